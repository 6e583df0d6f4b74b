import pytest
from pyspark.sql import DataFrame


@pytest.fixture
def make(spark, tmp_path):
    """A table from rows and a schema; ``make.folder`` holds tables as the registered queries read them."""

    class Make:
        folder = str(tmp_path)

        def __call__(self, rows, schema: str) -> DataFrame:
            return spark.createDataFrame(rows, schema)

        def table(self, name: str, rows, schema: str) -> None:
            self(rows, schema).coalesce(1).write.parquet(f"{self.folder}/{name}.parquet")

    return Make()
