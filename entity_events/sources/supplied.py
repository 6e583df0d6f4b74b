"""The supplied tables read as a change feed with its registries.

``events`` become readings of the entity ``<event_type>.user_<user_id>``. ``customer``, ``supplier``,
``nation`` and ``region`` become the entity, device, area and floor registries. The expressions are
plain SQL text because the cross-check in another engine uses the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entity_events import fixed_values as fixed
from entity_events.operators.enrich import Registry
from entity_events.operators.skew import with_neighbours
from entity_events.session import configure

DOMAINS = ("error", "view", "click", "signup", "purchase")

ENTITY_ID = "event_type || '.user_' || CAST(user_id AS STRING)"

_DECIMAL = "CAST(CAST(value AS DECIMAL(12,2)) AS STRING)"

#: State texts: every kind of value, decimals only, or on/off.
STATES = {
    "mixed": f"""CASE event_id % 8
        WHEN 0 THEN 'on' WHEN 1 THEN 'off' WHEN 2 THEN {_DECIMAL}
        WHEN 3 THEN CAST(CAST(ts AS DATE) AS STRING) || 'T' || substring(CAST(ts AS STRING), 12, 8) || '+02:00'
        WHEN 4 THEN 'inf' WHEN 5 THEN '1_000' WHEN 6 THEN 'True' ELSE event_type END""",
    "decimal": _DECIMAL,
    "switch": "CASE WHEN value < 50 THEN 'on' ELSE 'off' END",
}

ATTRIBUTES = f"""'{{' || substring(props, 2, length(props) - 2)
    || ', "user": ' || CAST(user_id AS STRING) || ', "kind": "' || event_type || '", "icon": "mdi:user", "nothing": null'
    || ', "levels": [' || CAST(user_id AS STRING) || ', 1]'
    || CASE WHEN user_id % 2 = 0 THEN ', "friendly_name": "User ' || CAST(user_id AS STRING) || '"' ELSE '' END
    || CASE WHEN user_id % 3 = 0 THEN ', "longitude": ' || CAST(user_id % 180 AS STRING)
        || ', "latitude": ' || CAST(user_id % 4 AS STRING) ELSE '' END
    || CASE WHEN event_id % 4 = 0 THEN ', "Event Type": "' || event_type || '", "event_type!": "a ' || event_type
        || '"' ELSE '' END
    || CASE WHEN event_id % 4 = 1 THEN ', "none": []' ELSE '' END
    || CASE WHEN event_id % 16 = 0 THEN ', "Température été": "haut"' ELSE '' END
    || CASE WHEN event_id % 32 = 0 THEN ', "zone": {{"b": 1, "a": {{"c": "x"}}}}, "parts": [{{"n": 1}}, 2]' ELSE '' END
    || CASE WHEN event_id % 8 = 5 THEN ', "!!!": 1, " ": "x"' ELSE '' END
    || ', "temperature": "' || CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE {_DECIMAL} END || '"}}'"""

#: Registry columns over ``customer`` (with ``domain``), ``supplier``, ``nation`` and ``region``.
ENTITY_COLUMNS = {
    "entity_id": "domain || '.user_' || CAST(c_custkey AS STRING)",
    "domain": "domain",
    "object_id": "'user_' || CAST(c_custkey AS STRING)",
    "name": "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE c_name END",
    "original_name": "'Original ' || c_name",
    "device_class": "CASE WHEN c_custkey % 6 = 0 THEN c_mktsegment END",
    "original_device_class": "domain",
    "area_id": "CASE WHEN c_custkey % 3 = 0 THEN 'area_' || CAST(c_nationkey AS STRING) END",
    "device_id": "CASE WHEN c_custkey % 2 = 0 THEN 'device_' || CAST(c_custkey AS STRING) END",
    "platform": "'platform_' || CAST(c_custkey % 5 AS STRING)",
    "unit_of_measurement": "CASE WHEN c_custkey % 5 = 0 THEN 'kWh' END",
}
REGISTERED = "c_custkey % 10 <> 7"
DEVICE_COLUMNS = {
    "id": "'device_' || CAST(s_suppkey AS STRING)",
    "name": "s_name",
    "name_by_user": "CASE s_suppkey % 3 WHEN 0 THEN 'My ' || s_name WHEN 1 THEN '' END",
    "area_id": "CASE WHEN s_suppkey % 7 <> 0 THEN 'area_' || CAST(s_nationkey AS STRING) END",
}
DEVICE_LABEL = "CASE WHEN s_acctbal > 5000 THEN 'rich' ELSE 'poor' END"
AREA_COLUMNS = {
    "id": "'area_' || CAST(n_nationkey AS STRING)",
    "name": "n_name",
    "floor_id": "CASE WHEN n_nationkey % 5 <> 0 THEN 'floor_' || CAST(n_regionkey AS STRING) END",
}
FLOOR_COLUMNS = {"floor_id": "'floor_' || CAST(r_regionkey AS STRING)", "name": "r_name"}

#: ``events`` as lines of a change feed, some of them cut short or no JSON at all.
_SECOND = "substring(CAST(ts AS STRING), 1, 10) || 'T' || substring(CAST(ts AS STRING), 12, 8) || 'Z'"
_NUMBERED = "'{' || chr(92) || '\"n' || chr(92) || '\":' || CAST(event_id AS STRING) || '}'"
_WHOLE_LINE = f"""'{{"time_fired":"' || {_SECOND} || '","old_state":null,"new_state":{{"entity_id":"' || {ENTITY_ID}
    || '","state":"' || {STATES["switch"]} || '","attributes":"' || {_NUMBERED} || '"}}}}'"""
EVENT_LINE = f"""CASE WHEN event_id % 50 = 7 THEN substring({_WHOLE_LINE}, 1, CAST(20 + event_id % 90 AS INT))
    WHEN event_id % 100 = 57 THEN 'no event ' || CAST(event_id AS STRING) ELSE {_WHOLE_LINE} END"""
BROKEN_LINE = "event_id % 50 = 7"

#: Event rows that report a removed entity, and bulk items that failed.
REMOVAL = "seq % 50 = 0"
FAILED = "value > 100"
STREAM_HEAD = f"{fixed.STREAM_TYPE}-{fixed.DATASET_PREFIX}."
STREAM_TAIL = f"-{fixed.STREAM_NAMESPACE}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One supplied table."""
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def readings_of(events: DataFrame, states: str = "mixed") -> DataFrame:
    """``events`` rows as readings; works on a stream as well."""
    return events.select(
        F.expr(ENTITY_ID).alias("entity_id"),
        F.col("ts").cast("timestamp").alias("time"),
        F.col("event_id").alias("seq"),
        F.expr(STATES[states]).alias("state"),
        F.expr(ATTRIBUTES).alias("attributes"),
    )


def readings(spark: SparkSession, folder: str, states: str = "mixed") -> DataFrame:
    """The feed, each reading with its new state only."""
    return readings_of(table(spark, folder, "events"), states)


def feed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as text lines (value) of a change feed, with the time of each beside it."""
    return table(spark, folder, "events").select(
        F.expr(EVENT_LINE).alias("value"), F.col("ts").cast("timestamp").alias("time")
    )


def order_readings(spark: SparkSession, folder: str) -> DataFrame:
    """``orders`` as a long, sparse feed: one reading per order of the customer's entity."""
    return table(spark, folder, "orders").select(
        F.expr("'purchase.user_' || CAST(o_custkey AS STRING)").alias("entity_id"),
        F.col("o_orderdate").cast("timestamp").alias("time"),
        F.col("o_orderkey").alias("seq"),
        F.expr("CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING)").alias("state"),
        F.lit(None).cast("string").alias("attributes"),
    )


def _columns(columns: dict[str, str]) -> list:
    return [F.expr(sql).alias(name) for name, sql in columns.items()]


def registry(spark: SparkSession, folder: str, whole: bool = False) -> Registry:
    """The four registries; some devices and floors are missing on purpose, and some entities unless ``whole``."""
    customers = table(spark, folder, "customer")
    if not whole:
        customers = customers.where(REGISTERED)
    by_domain = customers.withColumn("domain", F.explode(F.array(*map(F.lit, DOMAINS))))
    return Registry(
        entities=by_domain.select(
            *_columns(ENTITY_COLUMNS), F.array("domain", "c_mktsegment").alias("labels")
        ),
        devices=table(spark, folder, "supplier").select(
            *_columns(DEVICE_COLUMNS), F.array(F.expr(DEVICE_LABEL)).alias("labels")
        ),
        areas=table(spark, folder, "nation").select(*_columns(AREA_COLUMNS)),
        floors=table(spark, folder, "region").select(*_columns(FLOOR_COLUMNS)),
    )


def change_events(spark: SparkSession, folder: str) -> DataFrame:
    """The on/off feed as change events that carry the old state; some report a removal."""
    rows = with_neighbours(
        readings(spark, folder, "switch"), "entity_id", "time", ["state"], previous=True
    )

    def state(text: Column) -> Column:
        return F.struct(
            "entity_id",
            text.alias("state"),
            "attributes",
            F.col("time").alias("last_changed"),
            F.timestamp_micros("seq").alias("last_updated"),
        )

    return rows.select(
        F.col("time").alias("time_fired"),
        F.when(F.col("previous").isNotNull(), state(F.col("previous.state"))).alias("old_state"),
        F.when(F.expr(f"NOT ({REMOVAL})"), state(F.col("state"))).alias("new_state"),
    )


def bulk_responses(spark: SparkSession, folder: str) -> DataFrame:
    """One bulk response per hundred events; items of high-valued events have failed."""
    events = table(spark, folder, "events")
    index = F.concat(F.lit(STREAM_HEAD), "event_type", F.lit(STREAM_TAIL))
    failed = F.expr(FAILED)
    item = F.struct(
        F.struct(
            index.alias("_index"),
            F.col("event_id").cast("string").alias("_id"),
            F.when(failed, 400).otherwise(201).alias("status"),
            F.when(~failed, "created").alias("result"),
            F.when(
                failed,
                F.struct(
                    F.lit("document_parsing_exception").alias("type"),
                    F.concat(F.lit("value "), F.expr(_DECIMAL)).alias("reason"),
                ),
            ).alias("error"),
        ).alias("create")
    )
    placed = F.sort_array(F.collect_list(F.struct("event_id", item.alias("item"))))
    batches = events.groupBy(F.floor(F.col("event_id") / 100).alias("batch_id")).agg(
        placed.alias("placed"), F.bool_or(failed).alias("errors")
    )
    items = F.transform("placed", lambda entry: entry["item"])
    return batches.select(
        "batch_id",
        F.to_json(F.struct("errors", F.lit(1).alias("took"), items.alias("items"))).alias("response"),
    )
