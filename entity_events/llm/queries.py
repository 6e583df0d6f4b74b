"""The registered queries of the training-data operators: each applies one to its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entity_events.llm import (
    alignment,
    chat,
    decontaminate,
    fingerprints,
    hard_negatives,
    language,
    mixing,
    ngram_join,
    quality_rules,
    secrets,
    token_counts,
    toxicity,
    url_filter,
)
from entity_events.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        return query

    return add


@register("op1_mix_sources")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    taken = (F.col("size") * F.col("copies")).cast("long").alias("taken")
    return mixing.planned(docs).select("doc_id", "size", "source_size", "target", taken)


@register("op2_decontaminate")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    n_items = F.size("items").cast("long").alias("n_items")
    return found.select("doc_id", "n_words", "n_hit", n_items, digest, "contaminated")


@register("op3_count_tokens")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > token_counts.LIMIT)


@register("op4_toxicity")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    held_out = language.held_out(F.col("doc_id"), 5, 0)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    scored = toxicity.scored(docs, labels, ~held_out)
    predicted = (F.col("score") >= toxicity.LIMIT).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


@register("op6_language")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    held_out = language.held_out(F.col("doc_id"), 3, 1)
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    learnable = ~held_out & F.col("doc_id").isNotNull()
    return language.predicted(docs, learnable).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register("op7_fingerprint")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = fingerprints.with_next(table(spark, folder, "documents"))
    docs = docs.withColumn("edited", fingerprints.edited(F.col("text"), F.col("next_text")))
    docs = docs.withColumn("edited_print", fingerprints.fingerprint(F.col("edited")))
    return docs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("print")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_print")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        fingerprints.likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


@register("op8_ngram_join")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.joined(table(spark, folder, "documents").select("doc_id", "text"))


@register("op9_format_chats")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.rendered(chat.folded(chat.message_events(rows.unionByName(extra)))))


@register("op10_find_secrets")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.with_spans(table(spark, folder, "documents"))

    def listed(spans: Column) -> Column:
        places = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(places, ",")

    def of_kind(kind: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "live")
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS[:3]]
    digest = F.sha2(listed(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, listed(F.col("spans")).alias("spans"))


RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)


@register("op5_judge_urls")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    # Outcomes: the labels of the ids that pages share; bad is low quality or toxic.
    bad = F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), F.greatest(1 - F.col("quality"), "toxic"))
    outcomes = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), bad.cast("long").alias("bad"))
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judged(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


@register("op11_quality_rules")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.assessed(table(spark, folder, "documents"), ["doc_id"])
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("row.doc_id", *counts, "base_failed", "kept")


@register("op12_hard_negatives")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mined(table(spark, folder, "embeddings"), vec_id % 50 == 0, moved)


@register("op13_align_tokens")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.aligned(table(spark, folder, "documents"), *paths)
