"""Search-result dumps as VARIANT: items whose fields vary in name and kind, from runs of several queries or of one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import CORRUPT, FIELDS


def _text(value: Column, field: str) -> Column:
    """A field as text, null where it is missing or counts as nothing: the number 0, false, null (the text "0" is a value)."""
    found = F.try_variant_get(value, f"$.{field}", "string")
    plain = F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))
    return F.when((plain != "STRING") & found.rlike(r"^(-?0(\.0*)?|false)$"), None).otherwise(found)


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).filter(F.trim("value") != "")
    item = F.try_parse_json("value")
    return lines.select("value", item.alias("item")).withColumn(CORRUPT, F.when(F.try_variant_get("item", "$.kol_id", "string").isNull(), F.col("value")))


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """A row per JSON line: expert, chunk_no (of a run of several queries) or cluster_no (of a run of one), item_pos, what the
    item echoes, and results: an array of the fields that serp reads, with the whole result as VARIANT in raw, so that fields
    nobody has named yet are kept. results is null where it is no array. Lines that are no JSON object with an expert, or name a
    field twice, are left out: broken() has them. JSON numbers and texts both do as values.

    Members of a VARIANT stand in order of their names. That is why JSON-LD of pages, which is searched in the order it is
    written in, isn't read this way.
    """
    v = F.col("item")
    get = lambda name, kind: F.try_variant_get(v, f"$.{name}", kind)
    result = lambda r: F.struct(*[_text(r, f).alias(f) for f in FIELDS], r.alias("raw"))
    echoes = [_text(v, f).alias(f) for f in ("keyword", "query", "searchQuery")]
    pages = [get(f, "string").alias(f) for f in ("page_number", "page")]
    return _parsed(spark, path).filter(F.col(CORRUPT).isNull()).select(
        get("kol_id", "string").alias("kol_id"), get("roster_seq", "int").alias("roster_seq"), get("chunk_no", "int").alias("chunk_no"), get("cluster_no", "int").alias("cluster_no"),
        get("item_pos", "bigint").alias("item_pos"), *echoes, *pages, F.transform(get("results", "array<variant>"), result).alias("results"),
    )


def broken(spark: SparkSession, path: str) -> DataFrame:
    """file and record of the lines that read_items leaves out."""
    return _parsed(spark, path).select(F.input_file_name().alias("file"), F.col(CORRUPT).alias("record")).filter("record is not null")
