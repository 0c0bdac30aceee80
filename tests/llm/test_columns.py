"""Extra columns of any name: the stages keep them as they are, the other operators don't mind them."""

import pytest
from pyspark.sql import functions as F

from mentionflow.llm import chat, dedup, iblt, jaccard, mixing, packing, pii, quality, secrets, warc
from mentionflow.llm.common import Scratch

CLASHING = ["score", "_key", "_n", "_times", "_one", "a.b", "key", "n", "row", "turn", "turns", "times", "all", "size", "digest", "h1", "node", "part", "at", "value", "label"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, f"w{i % 9} w w{i % 7} " * (3 + i % 5), "en", "ab"[i % 2], None) for i in range(40)] + [(3, "w3 w w3 " * 6, "en", "b", None), (None, None, None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.select("*", *[F.concat(F.lit(f"mine-{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASHING])
    return df.withColumn("a_map", F.create_map(F.lit("k"), F.col("doc_id")))


def unchanged(before, after):
    assert after.columns == before.columns
    own = {tuple(map(str, r)) for r in before.collect()}
    got = [tuple(map(str, r)) for r in after.collect()]
    assert set(got) <= own
    return got


def test_stages_keep_other_columns(clashing):
    labels = clashing.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("label"), F.lit(0).alias("text"))
    model = quality.train(clashing, labels)
    assert len(unchanged(clashing, quality.accepted(clashing, model, 0.0))) == clashing.count()
    assert len(unchanged(clashing, dedup.drop_exact_copies(clashing))) == clashing.select("text").distinct().count()
    kept = unchanged(clashing, jaccard.one_of_each_class(clashing))
    assert len(kept) == jaccard.similar_documents(clashing).select("class_id").distinct().count()
    assert unchanged(clashing, mixing.mixed_documents(clashing))


def test_mix_in_order(spark, clashing):
    df = clashing.filter("doc_id is not null").dropDuplicates(["doc_id"])
    turns = mixing.mix(df, Scratch(spark, "test")).select("doc_id", F.explode("turns").alias("t")).orderBy(*[f"t.{c}" for c in mixing.ORDER])
    ordered = mixing.mixed_documents(df, in_order=True)
    assert [r.doc_id for r in ordered.collect()] == [r.doc_id for r in turns.collect()]
    total = sum(len(r.text.split()) for r in ordered.collect())
    assert total <= sum(len(r.text.split()) for r in df.collect())
    unchanged(df, ordered)


def test_other_columns_are_ignored(spark, clashing):
    plain = clashing.select("doc_id", "text", "source")
    same = lambda f: sorted(map(str, f(clashing).collect())) == sorted(map(str, f(plain).collect()))
    assert same(dedup.exact_groups)
    assert same(lambda d: mixing.mix(d, Scratch(spark, "test")))
    assert same(iblt.document_fingerprints)
    assert same(secrets.secret_spans)
    assert same(lambda d: pii.pseudonyms(d, b"k"))
    lengths = lambda d: packing.packed(d).select("doc_id", "piece", "length", "ids_crc32")
    assert same(lengths)
    pages = clashing.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"), *[F.col(f"`{c}`") for c in CLASHING])
    assert sorted(map(str, warc.archived(pages).collect())) == sorted(map(str, warc.archived(pages.select("page_id", "url", "html")).collect()))
    turns = clashing.select(F.col("doc_id").alias("conv_id"), F.lit(1).alias("turn"), F.lit("user").alias("role"), "text", F.lit("x").alias("tree"), F.lit("y").alias("id"), F.col("`a.b`"), "a_map")
    assert chat.format_paths(chat.conversation_nodes(turns)).count() == clashing.select("doc_id").distinct().count()
