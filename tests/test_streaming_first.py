"""Streams give the rows of the batch rules, in whatever order items arrive."""

import datetime
import random

import pytest

from mentionflow.operators import serp, urlfilter
from mentionflow.streaming import first

DAY = datetime.datetime(2024, 1, 1)
ITEMS = "kol_id string, roster_seq int, cluster_no int, search_query string, item_pos long, merged boolean, results array<struct<url: string, link: string, title: string>>"


def replayed(spark, tmp_path, rows, schema, rule, batches=5):
    """rows dealt out to files, each a micro-batch an hour later than the last; a row of nobody, days later, ends it."""
    for k in range(batches):
        at = [(*r, DAY + datetime.timedelta(hours=k)) for r in rows[k::batches]]
        spark.createDataFrame(at, f"{schema}, arrived timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    names = [f.split(" ")[0] for f in ("kol_id string", "roster_seq int")]
    last = spark.createDataFrame([("nobody", 1, DAY + datetime.timedelta(days=30))], "kol_id string, roster_seq int, arrived timestamp")
    spark.read.parquet(f"{tmp_path}/in").limit(1).drop(*names, "arrived").crossJoin(last).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    spark.conf.set(*first.STORE)
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = rule(stream, "2 days")
    query = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination(300)
    spark.conf.unset(first.STORE[0])
    return spark.read.schema(out.schema).parquet(f"{tmp_path}/out").filter("kol_id <> 'nobody'")


@pytest.mark.parametrize("seed", range(2))
def test_first_results(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for k in ("A", "B", "C"):
        for pos in range(12):
            merged = rng.random() < 0.25
            found = None if rng.random() < 0.2 else [(rng.choice([f"u{rng.randrange(9)}", f" u{rng.randrange(9)} ", "", None]), rng.choice([None, "u1"]), f"t{rng.randrange(99)}") for _ in range(rng.randrange(5))]
            rows.append((k, 1, rng.randrange(1, 4), "q", pos, merged, found))
    rng.shuffle(rows)
    want = serp.first_by_url(serp.flattened(spark.createDataFrame(rows, ITEMS)))
    got = replayed(spark, tmp_path, rows, ITEMS, first.first_results)
    as_set = lambda df: {tuple(r) for r in df.select(*sorted(want.columns)).collect()}
    assert as_set(got) == as_set(want) and got.count() == want.count() > 5


def test_first_by_normal_url(spark, tmp_path):
    rng = random.Random(3)
    schema = "kol_id string, roster_seq int, cluster_no int, item_pos long, result_pos int, url string, title string"
    rows = [(rng.choice("AB"), 1, rng.randrange(1, 4), pos, rng.randrange(3), rng.choice(["https://a.org/x?ref=%d" % pos, "HTTPS://a.org:443/x/", f"https://b.org/{pos % 3}", "bad"]), f"t{pos}") for pos in range(40)]
    rng.shuffle(rows)
    batch = spark.createDataFrame(rows, schema).withColumn("norm_url", first.normalized("url")).filter("norm_url <> ''")
    want = urlfilter.first_by_normal_url(batch, ["kol_id", "roster_seq"])
    got = replayed(spark, tmp_path, rows, schema, first.first_by_normal_url)
    as_set = lambda df: {tuple(r) for r in df.select(*sorted(want.columns)).collect()}
    assert as_set(got) == as_set(want) and got.count() == want.count() > 5
