"""Dumps read as VARIANT: what counts as a value, what is kept, what is left out, and the union of two kinds of runs."""

from pyspark.sql import functions as F

from mentionflow.operators import serp
from mentionflow.sources import dumps

LINES = """
{"kol_id": "K1", "roster_seq": 1, "chunk_no": 1, "item_pos": 0, "keyword": 0, "query": "Q A", "page_number": 1, "results": [{"link": "u1", "url": "", "position": 0, "new": {"x": [1, 2]}}, {"url": "u2", "position": "0"}]}
{"results": [{"url": false, "link": "u3", "title": null, "position": 12}], "item_pos": "1", "kol_id": "K1", "roster_seq": "1", "chunk_no": 1, "keyword": "q b"}
{"kol_id": "K1", "roster_seq": 1, "chunk_no": 1, "item_pos": 2, "results": {"url": "u9"}}
{"kol_id": "K1", "roster_seq": 1, "chunk_no": 1, "item_pos": 3, "results": []}
   
{"kol_id": "K1", "roster_seq": 1, "chunk_no": 1, "item_pos": 4, "results": [{"url": "u4"}
{"kol_id": "K1", "kol_id": "K2", "item_pos": 5}
[1, 2]
7
{"item_pos": 6}
"""
ONE = """
{"kol_id": "K1", "roster_seq": 1, "cluster_no": 2, "item_pos": 0, "keyword": "something else", "results": [{"url": "u1"}, {"url": " u5 "}]}
{"kol_id": "K1", "roster_seq": 1, "cluster_no": 1, "item_pos": 7, "page": "all", "results": [{"url": "u6"}]}
{"kol_id": "K1", "roster_seq": 1, "cluster_no": 1, "item_pos": 1, "results": [{"url": "u7"}]}
{"kol_id": "K9", "roster_seq": 1, "cluster_no": 1, "item_pos": 1, "results": [{"url": "u8"}]}
"""


def written(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return f"file://{path}"


def manifest(spark):
    return spark.createDataFrame([("K1", 1, 1, "Q a"), ("K1", 1, 2, "Q b")], "kol_id string, roster_seq int, cluster_no int, query string")


def chunks(spark):
    return manifest(spark).groupBy("kol_id", "roster_seq").agg(F.sort_array(F.collect_list(F.struct("cluster_no", "query"))).alias("queries")).withColumn("chunk_no", F.lit(1))


def test_values_of_a_dump(spark, tmp_path):
    path = written(tmp_path, "several.json", LINES)
    items = {r.item_pos: r for r in dumps.read_items(spark, path).collect()}
    assert sorted(items) == [0, 1, 2, 3]
    assert items[0].keyword is None and items[0].query == "Q A" and items[0].page_number == "1"
    assert [(r.url, r.link, r.position) for r in items[0].results] == [("", "u1", None), ("u2", None, "0")]
    assert [(r.url, r.link, r.title, r.position) for r in items[1].results] == [(None, "u3", None, "12")]
    assert items[2].results is None and items[3].results == []


def test_lines_left_out_are_kept(spark, tmp_path):
    path = written(tmp_path, "several.json", LINES)
    assert sorted(r.record[:9] for r in dumps.broken(spark, path).collect()) == sorted(['{"kol_id"', '{"kol_id"', "[1, 2]", "7", '{"item_po'])
    empty = written(tmp_path, "empty.json", "\n")
    assert dumps.read_items(spark, empty).count() == dumps.broken(spark, empty).count() == 0


def test_unknown_fields_survive(spark, tmp_path):
    items = dumps.read_items(spark, written(tmp_path, "several.json", LINES))
    rows = serp.first_by_url(serp.flattened(serp.attributed(items, chunks(spark))))
    got = {r.url: (r.cluster_no, r.x) for r in rows.select("url", "cluster_no", F.try_variant_get("r.raw", "$.new.x[1]", "int").alias("x")).collect()}
    assert got == {"u1": (1, 2), "u2": (1, None), "u3": (2, None)}


def test_two_kinds_of_runs(spark, tmp_path):
    several = serp.flattened(serp.attributed(dumps.read_items(spark, written(tmp_path, "several.json", LINES)), chunks(spark)))
    one = serp.flattened(serp.of_one_query(dumps.read_items(spark, written(tmp_path, "one.json", ONE)), manifest(spark)))
    got = {r.url: (r.pass_no, r.cluster_no, r.search_query) for r in serp.first_by_url(serp.united(several, one)).collect()}
    # A merged item overrides the others of its query; u1 was found by a run of several queries first.
    assert got == {"u1": (0, 1, "Q a"), "u2": (0, 1, "Q a"), "u3": (0, 2, "Q b"), " u5 ": (1, 2, "Q b"), "u6": (1, 1, "Q a")}
