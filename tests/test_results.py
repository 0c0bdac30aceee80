"""Search results, pages, identity, health, sinks."""

import dataclasses
import datetime
import threading

import pytest
from pyspark.sql import functions as F

from mentionflow.operators import health, identity, names, pages, serp
from mentionflow.plans import monitor as M
from mentionflow.sources import sinks, tables

ITEM = tables.SERP_ITEMS


def item(pos, results, chunk=1, keyword=None, page=None):
    blank = dict.fromkeys(tables._FIELDS)
    return ("K1", 1, chunk, pos, keyword, None, None, None, page, None if results is None else [tuple({**blank, **r}.values()) for r in results])


def chunks(spark, *qs):
    return spark.createDataFrame([("K1", 1, 1, [(i, q) for i, q in enumerate(qs, 1)])], "kol_id string, roster_seq int, chunk_no int, queries array<struct<cluster_no int, query string>>")


def test_attribution(spark):
    items = spark.createDataFrame([item(0, [], keyword=" QB "), item(1, [], keyword="other"), item(2, [])], ITEM)
    got = {r.item_pos: (r.cluster_no, r.search_query, r.unattributed) for r in serp.attributed(items, chunks(spark, "qa", "qb")).collect()}
    assert got == {0: (2, "qb", False), 1: (1, "qa", True), 2: (1, "qa", True)}
    alone = serp.attributed(items, chunks(spark, "qa")).collect()
    assert {(r.cluster_no, r.unattributed) for r in alone} == {(1, False)}


def test_merged_items_and_first_by_url(spark):
    rows = [item(0, [{"url": "https://a/1"}]), item(1, [{"link": "https://a/2"}, {"url": ""}, {"url": " https://a/2"}], page="all"), item(2, [{"url": "https://a/3"}], page="all")]
    flat = serp.flattened(serp.attributed(spark.createDataFrame(rows, ITEM), chunks(spark, "q")))
    assert sorted(r.url for r in flat.collect()) == [" https://a/2", "https://a/2"]
    assert [r.url for r in serp.first_by_url(flat).collect()] == ["https://a/2"]
    rows[1] = item(1, None, page="all")  # no results: every item counts
    flat = serp.flattened(serp.attributed(spark.createDataFrame(rows, ITEM), chunks(spark, "q")))
    assert sorted(r.url for r in flat.collect()) == ["https://a/1", "https://a/3"]


def test_first_by_url_of_results_in_one_place(spark):
    """Two items in one place with one URL but for blanks: the smaller spelling stays, in whatever order they come."""
    both = [item(0, [{"url": "https://a/1 "}]), item(0, [{"url": "https://a/1"}])]
    for rows in (both, both[::-1]):
        flat = serp.flattened(serp.attributed(spark.createDataFrame(rows, ITEM), chunks(spark, "q")))
        assert [r.url for r in serp.first_by_url(flat).collect()] == ["https://a/1"]


def test_processed(spark):
    roster = spark.createDataFrame([("K1", 1, "Ann Lee")], "kol_id string, roster_seq int, kol_name string")
    rows = [item(0, [{"url": "https://x.com/a", "title": "Ann Lee | hi", "snippet": "s", "date": "today", "position": "0"}])]
    r = serp.processed(serp.flattened(serp.attributed(spark.createDataFrame(rows, ITEM), chunks(spark, "q"))), roster).first()
    assert (r.author, r.description, r.published_date, r.position, r.source, r.platform, r.activity_type) == ("Ann Lee", "s", "today", "", "x.com", "X", "SMA")


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ('<head><meta property="og:title" content="A  B"><title>T</title></head><body>x <script>y</script>z</body>', ("A B", "", "", "", "x yz")),
        ("<title>Only &amp; title</title><p>loose", ("Only & title", "", "", "", "loose")),
        ('<meta name="date" content=" 2024 "><time datetime="2023">', ("", "", "", "2024", "")),
        ('<body><time>a</time><time datetime="2023">b</time></body>', ("", "", "", "2023", "ab")),
        ('<script type="application/ld+json">{bad</script><script type="application/ld+json">[{"a":{"dateCreated":"d1"},"@graph":[{"datePublished":"d2"}]}]</script>', ("", "", "", "d2", '{bad[{"a":{"dateCreated":"d1"},"@graph":[{"datePublished":"d2"}]}]')),
        ('<body><p class="x post-date">on <b>May</b> 1</p><span itemprop="dateCreated">s</span></body>', ("", "", "", "s", "on May 1s")),
        ('<body><div class="published"><div>in</div>out</div>after</body>', ("", "", "", "inout", "inoutafter")),
        ("", ("", "", "", "", "")),
        (None, ("", "", "", "", "")),
    ],
)
def test_parse_page(html, expected):
    assert pages.parse_page(html) == expected


def test_page_table(spark):
    df = spark.createDataFrame([("u1", "<title>Just a Moment...</title><body>b</body>"), ("u2", "<title>T</title><body>" + "x" * 9000 + "</body>"), ("u3", None)], "url string, html string")
    got = {r.url: (r.title, len(r.body_text)) for r in pages.page_metadata(df).collect()}
    assert got == {"u1": ("", 0), "u2": ("T", 8000), "u3": ("", 0)}
    results = spark.createDataFrame([("u2", "Website", "old", "", "a", ""), ("u2", "X", "old", "", "a", ""), ("u9", "Website", "old", "", "a", "")], "url string, platform string, title string, description string, author string, published_date string")
    over = sorted((r.url, r.platform, r.title, r.author) for r in pages.overlay(results, pages.page_metadata(df)).collect())
    assert over == [("u2", "Website", "T", "a"), ("u2", "X", "old", "a"), ("u9", "Website", "old", "a")]
    assert [r.url for r in pages.frontier(results).orderBy("url").collect()] == ["u2", "u9"]


def test_overlay_of_a_url_that_was_fetched_twice(spark):
    meta = spark.createDataFrame([("u", "T1", "d", "", "", ""), ("u", "T2", "", "", "", "b"), ("v", "V", "", "", "", "")], "url string, title string, description string, author string, published_date string, body_text string")
    results = spark.createDataFrame([("u", "Website", "old", "own", "a", "")], "url string, platform string, title string, description string, author string, published_date string")
    for table in (meta, meta.orderBy("title")):
        assert [(r.title, r.description, r.body_text) for r in pages.overlay(results, table).collect()] == [("T2", "own", "b")]
    again = pages.page_metadata(spark.createDataFrame([(1, "u", "<title>A</title>"), (2, "u", "<title>B</title>")], "n int, url string, html string"), ("n", "url"))
    assert sorted((r.n, r.url, r.title) for r in again.collect()) == [(1, "u", "A"), (2, "u", "B")]


def test_verdicts_leave_other_columns_alone(spark):
    roster = names.name_forms(spark.createDataFrame([("A", 1, "Ann Bea Lee", "", "", "")], "kol_id string, roster_seq int, kol_name string, suffix string, affiliation string, specialty string"))
    rows = spark.createDataFrame([("A", 1, "Dr. Ann Lee", "", "", "mine")], "kol_id string, roster_seq int, title string, description string, body_text string, _own string")
    got = identity.verdicts(rows, roster)
    assert got.columns == [*rows.columns, "validity", "validity_signals"] and got.first()._own == "mine"


def test_identity(spark):
    people = [("A", "Michael Scott Perry", "MD", "Cook Children's Medical Center", "Neurology"), ("B", "Ghulam Rehman (Manni) Mohy-Ud-Din (Mohyuddin)", "", "", ""), ("C", "()", "", "", "")]
    roster = names.name_forms(spark.createDataFrame([(k, 1, n, s, a, f) for k, n, s, a, f in people], "kol_id string, roster_seq int, kol_name string, suffix string, affiliation string, specialty string"))
    cases = [
        ("A", "Michael Scott Perry wed", "REVIEW", "no-medical-context"), ("A", "Michael Scott Perry on neurological care", "VALID", "full-name+specialty"), ("A", "Michael Perry, friar", "REVIEW", "short-name-only"),
        ("A", "nobody here", "REVIEW", "name-not-visible"), ("A", "Michael Perry, DO, said", "REVIEW", "suffix-conflict:do"), ("A", "Michael Perry, MD, said", "VALID", "suffix-match+titled-name"), ("A", "his doctor told Michael Perry", "REVIEW", "short-name-only"),
        ("A", "Dr. Perry met Michael Perry", "VALID", "titled-name"), ("A", "epileptologist Michael Perry of Cook", "VALID", "affiliation+titled-name"), ("B", "Ghulam Mohyuddin, MD", "VALID", "full-name+titled-name"), ("C", "x", "REVIEW", "unparseable-name"),
    ]
    df = spark.createDataFrame([(i, k, 1, t, None, "") for i, (k, t, _, _) in enumerate(cases)], "i int, kol_id string, roster_seq int, title string, description string, body_text string")
    got = [(r.validity, r.validity_signals) for r in identity.verdicts(df, roster).orderBy("i").collect()]
    assert got == [(v, s) for _, _, v, s in cases]
    assert identity.gated(df, roster, "drop").count() == sum(v == "VALID" for _, _, v, _ in cases)
    assert {r.validity for r in identity.gated(df, roster, "off").collect()} == {""}


def test_health(spark):
    roster = names.name_forms(spark.createDataFrame([(f"K{i:02}", 1, "()" if i == 9 else f"Ann L{i}", "") for i in range(10)], "kol_id string, roster_seq int, kol_name string, affiliation string"))
    final = spark.createDataFrame([("K00", 1, "VALID"), ("K00", 1, "REVIEW"), ("K01", 1, "VALID")], "kol_id string, roster_seq int, validity string")
    failed = spark.createDataFrame([("K05", 1), ("K06", 1)], "kol_id string, roster_seq int")
    lost = spark.createDataFrame([(f"K{i:02}", 1, c, f"q{i}{c}") for i in range(10) for c in range(1, 6)], "kol_id string, roster_seq int, cluster_no int, query string")
    r = health.summary(roster, final, failed, lost).first()
    assert (r.total_kols, r.kols_failed, r.queries_failed, r.kols_zero_results, r.review_rows, r.total_results, r.degraded) == (10, 2, 50, 5, 1, 3, True)
    assert list(r.failed_kol_names) == ["Ann L5", "Ann L6"]
    assert len(r.failed_query_samples) == 21 and r.failed_query_samples[:4] == ["q01", "q02", "q03", "q11"]
    with pytest.raises(health.DegradedRun):
        health.raise_if_degraded(health.summary(roster, final, failed, lost))
    empty = health.summary(roster.limit(0), final.limit(0), failed.limit(0), lost.limit(0)).first()
    assert (empty.total_kols, empty.failure_rate_pct, empty.degraded, list(empty.failed_query_samples)) == (0, 0.0, False, [])


def test_staging(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = spark.createDataFrame([("K", "u1"), ("K", None)], "kol_id string, url string")
    sinks.stage(rows.limit(1), root, "run-one-with-a-long-tag")
    assert sinks.promote(spark, root, "run-one-with-a-long-tag") == 1
    sinks.stage(rows, root, "run2")
    sinks.stage(rows, root, "run2")  # a retried run replaces its leftover
    assert sinks.promote(spark, root, "run2") == 2
    sinks.stage(rows.limit(0), root, "run3")
    assert sinks.promote(spark, root, "run3") is None
    out = sinks.current(spark, root)
    assert out.count() == 2 and out.columns[:3] == ["KOL_ID", "KOL_Name", "Search_Query"] and len(out.columns) == 14
    assert out.filter("URL is null or Title is null").count() == 0
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["output"]
    sinks.stage(rows.limit(0), root, "run4")
    assert sinks.promote(spark, root, "run4", promote_empty=True) == 0 and sinks.current(spark, root).count() == 0


def test_monitor_end_to_end(spark, tmp_path):
    raw = spark.createDataFrame([("K1", "Ann Bea Lee, MD", "MD", "", "Neurology"), ("K2", "Bo Ray", "", "", "")], tables.ROSTER)
    q = '("Ann Bea Lee" OR "Ann Lee" OR "Ann B Lee") (MD OR Dr OR PhD)'
    items = spark.createDataFrame([item(0, [{"url": "https://a.org/news/1", "title": "t", "date": "2024-01-30"}, {"url": "https://a.org/news/1/", "title": "t2", "date": "today"}, {"url": "https://md.com/x", "date": "today"}], keyword=q)], ITEM)
    page = spark.createDataFrame([("https://a.org/news/1", "<title>Dr. Ann Lee said</title>")], tables.PAGES)
    log = spark.createDataFrame([("K1", 1, c, "q", "ok", "") for c in range(1, 7)] + [("K2", 1, c, "q", "ok", "") for c in range(1, 7)], tables.FETCH_LOG)
    run = M.Run(as_of=datetime.date(2024, 1, 31), run_tag="r1")
    done = M.monitor(spark, raw, items, page, log, f"file://{tmp_path}", run).first()
    assert (done.total_results, done.kols_zero_results, done.degraded) == (1, 1, False)
    r = sinks.current(spark, f"file://{tmp_path}").first()
    assert (r.KOL_ID, r.Title, r.Activity_Type, r.Validity, r.Validity_Signals) == ("K1", "Dr. Ann Lee said", "Press", "VALID", "titled-name")
    page = spark.createDataFrame([("https://a.org/news/1", "<title>Nobody said</title>")], tables.PAGES)
    done = M.monitor(spark, raw, items, page, log, f"file://{tmp_path}/drop", dataclasses.replace(run, identity_gate="drop", promote_empty_run=True)).first()
    assert (done.total_results, done.dropped_by_gate, done.review_rows, done.kols_zero_results) == (0, 1, 0, 2)
    tagged = M.monitor(spark, raw, items, page, log, f"file://{tmp_path}/tag", run).first()
    assert (tagged.total_results, tagged.dropped_by_gate, tagged.review_rows) == (1, 0, 1)


def test_readers_see_whole_versions(spark, tmp_path):
    """A reader in a loop sees each version whole while others are promoted, and never none."""
    root, seen, stop, failed = f"file://{tmp_path}", set(), threading.Event(), []
    rows = lambda tag, n: spark.createDataFrame([(tag, f"u{i}") for i in range(n)], "title string, url string")

    def read():
        try:
            while not stop.is_set():
                seen.add(tuple(sorted((r.Title, r.n) for r in sinks.current(spark, root).groupBy("Title").agg(F.count("*").alias("n")).collect())))
        except Exception as e:  # told below
            failed.append(e)

    sinks.stage(rows("v0", 5), root, "v0")
    assert sinks.version(spark, root) == 0 and sinks.promote(spark, root, "v0") == 5
    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 7):
        sinks.stage(rows(f"v{k}", 5 + k), root, f"v{k}")
        sinks.promote(spark, root, f"v{k}", keep=4)
    stop.set()
    reader.join()
    assert not failed and seen <= {((f"v{k}", 5 + k),) for k in range(7)} and len(seen) > 1
    assert sinks.version(spark, root) == 7 and len(list((tmp_path / "output").glob("0*"))) == 4


def test_of_two_promotions_one_fails(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = spark.createDataFrame([("t", "u")], "title string, url string")
    for tag in ("a", "b"):
        sinks.stage(rows, root, tag)
    assert sinks.promote(spark, root, "a", based_on=0) == 1
    with pytest.raises(sinks.Conflict):
        sinks.promote(spark, root, "b", based_on=0)
    with pytest.raises(sinks.Conflict):  # both had seen the same log
        sinks._commit(spark, root, 1, "other")
    assert sinks.version(spark, root) == 1 and sinks.promote(spark, root, "b") == 1 and sinks.version(spark, root) == 2


def test_gate_puts_texts_into_plain_words_once(spark):
    """However many steps look at a text, and with a filter on the verdict, its plain words stand in the plan once."""
    roster = names.name_forms(spark.createDataFrame([("A", 1, "Ann Bea Lee", "MD", "Mayo", "Neurology")], "kol_id string, roster_seq int, kol_name string, suffix string, affiliation string, specialty string"))
    rows = spark.createDataFrame([("A", 1, "Dr. Ann Lee", "", "")], "kol_id string, roster_seq int, title string, description string, body_text string")
    for mode in ("tag", "drop"):
        df = identity.gated(rows, roster, mode)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("[^A-Za-z0-9_\\-]+") == 1
        assert [(r.validity, r.validity_signals) for r in df.collect()] == [("VALID", "titled-name")]
