"""As-of and range joins, subtotals: against plain loops."""

import datetime
import random

from pyspark.sql import functions as F

from mentionflow.functions import dates as D
from mentionflow.operators import health, pages, windows

AS_OF = datetime.date(2024, 1, 31)


def test_overlay_as_of(spark):
    rng = random.Random(2)
    base = datetime.datetime(2024, 1, 1)
    at = lambda: base + datetime.timedelta(hours=rng.randrange(24 * 60))
    snaps = [(rng.choice(["a", "a", "a", "b", None]), at(), f"t{k}", rng.choice(["", "d"]), "", None, "body") for k in range(60)]
    rows = [(k, rng.choice(["a", "a", "b", "c", "", None]), at(), f"own{k}", "own") for k in range(80)]
    snaps += [("b", snaps[0][1], "same time", "", "", "", ""), ("b", snaps[0][1], "same time 2", "", "", "", ""), ("late", base + datetime.timedelta(days=99), "late", "", "", "", "")]
    rows += [(90, "b", snaps[0][1], "own", "own"), (91, "late", base, "own", "own"), (91, "late", base, "own", "own")]
    s = spark.createDataFrame(snaps, "url string, fetched_at timestamp, title string, description string, author string, published_date string, body_text string")
    r = spark.createDataFrame(rows, "id int, url string, at timestamp, title string, description string")
    want = []
    for k, url, when, title, description in rows:
        before = [x for x in snaps if x[0] == url and x[0] is not None and x[1] <= when]
        _, _, t, d, *_ = max(before, key=lambda x: (x[1], x[2])) if before else (None,) * 7
        want.append((k, t or title, d or description))
    for seconds in (3600, 7 * 86400, 10**10):
        got = pages.overlay_as_of(r.repartition(3), s, bucket_seconds=seconds)
        assert sorted((x.id, x.title, x.description) for x in got.collect()) == sorted(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_kept_by_runs(spark):
    rng = random.Random(4)
    day = lambda: (AS_OF + datetime.timedelta(days=rng.randrange(-500, 500))).isoformat()
    rows = [(k, rng.choice([day(), day(), "", " ", None, "junk", f"{rng.randrange(60)} days ago", "2 weeks ago", "today"]), rng.choice(["Conference", "Pubs", "Press", None])) for k in range(300)]
    runs = [(i, AS_OF - datetime.timedelta(days=rng.randrange(600)), rng.choice([0, 7, 9, 45, 400])) for i in range(12)]
    df = spark.createDataFrame(rows, "id int, date_text string, activity_type string")
    got = windows.kept_by_runs(df, spark.createDataFrame(runs, "run_id int, as_of date, days_back int"))
    want = set()
    for run_id, as_of, back in runs:
        want |= {(run_id, r.id) for r in df.filter(D.date_decision("date_text", "activity_type", as_of, back)["keep"]).select("id").collect()}
    found = [(r.run_id, r.id) for r in got.collect()]
    assert set(found) == want and len(found) == len(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_stage_rollup(spark):
    rows = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "x")], "kol_id string, reason string")
    out = health.stage_rollup({"one": rows, "two": rows.drop("reason").filter(F.col("kol_id") == "A")})
    got = {(r.kol_id, r.stage, r.reason, r.level): r.n for r in out.collect()}
    assert got == {
        ("A", "one", "x", 0): 1, ("A", "one", "y", 0): 1, ("B", "one", "x", 0): 1, ("A", "two", "", 0): 2, (None, "one", "x", 4): 2, (None, "one", "y", 4): 1, (None, "two", "", 4): 2,
        (None, "one", None, 5): 3, (None, "two", None, 5): 2, ("A", None, None, 3): 4, ("B", None, None, 3): 1,
    }
