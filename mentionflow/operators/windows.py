"""The final date filter for many runs at once: results joined with the windows of runs by buckets of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import fixed
from ..functions.text import once, trimmed

#: Days of a bucket; shares that undated results, which every run keeps, are dealt out to.
DAYS, SALTS = 30, 16


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / DAYS).cast("int")


def kept_by_runs(results: DataFrame, runs: DataFrame, date_text: str = "date_text", activity: str = "activity_type") -> DataFrame:
    """run_id and the columns of results, a row for each run (run_id, as_of date, days_back) whose filter keeps the result:
    what dates.date_decision says for that run's day and look-back.

    Runs become the buckets that their windows touch, a few each, and results have one bucket each, so the join is one on
    equal keys; days are compared within a bucket only. Relative phrases meet the runs that look back as far.
    """
    text = trimmed(F.coalesce(F.col(date_text), F.lit("")))
    read = F.struct(text.alias("text"), D.relative_days(text).alias("relative"), D.absolute_date(text).alias("day"), D.policy(activity).alias("policy"))
    rows = once(results, "_read", read)
    r = {name: F.col(f"_read.{name}") for name in ("text", "relative", "day", "policy")}
    undated = (r["text"] == "") | (r["relative"].isNull() & r["day"].isNull())
    kind = F.when(undated, F.when(r["policy"] != "strict", "undated")).when(r["relative"].isNotNull(), "relative").when(r["policy"] == "event", "event").otherwise("dated")
    at = F.when(undated, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).when(r["relative"].isNotNull(), r["relative"].cast("int")).otherwise(_bucket(r["day"]))
    rows = rows.withColumns({"_kind": kind, "_at": at, "_day": r["day"]}).filter("_kind is not null").drop("_read")

    first, last, horizon = F.date_sub("as_of", F.col("days_back")), F.col("as_of"), F.date_add("as_of", fixed.EVENT_HORIZON_DAYS)
    span = lambda kind, start, end: F.transform(F.sequence(start, end), lambda b: F.struct(F.lit(kind).alias("_kind"), b.alias("_at")))
    keys = F.concat(span("dated", _bucket(first), _bucket(last)), span("event", _bucket(first), _bucket(horizon)), span("relative", F.lit(0), F.col("days_back").cast("int")), span("undated", F.lit(0), F.lit(SALTS - 1)))
    windows = runs.select("run_id", first.alias("_first"), last.alias("_last"), horizon.alias("_horizon"), F.inline(keys))
    within = F.when(F.col("_kind").isin("dated", "event"), F.col("_day").between(F.col("_first"), F.when(F.col("_kind") == "event", F.col("_horizon")).otherwise(F.col("_last")))).otherwise(True)
    return rows.join(windows, ["_kind", "_at"]).filter(within).select("run_id", *results.columns)
