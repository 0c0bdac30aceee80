"""Run health: totals, experts without results, capped samples, degraded runs, counts by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EXPERT = ["kol_id", "roster_seq"]


def failed_experts(fetch_log: DataFrame) -> DataFrame:
    return fetch_log.filter("cluster_no is null and status = 'failed'").select(*EXPERT).distinct()


def without_results(roster: DataFrame, final: DataFrame, failed: DataFrame) -> DataFrame:
    """Experts that have a name to search for, did not fail and have no final row."""
    searched = roster.filter("forms is not null")
    return searched.join(final.select(*EXPERT).distinct(), EXPERT, "left_anti").join(failed, EXPERT, "left_anti")


def query_samples(failed_queries: DataFrame, per_expert: int = 3, full_at: int = 20) -> DataFrame:
    """Up to three failed queries of each expert, in order, while fewer than twenty are held."""
    order = Window.partitionBy(*EXPERT).orderBy("cluster_no")
    some = failed_queries.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_expert)
    # The first twenty experts in order hold twenty queries at least, so no more are looked at.
    first = some.groupBy(*EXPERT).agg(F.count("*").alias("n")).orderBy(*EXPERT).limit(full_at)
    held = first.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy(*EXPERT).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return some.join(held.filter(F.col("before") < full_at).select(*EXPERT), EXPERT, "left_semi").drop("_n")


def summary(roster: DataFrame, final: DataFrame, failed: DataFrame, failed_queries: DataFrame, dropped: DataFrame | None = None, max_failure_rate_pct: float = 10) -> DataFrame:
    """One row: counters, two capped lists and whether the run is degraded. failed: experts that failed; dropped: rows that
    the identity gate took out, if it takes any."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    names = roster.join(failed, EXPERT, "left_semi").select(*EXPERT, "kol_name").orderBy(*EXPERT).limit(50)
    listed = lambda df, order, value: F.transform(F.sort_array(F.collect_list(F.struct(*order, value))), lambda s: s[value])
    parts = [
        count(roster, "total_kols"),
        count(failed, "kols_failed"),
        names.agg(listed(names, EXPERT, "kol_name").alias("failed_kol_names")),
        count(failed_queries, "queries_failed"),
        query_samples(failed_queries).agg(listed(None, [*EXPERT, "cluster_no"], "query").alias("failed_query_samples")),
        count(without_results(roster, final, failed), "kols_zero_results"),
        final.agg(F.count_if(F.col("validity") == "REVIEW").alias("review_rows"), F.count("*").alias("total_results")),
    ]
    whole = parts[0]
    parts.append(count(final.limit(0) if dropped is None else dropped, "dropped_by_gate"))
    for part in parts[1:]:  # one row each
        whole = whole.join(part, F.lit(True))
    rate = F.when(F.col("total_kols") > 0, F.col("kols_failed") / F.col("total_kols") * 100).otherwise(F.lit(0.0))
    return whole.withColumn("failure_rate_pct", rate).withColumn("degraded", F.col("failure_rate_pct") > max_failure_rate_pct)


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows of each expert at each stage; a stage may have a reason column."""
    out = None
    for name, df in stages.items():
        reason = F.col("reason") if "reason" in df.columns else F.lit("")
        part = df.groupBy(*EXPERT, reason.alias("reason")).agg(F.count("*").alias("n")).withColumn("stage", F.lit(name)).select(*EXPERT, "stage", "reason", "n")
        out = part if out is None else out.unionByName(part)
    return out


def stage_rollup(stages: dict[str, DataFrame]) -> DataFrame:
    """kol_id, stage, reason, level, n: rows of each stage by expert and reason, of each stage and reason, of each stage,
    and of each expert over all stages, in one pass over the tagged rows. level: grouping_id of (kol_id, stage, reason);
    what a level sums over is null."""
    tagged = None
    for name, df in stages.items():
        part = df.select("kol_id", F.lit(name).alias("stage"), (F.col("reason") if "reason" in df.columns else F.lit("")).alias("reason"))
        tagged = part if tagged is None else tagged.unionByName(part)
    keys = [F.col(c) for c in ("kol_id", "stage", "reason")]
    kol, stage, reason = keys
    return tagged.groupingSets([keys, [stage, reason], [stage], [kol]], *keys).agg(F.grouping_id().cast("int").alias("level"), F.count("*").alias("n"))


class DegradedRun(RuntimeError):
    """More experts failed than the run allows. Results were promoted before it is raised."""


def raise_if_degraded(health: DataFrame) -> None:
    row = health.select("kols_failed", "total_kols", "failure_rate_pct", "degraded").first()
    if row.degraded:
        raise DegradedRun(f"{row.kols_failed} of {row.total_kols} experts failed ({row.failure_rate_pct:.1f}%)")
