"""The monitoring run: roster and result dumps in, dated, enriched and deduplicated results out."""

from __future__ import annotations

import dataclasses
import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_decision, is_candidate
from ..functions.text import once
from ..operators import health as H
from ..operators import identity, names, pages, queries, serp, urlfilter
from ..sources import sinks
from ..sources.shared import settled

EXPERT = ["kol_id", "roster_seq"]


@dataclasses.dataclass(frozen=True)
class Run:
    """Parameters of a run; as_of is its day."""

    as_of: datetime.date
    run_tag: str = "run"
    days_back: int = 7
    results_per_query: int = 10
    queries_per_run: int = 6
    query_clusters: tuple[int, ...] | None = None
    crawl_social_platforms: bool = False
    include_social_results: bool = True
    identity_gate: str = "tag"
    promote_empty_run: bool = False
    max_failure_rate_pct: float = 10


@dataclasses.dataclass
class Stages:
    """The tables of a run, each a plan over the ones before."""

    roster: DataFrame
    manifest: DataFrame
    raw: DataFrame
    unique: DataFrame
    candidates: DataFrame
    dated: DataFrame
    recent: DataFrame
    judged: DataFrame
    final: DataFrame

    def settled(self) -> Stages:
        """The same with the tables between written once, for counts over all of them. Each is then a step of its own."""
        keep = {"raw", "unique", "candidates", "dated", "final"}
        return Stages(**{f.name: settled(getattr(self, f.name).drop("body_text"), f.name) if f.name in keep else getattr(self, f.name) for f in dataclasses.fields(self)})


def prepared(raw_roster: DataFrame, run: Run) -> tuple[DataFrame, DataFrame]:
    """Roster (with forms) and manifest, settled: a few rows with long expressions that every later plan reads."""
    roster = settled(names.name_forms(names.clean_roster(raw_roster)), "roster")
    return roster, settled(queries.manifest(roster, list(run.query_clusters) if run.query_clusters else None), "manifest")


def results(roster: DataFrame, manifest: DataFrame, items: DataFrame, page_table: DataFrame, run: Run, fetch_log: DataFrame | None = None) -> Stages:
    """Plans the run up to its final rows (with validity, and body_text for the gate). Failed experts have no results."""
    chunks = queries.batches(manifest, run.queries_per_run)
    if fetch_log is not None:
        items = items.join(H.failed_experts(fetch_log), EXPERT, "left_anti")
    raw = serp.flattened(serp.attributed(items, chunks))
    unique = serp.first_by_url(raw)
    rows = serp.processed(unique, roster)
    candidates = rows.filter(is_candidate("published_date", "activity_type", run.as_of, run.days_back))
    # Pages are cut down to the ones asked for before they are parsed; only metadata is joined back.
    wanted = page_table.join(pages.frontier(candidates, run.crawl_social_platforms), "url", "left_semi")
    enriched = pages.overlay(candidates, pages.page_metadata(wanted), run.crawl_social_platforms)
    dated = once(enriched, "_d", date_decision("published_date", "activity_type", run.as_of, run.days_back))
    dated = dated.withColumn("reason", F.concat_ws(" ", F.when(F.col("_d.keep"), "KEEP").otherwise("REMOVE"), F.col("_d.reason")))
    recent = dated.filter("_d.keep").drop("_d", "reason")
    final = urlfilter.first_by_normal_url(urlfilter.usable(recent), EXPERT)
    final = urlfilter.without_social(final, run.include_social_results)
    judged = identity.judged(final, roster, run.identity_gate)
    return Stages(roster, manifest, raw, unique, candidates, dated.drop("_d"), recent, judged, identity.passing(judged, run.identity_gate))


def monitor(spark: SparkSession, raw_roster: DataFrame, items: DataFrame, page_table: DataFrame, fetch_log: DataFrame, root: str, run: Run) -> DataFrame:
    """Runs everything: staged output, promotion, result copy, summary. Raises DegradedRun last, if at all.

    Counts and summary are taken from the staged rows, so nothing is worked out twice.
    """
    s = results(*prepared(raw_roster, run), items, page_table, run, fetch_log)
    copy = f"{root.rstrip('/')}/_results_{run.run_tag[:12]}"
    s.judged.drop("body_text", "norm_url").write.mode("overwrite").parquet(copy)
    judged = spark.read.parquet(copy)
    final = identity.passing(judged, run.identity_gate)
    dropped = judged.filter("validity <> 'VALID'") if run.identity_gate == "drop" else None
    sinks.stage(final, root, run.run_tag)
    failed = H.failed_experts(fetch_log)
    summary = H.summary(s.roster, final, failed, serp.failed_queries(s.manifest, fetch_log).join(failed, EXPERT, "left_anti"), dropped, run.max_failure_rate_pct)
    sinks.promote(spark, root, run.run_tag, run.promote_empty_run)
    sinks.append_results(final, f"{root.rstrip('/')}/dataset")
    path = f"{root.rstrip('/')}/run_summary"
    sinks.write_summary(summary, path)
    done = spark.read.json(path)
    H.raise_if_degraded(done)
    return done
