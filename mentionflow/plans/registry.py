"""The registered queries of the monitoring operators: each applies operators to inputs derived from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import url as U
from ..functions.classify import activity
from ..functions.text import trimmed
from ..operators import corpus, health, identity, index, names, pages, queries, serp, urlfilter, windows
from ..sources import dumps as dump_files
from ..sources import sinks, tables
from ..sources.shared import settled, shared_folder
from ..streaming import first as stream_rules
from . import fixtures as X
from . import monitor as M
from . import oracles as O

AS_OF, DAYS_BACK = X.AS_OF, 9
RUN = M.Run(as_of=AS_OF, days_back=DAYS_BACK, queries_per_run=4, identity_gate="off")


# -- inputs ----------------------------------------------------------------------------------------


def results_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.run(spark, sf_dir, X.with_tables(X.RESULTS, select="SELECT page_id, page_url, url, title, description FROM results"))


def dates_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.run(spark, sf_dir, X.with_tables(X.DATES, select="SELECT event_id, date_text, activity_type FROM dated"))


def raw_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.run(spark, sf_dir, X.with_tables(X.ROSTER, select="SELECT kol_id, kol_name, suffix, affiliation, specialty FROM roster"))


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settled(names.name_forms(names.clean_roster(raw_roster(spark, sf_dir))), "roster")


def roster_of(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """roster() of the experts that rows (kol_id) are about: only their names are worked out. It is small where they are few, and
    then joined without moving any text."""
    asked = rows.select(F.col("kol_id").alias("_asked")).distinct()
    raw = raw_roster(spark, sf_dir)
    return settled(names.name_forms(names.clean_roster(raw.join(asked, trimmed("kol_id") == F.col("_asked"), "left_semi"))), "roster")


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.run(spark, sf_dir, X.with_tables(X.MENTIONS, select="SELECT doc_id, kol_id, text FROM mentions"))


def injected_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.run(spark, sf_dir, X.with_tables(O.INJECTED, select="SELECT page_id, url, html FROM injected"))


def serp_items(spark: SparkSession, sf_dir: str, asked: DataFrame | None = None) -> DataFrame:
    """Items as a search dump has them: one per page and cluster that echoes its query (or lost it), and for every fourth
    expert a merged item per cluster."""
    hits = X.run(spark, sf_dir, X.with_tables(X.RESULTS, X.SERP, select="SELECT page_id, k, cluster_no, url, title, description FROM hits"))
    dated = F.element_at(F.array(*[F.lit(v) for v in ("2024-01-28", "3 days ago", "", "Jan 5, 2024", "2024-06-01", "press release")]), (F.col("page_id") % 6 + 1).cast("int"))
    hits = hits.withColumns({"kol_id": F.concat(F.lit("K"), F.col("k").cast("string")), "roster_seq": F.lit(1), "date": dated, "chunk_no": F.when(F.col("cluster_no") <= 4, 1).otherwise(2)})
    asked = queries.manifest(roster(spark, sf_dir)) if asked is None else asked
    hits = hits.join(asked.withColumnRenamed("query", "_q"), ["kol_id", "roster_seq", "cluster_no"])
    odd = F.col("page_id") % 2 == 1
    # Aliases of the dump's fields, in turns.
    result = F.struct(
        F.when(odd, F.col("url")).alias("url"), F.when(~odd, F.col("url")).alias("link"), "title", F.when(odd, F.col("description")).alias("description"), F.col("description").alias("snippet"),
        F.lit(None).cast("string").alias("publishedDate"), F.col("date"), *[F.lit(None).cast("string").alias(c) for c in ("published_date", "publishDate", "publishedAt", "author")], F.lit("1").alias("position"),
    )
    nothing = F.lit(None).cast("string")
    echo = F.when(F.col("page_id") % 11 != 0, F.upper("_q"))
    single = hits.select("kol_id", "roster_seq", "chunk_no", F.col("page_id").alias("item_pos"), F.when(odd, echo).alias("keyword"), F.when(~odd, echo).alias("query"), nothing.alias("searchQuery"), F.lit("1").alias("page_number"), nothing.alias("page"), F.array(result).alias("results"))
    listed = F.sort_array(F.collect_list(F.when(~odd, F.struct("page_id", F.col("url").alias("u"), result.alias("r")))))
    merged = hits.filter("k % 4 = 0").groupBy("kol_id", "roster_seq", "chunk_no", "_q").agg(listed.alias("l"))
    merged = merged.select("kol_id", "roster_seq", "chunk_no", F.lit(1_000_000_000).cast("long").alias("item_pos"), nothing.alias("keyword"), nothing.alias("query"), F.col("_q").alias("searchQuery"), nothing.alias("page_number"), F.lit("all").alias("page"), F.col("l.r").alias("results"))
    return single.unionByName(merged)


def fetch_log(spark: SparkSession, sf_dir: str, asked: DataFrame | None = None) -> DataFrame:
    """Every 97th query failed, every 89th has no row; every 41st expert failed."""
    asked = queries.manifest(roster(spark, sf_dir)) if asked is None else asked
    k = F.substring("kol_id", 2, 20).cast("long")
    rows = asked.filter((k * 5 + F.col("cluster_no")) % 89 != 0)
    rows = rows.withColumn("status", F.when((k * 7 + F.col("cluster_no")) % 97 == 0, "failed").otherwise("ok"))
    experts = names.clean_roster(raw_roster(spark, sf_dir)).filter((k % 41 == 0) & (F.col("roster_seq") == 1)).select("kol_id", "roster_seq")
    lost = experts.select("kol_id", "roster_seq", F.lit(None).cast("int").alias("cluster_no"), F.lit(None).cast("string").alias("query"), F.lit("failed").alias("status"))
    return rows.unionByName(lost).withColumn("error", F.lit(""))


def stages(spark: SparkSession, sf_dir: str, log: DataFrame | None = None, page_table: DataFrame | None = None) -> M.Stages:
    page_table = spark.read.parquet(f"{sf_dir}/pages.parquet").select("url", "html") if page_table is None else page_table
    known = M.prepared(raw_roster(spark, sf_dir), RUN)
    return M.results(*known, serp_items(spark, sf_dir, known[1]), page_table, RUN, log)


# -- queries ---------------------------------------------------------------------------------------


def url_normalize(spark, sf_dir):
    return results_table(spark, sf_dir).select("page_id", "url", U.normalized("url").alias("norm_url"))


def url_hosts(spark, sf_dir):
    """Hosts in all the forms that a browser reads: numbers, brackets, percent signs, letters beyond ASCII."""
    rows = X.run(spark, sf_dir, X.with_tables(X.HOSTS, select="SELECT page_id, n, host_text, url FROM hosts")).withColumn("_u", U.parsed("url"))
    return rows.select("page_id", "n", "host_text", F.coalesce("_u.host", F.lit("")).alias("host"), U.rebuilt(F.col("_u")).alias("norm_url"))


def url_dedupe_filter(spark, sf_dir):
    rows = results_table(spark, sf_dir).select((F.col("page_id") % 97).alias("expert"), "page_id", "url")
    return urlfilter.first_by_normal_url(urlfilter.usable(rows), ["expert"], ["page_id"]).select("expert", "norm_url", "page_id")


def host_list_filter(spark, sf_dir):
    """Results off a block-list that is a table: the fixed hosts and every third of the pages' own."""
    rows = results_table(spark, sf_dir).withColumn("host", U.host("url")).filter("host <> ''")
    own = X.run(spark, sf_dir, X.with_tables(X.RESULTS, X.LISTED, select="SELECT domain FROM listed"))
    return urlfilter.without_listed(rows, own).select("page_id", "host")


def platform_source(spark, sf_dir):
    return results_table(spark, sf_dir).select("page_id", U.source("url").alias("source"), U.platform("url").alias("platform"))


def activity_class(spark, sf_dir):
    rows = results_table(spark, sf_dir).withColumn("platform", U.platform("url"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("page_id"), "text")
    rows = rows.join(docs, "page_id", "left").withColumn("description", F.concat_ws(" ", "description", F.coalesce("text", F.lit(""))))
    return rows.select("page_id", "platform", activity("url", "title", "description", F.col("platform")).alias("activity_type"))


def social_author(spark, sf_dir):
    rows = results_table(spark, sf_dir).withColumn("platform", U.platform("url"))
    return rows.select("page_id", "platform", U.social_author("url", "title", F.col("platform")).alias("author"))


def relative_days(spark, sf_dir):
    return dates_table(spark, sf_dir).select("event_id", "date_text", D.relative_days("date_text").alias("days"))


def absolute_date(spark, sf_dir):
    return dates_table(spark, sf_dir).select("event_id", "date_text", D.absolute_date("date_text").alias("day"))


def candidate_filter(spark, sf_dir):
    return dates_table(spark, sf_dir).filter(D.is_candidate("date_text", "activity_type", AS_OF, DAYS_BACK)).select("event_id", "activity_type")


def recent_filter(spark, sf_dir):
    return dates_table(spark, sf_dir).select("event_id", "activity_type", F.inline(F.array(D.date_decision("date_text", "activity_type", AS_OF, DAYS_BACK))))


def backfill_windows(spark, sf_dir):
    """What fifty runs keep of all results, in one join: by run and kind of activity, how many and the sum of their ids."""
    runs = X.run(spark, sf_dir, X.with_tables(X.RUNS, select="SELECT run_id, as_of, days_back FROM runs"))
    kept = windows.kept_by_runs(dates_table(spark, sf_dir), runs)
    return kept.groupBy("run_id", "activity_type").agg(F.count("*").alias("n"), F.sum("event_id").cast("long").alias("ids"))


def roster_clean(spark, sf_dir):
    return names.clean_roster(raw_roster(spark, sf_dir))


def name_forms(spark, sf_dir):
    f = F.col("forms")
    return roster(spark, sf_dir).select("kol_id", "roster_seq", "clean_name", f["full"].alias("full_form"), f["short"].alias("short_form"), f["initial"].alias("initial_form"), F.array_join(f["extras"], "|").alias("extras"))


def query_manifest(spark, sf_dir):
    return queries.manifest(roster(spark, sf_dir))


def query_chunks(spark, sf_dir):
    asked = queries.requests(queries.batches(queries.manifest(roster(spark, sf_dir)), 4), DAYS_BACK)
    return asked.select("kol_id", "roster_seq", "chunk_no", "tbs", "limit", F.array_join(F.col("queries.query"), " | ").alias("queries"))


def serp_attribution(spark, sf_dir):
    asked = settled(queries.manifest(roster(spark, sf_dir)), "manifest")
    return serp.attributed(serp_items(spark, sf_dir, asked), queries.batches(asked, 4)).select("kol_id", "item_pos", "cluster_no", "unattributed")


def serp_flatten_dedupe(spark, sf_dir):
    return stages(spark, sf_dir).unique.select("kol_id", "cluster_no", "item_pos", "result_pos", "url")


def stream_first_results(spark, sf_dir):
    """The items of serp_flatten_dedupe as a stream, in micro-batches by hash, ended by an item of nobody a month later."""
    asked = settled(queries.manifest(roster(spark, sf_dir)), "manifest")
    attributed = serp.attributed(serp_items(spark, sf_dir, asked), queries.batches(asked, 4)).withColumn("batch", F.pmod(F.xxhash64("item_pos", "cluster_no"), F.lit(3)))
    began, root = F.lit("2024-01-31 00:00:00").cast("timestamp"), shared_folder(spark, "stream")
    stamped = attributed.withColumn("arrived", began + F.make_dt_interval(hours=F.col("batch").cast("int")))
    for batch in range(3):
        stamped.filter(F.col("batch") == batch).drop("batch").write.mode("append").parquet(f"{root}/in/batch={batch}")
    last = spark.range(1).select(*[F.lit("nobody" if c == "kol_id" else None).cast(t).alias(c) for c, t in stamped.drop("batch", "arrived").dtypes], (began + F.make_dt_interval(days=F.lit(31))).alias("arrived"))
    last.withColumns({"roster_seq": F.lit(0), "cluster_no": F.lit(0), "item_pos": F.lit(0).cast("long"), "merged": F.lit(False)}).write.parquet(f"{root}/in/batch=3")
    before = spark.conf.get(stream_rules.STORE[0], None)
    spark.conf.set(*stream_rules.STORE)
    try:
        items = spark.readStream.schema(stamped.drop("batch").schema).option("maxFilesPerTrigger", 16).parquet(f"{root}/in/*")
        out = stream_rules.first_results(items, "2 days")
        out.writeStream.format("parquet").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    finally:
        spark.conf.set(stream_rules.STORE[0], before) if before else spark.conf.unset(stream_rules.STORE[0])
    return spark.read.schema(out.schema).parquet(f"{root}/out").filter("kol_id <> 'nobody'").select("kol_id", "cluster_no", F.col("item_pos").cast("long").alias("item_pos"), "result_pos", "url")


def serp_variant_dumps(spark, sf_dir):
    """First results of two dumps, of runs of several queries and of one, read from JSON lines as VARIANT: fields of several names
    and kinds, results that are no array, lines cut short, and a field that no reader names."""
    asked, root = settled(queries.manifest(roster(spark, sf_dir)), "manifest"), shared_folder(spark, "dumps")
    lines = X.run(spark, sf_dir, X.with_tables(X.RESULTS, X.SERP, X.LINES, select="SELECT alone, line FROM dumped"), manifest=asked)
    for name, alone in (("several", False), ("one", True)):
        lines.filter(F.col("alone") == alone).select(F.col("line").alias("value")).write.text(f"{root}/{name}.json")
    several = serp.flattened(serp.attributed(dump_files.read_items(spark, f"{root}/several.json"), queries.batches(asked, 4)))
    one = serp.flattened(serp.of_one_query(dump_files.read_items(spark, f"{root}/one.json"), asked))
    unique = serp.first_by_url(serp.united(several, one))
    group = F.try_variant_get("r.raw", "$.rank.group", "int")
    return unique.select("kol_id", "pass_no", "cluster_no", "item_pos", "result_pos", "url", F.coalesce("r.position", F.lit("")).alias("position"), group.alias("rank_group"))


def failed_queries(spark, sf_dir):
    asked = settled(queries.manifest(roster(spark, sf_dir)), "manifest")
    return serp.failed_queries(asked, fetch_log(spark, sf_dir, asked)).select("kol_id", "roster_seq", "cluster_no", "query")


def crawl_frontier(spark, sf_dir):
    return pages.frontier(stages(spark, sf_dir).candidates)


def page_metadata(spark, sf_dir):
    return pages.page_metadata(injected_pages(spark, sf_dir), ("page_id",)).drop("body_text")


def page_overlay(spark, sf_dir):
    rows = results_table(spark, sf_dir).withColumn("platform", U.platform("url"))
    rows = rows.withColumns({"author": U.social_author("url", "title", F.col("platform")), "published_date": F.lit("")})
    return pages.overlay(rows, pages.page_metadata(injected_pages(spark, sf_dir))).select("page_id", "title", "description", "author", "published_date")


def page_overlay_asof(spark, sf_dir):
    """Results overlaid with the newest snapshot of their page that isn't after them."""
    get = lambda name, columns: X.run(spark, sf_dir, X.with_tables(X.SNAPSHOTS, select=f"SELECT {columns} FROM {name}"))
    empty = F.lit("")
    snaps = get("snapshots", "url, second, title, description").select("url", F.timestamp_seconds("second").alias("fetched_at"), "title", "description", empty.alias("author"), empty.alias("published_date"), empty.alias("body_text"))
    rows = get("asked", "page_id, n, url, second, title, description").withColumn("at", F.timestamp_seconds("second"))
    return pages.overlay_as_of(rows, snaps).select("page_id", F.col("n").cast("int").alias("n"), "title", "description")


def identity_verdict(spark, sf_dir):
    rows = mentions(spark, sf_dir).select("doc_id", "kol_id", F.lit(1).alias("roster_seq"), F.lit("").alias("title"), F.col("text").alias("description"), F.lit("").alias("body_text"))
    known = roster(spark, sf_dir)
    return identity.verdicts(rows.join(known.select("kol_id", "roster_seq"), ["kol_id", "roster_seq"], "left_semi"), known).select("doc_id", "kol_id", "validity", "validity_signals")


def identity_counts(spark, sf_dir):
    return identity_verdict(spark, sf_dir).groupBy("validity", "validity_signals").agg(F.count("*").alias("n"))


def monitor_output(spark, sf_dir):
    return stages(spark, sf_dir).final.select("kol_id", "url", "norm_url", "title", "description", "author", "published_date", "source", "platform", "activity_type", "cluster_no")


def monitor_enriched(spark, sf_dir):
    """The run over pages that have metadata: titles, descriptions, authors and dates of pages win, and their dates are filtered."""
    s = stages(spark, sf_dir, page_table=injected_pages(spark, sf_dir).select("url", "html"))
    return s.final.select("kol_id", "url", "norm_url", "title", "description", "author", "published_date", "source", "platform", "activity_type", "cluster_no")


def stage_counts(spark, sf_dir):
    s = stages(spark, sf_dir).settled()
    return health.stage_counts({"raw": s.raw, "unique": s.unique, "candidates": s.candidates, "dated": s.dated, "final": s.final})


def stage_rollup(spark, sf_dir):
    """Counts of stages with their subtotals."""
    s = stages(spark, sf_dir).settled()
    return health.stage_rollup({"raw": s.raw, "unique": s.unique, "candidates": s.candidates, "dated": s.dated, "final": s.final})


def run_health(spark, sf_dir):
    log = settled(fetch_log(spark, sf_dir), "fetch-log")
    s, failed = stages(spark, sf_dir, log), health.failed_experts(log)
    lost = serp.failed_queries(s.manifest, log).join(failed, ["kol_id", "roster_seq"], "left_anti")
    final = settled(s.final.drop("body_text"), "final")
    return health.summary(s.roster, final, failed, lost).select("total_kols", "kols_failed", "queries_failed", "kols_zero_results", "total_results", "degraded")


def promote_output(spark, sf_dir):
    """Staged, promoted and read again."""
    root = shared_folder(spark)
    rows = urlfilter.usable(results_table(spark, sf_dir)).withColumn("platform", U.platform("url"))
    rows = rows.withColumns({"source": U.source("url"), "author": U.social_author("url", "title", F.col("platform"))})
    sinks.stage(rows, root, "registered-query")
    sinks.promote(spark, root, "registered-query")
    return sinks.current(spark, root)


def corpus_search(spark, sf_dir):
    return corpus.corpus_search(mentions(spark, sf_dir), roster(spark, sf_dir)).withColumn("n_terms", F.col("n_terms").cast("long"))


def corpus_index_search(spark, sf_dir):
    """Documents are added to an index in two batches, as in two weeks; the search then reads no text."""
    root, docs = shared_folder(spark, "index"), mentions(spark, sf_dir)
    for week in (0, 1):
        index.add_documents(docs.filter(F.col("doc_id") % 2 == week), root, f"week-{week}")
    return index.search(spark, root, roster(spark, sf_dir)).withColumn("n_terms", F.col("n_terms").cast("long"))


def term_reach(spark, sf_dir):
    return corpus.term_reach(mentions(spark, sf_dir))


def form_reach(spark, sf_dir):
    return corpus.form_reach(mentions(spark, sf_dir), roster(spark, sf_dir))


def manifest_subset(spark, sf_dir):
    """Four of the six queries, as a lean weekly run asks."""
    return queries.manifest(roster(spark, sf_dir), [1, 3, 4, 6])


def name_budget(spark, sf_dir):
    """Queries of names so long that forms must go."""
    known = names.name_forms(X.run(spark, sf_dir, X.with_tables(X.LONG_NAMES, select="SELECT kol_id, roster_seq, kol_name, affiliation FROM long_names")))
    return queries.manifest(known, [1]).select("kol_id", "query")


def website_only(spark, sf_dir):
    rows = urlfilter.usable(results_table(spark, sf_dir)).withColumn("platform", U.platform("url"))
    return urlfilter.without_social(rows, False).select("page_id", "norm_url", "platform")


def dumps(spark, sf_dir, root):
    """Roster (CSV, its columns in another order), items (JSON lines) and fetch log (CSV); some records of each are broken."""
    known = raw_roster(spark, sf_dir)
    known.select("specialty", "kol_name", "kol_id", "affiliation", "suffix").write.option("header", True).option("escape", '"').csv(f"{root}/roster.csv")
    asked = settled(queries.manifest(roster(spark, sf_dir)), "manifest")
    items = serp_items(spark, sf_dir, asked)
    items.write.json(f"{root}/items.json")
    # Lines that were cut short, and a log whose numbers are words.
    cut = items.filter("page_number = '1' and item_pos % 50 = 3").select(F.concat(F.lit('{"kol_id": "'), "kol_id", F.lit('", "item_pos": '), F.col("item_pos").cast("string"), F.lit(', "results": [{')).alias("value"))
    cut.write.mode("append").text(f"{root}/items.json")
    log = fetch_log(spark, sf_dir, asked).select("status", "kol_id", "query", "cluster_no", "roster_seq", "error")
    odd = F.when(F.col("cluster_no") == 6, F.concat(F.lit("no. "), F.col("cluster_no").cast("string"))).otherwise(F.col("cluster_no").cast("string"))
    log.withColumn("cluster_no", odd).write.option("header", True).option("escape", '"').csv(f"{root}/log.csv")


def read_dumps(spark, sf_dir):
    """Attribution of items that were read from JSON lines, to queries of a roster that was read from CSV; lines that can't be
    read are left out."""
    root = shared_folder(spark, "dumps")
    dumps(spark, sf_dir, root)
    asked = settled(queries.manifest(names.name_forms(names.clean_roster(tables.read_roster(spark, f"{root}/roster.csv")))), "manifest")
    items = tables.read_serp_items(spark, f"{root}/items.json")
    return serp.attributed(items, queries.batches(asked, 4)).select("kol_id", "item_pos", "cluster_no", "unattributed")


def quarantine_counts(spark, sf_dir):
    """How many records of each dump could not be read; they are kept beside it."""
    root = shared_folder(spark, "dumps")
    dumps(spark, sf_dir, root)
    return tables.keep_quarantined(spark, {"items": (f"{root}/items.json", tables.SERP_ITEMS), "log": (f"{root}/log.csv", tables.FETCH_LOG)}, f"{root}/quarantine")


def page_body(spark, sf_dir):
    """Title and body text of the pages as they are."""
    meta = pages.page_metadata(tables.read_pages(spark, f"{sf_dir}/pages.parquet"))
    return meta.select("url", "title", "body_text")


def body_mentions(spark, sf_dir, known):
    """Results whose only evidence is the body text of their page."""
    empty = F.lit("")
    rows = mentions(spark, sf_dir).select("doc_id", "kol_id", F.lit(1).alias("roster_seq"), empty.alias("title"), empty.alias("description"), F.col("text").alias("body_text"))
    return rows.join(known.select("kol_id", "roster_seq"), ["kol_id", "roster_seq"], "left_semi")


def gate_modes(spark, sf_dir):
    """Each mode of the gate; texts are judged once, for the two modes that need it."""
    known = roster_of(spark, sf_dir, mentions(spark, sf_dir))
    rows, columns = body_mentions(spark, sf_dir, known), ["validity", "validity_signals"]
    judged = settled(identity.judged(rows, known).select("doc_id", "kol_id", *columns), "judged")
    of = {"off": identity.judged(rows, known, "off"), "tag": judged, "drop": judged}
    parts = [identity.passing(of[mode], mode).select("doc_id", "kol_id", F.lit(mode).alias("mode"), *columns) for mode in of]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def gated_health(spark, sf_dir):
    """The summary of a run that tags and of one that drops, written and read again."""
    known, asked = M.prepared(raw_roster(spark, sf_dir), RUN)
    log = settled(fetch_log(spark, sf_dir, asked), "fetch-log")
    failed = health.failed_experts(log)
    rows = body_mentions(spark, sf_dir, known).join(failed, ["kol_id", "roster_seq"], "left_anti")
    judged = settled(identity.judged(rows, known).drop("body_text"), "judged")
    lost = serp.failed_queries(asked, log).join(failed, ["kol_id", "roster_seq"], "left_anti")
    found = None
    for mode in ("tag", "drop"):
        path = shared_folder(spark, f"summary-{mode}")
        dropped = judged.filter("validity <> 'VALID'") if mode == "drop" else None
        sinks.write_summary(health.summary(known, identity.passing(judged, mode), failed, lost, dropped), path)
        lists = [F.array_join(c, " | ").alias(c) for c in ("failed_kol_names", "failed_query_samples")]
        counts = ["total_kols", "kols_failed", "queries_failed", "kols_zero_results", "review_rows", "total_results", "dropped_by_gate", "failure_rate_pct", "degraded"]
        part = spark.read.json(path).select(F.lit(mode).alias("mode"), *counts, *lists)
        found = part if found is None else found.unionByName(part)
    return found


def guarded_output(spark, sf_dir):
    """What is in the output and its second copy after a run with rows, and one without that must not be promoted."""
    root = shared_folder(spark)
    rows = urlfilter.usable(results_table(spark, sf_dir)).select("url", "title")
    for tag, run in (("full", rows), ("empty", rows.limit(0))):
        staged = sinks.stage(run, root, tag)
        sinks.append_results(staged, f"{root}/dataset")
        sinks.promote(spark, root, tag)
    out, copy = sinks.current(spark, root), spark.read.json(f"{root}/dataset")
    pick = lambda df, place: df.select(F.lit(place).alias("place"), F.col("URL").alias("url"), F.col("Title").alias("title"))
    return pick(out, "output").unionByName(pick(copy, "dataset"))


def corpus_search_single(spark, sf_dir):
    """Corpus search for experts with one name only."""
    known = names.name_forms(X.run(spark, sf_dir, X.with_tables(X.SINGLE_NAMES, select="SELECT kol_id, roster_seq, kol_name, affiliation FROM single_names")))
    return corpus.corpus_search(mentions(spark, sf_dir), known).withColumn("n_terms", F.col("n_terms").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        url_normalize, url_hosts, url_dedupe_filter, host_list_filter, platform_source, activity_class, social_author, relative_days, absolute_date, candidate_filter, recent_filter, backfill_windows, roster_clean, name_forms, query_manifest,
        query_chunks, serp_attribution, serp_flatten_dedupe, stream_first_results, serp_variant_dumps, failed_queries, crawl_frontier, page_metadata, page_overlay, page_overlay_asof, identity_verdict, identity_counts, monitor_output, monitor_enriched, stage_counts, stage_rollup, run_health,
        promote_output, corpus_search, corpus_index_search, term_reach, form_reach, manifest_subset, name_budget, website_only, read_dumps, quarantine_counts, page_body, gate_modes, gated_health, guarded_output, corpus_search_single,
    )
}

SQL: dict[str, str] = {
    name: X.plain(sql)
    for name, sql in {
        "url_normalize": O.URL_NORMALIZE, "url_hosts": O.URL_HOSTS, "host_list_filter": O.HOST_LIST, "url_dedupe_filter": O.URL_DEDUPE, "platform_source": O.PLATFORM_SOURCE, "activity_class": O.ACTIVITY, "social_author": O.SOCIAL_AUTHOR,
        "relative_days": O.RELATIVE_DAYS, "absolute_date": O.ABSOLUTE_DATE, "candidate_filter": O.CANDIDATES, "recent_filter": O.RECENT, "backfill_windows": O.BACKFILL, "roster_clean": O.ROSTER_CLEAN, "name_forms": O.NAME_FORMS,
        "query_manifest": O.QUERY_MANIFEST, "query_chunks": O.QUERY_CHUNKS, "serp_attribution": O.SERP_ATTRIBUTION, "serp_flatten_dedupe": O.SERP_DEDUPE, "stream_first_results": O.SERP_DEDUPE, "serp_variant_dumps": O.VARIANT_DUMPS, "failed_queries": O.FAILED_QUERIES,
        "crawl_frontier": O.FRONTIER, "page_metadata": O.PAGE_METADATA, "page_overlay": O.PAGE_OVERLAY, "page_overlay_asof": O.PAGE_ASOF, "identity_verdict": O.IDENTITY_VERDICT, "identity_counts": O.IDENTITY_COUNTS,
        "monitor_output": O.MONITOR_OUTPUT, "monitor_enriched": O.MONITOR_ENRICHED, "stage_counts": O.STAGE_COUNTS, "stage_rollup": O.STAGE_ROLLUP, "run_health": O.RUN_HEALTH, "promote_output": O.PROMOTE_OUTPUT, "corpus_search": O.CORPUS_SEARCH, "corpus_index_search": O.CORPUS_SEARCH, "term_reach": O.TERM_REACH,
        "form_reach": O.FORM_REACH, "manifest_subset": O.MANIFEST_SUBSET, "name_budget": O.NAME_BUDGET, "website_only": O.WEBSITE_ONLY, "read_dumps": O.SERP_ATTRIBUTION, "quarantine_counts": O.QUARANTINE, "page_body": O.PAGE_BODY,
        "gate_modes": O.GATE_MODES, "gated_health": O.GATED_HEALTH, "guarded_output": O.GUARDED_OUTPUT, "corpus_search_single": O.CORPUS_SEARCH_SINGLE,
    }.items()
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as usable results, in output columns."""
    rows = urlfilter.usable(results_table(spark, sf_dir)).withColumn("platform", U.platform("url"))
    rows = rows.withColumns({"source": U.source("url"), "activity_type": activity("url", "title", "description", F.col("platform"))})
    return sinks.output_columns(urlfilter.first_by_normal_url(rows, ["page_url"], ["page_id"]))
