"""Search results: attribution to queries, flattening, first-wins deduplication, normalised rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import activity
from ..functions.text import first_of, once, trimmed
from ..functions.url import host, platform_of, social_author

EXPERT = ["kol_id", "roster_seq"]


def attributed(items: DataFrame, chunks: DataFrame) -> DataFrame:
    """Items with the query (and its cluster) they belong to: the one they echo, else the first of their chunk.
    unattributed marks items that echo none of several queries."""
    echo = F.lower(trimmed(first_of("keyword", "query", "searchQuery")))
    chunk = chunks.select(*EXPERT, "chunk_no", F.col("queries").alias("_qs"))
    joined = items.withColumn("_echo", echo).join(chunk, [*EXPERT, "chunk_no"])
    same = F.filter("_qs", lambda q: F.lower(q["query"]) == F.col("_echo"))
    hit = F.get(same, F.lit(0))
    of = F.coalesce(hit, F.get("_qs", F.lit(0)))
    return joined.select(
        *EXPERT, "chunk_no", "item_pos", of["cluster_no"].alias("cluster_no"), of["query"].alias("search_query"),
        (hit.isNull() & (F.size("_qs") > 1)).alias("unattributed"),
        ((first_of("page_number") == "all") | (first_of("page") == "all")).alias("merged"), "results",
    )


def of_one_query(items: DataFrame, manifest: DataFrame) -> DataFrame:
    """Items of runs that asked one query each (cluster_no tells which), as attributed() gives them: what they echo doesn't count."""
    asked = manifest.select(*EXPERT, "cluster_no", F.col("query").alias("search_query"))
    merged = (first_of("page_number") == "all") | (first_of("page") == "all")
    return items.join(asked, [*EXPERT, "cluster_no"]).select(*EXPERT, "chunk_no", "item_pos", "cluster_no", "search_query", F.lit(False).alias("unattributed"), merged.alias("merged"), "results")


def united(batched: DataFrame, single: DataFrame) -> DataFrame:
    """Flattened results of runs of several queries (pass_no 0) and of one (1): first_by_url prefers the former."""
    return batched.withColumn("pass_no", F.lit(0)).unionByName(single.withColumn("pass_no", F.lit(1)), allowMissingColumns=True)


def flattened(items: DataFrame) -> DataFrame:
    """A row per result that has a URL. Where a query has a merged item with results, only its first counts."""
    of_query = Window.partitionBy(*EXPERT, "cluster_no")
    first = F.min(F.when(F.col("merged"), F.struct("item_pos", F.col("results").isNotNull().alias("usable")))).over(of_query)
    kept = items.withColumn("_first", first).filter(F.col("_first").isNull() | ~F.col("_first.usable") | (F.col("item_pos") == F.col("_first.item_pos")))
    each = kept.select(*EXPERT, "cluster_no", "search_query", "item_pos", F.posexplode("results").alias("result_pos", "r"))
    return each.withColumn("url", first_of("r.url", "r.link")).filter("url <> ''")


def first_by_url(results: DataFrame) -> DataFrame:
    """Per expert the first result of each URL (blanks at its ends don't count); of two in one place, the smaller URL. Where
    results of two kinds of runs are united, those of runs of several queries come first."""
    order = [c for c in ("pass_no", "cluster_no", "item_pos", "result_pos", "url") if c in results.columns]
    rest = [c for c in results.columns if c not in EXPERT]
    # min_by combines within each task before anything is shuffled.
    one = F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return results.filter(trimmed("url") != "").groupBy(*EXPERT, trimmed("url").alias("_key")).agg(one).select(*EXPERT, "_r.*")


def processed(results: DataFrame, roster: DataFrame) -> DataFrame:
    """The twelve text columns of a result, '' where nothing is known, and its place."""
    names = roster.select(*EXPERT, "kol_name")
    r = once(results.join(names, EXPERT), "source", host("url")).withColumn("platform", platform_of(F.col("source")))
    title, description = first_of("r.title"), first_of("r.description", "r.snippet")
    rows = r.select(
        *EXPERT, "kol_name", "search_query", title.alias("title"), description.alias("description"), "url",
        first_of("r.publishedDate", "r.date", "r.published_date", "r.publishDate", "r.publishedAt").alias("published_date"),
        first_of("r.author", social_author("url", title, F.col("platform"))).alias("author"),
        F.when(first_of("r.position") == "0", "").otherwise(first_of("r.position")).alias("position"),
        "source", "platform", "cluster_no", "item_pos", "result_pos",
    )
    return once(rows, "activity_type", activity("url", "title", "description", F.col("platform"), F.col("source")))


def failed_queries(queries: DataFrame, fetch_log: DataFrame) -> DataFrame:
    """Queries whose request failed, or of which the log knows nothing."""
    log = fetch_log.filter("cluster_no is not null").groupBy(*EXPERT, "cluster_no").agg(F.max(F.col("status") == "ok").alias("_ok"))
    return queries.join(log, [*EXPERT, "cluster_no"], "left").filter(~F.coalesce("_ok", F.lit(False))).drop("_ok")


