"""The query manifest: search strings for each roster row, request batches and recency buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import squeezed, trimmed


def anchor(affiliation: Column) -> Column:
    """The first six words of the affiliation, without quotes and brackets."""
    plain = squeezed(F.regexp_replace(F.coalesce(affiliation, F.lit("")), r'["()]', ""))
    return F.array_join(F.slice(F.split(plain, " "), 1, fixed.MAX_ANCHOR_WORDS), " ")


def _tokens(names: Column) -> Column:
    each = F.aggregate(names, F.lit(0), lambda n, name: n + F.size(F.split(name, " ")))
    return each + F.greatest(F.size(names) - 1, F.lit(0))


def names_in_budget(names: Column, forms: Column) -> Column:
    """Names dropped until the expression has at most 15 tokens or two names are left: the form with initials first,
    then from the end. Five names at most, so three steps do."""
    initial = forms["initial"]
    own = (initial != forms["full"]) & (initial != forms["short"])

    def step(acc: Column, _: Column) -> Column:
        over = (_tokens(acc) > fixed.MAX_NAME_TOKENS) & (F.size(acc) > 2)
        fewer = F.when(own & F.array_contains(acc, initial), F.array_remove(acc, initial)).otherwise(F.slice(acc, F.lit(1), F.size(acc) - 1))
        return F.when(over, fewer).otherwise(acc)

    return F.aggregate(F.array(F.lit(1), F.lit(2), F.lit(3)), names, step)


def expression(names: Column) -> Column:
    quotes = F.transform(names, lambda n: F.concat(F.lit('"'), n, F.lit('"')))
    return F.when(F.size(names) == 1, F.get(quotes, F.lit(0))).otherwise(F.concat(F.lit("("), F.array_join(quotes, " OR "), F.lit(")")))


def manifest(roster: DataFrame, clusters: list[int] | None = None) -> DataFrame:
    """kol_id, roster_seq, cluster_no, query: six rows (or the chosen clusters) for each roster row that has forms."""
    f = F.col("forms")
    df = roster.filter(f.isNotNull()).withColumn("_anchor", anchor(F.col("affiliation")))
    short, long = F.array(f["full"], f["short"]), F.concat(F.array(f["full"], f["short"], f["initial"]), f["extras"])
    names = F.array_distinct(F.filter(F.when(F.col("_anchor") != "", short).otherwise(long), lambda n: n != ""))
    df = df.withColumn("_names", names).withColumn("_names", names_in_budget(F.col("_names"), f))
    tail = F.when(F.col("_anchor") != "", F.concat(F.lit(' "'), F.col("_anchor"), F.lit('"'))).otherwise("")
    query = [F.concat(expression(F.col("_names")), F.lit(f" {fixed.HONORIFIC}" + (f" {c}" if c else "")), tail) for c in fixed.CLUSTERS]
    out = df.select("kol_id", "roster_seq", F.posexplode(F.array(*query)).alias("_k", "query")).withColumn("cluster_no", F.col("_k") + 1).drop("_k")
    if clusters:
        out = out.filter(F.col("cluster_no").isin([int(c) for c in clusters]))
    return out.select("kol_id", "roster_seq", "cluster_no", "query")


def batches(queries: DataFrame, size: int = 6) -> DataFrame:
    """kol_id, roster_seq, chunk_no, queries: a row per request, queries in order of their cluster. Sizes are 1 to 30."""
    size = max(1, min(30, int(size or 1)))
    kept = queries.withColumn("query", trimmed("query")).filter("query <> ''")
    each = F.sort_array(F.collect_list(F.struct("cluster_no", "query")))  # six at most
    whole = kept.groupBy("kol_id", "roster_seq").agg(each.alias("q"))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("q") - 1) / size).cast("int")), lambda k: F.slice("q", k * size + 1, F.lit(size)))
    return whole.select("kol_id", "roster_seq", F.posexplode(parts).alias("_k", "queries")).select("kol_id", "roster_seq", (F.col("_k") + 1).alias("chunk_no"), "queries")


def recency_bucket(days_back: int) -> str:
    return "qdr:d" if days_back <= 1 else "qdr:w" if days_back <= 7 else "qdr:m" if days_back <= 30 else "qdr:y"


def requests(chunks: DataFrame, days_back: int = 7, results_per_query: int = 10) -> DataFrame:
    """Adds what goes with each request: the recency bucket and the limit, as text."""
    return chunks.withColumns({"tbs": F.lit(recency_bucket(days_back)), "limit": F.lit(str(results_per_query or 10))})
