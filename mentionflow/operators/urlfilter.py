"""URL filters: normalised URLs, junk and directory pages, first-wins deduplication, social rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import url as U
from ..functions.text import once

ORDER = ["cluster_no", "item_pos", "result_pos", "url"]


def usable(results: DataFrame) -> DataFrame:
    """Adds norm_url and keeps rows with a valid URL that is neither junk nor on the block-list. All rows of one normalised
    URL share the outcome, so this comes before the deduplication and leaves it less to shuffle."""
    parts = once(results, "_parts", U.parsed("url")).filter("_parts is not null")
    return once(parts.filter(~U.blocked(F.col("_parts"))), "norm_url", U.rebuilt(F.col("_parts"))).drop("_parts").filter(~U.junk(F.col("norm_url")))


def without_listed(results: DataFrame, listed: DataFrame, host: str = "host") -> DataFrame:
    """results whose host is neither on the list (a column domain) nor below a domain on it; for lists of any length.

    Each distinct host becomes its suffixes at dots, which are joined with the list on equal values; results meet only the
    hosts that were found. Null and empty hosts stay.
    """
    hosts = results.select(F.col(host).alias("_host")).filter("_host <> ''").distinct()
    labels = F.split(U.bare(F.col("_host")), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = hosts.select("_host", F.explode(suffixes).alias("domain")).join(listed.select("domain"), "domain", "left_semi").select("_host").distinct()
    return results.join(found, F.col(host) == F.col("_host"), "left_anti")


def first_by_normal_url(results: DataFrame, by: list[str], order: list[str] | None = None) -> DataFrame:
    """Of the rows of one expert (by) and normalised URL, the first in order."""
    rest = [c for c in results.columns if c not in [*by, "norm_url"]]
    one = F.min_by(F.struct(*rest), F.struct(*(order or ORDER))).alias("_r")
    return results.groupBy(*by, "norm_url").agg(one).select(*by, "norm_url", "_r.*")


def without_social(results: DataFrame, include_social: bool = True) -> DataFrame:
    return results if include_social else results.filter("platform = 'Website'")
