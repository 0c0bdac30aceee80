"""The stateless stages over a stream of results, and first-wins deduplication within a look-back.

The batch run stays the reference; this is for dumps that arrive in pieces.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame

from ..functions.dates import date_decision
from ..operators import urlfilter


def recent_unique(results: DataFrame, as_of: datetime.date, days_back: int, look_back: str = "9 days", by: tuple[str, ...] = ("kol_id", "roster_seq")) -> DataFrame:
    """Results (arrived timestamp, url, published_date, activity_type and the expert) that are recent and usable, each
    expert and normalised URL once. State is kept for look_back behind the latest arrival, which bounds it."""
    recent = results.withWatermark("arrived", look_back).withColumn("_d", date_decision("published_date", "activity_type", as_of, days_back)).filter("_d.keep").drop("_d")
    return urlfilter.usable(recent).dropDuplicatesWithinWatermark([*by, "norm_url"])
