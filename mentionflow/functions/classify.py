"""Kind of activity of a result."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import col, has, let
from .url import host, host_in


def activity(url: Column | str, title: Column | str, description: Column | str, platform: Column, host_: Column | None = None) -> Column:
    """SMA, Trials, Pubs, Conference, Press or Other, in this order of precedence. host_: the URL's, where it is known."""
    none = F.lit("")
    u, t = F.coalesce(col(url), none), F.coalesce(col(title), none)
    given = F.struct(u.alias("url"), t.alias("title"), F.concat_ws(" ", t, F.coalesce(col(description), none)).alias("text"), (host(u) if host_ is None else host_).alias("host"))

    def of_page(g: Column) -> Column:
        h, u, text = g["host"], g["url"], g["text"]
        coded = has(g["title"], fixed.CONFERENCE_TITLE)
        return (
            F.when(host_in(h, fixed.TRIAL_HOSTS) | has(text, fixed.TRIAL_TEXT) | has(u, fixed.TRIAL_TEXT), "Trials")
            .when(host_in(h, fixed.PUBLISHER_HOSTS) | has(u, fixed.PUBLISHER_URL), F.when(has(u, fixed.SUPPLEMENT_URL) | coded, "Conference").otherwise("Pubs"))
            .when(has(text, fixed.CONFERENCE_TEXT) | has(u, fixed.CONFERENCE_URL) | coded, "Conference")
            .when(has(text, fixed.PRESS_TEXT) | has(u, fixed.PRESS_URL), "Press")
            .otherwise("Other")
        )

    return F.when(platform.isNotNull() & ~platform.isin("", "Website"), "SMA").otherwise(let(given, of_page))
