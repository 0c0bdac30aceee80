"""Dates in results: relative phrases, absolute dates, windows. Days are UTC days; the run's day is a parameter."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import WS, col, let, trimmed

_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_MONTH = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"


def relative_days(text: Column | str) -> Column:
    """Days back that a phrase such as '2 weeks ago' means; null for anything else."""
    some = F.lit(None).cast("long")

    def days(t: Column) -> Column:
        def count(unit: str) -> Column:
            return F.nullif(F.regexp_extract(t, rf"^(\d{{1,15}}){WS}+{unit}s?{WS}+ago\z", 1), F.lit("")).cast("long")

        return (
            F.when(t.isin("today", "just now"), 0)
            .when(t == "yesterday", 1)
            .when(t.rlike(rf"^\d+{WS}+(?:minute|minutes|hour|hours){WS}+ago\z"), 0)
            .when(t == "a week ago", 7)
            .when(t == "a month ago", 30)
            .when(t == "a year ago", 365)
            .when(t.endswith("ago"), F.coalesce(count("day"), count("week") * 7, count("month") * 30, count("year") * 365))
            .otherwise(some)
        )

    return let(F.lower(trimmed(F.coalesce(col(text), F.lit("")))), days)


def absolute_date(text: Column | str) -> Column:
    """The day of an absolute date; null for anything else, calendar-invalid days too.

    Accepted: yyyy, yyyy-MM, yyyyMMdd, yyyy-M-d and yyyy/M/d, ISO date-times with optional fraction and zone, month name
    first with a comma, day first with a month name, month/day/year and month-day-year, and RFC 1123 date-times.
    """
    return let(trimmed(F.coalesce(col(text), F.lit(""))), _day)


def _month(m: Column) -> Column:
    at = F.array_position(F.array(*[F.lit(x) for x in _MONTHS]), F.lower(F.substring(m, 1, 3)))
    return F.when(at > 0, at.cast("string")).otherwise(m)


def _zoned(day_time: Column, zone: Column) -> Column:
    z = F.replace(zone, F.lit(":"), F.lit(""))
    minutes = F.when(z.rlike(r"^[+-]\d{4}\z"), F.substring(z, 2, 2).cast("int") * 60 + F.substring(z, 4, 2).cast("int")).otherwise(0)
    sign = F.when(z.startswith("-"), -60).otherwise(60)
    at = F.try_to_timestamp(day_time, F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.timestamp_seconds(F.unix_timestamp(at) - sign * minutes)


#: Shapes of dates and the groups of year, month and day; a text has one shape at most.
_SHAPES = (
    (r"^(\d{4})([-/])(\d{1,2})[-/](\d{1,2})\z", (1, 3, 4)),
    (r"^(\d{4})(\d\d)(\d\d)\z", (1, 2, 3)),
    (r"^(\d{4})-(\d{1,2})\z", (1, 2, None)),
    (r"^(\d{4})\z", (1, None, None)),
    (rf"(?i)^({_MONTH}) (\d{{1,2}}), (\d{{4}})\z", (3, 1, 2)),
    (rf"(?i)^(\d{{1,2}}) ({_MONTH}) (\d{{4}})\z", (3, 2, 1)),
    (r"^(\d{1,2})([-/])(\d{1,2})\2(\d{4})\z", (4, 1, 3)),
)
_RFC = rf"(?i)^[a-z]{{3}}, (\d{{1,2}}) ({_MONTH}) (\d{{4}}) (\d\d:\d\d:\d\d) (GMT|UTC|[+-]\d{{4}})\z"
_ISO = r"^(\d{4}-\d\d-\d\d)[Tt ](\d\d:\d\d)(:\d\d)?(?:[.,]\d+)?([Zz]|[+-]\d\d:?\d\d)?\z"


def _day(t: Column) -> Column:
    def ymd(pattern: str, groups) -> Column:
        y, m, d = (F.lit("1") if g is None else F.regexp_extract(t, pattern, g) for g in groups)
        return F.try_to_timestamp(F.concat_ws("-", y, F.lpad(_month(m), 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd"))

    i, r = (lambda k, p=p: F.regexp_extract(t, p, k) for p in (_ISO, _RFC))
    iso = _zoned(F.concat(i(1), F.lit(" "), i(2), F.when(i(3) == "", ":00").otherwise(i(3))), i(4))
    rfc = _zoned(F.concat(r(3), F.lit("-"), F.lpad(_month(r(2)), 2, "0"), F.lit("-"), F.lpad(r(1), 2, "0"), F.lit(" "), r(4)), r(5))
    chain = F
    for pattern, groups in _SHAPES:
        chain = chain.when(t.rlike(pattern), ymd(pattern, groups))
    return chain.when(t.rlike(_ISO), iso).when(t.rlike(_RFC), rfc).cast("date")


def policy(activity: Column | str) -> Column:
    return F.when(col(activity) == "Conference", "event").when(col(activity).isin("Pubs", "Trials"), "lenient-undated").otherwise("strict")


def in_window(day: Column, as_of: datetime.date, days_back: int, policy_: Column) -> Column:
    """From days_back days before the run's day to that day, or to a year after it for events."""
    last = F.when(policy_ == "event", F.date_add(F.lit(as_of), fixed.EVENT_HORIZON_DAYS)).otherwise(F.lit(as_of))
    return (day >= F.date_sub(F.lit(as_of), days_back)) & (day <= last)


def _read(text: Column, activity: Column | str) -> Column:
    return F.struct(text.alias("text"), relative_days(text).alias("relative"), absolute_date(text).alias("day"), policy(activity).alias("policy"))


def is_candidate(date_text: Column | str, activity: Column | str, as_of: datetime.date, days_back: int) -> Column:
    """False only for results that are definitely out of the window."""

    def candidate(r: Column) -> Column:
        dated = F.when(r["day"].isNull(), True).otherwise(in_window(r["day"], as_of, days_back, r["policy"]))
        return F.when(r["text"] == "", True).when(r["relative"].isNotNull(), r["relative"] <= days_back).otherwise(dated)

    return let(_read(F.coalesce(col(date_text), F.lit("")), activity), candidate)


def date_decision(date_text: Column | str, activity: Column | str, as_of: datetime.date, days_back: int) -> Column:
    """(keep, reason) of the final filter: dated results must be in the window; undated ones stay unless the policy is strict."""

    def decision(r: Column) -> Column:
        as_pair = lambda keep, reason: F.struct(keep.alias("keep"), F.lit(reason).alias("reason"))
        loose = r["policy"] != "strict"
        return (
            F.when(r["text"] == "", as_pair(loose, "undated"))
            .when(r["relative"].isNotNull(), as_pair(r["relative"] <= days_back, "relative"))
            .when(r["day"].isNull(), as_pair(loose, "unparseable"))
            .otherwise(as_pair(in_window(r["day"], as_of, days_back, r["policy"]), "dated"))
        )

    return let(_read(trimmed(F.coalesce(col(date_text), F.lit(""))), activity), decision)
