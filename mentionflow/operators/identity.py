"""Identity gate: is a result about the expert, by medical evidence next to the name.

Names are only put in lower case while the text loses punctuation and non-ASCII letters; a name with either is
therefore never visible, as the rules have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import WS, once, quoted, strings

EXPERT = ["kol_id", "roster_seq"]


def haystack(*parts: Column) -> Column:
    text = F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))
    plain = F.regexp_replace(text, r"[^A-Za-z0-9_\-]+", " ")
    return F.concat(F.lit(" "), F.trim(plain), F.lit(" "))


def affiliation_tokens(affiliation: Column) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(affiliation, F.lit(""))), F.lit(r"([a-z']{4,})"), 1)
    return F.array_except(F.transform(found, lambda t: F.replace(t, F.lit("'"), F.lit(""))), strings(fixed.AFFILIATION_STOPWORDS))


def specialty_stems(specialty: Column) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(specialty, F.lit(""))), F.lit(r"([a-z]{6,})"), 1)
    return F.array_distinct(F.transform(found, lambda t: F.substring(t, 1, 7)))


def suffix_tokens(suffix: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(suffix, F.lit(""))), rf"(?:[,;/]|{WS})+")
    return F.filter(F.transform(parts, lambda t: F.replace(t, F.lit("."), F.lit(""))), lambda t: F.length(t).between(2, 8))


def evidence(roster: DataFrame) -> DataFrame:
    """What the gate looks for, worked out once for each roster row. roster has forms (null if no name is left)."""
    f = F.col("forms")
    every = F.filter(F.array_distinct(F.concat(F.array(f["full"], f["short"], f["initial"]), f["extras"])), lambda n: n != "")
    lower = F.transform(every, F.lower)

    def titled(form: Column) -> Column:
        first = quoted(F.substring_index(form, " ", 1))
        last = quoted(F.substring(form, F.instr(form, F.lit(" ")) + 1, F.length(form)))
        maybe = F.concat(F.lit("(?:"), first, F.lit(" )?"), last)
        return F.concat(
            F.lit(f" {fixed.ROLES} "), maybe, F.lit(" | "), maybe, F.lit(f" {fixed.DEGREES} | "), first, F.lit(r" [A-Za-z0-9_] "), last, F.lit(f" {fixed.DEGREES} ")
        )

    return roster.select(
        *EXPERT,
        f.isNotNull().alias("_has_name"),
        F.concat(F.lit(" "), F.lower(f["short"]), F.lit(" ")).alias("_short"),
        F.transform(F.filter(every, lambda n: n != f["short"]), lambda n: F.concat(F.lit(" "), F.lower(n), F.lit(" "))).alias("_strong"),
        F.transform(F.filter(lower, lambda n: F.contains(n, F.lit(" "))), titled).alias("_titled"),
        F.transform(lower, lambda n: F.concat(F.lit(" "), quoted(n), F.lit(r" ((?:[a-z-]{2,8} ){1,3})"))).alias("_adjacent"),
        affiliation_tokens(F.col("affiliation")).alias("_affiliation"),
        specialty_stems(F.col("specialty")).alias("_specialty"),
        suffix_tokens(F.col("suffix")).alias("_suffix"),
    )


#: Columns that exist only within verdicts().
_OWN = ("_has_name", "_short", "_strong", "_titled", "_adjacent", "_affiliation", "_specialty", "_suffix", "_hay", "_seen", "_after", "_said")


def verdicts(results: DataFrame, roster: DataFrame) -> DataFrame:
    """results (title, description, body_text) with validity and validity_signals. Patterns run only where a name is
    visible at all. The text is put into plain words once for each result, and each step looks at what the one before found."""
    words = once(results, "_hay", haystack(F.col("title"), F.col("description"), F.col("body_text")))
    joined = words.join(evidence(roster), EXPERT, "left").select(*results.columns, *_OWN[:9])
    hay = F.col("_hay")
    has = lambda needle: F.contains(hay, needle)
    strong = F.coalesce(F.exists("_strong", has), F.lit(False))
    joined = once(joined, "_seen", F.struct(strong.alias("strong"), (strong | F.coalesce(has(F.col("_short")), F.lit(False))).alias("any")))
    visible = F.col("_seen.any")
    affiliation = F.exists("_affiliation", lambda t: has(F.concat(F.lit(" "), t, F.lit(" "))) | has(F.concat(F.lit(" "), t, F.lit("s "))))
    specialty = F.exists("_specialty", has)
    titled = F.exists("_titled", lambda p: F.regexp_like(hay, p))
    after = F.flatten(F.transform("_adjacent", lambda p: F.regexp_extract_all(hay, p, 1)))
    tokens = F.flatten(F.transform(after, lambda a: F.split(F.trim(a), " ")))
    joined = once(joined, "_after", F.when(visible & (F.size("_suffix") > 0), tokens).otherwise(F.array().cast("array<string>")))
    primary = strings(fixed.CLINICAL_PRIMARY)
    other = F.filter("_after", lambda t: F.array_contains(primary, t) & ~F.array_contains(F.col("_suffix"), t))
    conflict = F.when(F.arrays_overlap("_suffix", primary), F.get(other, F.size(other) - 1))
    match = F.exists("_after", lambda t: F.array_contains(F.col("_suffix"), t))
    signal = lambda test, name: F.when(visible & test, name)
    signals = F.array_compact(F.array(signal(match, "suffix-match"), signal(affiliation, "affiliation"), signal(specialty, "specialty"), signal(titled, "titled-name")))
    joined = once(joined, "_said", F.struct(conflict.alias("conflict"), signals.alias("signals")))
    review = (
        F.when(~F.coalesce("_has_name", F.lit(False)), "unparseable-name")
        .when(~visible, "name-not-visible")
        .when(F.col("_said.conflict").isNotNull(), F.concat(F.lit("suffix-conflict:"), F.col("_said.conflict")))
        .when(F.size("_said.signals") == 0, F.when(F.col("_seen.strong"), "no-medical-context").otherwise("short-name-only"))
    )
    said = F.array_join(F.concat(F.when(F.col("_seen.strong"), F.array(F.lit("full-name"))).otherwise(F.array().cast("array<string>")), F.col("_said.signals")), "+")
    return joined.withColumns({"validity": F.when(review.isNull(), "VALID").otherwise("REVIEW"), "validity_signals": F.coalesce(review, said)}).drop(*_OWN)


def judged(results: DataFrame, roster: DataFrame, mode: str = "tag") -> DataFrame:
    """Both columns, before any row is dropped: empty in mode off, filled in any other."""
    return results.withColumns({"validity": F.lit(""), "validity_signals": F.lit("")}) if mode == "off" else verdicts(results, roster)


def gated(results: DataFrame, roster: DataFrame, mode: str = "tag") -> DataFrame:
    """mode off: empty columns; drop: only VALID rows; tag (and any other): both columns filled."""
    return passing(judged(results, roster, mode), mode)


def passing(judged_results: DataFrame, mode: str) -> DataFrame:
    return judged_results.filter("validity = 'VALID'") if mode == "drop" else judged_results
