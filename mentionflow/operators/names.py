"""Roster names: parentheticals, clean names and searchable forms, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import WS, squeezed, trimmed, words

_PAREN = r"\([^)]*\)"


def _plain(text: Column) -> Column:
    return squeezed(F.regexp_replace(F.regexp_replace(text, _PAREN, " "), r'[()"]', " "))


def with_nicknames(raw: Column) -> Column:
    """Quoted nicknames written as parentheticals."""
    return F.regexp_replace(F.coalesce(raw, F.lit("")), '"([^"]*)"', r"($1)")


def base_name(raw: Column) -> Column:
    return _plain(with_nicknames(raw))


def parentheticals(text: Column) -> Column:
    """array<struct<token, kind>>: what each parenthetical is, by where it stands; those without a use are left out.
    text: with_nicknames()."""
    found, around = F.regexp_extract_all(text, F.lit(r"\(([^)]*)\)"), 1), F.split(text, _PAREN)

    def one(raw_token: Column, k: Column) -> Column:
        token = squeezed(F.regexp_replace(raw_token, r'[()"]', " "))
        side = lambda parts: F.size(words(F.regexp_replace(F.array_join(parts, " "), r'[()"]', " ")))
        before, after = side(F.slice(around, F.lit(1), k + 1)), side(F.slice(around, k + 2, F.size(around)))
        many = F.contains(token, F.lit(" "))
        kind = (
            F.when((after == 0) & many, "altFullName")
            .when(after == 0, "altSurname")
            .when(before == 1, "nickname")
            .when((after == 1) & ~many, "altSurname")
        )
        return F.struct(token.alias("token"), F.when(F.length(token) >= 2, kind).alias("kind"))

    return F.filter(F.transform(found, one), lambda p: p["kind"].isNotNull())


def is_credential(token: Column, after_comma: bool) -> Column:
    norm = F.lower(F.replace(token, F.lit("."), F.lit("")))
    upper_only = norm.isin(*fixed.CREDENTIALS_UPPER)
    if not after_comma:
        letters = F.regexp_replace(token, "[^A-Za-z]", "")
        upper_only = upper_only & (letters != "") & (letters == F.upper(letters))
    return norm.isin(*fixed.CREDENTIALS_ANY) | upper_only


def with_clean_name(df: DataFrame, name: str) -> DataFrame:
    """Adds clean_name: without parentheticals, leading Dr., credentials after a comma and trailing credentials.

    A column for each step, so that no expression holds another one several times.
    """
    df = df.withColumn("_base", F.regexp_replace(base_name(F.col(name)), rf"(?i)^dr\.?{WS}+", ""))
    df = df.withColumn("_parts", F.filter(F.transform(F.split("_base", ","), trimmed), lambda p: p != ""))
    tail = F.split(F.array_join(F.slice("_parts", F.lit(2), F.greatest(F.size("_parts"), F.lit(1))), " "), f"{WS}+")
    df = df.withColumn("_tail", tail)
    name_part = F.when((F.size("_parts") > 1) & F.forall("_tail", lambda t: is_credential(t, True)), F.get("_parts", F.lit(0))).otherwise(F.col("_base"))
    df = df.withColumn("_tokens", F.split(name_part, f"{WS}+"))

    def drop(state: Column, token: Column) -> Column:
        gone = state["more"] & (state["n"] > 2) & is_credential(token, False)
        return F.struct((state["n"] - gone.cast("int")).alias("n"), gone.alias("more"))

    keep = F.aggregate(F.reverse("_tokens"), F.struct(F.size("_tokens").alias("n"), F.lit(True).alias("more")), drop, lambda s: s["n"])
    df = df.withColumn("clean_name", trimmed(F.array_join(F.slice("_tokens", F.lit(1), keep), " ")))
    return df.drop("_base", "_parts", "_tail", "_tokens")


def name_forms(roster: DataFrame, name: str = "kol_name") -> DataFrame:
    """Adds clean_name and forms (full, short, initial, extras); forms is null where no name is left."""
    df = with_clean_name(roster, name).withColumn("_p", F.split("clean_name", f"{WS}+"))
    df = df.withColumn("_nicked", with_nicknames(F.col(name))).withColumn("_parens", parentheticals(F.col("_nicked")))
    n = F.size("_p")
    particle = F.lower(F.replace(F.get("_p", n - 2), F.lit("."), F.lit(""))).isin(*fixed.SURNAME_PARTICLES)
    df = df.withColumn("_at", F.when((n >= 3) & particle, n - 2).otherwise(n - 1))
    first, last = F.get("_p", F.lit(0)), F.array_join(F.slice("_p", F.col("_at") + 1, n), " ")
    initials = F.transform(F.slice("_p", F.lit(2), F.greatest(F.col("_at") - 1, F.lit(0))), lambda m: F.substring(m, 1, 1))
    full, short = F.array_join("_p", " "), trimmed(F.concat(first, F.lit(" "), last))
    initial = F.when(F.size(initials) > 0, F.concat_ws(" ", first, F.array_join(initials, " "), last)).otherwise(short)
    df = df.withColumns({"_first": first, "_last": last, "_full": full, "_short": short, "_initial": initial})
    variant = F.transform(
        "_parens",
        lambda p: F.when(p["kind"] == "nickname", F.concat_ws(" ", p["token"], F.col("_last"))).when(p["kind"] == "altSurname", F.concat_ws(" ", F.col("_first"), p["token"])).otherwise(p["token"]),
    )
    extras = F.slice(F.array_except(variant, F.array("_full", "_short", "_initial")), 1, fixed.MAX_EXTRAS)
    extras = F.when(n >= 2, extras).otherwise(F.slice(variant, 1, 0))
    forms = F.struct(F.col("_full").alias("full"), F.col("_short").alias("short"), F.col("_initial").alias("initial"), extras.alias("extras"))
    return df.withColumn("forms", F.when(F.col("clean_name") != "", forms)).drop("_p", "_nicked", "_parens", "_at", "_first", "_last", "_full", "_short", "_initial")


def looks_like_suffix(value: Column) -> Column:
    """Whether an affiliation is a list of credentials in the wrong column."""
    tokens = F.filter(F.split(trimmed(F.coalesce(value, F.lit(""))), rf"(?:{WS}|[,;./])+"), lambda t: t != "")
    return (F.size(tokens) > 0) & F.forall(tokens, lambda t: t.rlike(r"^[A-Z]{2,6}\z"))


def clean_roster(raw: DataFrame) -> DataFrame:
    """kol_id, roster_seq, kol_name, suffix, affiliation, specialty, affiliation_was_suffix.

    Rows without id or name go; credentials in the affiliation column move to an empty suffix. Rows of one id are
    numbered in the order of their values.
    """
    fields = ["kol_id", "kol_name", "suffix", "affiliation", "specialty"]
    kept = raw.filter((F.coalesce("kol_id", F.lit("")) != "") & (F.coalesce("kol_name", F.lit("")) != ""))
    kept = kept.select(*[trimmed(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in fields])
    wrong = looks_like_suffix(F.col("affiliation"))
    kept = kept.withColumn("affiliation_was_suffix", wrong)
    moved = F.col("affiliation_was_suffix")
    kept = kept.withColumn("suffix", F.when(moved & (F.col("suffix") == ""), F.col("affiliation")).otherwise(F.col("suffix")))
    kept = kept.withColumn("affiliation", F.when(moved, "").otherwise(F.col("affiliation")))
    order = Window.partitionBy("kol_id").orderBy("kol_name", "suffix", "affiliation", "specialty")
    return kept.withColumn("roster_seq", F.row_number().over(order)).select("kol_id", "roster_seq", "kol_name", "suffix", "affiliation", "specialty", "affiliation_was_suffix")


