"""Text expressions: blanks, missing values, ASCII word boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Every character that counts as white space, as a class for Java patterns (\s there is ASCII only).
WS = r"[\t-\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"
_BOUNDARY = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """use(value), with value worked out once however often use refers to it, also where a filter is pushed below the
    projection that made it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column of a long expression: it stands in the plan once, whatever filters and projections come later
    (they are not pushed below the array of one that it is taken from)."""
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(F.array(value)).alias(name))


def trimmed(c: Column | str) -> Column:
    return F.regexp_replace(col(c), rf"^{WS}+|{WS}+\z", "")


def squeezed(c: Column | str) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(col(c), f"{WS}+", " "))


def first_of(*cols: Column | str) -> Column:
    """The first value that is neither null nor empty, else ''."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols], F.lit(""))


def has(c: Column | str, pattern: str) -> Column:
    """Whether a pattern of fixed.py is found, whatever the case; \\b sees ASCII words only, as the patterns expect."""
    return F.coalesce(col(c), F.lit("")).rlike("(?i)" + pattern.replace(r"\b", _BOUNDARY))


def quoted(c: Column) -> Column:
    """The text as a pattern that matches just it."""
    return F.regexp_replace(c, r"([.*+?^${}()|\[\]\\])", r"\\$1")


def words(c: Column) -> Column:
    return F.filter(F.split(squeezed(c), " "), lambda w: w != "")


def strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])
