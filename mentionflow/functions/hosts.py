"""Hosts of URLs as a browser's parser writes them, as column expressions; '' for a host that is none.

Percent-encoded characters are decoded, letters put in lower case, labels beyond ASCII written in Punycode; a host that ends
in a number is an IPv4 address in any of its forms (1 to 4 parts, decimal, octal or hexadecimal); one in brackets is an
IPv6 address and written in its shortest form. Not reproduced: composing of letters and marks (Unicode normal forms),
apart from letters and digits of full width.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

#: Hosts that are as they should be: ASCII labels in lower case, the last of which begins with a letter.
PLAIN = r"^(?:[a-z0-9_-]+\.)*[a-z][a-z0-9_-]*\z"
FORBIDDEN = r'[\x00-\x20#%/:<>?@\[\\\]^|\x7F]'
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F))) + "。｡"
_NARROW = "".join(map(chr, range(0x21, 0x7F))) + ".."
_SOFT = "[\u00ad\u200b\u2060\ufeff]"


def div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b)).cast("int")


def _fold(n: int, start: Column, step) -> Column:
    """step applied n times."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(n)), start, lambda acc, _: step(acc))


def _digits(delta: Column, bias: Column) -> Column:
    """A whole number in Punycode's base: digits of which each tells whether another follows."""
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    letter = lambda d: F.substring(F.lit(letters), d + 1, F.lit(1))

    def step(s: Column) -> Column:
        t = F.greatest(F.lit(1), F.least(F.lit(26), s["k"] - bias))
        rest = s["q"] - t
        more = ~s["done"] & (s["q"] >= t)
        return F.struct(
            F.when(more, div(rest, F.lit(36) - t)).otherwise(s["q"]).alias("q"), (s["k"] + 36).alias("k"),
            F.when(s["done"], s["out"]).when(more, F.concat(s["out"], letter(t + rest % (F.lit(36) - t)))).otherwise(F.concat(s["out"], letter(s["q"]))).alias("out"), (s["done"] | ~more).alias("done"),
        )

    return _fold(7, F.struct(delta.alias("q"), F.lit(36).alias("k"), F.lit("").alias("out"), F.lit(False).alias("done")), step)["out"]


def _adapted(delta: Column, points: Column, first: Column) -> Column:
    """The next bias."""
    start = let(F.when(first, div(delta, 700)).otherwise(div(delta, 2)), lambda d: d + div(d, points))
    step = lambda s: F.when(s["d"] > 455, F.struct(div(s["d"], 35).alias("d"), (s["k"] + 36).alias("k"))).otherwise(s)
    return let(_fold(4, F.struct(start.alias("d"), F.lit(0).alias("k")), step), lambda s: s["k"] + div(s["d"] * 36, s["d"] + 38))


def punycode(label: Column) -> Column:
    """The label's ASCII letters, a hyphen, and where which other letters stand."""

    def encoded(codes: Column) -> Column:
        indexed = F.transform(codes, lambda c, i: F.struct(c.alias("c"), i.cast("int").alias("p")))
        basic = F.array_join(F.transform(F.filter(codes, lambda c: c < 128), lambda c: F.chr(c)), "")
        n_basic = F.size(F.filter(codes, lambda c: c < 128))
        start = F.struct(F.lit(127).alias("c"), F.lit(-1).alias("p"), n_basic.alias("h"), F.lit(72).alias("bias"), F.lit("").alias("out"))

        def step(s: Column, x: Column) -> Column:
            below = lambda after, before, code: F.size(F.filter(indexed, lambda y: (y["p"] > after) & (y["p"] < before) & (y["c"] < code)))
            same = below(s["p"], x["p"], x["c"])
            # The rest of the last round, then the rounds of code points that the label hasn't, then this one up to x.
            left = F.when(s["p"] >= 0, below(s["p"], F.lit(1 << 30), s["c"]) + 1).otherwise(0)
            anew = left + (x["c"] - F.when(s["p"] >= 0, s["c"] + 1).otherwise(128)) * (s["h"] + 1) + below(F.lit(-1), x["p"], x["c"])
            delta = F.when(x["c"] == s["c"], same).otherwise(anew).cast("int")
            return let(delta, lambda d: F.struct(x["c"].alias("c"), x["p"].alias("p"), (s["h"] + 1).alias("h"), _adapted(d, s["h"] + 1, s["p"] < 0).alias("bias"), F.concat(s["out"], _digits(d, s["bias"])).alias("out")))

        others = F.array_sort(F.filter(indexed, lambda y: y["c"] >= 128))
        done = F.aggregate(others, start, step, lambda s: s["out"])
        return F.concat(basic, F.when(basic == "", "").otherwise("-"), done)

    return let(F.transform(F.regexp_extract_all(label, F.lit("(?s)."), F.lit(0)), lambda c: F.ascii(c)), encoded)


def _ascii(host: Column) -> Column:
    one = lambda label: F.when(label.rlike(r"[^\x00-\x7F]"), F.concat(F.lit("xn--"), punycode(label))).otherwise(label)
    return F.when(host.rlike(r"[^\x00-\x7F]"), F.array_join(F.transform(F.split(host, r"\."), one), ".")).otherwise(host)


def _number(part: Column) -> Column:
    """The value of a part of an IPv4 address, null for none (or one far too large)."""
    digits = F.regexp_replace(part, r"^(?:0x|0)0*(?=.)", "")
    based = lambda base: F.conv(digits, base, 10).cast("bigint")
    return (
        F.when(part.rlike(r"^0x\z"), F.lit(0).cast("bigint"))
        .when(part.rlike(r"^0x0*[0-9a-f]{1,9}\z"), based(16))
        .when(part.rlike(r"^0[0-7]*\z") & (F.length(digits) <= 12), based(8))
        .when(part.rlike(r"^[1-9][0-9]{0,10}\z"), part.cast("bigint"))
    )


def _dotted(value: Column) -> Column:
    return F.concat_ws(".", *[F.call_function("div", value, F.lit(1 << s)).cast("bigint").bitwiseAND(F.lit(255).cast("bigint")).cast("string") for s in (24, 16, 8, 0)])


def ipv4(host: Column) -> Column:
    def of_parts(parts: Column) -> Column:
        def of_values(v: Column) -> Column:
            n = F.size(v)
            head, last = F.slice(v, F.lit(1), n - 1), F.element_at(v, -1)
            room = F.element_at(F.array(*[F.lit(1 << s).cast("bigint") for s in (32, 24, 16, 8)]), n)
            value = F.aggregate(head, F.lit(0).cast("bigint"), lambda a, x: a * 256 + x) * room + last
            good = (n <= 4) & F.forall(v, lambda x: x.isNotNull()) & F.forall(head, lambda x: x < 256) & (last < room)
            return F.when(n > 4, "").when(good, _dotted(value)).otherwise("")

        return F.when(F.size(parts) > 4, "").otherwise(let(F.transform(parts, _number), of_values))

    return let(F.split(F.regexp_replace(host, r"\.\z", ""), r"\."), of_parts)


def ipv6(text: Column) -> Column:
    """[ ] around the shortest form of an address in brackets."""
    inner = F.regexp_extract(text, r"^\[([0-9a-f:]+(?::\d{1,3}(?:\.\d{1,3}){3})?)\]\z", 1)
    quad = F.regexp_extract(text, r"(\d{1,3}(?:\.\d{1,3}){3})\]\z", 1)
    bytes_ = F.transform(F.split(quad, r"\."), lambda b: F.when(b.rlike(r"^(?:0|[1-9]\d*)\z"), b.cast("int")))
    fits = (F.size(bytes_) == 4) & F.forall(bytes_, lambda b: b.isNotNull() & (b < 256))
    pair = lambda k: F.lower(F.hex(F.get(bytes_, F.lit(k)) * 256 + F.get(bytes_, F.lit(k + 1))))
    plain = F.when(quad == "", inner).when(fits, F.concat(F.regexp_replace(inner, r"\d{1,3}(?:\.\d{1,3}){3}\z", ""), pair(0), F.lit(":"), pair(2))).otherwise("")

    def whole(p: Column) -> Column:
        halves = F.split(p, "::")
        pieces = lambda k: F.filter(F.split(F.coalesce(F.get(halves, F.lit(k)), F.lit("")), ":"), lambda x: x != "")
        a, b = pieces(0), pieces(1)
        n, gap = F.size(a) + F.size(b), F.size(halves) == 2
        every = F.concat(a, F.when(gap, F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - n, F.lit(0)))).otherwise(F.slice(a, 1, 0)), b)
        good = (p != "") & (F.size(halves) <= 2) & F.when(gap, n < 8).otherwise(n == 8) & F.forall(every, lambda x: F.length(x) <= 4)
        # A colon at either end is half of two; three or more never stand together.
        good = good & ~p.rlike(r"^:(?!:)|(?<!:):\z|:::")
        short = F.array_join(F.transform(every, lambda x: F.regexp_replace(x, "^0+(?=.)", "")), ":")
        return F.when(good, let(short, lambda s: F.concat(F.lit("["), _without_zeros(s), F.lit("]")))).otherwise("")

    return let(plain, whole)


def _without_zeros(address: Column) -> Column:
    """The first of the longest runs of two zeros or more as two colons."""
    chain = F
    for n in range(8, 1, -1):
        pattern = rf"(?:^|(?<=:))0(?::0){{{n - 1}}}(?=:|\z)"
        two = F.concat(F.regexp_replace(F.regexp_extract(address, rf"^(.*?){pattern}", 1), r":\z", ""), F.lit("::"), F.regexp_extract(address, rf"^.*?{pattern}:?(.*)\z", 1))
        chain = chain.when(address.rlike(pattern), two)
    return chain.otherwise(address)


def canonical(raw: Column) -> Column:
    """The host of a URL of a special scheme (http and the like) as a browser writes it."""

    def mapped(host: Column) -> Column:
        ends_in_number = host.rlike(r"(?:^|\.)(?:[0-9]+|0x[0-9a-f]*)\.?\z")
        return F.when(host.isNull() | (host == "") | host.rlike(FORBIDDEN), "").when(ends_in_number, ipv4(host)).otherwise(host)

    def other(host: Column) -> Column:
        decoded = F.when(F.contains(host, F.lit("%")), F.try_url_decode(F.regexp_replace(F.replace(host, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25"))).otherwise(host)
        narrow = F.lower(F.regexp_replace(F.translate(F.lower(decoded), _WIDE, _NARROW), _SOFT, ""))
        return let(let(narrow, _ascii), mapped)

    return F.when(raw.rlike(PLAIN), raw).when(raw == "", "").when(raw.startswith("["), ipv6(F.lower(raw))).otherwise(other(raw))
