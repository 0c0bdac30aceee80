"""PII: format-preserving Feistel pseudonyms.

Validated values (e-mail addresses, card and account numbers, IBANs, phone numbers, social security numbers,
IPv4 addresses, dates) are replaced by a keyed permutation of all values of the same format: letters stay
letters, digits digits, check digits and calendar days valid. The permutation depends on the key, the kind
and the format only, so equal values stay equal across documents, and whoever has the key can undo it.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import or_empty, table

ROUNDS = 8
#: Letters and digits of a value that are permuted as one number; longer values are permuted by halves of their characters.
AS_NUMBER = 256
#: The key of the registered query; callers give their own.
DEMO_KEY = b"pseudonyms of the registered query"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


# -- permutations ----------------------------------------------------------------------------------


def permuted(x: int, size: int, key: bytes, tweak: bytes, undo: bool = False) -> int:
    """A keyed permutation of 0 .. size-1: a Feistel network over pairs, walked until it is back in range."""
    if size < 2:
        return x
    a = 1
    while a * a < size:  # two halves of a * b >= size, near each other
        a *= 2
    b = -(-size // a)
    length = (max(a, b).bit_length() + 7) // 8 + 8

    def f(k: int, value: int) -> int:
        data = tweak + b"|%d|%d|%d" % (size, k, value)
        return int.from_bytes(hashlib.shake_256(key + b"|" + data).digest(length), "big")

    while True:
        left, right = divmod(x, b)
        order = range(ROUNDS) if not undo else range(ROUNDS - 1, -1, -1)
        for k in order:
            sign = -1 if undo else 1
            if k % 2 == 0:
                left = (left + sign * f(k, right)) % a
            else:
                right = (right + sign * f(k, left)) % b
        x = left * b + right
        if x < size:
            return x


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASS = {ch: alphabet for alphabet in (LOWER, UPPER, DIGITS) for ch in alphabet}


def permuted_long(value: str, key: bytes, kind: str, undo: bool) -> str:
    """permuted_text for values of any length, in time linear in it: a Feistel network whose halves are the first and the
    last characters, each moved within its alphabet by bytes that are hashed from the other half."""
    code = np.frombuffer(value.encode("utf-32-le"), "<u4").copy()
    base, many = np.zeros(len(code), "<u4"), np.zeros(len(code), "<u4")
    for alphabet in (LOWER, UPPER, DIGITS):
        own = (code >= ord(alphabet[0])) & (code <= ord(alphabet[-1]))
        base[own], many[own] = ord(alphabet[0]), len(alphabet)
    at = np.flatnonzero(many)
    base, many, middle = base[at], many[at], len(at) // 2
    x = code[at] - base
    form = hashlib.sha256(base.tobytes()).digest()
    halves = slice(0, middle), slice(middle, len(at))
    for k in range(ROUNDS) if not undo else range(ROUNDS - 1, -1, -1):
        to, of = halves[k % 2], halves[1 - k % 2]
        data = key + b"|%s|%d|%d|" % (kind.encode(), len(at), k) + form + x[of].tobytes()
        step = np.frombuffer(hashlib.shake_256(data).digest(4 * (to.stop - to.start)), "<u4") % many[to]
        x[to] = (x[to] + (many[to] - step if undo else step)) % many[to]
    code[at] = base + x
    return code.tobytes().decode("utf-32-le")


def permuted_text(value: str, key: bytes, kind: str, undo: bool = False) -> str:
    """Each letter becomes a letter of the same case, each digit a digit; anything else stays."""
    if len(value) > AS_NUMBER:
        return permuted_long(value, key, kind, undo)
    size, x = 1, 0
    for ch in value:
        if alphabet := CLASS.get(ch):
            size *= len(alphabet)
            x = x * len(alphabet) + alphabet.index(ch)
    form = "".join("a" if c in LOWER else "A" if c in UPPER else "0" for c in value if c in CLASS)
    x = permuted(x, size, key, f"{kind}|{form}".encode(), undo)
    out = []
    for ch in reversed(value):
        if alphabet := CLASS.get(ch):
            x, k = divmod(x, len(alphabet))
            out.append(alphabet[k])
        else:
            out.append(ch)
    return "".join(reversed(out))


def only_digits(value: str) -> str:
    return re.sub(r"[^0-9]", "", value)


def with_digits(value: str, digits: str) -> str:
    """value with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if ch in DIGITS else ch for ch in value)


def luhn(digits: str) -> int:
    """The check digit that belongs after digits."""
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = int(ch) * (2 - k % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_rest(text: str) -> int:
    moved = text[4:] + text[:4]
    return int("".join(str(int(ch, 36)) for ch in moved)) % 97


# -- kinds -----------------------------------------------------------------------------------------


def email(value: str, key: bytes, undo: bool) -> str:
    """Name and domain are permuted apart, so that addresses of one domain stay so; the top-level domain stays."""
    local, _, domain = value.partition("@")
    own, dot, top = domain.rpartition(".")
    return f"{permuted_text(local, key, 'email', undo)}@{permuted_text(own, key, 'domain', undo)}{dot}{top}"


def number(value: str, key: bytes, undo: bool) -> str:
    """Card numbers keep a right check digit; other numbers of 13 to 19 digits are permuted whole. The two sets don't meet."""
    digits = only_digits(value)
    if luhn(digits[:-1]) == int(digits[-1]):
        body = permuted_text(digits[:-1], key, "card", undo)
        return with_digits(value, body + str(luhn(body)))
    # The last digit of these is one of nine: permuted as such, with the digits before it.
    rest = (int(digits[-1]) - luhn(digits[:-1]) - 1) % 10
    x = permuted(int(digits[:-1]) * 9 + rest, 9 * 10 ** (len(digits) - 1), key, b"account|%d" % len(digits), undo)
    body = str(x // 9).zfill(len(digits) - 1)
    return with_digits(value, body + str((luhn(body) + 1 + x % 9) % 10))


def phone(value: str, key: bytes, undo: bool) -> str:
    digits = only_digits(value)
    keep = max(0, len(digits) - 10)  # the country
    return with_digits(value, digits[:keep] + permuted_text(digits[keep:], key, "phone", undo))


def is_phone(value: str) -> bool:
    return 10 <= len(only_digits(value)) <= 15


def ssn(value: str, key: bytes, undo: bool) -> str:
    area, group, serial = value.split("-")
    areas = [a for a in range(1, 900) if a != 666]
    x = (areas.index(int(area)) * 99 + int(group) - 1) * 9999 + int(serial) - 1
    x = permuted(x, len(areas) * 99 * 9999, key, b"ssn", undo)
    return f"{areas[x // (99 * 9999)]:03d}-{x // 9999 % 99 + 1:02d}-{x % 9999 + 1:04d}"


def is_ssn(value: str) -> bool:
    area, group, serial = map(int, value.split("-"))
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def iban(value: str, key: bytes, undo: bool) -> str:
    plain = value.replace(" ", "")
    body = permuted_text(plain[4:], key, "iban" + plain[:2], undo)
    check = 98 - iban_rest(f"{plain[:2]}00{body}")
    it = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(ch if ch == " " else next(it) for ch in value)


def is_iban(value: str) -> bool:
    plain = value.replace(" ", "")
    return 15 <= len(plain) <= 34 and 2 <= int(plain[2:4]) <= 98 and iban_rest(plain) == 1


def ipv4(value: str, key: bytes, undo: bool) -> str:
    x = int.from_bytes(bytes(map(int, value.split("."))), "big")
    return ".".join(map(str, permuted(x, 2**32, key, b"ipv4", undo).to_bytes(4, "big")))


def is_ipv4(value: str) -> bool:
    return all(int(p) < 256 and p == str(int(p)) for p in value.split("."))


ISO, DAY_FIRST = re.compile(r"([0-9]{4})([-/.])([0-9][0-9])\2([0-9][0-9])"), re.compile(r"([0-9][0-9])([-/.])([0-9][0-9])\2([0-9]{4})")


def day_of(value: str) -> tuple[datetime.date, str] | None:
    """The date and its form. Of the two readings of 03/04/2024 the day comes first unless only the other is valid."""
    try:
        if m := ISO.fullmatch(value):
            return datetime.date(int(m[1]), int(m[3]), int(m[4])), f"%Y{m[2]}%m{m[2]}%d"
        m = DAY_FIRST.fullmatch(value)
        if int(m[3]) <= 12:
            return datetime.date(int(m[4]), int(m[3]), int(m[1])), f"%d{m[2]}%m{m[2]}%Y"
        return datetime.date(int(m[4]), int(m[1]), int(m[3])), f"%m{m[2]}%d{m[2]}%Y"
    except ValueError:
        return None


def is_date(value: str) -> bool:
    found = day_of(value)
    return found is not None and FIRST_DAY <= found[0].toordinal() <= LAST_DAY


def date(value: str, key: bytes, undo: bool) -> str:
    """A day is permuted among those on which the day of the month is above 12 as well, or isn't. So month-first days stay
    readable as such, and a day has one pseudonym in all forms."""
    day, form = day_of(value)
    x, late = day.toordinal(), day.day > 12
    while True:
        x = FIRST_DAY + permuted(x - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, b"date", undo)
        if (datetime.date.fromordinal(x).day > 12) == late:
            return datetime.date.fromordinal(x).strftime(form)


#: Kinds in the order in which they are tried at a place: pattern, validator, permutation.
KINDS: dict[str, tuple[str, Callable[[str], bool], Callable[[str, bytes, bool], str]]] = {
    "email": (r"(?<![\w.%+-])[\w%+-](?:[\w.%+-]*[\w%+-])?@[A-Za-z0-9](?:[A-Za-z0-9-]*\.)+[A-Za-z]{2,24}(?![\w-])", lambda v: True, email),
    "iban": (r"(?<!\w)[A-Z]{2}[0-9][0-9](?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", is_iban, iban),
    "ipv4": (r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])", is_ipv4, ipv4),
    "date": (r"(?<![\w./-])(?:[0-9]{4}([-/.])[0-9][0-9]\1[0-9][0-9]|[0-9][0-9]([-/.])[0-9][0-9]\2[0-9]{4})(?![\w/-]|\.[0-9])", is_date, date),
    "ssn": (r"(?<![\w-])[0-9]{3}-[0-9][0-9]-[0-9]{4}(?![\w-])", is_ssn, ssn),
    "number": (r"(?<![\w.+-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-]|\.[0-9])", lambda v: len({c for c in v if not c.isdigit()}) <= 1, number),
    "phone": (r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?[0-9]{2,4}|[0-9]{2,4}(?=[ .-][0-9]{2,4}[ .-][0-9])|(?<=\+)[0-9]{6,14}|(?<=\+[0-9])[ .-]?[0-9]{6,12})(?:[ .-][0-9]{2,4}){0,4}(?![\w-])", is_phone, phone),
}
CANDIDATE = re.compile(r"[@0-9]")
PATTERNS = {kind: re.compile(pattern) for kind, (pattern, _, _) in KINDS.items()}
NEEDS = {"email": "@"}
TAKEN = "\x00"


def found_in(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of valid values, in order; where kinds overlap, the first listed holds."""
    if not CANDIDATE.search(text):
        return []
    found: list[tuple[int, int, str]] = []
    for kind, pattern in PATTERNS.items():
        if NEEDS.get(kind, "") not in text:
            continue
        valid = KINDS[kind][1]
        own = [(*m.span(), kind) for m in pattern.finditer(text) if valid(m.group())]
        if own:  # what is found is out of the later patterns' way
            parts, last = [], 0
            for s, e, _ in own:
                parts += [text[last:s], TAKEN * (e - s)]
                last = e
            text = "".join(parts) + text[last:]
        found += own
    return sorted(found)


def pseudonymised(text: str, key: bytes, undo: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with its values replaced, and their places in the text as it was."""
    found, out, last = found_in(text), [], 0
    for s, e, kind in found:
        out += [text[last:s], KINDS[kind][2](text[s:e], key, undo)]
        last = e
    return "".join(out) + text[last:], found


def pseudonyms(docs: DataFrame, key: bytes, undo: bool = False) -> DataFrame:
    """doc_id, text (values replaced), n_found, kinds (kind:count), spans (kind:start:end in the text as it was): a row
    per row of docs, in one pass without a shuffle.

    Null texts stay null and have no values; empty ones stay empty; ids may be null or repeat; other columns are
    ignored. Texts and values may have any length: the time grows with it. Values that fail validation (a wrong calendar day, an octet above 255) stay as they are.
    """

    def masked(batches):
        for batch in batches:
            texts, n, kinds, spans = [], [], [], []
            for text in batch["text"]:
                if not text.is_valid:
                    new, found = None, []
                else:
                    new, found = pseudonymised(text.as_py(), key, undo)
                texts.append(new)
                n.append(len(found))
                count: dict[str, int] = {}
                for _, _, kind in found:
                    count[kind] = count.get(kind, 0) + 1
                kinds.append(",".join(f"{k}:{v}" for k, v in sorted(count.items())))
                spans.append(",".join(f"{k}:{s}:{e}" for s, e, k in found))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(kinds, pa.string()), pa.array(spans, pa.string())], ["doc_id", "text", "n_found", "kinds", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(masked, "doc_id long, text string, n_found long, kinds string, spans string")


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms(table(spark, sf_dir, "documents"), DEMO_KEY)
