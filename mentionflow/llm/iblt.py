"""Document fingerprints as invertible Bloom lookup tables of passage digests.

A text is cut into passages (lines, and clauses within them), each hashed to 64 bits. A fingerprint is a
small table: every distinct digest is added to three of its cells, which hold a count, a sum of digests and a
sum of check values. Subtracting the tables of two versions leaves what differs; cells that hold one digest
are peeled until nothing is left, which recovers the digests on either side. If peeling gets stuck, both
tables are built four times as large and with other cells, and subtracted again.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import or_empty, partitions, table

#: Cells of the fingerprint that is kept; digests of two versions that are compared at once.
CELLS, BATCH_DOCS, BATCH_DIGESTS = 24, 512, 200_000
#: Bytes of texts in a range of documents at most, and what a row counts beside its text.
RANGE_BYTES, ROW_BYTES = 64_000_000, 100
PASSAGE = re.compile(r"[^\n.,;:!?]{1,64}[\n.,;:!?]*|[\n.,;:!?]+")
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def passages(text: str) -> np.ndarray:
    """The distinct digests of a text's passages, in order."""
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(p) for p in map(str.encode, PASSAGE.findall(text))), dtype=np.uint64))


def mixed(x: np.ndarray, by: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX[by]
    x = (x ^ (x >> np.uint64(29))) * MIX[(by + 1) % 4]
    return x ^ (x >> np.uint64(32))


def cells_of(keys: np.ndarray, size: int) -> list[np.ndarray]:
    """One cell in each third of a table of so many cells."""
    third = size // 3
    seeded = keys + np.uint64(size * int(MIX[3]) % 2**64)
    return [(mixed(seeded, j) % np.uint64(third)).astype(np.int64) + j * third for j in range(3)]


class Tables:
    """Tables of n versions side by side; counts, sums of digests and of check values wrap around."""

    def __init__(self, n: int, size: int):
        self.n, self.size = n, size
        self.count, self.sums, self.checks = np.zeros(n * size, np.int64), np.zeros(n * size, np.uint64), np.zeros(n * size, np.uint64)

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int = 1) -> None:
        times = np.broadcast_to(np.asarray(sign, np.int64), keys.shape)
        factor = times.astype(np.uint64)
        check = mixed(keys, 3)
        for cell in cells_of(keys, self.size):
            at = owner * self.size + cell
            np.add.at(self.count, at, times)
            np.add.at(self.sums, at, keys * factor)
            np.add.at(self.checks, at, check * factor)

    def minus(self, other: Tables) -> Tables:
        left = Tables(self.n, self.size)
        left.count, left.sums, left.checks = self.count - other.count, self.sums - other.sums, self.checks - other.checks
        return left

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each version: whether all was recovered, digests only on the left and only on the right."""
        only = np.zeros((2, self.n), np.int64)
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            sign = self.count[look]
            factor = sign.astype(np.uint64)
            keys = self.sums[look] * factor
            pure = self.checks[look] * factor == mixed(keys, 3)
            owner, keys, sign = look[pure] // self.size, keys[pure], sign[pure]
            if not len(keys):
                break
            order = np.lexsort((keys, owner))
            owner, keys, sign = owner[order], keys[order], sign[order]
            new = np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])]
            owner, keys, sign = owner[new], keys[new], sign[new]
            np.add.at(only[0], owner[sign > 0], 1)
            np.add.at(only[1], owner[sign < 0], 1)
            self.add(owner, keys, -sign)
            touched = np.unique(np.concatenate([owner * self.size + c for c in cells_of(keys, self.size)]))
            look = touched[np.abs(self.count[touched]) == 1]
        stuck = ((self.count != 0) | (self.sums != 0) | (self.checks != 0)).reshape(self.n, self.size).any(axis=1)
        return ~stuck, only[0], only[1]

    def texts(self) -> list[str]:
        cells = np.zeros((self.n, self.size), dtype=[("n", "<i4"), ("sum", "<u8"), ("check", "<u4")])
        cells["n"], cells["sum"] = self.count.reshape(self.n, -1), self.sums.reshape(self.n, -1)
        cells["check"] = (self.checks & np.uint64(0xFFFFFFFF)).reshape(self.n, -1)
        return [base64.b64encode(row.tobytes()).decode() for row in cells]


def filled(sets: list[np.ndarray], size: int) -> Tables:
    t = Tables(len(sets), size)
    if sets and (n := [len(s) for s in sets]):
        t.add(np.repeat(np.arange(len(sets)), n), np.concatenate(sets))
    return t


def fingerprints(sets: list[np.ndarray]) -> list[str]:
    return filled(sets, CELLS).texts()


def differences(left: list[np.ndarray], right: list[np.ndarray], size: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """How many digests are only in the left and only in the right one of each pair, recovered from subtracted tables."""
    only = np.zeros((2, len(left)), np.int64)
    open_ = np.arange(len(left))
    while len(open_):
        done, a, b = filled([left[i] for i in open_], size).minus(filled([right[i] for i in open_], size)).peel()
        only[0, open_[done]], only[1, open_[done]] = a[done], b[done]
        open_ = open_[~done]
        size *= 4
    return only[0], only[1]


def likeness(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared digests by all digests of each pair; two texts without passages are alike."""
    only_left, only_right = differences(left, right)
    shared = np.array([len(s) for s in left], np.int64) - only_left
    whole = shared + only_left + only_right
    return np.where(whole > 0, shared / np.maximum(whole, 1), 1.0)


def edited_text(text: str, following: str) -> str:
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def compare(batches):
    """Rows come in order, each range's feeders last; a row is done when the next one is known."""
    waiting: list[tuple] = []
    held, last = 0, None

    def done():
        own, edits, nexts = ([row[k] for row in waiting] for k in (3, 4, 5))
        out = {
            "doc_id": pa.array([row[0] for row in waiting], pa.int64()),
            "n_chars": pa.array([row[1] for row in waiting], pa.int64()),
            "edited_sha256": [row[2] for row in waiting],
            "fingerprint": fingerprints(own),
            "edited_fingerprint": fingerprints(edits),
            "near_edited": likeness(own, edits),
            "near_next": likeness(own, nexts),
        }
        waiting.clear()
        return pa.RecordBatch.from_pydict(out)

    for batch in batches:
        for part, feeder, doc_id, text in zip(batch["part"].to_pylist(), batch["feeder"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"], strict=True):
            if feeder and (last is None or last[0] != part):
                continue  # the range is closed already
            text = text.as_py()
            row = (part, doc_id, text, passages(text))
            if last is not None:
                edit = edited_text(last[2], text)
                edits = passages(edit)
                waiting.append((last[1], len(last[2]), hashlib.sha256(edit.encode()).hexdigest(), last[3], edits, row[3]))
                held += len(edits) + 2 * len(row[3])
            last = None if feeder else row
            if len(waiting) >= BATCH_DOCS or held >= BATCH_DIGESTS:
                held = 0
                yield done()
    if waiting:
        yield done()


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def order_keys(no_id: np.ndarray, doc_id: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """17 bytes for each row that sort like (null ids last, id falling, digest rising)."""
    sign = np.uint64(1 << 63)
    falling = np.where(no_id, np.uint64(0), ~doc_id.astype(np.int64).view(np.uint64) ^ sign)
    parts = [no_id.astype(np.uint8)[:, None], *(x.astype(">u8").view(np.uint8).reshape(-1, 8) for x in (falling, digest.astype(np.int64).view(np.uint64) ^ sign))]
    return np.ascontiguousarray(np.hstack(parts)).view("S17").ravel()


def cuts_in(most: int):
    """Keys of the rows that begin the ranges of a sorted partition: the first, and each with which a range would pass so many bytes."""

    def cuts(batches):
        held = None
        for batch in batches:
            keys = order_keys(*(batch[c].to_numpy(zero_copy_only=False) for c in ("no_id", "doc_id", "digest")))
            found, last = [], None
            for key, size in zip(keys.tolist(), batch["size"].to_pylist(), strict=True):
                if held is None or held + size > most and key != last:
                    found.append(key)
                    held = 0
                held, last = held + size, key
            if found:
                yield pa.RecordBatch.from_pydict({"key": pa.array([k.ljust(17, b"\0") for k in found], pa.binary())})

    return cuts


def cuts_of(rows: DataFrame) -> np.ndarray:
    """Keys of the rows that begin the ranges, in order. Spark sorts narrow rows (id, hash, length), and each task tells where its
    ranges begin, so no range has more than RANGE_BYTES of texts, but for one longer text alone and rows repeated with one id and
    hash. The driver holds 17 bytes for each range."""
    n_tasks = partitions(rows.sparkSession)
    narrow = rows.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "digest", (F.octet_length("text") + ROW_BYTES).cast("long").alias("size"))
    whole = narrow.agg(F.sum("size")).first()[0]
    if not whole:
        return np.zeros(0, "S17")
    order = [F.col("no_id"), F.col("doc_id").desc(), F.col("digest")]
    begun = narrow.repartitionByRange(n_tasks, *order).sortWithinPartitions(*order).mapInArrow(cuts_in(min(RANGE_BYTES, -(-whole // n_tasks))), "key binary")
    return np.unique(np.array([bytes(k) for k in begun.toArrow()["key"].to_pylist()], "S17"))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each row's text and of its edited text, and how like they are; a row per row of docs.

    The next document is that with the next smaller id; rows of one id go by a hash of the text, null ids come last, and
    after the last row comes the first. Null texts count as empty; an only row is its own next; an empty table gives no
    rows; other columns are ignored, whatever their names. Texts are shuffled once, into ranges of (id, hash) that begin
    at rows known beforehand: the first row of a range is sent to the range before as well, so that no range
    waits for another. A very long text may be a range of its own.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty("text").alias("text")).withColumn("digest", F.xxhash64("text"))
    cuts = cuts_of(rows)
    n = max(1, len(cuts))
    starts = spark.sparkContext.broadcast(cuts.tobytes())  # 17 bytes a range

    @F.pandas_udf("part int, feeds int")
    def placed(no_id: pd.Series, doc_id: pd.Series, digest: pd.Series) -> pd.DataFrame:
        """The range of a row; and the range before if it is the first of its own."""
        begin, keys = np.frombuffer(starts.value, "S17"), order_keys(no_id.to_numpy(), doc_id.to_numpy(), digest.to_numpy())
        part = np.maximum(np.searchsorted(begin, keys, side="right") - 1, 0)
        return pd.DataFrame({"part": part, "feeds": np.where(begin[part] == keys, (part - 1) % n, -1)})

    at = placed(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "digest")
    here, there = F.struct(F.col("at.part").alias("part"), F.lit(False).alias("feeder")), F.struct(F.col("at.feeds").alias("part"), F.lit(True).alias("feeder"))
    rows = rows.withColumn("at", at).select("doc_id", "text", "digest", F.inline(F.when(F.col("at.feeds") >= 0, F.array(here, there)).otherwise(F.array(here))))
    dealt = rows.repartitionById(n, F.col("part")).sortWithinPartitions("part", "feeder", F.col("doc_id").desc_nulls_last(), "digest", "text")
    return dealt.select("part", "feeder", "doc_id", "text").mapInArrow(compare, OUT)


def op10_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))
