"""Exact deduplication by a tree merge of sorted digest runs.

Every partition sorts the digests of its texts into runs that hold each digest once, with the smallest
identifier and a count. A run is cut by digest range, so that no task ever sees more than one range, and the
runs of a range are merged in binomial rounds: in a round, the runs whose numbers agree but for their lowest
bits meet in one task, a heap merges them, and one sorted run is left. Two texts are one only if digest, length
and a second hash agree; at every level the smallest identifier of each is retained. A copy group of any size is
one entry of a run, so a hot text costs no more than any other.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, Scratch, first_of_each, key_of, or_empty, table

RUN = "part int, run long, digest array<binary>, n_bytes array<long>, check array<long>, keep_id array<long>, n array<long>"
TEXT = ("digest", "n_bytes", "check")
#: Digests that a range holds at most on average; rows that a task sorts at once; rounds of merges at most.
RANGE_ROWS, SORT_ROWS, ROUNDS = 100_000, 100_000, 3


def normalised(text: str = "text"):
    return F.regexp_replace(or_empty(text), BLANKS, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(text_col).alias("text"))
    return plain.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"), F.xxhash64("text").alias("check"))


def sorted_runs(t: pa.Table, number: int) -> pa.RecordBatch:
    """Rows of part, TEXT and keep_id as one sorted run of each part."""
    t = t.append_column("n", pa.array(np.ones(len(t), np.int64)))
    t = t.group_by(["part", *TEXT], use_threads=False).aggregate([("keep_id", "min"), ("n", "sum")]).sort_by([(c, "ascending") for c in ("part", *TEXT)]).combine_chunks()
    part = t["part"].to_numpy()
    cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
    offsets = pa.array(cuts, pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, t[c].combine_chunks()) for c in (*TEXT, "keep_id_min", "n_sum")]
    return pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]], pa.int32()), pa.array([number] * len(lists[0]), pa.int64()), *lists], ["part", "run", *TEXT, "keep_id", "n"])


def local_runs(batches):
    number, rows, waiting = TaskContext.get().partitionId(), [], 0
    for b in batches:
        rows.append(b)
        waiting += b.num_rows
        if waiting >= SORT_ROWS:
            yield sorted_runs(pa.Table.from_batches(rows), number)
            rows, waiting = [], 0
    if waiting:
        yield sorted_runs(pa.Table.from_batches(rows), number)


def merged(runs: list[list[tuple]]) -> list[tuple]:
    """Sorted runs of (digest, n_bytes, check, keep_id, n) as one, each text once."""
    out = []
    for text, same in groupby(heapq.merge(*runs, key=lambda e: e[:3]), key=lambda e: e[:3]):
        ids, counts = zip(*(e[3:] for e in same), strict=True)
        out.append((*text, min((i for i in ids if i is not None), default=None), sum(counts)))
    return out


def merge_runs(t: pa.Table) -> pa.Table:
    head = {"part": t["part"][:1], "run": t["to"][:1]}
    columns = (*TEXT, "keep_id", "n")
    if len(t) == 1:
        return pa.table(head | {c: t[c] for c in columns})
    runs = [list(zip(*lists, strict=True)) for lists in zip(*(t[c].to_pylist() for c in columns), strict=True)]
    lists = zip(*merged(runs), strict=True)
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    return pa.table(head | {c: pa.array([list(v)], pa.list_(k)) for c, v, k in zip(columns, lists, kinds, strict=True)})


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", round_bits: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty. keep_id is the smallest non-null id of the equal texts (null if all are
    null). Rows repeated with the id that stays are all marked kept; empty input gives no rows; other
    columns are ignored, whatever their names. round_bits: each round merges the runs of 2**round_bits partitions;
    by default 8 partitions, or as many as it takes to be done in ROUNDS rounds.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    each = scratch.keep(digests(docs, id_col, text_col), "digests")
    ranges = max(1, -(-each.count() // RANGE_ROWS))
    part = F.pmod(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), F.lit(ranges)).cast("int")
    runs = scratch.keep(each.select(part.alias("part"), *TEXT, F.col("doc_id").alias("keep_id")).mapInArrow(local_runs, RUN), "runs0")
    last = runs.agg(F.max("run")).first()[0] or 0
    bits = round_bits or max(3, -(-last.bit_length() // ROUNDS))
    level = 0
    while last > 0 or level == 0:
        to = F.shiftright("run", bits).alias("to")
        runs = scratch.keep(runs.select("part", to, *TEXT, "keep_id", "n").groupBy("part", "to").applyInArrow(merge_runs, RUN), f"runs{level + 1}")
        scratch.drop(f"runs{level}")
        last, level = last >> bits, level + 1
    scratch.only("digests", f"runs{level}")
    best = runs.select(F.inline(F.arrays_zip(*TEXT, "keep_id", F.col("n").alias("group_size"))))
    return each.join(best, list(TEXT)).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, one of each group; of rows repeated with one id, one stays."""
    kept = exact_groups(docs).filter("kept").select(key_of("doc_id", "text_sha256").alias("key")).distinct()
    return first_of_each(docs, kept, key_of("doc_id", F.sha2(normalised(), 256)))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
