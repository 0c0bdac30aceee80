"""Best-fit packing of documents into sequences, by hierarchical residual packing.

Documents are tokenised and cut where they are tokenised. Full pieces are sequences of their own. The
others are dealt out into groups of a bounded number of rows, best-fit packed there (largest first),
and nearly full bins are emitted. Underfull bins go up a tree: groups merge, their bins are items of the
next best-fit round, until one group is left. Where groups can't merge because they would be too large, bins are
dealt out anew instead, so that those of different groups meet, until a round lowers their number by less than 1%.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, or_empty, table

CAPACITY = 2048
#: Rows of a group on average; groups that merge into one at the next level; what counts as nearly full.
GROUP_ROWS, FAN_IN, NEARLY = 40_000, 8, 15 / 16
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
ITEM = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])
BIN = "grp long, full boolean, sequence_id long, fill int, items array<struct<doc_id long, piece int, start long, length long, ids_crc32 long, offset long>>"


class Tokens:
    """Ids of the byte-level BPE vocabulary. Texts that hold the special token's string or so many blanks in a row that
    the pattern of the ranks library would overflow its stack go to the tokenizers library, others to the same vocabulary
    as ranks, which gives the same ids several times faster."""

    special, blanks = "<|endoftext|>", 50_000

    def __init__(self, json_path: str, ranks_path: str):
        import base64

        import public_tokenizers
        import tiktoken

        self.json_path, self.whole = json_path, None
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.special not in text and not (len(text) > self.blanks and any(len(m[0]) > self.blanks for m in re.finditer(r"\s+", text))):
            return self.ranked.encode_ordinary(text)
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.json_path)
        return self.whole.encode(text, add_special_tokens=False).ids


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter than capacity."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """A row per piece of each row of docs; a piece of full length has a sequence_id, others have none."""
    import public_tokenizers

    json_path = json_path or public_tokenizers.path("byte_bpe_50k.json")
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def tokenised(batches):
        encode = Tokens(json_path, ranks_path)
        number, n_full = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.array([*encode(text.as_py()), 0], dtype="<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    full = length == capacity
                    out.append((doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes()), number + n_full if full else None))
                    n_full += full
            columns = list(zip(*out, strict=True)) or [()] * 6
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty("text").alias("text")).mapInArrow(tokenised, PIECE + ", sequence_id long")


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item: the open bin with the least room that still holds it, else a new one. Open bins are kept
    by room, and a bit for each room that some bin has finds the next larger one."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, n, out = 0, 0, []
    for size in sizes:
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at, n = capacity, n, n + 1
        room -= size
        if room:
            by_room[room].append(at)
            rooms |= 1 << room
        out.append(at)
    return out


def packer(level: int, capacity: int, nearly: float):
    def pack(t: pa.Table) -> pa.Table:
        return pack_group(t, level, capacity, nearly)

    return pack


def pack_group(t: pa.Table, level: int, capacity: int, nearly: float) -> pa.Table:
    """The bins of one group's items, each item a bin of the level below."""
    t = t.sort_by([("fill", "descending"), ("id0", "ascending"), ("piece0", "ascending"), ("crc0", "ascending")]).combine_chunks()
    group = t["grp"][0].as_py()
    fill = t["fill"].to_numpy()
    at = np.array(best_fit(fill.tolist(), capacity))
    order = np.argsort(at, kind="stable")
    at, fill = at[order], fill[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    ends = np.cumsum(fill)
    base = ends - fill
    shift = base - np.repeat(base[first], np.diff(np.r_[first, len(at)]))
    items = t["items"].combine_chunks().take(pa.array(order))
    counts = items.value_lengths().to_numpy()
    flat = items.flatten()
    moved = flat.field("offset").to_numpy() + np.repeat(shift, counts)
    columns = [flat.field(f.name) for f in ITEM][:-1] + [pa.array(moved, pa.int64())]
    starts = np.cumsum(np.r_[0, counts])
    offsets = np.r_[starts[first], starts[-1]].astype("int32")
    whole = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(ITEM)))
    fills = np.add.reduceat(fill, first)
    n = len(fills)
    ids = (level << 56) + (group << 32) + np.arange(n)
    return pa.table({"grp": pa.array([group] * n, pa.int64()), "full": pa.array(fills >= nearly * capacity), "sequence_id": pa.array(ids, pa.int64()), "fill": pa.array(fills, pa.int32()), "items": whole})


def packed(docs: DataFrame, capacity: int = CAPACITY, nearly: float = NEARLY, group_rows: int = GROUP_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: a row per piece.

    Null and empty texts are one token (the closing id 0); texts may have any length and any runs of blanks. Rows repeated with one id are packed as often as they
    stand; an empty table gives no rows; other columns are ignored, whatever their names; null ids are packed like others.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    cuts = scratch.keep(pieces(docs, capacity), "pieces")
    done = [cuts.filter("sequence_id is not null").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.lit(0).cast("long").alias("offset"))]
    rest = cuts.filter("sequence_id is null")
    n = rest.count()
    groups = max(1, math.ceil(n / group_rows))
    deal = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups))
    item = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))
    bins = rest.select(deal.alias("grp"), F.col("length").cast("int").alias("fill"), F.array(item).alias("items"))
    level, anew = 1, False
    while n:
        first = F.col("items")[0]
        keyed = bins.select("grp", "fill", "items", first["doc_id"].alias("id0"), first["piece"].alias("piece0"), first["ids_crc32"].alias("crc0"))
        round_ = keyed.groupBy("grp").applyInArrow(packer(level, capacity, nearly), BIN)
        round_ = scratch.keep(round_, f"level{level}")
        left = round_.filter("not full").count()
        ended = groups == 1 or left == 0 or (anew and left > 0.99 * n)
        out = round_ if ended else round_.filter("full")
        done.append(out.select("sequence_id", F.inline("items")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
        if ended:
            break
        fewer = max(math.ceil(groups / fan_in), math.ceil(left / group_rows))
        anew, groups = fewer >= groups, min(fewer, groups)
        to = F.pmod(F.xxhash64("sequence_id"), F.lit(groups)) if anew else F.pmod("grp", F.lit(groups))
        bins = round_.filter("not full").select(to.alias("grp"), "fill", "items")
        n, level = left, level + 1
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
