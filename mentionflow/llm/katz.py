"""Language-model scoring by Katz backoff.

The texts become blocks: word ids and the block's own words, packed. Order by order, each block sends the distinct n-grams
that it has, with its training counts, to buckets by context; a bucket adds them up, and answers with the counts of all
texts and, where an n-gram was never seen, with what its context's backoff weight is made of. So every n-gram moves once for
each block, however often it stands there, and the tables of counts are partitioned by bucket. Contexts so frequent that a
bucket would grow too large are split over several by their words, and their sums are added up afterwards.

    p(w | context) = d(c) * c(context w) / c(context)   where it was seen in training, d being Good-Turing discounts,
                   = a(context) * p(w | shorter context) where not, a being what seen words leave over, divided by what
                     they leave of the shorter context's probability: all probabilities of a context sum to 1 exactly.

Words never seen are one word of the vocabulary; a word that begins a text has the context of a start mark.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, or_empty, table

#: Counts up to CUT are discounted.
ORDER, CUT = 2, 5
#: Tokens of a block; n-grams of a bucket on average; occurrences of a context for each bucket it is split over.
BLOCK_TOKENS, BUCKET_GRAMS, SPLIT = 1_250_000, 600_000, 1_000_000
START = 1 << 62
BLOCK = "block long, doc_ids array<long>, trains array<boolean>, sizes binary, tokens binary, words binary, counts binary"
WORDS = "bucket int, block long, words binary, counts binary"
GRAMS = "bucket int, block long, ctx binary, word binary, counts binary, lower binary, lower_of binary, split binary"
#: A row for a block (what a bucket answers, in the order in which it was asked), or statistics of a bucket, or the sums of
#: a part of a split context, or a block that asks for such a context.
ANSWER = "k int, block long, bucket int, totals binary, ids binary, bare binary, sum_of binary, sums binary, stats array<long>, ctx long, hot array<double>"
_ANSWER = [("k", pa.int32()), ("block", pa.int64()), ("bucket", pa.int32()), *[(n, pa.binary()) for n in ("totals", "ids", "bare", "sum_of", "sums")], ("stats", pa.list_(pa.int64())), ("ctx", pa.int64()), ("hot", pa.list_(pa.float64()))]


# -- packed arrays ---------------------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in as few bytes as the largest needs, byte by byte of all numbers, compressed."""
    most = int(values.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    planes = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + zstandard.compress(planes.tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.decompress(data[1:]), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def rows_as(schema: list, rows: list[dict]) -> pa.Table:
    return pa.table({name: pa.array([r.get(name) for r in rows], kind) for name, kind in schema})


def spread(ctx: np.ndarray, sub: np.ndarray, buckets: int) -> np.ndarray:
    x = ctx.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + sub.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


# -- blocks ----------------------------------------------------------------------------------------


def blocks(batches):
    """Rows of BLOCK. The empty word stands for a text's end; words are numbered from the most frequent one on."""
    number, n = TaskContext.get().partitionId() << 32, 0
    doc_ids, trains, sizes, ids, own = [], [], [], [], {b"": 0}

    def packed():
        tokens, used = np.array(ids, dtype=np.int64), np.repeat(np.array(trains, dtype=bool), sizes)
        order = np.argsort(-np.bincount(tokens, minlength=len(own)), kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        words = list(own)
        counts = np.bincount(rank[tokens[used]], minlength=len(own))
        row = (number + n, doc_ids, trains, pack(np.array(sizes)), pack(rank[tokens]), zstandard.compress(b"\n".join([words[k] for k in order.tolist()]), 3), pack(counts))
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 4)
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], ["block", "doc_ids", "trains", "sizes", "tokens", "words", "counts"])

    for batch in batches:
        for doc_id, train, text in zip(batch["doc_id"].to_pylist(), batch["trains"].to_pylist(), batch["text"], strict=True):
            words = text.as_buffer().to_pybytes().lower().split()
            ids += [own.setdefault(w, len(own)) for w in words]
            ids.append(0)
            doc_ids.append(doc_id)
            trains.append(train)
            sizes.append(len(words) + 1)
            if len(ids) >= BLOCK_TOKENS:
                yield packed()
                n += 1
                doc_ids, trains, sizes, ids, own = [], [], [], [], {b"": 0}
    if doc_ids:
        yield packed()


class Level:
    """What a block knows of its n-grams of one order: for each distinct one its training count in all texts, its id, and
    whether its context has no count that is discounted."""

    def __init__(self, of: np.ndarray, counts: np.ndarray, ids: np.ndarray):
        self.of, self.counts, self.ids = of, counts, ids  # of: the n-gram that ends at each token
        self.p: np.ndarray | None = None  # the probability of the last word at each token


class Block:
    """A block and the answers it has got so far. Each text is preceded by a start mark here."""

    def __init__(self, row: dict, answers: list[dict], model: Model):
        self.row, self.model = row, model
        self.sizes, tokens = unpack(row["sizes"]), unpack(row["tokens"])
        own = unpack(row["counts"])
        self.n_words = len(own)
        ends = np.cumsum(self.sizes)
        self.starts = ends - self.sizes + np.arange(len(ends))
        self.is_start = np.zeros(len(tokens) + len(ends), dtype=bool)
        self.is_start[self.starts] = True
        self.w = np.full(len(self.is_start), self.n_words, dtype=np.int64)
        self.w[~self.is_start] = tokens
        used = np.repeat(np.array(row["trains"], dtype=bool), self.sizes + 1)
        self.used = used & ~self.is_start
        self.before = np.arange(len(self.w)) - 1
        self.before[self.starts] = self.starts
        self.answers = {k: sorted((a for a in answers if a["k"] == k and a["totals"] is not None), key=lambda a: a["bucket"]) for k in range(1, model.order + 1)}
        self.hot = {k: {a["ctx"]: a["hot"] for a in answers if a["k"] == k and a["hot"] is not None} for k in range(1, model.order + 1)}
        self.levels = [self.first()]

    def first(self) -> Level:
        bucket = word_buckets(self.row["words"], self.model.buckets[1])
        order = np.argsort(bucket, kind="stable")
        counts, ids = np.zeros(self.n_words + 1, dtype=np.int64), np.full(self.n_words + 1, START)
        counts[order] = joined([unpack(a["totals"]) for a in self.answers[1]])
        ids[order] = joined([unpack(a["ids"]) for a in self.answers[1]])
        counts[-1] = counts[self.row_of_end()]  # as many starts as ends
        level = Level(self.w, counts, ids)
        level.p = self.model.unigrams(counts[self.w])
        return level

    def row_of_end(self) -> int:
        return zstandard.decompress(self.row["words"]).split(b"\n").index(b"")

    def ask(self, k: int) -> dict[str, np.ndarray]:
        """The distinct n-grams of order k whose context was seen in training, by bucket, context and word."""
        last = self.levels[k - 2]
        key = last.of[self.before] * (self.n_words + 1) + self.w
        grams, first, of = np.unique(key, return_index=True, return_inverse=True)
        counts = np.bincount(of[self.used], minlength=len(grams))
        ctx = last.of[self.before[first]]
        cc = last.counts[ctx]
        asked = np.flatnonzero((cc > 0) & ~self.is_start[first])
        ctx_id, word_id = last.ids[ctx[asked]], self.levels[0].ids[self.w[first[asked]]]
        split = -(-cc[asked] // self.model.split)
        bucket = spread(ctx_id, np.where(split > 1, spread(word_id, word_id * 0, 1 << 30) % split, 0), self.model.buckets[k])
        order = np.lexsort((word_id, ctx_id, bucket))
        return {"of": of, "n": len(grams), "first": first, "ctx": ctx, "cc": cc, "asked": asked[order], "bucket": bucket[order], "ctx_id": ctx_id[order], "word_id": word_id[order], "counts": counts[asked[order]], "split": split[order] > 1}

    def messages(self, k: int) -> pa.Table:
        q = self.ask(k)
        values, codes = np.unique(self.levels[k - 2].p[q["first"][q["asked"]]], return_inverse=True)
        cuts = np.flatnonzero(np.r_[True, q["bucket"][1:] != q["bucket"][:-1], True]) if len(q["bucket"]) else []
        out = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True) if len(cuts) else ():
            mine, of = np.unique(codes[a:b], return_inverse=True)
            out.append({
                "bucket": int(q["bucket"][a]), "block": self.row["block"], "ctx": pack(np.diff(q["ctx_id"][a:b], prepend=0)), "word": pack(q["word_id"][a:b]), "counts": pack(q["counts"][a:b]),
                "lower": values[mine].tobytes(), "lower_of": pack(of), "split": pack(q["split"][a:b].astype(np.int64)),
            })
        kinds = [("bucket", pa.int32()), ("block", pa.int64()), *[(n, pa.binary()) for n in ("ctx", "word", "counts", "lower", "lower_of", "split")]]
        return rows_as(kinds, out)

    def add(self, k: int) -> None:
        """Takes the answers of order k in, and works out its probabilities."""
        q, m, last = self.ask(k), self.model, self.levels[k - 2]
        total, ids, bare = np.zeros(q["n"], dtype=np.int64), np.zeros(q["n"], dtype=np.int64), np.zeros(q["n"], dtype=np.int64)
        sums = np.zeros((q["n"], CUT + 2))
        at = 0
        for a in self.answers[k]:
            got = unpack(a["totals"])
            rows = q["asked"][at : at + len(got)]
            at += len(got)
            total[rows], bare[rows] = got, unpack(a["bare"])
            if a["ids"] is not None:
                ids[rows] = unpack(a["ids"])
            of = unpack(a["sum_of"])
            if len(of):
                sums[rows[got == 0]] = np.frombuffer(a["sums"]).reshape(-1, CUT + 2)[of]
        if at != len(q["asked"]):
            raise ValueError(f"{len(q['asked'])} n-grams asked for, {at} answered")
        if q["split"].any():
            hot = np.array(sorted(self.hot[k]))
            of_hot = np.array([self.hot[k][ctx] for ctx in hot.tolist()])[np.searchsorted(hot, q["ctx_id"][q["split"]])]
            sums[q["asked"][q["split"]]] = of_hot
            bare[q["asked"][q["split"]]] = of_hot[:, :CUT].sum(axis=1) == 0
        grams = Level(q["of"], total, ids)
        cc = q["cc"]
        held = np.where(bare > 0, cc + 1, cc)  # a context without discounted counts is taken to have occurred once more
        seen = total > 0
        p = np.zeros(q["n"])
        p[seen] = m.discount(k, total[seen]) * total[seen] / held[seen]
        weight = np.ones(q["n"])
        off = (cc > 0) & ~seen & ~self.is_start[q["first"]]
        kept = (sums[off, :CUT] @ m.discounts[k] + sums[off, CUT]) / held[off]
        weight[off] = (1 - kept) / (1 - sums[off, CUT + 1])
        of = q["of"]
        grams.p = np.where(seen[of], p[of], weight[of] * last.p)
        # The n-gram of start marks, and its count.
        grams.ids[q["of"][self.starts]] = START
        grams.counts[q["of"][self.starts]] = self.levels[0].counts[-1]
        self.levels.append(grams)

    def scores(self) -> pa.RecordBatch:
        m, n = self.model, len(self.sizes)
        c = self.levels[0].counts[self.w]
        sum_of = lambda values: np.add.reduceat(np.where(self.is_start, 0, values), self.starts)
        columns = {
            "doc_id": pa.array(self.row["doc_ids"], pa.int64()), "held_out": pa.array([not t for t in self.row["trains"]], pa.bool_()), "n_tokens": pa.array(self.sizes, pa.int64()),
            "n_known": pa.array(sum_of((c > 0).astype(np.int64)), pa.int64()), "train_tokens": pa.array(np.full(n, m.stats[1][0]), pa.int64()),
            "base_score": pa.array(sum_of(np.log10((c + 1) / (m.stats[1][0] + m.stats[1][1] + 1))), pa.float64()), "score": pa.array(sum_of(np.log10(self.levels[-1].p)), pa.float64()),
        }
        return pa.table(columns)


def joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def word_buckets(words: bytes, buckets: int) -> np.ndarray:
    return np.array([zlib.crc32(w) % buckets for w in zstandard.decompress(words).split(b"\n")], dtype=np.int64)


# -- buckets ---------------------------------------------------------------------------------------


def count_stats(totals: np.ndarray) -> list[int]:
    """Sum, number of those seen, and how many have each count from 1 to CUT + 1."""
    return [int(totals.sum()), int((totals > 0).sum()), *np.bincount(totals[(totals > 0) & (totals <= CUT + 1)], minlength=CUT + 2)[1:].tolist()]


def numbered(totals: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """Ids that no other bucket gives, small ones for the most frequent."""
    order = np.argsort(-totals, kind="stable")
    ids = np.empty(len(order), dtype=np.int64)
    ids[order] = np.arange(len(order)) * buckets + bucket
    return ids


def word_totals(buckets: int):
    def answered(t: pa.Table) -> pa.Table:
        bucket = t["bucket"][0].as_py()
        words = [zstandard.decompress(w).split(b"\n") for w in t["words"].to_pylist()]
        each = pa.concat_arrays([pa.array(w, pa.binary()) for w in words]).dictionary_encode()
        rank = np.argsort(pc.sort_indices(each.dictionary).to_numpy())  # so that ids don't depend on the order of messages
        code = rank[each.indices.to_numpy()]
        totals = np.zeros(len(each.dictionary), dtype=np.int64)
        np.add.at(totals, code, joined([unpack(c) for c in t["counts"].to_pylist()]))
        ids, cuts = numbered(totals, bucket, buckets), np.cumsum([0, *map(len, words)])
        out = [{"k": 1, "block": b, "bucket": bucket, "totals": pack(totals[code[x:y]]), "ids": pack(ids[code[x:y]])} for b, x, y in zip(t["block"].to_pylist(), cuts[:-1], cuts[1:], strict=True)]
        return rows_as(_ANSWER, [*out, {"k": 1, "stats": count_stats(totals)}])

    return answered


def gram_totals(k: int, buckets: int, last: bool):
    def answered(t: pa.Table) -> pa.Table:
        bucket, rows = t["bucket"][0].as_py(), t.to_pylist()
        ctx = [np.cumsum(unpack(r["ctx"])) for r in rows]
        sizes = np.array([len(c) for c in ctx])
        ctx, word, counts = joined(ctx), joined([unpack(r["word"]) for r in rows]), joined([unpack(r["counts"]) for r in rows])
        lower = np.concatenate([np.frombuffer(r["lower"])[unpack(r["lower_of"])] for r in rows])
        split = joined([unpack(r["split"]) for r in rows])
        order = np.lexsort((word, ctx))
        c, w = ctx[order], word[order]
        new = np.r_[True, (c[1:] != c[:-1]) | (w[1:] != w[:-1])]
        starts = np.flatnonzero(new)
        totals = np.add.reduceat(counts[order], starts)
        gram = np.empty(len(order), dtype=np.int64)
        gram[order] = np.cumsum(new) - 1
        # Of each context: occurrences of words seen 1 to CUT times, of those seen more often, and the lower probability of all seen.
        c, low = c[starts], lower[order][starts]
        new = np.r_[True, c[1:] != c[:-1]]
        of = np.cumsum(new) - 1
        sums = np.bincount(of * (CUT + 2) + np.clip(totals, 1, CUT + 1) - 1, weights=totals, minlength=(of[-1] + 1) * (CUT + 2)).reshape(-1, CUT + 2)
        sums[:, CUT + 1] = np.bincount(of, weights=np.where(totals > 0, low, 0))
        bare = sums[:, :CUT].sum(axis=1) == 0
        ids = None if last else numbered(totals, bucket, buckets)
        out, at = [], 0
        for r, n in zip(rows, sizes.tolist(), strict=True):
            mine = gram[at : at + n]
            got = totals[mine]
            used, sum_of = np.unique(of[mine[got == 0]], return_inverse=True)
            out.append({"k": k, "block": r["block"], "bucket": bucket, "totals": pack(got), "ids": None if last else pack(ids[mine]), "bare": pack(bare[of[mine]].astype(np.int64)), "sum_of": pack(sum_of), "sums": sums[used].tobytes()})
            out += [{"k": k, "block": r["block"], "ctx": x} for x in np.unique(ctx[at : at + n][split[at : at + n] > 0]).tolist()]
            at += n
        parts = np.zeros(len(sums), dtype=bool)
        parts[of[gram[split > 0]]] = True
        out += [{"k": k, "ctx": int(x), "hot": sums[i].tolist()} for i, x in zip(np.flatnonzero(parts), c[new][parts], strict=True)]
        return rows_as(_ANSWER, [*out, {"k": k, "stats": count_stats(totals)}])

    return answered


# -- the model -------------------------------------------------------------------------------------


def good_turing(counts: list[int]) -> np.ndarray:
    """Discounts of counts 1 to CUT from how many n-grams have each count from 1 to CUT + 1, as Katz has them; where
    these are no proper discounts (few data), half an occurrence is taken off."""
    n = [0, *counts]
    out = np.array([1 - 0.5 / r for r in range(1, CUT + 1)])
    beyond = (CUT + 1) * n[CUT + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUT + 1):
        if n[r] and n[r + 1] and beyond < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - beyond) / (1 - beyond)
            if 0 < d < 1:
                out[r - 1] = d
    return out


class Model:
    """What tasks need to know of all texts: a few numbers for each order."""

    def __init__(self, order: int, split: int):
        self.order, self.split = order, split
        self.buckets: dict[int, int] = {}
        self.stats: dict[int, list[int]] = {}
        self.discounts: dict[int, np.ndarray] = {}

    def learn(self, k: int, stats: list[int]) -> None:
        self.stats[k], self.discounts[k] = stats, good_turing(stats[2:])

    def discount(self, k: int, counts: np.ndarray) -> np.ndarray:
        return np.r_[1.0, self.discounts[k], 1.0][np.minimum(counts, CUT + 1)]

    def unigrams(self, counts: np.ndarray) -> np.ndarray:
        n, of = self.stats[1][0], np.array(self.stats[1][2 : 2 + CUT]) * np.arange(1, CUT + 1)
        if not n:
            return np.ones(len(counts))
        held = n + (not of.any())
        left = 1 - (of @ self.discounts[1] + (n - of.sum())) / held
        return np.where(counts > 0, self.discount(1, counts) * counts / held, left)


def katz_scores(docs: DataFrame, trains: Column, order: int = ORDER, split: int = SPLIT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row per row of docs.

    trains: which rows the model learns from. Tokens are words with A to Z lower-cased, and an end. base_score is that of
    single tokens with one added to each count; score the log10 probability of the text by Katz backoff of that order.

    Null and empty texts are one token, the end. Texts may have any length, rows any ids, null ones too; repeated rows count
    as often as they stand; a null in trains counts as false; without training rows all words are the unknown word (score
    0). Other columns are ignored; an empty table gives no rows.
    """
    scratch, model = Scratch(docs.sparkSession, "katz"), Model(order, split)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(trains, F.lit(False)).alias("trains"), or_empty("text").alias("text"))
    whole = scratch.keep(plain.mapInArrow(blocks, BLOCK), "blocks")
    n_tokens = whole.select(F.sum(F.octet_length("words")), F.sum(F.size("doc_ids"))).first()
    model.buckets[1] = max(1, (n_tokens[0] or 0) // 4_000_000)

    def send_words(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = zstandard.decompress(row["words"]).split(b"\n"), unpack(row["counts"])
                bucket = word_buckets(row["words"], model.buckets[1])
                rows = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.r_[True, np.diff(bucket[rows]) > 0, True])
                out = [{"bucket": int(bucket[rows[a]]), "block": row["block"], "words": zstandard.compress(b"\n".join([words[i] for i in rows[a:b].tolist()]), 3), "counts": pack(counts[rows[a:b]])} for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield from rows_as([("bucket", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())], out).to_batches()

    def learn(k: int, sent: DataFrame, totals) -> DataFrame:
        got = scratch.keep(sent.groupBy("bucket").applyInArrow(totals, ANSWER), f"order{k}")
        sums = got.filter("stats is not null").agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(CUT + 3)]).first()
        model.learn(k, [x or 0 for x in sums])
        own = got.filter("totals is not null")
        if k == 1:
            return own
        # Contexts that were split: their parts' sums, for each block that has them.
        hot = got.filter("hot is not null").groupBy("ctx").agg(F.array(*[F.sum(F.col("hot")[i]) for i in range(CUT + 2)]).alias("hot"))
        asks = got.filter("ctx is not null and block is not null").select("k", "block", "ctx").distinct().join(hot, "ctx")
        return own.unionByName(asks, allowMissingColumns=True).select(*got.columns)

    answers = learn(1, whole.select("block", "words", "counts").mapInArrow(send_words, WORDS), word_totals(model.buckets[1]))

    def loaded(left: pa.Table, right: pa.Table, upto: int) -> Block:
        block = Block(left.to_pylist()[0], right.to_pylist(), model)
        for k in range(2, upto + 1):
            block.add(k)
        return block

    def asking(k: int):
        return lambda left, right: loaded(left, right, k - 1).messages(k)

    for k in range(2, order + 1):
        model.buckets[k] = max(1, -(-model.stats[1][0] // BUCKET_GRAMS))
        sent = whole.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(asking(k), GRAMS)
        answers = answers.unionByName(learn(k, sent, gram_totals(k, model.buckets[k], k == order)))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return whole.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda left, right: loaded(left, right, order).scores(), schema)


def op12_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)
