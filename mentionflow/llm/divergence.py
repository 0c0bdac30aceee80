"""Source divergence audit: which terms set the sources of a language apart, and how far sources are from each other.

Each task takes the bytes of its texts as they lie in Arrow buffers and points at the beginnings of words. The pointers of
each source are sorted by a multikey quicksort that takes eight bytes at a step: pointers with equal bytes so far are
sorted by the next eight, until words end. Equal runs of the sorted pointers are the terms; their lengths are counts, the
documents that they point into document frequencies. Spark adds these up by language and term.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, or_empty, smaller, table

LEAST_DOCS, PRIOR, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Bytes of texts sorted together; rows of a shard of terms on average; cells of a block of terms by sources.
SLICE_BYTES, SHARD_ROWS, CELLS = 24_000_000, 200_000, 1_000_000
#: Steps of eight bytes after which the rest of longer words is compared as a whole.
STEPS = 8
COUNTED = "lang string, source string, term string, n long, docs long"
_KEPT = np.array([~np.uint64(0) << np.uint64(64 - 8 * k) if k else np.uint64(0) for k in range(9)], dtype=np.uint64)


def pointers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words (letters, and bytes beyond ASCII) begin and end; data ends with a byte of no word."""
    letter = np.zeros(256, dtype=bool)
    letter[ord("A") : ord("Z") + 1] = letter[ord("a") : ord("z") + 1] = letter[128:] = True
    inside = letter[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.r_[0, edge]
    return edge[::2], edge[1::2]


def sorted_runs(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the words, equal ones as they stand, and where in that order each run of equal words begins. data has
    eight bytes more than words need."""
    chunks = np.lib.stride_tricks.as_strided(data[:8].view(">u8"), shape=(len(data) - 7,), strides=(1,))
    size = end - begin

    def part(rows: np.ndarray, depth: int) -> np.ndarray:
        left = np.clip(size[rows] - depth, 0, 8)
        return chunks[np.where(left > 0, begin[rows] + depth, 0)].astype(np.uint64) & _KEPT[left]

    first = part(np.arange(len(begin)), 0)
    order = np.argsort(first, kind="stable")
    new = np.r_[True, first[order][1:] != first[order][:-1]] if len(order) else np.zeros(0, dtype=bool)
    depth = 8
    while True:
        starts = np.flatnonzero(new)
        if not len(starts):
            break
        counts = np.diff(np.r_[starts, len(order)])
        # Runs of several words some of which go on.
        longer = (counts > 1) & (np.maximum.reduceat(size[order], starts) > depth)
        if not longer.any():
            break
        slots = np.flatnonzero(np.repeat(longer, counts))
        group = np.repeat(np.arange(len(starts)), counts)[slots]
        rows = order[slots]
        if depth < 8 * STEPS:
            keys = part(rows, depth)
        else:
            rest = [data[b:e].tobytes() for b, e in zip((begin[rows] + depth).tolist(), np.maximum(end[rows], begin[rows] + depth).tolist(), strict=True)]
            rank = {r: k for k, r in enumerate(sorted(set(rest)))}
            keys = np.array([rank[r] for r in rest], dtype=np.uint64)
        sub = np.lexsort((keys, group))
        order[slots] = rows[sub]
        keys = keys[sub]
        new[slots] |= np.r_[True, (keys[1:] != keys[:-1]) | (group[1:] != group[:-1])]
        if depth >= 8 * STEPS:
            break
        depth += 8
    return order, np.flatnonzero(new)


def counted(batches):
    """Rows of COUNTED for slices of texts: each source's terms with their counts and documents."""
    for batch in smaller(batches, most=SLICE_BYTES):
        texts = batch["text"].cast(pa.binary())
        keys = list(zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True))
        names = sorted(set(keys))
        at = {k: i for i, k in enumerate(names)}
        of_doc = np.array([at[k] for k in keys], dtype=np.int64)
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = texts.buffers()[2]
        plain = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, dtype=np.uint8)
        offsets = offsets - offsets[0]
        # A zero after each text keeps words of two texts apart; only A to Z are lower-cased.
        ends = offsets[1:] + np.arange(len(texts))
        data = np.zeros(len(plain) + len(texts) + 16, dtype=np.uint8)
        data[np.arange(len(plain)) + np.repeat(np.arange(len(texts)), np.diff(offsets))] = plain
        data[(data >= ord("A")) & (data <= ord("Z"))] |= 0x20
        begin, end = pointers(data)
        doc = np.searchsorted(ends, begin)
        group = of_doc[doc]
        for g, (lang, source) in enumerate(names):
            own = np.flatnonzero(group == g)
            if not len(own):
                continue
            order, runs = sorted_runs(data, begin[own], end[own])
            which = doc[own][order]
            docs = np.add.reduceat(np.r_[True, which[1:] != which[:-1]] | np.isin(np.arange(len(order)), runs, assume_unique=True), runs)
            n = np.diff(np.r_[runs, len(order)])
            first = own[order[runs]]
            sizes = end[first] - begin[first]
            at_ = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin[first], sizes)
            terms = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int32).tobytes()), pa.py_buffer(data[at_].tobytes())])
            same = lambda v, k=len(first): pa.array([v], pa.string()).take(pa.array(np.zeros(k, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays([same(lang), same(source), terms, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])


def share(count: Column | str, n: Column | str, v: Column | str) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (n + PRIOR * v)), exactly; 0 where the language keeps no term."""
    c, total = (F.col(x) if isinstance(x, str) else x for x in (count, n))
    total = total + PRIOR * (F.col(v) if isinstance(v, str) else v)
    wide = F.lit(SCALE).cast("decimal(10,0)") * (c + PRIOR).cast("decimal(20,0)")
    return F.when(total > 0, 1 + F.call_function("div", wide, total.cast("decimal(20,0)"))).otherwise(F.lit(0).cast("long"))


def pairs_of(left: pa.Table, right: pa.Table) -> pa.Table:
    """lang, source, item, value: for all pairs of sources, the differences of their shares summed over the terms of one
    shard. left: source, term, p where a source has the term; right: each source's p of terms that it has not."""
    if not right.num_rows:
        return pa.table({"lang": pa.array([], pa.string()), "source": pa.array([], pa.string()), "item": pa.array([], pa.string()), "value": pa.array([], pa.int64())})
    right = right.sort_by("source")
    names, none = right["source"].to_pylist(), right["p0"].to_numpy()
    sums = np.zeros((len(names), len(names)), dtype=np.int64)
    if left.num_rows:
        term = left["term"].combine_chunks().dictionary_encode().indices.to_numpy()
        source = pc.index_in(left["source"], value_set=right["source"].combine_chunks()).to_numpy()
        p = left["p"].to_numpy()
        order = np.argsort(term, kind="stable")
        term, source, p = term[order], source[order], p[order]
        wide = max(1, CELLS // len(names))
        for start in range(0, int(term[-1]) + 1, wide):
            a, b = np.searchsorted(term, (start, start + wide))
            cells = np.tile(none, (min(wide, int(term[-1]) + 1 - start), 1))
            cells[term[a:b] - start, source[a:b]] = p[a:b]
            for k in range(len(names)):
                sums[k] += np.abs(cells - cells[:, [k]]).sum(axis=0)
    mine, other = np.nonzero(~np.eye(len(names), dtype=bool))
    lang = right["lang"][0].as_py()
    take = lambda at: pa.array(names, pa.string()).take(pa.array(at))
    return pa.table({"lang": pa.array([lang] * len(mine), pa.string()), "source": take(mine), "item": take(other), "value": pa.array(sums[mine, other], pa.int64())})


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank. Part pair: how far a source is from each other one of its language, the
    differences of all kept terms' shares summed; part term: the top terms whose share in the source is above that in the
    language. Shares are smoothed counts in billionths.

    Terms are kept by language if so many of its rows have them. Null texts, languages and sources count as empty ones,
    which are a language and a source like others; a language with one source has no pairs, one without kept terms pairs of
    value 0; rows repeated count as often as they stand, whatever their ids; texts and words may have any length; other
    columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "divergence")
    plain = docs.select(*[or_empty(c).alias(c) for c in ("lang", "source", "text")])
    # Each slice sends a term once for each source, so that words however frequent make few rows; the terms of a language
    # stay together for both sums.
    slices = plain.mapInArrow(counted, COUNTED).repartition("lang", "term")
    of_term = Window.partitionBy("lang", "term")
    sums = slices.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    sums = sums.withColumns({"in_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term), "first": F.col("source") == F.min("source").over(of_term)})
    kept = scratch.keep(sums.filter(F.col("in_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n", "first"), "kept")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("first").alias("v"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = plain.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    # A row for each source: kept as a table, so that its size is known where it is joined.
    groups = scratch.keep(groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "lang_total", "v")]), "groups")

    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "v"))
    above = shares.withColumn("value", F.col("p") - share("lang_n", "lang_total", "v")).filter("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    of_source = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = above.withColumn("rank", F.row_number().over(of_source)).filter(F.col("rank") <= top)

    n_shards = max(1, math.ceil(kept.count() / SHARD_ROWS))
    left = shares.select("lang", F.pmod(F.xxhash64("term"), F.lit(n_shards)).alias("shard"), "source", "term", "p")
    none = share(F.lit(0).cast("long"), "total", "v")
    right = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("shard"), "source", none.alias("p0"))
    parts = left.groupBy("lang", "shard").cogroup(right.groupBy("lang", "shard")).applyInArrow(pairs_of, "lang string, source string, item string, value long")
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(of_source))
    return pairs.unionByName(terms)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT r, lang, source, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM d) w
), vocabulary AS (
  SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), groups AS (
  SELECT DISTINCT lang, source FROM d
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term
), cells AS (
  SELECT g.lang, g.source, v.term, v.lang_n, coalesce(c.n, 0) AS n
  FROM groups g JOIN vocabulary v USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term
), sums AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, count(*) OVER (PARTITION BY lang, source) AS v, sum(lang_n) OVER (PARTITION BY lang, source) AS lang_total FROM cells
), shares AS (
  SELECT lang, source, term, n, CAST(1 + 1000000000::HUGEINT * (n + 5) // (total + 5 * v) AS BIGINT) AS p,
         CAST(1 + 1000000000::HUGEINT * (lang_n + 5) // (lang_total + 5 * v) AS BIGINT) AS q
  FROM sums
), differences AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN differences d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) u) x
WHERE part = 'pair' OR rank <= 50
"""
