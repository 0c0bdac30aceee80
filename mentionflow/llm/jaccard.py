"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of five-word shingles; two are linked if their Jaccard similarity is 0.8 or more. Copies (the
same words) are one node. Every node gets a MinHash signature; nodes that agree in a band of it meet in a
bucket. Nodes are numbered at random, and the smallest number among all nodes that a node meets is its home; a
ball is the nodes of one home (its core) and all that these meet (its shell). So each node counts its links in one
ball, and a group of near copies is a few balls, however many buckets its nodes share. Balls are compared in
a task each, many small ones in one: signatures are compared a few values at a time, a pair is dropped once
the posterior probability of its similarity reaching the threshold is below the tolerance, and what is left
is verified on the shingles themselves.

A ball too large for a task is first compared with a centre, in as many tasks as it needs. The centre P is the
set of shingles that most of a few of its texts have; any set would do. From P a text x has lost r and gained
a shingles. Texts x and y share |P| - r_x - r_y + s shingles, where s is what both lost and both gained, so they
are linked if num (a_x + a_y) + den (r_x + r_y) - (den - num) |P| is at most (num + den) s, for a threshold of
num / den. With w = num a + den r, all pairs whose w add up to (den - num) |P| at most are linked whatever s is,
and counted from a histogram of w: near copies close to their centre are never paired. Only nodes that this leaves
undecided go on, to pairs of blocks, and there only undecided pairs are looked at. Tasks return links per node
and a spanning forest, never pairs.

With 32 bands of 4 values, a pair at the threshold shares no band with probability 5e-8; the tolerance is 1e-9.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BLANKS, Scratch, first_of_each, key_of, or_empty, smaller, table

WORDS, THRESHOLD, TOLERANCE = 5, "0.8", 1e-9
BANDS, BAND_ROWS, STEP = 32, 4, 32
HASHES = BANDS * BAND_ROWS
#: Texts and words of a ball that one task compares, and of a block of a larger one; words that one vectorised step
#: hashes; words remembered.
BALL_DOCS, BALL_WORDS, BLOCK_DOCS, BLOCK_WORDS, STEP_WORDS, KNOWN_WORDS = 600, 600_000, 2000, 600_000, 100_000, 400_000
#: Texts of a ball that its centre is made of.
CENTRE_TEXTS = 15

_rng = np.random.default_rng(20240131)
ODD = (_rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32) | np.uint32(1)
ADD = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)
PLACE = _rng.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
NONE = np.uint32(0xFFFFFFFF)


class WordHash(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[str], known: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the shingles of each text one after another, repeated ones too. A text of fewer words than a
    shingle has is one shingle; one without words has none. Words are separated by single blanks."""
    words = [t.split(" ") if t else [] for t in texts]
    n = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter((known[w] for ws in words for w in ws), np.uint64, int(n.sum()))
    starts = np.cumsum(n) - n
    many = np.maximum(n - WORDS + 1, (n > 0).astype(np.int64))
    ends = np.cumsum(many)
    begin = np.arange(int(many.sum())) - np.repeat(ends - many - starts, many)
    length = np.repeat(np.minimum(n, WORDS), many)
    h = np.zeros(len(begin), np.uint64)
    for j in range(WORDS):
        inside = length > j
        part = flat[np.minimum(begin + j, max(len(flat) - 1, 0))] * PLACE[j] if len(flat) else h
        h += part if inside.all() else np.where(inside, part, np.uint64(0))
    return scrambled(h + length.astype(np.uint64)), ends


def signatures(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """MinHash values, a row per text; all ones for a text without shingles."""
    out = np.full((len(ends), HASHES), NONE, np.uint32)
    starts = np.r_[0, ends[:-1]]
    some = np.flatnonzero(ends > starts)
    if not len(some):
        return out
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    at = starts[some]
    for k in range(HASHES):
        out[some, k] = np.minimum.reduceat(x * ODD[k] + ADD[k], at)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A key for each band of each signature; keys of different bands differ."""
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signature), 1))
    for j in range(BAND_ROWS):
        key = scrambled(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key.view(np.int64)


def slices(texts: list[str]):
    """(from, to) of texts of about STEP_WORDS words together."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += t.count(" ") + 1
        if size >= STEP_WORDS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


SIGNED = "rid long, doc_id long, h1 long, h2 long, text string, words long, bands array<long>"


def signed(batches):
    known, n = WordHash(), TaskContext.get().partitionId() << 40
    for batch in smaller(batches):
        texts = batch["text"].to_pylist()
        for a, b in slices(texts):
            hashes, ends = shingles(texts[a:b], known)
            keys = bands(signatures(hashes, ends))
            words = np.diff(np.r_[0, ends])
            some = words > 0
            # A text without words is in no bucket.
            offsets = np.r_[0, np.cumsum(np.where(some, BANDS, 0))].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].ravel()))
            rids = pa.array(scrambled(np.arange(n, n + b - a).astype(np.uint64)).view(np.int64))  # different, and in no order
            n += b - a
            yield pa.RecordBatch.from_arrays([rids, *(batch[c].slice(a, b - a) for c in ("doc_id", "h1", "h2", "text")), pa.array(words), lists], ["rid", "doc_id", "h1", "h2", "text", "words", "bands"])


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For 1 .. HASHES / STEP steps: the fewest equal values with which a pair is kept, under a uniform prior."""
    least = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            # The posterior is Beta(m + 1, n - m + 1); its upper tail is a binomial sum.
            tail = sum(math.comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))
            if tail >= tolerance:
                least.append(m)
                break
    return least


class Unit:
    """The texts of one task, and what is found among them."""

    def __init__(self, nodes: np.ndarray, texts: list[str], threshold: str, tolerance: float):
        known = WordHash()
        self.nodes = nodes
        parts, sizes, signs = [], [], []
        for a, b in slices(texts):
            hashes, ends = shingles(texts[a:b], known)
            signs.append(signatures(hashes, ends))
            for s, e in zip(np.r_[0, ends[:-1]], ends, strict=True):
                parts.append(np.unique(hashes[s:e]))
                sizes.append(len(parts[-1]))
        self.signature = np.concatenate(signs)
        self.keys = bands(self.signature)
        self.size = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.size)
        _, self.tokens = np.unique(np.concatenate(parts), return_inverse=True)
        self.mark = np.zeros(int(self.tokens.max(initial=0)) + 1, bool)
        self.links = np.zeros(len(nodes), np.int64)
        self.parent = list(range(len(nodes)))
        self.num, self.den = ratio(threshold)
        self.least = least_matches(self.num / self.den, tolerance)

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def set_of(self, x: int) -> np.ndarray:
        return self.tokens[self.ends[x] - self.size[x] : self.ends[x]]

    def linked(self, x: int, others: np.ndarray) -> np.ndarray:
        """Those of others that are linked to x."""
        small, large = np.minimum(self.size[others], self.size[x]), np.maximum(self.size[others], self.size[x])
        others = others[small * self.den >= large * self.num]
        others = others[(self.keys[others] == self.keys[x]).any(axis=1)]
        same = np.zeros(len(others), np.int64)
        for k, least in enumerate(self.least):
            if not len(others):
                return others
            part = slice(k * STEP, (k + 1) * STEP)
            same = same + (self.signature[others, part] == self.signature[x, part]).sum(axis=1)
            keep = same >= least
            others, same = others[keep], same[keep]
        if not len(others):
            return others
        own = self.set_of(x)
        self.mark[own] = True
        n = self.size[others]
        hits = self.mark[np.concatenate([self.set_of(y) for y in others.tolist()])]
        shared = np.add.reduceat(hits.astype(np.int64), np.cumsum(n) - n)
        self.mark[own] = False
        return others[shared * self.den >= (n + self.size[x] - shared) * self.num]

    def ball(self, at: np.ndarray, core: np.ndarray, block: np.ndarray, w: np.ndarray, limit: int) -> None:
        """Links of the core of a ball with all of it, or with those of the other block if there are two. Pairs whose w
        add up to no more than limit are counted already."""
        order = np.lexsort((~core, block))  # a node comes after those whose pairs with it are its own to count
        at, core, block, w = at[order], core[order], block[order], w[order]
        second = int(np.searchsorted(block, block[-1])) if block[0] != block[-1] else 0
        for k in range(second if second else len(at)):
            others = np.arange(second if second else k + 1, len(at))
            if not core[k]:
                others = others[core[others]]
            others = others[w[others] + w[k] > limit]
            if not len(others):
                continue
            x, hits = int(at[k]), np.zeros(len(self.nodes), bool)
            hits[self.linked(x, at[others])] = True
            others = others[hits[at[others]]]
            if core[k]:
                self.links[x] += len(others)
            self.links[at[others[core[others]]]] += 1
            for y in at[others].tolist():
                a, b = self.find(x), self.find(y)
                if a != b:
                    self.parent[max(a, b)] = min(a, b)


def ratio(threshold: str) -> tuple[int, int]:
    t = Fraction(threshold)
    return t.numerator, t.denominator


FOUND = "node long, root long, links long"
DELTA = "home long, node long, core boolean, words long, w long, top long"


def verifier(threshold: str, tolerance: float):
    def verify(t: pa.Table) -> pa.Table:
        nodes, first, index = np.unique(t["node"].to_numpy(), return_index=True, return_inverse=True)
        texts = t["text"].take(pa.array(first)).to_pylist()
        unit = Unit(nodes, texts, threshold, tolerance)
        home, core, i, j, block, w, top = (t[c].to_numpy() for c in ("home", "core", "i", "j", "block", "w", "top"))
        rows = np.lexsort((nodes[index], j, i, home))
        new = (np.diff(home[rows]) != 0) | (np.diff(i[rows]) != 0) | (np.diff(j[rows]) != 0)
        for part in np.split(rows, np.flatnonzero(new) + 1):
            if i[part[0]] == j[part[0]] or len(np.unique(block[part])) > 1:
                unit.ball(index[part], core[part], block[part], w[part], int(top[part[0]]))
        roots = np.array([unit.find(x) for x in range(len(nodes))])
        some = np.flatnonzero((unit.links > 0) | (roots != np.arange(len(nodes))))
        return pa.table({"node": pa.array(nodes[some], pa.int64()), "root": pa.array(nodes[roots[some]], pa.int64()), "links": pa.array(unit.links[some], pa.int64())})

    return verify


def measurer(threshold: str):
    """What each node of a part of a large ball has lost and gained from the centre, which all parts make of the same texts
    (extra)."""
    num, den = ratio(threshold)

    def measure(t: pa.Table) -> pa.Table:
        known = WordHash()
        node, core, extra = (t[c].to_numpy() for c in ("node", "core", "extra"))
        order = np.r_[np.flatnonzero(extra), np.flatnonzero(~extra)]
        sample, n = int(extra.sum()), int((~extra).sum())
        texts = t["text"].take(pa.array(order)).to_pylist()
        hashes, ends = shingles(texts[:sample], known)
        each = [np.unique(hashes[s:e]) for s, e in zip(np.r_[0, ends[:-1]], ends, strict=True)]
        values, times = np.unique(np.concatenate(each), return_counts=True)
        centre = values[times * 2 > sample]
        w, words = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for a, b in slices(texts[sample:]):
            hashes, ends = shingles(texts[sample + a : sample + b], known)
            for k, (s, e) in enumerate(zip(np.r_[0, ends[:-1]], ends, strict=True), a):
                own = np.unique(hashes[s:e])
                shared = int((centre[np.minimum(np.searchsorted(centre, own), len(centre) - 1)] == own).sum()) if len(centre) else 0
                w[k], words[k] = num * (len(own) - shared) + den * (len(centre) - shared), e - s
        at = order[sample:]
        return pa.table(
            {"home": t["home"].take(pa.array(at)), "node": pa.array(node[at], pa.int64()), "core": pa.array(core[at], pa.bool_()), "words": pa.array(words, pa.int64()), "w": pa.array(w, pa.int64()), "top": pa.array([(den - num) * len(centre)] * n, pa.int64())}
        )

    return measure


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label) of every node of edges (u, v): equal labels within a connected component.

    Each round every node joins its smallest neighbour, in an order of the nodes that changes from round to round, and
    what was joined is one node of the next round; the edges that are left shrink by a factor each time.
    """
    edges = scratch.keep(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), f"{name}-edges0")
    steps: list[DataFrame] = []
    rng = np.random.default_rng(11)
    while not edges.isEmpty():
        mask = F.lit(int(rng.integers(0, 2**62)))
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min(F.col("v").bitwiseXOR(mask)).alias("m"))
        joined = near.select("u", F.least(F.col("m"), F.col("u").bitwiseXOR(mask)).bitwiseXOR(mask).alias("m"))
        k = len(steps)
        steps.append(scratch.keep(joined, f"{name}-joined{k}"))
        left, right = steps[k].select("u", F.col("m").alias("mu")), steps[k].select(F.col("u").alias("v"), F.col("m").alias("mv"))
        moved = edges.join(left, "u").join(right, "v").filter("mu <> mv").select(F.least("mu", "mv").alias("u"), F.greatest("mu", "mv").alias("v")).distinct()
        edges = scratch.keep(moved, f"{name}-edges{k + 1}")
        scratch.drop(f"{name}-edges{k}")
    if not steps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    labels = steps[0].select(F.col("u").alias("node"), F.col("m").alias("label"))
    for step in steps[1:]:
        labels = labels.join(step.select(F.col("u").alias("label"), "m"), "label", "left").select("node", F.coalesce("m", "label").alias("label"))
    return scratch.keep(labels, f"{name}-labels")


def prepared(docs: DataFrame) -> DataFrame:
    text = F.trim(F.regexp_replace(or_empty("text"), BLANKS, " "))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).select("doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2"))


def buckets_of(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """b, low, node, words: the buckets of two nodes or more, low the smallest node there. nodes: node, words, bands."""
    keyed = scratch.keep(nodes.select("node", "words", F.explode("bands").alias("b")), "keyed")
    shared = keyed.groupBy("b").agg(F.min("node").alias("low"), F.count("*").alias("n")).filter("n > 1").select("b", "low")
    return keyed.join(shared, "b")


def balls(buckets: DataFrame, scratch: Scratch) -> DataFrame:
    """home, node, core, words: the nodes of each ball. buckets: as buckets_of gives them."""
    at_home = F.min("low").over(Window.partitionBy("node"))
    placed = scratch.keep(buckets.select("b", "node", "words", at_home.alias("home")), "placed")
    # Few homes meet in a bucket, as a home has the smallest number of all that its core meets.
    homes = placed.groupBy("b").agg(F.collect_set("home").alias("homes"))
    around = placed.join(homes, "b").groupBy("node").agg(F.array_distinct(F.flatten(F.collect_set("homes"))).alias("homes"), F.min("home").alias("own"), F.max("words").alias("words"))
    found = around.select(F.explode("homes").alias("home"), "node", "own", "words").select("home", "node", (F.col("home") == F.col("own")).alias("core"), "words")
    found = scratch.keep(found, "balls")
    scratch.drop("placed")
    return found


def in_parts(n: Column, words: Column, most: int, most_words: int) -> Column:
    return F.greatest(F.ceil(n / most), F.ceil(words / most_words), F.lit(1)).cast("int")


def sent(texts: DataFrame, places: DataFrame, columns: list[str]) -> DataFrame:
    """places (node and columns) with the text of each node. A text moves once, whatever the number of its places."""
    wanted = places.groupBy("node").agg(F.collect_list(F.struct(*columns)).alias("at"))
    return texts.join(wanted.hint("merge"), "node").select("node", "text", F.inline("at"))


def links_of(texts: DataFrame, near: DataFrame, scratch: Scratch, threshold: str, tolerance: float, ball: tuple[int, int], block: tuple[int, int]) -> DataFrame:
    """node, root, links: parts of each node's number of links, and edges that join all that links join."""
    sizes = near.groupBy("home").agg(F.count("*").alias("docs"), F.sum("words").alias("words"))
    large = sizes.filter((F.col("docs") > ball[0]) | (F.col("words") > ball[1]))
    large = scratch.keep(large.select("home", in_parts(F.col("docs"), F.col("words"), *ball).alias("parts")), "large")
    small = near.join(large.select("home"), "home", "left_anti")
    total = small.agg(F.count("*").alias("docs"), F.sum("words").alias("words")).first()
    n = max(1, -(-total["docs"] // ball[0]), -(-(total["words"] or 0) // ball[1]))
    none = [F.lit(0).alias(c) for c in ("i", "j", "block")]
    whole = [F.lit(0).cast("long").alias("w"), F.lit(-1).cast("long").alias("top")]
    columns = ["unit", "home", "core", "i", "j", "block", "w", "top"]
    places = small.select(F.pmod(F.xxhash64("home"), F.lit(n)).alias("unit"), "node", "home", "core", *none, *whole)
    verify = verifier(threshold, tolerance)
    found = scratch.keep(sent(texts, places, columns).groupBy("unit").applyInArrow(verify, FOUND), "found")
    if large.isEmpty():
        return found

    # Large balls: everything is measured from the centre, in parts that all have the texts it is made of.
    inside = near.join(large, "home")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")
    nth = F.row_number().over(Window.partitionBy("home").orderBy("node"))  # node numbers are in no order: any few nodes
    first = inside.withColumn("nth", nth).filter(F.col("nth") <= CENTRE_TEXTS).select("node", "home", F.lit(False).alias("core"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("extra"))
    places = inside.select("node", "home", "core", part, F.lit(False).alias("extra")).unionByName(first)
    deltas = scratch.keep(sent(texts, places, ["home", "core", "part", "extra"]).groupBy("home", "part").applyInArrow(measurer(threshold), DELTA), "deltas")
    counts = deltas.groupBy("home", "w").agg(F.count("*").alias("n"), F.max("top").alias("top"))
    asked = counts.select("home", (F.col("top") - F.col("w")).alias("at"), F.lit(1).alias("later"), F.lit(0).cast("long").alias("n"), "w")
    marks = counts.select("home", F.col("w").alias("at"), F.lit(0).alias("later"), "n", F.lit(None).cast("long").alias("w")).unionByName(asked)
    upto = marks.withColumn("n", F.sum("n").over(Window.partitionBy("home").orderBy("at", "later").rowsBetween(Window.unboundedPreceding, 0))).filter("later = 1")
    ends = deltas.groupBy("home").agg(F.max("w").alias("far"), F.min(F.struct("w", "node")).alias("next"))
    upto = upto.join(ends, "home").select("home", "w", F.col("n").alias("close"), "far", F.col("next.w").alias("least"), F.col("next.node").alias("nearest"))
    marked = scratch.keep(deltas.join(upto, ["home", "w"]), "marked")
    # Whatever has such a link is linked to the node nearest to the centre.
    itself = F.when(F.col("w") * 2 <= F.col("top"), 1).otherwise(0)
    direct = marked.filter(F.col("w") + F.col("least") <= F.col("top")).select("node", F.col("nearest").alias("root"), F.when(F.col("core"), F.col("close") - itself).otherwise(0).cast("long").alias("links"))

    # Only nodes with undecided pairs go on.
    open_ = marked.filter(F.col("w") + F.col("far") > F.col("top"))
    blocks = open_.groupBy("home").agg(in_parts(F.count("*"), F.sum("words"), *block).alias("blocks"))
    split = open_.join(blocks, "home").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    places = split.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).select(F.xxhash64("home", "i", "j").alias("unit"), "node", *columns[1:])
    rest = scratch.keep(sent(texts, places, columns).groupBy("unit").applyInArrow(verify, FOUND), "rest")
    return found.unionByName(direct).unionByName(rest)


def similar_documents(docs: DataFrame, threshold: str = THRESHOLD, tolerance: float = TOLERANCE, ball: tuple[int, int] = (BALL_DOCS, BALL_WORDS), block: tuple[int, int] = (BLOCK_DOCS, BLOCK_WORDS)) -> DataFrame:
    """doc_id, class_id, n_links, copy_id, n_copies and h1, a row per row of docs.

    class_id: smallest id of the documents joined to it by links. n_links: other texts with a similarity of threshold or
    more; texts of the same words are copies (n_copies, itself too, smallest id copy_id) and count as one. Texts of
    fewer than five words are one shingle; null and blank texts are copies of each other and link to nothing. Null
    ids are never the smallest if there is another; other columns are ignored, whatever their names. ball, block: texts
    and words that a task takes on at once; they don't change the result.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    each = scratch.keep(prepared(docs).mapInArrow(signed, SIGNED), "signed")
    reps = each.groupBy("h1", "h2").agg(F.min("rid").alias("node"), F.min("doc_id").alias("copy_id"), F.count("*").alias("n_copies"), F.max("words").alias("words"))
    reps = scratch.keep(reps, "reps")
    nodes = each.join(reps.select(F.col("node").alias("rid")), "rid").select(F.col("rid").alias("node"), "words", "bands")
    near = balls(buckets_of(nodes, scratch), scratch)
    scratch.drop("keyed")
    # All texts move once, in a merge join: at some size they would be shuffled anyway, and the plan should be the same at
    # every size. What moves after that are the texts of balls only.
    texts = each.select(F.col("rid").alias("node"), "text").join(near.select("node").distinct().hint("merge"), "node")
    texts = scratch.keep(texts, "texts")
    found = links_of(texts, near, scratch, threshold, tolerance, ball, block)
    linked = components(found.select(F.col("root").alias("u"), F.col("node").alias("v")), scratch, "linked")
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    placed = reps.join(linked, "node", "left").join(links, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = placed.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    classes = scratch.keep(placed.join(lowest, "label").select("h1", "h2", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "copy_id", "n_copies"), "classes")
    ids = scratch.keep(each.select("doc_id", "h1", "h2"), "ids")
    scratch.only("ids", "classes")
    return ids.join(classes, ["h1", "h2"]).select("doc_id", "class_id", "n_links", "copy_id", "n_copies", "h1")


def one_of_each_class(docs: DataFrame) -> DataFrame:
    """The rows of docs with their class's smallest id; of rows repeated with one id, one stays."""
    kept = similar_documents(docs).filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(key_of("doc_id", "h1").alias("key")).distinct()
    return first_of_each(docs, kept, key_of("doc_id", F.xxhash64(F.trim(F.regexp_replace(or_empty("text"), BLANKS, " ")))))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "copy_id", "n_copies")
