"""Periodic run detection on grammar-compressed word ids.

The word ids of a text are compressed by Re-Pair: the most frequent pairs become nonterminals, round after round, until no
pair occurs twice; what is left is halved into a balanced tree, so that every place between two words is the boundary of
one nonterminal. For each nonterminal the runs that cross its boundary are computed once, within its expansion; they are
translated to all places where it is derived, and intervals of one period that belong together are merged. A run of the
text crosses the boundary of the lowest nonterminal that holds it, so the longest of merged intervals is the run.

A task compresses the texts of a batch side by side (their ids are kept apart, so that each has its own grammar).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, or_empty, smaller, table

LEAST_WORDS, LEAST_TIMES = 24, 3
#: Candidates (a boundary and a period) that are looked at together.
AT_ONCE = 2_000_000
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def word_ids(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, those of different texts different, and where each text begins."""
    ids: list[int] = []
    starts, base = [0], 0
    for words in texts:
        own: dict[bytes, int] = {}
        ids.extend([own.setdefault(w, base + len(own)) for w in words])
        base += len(own)
        starts.append(len(ids))
    return np.array(ids, dtype=np.int64), np.array(starts, dtype=np.int64)


class Grammar:
    """left, right, length and first place of each nonterminal; symbols below n_words are words. top: what is left of the
    texts, with the place of each symbol."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray):
        self.n_words = int(ids.max(initial=-1)) + 1
        self.top, self.at, self.text = ids, np.arange(len(ids)), np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        self.done: list[tuple[np.ndarray, np.ndarray]] = []  # of texts in which no pair occurs twice
        self.size = np.ones(self.n_words, dtype=np.int64)  # of words, then of nonterminals
        self.left, self.right, self.first = [], [], []
        while self.round():
            pass
        self.done.append((self.top, self.at))
        self.top, self.at = (np.concatenate(x) for x in zip(*self.done, strict=True))
        order = np.argsort(self.at, kind="stable")
        self.top, self.at = self.top[order], self.at[order]
        parts = [np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (self.left, self.right, self.first)]
        self.left, self.right, self.first = parts

    def round(self) -> bool:
        """Replaces, side by side, all occurrences of pairs that are more frequent than the pairs they overlap with."""
        s = self.top
        if len(s) < 2:
            return False
        _, code = np.unique(s[:-1] * (int(s.max()) + 1) + s[1:], return_inverse=True)
        place = np.arange(len(code))
        # In a stretch of one word again and again, every second pair counts: the others overlap with it.
        begins = np.r_[True, code[1:] != code[:-1]]
        even = (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0
        count = np.bincount(code[even])
        rank = np.where(count > 1, count * len(count) + np.arange(len(count)), 0)[code]
        before, after = np.r_[0, rank[:-1]], np.r_[rank[1:], 0]
        chosen = np.flatnonzero((rank > 0) & even & (rank >= before) & (rank >= after))
        if not len(chosen):
            return False
        pairs, where, to = np.unique(code[chosen], return_index=True, return_inverse=True)
        where = chosen[where]
        self.left.append(s[where])
        self.right.append(s[where + 1])
        self.first.append(self.at[where])
        new = len(self.size) + to
        self.size = np.r_[self.size, self.size[s[where]] + self.size[s[where + 1]]]
        top = s.copy()
        top[chosen] = new
        keep = np.ones(len(s), dtype=bool)
        keep[chosen + 1] = False
        live = np.zeros(self.text[-1] + 1, dtype=bool)
        live[self.text[chosen]] = True
        live = live[self.text]
        ended = keep & ~live
        self.done.append((top[ended], self.at[ended]))
        keep &= live
        self.top, self.at, self.text = top[keep], self.at[keep], self.text[keep]
        return True


def halved(places: np.ndarray, first: np.ndarray, end: np.ndarray, least: int):
    """(start, boundary, end) in words of the nodes of balanced trees over symbols first..end-1, which begin at places (one
    more than there are symbols), as far as they have least words."""
    nodes = []
    while True:
        long = (end - first > 1) & (places[end] - places[first] >= least)
        first, end = first[long], end[long]
        if not len(first):
            break
        lo, hi = places[first], places[end]
        middle = np.clip(np.searchsorted(places, (lo + hi) // 2), first + 1, end - 1)
        nodes.append(np.stack([lo, places[middle], hi]))
        first, end = np.r_[first, middle], np.r_[middle, end]
    return np.concatenate([np.zeros((3, 0), dtype=np.int64), *nodes], axis=1)


def candidates(w: np.ndarray, nodes: np.ndarray, least: int, times: int):
    """(node, period, side) worth a closer look. A run of period q that crosses the boundary c has half of its max(least,
    times * q) words or more on one side of it: there, so many words less q equal those q further on."""
    lo, c, hi = nodes
    half = lambda q: np.maximum(-(-least // 2), -(-times * q // 2))
    out = []
    for side, room in ((1, hi - c), (-1, c - lo)):
        most = np.minimum((hi - lo) // times, 2 * room // times)
        most[(room < half(np.int64(1))) | (hi - lo < least)] = 0
        ends = np.cumsum(most)
        start = 0
        while start < len(most):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + AT_ONCE, side="right")))
            node = np.repeat(np.arange(start, stop), most[start:stop])
            q = np.arange(len(node)) - np.repeat(ends[start:stop] - most[start:stop] - base, most[start:stop]) + 1
            need = half(q) - q
            ok = half(q) <= room[node]
            node, q, need = node[ok], q[ok], need[ok]
            at = c[node] if side > 0 else c[node] - 1
            for k in range(12):  # most go with the first words
                same = (k >= need) | (w[np.clip(at + side * k, 0, len(w) - 1)] == w[np.clip(at + side * (q + k), 0, len(w) - 1)])
                node, q, need, at = node[same], q[same], need[same], at[same]
                if not len(node):
                    break
            out.append(np.stack([node, q, np.full(len(node), side)]))
            start = stop
    found = np.concatenate([np.zeros((3, 0), dtype=np.int64), *out], axis=1)
    return found[:, np.lexsort((found[1], found[0]))]


def same_after(w: np.ndarray, at: int, q: int, end: int) -> int:
    """How many words from at on equal those q further on, which stand before end."""
    n, step = 0, 64
    while at + q + n < end:
        m = min(step, end - q - at - n)
        differ = np.flatnonzero(w[at + n : at + n + m] != w[at + q + n : at + q + n + m])
        if len(differ):
            return n + int(differ[0])
        n, step = n + m, step * 4
    return n


def same_before(w: np.ndarray, at: int, q: int, start: int) -> int:
    """How many words before at equal those q further on, down to start."""
    n, step = 0, 64
    while at - n > start:
        m = min(step, at - n - start)
        differ = np.flatnonzero(w[at - n - m : at - n] != w[at + q - n - m : at + q - n])
        if len(differ):
            return n + m - 1 - int(differ[-1])
        n, step = n + m, step * 4
    return n


def crossing(w: np.ndarray, nodes: np.ndarray, least: int, times: int) -> dict[int, list[tuple[int, int, int]]]:
    """By node, the runs (start, end, period) within it that cross its boundary. An interval may come up with its smallest
    period and with multiples of it: within one node they share start and end, and the smallest comes first and stays.
    Later, among intervals cut by different nodes, a multiple could no longer be told from a run."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    cands = candidates(w, nodes, least, times)
    cuts = np.flatnonzero(np.r_[True, cands[0, 1:] != cands[0, :-1]]) if cands.shape[1] else []
    for k, begin in enumerate(cuts):
        end = cuts[k + 1] if k + 1 < len(cuts) else cands.shape[1]
        node, qs, sides = int(cands[0, begin]), cands[1, begin:end], cands[2, begin:end]
        lo, c, hi = (int(x) for x in nodes[:, node])
        own: dict[tuple[int, int], int] = {}
        while len(qs):
            q, side = int(qs[0]), int(sides[0])
            qs, sides = qs[1:], sides[1:]
            at = c if side > 0 else c - q
            start, stop = at - same_before(w, at, q, lo), at + q + same_after(w, at, q, hi)
            if not (start < c < stop and stop - start >= max(least, times * q)):
                continue
            own.setdefault((start, stop), q)
            # What this run explains: multiples of its period, whose words looked at lie within it.
            reach = np.maximum(-(-least // 2), -(-times * qs // 2))
            within = np.where(sides > 0, (c >= start) & (c + reach <= stop), (c <= stop) & (c - reach >= start))
            other = (qs % q != 0) | ~within
            qs, sides = qs[other], sides[other]
        if own:
            found[node] = [(start, stop, q) for (start, stop), q in own.items()]
    return found


def merged(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, length, period) of the longest intervals: those of one period that share a period's words are one. Sorted
    by start and period."""
    whole: list[list[int]] = []
    for start, end, q in sorted(set(runs), key=lambda r: (r[2], r[0], -r[1])):
        if whole and whole[-1][2] == q and start <= whole[-1][1] - q:
            whole[-1][1] = max(whole[-1][1], end)
        else:
            whole.append([start, end, q])
    return sorted(((s, e - s, q) for s, e, q in whole), key=lambda r: (r[0], r[2]))


def text_runs(texts: list[list[bytes]], least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    long = [k for k, words in enumerate(texts) if len(words) >= least]
    if not long:
        return out
    ids, starts = word_ids([texts[k] for k in long])
    g = Grammar(ids, starts)
    size = g.size[g.n_words :]
    # Trees over what is left of each text; no pair of different texts is ever replaced, so symbols don't cross texts.
    places = np.r_[g.at, len(ids)]
    edges = np.searchsorted(places, starts)
    nodes = [halved(places, edges[:-1], edges[1:], least)]
    n_tree = nodes[0].shape[1]
    large = np.flatnonzero(size >= least)
    nodes.append(np.stack([g.first[large], g.first[large] + g.size[g.left[large]], g.first[large] + size[large]]))
    found = crossing(ids, np.concatenate(nodes, axis=1), least, times)

    # Where nonterminals with runs are derived: in what is left, and in other nonterminals, whose right part comes after the left.
    wanted = {int(large[k - n_tree]) + g.n_words for k in found if k >= n_tree}
    derived = derivations(g, wanted)
    every: list[list[tuple[int, int, int]]] = [[] for _ in long]
    of = lambda place: int(np.searchsorted(starts, place, side="right")) - 1
    for k, runs in found.items():
        if k < n_tree:
            every[of(runs[0][0])] += runs
            continue
        symbol = int(large[k - n_tree]) + g.n_words
        first = int(g.first[symbol - g.n_words])
        for place in derived[symbol]:
            every[of(place)] += [(s - first + place, e - first + place, q) for s, e, q in runs]
    for k, doc in enumerate(long):
        base = int(starts[k])
        out[doc] = [(s - base, n, q) for s, n, q in merged(every[k])]
    return out


def derivations(g: Grammar, wanted: set[int]) -> dict[int, list[int]]:
    """Every place of each wanted nonterminal in the texts. Only what derives one of them is followed."""
    if not wanted:
        return {}
    parents: dict[int, list[tuple[int, int]]] = {}
    needed, above = set(wanted), []
    for k in range(len(g.left)):  # a nonterminal comes after its parts
        for part, shift in ((int(g.left[k]), 0), (int(g.right[k]), int(g.size[g.left[k]]))):
            if part in needed:
                parents.setdefault(part, []).append((g.n_words + k, shift))
                needed.add(g.n_words + k)
    places: dict[int, list[int]] = {s: [] for s in needed}
    shown = np.flatnonzero(np.isin(g.top, list(needed)))
    for symbol, place in zip(g.top[shown].tolist(), g.at[shown].tolist(), strict=True):
        places[symbol].append(place)
    above = sorted(needed, reverse=True)
    for symbol in above:
        for parent, shift in parents.get(symbol, ()):
            places[symbol] += [p + shift for p in places[parent]]
    return {s: places[s] for s in wanted}


def word_runs(docs: DataFrame, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start and period) and collapsed (the words, joined by one
    blank, without what repeats a run's first period): a row per row of docs, in one pass without a shuffle.

    A run is a stretch of words of one smallest period, of least words and times periods at least, which no neighbouring
    word extends. Null and empty texts have no words and no runs; texts may have any length; ids may be null or repeat;
    other columns are ignored, whatever their names; an empty table gives no rows.
    """

    def found(batches):
        for batch in smaller(batches):
            texts = [t.as_buffer().to_pybytes().split() for t in batch["text"]]
            all_runs = text_runs(texts, least, times)
            flat = [r for runs in all_runs for r in runs]
            kept = []
            for words, runs in zip(texts, all_runs, strict=True):
                if runs:
                    stays = np.ones(len(words), dtype=bool)
                    for start, length, q in runs:
                        stays[start + q : start + length] = False
                    words = [words[k] for k in np.flatnonzero(stays).tolist()]
                kept.append(b" ".join(words))
            columns = [pa.array(c, pa.int64()) for c in (zip(*flat, strict=True) if flat else ((), (), ()))]
            offsets = pa.array(np.cumsum([0, *map(len, all_runs)]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=list(RUN)))
            n_words = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], n_words, lists, pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    schema = "doc_id long, n_words long, runs array<struct<start long, length long, period long>>, collapsed string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty("text").alias("text")).mapInArrow(found, schema)


def edited_text() -> Column:
    """The registered query's texts: of every tenth id by hash, the words from a place on are made periodic."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(or_empty("text"), BLANKS), lambda w: w != "")

    def periodic(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(at, " ")).otherwise("")

    changed = F.get(F.transform(F.array(words), periodic), F.lit(0))
    return F.when(h % 10 == 0, changed).otherwise(F.col("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = table(spark, sf_dir, "documents").select("doc_id", edited_text().alias("text"))
    rows = word_runs(edited)
    # The greatest exponent first, exactly: a / b < c / d where a * d < c * b.
    better = lambda x, y: x["length"] * y["period"] - y["length"] * x["period"]
    first = F.array_sort("runs", lambda x, y: F.when(better(x, y) > 0, -1).when(better(x, y) < 0, 1).when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1)).when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = F.get(first, F.lit(0))
    return rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )
