"""Katz backoff against a plain recursion over dictionaries."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mentionflow.llm import katz

from .conftest import NASTY


class ByHand:
    def __init__(self, texts, order):
        self.order, self.counts = order, {k: Counter() for k in range(1, order + 1)}
        for words in texts:
            whole = ["<s>"] * (order - 1) + words + ["</s>"]
            for at in range(order - 1, len(whole)):
                for k in range(1, order + 1):
                    self.counts[k][tuple(whole[at - k + 1 : at + 1])] += 1
        self.d, self.after = {}, {k: defaultdict(dict) for k in self.counts}
        for k, c in self.counts.items():
            n = Counter(c.values())
            self.d[k] = {}
            for r in range(1, 6):
                b = 6 * n[6] / n[1] if n[1] else 1
                d = ((r + 1) * n[r + 1] / (r * n[r]) - b) / (1 - b) if n[r] and n[r + 1] and b < 1 else 0
                self.d[k][r] = d if 0 < d < 1 else 1 - 0.5 / r
            for gram, x in c.items():
                self.after[k][gram[:-1]][gram[-1]] = x
        self.vocabulary = {g[0] for g in self.counts[1]}

    def p(self, w, ctx):
        k = len(ctx) + 1
        seen = self.after[k].get(ctx)
        if not seen:
            return self.p(w, ctx[1:]) if ctx else 1.0
        total = sum(seen.values())
        total += all(x > 5 for x in seen.values())
        star = lambda x: self.d[k].get(x, 1) * x / total
        if w in seen:
            return star(seen[w])
        left = 1 - sum(map(star, seen.values()))
        return left * self.p(w, ctx[1:]) / (1 - sum(self.p(v, ctx[1:]) for v in seen)) if ctx else left

    def score(self, words):
        whole = ["<s>"] * (self.order - 1) + words + ["</s>"]
        return sum(math.log10(self.p(whole[at], tuple(whole[at - self.order + 1 : at]))) for at in range(self.order - 1, len(whole)))


def words_of(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def some_rows(seed, n=60):
    rng = random.Random(seed)
    pick = lambda: rng.choice("aaaaaaaaabbbbbbcccd") if rng.random() < 0.8 else f"w{rng.randrange(40)}"
    return [(i, " ".join(pick() for _ in range(rng.randrange(0, 60)))) for i in range(n)]


@pytest.mark.parametrize(("order", "split"), [(2, 10**6), (2, 40), (3, 10**6), (3, 15), (1, 10)])
def test_scores_by_hand(spark, docs, monkeypatch, order, split):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(katz, "BUCKET_GRAMS", 200)
    rows = some_rows(order)
    got = {r.doc_id: r for r in katz.katz_scores(docs(rows).repartition(3), F.col("doc_id") % 4 != 1, order, split).collect()}
    train = [words_of(t) for i, t in rows if i % 4 != 1]
    hand = ByHand(train, order)
    counts, n = hand.counts[1], sum(hand.counts[1].values())
    assert set(got) == {i for i, _ in rows}
    for i, t in rows:
        tokens = [*words_of(t), "</s>"]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i % 4 == 1, len(tokens), sum((w,) in counts for w in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w,] + 1) / (n + len(counts) + 1)) for w in tokens))
        assert r.score == pytest.approx(hand.score(tokens[:-1]), rel=1e-9)
    # All words that may follow a context, the unknown one too, have probabilities that sum to 1.
    for ctx in [("<s>",) * (order - 1), *[("a", "b", "c")[: order - 1], ("d", "zzz")[: order - 1]]]:
        assert sum(hand.p(w, ctx) for w in [*hand.vocabulary, "<unknown>"]) == pytest.approx(1)


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    hand = ByHand([words_of(r.text) for r in rows if not held[r.doc_id]], katz.ORDER)
    got = {r.doc_id: r for r in katz.op12_katz_scores(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows[::7]:
        assert got[r.doc_id].held_out == held[r.doc_id] and got[r.doc_id].score == pytest.approx(hand.score(words_of(r.text)), rel=1e-9)
    better = lambda out: sum(r.score - r.base_score for r in got.values() if r.held_out == out)
    assert better(False) > 0 and better(True) > 0


def test_any_table(spark, nasty, docs):
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens) for r in katz.katz_scores(nasty, F.col("doc_id") > 1).collect())
    assert got == sorted((str(i), not (i or 0) > 1, len(words_of(t)) + 1) for i, t in NASTY)
    rows = katz.katz_scores(docs([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows} == {(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)}
    assert katz.katz_scores(docs([]), F.lit(True)).count() == 0


def test_packed_numbers():
    import numpy as np

    for values in ([], [0], [255], [256, 3], [70_000, 0, 5], [1 << 62, 1, 0]):
        assert katz.unpack(katz.pack(np.array(values, dtype=np.int64))).tolist() == values
