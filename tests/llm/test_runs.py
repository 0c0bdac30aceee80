"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import pytest

from mentionflow.llm import repair

from .conftest import NASTY


def runs_by_hand(words, least=24, times=3):
    """(start, length, period) by start and period: for each period, stretches of words that equal those a period on."""
    n, out = len(words), []
    for q in range(1, n // times + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end + q - start
            if end > start and length >= max(least, times * q) and not any(all(words[i] == words[i + p] for i in range(start, end + q - p)) for p in range(1, q)):
                out.append((start, length, q))
            start = max(end, start + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    kind, n = rng.randrange(6), rng.randrange(0, 220)
    pick = lambda k, m: [str(rng.randrange(k)) for _ in range(m)]
    if kind == 0:
        return pick(2, n)
    if kind == 1:
        return pick(50, rng.randrange(9)) + pick(4, rng.randrange(1, 30)) * rng.randrange(1, 12) + pick(50, rng.randrange(9))
    if kind == 2:
        return (["a"] * rng.randrange(40) + pick(3, rng.randrange(3))) * rng.randrange(1, 6)
    if kind == 3:
        a, b = ["a"], ["a", "b"]
        for _ in range(rng.randrange(4, 11)):
            a, b = b, b + a
        return b[:230]
    if kind == 4:
        unit = pick(2, rng.randrange(1, 6)) * rng.randrange(1, 9) + pick(2, rng.randrange(1, 6))
        return unit * rng.randrange(1, 6)
    whole = pick(3, rng.randrange(1, 9)) * rng.randrange(1, 20)
    for _ in range(rng.randrange(4)):
        if whole:
            whole[rng.randrange(len(whole))] = "x"
    return whole


@pytest.mark.parametrize("seed", range(6))
def test_runs_by_hand(seed):
    rng = random.Random(seed)
    texts = [random_words(rng) for _ in range(40)]
    for least, times in ((24, 3), (6, 2), (4, 3)):
        got = repair.text_runs([[w.encode() for w in t] for t in texts], least, times)
        for t, runs in zip(texts, got, strict=True):
            assert runs == runs_by_hand(t, least, times), (least, times, t)


def test_grammar_derives_the_texts():
    rng = random.Random(1)
    texts = [random_words(rng) for _ in range(40)]
    ids, starts = repair.word_ids([[w.encode() for w in t] for t in texts])
    g = repair.Grammar(ids, starts)

    def derived(symbol):
        k = symbol - g.n_words
        return [symbol] if k < 0 else derived(g.left[k]) + derived(g.right[k])

    assert [w for s in g.top for w in derived(s)] == ids.tolist()
    pairs = {}
    for k in range(len(g.top) - 1):
        pairs.setdefault((g.top[k], g.top[k + 1]), []).append(k)
    assert all(len(at) == 1 or at == [at[0], at[0] + 1] for at in pairs.values())  # no pair twice but where both overlap
    assert all(g.size[g.n_words + k] == g.size[g.left[k]] + g.size[g.right[k]] for k in range(len(g.left)))


def test_long_runs_take_little_time():
    for words in ([b"a"] * 100_000, [b"a", b"b", b"c"] * 30_000, [str(k % 5000).encode() for k in range(60_000)], ([b"a"] * 50 + [b"b"]) * 400):
        found = [r for r in repair.text_runs([words])[0] if r[1] > 1000]
        assert len(found) == 1 and found[0][:2] == (0, len(words))


def expected(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = repair.text_runs([words])[0] if n > 400 else runs_by_hand(words)
    best = min(runs, key=lambda r: (-r[1] * 10**9 // r[2], r[0], r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_by_hand(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in repair.op13_periodic_runs(spark, sf_dir).collect()]
    assert sorted(got) == sorted(expected(*r) for r in rows)
    assert sum(r[1] > 0 for r in got) > len(rows) / 20


def test_no_multiples_of_a_run_cut_by_a_node(spark, docs, tmp_path):
    unit = ["0", "1", "0"]
    texts = [["x"] + ["a"] * 161 + ["b"] + ["a"] * 100, ["1"] + unit * 40 + ["0", "1", "1"] + unit * 20 + ["0"]]
    got = repair.text_runs([[w.encode() for w in t] for t in texts])
    assert got == [runs_by_hand(t) for t in texts] == [[(1, 161, 1), (163, 100, 1)], [(1, 122, 3), (124, 61, 3)]]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts * 4)]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in repair.op13_periodic_runs(spark, str(tmp_path)).collect()) == sorted(expected(*r) for r in rows)


def test_any_table(spark, nasty, docs):
    got = {(r.doc_id, r.n_words, tuple(r.runs), r.collapsed) for r in repair.word_runs(nasty).collect()}
    assert got == {(i, len((t or "").encode().split()), (), " ".join(w.decode() for w in (t or "").encode().split())) for i, t in NASTY if i != 6} | {(6, 1500, ((0, 1500, 3),), "é 日本 🎉")}
    assert repair.word_runs(docs([])).count() == 0 and repair.word_runs(docs([(1, "a " * 23)])).first().runs == []
