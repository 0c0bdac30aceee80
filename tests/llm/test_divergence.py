"""Source divergence against its SQL and a count by hand."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from mentionflow.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, least_docs, top=50):
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    sources = defaultdict(set)
    for lang, source, text in rows:
        found = [t.translate(LOWER) for t in TERM.findall(text)]
        counts[lang, source].update(found)
        docs[lang].update(set(found))
        sources[lang].add(source)
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        whole = shares(sum((counts[lang, s] for s in names), Counter()))
        of = {s: shares(counts[lang, s]) for s in names}
        for s in names:
            pairs = [(sum(abs(of[s][t] - of[o][t]) for t in kept), o) for o in names - {s}]
            terms = [(of[s][t] - whole[t], t) for t in kept if counts[lang, s][t] and of[s][t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(items[:most], 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


def test_query_and_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = con.sql(divergence.OP11_SQL).fetchall()
    assert rows_of(divergence.op11_source_divergence(spark, sf_dir)) == sorted(want)
    assert {r[2] for r in want} == {"pair", "term"}


@pytest.mark.parametrize("seed", range(4))
def test_sorted_runs(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("ab") for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 100]))) for _ in range(400)]
    words += ["é" * 40, "é" * 40, "é" * 41, "a" * 100_000, "a" * 100_000, "a" * 99_999]
    rng.shuffle(words)
    data = np.frombuffer((" ".join(words)).encode() + b"\0" * 16, dtype=np.uint8)
    begin, end = divergence.pointers(data)
    order, runs = divergence.sorted_runs(data, begin, end)
    assert [words[k] for k in order] == sorted(words, key=str.encode)
    assert len(runs) == len(set(words)) and all(words[order[r]] != words[order[r - 1]] for r in runs[1:])


def test_small_tables(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "é", None, "c"]), " ".join(rng.choice("The the THE Ünder über a1b x_y 日本 ABC" .split()) for _ in range(rng.randrange(9)))) for _ in range(200)]
    rows += [("fr", "one", None), ("fr", "two", ""), ("it", "only", "word " * 9), ("long", "x", "x" * 200_000), ("long", "y", "x" * 200_000 + " yZ yz"), *rows[:20]]
    monkeypatch.setattr(divergence, "SHARD_ROWS", 3)
    monkeypatch.setattr(divergence, "CELLS", 7)
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], "lang string, source string, text string, term string, n long").repartition(5)
    for least in (1, 2, 10):
        assert rows_of(divergence.divergence(df, least)) == by_hand(rows, least)
    assert divergence.divergence(df.limit(0)).count() == 0


def test_shares_of_large_counts(spark):
    df = spark.createDataFrame([(10**15, 3 * 10**15, 7)], "c long, n long, v long")
    assert df.select(divergence.share("c", "n", "v")).first()[0] == 1 + 10**9 * (10**15 + 5) // (3 * 10**15 + 35)
