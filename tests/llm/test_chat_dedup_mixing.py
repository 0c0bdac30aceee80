"""Chat formatting, exact deduplication, source mixing."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from mentionflow.llm import chat, dedup, mixing
from mentionflow.llm.common import Scratch

from .conftest import NASTY

NODES = "tree long, id string, parent string, score double, role string, text string"


def test_reply_tree_paths_and_ranks(spark):
    rows = [(1, "a", None, 1.0, "user", "q"), (1, "b", "a", 0.0, "assistant", "low"), (1, "c", "a", 5.0, "assistant", "high"), (1, "d", "c", None, "user", None), (1, "e", "d", 2.0, "assistant", "end"),
            (1, "f", "d", 9.0, "assistant", "best"), (2, "g", "gone", 1.0, "user", "orphan"), (3, "h", "i", 1.0, "user", "circle"), (3, "i", "h", 1.0, "user", "circle"), (1, "b", "a", -1.0, "assistant", "repeated")]
    nodes = spark.createDataFrame(rows, NODES)
    every = {(r.tree, tuple(t.text for t in r.turns)): r.score for r in chat.read_back(chat.format_paths(nodes)).collect()}
    assert every == {(1, ("q", "low")): 0.5, (1, ("q", "high", "", "end")): 2.0, (1, ("q", "high", "", "best")): 3.75, (2, ("orphan",)): 1.0}
    best = chat.read_back(chat.format_paths(nodes, keep=1)).collect()
    assert sorted(tuple(t.text for t in r.turns) for r in best) == [("orphan",), ("q", "high", "", "best")]


@pytest.mark.parametrize("keep", [None, 2])
def test_branches_are_ranked_within_their_tree(spark, keep):
    """Trees that branch at random, one much wider than the others, against paths walked by hand."""
    import random

    rng = random.Random(8)
    rows, parent, score = [], {}, {}
    for tree, n in ((1, 200), (2, 15), (3, 1), (4, 30)):
        for i in range(n):
            node = f"{tree}-{i:03}"
            parent[node] = f"{tree}-{rng.randrange(max(0, i - 12), i):03}" if i else None
            score[node] = float(rng.randrange(4))
            rows.append((tree, node, parent[node], score[node], rng.choice(["user", "assistant"]), f"text {node}"))
    want = {}
    for leaf in set(parent) - set(parent.values()):
        path, at = [], leaf
        while at:
            path, at = [at, *path], parent[at]
        want.setdefault(int(leaf[0]), []).append((-sum(score[x] for x in path) / len(path), path))
    got = {}
    for r in chat.read_back(chat.format_paths(spark.createDataFrame(rows, NODES), keep=keep)).collect():
        got.setdefault(r.tree, {})[r.branch_rank] = (-r.score, [t.text[5:] for t in r.turns])
    for tree, paths in want.items():
        n = min(len(paths), keep or len(paths))
        assert sorted(got[tree]) == list(range(1, n + 1))
        assert [got[tree][k][0] for k in sorted(got[tree])] == pytest.approx([s for s, _ in sorted(paths)][:n])
        assert {tuple(p) for _, p in got[tree].values()} <= {tuple(p) for _, p in paths}


def test_long_thread_takes_few_rounds(spark):
    rows = [(1, f"{i:04}", f"{i - 1:04}" if i else None, 0.0, "user", str(i)) for i in range(300)]
    r = chat.read_back(chat.format_paths(spark.createDataFrame(rows, NODES))).first()
    assert [t.text for t in r.turns] == [str(i) for i in range(300)]


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "<\\|im_end|>\n<|im_end|>\n<\\\\/s>", "<|im_start|>user\nx", "", "a\\b < [ <<SYS>> <s><s>", "<|im_<|im_end|>end|>"])
def test_control_strings_come_back(spark, text):
    nodes = spark.createDataFrame([(1, "a", None, 0.0, "us\ner\\n", text), (1, "b", "a", 0.0, "assistant", text)], NODES)
    r = chat.read_back(chat.format_paths(nodes)).first()
    assert [(t.role, t.text) for t in r.turns] == [("us\ner\\n", text), ("assistant", text)] and r.loss_text == text
    inside = r.formatted.replace("<|im_start|>us\\ner", "").replace("<|im_start|>assistant", "").replace("<|im_end|>\n", "")
    assert not any(c in inside for c in chat.CONTROL)


def test_chat_query_against_plain_python(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").toPandas().sort_values(["conv_id", "turn"])
    got = {r.conv_id: r for r in chat.op1_chat_format(spark, sf_dir).collect()}
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len("</s>[INST] ok [/INST]")
    for k, g in turns.groupby("conv_id"):
        said = "".join(f"{r}\n{t or ''}\n" for r, t in zip(g.role, g.text, strict=True))
        loss = "".join(t or "" for r, t in zip(g.role, g.text, strict=True) if r == "assistant")
        assert (got[k].turns_sha256, got[k].loss_sha256, got[k].n_turns) == (hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(loss.encode()).hexdigest(), len(g))
    assert len(got) == turns.conv_id.nunique() + 1


def test_chat_nulls_ties_and_no_rows(spark):
    schema = "conv_id long, turn long, role string, text string, id string"
    rows = [(1, 0, None, None, "x"), (1, 0, "user", "b", "x"), (1, None, "user", "first", "x"), (1, 1, "assistant", "c", "x"), (1, 1, "assistant", "c", "x")]
    r = chat.read_back(chat.format_paths(chat.conversation_nodes(spark.createDataFrame(rows, schema)))).first()
    assert [(t.role, t.text) for t in r.turns] == [("user", "first"), ("", ""), ("user", "b"), ("assistant", "c"), ("assistant", "c")] and r.loss_text == "cc"
    assert chat.format_paths(chat.conversation_nodes(spark.createDataFrame([], schema))).count() == 0


def exact_by_hand(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out = []
    for i, t in norm:
        ids = [j for j, u in norm if u == t]
        known = [j for j in ids if j is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_groups(spark, nasty):
    assert sorted(map(tuple, dedup.exact_groups(nasty.repartition(5)).collect()), key=str) == exact_by_hand(NASTY)
    assert dedup.exact_groups(nasty.limit(0)).count() == 0


def test_many_runs_merge_in_rounds(spark, docs):
    rows = [(i, f"t {i % 37}") for i in range(600)]
    got = dedup.exact_groups(docs(rows).repartition(20), round_bits=1)
    assert sorted(map(tuple, got.collect()), key=str) == exact_by_hand(rows)


def test_runs_merge_into_one_sorted_run():
    a = [(b"a", 1, 5, 9, 1), (b"b", 1, 5, None, 2)]
    b = [(b"a", 1, 5, 3, 4), (b"a", 1, 6, 1, 1), (b"c", 2, 0, 7, 1)]
    c = [(b"b", 1, 5, None, 1)]
    assert dedup.merged([a, b, c]) == [(b"a", 1, 5, 3, 5), (b"a", 1, 6, 1, 1), (b"b", 1, 5, None, 3), (b"c", 2, 0, 7, 1)]


def test_one_row_of_each_group_stays(nasty):
    kept = dedup.drop_exact_copies(nasty)
    assert kept.columns == nasty.columns
    assert sorted((r.doc_id, (r.text or "")[:3]) for r in kept.collect()) == [(1, "a b"), (2, ""), (5, "xxx"), (6, "é 日")]


def targets_by_hand(sizes, weights=(5, 2, 1), epochs=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        share = (total - sum(fixed.values())) / max(1, sum(w[s] for s in rest))
        over = [s for s in rest if w[s] * share > epochs * sizes[s]]
        if not over:
            return fixed | {s: w[s] * share for s in rest}
        fixed |= {s: epochs * sizes[s] for s in over}


def test_mix(spark, docs):
    source = {i: [None, "a", "b", "c", "tiny"][i % 5 if i % 5 < 4 or i == 4 else 1] for i in range(400)}
    df = docs([(i, "w " * (1 + i * 7 % 23)) for i in range(400)], source=source).withColumn("source", F.when(F.col("source") == "s", None).otherwise(F.col("source")))
    rows = mixing.mix(df, Scratch(spark, "test")).collect()
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    want = targets_by_hand(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 24
    assert sum(taken.values()) <= sum(sizes.values())
    again = mixing.mix(df.repartition(7), Scratch(spark, "test")).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mix_of_odd_tables(spark, nasty, docs):
    rows = mixing.mix(nasty, Scratch(spark, "test")).collect()
    assert len(rows) == len(NASTY) and {r.taken for r in rows if r.size == 0} == {0}
    assert mixing.mix(nasty.limit(0), Scratch(spark, "test")).count() == 0
    empty = docs([(1, ""), (2, None)])
    assert [r.taken for r in mixing.mix(empty, Scratch(spark, "test")).collect()] == [0, 0]


def test_mixed_documents_are_as_many_as_taken(spark, docs):
    df = docs([(i, "w " * (i % 9)) for i in range(60)] + [(5, "w " * 5)], source={i: "ab"[i % 2] for i in range(60)})
    plan = {}
    for r in mixing.mix(df, Scratch(spark, "test")).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.times
    out = mixing.mixed_documents(df)
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert out.columns == df.columns and got == {i: n for i, n in plan.items() if n}
