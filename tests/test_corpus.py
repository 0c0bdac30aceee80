"""Corpus search against a walk over all experts and texts."""

import random

import pytest
from pyspark.sql import functions as F

from mentionflow.operators import corpus, index, names

TEXTS = [
    (1, "Dr. Madonna said: Cher spoke. Madonna again."), (2, "Ann Bea Lee MD of Mayo Clinic, presented. Ann Lee"), (3, "Ann Lee and Ann Lee, PhD at the mayo  clinic"), (4, "Anna Lee MD"), (5, "MD Madonna"),
    (6, None), (7, ""), (8, "Mayo Clinic Dr Ann B Lee"), (9, "Lee Ann Bea Lee Lee dr"), (10, "Lee, Ann Lee; dr. mayo clin"), (11, "dr x Madonnas"), (12, "x dr cher"),
]
PEOPLE = [("A", "Ann Bea Lee", ""), ("B", "Ann Bea Lee", "Mayo Clinic"), ("C", "Madonna", ""), ("D", "Cher", "Mayo"), ("E", "()", "")]


def test_corpus_search(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    roster = names.name_forms(spark.createDataFrame([(k, 1, n, a) for k, n, a in PEOPLE], "kol_id string, roster_seq int, kol_name string, affiliation string"))
    hays = {r.doc_id: r for r in corpus.term_hits(docs).collect()}
    want = set()
    for p in corpus.phrases(roster).groupBy("kol_id", "anchor").agg(F.collect_list("phrase").alias("all")).collect():
        for i, r in hays.items():
            n = sum(phrase in r.hay for phrase in p["all"])
            if n and r.honorific and (p.anchor == "  " or p.anchor in r.hay):
                want |= {(p.kol_id, k, i, n + r.honorific + t) for k, t in enumerate((0, *(r[c] for c in corpus.TOPICS)), 1) if k == 1 or t}
    got = {(r.kol_id, r.cluster_no, r.doc_id, r.n_terms) for r in corpus.corpus_search(docs, roster).collect()}
    assert got == want and {k for k, *_ in got} == {"A", "B", "C"} and {i for k, _, i, _ in got if k == "C"} == {1, 5}
    assert {r.cluster_no for r in corpus.corpus_search(docs, roster, [1, 3]).collect()} == {1, 3}
    assert corpus.corpus_search(docs.limit(0), roster).count() == 0 and corpus.corpus_search(docs, roster.limit(0)).count() == 0


@pytest.mark.parametrize(("block_docs", "shard_docs"), [(128, 1000), (2, 3)])
def test_index_search(spark, tmp_path, block_docs, shard_docs):
    """The index gives what a search over the texts gives, for one batch and two, with and without blocks left out."""
    rng = random.Random(block_docs)
    words = "Dr MD PhD said told study trial award Ann Lee Bea Mayo Clinic Cher Madonna x y z".split()
    texts = [*TEXTS, *((i, " ".join(rng.choice(words) for _ in range(rng.randrange(40)))) for i in range(100, 220))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    roster = names.name_forms(spark.createDataFrame([(k, 1, n, a) for k, n, a in PEOPLE], "kol_id string, roster_seq int, kol_name string, affiliation string"))
    root = f"file://{tmp_path}"
    for batch in ("w1", "w2", "w2"):  # the last one again: it is replaced
        index.add_documents(docs.filter(F.col("doc_id") % 2 == int(batch == "w1")), root, batch, block_docs, shard_docs)
    for n, clusters in ((3, None), (10, [1, 3])):
        got = index.search(spark, root, roster, clusters, n).collect()
        want = corpus.corpus_search(docs, roster, clusters, n).collect()
        assert {tuple(r) for r in got} == {tuple(r) for r in want} and len(got) == len(want) > 10
    assert index.search(spark, root, roster.limit(0)).count() == 0


def test_index_search_leaves_blocks_out(spark, tmp_path):
    """Of a name that many documents have, only the first block is read for the best results."""
    docs = spark.createDataFrame([(i, "Ann Lee MD said" if i % 10 == 0 else "Ann Lee MD") for i in range(300)], "doc_id long, text string")
    roster = names.name_forms(spark.createDataFrame([("A", 1, "Ann Lee", "")], "kol_id string, roster_seq int, kol_name string, affiliation string"))
    root = f"file://{tmp_path}"
    index.add_documents(docs, root, "w", block_docs=20)
    (tmp_path / "postings").rename(tmp_path / "all")
    spark.read.parquet(f"{root}/all").filter("block < 2").write.partitionBy("batch", "part").parquet(f"{root}/postings")
    got = {(r.cluster_no, r.doc_id) for r in index.search(spark, root, roster, [2], 10).collect()}
    assert got == {(2, 10 * i) for i in range(10)}


def test_form_reach_of_names_that_many_bear(spark):
    """Against a walk over all experts and texts; experts with the same forms and texts that show the same are counted, never paired."""
    people = [(f"{k}{i}", name) for k, name in [("A", "Ann Bea Lee"), ("B", "Ann (Bo) Bea Lee"), ("C", "Madonna"), ("D", "Ann Lee"), ("E", "()"), ("F", "Cher Lee (Vale)")] for i in range(40)]
    texts = [*TEXTS, *((100 + i, TEXTS[i % len(TEXTS)][1]) for i in range(60)), (900, "Bo Lee met Ann Bea Lee"), (901, "Cher Vale"), (901, "Cher Lee, Cher Vale")]
    roster = names.name_forms(spark.createDataFrame([(k, 1, n, "") for k, n in people], "kol_id string, roster_seq int, kol_name string, affiliation string"))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    hays = [(r.doc_id, r.hay) for r in corpus.term_hits(docs).collect()]
    pairs = {k: set() for k in ("full", "short", "initial", "extra")}
    for r in roster.filter("forms is not null").collect():
        for k, forms in {**{k: [r.forms[k]] for k in ("full", "short", "initial")}, "extra": r.forms.extras}.items():
            pairs[k] |= {(r.kol_id, i) for i, hay in hays if any(f" {f.lower()} " in hay for f in forms)}
    n = len(set().union(*pairs.values()))
    got = corpus.form_reach(docs, roster)
    assert {r.form_kind: (r.n_pairs, r.share) for r in got.collect()} == {k: (len(p), len(p) / n) for k, p in pairs.items()} and all(pairs.values())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "kol_id" not in plan and "doc_id" not in plan
    assert corpus.form_reach(docs.limit(0), roster).agg(F.sum("n_pairs")).first()[0] == 0


def test_index_search_reads_few_blocks_at_a_time(spark, tmp_path, monkeypatch):
    """While postings are read, a task takes few blocks at a time; the session's own setting comes back, also after a failure."""
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    roster = names.name_forms(spark.createDataFrame([("A", 1, "Ann Lee", "")], "kol_id string, roster_seq int, kol_name string, affiliation string"))
    index.add_documents(docs, f"file://{tmp_path}", "w")
    option, seen, settled = "spark.sql.parquet.columnarReaderBatchSize", {}, index.settled
    monkeypatch.setattr(index, "settled", lambda df, name: (seen.update({name: int(spark.conf.get(option))}), settled(df, name))[1])
    before = spark.conf.get(option)
    assert index.search(spark, f"file://{tmp_path}", roster).count() > 0
    assert max(seen["first"], seen["blocks"]) <= 64 and spark.conf.get(option) == before
    monkeypatch.setattr(index.corpus, "complete", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        index.search(spark, f"file://{tmp_path}", roster)
    assert spark.conf.get(option) == before
