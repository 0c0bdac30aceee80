"""The pipeline against a brute-force version of its stages, and the entry module without the llm folder."""

import os
import re
import shutil
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mentionflow.llm import mixing, quality
from mentionflow.llm.common import Scratch

from .test_chat_dedup_mixing import exact_by_hand, targets_by_hand
from .test_texts import near_by_hand
from .test_warc_packing import check

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest tables have too few labels for the classifier to keep any text
    cp = pytest.importorskip("corpus_pipeline")
    scratch = Scratch(spark, "test-pipeline")
    docs = first = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in cp.STAGES:
        before = docs
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        seen[name] = (before, docs)
        if name != cp.STAGES[-1][0]:
            assert docs.schema.names == first.schema.names
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    rows = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

    before, after = seen["quality"]
    model = quality.train(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids(after) == ids(quality.score(before, model, ["doc_id"]).filter(F.col("score") >= 0.7))
    before, after = seen["exact_dedup"]
    assert ids(after) == Counter({keep for _, keep, *_ in exact_by_hand(rows(before))})
    before, after = seen["near_dedup"]
    assert ids(after) == Counter({keep for _, keep, *_ in near_by_hand(rows(before))})
    before, after = seen["mixing"]
    assert ids(after) == Counter({r.doc_id: r.times for r in mixing.mix(before, scratch).collect() if r.times})
    # Words taken of each source by hand: near the targets that the sizes give, no document more than three times.
    sizes, given, most = Counter(), Counter(), 0
    for r in before.select("doc_id", "source", "text").collect():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        most = max(most, len((r.text or "").split()))
    for r in after.select("source", "text").collect():
        given[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    targets = targets_by_hand(dict(sizes))
    assert len(sizes) > 1 and all(abs(given[source] - targets[source]) <= 3 * most for source in sizes) and max(ids(after).values()) <= 3
    before, after = seen["packing"]
    n, least = check(after.collect(), [(r.doc_id, r.text) for r in before.collect()], 2048)
    assert n <= 1.02 * least + 1


def test_the_rest_works_without_the_llm_folder(tmp_path):
    copy = tmp_path / "repo"
    copy.mkdir()
    shutil.copytree(f"{REPO}/mentionflow", copy / "mentionflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", copy)
    code = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); print(len(q), len(s), any(k.startswith('op') for k in q), 'pipeline' in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=120)
    assert done.stdout.split()[2:] == ["False", "False"] and int(done.stdout.split()[0]) >= 25, done.stderr
