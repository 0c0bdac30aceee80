"""Quality classifier: supervised subword embeddings, trained by stochastic gradient descent in numpy.

A document is the mean of the vectors of its hashed words and character n-grams; a softmax over two classes
reads it. Training takes a bounded, documented sample of labelled rows: features are counted on the
executors, the gradient steps run on the driver. As the output is linear in the mean, each feature's vector
comes down to one number after training, and scoring a text is a mean of looked-up numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import Scratch, as_row, or_empty, quoted, smaller, table

#: Feature buckets (power of two), vector size, character n-grams, labelled rows of each class at most.
BUCKETS, DIM, GRAMS, TRAIN_ROWS = 1 << 17, 16, (2, 3, 4), 2000
#: Distinct features of all rows learnt from, at most: eight bytes each on the driver.
TRAIN_FEATURES = 40_000_000
EPOCHS, RATE, SEED, THRESHOLD = 5, 0.5, 7, 0.7
#: Code points that one vectorised step hashes.
STEP_CHARS = 200_000
PRIME = np.uint64(0x100000001B3)
POWERS = np.cumprod(np.r_[np.uint64(1), np.full(255, PRIME, np.uint64)], dtype=np.uint64)


def bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every word and character n-gram of the texts; n-grams run over single blanks. Words
    give a second token that tells how they repeat."""
    chars = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass") + "\n".encode("utf-32-le"), "<u4").astype(np.uint64)
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts)), np.diff(np.r_[0, ends]))
    blank = (chars <= 32) | (chars == 0xA0)
    chars = np.where(blank, np.uint64(32), chars)
    owners, found = [], []
    # Words: a polynomial hash over each run of other characters.
    begins = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    if len(begins):
        run = np.cumsum(~blank & np.r_[True, blank[:-1]]) - 1
        place = np.minimum(np.arange(len(chars)) - begins[np.maximum(run, 0)], 255)
        part = np.where(blank, np.uint64(0), chars * POWERS[np.maximum(place, 0)])
        words, of = np.add.reduceat(part, begins), doc[begins]
        owners += [of, of]
        found += [bucket(words + np.uint64(0x51)), bucket(repetition(words, of) + np.uint64(0x5252))]
    once = np.r_[True, ~(blank[1:] & blank[:-1])]  # runs of blanks count as one
    chars, doc = chars[once], doc[once]
    for n in GRAMS:
        if len(chars) < n:
            continue
        h = np.zeros(len(chars) - n + 1, np.uint64)
        for j in range(n):
            h = h * PRIME + chars[j : len(chars) - n + 1 + j]
        same = doc[: len(h)] == doc[n - 1 :]
        owners.append(doc[: len(h)][same])
        found.append(bucket(h[same] + np.uint64(n << 40)))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(owners), np.concatenate(found)


def repetition(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A token for each word: how far back its document last had it, on a log scale, and whether the word before it
    lies as far back (a repeated phrase)."""
    order = np.lexsort((np.arange(len(words)), words, doc))
    same = np.r_[False, (words[order][1:] == words[order][:-1]) & (doc[order][1:] == doc[order][:-1])]
    back = np.zeros(len(words), np.int64)
    back[order] = np.where(same, order - np.r_[0, order[:-1]], 0)
    phrase = np.r_[False, (back[1:] == back[:-1]) & (back[1:] > 0)]
    scale = np.ceil(np.log2(back + 1)).astype(np.uint64)
    return np.where(phrase, np.uint64(100), np.uint64(0)) + scale


def steps(texts: list[str]):
    """The texts in slices of about STEP_CHARS code points: (from, to)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > STEP_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def feature_counts(batches):
    for batch in smaller(batches):
        for doc_id, label, text in zip(batch["doc_id"].to_pylist(), batch["label"].to_pylist(), batch["text"].to_pylist(), strict=True):
            _, found = features([text])
            ids, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array([doc_id], pa.int64()), "label": pa.array([label], pa.int32()), "ids": pa.array([ids.astype(np.int32)], pa.list_(pa.int32())), "n": pa.array([n.astype(np.int32)], pa.list_(pa.int32()))})


def unpacked(t: pa.Table) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(labels, ids and counts of each row), as views of the table's own buffers."""
    lists = [t[c].combine_chunks() for c in ("ids", "n")]
    at = np.r_[0, np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
    ids, n = (x.flatten().to_numpy() for x in lists)
    return t["label"].to_numpy(), [(ids[a:b], n[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def fit(labels: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, float]:
    """(a number for each bucket, bias) of label 1 against 0, from rows of ids and counts. Rows are weighed so that
    both classes count the same; with one class or none, every text scores that class's share."""
    share = float(np.mean(labels)) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return np.zeros(BUCKETS, np.float32), {0.0: -5.0, 1.0: 5.0}.get(share, 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    out, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    weight = np.array([0.5 / (1 - share), 0.5 / share], np.float32)
    total, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            (ids, n), label = rows[k], labels[k]
            part = n.astype(np.float32) / max(1, n.sum())
            mean = part @ vectors[ids]
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            step = rate * (1 - done / total) * weight[label] * p
            back = step @ out
            out -= np.outer(step, mean)
            bias -= 0.1 * step
            # Rare features get as large a step as frequent ones: the square root evens out their shares.
            vectors[ids] -= np.outer(np.sqrt(part), back)
            done += 1
    return (vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0])


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_features: int = TRAIN_FEATURES) -> tuple[np.ndarray, float]:
    """Fits on at most train_rows labelled documents of each class, those with the smallest hash of the id, or as many of them
    as have half of train_features distinct features together (very long texts have many, BUCKETS at most). Rows whose
    crc32(doc_id as text) mod 4 is 2 are never used. A document with several labels has the lowest; of rows repeated with
    one id the smallest text counts; null ids and labels that are neither 0 nor 1 are passed over, null texts are empty.
    Without labels every text scores 0.5. Other columns of both tables are ignored, whatever their names."""
    marked = labels.filter("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label"))
    marked = marked.filter(~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = marked.filter("label = 1").orderBy(*order).limit(train_rows).unionByName(marked.filter("label = 0").orderBy(*order).limit(train_rows))
    # At most twice train_rows ids: small enough to send to every task.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), or_empty("text").alias("text")).join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text"))
    scratch = Scratch(docs.sparkSession, "quality")
    counted = scratch.keep(texts.select("doc_id", "label", "text").mapInArrow(feature_counts, "doc_id long, label int, ids array<int>, n array<int>"), "features")
    so_far = F.sum("size").over(Window.partitionBy("label").orderBy(*order))  # at most train_rows numbers a class
    fits = counted.select("doc_id", "label", F.size("ids").cast("long").alias("size")).withColumn("so_far", so_far).filter(F.col("so_far") <= train_features // 2).select("doc_id")
    learnt = counted.join(F.broadcast(fits), "doc_id").select("doc_id", "label", "ids", "n").toArrow().sort_by("doc_id")
    scratch.drop("features")
    return fit(*unpacked(learnt))


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def scorer(spark: SparkSession, model: tuple[np.ndarray, float]):
    """A function from texts (an Arrow array) to scores."""
    shared = spark.sparkContext.broadcast(model)  # BUCKETS numbers, whatever the input

    def scores(column: pa.Array) -> pa.Array:
        logit, bias = shared.value
        texts = [t or "" for t in column.to_pylist()]
        z = np.zeros(len(texts))
        for a, b in steps(texts):
            doc, found = features(texts[a:b])
            n = np.bincount(doc, minlength=b - a)
            z[a:b] = np.bincount(doc, weights=logit[found], minlength=b - a) / np.maximum(n, 1)
        return pa.array(1 / (1 + np.exp(-np.clip(z + bias, -30, 30))), pa.float64())

    return scores


def score(docs: DataFrame, model: tuple[np.ndarray, float], columns: list[str]) -> DataFrame:
    """columns of docs (text and others, none of them called score) and score, one row per row of docs, repeated rows too;
    null and empty texts score as the bias alone; an empty table gives no rows."""
    scores = scorer(docs.sparkSession, model)

    def scored(batches):
        for batch in smaller(batches):
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), scores(batch["text"])], [*columns, "score"])

    rows = docs.select(*map(quoted, columns), *map(quoted, {"text"} - set(columns)))
    schema = StructType([*(docs.schema[c] for c in columns), StructField("score", DoubleType())])
    return rows.mapInArrow(scored, schema)


def accepted(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score threshold or more, with all columns, whatever their names (score too)."""
    scores = scorer(docs.sparkSession, model)

    def scored(batches):
        for batch in smaller(batches, lambda b: b["row"].field("text")):
            yield pa.RecordBatch.from_arrays([batch["row"], scores(batch["row"].field("text"))], ["row", "score"])

    rows = docs.select(as_row(docs))
    return rows.mapInArrow(scored, StructType([rows.schema["row"], StructField("score", DoubleType())])).filter(F.col("score") >= threshold).select("row.*")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
