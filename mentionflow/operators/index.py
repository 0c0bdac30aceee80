"""A positional inverted index of documents, and corpus search over it.

Postings are kept by pairs of neighbouring words: where a pair stands in each document, and what the document scores. The
postings of a pair are cut into blocks of documents, those with the best scores first, and each block has the best scores
of its documents beside it. A search reads the first block of each pair that its phrases are made of; what it finds
there bounds what later blocks may still add, and only blocks whose best scores reach that bound are read. Texts are read
when they are added, and never by a search.

    postings/batch=.../part=...: w, next, shard, block, best (by cluster), docs (doc_id, scores, places)

Batches are added side by side (a week's documents, say); a document belongs to one batch. Lists are kept by shards of
documents, so that no word, however frequent, has a list that grows with all of them.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import settled
from . import corpus

#: Documents of a block; documents of a shard on average; folders that words are dealt out to.
BLOCK_DOCS, SHARD_DOCS, PARTS = 128, 5_000_000, 16
#: Blocks that a task reads at a time: each holds BLOCK_DOCS documents with all their places, and what the Parquet reader
#: holds of them is not in the memory that Spark accounts for.
READ_BLOCKS = ("spark.sql.parquet.columnarReaderBatchSize", "64")
SCORES = ["honorific", *corpus.TOPICS]
CLUSTERS = range(1, len(corpus.TOPICS) + 2)


def part_of(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(PARTS)).cast("int")


def _best() -> Column:
    """By cluster, the most that documents of a group score: nothing where none has the cluster's terms."""
    broad = F.max(F.when(F.col("honorific") > 0, F.col("honorific")))
    return F.array(broad, *[F.max(F.when((F.col("honorific") > 0) & (F.col(t) > 0), F.col("honorific") + F.col(t))) for t in corpus.TOPICS])


def add_documents(docs: DataFrame, root: str, batch: str, block_docs: int = BLOCK_DOCS, shard_docs: int = SHARD_DOCS) -> None:
    """Adds documents (doc_id, text) as a batch; one that was added before under that name is replaced.

    Null and empty texts have no postings. A repeated doc_id counts as one document with the places of all its rows.
    """
    shards = max(1, -(-docs.count() // shard_docs))
    texts = corpus.term_hits(docs).select("doc_id", *SCORES, F.split(F.trim("hay"), " ").alias("words"))
    places = texts.select("doc_id", *SCORES, F.posexplode(corpus.word_pairs("words")).alias("place", "pair"))
    places = places.select(F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"), "pair.w", F.coalesce("pair.next", F.lit("")).alias("next"), "doc_id", "place", *SCORES).filter("w <> ''")
    # One shuffle: the lists of a pair stay where its documents have been gathered.
    of_doc = places.repartition("shard", "w", "next").groupBy("shard", "w", "next", "doc_id").agg(F.sort_array(F.collect_list("place")).alias("places"), *[F.max(c).alias(c) for c in SCORES])
    most = F.greatest(*[F.col(t) for t in corpus.TOPICS])
    order = Window.partitionBy("shard", "w", "next").orderBy((F.col("honorific") > 0).desc(), (F.col("honorific") + most).desc(), "doc_id")
    cut = of_doc.withColumn("block", F.floor((F.row_number().over(order) - 1) / block_docs).cast("int"))
    entry = F.struct("doc_id", *[F.col(c).cast("tinyint").alias(c) for c in SCORES], "places")
    blocks = cut.groupBy("shard", "w", "next", "block").agg(_best().alias("best"), F.sort_array(F.collect_list(entry)).alias("docs"))
    blocks = blocks.select("w", "next", "shard", "block", "best", "docs", F.lit(batch).alias("batch"), part_of(F.col("w")).alias("part"))
    blocks.sortWithinPartitions("part", "w", "next", "block").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "part").parquet(f"{root.rstrip('/')}/postings")


def postings(spark: SparkSession, root: str) -> DataFrame:
    scores = ", ".join(f"{c}: tinyint" for c in SCORES)
    schema = f"w string, next string, shard int, block int, best array<int>, docs array<struct<doc_id: bigint, {scores}, places: array<int>>>, batch string, part int"
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/postings")


@contextlib.contextmanager
def _few_blocks_at_a_time(spark: SparkSession):
    name, before = READ_BLOCKS[0], spark.conf.get(READ_BLOCKS[0], None)
    spark.conf.set(*READ_BLOCKS)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def _looked_up(blocks: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """columns of the blocks of the pairs of phrases; a pair without a next word is that of a phrase of one word."""
    two = blocks.join(pairs.filter("next is not null"), ["part", "w", "next"]).select(columns)
    return two.unionByName(blocks.join(pairs.filter("next is null").drop("next"), ["part", "w"]).select(columns))


def _places(lists: DataFrame) -> DataFrame:
    """A row per place of the documents (with an honorific) of lists (docs, phrase, n_pairs, offset)."""
    each = lists.select("phrase", "n_pairs", "offset", F.explode("docs").alias("d")).filter("d.honorific > 0")
    return each.select("d.doc_id", *[F.col(f"d.{c}").cast("int").alias(c) for c in SCORES], "phrase", "n_pairs", "offset", F.explode("d.places").alias("place"))


def _found(blocks: DataFrame, of_key: DataFrame, pairs: DataFrame, questions: DataFrame, clusters: list[int] | None, results_per_query: int) -> DataFrame:
    """doc_id, scores and phrase of the documents that may be among the best of a question, settled."""
    # What the first blocks hold: of each question and cluster, the score of its last result so far.
    rest, listed = ["doc_id", *SCORES], ["docs", "phrase", "n_pairs", "offset"]
    head = _places(_looked_up(blocks.filter("block = 0"), pairs, listed))
    first = settled(corpus.complete(head, rest), "first")
    sofar = corpus.ranked(corpus.answers(first, questions), clusters, results_per_query)
    bounds = sofar.filter(F.col("rank") == results_per_query).select("key", "cluster_no", F.col("n_terms").alias("bound"))

    # A later document of a phrase scores what its block may at best, and a point for each form. The least bound of the
    # questions that a phrase belongs to decides; a question that has not enough results yet bounds nothing.
    wanted = [k for k in CLUSTERS if not clusters or k in {int(c) for c in clusters}]
    each = of_key.select("phrase", "key", "n_phrases", F.explode(F.array(*[F.lit(k) for k in wanted])).alias("cluster_no")).join(bounds, ["key", "cluster_no"], "left")
    needs = each.groupBy("phrase", "cluster_no").agg(F.min(F.coalesce(F.col("bound"), F.lit(0)) - F.col("n_phrases")).alias("need"))
    needs = settled(needs.groupBy("phrase").agg(F.map_from_entries(F.collect_list(F.struct("cluster_no", "need"))).alias("needs")), "needs")
    heads = blocks.filter("block > 0").select("part", "w", "next", "shard", "block", "batch", "best")
    asked = pairs.join(needs, "phrase")
    reaches = F.exists(F.map_entries("needs"), lambda e: F.get(F.col("best"), e["key"] - 1) >= e["value"])
    again = settled(_looked_up(heads, asked, [*heads.columns, "phrase", "n_pairs", "offset", "needs"]).filter(reaches).drop("best", "needs"), "blocks")
    if again.limit(1).count():
        later = _places(blocks.filter("block > 0").join(again, ["part", "w", "next", "shard", "block", "batch"]).select(listed))
        return settled(corpus.complete(head.unionByName(later), rest), "found")
    return first


def search(spark: SparkSession, root: str, roster: DataFrame, clusters: list[int] | None = None, results_per_query: int = 10) -> DataFrame:
    """The rows of corpus.corpus_search over all documents of the index."""
    experts, questions = corpus.asked(roster)
    questions = questions.withColumn("n_phrases", F.size("phrases"))
    of_key = questions.select("key", "n_phrases", F.explode("phrases").alias("phrase"), F.lit(False).alias("is_anchor"))
    of_key = settled(of_key.unionByName(questions.filter("anchor <> '  '").select("key", "n_phrases", F.col("anchor").alias("phrase"), F.lit(True).alias("is_anchor"))), "wanted")
    pairs = settled(corpus.pairs_of(of_key).withColumn("part", part_of(F.col("w"))), "pairs")
    blocks = postings(spark, root)

    with _few_blocks_at_a_time(spark):
        found = _found(blocks, of_key, pairs, questions, clusters, results_per_query)
    best = corpus.ranked(corpus.answers(found, questions), clusters, results_per_query)
    return best.join(experts, "key").select(*corpus.EXPERT, "cluster_no", "doc_id", "n_terms", "rank")
