"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Documents of a source queue up in a shuffled order (by a digest of the id). A document's virtual
finish time is the source's words up to it divided by the source's target; half of the document is
taken off, so that the document on a boundary falls to the nearer side. A source may be queued up to
three times over. All queued documents are range-sorted by that time, and what is after the budget is
cut off. The order is never held in one task: running sums are taken within (source, digest prefix)
buckets and by ranges of the sort, and only sums travel between them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NON_BLANKS, Scratch, as_row, key_of, partitions, row_order, table

WEIGHTS = (5, 2, 1)
EPOCHS = 3
#: Rows of a source's bucket and of a range of the sort on average.
BUCKET_ROWS, RANGE_ROWS = 20_000, 1_000_000
#: The order of the mix.
ORDER = ("v", "source_rank", "key", "size", "epoch")


def source_targets(sources: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Adds rank, target and share to (source, source_size): all words are shared by weight, no target is above
    epochs times its source's words, and what is above goes to the others by weight until none is."""
    # One row per source: the windows run over aggregates.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.row_number().over(by_name) - 1
    weighed = sources.withColumn("source_rank", nth).withColumn(
        "w", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_rank") % len(weights) + 1).cast("int")).cast("long")
    )
    cap = F.col("source_size") * epochs
    by_need = Window.orderBy(F.col("cap") / F.col("w"), "source_rank")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    after = by_need.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = weighed.withColumn("cap", cap).withColumn(
        "level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(after).cast("double")
    )
    # The level of the first source, in order of need, that its cap doesn't hold back, holds for all from there on.
    open_ = F.col("level") * F.col("w") <= F.col("cap")
    shared = F.min(F.when(open_, F.struct(F.col("cap") / F.col("w"), "source_rank", "level"))).over(everything)["level"]
    target = F.least(F.col("cap").cast("double"), shared * F.col("w"))
    return level.withColumn("target", F.coalesce(target, F.col("cap").cast("double"))).select("source", "source_rank", "source_size", "target")


def words_in(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NON_BLANKS)), F.lit(0)).cast("long")


def mix(docs: DataFrame, scratch: Scratch, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, source, key, size, source_size, target, taken, times (how often the mix takes the row) and turns (its places
    in the order of the mix, structs of ORDER), a row per row of docs, in no order.

    Null texts have size 0; a null source is a source of its own, last in order. Rows of size 0 are taken 0 times; an empty
    table gives no rows. Rows without an id are shuffled by their text; ties in the shuffled order can only be rows of
    one id and size. Other columns are ignored, whatever their names.
    """
    key = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.col("text")), F.lit("-")), 256)
    sized = scratch.keep(docs.select("doc_id", "source", words_in().alias("size"), key.alias("key")), "sizes")
    digits = max(2, math.ceil(math.log(max(1, sized.count()) / BUCKET_ROWS + 1, 16)))
    bucket = F.substring("key", 1, digits)
    buckets = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    targets = source_targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, epochs)
    earlier = Window.partitionBy("b.source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        buckets.alias("b")
        .join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .select(F.col("b.source").alias("source"), F.col("bucket"), "source_rank", "source_size", "target", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    )
    buckets = scratch.keep(buckets, "buckets")
    budget = sized.agg(F.sum("size")).first()[0] or 0

    within = Window.partitionBy("d.source", "d.bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = (
        sized.withColumn("bucket", bucket)
        .alias("d")
        .join(buckets.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.bucket") == F.col("b.bucket")))
        .select("doc_id", F.col("d.source").alias("source"), "key", "size", "source_rank", "source_size", "target", (F.col("base") + F.sum("size").over(within)).alias("through"))
    )
    queued = scratch.keep(queued, "queued")

    def time(epoch):
        words = 2 * (F.col("through") + epoch * F.col("source_size")) - F.col("size")
        return words.cast("double") / (2 * F.col("target"))

    turns = (
        queued.filter("size > 0")
        .withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(epochs)])))
        .select("source_rank", "key", "size", "epoch", time(F.col("epoch")).alias("v"))
    )
    last = last_turn(turns, budget, scratch)
    here = [F.struct(time(F.lit(e)).alias("v"), F.col("source_rank"), F.col("key"), F.col("size"), F.lit(e).alias("epoch")) for e in range(epochs)]
    end = F.struct(*[F.lit(last[c]).alias(c) for c in ORDER]) if last else F.lit(None)
    taken = F.when(F.col("size") > 0, F.filter(F.array(*here), lambda t: F.coalesce(t <= end, F.lit(False)) if last else F.lit(False))).otherwise(F.array())
    for step in ("sizes", "buckets", "turns"):
        scratch.drop(step)
    taken = queued.withColumn("turns", taken).withColumn("times", F.size("turns"))
    return taken.select("doc_id", "source", "key", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "times", "turns")


def last_turn(turns: DataFrame, budget: int, scratch: Scratch):
    """Range-sorts the turns and gives the last one up to which their sizes come to no more than the budget (None if there is
    none). Only the sums of the ranges, and one range, are looked at to find it."""
    n = max(partitions(turns.sparkSession), -(-turns.count() // RANGE_ROWS))
    ranged = scratch.keep(turns.repartitionByRange(n, *ORDER).sortWithinPartitions(*ORDER).withColumn("part", F.spark_partition_id()), "turns")
    down = [F.col(c).desc() for c in ORDER]
    sums = ranged.groupBy("part").agg(F.sum("size").alias("words"))  # a row per range
    over = sums.withColumn("through", F.sum("words").over(Window.orderBy("part"))).filter(F.col("through") > budget).orderBy("part").first()
    if over is None:
        return ranged.orderBy(*down).first()
    so_far = Window.partitionBy("part").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    inside = ranged.filter(F.col("part") == over["part"]).withColumn("through", F.lit(over["through"] - over["words"]) + F.sum("size").over(so_far))
    return inside.filter(F.col("through") <= budget).orderBy(*down).first() or ranged.filter(F.col("part") < over["part"]).orderBy(*down).first()


def mixed_documents(docs: DataFrame, in_order: bool = False) -> DataFrame:
    """The rows of docs as often as the mix takes them, with all columns, whatever their names. Rows repeated with one id
    and size count as that many documents and share what the mix takes of them. in_order: range-sorted into the order
    of the mix, which moves texts once more; otherwise in no order. Texts that are null or blank are never taken."""
    scratch = Scratch(docs.sparkSession, "mixing")
    plan = mix(docs, scratch).filter("times > 0").groupBy(key_of("doc_id", "source", "size").alias("key"))
    plan = plan.agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("times")).alias("n"), "turns"))), lambda t: t["turns"]).alias("all"))
    joined = docs.select(key_of("doc_id", "source", words_in()).alias("key"), as_row(docs)).join(plan, "key")
    nth = F.row_number().over(Window.partitionBy("key").orderBy(*row_order(docs)))
    taken = joined.withColumn("turns", F.get("all", nth - 1)).select("row", F.explode("turns").alias("turn"))
    if in_order:
        order = [F.col("turn")[c] for c in ORDER]
        taken = taken.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return taken.select("row.*")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, Scratch(spark, "mixing")).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, sha256(coalesce(CAST(doc_id AS VARCHAR), '-' || text, '-')) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank FROM d GROUP BY source
), w AS (
  SELECT *, CASE source_rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS cap FROM s
), l AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / CAST(sum(w) OVER (ORDER BY cap / w, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM w
), t AS (
  SELECT source, source_rank, source_size,
         least(CAST(cap AS DOUBLE), (SELECT level FROM l WHERE level * w <= cap ORDER BY cap / w, source_rank LIMIT 1) * w) AS target
  FROM l
), q AS (
  SELECT d.doc_id, d.key, d.size, t.source_rank, t.source_size, t.target,
         CAST(sum(size) OVER (PARTITION BY t.source_rank ORDER BY key, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS through
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT q.*, epoch, CAST(2 * (through + epoch * source_size) - size AS DOUBLE) / (2 * target) AS v
  FROM q, (SELECT unnest([0, 1, 2]) AS epoch) WHERE size > 0
), r AS (
  SELECT doc_id, key, size, source_rank, sum(size) OVER (ORDER BY v, source_rank, key, size, epoch ROWS UNBOUNDED PRECEDING) AS total FROM e
), k AS (
  SELECT key, source_rank, size, count(*) AS times FROM r WHERE total <= (SELECT sum(size) FROM d) GROUP BY ALL
)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(q.size * coalesce(k.times, 0) AS BIGINT) AS taken
FROM q LEFT JOIN k ON q.key = k.key AND q.source_rank = k.source_rank AND q.size = k.size
"""
