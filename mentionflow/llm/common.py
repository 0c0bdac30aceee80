"""What the operators of this subpackage share: scratch tables and a few expressions."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, CalendarIntervalType, DataType, MapType, StructType, VariantType

#: White space that separates words and is squeezed before texts are compared.
BLANKS = r"[\x20\x09-\x0D]+"
NON_BLANKS = r"[^\x20\x09-\x0D]+"

_own_root: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only where the session names none (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_root:
        _own_root.append("file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return _own_root[0]


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.steps: set[str] = set()

    def keep(self, df: DataFrame, step: str) -> DataFrame:
        path = f"{self.root}/{step}"
        self.steps.add(step)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, step: str) -> None:
        """Removes a table that no later plan reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{step}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.steps.discard(step)

    def only(self, *steps: str) -> None:
        """Removes all tables but these, which the result still reads."""
        for step in self.steps - set(steps):
            self.drop(step)


def smaller(batches, texts=lambda batch: batch["text"], most: int = 2_000_000):
    """Record batches cut so that each has about so many bytes of texts, one row at least. What a task makes of a batch
    is several times as large as the batch, so batches of ten thousand rows are too large to take at once."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(texts(batch)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def key_of(*columns: Column | str) -> Column:
    """One text that tells rows with different values apart, nulls too: joins and windows on it need one shuffle."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.replace(c.cast("string"), F.lit("|"), F.lit("||"))), F.lit("-")) for c in cols])


def quoted(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_row(docs: DataFrame) -> Column:
    """All columns as one, so that columns beside it may have any names; select("row.*") brings them back."""
    return F.struct(*[quoted(c) for c in docs.columns]).alias("row")


def sortable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(sortable(f.dataType) for f in kind.fields)
    return sortable(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType, CalendarIntervalType))


def row_order(docs: DataFrame) -> list[Column]:
    """An order of rows by all columns of "row", so that which of several stays is no chance; texts count by their hash."""
    fields = [(f, F.col("row").getField(f.name)) for f in docs.schema.fields if f.name != "text"]
    return [c if sortable(f.dataType) else F.to_json(F.struct(c.alias("v"))) for f, c in fields] + [F.xxhash64(F.col("row").getField("text"))]


def first_of_each(docs: DataFrame, kept: DataFrame, key: Column) -> DataFrame:
    """Of the rows of docs with a key (not null) that kept (one column, key, no value twice) has, one for each key. Rows
    of one key are moved once, for the join, and are still together for the window."""
    joined = docs.select(key.alias("key"), as_row(docs)).join(kept, "key")
    first = Window.partitionBy("key").orderBy(*row_order(docs))
    return joined.withColumn("n", F.row_number().over(first)).filter("n = 1").select("row.*")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
