"""Output tables: staged writes, promotion, result and summary files.

The output is a folder of versions and a log that names one version a commit:

    output/0000000003-<tag>-<id>/...    rows
    output/_log/0000000003              the version's folder, written in one step that fails if another run was first

Readers take the folder that the last entry names (current), so they see the version before a promotion or the one after
it, whole, and never none. The last versions are kept for readers that have begun.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import first_of


def output_columns(results: DataFrame) -> DataFrame:
    """The fourteen output columns in order, '' where a value is missing."""
    return results.select(*[(first_of(F.col(c).cast("string")) if c in results.columns else F.lit("")).alias(name) for name, c in fixed.OUTPUT_COLUMNS])


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def staging_path(root: str, run_tag: str) -> str:
    return f"{root.rstrip('/')}/_staging_{run_tag[:12]}"


def stage(results: DataFrame, root: str, run_tag: str) -> DataFrame:
    """Writes the run's output next to the last one; a leftover of the same run is replaced."""
    path = staging_path(root, run_tag)
    output_columns(results).write.mode("overwrite").parquet(path)
    return results.sparkSession.read.parquet(path)


class Conflict(RuntimeError):
    """Another run was promoted in the meantime; the staged rows are still there."""


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the log's entries, in order."""
    fs, path = _fs(spark, f"{root.rstrip('/')}/output/_log")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(path) if s.getPath().getName().isdigit()) if fs.exists(path) else []


def _folder(spark: SparkSession, root: str, number: int) -> str:
    fs, path = _fs(spark, f"{root.rstrip('/')}/output/_log/{number:010d}")
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["folder"]
    finally:
        stream.close()


def version(spark: SparkSession, root: str) -> int:
    """The current version, 0 before the first promotion."""
    return max(_versions(spark, root), default=0)


def current(spark: SparkSession, root: str) -> DataFrame:
    """The output as the last promotion left it."""
    number = version(spark, root)
    if not number:
        raise FileNotFoundError(f"nothing has been promoted to {root}")
    schema = ", ".join(f"`{name}` string" for name, _ in fixed.OUTPUT_COLUMNS)
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/output/{_folder(spark, root, number)}")


def _commit(spark: SparkSession, root: str, number: int, folder: str) -> None:
    """Writes an entry of the log beside its place and moves it there, unless there is one."""
    jvm, log = spark._jvm, f"{root.rstrip('/')}/output/_log"
    fs, part = _fs(spark, f"{log}/_{uuid.uuid4().hex}")
    fs.mkdirs(part.getParent())
    out = fs.create(part)
    out.write(bytearray(json.dumps({"folder": folder}).encode()))
    out.close()
    target = jvm.org.apache.hadoop.fs.Path(f"{log}/{number:010d}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), spark._jsc.hadoopConfiguration())
    try:
        # A rename that doesn't replace: of two runs with this number one fails.
        context.rename(part, target, spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Exception as e:
        fs.delete(part, False)
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"version {number} of {root} is another run's") from e
        raise


def promote(spark: SparkSession, root: str, run_tag: str, promote_empty: bool = False, based_on: int | None = None, keep: int = 3) -> int | None:
    """The staged rows become the next version of the output, in one step for readers. Without rows the output stays as it
    is (None), unless told otherwise. based_on: the version that the run began from; if it isn't current any more, or
    another run takes the next number first, Conflict is raised and nothing changes. The last versions (keep) stay."""
    staged = staging_path(root, run_tag)
    rows = spark.read.parquet(staged).count()
    fs, source = _fs(spark, staged)
    if rows == 0 and not promote_empty:
        fs.delete(source, True)
        return None
    log = _versions(spark, root)
    last = max(log, default=0)
    if based_on is not None and based_on != last:
        raise Conflict(f"{root} is at version {last}, not {based_on}")
    folder = f"{last + 1:010d}-{run_tag[:12]}-{uuid.uuid4().hex[:8]}"
    _, target = _fs(spark, f"{root.rstrip('/')}/output/{folder}")
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):  # no reader knows of it yet
        raise OSError(f"can't move {source} to {target}")
    try:
        _commit(spark, root, last + 1, folder)
    except Exception:
        fs.rename(target, source)
        raise
    for number in log[: max(0, len(log) + 1 - keep)]:
        old = _folder(spark, root, number)
        # The entry goes first: who reads the log finds only versions that are there.
        fs.delete(_fs(spark, f"{root.rstrip('/')}/output/_log/{number:010d}")[1], False)
        fs.delete(_fs(spark, f"{root.rstrip('/')}/output/{old}")[1], True)
    return rows


def append_results(results: DataFrame, path: str, format: str = "json") -> None:
    """A second copy of the results as data set rows, added to what is there."""
    results.write.mode("append").format(format).save(path)


def write_csv(results: DataFrame, path: str) -> None:
    output_columns(results).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_summary(health: DataFrame, path: str) -> None:
    health.write.mode("overwrite").json(path)
