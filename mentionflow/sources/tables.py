"""Input tables: roster, search-result dumps, fetch log, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROSTER = "kol_id string, kol_name string, suffix string, affiliation string, specialty string"
FIELDS = "url link title description snippet publishedDate date published_date publishDate publishedAt author position".split()
RESULT = f"struct<{', '.join(f'{name}: string' for name in FIELDS)}>"
SERP_ITEMS = (
    "kol_id string, roster_seq int, chunk_no int, item_pos int, keyword string, query string, searchQuery string,"
    f" page_number string, page string, results array<{RESULT}>"
)
FETCH_LOG = "kol_id string, roster_seq int, cluster_no int, query string, status string, error string"
PAGES = "url string, html string"


CORRUPT = "_corrupt"


def _parsed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The columns of schema by name, and for records that can't be read their text in a column of its own (null else)."""
    names = spark.createDataFrame([], schema).columns
    if path.endswith((".csv", ".csv.gz")):
        options = {"header": True, "multiLine": True, "escape": '"', "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
        there = spark.read.options(**options).csv(path).columns
        # By the names of the header, whatever their order; files of other headers than the first one's raise.
        raw = spark.read.options(**options, enforceSchema=False).schema(", ".join(f"`{c}` string" for c in [*there, CORRUPT])).csv(path)
        kinds = dict(spark.createDataFrame([], schema).dtypes)
        value = {c: F.expr(f"try_cast(`{c}` AS {kinds[c]})") if c in there else F.lit(None).cast(kinds[c]) for c in names}
        broken = F.lit(False)
        for c in names:
            if c in there and kinds[c] != "string":  # a value that is no number is a record that can't be read
                broken = broken | (F.col(f"`{c}`").isNotNull() & value[c].isNull())
        whole = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in there])
        # The reader refuses plans that need nothing but the column of broken records, so this asks for the others as well.
        text = F.when(F.length(whole) >= 0, F.coalesce(CORRUPT, F.when(broken, whole)))
        return raw.select(*[value[c].alias(c) for c in names], text.alias(CORRUPT))
    if path.endswith((".json", ".jsonl", ".json.gz")):
        lines = spark.read.text(path).filter(F.trim("value") != "")
        record = F.from_json("value", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
        return lines.select(F.explode(F.array(record)).alias("r")).select("r.*")
    return spark.read.schema(schema).parquet(path).withColumn(CORRUPT, F.lit(None).cast("string"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV (with a header line) and JSON lines by their ending, Parquet else; columns by name. Records that can't be read
    are left out here: quarantined() has them."""
    return _parsed(spark, path, schema).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """file and record (its text) of the records that _read leaves out."""
    return _parsed(spark, path, schema).select(F.input_file_name().alias("file"), F.col(CORRUPT).alias("record")).filter("record is not null")


def keep_quarantined(spark: SparkSession, sources: dict[str, tuple[str, str]], path: str) -> DataFrame:
    """Writes the records that could not be read, by source (name: path and schema), and gives how many there are of each."""
    whole = None
    for name, (place, schema) in sources.items():
        part = quarantined(spark, place, schema).withColumn("source", F.lit(name))
        whole = part if whole is None else whole.unionByName(part)
    whole.write.mode("append").partitionBy("source").parquet(path)
    return spark.read.schema("file string, record string, source string").parquet(path).groupBy("source").agg(F.count("*").alias("n"))


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, ROSTER)


def read_serp_items(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, SERP_ITEMS)


def read_fetch_log(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, FETCH_LOG)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, PAGES)
