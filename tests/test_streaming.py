import datetime

from mentionflow.streaming.results import recent_unique


def test_stream_keeps_first_of_each_url(spark, tmp_path):
    schema = "arrived timestamp, kol_id string, roster_seq int, url string, published_date string, activity_type string"
    at = datetime.datetime(2024, 1, 31)
    rows = [(at, "K", 1, u, d, "Press") for u, d in (("https://a.org/x?ref=1", "today"), ("https://a.org/x/", "today"), ("https://a.org/old", "2020-01-01"), ("https://md.com/", "today"), ("https://b.org", "2 days ago"))]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    stream = recent_unique(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), at.date(), 7)
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination(120)
    assert sorted(r.norm_url for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["https://a.org/x", "https://b.org/"]
