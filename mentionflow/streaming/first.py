"""First-wins rules over streams, whatever the order in which results arrive.

The batch rules ask for the first result in the order of queries, items and results, and a merged item overrides the other
items of its query. In a stream the first to arrive may be none of them. So state holds the best seen so far, and what a
merged item would replace; an event-time timer gives the rows out when the look-back since the latest arrival is over, and
clears the state. Rows of a key that come later than that begin anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..functions.text import first_of, trimmed
from ..functions.url import normalized

EXPERT = ["kol_id", "roster_seq"]
#: The state store that these rules need; set it before the stream starts.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Timed(StatefulProcessor):
    """State that is given out and cleared when no row has come for the look-back. One timer for a key, at its latest
    arrival: the watermark is the look-back behind."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "ms long")

    def wait(self, rows: pd.DataFrame) -> None:
        latest = int(rows["ms"].max())
        if self.due.exists():
            before = int(self.due.get()[0])
            if before >= latest:
                return
            self.handle.deleteTimer(before)
        self.due.update((latest,))
        self.handle.registerTimer(latest)

    def close(self) -> None:
        pass


class FirstResults(_Timed):
    """Of an expert's results the first of each URL; where a query has a merged item with results, only its first counts.

    State: by query, the first merged item and whether it has results; by query and URL the best result of all items, and
    the best of the merged item with the smallest place so far.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.merged = handle.getMapState("merged", "cluster_no int", "item_pos long, usable boolean")
        self.best = handle.getMapState("best", "cluster_no int, key string, of_merged boolean", "item_pos long, result_pos int, url string, value string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            self.wait(batch)
            whole = batch[batch["merged"]].sort_values(["item_pos", "usable"]).drop_duplicates("cluster_no")
            for r in whole.itertuples():
                new = (int(r.item_pos), bool(r.usable))
                if not self.merged.containsKey((r.cluster_no,)) or new < tuple(self.merged.getValue((r.cluster_no,))):
                    self.merged.updateValue((r.cluster_no,), new)
            shown = batch[batch["key"].notna()].sort_values(["item_pos", "result_pos", "url"])
            for of_merged, part in ((False, shown), (True, shown[shown["merged"]])):
                for r in part.drop_duplicates(["cluster_no", "key"]).itertuples():
                    at, new = (int(r.cluster_no), r.key, of_merged), (int(r.item_pos), int(r.result_pos), r.url, r.value)
                    if not self.best.containsKey(at) or new[:3] < tuple(self.best.getValue(at))[:3]:
                        self.best.updateValue(at, new)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        merged = {k[0]: tuple(v) for k, v in self.merged.iterator()}
        first: dict[str, tuple] = {}
        for (cluster_no, url_key, of_merged), (item_pos, result_pos, url, value) in self.best.iterator():
            place, usable = merged.get(cluster_no, (None, False))
            if of_merged != usable or (usable and item_pos != place):
                continue
            new = (cluster_no, item_pos, result_pos, url, value)
            if url_key not in first or new < first[url_key]:
                first[url_key] = new
        for state in (self.merged, self.best, self.due):
            state.clear()
        yield pd.DataFrame({"value": [v[-1] for v in first.values()]})


class FirstInOrder(_Timed):
    """The row of a key that is first in order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.first = handle.getValueState("first", "cluster_no int, item_pos long, result_pos int, url string, value string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            self.wait(batch)
            r = next(batch.sort_values(["cluster_no", "item_pos", "result_pos", "url"]).itertuples())
            new = (int(r.cluster_no), int(r.item_pos), int(r.result_pos), r.url, r.value)
            if not self.first.exists() or new < tuple(self.first.get()):
                self.first.update(new)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        value = self.first.get()[-1]
        self.first.clear()
        self.due.clear()
        yield pd.DataFrame({"value": [value]})


def _given_out(rows: DataFrame, by: list[str], processor: StatefulProcessor, schema: StructType) -> DataFrame:
    out = rows.groupBy(*by).transformWithStateInPandas(statefulProcessor=processor, outputStructType="value string", outputMode="Append", timeMode="EventTime")
    return out.select(F.from_json("value", schema).alias("_v")).select("_v.*")


def _ms(stamp: str):
    return F.unix_millis(F.col(stamp))


def first_results(items: DataFrame, look_back: str, arrived: str = "arrived") -> DataFrame:
    """A stream of attributed items (serp.attributed, and when they arrived) as the rows of serp.first_by_url of
    serp.flattened. An expert's rows are given out together."""
    each = items.withWatermark(arrived, look_back).select(*EXPERT, "cluster_no", "search_query", "item_pos", "merged", F.col("results").isNotNull().alias("usable"), arrived, F.posexplode_outer("results").alias("result_pos", "r"))
    each = each.withColumn("url", first_of("r.url", "r.link")).withColumn("item_pos", F.col("item_pos").cast("long"))
    value = F.struct(*EXPERT, "cluster_no", "search_query", "item_pos", "result_pos", "r", "url")
    key = F.when((F.col("url") != "") & (trimmed("url") != ""), trimmed("url"))
    rows = each.select(*EXPERT, "cluster_no", "item_pos", "result_pos", "url", key.alias("key"), "merged", "usable", F.to_json(value, {"ignoreNullFields": "false"}).alias("value"), _ms(arrived).alias("ms"), arrived)
    return _given_out(rows, EXPERT, FirstResults(), each.select(value.alias("v")).schema["v"].dataType)


def first_by_normal_url(results: DataFrame, look_back: str, arrived: str = "arrived") -> DataFrame:
    """A stream of results (with cluster_no, item_pos, result_pos and when they arrived) as the rows of
    urlfilter.first_by_normal_url: the first in order of each expert and normalised URL."""
    rest = [c for c in results.columns if c != arrived]
    rows = results.withWatermark(arrived, look_back).withColumn("norm_url", normalized("url")).filter("norm_url <> ''")
    value = F.struct(*rest, "norm_url")
    given = rows.select(*EXPERT, "norm_url", F.col("cluster_no").cast("int"), F.col("item_pos").cast("long"), F.col("result_pos").cast("int"), "url", F.to_json(value, {"ignoreNullFields": "false"}).alias("value"), _ms(arrived).alias("ms"), arrived)
    return _given_out(given, [*EXPERT, "norm_url"], FirstInOrder(), rows.select(value.alias("v")).schema["v"].dataType)
