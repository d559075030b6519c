"""A live alarm for services that fall silent: one row of state and one timer for each service.

Rows are first reduced to the newest time per service in every task, so a busy service moves a few rows
per batch. The state holds that time; an event-time timer an hour behind it goes off once the watermark
has passed it without a newer record, and the service is reported silent. Its next record reports it
back. Records later than the watermark are dropped by Spark, as they cannot end a silence already told.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ALARM_SCHEMA = "source_service string, state string, last_log_time timestamp, at timestamp"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Silence(StatefulProcessor):
    """Per service: the time of its newest record and whether it has been reported silent."""

    def __init__(self, silent_ms: int):
        self.silent_ms = silent_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "last_ms long, silent boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(part["last_ms"].max()) for part in rows)
        last, silent = self.known.get() if self.known.exists() else (None, False)
        if last is None or newest > last:
            if last is not None and not silent:
                self.handle.deleteTimer(last + self.silent_ms)
            self.known.update((newest, False))
            self.handle.registerTimer(newest + self.silent_ms)
            if silent:
                yield self._row(key, "back", newest, newest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, _ = self.known.get()
        self.known.update((last, True))
        yield self._row(key, "silent", last, expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass

    @staticmethod
    def _row(key, state, last, at) -> pd.DataFrame:
        return pd.DataFrame({"source_service": [key[0]], "state": [state], "last_ms": [last], "at_ms": [at]})


def _newest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield rows.groupby("source_service", as_index=False, dropna=False)["last_ms"].max()


def silence_stream(logs: DataFrame, silent_hours: float = 1, delay="10 minutes") -> DataFrame:
    """A stream of ``ALARM_SCHEMA``: a row when a service has been silent so long, and one when it is back.

    Silence is judged in event time, at the watermark (``delay`` behind the newest record). The stream
    keeps its state in RocksDB, which ``prepare`` sets.
    """
    prepare(logs.sparkSession)
    times = logs.select("source_service", F.unix_millis("created_at").alias("last_ms"))
    newest = times.mapInPandas(_newest, "source_service string, last_ms long").select(
        "source_service", "last_ms", F.timestamp_millis("last_ms").alias("last_log_time"))
    told = newest.withWatermark("last_log_time", delay).groupBy("source_service").transformWithStateInPandas(
        statefulProcessor=Silence(int(silent_hours * 3_600_000)),
        outputStructType="source_service string, state string, last_ms long, at_ms long",
        outputMode="Update", timeMode="EventTime")
    return told.select("source_service", "state", F.timestamp_millis("last_ms").alias("last_log_time"),
                       F.timestamp_millis("at_ms").alias("at"))


def prepare(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def silent_now(told: DataFrame) -> DataFrame:
    """The services that are silent after all rows that the stream has told."""
    w = Window.partitionBy("source_service").orderBy(F.desc("last_log_time"), F.desc("state"))
    return told.withColumn("_rank", F.row_number().over(w)).filter(
        (F.col("_rank") == 1) & (F.col("state") == "silent")).drop("_rank")
