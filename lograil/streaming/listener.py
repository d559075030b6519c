"""Live counters of streams: progress reports and observed counters, appended while a stream runs."""

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from lograil.operators.metrics import OBSERVED
from lograil.sinks import files

PROGRESS_SCHEMA = ("query string, run string, batch_id bigint, at timestamp, input_rows bigint, consumed bigint, "
                   "rejected bigint, flush_seconds double, rows_per_second double")


class ProgressLog(StreamingQueryListener):
    """Appends one small file for every finished batch of every stream of the session.

    Register it with ``spark.streams.addListener``. A file is named after query and batch: a batch that
    runs again after a restart keeps its first report. Batches without input are not reported.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        counted = p.observedMetrics.get(OBSERVED)
        if not p.numInputRows and counted is None:
            return
        line = {
            "query": str(p.id), "run": str(p.runId), "batch_id": p.batchId, "at": p.timestamp,
            "input_rows": p.numInputRows, "flush_seconds": p.durationMs.get("triggerExecution", 0) / 1000,
            "rows_per_second": p.processedRowsPerSecond,
            **({"consumed": counted["consumed"], "rejected": counted["rejected"]} if counted else {})}
        files.put_new(self.spark, f"{self.path}/{p.id}-{p.batchId:012d}.json", json.dumps(line) + "\n")


@dataclass
class LiveCounters:
    """What a ProgressLog has appended so far."""

    spark: SparkSession
    path: str

    def batches(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS_SCHEMA).json(self.path)

    def totals(self) -> DataFrame:
        """Per query: batches, records consumed, stored or refused, and the rate over all."""
        rows = self.batches().groupBy("query").agg(
            F.count("*").alias("batches"), F.sum("consumed").alias("consumed"), F.sum("rejected").alias("rejected"),
            F.sum("flush_seconds").alias("seconds"))
        return rows.select("query", "batches", "consumed", "rejected",
                           (F.col("consumed") - F.col("rejected")).alias("accepted"),
                           F.floor(F.try_divide("consumed", "seconds")).alias("rows_per_second"))
