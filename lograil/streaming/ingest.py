"""Streaming ingest: topic messages to the log table, dead letters, rollup partials and statistics.

Each micro-batch commits what it writes under its own number, so a batch that is repeated after a
failure counts once: records and rollups keep the first commit, dead letters and statistics the last.
Offsets live in the query's checkpoint and advance only after the batch function returned.
"""

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from py4j.protocol import Py4JError
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lograil.operators import ingest, jsonlog
from lograil.operators.metrics import observed
from lograil.operators.rollups import ROLLUPS
from lograil.operators.validate import accepted, finish, rejected
from lograil.schema import BATCH_STATS_SCHEMA, LOG_COLUMNS
from lograil.session import small_batches
from lograil.sinks.commits import CommitTable
from lograil.sinks.tables import store_batch, write_batch
from lograil.sinks.topics import append_topic, topic_table
from lograil.sources.topics import DLQ_TOPIC, RAW_TOPIC, topic_text
from lograil.streaming.rollups import write_rollup
from lograil.streaming.triage import write_summary

# Attempts per batch, pauses between them in seconds, and the flush interval.
MAX_ATTEMPTS = 3
PAUSES = (1, 2)
FLUSH_INTERVAL = "5 seconds"
# Writes of a batch that run side by side.
WRITERS = 6

_POSITION = ["topic", "partition", "offset"]
_PLACE = ["partition", "offset", "timestamp"]
ERROR_CHARS = 300
# All rollups but the one that keeps every message.
BOUNDED_ROLLUPS = tuple(name for name in ROLLUPS if name != "error_messages")


def short_text(error: Exception) -> str:
    """The first line of an error, without the stack trace of the JVM."""
    text = str(getattr(error, "java_exception", None) or error).strip()
    return (text.splitlines() or [type(error).__name__])[0][:ERROR_CHARS]


def is_storage_failure(error: Exception) -> bool:
    """Failures of the file system or of Spark while it writes."""
    return isinstance(error, (OSError, Py4JError, PySparkException))


def uncompressed(spark: SparkSession):
    """What is cached meanwhile is kept plain: a batch lives shortly, and choosing codes for its columns costs more than they save."""
    return small_batches(spark, compressed=False)


@dataclass
class TopicIngest:
    """The ingest stream: parsing is part of the stream, writing is its batch function."""

    spark: SparkSession
    root: str
    topic: str = RAW_TOPIC
    rollups: tuple = BOUNDED_ROLLUPS
    summaries: bool = False  # also keep triage partials of the dead letters
    store: object = None
    pause: object = time.sleep
    clock: object = field(default=time.monotonic)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def writer(self) -> str:
        """Who commits: the stream as its checkpoint knows it, so that batch numbers are its own."""
        query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        return f"{self.topic}/{query or 'batches'}"

    def prepare(self, topic: DataFrame) -> DataFrame:
        """Topic rows (stream or batch) to checked records.

        Of a message only its place is kept besides its record, and the text of a refused one.
        """
        done = finish(
            jsonlog.parse_messages(topic_text(topic)), ingested_at=F.col("timestamp"),
            id_from=_POSITION, promoted=True, meta="_meta")
        return done.select(*_POSITION, "timestamp", *LOG_COLUMNS, "errors", F.when(
            F.col("errors").isNotNull(), F.col("value")).alias("value"))

    def run_batch(self, topic: DataFrame, batch_id: int) -> None:
        """Handle a plain batch of topic rows as the stream would."""
        self(self.prepare(topic), batch_id)

    def __call__(self, done: DataFrame, batch_id: int) -> None:
        started, writer = self.clock(), self.writer()
        # Read several times below; recomputed from the source if an executor is lost. The count fills
        # it; observed counters may count rows again that are computed again, these do not.
        with uncompressed(done.sparkSession):
            done = done.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = done.agg(
                F.count("*").alias("consumed"),
                F.count_if(F.col("errors").isNotNull()).alias("rejected")).first()
            placed = accepted(done, _PLACE)
            logs = placed.select(*LOG_COLUMNS)
            failed, problem, write_seconds = self._store(logs, batch_id, writer)
            jobs = self._dead_letter_jobs(done, placed, problem, batch_id, writer)
            if problem is None:
                jobs += [partial(write_rollup, logs, self.root, name, writer, batch_id) for name in self.rollups]
            self._at_once(jobs)
            good = counts["consumed"] - counts["rejected"]
            self._write_stats(batch_id, (
                batch_id, self.topic, counts["consumed"], good if problem is None else 0,
                counts["rejected"], "success" if problem is None else "dlq", failed,
                None if problem is None else problem[0], write_seconds,
                self.clock() - started))
        finally:
            done.unpersist()

    def _at_once(self, jobs) -> None:
        """Independent writes of a batch run side by side: each is a short job of its own."""
        with ThreadPoolExecutor(WRITERS) as pool:
            for future in [pool.submit(inheritable_thread_target(self.spark)(job)) for job in jobs]:
                future.result()

    def _store(self, logs, batch_id, writer):
        """Write the logs; after the last failed attempt return (type, text) of the problem."""
        for attempt in range(1, MAX_ATTEMPTS + 1):
            started = self.clock()
            try:
                store = self.store or partial(store_batch, writer=writer)
                store(logs, self.path("logs"), batch_id)
                return attempt - 1, None, self.clock() - started
            except Exception as error:  # noqa: BLE001 - any failure must end in the queue
                if is_storage_failure(error):
                    problem = (ingest.INSERT_FAILURE,
                               f"Failed to insert after {MAX_ATTEMPTS} retries: {short_text(error)}")
                else:
                    problem = (f"unexpected_{type(error).__name__}",
                               f"Unexpected error during flush: {short_text(error)}")
            if attempt < MAX_ATTEMPTS:
                self.pause(PAUSES[attempt - 1])
        return MAX_ATTEMPTS, problem, self.clock() - started

    def _dead_letter_jobs(self, done, placed, problem, batch_id, writer):
        """Writes of the dead letters as topic records; a letter keeps the position of the message it stands for."""
        refused = rejected(done, "value", [*_POSITION, "timestamp"])
        letters = ingest.message_reject_envelopes(refused, F.col("timestamp"), _POSITION, _PLACE)
        if problem is not None:
            letters = ingest.union_envelopes(letters, ingest.failed_batch_envelopes(
                placed, F.col("ingested_at"), problem[1], problem[0], _PLACE))
        topic = letters.select(
            F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"),
            F.lit(DLQ_TOPIC).alias("topic"), *_PLACE, F.lit(0).alias("timestampType"),
            F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"))
        jobs = [partial(append_topic, topic, self.path("dead_letters"), writer, batch_id)]
        if self.summaries:
            jobs.append(partial(write_summary, topic, self.path("triage"), writer, batch_id))
        return jobs

    def dead_letters(self) -> CommitTable:
        """The dead-letter queue that this stream wrote, as a stored topic."""
        return topic_table(self.spark, self.path("dead_letters"))

    def _write_stats(self, batch_id, row):
        # One task; a local list would go through Python workers on every core.
        frame = self.spark.range(1, numPartitions=1).select(*[
            F.lit(value).cast(f.dataType).alias(f.name) for value, f in zip(row, BATCH_STATS_SCHEMA)])
        write_batch(frame.drop("batch_id"), self.path("stats"), batch_id)

    def start(self, stream: DataFrame, checkpoint: str, available_now=False):
        """Run the stream: every few seconds over all that has come, or once over all that is there."""
        parsed = observed(self.prepare(stream))
        writer = parsed.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        if available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=FLUSH_INTERVAL).start()
