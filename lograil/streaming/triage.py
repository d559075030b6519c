"""Scheduled triage runs over the dead-letter queue: report, replay or park, commit; and release of parked letters."""

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lograil.functions import jsonx
from lograil.operators import dlq, replay
from lograil.operators.signals import health_signals, table_signals
from lograil.session import small_batches
from lograil.sinks import files
from lograil.sinks.commits import CommitTable
from lograil.sources.topics import read_front, read_stored, read_topic_files, stored_ends

COMMITTED_SCHEMA = "partition int, committed_offset bigint"
PARKED_SCHEMA = ("partition int, offset bigint, key string, timestamp timestamp, value string, "
                 "error_class string, reason string, run_id int")
PLACE = ["partition", "offset"]
# Of a classified letter, what its verdict and the commit points need.
CLASSIFIED = [*PLACE, "key", "timestamp", "value", "error_class"]
ROW_GROUP_BYTES = 32 << 20


def complete_runs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete folders ``run_id=N`` below a path (names only are read)."""
    runs = [n.removeprefix("run_id=") for n in files.names(spark, path) if n.startswith("run_id=")]
    return sorted(int(n) for n in runs if "_SUCCESS" in files.names(spark, f"{path}/run_id={n}"))


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """Committed offset per partition: the highest of all runs."""
    runs = complete_runs(spark, path)
    empty = spark.createDataFrame([], COMMITTED_SCHEMA)
    if not runs:
        return empty
    stored = spark.read.schema(COMMITTED_SCHEMA).parquet(*[f"{path}/run_id={r}" for r in runs])
    return replay.merge_committed(empty, stored)


def summary_table(spark: SparkSession, path: str) -> CommitTable:
    """Stored triage partials, parted by the month of arrival."""
    if not _summary_schema:
        letters = spark.createDataFrame([], "error_class string, error_reason string, value_preview string, key string, "
                                            "timestamp timestamp, partition int, offset bigint, _v int")
        _summary_schema.append(", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in dlq.triage_partials(letters).schema))
    return CommitTable(spark, path, _summary_schema[0], key="month", kind="string", spread=False)


_summary_schema: list[str] = []


def write_summary(topic: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """Triage partials of the letters of one batch; a batch that repeats replaces its own.

    A class counts for the month of its first letter in the batch.
    """
    # Totals, reasons and first letters come from it: each letter is read and classified once.
    with small_batches(topic.sparkSession):
        classified = dlq.classify(dlq.decode(topic)).select("error_class", *dlq.SAMPLE_FIELDS).persist(
            StorageLevel.MEMORY_AND_DISK)
    month = F.date_format(F.get(F.col("letters"), 0)["timestamp"], "yyyy-MM")
    partials = dlq.triage_partials(classified).withColumn("month", F.coalesce(month, F.lit("none")))
    try:
        summary_table(topic.sparkSession, path).append(partials, writer=writer, batch_id=batch_id, replace=True)
    finally:
        classified.unpersist()


def stored_report(spark: SparkSession, path: str, months=None) -> DataFrame:
    """The triage report of all letters, or of some months, without opening a letter."""
    wanted = None if months is None else set(months)
    rows = summary_table(spark, path).read(only=lambda month, _: wanted is None or month in wanted)
    return dlq.report_of_partials(rows.drop("month"))


def compact_summary(spark: SparkSession, path: str) -> None:
    """Merge the partials of each month into one per class."""
    table = summary_table(spark, path)
    for month in sorted({m for m, _ in table.snapshot().live}):
        table.compact(month, lambda rows, m=month: dlq.merge_triage_partials(rows.drop("month")).withColumn(
            "month", F.lit(m)))


@dataclass
class TriageJob:
    """Reads the queue from the committed offsets, reports, replays or parks each letter, commits.

    A letter is replayed if the gate is open (or forced) and ingest would accept it; it is parked,
    whole and with the reason, otherwise. So the queue moves on and nothing leaves it unseen.
    ``park_refused=False`` leaves the queue as it is while the gate is closed. ``release`` takes parked
    letters up again once the cause is mended.

    Every outcome is written once: a run that is repeated after a stop adds only the letters that its
    first attempt has not written, whatever came into the queue meanwhile.
    """

    spark: SparkSession
    root: str
    sample_size: int | None = dlq.SAMPLE_SIZE
    park_refused: bool = True

    def run(self, topic: DataFrame | CommitTable, logs: DataFrame | CommitTable, as_of: Column, run_id: int,
            force=False, dry_run=False) -> DataFrame:
        """One run; returns the stored one-row final report.

        ``topic`` and ``logs`` may be stored tables: then the run opens only the segments behind the
        committed offsets that it needs, and takes backlog and signals from the tables' commit logs.
        Replayed and parked letters are written before the offsets, so a run that breaks in between
        is repeated rather than lost. ``sample_size=None`` takes the whole backlog.
        """
        committed = read_committed(self.spark, f"{self.root}/committed")
        stored = isinstance(topic, CommitTable)
        if self.sample_size is None:
            taken = read_stored(topic, committed) if stored else dlq.uncommitted(topic, committed)
        else:
            front = read_front(topic, committed, self.sample_size) if stored else topic
            taken = dlq.sample(front, committed, self.sample_size)
        ends = stored_ends(topic) if stored else dlq.end_offsets(topic)
        signals = table_signals(logs, as_of) if isinstance(logs, CommitTable) else health_signals(logs, as_of)
        target, work = f"{self.root}/reports/run_id={run_id}", f"{self.root}/work/run_id={run_id}"
        try:
            # Each letter is classified once and checked once. What comes of it is read several times from
            # written tables: whole letters, each with what it replays, are more than executors can cache.
            classified = self._kept(dlq.classify(dlq.decode(taken)).select(*CLASSIFIED), f"{work}/classified")
            gate = replay.replay_gate(dlq.dominant_class(dlq.class_counts(classified))).persist()
            opened = force or gate.first()["should_replay"]
            letters = classified.withColumn("_v", jsonx.parse(F.col("value")))
            verdict = self._kept(replay.with_verdict(letters, None if opened else gate).select(
                *replay.PARKED_COLUMNS, "replay_key", "replay_value"), f"{work}/verdict")
            rows = replay.replays(verdict)
            report = replay.final_report(
                dlq.backlog_behind(ends, committed), gate, signals,
                replay.replay_report(gate, rows, dry_run=dry_run, force=force))
            if not dry_run and (opened or self.park_refused):
                self._add(rows, "replayed", run_id)
                self._add(replay.parked(verdict), "parked", run_id)
                replay.commit_points(classified).write.mode("overwrite").parquet(
                    f"{self.root}/committed/run_id={run_id}")
            report.write.mode("overwrite").parquet(target)
            gate.unpersist()
        finally:
            files.remove(self.spark, work)
        return self.spark.read.parquet(target)

    def _kept(self, rows: DataFrame, path: str) -> DataFrame:
        """The rows as a written table, in row groups that fit beside each other in the memory of an executor."""
        rows.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def release(self, run_id: int, reason: str | None = None, error_class: str | None = None) -> int:
        """Sends parked letters on that ingest would accept by now; returns how many.

        ``reason`` (a pattern) and ``error_class`` choose among them. What ingest would still refuse
        stays parked. ``run_id`` is one of its own, not that of a run; repeated, it adds nothing.
        """
        letters = self.parked()
        if reason is not None:
            letters = letters.filter(F.col("reason").rlike(reason))
        if error_class is not None:
            letters = letters.filter(F.col("error_class") == error_class)
        topic = letters.select(
            F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value"), *PLACE, "timestamp",
            F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"))
        rows = replay.replays(replay.with_verdict(dlq.decode(topic)))
        return self._add(rows, "replayed", run_id)

    def _add(self, rows: DataFrame, name: str, run_id: int) -> int:
        """Write the rows that this run has not written before; how many there are in all."""
        target = f"{self.root}/{name}/run_id={run_id}"
        if run_id in complete_runs(self.spark, f"{self.root}/{name}"):
            before = self.spark.read.schema(rows.schema).parquet(target)
            rows = rows.join(before.select(*PLACE), PLACE, "left_anti").select(*rows.columns)
        rows.write.mode("append").parquet(target)
        return self.spark.read.schema(rows.schema).parquet(target).count()

    def replay_stream(self) -> DataFrame:
        """All replayed letters as a topic stream, for ``TopicIngest.start``."""
        return read_topic_files(self.spark, f"{self.root}/replayed/run_id=*")

    def _stored(self, name: str) -> DataFrame | None:
        runs = complete_runs(self.spark, f"{self.root}/{name}")
        return self.spark.read.option("basePath", f"{self.root}/{name}").parquet(
            *[f"{self.root}/{name}/run_id={r}" for r in runs]) if runs else None

    def parked(self) -> DataFrame:
        """The parked letters that have not been sent on since."""
        letters, sent = self._stored("parked"), self._stored("replayed")
        if letters is None:
            return self.spark.createDataFrame([], PARKED_SCHEMA)
        return letters if sent is None else letters.join(sent.select(*PLACE), PLACE, "left_anti")
