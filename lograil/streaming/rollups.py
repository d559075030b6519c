"""Rollups kept from a stream: months of committed partials, merge on read, compaction, and final hourly rows."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from lograil.operators.rollups import ROLLUPS, monthly_partials
from lograil.schema import LOG_SCHEMA
from lograil.sinks.commits import CommitTable

_schemas: dict[str, str] = {}


def rollup_table(spark: SparkSession, root: str, name: str) -> CommitTable:
    """The stored partials of a rollup, parted by month."""
    if name not in _schemas:
        empty = monthly_partials(name, spark.createDataFrame([], LOG_SCHEMA)).drop("month")
        _schemas[name] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in empty.schema)
    return CommitTable(spark, f"{root}/rollups/{name}", _schemas[name], key="month", kind="string",
                       spread=False)


def write_rollup(logs: DataFrame, root: str, name: str, writer: str, batch_id: int) -> None:
    """The partials of one batch, per month; a batch that has been written adds nothing."""
    table = rollup_table(logs.sparkSession, root, name)
    table.append(monthly_partials(name, logs), writer=writer, batch_id=batch_id)


def read_partials(spark: SparkSession, root: str, name: str, months=None) -> DataFrame:
    """The partials of some months, or of all, without the month."""
    wanted = None if months is None else set(months)
    return rollup_table(spark, root, name).read(
        only=lambda month, _: wanted is None or month in wanted).drop("month")


def read_rollup(spark: SparkSession, root: str, name: str, months=None) -> DataFrame:
    """A rollup as of now: the partials of all batches merged by key. Months not asked for stay closed."""
    _, merge = ROLLUPS[name]
    return merge(read_partials(spark, root, name, months))


def compact_rollup(spark: SparkSession, root: str, name: str, month: str | None = None) -> list[str]:
    """Merge the partials of a month, or of every month, into one state each; returns the merged months.

    Each month is one commit: readers see its partials or its state, and batches that come or repeat
    meanwhile count once.
    """
    _, merge = ROLLUPS[name]
    table = rollup_table(spark, root, name)
    months = sorted({m for m, _ in table.snapshot().live}) if month is None else [month]
    return [m for m in months
            if table.compact(m, lambda rows, m=m: merge(rows.drop("month")).withColumn("month", F.lit(m))) is not None]


def retire_rollup(spark: SparkSession, root: str, name: str, before: str) -> list[str]:
    """Remove the months before a month (``yyyy-MM``); only the commit log is read."""
    table = rollup_table(spark, root, name)
    return table.retire({m for m, _ in table.snapshot().live if m < before})


def hourly_health_stream(logs: DataFrame, delay="1 hour") -> DataFrame:
    """Final hourly service health rows, each emitted once its hour is closed.

    Records later than ``delay`` behind the newest are missing here; the batch partials have them.
    """
    return (
        logs.withWatermark("created_at", delay)
        .groupBy(F.window("created_at", "1 hour"), "source_service")
        .agg(F.count("*").alias("log_count"), F.max("created_at").alias("last_log_time"),
             F.min("created_at").alias("min_log_time"))
        .select(F.col("window.start").alias("hour"), "source_service", "log_count",
                "last_log_time", "min_log_time")
    )
