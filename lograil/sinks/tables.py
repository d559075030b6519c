"""Table sinks: the committed, day-partitioned log table, idempotent batch folders, retention."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from lograil.operators.validate import with_event_date
from lograil.schema import LOG_COLUMNS, LOG_SCHEMA
from lograil.sinks.commits import CommitTable

# Columns searched by equality that the sort order does not serve.
BLOOM_COLUMNS = ("trace_id", "user_id")
RETENTION_DAYS = 30


def bloom_options() -> dict:
    """Bloom filters sized by the values a file holds; for the log table's large files only."""
    options = {"parquet.bloom.filter.adaptive.enabled": "true"}
    for name in BLOOM_COLUMNS:
        options[f"parquet.bloom.filter.enabled#{name}"] = "true"
    return options


LOG_ORDER = ("source", "level", "created_at")
# Statistics kept of every folder of the log table.
LOG_STATS = {
    "rows": ("bigint", "count(*)"),
    "min_created_at": ("timestamp", "min(created_at)"),
    "max_created_at": ("timestamp", "max(created_at)"),
    "max_ingested_at": ("timestamp", "max(ingested_at)"),
    "unparsed": ("bigint", "count_if(is_parsed = 0)"),
}


def log_table(spark: SparkSession, path: str, fields=False) -> CommitTable:
    """The log table at a path: days of committed folders.

    With ``fields`` it has the metadata a second time as a VARIANT column of that name, which files
    keep in typed columns per member: a search by a member reads that member alone.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LOG_SCHEMA)
    return CommitTable(spark, path, schema + ", fields variant" * fields, stats=LOG_STATS)


def append_logs(logs: DataFrame, path: str, fields=False) -> None:
    """Append log records, partitioned by day and sorted by source, level and time, with Bloom filters.

    The rows are spread by day so that each day gets few, evenly sized files; adaptive execution
    splits a day that is larger than the others.
    """
    table, rows = log_table(logs.sparkSession, path, fields), logs.select(*LOG_COLUMNS)
    table.options = bloom_options()
    table.append(with_event_date(rows.withColumn("fields", F.try_parse_json("metadata")) if fields else rows), LOG_ORDER)


def store_batch(logs: DataFrame, path: str, batch_id: int, writer="stream") -> None:
    """One micro-batch of a stream into the log table; a batch that was stored before adds nothing.

    ``writer`` names the stream, so that several may write into one table.
    """
    log_table(logs.sparkSession, path).append(
        with_event_date(logs.select(*LOG_COLUMNS)), LOG_ORDER, writer, batch_id)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch to its own folder, replacing what an earlier attempt left there."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch_id={batch_id}")


def compact_day(spark: SparkSession, path: str, day: str) -> int | None:
    """Rewrite one day as few large files with Bloom filters, in one commit.

    The stream may go on meanwhile, and repeat batches that are merged here.
    """
    return log_table(spark, path).compact(day, order=LOG_ORDER, options=bloom_options())


def retained(logs: DataFrame, as_of, days=RETENTION_DAYS) -> DataFrame:
    """The records that are younger than the retention period at ``as_of``."""
    oldest = _timestamp(as_of) - dt.timedelta(days=days)
    kept = logs.filter(F.col("created_at") > F.lit(oldest).cast("timestamp"))
    if "event_date" in logs.columns:
        kept = kept.filter(F.col("event_date") >= F.lit(oldest.date()))
    return kept


def drop_expired_days(spark: SparkSession, path: str, as_of, days=RETENTION_DAYS) -> list[str]:
    """Remove the day partitions that lie wholly before the retention period.

    Only the commit log is read; returns the removed days.
    """
    oldest = (_timestamp(as_of) - dt.timedelta(days=days)).date().isoformat()
    table = log_table(spark, path)
    return table.retire({day for day, _ in table.snapshot().live if day < oldest})


def _timestamp(value) -> dt.datetime:
    return value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(str(value))
