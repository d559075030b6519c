"""Health signals of the log table at a given time."""

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from lograil.sinks.commits import CommitTable

UNPARSED_WINDOW_MINUTES = 10


def recent_unparsed(logs: DataFrame, as_of: Column,
                    minutes=UNPARSED_WINDOW_MINUTES) -> DataFrame:
    """Unparsed records of the last minutes. A day-partitioned table reads one or two days."""
    start = as_of - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    found = logs.filter((F.col("is_parsed") == 0) & (F.col("created_at") >= start))
    if "event_date" in logs.columns:
        found = found.filter(F.col("event_date") >= F.to_date(start))
    return found.agg(F.count("*").alias("parse_errors_last_10min"))


def freshness(logs: DataFrame, as_of: Column) -> DataFrame:
    """Latest ingest time, the lag behind ``as_of`` in seconds, and the number of records."""
    df = logs.agg(F.max("ingested_at").alias("max_ingested_at"),
                  F.count("*").alias("total_logs_count"))
    lag = (F.unix_micros(as_of) - F.unix_micros("max_ingested_at")) / 1_000_000
    return df.select("max_ingested_at", lag.alias("ingestion_lag_seconds"), "total_logs_count")


def health_signals(logs: DataFrame, as_of: Column,
                   minutes=UNPARSED_WINDOW_MINUTES) -> DataFrame:
    """All signals as one row from one scan of three columns; an empty table gives 0 and nulls."""
    start = as_of - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    df = logs.agg(
        F.count_if((F.col("is_parsed") == 0) & (F.col("created_at") >= start))
        .alias("parse_errors_last_10min"),
        F.max("ingested_at").alias("max_ingested_at"),
        F.count("*").alias("total_logs_count"))
    lag = (F.unix_micros(as_of) - F.unix_micros("max_ingested_at")) / 1_000_000
    return df.select("parse_errors_last_10min", "max_ingested_at",
                     lag.alias("ingestion_lag_seconds"), "total_logs_count")


def recent_folders(table: CommitTable, start: dt.datetime) -> DataFrame:
    """The rows of the folders that hold unparsed records and reach past ``start``; others stay closed."""
    def wanted(part, stats):
        return int(stats["unparsed"]) > 0 and dt.datetime.fromisoformat(stats["max_created_at"]) >= start
    return table.read(only=wanted)


def table_signals(table: CommitTable, as_of: Column, minutes=UNPARSED_WINDOW_MINUTES) -> DataFrame:
    """The same signals of a stored log table, from the statistics that its commits keep.

    Total and newest ingest time come from the commit log alone; rows are read only of folders that
    hold unparsed records of the last minutes. It equals ``health_signals`` over all rows.
    """
    now = table.spark.range(1).select(as_of.cast("timestamp").alias("now")).first()["now"]
    start = now - dt.timedelta(minutes=minutes)
    recent = recent_folders(table, start).agg(
        F.count_if((F.col("is_parsed") == 0) & (F.col("created_at") >= F.lit(start))).alias("parse_errors_last_10min"))
    known = table.entries().agg(
        F.max("max_ingested_at").alias("max_ingested_at"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total_logs_count"))
    stacked = recent.unionByName(known, allowMissingColumns=True)
    row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    lag = (F.unix_micros(F.lit(now)) - F.unix_micros("max_ingested_at")) / 1_000_000
    return row.select("parse_errors_last_10min", "max_ingested_at",
                      lag.alias("ingestion_lag_seconds"), "total_logs_count")
