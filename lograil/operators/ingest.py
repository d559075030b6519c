"""Ingest outcome: reports per input, reject channels and dead-letter envelopes."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lograil.functions.text import stable_uuid
from lograil.functions.times import iso_text
from lograil.sinks.topics import log_json

# Rejects of these channels go to the dead-letter queue, others are only reported.
DLQ_CHANNELS = ("raw", "raw_file", "kafka")
REPORTED_CHANNELS = ("json", "batch", "jsonl")

MAX_REPORTED_ERRORS = 20
PARSE_ERROR = "parse_error"
MESSAGE_PARSE_ERROR = "message_parse_error"
INSERT_FAILURE = "clickhouse_insert_failure"


def ingest_counts(done: DataFrame, by="file") -> DataFrame:
    """Count, success and failed per input."""
    return done.groupBy(by).agg(
        F.count("*").alias("count"),
        F.count_if(F.col("errors").isNull()).alias("success"),
        F.count_if(F.col("errors").isNotNull()).alias("failed"))


def first_errors(done: DataFrame, by="file", order=("line",), limit=MAX_REPORTED_ERRORS):
    """The first ``limit`` rejects of each input.

    The rank is cut in every task before rows are shuffled, so an input with very many rejects
    sends no more than ``limit`` rows per task.
    """
    w = Window.partitionBy(by).orderBy(*order)
    bad = done.filter(F.col("errors").isNotNull()).select(by, *order, "errors")
    return bad.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= limit)


def error_lists(numbered: DataFrame, by="file", line="line") -> DataFrame:
    """Ranked rejects (at most the report limit per input) to one array of ``{line, error}``."""
    item = F.struct(F.col(line).cast("bigint").alias("line"), F.col("errors").alias("error"))
    return numbered.groupBy(by).agg(F.sort_array(F.collect_list(item)).alias("errors"))


def ingest_report(done: DataFrame, by="file", line="line") -> DataFrame:
    """Per input: count, success, failed and the first rejects with their line numbers."""
    lists = error_lists(first_errors(done, by, (line,)), by, line)
    return ingest_counts(done, by).join(lists, by, "left")


def with_channel(rejects: DataFrame, channel) -> DataFrame:
    return rejects.withColumn(
        "channel", channel if isinstance(channel, Column) else F.lit(channel))


def dlq_bound(rejects: DataFrame) -> DataFrame:
    """The rejects whose channel has a dead-letter queue."""
    return rejects.filter(F.col("channel").isin(*DLQ_CHANNELS))


def _envelope(*fields) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def parser_reject_envelopes(rejects: DataFrame, as_of: Column, id_from, source="source",
                            keep=()) -> DataFrame:
    """Envelopes of refused raw lines: the payload is kept whole."""
    return rejects.select(
        *keep, F.lit(None).cast("string").alias("key"),
        _envelope(
            stable_uuid(*map(F.col, id_from)).alias("id"),
            iso_text(as_of).alias("created_at"),
            F.col("raw_payload"),
            F.col("error_message"),
            F.lit(PARSE_ERROR).alias("error_type"),
            F.col(source).alias("source"),
        ).alias("value"))


def message_reject_envelopes(rejects: DataFrame, as_of: Column, id_from, keep=()) -> DataFrame:
    """Envelopes of unparseable topic messages: the payload is kept whole, so it can be replayed."""
    return rejects.select(
        *keep, F.lit(None).cast("string").alias("key"),
        _envelope(
            stable_uuid(*map(F.col, id_from)).alias("dlq_id"),
            iso_text(as_of).alias("dlq_timestamp"),
            F.concat(F.lit("Failed to parse message: "), F.col("error_message"))
            .alias("error_message"),
            F.lit(MESSAGE_PARSE_ERROR).alias("error_type"),
            F.col("raw_payload"),
        ).alias("value"))


def failed_batch_envelopes(logs: DataFrame, as_of: Column, error_message: str,
                           error_type=INSERT_FAILURE, keep=()) -> DataFrame:
    """Envelopes of records that could not be stored: each holds its whole log."""
    body = log_json()
    return logs.select(
        *keep, F.lit(None).cast("string").alias("key"),
        F.concat(
            F.substring(
                head := _envelope(
                    stable_uuid(F.lit("dlq"), F.col("id")).alias("dlq_id"),
                    iso_text(as_of).alias("dlq_timestamp"),
                    F.lit(error_message).alias("error_message"),
                    F.lit(error_type).alias("error_type")),
                F.lit(1), F.length(head) - 1),
            F.lit(',"original_log":'), body, F.lit("}")).alias("value"))


def union_envelopes(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
