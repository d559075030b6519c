"""Rollups of the log table, their mergeable partials, and the dashboard queries over them."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from lograil.functions.levels import ERROR_LEVELS

TOP_MESSAGES = 3
UNKNOWN_ERROR = "Unknown"
# Counters the approximate top-k state keeps; more than the k it is asked for.
SKETCH_ITEMS = 1000


def errors_only(logs: DataFrame) -> DataFrame:
    """ERROR and FATAL records with their day and error type."""
    return logs.filter(F.col("level").isin(*ERROR_LEVELS)).withColumns({
        "date": F.to_date("created_at"),
        "error_type": F.coalesce("error_type", F.lit(UNKNOWN_ERROR)),
    })


# --- error types -------------------------------------------------------------------------------

ERROR_TYPE_KEYS = ["date", "error_type", "level"]


def error_message_counts(logs: DataFrame) -> DataFrame:
    """Rows per day, error type, level and message: the exact, mergeable form of top messages."""
    return errors_only(logs).groupBy(*ERROR_TYPE_KEYS, "message").agg(F.count("*").alias("n"))


def top_messages(counts: DataFrame, keys=ERROR_TYPE_KEYS, k=TOP_MESSAGES) -> DataFrame:
    """The k most frequent messages per key; equal counts order by message.

    Works on counts, and the rank is cut per task before the shuffle, so a key that holds a large
    share of all rows moves only k rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), "message")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def error_type_summary(logs: DataFrame) -> DataFrame:
    """Per day, error type and level: number of errors and the top messages in order."""
    return summarise_messages(error_message_counts(logs))


def merge_error_message_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*ERROR_TYPE_KEYS, "message").agg(F.sum("n").alias("n"))


def summarise_messages(merged: DataFrame) -> DataFrame:
    """The summary of merged message counts."""
    totals = merged.groupBy(*ERROR_TYPE_KEYS).agg(F.sum("n").alias("error_count"))
    lists = top_messages(merged).groupBy(*ERROR_TYPE_KEYS).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "message"))), lambda m: m.message
        ).alias("sample_messages"))
    return totals.join(lists, ERROR_TYPE_KEYS)


def error_type_partials(logs: DataFrame) -> DataFrame:
    """Counts with an approximate top-message state of bounded size per key."""
    return errors_only(logs).groupBy(*ERROR_TYPE_KEYS).agg(
        F.count("*").alias("error_count"),
        F.expr(f"approx_top_k_accumulate(message, {SKETCH_ITEMS})").alias("message_state"))


def merge_error_type_states(partials: DataFrame) -> DataFrame:
    """Partials of the same kind; a state stays bounded however many it was merged from."""
    return partials.groupBy(*ERROR_TYPE_KEYS).agg(
        F.sum("error_count").alias("error_count"),
        F.expr(f"approx_top_k_combine(message_state, {SKETCH_ITEMS})").alias("message_state"))


def merge_error_type_partials(partials: DataFrame, k=TOP_MESSAGES) -> DataFrame:
    """The summary of merged states."""
    return merge_error_type_states(partials).select(
        *ERROR_TYPE_KEYS, "error_count",
        F.expr(f"transform(approx_top_k_estimate(message_state, {k}), x -> x.item)")
        .alias("sample_messages"))


# --- errors per service ------------------------------------------------------------------------

SERVICE_ERROR_KEYS = ["date", "source_service", "error_type", "level"]


def service_error_matrix(logs: DataFrame) -> DataFrame:
    """Per day, service, error type and level: number of errors and time of the last one."""
    return errors_only(logs).groupBy(*SERVICE_ERROR_KEYS).agg(
        F.count("*").alias("error_count"), F.max("created_at").alias("last_error_time"))


def merge_service_error_matrix(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*SERVICE_ERROR_KEYS).agg(
        F.sum("error_count").alias("error_count"),
        F.max("last_error_time").alias("last_error_time"))


# --- service health ----------------------------------------------------------------------------

HEALTH_KEYS = ["hour", "source_service"]


def service_health(logs: DataFrame) -> DataFrame:
    """Per hour and service: number of logs, last and first log time."""
    return logs.groupBy(
        F.date_trunc("hour", "created_at").alias("hour"), "source_service"
    ).agg(
        F.count("*").alias("log_count"), F.max("created_at").alias("last_log_time"),
        F.min("created_at").alias("min_log_time"))


def merge_service_health(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*HEALTH_KEYS).agg(
        F.sum("log_count").alias("log_count"), F.max("last_log_time").alias("last_log_time"),
        F.min("min_log_time").alias("min_log_time"))


# --- documented views --------------------------------------------------------------------------

VOLUME_KEYS = ["hour", "source", "level"]
TOP_ERROR_KEYS = ["error_type", "source"]


def hourly_volume(logs: DataFrame) -> DataFrame:
    return logs.groupBy(
        F.date_trunc("hour", "created_at").alias("hour"), "source", "level"
    ).agg(F.count("*").alias("log_count"))


def merge_hourly_volume(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*VOLUME_KEYS).agg(F.sum("log_count").alias("log_count"))


def errors_top(logs: DataFrame) -> DataFrame:
    """Level ERROR with an error type: number and last time per error type and source."""
    return logs.filter((F.col("level") == "ERROR") & F.col("error_type").isNotNull()).groupBy(
        *TOP_ERROR_KEYS
    ).agg(F.count("*").alias("error_count"), F.max("created_at").alias("last_seen"))


def merge_errors_top(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*TOP_ERROR_KEYS).agg(
        F.sum("error_count").alias("error_count"), F.max("last_seen").alias("last_seen"))


# Rollup name: (partial of a batch, merge of partials into one). A merge gives partials again.
# "error_messages" is exact and grows with the number of different messages; "error_types" is bounded.
ROLLUPS = {
    "error_types": (error_type_partials, merge_error_type_states),
    "error_messages": (error_message_counts, merge_error_message_counts),
    "service_errors": (service_error_matrix, merge_service_error_matrix),
    "service_health": (service_health, merge_service_health),
    "hourly_volume": (hourly_volume, merge_hourly_volume),
    "errors_top": (errors_top, merge_errors_top),
}

# The time column of each rollup's rows that tells their month; one has none, and is kept by month besides.
ROLLUP_TIMES = {"error_types": "date", "error_messages": "date", "service_errors": "date",
                "service_health": "hour", "hourly_volume": "hour"}


def monthly_partials(name: str, logs: DataFrame) -> DataFrame:
    """The partials of a rollup with the month (``yyyy-MM``) that each belongs to."""
    partial, _ = ROLLUPS[name]
    if name in ROLLUP_TIMES:
        return partial(logs).withColumn("month", F.date_format(ROLLUP_TIMES[name], "yyyy-MM"))
    month = F.date_format("created_at", "yyyy-MM").alias("month")
    found = logs.filter((F.col("level") == "ERROR") & F.col("error_type").isNotNull())
    return found.groupBy(*TOP_ERROR_KEYS, month).agg(
        F.count("*").alias("error_count"), F.max("created_at").alias("last_seen"))


# --- dashboards --------------------------------------------------------------------------------


def top_error_types(matrix: DataFrame, k=3) -> DataFrame:
    """The k error types with the most errors over the whole rollup."""
    return matrix.groupBy("error_type").agg(
        F.sum("error_count").alias("error_count")
    ).orderBy(F.desc("error_count"), "error_type").limit(k)


def top_errors_per_service(matrix: DataFrame, k=3) -> DataFrame:
    """The k most frequent error types of every service."""
    counts = matrix.groupBy("source_service", "error_type").agg(
        F.sum("error_count").alias("error_count"),
        F.max("last_error_time").alias("last_error_time"))
    w = Window.partitionBy("source_service").orderBy(F.desc("error_count"), "error_type")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def dead_services(health: DataFrame, as_of: Column, silent_hours=1) -> DataFrame:
    """Services whose last log is more than an hour old at ``as_of``."""
    last = health.groupBy("source_service").agg(F.max("last_log_time").alias("last_log_time"))
    silent = F.unix_micros(as_of) - F.unix_micros("last_log_time")
    return last.withColumn("silent_seconds", F.floor(silent / 1_000_000)).filter(
        F.col("last_log_time") < as_of - F.expr(f"INTERVAL {int(silent_hours)} HOURS"))
