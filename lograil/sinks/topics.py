"""Topic sinks: keyed log records and dead letters as key/value rows, stored topics, and the Kafka writer."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from lograil.functions.times import iso_text
from lograil.schema import LOG_COLUMNS, TOPIC_SCHEMA
from lograil.sinks.commits import CommitTable


def log_json(columns=LOG_COLUMNS):
    """A log record as JSON text with its timestamps as ISO text and nulls kept."""
    fields = [
        iso_text(F.col(c)).alias(c) if c in ("created_at", "ingested_at") else F.col(c)
        for c in columns
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def log_messages(logs: DataFrame) -> DataFrame:
    """Log records as topic rows; the service is the key, so a service stays in one partition."""
    return logs.select(F.col("source_service").alias("key"), log_json().alias("value"))


# Offsets of a partition that share a folder of a stored topic.
SEGMENT = 100_000
SEGMENT_STATS = {
    "rows": ("bigint", "count(*)"), "partition": ("int", "min(partition)"),
    "min_offset": ("bigint", "min(offset)"), "max_offset": ("bigint", "max(offset)"),
}


def topic_table(spark: SparkSession, path: str) -> CommitTable:
    """A topic stored as a committed table of offset segments: which offsets a folder holds is in the log."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in TOPIC_SCHEMA)
    return CommitTable(spark, path, schema, key="segment", kind="string", stats=SEGMENT_STATS)


def append_topic(rows: DataFrame, path: str, writer=None, batch_id=None) -> int | None:
    """Store topic records; the records of a writer's last batch replace those of its earlier attempt."""
    number = F.floor(F.col("offset") / SEGMENT)
    segment = F.format_string("p%05d-%012d", F.col("partition"), number)
    return topic_table(rows.sparkSession, path).append(
        rows.select(*TOPIC_SCHEMA.fieldNames()).withColumn("segment", segment), ("offset",), writer, batch_id,
        replace=writer is not None)


def write_topic(rows: DataFrame, servers: str, topic: str) -> None:
    """Publish key/value rows; needs the Kafka connector on the class path."""
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic).save()
