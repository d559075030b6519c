"""Topic sources: Kafka readers, and file streams with the same column shape."""

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lograil.schema import TOPIC_SCHEMA
from lograil.sinks.commits import CommitTable

# Topic names.
RAW_TOPIC = "logs.raw"
DLQ_TOPIC = "logs.dead_letter"


def starting_offsets(topic: str, committed: DataFrame, partitions: int) -> str:
    """Reader option: each partition from its committed offset, others from the earliest (-2).

    ``committed`` has one row per partition of the topic.
    """
    at = {r["partition"]: r["committed_offset"] for r in committed.collect()}
    return json.dumps({topic: {str(p): at.get(p, -2) for p in range(partitions)}})


def kafka_options(servers: str, topic: str, start="earliest", max_records=None) -> dict:
    """Reader options. ``max_records`` bounds the records of a trigger; by default none is left out."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "includeHeaders": "true",
    }
    if max_records:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def read_topic_stream(spark: SparkSession, servers, topic=RAW_TOPIC, max_records=None):
    """The topic as a stream; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(
        **kafka_options(servers, topic, max_records=max_records)).load()


def read_topic(spark: SparkSession, servers, topic=DLQ_TOPIC, start="earliest") -> DataFrame:
    """The topic as a batch from ``start``; needs the Kafka connector on the class path."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic, start)).load()


def read_topic_files(spark: SparkSession, path: str, max_files=None) -> DataFrame:
    """A folder of Parquet files with topic records as a stream."""
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _offsets(committed: DataFrame | None) -> dict[int, int]:
    """Committed offset by partition; one row per partition of the topic."""
    return {} if committed is None else {r["partition"]: r["committed_offset"] for r in committed.collect()}


def _after(at: dict[int, int]) -> Column:
    """Rows at and after the committed offsets, as plain conditions that reach the scan."""
    if not at:
        return F.lit(True)
    known = [(F.col("partition") == p) & (F.col("offset") >= o) for p, o in sorted(at.items())]
    return reduce(Column.__or__, known, ~F.col("partition").isin(sorted(at)))


def read_stored(table: CommitTable, committed: DataFrame = None) -> DataFrame:
    """The records of a stored topic from the committed offsets on; segments before them stay closed."""
    at = _offsets(committed)
    rows = table.read(only=lambda _, s: int(s["max_offset"]) >= at.get(int(s["partition"]), 0))
    return rows.filter(_after(at)).select(*TOPIC_SCHEMA.fieldNames())


def read_front(table: CommitTable, committed: DataFrame = None, size: int = 50) -> DataFrame:
    """Of every partition the first records after its committed offset, ``size`` at least where there are
    as many; only the segments that hold them are opened.

    What is given of a partition is a prefix by offset: all segments up to the one that makes it enough,
    with any segment that reaches below the last offset taken.
    """
    at, taken = _offsets(committed), set()
    by_partition: dict[int, list] = {}
    for key, s in table.snapshot().live.items():
        start = at.get(int(s["partition"]), 0)
        if int(s["max_offset"]) >= start:
            # Of a segment that the commit point lies in, count what surely comes after it.
            low, high, n = int(s["min_offset"]), int(s["max_offset"]), int(s["rows"])
            sure = n if low >= start else max(1, n - (start - low))
            by_partition.setdefault(int(s["partition"]), []).append((low, high, sure, key))
    ends = {}
    for partition, segments in by_partition.items():
        found, end = 0, -1
        for low, high, sure, key in sorted(segments):
            if found >= size and low > end:
                break
            found, end = found + sure, max(end, high)
            taken.add(key)
        ends[partition] = end
    rows = table._read(sorted(taken)).filter(_after(at))
    return rows.select(*TOPIC_SCHEMA.fieldNames())


def stored_ends(table: CommitTable) -> DataFrame:
    """Partition and end offset of a stored topic, from its commit log alone."""
    return table.entries().groupBy("partition").agg((F.max("max_offset") + 1).alias("end_offset"))


def topic_text(topic: DataFrame) -> DataFrame:
    """Key and value decoded as UTF-8 text, invalid bytes replaced."""
    return topic.withColumns({
        "key": F.make_valid_utf8(F.col("key").cast("string")),
        "value": F.make_valid_utf8(F.col("value").cast("string")),
    })
