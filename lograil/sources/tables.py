"""Stored tables: the day-partitioned log table and the batch folders of the streaming job."""

from pyspark.sql import DataFrame, SparkSession

from lograil.sinks.tables import log_table


def read_log_table(spark: SparkSession, path: str, version: int | None = None, fields=False) -> DataFrame:
    """The committed rows of the log table: its columns plus the partition column ``event_date``.

    The frame keeps to the version that it was made with, whatever is committed later. ``fields`` adds
    the metadata as VARIANT of a table that was written so.
    """
    return log_table(spark, path, fields).read(version)


def read_batches(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All ``batch_id=`` folders below a path; with a schema also where none is there yet."""
    reader = spark.read.option("basePath", path)
    return (reader.schema(schema) if schema else reader).parquet(f"{path}/batch_id=*")
