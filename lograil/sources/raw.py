"""File sources: raw text lines and JSONL, with file names and line numbers."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lograil.functions.text import strip

# File name endings of each kind of upload.
RAW_EXTENSIONS = (".log", ".txt", ".raw", ".clf", ".syslog")
JSONL_EXTENSIONS = (".jsonl", ".json", ".txt")


def _read_lines(spark: SparkSession, paths, extensions) -> DataFrame:
    """Non-blank lines of the matching files with the position of each.

    ``line_pos`` grows along each block of a file; with ``file`` and ``block_start`` it orders
    the lines of a file, however many tasks read it. Undecodable bytes are replaced.
    """
    endings = "|".join(e.lstrip(".") for e in extensions)
    df = spark.read.text(paths).select(
        F.make_valid_utf8("value").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )
    # Names without an extension are allowed.
    name = F.lower(F.element_at(F.split("file", "/"), -1))
    df = df.filter(name.rlike(rf"\.({endings})$") | ~F.contains(name, F.lit(".")))
    df = df.filter(strip(F.col("value")) != "")
    return df.withColumn("line_pos", F.monotonically_increasing_id())


def read_raw_lines(spark: SparkSession, paths) -> DataFrame:
    """Raw log files, one log per non-blank line."""
    return _read_lines(spark, paths, RAW_EXTENSIONS)


def read_jsonl_lines(spark: SparkSession, paths) -> DataFrame:
    """JSONL files, one JSON object per non-blank line."""
    return _read_lines(spark, paths, JSONL_EXTENSIONS)


# What identifies a line of a file, however files are packed into tasks: ids derive from it.
LINE_KEY = ["file", "line"]


def block_offsets(lines: DataFrame) -> DataFrame:
    """Per file block: first position, and the number of lines of the file before the block.

    One row per block (about 128 MB of text), so this stays small beside the lines.
    """
    blocks = lines.groupBy("file", "block_start").agg(
        F.min("line_pos").alias("first_pos"), F.count("*").alias("block_lines"))
    before = Window.partitionBy("file").orderBy("block_start").rowsBetween(
        Window.unboundedPreceding, -1)
    return blocks.select(
        "file", "block_start", "first_pos",
        F.coalesce(F.sum("block_lines").over(before), F.lit(0)).alias("lines_before"))


def with_line_numbers(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Add the 1-based number among the non-blank lines of its file to each row of ``rows``.

    ``rows`` is any selection of ``lines`` that kept file, block and position. The number depends on
    the file alone, not on what else is read or how it is split.
    """
    number = F.col("lines_before") + F.col("line_pos") - F.col("first_pos") + 1
    return (
        rows.join(block_offsets(lines), ["file", "block_start"])
        .withColumn("line", number.cast("bigint"))
        .drop("first_pos", "lines_before")
    )


def numbered(lines: DataFrame) -> DataFrame:
    """The lines with their number, so that ``LINE_KEY`` stands."""
    return with_line_numbers(lines, lines)
