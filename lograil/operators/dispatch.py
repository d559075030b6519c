"""Choosing the parse job for a format, for whole frames and for frames of mixed formats."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lograil.functions.text import strip
from lograil.operators import jsonlog
from lograil.operators.clf import parse_clf
from lograil.operators.syslog import parse_syslog
from lograil.operators.validate import accepted, finish, rejected, with_record_defaults
from lograil.schema import LOG_SCHEMA, RECORD_TYPES

TEXT_FORMATS = {"syslog": parse_syslog, "clf": parse_clf}


def text_format(name: str) -> str:
    """The canonical name of a raw text format; JSON and unknown names are errors."""
    key = name.strip().lower()
    if key == "json":
        raise ValueError("JSON records have their own job; choose syslog or clf")
    if key not in TEXT_FORMATS:
        raise ValueError(f"unsupported format '{name}'; supported: syslog, clf, json")
    return key


def _override(df: DataFrame, source, source_service) -> DataFrame:
    """Source always replaces the parser's; a service does unless it is empty or 'unknown'."""
    source = source if isinstance(source, Column) else F.lit(source)
    service = source_service if isinstance(source_service, Column) else F.lit(source_service)
    given = service.isNotNull() & ~service.isin("", "unknown")
    return df.withColumns({
        "source": source,
        "source_service": F.when(given, service).otherwise(F.col("source_service")),
    })


def parse_lines(df: DataFrame, format, source_service="unknown", source="http", content="value",
                **options) -> DataFrame:
    """Parse a frame of raw lines of one format; ``finish`` completes the result."""
    key = text_format(format)
    parsed = TEXT_FORMATS[key](df, content, **options)
    return _override(parsed.withColumn("format", F.lit(key)), source, source_service)


def parse_mixed(df: DataFrame, format_column="format", content="value", source_service="unknown",
                source="http") -> DataFrame:
    """Parse lines whose format is named per row; rows of no text format become rejects.

    Each format is a filtered branch over the same scan, so no line meets a foreign parser.
    The given format text stays in the column ``declared_format``.
    """
    declared = df.withColumnRenamed(format_column, "declared_format")
    declared = declared.withColumn("_fmt", F.lower(strip(F.col("declared_format"))))
    keep = [c for c in declared.columns if c != "_fmt"]
    record = [c for c in RECORD_TYPES if c not in keep] + ["errors"]
    branches = [
        with_record_defaults(
            parse_lines(declared.filter(F.col("_fmt") == key), key, source_service, source,
                        content)).select(*keep, *record)
        for key in TEXT_FORMATS
    ]
    known = F.col("_fmt").isin(*TEXT_FORMATS)
    other = declared.filter(~F.coalesce(known, F.lit(False)))
    other = with_record_defaults(other.withColumn(
        "errors",
        F.when(F.col("_fmt") == "json", F.lit("JSON format has its own job"))
        .otherwise(F.concat(F.lit("unsupported format '"), F.coalesce("declared_format", F.lit("")),
                            F.lit("'")))))
    return reduce(DataFrame.unionByName, [*branches, other.select(*keep, *record)])


def store_outcome(done: DataFrame, path: str, keep=(), raw="value") -> DataFrame:
    """Write a checked frame once, valid and refused rows apart, and return it as it is stored.

    Records, rejects and reports then come from this table: the input is read and parsed once.
    """
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields]
    rows = done.select(*keep, *fields, F.col(raw).cast("string").alias("value"), "errors",
                       F.col("errors").isNotNull().alias("is_error"))
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy("is_error").parquet(path)
    return done.sparkSession.read.schema(rows.schema).parquet(path)


def run_text_job(df: DataFrame, format, source_service="unknown", source="http",
                 content="value", ingested_at=None, id_from=None, keep=(), **options):
    """Raw lines to (log records, rejects)."""
    done = finish(parse_lines(df, format, source_service, source, content, **options),
                  ingested_at=ingested_at, id_from=id_from)
    return accepted(done, keep), rejected(done, content, keep)


def run_request_job(df: DataFrame, content="value", ingested_at=None, id_from=None, keep=(),
                    **defaults):
    """JSON requests to (log records, rejects)."""
    done = finish(jsonlog.parse_requests(df, content, **defaults), ingested_at=ingested_at,
                  id_from=id_from, promoted=True, meta="_meta")
    return accepted(done, keep), rejected(done, content, keep)


def run_message_job(df: DataFrame, content="value", ingested_at=None, id_from=None, keep=()):
    """Topic messages to (log records, rejects)."""
    done = finish(jsonlog.parse_messages(df, content), ingested_at=ingested_at,
                  id_from=id_from, promoted=True, meta="_meta")
    return accepted(done, keep), rejected(done, content, keep)
