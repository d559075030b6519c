"""Log data derived from the given tables.

There is no log table among the inputs, so records, raw lines, topic messages and dead letters are
computed from ``events`` (and other text tables), including broken ones. All of it is a narrow
projection of whole tables. ``oracle.py`` states the same derivations in SQL.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from lograil.operators.validate import accepted, finish, with_record_defaults
from lograil.schema import BATCH_STATS_SCHEMA

# The time the queries take as "now": just after the last event.
AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def millis_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")


def seconds_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


RECORD_SQL = {
    "id": "md5(cast(event_id AS string))",
    "created_at": "CASE WHEN event_id % 50 <> 0 THEN cast(ts AS timestamp) END",
    "ingested_at": "cast(ts AS timestamp) + make_dt_interval(0, 0, 0, event_id % 600)",
    "source": "element_at(array('http', 'kafka', 'file'), cast(event_id % 3 + 1 AS int))",
    "source_host": "CASE WHEN event_id % 5 <> 0 THEN concat('host-', event_id % 20) END",
    "source_service": "concat('svc-', user_id % 8)",
    "level": """CASE WHEN event_id % 97 = 0 THEN 'bogus'
        WHEN event_type = 'error' AND value > 100 THEN 'critical'
        WHEN event_type = 'error' THEN 'err' WHEN event_type = 'view' THEN 'trace'
        WHEN event_type = 'click' THEN 'Information' WHEN event_type = 'signup' THEN 'warning'
        ELSE ' info ' END""",
    "message": "concat(event_type, ' by user ', user_id % 10)",
    "metadata": """CASE event_id % 6
        WHEN 1 THEN concat('{"http_status": ', 200 + event_id % 300, ', "k": ', k,
            ', "response_time_ms": ', event_id % 2000, ', "trace_id": "t-', event_id % 1000, '"}')
        WHEN 2 THEN concat('{"http_status": "404", "k": ', k, '}')
        WHEN 3 THEN concat('{"http_status": 999, "k": ', k, ', "user_id": ', user_id, '}')
        WHEN 4 THEN concat('{"k": ', k, ', "response_time_ms": 12.7, "span_id": null}')
        WHEN 5 THEN props END""",
    "user_id": "CASE WHEN event_id % 7 <> 0 THEN cast(user_id AS string) END",
    "trace_id": "CASE WHEN event_id % 12 = 1 THEN concat('declared-', event_id % 100) END",
    "error_type": """CASE WHEN event_type = 'error' THEN element_at(
        array(NULL, 'TimeoutError', 'ValidationError', 'OutOfMemoryError'),
        cast(event_id % 4 + 1 AS int)) END""",
    "is_parsed": "event_id % 41 <> 0",
    "parse_errors": "CASE WHEN event_id % 41 = 0 THEN 'unreadable field' END",
}


def events(spark, folder) -> DataFrame:
    """The events, dealt to all cores: their file has few pieces, and what is made of a row costs far more than to read it."""
    df = table(spark, folder, "events").repartition(2 * spark.sparkContext.defaultParallelism)
    return df.withColumn("k", F.regexp_extract("props", "[0-9]+", 0))


def records(spark, folder) -> DataFrame:
    """Unvalidated log records, one per event."""
    df = events(spark, folder)
    return with_record_defaults(
        df.select("event_id", *[F.expr(sql).alias(name) for name, sql in RECORD_SQL.items()]))


def finished(spark, folder) -> DataFrame:
    return finish(records(spark, folder), promoted=True)


def logs(spark, folder, keep=()) -> DataFrame:
    """The log table: the valid records in stored form."""
    return accepted(finished(spark, folder), keep)


CLF_SQL = """
CASE WHEN event_id % 40 = 8 THEN concat('not an access log ', event_id) ELSE concat(
  '10.0.', user_id % 4, '.', event_id % 256, CASE WHEN event_id % 9 = 0 THEN ' id ' ELSE ' - ' END,
  CASE WHEN event_id % 3 = 0 THEN '-' ELSE concat('u', user_id) END, ' [',
  CASE WHEN event_id % 11 = 3 THEN 'BAD_TIMESTAMP' ELSE date_format(ts, 'dd/MMM/yyyy:HH:mm:ss') END,
  CASE event_id % 11 WHEN 1 THEN ' -0700' WHEN 2 THEN '' WHEN 3 THEN '' WHEN 4 THEN ' +05:30'
    ELSE ' +0000' END, '] "',
  CASE event_id % 13 WHEN 0 THEN '-' WHEN 1 THEN '' WHEN 2 THEN 'get /lower HTTP/1.1'
    WHEN 3 THEN 'GET /noproto' ELSE concat(
      CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'POST' ELSE 'GET' END,
      ' /api/', event_type, '/', event_id, ' HTTP/1.1') END, '" ',
  CASE WHEN event_id % 17 = 0 THEN '700' ELSE element_at(
    array('200', '301', '404', '500', '101', '204'), cast(event_id % 6 + 1 AS int)) END, ' ',
  CASE WHEN event_id % 10 = 0 THEN '-' ELSE cast(event_id * 3 AS string) END,
  CASE event_id % 4 WHEN 0 THEN ' "-" "Mozilla/5.0 (X11)"'
    WHEN 1 THEN concat(' "http://ref.example/', user_id, '" "-"') WHEN 2 THEN ' "" "curl"'
    ELSE '' END,
  CASE WHEN event_id % 40 = 7 THEN ' trailing' ELSE '' END) END
"""


def clf_lines(spark, folder) -> DataFrame:
    """Access-log lines in seven files with the receive time; some are broken."""
    return events(spark, folder).select(
        "event_id", F.expr(CLF_SQL).alias("value"),
        F.expr("concat('access-', event_id % 7, '.log')").alias("file"),
        F.expr("event_id div 7 + 1").alias("line"),
        F.expr(RECORD_SQL["ingested_at"]).alias("received"))


SYSLOG_SQL = r"""
CASE WHEN event_id % 37 = 5 THEN concat('garbage ', event_id) ELSE concat(
  '<', event_id * 7 % 200, '>', CASE WHEN event_id % 31 = 0 THEN '2' ELSE '1' END, ' ',
  CASE event_id % 10 WHEN 0 THEN '-' WHEN 1 THEN 'bad-time'
    WHEN 2 THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), '+02:00')
    WHEN 3 THEN date_format(ts, "yyyyMMdd'T'HHmmss")
    ELSE concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z') END, ' ',
  CASE WHEN event_id % 6 = 0 THEN '-' ELSE concat('host-', event_id % 20) END, ' ',
  CASE WHEN event_id % 7 = 0 THEN '-' ELSE concat('svc-', user_id % 8) END, ' ',
  CASE WHEN event_id % 5 = 0 THEN '-' ELSE cast(1000 + event_id % 97 AS string) END, ' ',
  CASE WHEN event_id % 8 = 3 THEN '-' ELSE concat('ID', event_id % 50) END, ' ',
  CASE event_id % 8
    WHEN 0 THEN concat('- ', event_type, ' event')
    WHEN 1 THEN concat('[a@1 x="', k, '"] ', event_type, ' event')
    WHEN 2 THEN concat('[a@1 x="1"][b@1 y="', k, '"]   ', event_type, ' event')
    WHEN 3 THEN concat('[a@1 x="1"] [b@1 y="q\\"z] ', k, '"] ', event_type, ' event')
    WHEN 4 THEN '[a@1 x="1"]'
    WHEN 5 THEN concat('[a b="c"] [open ', event_type)
    WHEN 6 THEN concat('plain ', event_type)
    ELSE concat('[a [n] ', k, '] ', event_type, ' event') END) END
"""


def syslog_lines(spark, folder) -> DataFrame:
    """Syslog lines in all structured-data shapes; some are broken."""
    return events(spark, folder).select(
        "event_id", F.expr(SYSLOG_SQL).alias("value"),
        F.expr(RECORD_SQL["ingested_at"]).alias("received"))


REQUEST_SQL = """
CASE event_id % 16
  WHEN 3 THEN concat('{"source": "http", "level": "info", cut ', event_id)
  WHEN 4 THEN concat('[', event_id, ']')
  ELSE concat('{',
    CASE event_id % 16 WHEN 0 THEN '' WHEN 1 THEN '"source": null, ' WHEN 2 THEN '"source": 123, '
      WHEN 11 THEN '"source": "first", "source": "last", ' ELSE '"source": "http", ' END,
    CASE event_id % 16 WHEN 10 THEN '' ELSE concat('"source_service": "svc-', user_id % 8, '", ')
      END,
    '"level": "', CASE event_id % 16 WHEN 5 THEN 'bogus' WHEN 9 THEN 'information'
      WHEN 12 THEN ' Warning' ELSE 'err' END, '", ',
    '"message": "', event_type, ' ', event_id, '", "unknown_key": [1, {"a": null}], ',
    '"created_at": ', CASE event_id % 16 WHEN 7 THEN cast(1704067200 + event_id AS string)
      WHEN 8 THEN '"yesterday"' WHEN 13 THEN 'null' WHEN 14 THEN '1704067200.25' ELSE concat('"',
        date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z"') END, ', ',
    '"trace_id": ', CASE WHEN event_id % 3 = 0 THEN 'null' ELSE concat('"tr-', event_id % 9, '"')
      END, ', ',
    '"payload": ', CASE event_id % 16 WHEN 6 THEN '[1]' WHEN 15 THEN 'null'
      ELSE concat('{"k": ', k, ', "trace_id": "meta", "user_id": "u', user_id, '"}') END,
    '}') END
"""


def request_lines(spark, folder) -> DataFrame:
    """JSON ingest requests; some are broken."""
    return events(spark, folder).select(
        "event_id", F.expr(REQUEST_SQL).alias("value"),
        F.expr("concat('upload-', event_id % 5, '.jsonl')").alias("file"),
        F.expr("event_id div 5 + 1").alias("line"),
        F.expr(RECORD_SQL["ingested_at"]).alias("received"))


def batch_documents(spark, folder, size=50) -> DataFrame:
    """Batch documents of up to 50 requests; every 20th is broken, one in seven holds junk."""
    lines = events(spark, folder).select(
        F.expr(f"event_id div {size}").alias("doc"), "event_id", F.expr(REQUEST_SQL).alias("value"))
    # Requests that are no JSON cannot be part of a document.
    lines = lines.withColumn("value", F.expr(
        "CASE WHEN event_id % 16 = 3 THEN '\"cut\"' ELSE value END"))
    # A group is one document, of at most 50 requests by construction.
    docs = lines.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("event_id", "value")))
                                    .alias("items"))
    body = F.array_join(F.transform("items", lambda x: x.value), ",")
    return docs.select("doc", F.expr("doc % 20").alias("m"), body.alias("body")).select(
        "doc",
        F.when(F.col("m") == 7, '{"logs": []}').when(F.col("m") == 8, '{"entries": []}')
        .when(F.col("m") == 9, '{"logs": [')
        .otherwise(F.concat(F.lit('{"logs": ['), "body", F.lit("]}"))).alias("value"))


VALID_MESSAGE_SQL = """
concat('{"id": "', CASE WHEN event_id % 20 = 7 THEN 'no-uuid'
      WHEN event_id % 20 = 8 THEN upper(md5(cast(event_id AS string)))
      ELSE md5(cast(event_id AS string)) END,
    '", "created_at": ', CASE WHEN event_id % 20 = 9 THEN 'null' ELSE concat('"',
      date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '"') END,
    ', "ingested_at": "', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), 'Z", ',
    '"event_time_missing": ', CASE WHEN event_id % 20 = 10 THEN '"maybe"' WHEN event_id % 2 = 0
      THEN 'false' ELSE '0' END,
    ', "source": "http", "source_host": null, "source_service": "svc-', user_id % 8,
    '", "level": ', CASE WHEN event_id % 20 = 5 THEN concat('[', user_id, ']')
      WHEN event_id % 20 = 11 THEN concat('"grade ', user_id % 3, '"')
      WHEN event_type = 'error' THEN '"ERROR"' ELSE '"INFO"' END,
    CASE WHEN event_id % 20 = 6 THEN '' ELSE concat(', "message": "', event_type, ' ', event_id, '"') END,
    ', "format": "json", "metadata": ',
    CASE WHEN event_id % 20 = 12 THEN '"[1]"' WHEN event_id % 20 = 13 THEN 'null'
      WHEN event_id % 20 = 14 THEN concat('"{\\\\"k\\\\": ', k, '}"')
      ELSE concat('{"http_status": 404, "k": ', k, '}') END,
    ', "http_status": ', CASE event_id % 20 WHEN 15 THEN '"200"' WHEN 16 THEN '200.0'
      WHEN 17 THEN '200.5' WHEN 18 THEN '99' WHEN 0 THEN '"abc"' ELSE 'null' END,
    ', "http_response_time_ms": ', CASE event_id % 20 WHEN 19 THEN '-1' WHEN 1 THEN '0'
      ELSE 'null' END,
    ', "error_type": ', CASE WHEN event_type = 'error' AND event_id % 3 > 0
      THEN '"TimeoutError"' ELSE 'null' END,
    ', "is_parsed": true, "parse_errors": null}')
"""
# A message that breaks off at a place of its own, one inside a list, and all others.
MESSAGE_SQL = f"""
CASE event_id % 20 WHEN 3 THEN left({VALID_MESSAGE_SQL}, cast(15 + event_id % 60 AS int))
  WHEN 4 THEN concat('[', {VALID_MESSAGE_SQL}, ']') ELSE {VALID_MESSAGE_SQL} END
"""


def topic_messages(spark, folder) -> DataFrame:
    """Topic records with log records as JSON; some are malformed."""
    return events(spark, folder).select(
        "event_id",
        F.expr("encode(concat('svc-', user_id % 8), 'UTF-8')").alias("key"),
        F.encode(F.expr(MESSAGE_SQL), "UTF-8").alias("value"),
        F.lit("logs.raw").alias("topic"),
        F.expr("cast(event_id % 3 AS int)").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.expr("cast(ts AS timestamp)").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.lit(None).cast("array<struct<key:string,value:binary>>").alias("headers"))


# Error texts of the dead letters: one for every pattern of the classes, then texts of two classes and of none.
DLQ_PHRASES = [
    "timeout", "timed out", "connection", "temporarily disabled", "502", "503", "504", "upstream timed out",
    "connection refused", "connection reset", "network error",
    "unrecognized column", "unknown column", "table t_7 doesn't exist", "access denied", "authentication",
    "permission denied", "schema", "type mismatch", "cannot parse",
    "invalid json", "json decode", "malformed", "validation error", "parse error", "decode error",
    "schema lookup timeout", "malformed schema", "5021 rows", "no cause given", "disk full",
]


def dlq_text():
    """The phrase of an event with its number behind it, every other time in capitals."""
    phrase = F.element_at(F.array(*map(F.lit, DLQ_PHRASES)), F.expr(f"cast(event_id % {len(DLQ_PHRASES)} + 1 AS int)"))
    return F.concat(F.lit("step "), F.expr("event_id % 4"), F.lit(": "),
                    F.when(F.expr("event_id % 2 = 0"), F.upper(phrase)).otherwise(phrase))


LOG_VALUE_SQL = """
concat('{"level":"INFO","message":"', event_type, ' ', event_id, '","source":"http",',
  '"source_service":"svc-', user_id % 8, '"}')
"""
DLQ_VALUE_SQL = f"""
CASE WHEN event_id % 23 = 0 THEN concat('junk ', event_id)
  WHEN event_id % 29 = 0 THEN {LOG_VALUE_SQL}
  WHEN event_id % 4 = 1 THEN concat('{{"created_at":"2024-01-30T10:00:00","error_message":"', text,
    '","error_type":"parse_error","id":"', event_id, '","raw_payload":"bad line ', event_id,
    '","source":"file"}}')
  WHEN event_id % 4 = 2 THEN concat('{{"dlq_id":"', event_id,
    '","dlq_timestamp":"2024-01-30T11:00:00","error_message":"', text,
    '","error_type":"clickhouse_insert_failure","original_log":', {LOG_VALUE_SQL}, '}}')
  WHEN event_id % 4 = 3 THEN concat('{{"dlq_id":"', event_id,
    '","dlq_timestamp":"2024-01-30T12:00:00","error_message":"', text,
    '","error_type":"message_parse_error","raw_payload":"{{\\\\"source\\\\":', event_id, '}}"}}')
  ELSE {LOG_VALUE_SQL} END
"""


def dead_letters(spark, folder) -> DataFrame:
    """The dead-letter topic: four value shapes and junk; errors in headers or in the value."""
    df = events(spark, folder).withColumn("text", dlq_text())
    plain_log = (F.col("event_id") % 4 == 0) & (F.col("event_id") % 23 != 0) & (
        F.col("event_id") % 29 != 0)
    header = lambda key, value: F.struct(
        F.lit(key).alias("key"), F.encode(value, "UTF-8").alias("value"))
    headers = F.when(plain_log, F.array(
        header("error_message", F.lit("superseded")), header("error_message", F.col("text")),
        header("error_type", F.lit("insert_error"))))
    return df.select(
        F.expr("CASE WHEN event_id % 5 <> 0 THEN encode(concat('svc-', user_id % 8), 'UTF-8') END")
        .alias("key"),
        F.encode(F.expr(DLQ_VALUE_SQL), "UTF-8").alias("value"),
        F.lit("logs.dead_letter").alias("topic"),
        F.expr("cast(event_id % 3 AS int)").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.expr("cast(ts AS timestamp)").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        headers.alias("headers"))


def committed_offsets(spark, folder) -> DataFrame:
    """Committed offsets of partitions 0 and 1: a quarter of what each holds."""
    counts = events(spark, folder).groupBy(
        F.expr("cast(event_id % 3 AS int)").alias("partition")).agg(F.count("*").alias("n"))
    return counts.filter("partition < 2").select(
        "partition", F.expr("n div 4").alias("committed_offset"))


def batch_stats(spark, folder) -> DataFrame:
    """Batch statistics: one row per 100 events."""
    df = events(spark, folder).groupBy(F.expr("event_id div 100").alias("batch_id")).agg(
        F.count("*").alias("consumed"), F.count_if(F.expr("event_id % 97 = 0")).alias("rejected"))
    return df.select(
        F.col("batch_id"), F.lit("logs.raw").alias("topic"), "consumed",
        F.expr("CASE WHEN batch_id % 9 = 4 THEN 0 ELSE consumed - rejected END").alias("written"),
        "rejected",
        F.expr("CASE WHEN batch_id % 9 = 4 THEN 'dlq' ELSE 'success' END").alias("status"),
        F.expr("""CASE WHEN batch_id % 9 = 4 THEN 3 WHEN batch_id % 5 = 0 THEN 1 ELSE 0 END""")
        .alias("failed_attempts"),
        F.expr("CASE WHEN batch_id % 9 = 4 THEN 'clickhouse_insert_failure' END")
        .alias("error_type"),
        F.expr("(batch_id % 40) * 0.03D").alias("write_seconds"),
        F.expr("(batch_id % 40) * 0.03D + 0.005D").alias("flush_seconds"),
    ).select(*BATCH_STATS_SCHEMA.fieldNames())
