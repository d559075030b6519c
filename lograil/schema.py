"""Column layout of the log table, the dead-letter table and the batch statistics."""

from pyspark.sql import types as T

# The stored log record, in table order.
LOG_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("ingested_at", T.TimestampType(), False),
    T.StructField("event_time_missing", T.IntegerType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("source_host", T.StringType(), False),
    T.StructField("source_service", T.StringType(), False),
    T.StructField("level", T.StringType(), False),
    T.StructField("message", T.StringType(), False),
    T.StructField("parsed_message", T.StringType(), False),
    T.StructField("format", T.StringType(), False),
    T.StructField("metadata", T.StringType(), False),
    T.StructField("user_id", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField("trace_id", T.StringType()),
    T.StructField("span_id", T.StringType()),
    T.StructField("http_method", T.StringType()),
    T.StructField("http_path", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("http_response_time_ms", T.LongType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("error_stack", T.StringType()),
    T.StructField("is_parsed", T.IntegerType(), False),
    T.StructField("parse_errors", T.StringType()),
])
LOG_COLUMNS = LOG_SCHEMA.fieldNames()

# Types a parser hands to validation: flags are booleans, everything may be null.
RECORD_TYPES = {
    f.name: "boolean" if f.name in ("event_time_missing", "is_parsed")
    else f.dataType.simpleString()
    for f in LOG_SCHEMA.fields
}

# Fixed values: (required, minimum length, maximum length) per text column.
TEXT_RULES = {
    "source": (True, 1, 50),
    "source_host": (False, 0, 255),
    "source_service": (True, 1, 100),
    "level": (True, 0, 20),
    "message": (True, 1, 10000),
    "parsed_message": (False, 0, 10000),
    "format": (True, 0, 20),
    "user_id": (False, 0, 255),
    "request_id": (False, 0, 255),
    "trace_id": (False, 0, 255),
    "span_id": (False, 0, 255),
    "http_method": (False, 0, 10),
    "http_path": (False, 0, 2000),
    "error_type": (False, 0, 100),
    "error_stack": (False, 0, 50000),
}

# Fixed values: (minimum, maximum) per integer column.
RANGE_RULES = {
    "http_status": (100, 599),
    "http_response_time_ms": (0, None),
}

# Fixed values: (required, minimum length, maximum length) of an ingest request.
REQUEST_RULES = {
    "source": (True, 1, 50),
    "source_service": (True, 1, 100),
    "level": (True, 1, 10),
    "message": (True, 1, 10000),
    "source_host": (False, 0, 255),
    "trace_id": (False, 0, 255),
}

# A topic record as the Kafka source delivers it (headers included).
TOPIC_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
])

# One dead letter whichever producer wrote it.
DLQ_SCHEMA = T.StructType([
    T.StructField("dlq_id", T.StringType()),
    T.StructField("dlq_time", T.TimestampType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("raw_payload", T.StringType()),
    T.StructField("original_log", T.StringType()),
    T.StructField("shape", T.StringType()),
])

# One row per flushed micro-batch.
BATCH_STATS_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("topic", T.StringType()),
    T.StructField("consumed", T.LongType()),
    T.StructField("written", T.LongType()),
    T.StructField("rejected", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("failed_attempts", T.IntegerType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("write_seconds", T.DoubleType()),
    T.StructField("flush_seconds", T.DoubleType()),
])
