"""JSON jobs: ingest requests (single, JSONL, batch documents) and topic messages."""

from pyspark.sql import Column, DataFrame, functions as F

from lograil.functions import jsonx, times
from lograil.functions.jsonx import Member, with_members, with_text_members
from lograil.functions.text import parse_uuid, pinned
from lograil.operators.validate import collect_errors, level_error, request_errors
from lograil.schema import RECORD_TYPES, TEXT_RULES

NOT_JSON = "value is not valid JSON"
NOT_OBJECT = "value is not a JSON object"

_REQUEST_TEXT = ["source", "source_service", "level", "message", "source_host", "trace_id"]

# Members of a topic message that are texts as a rule.
_MESSAGE_TEXT = [n for n, kind in RECORD_TYPES.items() if kind in ("string", "timestamp") and n != "metadata"]


def _event_time(m: Member) -> Column:
    """Event time of a JSON member: text or epoch seconds; any other value is null."""
    return (
        F.when(m.is_text, times.event_time_text(m.cast("string")))
        .when(m.is_number, times.event_time_epoch(m.cast("double")))
        .when(m.is_flag, times.event_time_epoch(m.cast("boolean").cast("int")))
    )


def _document_error(valid: Column, members: Column) -> Column:
    """Why a value has no members; ``members`` is null for all but objects, and cheaper than the type of a whole document."""
    return F.when(~valid, F.lit(NOT_JSON)).when(members.isNull(), F.lit(NOT_OBJECT))


def parse_requests(df: DataFrame, content="value", default_source=None,
                   default_source_service=None) -> DataFrame:
    """Ingest requests as JSON text: add the record columns, ``errors`` and variant ``_meta``.

    The defaults apply only where the key itself is absent; an explicit null stays an error.
    """
    return request_columns(
        df.withColumn("_v", jsonx.parse(F.col(content))), default_source, default_source_service
    ).drop("_v")


def request_columns(df: DataFrame, default_source=None, default_source_service=None) -> DataFrame:
    """As ``parse_requests`` for documents already held in the variant column ``_v``."""
    df, m, helpers = with_members(
        df, F.col("_v"), [*_REQUEST_TEXT, "payload", "created_at"], texts=[*_REQUEST_TEXT, "created_at"])
    defaults = {"source": default_source, "source_service": default_source_service}
    columns, shapes = {}, {}
    for name in _REQUEST_TEXT:
        columns[name], shapes[name] = m[name].text(), m[name].shape
        if defaults.get(name) is not None:
            columns[name] = F.when(m[name].shape.isNull(), F.lit(defaults[name])).otherwise(
                columns[name])
            shapes[name] = F.coalesce(shapes[name], F.lit("STRING"))
    df = df.withColumns({
        **columns,
        "created_at": _event_time(m["created_at"]),
        "_meta": F.when(m["payload"].is_object, m["payload"].value),
        "_doc_error": _document_error(F.col("_v").isNotNull(), F.col(helpers[0])),
    })
    rules = collect_errors(
        *request_errors(F.col, shapes),
        F.when(m["payload"].present & ~m["payload"].is_null & ~m["payload"].is_object,
               F.lit("payload: must be an object")),
        level_error(F.col("level")),
    )
    return df.withColumns({
        "errors": pinned(F.coalesce("_doc_error", rules)),
        "metadata": F.coalesce(F.to_json("_meta"), F.lit("{}")),
        "format": F.lit("json"),
    }).drop("_doc_error", *helpers)


def explode_batches(df: DataFrame, content="value", max_logs=1000) -> DataFrame:
    """Batch documents ``{"logs": [...]}`` to one row per log with its ``index``.

    A document that is no JSON, has no list of logs, or holds none or more than ``max_logs`` is
    one row with index -1 and a document error.
    """
    df = df.withColumn("_doc", jsonx.parse(F.col(content)))
    df = df.withColumn("_logs", F.try_variant_get("_doc", "$.logs", "array<variant>"))
    size = F.size("_logs")
    df = df.withColumn("document_error", (
        F.when(F.col("_doc").isNull(), F.lit(NOT_JSON))
        .when(F.col("_logs").isNull(), F.lit("logs: must be a list"))
        .when(size == 0, F.lit("logs: must hold at least 1 log"))
        .when(size > max_logs, F.lit(f"logs: must hold at most {max_logs} logs"))
    ))
    items = F.when(F.col("document_error").isNull(), F.col("_logs"))
    keep = [c for c in df.columns if c not in ("_doc", "_logs")]
    df = df.select(*keep, F.posexplode_outer(items).alias("index", "_v"))
    return df.withColumn("index", F.coalesce("index", F.lit(-1)))


def parse_batches(df: DataFrame, content="value", max_logs=1000) -> DataFrame:
    """Batch documents to validated-request columns, one row per log or broken document."""
    df = request_columns(explode_batches(df, content, max_logs))
    return df.withColumn("errors", pinned(F.coalesce("document_error", "errors"))).drop(
        "_v", "document_error")


def _declared_time(m: Member) -> Column:
    """A declared timestamp: ISO text, epoch seconds or (beyond 2e10) epoch milliseconds."""
    number = m.cast("double")
    seconds = F.when(F.abs(number) > F.lit(2e10), number / 1000).otherwise(number)
    return (
        F.when(m.is_text, times.iso_timestamp(m.cast("string")))
        .when(m.is_number, times.event_time_epoch(seconds))
    )


def parse_messages(df: DataFrame, content="value") -> DataFrame:
    """Topic messages (full log records as JSON): record columns, ``errors``, variant ``_meta``."""
    text = F.col(content).cast("string")
    df, m, valid, helpers = with_text_members(df, text, list(RECORD_TYPES), texts=_MESSAGE_TEXT)
    meta = m["metadata"]
    df = df.withColumn("_meta_text", F.when(meta.is_text, jsonx.parse(meta.cast("string"))))
    texts = [n for n in TEXT_RULES if n != "level"] + ["level", "parse_errors"]
    df = df.withColumns({
        **{name: m[name].text() for name in texts},
        "id": parse_uuid(m["id"].text()),
        "created_at": _event_time(m["created_at"]),
        "ingested_at": _declared_time(m["ingested_at"]),
        "event_time_missing": m["event_time_missing"].flag(),
        "is_parsed": m["is_parsed"].flag(),
        "http_status": m["http_status"].whole_number().try_cast("int"),
        "http_response_time_ms": m["http_response_time_ms"].whole_number(),
        "_meta": F.when(meta.is_object, meta.value)
        .when(meta.is_text, F.when(jsonx.is_object(F.col("_meta_text")), F.col("_meta_text")))
        .when(~meta.present | meta.is_null, F.parse_json(F.lit("{}"))),
        "_doc_error": _document_error(valid, F.col(helpers[0])),
    })

    def wrong(name, what, nullable=False):
        """Error where the key is present and its value could not be read as ``what``."""
        bad = m[name].present & F.col(name).isNull()
        if nullable:
            bad = bad & ~m[name].is_null
        return F.when(bad, F.lit(f"{name}: must be {what}"))

    required = {n for n, (needed, _, _) in TEXT_RULES.items() if needed}
    checks = [wrong(n, "a string", n not in required) for n in texts] + [
        wrong("id", "a UUID"),
        wrong("ingested_at", "a timestamp"),
        wrong("event_time_missing", "a boolean"),
        wrong("is_parsed", "a boolean"),
        wrong("http_status", "an integer", True),
        wrong("http_response_time_ms", "an integer", True),
        F.when(F.col("_meta").isNull(), F.lit("metadata: must be a JSON object")),
    ]
    df = df.withColumn("errors", pinned(F.coalesce("_doc_error", collect_errors(*checks))))
    return df.withColumns({
        "format": F.when(~m["format"].present, F.lit("json")).otherwise(F.col("format")),
        "is_parsed": F.coalesce("is_parsed", F.lit(True)),
        "event_time_missing": F.coalesce("event_time_missing", F.lit(False)),
        "metadata": F.coalesce(F.to_json("_meta"), F.lit("{}")),
    }).drop("_meta_text", "_doc_error", *helpers)
