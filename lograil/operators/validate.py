"""Validation and normalisation of parsed records.

A parser adds the columns of ``RECORD_TYPES`` and an ``errors`` text to its input. ``finish``
checks and completes them; afterwards every row holds either a storable log record (``errors``
is null) or a reject with the reasons. All of it is one narrow projection chain.
"""

from pyspark.sql import Column, DataFrame, functions as F

from lograil.functions import jsonx, times
from lograil.functions.levels import normalise_level
from lograil.functions.text import blank_to_null, let, pinned, stable_uuid
from lograil.schema import (
    LOG_SCHEMA, RANGE_RULES, RECORD_TYPES, REQUEST_RULES, TEXT_RULES,
)


def length_errors(rules: dict, column=F.col) -> list[Column]:
    """One nullable error text per rule on a text column."""
    found = []
    for name, (required, low, high) in rules.items():
        c = column(name)
        rule = F.when(F.length(c) > high, F.lit(f"{name}: longer than {high} characters"))
        if low:
            rule = rule.when(F.length(c) < low, F.lit(f"{name}: shorter than {low} characters"))
        if required:
            rule = rule.when(c.isNull(), F.lit(f"{name}: required"))
        found.append(rule)
    return found


def range_errors(rules: dict = RANGE_RULES, column=F.col) -> list[Column]:
    found = []
    for name, (low, high) in rules.items():
        c = column(name)
        outside = c < low if high is None else ~c.between(low, high)
        limit = f"at least {low}" if high is None else f"{low} to {high}"
        found.append(F.when(outside, F.lit(f"{name}: must be {limit}")))
    return found


def level_error(raw: Column) -> Column:
    return F.when(
        raw.isNotNull() & normalise_level(raw).isNull(),
        F.concat(F.lit("level: unknown level '"), raw, F.lit("'")))


def collect_errors(*errors: Column) -> Column:
    """All non-null error texts in rule order as one text; null if there is none."""
    return blank_to_null(F.concat_ws("; ", *errors))


def metadata_variant(text: Column) -> Column:
    """Metadata text as a variant object: null becomes {}, invalid or non-object becomes null."""
    return let(jsonx.parse(F.coalesce(text, F.lit("{}"))),
               lambda v: F.when(jsonx.is_object(v), v))


def metadata_error(text: Column, v: Column) -> Column:
    return F.when(
        text.isNotNull() & v.isNull(), F.lit("metadata: must be a JSON object"))


# Column filled from metadata, and the metadata key it comes from.
PROMOTED_TEXT = {
    "trace_id": "trace_id",
    "span_id": "span_id",
    "request_id": "request_id",
    "user_id": "user_id",
    "http_method": "http_method",
}
PROMOTED_NUMBERS = {
    "http_status": "http_status",
    "http_response_time_ms": "response_time_ms",
}


def promote(df: DataFrame, meta: str) -> DataFrame:
    """Fill empty columns from the metadata in the variant column ``meta``; given values win."""
    keys = [*PROMOTED_TEXT.values(), *PROMOTED_NUMBERS.values()]
    df, m, helpers = jsonx.with_members(df, F.col(meta), keys, "_p", texts=())
    out = {}
    for name, key in PROMOTED_TEXT.items():
        out[name] = F.coalesce(blank_to_null(F.col(name)), m[key].as_text(), F.col(name))
    for name, key in PROMOTED_NUMBERS.items():
        low, high = RANGE_RULES[name]
        number = m[key].truncated_number()
        fits = number >= low if high is None else number.between(low, high)
        out[name] = F.coalesce(
            F.col(name), F.when(fits, number.try_cast(RECORD_TYPES[name])))
    return df.withColumns(out).drop(*helpers)


def with_record_defaults(df: DataFrame) -> DataFrame:
    """Add the record columns a parser did not set, with their default values."""
    defaults = {"format": F.lit("json"), "metadata": F.lit("{}"), "is_parsed": F.lit(True),
                "event_time_missing": F.lit(False)}
    missing = {
        name: defaults.get(name, F.lit(None)).cast(kind)
        for name, kind in RECORD_TYPES.items() if name not in df.columns
    }
    return df.withColumns(missing)


def event_time_columns(created_at: Column, ingested_at: Column, missing: Column = None) -> dict:
    """Event time with the fallback to ingest time, and the flag that tells about it."""
    return {
        "created_at": times.to_millis(F.coalesce(created_at, ingested_at)),
        "ingested_at": times.to_millis(ingested_at),
        "event_time_missing": (
            created_at.isNull() | F.coalesce(missing, F.lit(False)) if missing is not None
            else created_at.isNull()
        ).cast("int"),
    }


def storage_columns(column=F.col) -> dict[str, Column]:
    """Flags as 0/1, empty text for a missing host or parsed message, {} for no metadata."""
    return {
        "source_host": F.coalesce(column("source_host"), F.lit("")),
        "parsed_message": F.coalesce(column("parsed_message"), F.lit("")),
        "metadata": F.coalesce(column("metadata"), F.lit("{}")),
        "is_parsed": column("is_parsed").cast("int"),
    }


def finish(df: DataFrame, ingested_at=None, id_from=None, promoted=False, meta=None) -> DataFrame:
    """Check a parsed frame and bring it to the stored form.

    ``ingested_at`` is the ingest time (column or value, default now), used where the record has
    none. ``id_from`` names the columns that identify the input row; the id of a record without
    one is derived from them, so that a retry gives the same id. ``promoted`` fills empty columns
    from metadata; ``meta`` names a column that already holds the metadata as a variant.
    """
    df = with_record_defaults(df)
    if "errors" not in df.columns:
        df = df.withColumn("errors", F.lit(None).cast("string"))
    now = F.current_timestamp() if ingested_at is None else (
        ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at).cast("timestamp"))
    new_id = stable_uuid(*map(F.col, id_from)) if id_from else F.uuid()

    checks = collect_errors(
        *length_errors(TEXT_RULES), *range_errors(), level_error(F.col("level")))
    # A row its parser refused is not checked again: its columns say nothing.
    df = df.withColumn("errors", pinned(F.coalesce("errors", checks)))
    df = df.withColumns({
        **event_time_columns(
            F.col("created_at"), F.coalesce(F.col("ingested_at"), now),
            F.col("event_time_missing")),
        "id": F.coalesce(F.col("id"), new_id),
        "level": normalise_level(F.col("level")),
    })
    if promoted:
        if meta is None:
            df, meta = df.withColumn("_meta", metadata_variant(F.col("metadata"))), "_meta"
            df = df.withColumn("metadata", F.coalesce(F.to_json("_meta"), F.lit("{}")))
        df = promote(df, meta).drop(meta)
    return df.withColumns(storage_columns())


def _outcome(df: DataFrame, bad: bool) -> DataFrame:
    """The rows of one outcome; a stored outcome reads only the folder of it."""
    rows = df.filter(F.col("errors").isNotNull() if bad else F.col("errors").isNull())
    return rows.filter(F.col("is_error") == bad) if "is_error" in df.columns else rows


def accepted(df: DataFrame, keep=()) -> DataFrame:
    """The valid rows as log records (plus the named input columns)."""
    # Every column after the id is non-null by validation; the cast fixes the type only.
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields]
    return _outcome(df, False).select(*keep, *fields)


def rejected(df: DataFrame, raw="value", keep=()) -> DataFrame:
    """The invalid rows: their raw text and all reasons in one text."""
    return _outcome(df, True).select(
        *keep, F.col(raw).cast("string").alias("raw_payload"),
        F.col("errors").alias("error_message"))


def with_event_date(logs: DataFrame) -> DataFrame:
    return logs.withColumn("event_date", F.to_date("created_at"))


def request_errors(column, types: dict[str, Column]) -> list[Column]:
    """Rules of an ingest request: text fields must be JSON strings within their limits."""
    found = []
    for name, (required, low, high) in REQUEST_RULES.items():
        c, t = column(name), types[name]
        # An optional field may be null.
        allowed = ["STRING"] if required else ["STRING", "VOID"]
        rule = F.when(~t.isin(*allowed), F.lit(f"{name}: must be a string"))
        if required:
            rule = rule.when(t.isNull(), F.lit(f"{name}: required"))
        rule = rule.when(F.length(c) > high, F.lit(f"{name}: longer than {high} characters"))
        if low:
            rule = rule.when(F.length(c) < low, F.lit(f"{name}: shorter than {low} characters"))
        found.append(rule)
    return found

