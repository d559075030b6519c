"""Syslog job: RFC 5424 lines to log records."""

from pyspark.sql import Column, DataFrame, functions as F

from lograil.functions.levels import severity_level
from lograil.functions.text import (
    FLAGS, NS, S, dash_to_null, lstrip, pinned, regex_groups, strip,
)
from lograil.functions.times import iso_timestamp
from lograil.operators.clf import EMPTY, merge_json

# <PRI>VERSION TIME HOST APP PROCID MSGID rest
HEADER = (
    rf"{FLAGS}^<([0-9]{{1,3}})>([0-9]{{1,3}}){S}+({NS}+){S}+({NS}+){S}+({NS}+){S}+"
    rf"({NS}+){S}+({NS}+){S}+([^\n]*)$"
)
# One structured-data element. Possessive repeats keep the match linear and free of recursion.
_ELEMENT = r'\[(?:[^"\[\]\\]++|\\.|"(?:[^"\\]++|\\.)*+")*+\]'
_TOLERANT_SD = rf"(?d)^({_ELEMENT}(?: *{_ELEMENT})*+)(?! *\[)"
_ADJACENT_SD = rf"(?d)^((?:{_ELEMENT})++)(?!\[)"

NOT_SYSLOG = "line does not match the RFC 5424 syslog header"
# Stored texts of the two faults of structured data.
SD_START = "STRUCTURED-DATA must start with '-' or '['"
SD_OPEN = "Unterminated STRUCTURED-DATA (missing closing ']')"


def _scan_length(s: Column, spaced: bool) -> Column:
    """Length of the structured data of ``s`` by a scan over its characters, null if it never ends.

    Only for text the patterns cannot describe (unquoted nested brackets). The state holds the
    characters read, whether the next one is escaped, whether quotes are open, the bracket depth,
    the end of the last closed element, and whether the data has ended.
    """
    start = F.struct(
        F.lit(0).alias("n"), F.lit(False).alias("esc"), F.lit(False).alias("quo"),
        F.lit(0).alias("depth"), F.lit(0).alias("end"), F.lit(False).alias("done"))

    def step(a, ch):
        between = (a.depth == 0) & (a.n > 0) & ~a.quo & ~a.esc
        continues = (ch == "[") | ((ch == " ") & F.lit(spaced))
        ends = a.done | (between & ~continues)
        opens = ~a.esc & ~a.quo & (ch == "[")
        closes = ~a.esc & ~a.quo & (ch == "]")
        depth = a.depth + F.when(opens, 1).when(closes, -1).otherwise(0)
        return F.struct(
            (a.n + 1).alias("n"),
            F.when(ends, a.esc).otherwise(~a.esc & (ch == "\\")).alias("esc"),
            F.when(~ends & ~a.esc & (ch == '"'), ~a.quo).otherwise(a.quo).alias("quo"),
            F.when(ends, a.depth).otherwise(depth).alias("depth"),
            F.when(~ends & closes & (depth == 0), a.n + 1).otherwise(a.end).alias("end"),
            ends.alias("done"))

    state = F.aggregate(F.filter(F.split(s, ""), lambda ch: ch != ""), start, step)
    return F.when(state.getField("depth") == 0, state.getField("end"))


def structured_data(rest: Column, allow_spaced=True) -> dict[str, Column]:
    """Split the text after MSGID into structured data, message and error.

    ``allow_spaced`` also takes elements separated by spaces as one block.
    """
    s = lstrip(rest)
    by_pattern = F.length(F.regexp_extract(s, _TOLERANT_SD if allow_spaced else _ADJACENT_SD, 1))
    size = F.coalesce(F.nullif(by_pattern, F.lit(0)), _scan_length(s, allow_spaced))
    nil = F.startswith(s, F.lit("-"))
    bracket = F.startswith(s, F.lit("["))
    return {
        "_sd_text": s,
        "_sd_size": F.when(bracket, size),
        "_sd_kind": F.when(nil, "nil").when(bracket, "bracket").otherwise("other"),
    }


def parse_syslog(df: DataFrame, content="value", strict=False, allow_spaced=True) -> DataFrame:
    """Add the record columns and ``errors`` to a frame of syslog lines.

    ``strict`` turns out-of-range priorities, versions other than 1, invalid timestamps and
    malformed structured data into rejects.
    """
    df = df.withColumn("_line", strip(F.col(content)))
    df = df.withColumn("_hdr", regex_groups(F.col("_line"), HEADER, 8))
    fits = F.size("_hdr") == 8
    names = ["_pri", "_ver", "_ts", "_host", "_app", "_proc", "_msgid", "_rest"]
    part = {name: F.when(fits, F.col("_hdr")[i]) for i, name in enumerate(names)}
    part["_pri"] = part["_pri"].cast("int")
    part["_ver"] = part["_ver"].cast("int")
    df = df.withColumns(part)
    df = df.withColumns({
        "created_at": F.when(F.col("_ts") != "-", iso_timestamp(F.col("_ts"))),
        **structured_data(F.col("_rest"), allow_spaced),
    })

    severity = F.pmod(F.col("_pri"), F.lit(8))
    in_sd = (F.col("_sd_kind") == "bracket") & F.col("_sd_size").isNotNull()
    nil_tail = F.substring(F.col("_sd_text"), 2, 2147483647)
    message = (
        F.when(F.col("_sd_kind") == "nil",
               F.when(F.startswith(nil_tail, F.lit(" ")), nil_tail).otherwise(F.lit("")))
        .when(in_sd, F.substring(F.col("_sd_text"), F.col("_sd_size") + 1,
                                 F.length("_sd_text")))
        .otherwise(F.col("_sd_text"))
    )
    sd_error = (
        F.when((F.col("_sd_kind") == "bracket") & ~in_sd, F.lit(SD_OPEN))
        .when(F.col("_sd_kind") == "other", F.lit(SD_START))
    )
    always = F.struct(
        F.col("_pri").alias("syslog_priority"),
        severity.alias("syslog_severity"),
        F.floor(F.col("_pri") / 8).cast("int").alias("syslog_facility"),
        F.col("_ver").alias("syslog_version"),
        dash_to_null(F.col("_proc")).alias("proc_id"),
        dash_to_null(F.col("_msgid")).alias("msg_id"),
        F.when(in_sd, F.substring(F.col("_sd_text"), F.lit(1), F.col("_sd_size")))
        .alias("structured_data"),
    )
    no_time = F.col("created_at").isNull()
    extra = F.struct(
        F.when(no_time, True).alias("event_timestamp_missing"),
        F.when(no_time, F.col("_ts")).alias("event_timestamp_raw"),
        sd_error.alias("structured_data_parse_error"),
    )
    strict_error = F.coalesce(
        F.when(~F.col("_pri").between(0, 191), F.lit("priority out of range (0..191)")),
        F.when(F.col("_ver") != 1, F.lit("unsupported version (expected 1)")),
        F.when((F.col("_ts") != "-") & no_time, F.lit("invalid timestamp")),
        F.when(sd_error.isNotNull(), F.concat(F.lit("malformed structured data: "), sd_error)),
    ) if strict else F.lit(None).cast("string")
    text = F.col("_line")
    errors = (
        F.when(text.isNull() | (text == ""), F.lit(EMPTY))
        .when(F.col("_pri").isNull(), F.lit(NOT_SYSLOG))
        .otherwise(strict_error)
    )
    return df.withColumns({
        "source": F.lit("syslog"),
        "source_host": dash_to_null(F.col("_host")),
        "source_service": F.when(F.col("_app") == "-", "unknown").otherwise(F.col("_app")),
        "level": severity_level(severity),
        "message": strip(message),
        "format": F.lit("syslog"),
        "metadata": merge_json(always, extra),
        "errors": pinned(errors),
    }).drop("_line", "_hdr", "_sd_text", "_sd_size", "_sd_kind", *names)
