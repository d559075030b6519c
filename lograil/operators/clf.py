"""Access-log job: common and combined log format lines to log records."""

from pyspark.sql import DataFrame, functions as F

from lograil.functions.levels import status_level
from lograil.functions.text import (
    FLAGS, NS, S, blank_to_null, dash_to_null, pinned, regex_groups, strip,
)
from lograil.functions.times import clf_timestamp

# host ident user [time] "request" status bytes, optionally "referer" "agent", nothing after.
LINE = (
    rf'{FLAGS}^({NS}+){S}+({NS}+){S}+({NS}+){S}+\[([^\]]+)\]{S}+"([^"]*)"{S}+'
    rf'([0-9]{{3}}){S}+([0-9]+|-)((?:{S}+"([^"]*)"{S}+"([^"]*)")?)$'
)
REQUEST = (
    rf"{FLAGS}^([A-Z!#$%&'*+\-.^_`|~0-9]+){S}+({NS}+)(?:{S}+(HTTP/[0-9](?:\.[0-9])?))?$"
)

NOT_CLF = "line is not in common or combined log format"
EMPTY = "line is empty"


def parse_clf(df: DataFrame, content="value") -> DataFrame:
    """Add the record columns and ``errors`` to a frame of access-log lines."""
    # Step 1: one match per line.
    df = df.withColumn("_line", strip(F.col(content)))
    df = df.withColumn("_clf", regex_groups(F.col("_line"), LINE, 10))
    fits = F.size("_clf") == 10
    part = {
        name: F.when(fits, F.col("_clf")[i])
        for i, name in enumerate(
            ["_host", "_ident", "_user", "_time", "_request", "_status", "_bytes", "_pair",
             "_referer", "_agent"])
    }
    df = df.withColumns(part)
    # Step 2: the request line; "-", empty or odd text leaves method and path null.
    request = F.when(F.col("_request") != "-", regex_groups(F.col("_request"), REQUEST, 3))
    df = df.withColumns({"_req": request, "created_at": clf_timestamp(F.col("_time"))})
    parsed_request = F.size("_req") == 3
    df = df.withColumns({
        "http_method": F.when(parsed_request, F.col("_req")[0]),
        "http_path": F.when(parsed_request, F.col("_req")[1]),
        "_protocol": F.when(parsed_request, blank_to_null(F.col("_req")[2])),
        "http_status": F.col("_status").cast("int"),
    })
    combined = F.col("_pair") != ""
    message = F.concat_ws(
        " ", F.lit("HTTP"), F.col("http_status").cast("string"),
        F.when(F.col("http_method").isNotNull(),
               F.concat_ws(" ", "http_method", "http_path"))
        .when(F.col("_request").isin("-", ""), F.lit("<no-request>"))
        .otherwise(F.lit("<unparsed-request>")))
    # Keys that are always present, null or not.
    always = F.struct(
        F.col("_host").alias("remote_addr"),
        dash_to_null(F.col("_ident")).alias("ident"),
        blank_to_null(F.col("_request")).alias("request_raw"),
        F.col("_protocol").alias("http_protocol"),
        F.col("_bytes").try_cast("decimal(38,0)").alias("body_bytes_sent"),
    )
    # Keys that exist only with a value.
    extra = F.struct(
        F.when(F.col("created_at").isNull(), True).alias("event_timestamp_missing"),
        F.when(F.col("created_at").isNull(), F.col("_time")).alias("event_timestamp_raw"),
        F.when(combined, dash_to_null(F.col("_referer"))).alias("http_referer"),
        F.when(combined, dash_to_null(F.col("_agent"))).alias("http_user_agent"),
    )
    text = F.col("_line")
    errors = (
        F.when(text.isNull() | (text == ""), F.lit(EMPTY))
        .when(F.col("_host").isNull(), F.lit(NOT_CLF))
    )
    return df.withColumns({
        "source": F.lit("http"),
        "source_host": F.col("_host"),
        "source_service": F.lit("access-log"),
        "level": status_level(F.col("http_status")),
        "message": message,
        "format": F.lit("clf"),
        "user_id": dash_to_null(F.col("_user")),
        "metadata": merge_json(always, extra),
        "errors": pinned(errors),
    }).drop("_line", "_clf", "_req", "_protocol", *part)


def merge_json(always, extra):
    """One JSON object of two structs; null members of the second are left out."""
    first = F.rtrim(F.to_json(always, {"ignoreNullFields": "false"}), F.lit("}"))
    second = F.to_json(extra)
    return F.concat(first, F.when(second == "{}", "}").otherwise(
        F.concat(F.lit(","), F.ltrim(second, F.lit("{")))))
