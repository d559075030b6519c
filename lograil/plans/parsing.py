"""Queries of the parse jobs, the validation rules and the record sources."""

from pyspark.sql import functions as F

from lograil.functions import jsonx, times
from lograil.functions.levels import normalise_level
from lograil.operators import dispatch, jsonlog, syslog, validate
from lograil.plans import inputs, oracle
from lograil.plans.inputs import as_of, millis_text
from lograil.plans.oracle import ts3, with_
from lograil.plans.registry import query
from lograil.schema import LOG_COLUMNS, TEXT_RULES
from lograil.session import scratch_dir
from lograil.sources import raw

def as_text(df, columns):
    """Log columns with timestamps as text, for comparison."""
    return df.select(*[
        millis_text(F.col(c)).alias(c) if c in ("created_at", "ingested_at") else F.col(c)
        for c in columns])


# --- sources -----------------------------------------------------------------------------------

@query("s4_json_records", with_(oracle.REQUESTS, """
SELECT event_id, error IS NULL AND m <> 0 AND m <> 10 AS valid,
  CASE m WHEN 0 THEN 'source: required' WHEN 10 THEN 'source_service: required' ELSE error END
    AS error FROM req"""))
def json_records(spark, folder):
    done = validate.finish(
        jsonlog.parse_requests(inputs.request_lines(spark, folder)),
        ingested_at=F.col("received"), id_from=["event_id"], promoted=True, meta="_meta")
    return done.select("event_id", F.col("errors").isNull().alias("valid"),
                       F.col("errors").alias("error"))


_JSONL_ROWS = f"""
SELECT event_id,
  {ts3('''coalesce(CASE m WHEN 7 THEN TIMESTAMP '2024-01-01' + to_seconds(event_id)
    WHEN 8 THEN NULL WHEN 13 THEN NULL
    WHEN 14 THEN TIMESTAMP '2024-01-01 00:00:00.25' ELSE ts END, received)''')} AS created_at,
  CASE WHEN m IN (8, 13) THEN 1 ELSE 0 END AS event_time_missing,
  CASE m WHEN 0 THEN 'file' WHEN 11 THEN 'last' ELSE 'http' END AS source,
  CASE m WHEN 10 THEN 'unknown' ELSE 'svc-' || user_id % 8 END AS source_service,
  CASE m WHEN 12 THEN 'WARN' ELSE 'ERROR' END AS level,
  event_type || ' ' || event_id AS message,
  CASE m WHEN 15 THEN '{{}}' ELSE '{{"k":' || k || ',"trace_id":"meta","user_id":"u' || user_id ||
    '"}}' END AS metadata,
  CASE WHEN event_id % 3 > 0 THEN 'tr-' || event_id % 9 WHEN m <> 15 THEN 'meta' END AS trace_id,
  CASE WHEN m <> 15 THEN 'u' || user_id END AS user_id
FROM req WHERE error IS NULL"""


@query("s3_jsonl_files", with_(oracle.REQUESTS, """
SELECT 'upload-' || event_id % 5 || '.jsonl' AS file, count(*) AS count, count(*) - count(error) AS success,
  count(error) AS failed, min(CASE WHEN error IS NOT NULL THEN 1 + event_id // 5 END) AS first_error,
  string_agg(CASE WHEN error IS NULL THEN event_type || ' ' || event_id END, ',' ORDER BY event_id)
    AS messages FROM req GROUP BY 1"""))
def jsonl_files(spark, folder):
    """Uploads as JSONL files on disk, one for each name: report per file and the stored messages in line order."""
    path, rows = scratch_dir(spark, "uploads"), inputs.request_lines(spark, folder)
    # One file of ordered lines for each name, five in all; the lines are made before they are dealt to the files.
    one = rows.filter("event_id % 5 >= 0").withColumn("upload", F.col("file")).repartition("upload").sortWithinPartitions(
        "upload", "event_id")
    one.select("value", "upload").write.option("lineSep", "\n").partitionBy("upload").text(f"{path}/lines")
    lines = raw.numbered(raw.read_jsonl_lines(spark, f"{path}/lines"))
    named = lines.withColumn("file", F.element_at(F.split(F.element_at(F.split("file", "/"), -2), "="), -1))
    done = validate.finish(jsonlog.parse_requests(named, default_source="file", default_source_service="unknown"),
                           ingested_at=as_of(), id_from=raw.LINE_KEY, promoted=True, meta="_meta")
    outcome = dispatch.store_outcome(done, f"{path}/outcome", raw.LINE_KEY)
    logs, bad = validate.accepted(outcome, raw.LINE_KEY), validate.rejected(outcome, keep=raw.LINE_KEY)
    stored = logs.groupBy("file").agg(F.count("*").alias("success"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("line", "message"))), lambda m: m["message"]), ",").alias("messages"))
    refused = bad.groupBy("file").agg(F.count("*").alias("failed"), F.min("line").alias("first_error"))
    return stored.join(refused, "file").select(
        "file", (F.col("success") + F.col("failed")).alias("count"), "success", "failed", "first_error", "messages")


@query("s3_jsonl_scan", with_(oracle.REQUESTS, _JSONL_ROWS))
def jsonl_scan(spark, folder):
    logs, _ = dispatch.run_request_job(
        inputs.request_lines(spark, folder), ingested_at=F.col("received"), id_from=["event_id"],
        keep=["event_id"], default_source="file", default_source_service="unknown")
    return as_text(logs, ["event_id", "created_at", "event_time_missing", "source",
                          "source_service", "level", "message", "metadata", "trace_id", "user_id"])


@query("s5_batch_documents", with_(oracle.REQUESTS, """
, docs AS (SELECT event_id // 50 AS doc, (event_id // 50) % 20 AS dm, event_id, m, error,
    row_number() OVER (PARTITION BY event_id // 50 ORDER BY event_id) - 1 AS idx FROM req)
SELECT doc, cast(idx AS integer) AS index, CASE m WHEN 0 THEN 'source: required'
    WHEN 10 THEN 'source_service: required' WHEN 3 THEN 'value is not a JSON object' ELSE error END
    AS error FROM docs WHERE dm NOT IN (7, 8, 9)
UNION ALL
SELECT DISTINCT doc, -1, CASE dm WHEN 7 THEN 'logs: must hold at least 1 log'
    WHEN 8 THEN 'logs: must be a list' ELSE 'value is not valid JSON' END
FROM docs WHERE dm IN (7, 8, 9)"""))
def batch_documents(spark, folder):
    parsed = jsonlog.parse_batches(inputs.batch_documents(spark, folder))
    return validate.finish(parsed, ingested_at=inputs.as_of(), id_from=["doc", "index"]).select(
        "doc", "index", F.col("errors").alias("error"))


# --- syslog ------------------------------------------------------------------------------------

_SYSLOG_EXPECTED = oracle.EVENTS + r""",
sys AS (
  SELECT *, event_id % 8 AS m, event_id * 7 % 200 AS pri,
    CASE event_id % 8 WHEN 1 THEN '[a@1 x="' || k || '"]'
      WHEN 2 THEN '[a@1 x="1"][b@1 y="' || k || '"]'
      WHEN 3 THEN '[a@1 x="1"] [b@1 y="q\"z] ' || k || '"]' WHEN 4 THEN '[a@1 x="1"]'
      WHEN 7 THEN '[a [n] ' || k || ']' END AS sd,
    CASE event_id % 8 WHEN 4 THEN '' WHEN 5 THEN '[a b="c"] [open ' || event_type
      WHEN 6 THEN 'plain ' || event_type ELSE event_type || ' event' END AS msg,
    CASE event_id % 8 WHEN 5 THEN 'Unterminated STRUCTURED-DATA (missing closing '']'')'
      WHEN 6 THEN 'STRUCTURED-DATA must start with ''-'' or ''[''' END AS sd_error,
    CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN NULL
      WHEN 2 THEN date_trunc('milliseconds', ts) - to_hours(2)
      WHEN 3 THEN date_trunc('second', ts) ELSE date_trunc('milliseconds', ts) END AS event_time
  FROM ev WHERE event_id % 37 <> 5)
"""
_SYSLOG_META = """'{"syslog_priority":' || pri || ',"syslog_severity":' || pri % 8 ||
  ',"syslog_facility":' || pri // 8 || ',"syslog_version":' ||
  CASE WHEN event_id % 31 = 0 THEN '2' ELSE '1' END || ',"proc_id":' ||
  CASE WHEN event_id % 5 = 0 THEN 'null' ELSE '"' || 1000 + event_id % 97 || '"' END ||
  ',"msg_id":' || CASE WHEN m = 3 THEN 'null' ELSE '"ID' || event_id % 50 || '"' END ||
  ',"structured_data":' || coalesce(cast(to_json(sd) AS varchar), 'null') ||
  CASE event_id % 10 WHEN 0 THEN ',"event_timestamp_missing":true,"event_timestamp_raw":"-"'
    WHEN 1 THEN ',"event_timestamp_missing":true,"event_timestamp_raw":"bad-time"' ELSE '' END ||
  coalesce(',"structured_data_parse_error":' || cast(to_json(sd_error) AS varchar), '') || '}'"""
_SYSLOG_LEVEL = """['FATAL', 'FATAL', 'FATAL', 'ERROR', 'WARN', 'INFO', 'INFO', 'DEBUG']
  [pri % 8 + 1]"""


@query("p1_p5_syslog_job", with_(_SYSLOG_EXPECTED, f"""
SELECT event_id, {ts3("coalesce(event_time, date_trunc('milliseconds', received))")} AS created_at,
  CASE WHEN event_time IS NULL THEN 1 ELSE 0 END AS event_time_missing, 'file' AS source,
  CASE WHEN event_id % 6 = 0 THEN '' ELSE 'host-' || event_id % 20 END AS source_host,
  CASE WHEN event_id % 7 = 0 THEN 'unknown' ELSE 'svc-' || user_id % 8 END AS source_service,
  {_SYSLOG_LEVEL} AS level, msg AS message, 'syslog' AS format, {_SYSLOG_META} AS metadata
FROM sys WHERE msg <> ''"""))
def syslog_job(spark, folder):
    logs, _ = dispatch.run_text_job(
        inputs.syslog_lines(spark, folder), "syslog", source="file",
        ingested_at=F.col("received"), id_from=["event_id"], keep=["event_id"])
    return as_text(logs, ["event_id", "created_at", "event_time_missing", "source", "source_host",
                          "source_service", "level", "message", "format", "metadata"])


@query("p2_syslog_priority", with_(_SYSLOG_EXPECTED, f"""
SELECT {_SYSLOG_LEVEL} AS level, cast(pri % 8 AS integer) AS severity,
  cast(pri // 8 AS integer) AS facility, count(*) AS n FROM sys GROUP BY ALL"""))
def syslog_priority(spark, folder):
    parsed = syslog.parse_syslog(inputs.syslog_lines(spark, folder)).filter("errors IS NULL")
    meta = F.from_json("metadata", "syslog_severity int, syslog_facility int")
    return parsed.select("level", meta.alias("m")).groupBy(
        "level", F.col("m.syslog_severity").alias("severity"),
        F.col("m.syslog_facility").alias("facility")).agg(F.count("*").alias("n"))


@query("p3_syslog_time", with_(_SYSLOG_EXPECTED, f"""
SELECT event_id, {ts3('event_time')} AS event_time FROM sys"""))
def syslog_time(spark, folder):
    parsed = syslog.parse_syslog(inputs.syslog_lines(spark, folder)).filter("errors IS NULL")
    return parsed.select("event_id", millis_text(F.col("created_at")).alias("event_time"))


@query("p4_structured_data", with_(_SYSLOG_EXPECTED, """
SELECT event_id, sd, msg AS message, sd_error FROM sys"""))
def structured_data(spark, folder):
    parsed = syslog.parse_syslog(inputs.syslog_lines(spark, folder)).filter("errors IS NULL")
    return parsed.select(
        "event_id", F.get_json_object("metadata", "$.structured_data").alias("sd"), "message",
        F.get_json_object("metadata", "$.structured_data_parse_error").alias("sd_error"))


@query("p4_adjacent_only", with_(_SYSLOG_EXPECTED, """
SELECT event_id, CASE m WHEN 3 THEN '[a@1 x="1"]' WHEN 5 THEN '[a b="c"]' ELSE sd END AS sd,
  CASE m WHEN 3 THEN '[b@1 y="q\\"z] ' || k || '"] ' || event_type || ' event'
    WHEN 5 THEN '[open ' || event_type ELSE msg END AS message FROM sys"""))
def adjacent_only(spark, folder):
    parsed = syslog.parse_syslog(
        inputs.syslog_lines(spark, folder), allow_spaced=False).filter("errors IS NULL")
    return parsed.select(
        "event_id", F.get_json_object("metadata", "$.structured_data").alias("sd"), "message")


@query("p1_syslog_rejects", with_(oracle.EVENTS, """
SELECT event_id, CASE WHEN event_id % 37 = 5 THEN 'garbage ' || event_id END AS raw_payload,
  CASE WHEN event_id % 37 = 5 THEN 'line does not match the RFC 5424 syslog header'
    ELSE 'message: shorter than 1 characters' END AS error_message
FROM ev WHERE event_id % 37 = 5 OR event_id % 8 = 4"""))
def syslog_rejects(spark, folder):
    _, bad = dispatch.run_text_job(
        inputs.syslog_lines(spark, folder), "syslog", ingested_at=F.col("received"),
        id_from=["event_id"], keep=["event_id"])
    # Lines refused for an empty message are long; their text is compared by the other queries.
    garbage = F.when(F.startswith("raw_payload", F.lit("garbage")), F.col("raw_payload"))
    return bad.select("event_id", garbage.alias("raw_payload"), "error_message")


@query("p6_syslog_strict", with_(_SYSLOG_EXPECTED, """
SELECT event_id, CASE WHEN pri > 191 THEN 'priority out of range (0..191)'
  WHEN event_id % 31 = 0 THEN 'unsupported version (expected 1)'
  WHEN event_id % 10 = 1 THEN 'invalid timestamp'
  ELSE 'malformed structured data: ' || sd_error END AS error_message FROM sys"""))
def syslog_strict(spark, folder):
    parsed = syslog.parse_syslog(inputs.syslog_lines(spark, folder), strict=True)
    return parsed.filter(
        F.col("errors").isNull() | (F.col("errors") != syslog.NOT_SYSLOG)
    ).select("event_id", F.col("errors").alias("error_message"))


@query("p1_syslog_long_bodies", r"""
WITH b AS (SELECT conv_id, turn, role, trim(regexp_replace(text, '[\n\r]+', ' ', 'g')) AS msg
  FROM conversations)
SELECT conv_id, turn, role AS source_service, msg AS message,
  length(msg) BETWEEN 1 AND 10000 AS valid FROM b""")
def syslog_long_bodies(spark, folder):
    lines = inputs.table(spark, folder, "conversations").select(
        "conv_id", "turn", F.concat(
            F.lit("<14>1 2024-01-15T10:30:00Z chat "), "role", F.lit(" - - - "),
            F.regexp_replace("text", r"[\n\r]+", " ")).alias("value"))
    done = validate.finish(syslog.parse_syslog(lines), ingested_at=inputs.as_of(),
                           id_from=["conv_id", "turn"])
    return done.select("conv_id", "turn", "source_service", "message",
                       F.col("errors").isNull().alias("valid"))


# --- access logs -------------------------------------------------------------------------------

_CLF_META = """'{"remote_addr":"' || g.host || '","ident":' ||
  CASE g.ident WHEN '-' THEN 'null' ELSE '"' || g.ident || '"' END || ',"request_raw":' ||
  CASE g.request WHEN '' THEN 'null' ELSE '"' || g.request || '"' END || ',"http_protocol":' ||
  CASE r.protocol WHEN '' THEN 'null' ELSE '"' || r.protocol || '"' END || ',"body_bytes_sent":' ||
  CASE g.bytes WHEN '-' THEN 'null' ELSE g.bytes END ||
  CASE WHEN event_time IS NULL THEN ',"event_timestamp_missing":true,"event_timestamp_raw":"' ||
    g.tim || '"' ELSE '' END ||
  CASE WHEN g.tail = '' OR t.referer = '-' THEN '' ELSE ',"http_referer":"' || t.referer || '"' END ||
  CASE WHEN g.tail = '' OR t.agent = '-' THEN '' ELSE ',"http_user_agent":"' || t.agent || '"' END ||
  '}'"""


@query("p7_p12_clf_job", with_(oracle.CLF, f"""
SELECT event_id, {ts3("coalesce(event_time, date_trunc('milliseconds', received))")} AS created_at,
  CASE WHEN event_time IS NULL THEN 1 ELSE 0 END AS event_time_missing, 'file' AS source,
  g.host AS source_host, 'access-log' AS source_service,
  CASE status // 100 WHEN 1 THEN 'DEBUG' WHEN 2 THEN 'INFO' WHEN 3 THEN 'INFO' WHEN 4 THEN 'WARN'
    ELSE 'ERROR' END AS level,
  'HTTP ' || status || ' ' || CASE WHEN r.method <> '' THEN r.method || ' ' || r.path
    WHEN g.request IN ('', '-') THEN '<no-request>' ELSE '<unparsed-request>' END AS message,
  'clf' AS format, nullif(g.usr, '-') AS user_id, nullif(r.method, '') AS http_method,
  nullif(r.path, '') AS http_path, status AS http_status, {_CLF_META} AS metadata
FROM clf_fields WHERE fits AND status BETWEEN 100 AND 599"""))
def clf_job(spark, folder):
    logs, _ = dispatch.run_text_job(
        inputs.clf_lines(spark, folder), "clf", source="file", ingested_at=F.col("received"),
        id_from=["event_id"], keep=["event_id"])
    return as_text(logs, ["event_id", "created_at", "event_time_missing", "source", "source_host",
                          "source_service", "level", "message", "format", "user_id",
                          "http_method", "http_path", "http_status", "metadata"])


@query("p7_clf_rejects", with_(oracle.CLF, """
SELECT event_id, line AS raw_payload, CASE WHEN fits THEN 'http_status: must be 100 to 599'
  ELSE 'line is not in common or combined log format' END AS error_message
FROM clf_fields WHERE NOT fits OR status NOT BETWEEN 100 AND 599"""))
def clf_rejects(spark, folder):
    _, bad = dispatch.run_text_job(
        inputs.clf_lines(spark, folder), "clf", ingested_at=F.col("received"),
        id_from=["event_id"], keep=["event_id"])
    return bad


@query("p8_clf_request_paths", r"""
SELECT page_id, 'HTTP 200 GET ' || url AS message, url AS http_path,
  length(url) <= 2000 AS valid FROM pages""")
def clf_request_paths(spark, folder):
    lines = inputs.table(spark, folder, "pages").select(
        "page_id", F.concat(
            F.lit('1.2.3.4 - - [15/Jan/2024:10:30:00 +0000] "GET '), "url",
            F.lit(' HTTP/1.1" 200 1')).alias("value"))
    done = validate.finish(dispatch.parse_lines(lines, "clf"), ingested_at=inputs.as_of(),
                           id_from=["page_id"])
    return done.select("page_id", "message", "http_path", F.col("errors").isNull().alias("valid"))


@query("p9_status_levels", with_(oracle.CLF, """
SELECT status AS http_status, CASE status // 100 WHEN 1 THEN 'DEBUG' WHEN 2 THEN 'INFO'
  WHEN 3 THEN 'INFO' WHEN 4 THEN 'WARN' WHEN 5 THEN 'ERROR' ELSE 'INFO' END AS level,
  count(*) AS n FROM clf_fields WHERE fits GROUP BY ALL"""))
def status_levels(spark, folder):
    parsed = dispatch.parse_lines(inputs.clf_lines(spark, folder), "clf").filter("errors IS NULL")
    return parsed.groupBy("http_status", "level").agg(F.count("*").alias("n"))


@query("p10_clf_time", with_(oracle.CLF, f"""
SELECT event_id, {ts3('event_time')} AS event_time FROM clf_fields WHERE fits"""))
def clf_time(spark, folder):
    parsed = dispatch.parse_lines(inputs.clf_lines(spark, folder), "clf").filter("errors IS NULL")
    return parsed.select("event_id", millis_text(F.col("created_at")).alias("event_time"))


# --- dispatch ----------------------------------------------------------------------------------

@query("p13_mixed_formats", with_(oracle.CLF, """
SELECT 'clf' AS format, count(*) FILTER (WHERE fits AND status BETWEEN 100 AND 599) AS accepted,
  count(*) FILTER (WHERE NOT fits OR status NOT BETWEEN 100 AND 599) AS rejected
FROM clf_fields WHERE event_id % 4 = 0
UNION ALL SELECT 'syslog', count(*) FILTER (WHERE event_id % 37 <> 5 AND event_id % 8 <> 4),
  count(*) FILTER (WHERE event_id % 37 = 5 OR event_id % 8 = 4) FROM events WHERE event_id % 4 = 1
UNION ALL SELECT 'json', 0, count(*) FROM events WHERE event_id % 4 = 2
UNION ALL SELECT 'xml', 0, count(*) FROM events WHERE event_id % 4 = 3"""))
def mixed_formats(spark, folder):
    df = inputs.events(spark, folder).select(
        "event_id",
        F.expr("element_at(array(' CLF ', 'syslog', 'json', 'xml'), cast(event_id % 4 + 1 AS int))")
        .alias("format"),
        F.expr(f"CASE event_id % 4 WHEN 1 THEN {inputs.SYSLOG_SQL} ELSE {inputs.CLF_SQL} END")
        .alias("value"))
    done = validate.finish(dispatch.parse_mixed(df), ingested_at=inputs.as_of(),
                           id_from=["event_id"])
    return done.groupBy(F.lower(F.trim("declared_format")).alias("format")).agg(
        F.count_if(F.col("errors").isNull()).alias("accepted"),
        F.count_if(F.col("errors").isNotNull()).alias("rejected"))


@query("p14_failure_texts", with_(oracle.CLF, """
SELECT CASE WHEN fits THEN 'http_status: must be 100 to 599'
  ELSE 'line is not in common or combined log format' END AS error_message, count(*) AS n
FROM clf_fields WHERE NOT fits OR status NOT BETWEEN 100 AND 599 GROUP BY ALL"""))
def failure_texts(spark, folder):
    return clf_rejects(spark, folder).groupBy("error_message").agg(F.count("*").alias("n"))


@query("p15_topic_messages", with_(oracle.MESSAGES, f"""
SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' ||
    substr(h, 17, 4) || '-' || substr(h, 21) AS id,
  {ts3("date_trunc('milliseconds', ts)")} AS created_at,
  {ts3("date_trunc('milliseconds', ts)")} AS ingested_at,
  CASE WHEN m = 9 THEN 1 ELSE 0 END AS event_time_missing,
  'http' AS source, '' AS source_host, 'svc-' || user_id % 8 AS source_service,
  CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  event_type || ' ' || event_id AS message,
  CASE m WHEN 13 THEN '{{}}' WHEN 14 THEN '{{"k":' || k || '}}'
    ELSE '{{"http_status":404,"k":' || k || '}}' END AS metadata,
  CASE WHEN m IN (15, 16) THEN 200 WHEN m IN (13, 14) THEN NULL ELSE 404 END AS http_status,
  cast(CASE m WHEN 1 THEN 0 END AS bigint) AS http_response_time_ms,
  CASE WHEN event_type = 'error' AND event_id % 3 > 0 THEN 'TimeoutError' END AS error_type
FROM (SELECT *, md5(cast(event_id AS varchar)) AS h FROM msg WHERE error IS NULL)"""))
def topic_messages(spark, folder):
    logs, _ = dispatch.run_message_job(
        inputs.topic_messages(spark, folder), ingested_at=F.col("timestamp"),
        id_from=["partition", "offset"], keep=["event_id"])
    return as_text(logs, ["event_id", "id", "created_at", "ingested_at", "event_time_missing",
                          "source", "source_host", "source_service", "level", "message",
                          "metadata", "http_status", "http_response_time_ms", "error_type"])


# --- validation --------------------------------------------------------------------------------

@query("v1_field_rules", """
SELECT doc_id, CASE WHEN length(text) > 10000 THEN 'message: longer than 10000 characters'
  WHEN text = '' THEN 'message: shorter than 1 characters' END AS error FROM documents""")
def field_rules(spark, folder):
    df = inputs.table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("message"), F.col("source").alias("source_service"),
        F.lit("file").alias("source"), F.lit("INFO").alias("level"))
    done = validate.finish(df, ingested_at=inputs.as_of(), id_from=["doc_id"])
    return done.select("doc_id", F.col("errors").alias("error"))


_V1_TEXTS = {name: (high, low) for name, (_, low, high) in TEXT_RULES.items()}


@query("v1_every_rule", "\nUNION ALL\n".join(f"""
SELECT '{name}' AS field, count(*) FILTER (WHERE length(text) > {high}) AS too_long,
  count(*) FILTER (WHERE length(text) < {low}) AS too_short FROM documents"""
    for name, (high, low) in _V1_TEXTS.items()))
def every_rule(spark, folder):
    # The same text in every column: each rule counts the documents beyond its own limits.
    df = inputs.table(spark, folder, "documents").select(
        "doc_id", *[F.col("text").alias(n) for n in TEXT_RULES])
    rules = validate.length_errors(TEXT_RULES)
    counts = df.select(*[r.alias(n) for r, n in zip(rules, TEXT_RULES)]).agg(*[
        F.struct(F.lit(n).alias("field"),
                 F.count_if(F.contains(n, F.lit("longer"))).alias("too_long"),
                 F.count_if(F.contains(n, F.lit("shorter"))).alias("too_short")).alias(n)
        for n in TEXT_RULES])
    return counts.select(F.explode(F.array(*TEXT_RULES)).alias("r")).select("r.*")


@query("v2_level_normalise", with_(oracle.LOGS, """
SELECT r.raw_level, l.level, count(*) AS n FROM rec r LEFT JOIN logs l USING (event_id)
GROUP BY ALL"""))
def level_normalise(spark, folder):
    return inputs.records(spark, folder).select(
        F.col("level").alias("raw_level"), normalise_level(F.col("level")).alias("level")
    ).groupBy("raw_level", "level").agg(F.count("*").alias("n"))


_TIME_FORMS = r"""CASE event_id % 12
  WHEN 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
  WHEN 1 THEN date_format(ts, "yyyy-MM-dd HH:mm:ss")
  WHEN 2 THEN date_format(ts, "yyyyMMdd'T'HHmmss")
  WHEN 3 THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), '+05:30')
  WHEN 4 THEN concat(date_format(ts, "yyyy-MM-dd'x'HH:mm"), '-0300')
  WHEN 5 THEN date_format(ts, "yyyy-M-d'T'H:m:s'Z'")
  WHEN 6 THEN date_format(ts, "yyyy-MM-dd")
  WHEN 7 THEN date_format(ts, "HH:mm:ss")
  WHEN 8 THEN date_format(ts, "yyyy")
  WHEN 9 THEN concat(' ', date_format(ts, "yyyy-MM-dd'T'HH"), ' ')
  WHEN 10 THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), ' Europe/Paris')
  ELSE concat(date_format(ts, "yyyy-M-d'T'H:m:s.SSS"), 'Z') END"""


@query("v3_event_time", f"""
SELECT event_id, {ts3('''CASE event_id % 12 WHEN 0 THEN date_trunc('milliseconds', ts)
  WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('second', ts)
  WHEN 3 THEN date_trunc('milliseconds', ts) - to_minutes(330)
  WHEN 4 THEN date_trunc('minute', ts) + to_hours(3) WHEN 5 THEN date_trunc('second', ts)
  WHEN 6 THEN cast(date_trunc('day', ts) AS timestamp) WHEN 9 THEN date_trunc('hour', ts)
  WHEN 11 THEN date_trunc('milliseconds', ts) END''')} AS event_time FROM events""")
def event_time(spark, folder):
    return inputs.events(spark, folder).select(
        "event_id",
        millis_text(times.event_time_text(F.expr(_TIME_FORMS))).alias("event_time"))


@query("v4_event_time_fallback", with_(oracle.LOGS, f"""
SELECT event_id, {ts3('created_at')} AS created_at, event_time_missing FROM logs"""))
def event_time_fallback(spark, folder):
    return as_text(inputs.logs(spark, folder, ["event_id"]),
                   ["event_id", "created_at", "event_time_missing"])


@query("v5_metadata", """
SELECT event_id, CASE event_id % 5 WHEN 1 THEN '{}' WHEN 3 THEN NULL WHEN 4 THEN NULL
  ELSE replace(props, ' ', '') END AS metadata,
  CASE WHEN event_id % 5 IN (3, 4) THEN 'metadata: must be a JSON object' END AS error
FROM events""")
def metadata(spark, folder):
    df = inputs.events(spark, folder).select("event_id", F.expr("""CASE event_id % 5
        WHEN 3 THEN concat('[', props, ']') WHEN 4 THEN concat('{', props)
        WHEN 1 THEN NULL ELSE props END""").alias("text"))
    df = df.withColumn("v", validate.metadata_variant(F.col("text")))
    return df.select("event_id", F.to_json("v").alias("metadata"),
                     validate.metadata_error(F.col("text"), F.col("v")).alias("error"))


@query("v6_metadata_promotion", with_(oracle.LOGS, """
SELECT event_id, trace_id, user_id, http_status, http_response_time_ms FROM logs"""))
def metadata_promotion(spark, folder):
    return inputs.logs(spark, folder, ["event_id"]).select(
        "event_id", "trace_id", "user_id", "http_status", "http_response_time_ms")


@query("v7_ranges", """
SELECT event_id, nullif(concat_ws('; ',
  CASE WHEN event_id % 700 NOT BETWEEN 100 AND 599 THEN 'http_status: must be 100 to 599' END,
  CASE WHEN event_id % 5 - 2 < 0 THEN 'http_response_time_ms: must be at least 0' END), '') AS error
FROM events""")
def ranges(spark, folder):
    df = inputs.events(spark, folder).select(
        "event_id", F.expr("cast(event_id % 700 AS int)").alias("http_status"),
        F.expr("event_id % 5 - 2").alias("http_response_time_ms"))
    return df.select("event_id", validate.collect_errors(*validate.range_errors()).alias("error"))


@query("v8_json_types", r"""
SELECT event_id, event_id % 9 AS form, CASE event_id % 9 WHEN 0 THEN event_id WHEN 1 THEN event_id
  WHEN 2 THEN event_id WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN 1 WHEN 6 THEN NULL
  WHEN 7 THEN NULL ELSE event_id END AS whole_number,
  CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN cast(event_id AS varchar) WHEN 4 THEN 'abc'
  WHEN 8 THEN event_id || '.00' END AS text
FROM events""")
def json_types(spark, folder):
    df = inputs.events(spark, folder).select("event_id", F.expr("""concat('{"f": ',
        CASE event_id % 9 WHEN 0 THEN cast(event_id AS string) WHEN 1 THEN concat('"', event_id, '"')
        WHEN 2 THEN concat(event_id, '.0') WHEN 3 THEN concat(event_id, '.5') WHEN 4 THEN '"abc"'
        WHEN 5 THEN 'true' WHEN 6 THEN 'null' WHEN 7 THEN '[1]'
        ELSE concat('"', event_id, '.00"') END, '}')""").alias("value"))
    df, m, _ = jsonx.with_members(df, jsonx.parse(F.col("value")), ["f"])
    return df.select(
        "event_id", F.expr("event_id % 9").alias("form"),
        m["f"].whole_number().alias("whole_number"), m["f"].text().alias("text"))


@query("v9_request_projection", with_(oracle.REQUESTS, """
SELECT event_id, 'json' AS format, 1 AS is_parsed, '' AS source_host, '' AS parsed_message,
  cast(NULL AS varchar) AS error_type, cast(NULL AS varchar) AS http_path,
  CASE WHEN m <> 15 THEN k END AS k FROM req WHERE error IS NULL"""))
def request_projection(spark, folder):
    logs, _ = dispatch.run_request_job(
        inputs.request_lines(spark, folder), ingested_at=F.col("received"), id_from=["event_id"],
        keep=["event_id"], default_source="file", default_source_service="unknown")
    return logs.select("event_id", "format", "is_parsed", "source_host", "parsed_message",
                       "error_type", "http_path",
                       F.get_json_object("metadata", "$.k").alias("k"))


_STORED = ", ".join(
    f"{ts3(c)} AS {c}" if c in ("created_at", "ingested_at") else
    f"cast(NULL AS varchar) AS {c}"
    if c in ("request_id", "span_id", "http_method", "http_path", "error_stack") else c
    for c in LOG_COLUMNS)


@query("v10_storage_projection", with_(oracle.LOGS, f"SELECT {_STORED} FROM logs"))
def storage_projection(spark, folder):
    return as_text(inputs.logs(spark, folder), LOG_COLUMNS)
