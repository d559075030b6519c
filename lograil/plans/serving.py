"""Queries of sinks, search, rollups, signals and metrics."""

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lograil.operators import dispatch, ingest, metrics, rollups, search, signals, validate
from lograil.operators.search import Search
from lograil.plans import inputs, oracle
from lograil.plans.inputs import as_of, millis_text, seconds_text
from lograil.plans.oracle import ts0, ts3, with_
from lograil.plans.parsing import as_text
from lograil.plans.registry import query
from lograil.session import scratch_dir
from lograil.sinks import tables as sink_tables, topics
from lograil.sources import raw, tables as source_tables

NOW = dt.datetime.fromisoformat(inputs.AS_OF)


def log(sql):
    return with_(oracle.LOGS, sql)


# --- sources and sinks -------------------------------------------------------------------------

def stored_logs(spark, folder):
    """The log table written to and read back from day partitions."""
    path = scratch_dir(spark, "logs")
    sink_tables.append_logs(inputs.logs(spark, folder), path)
    return source_tables.read_log_table(spark, path)


_DAYS = """SELECT strftime(created_at, '%Y-%m-%d') AS day, level, count(*) AS n,
  count(DISTINCT id) AS ids FROM logs GROUP BY ALL"""


@query("k1_s6_log_table", log(_DAYS))
def log_table(spark, folder):
    return stored_logs(spark, folder).groupBy(
        F.col("event_date").cast("string").alias("day"), "level").agg(
        F.count("*").alias("n"), F.countDistinct("id").alias("ids"))


@query("s2_raw_text_scan", with_(oracle.CLF, """
SELECT line AS value, fits AND status BETWEEN 100 AND 599 AS valid, count(*) AS n
FROM clf_fields GROUP BY ALL"""))
def raw_text_scan(spark, folder):
    path = scratch_dir(spark, "raw")
    inputs.clf_lines(spark, folder).select("value").write.text(path)
    lines = raw.numbered(raw.read_raw_lines(spark, path))
    done = validate.finish(dispatch.parse_lines(lines, "clf", source="file"),
                           ingested_at=as_of(), id_from=raw.LINE_KEY)
    return done.groupBy("value", F.col("errors").isNull().alias("valid")).agg(
        F.count("*").alias("n"))


@query("k2_keyed_messages", log("""
SELECT source_service AS key, count(*) AS n, count(DISTINCT id) AS ids FROM logs GROUP BY ALL"""))
def keyed_messages(spark, folder):
    rows = topics.log_messages(inputs.logs(spark, folder))
    return rows.groupBy("key").agg(
        F.count("*").alias("n"),
        F.countDistinct(F.get_json_object("value", "$.id")).alias("ids"))


@query("k7_retention", log(f"""
SELECT strftime(created_at, '%Y-%m-%d') AS day, count(*) AS n FROM logs
WHERE created_at > TIMESTAMP '{inputs.AS_OF}' - INTERVAL 7 DAY GROUP BY ALL"""))
def retention(spark, folder):
    kept = sink_tables.retained(inputs.logs(spark, folder), NOW, days=7)
    return kept.groupBy(F.to_date("created_at").cast("string").alias("day")).agg(
        F.count("*").alias("n"))


# --- ingest reports and dead-letter envelopes --------------------------------------------------

def clf_done(spark, folder):
    return validate.finish(
        dispatch.parse_lines(inputs.clf_lines(spark, folder), "clf", source="file"),
        ingested_at=F.col("received"), id_from=["event_id"])


_CLF_BAD = """, bad AS (SELECT 'access-' || event_id % 7 || '.log' AS file, event_id // 7 + 1 AS line,
    fits AND status BETWEEN 100 AND 599 AS good, CASE WHEN fits THEN 'http_status: must be 100 to 599'
    ELSE 'line is not in common or combined log format' END AS error FROM clf_fields)"""


@query("v11_ingest_report", with_(oracle.CLF, _CLF_BAD + """
, firsts AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY line) AS r FROM bad
  WHERE NOT good)
SELECT file, count(*) AS count, count(*) FILTER (WHERE good) AS success,
  count(*) FILTER (WHERE NOT good) AS failed,
  (SELECT string_agg(f.line || ':' || f.error, '|' ORDER BY f.line) FROM firsts f
    WHERE f.file = bad.file AND f.r <= 20) AS errors
FROM bad GROUP BY file"""))
def ingest_report(spark, folder):
    report = ingest.ingest_report(clf_done(spark, folder))
    return report.withColumn("errors", F.array_join(
        F.transform("errors", lambda e: F.concat_ws(":", e.line.cast("string"), e.error)), "|"))


@query("v12_reject_routing", with_(oracle.CLF, """
SELECT 'raw_file' AS channel, count(*) AS dead_letters FROM clf_fields
WHERE NOT fits OR status NOT BETWEEN 100 AND 599
UNION ALL SELECT 'kafka', count(*) FROM events
WHERE event_id % 20 IN (3, 4, 5, 6, 7, 10, 11, 12, 17, 18, 0, 19)"""))
def reject_routing(spark, folder):
    _, clf_bad = dispatch.run_text_job(
        inputs.clf_lines(spark, folder), "clf", ingested_at=F.col("received"),
        id_from=["event_id"])
    _, jsonl_bad = dispatch.run_request_job(
        inputs.request_lines(spark, folder), ingested_at=F.col("received"), id_from=["event_id"])
    _, topic_bad = dispatch.run_message_job(
        inputs.topic_messages(spark, folder), ingested_at=F.col("timestamp"),
        id_from=["partition", "offset"])
    rejects = ingest.union_envelopes(
        ingest.with_channel(clf_bad, "raw_file"), ingest.with_channel(jsonl_bad, "jsonl"),
        ingest.with_channel(topic_bad, "kafka"))
    return ingest.dlq_bound(rejects).groupBy("channel").agg(F.count("*").alias("dead_letters"))


def envelope_fields(df, names):
    return df.select("event_id", *[
        F.get_json_object("value", f"$.{n}").alias(n) for n in names])


@query("k3_parser_rejects", with_(oracle.CLF, """
SELECT event_id, '2024-01-31T00:00:00' AS created_at, line AS raw_payload,
  CASE WHEN fits THEN 'http_status: must be 100 to 599'
  ELSE 'line is not in common or combined log format' END AS error_message,
  'parse_error' AS error_type, 'file' AS source
FROM clf_fields WHERE NOT fits OR status NOT BETWEEN 100 AND 599"""))
def parser_rejects(spark, folder):
    bad = validate.rejected(clf_done(spark, folder), keep=["event_id", "source"])
    letters = ingest.parser_reject_envelopes(bad, as_of(), ["event_id"], keep=["event_id"])
    return envelope_fields(letters, ["created_at", "raw_payload", "error_message", "error_type",
                                     "source"])


@query("k4_unparseable_messages", with_(oracle.MESSAGES, """
SELECT event_id, '2024-01-31T00:00:00' AS dlq_timestamp,
  'Failed to parse message: ' || error AS error_message, 'message_parse_error' AS error_type,
  left(CASE m WHEN 4 THEN '[' ELSE '' END || '{"id": "' || CASE m WHEN 7 THEN 'no-uuid' ELSE md5(event_id::varchar) END ||
    '", "created_at": "' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '", ',
    CASE m WHEN 3 THEN least(60, 15 + event_id % 60) ELSE 60 END) AS payload_start
FROM msg WHERE error IS NOT NULL"""))
def unparseable_messages(spark, folder):
    _, bad = dispatch.run_message_job(
        inputs.topic_messages(spark, folder), ingested_at=F.col("timestamp"),
        id_from=["partition", "offset"], keep=["event_id"])
    letters = ingest.message_reject_envelopes(bad, as_of(), ["event_id"], keep=["event_id"])
    out = envelope_fields(letters, ["dlq_timestamp", "error_message", "error_type",
                                    "raw_payload"])
    return out.withColumn("payload_start", F.left("raw_payload", F.lit(60))).drop("raw_payload")


@query("k5_failed_batch", log("""
SELECT id, 'clickhouse_insert_failure' AS error_type, 'store is down' AS error_message,
  message, level, source_service FROM logs"""))
def failed_batch(spark, folder):
    letters = ingest.failed_batch_envelopes(
        inputs.logs(spark, folder), as_of(), "store is down")
    field = lambda path: F.get_json_object("value", path)
    return letters.select(
        field("$.original_log.id").alias("id"), field("$.error_type").alias("error_type"),
        field("$.error_message").alias("error_message"),
        field("$.original_log.message").alias("message"),
        field("$.original_log.level").alias("level"),
        field("$.original_log.source_service").alias("source_service"))


# --- search ------------------------------------------------------------------------------------

_T0, _T1 = dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 12, 18)
_RANGE = "created_at BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'"
_PAGE_COLUMNS = ["id", "created_at", "level", "source", "source_service", "message", "user_id"]
_PAGE_SQL = f"id, {ts3('created_at')} AS created_at, level, source, source_service, message, user_id"


def page_rows(df):
    return as_text(df, _PAGE_COLUMNS)


@query("q1_time_range", log(f"SELECT id, {ts3('created_at')} AS created_at FROM logs WHERE {_RANGE}"))
def search_range(spark, folder):
    found = search.matching(inputs.logs(spark, folder), Search(time_from=_T0, time_to=_T1))
    return as_text(found, ["id", "created_at"])


@query("q2_default_range", log(f"""
SELECT id, {ts3('created_at')} AS created_at FROM logs WHERE created_at
BETWEEN TIMESTAMP '{inputs.AS_OF}' - INTERVAL 24 HOUR AND TIMESTAMP '{inputs.AS_OF}'"""))
def search_default(spark, folder):
    found = search.matching(inputs.logs(spark, folder), Search().checked(NOW))
    return as_text(found, ["id", "created_at"])


@query("q3_equality", log("""
SELECT id FROM logs WHERE source = 'http' AND source_service = 'svc-3' AND level = 'INFO'"""))
def search_equality(spark, folder):
    wanted = Search(source="http", source_service="svc-3", level="INFO", trace_id="", user_id="")
    return search.matching(inputs.logs(spark, folder), wanted).select("id")


@query("q3_trace_and_user", log("""
SELECT id, trace_id, user_id FROM logs WHERE trace_id = 'declared-13'
UNION ALL SELECT id, trace_id, user_id FROM logs WHERE user_id = '7'"""))
def search_trace_and_user(spark, folder):
    logs = inputs.logs(spark, folder)
    by_trace = search.matching(logs, Search(trace_id="declared-13"))
    by_user = search.matching(logs, Search(user_id="7"))
    return by_trace.unionByName(by_user).select("id", "trace_id", "user_id")


@query("q4_missing_time_flag", log("""
SELECT event_time_missing, count(*) AS n FROM logs GROUP BY ALL"""))
def search_flag(spark, folder):
    logs = inputs.logs(spark, folder)
    found = [search.matching(logs, Search(event_time_missing=flag)) for flag in (True, False)]
    return found[0].unionByName(found[1]).groupBy("event_time_missing").agg(
        F.count("*").alias("n"))


@query("q5_text", log("""
SELECT 'BY USER 3' AS query, id FROM logs WHERE message ILIKE '%BY USER 3%'
UNION ALL SELECT 'e__or by', id FROM logs WHERE message ILIKE '%e__or by%'
UNION ALL SELECT 'v%7', id FROM logs WHERE message ILIKE '%v%7%'"""))
def search_text(spark, folder):
    logs = inputs.logs(spark, folder)
    parts = [
        search.matching(logs, Search(query=q)).select(F.lit(q).alias("query"), "id")
        for q in ("BY USER 3", "e__or by", "v%7")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("q5_backslash", log(r"""
SELECT 'by\user' AS query, id FROM logs WHERE contains(lower(replace(message, ' ', '\')), 'by\user')
UNION ALL SELECT '7\', id FROM logs WHERE contains(replace(message, ' ', '\') || '\', '7\')"""))
def search_backslash(spark, folder):
    """Paths are everyday search text: a backslash stands for itself."""
    logs = inputs.logs(spark, folder).withColumn(
        "message", F.concat(F.replace("message", F.lit(" "), F.lit("\\")), F.lit("\\")))
    parts = [search.matching(logs, Search(query=q)).select(F.lit(q).alias("query"), "id")
             for q in ("by\\user", "7\\")]
    return parts[0].unionByName(parts[1])


_ALL = f"{_RANGE} AND source = 'kafka' AND level = 'INFO' AND message ILIKE '%user%'"
_ALL_SEARCH = dict(time_from=_T0, time_to=_T1, source="kafka", level="info", query="USER")


@query("q6_q7_total", log(f"""SELECT 'filtered' AS scope, count(*) AS total FROM logs WHERE {_ALL}
UNION ALL SELECT 'all', count(*) FROM logs"""))
def search_total(spark, folder):
    logs = inputs.logs(spark, folder)
    filtered = search.total(logs, Search(**_ALL_SEARCH, offset=5).checked(NOW))
    everything = search.total(logs, Search())
    return filtered.select(F.lit("filtered").alias("scope"), "total").unionByName(
        everything.select(F.lit("all").alias("scope"), "total"))


_FIELDS_SQL = """SELECT id, try_cast(metadata->>'$.http_status' AS varchar) AS http, cast(metadata->>'$.response_time_ms' AS double) AS ms
FROM logs WHERE metadata->>'$.http_status' = '404' OR cast(metadata->>'$.response_time_ms' AS double) > 1900"""


@query("q2_metadata_fields", log(_FIELDS_SQL))
def metadata_fields(spark, folder):
    """Search by members of the metadata in a table that keeps them as typed columns."""
    path = scratch_dir(spark, "fields")
    sink_tables.append_logs(inputs.logs(spark, folder), path, fields=True)
    logs = source_tables.read_log_table(spark, path, fields=True)
    http, ms = search.field(logs, "http_status"), search.field(logs, "response_time_ms", "double")
    return logs.filter((http == "404") | (ms > 1900)).select("id", http.alias("http"), ms.alias("ms"))


_ROLLED = [dict(), dict(level="ERROR"), dict(source="http", time_from=dt.datetime(2024, 1, 10, 7, 20)),
           dict(time_from=dt.datetime(2024, 1, 3, 5), time_to=dt.datetime(2024, 1, 20, 18, 0, 0)),
           dict(time_from=dt.datetime(2024, 1, 9, 5, 1), time_to=dt.datetime(2024, 1, 9, 5, 58), level="INFO"),
           dict(time_to=dt.datetime(2024, 1, 15, 12, 30), query="user 3")]
_ROLLED_SQL = ["true", "level = 'ERROR'", "source = 'http' AND created_at >= TIMESTAMP '2024-01-10 07:20:00'",
               "created_at BETWEEN TIMESTAMP '2024-01-03 05:00:00' AND TIMESTAMP '2024-01-20 18:00:00'",
               "created_at BETWEEN TIMESTAMP '2024-01-09 05:01:00' AND TIMESTAMP '2024-01-09 05:58:00' AND level = 'INFO'",
               "created_at <= TIMESTAMP '2024-01-15 12:30:00' AND message ILIKE '%user 3%'"]


@query("q7_rolled_totals", log("\nUNION ALL\n".join(
    f"SELECT {i} AS search, count(*) AS total FROM logs WHERE {sql}" for i, sql in enumerate(_ROLLED_SQL))))
def rolled_totals(spark, folder):
    """Totals from the hourly rollup; only cut hours, and filters that it does not know, read records."""
    logs = inputs.logs(spark, folder)
    volume = rollups.hourly_volume(logs)
    return reduce(DataFrame.unionByName, [
        search.rolled_total(volume, logs, Search(**wanted)).select(F.lit(i).alias("search"), "total")
        for i, wanted in enumerate(_ROLLED)])


@query("q8_rolled_page", log(f"""SELECT {_PAGE_SQL} FROM logs l WHERE l.level = 'INFO'
ORDER BY l.created_at DESC, id LIMIT 20 OFFSET 300"""))
def rolled_page(spark, folder):
    logs = inputs.logs(spark, folder)
    wanted = Search(level="INFO", offset=300, limit=20)
    return page_rows(search.deep_page(logs, wanted, max_skip=5, volume=rollups.hourly_volume(logs)))


@query("q8_page", log(f"""SELECT {_PAGE_SQL} FROM logs l WHERE {_ALL}
ORDER BY l.created_at DESC, id LIMIT 20 OFFSET 5"""))
def search_page(spark, folder):
    wanted = Search(**_ALL_SEARCH, offset=5, limit=20).checked(NOW)
    return page_rows(search.page(inputs.logs(spark, folder), wanted))


@query("q8_stored_page", log(f"""SELECT {_PAGE_SQL} FROM logs l WHERE {_ALL}
ORDER BY l.created_at DESC, id LIMIT 20 OFFSET 5"""))
def search_stored_page(spark, folder):
    wanted = Search(**_ALL_SEARCH, offset=5, limit=20).checked(NOW)
    return page_rows(search.page(stored_logs(spark, folder), wanted))


@query("q8_page_after", log(f"""SELECT {_PAGE_SQL} FROM logs l
WHERE l.created_at < (SELECT created_at FROM logs ORDER BY created_at DESC, id LIMIT 1 OFFSET 49)
ORDER BY l.created_at DESC, id LIMIT 25"""))
def search_page_after(spark, folder):
    logs = inputs.logs(spark, folder)
    last = search.page(logs, Search(offset=49, limit=1)).select(
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("at"), "id").first()
    at = dt.datetime.fromisoformat(last["at"])
    return page_rows(search.page_after(logs, Search(limit=25), at, last["id"]))


@query("q8_deep_page", log(f"""SELECT {_PAGE_SQL} FROM logs l
ORDER BY l.created_at DESC, id LIMIT 100 OFFSET 5000"""))
def search_deep_page(spark, folder):
    wanted = Search(offset=5000, limit=100)
    return page_rows(search.deep_page(inputs.logs(spark, folder), wanted, max_skip=50))


_ISO = """CASE WHEN strftime({c}, '%g') = '000' THEN strftime({c}, '%Y-%m-%dT%H:%M:%S')
  ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%g') || '000' END"""


@query("q10_iso_times", log(f"""SELECT id, {_ISO.format(c='l.created_at')} AS created_at,
  {_ISO.format(c='l.ingested_at')} AS ingested_at FROM logs l
ORDER BY l.created_at DESC, id LIMIT 1000"""))
def search_iso_times(spark, folder):
    rows = search.page(inputs.logs(spark, folder), Search(limit=1000))
    return search.rendered(rows).select("id", "created_at", "ingested_at")


@query("q11_adhoc", log("""
SELECT source, count(*) AS n FROM logs WHERE level = 'ERROR' AND http_status >= 300 GROUP BY ALL"""))
def search_adhoc(spark, folder):
    return search.adhoc(
        spark, inputs.logs(spark, folder),
        "SELECT source, count(*) AS n FROM logs WHERE level = :level AND http_status >= :low "
        "GROUP BY source", {"level": "ERROR", "low": 300})


# --- rollups -----------------------------------------------------------------------------------

_ERRORS = """, err AS (SELECT *, cast(created_at AS date) AS day,
    coalesce(error_type, 'Unknown') AS etype FROM logs WHERE level IN ('ERROR', 'FATAL'))"""


@query("a1_a6_error_type_summary", log(_ERRORS + """
, counted AS (SELECT day, etype, level, message, count(*) AS n FROM err GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY day, etype, level ORDER BY n DESC, message)
  AS r FROM counted)
SELECT cast(day AS varchar) AS date, etype AS error_type, level,
  cast(sum(n) AS bigint) AS error_count,
  string_agg(message, '|' ORDER BY r) FILTER (WHERE r <= 3) AS sample_messages
FROM ranked GROUP BY ALL"""))
def error_type_summary(spark, folder):
    return rollups.error_type_summary(inputs.logs(spark, folder)).select(
        F.col("date").cast("string").alias("date"), "error_type", "level", "error_count",
        F.array_join("sample_messages", "|").alias("sample_messages"))


@query("a6_approximate_messages", log(_ERRORS + """
SELECT cast(day AS varchar) AS date, etype AS error_type, level, count(*) AS error_count,
  least(count(DISTINCT message), 3) AS messages FROM err GROUP BY ALL"""))
def approximate_messages(spark, folder):
    logs = inputs.logs(spark, folder, ["event_id"])
    halves = [rollups.error_type_partials(logs.filter(F.col("event_id") % 2 == h)) for h in (0, 1)]
    merged = rollups.merge_error_type_partials(halves[0].unionByName(halves[1]))
    return merged.select(
        F.col("date").cast("string").alias("date"), "error_type", "level", "error_count",
        F.size("sample_messages").cast("bigint").alias("messages"))


@query("a6_sketch_winners", log(_ERRORS + """,
kinds AS (SELECT day, etype, level, CASE WHEN event_id % 7 < 4 THEN 'often' WHEN event_id % 7 < 6 THEN 'at times'
  ELSE 'seldom' END AS kind, count(*) AS n FROM err GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER w AS r, lead(n) OVER w AS next FROM kinds
  WINDOW w AS (PARTITION BY day, etype, level ORDER BY n DESC))
SELECT cast(day AS varchar) AS date, etype AS error_type, level, kind AS message, n FROM ranked
WHERE r = 1 AND n > coalesce(next, 0)"""))
def sketch_winners(spark, folder):
    """The top message of merged states, where one message leads."""
    kind = F.expr("CASE WHEN event_id % 7 < 4 THEN 'often' WHEN event_id % 7 < 6 THEN 'at times' ELSE 'seldom' END")
    logs = inputs.logs(spark, folder, ["event_id"]).withColumn("message", kind)
    parts = [rollups.error_type_partials(logs.filter(F.col("event_id") % 3 == h)) for h in (0, 1, 2)]
    first = rollups.merge_error_type_states(parts[0].unionByName(parts[1]))
    merged = rollups.merge_error_type_states(first.unionByName(parts[2]))
    best = F.expr("approx_top_k_estimate(message_state, 2)")
    return merged.select("date", "error_type", "level", best.alias("best")).filter(
        (F.size("best") == 1) | (F.col("best")[0]["count"] > F.try_element_at("best", F.lit(2))["count"])).select(
        F.col("date").cast("string").alias("date"), "error_type", "level",
        F.col("best")[0]["item"].alias("message"), F.col("best")[0]["count"].alias("n"))


_MATRIX = f"""SELECT cast(day AS varchar) AS date, source_service, etype AS error_type, level,
  count(*) AS error_count, {ts3('max(created_at)')} AS last_error_time FROM err GROUP BY ALL"""


def matrix_text(df):
    return df.select(F.col("date").cast("string").alias("date"), "source_service", "error_type",
                     "level", "error_count",
                     millis_text(F.col("last_error_time")).alias("last_error_time"))


@query("a2_service_error_matrix", log(_ERRORS + _MATRIX))
def service_error_matrix(spark, folder):
    return matrix_text(rollups.service_error_matrix(inputs.logs(spark, folder)))


_HEALTH = f"""SELECT {ts0("date_trunc('hour', l.created_at)")} AS hour, source_service,
  count(*) AS log_count, {ts3('max(l.created_at)')} AS last_log_time,
  {ts3('min(l.created_at)')} AS min_log_time FROM logs l
  GROUP BY date_trunc('hour', l.created_at), source_service"""


def health_text(df):
    return df.select(seconds_text(F.col("hour")).alias("hour"), "source_service", "log_count",
                     millis_text(F.col("last_log_time")).alias("last_log_time"),
                     millis_text(F.col("min_log_time")).alias("min_log_time"))


@query("a3_service_health", log(_HEALTH))
def service_health(spark, folder):
    return health_text(rollups.service_health(inputs.logs(spark, folder)))


@query("a4_hourly_volume", log(f"""SELECT {ts0("date_trunc('hour', l.created_at)")} AS hour, source,
  level, count(*) AS log_count FROM logs l GROUP BY date_trunc('hour', l.created_at), source, level"""))
def hourly_volume(spark, folder):
    return rollups.hourly_volume(inputs.logs(spark, folder)).withColumn(
        "hour", seconds_text(F.col("hour")))


@query("a5_errors_top", log(f"""SELECT error_type, source, count(*) AS error_count,
  {ts3('max(created_at)')} AS last_seen FROM logs WHERE level = 'ERROR' AND error_type IS NOT NULL
  GROUP BY ALL"""))
def errors_top(spark, folder):
    return rollups.errors_top(inputs.logs(spark, folder)).withColumn(
        "last_seen", millis_text(F.col("last_seen")))


@query("a7_a8_merged_partials", log(_ERRORS + _MATRIX))
def merged_partials(spark, folder):
    logs = inputs.logs(spark, folder, ["event_id"])
    parts = [rollups.service_error_matrix(logs.filter(F.col("event_id") % 3 == p))
             for p in range(3)]
    return matrix_text(rollups.merge_service_error_matrix(
        parts[0].unionByName(parts[1]).unionByName(parts[2])))


@query("a10_top_error_types", log(_ERRORS + """
SELECT etype AS error_type, count(*) AS error_count FROM err GROUP BY ALL
ORDER BY error_count DESC, error_type LIMIT 3"""))
def top_error_types(spark, folder):
    return rollups.top_error_types(rollups.service_error_matrix(inputs.logs(spark, folder)))


@query("a11_top_errors_per_service", log(_ERRORS + f"""
, c AS (SELECT source_service, etype AS error_type, count(*) AS error_count,
  max(created_at) AS last_time FROM err GROUP BY ALL)
SELECT source_service, error_type, error_count, {ts3('last_time')} AS last_error_time,
  row_number() OVER (PARTITION BY source_service ORDER BY error_count DESC, error_type) AS rank
FROM c QUALIFY rank <= 3"""))
def top_errors_per_service(spark, folder):
    top = rollups.top_errors_per_service(
        rollups.service_error_matrix(inputs.logs(spark, folder)))
    return top.withColumns({"last_error_time": millis_text(F.col("last_error_time")),
                            "rank": F.col("rank").cast("bigint")})


@query("a12_dead_services", log(f"""
SELECT 'u-' || user_id AS source_service, {ts3('max(created_at)')} AS last_log_time,
  cast(floor(epoch(TIMESTAMP '{inputs.AS_OF}' - max(created_at))) AS bigint) AS silent_seconds
FROM logs WHERE user_id IS NOT NULL GROUP BY ALL
HAVING max(created_at) < TIMESTAMP '{inputs.AS_OF}' - INTERVAL 1 HOUR"""))
def dead_services(spark, folder):
    # Users stand in for services: only they fall silent for hours in this data.
    logs = inputs.logs(spark, folder).filter("user_id IS NOT NULL").withColumn(
        "source_service", F.concat(F.lit("u-"), "user_id"))
    return rollups.dead_services(rollups.service_health(logs), as_of()).withColumn(
        "last_log_time", millis_text(F.col("last_log_time")))


# --- health signals and metrics ----------------------------------------------------------------

_SIGNAL_TIME = "2024-01-30 23:00:00"


def signal_time():
    return F.lit(_SIGNAL_TIME).cast("timestamp")


@query("h1_recent_unparsed", log(f"""SELECT count(*) AS parse_errors_last_10min FROM logs
WHERE is_parsed = 0 AND created_at >= TIMESTAMP '{_SIGNAL_TIME}' - INTERVAL 10 MINUTE"""))
def recent_unparsed(spark, folder):
    return signals.recent_unparsed(inputs.logs(spark, folder), signal_time())


_LAG = f"epoch_us(TIMESTAMP '{inputs.AS_OF}') - epoch_us(max(l.ingested_at))"


@query("h2_h4_freshness", log(f"""SELECT {ts3('max(l.ingested_at)')} AS max_ingested_at,
  ({_LAG}) / 1000000 AS ingestion_lag_seconds, count(*) AS total_logs_count FROM logs l"""))
def freshness(spark, folder):
    return signals.freshness(inputs.logs(spark, folder), as_of()).withColumn(
        "max_ingested_at", millis_text(F.col("max_ingested_at")))


@query("h5_health_signals", log(f"""SELECT count(*) FILTER (WHERE is_parsed = 0 AND
  created_at >= TIMESTAMP '{inputs.AS_OF}' - INTERVAL 6 HOUR) AS parse_errors_last_10min,
  {ts3('max(l.ingested_at)')} AS max_ingested_at, ({_LAG}) / 1000000 AS ingestion_lag_seconds,
  count(*) AS total_logs_count FROM logs l"""))
def health_signals(spark, folder):
    # Six hours instead of ten minutes, so that the small tables have something to count.
    return signals.health_signals(inputs.logs(spark, folder), as_of(), minutes=360).withColumn(
        "max_ingested_at", millis_text(F.col("max_ingested_at")))


# The backfill comes an hour after the time of the signals, later than all other records.
_NEWEST = f"greatest(max(l.ingested_at), TIMESTAMP '{inputs.AS_OF}' + INTERVAL 1 HOUR)"


@query("h5_stored_signals", log(f"""SELECT count(*) FILTER (WHERE is_parsed = 0 AND
  created_at >= TIMESTAMP '{inputs.AS_OF}' - INTERVAL 6 HOUR) AS parse_errors_last_10min,
  {ts3(_NEWEST)} AS max_ingested_at,
  (epoch_us(TIMESTAMP '{inputs.AS_OF}') - epoch_us({_NEWEST})) / 1000000 AS ingestion_lag_seconds, count(*) + count(*) FILTER (WHERE event_id % 50 = 0) AS total_logs_count FROM logs l"""))
def stored_signals(spark, folder):
    """From the statistics of the table's commits, after a backfill of old days that came just now."""
    path, logs = scratch_dir(spark, "signals"), inputs.logs(spark, folder, ["event_id"])
    sink_tables.append_logs(logs, path)
    sink_tables.append_logs(logs.filter("event_id % 50 = 0").withColumns({
        "created_at": F.col("created_at") - F.expr("INTERVAL 60 DAYS"),
        "ingested_at": as_of() + F.expr("INTERVAL 1 HOUR")}), path)
    return signals.table_signals(sink_tables.log_table(spark, path), as_of(), minutes=360).withColumn(
        "max_ingested_at", millis_text(F.col("max_ingested_at")))


def stat(sql):
    return with_(oracle.STATS, sql)


@query("m1_counters", stat("""
SELECT 'messages_consumed' AS metric, 'logs.raw' AS label, cast(sum(consumed) AS bigint) AS value
  FROM stats
UNION ALL SELECT 'writes', 'success', count(*) FROM stats WHERE status = 'success'
UNION ALL SELECT 'writes', 'error', cast(sum(failed_attempts) AS bigint) FROM stats
UNION ALL SELECT 'rows_written', '', cast(sum(written) AS bigint) FROM stats
UNION ALL SELECT 'dlq_messages', 'message_parse_error', cast(sum(rejected) AS bigint) FROM stats
UNION ALL SELECT 'dlq_messages', 'clickhouse_insert_failure', cast(sum(consumed - rejected) AS bigint)
  FROM stats WHERE status = 'dlq'"""))
def counters(spark, folder):
    return metrics.counters(inputs.batch_stats(spark, folder))


@query("m1_ingested_by_label", log("""
SELECT source, level, count(*) AS value FROM logs GROUP BY ALL"""))
def ingested_by_label(spark, folder):
    return metrics.ingested_by_label(inputs.logs(spark, folder))


_M2 = "\nUNION ALL\n".join(
    f"SELECT '{metric}' AS metric, '{bound if isinstance(bound, str) else f'{bound:g}'}' AS le, "
    f"count(*) FILTER (WHERE {'true' if isinstance(bound, str) else f'{column} <= cast({bound} AS double)'})"
    " AS cumulative FROM stats WHERE status = 'success'"
    for metric, (column, bounds) in metrics.HISTOGRAMS.items() for bound in [*bounds, "+Inf"])


@query("m2_histograms", stat(_M2))
def histograms(spark, folder):
    return metrics.histograms(inputs.batch_stats(spark, folder))


@query("m2_histogram_sums", stat("\nUNION ALL\n".join(
    f"SELECT '{m}' AS metric, round(sum({c}), 6) AS sum, count(*) AS count FROM stats "
    "WHERE status = 'success'" for m, (c, _) in metrics.HISTOGRAMS.items())))
def histogram_sums(spark, folder):
    return metrics.histogram_sums(inputs.batch_stats(spark, folder)).withColumn(
        "sum", F.round("sum", 6))


@query("m3_throughput", stat("""
SELECT batch_id, written, cast(floor(written / flush_seconds) AS bigint) AS rows_per_second
FROM stats WHERE status = 'success'"""))
def throughput(spark, folder):
    return metrics.throughput(inputs.batch_stats(spark, folder))


@query("m3_flush_totals", stat("""
SELECT cast(sum(consumed) AS bigint) AS total_consumed, cast(sum(written) AS bigint) AS total_flushed,
  count(*) FILTER (WHERE status = 'success') AS flush_count,
  cast(floor(sum(written) / sum(flush_seconds) FILTER (WHERE status = 'success')) AS bigint)
    AS rows_per_second FROM stats"""))
def flush_totals(spark, folder):
    return metrics.flush_totals(inputs.batch_stats(spark, folder))


@query("m5_conservation", with_(oracle.CLF, _CLF_BAD + """
SELECT file, count(*) AS sent, count(*) FILTER (WHERE good) AS stored,
  count(*) FILTER (WHERE NOT good) AS rejected, 0 AS missing FROM bad GROUP BY file"""))
def conservation(spark, folder):
    lines = inputs.clf_lines(spark, folder)
    logs, bad = dispatch.run_text_job(lines, "clf", ingested_at=F.col("received"),
                                      id_from=["event_id"], keep=["file"])
    return metrics.conservation(lines, logs, bad, by="file")


@query("m5_lost_and_doubled", log("""
SELECT event_id, 1 AS sent, (event_id % 97 <> 5)::int + (event_id % 89 = 7)::int AS stored FROM logs
WHERE (event_id % 97 <> 5)::int + (event_id % 89 = 7)::int <> 1"""))
def lost_and_doubled(spark, folder):
    """Which records are missing or doubled in a stored table, by digests per source and hour."""
    sent = inputs.logs(spark, folder, ["event_id"]).withColumn("hour", F.date_trunc("hour", "created_at"))
    stored = sent.filter("event_id % 97 <> 5").unionByName(sent.filter("event_id % 89 = 7"))
    return metrics.lost_and_doubled(sent, stored, ["source", "hour"], ["event_id"])


@query("m5_unequal_cells", log("""
SELECT DISTINCT source, strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:%M:%S') AS hour FROM logs
WHERE (event_id % 97 <> 5)::int + (event_id % 89 = 7)::int <> 1"""))
def unequal_cells(spark, folder):
    sent = inputs.logs(spark, folder, ["event_id"]).withColumn("hour", F.date_trunc("hour", "created_at"))
    stored = sent.filter("event_id % 97 <> 5").unionByName(sent.filter("event_id % 89 = 7"))
    return metrics.unequal_cells(sent, stored, ["source", "hour"], ["event_id"]).withColumn(
        "hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


# --- the whole way -----------------------------------------------------------------------------

def flagship(spark, folder):
    """Access-log lines to stored records to the top errors of every service."""
    lines = inputs.clf_lines(spark, folder)
    service = F.concat(F.lit("svc-"), F.col("event_id") % 8)
    logs, _ = dispatch.run_text_job(lines, "clf", source_service=service, source="file",
                                    ingested_at=F.col("received"), id_from=["event_id"])
    path = scratch_dir(spark, "flagship")
    sink_tables.append_logs(logs, path)
    stored = source_tables.read_log_table(spark, path)
    top = rollups.top_errors_per_service(rollups.service_error_matrix(stored))
    return top.select("source_service", "error_type", "error_count",
                      millis_text(F.col("last_error_time")).alias("last_error_time"),
                      F.col("rank").cast("bigint").alias("rank"))


query("flagship_lines_to_top_errors", with_(oracle.CLF, f"""
SELECT 'svc-' || event_id % 8 AS source_service, 'Unknown' AS error_type, count(*) AS error_count,
  {ts3("max(coalesce(event_time, date_trunc('milliseconds', received)))")} AS last_error_time,
  1 AS rank
FROM clf_fields WHERE fits AND status BETWEEN 500 AND 599 GROUP BY event_id % 8"""))(flagship)
