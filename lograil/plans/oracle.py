"""The derivations of ``inputs.py`` in DuckDB SQL, as common table expressions."""

EVENTS = """
ev AS (SELECT *, regexp_extract(props, '[0-9]+') AS k,
    ts + to_seconds(event_id % 600) AS received FROM events)
"""

RECORDS = EVENTS + """,
rec AS (
  SELECT event_id, md5(cast(event_id AS varchar)) AS id,
    CASE WHEN event_id % 50 <> 0 THEN ts END AS event_time,
    received AS ingest_time,
    CASE event_id % 3 WHEN 0 THEN 'http' WHEN 1 THEN 'kafka' ELSE 'file' END AS source,
    CASE WHEN event_id % 5 <> 0 THEN 'host-' || event_id % 20 END AS source_host,
    'svc-' || user_id % 8 AS source_service,
    CASE WHEN event_id % 97 = 0 THEN 'bogus'
      WHEN event_type = 'error' AND value > 100 THEN 'critical'
      WHEN event_type = 'error' THEN 'err' WHEN event_type = 'view' THEN 'trace'
      WHEN event_type = 'click' THEN 'Information' WHEN event_type = 'signup' THEN 'warning'
      ELSE ' info ' END AS raw_level,
    event_type || ' by user ' || user_id % 10 AS message,
    CASE event_id % 6
      WHEN 1 THEN '{"http_status":' || 200 + event_id % 300 || ',"k":' || k ||
        ',"response_time_ms":' || event_id % 2000 || ',"trace_id":"t-' || event_id % 1000 || '"}'
      WHEN 2 THEN '{"http_status":"404","k":' || k || '}'
      WHEN 3 THEN '{"http_status":999,"k":' || k || ',"user_id":' || user_id || '}'
      WHEN 4 THEN '{"k":' || k || ',"response_time_ms":12.7,"span_id":null}'
      WHEN 5 THEN '{"k":' || k || '}' ELSE '{}' END AS metadata,
    CASE WHEN event_id % 7 <> 0 THEN cast(user_id AS varchar) END AS declared_user,
    user_id AS event_user,
    CASE WHEN event_id % 12 = 1 THEN 'declared-' || event_id % 100 END AS declared_trace,
    CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 1 THEN 'TimeoutError'
      WHEN 2 THEN 'ValidationError' WHEN 3 THEN 'OutOfMemoryError' END END AS error_type,
    CASE WHEN event_id % 41 = 0 THEN 0 ELSE 1 END AS is_parsed,
    CASE WHEN event_id % 41 = 0 THEN 'unreadable field' END AS parse_errors
  FROM ev)
"""

LOGS = RECORDS + """,
logs AS (
  SELECT event_id, id,
    date_trunc('milliseconds', coalesce(event_time, ingest_time)) AS created_at,
    date_trunc('milliseconds', ingest_time) AS ingested_at,
    CASE WHEN event_time IS NULL THEN 1 ELSE 0 END AS event_time_missing,
    source, coalesce(source_host, '') AS source_host, source_service,
    CASE upper(trim(raw_level)) WHEN 'CRITICAL' THEN 'FATAL' WHEN 'ERR' THEN 'ERROR'
      WHEN 'TRACE' THEN 'DEBUG' WHEN 'INFORMATION' THEN 'INFO' WHEN 'WARNING' THEN 'WARN'
      WHEN 'INFO' THEN 'INFO' END AS level,
    message, '' AS parsed_message, 'json' AS format, metadata,
    CASE WHEN declared_user IS NOT NULL THEN declared_user
      WHEN event_id % 6 = 3 THEN cast(event_user AS varchar) END AS user_id,
    CASE WHEN declared_trace IS NOT NULL THEN declared_trace
      WHEN event_id % 6 = 1 THEN 't-' || event_id % 1000 END AS trace_id,
    cast(CASE event_id % 6 WHEN 1 THEN 200 + event_id % 300 WHEN 2 THEN 404 END AS integer)
      AS http_status,
    cast(CASE event_id % 6 WHEN 1 THEN event_id % 2000 WHEN 4 THEN 12 END AS bigint)
      AS http_response_time_ms,
    error_type, is_parsed, parse_errors
  FROM rec WHERE raw_level <> 'bogus')
"""

CLF = EVENTS + r""",
clf AS (
  SELECT event_id, received, CASE WHEN event_id % 40 = 8 THEN 'not an access log ' || event_id
    ELSE '10.0.' || user_id % 4 || '.' || event_id % 256 ||
    CASE WHEN event_id % 9 = 0 THEN ' id ' ELSE ' - ' END ||
    CASE WHEN event_id % 3 = 0 THEN '-' ELSE 'u' || user_id END || ' [' ||
    CASE WHEN event_id % 11 = 3 THEN 'BAD_TIMESTAMP' ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') END ||
    CASE event_id % 11 WHEN 1 THEN ' -0700' WHEN 2 THEN '' WHEN 3 THEN '' WHEN 4 THEN ' +05:30'
      ELSE ' +0000' END || '] "' ||
    CASE event_id % 13 WHEN 0 THEN '-' WHEN 1 THEN '' WHEN 2 THEN 'get /lower HTTP/1.1'
      WHEN 3 THEN 'GET /noproto' ELSE
      CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'POST' ELSE 'GET' END ||
      ' /api/' || event_type || '/' || event_id || ' HTTP/1.1' END || '" ' ||
    CASE WHEN event_id % 17 = 0 THEN '700' ELSE
      ['200', '301', '404', '500', '101', '204'][event_id % 6 + 1] END || ' ' ||
    CASE WHEN event_id % 10 = 0 THEN '-' ELSE cast(event_id * 3 AS varchar) END ||
    CASE event_id % 4 WHEN 0 THEN ' "-" "Mozilla/5.0 (X11)"'
      WHEN 1 THEN ' "http://ref.example/' || user_id || '" "-"' WHEN 2 THEN ' "" "curl"'
      ELSE '' END ||
    CASE WHEN event_id % 40 = 7 THEN ' trailing' ELSE '' END END AS line
  FROM ev),
clf_groups AS (
  SELECT event_id, received, line,
    regexp_matches(line, '^\S+\s+\S+\s+\S+\s+\[[^\]]+\]\s+"[^"]*"\s+\d{3}\s+(\d+|-)(\s+"[^"]*"\s+"[^"]*")?$')
      AS fits,
    regexp_extract(line, '^(\S+)\s+(\S+)\s+(\S+)\s+\[([^\]]+)\]\s+"([^"]*)"\s+(\d{3})\s+(\d+|-)(.*)$',
      ['host', 'ident', 'usr', 'tim', 'request', 'status', 'bytes', 'tail']) AS g
  FROM clf),
clf_fields AS (
  SELECT event_id, received, line, fits, g, try_cast(g.status AS integer) AS status,
    regexp_extract(g.tail, '^\s+"([^"]*)"\s+"([^"]*)"$', ['referer', 'agent']) AS t,
    regexp_extract(g.request, '^([A-Z!#$%&''*+\-.^_`|~0-9]+)\s+(\S+)(\s+(HTTP/\d(\.\d)?))?$',
      ['method', 'path', 'x', 'protocol']) AS r,
    date_trunc('milliseconds', CASE
      WHEN regexp_matches(g.tim, '^\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2}') THEN
        strptime(substr(g.tim, 1, 20), '%d/%b/%Y:%H:%M:%S') - CASE
          WHEN regexp_matches(g.tim, '[+-]\d{2}:?\d{2}$') THEN to_seconds(
            (CASE WHEN substr(g.tim, 22, 1) = '-' THEN -1 ELSE 1 END) *
            (cast(substr(g.tim, 23, 2) AS integer) * 3600 + cast(right(g.tim, 2) AS integer) * 60))
          ELSE to_seconds(0) END END) AS event_time
  FROM clf_groups)
"""

REQUESTS = EVENTS + r""",
req AS (
  SELECT event_id, event_id % 16 AS m, ts, received, event_type, user_id, k,
    CASE event_id % 16
      WHEN 1 THEN 'source: must be a string' WHEN 2 THEN 'source: must be a string'
      WHEN 3 THEN 'value is not valid JSON' WHEN 4 THEN 'value is not a JSON object'
      WHEN 5 THEN 'level: unknown level ''bogus'''
      WHEN 6 THEN 'payload: must be an object'
      WHEN 9 THEN 'level: longer than 10 characters'
      END AS error
  FROM ev)
"""

MESSAGES = EVENTS + r""",
msg AS (
  SELECT event_id, event_id % 20 AS m, ts, event_type, user_id, k,
    CASE event_id % 20
      WHEN 3 THEN 'value is not valid JSON'
      WHEN 4 THEN 'value is not a JSON object'
      WHEN 5 THEN 'level: must be a string'
      WHEN 6 THEN 'message: required'
      WHEN 7 THEN 'id: must be a UUID'
      WHEN 10 THEN 'event_time_missing: must be a boolean'
      WHEN 11 THEN 'level: unknown level ''grade ' || user_id % 3 || ''''
      WHEN 12 THEN 'metadata: must be a JSON object'
      WHEN 17 THEN 'http_status: must be an integer'
      WHEN 18 THEN 'http_status: must be 100 to 599'
      WHEN 0 THEN 'http_status: must be an integer'
      WHEN 19 THEN 'http_response_time_ms: must be at least 0'
      END AS error
  FROM ev)
"""

_PHRASES = ["timeout", "timed out", "connection", "temporarily disabled", "502", "503", "504", "upstream timed out",
            "connection refused", "connection reset", "network error",
            "unrecognized column", "unknown column", "table t_7 doesn't exist", "access denied", "authentication",
            "permission denied", "schema", "type mismatch", "cannot parse",
            "invalid json", "json decode", "malformed", "validation error", "parse error", "decode error",
            "schema lookup timeout", "malformed schema", "5021 rows", "no cause given", "disk full"]

# The patterns of each class, in the order in which they give the reason.
_INFRA = [r"timeout", r"timed out", r"connection", r"temporarily disabled", r"\b502\b", r"\b503\b", r"\b504\b",
          r"upstream timed out", r"connection refused", r"connection reset", r"network error"]
_STORAGE = [r"unrecognized column", r"unknown column", r"table.*doesn't exist", r"access denied", r"authentication",
            r"permission denied", r"schema", r"type mismatch", r"cannot parse"]
_DATA = [r"invalid json", r"json decode", r"malformed", r"validation error", r"parse error", r"decode error"]


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _found(patterns) -> str:
    return f"regexp_matches(class_text, {_text('(?i)' + '|'.join(patterns))})"


_REASONS = ", ".join(f"nullif(regexp_extract(class_text, {_text('(?i)' + p)}), '')" for p in _INFRA + _STORAGE + _DATA)

DLQ = EVENTS + rf""",
dlq_text AS (
  SELECT *, 'step ' || event_id % 4 || ': ' || CASE WHEN event_id % 2 = 0 THEN upper(phrase) ELSE phrase END AS txt,
    CASE WHEN event_id % 23 = 0 THEN 'junk' WHEN event_id % 29 = 0 THEN 'bare'
      WHEN event_id % 4 = 1 THEN 'parser_reject' WHEN event_id % 4 = 2 THEN 'failed_batch'
      WHEN event_id % 4 = 3 THEN 'unparseable_message' ELSE 'log' END AS kind,
    '{{"level":"INFO","message":"' || event_type || ' ' || event_id || '","source":"http",' ||
      '"source_service":"svc-' || user_id % 8 || '"}}' AS log_json
  FROM (SELECT *, [{", ".join(map(_text, _PHRASES))}][event_id % {len(_PHRASES)} + 1] AS phrase FROM ev)),
dlq AS (
  SELECT event_id, cast(event_id % 3 AS integer) AS part, event_id // 3 AS off, ts, kind, log_json,
    CASE WHEN event_id % 5 <> 0 THEN 'svc-' || user_id % 8 END AS msg_key,
    'svc-' || user_id % 8 AS service,
    CASE WHEN kind NOT IN ('junk', 'bare') THEN txt END AS error_text,
    -- Letters that tell the error in a header have it twice in the text that is classified.
    CASE WHEN kind = 'log' THEN txt || ' ' || txt WHEN kind NOT IN ('junk', 'bare') THEN txt END AS class_text
  FROM dlq_text),
dlq_class AS (
  SELECT *, CASE
    WHEN {_found(_INFRA)} THEN 'infra/transient'
    WHEN {_found(_STORAGE)} THEN 'storage/schema/config'
    WHEN {_found(_DATA)} THEN 'data/parsing'
    WHEN kind = 'junk' THEN 'data/parsing' ELSE 'unknown' END AS error_class,
    CASE WHEN error_text IS NULL THEN CASE WHEN kind = 'junk' THEN 'JSON decode error' END ELSE
    coalesce({_REASONS}) END AS error_reason
  FROM dlq),
committed AS (
  SELECT cast(event_id % 3 AS integer) AS part, count(*) // 4 AS committed_offset
  FROM events WHERE event_id % 3 < 2 GROUP BY 1)
"""

DLQ_SUMMARY = DLQ + """,
cls AS (
  SELECT error_class, count(*) AS n, count(*) / sum(count(*)) OVER () AS share,
    CASE error_class WHEN 'infra/transient' THEN 1 WHEN 'storage/schema/config' THEN 2
      WHEN 'data/parsing' THEN 3 ELSE 4 END AS prec
  FROM dlq_class GROUP BY error_class),
dom AS (
  SELECT (SELECT cast(sum(n) AS bigint) FROM cls) AS sampled_count, error_class AS dominant_class,
    share AS dominant_share,
    coalesce((SELECT share FROM cls WHERE error_class = 'storage/schema/config'), 0)
      AS storage_share
  FROM cls ORDER BY n DESC, prec LIMIT 1)
"""

STATS = """
st AS (
  SELECT event_id // 100 AS batch_id, count(*) AS consumed,
    count(*) FILTER (WHERE event_id % 97 = 0) AS rejected FROM events GROUP BY 1),
stats AS (
  SELECT batch_id, consumed, rejected,
    CASE WHEN batch_id % 9 = 4 THEN 0 ELSE consumed - rejected END AS written,
    CASE WHEN batch_id % 9 = 4 THEN 'dlq' ELSE 'success' END AS status,
    CASE WHEN batch_id % 9 = 4 THEN 3 WHEN batch_id % 5 = 0 THEN 1 ELSE 0 END AS failed_attempts,
    (batch_id % 40) * cast(0.03 AS double) AS write_seconds,
    (batch_id % 40) * cast(0.03 AS double) + cast(0.005 AS double) AS flush_seconds
  FROM st)
"""


def with_(cte: str, body: str) -> str:
    return f"WITH {cte.strip()}\n{body.strip()}"


def ts3(c: str) -> str:
    """A timestamp as text with milliseconds."""
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%g')"


def ts0(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
