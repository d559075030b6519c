"""Queries that run a stream over the given tables to its end and read what it wrote."""

import time
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lograil.functions import times
from lograil.operators import dlq, replay
from lograil.operators.rollups import merge_error_type_partials
from lograil.plans import inputs, oracle
from lograil.plans.inputs import millis_text, seconds_text
from lograil.plans.letters import summary, _GATE, _REPLAYABLE
from lograil.plans.oracle import ts0, ts3, with_
from lograil.plans.registry import query
from lograil.session import scratch_dir
from lograil.sinks import files, tables as sink_tables
from lograil.sinks.topics import append_topic, topic_table
from lograil.sources import tables as source_tables
from lograil.sources.topics import DLQ_TOPIC, read_topic_files
from lograil.streaming.alarm import ALARM_SCHEMA, silence_stream, silent_now
from lograil.streaming.ingest import BOUNDED_ROLLUPS, TopicIngest
from lograil.streaming.listener import LiveCounters, ProgressLog
from lograil.streaming.rollups import compact_rollup, hourly_health_stream, read_partials, read_rollup
from lograil.streaming.triage import TriageJob, read_committed


def run_ingest(spark, folder, rollups=BOUNDED_ROLLUPS, files=None, per_batch=None, change=lambda topic: topic):
    """Write the topic as files, run the ingest stream over them, return the output root.

    Unless told otherwise there are three batches, each of one file for every core.
    """
    root, cores = scratch_dir(spark, "stream"), spark.sparkContext.defaultParallelism
    files, per_batch = files or 3 * cores, per_batch or cores
    topic = change(inputs.topic_messages(spark, folder).drop("event_id"))
    topic.repartition(files, "partition", "offset").write.parquet(f"{root}/topic")
    job = TopicIngest(spark, f"{root}/out", rollups=rollups)
    job.start(read_topic_files(spark, f"{root}/topic", max_files=per_batch), f"{root}/checkpoint",
              available_now=True).awaitTermination()
    return f"{root}/out"


_STREAMED = oracle.MESSAGES + """,
streamed AS (SELECT event_id, date_trunc('milliseconds', ts) AS created_at, 'svc-' || user_id % 8 AS service,
  CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  event_type || ' ' || event_id AS message,
  CASE WHEN event_type = 'error' AND event_id % 3 > 0 THEN 'TimeoutError' ELSE 'Unknown' END AS etype
  FROM msg WHERE error IS NULL)
"""


@query("s1_t1_stream_ingest", with_(oracle.MESSAGES, """
SELECT 'stored' AS part, count(*) AS n, cast(sum(length(event_type || ' ' || event_id)) AS bigint)
  AS chars FROM msg WHERE error IS NULL
UNION ALL SELECT 'dead letters', count(*), cast(sum(length('Failed to parse message: ' || error))
  AS bigint) FROM msg WHERE error IS NOT NULL
UNION ALL SELECT 'consumed', count(*), 0 FROM msg"""))
def stream_ingest(spark, folder):
    root = run_ingest(spark, folder, ())
    stored = source_tables.read_log_table(spark, f"{root}/logs").agg(
        F.lit("stored").alias("part"), F.count("*").alias("n"),
        F.sum(F.length("message")).alias("chars"))
    dead = topic_table(spark, f"{root}/dead_letters").read().agg(
        F.lit("dead letters").alias("part"), F.count("*").alias("n"),
        F.sum(F.length(F.get_json_object(F.col("value").cast("string"), "$.error_message"))).alias("chars"))
    stats = source_tables.read_batches(spark, f"{root}/stats").agg(
        F.lit("consumed").alias("part"), F.sum("consumed").alias("n"),
        F.lit(0).cast("bigint").alias("chars"))
    return stored.unionByName(dead).unionByName(stats)


@query("a9_t5_stream_rollup", with_(_STREAMED, f"""
SELECT {ts0("date_trunc('hour', created_at)")} AS hour, service AS source_service,
  count(*) AS log_count, {ts3('max(created_at)')} AS last_log_time,
  {ts3('min(created_at)')} AS min_log_time FROM streamed
GROUP BY date_trunc('hour', created_at), service"""))
def stream_rollup(spark, folder):
    root = run_ingest(spark, folder, ("service_health",))
    # The state of merged batches and a batch that came after must merge to the same rows.
    compact_rollup(spark, root, "service_health")
    return read_rollup(spark, root, "service_health").select(
        seconds_text(F.col("hour")).alias("hour"), "source_service", "log_count",
        millis_text(F.col("last_log_time")).alias("last_log_time"),
        millis_text(F.col("min_log_time")).alias("min_log_time"))


@query("a9_stream_error_types", with_(_STREAMED, """
SELECT cast(created_at AS date)::varchar AS date, etype AS error_type, level, count(*) AS error_count,
  array_to_string(list_sort(list(DISTINCT 'error ' || CASE WHEN event_id % 10 < 4 THEN 'a' WHEN event_id % 10 < 7
    THEN 'b' ELSE 'c' END)), ',') AS messages FROM streamed WHERE level = 'ERROR' GROUP BY ALL"""))
def stream_error_types(spark, folder):
    """The default, bounded rollup of a stream with three texts per type, with its messages."""
    def few(topic):
        text = F.col("value").cast("string")
        for digits, letter in (("0-3", "a"), ("4-6", "b"), ("7-9", "c")):
            text = F.regexp_replace(text, f'"message": "(\\w+) \\d*[{digits}]"', f'"message": "$1 {letter}"')
        return topic.withColumn("value", F.encode(text, "UTF-8"))

    root = run_ingest(spark, folder, change=few)
    merged = merge_error_type_partials(read_partials(spark, root, "error_types"))
    return merged.select(F.col("date").cast("string").alias("date"), "error_type", "level", "error_count",
                         F.array_join(F.array_sort("sample_messages"), ",").alias("messages"))


@query("a9_default_rollups", with_(_STREAMED, """
SELECT 'service_errors' AS part, count(*) AS keys, cast(sum(n) AS bigint) AS n FROM (SELECT count(*) AS n FROM streamed
  WHERE level = 'ERROR' GROUP BY cast(created_at AS date), service, etype, level)
UNION ALL SELECT 'service_health', count(*), cast(sum(n) AS bigint) FROM (SELECT count(*) AS n FROM streamed
  GROUP BY date_trunc('hour', created_at), service)
UNION ALL SELECT 'hourly_volume', count(*), cast(sum(n) AS bigint) FROM (SELECT count(*) AS n FROM streamed
  GROUP BY date_trunc('hour', created_at), level)
UNION ALL SELECT 'errors_top', count(*), cast(sum(n) AS bigint) FROM (SELECT count(*) AS n FROM streamed
  WHERE level = 'ERROR' AND etype <> 'Unknown' GROUP BY etype)"""))
def default_rollups(spark, folder):
    """All other default rollups of one stream, read from merged months."""
    root = run_ingest(spark, folder)
    parts = []
    for name, number in (("service_errors", "error_count"), ("service_health", "log_count"),
                         ("hourly_volume", "log_count"), ("errors_top", "error_count")):
        compact_rollup(spark, root, name)
        parts.append(read_rollup(spark, root, name).agg(
            F.lit(name).alias("part"), F.count("*").alias("keys"), F.sum(number).alias("n")))
    return reduce(DataFrame.unionByName, parts)


@query("m1_live_counters", with_(oracle.MESSAGES, """
SELECT part, count(*) AS consumed, count(error) AS rejected FROM msg, (VALUES ('listener'), ('stored')) v(part)
GROUP BY part"""))
def live_counters(spark, folder):
    """What the listener has appended while the stream ran, and the statistics that the stream stored."""
    log = ProgressLog(spark, scratch_dir(spark, "progress"))
    spark.streams.addListener(log)
    try:
        root = run_ingest(spark, folder, ("service_health",))
        counters, batches = LiveCounters(spark, log.path), source_tables.read_batches(spark, f"{root}/stats")
        expected, until = batches.count(), time.monotonic() + 30
        # Reports arrive a moment after the batch.
        while len(files.names(spark, log.path)) < expected and time.monotonic() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    seen = counters.totals().select(F.lit("listener").alias("part"), "consumed", "rejected")
    return seen.unionByName(batches.agg(
        F.lit("stored").alias("part"), F.sum("consumed").alias("consumed"), F.sum("rejected").alias("rejected")))


@query("t5_closed_hours", f"""
WITH l AS (SELECT date_trunc('milliseconds', ts) AS t, 'svc-' || user_id % 8 AS s FROM events)
SELECT {ts0("date_trunc('hour', t)")} AS hour, s AS source_service, count(*) AS log_count,
  {ts3('max(t)')} AS last_log_time, {ts3('min(t)')} AS min_log_time FROM l
GROUP BY date_trunc('hour', t), s
HAVING date_trunc('hour', t) + INTERVAL 1 HOUR <= (SELECT max(t) FROM l) - INTERVAL 1 HOUR""")
def closed_hours(spark, folder):
    root = scratch_dir(spark, "hours")
    schema = inputs.table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(
        folder)
    logs = events.select(
        times.to_millis(F.col("ts").cast("timestamp")).alias("created_at"),
        F.concat(F.lit("svc-"), F.col("user_id") % 8).alias("source_service"))
    hourly_health_stream(logs).writeStream.format("parquet").option(
        "checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/out").outputMode(
        "append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        seconds_text(F.col("hour")).alias("hour"), "source_service", "log_count",
        millis_text(F.col("last_log_time")).alias("last_log_time"),
        millis_text(F.col("min_log_time")).alias("min_log_time"))


@query("a12_live_alarm", f"""
WITH l AS (SELECT date_trunc('milliseconds', ts) AS t, 'u-' || user_id AS s FROM events WHERE user_id IS NOT NULL)
SELECT s AS source_service, {ts3('max(t)')} AS last_log_time, {ts3("max(t) + INTERVAL 1 HOUR")} AS at FROM l GROUP BY s
HAVING max(t) + INTERVAL 1 HOUR < (SELECT max(t) FROM l) - INTERVAL 10 MINUTE""")
def live_alarm(spark, folder):
    """Users stand in for services; the stream takes the events in four rounds of time."""
    root, times_of = scratch_dir(spark, "alarm"), inputs.table(spark, folder, "events").filter("user_id IS NOT NULL")
    logs = times_of.select(
        F.concat(F.lit("u-"), "user_id").alias("source_service"),
        times.to_millis(F.col("ts").cast("timestamp")).alias("created_at"))
    first, last = logs.agg(F.min(F.unix_millis("created_at")), F.max(F.unix_millis("created_at"))).first()
    step = (last - first) // 4 + 1
    for quarter in range(4):
        logs.filter(F.floor((F.unix_millis("created_at") - first) / step) == quarter).coalesce(1).write.mode(
            "append").parquet(f"{root}/logs")
    stream = spark.readStream.schema(logs.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/logs")
    silence_stream(stream).writeStream.foreachBatch(
        lambda rows, number: sink_tables.write_batch(rows, f"{root}/told", number)).option(
        "checkpointLocation", f"{root}/checkpoint").outputMode("update").trigger(
        availableNow=True).start().awaitTermination()
    told = source_tables.read_batches(spark, f"{root}/told", ALARM_SCHEMA)
    return silent_now(told).select("source_service", millis_text(F.col("last_log_time")).alias("last_log_time"),
                                   millis_text(F.col("at")).alias("at"))


@query("t7_triage_run", summary(f"""
SELECT sampled_count, dominant_class, {_GATE} AS replayed,
  CASE WHEN {_GATE} THEN {_REPLAYABLE} ELSE 0 END AS replayed_rows,
  CASE WHEN {_GATE} THEN 3 ELSE 0 END AS committed_partitions FROM dom"""))
def triage_run(spark, folder):
    root = scratch_dir(spark, "triage")
    report = TriageJob(spark, root, sample_size=None, park_refused=False).run(
        inputs.dead_letters(spark, folder), inputs.logs(spark, folder), inputs.as_of(), run_id=1)
    replayed = report.first()["replayed"]
    rows = spark.read.parquet(f"{root}/replayed/run_id=1").count() if replayed else 0
    committed = read_committed(spark, f"{root}/committed").count()
    return report.select("sampled_count", "dominant_class", "replayed").withColumns({
        "replayed_rows": F.lit(rows).cast("bigint"),
        "committed_partitions": F.lit(committed).cast("bigint")})


@query("t7_sampled_runs", with_(oracle.DLQ, """
SELECT part AS partition, off AS offset, CASE WHEN kind IN ('log', 'bare', 'failed_batch')
  THEN 'replayed' ELSE 'parked' END AS outcome, CAST(1 AS BIGINT) AS times FROM dlq"""))
def sampled_runs(spark, folder):
    """Triage by samples until the queue is empty, with times that run against the offsets."""
    root = scratch_dir(spark, "sampled")
    topic = inputs.dead_letters(spark, folder).withColumn(
        "timestamp", F.timestamp_seconds(F.lit(1_700_000_000) - F.col("offset")))
    logs, count = inputs.logs(spark, folder), topic.count()
    job = TriageJob(spark, root, sample_size=count // 3 + 1)
    run = 0
    while run == 0 or report["sampled_count"]:
        report = job.run(topic, logs, inputs.as_of(), run, force=True).first()
        run += 1
    replayed = spark.read.parquet(f"{root}/replayed/run_id=*").withColumn("outcome", F.lit("replayed"))
    parked = job.parked().withColumn("outcome", F.lit("parked"))
    both = replayed.select("partition", "offset", "outcome").unionByName(
        parked.select("partition", "offset", "outcome"))
    return both.groupBy("partition", "offset", "outcome").agg(F.count("*").alias("times"))


@query("t7_closed_gate", with_(oracle.DLQ_SUMMARY, f"""
SELECT 'parked' AS part, count(*) AS n FROM dlq, dom WHERE NOT ({_GATE})
UNION ALL SELECT 'left', count(*) FROM dlq, dom WHERE {_GATE} AND false"""))
def closed_gate(spark, folder):
    """While the gate is closed all letters are parked, whole, and the queue moves on."""
    root = scratch_dir(spark, "closed")
    topic, logs = inputs.dead_letters(spark, folder), inputs.logs(spark, folder)
    job = TriageJob(spark, root, sample_size=None)
    job.run(topic, logs, inputs.as_of(), 0)
    left = dlq.uncommitted(topic, read_committed(spark, f"{root}/committed"))
    return job.parked().agg(F.lit("parked").alias("part"), F.count("*").alias("n")).unionByName(
        left.agg(F.lit("left").alias("part"), F.count("*").alias("n")))


def _no_store(logs, path, batch_id):
    """A writer that fails as Spark's do: its target cannot be made."""
    logs.write.mode("overwrite").parquet("unknown-scheme://nowhere/logs")


@query("t6_t7_loop", with_(oracle.MESSAGES, """
SELECT 'failed batch' AS part, count(*) AS n, cast(count(*) AS bigint) AS detail FROM msg WHERE error IS NULL
UNION ALL SELECT 'unparseable', count(*), cast(count(*) AS bigint) FROM msg WHERE error IS NOT NULL
UNION ALL SELECT 'parked', count(*), cast(count(*) AS bigint) FROM msg WHERE error IS NOT NULL
UNION ALL SELECT 'stored', count(*), cast(sum(length(event_type || ' ' || event_id)) AS bigint)
  FROM msg WHERE error IS NULL"""))
def loop(spark, folder):
    """A store that is down: messages to dead letters, to triage, to the replay topic, to the table."""
    root = scratch_dir(spark, "loop")
    topic = inputs.topic_messages(spark, folder).drop("event_id")
    broken = TopicIngest(spark, f"{root}/first", rollups=(), store=_no_store, pause=lambda seconds: None)
    broken.run_batch(topic, 0)
    letters = broken.dead_letters().read()
    kind = F.get_json_object(F.col("value").cast("string"), "$.error_type")
    job = TriageJob(spark, f"{root}/triage", sample_size=None)
    job.run(broken.dead_letters(), inputs.logs(spark, folder), inputs.as_of(), 0, force=True)
    again = TopicIngest(spark, f"{root}/second", topic=DLQ_TOPIC, rollups=())
    again.start(job.replay_stream(), f"{root}/checkpoint", available_now=True).awaitTermination()
    stored = source_tables.read_log_table(spark, f"{root}/second/logs").dropDuplicates(["id"])

    def counted(rows, part, detail=None):
        return rows.agg(F.lit(part).alias("part"), F.count("*").alias("n"),
                        (F.count("*") if detail is None else F.sum(detail)).alias("detail"))
    return (counted(letters.filter(kind == "clickhouse_insert_failure"), "failed batch")
            .unionByName(counted(letters.filter(kind == "message_parse_error"), "unparseable"))
            .unionByName(counted(job.parked(), "parked"))
            .unionByName(counted(stored, "stored", F.length("message"))))


@query("k7_stream_retention", with_(_STREAMED, """
SELECT cast(created_at AS date)::varchar AS day, count(*) AS n FROM streamed
WHERE cast(created_at AS date) >= DATE '2024-01-20' GROUP BY ALL"""))
def stream_retention(spark, folder):
    """Days that expired are removed from the table that the stream writes."""
    root = run_ingest(spark, folder, ())
    sink_tables.drop_expired_days(spark, f"{root}/logs", "2024-01-27 00:00:00", days=7)
    kept = source_tables.read_log_table(spark, f"{root}/logs")
    return kept.groupBy(F.col("event_date").cast("string").alias("day")).agg(F.count("*").alias("n"))


_DAY = "cast(created_at AS date) = (SELECT min(cast(created_at AS date)) FROM streamed)"


@query("k1_compacted_day", with_(_STREAMED, f"""
SELECT md5(event_id::varchar) AS id, cast(created_at AS date)::varchar AS day, message, 1::bigint AS times, 1 AS folders
FROM streamed WHERE {_DAY}"""))
def compacted_day(spark, folder):
    """The first day of the stream's table: written twice over, merged, a merge that stopped, a batch that repeats."""
    root = run_ingest(spark, folder, ())
    path = f"{root}/logs"
    table = sink_tables.log_table(spark, path)
    day = min(part for part, _ in table.snapshot().live)
    (writer, last), = table.snapshot().batches.items()
    # A writer that stops before its commit leaves folders that nobody reads.
    rows = source_tables.read_log_table(spark, path).filter(F.col("event_date") == day)
    table.write_folders(rows, "stopped")
    sink_tables.compact_day(spark, path, day)
    # The last batch comes again after it was merged.
    sink_tables.store_batch(rows, path, last, writer=writer)
    table.vacuum(grace=0)
    folders = sum(part == day for part, _ in table.snapshot().live)
    stored = source_tables.read_log_table(spark, path).filter(F.col("event_date") == day)
    return stored.groupBy(F.regexp_replace("id", "-", "").alias("id"), F.col("event_date").cast("string").alias("day"),
                          "message").agg(F.count("*").alias("times")).withColumn("folders", F.lit(folders))


@query("k6_replayed_ids", with_(oracle.DLQ + """,
raw AS (SELECT count(*) AS n FROM events WHERE event_id % 20 NOT IN (0, 3, 4, 5, 6, 10, 11, 12, 17, 18, 19)),
again AS (SELECT count(*) AS n FROM dlq WHERE kind IN ('log', 'bare', 'failed_batch'))""", """
SELECT raw.n AS raw, again.n AS replayed, raw.n + again.n AS ids FROM raw, again"""))
def replayed_ids(spark, folder):
    """Raw messages without ids of their own and replayed letters in one table: every record has its own id."""
    root = scratch_dir(spark, "ids")
    value = F.regexp_replace(F.col("value").cast("string"), '"id": "[^"]*", ', "")
    raw = inputs.topic_messages(spark, folder).drop("event_id").withColumn("value", F.encode(value, "UTF-8"))
    first = TopicIngest(spark, root, rollups=())
    first.run_batch(raw, 0)
    table = sink_tables.log_table(spark, f"{root}/logs")
    before = table.read().count()
    verdict = replay.with_verdict(dlq.classify(dlq.decode(inputs.dead_letters(spark, folder))))
    TopicIngest(spark, root, topic=DLQ_TOPIC, rollups=()).run_batch(replay.replays(verdict), 0)
    return table.read().agg(
        F.lit(before).cast("bigint").alias("raw"), (F.count("*") - before).alias("replayed"),
        F.countDistinct("id").alias("ids"))


@query("t7_released", with_(oracle.DLQ, """
SELECT part AS partition, off AS offset, CASE WHEN kind IN ('log', 'bare', 'failed_batch')
  THEN 'stored' ELSE 'parked' END AS outcome, CAST(1 AS BIGINT) AS times FROM dlq"""))
def released(spark, folder):
    """A closed gate parks every letter; later the cause is mended and all valid ones are stored, once each."""
    root, name = scratch_dir(spark, "released"), F.format_string("at %d/%d", F.col("partition"), F.col("offset"))
    # Each letter's log names its position, so that the stored record tells it.
    text = F.regexp_replace(F.col("value").cast("string"), '("message":")[^"]*', F.concat(F.lit("$1"), name))
    topic = inputs.dead_letters(spark, folder).withColumn("value", F.encode(text, "UTF-8"))
    append_topic(topic, f"{root}/queue")
    queue, logs = topic_table(spark, f"{root}/queue"), sink_tables.log_table(spark, f"{root}/out/logs")
    job = TriageJob(spark, f"{root}/triage", sample_size=None)
    job.run(queue, logs, inputs.as_of(), 0)
    again = TopicIngest(spark, f"{root}/out", topic=DLQ_TOPIC, rollups=())
    for number in (1, 1, 2):  # the first release is repeated, the last finds nothing more
        job.release(number)
        again.start(job.replay_stream(), f"{root}/checkpoint", available_now=True).awaitTermination()
    at = [F.regexp_extract("message", r"at (\d+)/(\d+)", i) for i in (1, 2)]
    stored = logs.read().select(at[0].cast("int").alias("partition"), at[1].cast("bigint").alias("offset"),
                                F.lit("stored").alias("outcome"))
    parked = job.parked().select("partition", "offset", F.lit("parked").alias("outcome"))
    return stored.unionByName(parked).groupBy("partition", "offset", "outcome").agg(F.count("*").alias("times"))
