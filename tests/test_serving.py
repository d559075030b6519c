"""Sources, sinks, search, rollups, triage and streams on small fixtures."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lograil.operators import dispatch, dlq, ingest, jsonlog, replay, rollups, search, validate
from lograil.operators.search import Search
from lograil.schema import LOG_COLUMNS, TOPIC_SCHEMA
from lograil.sinks import tables as sinks, topics
from lograil.sources import raw, tables, topics as topic_sources
from lograil.streaming.ingest import TopicIngest
from lograil.streaming.rollups import compact_rollup, read_rollup

INGESTED = "2024-02-01 00:00:00"


def make_logs(spark, count=300, days=5):
    df = spark.range(count).select("id", F.expr(f"""to_json(named_struct(
        'source', element_at(array('http', 'kafka'), cast(id % 2 + 1 AS int)),
        'source_service', concat('s', id % 3), 'message', concat('event ', id % 7),
        'level', element_at(array('ERROR', 'FATAL', 'INFO'), cast(id % 3 + 1 AS int)),
        'created_at', 1706000000 + (id % {days}) * 86400 + (id div 10)))""").alias("value"))
    logs, bad = dispatch.run_message_job(
        df.withColumnRenamed("id", "n"), ingested_at=INGESTED, id_from=["n"])
    assert bad.count() == 0
    return logs


def test_line_numbers_across_file_splits(spark, tmp_path):
    """Numbers count the non-blank lines of a file, also where many tasks read it."""
    text = "".join(f"line {i}\n" + ("\n" if i % 3 == 0 else "") for i in range(1, 2001))
    (tmp_path / "a.log").write_text(text)
    (tmp_path / "b.txt").write_text("only\n")
    (tmp_path / "c.csv").write_text("ignored\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = raw.read_raw_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 8
        rows = raw.with_line_numbers(lines, lines).select("value", "line").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 2001
    assert all(r["value"] in (f"line {r['line']}", "only") for r in rows)


def test_ids_do_not_depend_on_what_else_is_read(spark, tmp_path):
    line = "<134>1 2024-01-15T10:30:00Z h a - - - m"
    for name, n in (("a", 40), ("b", 5), ("c", 900)):
        (tmp_path / f"{name}.log").write_text("\n".join(f"{line}{i}" for i in range(n)) + "\n")

    def ids(paths):
        lines = raw.numbered(raw.read_raw_lines(spark, paths))
        logs, _ = dispatch.run_text_job(lines, "syslog", source="file", id_from=raw.LINE_KEY,
                                        ingested_at=dt.datetime(2024, 1, 16))
        return {r["message"]: r["id"] for r in logs.select("message", "id").collect()}

    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        alone = ids(str(tmp_path / "b.log"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    together = spark.read.text(str(tmp_path / "b.log")).count()
    every = raw.numbered(raw.read_raw_lines(spark, str(tmp_path / "*.log")))
    logs, _ = dispatch.run_text_job(every, "syslog", source="file", id_from=raw.LINE_KEY, keep=["file"],
                                    ingested_at=dt.datetime(2024, 1, 16))
    found = {r["message"]: r["id"] for r in logs.filter(F.col("file").endswith("/b.log")).collect()}
    assert len(alone) == together == 5 and found == alone


def test_rows_of_both_outcomes_from_one_pass(spark, tmp_path):
    """Records, rejects and report come from one stored parse; the lines are read once."""
    (tmp_path / "x.jsonl").write_text("\n".join(
        '{"source":"s","source_service":"v","level":"info","message":"m%d"}' % i if i % 3 else "bad %d" % i
        for i in range(30)))
    lines = raw.numbered(raw.read_jsonl_lines(spark, str(tmp_path / "x.jsonl")))
    done = validate.finish(jsonlog.parse_requests(lines), ingested_at=dt.datetime(2024, 1, 16),
                           id_from=raw.LINE_KEY, promoted=True, meta="_meta")
    stored = dispatch.store_outcome(done, str(tmp_path / "out"), keep=["file", "line"])
    plan = validate.accepted(stored)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_error" in plan and plan.count("Scan parquet") == 1
    assert validate.accepted(stored).count() == 20 and validate.rejected(stored).count() == 10
    report = ingest.ingest_report(stored).first()
    assert (report["count"], report["success"], report["failed"]) == (30, 20, 10)
    assert [e["line"] for e in report["errors"]] == list(range(1, 31, 3))


def test_report_keeps_first_twenty_errors(spark):
    lines = spark.range(1, 501).select(
        F.lit("f.log").alias("file"), F.col("id").alias("line"),
        F.expr("CASE WHEN id % 2 = 0 THEN 'bad' END").alias("errors"))
    row = ingest.ingest_report(lines).collect()[0]
    assert (row["count"], row["success"], row["failed"]) == (500, 250, 250)
    assert [e["line"] for e in row["errors"]] == list(range(2, 42, 2))


def test_per_task_rank_cut_in_plans(spark):
    """Rank limits are applied before the shuffle as well, so a hot group stays small."""
    lines = spark.range(100).selectExpr(
        "concat('f', id % 3) AS file", "id AS line", "concat('bad ', id) AS errors")
    plan = ingest.first_errors(lines)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_table_partitions_prune_and_expire(spark, tmp_path):
    path = str(tmp_path / "logs")
    logs = make_logs(spark)
    sinks.append_logs(logs, path)
    stored = tables.read_log_table(spark, path)
    assert stored.count() == 300 and stored.columns[:24] == LOG_COLUMNS
    day = dt.datetime(2024, 1, 24)
    found = search.matching(stored, Search(time_from=day, time_to=day + dt.timedelta(hours=20)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    expired = sinks.drop_expired_days(spark, path, "2024-01-25 12:00:00", days=1)
    assert expired == ["2024-01-23"]
    assert tables.read_log_table(spark, path).filter("event_date < '2024-01-24'").count() == 0


def test_deep_page_equals_page(spark):
    logs = make_logs(spark, 400, days=2).cache()
    for offset in (0, 1, 57, 199, 200, 399, 400, 5000):
        wanted = Search(offset=offset, limit=30)
        plain = [r["id"] for r in search.page(logs, wanted).collect()]
        assert [r["id"] for r in search.deep_page(logs, wanted, max_skip=2).collect()] == plain


def test_deep_page_prunes_days(spark, tmp_path):
    path = str(tmp_path / "deep")
    logs = make_logs(spark)
    sinks.append_logs(logs, path)
    stored = tables.read_log_table(spark, path)
    wanted = Search(offset=250, limit=10)
    got = search.deep_page(stored, wanted, max_skip=2)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "LessThan(created_at" in plan
    assert [r["id"] for r in got.collect()] == [r["id"] for r in search.page(logs, wanted).collect()]


def test_every_search_checks_its_parameters(spark):
    logs = make_logs(spark, 5)
    for find in (search.page, search.total, search.matching, search.deep_page):
        with pytest.raises(ValueError):
            find(logs, Search(limit=10**9))


def test_rollup_before_the_first_batch(spark, tmp_path):
    assert read_rollup(spark, str(tmp_path), "service_health").count() == 0


def test_spark_write_errors_are_storage_failures(spark, tmp_path):
    """A real writer that fails: its letters name the storage, without the JVM's stack trace."""
    good = json.dumps({"source": "http", "source_service": "s", "level": "error", "message": "m"})
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "logs").write_text("a file where the table should be")
    job = TopicIngest(spark, str(tmp_path / "out"), rollups=(), pause=lambda seconds: None)
    job.run_batch(topic_rows(spark, [good, good, "junk"]), 0)
    letters = [json.loads(bytes(r["value"])) for r in job.dead_letters().read().collect()]
    assert sorted(x["error_type"] for x in letters) == ["clickhouse_insert_failure"] * 2 + ["message_parse_error"]
    assert all(len(x["error_message"]) < 400 and "\n" not in x["error_message"] for x in letters)


def test_repeated_batch_adds_nothing(spark, tmp_path):
    path, logs = str(tmp_path / "t"), make_logs(spark, 60)
    for batch in (0, 1, 1):
        sinks.store_batch(logs, path, batch)
    stored = tables.read_log_table(spark, path)
    assert stored.count() == 120
    days = stored.select("event_date").distinct().count()
    assert len(stored.inputFiles()) <= 2 * days
    day = str(stored.agg(F.min("event_date")).first()[0])
    sinks.compact_day(spark, path, day)
    assert tables.read_log_table(spark, path).count() == 120
    assert len([1 for part, _ in sinks.log_table(spark, path).snapshot().live if part == day]) == 1


def test_search_parameters():
    now = dt.datetime(2024, 1, 31)
    filled = Search(level="warning").checked(now)
    assert (filled.level, filled.time_to, filled.limit) == ("WARNING", now, 100)
    assert filled.time_from == now - dt.timedelta(hours=24)
    for bad in (dict(limit=0), dict(limit=1001), dict(offset=-1), dict(query="x" * 1001)):
        with pytest.raises(ValueError):
            Search(**bad).checked(now)
    Search(limit=1000, query="x" * 1000).checked(now)


def test_search_text_is_a_value(spark):
    logs = make_logs(spark, 20)
    assert search.matching(logs, Search(query="' OR 1=1 --", source="x' OR 'a'='a")).count() == 0


def test_top_messages_break_ties_by_text(spark):
    counts = spark.createDataFrame(
        [("k", m, n) for m, n in (("b", 2), ("a", 2), ("c", 5), ("d", 1))], "key string, message string, n long")
    rows = rollups.top_messages(counts, ["key"]).orderBy("rank").collect()
    assert [r["message"] for r in rows] == ["c", "a", "b"]


def topic_rows(spark, values, headers=None):
    return spark.createDataFrame(
        [(None, bytearray(v, "utf8"), "t", i % 2, i, dt.datetime(2024, 1, 1, 0, i // 60, i % 60), 0,
          [(k, bytearray(h, "utf8")) for k, h in (headers or {}).get(i, [])])
         for i, v in enumerate(values)], TOPIC_SCHEMA)


@pytest.mark.parametrize("text, wanted", [
    ("Connection timeout to store", "infra/transient"), ("connection refused", "infra/transient"),
    ("got 503", "infra/transient"), ("Network error", "infra/transient"),
    ("code 15030", "unknown"), ("Unrecognized column 'x'", "storage/schema/config"),
    ("Table logs doesn't exist", "storage/schema/config"),
    ("Access denied", "storage/schema/config"), ("Invalid JSON", "data/parsing"),
    ("malformed line", "data/parsing"), ("timeout: unknown column", "infra/transient"),
    ("something else", "unknown")])
def test_classes(spark, text, wanted):
    df = topic_rows(spark, ["{}"], {0: [("error_message", text)]})
    assert dlq.classify(dlq.decode(df)).first()["error_class"] == wanted


def test_value_without_json_is_a_data_error(spark):
    long_json = json.dumps({"a": "x" * 5000})
    rows = dlq.classify(dlq.decode(topic_rows(spark, ["junk", "", long_json]))).collect()
    assert [r["error_class"] for r in rows] == ["data/parsing", "unknown", "unknown"]


@pytest.mark.parametrize("shares, replays", [
    ((85, 5, 10, 0), True), ((70, 10, 20, 0), True), ((70, 25, 5, 0), False),
    ((60, 0, 40, 0), False), ((10, 80, 10, 0), False), ((0, 0, 0, 0), False)])
def test_replay_gate(spark, shares, replays):
    total = sum(shares)
    counts = spark.createDataFrame(
        [(c, n, n / total) for c, n in zip(dlq.CLASSES, shares) if n],
        "error_class string, count long, percentage double")
    row = replay.replay_gate(dlq.dominant_class(counts)).first()
    assert row["should_replay"] is replays
    if total == 0:
        assert row["dominant_class"] == "unknown" and row["sampled_count"] == 0


def test_ties_go_to_the_first_class(spark):
    counts = spark.createDataFrame(
        [(c, 5, 0.25) for c in reversed(dlq.CLASSES)],
        "error_class string, count long, percentage double")
    assert dlq.dominant_class(counts).first()["dominant_class"] == dlq.INFRA


def test_stream_retry_and_repeat(spark, tmp_path):
    """A failing store ends in the dead-letter queue; a repeated batch is counted once."""
    good = json.dumps({"source": "http", "source_service": "s", "level": "error", "message": "m",
                       "created_at": "2024-01-01T00:00:00Z"})
    batch = topic_rows(spark, [good, good, "junk"])
    pauses, calls = [], []

    def flaky(logs, path, batch_id):
        calls.append(batch_id)
        if batch_id == 1:
            raise OSError("disk is gone")
        if len(calls) == 1:
            raise RuntimeError("once")
        sinks.store_batch(logs, path, batch_id)

    root = str(tmp_path / "out")
    job = TopicIngest(spark, root, store=flaky, pause=pauses.append,
                      rollups=("service_health", "error_messages"))
    job.run_batch(batch, 0)
    job.run_batch(batch, 0)
    job.run_batch(batch, 1)
    assert pauses == [1, 1, 2]
    assert tables.read_log_table(spark, f"{root}/logs").count() == 2
    letters = job.dead_letters().read()
    types = {r["t"]: r["n"] for r in letters.groupBy(
        F.get_json_object(F.col("value").cast("string"), "$.error_type").alias("t")).agg(F.count("*").alias("n"))
        .collect()}
    assert types == {"message_parse_error": 2, "clickhouse_insert_failure": 2}
    stats = {r["batch_id"]: r for r in tables.read_batches(spark, f"{root}/stats").collect()}
    assert (stats[1]["status"], stats[1]["written"], stats[1]["failed_attempts"]) == ("dlq", 0, 3)
    compact_rollup(spark, root, "service_health")
    assert read_rollup(spark, root, "service_health").first()["log_count"] == 2


def test_kafka_options_and_keys(spark):
    options = topic_sources.kafka_options("host:9092", "logs.raw")
    assert options["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in options
    assert topic_sources.kafka_options("h", "t", max_records=5)["maxOffsetsPerTrigger"] == "5"
    committed = spark.createDataFrame([(1, 7)], "partition int, committed_offset long")
    assert json.loads(topic_sources.starting_offsets("t", committed, 2)) == {"t": {"0": -2, "1": 7}}
    row = topics.log_messages(make_logs(spark, 1)).first()
    assert row["key"] == "s0" and list(json.loads(row["value"])) == LOG_COLUMNS
