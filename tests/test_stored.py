"""Stored topics, monthly rollups, released letters: what is opened, and what a repeat does."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lograil.operators import dlq, replay, search
from lograil.operators.rollups import ROLLUPS
from lograil.operators.search import Search
from lograil.plans import inputs
from lograil.sinks import tables as sinks, topics
from lograil.sources import topics as sources
from lograil.streaming import rollups, triage
from lograil.streaming.ingest import TopicIngest
from lograil.streaming.triage import TriageJob
from test_serving import make_logs, topic_rows

LOG = {"source": "http", "source_service": "s", "level": "error", "message": "m"}


def places(df):
    return sorted(map(tuple, df.select("partition", "offset").collect()))


@pytest.fixture
def queue(spark, tmp_path, monkeypatch):
    """600 letters of two partitions in segments of 50 offsets, written in three rounds."""
    monkeypatch.setattr(topics, "SEGMENT", 50)
    rows = topic_rows(spark, [json.dumps({**LOG, "message": f"m{i}"}) for i in range(600)])
    rows = rows.withColumn("offset", F.expr("offset div 2")).cache()
    for low, high in ((0, 90), (90, 100), (100, 300)):
        topics.append_topic(rows.filter((F.col("offset") >= low) & (F.col("offset") < high)), str(tmp_path / "queue"))
    return topics.topic_table(spark, str(tmp_path / "queue")), rows


def test_reading_from_offsets_opens_later_segments(spark, queue):
    table, rows = queue
    committed = spark.createDataFrame([(0, 120), (1, 290)], "partition int, committed_offset long")
    got = sources.read_stored(table, committed)
    assert places(got) == places(dlq.uncommitted(rows, committed))
    opened = {f.split("segment=")[1].split("/")[0] for f in got.inputFiles()}
    assert opened == {"p00000-000000000002", "p00000-000000000003", "p00000-000000000004", "p00000-000000000005",
                      "p00001-000000000005"}
    assert places(sources.read_stored(table)) == places(rows)
    assert "offset" in str(got._jdf.queryExecution().executedPlan()).split("PushedFilters")[1]


def test_front_opens_what_a_sample_needs(spark, queue):
    table, rows = queue
    committed = spark.createDataFrame([(0, 120)], "partition int, committed_offset long")
    for size in (1, 10, 60, 5000):
        front = sources.read_front(table, committed, size)
        assert places(dlq.sample(front, committed, size)) == places(dlq.sample(rows, committed, size))
    opened = {f.split("segment=")[1].split("/")[0] for f in sources.read_front(table, committed, 10).inputFiles()}
    assert opened == {"p00000-000000000002", "p00001-000000000000"}


def test_ends_come_from_the_commit_log(spark, queue):
    table, rows = queue
    assert sorted(map(tuple, sources.stored_ends(table).collect())) == [(0, 300), (1, 300)]
    plan = sources.stored_ends(table)._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower()
    committed = spark.createDataFrame([(1, 40)], "partition int, committed_offset long")
    assert dlq.backlog_behind(sources.stored_ends(table), committed).collect() == dlq.backlog(rows, committed).collect()


def test_repeated_run_and_release_write_once(spark, queue, tmp_path, monkeypatch):
    """A run that stops before its offsets is repeated over a longer queue: every letter has one outcome."""
    table, rows = queue
    job, logs = TriageJob(spark, str(tmp_path / "triage"), sample_size=40), sinks.log_table(spark, str(tmp_path / "logs"))
    with monkeypatch.context() as m:
        m.setattr(replay, "commit_points", lambda df: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            job.run(table, logs, inputs.as_of(), 0, force=True)
    job.sample_size = 60
    job.run(table, logs, inputs.as_of(), 0, force=True)
    stored = job._stored("replayed")
    assert stored.count() == 60 == len(set(places(stored)))
    job.sample_size = None
    job.run(table, logs, inputs.as_of(), 1)  # the gate is closed
    assert job.parked().count() == 540 and job.release(7, reason="no such reason") == 0
    assert job.release(2, error_class="unknown") == 540 == job.release(2, error_class="unknown")
    assert job.parked().count() == 0 and len(set(places(job._stored("replayed")))) == 600


def test_replays_never_share_ids_with_raw_messages(spark, tmp_path):
    raw = topic_rows(spark, [json.dumps({**LOG, "message": f"raw {i}"}) for i in range(20)])
    letters = topic_rows(spark, [json.dumps({**LOG, "message": f"letter {i}"}) for i in range(20)])
    root = str(tmp_path)
    TopicIngest(spark, root, rollups=()).run_batch(raw.withColumn("topic", F.lit("logs.raw")), 0)
    rows = replay.replays(replay.with_verdict(dlq.classify(dlq.decode(letters))))
    for _ in range(2):
        TopicIngest(spark, root, topic=sources.DLQ_TOPIC, rollups=()).run_batch(rows, 0)
    got = sinks.log_table(spark, f"{root}/logs").read()
    assert got.count() == 40 == got.select("id").distinct().count()


def test_months_of_a_rollup(spark, tmp_path):
    """A month's read opens that month; merging and retiring months keeps the others."""
    root, logs = str(tmp_path), make_logs(spark, 300, days=60).withColumn("error_type", F.lit("Late")).cache()
    for name, (partial, merge) in ROLLUPS.items():
        for batch, part in enumerate((logs.filter("level = 'FATAL'"), logs.filter("level <> 'FATAL'"))):
            for _ in range(2):  # a batch that repeats adds nothing
                rollups.write_rollup(part, root, name, "w", batch)
        want = partial(logs) if name != "error_types" else None
        months = ["2024-01", "2024-02", "2024-03"]
        for _ in range(2):  # before and after merging
            whole = rollups.read_rollup(spark, root, name)
            if want is not None:
                assert sorted(map(str, whole.collect())) == sorted(map(str, want.select(whole.columns).collect()))
            opened = rollups.read_rollup(spark, root, name, ["2024-02"])
            assert {f.split("month=")[1][:7] for f in opened.inputFiles()} <= {"2024-02"}
            rollups.compact_rollup(spark, root, name)
        table = rollups.rollup_table(spark, root, name)
        assert sorted(m for m, _ in table.snapshot().live) in (months, months[:2])
        assert rollups.retire_rollup(spark, root, name, "2024-02") == ["2024-01"]
        assert "2024-01" not in {m for m, _ in table.snapshot().live}
    assert rollups.read_rollup(spark, root, "service_health").count() < 300


def test_totals_and_pages_from_the_rollup(spark, tmp_path):
    """A total over whole hours opens no file of the log table; a page opens the days that it lies in."""
    logs, path = make_logs(spark, 400, days=6).cache(), str(tmp_path / "logs")
    sinks.append_logs(logs, path)
    rollups.write_rollup(logs, str(tmp_path), "hourly_volume", "w", 0)
    stored, volume = sinks.log_table(spark, path).read(), rollups.read_rollup(spark, str(tmp_path), "hourly_volume")
    for wanted in (Search(), Search(level="ERROR"), Search(time_from=dt.datetime(2024, 1, 24)),
                   Search(source="kafka", time_from=dt.datetime(2024, 1, 24, 8))):
        got = search.rolled_total(volume, stored, wanted)
        assert "event_date" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.collect() == search.total(logs, wanted).collect()
    cut = Search(time_from=dt.datetime(2024, 1, 23, 8, 53, 30), time_to=dt.datetime(2024, 1, 26, 8, 53, 32))
    assert search.rolled_total(volume, stored, cut).collect() == search.total(logs, cut).collect()
    for offset in (0, 100, 250, 399, 400):
        wanted = Search(offset=offset, limit=20)
        got = search.deep_page(stored, wanted, max_skip=2, volume=volume)
        assert [r["id"] for r in got.collect()] == [r["id"] for r in search.page(logs, wanted).collect()]


def test_a_field_is_read_alone(spark, tmp_path):
    logs, path = make_logs(spark, 200), str(tmp_path / "logs")
    body = F.expr("""concat('{"k": ', cast(message as string) = 'event 3', ', "n": ', length(message) + day(created_at),
        ', "deep": {"er": "', message, '"}, "long": "', repeat('x', 500), '"}')""")
    logs = logs.withColumn("metadata", body)
    sinks.append_logs(logs, path, fields=True)
    stored = sinks.log_table(spark, path, fields=True).read()
    found = stored.filter(search.field(stored, "n", "bigint") == 32).select("id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "fields:struct<0:bigint>" in plan and "metadata" not in plan
    assert sorted(found.collect()) == sorted(logs.filter(search.field(logs, "n", "bigint") == 32).select("id").collect()) != []
    deep = search.field(stored, "deep.er")
    assert stored.filter(deep == "event 3").count() == logs.filter("message = 'event 3'").count() > 0
    assert sinks.log_table(spark, path).read().columns == sinks.log_table(spark, path, fields=True).read().drop("fields").columns
    for name in ("", "a'b", "x.", "$"):
        with pytest.raises(ValueError):
            search.field(stored, name)


def test_stream_keeps_triage_partials(spark, tmp_path):
    """The report from what the stream kept equals the report over its letters; a repeat changes nothing."""
    job = TopicIngest(spark, str(tmp_path), rollups=(), summaries=True)
    good = json.dumps(LOG)
    for batch, values in ((0, [good, "junk", "{}"]), (1, ["x", good]), (1, ["x", good])):
        rows = topic_rows(spark, values).withColumn("offset", F.col("offset") + 100 * batch)
        job.run_batch(rows, batch)
    kept = triage.stored_report(spark, f"{tmp_path}/triage")
    want = dlq.triage_report(dlq.classify(dlq.decode(job.dead_letters().read())))
    columns = ["error_class", "count", "percentage", "top_errors"]
    assert sorted(kept.select(columns).collect()) == sorted(want.select(columns).collect()) != []
    assert sum(r["count"] for r in kept.collect()) == 3
