"""The commit log: repeats, merges, stops, several writers, retention, statistics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lograil.operators import signals
from lograil.sinks import commits, files, tables as sinks
from lograil.sources import tables
from test_serving import make_logs


def ids(spark, path, version=None):
    return sorted(r["id"] for r in tables.read_log_table(spark, path, version).select("id").collect())


def batches(spark, n=3):
    """Different records in every batch."""
    logs = make_logs(spark, 60 * n, days=3).cache()
    return [logs.filter(F.col("id").substr(1, 1).isin(*digits)) for digits in ("01234", "56789", "abcdef")][:n]


def test_merged_batch_that_repeats(spark, tmp_path):
    path, parts = str(tmp_path / "logs"), batches(spark)
    for i, part in enumerate(parts):
        sinks.store_batch(part, path, i)
    every = sorted(r["id"] for part in parts for r in part.collect())
    table = sinks.log_table(spark, path)
    day = sorted(p for p, _ in table.snapshot().live)[0]
    before = table.snapshot().version
    assert sinks.compact_day(spark, path, day) == before + 1
    sinks.store_batch(parts[2], path, 2)
    sinks.store_batch(parts[0], path, 0)
    assert ids(spark, path) == every == ids(spark, path, before)
    assert len([1 for p, _ in table.snapshot().live if p == day]) == 1
    assert sinks.compact_day(spark, path, day) is None


def test_stops_before_and_after_the_commit(spark, tmp_path, monkeypatch):
    path, parts = str(tmp_path / "logs"), batches(spark)
    sinks.store_batch(parts[0], path, 0)
    sinks.store_batch(parts[1], path, 1)
    every, table = ids(spark, path), sinks.log_table(spark, path)
    day = sorted(p for p, _ in table.snapshot().live)[0]

    def stop(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # written, not committed
        m.setattr(commits.CommitTable, "commit", stop)
        for job in (lambda: sinks.compact_day(spark, path, day), lambda: sinks.store_batch(parts[2], path, 2)):
            with pytest.raises(KeyboardInterrupt):
                job()
    assert ids(spark, path) == every
    sinks.compact_day(spark, path, day)
    sinks.store_batch(parts[2], path, 2)
    with_last = sorted(every + [r["id"] for r in parts[2].collect()])
    assert ids(spark, path) == with_last
    live = len(table.snapshot().live)
    assert table.vacuum(grace=10_000) == [] and len(table.vacuum(grace=0)) > 0
    assert ids(spark, path) == with_last and len(table.snapshot().live) == live and table.vacuum(grace=0) == []


def test_writers_at_once(spark, tmp_path):
    """A batch that is committed while a day is merged stays; of two merges of a day one is refused."""
    path, parts = str(tmp_path / "logs"), batches(spark)
    sinks.store_batch(parts[0], path, 0)
    sinks.store_batch(parts[1], path, 1)
    table = sinks.log_table(spark, path)
    day = sorted(p for p, _ in table.snapshot().live)[0]
    old = [k for k in table.snapshot().live if k[0] == day]
    one, two = (table.write_folders(table._read(old), "merged") for _ in range(2))
    sinks.store_batch(parts[2], path, 2)
    table.commit(one, old)
    with pytest.raises(commits.Conflict):
        table.commit(two, old)
    assert ids(spark, path) == sorted(r["id"] for part in parts for r in part.collect())
    sinks.store_batch(parts[0], path, 0, writer="another stream")
    assert len(ids(spark, path)) == sum(p.count() for p in parts) + parts[0].count()


def test_log_is_read_from_its_newest_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "CHECKPOINT_EVERY", 2)
    path, parts = str(tmp_path / "logs"), batches(spark)
    for i in range(5):
        sinks.store_batch(parts[i % 3], path, i)
    table = sinks.log_table(spark, path)
    listed = files.names(spark, f"{path}/_commits")
    assert [n for n in listed if n.endswith("state")] == [f"{n:020d}.state" for n in (2, 4)]
    for n in (1, 2, 3, 4):  # the newest state and the commit after it are enough
        files.remove(spark, f"{path}/_commits/{n:020d}.json")
    again = table.snapshot()
    assert (again.version, again.batches) == (5, {"stream": 4})
    assert len(ids(spark, path)) == sum(parts[i % 3].count() for i in range(5))


def test_empty_batches_and_tables(spark, tmp_path):
    path = str(tmp_path / "logs")
    assert tables.read_log_table(spark, path).count() == 0
    sinks.store_batch(make_logs(spark, 5).limit(0), path, 0)
    assert sinks.log_table(spark, path).snapshot().batches == {"stream": 0}
    assert tables.read_log_table(spark, path).count() == 0 and sinks.drop_expired_days(spark, path, "2030-01-01") == []


def test_signals_from_statistics(spark, tmp_path):
    """A backfill of old days is fresh; only folders that reach into the window are opened."""
    path = str(tmp_path / "logs")
    logs = make_logs(spark, 300).withColumn("is_parsed", F.expr("CASE WHEN message = 'event 3' THEN 0 ELSE 1 END")).withColumn("ingested_at", F.col("created_at"))
    newest = logs.agg(F.max("created_at")).first()[0]
    sinks.append_logs(logs, path)
    old = make_logs(spark, 20, days=2).withColumns({
        "created_at": F.col("created_at") - F.expr("INTERVAL 90 DAYS"), "ingested_at": F.lit(newest + dt.timedelta(minutes=1)),
        "is_parsed": F.lit(1)})
    sinks.append_logs(old, path)
    as_of = F.lit(newest + dt.timedelta(minutes=2))
    table = sinks.log_table(spark, path)
    got = signals.table_signals(table, as_of)
    want = signals.health_signals(tables.read_log_table(spark, path), as_of)
    assert got.collect() == want.collect() and got.first()["ingestion_lag_seconds"] == 60.0
    opened = [f for f in signals.recent_folders(table, newest).inputFiles()]
    assert opened and all(f"event_date={newest.date()}" in f for f in opened)
