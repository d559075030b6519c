"""Work that grows with the input is dealt to all cores, and no step meets in a task per topic partition."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lograil.functions import jsonx
from lograil.operators import dlq, jsonlog, replay
from lograil.plans import inputs, parsing, streams
from lograil.sinks import files
from lograil.sources import tables as source_tables
from lograil.streaming import ingest as stream
from lograil.streaming.triage import TriageJob, stored_report, write_summary
from test_serving import make_logs, topic_rows
from test_stored import LOG, places


@pytest.fixture
def folder(spark, tmp_path):
    """400 events in a single file of a single piece."""
    rows = [(i, dt.datetime(2024, 1, 1 + i % 5, i % 24), i % 30, "error" if i % 3 else "view", 1.0, '{"k": %d}' % i)
            for i in range(400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_events_are_dealt_to_all_cores(spark, folder):
    cores = spark.sparkContext.defaultParallelism
    for made in (inputs.topic_messages, inputs.request_lines, inputs.clf_lines, inputs.dead_letters):
        rows = made(spark, folder)
        assert rows.count() == 400 and rows.rdd.getNumPartitions() >= cores


def test_stream_takes_three_batches_of_a_file_per_core(spark, folder):
    root = streams.run_ingest(spark, folder, ())
    written = [n for n in files.names(spark, root.removesuffix("out") + "topic") if n.endswith(".parquet")]
    assert len(written) > 3 and source_tables.read_batches(spark, f"{root}/stats").count() <= 3
    assert source_tables.read_batches(spark, f"{root}/stats").agg(F.sum("consumed")).first()[0] == 400


def test_uploads_are_written_at_once_in_order(spark, folder, monkeypatch):
    made, written = inputs.request_lines, []
    monkeypatch.setattr(inputs, "request_lines", lambda *a: made(*a).withColumn("value", _noted(spark, written)("value")))
    got = {r["file"]: r for r in parsing.jsonl_files(spark, folder).collect()}
    assert sorted(got) == [f"upload-{i}.jsonl" for i in range(5)] and all(r["count"] == 80 for r in got.values())
    numbers = [int(m.split()[1]) for m in got["upload-1.jsonl"]["messages"].split(",")]
    assert numbers == sorted(numbers) and {n % 5 for n in numbers} == {1}
    assert written[0].value == 400


def _noted(spark, counters):
    """A function on a text column that counts its calls."""
    counters.append(spark.sparkContext.accumulator(0))
    count = counters[-1]

    def same(text):
        count.add(1)
        return text
    return F.udf(same, "string").asNondeterministic()


def test_committed_offsets_do_not_gather_a_partition_in_a_task(spark):
    topic = topic_rows(spark, [json.dumps(LOG)] * 60)
    committed = spark.createDataFrame([(0, 20)], "partition int, committed_offset long")
    got = dlq.uncommitted(topic, committed)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    kept = topic.filter((F.col("partition") != 0) | (F.col("offset") >= 20))
    assert places(got) == places(kept)


def test_large_samples_are_cut_by_slices(spark, monkeypatch):
    rows = topic_rows(spark, [json.dumps(LOG)] * 200).withColumn("partition", F.expr("int(offset % 3 + offset div 150)"))
    committed = spark.createDataFrame([(0, 31)], "partition int, committed_offset long")
    sizes = (6, 20, 100, 150, 198, 5000)
    ranked = [places(dlq.sample(rows, at, size)) for size in sizes for at in (None, committed)]
    monkeypatch.setattr(dlq, "RANKED_SAMPLE", 5)
    monkeypatch.setattr(dlq, "SLICE", 7)
    sliced = [dlq.sample(rows, at, size) for size in sizes for at in (None, committed)]
    assert [places(s) for s in sliced] == ranked
    assert sliced[0].columns == rows.columns
    assert not places(dlq.sample(rows.limit(0), None, 6))
    # A partition is not ranked whole: what is ranked is joined with its cut first.
    assert all("_cut" in str(s._jdf.queryExecution().optimizedPlan()) for s in sliced)


def test_a_run_checks_each_letter_once(spark, tmp_path, monkeypatch):
    checked, verdict = [], replay.with_verdict
    monkeypatch.setattr(replay, "with_verdict", lambda *a: verdict(*a).withColumn("reason", _noted(spark, checked)("reason")))
    rows = topic_rows(spark, [json.dumps(LOG), "junk"] * 30)
    job = TriageJob(spark, str(tmp_path), sample_size=None)
    job.run(rows, make_logs(spark), inputs.as_of(), 0, force=True)
    assert job.parked().count() == 30 and checked[0].value == 60


def test_a_run_caches_no_letters(spark, tmp_path, monkeypatch):
    """Letters of a run are read from written tables, which are gone after it; its rows stay as they are."""
    plans, add = [], TriageJob._add

    def noted(job, rows, name, run_id):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return add(job, rows, name, run_id)

    monkeypatch.setattr(TriageJob, "_add", noted)
    rows = topic_rows(spark, [json.dumps(LOG)] * 4 + ["junk", ""])
    root, logs = str(tmp_path), make_logs(spark)
    for run_id, force, sent in ((0, False, 0), (1, True, 4)):
        job = TriageJob(spark, f"{root}/{run_id}", sample_size=None)
        report = job.run(rows, logs, F.lit("2024-01-01").cast("timestamp"), run_id, force=force).first()
        assert (report["sampled_count"], job.parked().count()) == (6, 6 - sent)
        assert files.names(spark, f"{root}/{run_id}/work") == []
    assert len(plans) == 4 and not any("InMemoryTableScan" in plan for plan in plans)


def test_cached_batches_hold_few_rows(spark, monkeypatch):
    """A task's serializer keeps its last hundred batches, so a batch must be small."""
    with stream.uncompressed(spark):
        kept = spark.range(1000, numPartitions=1).persist()
    assert kept.count() == 1000 and spark.conf.get("spark.sql.inMemoryColumnarStorage.batchSize") == "10000"
    batches = kept._jdf.queryExecution().withCachedData().cacheBuilder().cachedColumnBuffers().count()
    kept.unpersist()
    assert batches >= 4


def test_a_summary_classifies_each_letter_once(spark, tmp_path, monkeypatch):
    classified, classify = [], dlq.classify
    monkeypatch.setattr(dlq, "classify", lambda rows: classify(rows).withColumn(
        "error_class", _noted(spark, classified)("error_class")))
    rows = topic_rows(spark, [json.dumps(LOG), "junk"] * 30)
    write_summary(rows, str(tmp_path), "stream", 0)
    assert classified[0].value == 60
    got = {r["error_class"]: r for r in stored_report(spark, str(tmp_path)).collect()}
    assert {name: r["count"] for name, r in got.items()} == {dlq.DATA: 30, dlq.UNKNOWN: 30}
    assert all(len(r["sample_messages"]) == 3 for r in got.values())


def test_a_message_is_typed_by_its_members_and_kept_without_its_text(spark, tmp_path, monkeypatch):
    odd = ["{}", "[1]", "null", "1", '"x"', "x", json.dumps(LOG | {"metadata": None}), json.dumps(LOG | {"metadata": '{"k": 1}'}),
           json.dumps(LOG | {"metadata": "[1]"}), json.dumps(LOG | {"metadata": [1]}), json.dumps(LOG | {"metadata": {"k": 1}}),
           json.dumps(LOG | {"id": "0123456789abcdef" * 2}), json.dumps(LOG | {"id": "0123456789ABCDEF" * 2})]
    rows = topic_rows(spark, odd)
    parsed = jsonlog.parse_messages(rows)
    plan = parsed._jdf.queryExecution().analyzed().toString()
    # The type of a whole document, and texts of what is no text as a rule, are not made.
    assert "schema_of_variant(_v#" not in plan and "StructField(http_status,StringType" not in plan
    got = [(r["errors"], r["metadata"], r["id"]) for r in parsed.orderBy("partition", "offset").collect()]
    bad, uuid = "metadata: must be a JSON object", "01234567-89ab-cdef-0123-456789abcdef"
    want = {"[1]": jsonlog.NOT_OBJECT, "null": jsonlog.NOT_OBJECT, "1": jsonlog.NOT_OBJECT, '"x"': jsonlog.NOT_OBJECT,
            "x": jsonlog.NOT_JSON, odd[8]: bad, odd[9]: bad}
    values = [r["value"].decode() for r in rows.orderBy("partition", "offset").collect()]
    assert [e for e, _, _ in got] == [want.get(v) for v in values]
    assert {got[values.index(odd[i])][1] for i in (7, 10)} == {'{"k":1}'} and got[values.index(odd[6])][1] == "{}"
    assert {got[values.index(odd[i])][2] for i in (11, 12)} == {uuid}

    kept, refuse = [], stream.rejected
    monkeypatch.setattr(stream, "rejected", lambda done, *a: (kept.append([
        (r["errors"] is None, r["value"] is None) for r in done.collect()]), refuse(done, *a))[1])
    stream.TopicIngest(spark, str(tmp_path), rollups=()).run_batch(rows, 0)
    assert len(kept[0]) == len(odd) and all(good == bare for good, bare in kept[0])


def test_a_message_is_read_once_and_carries_no_document_along(spark, tmp_path):
    odd = ["{}", ' \t{"a": "x", "b": 1}', '[{"a": 1}]', "null", "1", "x", '{"a": 1', "{'a': 1}", '{"a": NaN}', '{"a": 1, "a": "y"}',
           '{"a": null, "b": {"c": [1]}}', '{"a": 1.50, "b": true} x', '{"c": ' + "9" * 1200 + "}", '{"a": "' + "z" * 1200 + '"}', None]
    rows = spark.createDataFrame(list(enumerate(odd)), "i int, value string")
    read, m, valid, helpers = jsonx.with_text_members(rows, F.col("value"), ["a", "b"], texts=["a"])
    assert read._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1 and helpers[0] in read.columns
    whole, n, _ = jsonx.with_members(rows.withColumn("_v", jsonx.parse(F.col("value"))), F.col("_v"), ["a", "b"])
    seen = lambda x: [c for k in "ab" for c in (x[k].shape, x[k].cast("string"), F.to_json(x[k].value))]
    got = read.select("i", F.when(valid, F.struct(valid, *seen(m)))).orderBy("i").collect()
    want = whole.select("i", F.when(F.col("_v").isNotNull(), F.struct(F.lit(True), *seen(n)))).orderBy("i").collect()
    assert [tuple(r[1] or ()) for r in got] == [tuple(r[1] or ()) for r in want]

    parsed = stream.TopicIngest(spark, str(tmp_path), rollups=()).prepare(topic_rows(spark, [json.dumps(LOG)]))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and " AS _v#" not in plan and "key#" not in plan.splitlines()[0]
    with stream.uncompressed(spark):
        kept = parsed.persist()
    assert kept.collect()[0]["errors"] is None and spark.conf.get("spark.sql.inMemoryColumnarStorage.compressed") == "true"
    kept.unpersist()
