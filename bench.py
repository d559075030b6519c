"""Benchmark of the headline jobs. Prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local threads).
Each job but the stream runs once to warm up and is then timed; results go to the no-op sink.
"""

import datetime as dt
import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from lograil.operators import dispatch, dlq, rollups, search, signals  # noqa: E402
from lograil.plans import inputs  # noqa: E402
from lograil.plans.streams import run_ingest  # noqa: E402
from lograil.session import local_session, scratch_dir  # noqa: E402
from lograil.sinks.tables import append_logs  # noqa: E402
from lograil.sources.tables import read_log_table  # noqa: E402


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cpus=cpus, shuffle_partitions=cpus)

    # Raw inputs and the stored table exist before the clock starts.
    root = scratch_dir(spark, "bench")
    sources = {"clf": inputs.clf_lines, "syslog": inputs.syslog_lines,
               "requests": inputs.request_lines, "messages": inputs.topic_messages,
               "letters": inputs.dead_letters}
    for name, build in sources.items():
        build(spark, folder).repartition(cpus).write.parquet(f"{root}/{name}")
    append_logs(inputs.logs(spark, folder), f"{root}/logs")
    raw = {name: spark.read.parquet(f"{root}/{name}") for name in sources}
    rows = raw["clf"].count()
    logs = read_log_table(spark, f"{root}/logs")
    classified = dlq.classify(dlq.decode(raw["letters"]))
    received = {"ingested_at": F.col("received"), "id_from": ["event_id"]}
    wanted = search.Search(
        time_from=dt.datetime(2024, 1, 10), time_to=dt.datetime(2024, 1, 20), query="user 3",
        level="INFO", limit=100)

    jobs = {
        "parse_clf": lambda: drain(dispatch.run_text_job(raw["clf"], "clf", **received)[0]),
        "parse_syslog": lambda: drain(
            dispatch.run_text_job(raw["syslog"], "syslog", **received)[0]),
        "parse_requests": lambda: drain(
            dispatch.run_request_job(raw["requests"], default_source="file",
                                     default_source_service="unknown", **received)[0]),
        "parse_messages": lambda: drain(dispatch.run_message_job(
            raw["messages"], ingested_at=F.col("timestamp"),
            id_from=["partition", "offset"])[0]),
        "store_logs": lambda: append_logs(logs, scratch_dir(spark, "bench-store")),
        "error_type_summary": lambda: drain(rollups.error_type_summary(logs)),
        "service_error_matrix": lambda: drain(rollups.service_error_matrix(logs)),
        "service_health": lambda: drain(rollups.service_health(logs)),
        "top_errors_per_service": lambda: drain(
            rollups.top_errors_per_service(rollups.service_error_matrix(logs))),
        "search_page": lambda: search.page(logs, wanted).collect(),
        "search_total": lambda: search.total(logs, wanted).collect(),
        "deep_page": lambda: search.deep_page(
            logs, search.Search(offset=rows // 2), max_skip=1000).collect(),
        "health_signals": lambda: signals.health_signals(logs, inputs.as_of()).collect(),
        "triage_report": lambda: drain(dlq.triage_report(classified)),
    }
    times = {}
    for name, job in jobs.items():
        job()
        started = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - started, 3)
    started = time.perf_counter()
    # Three micro-batches of as many files as there are threads, with all default rollups; not warmed up.
    run_ingest(spark, folder, files=3 * cpus, per_batch=cpus)
    times["stream_ingest"] = round(time.perf_counter() - started, 3)

    parse = [n for n in times if n.startswith("parse_")]
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"), "cpus": cpus,
        "rows_per_input": rows,
        "rows_per_second": {n: int(rows / times[n]) for n in [*parse, "stream_ingest"]},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
