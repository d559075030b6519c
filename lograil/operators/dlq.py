"""Dead-letter triage: decoding, unifying, classifying and summarising dead letters.

Input is a topic frame: key, value, partition, offset, timestamp and headers. All steps work on
the whole queue or on a bounded sample of it, as the caller likes.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from lograil.functions import jsonx, times
from lograil.functions.text import blank_to_null, pinned

SAMPLE_SIZE = 50
PREVIEW_CHARS = 4096
TOP_REASONS = 5
SAMPLE_MESSAGES = 3

INFRA = "infra/transient"
STORAGE = "storage/schema/config"
DATA = "data/parsing"
UNKNOWN = "unknown"
# The classes in their order of precedence.
CLASSES = [INFRA, STORAGE, DATA, UNKNOWN]

# Error text patterns per class, tried in this order, ignoring case.
PATTERNS = {
    INFRA: [
        r"timeout", r"timed out", r"connection", r"temporarily disabled", r"\b502\b", r"\b503\b",
        r"\b504\b", r"upstream timed out", r"connection refused", r"connection reset",
        r"network error",
    ],
    STORAGE: [
        r"unrecognized column", r"unknown column", r"table.*doesn't exist", r"access denied",
        r"authentication", r"permission denied", r"schema", r"type mismatch", r"cannot parse",
    ],
    DATA: [
        r"invalid json", r"json decode", r"malformed", r"validation error", r"parse error",
        r"decode error",
    ],
}

# Headers that may tell the error, in order of preference, and all that are read.
ERROR_HEADERS = ["error_message", "error", "exception"]
CLASSIFIED_HEADERS = ["error", "exception", "reason", "error_message"]

NOT_JSON_REASON = "JSON decode error"


def decode_headers(headers: Column) -> Column:
    """List of (key, bytes) to a map of text; a repeated key keeps its last value."""
    pairs = F.transform(headers, lambda h: F.struct(
        h["key"], F.coalesce(F.make_valid_utf8(h["value"].cast("string")), F.lit(""))))
    return F.coalesce(F.map_from_entries(pairs),
                      F.create_map().cast("map<string,string>"))


def decode(topic: DataFrame) -> DataFrame:
    """Topic rows to dead letters: text value, preview, parsed value, headers and error text."""
    value = F.make_valid_utf8(F.col("value").cast("string"))
    df = topic.select(
        "partition", "offset", F.col("key").cast("string").alias("key"), "timestamp",
        decode_headers(F.col("headers")).alias("headers"), value.alias("value"))
    df = df.withColumn("_v", jsonx.parse(F.col("value")))
    error = {k: jsonx.member(jsonx.child(F.col("_v"), k)) for k in ("error_message", "error_type")}
    header = [blank_to_null(F.try_element_at("headers", F.lit(h))) for h in ERROR_HEADERS]
    return df.withColumns({
        "value_preview": F.substring("value", 1, PREVIEW_CHARS),
        "value_json": F.to_json("_v"),
        "error_text": F.coalesce(
            *header, *[blank_to_null(e.text()) for e in error.values()]),
    })


_ENVELOPE_KEYS = [
    "dlq_id", "id", "dlq_timestamp", "created_at", "error_message", "error_type", "source",
    "raw_payload", "original_log", "message",
]


def unify(dead: DataFrame) -> DataFrame:
    """Add the common dead-letter columns, whichever of the four shapes a value has."""
    v = F.col("_v")
    df, m, helpers = jsonx.with_members(
        dead, v, _ENVELOPE_KEYS, texts=[k for k in _ENVELOPE_KEYS if k != "original_log"])
    raw = m["raw_payload"]
    envelope = m["error_message"].is_text & raw.present
    df = df.withColumn("shape", F.coalesce(
        F.when(v.isNull(), "junk")
        .when(m["original_log"].is_object, "failed_batch")
        .when(envelope & m["dlq_id"].present, "unparseable_message")
        .when(envelope, "parser_reject")
        .when(m["message"].present, "log"), F.lit("other")))
    wrapped = F.col("shape").isin("failed_batch", "unparseable_message", "parser_reject")
    header = lambda name: F.try_element_at("headers", F.lit(name))
    stated = F.coalesce(
        F.when(wrapped, F.coalesce(m["dlq_timestamp"].text(), m["created_at"].text())),
        header("dlq_timestamp"))
    return df.withColumns({
        "dlq_id": F.when(wrapped, F.coalesce(m["dlq_id"].text(), m["id"].text())),
        "dlq_time": F.coalesce(times.event_time_text(stated), F.col("timestamp")),
        "error_message": F.coalesce(
            F.when(wrapped, m["error_message"].text()), F.col("error_text")),
        "error_type": F.coalesce(F.when(wrapped, m["error_type"].text()), header("error_type")),
        "source": m["source"].text(),
        "raw_payload": F.when(wrapped, raw.text()).when(F.col("shape") == "junk", F.col("value")),
        "original_log": F.when(m["original_log"].is_object, F.to_json(m["original_log"].value))
        .when(F.col("shape") == "log", F.col("value_json")),
    }).drop(*helpers)


def _matched(text: Column, pattern: str) -> Column:
    return blank_to_null(F.regexp_extract(text, f"(?iu)(?U)(?d){pattern}", 0))


def classify(dead: DataFrame, patterns=PATTERNS) -> DataFrame:
    """Add ``error_class`` and ``error_reason``.

    The text is the error text and the error headers together. The first class with a matching
    pattern wins; its reason is the text matched by the first matching pattern. A value that is
    no JSON makes an otherwise unexplained dead letter a data error.
    """
    headers = [F.try_element_at("headers", F.lit(h)) for h in CLASSIFIED_HEADERS]
    df = dead.withColumn(
        "_text", F.concat_ws(" ", blank_to_null(F.col("error_text")), *headers))
    reason = {}
    for name, listed in patterns.items():
        # One test per class; the patterns are tried one by one only where it succeeds.
        any_of = F.col("_text").rlike("(?iu)(?U)(?d)" + "|".join(listed))
        reason[name] = F.when(any_of, F.coalesce(*[_matched(F.col("_text"), p) for p in listed]))
    df = df.withColumns({f"_r{i}": r for i, r in enumerate(reason.values())})
    not_json = F.col("_v").isNull() & (F.coalesce(F.length("value"), F.lit(0)) > 0)
    chosen = F.when(F.lit(False), "")
    for i, name in enumerate(reason):
        chosen = chosen.when(F.col(f"_r{i}").isNotNull(), name)
    df = df.withColumns({
        "error_class": pinned(chosen.when(not_json, DATA).otherwise(UNKNOWN)),
        "error_reason": pinned(F.coalesce(
            *[F.col(f"_r{i}") for i in range(len(reason))],
            F.when(not_json, F.lit(NOT_JSON_REASON)))),
    })
    return df.drop("_text", *[f"_r{i}" for i in range(len(reason))])


ARRIVAL = ["timestamp", "partition", "offset"]


def uncommitted(topic: DataFrame, committed: DataFrame) -> DataFrame:
    """The records at and after the committed offset of their partition."""
    # One row per partition of the topic: it goes to the records, which else would meet in a task per partition.
    return topic.join(F.broadcast(committed), "partition", "left").filter(
        F.col("offset") >= F.coalesce("committed_offset", F.lit(0))).drop("committed_offset")


# Samples up to this size are ranked in one task per partition; offsets that share a slice of a larger one.
RANKED_SAMPLE = SLICE = 10_000


def sample(topic: DataFrame, committed: DataFrame = None, size=SAMPLE_SIZE) -> DataFrame:
    """``size`` records after the committed offsets, taken evenly from the front of each partition.

    What is taken of a partition is a prefix by offset, whatever the timestamps say, so the offset
    after it may be committed. The rank is cut in every task before rows are shuffled; a large sample
    is cut by counts per slice of offsets instead, and comes in no order.
    """
    if committed is not None:
        topic = uncommitted(topic, committed)
    if size > RANKED_SAMPLE:
        return _sliced_sample(topic, size)
    w = Window.partitionBy("partition").orderBy("offset")
    ranked = topic.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= size)
    return ranked.orderBy("_rank", "partition").limit(size).drop("_rank")


def _shares(held: list, size: int) -> list[int]:
    """How many records each partition gives, as far as it holds them: evenly, one more from the first ones."""
    low, high = 0, max(held, default=0)
    while low < high:  # the most that all can give
        each = (low + high + 1) // 2
        low, high = (each, high) if sum(min(n, each) for n in held) <= size else (low, each - 1)
    left = size - sum(min(n, low) for n in held)
    more = [i for i, n in enumerate(held) if n > low][:left]
    return [min(n, low) + (i in more) for i, n in enumerate(held)]


def _sliced_sample(topic: DataFrame, size: int) -> DataFrame:
    """The same from counts: whole slices of offsets below the cut, and the one of each partition that it lies in ranked.

    A task holds a slice at most, and no record moves but those of the ranked slices.
    """
    number = F.floor(F.col("offset") / SLICE)
    counts = topic.groupBy("partition", number.alias("_slice")).agg(F.count("*").alias("_n")).persist()
    try:
        # One row per partition of the topic.
        held = sorted(map(tuple, counts.groupBy("partition").agg(F.sum("_n")).collect()), key=lambda r: (r[0] is not None, r[0]))
        shares = topic.sparkSession.createDataFrame(
            [(p, n) for (p, _), n in zip(held, _shares([n for _, n in held], size))], "partition int, _share long")
        # A row per slice, summed up in the order of a partition's offsets.
        before = F.sum("_n").over(Window.partitionBy("partition").orderBy("_slice")) - F.col("_n")
        cuts = counts.withColumn("_before", before).withColumnRenamed("partition", "_p").join(
            F.broadcast(shares), F.col("_p").eqNullSafe(F.col("partition"))).filter(
            (F.col("_before") < F.col("_share")) & (F.col("_before") + F.col("_n") >= F.col("_share")))
        at = cuts.select("_p", F.col("_slice").alias("_cut"), (F.col("_share") - F.col("_before")).alias("_take")).collect()
    finally:
        counts.unpersist()
    cut = topic.sparkSession.createDataFrame(at, "_p int, _cut long, _take long")
    placed = topic.withColumn("_slice", number).join(F.broadcast(cut), F.col("partition").eqNullSafe(F.col("_p")))
    first = F.coalesce("_slice", F.lit(-2**63))  # records without offset come first, as in an ascending order
    last = F.coalesce("_cut", F.lit(-2**63))
    w = Window.partitionBy("partition").orderBy("offset")
    ranked = placed.filter(first == last).withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= F.col("_take"))
    return placed.filter(first < last).select(*topic.columns).unionByName(ranked.select(*topic.columns))


def end_offsets(topic: DataFrame) -> DataFrame:
    """Partition and end offset of topic records, by reading their offsets."""
    return topic.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))


def partition_lag(topic: DataFrame, committed: DataFrame = None) -> DataFrame:
    """Per partition: end offset, committed offset and lag."""
    return lag_behind(end_offsets(topic), committed)


def lag_behind(ends: DataFrame, committed: DataFrame = None) -> DataFrame:
    """The same from known end offsets."""
    if committed is None:
        ends = ends.withColumn("committed_offset", F.lit(0).cast("bigint"))
    else:
        ends = ends.join(committed, "partition", "left").withColumn(
            "committed_offset", F.coalesce("committed_offset", F.lit(0)))
    return ends.withColumn("lag", F.col("end_offset") - F.col("committed_offset"))


def backlog(topic: DataFrame, committed: DataFrame = None) -> DataFrame:
    """One row: number of partitions and the sum of their lags."""
    return backlog_behind(end_offsets(topic), committed)


def backlog_behind(ends: DataFrame, committed: DataFrame = None) -> DataFrame:
    """The same from known end offsets."""
    return lag_behind(ends, committed).agg(
        F.count("*").alias("partitions"),
        F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"))


def _precedence(name: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, CLASSES)), name)


def reason_counts(classified: DataFrame) -> DataFrame:
    """Per class and reason: number and first arrival. Class counts and top reasons follow from it."""
    return classified.groupBy("error_class", "error_reason").agg(
        F.count("*").alias("n"), F.min(F.struct(*ARRIVAL)).alias("first_seen"))


def class_counts(classified: DataFrame, n: Column = None) -> DataFrame:
    """Count and share per class that occurs; one aggregation over all rows (``n`` letters each)."""
    n = F.lit(1) if n is None else n
    zero = F.lit(0).cast("bigint")
    totals = classified.agg(F.coalesce(F.sum(n), zero).alias("_total"), *[
        F.coalesce(F.sum(F.when(F.col("error_class") == name, n)), zero).alias(f"_{i}")
        for i, name in enumerate(CLASSES)])
    entries = F.array(*[
        F.struct(F.lit(name).alias("error_class"), F.col(f"_{i}").alias("count"),
                 F.try_divide(F.col(f"_{i}"), F.col("_total")).alias("percentage"))
        for i, name in enumerate(CLASSES)])
    return totals.select(F.explode(entries).alias("e")).select("e.*").filter("count > 0")


def top_reasons(classified: DataFrame, k=TOP_REASONS) -> DataFrame:
    """The first k distinct reasons of each class in order of first arrival."""
    return first_reasons(reason_counts(classified), k).drop("n")


def first_reasons(counts: DataFrame, k=TOP_REASONS) -> DataFrame:
    """The same from the counts per reason."""
    first = counts.filter(blank_to_null(F.col("error_reason")).isNotNull())
    w = Window.partitionBy("error_class").orderBy("first_seen", "error_reason")
    return first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def sample_messages(classified: DataFrame, k=SAMPLE_MESSAGES) -> DataFrame:
    """The first k dead letters of each class; the rank is cut per task before the shuffle."""
    w = Window.partitionBy("error_class").orderBy(*ARRIVAL)
    return classified.drop("_v").withColumn("rank", F.row_number().over(w)).filter(
        F.col("rank") <= k)


def dominant_class(counts: DataFrame) -> DataFrame:
    """One row: sampled count, dominant class with its share, and the share of storage errors.

    Equal counts are decided by precedence. An empty queue gives class unknown with share 0.
    """
    best = F.max_by(
        F.struct("error_class", "percentage"),
        F.struct(F.col("count"), -_precedence(F.col("error_class"))))
    row = counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("sampled_count"), best.alias("best"),
        F.max(F.when(F.col("error_class") == STORAGE, F.col("percentage"))).alias("storage"))
    return row.select(
        "sampled_count",
        F.coalesce("best.error_class", F.lit(UNKNOWN)).alias("dominant_class"),
        F.coalesce("best.percentage", F.lit(0.0)).alias("dominant_percentage"),
        F.coalesce("storage", F.lit(0.0)).alias("storage_percentage"))


SAMPLE_FIELDS = [*ARRIVAL, "key", "value_preview", "error_reason"]


def triage_partials(classified: DataFrame, k=TOP_REASONS, samples=SAMPLE_MESSAGES) -> DataFrame:
    """One row per class, of bounded size: number of letters, the k reasons that came first with their
    arrival, and the letters that came first.

    Partials of different letters merge to the partial of all of them: a reason among the k first of all
    is among the k first of the partial that holds its first letter. A repeated letter must not be in two.
    """
    counts = reason_counts(classified)
    letters = sample_messages(classified, samples).groupBy("error_class").agg(
        F.sort_array(F.collect_list(F.struct(*SAMPLE_FIELDS))).alias("letters"))
    return _partial_rows(counts.groupBy("error_class").agg(F.sum("n").alias("n")), counts, letters, k)


def _partial_rows(totals: DataFrame, reasons: DataFrame, letters: DataFrame, k) -> DataFrame:
    lists = first_reasons(reasons, k).groupBy("error_class").agg(
        F.sort_array(F.collect_list(F.struct("first_seen", "error_reason"))).alias("reasons"))
    return totals.join(lists, "error_class", "left").join(letters, "error_class", "left")


def merge_triage_partials(partials: DataFrame, k=TOP_REASONS, samples=SAMPLE_MESSAGES) -> DataFrame:
    """Partials of several sets of letters as one partial per class."""
    totals = partials.groupBy("error_class").agg(F.sum("n").alias("n"))
    reasons = partials.select("error_class", F.inline("reasons")).groupBy("error_class", "error_reason").agg(
        F.min("first_seen").alias("first_seen"))
    w = Window.partitionBy("error_class").orderBy(*ARRIVAL)
    first = partials.select("error_class", F.inline("letters")).withColumn("_rank", F.row_number().over(w))
    letters = first.filter(F.col("_rank") <= samples).groupBy("error_class").agg(
        F.sort_array(F.collect_list(F.struct(*SAMPLE_FIELDS))).alias("letters"))
    return _partial_rows(totals, reasons, letters, k)


def report_of_partials(partials: DataFrame) -> DataFrame:
    """The triage report from partials alone: equal to ``triage_report`` over all their letters."""
    merged = merge_triage_partials(partials)
    message = lambda x, i: F.struct(
        (i + 1).alias("rank"), x["partition"].alias("partition"), x["offset"].alias("offset"), x["key"].alias("key"),
        x["timestamp"].alias("timestamp"), x["value_preview"].alias("value_preview"),
        x["error_reason"].alias("error_reason"))
    return class_counts(merged, F.col("n")).join(merged.drop("n"), "error_class").select(
        "error_class", "count", "percentage",
        F.coalesce(F.transform("reasons", lambda r: r["error_reason"]), F.array().cast("array<string>")).alias("top_errors"),
        F.transform("letters", message).alias("sample_messages"))


def triage_report(classified: DataFrame) -> DataFrame:
    """One row per class that occurs: count, share, top reasons and sample messages."""
    counts = reason_counts(classified)
    reasons = first_reasons(counts).groupBy("error_class").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "error_reason"))),
            lambda x: x.error_reason).alias("top_errors"))
    message = F.struct(
        "rank", "partition", "offset", "key", "timestamp", "value_preview", "error_reason")
    samples = sample_messages(classified).groupBy("error_class").agg(
        F.sort_array(F.collect_list(message)).alias("sample_messages"))
    return (
        class_counts(counts, F.col("n"))
        .join(reasons, "error_class", "left").join(samples, "error_class", "left")
        .withColumn("top_errors", F.coalesce("top_errors", F.array().cast("array<string>"))))
