"""Pipeline metrics from the batch statistics, and the conservation check."""

from pyspark.sql import Column, DataFrame, functions as F

# Upper bounds of the histogram buckets.
SIZE_BUCKETS = [10, 50, 100, 250, 500, 1000, 2500, 5000]
SECONDS_BUCKETS = [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]

# Histogram name: (statistics column, bucket bounds).
HISTOGRAMS = {
    "batch_size": ("written", SIZE_BUCKETS),
    "write_seconds": ("write_seconds", SECONDS_BUCKETS),
    "flush_seconds": ("flush_seconds", SECONDS_BUCKETS),
}


def counters(stats: DataFrame) -> DataFrame:
    """Labelled totals: consumed per topic, writes per status, rows written, dead letters per type.

    Every failed attempt counts as a write with status error.
    """
    entry = lambda metric, label, value: F.struct(
        F.lit(metric).alias("metric"), label.alias("label"), value.cast("bigint").alias("value"))
    rows = stats.select(F.explode(F.array(
        entry("messages_consumed", F.col("topic"), F.col("consumed")),
        entry("writes", F.lit("success"), F.when(F.col("status") == "success", 1)),
        entry("writes", F.lit("error"), F.col("failed_attempts")),
        entry("rows_written", F.lit(""), F.when(F.col("status") == "success", F.col("written"))),
        entry("dlq_messages", F.lit("message_parse_error"), F.col("rejected")),
        entry("dlq_messages", F.col("error_type"),
              F.when(F.col("status") != "success", F.col("consumed") - F.col("rejected"))),
    )).alias("e")).select("e.*")
    return rows.filter(F.col("value") > 0).groupBy("metric", "label").agg(
        F.sum("value").alias("value"))


def ingested_by_label(logs: DataFrame) -> DataFrame:
    """Ingested records per source and level."""
    return logs.groupBy("source", "level").agg(F.count("*").alias("value"))


def histograms(stats: DataFrame) -> DataFrame:
    """Cumulative buckets of every histogram in one scan: metric, bound, count at or below it.

    The bound ``+Inf`` counts all. Only batches that were stored are observed.
    """
    stored = stats.filter(F.col("status") == "success")
    cells = []
    for metric, (column, bounds) in HISTOGRAMS.items():
        for bound in bounds:
            cells.append((metric, f"{bound:g}", F.count_if(F.col(column) <= bound)))
        cells.append((metric, "+Inf", F.count(column)))
    one_row = stored.agg(*[c.alias(f"c{i}") for i, (_, _, c) in enumerate(cells)])
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(metric).alias("metric"), F.lit(bound).alias("le"),
                 F.col(f"c{i}").alias("cumulative"))
        for i, (metric, bound, _) in enumerate(cells)
    ])).alias("h")).select("h.*")


def histogram_sums(stats: DataFrame) -> DataFrame:
    """Sum and count of every histogram."""
    stored = stats.filter(F.col("status") == "success")
    one_row = stored.agg(*[
        F.struct(F.lit(m).alias("metric"), F.sum(c).cast("double").alias("sum"),
                 F.count(c).alias("count")).alias(m)
        for m, (c, _) in HISTOGRAMS.items()])
    return one_row.select(F.explode(F.array(*HISTOGRAMS)).alias("h")).select("h.*")


def throughput(stats: DataFrame) -> DataFrame:
    """Rows per second of every stored batch, as a whole number."""
    return stats.filter(F.col("status") == "success").select(
        "batch_id", "written",
        F.coalesce(
            F.floor(F.try_divide("written", "flush_seconds")), F.lit(0)).alias("rows_per_second"))


def flush_totals(stats: DataFrame) -> DataFrame:
    """Consumed and flushed records, flushes, and the overall rows per second."""
    ok = F.col("status") == "success"
    df = stats.agg(
        F.coalesce(F.sum("consumed"), F.lit(0)).alias("total_consumed"),
        F.coalesce(F.sum(F.when(ok, F.col("written"))), F.lit(0)).alias("total_flushed"),
        F.count_if(ok).alias("flush_count"),
        F.sum(F.when(ok, F.col("flush_seconds"))).alias("_seconds"))
    return df.select(
        "total_consumed", "total_flushed", "flush_count",
        F.floor(F.try_divide("total_flushed", "_seconds")).alias("rows_per_second"))


def conservation(sent: DataFrame, stored: DataFrame, refused: DataFrame,
                 by="source_service") -> DataFrame:
    """Per label: records sent, stored and refused, and whether none is missing.

    Every side is counted per label before the join.
    """
    def counted(df, name):
        return df.groupBy(by).agg(F.count("*").alias(name))

    zero = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    joined = counted(sent, "sent").join(counted(stored, "stored"), by, "full_outer").join(
        counted(refused, "rejected"), by, "full_outer")
    return joined.select(by, zero("sent"), zero("stored"), zero("rejected")).withColumn(
        "missing", F.col("sent") - F.col("stored") - F.col("rejected"))


DIGEST = ["n", "hash_sum", "hash_xor"]


def digests(records: DataFrame, cells, ids=("id",)) -> DataFrame:
    """Per cell a digest of its multiset of ids that no order changes: number, sum and xor of their hashes."""
    h = F.xxhash64(*ids)
    return records.groupBy(*cells).agg(
        F.count("*").alias("n"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor(h).alias("hash_xor"))


def unequal_cells(sent: DataFrame, got: DataFrame, cells, ids=("id",)) -> DataFrame:
    """The cells whose records are not the same on both sides; a cell one side lacks is one of them.

    Both sides are reduced to a row per cell before they meet; either may be a table of digests kept
    from earlier.
    """
    one, two = (df if set(DIGEST) <= set(df.columns) else digests(df, cells, ids) for df in (sent, got))
    less = two.withColumns({"n": -F.col("n"), "hash_sum": -F.col("hash_sum")})
    both = one.select(*cells, *DIGEST).unionByName(less.select(*cells, *DIGEST)).groupBy(*cells).agg(
        F.sum("n").alias("n"), F.sum("hash_sum").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor"))
    return both.filter((F.col("n") != 0) | (F.col("hash_sum") != 0) | (F.col("hash_xor") != 0)).select(*cells)


def lost_and_doubled(sent: DataFrame, got: DataFrame, cells, ids=("id",)) -> DataFrame:
    """The ids that are not as often on one side as on the other: ids, ``sent`` and ``stored``.

    Only records of unequal cells are looked at one by one, so a sound table costs two aggregations.
    """
    wrong = unequal_cells(sent, got, cells, ids).select(*[F.col(c).alias(f"_{c}") for c in cells])
    sides = [df.select(*cells, *ids, F.lit(int(first)).alias("sent"), F.lit(int(not first)).alias("stored"))
             for df, first in ((sent, True), (got, False))]
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cells]
    counts = sides[0].unionByName(sides[1]).join(wrong, same, "left_semi").groupBy(*ids).agg(
        F.sum("sent").alias("sent"), F.sum("stored").alias("stored"))
    return counts.filter(F.col("sent") != F.col("stored"))


OBSERVED = "ingest"


def observed(df: DataFrame, name=OBSERVED, rejected: Column = None) -> DataFrame:
    """Attach counters of the rows that pass, for the progress reports that a listener of a stream gets.

    Rows that Spark computes again after the loss of an executor may count again.
    """
    bad = rejected if rejected is not None else F.col("errors").isNotNull()
    return df.observe(name, F.count("*").alias("consumed"), F.count_if(bad).alias("rejected"))
