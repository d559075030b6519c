"""Session settings the library relies on, and the shared scratch location."""

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# All timestamps are UTC; of duplicate JSON or map keys the last one counts.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Wide projections generate methods above 8,000 bytes, which the JVM would only interpret.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


# Rows of a cached batch. Spark's serializer holds on to the last hundred batches that a task wrote, outside
# of the memory that it accounts for, and makes room for a whole batch of every column beforehand.
CACHED_ROWS = 250


@contextmanager
def small_batches(spark: SparkSession, compressed=True):
    """What is cached meanwhile is kept in batches of few rows, plain if not ``compressed``."""
    wanted = {"spark.sql.inMemoryColumnarStorage.batchSize": str(CACHED_ROWS),
              "spark.sql.inMemoryColumnarStorage.compressed": str(compressed).lower()}
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def local_session(app="lograil", cpus=8, shuffle_partitions=8, memory="12g"):
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        # Without call-site capture, building the wide expressions takes half the time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Where that setting is absent, a session on one machine takes a temporary folder; on a cluster
    each executor would write to its own disk, so there it is an error.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not root and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="lograil-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
