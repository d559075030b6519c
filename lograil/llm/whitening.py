"""Whitening of embeddings with MLlib's BlockMatrix.

Components become whole numbers x = floor(64 c) + 1,000,000; their count and sums are exact. Each row
is centred exactly, as (n x - S) / n with the difference in whole numbers, before anything is
multiplied, so the offset costs no digits. Centred rows get an index and form the row blocks of a
matrix A, a written table whose column holds MLlib matrices. A transposed times A gives the scatter,
numpy's eigh of that d x d matrix gives the components, and A times the whitening matrix projects all
rows. The same product over the projected rows, centred, checks the result.

For the scatter the second factor holds the same blocks in a grid of GROUPS ~ sqrt(row blocks) block
columns, one for each run of row blocks. The product is one d x d block per run, so no reducer adds
up more than about sqrt(row blocks) matrices; the runs' blocks are then added in a tree. The driver
holds d x d matrices, the counts per input partition and the keys of the blocks (at most MOST_BLOCKS
until a block has BLOCK_BYTES, then one for every BLOCK_BYTES), no rows.

Defined cases: vectors that are null, empty, or hold null or non-finite entries take no part, nor do
vectors of another length than the most frequent one (of equally frequent ones, the longest); entries
with x beyond LIMIT either way are taken as LIMIT; repeated rows and rows of a null vec_id count and
are returned each; a deviation that does not fit a long is null; components whose variance is zero to
double precision have a null ``whitened`` and are left out of the identity error; if all variance is
zero, ``explained`` is null too; other columns are ignored; no vectors give an empty result.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, functions as F, types as T

from lograil.llm.common import usual_length
from lograil.llm.components import saved
from lograil.session import scratch_dir

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
LIMIT = 1 << 52
# Row blocks hold LEAST_ROWS rows, more once there are MOST_BLOCKS, but never more than BLOCK_BYTES.
LEAST_ROWS, MOST_BLOCKS, BLOCK_BYTES = 512, 50_000, 64_000_000
# Eigenvalues up to this share of the largest are zero to double precision.
ZERO = 1e-13
# Rows of a block that go into one result batch.
BATCH_ROWS = 2_000

_MATRIX = ("struct<type:tinyint,numRows:int,numCols:int,colPtrs:array<int>,rowIndices:array<int>,"
           "values:array<double>,isTransposed:boolean>")
_KEYS = ["blockRowIndex", "blockColIndex"]
_RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
           "identity_error double")


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x array<long>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    x = F.transform(v, lambda c: F.greatest(F.least(
        F.floor(F.greatest(F.least(c, F.lit(1e17)), F.lit(-1e17)) * SCALE) + OFFSET, F.lit(LIMIT)), F.lit(-LIMIT)))
    kept = embeddings.where(v.isNotNull() & (F.size(v) > 0) & finite).select("vec_id", x.alias("x"))
    return kept.where(F.size("x") == usual_length(kept, "x"))


def totals(vectors: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and the exact sums per dimension."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                flat = batch["x"].flatten().to_numpy(zero_copy_only=False)
                sums = flat.reshape(batch.num_rows, -1).sum(0)  # below 2^63: at most 1,000 rows of 2^52
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums),
                                                  pa.array(np.full(len(sums), batch.num_rows))], ["i", "s", "n"])
    sums = vectors.select("x").mapInArrow(run, "i int, s long, n long").groupBy("i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n"))
    rows = sums.orderBy("i").collect()  # one row per dimension
    return (rows[0].n if rows else 0), [int(r.s) for r in rows]


def indexed(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The vectors as a written table with the partition and place that each row had when written,
    and the index of the first row of each partition. Sums and counts of them are a gapless index that
    no later reading changes."""
    at = F.monotonically_increasing_id()
    rows = saved(vectors.select("*", F.shiftright(at, 33).alias("part"),
                                at.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "vectors")
    first, starts = 0, []
    for part, count in sorted(map(tuple, rows.groupBy("part").count().collect())):  # one row per partition
        starts.append((part, first))
        first += count
    return rows, vectors.sparkSession.createDataFrame(starts, "part long, first long")


def _written(df: DataFrame, name: str) -> str:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return path


def _matrix(values, columns: int):
    """Values row by row as a dense MLlib matrix, in the fields that its type is stored in."""
    none = F.lit(None).cast("array<int>")
    return F.struct(
        F.lit(1).cast("tinyint").alias("type"), (F.size(values) / columns).cast("int").alias("numRows"),
        F.lit(columns).alias("numCols"), none.alias("colPtrs"), none.alias("rowIndices"),
        F.col(values).alias("values"), F.lit(True).alias("isTransposed"))


def _block_columns(columns: int, *more):
    return [F.col("block").alias(_KEYS[0]), F.lit(0).cast("long").alias(_KEYS[1]),
            _matrix("y", columns).alias("subMatrix"), *more]


def centred_blocks(rows: DataFrame, starts: DataFrame, n: int, sums: list[int], per_block: int) -> str:
    """Writes the blocks of centred rows with the ids and exact deviations of their rows."""
    d, total = len(sums), np.array(sums, dtype=object)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                members = batch["rows"][i].values
                order = np.argsort(members.field("index").to_numpy(), kind="stable")
                x = members.field("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)[order]
                # In machine words where these hold every step, else in whole numbers of any size.
                if n * int(np.abs(x).max()) + max(map(abs, sums)) < 1 << 62:
                    diff = x * n - total.astype(np.int64)
                else:
                    diff = x.astype(object) * n - total
                exact = diff if int(np.abs(diff).max()) ** 2 * d < 1 << 62 else diff.astype(object)
                squares = [s if s < 1 << 63 else None for s in (exact * exact).sum(1).tolist()]
                yield pa.RecordBatch.from_arrays([
                    batch["block"].slice(i, 1),
                    pa.array([members.field("vec_id").take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
                    pa.array([squares], pa.list_(pa.int64())),
                    pa.array([(diff / n).astype(np.float64).ravel()], pa.list_(pa.float64()))],
                    ["block", "vec_id", "deviation", "y"])

    index = (F.col("first") + F.col("place")).alias("index")
    dealt = rows.join(starts, "part").select("vec_id", "x", index).groupBy(
        F.floor(F.col("index") / per_block).alias("block")).agg(
        F.collect_list(F.struct("index", "vec_id", "x")).alias("rows"))
    blocks = dealt.mapInArrow(run, "block long, vec_id array<long>, deviation array<long>, y array<double>")
    return _written(blocks.select(*_block_columns(d, "vec_id", "deviation")), "centred")


def distributed(spark, folder: str, n: int, per_block: int, columns: int, run: int | None = None) -> BlockMatrix:
    """The written blocks as a BlockMatrix; with ``run`` each run of that many row blocks in a block column of its own."""
    schema = T.StructType([*(T.StructField(k, T.LongType()) for k in _KEYS), T.StructField("subMatrix", MatrixUDT())])
    table, wide = spark.read.schema(schema).parquet(folder), 1
    if run:
        table = table.withColumn(_KEYS[1], F.floor(F.col(_KEYS[0]) / run))
        wide = -(-n // (per_block * run))
    table = table.select(F.struct(*_KEYS).alias("at"), "subMatrix")
    java = callMLlibFunc("createBlockMatrix", table, per_block, columns, n, columns * wide)
    return BlockMatrix(java, per_block, columns)


def scatter(spark, folder: str, n: int, per_block: int, columns: int) -> np.ndarray:
    """A transposed times A: one product per run of row blocks, added in a tree."""
    run = math.isqrt(-(-n // per_block) - 1) + 1
    left = distributed(spark, folder, n, per_block, columns).transpose()
    right = distributed(spark, folder, n, per_block, columns, run)
    # Splitting the inner dimension gives the blocks of a run to different tasks.
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, run)
    return BlockMatrix(product, columns, columns).blocks.map(lambda b: b[1].toArray()).treeReduce(np.add)


def project(spark, folder: str, n: int, per_block: int, w: np.ndarray) -> DataFrame:
    """(block, z array): every row block times the matrix w; z lies column by column."""
    d, k = w.shape
    one = spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, k, w.ravel(order="F").tolist()))], 1)
    product = distributed(spark, folder, n, per_block, d).multiply(BlockMatrix(one, d, k, d, k))
    blocks = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model)
    path = _written(blocks.select(F.col("_1._1").cast("long").alias("block"), F.col("_2").alias("z")), "projected")
    return spark.read.schema(f"block long, z {_MATRIX}").parquet(path).select("block", "z.values")


def _covariance(projected: DataFrame, n: int, per_block: int, k: int) -> np.ndarray:
    """The covariance of the projected rows, centred before multiplying."""
    def sums(batches):
        for batch in batches:
            z = [v.values.to_numpy().reshape(k, -1).sum(1) for v in batch["values"]]
            if z:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(sum(z))], ["i", "s"])

    total = projected.mapInArrow(sums, "i int, s double").groupBy("i").agg(F.sum("s")).orderBy("i").collect()
    mean = np.array([s for _, s in total]) / n

    def centre(batches):
        for batch in batches:
            y = [(v.values.to_numpy().reshape(k, -1).T - mean).ravel() for v in batch["values"]]
            yield pa.RecordBatch.from_arrays([batch["block"], pa.array(y, pa.list_(pa.float64()))], ["block", "y"])

    blocks = projected.mapInArrow(centre, "block long, y array<double>")
    folder = _written(blocks.select(*_block_columns(k)), "whitened")
    return scatter(projected.sparkSession, folder, n, per_block, k) / n


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component."""
    spark = embeddings.sparkSession
    rows, starts = indexed(whole_vectors(embeddings))
    n, sums = totals(rows)
    if not n:
        return spark.createDataFrame([], _RESULT)
    d = len(sums)
    per_block = max(1, min(max(LEAST_ROWS, 4 * d, -(-n // MOST_BLOCKS)), BLOCK_BYTES // (8 * d)))
    folder = centred_blocks(rows, starts, n, sums, per_block)
    values, vectors = np.linalg.eigh(scatter(spark, folder, n, per_block, d) / n)
    k = min(components, d)
    e, u = values[::-1], vectors[:, ::-1][:, :k]
    usable = e[:k] > max(e[0], 0) * ZERO
    projected = project(spark, folder, n, per_block, u / np.sqrt(np.where(usable, e[:k], 1)))
    trace = float(e.sum())
    explained = [float(x / trace) if trace > 0 else None for x in e[:k]]
    off = np.abs(_covariance(projected, n, per_block, k) - np.eye(k))[np.ix_(usable, usable)]
    error = float(off.max()) if usable.any() else None

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, deviation = batch["vec_id"][i].values, batch["deviation"][i].values
                z = batch["values"][i].values.to_numpy().reshape(k, -1).T
                for a in range(0, len(ids), BATCH_ROWS):
                    part = z[a:a + BATCH_ROWS]
                    m = len(part)
                    row = pa.array(np.repeat(np.arange(a, a + m), k))
                    blank = np.tile(~usable, m)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n)), deviation.take(row), pa.array(part.ravel(), mask=blank),
                        pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64())],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kept = spark.read.schema("blockRowIndex long, vec_id array<long>, deviation array<long>").parquet(folder)
    return kept.withColumnRenamed("blockRowIndex", "block").join(projected, "block").drop("block").mapInArrow(run, _RESULT)
