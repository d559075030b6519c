"""Approximate nearest neighbours by inner product with an inverted multi-index.

The two halves of a vector are quantised separately, each with its own codebook; a pair of centroids
is a cell, and the index holds every vector under its cell. A query sorts the centroids of each half
by distance (the negated inner product with its own half) and walks the pairs by summed distance with
a heap until the visited cells hold enough entries. The entries of visited cells are reranked by the
exact product with the original vectors.

Bounded samples: codebooks and the share of entries that is enough are fitted on about SAMPLE vectors
(those whose hashed id falls into one part of n / SAMPLE). The share is measured there: brute force
gives the true neighbours of TUNE sample queries, and the share is what the walk must visit to meet
TARGET of them. In a larger table the nearest are nearer and come earlier, so the share is on the safe
side. All else covers every row: the index, the cell counts, the walk and the reranking have no caps.

Cells are laid out in blocks of about BLOCK_BYTES; a cell that is larger is dealt over several blocks.
A query goes once to every block that it visits, with one bit per cell; packs of queries meet the
block's entries there, a task taking at most SHARE queries at a time, and at most k entries per query
leave a block. The driver sees codebooks and the counts of at most MOST_CENTROIDS ** 2 cells.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part,
nor do rows of a null vec_id or vectors of another length than the most frequent one (of equally
frequent ones, the longest); repeated rows (same id and vector) count once; rows of one id with
different vectors are candidates each, but never for each other; ties go to the smaller vec_id; a query
without candidates has no rows; fewer than k candidates are all returned; other columns are ignored; no
vectors give an empty result.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from lograil.llm.common import usual_length
from lograil.llm.components import saved

SAMPLE, TUNE, TARGET, ROUNDS = 16_384, 256, 0.96, 12
# A half has GROWTH[0] * n ** GROWTH[1] centroids for n vectors, at least 2 and no more than this.
GROWTH, MOST_CENTROIDS = (2, 0.3), 256
BLOCK_BYTES, PACK, SHARE = 2_000_000, 256, 8_192


def usable_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v array): the vectors that take part, of the column's own float type."""
    kind = embeddings.schema["embedding"].dataType
    own = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))
    v = F.col("embedding") if own else F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    kept = embeddings.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda c: c != 0))
    kept = kept.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return kept.where(F.size("v") == usual_length(kept, "v")).dropDuplicates(["vec_id", "v"])


def _rows(column) -> np.ndarray:
    """An Arrow list column as a matrix of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def centroids(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's k-means of the rows; at most k different centroids."""
    found = np.unique(x, axis=0)
    if len(found) <= k:
        return found
    c = found[np.random.default_rng(seed).choice(len(found), k, replace=False)]
    for _ in range(ROUNDS):
        near = _nearest(x, c)
        size = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], c)
    return c


def _nearest(x, c):
    return np.argmax(x @ c.T - 0.5 * (c * c).sum(1), axis=1)


class MultiIndex:
    """Two codebooks, and after ``laid_out`` the number of entries and the blocks of every cell."""

    def __init__(self, first: np.ndarray, second: np.ndarray, share: float = 1.0):
        self.first, self.second, self.share = first, second, share
        self.half, self.cells = first.shape[1], len(first) * len(second)

    def cell(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x[:, :self.half], self.first) * len(self.second) + _nearest(x[:, self.half:], self.second)

    def distances(self, q: np.ndarray):
        """Of every query to the centroids of either half."""
        return -(q[:, :self.half] @ self.first.T), -(q[:, self.half:] @ self.second.T)

    def laid_out(self, counts: dict[int, int], per_block: int):
        """Blocks of cells in order: small cells share one, a large cell has as many as it needs."""
        self.counts = np.zeros(self.cells, np.int64)
        self.counts[list(counts)] = list(counts.values())
        self.parts = np.maximum(1, -(-self.counts // per_block))
        self.block = np.zeros(self.cells, np.int64)  # the first of a cell; it never falls from cell to cell
        block = filled = 0
        for c, (n, parts) in enumerate(zip(self.counts.tolist(), self.parts.tolist())):
            if filled and filled + n > per_block:
                block, filled = block + 1, 0
            self.block[c], filled = block, filled + n
            if parts > 1:
                block, filled = block + parts, 0
        return self

    def cells_of(self, block: int) -> tuple[int, int]:
        """The range of cells that lie in a block."""
        end = int(np.searchsorted(self.block, block, "right"))
        start = int(np.searchsorted(self.block, block, "left"))
        return (start, end) if start < end else (end - 1, end)

    def walk(self, one: np.ndarray, two: np.ndarray, enough: int) -> list[int]:
        """The cells with entries by summed distance until these are enough. Every pair enters the heap once."""
        order, other = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
        a, b = one[order].tolist(), two[other].tolist()
        row, col, counts = (order * len(two)).tolist(), other.tolist(), self.counts
        heap, out, got = [(a[0] + b[0], 0, 0)], [], 0
        while heap and got < enough:
            _, i, j = heapq.heappop(heap)
            n = counts[row[i] + col[j]]
            if n:
                out.append(row[i] + col[j])
                got += n
            if j + 1 < len(b):
                heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            if not j and i + 1 < len(a):
                heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        return out

    def visits(self, cells: list[int]):
        """(block, bits of its cells) of every block that holds visited cells."""
        cells = np.sort(np.array(cells, np.int64))
        parts = self.parts[cells]
        at = np.repeat(self.block[cells], parts) + np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        cells = np.repeat(cells, parts)
        for block in np.unique(at).tolist():
            start, end = self.cells_of(block)
            bits = np.zeros(end - start, np.uint8)
            inside = cells[at == block]
            bits[inside - start] = 1
            yield block, np.packbits(bits).tobytes()


def fit(vectors: DataFrame, n: int, k: int, target: float = TARGET) -> MultiIndex:
    """Codebooks and share from the sample. ``n`` is the number of vectors."""
    parts = -(-n // SAMPLE)
    sample = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == 0).orderBy("vec_id", "v").toArrow()
    if not sample.num_rows:  # a hash may leave a small part empty
        sample = vectors.orderBy("vec_id", "v").limit(SAMPLE).toArrow()
    x = _rows(sample["v"].combine_chunks())
    half = x.shape[1] // 2
    size = int(min(MOST_CENTROIDS, max(2, GROWTH[0] * n ** GROWTH[1])))
    model = MultiIndex(centroids(x[:, :half], size, 1), centroids(x[:, half:], size, 2))
    asked = np.random.default_rng(3).permutation(len(x))[:TUNE]
    cell = model.cell(x)
    counts = np.bincount(cell, minlength=model.cells)
    one, two = model.distances(x[asked])
    needed = []
    for row, i in enumerate(asked.tolist()):
        score = x @ x[i]
        score[i] = -np.inf
        near = np.argsort(-score, kind="stable")[:min(k, len(x) - 1)]
        order = np.argsort((one[row][:, None] + two[row]).ravel(), kind="stable")
        seen = np.empty(model.cells)
        seen[order] = np.cumsum(counts[order])
        needed.extend(seen[cell[near]] / len(x))
    model.share = float(np.quantile(needed, target)) if needed else 1.0
    return model


def build(vectors: DataFrame, k: int, target: float = TARGET) -> tuple[MultiIndex, DataFrame]:
    """The fitted index and its entries (vec_id, v, cell), a written table."""
    kept = saved(vectors, "vectors")
    n = kept.count()
    if not n:
        return None, kept
    model = fit(kept, n, k, target)

    def run(batches):
        for batch in batches:
            cell = pa.array(model.cell(_rows(batch["v"])), pa.int32()) if batch.num_rows else pa.array([], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, cell], ["vec_id", "v", "cell"])

    shape = T.StructType([*kept.schema.fields, T.StructField("cell", T.IntegerType())])
    entries = saved(kept.mapInArrow(run, shape), "index")
    dim = len(model.first[0]) + len(model.second[0])
    counts = dict(map(tuple, entries.groupBy("cell").count().collect()))  # one row per cell
    wide = 4 if isinstance(kept.schema["v"].dataType.elementType, T.FloatType) else 8
    return model.laid_out(counts, max(1, BLOCK_BYTES // (wide * dim))), entries


def _best(k, score, allowed, ids, q, v):
    """(row, entry, exact score) of the k best allowed entries of each query."""
    score = np.where(allowed, score, -np.inf)
    out = []
    n = min(k, score.shape[1])
    least = np.partition(score, -n, axis=1)[:, -n]
    # Products may differ in the last digits by their place in a block: all near the k-th are summed alike.
    slack = 1e-9 * (np.abs(score.max(1, initial=0, where=allowed)) + 1e-300) + 1e-12 * np.abs(q).sum(1) * np.abs(v).max()
    for row in range(len(score)):
        near = np.flatnonzero(allowed[row] & (score[row] >= least[row] - slack[row]))
        exact = (v[near] * q[row]).sum(1)
        first = np.lexsort((ids[near], -exact))[:k]
        out.append((np.full(len(first), row), near[first], exact[first]))
    return tuple(map(np.concatenate, zip(*out)))


def search(model: MultiIndex, entries: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of frame ``queries`` (vec_id, v)."""
    n = int(model.counts.sum())
    enough = max(int(np.ceil(model.share * n)), k + 1)
    dim = len(model.first[0]) + len(model.second[0])
    element = entries.schema["v"].dataType.simpleString()

    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = model.distances(_rows(batch["v"]))
            found = [(row, *visit) for row in range(batch.num_rows)
                     for visit in model.visits(model.walk(one[row], two[row], enough))]
            rows, blocks, bits = zip(*found)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), batch["vec_id"].take(at), batch["v"].take(at), pa.array(bits, pa.binary())],
                ["block", "vec_id", "v", "bits"])

    shares = max(1, -(-queries.count() // SHARE))
    pack = F.pmod(F.xxhash64("vec_id", "v"), F.lit(shares * (SHARE // PACK)))
    asked = (queries.select("vec_id", "v").mapInArrow(route, f"block long, vec_id long, v {element}, bits binary")
             .withColumn("pack", pack).groupBy("block", "pack").agg(F.collect_list(F.struct("vec_id", "v", "bits")).alias("q"))
             .select("block", F.pmod("pack", F.lit(shares)).alias("share"),
                     F.col("q.vec_id").alias("q_id"), F.flatten("q.v").alias("q_v"), F.col("q.bits").alias("q_bits")))

    def place(batches):
        for batch in batches:
            cell = batch["cell"].to_numpy().astype(np.int64)
            part = batch["h"].to_numpy() % model.parts[cell]
            yield pa.RecordBatch.from_arrays(
                [pa.array(model.block[cell] + part), batch["vec_id"], batch["v"], batch["cell"]],
                ["block", "vec_id", "v", "cell"])

    h = F.shiftrightunsigned(F.xxhash64("vec_id", "v"), 1).alias("h")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))).alias("share")
    blocks = (entries.select("vec_id", "v", "cell", h).mapInArrow(place, f"block long, vec_id long, v {element}, cell int")
              .groupBy("block").agg(F.collect_list(F.struct("vec_id", "v", "cell")).alias("e"))
              .select("block", every, F.col("e.vec_id").alias("e_id"), F.flatten("e.v").alias("e_v"),
                      F.col("e.cell").alias("e_cell")))

    def rerank(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                start, end = model.cells_of(batch["block"][i].as_py())
                values = {name: batch[name][i].values for name in ("q_id", "q_v", "q_bits", "e_id", "e_v", "e_cell")}
                q_id, e_id, cell = (values[name].to_numpy() for name in ("q_id", "e_id", "e_cell"))
                q, v = (values[name].to_numpy().astype(np.float64).reshape(-1, dim) for name in ("q_v", "e_v"))
                bits = np.frombuffer(b"".join(values["q_bits"].to_pylist()), np.uint8).reshape(len(q_id), -1)
                visited = np.unpackbits(bits, axis=1, count=end - start).astype(bool)
                some = visited.any(0)[cell - start]
                e_id, cell, v = e_id[some], cell[some], v[some]
                allowed = visited[:, cell - start] & (q_id[:, None] != e_id)
                row, entry, score = _best(k, q @ v.T, allowed, e_id, q, v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_id[row]), pa.array(e_id[entry]), pa.array(score)], ["query_id", "vec_id", "score"])

    met = asked.join(blocks, ["block", "share"]).drop("share")
    found = met.mapInArrow(rerank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(embeddings: DataFrame, k: int = 20, every: int = 20, target: float = TARGET) -> DataFrame:
    """The k nearest found of all other vectors for every vector whose id is divisible by ``every``."""
    model, entries = build(usable_vectors(embeddings), k, target)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(model, entries, entries.where(F.col("vec_id") % every == 0), k)
