"""Exact top-k by inner product, in three phases with one uniform cutoff per query.

The dimensions are cut into SEGMENTS lists of partial scores. Phase one gathers, from one in PROBED
blocks of candidates, the best few entries of each list and scores them exactly; the k-th best of
these is a cutoff the true answer cannot fall below, whichever blocks gave it. Phase two sends the
cutoff with the queries to every block; a vector that reaches it must reach cutoff / SEGMENTS in some
list, so the entries down to that share are sufficient. Phase three adds up the partial scores of
those alone and keeps the k best.

Queries meet candidates in blocks of bounded size, and only k entries per query leave a block.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do
rows of a null vec_id; repeated rows (same id and vector) count once; rows of one id are never
candidates for each other; vectors of different length are not compared; ties go to the smaller
vec_id; a query without candidates has no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

SEGMENTS, PROBED = 4, 8
CANDIDATES, QUERIES = 4096, 1024
# Pairs of blocks in an Arrow batch, and queries of a block that are scored at a time: what a Python worker holds.
PAIRS, SCORED = 8, 256
_LOWEST = -(1 << 62)  # the cutoff of a query with fewer than k known scores


def whole_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v array<long>): every component as floor(scale * x)."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    whole = F.transform(x, lambda c: F.floor(c * scale))
    return (embeddings.where(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
            .select("vec_id", whole.alias("v")).dropDuplicates(["vec_id", "v"]))


def _packed(vectors: DataFrame, blocks: int, name: str, *more) -> DataFrame:
    """One row per block: ids, and the vectors' components one after the other."""
    v = vectors.withColumns({"dim": F.size("v"), name: F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))})
    rows = v.groupBy("dim", name).agg(F.collect_list(F.struct("vec_id", "v", *more)).alias("rows"))
    return rows.select("dim", name, *[F.col(f"rows.{c}").alias(f"{name}_{c}") for c in ("vec_id", *more)],
                       F.flatten("rows.v").alias(f"{name}_v"))


def _arrays(batch, row, *names):
    return [batch[n][row].values.to_numpy(zero_copy_only=False) for n in names]


def _partial_scores(q, c, segments):
    """The lists: per segment of dimensions a matrix of inner products, exact."""
    dim = q.shape[1]
    top = float(max(np.abs(q).max(initial=0), 1)) * float(max(np.abs(c).max(initial=0), 1)) * max(dim, 1)
    if top < 2.0 ** 53:  # doubles then hold every sum exactly
        q, c = q.astype(np.float64), c.astype(np.float64)
    cuts = np.linspace(0, dim, min(segments, max(dim, 1)) + 1).astype(int)
    return [q[:, a:b] @ c[:, a:b].T for a, b in zip(cuts, cuts[1:])]


def sufficient(lists, cutoff):
    """Marks the entries that some list holds at or above its share of the query's cutoff."""
    share = -(-cutoff // len(lists))[:, None]  # the least whole number that is enough
    enough = lists[0] >= share
    for part in lists[1:]:
        enough |= part >= share
    return enough


def resolved(lists, rows, cols):
    """The exact scores of the entries at these places, from their partial ones."""
    return sum(part[rows, cols] for part in lists).astype(np.int64)


def _first(k, rows, score, ids):
    """Of entries (row, score, id) the k first of each row by score, then id."""
    order = np.lexsort((ids, -score, rows))
    r = rows[order]
    start = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]])) if len(r) else np.zeros(0, int)
    place = np.arange(len(r)) - np.repeat(start, np.diff(np.append(start, len(r))))
    return order[place < k]


def _phase(k, segments, resolve):
    """Phase one, or phases two and three (``resolve``), on pairs of a query and a candidate block."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, vectors, c_id, c_v = _arrays(batch, i, "qb_vec_id", "qb_v", "cb_vec_id", "cb_v")
                dim = batch["dim"][i].as_py()
                vectors, c_v = vectors.reshape(len(ids), dim), c_v.reshape(len(c_id), dim)
                cutoffs, = _arrays(batch, i, "qb_cutoff") if resolve else (None,)
                for start in range(0, len(ids), SCORED):
                    part = slice(start, start + SCORED)
                    q_id = ids[part]
                    lists = _partial_scores(vectors[part], c_v, segments)
                    own = q_id[:, None] == c_id[None, :]
                    if resolve:
                        cutoff = cutoffs[part]
                        enough = sufficient(lists, cutoff)
                        rows, cols = np.nonzero(enough & ~own)
                        score = resolved(lists, rows, cols)
                        kept = score >= cutoff[rows]
                        rows, cols, score = rows[kept], cols[kept], score[kept]
                    else:
                        n = min(k + 1, len(c_id))  # one more, for the query itself
                        picked = np.zeros_like(own)
                        for values in lists:
                            best = np.argpartition(-values, n - 1, axis=1)[:, :n]
                            np.put_along_axis(picked, best, True, axis=1)
                        rows, cols = np.nonzero(picked & ~own)
                        score = resolved(lists, rows, cols)
                    at = _first(k, rows, score, c_id[cols])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_id[rows[at]]), pa.array(c_id[cols[at]]), pa.array(score[at])],
                        ["query_id", "vec_id", "score"])
    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, segments: int = SEGMENTS) -> DataFrame:
    """(query_id, rank, vec_id, score) of frames (vec_id long, v array<long>)."""
    # A pair of blocks is one row of megabytes; the next query sets the number again (common.prepared).
    candidates.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(PAIRS))
    n_c = candidates.count() // CANDIDATES + 1
    n_q = queries.count() // QUERIES + 1
    blocks = _packed(candidates, n_c, "cb")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long")))
    shape = "query_id long, vec_id long, score long"

    def meet(asked, resolve):
        # Each query block is dealt to every candidate block: the stated queries against all rows.
        pairs = asked.select("*", every.alias("cb"))
        if not resolve:  # a share of the blocks, another one for every query block, at least one
            pairs = pairs.where(F.pmod(F.col("cb") - F.col("qb"), F.lit(min(PROBED, n_c))) == 0)
        # Estimated by the blocks before they are dealt, the copies could look small enough to broadcast.
        pairs = pairs.hint("merge").join(blocks, ["dim", "cb"])
        return pairs.drop("qb", "cb").mapInArrow(_phase(k, segments, resolve), shape)

    def ranked(found):
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    local = ranked(meet(_packed(queries, n_q, "qb"), False))
    cutoffs = local.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"),
                                                     F.col("score").alias("cutoff"))
    asked = queries.join(cutoffs, "vec_id", "left").fillna(_LOWEST, "cutoff")
    found = ranked(meet(_packed(asked, n_q, "qb", "cutoff"), True))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(embeddings: DataFrame, k: int = 5) -> DataFrame:
    """The k best of all other vectors for every vector whose id is divisible by 50."""
    vectors = whole_vectors(embeddings)
    return top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, k)
