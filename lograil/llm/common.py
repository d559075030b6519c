"""What the operators of this subpackage share: words as hashes, sliding minima, blocks of documents."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

# Distinct words a Python worker remembers before it starts anew.
REMEMBERED = 300_000
# Text of one block, in bytes: what one grouped task holds at a time.
BLOCK_BYTES = 4_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
np.seterr(over="ignore")  # hashes wrap around
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33))


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a bound."""

    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = WordHashes()


def hash_words(words) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def texts_of(column) -> list:
    """The values of an Arrow string column as UTF-8 bytes; null stays None."""
    return column.cast(pa.binary()).to_pylist()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values, so that sums of words become usable hashes."""
    x = (x ^ (x >> _MIX[2])) * _MIX[0]
    x = (x ^ (x >> _MIX[2])) * _MIX[1]
    return x ^ (x >> _MIX[2])


def grams(hashes: np.ndarray, k: int, base=_BASE) -> np.ndarray:
    """The hash of the k values from each position; shorter than the input by k - 1.

    A polynomial of the values, put together from runs of 1, 2, 4 ... of them.
    """
    n = max(len(hashes) - k + 1, 0)
    out, done, run, size, power = None, 0, hashes, 1, base
    while True:
        if k & size:
            part = run[done:done + n]
            out = part if out is None else out * power + part
            done += size
        if 2 * size > k:
            return mixed(out)
        run = run[:len(run) - size] * power + run[size:]
        size, power = 2 * size, power * power


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (np.minimum or np.maximum) of each ``width`` neighbours, in log(width) passes."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def minimisers(hashes: np.ndarray, windows: np.ndarray, k: int, m: int) -> np.ndarray:
    """Marks the positions that some window of k values selects: those of its smallest m-gram.

    ``windows`` marks the positions where a window lies in one document. Which m-gram a window
    selects depends on its own words alone; of equal m-grams all are marked.
    """
    gram = grams(hashes, m)
    width = k - m + 1
    smallest = sliding(gram, width, np.minimum)
    smallest = np.where(windows[:len(smallest)], smallest, 0)
    pad = np.zeros(width - 1, np.uint64)
    reached = sliding(np.concatenate([pad, smallest, pad]), width, np.maximum)
    return (reached[:len(gram)] == gram) & (gram > 0)


def prepared(spark):
    """Few rows in an Arrow batch, so that long texts stay within a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def usual_length(vectors: DataFrame, name: str) -> int:
    """The most frequent length of an array column, of equally frequent ones the longest; 0 without rows."""
    most = vectors.groupBy(F.size(name).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return most.d if most else 0


def with_blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """Documents dealt by hash into blocks of about BLOCK_BYTES of text (column block); how many blocks.

    One pass over the text lengths fixes the number of blocks, so a block keeps its size at any
    scale. A document is never cut; one that is longer than a block makes its block larger.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("double"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(least, int(size / BLOCK_BYTES) + 1)
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))), blocks


class Block:
    """The documents of one block as one array of word hashes, for work on all windows of k words.

    ``left`` counts the words from each position to its document's end. Documents of a null id have
    no windows.
    """

    def __init__(self, table: pa.Table, k: int):
        self.ids = table["doc_id"].to_numpy(zero_copy_only=False) if not table["doc_id"].null_count else np.array(
            [0 if i is None else i for i in table["doc_id"].to_pylist()], np.int64)
        self.words = [(t or b"").split() for t in texts_of(table["text"])]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.hashes = hash_words([w for ws in self.words for w in ws])
        n = len(self.hashes)
        self.doc = np.repeat(np.arange(len(self.words)), self.sizes)
        self.left = np.repeat(self.first + self.sizes, self.sizes) - np.arange(n)
        known = ~np.array(table["doc_id"].is_null().to_numpy(zero_copy_only=False), bool)
        self.windows = (self.left >= k) & np.repeat(known, self.sizes)
        self.windows = self.windows[:max(n - k + 1, 0)]


def starts_of(*columns) -> np.ndarray:
    """Starts of the runs of equal rows in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def ends_of(starts: np.ndarray, n: int) -> np.ndarray:
    """The last row of each run."""
    return np.append(starts[1:], n)[:len(starts)] - 1


def per_row(starts: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    """A run's value for every row of it."""
    return np.repeat(values, np.diff(np.append(starts, n)))


def columns_of(table: pa.Table, *names, kinds=None):
    """The values of binary columns one after the other, and the table row that each came from."""
    out = [np.frombuffer(b"".join(table[n].to_pylist()), np.int64 if n in (kinds or ()) else np.uint64) for n in names]
    sizes = [len(x) // 8 for x in table[names[0]].to_pylist()]
    return (*out, np.repeat(np.arange(len(sizes)), sizes))


def dealt(bucket: np.ndarray, block: int, **columns) -> pa.Table:
    """One row per bucket with the binary columns of the entries that fall into it."""
    order = np.argsort(bucket, kind="stable")
    starts = starts_of(bucket[order])
    ends = np.append(starts[1:], len(bucket))
    data = {"bucket": pa.array(bucket[order][starts].astype(np.int64)), "block": pa.array([block] * len(starts), pa.int64())}
    for name, values in columns.items():
        v = values[order]
        data[name] = pa.array([v[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())
    return pa.table(data)
