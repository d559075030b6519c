"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

Words are runs of letters, digits and non-ASCII, A-Z lower-cased; shingles are five consecutive words with their number, the
sequence itself for a shorter item. A shingle weighs log(1 + items / items that hold it), one that no
item holds as if one did. The similarity of an item and a window of as many words is the weighted
Jaccard of their shingles: sum of the smaller over sum of the larger counts, times the weights. A
document is contaminated by an item if some window reaches SIMILARITY.

1. Every position whose shingle hash an item holds is marked; a window can only reach the threshold
   if the weight marked in it by items of its size does. This bound loses nothing.
2. The other windows of item size get a 64-bit SimHash of their weighted shingles. Fingerprints are
   compared by a multi-index over BLOCKS blocks: two within RADIUS bits agree in one block up to
   RADIUS // BLOCKS bits, so probing every block with all variants at that distance finds them all.
3. Candidates are verified by the exact similarity on the words themselves.

The benchmark is taken in parts of PART items, each a broadcast of bounded size, with a pass over the
documents for each; the documents are never shuffled and a hot passage costs no more than another.
Weights come from the whole benchmark: with several parts, the shingles that two or more items hold
(all others weigh the most) go to every part by hash, in broadcasts of COMMON shingles.

Defined cases: null texts and items are empty; an empty item matches nothing; of several windows of
a document the most similar, then the first counts for an item; a null item_id or doc_id is carried;
repeated rows of documents give repeated rows, repeated items one match each; other columns are
ignored; an empty table gives an empty result.
"""

import functools
import itertools
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lograil.llm.common import grams, hash_words, mixed, texts_of
from lograil.llm.components import saved

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 23, 8
PART = 20_000
# Shingles of several items in one broadcast, 16 bytes each.
COMMON = 2_000_000
SHAPE = "doc_id long, item_id long, similarity double, start long, n_words long"
# Bytes: digits, letters and all of non-ASCII make words.
_GAPS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
# All differences of up to RADIUS // BLOCKS bits in one block of a fingerprint.
_VARIANTS = np.array([sum(1 << i for i in c) for n in range(RADIUS // BLOCKS + 1)
                      for c in itertools.combinations(range(64 // BLOCKS), n)], np.uint8)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_GAPS).split()


def shingles(words: list) -> Counter:
    """Shingles with their number; shorter sequences are one shingle."""
    k = min(SHINGLE, len(words))
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if k else Counter()


class Benchmark:
    """A part of the items, ready to be looked up."""

    def __init__(self, items: list[tuple], held: Counter, total: int):
        self.items = [(i, w, shingles(w)) for i, w in items]
        self.weight_of = {s: log(1 + total / held[s]) for _, _, sh in self.items for s in sh}
        self.most = log(1 + total)
        # By shingle size, sorted hashes and weights of the shingles that several items of any part hold.
        self.common = []
        self.sizes = {}
        for at, (_, words, _) in enumerate(self.items):
            self.sizes.setdefault(len(words), []).append(at)
        self.tables = {k: self._table(k) for k in {min(SHINGLE, n) for n in self.sizes}}
        self.index = {n: self._index(n, ats) for n, ats in self.sizes.items()}

    def _table(self, k):
        """Of the shingles of k words: sorted hashes, weights, a filter by low bits, by item size who holds them."""
        listed = [s for s in self.weight_of if len(s) == k]
        h = np.array([grams(hash_words(s), k)[0] for s in listed], np.uint64)
        order = np.argsort(h)
        some = np.zeros(1 << 20, bool)
        some[(h & np.uint64(len(some) - 1)).astype(np.int64)] = True
        weight = np.array([self.weight_of[listed[i]] for i in order])
        sizes = {n: {s for at in ats for s in self.items[at][2]} for n, ats in self.sizes.items()
                 if min(SHINGLE, n) == k}
        holds = {n: np.array([listed[i] in held for i in order]) for n, held in sizes.items()}
        return h[order], weight, some, holds

    def places(self, hashes, k):
        """Positions whose shingle hash some item holds, and the places of these in the table."""
        table, _, some, _ = self.tables[k]
        maybe = np.flatnonzero(some[(hashes & np.uint64(len(some) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(table, hashes[maybe]), len(table) - 1)
        hit = table[at] == hashes[maybe]
        return maybe[hit], at[hit]

    def weights(self, hashes, k):
        """Weight of every shingle: the highest where no item of any part holds it."""
        return self.weighed(hashes, k, *self.places(hashes, k))

    def weighed(self, hashes, k, hits, at):
        """Weights where the places in the table are known."""
        out = np.full(len(hashes), self.most)
        for piece in self.common:
            if k in piece:
                table, weight = piece[k]
                found = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
                out = np.where(table[found] == hashes, weight[found], out)
        out[hits] = self.tables[k][1][at]
        return out

    def weight(self, shingle: tuple) -> float:
        """Weight of one shingle, by its words if an item of this part holds it."""
        got = self.weight_of.get(shingle)
        if got is None and self.common:
            got = self.weights(grams(hash_words(shingle), len(shingle)), len(shingle))[0]
        return self.most if got is None else got

    def fingerprint(self, hashes, weights):
        """Weighted SimHash of shingle hashes, as bytes."""
        bits = np.unpackbits(mixed(hashes).view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64)
        return np.packbits(weights @ (2 * bits - 1) > 0)

    def _index(self, n, ats):
        """Block number and value to the items of n words with that block, and their fingerprints."""
        k, found, prints = min(SHINGLE, n), {}, []
        for place, at in enumerate(ats):
            h = grams(hash_words(self.items[at][1]), k)
            prints.append(self.fingerprint(h, self.weights(h, k)))
            for block, value in enumerate(prints[-1]):
                found.setdefault((block, int(value)), []).append(place)
        return found, np.array(prints)

    def within_radius(self, n, fingerprint):
        """The items of n words whose fingerprint differs in at most RADIUS bits."""
        found, prints = self.index[n]
        places = {p for block, value in enumerate(fingerprint) for x in _VARIANTS ^ value
                  for p in found.get((block, int(x)), ())}
        places = np.array(sorted(places), np.int64)
        near = np.bitwise_count(prints[places] ^ fingerprint).sum(1) <= RADIUS
        return [self.sizes[n][p] for p in places[near]]

    def similarity(self, item: Counter, window: Counter) -> float:
        """Weighted Jaccard of two shingle counters."""
        low = high = 0.0
        for s in item.keys() | window.keys():
            w = self.weight(s)
            low += w * min(item[s], window[s])
            high += w * max(item[s], window[s])
        return low / high if high else 0.0

    def matches(self, text: bytes | None):
        """(item number, similarity, start, words): the best window of each item that reaches SIMILARITY."""
        words, best = words_of(text), {}
        hashes = hash_words(words)
        for k in self.tables:
            if len(words) < k:
                continue
            h = grams(hashes, k)
            hits, place = self.places(h, k)
            if not len(hits):
                continue
            weight = self.weighed(h, k, hits, place)
            total = np.concatenate([[0.0], np.cumsum(weight)])
            for n, holds in self.tables[k][3].items():
                own, m = hits[holds[place]], n - k + 1  # m shingles in a window
                if not len(own) or n > len(words):
                    continue
                shared = np.zeros(len(h))
                shared[own] = weight[own]
                shared = np.concatenate([[0.0], np.cumsum(shared)])
                starts = np.unique((own[:, None] - np.arange(m)[None, :]).ravel())
                starts = starts[(starts >= 0) & (starts + m <= len(h))]
                # The weight shared with items of this size over all weight bounds the similarity.
                bound = (shared[starts + m] - shared[starts]) / (total[starts + m] - total[starts])
                for s in starts[bound >= SIMILARITY - 1e-9].tolist():
                    window, w = None, weight[s:s + m]
                    for at in self.within_radius(n, self.fingerprint(h[s:s + m], w)):
                        window = window or shingles(words[s:s + n])
                        got = self.similarity(self.items[at][2], window)
                        if got >= SIMILARITY - 1e-12 and (at not in best or got > best[at][0] + 1e-12):
                            best[at] = (got, s, n)
        return [(at, *x) for at, x in sorted(best.items())]


def _part_matches(docs: DataFrame, benchmark: Benchmark, common: list) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(benchmark)

    def run(batches):
        known = model.value
        known.common = [c.value for c in common]
        for batch in batches:
            out = [(d, known.items[at][0], got, s, n) for d, t in
                   zip(batch["doc_id"].to_pylist(), texts_of(batch["text"])) for at, got, s, n in known.matches(t)]
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "item_id", "similarity", "start", "n_words"])
    return docs.select("doc_id", "text").mapInArrow(run, SHAPE)


def _without_matches(docs: DataFrame, benchmark: Benchmark, common: list) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(benchmark)

    def run(batches):
        known = model.value
        known.common = [c.value for c in common]
        for batch in batches:
            yield batch.filter(pa.array([not known.matches(t) for t in texts_of(batch["text"])], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def _parts(benchmark: DataFrame, part: int):
    """The benchmark as lookups of at most about ``part`` items, and broadcasts of the shingles they share.

    Shingle frequencies are counted over the whole benchmark; its items come to the driver part by part.
    """
    total = benchmark.count()
    parts = total // part + 1
    dealt = benchmark.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).alias("part"))
    common = common_weights(dealt, total) if parts > 1 else []
    for p in range(parts):
        rows = dealt.where(F.col("part") == p).orderBy("item_id", "text").collect()
        items = [(r.item_id, w) for r in rows if (w := words_of((r.text or "").encode()))]
        if items:
            held = Counter(s for _, w in items for s in shingles(w)) if parts == 1 else frequencies(dealt, p)
            yield Benchmark(items, held, total), common


def contaminated(docs: DataFrame, benchmark: DataFrame, part: int = PART) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words): the best window of each item in each document."""
    found = [_part_matches(docs, known, common) for known, common in _parts(benchmark, part)]
    return functools.reduce(DataFrame.union, found, docs.sparkSession.createDataFrame([], SHAPE))


def _counted(dealt: DataFrame, *more) -> DataFrame:
    """(s, n, more...): in how many items of all parts each shingle stands."""
    def run(batches):
        for batch in batches:
            out = [(p, b"\x00".join(s)) for p, t in zip(batch["part"].to_pylist(), texts_of(batch["text"]))
                   for s in shingles(words_of(t))]
            p, s = list(zip(*out)) or ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(s, pa.binary())], ["part", "s"])
    return dealt.select("part", "text").mapInArrow(run, "part long, s binary").groupBy("s").agg(
        F.count("*").alias("n"), *more)


def frequencies(dealt: DataFrame, part: int) -> Counter:
    """In how many items of all parts each shingle of one part stands."""
    counts = _counted(dealt, F.max((F.col("part") == part).cast("int")).alias("own"))
    return Counter({tuple(bytes(r.s).split(b"\x00")): r.n for r in counts.where("own = 1").select("s", "n").collect()})


def common_weights(dealt: DataFrame, total: int) -> list:
    """Broadcasts of at most about COMMON shingles that several items hold: by size, sorted hashes and weights."""
    def run(batches):
        for batch in batches:
            listed = [bytes(s).split(b"\x00") for s in batch["s"].to_pylist()]
            h = np.array([grams(hash_words(s), len(s))[0] for s in listed], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array([len(s) for s in listed], pa.int64()),
                                              pa.array(h.view(np.int64)), batch["n"]], ["k", "h", "n"])
    spark = dealt.sparkSession
    hashes = saved(_counted(dealt).where("n > 1").mapInArrow(run, "k long, h long, n long"), "common-shingles")
    pieces, out = hashes.count() // COMMON + 1, []
    for p in range(pieces):
        rows = hashes.where(F.pmod("h", F.lit(pieces)) == p).toArrow()
        k, h, n = (rows[c].to_numpy() for c in ("k", "h", "n"))
        h, piece = h.view(np.uint64), {}
        for size in np.unique(k).tolist():
            order = np.flatnonzero(k == size)
            order = order[np.argsort(h[order])]
            piece[size] = h[order], np.log(1 + total / n[order])
        out.append(spark.sparkContext.broadcast(piece))
    return out


def kept_documents(docs: DataFrame, benchmark: DataFrame, part: int = PART) -> DataFrame:
    """The documents in which no item stands; every column as it was."""
    for known, common in _parts(benchmark, part):
        docs = _without_matches(docs, known, common)
    return docs
