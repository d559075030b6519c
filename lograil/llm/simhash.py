"""SimHash near-dedup by meeting in the middle of Hamming balls.

Two fingerprints that differ in RADIUS (3) bits or fewer differ in at most one bit, half the radius,
in one of their two 32-bit halves. So every fingerprint emits each half and all variants of it within
that distance (66 keys), and also each half as it is (2 keys, marked). Rows meet by a shuffle on the
variant; two that meet are verified on the whole fingerprint. Emitting full-width variants instead
would take the ball of two bits (2,081 keys a fingerprint), thirty times the shuffle.

Equal fingerprints are one node before anything is emitted. A group of rows on one variant is not
expanded into its pairs: inside it the same ball hashing runs on the other half, and what leaves is a
spanning forest of the links. Half values with very many different fingerprints are dealt on by the
bytes of the other half, one of which must agree. Components of the links close the relation.

Defined cases: null text counts as empty; a text without words has fingerprint zero and is linked
like any other; repeated rows and equal texts share a fingerprint; a null doc_id is carried and takes
part in links, a component whose documents all have null ids has null as its id; other columns are
ignored; an empty table gives an empty result.
"""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lograil.llm.common import starts_of, texts_of
from lograil.llm.components import components, saved

SEED, WORDS, RADIUS = 42, 3, 3
# Different fingerprints on one half value from which the value is dealt on by the other half's bytes.
CROWDED = 200_000
# Comparisons up to which the rows of one variant are compared outright.
OUTRIGHT = 4_000_000
_LOW = 0xFFFFFFFF


def fingerprint(text: bytes | None) -> int:
    """The 64-bit SimHash of a text's shingles, signed."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and ASCII white space
    if not words:
        return 0
    n = max(len(words) - WORDS + 1, 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(WORDS)))) if len(words) >= WORDS else [b" ".join(words)]
    digest = b"".join([xxhash.xxh64_digest(s, SEED) for s in shingles])
    counts = np.zeros(64, np.int64)
    step = 255 * 64  # rows are summed in bytes, so in runs of 255
    for at in range(0, len(digest), 8 * step):
        bits = np.unpackbits(np.frombuffer(digest[at:at + 8 * step], np.uint8)).reshape(-1, 64)
        for i in range(0, len(bits), 255):
            counts += bits[i:i + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, key, fp long) of every document; ``key`` tells rows of one id apart by their text."""
    def run(batches):
        for batch in batches:
            fps = [fingerprint(t) for t in texts_of(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["key"], pa.array(fps, pa.int64())], ["doc_id", "key", "fp"])
    rows = docs.select(F.col("doc_id").cast("long"), _row_key(), "text")
    return rows.mapInArrow(run, "doc_id long, key long, fp long")


def _row_key():
    return F.xxhash64("doc_id", "text").alias("key")


def _weights(masks, bits):
    return np.array([sum(1 << i for i in c) for w in masks for c in itertools.combinations(range(bits), w)], np.uint64)


NEAR, FAR = _weights((0, 1), 32), _weights((0, 1, 2), 32)


def joined(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each of n items' components under the links a - b."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(label, label[label]):
            label = label[label]
    return label


def _lookup(keys, values):
    """For each value its place in sorted keys, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return at, keys[at] == values


def bucket_links(fps: np.ndarray, exact: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links within RADIUS between the fingerprints of one variant.

    ``exact`` marks those whose half is the variant itself; a link has one such side at least.
    ``shift`` is where that half begins; the other half decides.
    """
    n, centre = len(fps), np.flatnonzero(exact)
    if len(centre) * n <= OUTRIGHT:  # few enough to compare outright, a chunk of rows at a time
        a, b = [], []
        chunk = max(1, 200_000 // n)
        for i in range(0, len(centre), chunk):
            rows = centre[i:i + chunk]
            x, y = np.nonzero(np.bitwise_count(fps[rows, None] ^ fps[None, :]) <= RADIUS)
            label = joined(n, rows[x], y)
            kept = np.flatnonzero(label != np.arange(n))
            a.append(kept)
            b.append(label[kept])
        label = joined(n, np.concatenate(a), np.concatenate(b))
    else:
        # The middle: variants of the other half within one bit, each with one of its owners.
        other = (fps >> np.uint64(32 - shift)) & np.uint64(_LOW)
        variants = (other[centre, None] ^ NEAR[None, :]).ravel()
        owner = np.repeat(centre, len(NEAR))
        order = np.argsort(variants, kind="stable")
        variants, owner = variants[order], owner[order]
        starts = starts_of(variants)
        keeper = np.repeat(owner[starts], np.diff(np.append(starts, len(variants))))
        label = joined(n, owner, keeper)
        variants, keeper = variants[starts], owner[starts]
        for mask in FAR:  # other rows at up to two bits from it; one where the first half took a bit
            rows = np.arange(n) if np.bitwise_count(mask) < 2 else centre
            at, there = _lookup(variants, other[rows] ^ mask)
            label = joined(n, np.concatenate([np.arange(n), rows[there]]), np.concatenate([label, keeper[at[there]]]))
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def _links(batches):
    """Links of rows (key, sub, fp, exact) that come sorted by key and sub, group by group."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        if batch is None:
            rows, rest = rest, None
        else:
            own = [batch[c].to_numpy(zero_copy_only=False) for c in ("key", "sub", "fp", "exact")]
            rows = own if rest is None else [np.concatenate(x) for x in zip(rest, own)]
            last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1])) if len(rows[0]) else ()
            cut = last[-1] + 1 if len(last) else 0
            rest, rows = [x[cut:] for x in rows], [x[:cut] for x in rows]
        if rows is None or not len(rows[0]):
            continue
        key, sub, fp, exact = rows
        starts = starts_of(key, sub)
        ends = np.append(starts[1:], len(key))
        found = np.add.reduceat(exact.astype(np.int64), starts)
        a, b = [], []
        for i in np.flatnonzero((found > 0) & (ends - starts > 1)):
            part = slice(starts[i], ends[i])
            fps = fp[part].view(np.uint64)
            x, y = bucket_links(fps, exact[part], int(key[starts[i]] >> 32) * 32)
            a.append(fps[x].view(np.int64))
            b.append(fps[y].view(np.int64))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])


def _keys(fps: DataFrame) -> DataFrame:
    """(key, sub, fp, exact): both halves of every fingerprint and their one-bit variants.

    A key holds the half's number and value. ``sub`` is 0, or a byte of the other half for a value
    that is crowded (the list of those is at most distinct fingerprints / CROWDED long).
    """
    low, high = F.col("fp").bitwiseAND(_LOW), F.shiftrightunsigned("fp", 32)
    halves = fps.select("fp", F.explode(F.array(low, high.bitwiseOR(1 << 32))).alias("half"))
    crowded = [r[0] for r in halves.groupBy("half").count().where(F.col("count") > CROWDED).select("half").collect()]
    masks = F.array(*[F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(32)]])
    keys = halves.select("fp", "half", F.explode(masks).alias("mask")).select(
        F.col("half").bitwiseXOR(F.col("mask")).alias("key"), "fp", (F.col("mask") == 0).alias("exact"))
    other = F.when(F.shiftright("key", 32) == 0, high).otherwise(low)
    of_bytes = F.array(*[F.shiftright(other, 8 * i).bitwiseAND(255) + (256 * (i + 1)) for i in range(4)])
    if not crowded:
        return keys.withColumn("sub", F.lit(0).cast("long"))
    return keys.withColumn("sub", F.explode(F.when(F.col("key").isin(crowded), of_bytes).otherwise(
        F.array(F.lit(0).cast("long")))))


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links between different fingerprints that connect all within RADIUS."""
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _keys(fps).repartition(n, "key", "sub").sortWithinPartitions("key", "sub", "fp")
    return dealt.select("key", "sub", "fp", "exact").mapInArrow(_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, key, fp, group, component_id): the smallest doc_id reachable over links, the own included.

    ``group`` is the component as its smallest fingerprint; it stands also where all ids are null.
    """
    own = saved(fingerprints(docs), "simhash")
    fps = saved(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    of_fp = components(saved(links(fps), "simhash-links"))
    named = fps.join(of_fp, fps.fp == of_fp.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("group"))
    least = named.groupBy("group").agg(F.min("first").alias("component_id"))
    return own.join(named.join(least, "group").drop("first"), "fp").select(
        "doc_id", "key", "fp", "group", "component_id")


def kept_documents(docs: DataFrame) -> DataFrame:
    """One document of each component, its smallest doc_id (null last); every column as it was."""
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("key").alias("key"))
    # Rows are known by id and hash, under names that no column of theirs has.
    spare = "_" * (1 + max(map(len, docs.columns)))
    known = [spare + "id", spare + "key"]
    keepers = near_duplicates(docs).groupBy("group").agg(F.min(order).alias("first")).select(
        F.coalesce("first.id", F.lit(0)).cast("long").alias(known[0]), F.col("first.key").alias(known[1]))
    rows = docs.withColumns({known[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), known[1]: _row_key()})
    return rows.join(keepers, known, "left_semi").dropDuplicates(known).select(*docs.columns)


def summary(docs: DataFrame) -> DataFrame:
    """Per document: fingerprint as 16 hex digits, component."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
