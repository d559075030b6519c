"""Substring dedup by a sparse suffix array.

Of all suffixes (word positions) only those at minimisers are kept: the position of the smallest
M-word hash of every window of LEAST words. Equal passages of LEAST words or more select the same
positions, so each of them contains a sampled suffix in every document that holds it.

1. Blocks of documents tell the buckets which minimisers they hold; a minimiser of one document
   only cannot start a repeat and goes. Hot ones come once per block, not once per document.
2. The windows of LEAST words that selected a remaining suffix decide what repeats: every block sends
   each of its different windows (128 bits) with its two smallest documents to the window's bucket,
   which answers with the two smallest of all. No neighbourhood, chunk or part has a say in this.
3. The suffixes that repeated windows selected carry REACH words to the right and to the left as word hashes. They are
   sorted by the words to the right, then by those to the left, read backwards. Each is compared with its
   nearest neighbours of other documents and the match is extended to the right and to the left; LEAST
   words or more in common are a match, with its place in both documents. The suffixes of the first and
   the last document of each sorted part also meet those of the parts beside it, so that the order alone
   decides who is whose neighbour, not the number of parts.
4. Matches with one document that advance in step are extended into alignments. Overlapping windows of a
   document are merged into maximal spans, and each span carries its longest alignment: which document
   the passage stands in, and where. The windows alone know that a passage repeats; only the sorted
   order knows where its longest copy is. Nearest neighbours are not all neighbours: an alignment is a
   true one, but a longer one may exist, and a span of which none was met has null there.

The sort is Spark's range partitioning over all of the key and the document, and windows are dealt by
their own hash, so that a passage or phrase in a third of all documents spreads over many tasks.

Defined cases: null text has no words; documents of fewer than LEAST words have no spans; rows of a
null doc_id take no part; repeats inside one document, or between rows of one id, do not count; ties
in the order are broken by doc_id and position; other columns are ignored; an empty table gives an
empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lograil.llm.common import (
    Block, columns_of, dealt, ends_of, grams, minimisers, mixed, per_row, sliding, starts_of, with_blocks)
from lograil.llm.components import saved

LEAST, SAMPLED = 50, 8
REACH = LEAST
# Sorted suffixes that are compared at a time.
CHUNK = 20_000
_STEP, _SECOND = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
SUFFIX = "anchor long, right binary, left binary, doc_id long, at long, n_left int, n_right int"
MATCH = "doc_id long, start long, end long, other_id long, other_start long"
_MATCHED = ("doc_id", "start", "end", "other_id", "other_start")


def _sampled(table):
    """A block, the positions of its sampled suffixes and their minimisers' hashes."""
    block = Block(table, LEAST)
    marked = minimisers(block.hashes, block.windows, LEAST, SAMPLED)
    # An m-gram over a document's end belongs to no window.
    at = np.flatnonzero(marked & (block.left[:len(marked)] >= SAMPLED))
    return block, at, grams(block.hashes, SAMPLED)[at]


def _minimiser_entries(buckets):
    def run(table):
        block, at, anchor = _sampled(table)
        doc = block.ids[block.doc[at]]
        order = np.lexsort((doc, anchor))
        anchor, doc = anchor[order], doc[order]
        starts = starts_of(anchor)
        ends = ends_of(starts, len(anchor))
        return dealt(mixed(anchor[starts] + _STEP) % np.uint64(buckets), table["block"][0].as_py(),
                     anchor=anchor[starts], low=doc[starts], high=doc[ends])
    return run


def _shared_minimisers(table):
    """The minimisers of a bucket that stand in several documents, for each block that holds them."""
    anchor, low, high, row = columns_of(table, "anchor", "low", "high", kinds=("low", "high"))
    order = np.argsort(anchor, kind="stable")
    anchor, low, high, row = (x[order] for x in (anchor, low, high, row))
    starts = starts_of(anchor)
    shared = np.minimum.reduceat(low, starts) < np.maximum.reduceat(high, starts)
    shared = np.repeat(shared, np.diff(np.append(starts, len(anchor))))
    out = dealt(row[shared], 0, anchor=anchor[shared])
    return pa.table({"block": table["block"].take(out["bucket"]), "anchors": out["anchor"]})


def _hashed(block, at):
    """The two hashes of the windows at some positions."""
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return grams(block.hashes, LEAST)[at], grams(block.hashes, LEAST, _SECOND)[at]


def _window_entries(buckets):
    """The different windows of a block at shared minimisers, each with its two smallest documents."""
    def run(table, shared):
        if not len(table) or not len(shared):
            return dealt(np.zeros(0, np.uint64), 0, **{c: np.zeros(0) for c in ("one", "two", "doc")})
        block = Block(table, LEAST)
        at = np.flatnonzero(block.windows)
        least = sliding(grams(block.hashes, SAMPLED), LEAST - SAMPLED + 1, np.minimum)[at]
        at = at[np.isin(least, np.frombuffer(b"".join(shared["anchors"].to_pylist()), np.uint64))]
        one, two = _hashed(block, at)
        doc = block.ids[block.doc[at]]
        order = np.lexsort((doc, two, one))
        order = order[starts_of(one[order], two[order], doc[order])]
        starts = starts_of(one[order], two[order])
        order = order[np.arange(len(order)) - per_row(starts, len(order), starts) < 2]
        return dealt(mixed(one[order] + _STEP) % np.uint64(buckets), table["block"][0].as_py(), one=one[order],
                     two=two[order], doc=doc[order])
    return run


def _window_bucket(table):
    """The windows of several documents with the two smallest of these, for each block that holds them."""
    one, two, doc, row = columns_of(table, "one", "two", "doc", kinds=("doc",))
    order = np.lexsort((row, doc, two, one))
    one, two, doc, row = (x[order] for x in (one, two, doc, row))
    starts, n = starts_of(one, two), len(one)
    low = per_row(starts, n, doc[starts])
    second = np.minimum.reduceat(np.where(doc > low, doc, np.iinfo(np.int64).max), starts)
    repeats = per_row(starts, n, doc[starts] < doc[ends_of(starts, n)])
    one, two, low, second, row = (x[repeats] for x in (one, two, low, per_row(starts, n, second), row))
    # A block that sent two documents is answered once.
    order = np.lexsort((two, one, row))
    order = order[starts_of(row[order], one[order], two[order])]
    out = dealt(row[order], 0, one=one[order], two=two[order], low=low[order], second=second[order])
    return pa.table({"block": table["block"].take(out["bucket"]), **{c: out[c] for c in ("one", "two", "low", "second")}})


def _repeated(table, answers):
    """A block, the positions of its repeated windows and the smallest other document that holds each."""
    one, two, low, second, _ = columns_of(answers, "one", "two", "low", "second", kinds=("low", "second"))
    order = np.lexsort((two, one))
    one, two, low, second = (x[order] for x in (one, two, low, second))
    block = Block(table, LEAST)
    at = np.flatnonzero(block.windows)
    mine, also = _hashed(block, at)
    place = np.minimum(np.searchsorted(one, mine), len(one) - 1)
    hit = (one[place] == mine) & (two[place] == also)
    at, place = at[hit], place[hit]
    return block, at, np.where(low[place] == block.ids[block.doc[at]], second[place], low[place])


def _found(table, answers):
    """The runs of repeated windows of a block as matches, and the suffixes that these windows selected."""
    if not len(table) or not len(answers):
        return _filled(pa.table({}))
    block, at, other = _repeated(table, answers)
    if not len(at):
        return _filled(pa.table({}))
    starts = starts_of(block.doc[at], at - np.arange(len(at)))
    first = block.first[block.doc[at[starts]]]
    runs = pa.table({
        "doc_id": pa.array(block.ids[block.doc[at[starts]]]), "start": pa.array(at[starts] - first),
        "end": pa.array(at[ends_of(starts, len(at))] - first + LEAST),
        "other_id": pa.array(np.minimum.reduceat(other, starts))})
    return pa.concat_tables([_filled(runs), _filled(_contexts(block, at))])


def _contexts(block, windows):
    """The suffixes that some windows selected, with the words around them as 4-byte hashes."""
    some = np.zeros(len(block.windows), bool)
    some[windows] = True
    at = np.flatnonzero(minimisers(block.hashes, some, LEAST, SAMPLED))
    anchor = grams(block.hashes, SAMPLED)[at]
    short = np.concatenate([np.zeros(REACH, ">u4"), (block.hashes >> np.uint64(32)).astype(">u4"), np.zeros(REACH, ">u4")])
    first = block.first[block.doc[at]]
    n_right, n_left = np.minimum(block.left[at], REACH), np.minimum(at - first, REACH)
    span = np.arange(REACH)
    right = short[at[:, None] + REACH + span]
    left = short[at[:, None] + REACH - 1 - span]
    right[span[None, :] >= n_right[:, None]] = 0
    left[span[None, :] >= n_left[:, None]] = 0
    size = pa.binary(4 * REACH)
    return pa.table({
        "anchor": pa.array(anchor.view(np.int64)),
        "right": pa.Array.from_buffers(size, len(at), [None, pa.py_buffer(right.tobytes())]).cast(pa.binary()),
        "left": pa.Array.from_buffers(size, len(at), [None, pa.py_buffer(left.tobytes())]).cast(pa.binary()),
        "doc_id": pa.array(block.ids[block.doc[at]]), "at": pa.array(at - first),
        "n_left": pa.array(n_left.astype(np.int32)), "n_right": pa.array(n_right.astype(np.int32))})


_KINDS = {"anchor": pa.int64(), "right": pa.binary(), "left": pa.binary(), "doc_id": pa.int64(), "at": pa.int64(),
          "n_left": pa.int32(), "n_right": pa.int32()}


def _equal(words, n, a, b):
    """How many leading words of rows a and b agree, up to the words that both have."""
    same = words[a] == words[b]
    run = np.where(same.all(axis=1), words.shape[1], same.argmin(axis=1)) if len(a) else np.zeros(0, np.int64)
    return np.minimum(run, np.minimum(n[a], n[b]))


def neighbour_matches(table: pa.Table) -> pa.Table:
    """The matches of every suffix with its nearest neighbours of other documents, before and after it."""
    n = table.num_rows
    doc, at, n_left, n_right, anchor = (table[c].to_numpy() for c in ("doc_id", "at", "n_left", "n_right", "anchor"))
    right = np.frombuffer(b"".join(table["right"].to_pylist()), ">u4").reshape(n, REACH)
    left = np.frombuffer(b"".join(table["left"].to_pylist()), ">u4").reshape(n, REACH)
    found = []
    runs = starts_of(anchor, doc)
    ends = np.append(runs[1:], n)
    each = np.repeat(np.arange(len(runs)), ends - runs)
    for place in (runs[each] - 1, ends[each]):
        a = np.flatnonzero((place >= 0) & (place < n))
        b = place[a]
        met = anchor[a] == anchor[b]
        a, b = a[met], b[met]
        r, l = _equal(right, n_right, a, b), _equal(left, n_left, a, b)
        hit = (r >= SAMPLED) & (r + l >= LEAST)
        a, b, r, l = a[hit], b[hit], r[hit], l[hit]
        found.append((doc[a], at[a] - l, at[a] + r, doc[b], at[b] - l))
    return pa.table({c: pa.array(np.concatenate(x).astype(np.int64)) for c, x in zip(_MATCHED, zip(*found))})


def _chunks(batches):
    """Sorted rows in tables of CHUNK rows or more. Each begins with the tail of the one before it: the last
    minimiser's rows, or, where these are many, its last document's and one more."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK:
            rows = pa.Table.from_batches(held).combine_chunks()
            yield rows
            anchor, doc = rows["anchor"].to_numpy(), rows["doc_id"].to_numpy()
            tail = starts_of(anchor)[-1]
            if len(anchor) - tail >= CHUNK // 2:
                tail = max(starts_of(anchor, doc)[-1] - 1, 0)
            held = rows.slice(tail).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _compare(batches):
    """Matches of one sorted part; the suffixes of its first and last document leave too, for the parts beside it."""
    first, rows = True, None
    for rows in _chunks(b for b in batches if b.num_rows):
        runs = _runs(rows)
        # A chunk of one document and minimiser comes again, whole, with the next.
        if first and len(runs) > 1:
            yield from _edge(rows.slice(0, runs[1]))
            first = False
        yield from _filled(neighbour_matches(rows)).to_batches()
    if rows is not None:
        yield from _edge(rows if first else rows.slice(_runs(rows)[-1]))


def _runs(rows):
    """Where each run of suffixes of one minimiser and document starts."""
    return starts_of(rows["anchor"].to_numpy(), rows["doc_id"].to_numpy())


def _filled(found):
    for name, kind in {**dict.fromkeys(_MATCHED[1:], pa.int64()), **_KINDS}.items():
        if name not in found.column_names:
            found = found.append_column(name, pa.nulls(found.num_rows, kind))
    return found.select(_COLUMNS)


def _edge(rows):
    return _filled(rows).to_batches()


_COLUMNS = [*_MATCHED[1:], *_KINDS]


def _across(batches):
    """Matches between the last document of a part and the first of the next; parts come in order."""
    rows = pa.Table.from_batches(list(batches))
    if rows.num_rows:
        yield from neighbour_matches(rows.select(list(_KINDS))).to_batches()


def matches(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, start, end, other_id): runs of windows that stand in another document too, not merged yet, and
    (doc_id, start, end, other_id, other_start): matches of sorted neighbours."""
    blocks, buckets = with_blocks(docs.select("doc_id", "text"))
    by_block = blocks.groupBy("block")
    shared = (by_block.applyInArrow(_minimiser_entries(buckets), "bucket long, block long, anchor binary, low binary, high binary")
              .groupBy("bucket").applyInArrow(_shared_minimisers, "block long, anchors binary"))
    entries = by_block.cogroup(shared.groupBy("block")).applyInArrow(
        _window_entries(buckets), "bucket long, block long, one binary, two binary, doc binary")
    answers = saved(entries.groupBy("bucket").applyInArrow(
        _window_bucket, "block long, one binary, two binary, low binary, second binary"), "suffix-windows")
    both = "start long, end long, other_id long, other_start long, " + SUFFIX
    repeats = saved(by_block.cogroup(answers.groupBy("block")).applyInArrow(_found, both), "suffixes")
    windows = repeats.where(F.col("start").isNotNull()).select("doc_id", "start", "end", "other_id")
    suffixes = repeats.where(F.col("start").isNull()).select(*_KINDS)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["anchor", "right", "left", "doc_id", "at"]
    parts = suffixes.repartitionByRange(n, *order).sortWithinPartitions(*order)
    found = saved(parts.mapInArrow(_compare, both), "suffix-neighbours")
    inside = found.where(F.col("start").isNotNull()).select(*_MATCHED)
    # Suffixes of one minimiser and two documents per part: their number is that of the parts, not of the rows.
    edges = found.where(F.col("start").isNull()).select(*_KINDS).repartition(1).sortWithinPartitions(*order)
    return windows, inside.union(edges.mapInArrow(_across, MATCH))


def _islands(rows: DataFrame, within: list[str], name: str) -> DataFrame:
    """Numbers the groups of overlapping spans among rows that agree in some columns."""
    by = Window.partitionBy(*within).orderBy("start", "end")
    return (rows.withColumn("reach", F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("new", F.when(F.col("start") <= F.col("reach"), 0).otherwise(1))
            .withColumn(name, F.sum("new").over(by)).drop("reach", "new"))


def alignments(found: DataFrame) -> DataFrame:
    """(doc_id, start, end, other_id, other_start): matches extended by those that advance in step with them."""
    step = ["doc_id", "other_id", "shift"]
    steps = found.withColumn("shift", F.col("other_start") - F.col("start"))
    return (_islands(steps, step, "island").groupBy(*step, "island")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .select("doc_id", "start", "end", "other_id", (F.col("start") + F.col("shift")).alias("other_start")))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, n_words, other_id, match_id, match_start, match_words, match_at): maximal word spans
    that repeat across documents.

    ``other_id`` is the smallest other document that holds LEAST words of the span in a row. The longest
    alignment in the span has ``match_words`` words from ``match_at`` on; they stand in ``match_id`` from
    word ``match_start`` on. Of equally long ones the smallest document, then the first place counts.
    """
    windows, found = matches(docs)
    # Dealt by document once; all that follows is sorted and grouped inside it.
    rows = (windows.withColumn("other_start", F.lit(None).cast("long")).repartition("doc_id")
            .union(alignments(found.repartition("doc_id"))))
    n_words = F.col("end") - F.col("start")
    longest = F.when(F.col("other_start").isNotNull(),
                     F.struct(n_words.alias("n"), -F.col("other_id"), -F.col("start"), -F.col("other_start")))
    return (_islands(rows, ["doc_id"], "span").groupBy("doc_id", "span")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("other_id").alias("other_id"),
                 F.max(longest.cast("struct<n:long,id:long,at:long,place:long>")).alias("best"))
            .select("doc_id", "start", "end", n_words.alias("n_words"), "other_id", (-F.col("best.id")).alias("match_id"),
                    (-F.col("best.place")).alias("match_start"), F.col("best.n").alias("match_words"),
                    (-F.col("best.at")).alias("match_at")))
