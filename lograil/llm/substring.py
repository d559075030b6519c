"""Substring dedup: words that repeat a window of an earlier document go.

The k-word windows of all documents are the edges of a De Bruijn graph (its nodes are the k - 1 words
that neighbouring windows share). Each edge belongs to its minimiser, its smallest m-word hash, and a
run of a document's edges with one minimiser is a path. Where all documents take one path through a
minimiser the graph does not branch there: the path is compacted to a single entry with one source
coordinate, the place in the smallest document that holds it. Only where different paths meet in one minimiser are
edges told apart, and of each path only by its source document, since all others repeat it whole.

1. Every block of documents sends its paths (minimiser, content, smallest and largest document) to
   the minimiser's bucket, each once however many documents of the block hold it.
2. A bucket answers each block which paths have an earlier source, and which branch.
3. Source documents of branching paths send single edges, joined by their own hash alike.
4. Per document, neighbouring repeated windows whose source coordinates advance in step are one long
   span with one source; where they do not, the span is cut, since no single passage of a source
   stands behind it. The words of all spans go.

Paths and edges are identified by 128 bits of two hashes over 64-bit word hashes. Copies of a group
meet only as one entry per block, so no group lands in one task; blocks and buckets have bounded size.

Defined cases: null text has no words; documents of fewer than k words are kept whole; a null doc_id
neither removes nor loses words; rows of one doc_id never remove words from each other; windows are
judged on the input; extra columns are carried by ``deduplicated``; an empty table stays empty.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lograil.llm.common import (Block, columns_of, dealt, ends_of, grams, mixed, per_row, sliding, starts_of,
                                with_blocks)

WINDOW, MINIMISER = 13, 5
_STEP, _SECOND = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
SOURCED, BRANCHING, EDGE = 0, 1, 2
ANSWER = "block long, kind int, keys binary, source binary, place binary"


def _joined(a, b):
    """One key of two, for looking up within a block."""
    return mixed(a * _SECOND + b)


class Paths(Block):
    """A block's windows, cut into paths: runs with one minimiser."""

    def __init__(self, table, k=WINDOW, m=MINIMISER):
        super().__init__(table, k)
        self.k = k
        self.at = np.flatnonzero(self.windows)
        least = sliding(grams(self.hashes, m), k - m + 1, np.minimum)[self.at]
        edge = grams(self.hashes, k)[self.at]
        self.starts = starts_of(least, self.at - np.arange(len(self.at)))
        self.anchor = least[self.starts]
        place = np.arange(len(self.at)) - per_row(self.starts, len(self.at), self.starts)
        content = mixed(edge + place.astype(np.uint64) * _STEP)
        self.path = mixed(np.add.reduceat(content, self.starts)) if len(self.starts) else content
        self.edge = edge
        self.owner = self.ids[self.doc[self.at[self.starts]]]
        self.offset = place  # of a window in its path
        self.place = self.at - self.first[self.doc[self.at]]  # of a window in its document
        self.key = _joined(self.anchor, self.path)

    def of_windows(self, values):
        return per_row(self.starts, len(self.at), values)

    def second(self, rows):
        """A second hash of some windows."""
        out = np.zeros(len(rows), np.uint64)
        for j in range(self.k):
            out = (out + self.hashes[self.at[rows] + j]) * _SECOND
            out ^= out >> np.uint64(29)
        return out


def _found(keys, wanted, values, default):
    """values of the keys (sorted, unique) at ``wanted``; default where absent."""
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


_NONE = np.iinfo(np.int64).max


def _answers(table, kind):
    """Sorted keys of the answers of one kind, their source documents and the places in these."""
    rows = table.filter(pc.equal(table["kind"], kind))
    keys, source, place, _ = columns_of(rows, "keys", "source", "place", kinds=("source", "place"))
    order = np.argsort(keys)
    return keys[order], source[order], place[order]


def _path_entries(buckets):
    def run(table):
        p = Paths(table)
        order = np.lexsort((p.place[p.starts], p.owner, p.path, p.anchor))
        anchor, path, doc, place = p.anchor[order], p.path[order], p.owner[order], p.place[p.starts][order]
        starts = starts_of(anchor, path)
        ends = ends_of(starts, len(anchor))
        a = anchor[starts]
        return dealt(mixed(a + _STEP) % np.uint64(buckets), table["block"][0].as_py(), anchor=a, path=path[starts],
                     low=doc[starts], high=doc[ends], place=place[starts])
    return run


def _answered(table, rows, kind, keys, source, place):
    """Answers by the block that asked."""
    out = dealt(rows, 0, keys=keys, source=source, place=place)
    block = table["block"].take(out["bucket"])
    return pa.table({"block": block, "kind": pa.array([kind] * len(block), pa.int32()), "keys": out["keys"],
                     "source": out["source"], "place": out["place"]})


def _path_bucket(table):
    anchor, path, low, high, place, row = columns_of(
        table, "anchor", "path", "low", "high", "place", kinds=("low", "high", "place"))
    order = np.lexsort((place, low, path, anchor))
    anchor, path, low, high, place, row = (x[order] for x in (anchor, path, low, high, place, row))
    n, of_anchor, of_path = len(anchor), starts_of(anchor), starts_of(anchor, path)
    source, place = per_row(of_path, n, low[of_path]), per_row(of_path, n, place[of_path])
    first, last = np.minimum.reduceat(low, of_anchor), np.maximum.reduceat(high, of_anchor)
    number = np.add.reduceat(np.isin(np.arange(n), of_path), of_anchor)
    branches = per_row(of_anchor, n, (number > 1) & (first < last)) & (low == source)
    key, repeats = _joined(anchor, path), source < high
    return pa.concat_tables([
        _answered(table, row[repeats], SOURCED, key[repeats], source[repeats], place[repeats]),
        _answered(table, row[branches], BRANCHING, key[branches], source[branches], place[branches])])


def _edge_entries(buckets):
    def run(table, answers):
        if not len(table):
            return dealt(np.zeros(0, np.uint64), 0, **{c: np.zeros(0) for c in ("one", "two", "doc", "place")})
        p = Paths(table)
        keys, source, _ = _answers(answers, BRANCHING)
        rows = np.flatnonzero(p.of_windows(_found(keys, p.key, source, _NONE) == p.owner))
        doc, one, two, place = p.of_windows(p.owner)[rows], p.edge[rows], p.second(rows), p.place[rows]
        order = np.lexsort((place, doc, two, one))
        order = order[starts_of(one[order], two[order], doc[order])]
        return dealt(mixed(one[order] + _STEP) % np.uint64(buckets), table["block"][0].as_py(), one=one[order],
                     two=two[order], doc=doc[order], place=place[order])
    return run


def _edge_bucket(table):
    one, two, doc, place, row = columns_of(table, "one", "two", "doc", "place", kinds=("doc", "place"))
    order = np.lexsort((place, doc, two, one))
    one, two, doc, place, row = (x[order] for x in (one, two, doc, place, row))
    starts = starts_of(one, two)
    source, place = per_row(starts, len(one), doc[starts]), per_row(starts, len(one), place[starts])
    later = source < doc
    # The document stands in the key: a block may hold one edge in several sources.
    key = _joined(_joined(one, two), doc.view(np.uint64))
    return _answered(table, row[later], EDGE, key[later], source[later], place[later])


def _repeats(table, answers):
    """The block's paths, and for each window the earlier document that holds it, or _NONE, and where."""
    p = Paths(table)
    keys, source, place = _answers(answers, SOURCED)
    found = _found(keys, p.key, source, _NONE)
    earlier = p.of_windows(np.where(found < p.owner, found, _NONE))
    where = p.of_windows(_found(keys, p.key, place, 0)) + p.offset
    keys, source, place = _answers(answers, EDGE)
    if len(keys):
        own, _, _ = _answers(answers, BRANCHING)
        asked = _found(own, p.key, np.ones(len(own), bool), False)
        rows = np.flatnonzero(p.of_windows(asked) & (earlier == _NONE))
        doc = p.of_windows(p.owner)[rows].view(np.uint64)
        wanted = _joined(_joined(p.edge[rows], p.second(rows)), doc)
        earlier[rows] = _found(keys, wanted, source, _NONE)
        where[rows] = _found(keys, wanted, place, 0)
    return p, earlier, where


def _spans(p, earlier, where):
    """By document: word spans in which the source coordinates advance in step with the own ones."""
    rows = np.flatnonzero(earlier != _NONE)
    doc, at = p.doc[p.at[rows]], p.place[rows]
    starts = starts_of(doc, at - np.arange(len(rows)), earlier[rows], where[rows] - at)
    ends = ends_of(starts, len(rows))
    found = [[] for _ in p.words]
    for d, a, b, source, source_at in zip(*(x.tolist() for x in (
            doc[starts], at[starts], at[ends] + p.k, earlier[rows][starts], where[rows][starts]))):
        found[d].append({"start": a, "end": b, "source_id": source, "source_start": source_at})
    return found


SPAN = "struct<start:bigint,end:bigint,source_id:bigint,source_start:bigint>"


def _kept(table, answers):
    """The block's rows with kept, n_words, n_removed and spans."""
    p, earlier, where = _repeats(table, answers)
    change = np.zeros(len(p.hashes) + 1, np.int64)
    hit = p.at[earlier != _NONE]
    np.add.at(change, hit, 1)
    np.add.at(change, hit + p.k, -1)
    gone = np.cumsum(change)[:-1] > 0
    kept, removed = [], []
    for words, first in zip(p.words, p.first):
        mine = gone[first:first + len(words)]
        n = int(mine.sum())
        removed.append(n)
        kept.append(b" ".join(words if not n else [w for w, g in zip(words, mine.tolist()) if not g]))
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "source_id", "source_start")]))
    return (table.drop_columns(["block"]).append_column("kept", pa.array(kept, pa.binary()).cast(pa.string()))
            .append_column("n_words", pa.array(p.sizes)).append_column("n_removed", pa.array(removed, pa.int64()))
            .append_column("spans", pa.array(_spans(p, earlier, where), kind)))


def repeated_spans(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text, more..., kept, n_words, n_removed, spans): each document without repeated words.

    ``spans`` holds the repeated word ranges (start from 0, end not included), which may overlap, each
    with the document and the word from which on the same words stand there.
    """
    own = docs.select("doc_id", "text", *more)
    blocks, buckets = with_blocks(own)
    by_block = blocks.groupBy("block")
    entries = by_block.applyInArrow(
        _path_entries(buckets), "bucket long, block long, anchor binary, path binary, low binary, high binary, place binary")
    paths = entries.groupBy("bucket").applyInArrow(_path_bucket, ANSWER)
    edges = by_block.cogroup(paths.groupBy("block")).applyInArrow(
        _edge_entries(buckets), "bucket long, block long, one binary, two binary, doc binary, place binary")
    answers = paths.union(edges.groupBy("bucket").applyInArrow(_edge_bucket, ANSWER))
    shape = (T.StructType(own.schema.fields).add("kept", "string").add("n_words", "long")
             .add("n_removed", "long").add("spans", T.DataType.fromDDL(f"array<{SPAN}>")))
    names = [f.name for f in shape.fields]

    empty = to_arrow_schema(shape).empty_table()

    def kept(table, found):
        return _kept(table, found).select(names) if len(table) else empty

    return by_block.cogroup(answers.groupBy("block")).applyInArrow(kept, shape)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents with the kept words as text where words went, else as they were; n_chars follows."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # Other columns travel in one struct, so that none clashes with a name used here.
    spare = "_" * (1 + max(map(len, rest), default=0))
    carried = docs.select("doc_id", "text", F.struct(F.lit(0).alias(spare), *rest).alias("rest"))
    cut = F.col("n_removed") > 0
    columns = {c: F.col("rest")[c].alias(c) for c in rest} | {
        "doc_id": F.col("doc_id"), "text": F.when(cut, F.col("kept")).otherwise(F.col("text")).alias("text")}
    if "n_chars" in rest:
        told = F.col("rest")["n_chars"]
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(cut, F.length("kept").cast(kind)).otherwise(told).alias("n_chars")
    return repeated_spans(carried, "rest").select([columns[c] for c in docs.columns])


def summary(docs: DataFrame) -> DataFrame:
    """Per document: number of words, of removed words, digest of the kept ones."""
    return repeated_spans(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
