"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its distinct words, hashed to WORD_BUCKETS, and dense statistics of its
structure and of the metadata column n_chars. The machine adds to a linear model all pairwise
interactions of features through factors of rank RANK, computed in linear time by the identity
sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2].

It is fitted by logistic loss on a bounded sample of labelled rows: the SAMPLE labelled documents of
the smallest hashes among those not held out. Scoring covers every whole text in the tasks.

Defined cases: a null text is empty, and empty texts get a score too; a null n_chars counts as the
text's length; labels of a null quality or of ids without a document are not learned from; a
document labelled several times counts with its largest label, of several texts under one id one is
learned from, always the same; without labels the score is 0.5;
repeated rows are scored each; labels, lang, source and doc_id are no inputs of a score; a null
doc_id counts as held out; an empty table gives an empty result.
"""

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lograil.llm.common import hash_words, texts_of
from lograil.llm.langid import held_out

SAMPLE, WORD_BUCKETS, RANK = 8_000, 1 << 16, 8
EPOCHS, BATCH, RATE, DECAY = 8, 256, 0.05, 1e-5
REJECT_BELOW = 0.3
UPPER, DIGITS = string.ascii_uppercase.encode(), string.digits.encode()
MARKS, ODD = string.punctuation.encode(), b"#$%&*|<>{}\\^~@_=+"
LETTERS = string.ascii_letters.encode() + bytes(range(128, 256))
SHAPES = ("upper", "digits", "marks", "odd marks", "no letters", "repeats", "distinct", "word length",
          "words", "lines", "repeated lines", "length against metadata")
FEATURES = WORD_BUCKETS + len(SHAPES)
_SHAPE_IDS = np.arange(WORD_BUCKETS, FEATURES, dtype=np.int32)


def features(text: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a document's features."""
    words = hash_words(text.lower().split())
    own = np.unique(words % np.uint64(WORD_BUCKETS)).astype(np.int32)
    size, n, lines = max(len(text), 1), max(len(words), 1), text.split(b"\n")

    def share(of):
        return (len(text) - len(text.translate(None, of))) / size

    chars = len(text.decode("utf-8", "replace"))
    told = chars if n_chars is None else max(n_chars, 0)
    shapes = np.array([
        share(UPPER), share(DIGITS), share(MARKS), share(ODD), 1 - share(LETTERS),
        (words[1:] == words[:-1]).sum() / n, len(np.unique(words)) / n, min(len(text) / n, 40) / 10,
        np.log1p(n) / 10, np.log1p(len(lines)) / 5, 1 - len(set(lines)) / len(lines),
        abs(np.log1p(chars) - np.log1p(told))])
    values = np.concatenate([np.full(len(own), 1 / np.sqrt(max(len(own), 1))), np.clip(4 * shapes, 0, 8)])
    return np.concatenate([own, _SHAPE_IDS]), values.astype(np.float32)


class Machine:
    """A factorisation machine for sparse rows given as (indices, values, row starts)."""

    def __init__(self, seed: int = 7):
        self.bias = 0.0
        self.w = np.zeros(FEATURES, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.02, (FEATURES, RANK)).astype(np.float32)

    def margins(self, ids, x, starts):
        """Linear part and pairwise interactions; also the factor sums that gradients need."""
        xv = self.v[ids] * x[:, None]
        total = np.add.reduceat(xv, starts, axis=0)
        squares = np.add.reduceat((xv * xv).sum(1), starts)
        linear = np.add.reduceat(self.w[ids] * x, starts)
        return self.bias + linear + 0.5 * ((total * total).sum(1) - squares), xv, total

    def scores(self, ids, x, starts):
        return 1 / (1 + np.exp(-np.clip(self.margins(ids, x, starts)[0].astype(np.float64), -30, 30)))

    def fit(self, rows: list, labels: np.ndarray, seed: int = 7):
        """Logistic loss by adaptive gradient steps over batches in a fixed order."""
        order, speed = np.random.default_rng(seed), [np.full(FEATURES, 1e-3, np.float32), np.full((FEATURES, RANK), 1e-3, np.float32)]
        rate = labels.mean()
        self.bias = float(np.log((rate + 1e-3) / (1 - rate + 1e-3)))
        for _ in range(EPOCHS):
            for part in np.array_split(order.permutation(len(rows)), max(1, len(rows) // BATCH)):
                ids, x, starts = stacked([rows[i] for i in part])
                margin, xv, total = self.margins(ids, x, starts)
                error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[part]).astype(np.float32) / len(part)
                each = np.repeat(error, np.diff(np.append(starts, len(ids))))
                doc = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(ids))))
                slopes = (each * x, (each * x)[:, None] * (total[doc] - xv))
                by = np.argsort(ids, kind="stable")
                first = np.flatnonzero(np.diff(ids[by], prepend=-1))
                at = ids[by][first]
                for theta, seen, slope in zip((self.w, self.v), speed, slopes):
                    g = np.add.reduceat(slope[by], first, axis=0) + DECAY * theta[at]
                    seen[at] += g * g
                    theta[at] -= RATE * g / np.sqrt(seen[at])
                self.bias -= 0.1 * float(error.sum())
        return self


def stacked(rows):
    sizes = [len(ids) for ids, _ in rows]
    return (np.concatenate([ids for ids, _ in rows]), np.concatenate([x for _, x in rows]),
            np.cumsum([0, *sizes[:-1]]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine | None:
    """The machine, fitted on at most ``sample`` labelled documents; None without any."""
    known = (labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    # Bounded by the sample, so it can be sent to where the documents are.
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches):
        for batch in batches:
            rows = [features(t or b"", n) for t, n in zip(texts_of(batch["text"]), batch["n_chars"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["quality"].cast(pa.int32()), pa.array([i.tobytes() for i, _ in rows], pa.binary()),
                 pa.array([x.tobytes() for _, x in rows], pa.binary())], ["doc_id", "quality", "ids", "x"])

    rows = docs.select("doc_id", "text", F.col("n_chars").cast("long").alias("n_chars")).join(
        F.broadcast(known), "doc_id").mapInArrow(run, "doc_id long, quality int, ids binary, x binary")
    # Of several texts under one id the first in the order of their features is learned from.
    first = rows.groupBy("doc_id").agg(F.min(F.struct("quality", "ids", "x")).alias("r"))
    found = sorted(map(tuple, first.select("doc_id", "r.*").collect()))
    if not found:
        return None
    sparse = [(np.frombuffer(i, np.int32), np.frombuffer(x, np.float32)) for _, _, i, x in found]
    return Machine().fit(sparse, np.array([q for _, q, _, _ in found], np.float32))


def _scores(batch, machine: Machine | None) -> np.ndarray:
    """The chance of label 1 for every document of a batch."""
    if machine is None or not batch.num_rows:
        return np.full(batch.num_rows, 0.5)
    n_chars = batch["n_chars"].cast(pa.int64()).to_pylist()
    rows = [features(t or b"", n) for t, n in zip(texts_of(batch["text"]), n_chars)]
    return np.concatenate([machine.scores(*stacked(rows[i:i + 64])) for i in range(0, len(rows), 64)])


def score(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """(doc_id, score): the chance that a document's label is 1."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(_scores(batch, model.value))], ["doc_id", "score"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "n_chars")
    return rows.mapInArrow(run, "doc_id long, score double")


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject; every column as it was."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch, model.value) >= REJECT_BELOW))
    return docs.mapInArrow(run, docs.schema)


def summary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it was held out, its score and the decision."""
    return score(docs, train(docs, labels)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"))
