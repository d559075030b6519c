"""Fill-in-the-middle transformation, with cuts located in a wavelet matrix over character classes.

Every character has one of four classes: inside a word, last of a word, inside white space, last of
white space. The classes of a batch of texts form one sequence, kept as a wavelet matrix: two bit
vectors with running counts, the second reordered by the first. ``rank`` counts a class before a
position; the units of a text are the word ends in it, plus one if white space ends it (ranks of the
two white-space classes over its last character). ``select`` finds the cut after the k-th unit, by
walking the levels back up; at each level the place of a bit is found by bisection on the counts.

A unit is a word with the white space before it, or white space that ends the text. Two hashed
numbers per document give the cuts, two more the form: plain, or the three parts with markers, prefix
first (psm) or suffix first (spm). Equal documents are changed equally, wherever they are computed.

Defined cases: a null text is an empty one; empty texts and texts that hold a marker stay plain, so
every output can be read back (``restored``); a null doc_id is hashed as no digits at all; cuts may
coincide (empty parts); repeated rows are changed each; other columns are ignored; an empty table
gives an empty result. Texts are cut whole; a batch is worked on in runs of about RUN characters, a
longer text alone.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SUFFIX_FIRST = 42, 50, 80
RUN = 4_000_000

WORD, WORD_END, SPACE, SPACE_END = range(4)


class Bits:
    """A bit vector with counts per 64-bit word: rank in constant time, select by bisection."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
        padded[:self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, at):
        """Set bits before each position."""
        at = np.asarray(at, np.int64)
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & below)

    def count(self, bit: int, at):
        ones = self.rank(at)
        return ones if bit else np.asarray(at, np.int64) - ones

    def select(self, bit: int, k):
        """The position of the k-th (from 0) bit of this value, by bisection on the ranks."""
        k = np.asarray(k, np.int64)
        low, high = np.zeros_like(k), np.full_like(k, self.n)
        while np.any(high - low > 1):
            mid = (low + high) >> 1
            enough = self.count(bit, mid) > k
            high, low = np.where(enough, mid, high), np.where(enough, low, mid)
        return low


class WaveletMatrix:
    """Rank and select of symbols below 2 ** levels in a sequence."""

    def __init__(self, symbols: np.ndarray, levels: int = 2):
        self.levels, self.zeros = [], []
        for shift in reversed(range(levels)):
            bits = (symbols >> shift) & 1
            self.levels.append(Bits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def _way(self, symbol):
        """Per level from the top: its bits, the number of zeros in it, and the symbol's bit."""
        last = len(self.levels) - 1
        return [(b, z, (symbol >> (last - i)) & 1) for i, (b, z) in enumerate(zip(self.levels, self.zeros))]

    def rank(self, symbol: int, at):
        """How often the symbol stands before each position."""
        start, at = np.int64(0), np.asarray(at, np.int64)
        for bits, zeros, bit in self._way(symbol):
            start, at = (bits.count(bit, x) + zeros * bit for x in (start, at))
        return at - start

    def select(self, symbol: int, k):
        """The position of the k-th (from 0) place of the symbol."""
        start, way = np.int64(0), self._way(symbol)
        for bits, zeros, bit in way:
            start = bits.count(bit, start) + zeros * bit
        at = start + np.asarray(k, np.int64)
        for bits, zeros, bit in reversed(way):
            at = bits.select(bit, at - zeros * bit)
        return at


def classes(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of every character of texts that lie one after the other; ``ends`` are past their last."""
    space = (points == 0x20) | ((points >= 9) & (points <= 13))
    last = np.ones(len(points), bool)
    last[:-1] = space[1:] != space[:-1]
    last[ends[ends > 0] - 1] = True
    return (2 * space + last).astype(np.uint8)


class Units:
    """The units of texts: how many each has, and where a cut after k of them lies."""

    def __init__(self, texts: list[str]):
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts, self.sizes = self.ends - sizes, sizes
        self.matrix = WaveletMatrix(classes(points, self.ends))
        self.words_before = self.matrix.rank(WORD_END, self.starts)
        self.words = self.matrix.rank(WORD_END, self.ends) - self.words_before
        tail = np.maximum(self.ends - 1, self.starts)
        trailing = sum(self.matrix.rank(c, self.ends) - self.matrix.rank(c, tail) for c in (SPACE, SPACE_END))
        self.count = self.words + trailing

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Characters before the cut after k units of each text; k is at most its number of units."""
        out = np.where(k > self.words, self.sizes, 0)
        inner = (k > 0) & (k <= self.words)
        found = self.matrix.select(WORD_END, self.words_before[inner] + k[inner] - 1)
        out[inner] = found + 1 - self.starts[inner]
        return out


def numbers(doc_id, seed: int) -> list[int]:
    """The four numbers of a document: digit groups of a hash of seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def formatted(text: str, a: int, b: int, form: str) -> str:
    """The text with its middle [a, b) moved to the end."""
    if form == "plain":
        return text
    first, last = PREFIX + text[:a], SUFFIX + text[b:]
    return (first + last if form == "psm" else last + first) + MIDDLE + text[a:b]


def restored(output: str, form: str) -> str:
    """The text that an output was made from. Parts hold no marker, so the first of each is the real one."""
    if form == "plain":
        return output
    marks = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    first, _, rest = output.removeprefix(marks[0]).partition(marks[1])
    second, _, middle = rest.partition(MIDDLE)
    return first + middle + second if form == "psm" else second + middle + first


def _runs(texts):
    """Slices of a batch of about RUN characters."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > RUN:
            yield start, i
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, len(texts)


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, restored) of every text.

    ``rate`` percent of the documents are changed, ``suffix_first`` percent of these to spm.
    """
    shape = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, "
             "restored string")

    def run(batches):
        for batch in batches:
            all_ids, all_texts = batch["doc_id"].to_pylist(), [t or "" for t in batch["text"].to_pylist()]
            for start, end in _runs(all_texts):
                ids, texts = all_ids[start:end], all_texts[start:end]
                units = Units(texts)
                h = np.array([numbers(i, seed) for i in ids], np.int64).T
                one, two = h[0] % (units.count + 1), h[1] % (units.count + 1)
                low, high = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
                forms = ["plain" if not t or PREFIX in t or SUFFIX in t or MIDDLE in t or x % 100 >= rate
                         else "spm" if y % 100 < suffix_first else "psm" for t, x, y in zip(texts, h[2], h[3])]
                out = [formatted(*x) for x in zip(texts, low.tolist(), high.tolist(), forms)]
                plain = np.array([f == "plain" for f in forms])
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(units.count), pa.array(forms, pa.string()),
                    pa.array(low, mask=plain), pa.array(high - low, mask=plain), pa.array(out, pa.string()),
                    pa.array(map(restored, out, forms), pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, shape)


def digests(docs: DataFrame) -> DataFrame:
    """Per document: units, form, the parts' lengths, digests of the output and of the text read back."""
    return transform(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))
