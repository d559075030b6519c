"""Byte-level BPE encoding and decoding of whole texts, with the vocabulary of a tokenizer file.

A word's parts and the ranks of its neighbouring pairs lie in two short lists. The smallest rank is
looked for by scanning, its boundary goes, and the two ranks beside it are looked up anew. Words of
many parts take a heap of pairs over linked parts, since scanning would be quadratic there.

Null texts encode as empty ones: no ids, empty decoded text. Added tokens of the file inside a text
become their single ids, as the tokenizers library does by default. Ties of rank cannot occur
between different pairs; of equal pairs the leftmost merges first. Documents are independent rows:
repeated rows give repeated rows, extra columns are ignored, an empty table gives an empty one.
"""

import functools
import heapq
import json
import re
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

# Fixed value: the pattern by which byte-level vocabularies of this family cut texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Texts of characters below this one are cut by an equal pattern of explicit classes, which is faster.
LATIN = 0x250
# Words of more parts than this go by the heap.
SHORT = 100
REMEMBERED = 300_000
_NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The visible letter by which tokenizer files write each byte, to the byte."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return ({chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)})


def latin_words() -> re.Pattern:
    """WORDS with its character classes written out, for characters below LATIN."""
    def members(kind):
        return "".join(f"\\u{c:04x}" for c in range(LATIN) if regex.fullmatch(kind, chr(c)))
    letters, numbers, spaces = map(members, (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
                      rf"|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


class Vocabulary(dict):
    """A byte-level BPE vocabulary read from the content of a tokenizer file.

    As a dictionary it remembers the ids of words, up to a bound.
    """

    def __init__(self, content: str):
        super().__init__()
        data = json.loads(content)
        letters = byte_letters()
        ids = data["model"]["vocab"]
        bytes_of = {i: bytes(letters[c] for c in token) for token, i in ids.items()}
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = ids[letter]
        self.pairs = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[ids[left], ids[right]] = (rank, ids[left + right])
        self.added = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
        bytes_of |= {i: text.encode() for text, i in self.added.items()}
        self.bytes_of = [bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)]
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split = regex.compile(f"({'|'.join(map(regex.escape, longest_first))})") if self.added else None
        self.any_words, self.latin_words = regex.compile(WORDS), latin_words()
        self.beyond_latin = re.compile(f"[^\x00-{chr(LATIN - 1)}]")

    def merge_short(self, parts: list[int]) -> list[int]:
        """The contiguous rank array: scan for the minimum, delete a boundary, refresh its neighbours."""
        pairs, none = self.pairs, (_NEVER, 0)
        ranks = [pairs.get(p, none)[0] for p in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == _NEVER:
                break
            at = ranks.index(least)
            parts[at:at + 2] = [pairs[parts[at], parts[at + 1]][1]]
            del ranks[at]
            if at:
                ranks[at - 1] = pairs.get((parts[at - 1], parts[at]), none)[0]
            if at < len(ranks):
                ranks[at] = pairs.get((parts[at], parts[at + 1]), none)[0]
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same result by a heap of (rank, place), for words of many parts."""
        pairs, n = self.pairs, len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(pairs[p][0], i, *p) for i, p in enumerate(zip(parts, parts[1:])) if p in pairs]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i], parts[j] = pairs[left, right][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (p := (parts[x], parts[y])) in pairs:
                    heapq.heappush(heap, (pairs[p][0], x, *p))
        return [p for p in parts if p >= 0]

    def __missing__(self, word: str) -> bytes:
        """The ids of a word that is not remembered, as 4-byte numbers one after the other."""
        parts = [self.byte_ids[b] for b in word.encode()]
        ids = self.merge_short(parts) if len(parts) <= SHORT else self.merge_long(parts)
        packed = array("i", ids).tobytes()
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= SHORT:
            self[word] = packed
        return packed

    def packed(self, text: str) -> bytes:
        """The ids of a text, as 4-byte numbers one after the other."""
        if self.split is not None and self.split.search(text):
            return b"".join(array("i", [self.added[piece]]).tobytes() if piece in self.added else
                            self.packed(piece) for piece in self.split.split(text))
        words = self.any_words if self.beyond_latin.search(text) else self.latin_words
        return b"".join(map(self.__getitem__, words.findall(text)))

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(2)
def _vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every text; ``path`` names the tokenizer file on the driver.

    The file (a vocabulary of fixed size) travels to the executors as a broadcast.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(path or default_path()).read_text())

    def run(batches):
        vocabulary = _vocabulary(content.value)
        for batch in batches:
            packed = [vocabulary.packed(t or "") for t in batch["text"].to_pylist()]
            offsets = np.cumsum([0, *map(len, packed)]) // 4
            flat = np.frombuffer(b"".join(packed), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), ids], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, text) read back from ids; null ids give empty text."""
    content = encoded.sparkSession.sparkContext.broadcast(Path(path or default_path()).read_text())

    def run(batches):
        vocabulary = _vocabulary(content.value)
        for batch in batches:
            texts = [vocabulary.decode([] if x is None else x.values.to_numpy(zero_copy_only=False).tolist())
                     for x in batch["ids"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["ids"], pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the text decoded from them."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decode(encode(docs, path), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
