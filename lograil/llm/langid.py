"""Language identification by compression: the language whose dictionary shrinks a text most.

Each language of the learning documents gives one zstandard raw-content dictionary, filled from a
bounded sample of its texts. A text is compressed piece by piece with every dictionary; the smallest
total wins. Where the margin to the second is narrow the prediction is not accepted: the language
stays, ``accepted`` says no, and the score is near that of a draw.

The sample is bounded by SAMPLE_DOCS different texts of a language, EXCERPT characters of each from a
place that its hash chooses, and the last DICTIONARY_BYTES of these (the model's only data); texts to
be predicted are read whole.

Defined cases: a null text or one without a letter is ``und`` with score 0, not accepted; with no
learning documents every text is ``und``; ties go to the language with more learning documents, then
to the first by name; repeated
rows are predicted each; lang, source and doc_id are no inputs of a prediction (a null doc_id counts
as held out); rows of a null lang are not learned from; an empty table gives an empty result.
"""

import functools
import math

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

UNDETERMINED = "und"
SAMPLE_DOCS, EXCERPT = 200, 1_000
DICTIONARY_BYTES, LEVEL, PIECE = 200_000, 6, 4_000
# Of the compressed size: a smaller lead over the second language is no decision.
MARGIN = 0.01
# Bytes of lead that count as one unit of log odds.
UNIT = 6.0


def held_out(doc_id: Column) -> Column:
    """The fifth of all documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def dictionaries(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """Dictionary content of each language, from the sample documents of the smallest hashes.

    The language with most learning documents comes first.
    """
    count = dict(map(tuple, docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
                     .groupBy("lang").count().collect()))
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    # Different texts only, by their hashes first: so a group of copies gives one sample, and few texts move.
    h = F.xxhash64("text")
    order = Window.partitionBy("lang").orderBy("h")
    chosen = usable.select("lang", h.alias("h")).distinct().withColumn("n", F.row_number().over(order)).where(
        F.col("n") <= sample_docs)
    place = F.pmod(h, F.greatest(F.length("text") - EXCERPT, F.lit(0)) + 1).cast("int") + 1
    rows = usable.select("lang", h.alias("h"), F.substring("text", place, EXCERPT).alias("text")).join(
        chosen, ["lang", "h"]).groupBy("lang", "h", "n").agg(F.min("text").alias("text"))
    found = {}
    for r in rows.select("lang", "text").orderBy("lang", "n").collect():
        found.setdefault(r.lang, []).append(r.text.lower().encode())
    ordered = sorted(found.items(), key=lambda kv: (-count[kv[0]], kv[0]))
    return {lang: b"\n".join(texts)[-DICTIONARY_BYTES:] for lang, texts in ordered}


@functools.lru_cache(2)
def _compressors(contents: tuple) -> list:
    ready = []
    for _, content in contents:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        ready.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False))
    return ready


def sizes(text: str, compressors: list) -> list[int]:
    """Compressed size of a whole text under each dictionary."""
    data = text.lower().encode()
    pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
    return [sum(len(c.compress(p)) for p in pieces) for c in compressors]


def decide(got: list[int]) -> tuple[int, float, bool]:
    """The winner, its score and whether the margin is wide enough."""
    best = min(range(len(got)), key=lambda i: (got[i], i))
    second = min((s for i, s in enumerate(got) if i != best), default=got[best] * 2)
    score = 1 / sum(math.exp(min(0.0, (got[best] - s) / UNIT)) for s in got)
    return best, score, second - got[best] >= max(1, MARGIN * got[best])


def predict(docs: DataFrame, contents: dict[str, bytes]) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every document."""
    fixed = tuple(contents.items())
    names = [lang for lang, _ in fixed]

    def one(text, compressors):
        if not names or not text or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, False
        best, score, sure = decide(sizes(text, compressors))
        return names[best], score, sure

    def run(batches):
        compressors = _compressors(fixed)
        for batch in batches:
            out = [one(t, compressors) for t in batch["text"].to_pylist()]
            lang, score, sure = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(sure, pa.bool_())], ["doc_id", "lang_pred", "score", "accepted"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, accepted boolean")


def summary(docs: DataFrame) -> DataFrame:
    """Learns from the documents that are not held out and predicts all."""
    return predict(docs, dictionaries(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
