"""The corpus pipeline: raw documents to token ids, five stages in order.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept; all but the
last return the columns of ``documents``. Between stages the documents are a written table.

1. quality: documents that the classifier rejects go.
2. near duplicates: of each SimHash component one document stays.
3. substrings: words that repeat a window of an earlier document go; n_chars follows the text.
4. decontamination: documents that hold a benchmark item go.
5. tokens: ids of the texts that are left and the texts decoded from them, as digests.

Null and empty texts, repeated rows, ties, extra columns and empty tables are each stage's own
cases, as its operator states them.
"""

from lograil.llm import bpe, decontaminate, quality, simhash, substring
from lograil.llm.common import prepared
from lograil.llm.components import saved
from lograil.llm.queries import table


def keep_good(spark, docs, sf_dir):
    return quality.kept_documents(docs, table(prepared(spark), sf_dir, "labels"))


def keep_one_of_each_group(spark, docs, sf_dir):
    prepared(spark)
    return simhash.kept_documents(docs)


def cut_repeats(spark, docs, sf_dir):
    prepared(spark)
    return substring.deduplicated(docs)


def keep_clean(spark, docs, sf_dir):
    return decontaminate.kept_documents(docs, table(prepared(spark), sf_dir, "benchmark"))


def to_tokens(spark, docs, sf_dir):
    prepared(spark)
    return bpe.digests(docs)


STAGES = [
    ("quality", keep_good),
    ("near duplicates", keep_one_of_each_group),
    ("substrings", cut_repeats),
    ("decontamination", keep_clean),
    ("tokens", to_tokens),
]

# The classifier, token ids and XXH64 fingerprints are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
