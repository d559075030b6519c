"""The pipeline's stages one by one against the operators, and as a whole."""

import pytest
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from lograil.llm import bpe, decontaminate, quality
from test_duplicates import brute_simhash

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The table before the first stage and after each."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        out.append(docs)
    return out


def test_stages_return_documents(stages):
    assert [s.columns for s in stages[:-1]] == [COLUMNS] * 5
    counts = [s.count() for s in stages]
    assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-2] > 0.5 * counts[0]


def test_good_documents_stay(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = stages[0].join(labels.where("quality = 1"), "doc_id").select("doc_id").distinct()
    assert good.join(stages[1], "doc_id", "left_semi").count() >= 0.98 * good.count()
    assert quality.train(stages[0], labels) is not None


def test_no_benchmark_item_is_left(spark, stages):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    assert decontaminate.contaminated(stages[4], bench).count() == 0
    lost = stages[3].join(stages[4], "doc_id", "left_anti").select("doc_id").distinct()
    found = decontaminate.contaminated(stages[3], bench).select("doc_id").distinct()
    assert sorted(map(tuple, lost.collect())) == sorted(map(tuple, found.collect()))


def test_run_equals_the_stages(spark, stages):
    got = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect()))
    assert got == sorted(map(tuple, stages[-1].collect()))


def test_run_equals_brute_force(spark, stages):
    """All five stages in plain Python, one after the other; only the fitted model is the library's."""
    labels, bench = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    machine = quality.train(stages[0], labels)
    scores = [(r.doc_id, r.text, brute.quality_score(r.text, r.n_chars, machine)) for r in stages[0].collect()]
    assert all(abs(s - 0.3) > 1e-4 for *_, s in scores)
    docs = [(i, t) for i, t, s in scores if s >= 0.3]
    keepers = {c for _, _, c in brute_simhash(docs)}
    docs = brute.without_repeats([(i, t) for i, t in docs if str(i) in keepers])
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    bad = {d for d, *_ in brute.contaminated(docs, items)}
    library, want = Tokenizer.from_file(bpe.default_path()), []
    for i, t in docs:
        if str(i) not in bad:
            ids = library.encode(t or "", add_special_tokens=False).ids
            want.append((i, len(ids), brute.sha(",".join(map(str, ids))),
                         brute.sha(library.decode(ids, skip_special_tokens=False))))
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want) and bad and len(want) > 50


def test_stages_take_odd_rows(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (2, ""), (None, "a b c"), (3, "word " * 9000), (4, "word " * 9000)])
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns, name
        docs.count()
    empty = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
        assert empty.count() == 0
