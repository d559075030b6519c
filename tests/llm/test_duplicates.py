"""Near duplicates, substring dedup, suffixes, decontamination and top-k against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

import brute
from lograil.llm import components, decontaminate, simhash, substring, suffixes, topk

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return SPACE.findall((text or "").encode())


def copies(seed=1, n=60, vocabulary=400):
    """Documents with exact copies, near copies, shared passages and self-repeats."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(rng.randint(20, 90))] for _ in range(5)]
    docs = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(0, 150))]
        kind = i % 6
        if kind == 1 and docs:
            w = list(docs[rng.randrange(len(docs))])
        elif kind == 2 and docs:
            w = list(docs[rng.randrange(len(docs))])
            if w:
                w[rng.randrange(len(w))] = word()
        elif kind in (3, 4):
            for p in rng.sample(passages, 2):
                at = rng.randint(0, len(w))
                w[at:at] = p
        elif kind == 5:
            w = [rng.choice("ab") for _ in range(60)] + passages[0] * 2
        docs.append(w)
    order = list(range(n))
    rng.shuffle(order)
    return [(order[i] - 10, " ".join(w)) for i, w in enumerate(docs)]


ODD = [(900, None), (901, ""), (902, " \n "), (903, "a b"), (903, "a b"), (None, "the same " * 30), (None, None),
       (904, "the same " * 30), (905, "long " * 30_000), (906, "A b\x0bC d")]


def brute_substring(pairs):
    first = {}
    rows = [(i, words(t)) for i, t in pairs]
    for i, w in rows:
        for s in range(len(w) - 12):
            if i is not None:
                key = tuple(w[s:s + 13])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in rows:
        gone = set()
        for s in range(len(w) - 12):
            if i is not None and first[tuple(w[s:s + 13])] < i:
                gone.update(range(s, s + 13))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed, vocabulary", [(1, 400), (2, 3), (3, 40)])
def test_substring(docs_of, seed, vocabulary):
    pairs = copies(seed, vocabulary=vocabulary) + ODD
    got = [(str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring.summary(docs_of(pairs)).collect()]
    assert sorted(got) == brute_substring(pairs)
    # The source coordinates of every span lead to the same words in an earlier document.
    texts = {i: words(t) for i, t in pairs}
    rows = substring.repeated_spans(docs_of(pairs, extra=False)).collect()
    for r in rows:
        covered = set()
        for s in r.spans:
            assert s.source_id < r.doc_id and s.end - s.start >= 13
            there = texts[s.source_id][s.source_start:s.source_start + s.end - s.start]
            assert there == texts[r.doc_id][s.start:s.end]
            covered.update(range(s.start, s.end))
        assert len(covered) == r.n_removed
    assert max(s.end - s.start for r in rows for s in r.spans) > 50


def test_substring_as_a_stage(docs_of):
    df = docs_of(copies() + ODD)
    out = substring.deduplicated(df)
    assert out.columns == df.columns and out.count() == df.count()
    whole = {r.doc_id: r for r in substring.summary(df).collect()}
    for r in out.where("doc_id IS NOT NULL").collect():
        if whole[r.doc_id].n_removed:
            assert r.n_chars == len(r.text)
    assert substring.deduplicated(docs_of([])).count() == 0


def brute_simhash(pairs):
    fps = []
    for i, t in pairs:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sh = [b" ".join(w[j:j + 3]) for j in range(max(len(w) - 2, 1))] if w else []
        hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    f = np.array(fps, np.uint64)
    a, b = np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= 3)
    label = simhash.joined(len(f), a, b)
    least = {}
    for (i, _), c in zip(pairs, label):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted((str(i), f"{p:016x}", str(least.get(c))) for (i, _), p, c in zip(pairs, fps, label))


def test_simhash(docs_of):
    pairs = copies(4, 120) + ODD
    got = simhash.summary(docs_of(pairs)).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == brute_simhash(pairs)


def test_simhash_keeps_one_of_each_group(docs_of):
    pairs = copies(4, 120) + ODD
    df = docs_of(pairs)
    kept = simhash.kept_documents(df)
    assert kept.columns == df.columns
    groups = {c for _, _, c in brute_simhash(pairs)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(groups)
    assert simhash.kept_documents(docs_of([])).count() == 0 and simhash.summary(docs_of([])).count() == 0


@pytest.mark.parametrize("shift", [0, 32])
def test_bucket_links_both_ways(shift, monkeypatch):
    """A group that is compared outright and one that is linked by balls give the same components."""
    rng = np.random.default_rng(shift)
    half = int(rng.integers(0, 1 << 32))
    fps = []
    for base in rng.integers(0, 1 << 32, 4):
        for _ in range(80):
            other, own = int(base), half
            for k in rng.integers(0, 32, rng.integers(0, 5)):
                other ^= 1 << int(k)
            if rng.random() < 0.4:
                own ^= 1 << int(rng.integers(0, 32))
            fps.append(own << shift | other << (32 - shift))
    fps = np.unique(np.array(fps, np.uint64))
    exact = (fps >> np.uint64(shift)) & np.uint64(0xFFFFFFFF) == half
    a, b = np.nonzero((np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3) & (exact[:, None] | exact[None, :]))
    want = simhash.joined(len(fps), a, b)
    assert np.array_equal(simhash.joined(len(fps), *simhash.bucket_links(fps, exact, shift)), want)
    monkeypatch.setattr(simhash, "OUTRIGHT", 0)
    assert np.array_equal(simhash.joined(len(fps), *simhash.bucket_links(fps, exact, shift)), want)


def test_simhash_crowded_values(spark, docs_of, monkeypatch):
    monkeypatch.setattr(simhash, "CROWDED", 1)
    pairs = copies(6, 60) + ODD
    got = simhash.summary(docs_of(pairs)).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == brute_simhash(pairs)


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (5, 5), (3, 1), (20, 21), (21, 22), (22, 23), (23, 24), (24, 25), (2, 1)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 20: 20, 21: 20, 22: 20, 23: 20, 24: 20, 25: 20}
    assert components.components(df.where("false")).count() == 0


def brute_repeats(pairs):
    holders = {}
    rows = [(i, words(t)) for i, t in pairs if i is not None]
    for i, w in rows:
        for s in range(len(w) - 49):
            holders.setdefault(tuple(w[s:s + 50]), set()).add(i)
    return {(i, x) for i, w in rows for s in range(len(w) - 49) if len(holders[tuple(w[s:s + 50])]) > 1
            for x in range(s, s + 50)}


@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes(docs_of, seed):
    pairs = copies(seed) + ODD
    got = suffixes.repeated_spans(docs_of(pairs)).collect()
    assert all(r.n_words == r.end - r.start >= 50 and r.other_id != r.doc_id for r in got)
    covered = {(r.doc_id, x) for r in got for x in range(r.start, r.end)}
    want = brute_repeats(pairs)
    assert covered <= want and len(covered) >= 0.99 * len(want)
    assert suffixes.repeated_spans(docs_of([])).count() == 0


def test_suffixes_of_a_hot_passage(spark, docs_of):
    """A passage in every document, spread over many sorted parts, is found in each."""
    rng = random.Random(8)
    fresh = lambda n: " ".join(f"z{rng.randrange(10**9)}" for _ in range(n))
    passage = fresh(60)
    pairs = [(i, f"{fresh(30)} {passage} {fresh(30)}") for i in range(300)] + [(999, fresh(200))]
    got = suffixes.repeated_spans(docs_of(pairs)).collect()
    assert {(r.doc_id, r.start, r.end) for r in got} == {(i, 30, 90) for i in range(300)}
    assert {(r.match_at, r.match_words, r.match_start) for r in got} == {(30, 60, 30)}
    assert all(r.match_id != r.doc_id for r in got)


def longest_copy(w, others):
    """The most words in a row of w that stand in one of the others, by common-run lengths."""
    best = 0
    for o in others:
        above = [0] * (len(o) + 1)
        for x in w:
            above = [0] + [above[j] + 1 if x == y else 0 for j, y in enumerate(o)]
            best = max(best, *above)
    return best


def test_suffix_alignments(spark, docs_of):
    """Sorted neighbours place the copy of a span: true ones, mostly a longest one, whatever the parts."""
    pairs = copies(4) + [(904, "the same " * 30), (907, "x " + "the same " * 31)]
    rows = {i: words(t) for i, t in pairs}
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    for partitions in ("1", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            seen.append(sorted(map(tuple, suffixes.repeated_spans(docs_of(pairs)).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] and len(seen[0]) > 20
    met = [r for r in seen[0] if r[5] is not None]
    assert len(met) >= 0.95 * len(seen[0])
    longest = []
    for doc, start, end, _, _, other, place, n, at in met:
        assert other != doc and n >= 50 and start <= at and at + n <= end
        assert rows[doc][at:at + n] == rows[other][place:place + n]
        longest.append((n, longest_copy(rows[doc][start:end], [w for i, w in rows.items() if i != doc])))
    # Nearest neighbours are not all neighbours: some longer copy stands elsewhere.
    print("longest:", sum(n == m for n, m in longest), "of", len(longest), "words", [sum(x) for x in zip(*longest)])
    assert all(n <= m for n, m in longest) and sum(n for n, _ in longest) >= 0.9 * sum(m for _, m in longest)


def brute_suffix_spans(pairs):
    """(doc_id, start, end, other_id) of all maximal spans, by plain windows."""
    rows = [(i, words(t)) for i, t in pairs if i is not None]
    holders = {}
    for i, w in rows:
        for s in range(len(w) - 49):
            holders.setdefault(tuple(w[s:s + 50]), set()).add(i)
    spans = {}
    for i, w in rows:
        for s in range(len(w) - 49):
            others = holders[tuple(w[s:s + 50])] - {i}
            mine = spans.setdefault(i, [])
            if others and mine and s <= mine[-1][1]:
                mine[-1][1:] = [s + 50, min(mine[-1][2], *others)]
            elif others:
                mine.append([s, s + 50, min(others)])
    return {(i, *x) for i, xs in spans.items() for x in xs}


def spans_around_a_hot_phrase():
    """Pairs that share 42 words before a phrase in all documents, which alone is sampled; and other documents."""
    rng = random.Random(5)
    fresh = lambda n: [f"q{rng.randrange(10**9)}" for _ in range(n)]
    smallest = lambda p: int(suffixes.grams(suffixes_hash(p), 8)[0])
    phrase = min((fresh(8) for _ in range(5000)), key=smallest)
    docs = []
    for _ in range(20):
        shared = fresh(42)
        docs += [fresh(5) + shared + phrase + fresh(60) for _ in range(2)]
    docs += [fresh(60) + phrase + fresh(60) for _ in range(300)]
    return [(i, " ".join(w)) for i, w in enumerate(docs)]


def suffixes_hash(listed):
    return np.array([xxhash.xxh64_intdigest(w.encode()) for w in listed], np.uint64)


@pytest.mark.parametrize("partitions", ["4", "13"])
@pytest.mark.parametrize("make", [spans_around_a_hot_phrase, lambda: [p for p in copies(2) + ODD if p[0] != 903]])
def test_suffixes_are_exact(spark, docs_of, make, partitions):
    """All spans and smallest other documents, however many parts the suffixes are sorted into."""
    pairs = make()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = suffixes.repeated_spans(docs_of(pairs)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute_suffix_spans(pairs)
    assert len(want) >= 20 and {(r.doc_id, r.start, r.end, r.other_id) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("part", [20_000, 3])
def test_decontamination(spark, docs_of, part):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(rng.choice((3, 8, 30, 31, 60))))) for i in range(12)]
    items += [(50, None), (51, "  "), (52, items[0][1]), (None, " ".join(word() for _ in range(40)))]
    pairs = []
    for i in range(60):
        w = [word() for _ in range(rng.randint(0, 80))]
        if i % 3 == 0:
            t = (items[rng.randrange(12)][1]).split()
            if i % 2 and len(t) > 20:
                t[0] = "changed"
            if i % 4 == 0:
                t = [x.upper() + "," for x in t]
            w[len(w) // 2:len(w) // 2] = t
        pairs.append((i, " ".join(w)))
    pairs += ODD + [(700, items[-1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS part", "2 AS doc_id")
    got = decontaminate.contaminated(docs_of(pairs), bench, part).collect()
    want = brute.contaminated(pairs, items)
    assert sorted((str(r.doc_id), str(r.item_id), round(r.similarity, 9), r.start) for r in got) == want and len(want) > 10
    df = docs_of(pairs)
    kept = decontaminate.kept_documents(df, bench, part)
    bad = {d for d, *_ in want}
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in pairs if str(d) not in bad)
    assert decontaminate.contaminated(docs_of([]), bench).count() == 0
    assert decontaminate.contaminated(df, bench.where("false")).count() == 0


def test_decontamination_weighs_by_the_whole_benchmark(spark, docs_of, monkeypatch):
    """Changed words that are template text of items in other parts weigh as little as with one part."""
    monkeypatch.setattr(decontaminate, "COMMON", 15)  # two broadcasts
    rng = random.Random(3)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    template = fresh(30)
    own = [fresh(60) for _ in range(20)]
    items = [(i, " ".join(w)) for i, w in enumerate(own)]
    items += [(100 + i, " ".join(template + fresh(20))) for i in range(12)]
    pairs = [(i, " ".join(fresh(10) + w[:53] + template[:7] + fresh(10))) for i, w in enumerate(own)]
    want = brute.contaminated(pairs, items)
    assert len(want) == len(own) and all(x[2] < 0.82 for x in want)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs_of(pairs), bench, 5).collect()
    assert sorted((str(r.doc_id), str(r.item_id), round(r.similarity, 9), r.start) for r in got) == want


def brute_topk(rows, k):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        vectors[i, tuple(int(np.floor(256 * float(x))) for x in v)] = None
    out = []
    for q, a in vectors:
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in vectors if c != q and len(a) == len(b))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 60)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 9).astype(np.float32)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(100)]  # a hot vector
    rows += [(i, None) for i in (450, 2000)] + [(2050, [1.0, None] + [0.0] * 7), (2100, [float("nan")] * 9),
                                               (2150, [float("inf")] * 9), (None, rows[1][1]), rows[50], (2200, []),
                                               (2250, [1.0, 2.0]), (2251, [3.0, -2.0]), (2300, [1e6] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS rank")
    got = sorted(tuple(r) for r in topk.nearest(df).collect())
    rows32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == brute_topk(rows32, 5)
    assert topk.nearest(df.where("false")).count() == 0


def test_topk_copies_of_queries_are_not_broadcast(spark, monkeypatch):
    """Every candidate block gets a copy of the queries; together these may be far more than a driver holds."""
    monkeypatch.setattr(topk, "CANDIDATES", 20)
    monkeypatch.setattr(topk, "SCORED", 1)
    rows = [(i, [float(i % 7 - 3), float(i % 11 - 5), float(i % 13 - 6)]) for i in range(200)]
    found = topk.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted(tuple(r) for r in found.collect()) == brute_topk(rows, 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"(\w+Join) \[dim", plan)) == {"SortMergeJoin"}


def test_top_k_resolves_few_scores(spark):
    """The cutoff of a few blocks leaves a small part of all pairs to be scored, and none of the best is lost."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(6000, 64))
    x = np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None]).astype(np.int64)
    q, k = x[:100], 5
    scores = q @ x.T
    scores[np.arange(100), np.arange(100)] = -10 ** 9
    probed = np.sort(scores[:, :6000 // topk.PROBED], axis=1)[:, -k]  # the k-th best of one part in eight
    mask = topk.sufficient(topk._partial_scores(q, x, topk.SEGMENTS), probed)
    assert mask.mean() < 0.4
    best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    assert np.take_along_axis(mask, best, axis=1).all()
    rows, cols = np.nonzero(mask)
    assert (topk.resolved(topk._partial_scores(q, x, topk.SEGMENTS), rows, cols) == (q @ x.T)[rows, cols]).all()


def test_columns_of_any_name_pass_the_substring_stage(docs_of):
    docs = docs_of([(1, "a b c " * 20), (2, "a b c " * 20)]).selectExpr("*", "1 AS _", "2 AS __")
    assert substring.deduplicated(docs).columns == docs.columns
    assert sorted(r["_"] for r in substring.deduplicated(docs).collect()) == [1, 1]


def test_columns_of_any_name_pass_the_near_duplicate_stage(docs_of):
    docs = docs_of([(1, "a b c d"), (2, "a b c d"), (None, "x y z"), (None, None), (None, "x y z")], extra=False)
    docs = docs.selectExpr("*", "1 AS _key", "2 AS key", "3 AS `group`", "4 AS ______id")
    kept = simhash.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (tuple(r) for r in kept.select("doc_id", "text", "_key", "key").collect()))) == sorted(
        map(str, [(1, "a b c d", 1, 2), (None, "x y z", 1, 2), (None, None, 1, 2)]))
