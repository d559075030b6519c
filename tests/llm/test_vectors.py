"""Whitening and nearest neighbours against numpy."""

import numpy as np
import pytest

from lograil.llm import multiindex, whitening
from lograil.llm.common import prepared

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vectors_of(spark):
    prepared(spark)

    def make(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        for name in ("x", "v", "block", "cell", "index", "part", "rank", "score", "n"):
            df = df.selectExpr("*", f"'y' AS {name}")
        return df
    return make


def numpy_whitened(x):
    n, s = len(x), x.sum(0)
    c = np.array([[(n * int(a) - int(b)) / n for a, b in zip(row, s)] for row in x])
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return c @ u / np.sqrt(np.where(e > 0, e, 1)), e / e.sum(), deviation


def compare(got, ids, v, per=32):
    """``got`` against numpy, either sign of each component."""
    x = np.floor(64 * v.astype(float)).astype(np.int64) + 1_000_000
    z, explained, deviation = numpy_whitened(x)
    k = min(per, x.shape[1])
    assert len(got) == len(x) * k
    by = {}
    for r in got:
        by.setdefault(r.component, {})[r.vec_id] = r
    for c in range(1, k + 1):
        w = np.array([by[c][i].whitened for i in ids])
        assert min(np.abs(w - z[:, c - 1]).max(), np.abs(w + z[:, c - 1]).max()) < 1e-6
        assert abs(by[c][ids[0]].explained / explained[c - 1] - 1) < 1e-9
    assert [by[1][i].deviation for i in ids] == deviation
    assert {r.n for r in got} == {len(x)} and {r.identity_error < 1e-9 for r in got} == {True}


def test_whitening_equals_numpy(spark):
    df = prepared(spark).read.parquet(f"{SF}/embeddings.parquet")
    rows = df.collect()
    compare(whitening.whiten(df).collect(), [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float32))


def test_whitening_in_many_blocks(vectors_of, monkeypatch):
    """Small blocks: several runs of row blocks, the last of them not full."""
    monkeypatch.setattr(whitening, "LEAST_ROWS", 7)
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 7 * 8 * 5)
    v = np.random.default_rng(2).normal(size=(100, 5)).astype(np.float32) * [9, 7, 4, 2, 1]
    got = whitening.whiten(vectors_of([(i, r.tolist(), 0) for i, r in enumerate(v.astype(np.float32))]).repartition(3)).collect()
    compare(got, list(range(100)), v.astype(np.float32))


def test_whitening_of_odd_rows(vectors_of):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [0.0, 5.0], 0), (2, [3.0, -1.0], 0), (3, [0.5, 0.5], 0)]
    bad = [(4, None, 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (7, [None, 1.0], 0), (8, [], 0), (9, [1.0] * 3, 0)]
    got = whitening.whiten(vectors_of(good + bad)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == sorted((i or 0, c) for i, _, _ in good for c in (1, 2))
    assert {r.n for r in got} == {5} and max(r.identity_error for r in got) < 1e-9
    flat = whitening.whiten(vectors_of([(1, [1.0, 2.0], 0), (2, [1.0, 3.0], 0)])).collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)}
    same = whitening.whiten(vectors_of([(1, [1.0, 2.0], 0)] * 2)).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(0, None, None, None)] * 4
    huge = whitening.whiten(vectors_of([(1, [3e38, 0.0], 0), (2, [-3e38, 1.0], 0)])).collect()
    assert {r.deviation for r in huge} == {None}
    assert whitening.whiten(vectors_of(bad[:5])).count() == 0
    assert whitening.whiten(vectors_of([])).count() == 0


def brute(rows, every, k):
    v = {i: np.array(x, np.float32).astype(float) for i, x in rows}
    out = {}
    for q in v:
        if q % every == 0:
            scored = sorted((-(v[c] * v[q]).sum(), c) for c in v if c != q)
            out[q] = [(c, -s) for s, c in scored[:k]]
    return out


def recall(got, want):
    """The share of true neighbours found; one as near as the last true one counts."""
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r.score)
    hits = sum(sum(s >= w[-1][1] - 1e-12 for s in found.get(q, [])) for q, w in want.items() if w)
    return hits / sum(map(len, want.values()))


def test_neighbours_found_and_scored(spark):
    df = prepared(spark).read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in df.collect()}
    got = multiindex.nearest(df).collect()
    want = brute(rows.items(), 20, 20)
    assert len(got) == 20 * len(want) and recall(got, want) >= 0.9
    for q in want:
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
    v = {i: np.array(x) for i, x in rows.items()}
    assert max(abs(r.score - v[r.query_id] @ v[r.vec_id]) for r in got) < 1e-12


def test_whole_walk_is_exact(vectors_of, monkeypatch):
    """With a share of one and tiny blocks the result is that of brute force, ties and copies included."""
    monkeypatch.setattr(multiindex, "BLOCK_BYTES", 4 * 6 * 16)
    monkeypatch.setattr(multiindex, "SHARE", multiindex.PACK)
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(400)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 1.0, 0.0, -1.0]) for i in range(300)]
    rows = [(i, x) for i, x in rows if any(x)]
    model, entries = multiindex.build(multiindex.usable_vectors(vectors_of([(i, x, 0) for i, x in rows + rows[:50]])), 7)
    model.share = 1.0
    mine = {}
    for r in multiindex.search(model, entries, entries.where("vec_id % 3 = 0"), 7).collect():
        mine.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows, 3, 7)
    assert {q: [(c, s) for _, c, s in sorted(x)] for q, x in mine.items()} == want


def test_neighbours_of_odd_rows(vectors_of):
    nan, inf = float("nan"), float("inf")
    bad = [(40, None, 0), (60, [nan, 1.0], 0), (80, [inf, 1.0], 0), (100, [None, 1.0], 0), (120, [0.0, 0.0], 0),
           (140, [], 0), (160, [1.0] * 3, 0), (None, [1.0, 1.0], 0)]
    good = [(20, [1.0, 0.0], 0), (20, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [2.0, 0.0], 0), (3, [2.0, 5.0], 0)]
    got = multiindex.nearest(vectors_of(bad + good)).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 2, 2.0), (2, 3, 2.0), (3, 1, 0.0)]
    assert multiindex.nearest(vectors_of([(20, [1.0], 0)])).collect() == []
    one = multiindex.nearest(vectors_of([(20, [2.0], 0), (40, [3.0], 0)])).collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in one) == [(20, 40, 6.0), (40, 20, 6.0)]
    assert multiindex.nearest(vectors_of(bad)).count() == 0 and multiindex.nearest(vectors_of([])).count() == 0


def test_walk_goes_by_summed_distance():
    rng = np.random.default_rng(6)
    model = multiindex.MultiIndex(np.zeros((9, 1)), np.zeros((7, 1)))
    model.laid_out({c: int(n) for c, n in enumerate(rng.integers(0, 5, 63))}, 4)
    one, two = rng.normal(size=9), rng.normal(size=7)
    every = [c for c in np.argsort((one[:, None] + two).ravel(), kind="stable").tolist() if model.counts[c]]
    assert model.walk(one, two, 10 ** 9) == every
    some = model.walk(one, two, 20)
    assert some == every[:len(some)] and sum(model.counts[c] for c in some[:-1]) < 20 <= sum(model.counts[c] for c in some)
    blocks = dict(model.visits(every))
    assert sorted(blocks) == list(range(int((model.block + model.parts).max())))
