"""The fill-in-the-middle transformation and its wavelet matrix against plain Python."""

import hashlib
import random
import re

import numpy as np

from lograil.llm import middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, mid, last = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    spm = h4 % 100 < 80
    out = f"<S>{last}<P>{first}<M>{mid}" if spm else f"<P>{first}<S>{last}<M>{mid}"
    return doc_id, n, "spm" if spm else "psm", len(first), len(mid), sha(out), sha(text)


def test_digests_equal_brute_force(docs_of):
    rng = random.Random(5)
    pool = [" ", "  ", "\n", "\t", "a", "word", "é", "👍", "\x85", "\x1c", "<", "<P", ">", "S>", "<<"]
    pairs = [(i, "".join(rng.choices(pool, k=rng.randint(0, 40)))) for i in range(400)]
    pairs += [(1000, None), (1001, ""), (1002, " \n "), (None, "a b c d e"), (1003, "see <M> here"), (1003, "see <M> here"),
              (1004, "long word " * 50_000), (1005, "x" * 300_000), (1006, " " * 5_000), (-7, "a b  c ")]
    got = sorted((tuple(r) for r in middle.digests(docs_of(pairs)).collect()), key=str)
    assert got == sorted((brute(*p) for p in pairs), key=str)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}
    assert middle.digests(docs_of([])).count() == 0


def test_output_reads_back(docs_of):
    rows = middle.transform(docs_of([(i, f"one {i}  two\nthree <") for i in range(200)]), rate=100, suffix_first=50).collect()
    assert {r.form for r in rows} == {"psm", "spm"}
    assert all(r.restored == f"one {r.doc_id}  two\nthree <" and len(r.output) == len(r.restored) + 9 for r in rows)


def test_wavelet_matrix_ranks_and_selects():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 1000):
        s = rng.integers(0, 4, n).astype(np.uint8)
        m = middle.WaveletMatrix(s)
        for c in range(4):
            assert m.rank(c, np.arange(n + 1)).tolist() == [int((s[:i] == c).sum()) for i in range(n + 1)]
            places = np.flatnonzero(s == c)
            assert m.select(c, np.arange(len(places))).tolist() == places.tolist()
