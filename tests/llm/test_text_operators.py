"""BPE, license scans, language ID, quality and chat formatting on small inputs."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from lograil.llm import bpe, chat, langid, licenses, quality

ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "a"), (None, "the mit license"), (4, "a"), (5, "x" * 20_000),
       (6, "word " * 4_000), (7, "é 中 👍 <|endoftext|> don't"), (8, "\x00\x1c\u0085  b")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_equals_the_library(docs_of):
    library = Tokenizer.from_file(bpe.default_path())
    rng = random.Random(3)
    pool = [" ", "  ", "\n", "a", "The", "é", "²", "中", "👍", "'s", "'LL", "!", "<|endoftext|>", "12", " ", "﻿"]
    pairs = ODD + [(100 + i, "".join(rng.choices(pool, k=rng.randint(0, 30)))) for i in range(200)]
    got = sorted((tuple(r) for r in bpe.digests(docs_of(pairs)).collect()), key=str)
    want = []
    for i, t in pairs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=str)


def test_bpe_long_and_short_words_agree():
    v = bpe.Vocabulary(open(bpe.default_path()).read())
    rng = random.Random(1)
    for n in (1, 2, 3, 50, 400):
        parts = [v.byte_ids[rng.choice(b"abcdeeet ")] for _ in range(n)]
        assert v.merge_short(parts[:]) == v.merge_long(parts[:])


def test_bpe_ids_decode(docs_of):
    pairs = [(i, t) for i, t in ODD if t is not None]
    back = bpe.decode(bpe.encode(docs_of(pairs))).collect()
    assert sorted(r.text for r in back) == sorted(t for _, t in pairs)
    assert bpe.digests(docs_of([])).count() == 0


def brute_licenses(text):
    import re
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in licenses.PHRASES.items() for p in [phrase.split()]
              for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    return len(words), sorted(places)


def test_license_places(docs_of):
    texts = ODD + [(20, "MIT License mit license, cc-by CC BY cc by"), (21, "Apache\nLicense GNU General  Public license"),
                   (22, "omit license; mit licenses; K mit license émit license"), (23, "mit license"),
                   (24, "MIT LICENSE İ apache license " * 3)]
    got = licenses.scan(docs_of(texts)).collect()
    assert sorted((str(r.doc_id), r.n_words, [tuple(p) for p in r.places]) for r in got) == sorted(
        (str(i), *brute_licenses(t)) for i, t in texts)
    assert licenses.summary(docs_of([])).count() == 0


def test_license_templates(docs_of):
    notice = licenses.TEMPLATES["mit-notice"][1]
    words = notice.split()
    cut = " ".join(w for w in words if w not in {"granted", "charge"})
    texts = [(1, notice.upper()), (2, cut), (3, " ".join(words[:8])), (4, "a\n" + notice + "\nb"), (5, "mit license")]
    got = {r.doc_id: r for r in licenses.summary(docs_of(texts)).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4, 5)] == ["mit-notice", "mit-notice", "", "mit-notice", "mit"]
    assert got[1].score == 1.0 and 0.8 <= got[2].score < 1 and got[3].score == 0 and got[5].score == 1.0
    # Filters lose nothing: plain containment of every block gives the same hits.
    for i, text in texts:
        want = set()
        for label, ts in licenses.TEMPLATES.items():
            for t in ts:
                t = set(t.split())
                if any(len(t & set(b.lower().split())) >= licenses.needed(len(t), 0.8) for b in text.split("\n")):
                    want.add(label)
        found = {h.label for r in licenses.scan(docs_of([(i, text)])).collect() for h in r.hits}
        assert found == want


def test_language(docs_of):
    en = "the cat and the dog were in the house with a friend who was there "
    de = "der hund und die katze waren in dem haus mit einem freund der dort war "
    pairs = [(i, (en if i % 2 else de) * (1 + i % 4)) for i in range(60)]
    odd = [(101, None), (102, ""), (103, "12 345 !?"), (None, en), (104, en * 500), (105, de)]
    lang = {i: "en" if i % 2 else "de" for i in range(60)} | {101: None, 105: None}
    df = docs_of(pairs + odd, lang=lang)
    rows = langid.summary(df).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 66
    assert all(got[i].lang_pred == lang[i] for i in range(60))
    assert [got[i].lang_pred for i in (101, 102, 103, 104, 105)] == ["und", "und", "und", "en", "de"]
    assert all(0 <= r.score <= 1 for r in rows) and got[101].score == 0 and got[None].held_out
    # The same prediction whatever the other columns say.
    other = langid.predict(df.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.col("doc_id") + 1000),
                           langid.dictionaries(df))
    assert sorted(r.lang_pred for r in other.collect()) == sorted(r.lang_pred for r in rows)
    nothing = langid.summary(docs_of([(1, None), (2, "abc")], lang={1: None, 2: None}))
    assert {r.lang_pred for r in nothing.collect()} == {"und"} and langid.summary(docs_of([])).count() == 0


def test_language_held_out_accuracy(spark):
    rows = langid.summary(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95


def test_quality(spark, docs_of):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    good = [(i, " ".join(word() for _ in range(60))) for i in range(80)]
    bad = [(i, " ".join(word().upper() + "$$$" for _ in range(60))) for i in range(80, 160)]
    odd = [(200, None), (201, ""), (None, good[0][1]), (0, good[0][1]), (202, "AB$$$ " * 5000)]
    labels = spark.createDataFrame(
        [(i, int(i < 80)) for i in range(160)] + [(900, 1), (None, 0), (3, None), (3, 1)],
        "doc_id long, quality int")
    df = docs_of(good + bad + odd)
    rows = quality.summary(df, labels).collect()
    assert len(rows) == 165 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    right = [r.predicted == int(r.doc_id < 80) for r in rows if r.doc_id is not None and r.doc_id < 160]
    assert sum(right) / len(right) > 0.98
    again = quality.summary(df.withColumn("lang", F.lit("q")).withColumn("source", F.lit("q")), labels)
    assert sorted((str(r.doc_id), r.score) for r in again.collect()) == sorted((str(r.doc_id), r.score) for r in rows)
    kept = quality.kept_documents(df, labels)
    assert kept.columns == df.columns and 75 <= kept.where("doc_id < 160").count() <= 85
    none = quality.summary(docs_of([(1, "a")]), labels.where("quality > 5"))
    assert none.first().score == 0.5
    assert quality.summary(docs_of([]), labels).count() == 0


def test_factorisation_identity():
    import numpy as np
    m = quality.Machine()
    ids, x = np.array([3, 9, 70, quality.FEATURES - 1], np.int32), np.array([1, 2, 0.5, 3], np.float32)
    plain = sum(float(m.v[a] @ m.v[b]) * x[i] * x[j] for i, a in enumerate(ids) for j, b in enumerate(ids) if i < j)
    assert m.margins(ids, x, np.array([0]))[0][0] == pytest.approx(plain, abs=1e-5)


def test_chat_round_trip(spark):
    odd = ["", None, "<|im_end|>", "<|im_start|>assistant ok", "<||", "<|||", "a\\b", "<", "<|n", "x\ny", "é👍" * 3000]
    rows = [(c, t, role, text) for c in range(3) for t, text in enumerate(odd) for role in ("assistant", "us\ner", None)]
    rows += [(9, None, "user", "no turn"), (9, 1, "user", "one"), (9, 1, "user", "one"), (None, 0, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS loss")
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    assert len(got) == 5
    for c, r in got.items():
        mine = sorted(((t, role or "", text or "") for cc, t, role, text in rows if cc == c),
                      key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        assert r.turns_sha256 == sha("".join(f"{role}\n{text}\n" for _, role, text in mine))
        loss = "".join(text for _, role, text in mine if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(mine), len(loss), sha(loss))
    text = chat.formatted(chat.canonical_turns(df.where("conv_id = 0"))).first().formatted
    assert text.count(chat.START) == text.count(chat.END) == got[0].n_turns
    assert chat.digests(df.where("false")).count() == 0


def test_chat_layouts(spark):
    records = {
        1: {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 5},
        2: {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        3: {"prompt": "q", "response": "a", "extra": {"role": "x"}}, 4: {"instruction": "q", "output": "a"},
        5: {"instruction": "q", "input": "i", "output": "a"}, 6: {"system": "s", "prompt": "q", "response": "a"},
        7: {"prompt": "q", "completion": "a"}, 8: {"other": 1}}
    rows = [(i, json.dumps(r)) for i, r in records.items()] + [(9, "no json"), (10, None)]
    df = spark.createDataFrame(rows, "conv_id long, record_text string")
    turns = {}
    for r in chat.canonical_records(df, "record_text").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    plain = [("user", "q"), ("assistant", "a")]
    assert turns == {1: plain, 2: plain, 3: plain, 4: plain, 5: [("user", "q\n\ni"), ("assistant", "a")],
                     6: [("system", "s"), *plain], 7: plain}
    layouts = {r.conv_id: r.layout for r in chat.with_layout(df, "record_text").collect()}
    assert layouts[8] == layouts[9] == layouts[10] == chat.UNKNOWN and layouts[2] == "shared"
    nested = spark.createDataFrame([(1, [("user", "q"), ("assistant", "a")])],
                                   "conv_id long, messages array<struct<role:string,content:string>>")
    assert [tuple(r) for r in chat.canonical_turns(nested).collect()] == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    with pytest.raises(ValueError):
        chat.canonical_turns(spark.createDataFrame([(1, "x")], "conv_id long, thing string"))


def test_chat_layouts_beside_each_other(spark):
    """Fields of other layouts change nothing; unknown records are kept; any element tells an array's paths."""
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    plain = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for extra in ("prompt", "response", "system", "input", "output", "instruction", "completion", "turns", "parts", "sizes"):
        wide = plain.withColumn(extra, F.lit("other"))
        assert chat.digests(wide).collect() == chat.digests(plain).collect(), extra
    records = {1: {"prompt": "q", "response": "a", "input": "unused"}, 2: {"messages": [{"x": 1}, {"role": "user", "content": "q"}]},
               3: {"messages": []}, 4: {"thing": 1}}
    df = spark.createDataFrame([(i, json.dumps(r), "z") for i, r in records.items()], "conv_id long, body string, layout string")
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.canonical_records(df, "body").na.fill("").collect())
    assert got == [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "", ""), (2, 1, "user", "q")]
    lost = chat.unknown_records(df, "body")
    assert sorted(r.conv_id for r in lost.collect()) == [3, 4] and lost.columns == df.columns


def test_chat_long_conversation(spark):
    """Loss spans over many runs of turns are those of a plain walk."""
    rows = [(1, i, "assistant" if i % 3 else "user", f"<|text {i}" * (i % 4)) for i in range(5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat.formatted(chat.canonical_turns(df)).first()
    at, want = 1, []
    for _, _, role, text in rows:
        head, body = len(f"<|im_start|>{role}\n"), len(text.replace("<|", "<||"))
        if role == "assistant":
            want.append((at + head, body))
        at += head + body + len("<|im_end|>\n")
    assert [tuple(x) for x in r.loss] == want and len(r.formatted) == at - 1


def test_dictionaries_hold_different_texts(docs_of):
    """Copies give one sample; a long text gives an excerpt from a place of its own."""
    same = [(i, f"text number {i % 7} of a few") for i in range(700)]
    long = [(1000 + i, "".join(f"{i}w{j} " for j in range(2000))) for i in range(20)]
    lang = {i: "aa" for i, _ in same} | {i: "bb" for i, _ in long}
    found = langid.dictionaries(docs_of(same + long, lang=lang))
    lines = found["aa"].decode().split("\n")
    assert len(lines) == len(set(lines)) == 7
    starts = [x.split(" ")[1] for x in found["bb"].decode().split("\n")]
    assert len({s.split("w")[1] for s in starts}) > 5


def test_license_notices_wrapped_and_repeated(docs_of):
    """A notice over several lines is one block; very many places of a phrase are all found."""
    words = licenses.TEMPLATES["mit-notice"][1].split()
    wrapped = "\r\n".join(" * " + " ".join(words[i:i + 8]) for i in range(0, len(words), 8))
    far = "\n\n".join(" ".join(words[i:i + 8]) for i in range(0, len(words), 8))
    many = "x mit license, cc by " * 1500
    got = {r.doc_id: r for r in licenses.summary(docs_of([(1, "head\n\n" + wrapped + "\n\ntail"), (2, far), (3, many)])).collect()}
    assert (got[1].labels, got[1].score) == ("mit-notice", 1.0) and got[2].labels == ""
    n, places = brute_licenses(many)
    mine = licenses.scan(docs_of([(3, many)])).first()
    assert mine.n_words == n and [tuple(p) for p in mine.places] == places and got[3].n_base == 3000
    assert got[3].first_word == 1 and got[3].last_word == places[-1][0]


FOLDER = "/root/testdata/sf0.001"


def test_language_equals_brute_force(spark, docs_of):
    """Dictionaries, sizes, scores and margins as plain Python has them, over whole texts."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(9_001, None, "en"), (9_002, "12 34", "en"), (9_003, "", None), (None, "le chat", "fr")],
                                docs.schema)
    rows = [tuple(r) for r in docs.union(odd).collect()]
    known = brute.languages(rows)
    assert langid.dictionaries(docs.union(odd)) == known and len(known) >= 4
    want = sorted((str(i), brute.is_held_out(i), *brute.language(t, known)) for i, t, _ in rows)
    got = sorted((str(r.doc_id), r.held_out, r.lang_pred, r.score, r.accepted)
                 for r in langid.summary(docs.union(odd)).collect())
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-12)


def test_quality_equals_brute_force(spark):
    """Scores of the fitted machine from features counted one by one and all their pairs."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    machine = quality.train(docs, labels)
    want = {r.doc_id: brute.quality_score(r.text, r.n_chars, machine) for r in docs.collect()}
    got = {r.doc_id: r for r in quality.summary(docs, labels).collect()}
    assert {i: r.score for i, r in got.items()} == pytest.approx(want, abs=1e-4)
    assert all(r.held_out == brute.is_held_out(i) and r.predicted == (r.score >= 0.3) for i, r in got.items())


def test_quality_of_several_texts_under_one_id(spark, docs_of):
    """Whatever the order of the rows, the same text is learned from."""
    pairs = [(i, f"word {i} and more") for i in range(40)] + [(i, f"OTHER ## {i}") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    one, two = (quality.train(docs_of(p).repartition(n), labels) for p, n in ((pairs, 1), (pairs[::-1], 7)))
    assert one.bias == two.bias and (one.w == two.w).all() and (one.v == two.v).all()


def test_license_notice_in_a_long_paragraph(docs_of):
    words = licenses.TEMPLATES["mit-notice"][1].split()
    wrapped = "\n".join(" ".join(words[i:i + 6]) for i in range(0, len(words), 6))
    lines = "\n".join(f"line {i} of code" for i in range(400))
    got = {r.doc_id: r.labels for r in licenses.summary(docs_of([(1, lines + "\n" + wrapped), (2, lines)])).collect()}
    assert got == {1: "mit-notice", 2: ""}
