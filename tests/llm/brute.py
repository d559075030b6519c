"""Operators in plain Python, by their definitions: nothing of the library but its constants and a fitted model."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter

import numpy as np
import regex
import xxhash
import zstandard

ASCII_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def is_held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


# Benchmark decontamination.

def item_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().translate(ASCII_LOWER))


def item_shingles(words):
    k = min(5, len(words))
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)] if k else []


def contaminated(pairs, items, least=0.8):
    """(doc_id, item_id, similarity, start), ids as text, of every item in every document."""
    held = Counter(s for _, t in items for s in set(item_shingles(item_words(t))))
    weight = lambda s: math.log(1 + len(items) / max(held[s], 1))
    out = []
    for doc_id, text in pairs:
        words = item_words(text)
        for item_id, item_text in items:
            own = item_words(item_text)
            shingles, best = Counter(item_shingles(own)), (0, 0)
            n, k = len(own), min(5, len(own))
            if not n or n > len(words):
                continue
            # A window without any shingle of the item has similarity 0.
            marked = [tuple(words[i:i + k]) in shingles for i in range(len(words) - k + 1)]
            before = np.concatenate([[0], np.cumsum(marked)])
            for s in range(len(words) - n + 1):
                if before[s + n - k + 1] > before[s]:
                    window = Counter(item_shingles(words[s:s + n]))
                    both = shingles.keys() | window.keys()
                    low = math.fsum(weight(x) * min(shingles[x], window[x]) for x in both)
                    high = math.fsum(weight(x) * max(shingles[x], window[x]) for x in both)
                    best = max(best, (round(low / high, 9), -s))
            if best[0] >= least:
                out.append((str(doc_id), str(item_id), best[0], -best[1]))
    return sorted(out)


# Language identification.

def languages(rows, sample=200, excerpt=1_000, most=200_000):
    """Dictionaries by language from (doc_id, text, lang) rows, most rows first."""
    learned = [(t, lang) for i, t, lang in rows if lang is not None and not is_held_out(i)]
    count = Counter(lang for _, lang in learned)
    texts = {}
    for text, lang in learned:
        if regex.search(r"\p{L}", text or ""):
            h = xxhash.xxh64_intdigest(text.encode(), 42)
            h -= (h >> 63) << 64
            at = h % (max(len(text) - excerpt, 0) + 1)
            texts.setdefault(lang, {})[h] = text[at:at + excerpt]
    return {lang: b"\n".join(texts[lang][h].lower().encode() for h in sorted(texts[lang])[:sample])[-most:]
            for lang in sorted(texts, key=lambda x: (-count[x], x))}


def language(text, dictionaries, level=6, piece=4_000, unit=6.0, margin=0.01):
    """(language, score, accepted) of a text."""
    if not dictionaries or not any(c.isalpha() for c in text or ""):
        return "und", 0.0, False
    data, sizes = text.lower().encode(), {}
    for lang, content in dictionaries.items():
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=level)
        packer = zstandard.ZstdCompressor(dict_data=known, write_content_size=False)
        sizes[lang] = sum(len(packer.compress(data[i:i + piece])) for i in range(0, len(data), piece))
    ranked = sorted(sizes, key=sizes.get)
    best = sizes[ranked[0]]
    score = 1 / sum(math.exp((best - s) / unit) for s in sizes.values())
    lead = sizes[ranked[1]] - best if len(ranked) > 1 else best
    return ranked[0], score, lead >= max(1, margin * best)


# Quality.

def quality_score(text, n_chars, machine, buckets=1 << 16):
    """A fitted factorisation machine's score, all pairs of features one by one."""
    data, chars = (text or "").encode(), len(text or "")
    words, lines = data.lower().split(), data.split(b"\n")
    n, size = max(len(words), 1), max(len(data), 1)
    share = lambda wanted: sum(b in wanted for b in data) / size
    told = chars if n_chars is None else max(n_chars, 0)
    shapes = [
        share(string.ascii_uppercase.encode()), share(string.digits.encode()), share(string.punctuation.encode()),
        share(b"#$%&*|<>{}\\^~@_=+"), 1 - share(string.ascii_letters.encode() + bytes(range(128, 256))),
        sum(a == b for a, b in zip(words, words[1:])) / n, len(set(words)) / n, min(len(data) / n, 40) / 10,
        math.log1p(n) / 10, math.log1p(len(lines)) / 5, 1 - len(set(lines)) / len(lines),
        abs(math.log1p(chars) - math.log1p(told))]
    x = {b: 1.0 for b in {xxhash.xxh64_intdigest(w) % buckets for w in words}}
    x = {b: 1 / math.sqrt(len(x)) for b in x}
    x |= {buckets + i: min(max(4 * v, 0), 8) for i, v in enumerate(shapes)}
    ids, values = np.array(list(x)), np.array(list(x.values()))
    factors = machine.v[ids].astype(float) * values[:, None]
    pairs = np.triu(factors @ factors.T, 1).sum()
    margin = machine.bias + float(machine.w[ids].astype(float) @ values) + pairs
    return 1 / (1 + math.exp(-min(max(margin, -30), 30)))


# Substrings of 13 words.

def without_repeats(pairs, n=13):
    """The text of every row: kept words joined by a space where words go, else as it is. Ids are not null."""
    rows = [(i, t, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in pairs]
    first = {}
    for i, _, w in rows:
        for s in range(len(w) - n + 1):
            key = tuple(w[s:s + n])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t, w in rows:
        gone = {x for s in range(len(w) - n + 1) if first[tuple(w[s:s + n])] < i for x in range(s, s + n)}
        out.append((i, b" ".join(x for j, x in enumerate(w) if j not in gone).decode() if gone else t))
    return out
