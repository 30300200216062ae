"""Operator 12 against counting in memory: border failures, long texts, languages, odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from leadlens.llm.common import ASCII_LOWER
from leadlens.llm.phrase_mining import _chunks, collocations, phrase_counts

SCHEMA = "text string, lang string, phrase string, hash long, len int"


def brute_counts(rows, least):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII_LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    return {lang: {p: c for p, c in f[lang].items() if c >= least} for lang in f}, n


def brute(rows, least=30, top=2000):
    counts, n = brute_counts(rows, least)
    out = []
    for lang, f in counts.items():
        cands, best = {p: a for p, a in f.items() if " " in p}, []
        for p, a in cands.items():
            w = p.split(" ")
            cuts = [(2000000 * a // (f[" ".join(w[:k])] + f[" ".join(w[k:])]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            if not any(100 * b >= 80 * a and f" {p} " in f" {q} " for q, b in cands.items() if len(q.split(" ")) > len(w)):
                best.append((-score, -a, p.encode(), f[" ".join(w[:k])], f[" ".join(w[k:])]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(best)[:top])]
    return sorted(out)


def texts(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(60)] + ["é", "ß\x00", "it's"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    fixed = ["alpha Beta gamma delta epsilon", "alpha beta zeta", "one two\tthree  four"]
    out = []
    for _ in range(n):
        words = rng.choices(vocabulary, weights, k=rng.randrange(60))
        for _ in range(rng.randrange(3)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(fixed))
        out.append((rng.choice([" ", " ", ". ", "\n"]).join(words), rng.choice(["en", "de", None, ""])))
    return out


ODD = [(None, "en"), ("", "en"), (" \t\n", None), ("a,b" * 400, "xx"), ("Rare pair " * 40, "en"), ("solo", "one"),
       ("a a a a a a a a " * 10, "rep")]


def answer(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sample", [0.125, 0.0])  # without any proposal all is found by border failures
def test_against_brute_force(spark, sample):
    rows = texts(400, 5) + ODD
    d = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    counts = phrase_counts(d, sample=sample, chunk=300).cache()
    f, n = brute_counts(rows, 30)
    assert {(r.lang, r.phrase): r.cnt for r in counts.filter("len > 0 AND cnt >= 30").collect()} == {
        (lang, p): c for lang in f for p, c in f[lang].items()}
    assert {r.lang: r.cnt for r in counts.filter("len = 0").collect()} == {k: v for k, v in n.items() if v}
    assert answer(collocations(counts)) == brute(rows)
    assert answer(collocations(counts, top=3)) == brute(rows, top=3)


def test_large_counts_are_exact(spark):
    big = 3 * 10 ** 15
    counts = spark.createDataFrame([("x", "a", 1, big + 1), ("x", "b", 1, big + 2), ("x", "a b", 2, big), ("x", "", 0, 2 * big)],
                                   "lang string, phrase string, len int, cnt long")
    assert answer(collocations(counts)) == [("x", 1, "a b", big, big + 1, big + 2, 2 * big,
                                             2000000 * big // (2 * big + 3))]


def test_chunks_cut_nothing():
    rng = random.Random(1)
    docs = ["".join(rng.choice(["a", "bc", " ", "\n", "é", ".", "  "]) for _ in range(rng.randrange(300))) for _ in range(20)]
    salt = np.arange(20, dtype=np.uint64)
    whole = next(_chunks(docs, salt, 1 << 20))
    for chunk in (1, 7, 100):
        hashes, last = [], []
        for w in _chunks(docs, salt, chunk):
            hashes += w.hash[w.old:].tolist()
            last += [w.text(i, 1) for i in range(w.old, w.n)]
        assert hashes == whole.hash.tolist()
        assert last == [whole.text(i, 1) for i in range(whole.n)]


def test_empty_table(spark):
    assert collocations(phrase_counts(spark.createDataFrame([], SCHEMA))).collect() == []
