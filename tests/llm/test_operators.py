"""The ten operators and the pipeline: SQL oracles, brute force, round trips, and odd inputs."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from leadlens import llm
from leadlens.llm import (
    html_extract, language_id, license_scan, line_quality, mixing, ngram_join, sentencepiece_sampling,
    suffix_tree_lm, topk, warc_revisit)
from leadlens.llm.common import components, table
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

DOCS = "doc_id long, text string, lang string, source string, n_chars long, words string, block int"
LONG = " ".join(f"w{i % 977} of the" for i in range(20_000))
ODD = [
    (1, None, None, None, None, "x", 1), (2, "", "en", "a", 0, "x", 1), (3, " \n\t ", "en", "a", 3, None, None),
    (4, "one", "en", None, 3, "x", 1), (4, "one", "en", None, 3, "x", 1), (None, "no id here at all", "en", "a", 1, "x", 1),
    (6, LONG, "en", "b", len(LONG), "x", 1), (7, LONG, "de", "b", len(LONG), "x", 1),
    (8, "Licensed under CC BY-NC 4.0. ﬁ 日本 é\x00\U0001f600 ▁ x", "fr", "c", 1, "x", 1),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_oracle(spark, name):
    msg, ok = compare(spark, name, llm.queries()[name], llm.oracle_sql()[name], SF_SMALL, duck(SF_SMALL))
    assert ok, msg


OPERATORS = {
    "license": lambda d: license_scan.license_spans(d),
    "lines": lambda d: line_quality.line_quality(d),
    "good": lambda d: line_quality.keep_good(d),
    "jaccard": lambda d: ngram_join.jaccard_components(d),
    "first": lambda d: ngram_join.first_of_each(d),
    "language": lambda d: language_id.keep_known(d),
    "mix": lambda d: mixing.mix(d),
    "mixed": lambda d: mixing.mixed_docs(d),
    "encode": lambda d: sentencepiece_sampling.encode_samples(d, F.col("doc_id"), carry=["doc_id", "words"]),
    "lm": lambda d: suffix_tree_lm.lm_scores(d),
    "pages": lambda d: html_extract.extract_pages(d.withColumnRenamed("text", "html")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_and_empty_tables(odd, none, name):
    rows = OPERATORS[name](odd).collect()
    assert OPERATORS[name](none).collect() == []
    expect = {"license": None, "lines": 9, "jaccard": 9, "lm": 9, "pages": 9}.get(name)
    assert expect is None or len(rows) == expect


def test_license_spans(spark):
    d = spark.createDataFrame([(1, "It is licensed under the Apache Public License, Version 2.0 now. All rights reserved. "
                                   "cc by cc-by all rights; general public license")], "doc_id long, text string")
    s = [(r.label, r.base, r.start, r.end, r.exact) for r in license_scan.license_spans(d).collect() if r.label]
    assert ("reserved", True, 12, 15, True) in s and ("gpl", True, 21, 24, True) in s
    assert [x[2] for x in s if x[0] == "cc-by" and x[1]] == [15, 17] or sorted(
        x[2] for x in s if x[0] == "cc-by" and x[1]) == [15, 17]
    # a word put in: two neighbouring diagonals of one span
    assert [(x[2], x[4]) for x in s if x[0] == "apache-2.0" and not x[1]] == [(2, False)]


@pytest.mark.parametrize("label,text", [
    ("mit", "Released under MIT License"), ("mit", "Released under the MIT Licence"),
    ("mit", "Released now under the MIT License"), ("apache-2.0", "Licensed under Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache Licence, Version 2.0"),
    ("gpl-3.0", "licensed under the GNU General Public Licence version 3"),
    ("cc-by-nc-4.0", "Licensed under the CC BY-NC 4.0")])
def test_license_notice_with_a_changed_word(spark, label, text):
    d = spark.createDataFrame([(1, f"some of the words before. {text}, and words after")], "doc_id long, text string")
    assert {r.label for r in license_scan.license_spans(d).collect() if r.base is False} == {label}


@pytest.mark.parametrize("text", [
    "licensed under the GNU General Public License version 4", "Licensed under CC BY-ND 4.0",
    "licensed under a Creative Commons Attribution 3.0 International License", "Licensed under the Apache License, Version 3.1"])
def test_license_of_another_version_is_no_match(spark, text):
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert not [r for r in license_scan.license_spans(d).collect() if r.base is False]


def test_html():
    page = ("<body><nav><a>Home</a> | <a>News</a></nav><div class='cookie-notice'>We use cookies</div><header>Site</header>"
            "<main><h1>T&eacute;st</h1><p>A long enough paragraph of\n text, with <b>marks</b> &amp; more of it."
            "<p>Short.<script>var a='<p>no</p>'</script><aside>Side</aside><form>Name</form>"
            "<div class='comments'><p>I like this post very much and more</p></div></main><footer>&copy; us</footer>")
    assert html_extract.main_text(page)[0] == (
        "Tést\n\nA long enough paragraph of text, with marks & more of it.\n\nShort.")
    assert html_extract.main_text(None)[0] == "" and html_extract.main_text("<nav>x</nav>")[0] == ""
    assert html_extract.main_text("<p>" * 3000 + "deep")[0] == "deep"


def test_html_article_over_sibling_containers():
    parts = [[f"Part {k}, paragraph {i}: " + "a sentence of the one article goes on and on here. " * 4 for i in range(n)]
             for k, n in enumerate((9, 3))]
    for tag in ("div", "section"):
        blocks = "".join(f"<{tag}>" + "".join(f"<p>{x}</p>" for x in p) + f"</{tag}>" for p in parts)
        page = (f"<body><nav><a>Home</a><a>News</a></nav><div class='wrap'>{blocks}</div>"
                "<div class='sidebar'><p>Side</p></div><footer>&copy; us</footer></body>")
        assert html_extract.main_text(page)[0].split("\n\n") == [x.strip() for p in parts for x in p]


def _sets(rows, n=4):
    lower = {i: i + 32 for i in range(65, 91)}
    out = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        out[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    return out


def test_jaccard_against_brute_force(spark):
    rng = random.Random(3)
    base = [[f"v{rng.randrange(400)}" for _ in range(rng.choice([3, 12, 60, 150]))] for _ in range(40)]
    rows = []
    for k in range(400):
        w = list(base[rng.randrange(6) if k % 3 else rng.randrange(40)])
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(400)}"
        rows.append((k, " ".join(w).title()))
    sets, parent = _sets(rows), {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in itertools.combinations(sets.items(), 2):
        o = len(x & y)
        if o and 100 * o >= 85 * (len(x) + len(y) - o):
            p, q = sorted((find(a), find(b)))
            parent[q] = p
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), find(i)) for i in sets}


def test_one_row_of_each_component_stays(spark, odd):
    assert Counter(r.doc_id for r in ngram_join.first_of_each(odd).collect()) == Counter([1, 2, 3, 4, None, 6, 8])
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(None, "clean and of its own kind", "a"), (None, text, "a"), (None, text, "a"), (None, text, "b"),
            (None, "", "a"), (5, "x " + text[::-1], "a"), (5, "x " + text[::-1], "b"), (5, "another text under five", "a"),
            (9, "x " + text[::-1], "a"), (None, "x " + text[::-1], "a")]
    out = ngram_join.first_of_each(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert out.columns == ["doc_id", "text", "source"]
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter([
        (None, "clean and of its own kind"), (None, text), (None, ""), (5, "x " + text[::-1]),
        (5, "another text under five")])


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{k: 100 for k in range(100, 160)}}


def test_forward_backward_against_enumeration(monkeypatch):
    rng = np.random.default_rng(0)
    emit, step = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))

    def brute(e):
        out = np.zeros(e.shape)
        for y in itertools.product(range(3), repeat=len(e)):
            v = math.exp(sum(e[i, k] for i, k in enumerate(y)) + sum(step[a, b] for a, b in zip(y, y[1:])))
            for i, k in enumerate(y):
                out[i, k] += v
        return out / out.sum(axis=1, keepdims=True)

    for span in (2, 3, 64):
        monkeypatch.setattr(language_id, "SPAN", span)
        got = language_id.marginals(emit, step, np.array([6, 3]))
        assert np.allclose(got, np.vstack([brute(emit[:6]), brute(emit[6:])]))


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF_SMALL.replace("0.001", "0.01"), "documents")
    r = language_id.op4_language_id(spark, SF_SMALL.replace("0.001", "0.01")).join(docs.select("doc_id", "lang"), "doc_id")
    held = r.filter("held_out and lang is not null")
    assert held.filter("lang = lang_pred").count() >= 0.97 * held.count()


def test_code_switched_words_are_labelled_apart():
    a, b = [f"tha{x}" for x in "bcdfg"], [f"öch{x}" for x in "bcdfg"]
    weights, step = language_id.fit([(a * 12, 0), (b * 12, 1)] * 6, 2)
    p = language_id.marginals(language_id.potentials(weights, a + b), step, np.array([10]))
    assert p.argmax(axis=1).tolist() == [0] * 5 + [1] * 5


def test_mixing(spark):
    assert mixing.targets([100, 10, 0], [1, 2, 3]) == [80.0, 30.0, 0.0]
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 90)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(6000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(d, block=256).collect()
    assert sorted(r.doc_id for r in got) == list(range(6000))
    again = {r.doc_id: r.copies for r in mixing.mix(d.repartition(7), block=256).collect()}
    assert again == {r.doc_id: r.copies for r in got}
    for s in ("a", "b", "c", None):
        own = [r for r in got if r.source == s]
        assert abs(sum(r.size * r.copies for r in own) - own[0].target) < 30 and max(r.copies for r in own) <= 3
    stay = mixing.mixed_docs(d).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in stay} == {r.doc_id: r.copies for r in mixing.mix(d).collect() if r.copies}


def test_quality(spark):
    good = "This is a whole sentence of the text and it goes on. " * 3
    lines = [f"{good} {k}." for k in range(5)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(f"home{k} | news{k} | about{k} | more{k}" for k in range(20))),
            (3, "\n".join([*lines, "Accept cookies to go on.", "home | news"]))]
    got = {r.doc_id: r for r in line_quality.line_quality(spark.createDataFrame(rows, "doc_id long, text string"),
                                                         max_repeat_percent=100).collect()}
    assert got[1].kept and not got[2].kept and got[2].clean_text == "" and got[3].kept
    assert got[3].clean_text == rows[0][1]


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(900, 12)).astype("float32")
    v[:300] = v[0]  # many equal vectors
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(2000, None), (2050, [float("nan")] * 12), (2100, [None] * 12),
                                                         (2150, []), (None, [1.0] * 12), (2200, [1.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    w = {i: np.floor(256 * np.array(x, dtype=float)) for i, x in rows[:900]} | {2200: np.array([256.0] + [0] * 11)}
    want = set()
    for q in w:
        if q % 50 == 0:
            best = sorted((-int(w[q] @ x), i) for i, x in w.items() if i != q)[:5]
            want |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    assert {tuple(r) for r in topk.top_k(d, F.col("id") % 50 == 0).collect()} == want
    assert topk.top_k(d.limit(0), F.col("id") % 50 == 0).collect() == []


def test_gumbel_samples_have_the_right_chances():
    m = sentencepiece_sampling.read_pieces()
    lp = {m["pieces"][i]: float(x) for i, x in zip(m["normal"], m["log_p"])}

    def paths(u):
        return [((), 0.0)] if not u else [((u[:j], *s), lp[u[:j]] + q) for j in range(1, len(u) + 1) if u[:j] in lp
                                         for s, q in paths(u[j:])]

    every = paths("▁ab▁c")
    z = np.logaddexp.reduce([q for _, q in every])
    p = {s: math.exp(q - z) for s, q in every}
    n = 8000
    rows, ids, per = sentencepiece_sampling.Sampler(m, 3).sample(["ab c"] * n, list(range(n)))
    ends = np.cumsum(per)
    got = [[] for _ in range(n)]
    for k, r in enumerate(rows):
        got[r[0]].append((tuple(m["pieces"][i] for i in ids[ends[k] - per[k]:ends[k]]), r))
    assert all(len({s for s, _ in g}) == 3 and g[0][1][3] >= g[1][1][3] >= g[2][1][3] for g in got)
    first, pairs = Counter(g[0][0] for g in got), Counter((g[0][0], g[1][0]) for g in got)
    assert max(abs(first[s] / n - x) for s, x in p.items()) < 0.02
    assert max(abs(pairs[a, b] / n - p[a] * p[b] / (1 - p[a])) for a in p for b in p if a != b) < 0.02
    # the inclusion scores weigh the samples back to the whole
    assert abs(np.mean([sum(math.exp(r[2] - r[4]) for _, r in g) for g in got]) - 1) < 0.01


def test_round_trip(odd):
    rows = sentencepiece_sampling.decoded(sentencepiece_sampling.encode_samples(
        odd, F.col("doc_id"), carry=["doc_id"]), into="back").collect()
    want = {r[0]: (r[1] or "").replace("▁", " ") for r in ODD}
    assert all(r.back == want[r.doc_id] for r in rows) and {r.rank for r in rows} == {1, 2}


BODY = "A sentence that is long enough to be the text of an article, and then some more words. " * 4


@pytest.mark.parametrize("page,want", [
    (f'<article><div class="entry-header"><h1>Title</h1></div><p>{BODY}</p><p class="legal">Law.</p>'
     f'<div class="related-work"><p>Earlier work.</p></div><div class="share-buttons">Share</div>'
     f'<div class="ad-slot">Buy</div><div id="comments"><p>First!</p></div></article>',
     ["Title", BODY, "Law.", "Earlier work."]),
    (f"<article><p>{BODY}</p><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p></article>", [BODY, "so x=1 holds"]),
    (f"<body><span><article><p>{BODY}</p></span><p>After.</p></article></body>", [BODY, "After."]),
    (f'<body><span class="ad"><p>Buy</span><article><p>{BODY}</p></article></body>', [BODY]),
    (f"<body><nav>Menu</nav><section><p>{BODY}</p><p>{BODY}</p></section><section><p>Tiny end.</p></section></body>",
     [BODY, BODY, "Tiny end."]),
    (f"<body><article><p>{BODY}</p></article><article><p>The second.</p></article><article class='teaser'><p>No.</p>"
     "</article></body>", [BODY, "The second."]),
    (f"<body><div>Shop</div><div class='part'><p>{BODY}</p><p>{BODY}</p></div><div class='part'><p>End.</p></div></body>",
     [BODY, BODY, "End."]),
])
def test_html_keeps_the_whole_article(page, want):
    assert html_extract.main_text(page)[0].split("\n\n") == [x.strip() for x in want]


def test_lm_base_and_normalisation(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    lower = {i: i + 32 for i in range(65, 91)}
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) + [None] for i, t in docs}
    count = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    total, v = sum(count.values()), len(count)
    for r in suffix_tree_lm.op10_lm_score(spark, sf).collect():
        ws = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(count[w] > 0 for w in ws), total)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (total + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.score < 0


def plain_lm(docs: dict[int, list[str]], held: set[int]) -> dict[int, float]:
    """Scores by dictionaries: words, contexts of one and of two words, longest kept context."""
    m = suffix_tree_lm
    texts = {i: ["", *ws, ""] for i, ws in docs.items()}
    grams = Counter(tuple(t[k - n:k + 1]) for i, t in texts.items() if i not in held
                    for k in range(1, len(t)) for n in range(min(k, 2) + 1))
    total, v = sum(c for g, c in grams.items() if len(g) == 1), sum(len(g) == 1 for g in grams)
    count = lambda g: grams[g] if grams[g] >= m.KEEP else 0
    kept: dict[tuple, float] = {}

    def p(w, ctx):
        if not ctx:
            return (grams[w,] + 1) / (total + v + 1)
        lower = p(w, ctx[1:])
        return lower if ctx not in kept else max(count((*ctx, w)) - 1, 0) / grams[ctx] + kept[ctx] * lower

    for size in (1, 2):
        after: dict[tuple, list] = {}
        for g, c in grams.items():
            if len(g) == size + 1 and grams[g[:-1]] >= m.MIN_COUNT:
                after.setdefault(g[:-1], []).append((g[-1], c))
        new = {}
        for ctx, words in after.items():
            n = sum(c for _, c in words)
            share = 1 - sum(c - 1 for _, c in words if c >= m.KEEP) / n
            at = max(s for s in m.SHARES if s <= share)
            gain = sum(c * math.log((c - 2) / n / p(w, ctx[1:]) + at if c > m.KEEP else share) for w, c in words)
            if gain > m.MIN_GAIN:
                new[ctx] = share
        kept |= new
    assert {len(c) for c in kept} == {1, 2}
    return {i: sum(math.log10(p(t[k], tuple(t[max(0, k - 2):k]))) for k in range(1, len(t)))
            for i, t in texts.items()}


def test_lm_scores_against_dictionaries(spark, monkeypatch):
    rng = random.Random(3)
    docs = {}
    for i in range(150):
        ws = []
        for _ in range(rng.randrange(60)):
            x = rng.randrange(12)
            ws += [f"a{x}", f"b{x}", f"c{x % 5}"] if rng.random() < 0.7 else rng.choices(["u", "v", "w", f"n{rng.random()}"], k=2)
            if rng.random() < 0.3:
                ws += ["the", f"a{x}", f"d{x}"]
        docs[i] = ws
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 7 == 2}
    want = plain_lm(docs, held)
    d = spark.createDataFrame([(i, " ".join(ws)) for i, ws in docs.items()], "doc_id long, text string").repartition(3)
    for block, stretch in ((1 << 23, 1 << 20), (400, 60)):  # whole texts, and texts over several blocks
        monkeypatch.setattr(suffix_tree_lm, "PER_PART", 700)
        got = {r.doc_id: r for r in suffix_tree_lm.lm_scores(d, block=block, stretch=stretch).collect()}
        assert len(got) == len(docs) and all(math.isclose(got[i].score, want[i], rel_tol=1e-6) for i in docs)
        assert all(got[i].n_tokens == len(docs[i]) + 1 for i in docs)
        assert sum(got[i].score for i in held) > sum(got[i].base_score for i in held)


def test_lm_rejects_contexts_that_tell_nothing():
    zeros = np.zeros(len(suffix_tree_lm.SHARES))
    shares = suffix_tree_lm.back_off_shares(np.array([
        [1000, 500, 400, *(zeros + 900)], [1000, 10, 990, *(zeros + 2)], [9, 8, 0, *(zeros + 99)]]))
    assert shares.tolist() == [0.5, 0, 0]  # the second gains less than it loses, the third is rare


def test_lm_contexts_grow_with_the_corpus(spark):
    def corpus(size):
        rng = random.Random(5)  # each of the words has a next word of its own
        return [(k, " ".join(f"a{x} b{x}" for x in rng.choices(range(size), k=size))) for k in range(40)]

    better = []
    for size in (20, 400):
        rows = suffix_tree_lm.lm_scores(spark.createDataFrame(corpus(size), "doc_id long, text string")).collect()
        held = [r for r in rows if r.held_out]
        better.append(sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held))
    # a known next word is worth half of log10(size) at least, however many contexts there are
    assert better[0] > 0.3 and better[1] > 0.9


def test_revisits(spark):
    h = lambda **x: [(k.replace("_", "-"), v) for k, v in x.items()]
    rows = [("a", "response", 200, "http://WWW.x.org/p/?b=2&a=1&utm_source=z#f", "2024-01-01 00:00:00", "d1",
             h(etag="1", content_type="t", date="old")),
            ("b", "response", 200, "https://x.org:443/p?a=1&b=2", "2024-01-02 00:00:00", "d2", h(etag="2")),
            ("r1", "revisit", 304, "https://x.org/p?a=1&b=2", "2024-01-01 12:00:00", "d1",
             h(etag="W/1", date="new", content_type="no")),
            ("r2", "revisit", 304, "https://x.org/p?a=1&b=2", "2024-01-03 12:00:00", "d1", h()),
            ("r3", "revisit", 304, "https://x.org/p?a=1&b=2", "2024-01-01 00:00:00", "d1", h()),
            ("r4", "revisit", 304, None, "2024-01-05 00:00:00", None, None),
            ("r5", "revisit", 304, "https://x.org/p?a=1&b=2", "2024-01-05 00:00:00", None, h(server="s"))]
    d = spark.createDataFrame(rows, "record_id string, record_type string, status int, url string, date string, "
                                    "digest string, headers array<struct<name:string,value:string>>").withColumn(
        "date", F.col("date").cast("timestamp"))
    got = {r.record_id: r for r in warc_revisit.resolve_revisits(d).collect()}
    assert {k: (r.resolution, r.response_id) for k, r in got.items()} == {
        "r1": ("resolved", "a"), "r2": ("validator_mismatch", "b"), "r3": ("no_earlier_response", None),
        "r4": ("no_earlier_response", None), "r5": ("no_validator", "b")}
    assert {x["name"]: x["value"] for x in got["r1"].headers} == {"etag": "W/1", "content-type": "t", "date": "new"}
    assert warc_revisit.resolve_revisits(d.limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
    q = duckdb.connect().execute(f"SELECT count(*) FROM '{SF_SMALL}/documents.parquet'").fetchone()[0]
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert rows and len({r.doc_id for r in rows}) <= q
