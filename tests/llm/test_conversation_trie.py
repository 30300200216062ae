"""Operator 11 against a trie built in memory: segments, partitions, hot prefixes, odd rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from leadlens.llm.common import table
from leadlens.llm.conversation_trie import conversation_trie, op11_conversation_trie, rebuilt, turns_of
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, pos int, unit string, n int"


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            unit = hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest()
            own[c].append((t is not None, t or 0, unit, (r, x)))
    own = {c: [x for *_, x in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(c - c % 20, [])[:h] + v[h:])
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * words
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def answer(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def trie(spark, rows, **options):
    d = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    return conversation_trie(*rebuilt(turns_of(d)), **options)


def conversations(n, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 400), n):
        if c % 3 == 0:  # a group of copies
            rows += [(c, t, "user", f"hot turn {t}") for t in range(rng.choice([5, 5, 5, 7, 9]))]
        else:
            rows += [(c, t, rng.choice(["user", "bot"]), rng.choice(["a b", "a", "", None, "c  d e"]))
                     for t in range(rng.choice([1, 2, 6, 12]))]
    return rows


ODD = [(500, None, None, None), (500, None, "u", "a"), (500, 3, "u", "b c"), (500, 3, "u", "b c"), (500, 3, "t", "b"),
       (None, 1, "u", "lost"), (None, None, None, None), (501, 1, "u", "x" * 100_000), (502, -5, "ub", "c"),
       (502, -5, "u", "bc"), (520, 1, "u", "only"), (521, 7, "u", "short"), (-7, 2, None, "é\x00")]


@pytest.mark.parametrize("segment", [128, 4, 1])
def test_against_brute_force(spark, segment):
    rows = conversations(90, segment) + ODD
    got = trie(spark, rows, segment=segment)
    assert answer(got) == brute(rows)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]


def test_many_partitions_share_a_prefix(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = [(c, t, "u", f"same {t}" if t < 4 else f"own {c % 50}") for c in range(200) for t in range(6)]
        rows += conversations(60, 9)
        rows = [(c if i < 1200 else c + 1000, t, r, x) for i, (c, t, r, x) in enumerate(rows)]
        assert answer(trie(spark, rows)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_table_and_query(spark):
    assert trie(spark, []).collect() == []
    assert trie(spark, [(None, 1, "u", "x")]).collect() == []
    d = table(spark, SF_SMALL, "conversations")
    assert answer(op11_conversation_trie(spark, SF_SMALL)) == brute(
        [(r.conv_id, r.turn, r.role, r.text) for r in d.collect()])
