"""Operator 13: directory, chains, a second batch, and odd rows against brute force."""

import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from leadlens.llm.common import ASCII_LOWER
from leadlens.llm.exact_dedup import build_index, directory_of, exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(ASCII_LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        kept = 0
        for i in ids:
            now = i == top and not kept
            kept += now
            out.append((i, top, len(ids), now, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def answer(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()], key=str)


def docs(n, seed=1):
    rng = random.Random(seed)
    texts = [f"Text {k} " + "xé\x00" * rng.randrange(5) for k in range(n // 3)]
    return [(i, "HOT" if i % 3 == 0 else rng.choice(texts).upper() if i % 5 == 0 else rng.choice(texts))
            for i in range(n)]


ODD = [(1, None), (2, ""), (None, None), (None, "a"), (None, "A"), (None, "a"), (5, "b"), (5, "B"), (5, "b"),
       (7, "É"), (8, "é"), (9, "x" * 300_000), (10, "X" * 300_000), (-3, " "), (-4, " ")]


def test_groups_against_brute_force(spark):
    rows = docs(600) + ODD
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, slot int")
    assert answer(exact_dedup(df)) == brute(rows)
    # 50 keys in all: nearly every bucket chains texts that share a key
    weak = exact_dedup(df, capacity=4, key=lambda t: F.shiftleft(F.pmod(F.xxhash64(t), F.lit(50)), 58))
    assert answer(weak) == brute(rows)
    assert weak.agg(F.max("chain")).first()[0] > 0


def test_directory_doubles_and_covers_every_slot(spark):
    keys = [k << 60 for k in range(-8, 8)] + [(k << 50) for k in range(100)]
    df = spark.createDataFrame([(k,) for k in set(keys)], "key long")
    directory, g = directory_of(df, 10)
    slots = sorted(directory.collect())
    assert g > 4 and [r.slot for r in slots] == list(range(2 ** g))
    held = defaultdict(int)
    for k in set(keys):
        held[slots[(k % 2 ** 64) >> (64 - g)].bucket] += 1
    assert max(held.values()) <= 10
    for r in slots:
        assert len(r.bucket) == r.depth + 1 and format(r.slot, f"0{g}b").startswith(r.bucket[1:])
    # one key cannot be split: the bucket stays at the deepest level and its keys still meet there
    same, g = directory_of(spark.createDataFrame([(1,), (2,), (3,)], "key long"), 2, max_bits=6)
    assert g == 6 and same.count() == 64


def test_second_batch_and_empty_tables(spark):
    rows = docs(300, 2)
    schema = "doc_id long, text string"
    first, _ = build_index(spark.createDataFrame(rows[:200], schema), capacity=16)
    grown = exact_dedup(spark.createDataFrame(rows[200:], schema), before=first, capacity=16)
    new = {i for i, _ in rows[200:]}
    assert answer(grown) == [r for r in brute(rows) if r[0] in new]
    assert first.entries.count() == len({t.translate(ASCII_LOWER) for _, t in rows[:200]})
    assert exact_dedup(spark.createDataFrame([], schema)).collect() == []
