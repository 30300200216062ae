"""Mixing sources to target weights by the cube method (operator 5).

A source's target is its weighted share of all words, at most ``MAX_REPEAT`` times its own
words; what that cuts off is shared again by weight.  Every document of a source is due
target / words copies: the whole part is sure, the fraction is its inclusion probability.
The cube method turns the fractions into 0 or 1:

* flight: three open units at a time, their probabilities move along the null space of
  the two constraints (documents and words stay in balance) until one hits 0 or 1;
* a block of units ends with at most two open ones.  They go to the next level, where
  blocks of leftovers are joined, until a source has one block;
* landing: ``HELD_BACK`` units of that block stay out of the flight; they and the last two
  are rounded together so that the words come nearest to the target.

Blocks are dealt by a hash, so a source with a third of all rows is many blocks.  The
levels are known from the row counts beforehand; each one is cut off by a checkpoint.
Only the table of sources is collected; its bound ``MAX_SOURCES`` is checked.

Cases: a null text has size 0; a null source is a source of its own, the last; rows equal
in doc_id, source and size are one unit (they get the same copies, so a document never
exceeds its share); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm.common import blocks_for, saved, space_words, table

#: weights of the sources in their order, repeating
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
BLOCK = 4096
MAX_SOURCES = 100_000
HELD_BACK = 10
SEED = 17
EPS = 1e-9


def targets(words: list[int], weights: list[float], cap: float = MAX_REPEAT) -> list[float]:
    """Shares of all words by weight; none above ``cap`` times its own, the excess shared again."""
    out, open_, left = [0.0] * len(words), set(range(len(words))), float(sum(words))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit >= cap * words[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in sorted(full):
            out[i] = float(cap * words[i])
            left -= out[i]
            open_.discard(i)
    return out


def _step(p: list[float], a: list[float], b: list[float], draw: random.Random) -> None:
    """Move open probabilities along a vector on which sums of a and of b do not change."""
    if len(p) == 3:
        u = [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
        if max(map(abs, u)) < EPS:  # proportional units: one pair will do
            u = [a[1], -a[0], 0.0]
    else:
        u = [a[1], -a[0]]
    size = max(map(abs, u))
    u = [x / size for x in u]
    up = min((1 - p[i]) / x if x > 0 else -p[i] / x for i, x in enumerate(u) if x)
    down = min(p[i] / x if x > 0 else (p[i] - 1) / x for i, x in enumerate(u) if x)
    t = up if draw.random() * (up + down) < down else -down
    for i, x in enumerate(u):
        v = p[i] + t * x
        p[i] = 0.0 if v < EPS else 1.0 if v > 1 - EPS else v


def flight(p: list[float], count: list[float], words: list[float], draw: random.Random) -> list[float]:
    """Flight phase: afterwards at most two probabilities are neither 0 nor 1."""
    p, held = list(p), []
    for k in [i for i, x in enumerate(p) if EPS < x < 1 - EPS]:
        held.append(k)
        while len(held) == 3:
            q = [p[i] for i in held]
            _step(q, [count[i] for i in held], [words[i] for i in held], draw)
            for i, x in zip(held, q):
                p[i] = x
            held = [i for i in held if 0 < p[i] < 1]
    if len(held) == 2 and count[held[0]] * words[held[1]] == count[held[1]] * words[held[0]]:
        q = [p[i] for i in held]  # proportional units can still move
        _step(q, [count[i] for i in held], [words[i] for i in held], draw)
        p[held[0]], p[held[1]] = q
    return p


def landing(p: list[float], words: list[float]) -> list[float]:
    """Round the open units so that the words change least; of equal choices, the one with
    the number of units nearest to the sum of probabilities."""
    held = [i for i, x in enumerate(p) if 0 < x < 1]
    if not held:
        return p
    chance, size = np.array([p[i] for i in held]), np.array([words[i] for i in held])
    choice = (np.arange(1 << len(held))[:, None] >> np.arange(len(held))) & 1
    off = np.abs(choice @ size - chance @ size)
    best = np.lexsort((np.abs(choice.sum(axis=1) - chance.sum()), off))[0]
    p = list(p)
    for j, i in enumerate(held):
        p[i] = float(choice[best, j])
    return p


def source_table(sizes: DataFrame, weights=WEIGHTS, cap: float = MAX_REPEAT, block: int = BLOCK):
    """Rows (source, ord, source_size, target, blocks of each level), from (source, size) rows."""
    stats = (sizes.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect())
    if len(stats) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    due = targets([r.words for r in stats], [weights[i % len(weights)] for i in range(len(stats))], cap)
    out = []
    for i, (r, t) in enumerate(zip(stats, due)):
        levels = [blocks_for(r.n, block)]
        while levels[-1] > 1:
            levels.append(blocks_for(2 * levels[-1], block))
        out.append((r.source, i, r.words, t, levels))
    return out


def _level(level: int, seed: int, cols: list[str]):
    """One level of the flight for a block; a source's last level lands."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "doc_id", "size", "n_rows"], ignore_index=True)
        first = pdf.iloc[0]
        draw = random.Random(f"{seed}/{level}/{first.ord}/{first.block}")
        n, w = pdf.n_rows.astype(float).tolist(), (pdf.n_rows * pdf["size"]).astype(float).tolist()
        last, p = level >= first.levels - 1, pdf.p.tolist()
        held = set([i for i, x in enumerate(p) if 0 < x < 1][-HELD_BACK:] if last else [])
        flown = flight([0.0 if i in held else x for i, x in enumerate(p)], n, w, draw)
        for i in held:
            flown[i] = p[i]
        return pdf.assign(p=landing(flown, w) if last else flown)[cols]

    return run


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weights=WEIGHTS, cap: int = MAX_REPEAT, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Copies per unit: doc_id, source, size, n_rows, source_size, target, copies."""
    spark = docs.sparkSession
    units = (docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                         F.size(space_words(F.col(text))).cast("long").alias("size"))
             .groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n_rows")))
    units = saved(units)
    plan = source_table(units.select("source", (F.col("size") * F.col("n_rows")).alias("size")), weights, cap, block)
    depth = max([len(x[4]) for x in plan], default=0)
    sources = spark.createDataFrame(
        [(s, i, w, t, lv + [1] * (depth - len(lv)), len(lv)) for s, i, w, t, lv in plan],
        "source string, ord int, source_size long, target double, blocks array<int>, levels int")
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u = (units.join(F.broadcast(sources).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
         .withColumn("due", due)
         # a whole number but for rounding counts as whole
         .withColumn("whole", F.floor(F.col("due") + EPS))
         .withColumn("p", F.greatest(F.lit(0.0), F.col("due") - F.col("whole")))
         .withColumn("p", F.when(F.col("p") < EPS, 0.0).otherwise(F.col("p")))
         .drop("_s", "due"))
    cols = u.columns
    open_, done = u, []
    for level in range(depth):
        dealt = open_.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + level), "doc_id", "size"),
                                                 F.get("blocks", F.lit(level))).cast("int"))

        moved = saved(dealt.withColumn("order", F.xxhash64(F.lit(-seed), "doc_id", "size"))
                      .groupBy("ord", "block").applyInPandas(_level(level, seed, cols), u.schema))
        done.append(moved.filter(F.col("p").isin(0.0, 1.0)))
        open_ = moved.filter(~F.col("p").isin(0.0, 1.0))
    for d in done[1:]:
        done[0] = done[0].unionByName(d)
    out = done[0] if done else u
    return out.select("doc_id", "source", "size", "n_rows", "source_size", "target",
                      (F.col("whole") + F.col("p")).cast("int").alias("copies"))


def mixed_docs(docs: DataFrame) -> DataFrame:
    """Pipeline stage: each row as often as the mix takes it, with the columns of ``docs``."""
    plan = mix(docs).select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"),
                            F.col("size").alias("_size"), "copies").filter(F.col("copies") > 0)
    d = docs.withColumn("_words", F.size(space_words(F.col("text"))).cast("long"))
    return (d.join(plan, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
                   & (F.col("_words") == F.col("_size")))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col(c) for c in docs.columns]))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return (m.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                    "copies"))


QUERIES = {"op5_mixing": op5_mixing}
