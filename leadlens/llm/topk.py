"""Exact top-k inner products (operator 7).

* Vectors are turned into whole numbers; an orthogonal rotation (from the singular vectors
  of all vectors, by their d x d matrix of inner products) puts most of the length into
  the first coordinates.
* Candidates are sorted by length into bands and processed in descending length.  Each
  query starts with the k-th best score among the longest ``HEAD`` vectors as its bar.
* A band is skipped for a block of queries if |q| |c| is below every bar; inside a block
  the partial sums of the first coordinates plus the Cauchy-Schwarz bound of the rest
  sort out candidates, and only the others get their exact score from the whole numbers.

Queries and candidates meet in blocks (``QUERIES_PER_BLOCK`` x ``ROWS_PER_BLOCK``).  A
band's rows are dealt to blocks by a hash, so equal vectors or lengths share no single
task.  What is collected has a fixed size: the d x d matrix, ``HEAD`` vectors and
``BANDS`` lengths.

Cases: vectors that are null, empty or hold null or non-finite components, and rows with
a null id, take no part; a shorter vector counts as zero beyond its end; rows with the
query's own id are its own; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlens.llm.common import blocks_for, saved, table

K = 5
SCALE = 256
HEAD = 2048
BANDS = 64
QUERIES_PER_BLOCK = 512
ROWS_PER_BLOCK = 4096
CHUNK = 512


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(id, v array<long>, len2 double) of the vectors that take part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.filter(F.col(vec_id).isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))
            .select(F.col(vec_id).cast("long").alias("id"),
                    F.transform(v, lambda x: F.floor(scale * x.cast("double"))).alias("v"))
            .withColumn("len2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))


def _matrix(vectors, dim: int) -> np.ndarray:
    m = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        m[i, :len(v)] = v
    return m


def _rotation(vectors: DataFrame, dim: int) -> np.ndarray:
    """Columns: directions by falling share of the total squared length."""
    def part(batches):
        total = np.zeros((dim, dim))
        for pdf in batches:
            m = _matrix(pdf.v.to_numpy(), dim)
            total += m.T @ m
        yield pd.DataFrame({"cell": np.arange(dim * dim), "x": total.ravel()})

    cells = vectors.select("v").mapInPandas(part, "cell int, x double").groupBy("cell").agg(F.sum("x").alias("x"))
    gram = np.zeros(dim * dim)
    for r in cells.collect():
        gram[r.cell] = r.x
    values, directions = np.linalg.eigh(gram.reshape(dim, dim))
    return directions[:, np.argsort(values)[::-1]]


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whole inner products; in floating point where it is exact."""
    if q.size and c.size and np.abs(q).max() * np.abs(c).max() * q.shape[1] < 2.0 ** 53:
        return q @ c.T
    return q.astype(object).dot(c.astype(object).T)


def _block_search(q_ids, q, bar, c_ids, c, rotation, k, chunk=CHUNK):
    """Candidates of one block that can be among a query's best k: (query, id, score)."""
    order = np.lexsort((c_ids, -np.einsum("ij,ij->i", c, c)))
    c_ids, c = c_ids[order], c[order]
    split = max(1, rotation.shape[1] // 4)
    rq, rc = q @ rotation, c @ rotation
    q_rest = np.sqrt(np.einsum("ij,ij->i", rq[:, split:], rq[:, split:]))
    c_rest = np.sqrt(np.einsum("ij,ij->i", rc[:, split:], rc[:, split:]))
    q_len, c_len = np.sqrt(np.einsum("ij,ij->i", q, q)), np.sqrt(np.einsum("ij,ij->i", c, c))
    bar, best = bar.astype(float).copy(), [[] for _ in q_ids]
    for at in range(0, len(c), chunk):
        part = slice(at, at + chunk)
        slack = 1e-9 * (1 + q_len * c_len[at])  # of the rotation's rounding
        live = np.flatnonzero(q_len * c_len[at] + slack >= bar)
        if not len(live):
            break  # lengths only fall from here
        bound = rq[live, :split] @ rc[part, :split].T + np.outer(q_rest[live], c_rest[part]) + slack[live, None]
        can = (bound >= bar[live, None]) & (c_ids[part][None, :] != q_ids[live][:, None])
        cols = np.flatnonzero(can.any(axis=0))
        if not len(cols):
            continue
        score = _exact(q[live], c[part][cols])
        for i, k_q in enumerate(live):
            hit = np.flatnonzero(can[i, cols] & (score[i] >= bar[k_q]))
            if len(hit):
                own = best[k_q] + [(-int(score[i, j]), int(c_ids[part][cols[j]])) for j in hit]
                best[k_q] = sorted(own)[:k]
                if len(best[k_q]) == k:
                    bar[k_q] = max(bar[k_q], -best[k_q][-1][0])
    return [(int(q_ids[i]), c_id, -s) for i, found in enumerate(best) for s, c_id in found]


def top_k(rows: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = K,
          scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best rows but its own.

    ``is_query`` is a condition on the column ``id`` (the row's id as a long).
    """
    spark = rows.sparkSession
    vectors = saved(whole_vectors(rows, vec_id, vector, scale))
    queries = vectors.filter(F.coalesce(is_query, F.lit(False)))
    facts = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"),
                        F.percentile_approx("len2", [i / BANDS for i in range(1, BANDS)], 1000).alias("cuts")).first()
    schema = "query_id long, vec_id long, score long"
    if not facts.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim, cuts = facts.dim, sorted(set(facts.cuts))
    rotation = _rotation(vectors, dim)
    head = vectors.orderBy(F.col("len2").desc(), "id").limit(HEAD).collect()
    head_ids, head_v = np.array([r.id for r in head]), _matrix([r.v for r in head], dim)

    def bars(batches):
        for pdf in batches:
            q = _matrix(pdf.v.to_numpy(), dim)
            score = _exact(q, head_v).astype(float)
            score[pdf.id.to_numpy()[:, None] == head_ids[None, :]] = -np.inf
            short = np.full((len(q), max(0, k - len(head_ids))), -np.inf)
            bar = np.sort(np.hstack([score, short]), axis=1)[:, -k]
            yield pdf.assign(bar=bar)

    n_queries = queries.count()
    q_blocks = blocks_for(n_queries, QUERIES_PER_BLOCK)
    q_rows = saved(queries.select("id", "v", "len2").mapInPandas(bars, "id long, v array<long>, len2 double, bar double")
                   .withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(q_blocks)).cast("int")))
    per_band = blocks_for(blocks_for(facts.n, len(cuts) + 1), ROWS_PER_BLOCK)
    band = sum((F.col("len2") > c).cast("int") for c in cuts) if cuts else F.lit(0)
    c_rows = vectors.select("id", "v", "len2", (band * per_band + F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(per_band)))
                            .cast("int").alias("cb"))
    # which blocks can meet: the longest candidate against the lowest bar of the query block
    need = q_rows.groupBy("qb").agg(F.min(F.when(F.col("bar") <= 0, 0.0).otherwise(
        F.col("bar") / F.sqrt(F.greatest("len2", F.lit(1e-300))))).alias("need"),
        F.max(F.col("bar") < 0).alias("any"))
    reach = c_rows.groupBy("cb").agg(F.sqrt(F.max("len2")).alias("reach"))
    pairs = (reach.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).join(need, "qb")
             .filter(F.col("any") | (F.col("reach") * (1 + 1e-9) >= F.col("need")))
             .select(F.col("qb").alias("pq"), F.col("cb").alias("pc")))
    left = q_rows.join(pairs, F.col("qb") == F.col("pq")).select("pq", "pc", "id", "v", "bar")
    right = c_rows.join(pairs, F.col("cb") == F.col("pc")).select(F.col("pq").alias("rq"), F.col("pc").alias("rc"), "id", "v")

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        found = _block_search(q.id.to_numpy(), _matrix(q.v.to_numpy(), dim), q.bar.to_numpy(),
                              c.id.to_numpy(), _matrix(c.v.to_numpy(), dim), rotation, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = left.groupBy("pq", "pc").cogroup(right.groupBy("rq", "rc")).applyInPandas(search, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 50 == 0)


QUERIES = {"op7_topk": op7_topk}

ORACLE = {"op7_topk": f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}"""}
