"""N-gram Jaccard join and its components (operator 3).

A document's set holds the hashes of its distinct word n-grams.  Two documents link when
the overlap of their sets is at least ``PERCENT`` of their union.  Equal sets are one class,
so copies never multiply.  Between classes, every link is found:

* order: hashes are ordered by their frequency, the rare ones first; the frequent ones and
  their counts come from summaries of bounded size that the tasks make of all documents.
  Any order finds all links, a good one makes small tiles.  Sets that link share l of their
  first n - ceil(0.85 n) + l hashes (l is 1 for small sets and grows to ``MOST_SHARED``);
* tiles: classes that share such a hash form a tile, cut into size bands by the rule that
  linked sets differ in size by that percentage at most; of a pair in a tile, the places of
  the common hash in both orders bound the overlap too;
* bitmaps: each set has a signature of hashed bits, a few per n-gram.  Bits that differ between two
  signatures bound the overlap from above; pairs below the needed overlap fall out;
  inside tiles ``TILE_BITS`` parities do the same, which hold in large sets too;
* what is left is decided by the exact intersection of the sorted arrays.

Links are only needed between classes that are not connected yet.  A first round holds each
class against a few members of some of its tiles (stars, linear in the tile) and keeps the
most promising pairs; the verified links give components.  The second round looks at all
tiles that still hold several components, and there only at pairs across components, on one
side the members outside the tile's largest component.  So a group of copies of any size
costs a star and not its square, and no link between components can be missed.

Cases: a null or empty text has an empty set and is its own component; fewer words than n
are one n-gram; repeated rows are rows of their own; documents with a null id take part,
but a component's name is its smallest non-null id; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.llm.common import components, table, written

N = 4
PERCENT = 85
TILE_BITS = 512
SUMMARY = 1 << 18
FREQUENT = 1 << 20
MARK_BITS = 23
STARS = 4
HEADS = 3
MOST_SHARED = 8
KEPT_HEADS = 3
RUN_CHARS = 500_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _MIX[0])
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (ASCII capitals lowered, between ASCII white space), and words per text."""
    raw = [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]
    flat = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    white = _WHITE[flat]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], white]).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(raw), dtype=np.int64)
    size = end - begin
    stop = np.cumsum([len(r) + 1 for r in raw])
    per_text = np.diff(np.concatenate([[0], np.searchsorted(begin, stop)]))
    with np.errstate(over="ignore"):
        power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(int(size.max()), _MIX[0]))])
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        sums = np.add.reduceat(_BYTE[flat[~white]] * power[place], np.cumsum(size) - size)
        return _mixed(sums + size.astype(np.uint64) * _MIX[1]), per_text


def ngram_sets(texts, n: int = N):
    """Sorted distinct n-gram hashes of each text, worked out in runs of whole texts."""
    run, held = [], 0
    for t in texts:
        run.append(t)
        held += len(t or "")
        if held > RUN_CHARS:
            yield from _run_sets(run, n)
            run, held = [], 0
    yield from _run_sets(run, n)


def _run_sets(texts, n: int) -> list[np.ndarray]:
    flat, per_text = word_hashes(texts)
    out, at = [], 0
    with np.errstate(over="ignore"):
        grams = np.zeros(max(0, len(flat) - n + 1), dtype=np.uint64)
        for k in range(n):
            grams = _mixed(grams * _MIX[0] + flat[k:k + len(grams)] + np.uint64(k + 1))
        for size in per_text.tolist():
            if size >= n:
                out.append(np.unique(grams[at:at + size - n + 1]))
            elif size:
                x = np.zeros(1, dtype=np.uint64)
                for k in range(size):
                    x = _mixed(x * _MIX[0] + flat[at + k] + np.uint64(k + 1))
                out.append(_mixed(x + np.uint64(1000 + size)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            at += size
    return out


def needed_shared(size: int) -> int:
    """Hashes that linked sets have in common in their prefixes, by the smaller set."""
    return min(MOST_SHARED, max(1, size // 20))


def needed_prefix(size: int, percent: int = PERCENT) -> int:
    """Linked sets overlap in ceil(percent of either) or more: prefixes this long share
    ``needed_shared`` hashes at least."""
    return min(size, size - -(-percent * size // 100) + needed_shared(size))


def _signature(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed bitmap as longs: a power of two of bits, four to eight per hash and at least
    4 ``TILE_BITS``; and ``TILE_BITS`` parities, of the number of hashes at each place: a hash
    that one set has and the other has not turns one of them, so they do not fill up in large sets."""
    bits = max(4 * TILE_BITS, 1 << (4 * len(grams) - 1).bit_length())
    at = (grams >> np.uint64(20)).astype(np.int64)
    set_ = np.zeros(bits, dtype=bool)
    set_[at & (bits - 1)] = True
    odd = np.bincount(at & (TILE_BITS - 1), minlength=TILE_BITS) & 1
    return tuple(np.packbits(x.astype(bool), bitorder="little").view(np.int64) for x in (set_, odd))


def _class_hash(grams: np.ndarray) -> tuple[int, int]:
    """Two sums over the set: equal sets, equal numbers."""
    with np.errstate(over="ignore"):
        a, b = _mixed(grams + _MIX[0]).sum(dtype=np.uint64), _mixed(grams ^ _MIX[1]).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def _frequent(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams, sorted, and the level (whole log2 of its count) of each.

    Every task keeps a summary of the n-grams of all its different sets: beyond ``SUMMARY``
    entries the count of the first one left out is taken from all (Misra-Gries), so what is
    much more frequent than the rest stays.  Summaries add up; of the sums the levels
    that hold ``FREQUENT`` n-grams or fewer are kept.
    """
    def summaries(batches):
        keys, counts, held, size, seen = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0, set()

        def packed():
            both, at = np.unique(np.concatenate([keys, *held]), return_inverse=True)
            total = np.bincount(at, np.concatenate([counts, np.ones(len(at) - len(keys), np.int64)])).astype(np.int64)
            if len(both) > SUMMARY:
                total = total - np.partition(total, -SUMMARY - 1)[-SUMMARY - 1]
            return both[total > 0], total[total > 0]

        for pdf in batches:
            for g in ngram_sets(pdf.text, n):
                h = _class_hash(g)
                if h not in seen:
                    seen.add(h)
                    held.append(g)
                    size += len(g)
                if size > 4 * SUMMARY:
                    (keys, counts), held, size = packed(), [], 0
        keys, counts = packed()
        keep = counts > 1
        yield pd.DataFrame({"gram": keys[keep].view(np.int64), "n": counts[keep]})

    sums = written(docs.select("text").mapInPandas(summaries, "gram long, n long").groupBy("gram")
                   .agg(F.floor(F.log2(F.sum("n"))).cast("int").alias("level")), "frequent")
    least, room = 64, FREQUENT
    for r in sorted(sums.groupBy("level").count().collect(), key=lambda r: -r.level):
        room -= r["count"]
        if room < 0:
            break
        least = r.level
    top = sums.filter(F.col("level") >= least).toPandas()  # FREQUENT rows at most
    grams = top.gram.to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], top.level.to_numpy(dtype=np.uint8)[order]


_SETS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()), T.StructField("n", T.LongType()), T.StructField("h1", T.LongType()),
    T.StructField("h2", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType())),
    T.StructField("bits", T.ArrayType(T.LongType())), T.StructField("fold", T.ArrayType(T.LongType()))])


def _set_rows(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], n: int, percent: int) -> DataFrame:
    """A row per document: set size, class hashes, and for the first of each class in a task
    its first hashes in the order and its signature (null for later copies)."""
    holder = docs.sparkSession.sparkContext.broadcast(frequent)  # nine bytes for each of FREQUENT n-grams

    def run(batches):
        (often, level), seen = holder.value, set()
        often, level = np.append(often, np.uint64(2 ** 64 - 1)), np.append(level, np.uint8(0))
        for pdf in batches:
            rows = []
            for g in ngram_sets(pdf.text, n):
                h = _class_hash(g)
                if h in seen or not len(g):
                    rows.append((len(g), *h, None, None, None))
                    continue
                seen.add(h)
                at = np.minimum(np.searchsorted(often, g), len(often) - 1)
                order = np.argsort(np.where(often[at] == g, level[at], 0), kind="stable")
                prefix = g[order[:needed_prefix(len(g), percent)]] if len(g) > 1 else g[:0]
                rows.append((len(g), *h, prefix.astype(np.int64), *_signature(g)))
            out = pd.DataFrame(rows, columns=["n", "h1", "h2", "prefix", "bits", "fold"])
            out.insert(0, "doc_id", pdf.doc_id.astype("Int64"))
            out.insert(1, "row", pdf.row.astype("Int64"))
            yield out

    return docs.select("doc_id", "row", "text").mapInPandas(run, _SETS)


def _tile_bound(a: str, b: str, words: int):
    """Upper bound of the overlap from sizes and differing parities."""
    x, y = F.col(f"{a}.fold"), F.col(f"{b}.fold")
    differ = sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(words)), F.lit(0))
    return F.floor((F.col(f"{a}.n") + F.col(f"{b}.n") - differ) / 2)


def _place_bound(a: str, b: str):
    """Upper bound of the overlap from the places of a common hash: what comes before it in
    either set, itself, and what comes after it in either set."""
    left = F.least(f"{a}.place", f"{b}.place") + 1
    return left + F.least(F.col(f"{a}.n") - F.col(f"{a}.place"), F.col(f"{b}.n") - F.col(f"{b}.place")) - 1


def _halved(bits, other):
    """The signature folded once if it is longer than the other (sizes differ less than twofold)."""
    half = (F.size(bits) / 2).cast("int")
    return F.when(F.size(bits) > F.size(other), F.zip_with(
        F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda p, q: p.bitwiseOR(q))).otherwise(bits)


def _bound(a: str, b: str):
    """The same bound from the whole signatures."""
    x, y = F.col(f"{a}.bits"), F.col(f"{b}.bits")
    differ = F.aggregate(F.zip_with(_halved(x, y), _halved(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
                         F.lit(0), lambda s, c: s + c)
    return F.floor((F.col(f"{a}.n") + F.col(f"{b}.n") - differ) / 2)


def _links(a: str, b: str, overlap, percent: int):
    """100 * overlap >= percent * union."""
    return 100 * overlap >= percent * (F.col(f"{a}.n") + F.col(f"{b}.n") - overlap)


def _marks(ids: DataFrame) -> np.ndarray:
    """A bit field of fixed size with the cells of ``doc_id`` set."""
    cell = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - MARK_BITS)
    words = ids.groupBy(F.shiftright(cell, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(doc_id), {64 - MARK_BITS}) & 63 as int))"))
        .alias("b"))
    field = np.zeros(1 << (MARK_BITS - 6), dtype=np.int64)
    for r in words.toLocalIterator():
        field[r.w] = r.b
    return np.unpackbits(field.view(np.uint8), bitorder="little").astype(bool)


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """The (a, b) pairs that link, by the exact intersection of their arrays.

    The arrays are worked out again for the documents in question.  A bit field of fixed
    size sorts out most others while scanning, so no text is shuffled; the join decides.
    """
    wanted = pairs.select(F.col("a").alias("rid")).union(pairs.select("b")).distinct()
    chosen = written(classes.select("rid", "doc_id", "h1", "h2").join(wanted, "rid"), "chosen")
    marks = docs.sparkSession.sparkContext.broadcast(np.packbits(_marks(chosen.select("doc_id"))))

    def arrays(batches):
        field = np.unpackbits(marks.value).astype(bool)
        for pdf in batches:
            pdf = pdf[field[pdf.cell.to_numpy()]]
            if len(pdf):
                yield pd.DataFrame([(*_class_hash(g), g.astype(np.int64)) for g in ngram_sets(pdf.text, n)],
                                   columns=["g1", "g2", "grams"]).assign(id=pdf.doc_id.astype("Int64").array)[
                    ["id", "g1", "g2", "grams"]]

    cell = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - MARK_BITS)
    sides = (pairs.select(F.col("a").alias("rid"), "a", "b", F.lit(True).alias("left"))
             .union(pairs.select("b", "a", "b", F.lit(False)))
             .join(chosen.select("rid", "doc_id", "h1", "h2"), "rid").drop("rid"))
    sets = docs.select("doc_id", cell.alias("cell"), "text").mapInPandas(
        arrays, "id long, g1 long, g2 long, grams array<long>")
    met = sides.join(sets, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h1") == F.col("g1"))
                     & (F.col("h2") == F.col("g2")))
    # two rows a pair, and a few more where a row is repeated
    both = met.groupBy("a", "b").agg(F.max(F.when(F.col("left"), F.col("grams"))).alias("ga"),
                                     F.max(F.when(~F.col("left"), F.col("grams"))).alias("gb"))

    @F.pandas_udf(T.LongType())
    def overlap(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(p, q, assume_unique=True)) for p, q in zip(x, y)], dtype="int64")

    size = F.size("ga") + F.size("gb")
    return (both.select("a", "b", size.alias("size"), overlap("ga", "gb").alias("o"))
            .filter(100 * F.col("o") >= percent * (F.col("size") - F.col("o"))).select("a", "b"))


def _narrowed(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b, share): the pairs that the whole signatures leave open."""
    slim = classes.select("rid", "n", "bits")
    return (pairs.join(slim.alias("x"), F.col("a") == F.col("x.rid")).join(slim.alias("y"), F.col("b") == F.col("y.rid"))
            .withColumn("bound", _bound("x", "y")).filter(_links("x", "y", F.col("bound"), percent))
            .select("a", "b", (F.col("bound") / (F.col("x.n") + F.col("y.n"))).alias("share")))


def _tile_narrowed(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs that the parities leave open."""
    slim = classes.select("rid", "n", "fold")
    return (pairs.join(slim.alias("x"), F.col("a") == F.col("x.rid")).join(slim.alias("y"), F.col("b") == F.col("y.rid"))
            .filter(_links("x", "y", _tile_bound("x", "y", TILE_BITS // 64), percent)).select("a", "b"))


def _members(d: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, row, n, comp (null without words); one row per row of ``d`` (doc_id, row, text)."""
    rows = written(_set_rows(d, _frequent(d, n), n, percent).withColumn("rid", F.monotonically_increasing_id()), "rows")
    classes = rows.filter(F.col("prefix").isNotNull())
    # equal sets of different tasks
    first = classes.groupBy("h1", "h2", "n").agg(F.min("rid").alias("b"), F.max("rid").alias("hi")).filter("b < hi")
    equal = written(classes.select("h1", "h2", "n", F.col("rid").alias("a")).join(first, ["h1", "h2", "n"])
                    .filter("a > b").select("a", "b"), "equal")

    # tiles: hashes that several classes have in their prefixes, with the place in the order.
    # A member stays if there is another one: the second row of the hash is one at the latest.
    # The sums name the columns of both sides, in the table's order, so both read one exchange
    member = classes.select("n", "rid", F.posexplode("prefix").alias("place", "gram"))
    other = ((F.col("x.gram") == F.col("y.gram")) & (F.col("x.rid") != F.col("y.rid"))
             & (F.col("x.n") + F.col("y.n") > 0) & (F.col("x.place") + F.col("y.place") >= 0))
    tiles = written(member.alias("x").join(member.alias("y"), other, "left_semi"), "tiles")

    # round 1: stars
    draws = [F.xxhash64("rid", F.lit(k)) for k in range(HEADS)]
    heads = (tiles.groupBy("gram").agg(*[F.min_by(c, draw).alias(f"{c}{k}") for k, draw in enumerate(draws)
                                         for c in ("rid", "n", "place")])
             .select("gram", F.explode(F.array_distinct(F.array(*[
                 F.struct(F.col(f"rid{k}").alias("b"), F.col(f"n{k}").alias("n"), F.col(f"place{k}").alias("place"))
                 for k in range(HEADS)]))).alias("h")))
    nth = F.row_number().over(Window.partitionBy("rid").orderBy(F.xxhash64("gram"), "gram"))
    star = (tiles.withColumn("nth", nth).filter(F.col("nth") <= STARS).join(heads, "gram")
            .select("rid", "h", F.struct("n", "place").alias("m"))
            .filter((F.col("rid") != F.col("h.b")) & _links("m", "h", _place_bound("m", "h"), percent))
            .select(F.col("rid").alias("a"), F.col("h.b").alias("b")).distinct())
    star = _tile_narrowed(star, classes, percent)
    # a member has STARS x HEADS heads at most and keeps the most promising ones
    best = (_narrowed(star, classes, percent).groupBy("a")
            .agg(F.sort_array(F.collect_list(F.struct("share", "b")), asc=False).alias("h"))
            .select("a", F.explode(F.slice("h", 1, KEPT_HEADS)).alias("h"))
            .select(F.least("a", "h.b").alias("a"), F.greatest("a", "h.b").alias("b")).distinct())
    links = written(_verified(written(best, "stars"), d, classes, n, percent).unionByName(equal), "links")

    # round 2: pairs across components in tiles that hold several
    comp = written(components(links), "comp")
    member = tiles.drop("n").join(comp.withColumnRenamed("node", "rid"), "rid", "left").withColumn(
        "comp", F.coalesce("comp", "rid"))
    counts = member.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("c"))
    major = (counts.groupBy("gram").agg(F.max_by("comp", "c").alias("major"), F.min("comp").alias("lo"),
                                        F.max("comp").alias("hi")).filter("lo < hi").select("gram", "major"))
    slim = classes.select("rid", "n", "fold")
    full = written(member.join(major, "gram").join(slim, "rid"), "mixed")
    x, y = full.filter("comp != major").alias("x"), full.alias("y")
    across = (x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.comp") != F.col("y.comp"))
                     & ((F.col("y.comp") == F.col("y.major")) | (F.col("x.rid") < F.col("y.rid")))
                     & _links("x", "y", _place_bound("x", "y"), percent)
                     & _links("x", "y", _tile_bound("x", "y", TILE_BITS // 64), percent))
              .groupBy(F.least("x.rid", "y.rid").alias("a"), F.greatest("x.rid", "y.rid").alias("b"))
              .agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("x.n", "y.n")).alias("n"))
              # each common tile of a pair across components counts once
              .filter(F.col("shared") >= F.least(F.lit(MOST_SHARED), F.greatest(F.lit(1), F.floor(F.col("n") / 20))))
              .select("a", "b"))
    across = written(_narrowed(across, classes, percent).select("a", "b"), "across")
    more = _verified(across, d, classes, n, percent)
    comp = components(links.unionByName(more))

    # back to documents: a class's component
    named = (classes.select("h1", "h2", "n", "rid").join(comp.withColumnRenamed("node", "rid"), "rid", "left")
             .groupBy("h1", "h2", "n").agg(F.min(F.coalesce("comp", "rid")).alias("comp")))
    return written(rows.select("doc_id", "row", "n", "h1", "h2").join(named, ["h1", "h2", "n"], "left")
                   .select("doc_id", "row", "n", "comp"), "members")


def jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = N,
                       percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id; one row per row of ``docs``."""
    member = _members(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("row"),
                                  F.col(text).alias("text")), n, percent)
    # the smallest id of each component
    smallest = member.filter("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return member.join(smallest, "comp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame) -> DataFrame:
    """Pipeline stage: of each component one row stays, the one with the smallest id (a null id
    comes last; rows of one id go by a hash of the row, and of equal rows one stays); documents
    without words stay."""
    hashed = [F.col(f.name) for f in docs.schema if "map<" not in f.dataType.simpleString()]
    marked = docs.withColumn("_row", F.xxhash64(*hashed))
    member = _members(marked.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_row").alias("row"), "text"),
                      N, PERCENT)
    first = (member.filter("n > 0").groupBy("comp", "doc_id", "row").agg(F.count(F.lit(1)).alias("copies"))
             .groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row", "copies")).alias("k"))
             .select("k.doc_id", "k.row", "k.copies"))
    blank = member.filter("n = 0").select("doc_id", "row", F.lit(1).cast("long").alias("copies")).distinct()
    keep = written(first.unionByName(blank).withColumnsRenamed({"doc_id": "_id", "row": "_key"}), "first")

    def kept(copies: str) -> DataFrame:
        return marked.join(keep.filter(copies), F.col("doc_id").eqNullSafe(F.col("_id"))
                           & (F.col("_row") == F.col("_key")), "left_semi")

    out, equal = kept("copies = 1").drop("_row"), "copies > 1"
    if keep.filter(equal).isEmpty():
        return out
    one = kept(equal).groupBy("doc_id", "_row").agg(F.first(F.struct(*docs.columns)).alias("r"))
    return out.unionByName(one.select("r.*"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op3_ngram_join": op3_ngram_join}
