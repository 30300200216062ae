"""LM scoring by a probabilistic suffix tree over words (operator 10).

A context is the one or the two words before a token; before the first word stands the end of
a text.  The tree holds all words with their counts (the base), and of the contexts

* those seen ``MIN_COUNT`` times whose next words diverge from those of the context one word
  shorter: the log likelihood that the context gains on its own training tokens, each left
  out of its own count, passes ``MIN_GAIN``;
* of their next words those seen ``KEEP`` times.

Both are absolute, so the tree grows with the corpus.  A kept context gives a next word
``(c - 1) / n`` and spreads the rest of its mass as the next shorter kept context does, down to
all words, ``(c + 1) / (N + V + 1)``, where all unseen words are one symbol.  Every distribution
sums to one.  A token is scored in the state of its longest kept context.

How it runs: texts become blocks of word codes, a bucketed table of the shared folder; very long texts
go on in the next block, which begins with the two words before.  A block sends the sorted
hashes of its distinct words, pairs, triples or contexts with their sums to the parts that they
hash to, one row a part; a part adds them up and answers in the same order, so a word or pair
that holds a third of the corpus is one entry a block and nothing is collected or broadcast.
Pairs are sent once; triples only behind pairs that can be contexts.

Cases: a null or empty text is only its end; if nothing can be learned the base score is
that of zero counts and no context is kept; repeated rows are scored row by row; a null id
counts as the empty text for the split; extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm.common import blocks_for, crc_mod, shuffles_freed, table, written
from leadlens.session import ensure_checkpoint_dir

MOD, HELD_OUT = 7, 2
#: text bytes of a block, and of a stretch that is split into words at once
BLOCK, STRETCH = 8 << 20, 1 << 20
#: tokens to a part
PER_PART = 500_000
MIN_COUNT, KEEP, MIN_GAIN = 10, 3, 10.0
END = b"\n"
WORD, PAIR, TRIPLE, ONE, TWO = range(5)
#: a context's gain is summed for these back-off shares; the one at or below its own counts
SHARES = np.array([0.0, 0.2, 0.5, 0.8])
#: training tokens, discounted mass, tokens without a count of their own, gains by share, and the
#: fraction of each that is sent as one: whole numbers add up alike in any order
STATS = 3 + len(SHARES)
UNITS = np.array([1, 1 << 26, 1, *[1 << 16] * len(SHARES)])
SENT = "part int, kind int, block long, keys binary, sums binary"
BACK = "block long, kind int, part int, sums binary"

_SPACE = re.compile(rb"[ \t-\r]")
_U = np.uint64


def _pack(a: np.ndarray) -> bytes:
    """A column of numbers, its bytes by place, compressed."""
    planes = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T)
    return len(a).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, dtype) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).reshape(-1).view(dtype)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _U(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _stretches(text: str | None, stretch: int) -> Iterator[list[bytes]]:
    """Words between ASCII white space, ASCII capitals lowered; the end after the last."""
    data, lo = (text or "").encode("utf-8", "surrogatepass").lower(), 0
    while len(data) - lo > stretch:
        gap = _SPACE.search(data, lo + stretch)
        hi = gap.start() if gap else len(data)
        yield data[lo:hi].split()
        lo = hi
    yield [*data[lo:].split(), END]


def coded(docs: DataFrame, size: int = BLOCK, stretch: int = STRETCH) -> DataFrame:
    """(doc_id, held_out, text) as blocks of word codes; a piece is a text or a part of one."""
    def code(batches):
        task, made, row = TaskContext.get().partitionId() << 33, 0, 0
        tokens, held, pieces = [], 0, []

        def block():
            nonlocal tokens, held, pieces, made
            codes, distinct = pd.factorize(np.array(tokens, dtype=object))
            p = list(zip(*pieces))
            out = {"block": task + made, "train_tokens": sum(s - k for s, k, h in zip(p[3], p[4], p[2]) if not h),
                   "n_tokens": sum(p[3]) - sum(p[4]),
                   "hashes": _pack(pd.util.hash_array(np.asarray(distinct, dtype=object), categorize=False)),
                   "codes": _pack(codes.astype(np.int32)), "row": list(p[0]), "doc_id": list(p[1]),
                   "held_out": list(p[2]), "size": list(p[3]), "past": list(p[4])}
            tokens, held, pieces, made = [], 0, [], made + 1
            return pa.RecordBatch.from_pylist([out], schema=schema)

        for batch in batches:
            ids, split, texts = (batch.column(k) for k in range(3))
            for k in range(batch.num_rows):
                past = [END]
                for words in _stretches(texts[k].as_py(), stretch):
                    pieces.append((task + row, ids[k].as_py(), split[k].as_py(), len(words) + len(past), len(past)))
                    tokens += past
                    tokens += words
                    held += sum(map(len, words)) + len(words)
                    past = words[-2:] if len(words) > 1 else [*past, *words][-2:]
                    if held >= size:
                        yield block()
                row += 1
        if pieces:
            yield block()

    ddl = ("block long, train_tokens long, n_tokens long, hashes binary, codes binary, row array<long>, "
           "doc_id array<string>, held_out array<boolean>, size array<long>, past array<long>")
    longs = pa.list_(pa.int64())
    schema = pa.schema([("block", pa.int64()), ("train_tokens", pa.int64()), ("n_tokens", pa.int64()),
                        ("hashes", pa.binary()), ("codes", pa.binary()), ("row", longs),
                        ("doc_id", pa.list_(pa.string())), ("held_out", pa.list_(pa.bool_())),
                        ("size", longs), ("past", longs)])
    # a table in buckets: the later joins on the block move only the answers
    spark = docs.sparkSession
    name, buckets = f"coded_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_freed(spark):
        (docs.select(F.col("doc_id").cast("string"), "held_out", "text").mapInArrow(code, ddl).repartition(buckets, "block")
         .write.bucketBy(buckets, "block").option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/leadlens-{name}")
         .saveAsTable(name, format="parquet"))
    return spark.table(name)


class Block:
    """Tokens of a block, the hashes of what ends at each of them, and what is known of these."""

    def __init__(self, row, parts: int, total: int = 0, distinct: int = 0):
        self.id, self.parts, self.row = int(row.block), parts, row
        self.hashes, self.codes = _unpack(row.hashes, _U), _unpack(row.codes, np.int32)
        self.size = np.asarray(row["size"], dtype=np.int64)
        past = np.asarray(row.past, dtype=np.int64)
        begin = np.cumsum(self.size) - self.size
        self.place = np.arange(len(self.codes)) - np.repeat(begin, self.size)
        self.scored = self.place >= np.repeat(past, self.size)
        self.train = self.scored & ~np.repeat(np.asarray(row.held_out, dtype=bool), self.size)
        word = self.hashes[self.codes]
        self.pair = _mix(np.roll(word, 1), word)
        self.triple = _mix(np.roll(self.pair, 1), word)
        self.norm = total + distinct + 1

    # what is sent: places and hashes of each kind, then sums by distinct hash

    def _where(self, kind: int) -> np.ndarray:
        if kind == PAIR:
            return np.flatnonzero(self.place >= 1)
        if kind == TRIPLE:
            return np.flatnonzero((self.place >= 2) & (np.roll(self.c2, 1) >= MIN_COUNT) & (self.c2 >= KEEP))
        if kind == ONE:
            return np.flatnonzero((self.place >= 1) & (self.n1 >= MIN_COUNT))
        return np.flatnonzero((self.place >= 2) & (self.n2 >= MIN_COUNT))

    def _distinct(self, kind: int):
        """Places, distinct hashes by part, the hash of each place among them, bounds of the parts."""
        if kind == WORD:
            at, keys, back = np.arange(len(self.codes)), self.hashes, self.codes
        else:
            at = self._where(kind)
            keys = {PAIR: self.pair, TRIPLE: self.triple, ONE: np.roll(self.hashes[self.codes], 1),
                    TWO: np.roll(self.pair, 1)}[kind][at]
            keys, back = np.unique(keys, return_inverse=True)
        # parts are ranges of hashes: steps between a block's keys do not widen with the number of parts
        order = np.argsort(keys)
        rank = np.empty(len(keys), dtype=np.int64)
        rank[order] = np.arange(len(keys))
        part = ((keys[order] >> _U(32)) * _U(self.parts)) >> _U(32)
        return at, keys[order], rank[back], np.searchsorted(part, np.arange(self.parts + 1, dtype=_U))

    def send(self, kind: int) -> list[tuple]:
        at, keys, back, bounds = self._distinct(kind)
        on = self.train[at]
        columns = [on] if kind < ONE else [on, *(c[at] * on for c in self._stats(kind))]
        sums = np.stack([np.bincount(back, c, len(keys)) for c in columns], axis=1)
        sums = np.rint(sums * UNITS[:sums.shape[1]]).astype(np.int64)
        # keys are sent as steps from the first hash of their part
        first = [_U(-(-(p << 32) // self.parts) << 32) for p in range(self.parts)]
        return [(p, kind, self.id, _pack(np.diff(keys[lo:hi], prepend=first[p])), _pack(sums[lo:hi].T.ravel()))
                for p, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])) if hi > lo]

    def _stats(self, kind: int) -> list[np.ndarray]:
        c, n, lower = (self.c2, self.n1, self.p0) if kind == ONE else (self.c3, self.n2, self.p1)
        own = np.where(c > KEEP, (c - 2) / np.maximum(n, 1), 0)  # the token itself left out
        with np.errstate(divide="ignore"):
            gains = [np.where(own > 0, np.log(own / lower + s), 0) for s in SHARES]
        return [np.where(c >= KEEP, (c - 1) / np.maximum(c, 1), 0), own == 0, *gains]

    # what came back

    def _known(self, back: dict, kind: int) -> np.ndarray:
        out = np.zeros(len(self.codes))
        if kind in back:
            at, _, place, _ = self._distinct(kind)
            out[at] = np.concatenate([_unpack(s, np.float64) for _, s in sorted(back[kind])])[place]
        return out

    def learn(self, back: dict) -> Block:
        """Counts, back-off shares and probabilities as far as the answers go."""
        self.c1, self.c2 = self._known(back, WORD), self._known(back, PAIR)
        self.n1, self.n2 = np.roll(self.c1, 1), np.roll(self.c2, 1)
        self.p0 = (self.c1 + 1) / self.norm
        self.p1 = self._next(self._known(back, ONE), self.c2, self.n1, self.p0)
        self.c3 = self._known(back, TRIPLE)
        return self

    @staticmethod
    def _next(share, count, n, lower):
        return np.where(share > 0, np.maximum(count - 1, 0) / np.maximum(n, 1) + share * lower, lower)

    def scores(self, back: dict) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, base score and score of the pieces."""
        p2 = self._next(self._known(back, TWO), self.c3, self.n2, self.p1)
        ends = np.cumsum(self.size)
        sums = lambda x: np.add.reduceat(np.where(self.scored, x, 0), ends - self.size)
        return (sums(np.ones(len(p2), np.int64)), sums((self.c1 > 0).astype(np.int64)),
                sums(np.log10(self.p0)), sums(np.log10(p2)))


def back_off_shares(sums: np.ndarray) -> np.ndarray:
    """The back-off share of each context that is kept, else 0, from the sums of its ``STATS``."""
    n, mass, few = sums[:, 0], sums[:, 1], sums[:, 2]
    share = 1 - mass / np.maximum(n, 1)
    column = np.searchsorted(SHARES, share, "right") - 1
    gain = sums[np.arange(len(sums)), 3 + np.maximum(column, 0)] + few * np.log(np.maximum(share, 1e-300))
    return np.where((n >= MIN_COUNT) & (gain > MIN_GAIN), share, 0.0)


def _answers(part: pd.DataFrame) -> pd.DataFrame:
    """Sums of a part, answered to every block in the order of its keys."""
    out = []
    for kind, g in part.groupby("kind"):
        keys = [np.cumsum(_unpack(k, _U), dtype=_U) for k in g["keys"]]  # within the part
        width = 1 if kind < ONE else STATS
        sums = np.concatenate([_unpack(s, np.int64).reshape(width, -1).T for s in g["sums"]])
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.stack([np.bincount(back, sums[:, k], len(distinct)) for k in range(width)], axis=1)
        if kind == WORD:  # the number of words, for the driver
            known = total[:, 0]
            out.append((-1, WORD, int((known > 0).sum()), b""))
        else:
            known = np.where(total[:, 0] >= KEEP, total[:, 0], 0) if kind < ONE else back_off_shares(total / UNITS)
        answer = np.split(known[back], np.cumsum([len(k) for k in keys])[:-1])
        out += [(b, kind, p, _pack(a)) for b, p, a in zip(g["block"], g["part"], answer)]
    return pd.DataFrame(out, columns=["block", "kind", "part", "sums"])


def lm_scores(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", mod: int = MOD,
              held: int = HELD_OUT, block: int = BLOCK, stretch: int = STRETCH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    d = docs.select(F.col(doc_id).alias("doc_id"), (crc_mod(doc_id, mod) == held).alias("held_out"),
                    F.col(text).alias("text"))
    state = coded(d, block, stretch)
    facts = state.agg(F.sum("train_tokens").alias("train"), F.sum("n_tokens").alias("n")).first()
    total, parts = facts.train or 0, blocks_for(facts.n or 0, PER_PART)

    def answered(sent: DataFrame, name: str) -> DataFrame:
        return written(sent.groupBy("part").applyInPandas(_answers, BACK), name)

    def first(batches):
        for pdf in batches:
            for _, row in pdf.iterrows():
                b = Block(row, parts)
                yield pd.DataFrame(b.send(WORD) + b.send(PAIR), columns=["part", "kind", "block", "keys", "sums"])

    back = answered(state.mapInPandas(first, SENT), "counts")
    distinct = back.filter("block = -1").agg(F.sum("part")).first()[0] or 0
    back = back.filter("block >= 0")

    def informed(left: pd.DataFrame, right: pd.DataFrame) -> tuple[Block, dict]:
        known: dict[int, list] = {}
        for kind, part, sums in zip(right["kind"], right["part"], right["sums"]):
            known.setdefault(int(kind), []).append((int(part), sums))
        return Block(left.iloc[0], parts, total, distinct).learn(known), known

    def more(*kinds):
        def send(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            b, _ = informed(left, right)
            return pd.DataFrame([r for k in kinds for r in b.send(k)], columns=["part", "kind", "block", "keys", "sums"])
        return send

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        b, known = informed(left, right)
        n, seen, base, full = b.scores(known)
        return pd.DataFrame({"row": b.row["row"], "doc_id": b.row.doc_id, "held_out": b.row.held_out, "n_tokens": n,
                             "n_known": seen, "base_score": base, "score": full})

    blocks = state.groupBy("block")
    for name, kinds in (("triples", (TRIPLE, ONE)), ("contexts", (TWO,))):
        back = back.unionByName(answered(blocks.cogroup(back.groupBy("block")).applyInPandas(more(*kinds), SENT), name))
    pieces = blocks.cogroup(back.groupBy("block")).applyInPandas(
        score, "row long, doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return pieces.groupBy("row").agg(
        F.first("doc_id").cast(d.schema["doc_id"].dataType).alias("doc_id"), F.first("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        F.sum("base_score").alias("base_score"), F.sum("score").alias("score")).drop("row")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op10_lm_score": op10_lm_score}
