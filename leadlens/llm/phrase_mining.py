"""Phrase collocation mining by Toivonen's sample and negative border (operator 12).

* A sample of the rows proposes phrases: those seen ``PROPOSE`` times in it whose parts were
  proposed too, found length by length.  It only proposes, so it decides cost and no result.
* A full pass counts the proposals and their negative border, the phrases that are no proposal
  though both phrases one word shorter inside them are (each word belongs to one of the two).
* A border phrase that is seen ``min_count`` times is a border failure: it becomes a proposal, and
  another full pass counts the border that it opens.  This ends when no border phrase fails;
  then all phrases of ``min_count`` or more are counted, since their parts, no rarer than
  themselves, were proposals before them.
* These passes count by hash, since nearly all of a border is rare: phrases whose hashes agree are
  counted together, which can only make a failure without need.  The last pass counts the
  phrases that reached ``min_count`` as texts, exactly.

Which phrases were proposed is a bit field of their hashes, ``FIELD_BITS`` bits for each of them
and ``MAX_FIELD`` bits at most, which is broadcast.  A phrase that hits a bit by chance is
counted without need; none is missed, and no count depends on the field.

Scan tasks hash words from prefix sums over the bytes of a chunk of text and send each phrase
of a few chunks once with its count, so a phrase or language that holds a third of the corpus is
a row a task or a few.  Hashes are dealt to parts by their high half, as many parts as shuffle
partitions; a task sends each part the sorted low halves and their counts as one block, and one
task sums a part.  Texts longer than a chunk go on in the next one, which begins with the last
words before it.

Cases: a null text is empty, a null language ``und``; empty texts add nothing, and a language
without phrases has no row; repeated rows count each; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leadlens.llm.common import LOWER, UPPER, table, written

MIN_COUNT, MAX_LEN, TOP = 30, 4, 2000
#: share of rows that propose, and occurrences in them that make a proposal
SAMPLE, PROPOSE, SEED = 0.125, 2, 11
FIELD_BITS, MAX_FIELD = 32, 30
CHUNK = 1 << 19
#: hashes that a scan task gathers before it sends them
HELD = 1 << 20
SALTS = 64

#: rows of the scan, blocks: sorted low halves of hashes, or phrases of a language with line feeds
#: between them; and their counts
SCANNED = "part int, lang string, keys binary, counts binary"
COUNTS = "low bigint, proposed boolean, lang string, phrase string, len int, cnt bigint"
#: capitals become small letters, piece breaks a line feed, tabs a space
_BYTES = bytes.maketrans(UPPER.encode() + b".,;:!?\x0b\x0c\r\t", LOWER.encode() + b"\n" * 9 + b" ")
_GAP = re.compile(rb"[ \n]")
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Words:
    """Words of a chunk: hash (with the language), piece, place in the bytes."""

    powers = np.ones(1, _U), np.ones(1, _U)

    @classmethod
    def power(cls, n: int):
        if len(cls.powers[0]) < n:
            cls.powers = tuple(np.cumprod(np.concatenate([[_U(1)], np.full(n - 1, b, _U)])) for b in (
                _BASE, pow(_BASE, -1, 1 << 64)))
        return cls.powers

    def __init__(self, data: bytes, at: int, doc_starts: np.ndarray, salt: np.ndarray, old: int):
        self.data, self.old = data, old
        a = np.frombuffer(data, np.uint8)
        gap = (a == 32) | (a == 10)
        edge = np.diff(np.concatenate([[1], gap.view(np.int8), [1]]))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.n = len(self.start)
        up, down = self.power(len(a) + 1)
        total = np.concatenate([[_U(0)], np.cumsum((a.astype(_U) + _U(1)) * up[:len(a)])])
        word = (total[self.end] - total[self.start]) * down[self.start]
        self.doc = np.searchsorted(doc_starts, self.start + at, "right") - 1
        self.piece = np.cumsum(a == 10, dtype=np.int64)[self.start]
        self.hash = _mix(_mix(word + (self.end - self.start).astype(_U)) + salt[self.doc])

    def text(self, first: int, n: int) -> bytes:
        return self.texts(np.array([first]), n)[0]

    def texts(self, first: np.ndarray, n: int) -> list[bytes]:
        """The phrases of ``n`` words that begin at the words ``first``, a space between words."""
        start, end = self.start[first], self.end[first + n - 1]
        words = sum((self.end[first + k] - self.start[first + k] for k in range(n)), np.int64(n - 1))
        return [self.data[a:b] if plain else b" ".join(self.data[a:b].split())
                for a, b, plain in zip(start.tolist(), end.tolist(), (end - start == words).tolist())]


def _chunks(texts: list[str], salt: np.ndarray, chunk: int) -> Iterator[_Words]:
    parts = [t.encode("utf-8", "replace").translate(_BYTES) for t in texts]
    starts = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
    data = b"\n".join(parts)
    lo = hi = old = 0
    while hi < len(data):
        hi += chunk
        gap = _GAP.search(data, hi)
        hi = gap.start() if gap else len(data)
        w = _Words(data[lo:hi], lo, starts, salt, old)
        yield w
        old = min(w.n, MAX_LEN - 1)
        lo = lo + int(w.start[-old]) if old else hi


def _in(field: np.ndarray | None, bits: int, h: np.ndarray) -> np.ndarray:
    if field is None:
        return np.zeros(len(h), bool)
    at = h & _U((1 << bits) - 1)
    return (field[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8)) & 1 == 1


class _Allowed:
    """Phrases of growing length that a field's proposals allow to be counted."""

    def __init__(self, field, bits, n):
        self.field, self.bits, self.ok, self.member = field, bits, np.ones(n, bool), None

    def enter(self, h: np.ndarray):
        """Hashes of this length -> which of the allowed ones are proposals."""
        self.member = np.zeros(len(h), bool)
        at = np.flatnonzero(self.ok)
        self.member[at] = _in(self.field, self.bits, h[at])

    def longer(self, whole: np.ndarray):
        self.ok = self.member[:-1] & self.member[1:] & whole


class _Counts:
    """What a scan task has counted: hashes, and phrases as texts.  A hash stands in part
    ``(h >> 32) * parts >> 32`` with its low 32 bits."""

    def __init__(self, parts: int):
        self.parts, self.hashes, self.counts, self.size = parts, [], [], 0
        # phrases: their hashes in order, the number, language and count of each, texts by number
        self.known, self.number, self.cnt = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.langs, self.phrases = np.zeros(0, object), []

    def part(self, h: np.ndarray) -> np.ndarray:
        return ((h >> _U(32)) * _U(self.parts)) >> _U(32)

    def by_hash(self, h: np.ndarray) -> None:
        got, cnt = np.unique(h, return_counts=True)
        self.hashes.append(got)
        self.counts.append(cnt.astype(np.uint32))
        self.size += len(got)

    def by_text(self, h: np.ndarray, at: np.ndarray, w: _Words, n: int, langs: np.ndarray) -> None:
        got, first, cnt = np.unique(h, return_index=True, return_counts=True)
        place = np.searchsorted(self.known, got)
        old = place < len(self.known)
        old[old] = self.known[place[old]] == got[old]
        self.cnt[place[old]] += cnt[old].astype(np.uint32)
        new, place = ~old, place[~old]
        if not len(place):
            return
        found = at[first[new]]
        number = len(self.phrases) + np.arange(len(place))
        self.phrases += w.texts(found, n)
        self.known, self.number, self.langs, self.cnt = (np.insert(a, place, b) for a, b in (
            (self.known, got[new]), (self.number, number), (self.langs, langs[w.doc[found]]),
            (self.cnt, cnt[new].astype(np.uint32))))
        self.size = 8 * len(self.phrases)  # each takes as much memory as some hashes

    def rows(self) -> Iterator[pa.RecordBatch]:
        """Gives out and forgets all of it."""
        if self.hashes:
            h, cnt = np.concatenate(self.hashes), np.concatenate(self.counts)
            key, cnt = _summed((self.part(h) << _U(32)) | (h & _U(0xFFFFFFFF)), cnt)
            part, low = (key >> _U(32)).astype(np.int32), key.astype(np.uint32)
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            yield from _blocks([(int(part[i]), None, low[i:k].tobytes(), cnt[i:k].tobytes())
                                for i, k in zip(cuts, cuts[1:])])
        if self.phrases:
            part, (lang, names) = self.part(self.known).astype(np.int64), pd.factorize(self.langs)
            order = np.lexsort((lang, part))
            cuts = np.flatnonzero(np.diff(part[order] * len(names) + lang[order], prepend=-1, append=-1)).tolist()
            out = []
            for i, k in zip(cuts, cuts[1:]):
                own, at = order[i:k], order[i]
                # neighbours in the order of texts are alike, which compresses
                own = own[sorted(range(len(own)), key=[self.phrases[x] for x in self.number[own].tolist()].__getitem__)]
                out.append((int(part[at]), names[lang[at]], b"\n".join([self.phrases[x] for x in self.number[own].tolist()]),
                            self.cnt[own].tobytes()))
            yield from _blocks(out)
        self.__init__(self.parts)


def _blocks(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("keys", pa.binary()), ("counts", pa.binary())])
    for i in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + 64]), schema)], schema=schema)


def _summed(key: np.ndarray, cnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[:1] + key.dtype.type(1)))
    return key[first], np.add.reduceat(cnt[order], first, dtype=cnt.dtype)


def _counter(now, before, bits: int, lengths: tuple[int, ...], texts: bool, chunk: int, parts: int):
    """A scan task's function.  ``now``, ``before``: broadcast fields (or None).  Counts by hash
    what ``now`` allows and ``before`` did not; with ``texts`` the members of ``now``, as texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, done, out = now and now.value, before and before.value, _Counts(parts)
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
            cuts = np.flatnonzero(np.diff(size // chunk, prepend=0, append=-1))
            for i, k in zip([0, *cuts], cuts):  # rows of about a chunk of text at a time
                b = batch.slice(i, k - i)
                langs, lang = np.unique(np.array(b.column("lang").to_pylist(), object), return_inverse=True)
                salt = b.column("salt").to_numpy().astype(np.int64).view(_U)
                words = np.zeros(len(langs), np.int64)
                for w in _chunks(b.column("text").to_pylist(), salt, chunk):
                    words += np.bincount(lang[w.doc[w.old:]], minlength=len(langs))
                    _chunk(w, langs[lang], out, field, done, bits, lengths, texts)
                    if out.size > HELD:
                        yield from out.rows()
                if texts:  # the empty phrase stands for all words of a language
                    yield from _blocks([(0, langs[i], b"", np.uint32(words[i]).tobytes()) for i in np.flatnonzero(words)])
        yield from out.rows()
    return count


def _chunk(w: _Words, langs, out: _Counts, field, done, bits, lengths, texts) -> None:
    h, a, c = w.hash, _Allowed(field, bits, w.n), _Allowed(done, bits, w.n)
    for n in range(1, max(lengths) + 1):
        if n > 1:
            whole = w.piece[n - 1:] == w.piece[:1 - n]
            a.longer(whole)
            c.longer(whole)
            # hashes of allowed phrases only: few from three words on
            at = np.flatnonzero(a.ok)
            longer = np.zeros(len(a.ok), _U)
            longer[at] = _mix(h[at] * _U(3) + w.hash[at + n - 1] + _U(n))
            h = longer
        a.enter(h)
        c.enter(h)
        if n in lengths:
            chosen = a.member if texts else a.ok if done is None else a.ok & ~c.ok
            at = max(0, w.old - n + 1) + np.flatnonzero(chosen[max(0, w.old - n + 1):])
            if len(at) and texts:
                out.by_text(h[at], at, w, n, langs)
            elif len(at):
                out.by_hash(h[at])
        if len(h) < 2:
            return


def _merger(least: int, now, bits: int):
    """Sums the blocks of a part; what is seen less than ``least`` times goes."""
    def merge(t: pa.Table) -> pa.Table:
        t, hashes = t.filter(pc.is_valid(t["lang"])), t.filter(pc.is_null(t["lang"]))
        low, cnt = (np.frombuffer(b"".join(hashes[c].to_pylist()), np.uint32) for c in ("keys", "counts"))
        if len(low):
            low, cnt = _summed(low, cnt.astype(np.int64))
            low, cnt = low[cnt >= least], cnt[cnt >= least]
        none = pa.nulls(len(low), pa.string())
        out = [pa.table({"low": pa.array(low.astype(np.int64)),
                         "proposed": pa.array(_in(now and now.value, bits, low.astype(_U))), "lang": none, "phrase": none,
                         "len": pa.nulls(len(low), pa.int32()), "cnt": pa.array(cnt.astype(np.int64))})]
        found: dict[str, Counter] = defaultdict(Counter)
        for lang, keys, counts in zip(*(t[c].to_pylist() for c in ("lang", "keys", "counts"))):
            own = found[lang]
            for phrase, c in zip(keys.split(b"\n"), np.frombuffer(counts, np.uint32).tolist()):
                own[phrase] += c
        for lang, own in found.items():
            own = {p: c for p, c in own.items() if c >= least or not p}
            out.append(pa.table({
                "low": pa.nulls(len(own), pa.int64()), "proposed": pa.nulls(len(own), pa.bool_()),
                "lang": pa.array([lang] * len(own), pa.string()),
                "phrase": pa.array([p.decode("utf-8", "replace") for p in own], pa.string()),
                "len": pa.array([p.count(b" ") + 1 if p else 0 for p in own], pa.int32()),
                "cnt": pa.array(list(own.values()), pa.int64())}))
        return pa.concat_tables(out)
    return merge


def _field(hashes: DataFrame, bits: int):
    """Broadcast bit field of ``hashes``; what comes to the driver has 2 ** ``bits`` bits at most."""
    low = min(bits, 15)

    def pack(t: pa.Table) -> pa.Table:
        f = np.zeros(1 << low, np.uint8)
        f[t["bit"].to_numpy()] = 1
        return pa.table({"part": t["part"][:1], "field": pa.array([np.packbits(f, bitorder="little").tobytes()])})

    at = F.col("low").bitwiseAND((1 << bits) - 1)
    parts = (hashes.select(F.shiftright(at, low).alias("part"), at.bitwiseAND((1 << low) - 1).alias("bit")).distinct()
             .groupBy("part").applyInArrow(pack, "part bigint, field binary").toArrow())
    out = np.zeros(1 << bits >> 3, np.uint8)
    for part, f in zip(parts["part"].to_pylist(), parts["field"].to_pylist()):
        out[part << low >> 3:][:len(f)] = np.frombuffer(f, np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(out)


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                  sample: float = SAMPLE, propose: int = PROPOSE, chunk: int = CHUNK) -> DataFrame:
    """lang, phrase, len, cnt: all phrases of 1 to ``MAX_LEN`` words seen ``min_count`` times,
    and a row of ``len`` 0 with the number of words for each language that has any."""
    lang = F.coalesce(F.col(lang_col), F.lit("und"))
    given = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), lang.alias("lang"),
                        F.xxhash64(lang).alias("salt"))

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def counts(rows, name, least, now, before, bits, lengths=tuple(range(1, MAX_LEN + 1)), texts=False):
        got = rows.mapInArrow(_counter(now, before, bits, lengths, texts, chunk, parts), SCANNED)
        return written(got.groupBy("part").applyInArrow(_merger(least, now, bits), COUNTS), f"phrases-{name}")

    # proposals of the sample, by length
    some = written(given.sample(False, sample, SEED), "phrases-rows")
    proposed = counts(some, "sample", propose, None, None, 0, (1,)).select("low")
    bits = _bits(2 * proposed.count())
    for n in range(2, MAX_LEN + 1):
        more = counts(some, "sample", propose, _field(proposed, bits), None, bits, (n,))
        proposed = proposed.unionByName(more.select("low"))
    # full passes until no border phrase is frequent
    before, now, frequent = None, _field(proposed, bits), None
    while True:
        got = counts(given, "pass", min_count, now, before, bits)
        frequent = got.select("low") if frequent is None else frequent.unionByName(got.select("low"))
        failed = got.filter("NOT proposed").select("low")
        if failed.isEmpty():
            break
        proposed = proposed.unionByName(failed)
        before, now = now, _field(proposed, bits)
    bits = _bits(frequent.count())
    return counts(given, "texts", min_count, _field(frequent, bits), None, bits, texts=True).select(
        "lang", "phrase", "len", "cnt")


def _bits(members: int) -> int:
    return min(MAX_FIELD, max(16, (FIELD_BITS * max(1, members) - 1).bit_length()))


def _wide(c) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(counts: DataFrame, top: int = TOP, percent: int = 80) -> DataFrame:
    """Ranked phrases of two words or more per language, from ``phrase_counts``."""
    f = counts.filter("len >= 1")
    words = F.split("phrase", " ")
    cands = f.filter("len >= 2").select("lang", "phrase", "len", F.col("cnt").alias("a"))
    piece = lambda i, n: F.array_join(F.slice(words, i, n), " ")
    cuts = cands.select("lang", "phrase", "a", "len", F.explode(F.sequence(F.lit(1), F.col("len") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", piece(F.lit(1), F.col("k")).alias("first"),
        piece(F.col("k") + 1, F.col("len") - F.col("k")).alias("rest"))
    part = lambda name, out: f.select("lang", F.col("phrase").alias(name), F.col("cnt").alias(out))
    scored = (cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
              .withColumns({"_a": _wide("a"), "_lr": _wide("l") + _wide("r")})
              .withColumn("score", F.expr("(_a * 2000000) div _lr"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inside = cands.filter("len >= 3").select("lang", F.col("a").alias("f"), F.explode(F.expr(
        "flatten(transform(sequence(2, len - 1), n -> transform(sequence(1, len - n + 1), "
        "i -> array_join(slice(split(phrase, ' '), i, n), ' '))))")).alias("phrase"))
    longest = inside.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    left = scored.join(longest, ["lang", "phrase"], "left").filter(
        F.col("f").isNull() | (_wide("f") * 100 < _wide("a") * percent)).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    # the best of each salt first: the last window of a language sees top * SALTS rows at most
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    best = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(
        F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(
        F.col("rank") <= top)
    n = counts.filter("len = 0").groupBy("lang").agg(F.sum("cnt").alias("n"))
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
                                         "n", "score")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(phrase_counts(table(spark, sf_dir, "documents")))


QUERIES = {"op12_phrase_mining": op12_phrase_mining}

ORACLE = {"op12_phrase_mining": rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, range(1, 5) AS r(k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cut AS (SELECT c.*, i, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score
        FROM (SELECT c.*, unnest(range(1, k)) AS i FROM c) c
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:i], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[i + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
sub AS (SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda n: list_transform(range(1, k - n + 2),
        lambda i: array_to_string(w[i:i + n - 1], ' '))))) AS phrase FROM c WHERE k >= 3),
top AS (SELECT lang, phrase, max(a) AS f FROM sub GROUP BY ALL),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
           FROM best b LEFT JOIN top t ON t.lang = b.lang AND t.phrase = b.phrase
           WHERE t.f IS NULL OR 100::HUGEINT * t.f < 80::HUGEINT * b.a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN n USING (lang)
WHERE rank <= 2000"""}
