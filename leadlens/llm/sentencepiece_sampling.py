"""SentencePiece encoding with sampled segmentations, and decoding (operator 8).

A text is cut between any two characters that stand together in no piece of the model, so
that no piece reaches across; each unit has a lattice of pieces (a character that no piece
holds is spelled in byte pieces).  A segmentation is a path; its probability is proportional to
the product of its pieces' probabilities ``(rank + SHIFT) ** -POWER``.

Gumbel top-k without replacement by perturbed A* search: the whole space of paths gets
its largest Gumbel value and one exact sample (drawn piece by piece with the lattice's
backward sums).  The rest of the space is split by the first decision that differs; each
part's own largest value is a Gumbel at the log of its mass, truncated at its parent's.
The part with the largest value is sampled next, and so on: k distinct segmentations in
falling order of perturbed log-probability.  The (k+1)-th value is the threshold of the
inclusion probability 1 - exp(-exp(log p - threshold)).  All draws are hashes of
(seed, row key, sample, place), so a rerun or a retried task gives the same rows.

Runs over Arrow batches without a shuffle, in runs of about ``UNITS`` units of whole texts;
the lattices of a run's distinct units are built together.

Cases: a null or empty text has one segmentation, the empty one; a text with fewer than k
segmentations gives them all, with inclusion 1; the character U+2581 is read as a space;
a null key seeds like 0, equal keys and texts give equal samples; columns to carry are
chosen by name, others are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.llm.common import settings, table, written

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
K = 2
SEED = 11
POWER = 1.0
SHIFT = 10.0
BYTE_RANK = 4.0  # a byte piece counts as this many times the last rank
UNITS = 20_000
#: rows of a batch in the pipeline: tasks hold a batch of texts on both sides of the Arrow stream
BATCH_ROWS = 500
SPACE = "▁"
HASH_BASE = np.uint64(0x9E3779B97F4A7C15)
#: range of a Gumbel number made from a 52-bit uniform one
LEAST_NOISE, MOST_NOISE = -4.0, 38.0


def read_pieces(path: str = MODEL) -> dict:
    """Pieces of a model file: normal pieces with log-probabilities, and the byte pieces."""
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    size = m.get_piece_size()
    pieces = [m.id_to_piece(i) for i in range(size)]
    special = {i for i in range(size) if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i)}
    normal = sorted((i for i in range(size) if i not in special), key=lambda i: (-m.get_score(i), i))
    bytes_ = {int(pieces[i][3:5], 16): i for i in range(size) if m.is_byte(i)}
    ranks = np.arange(len(normal)) + SHIFT
    log_p = -POWER * np.log(ranks)
    return {"pieces": pieces, "normal": normal, "log_p": log_p, "bytes": bytes_, "special": sorted(special),
            "byte_log_p": -POWER * float(np.log(BYTE_RANK * ranks[-1]))}


class Vocabulary:
    """The pieces as a trie in a hash table: (state, character) -> state, for whole arrays."""

    def __init__(self, model: dict):
        chars = sorted({c for i in model["normal"] for c in model["pieces"][i]})
        self.code_of = np.full(0x110000, -1, dtype=np.int64)
        self.code_of[[ord(c) for c in chars]] = np.arange(len(chars))
        self.width = len(chars)
        self.joined = np.zeros((self.width + 1, self.width + 1), dtype=bool)  # the last stands for no code
        for i in model["normal"]:
            c = self.code_of[[ord(x) for x in model["pieces"][i]]]
            self.joined[c[:-1], c[1:]] = True
        moves: dict[int, int] = {}
        accept = {}
        for i, lp in zip(model["normal"], model["log_p"]):
            state = 0
            for c in model["pieces"][i]:
                at = state * self.width + int(self.code_of[ord(c)])
                state = moves.setdefault(at, len(moves) + 1)
            accept[state] = (i, lp)
        self.piece = np.full(len(moves) + 1, -1, dtype=np.int64)
        self.log_p = np.zeros(len(moves) + 1)
        for state, (i, lp) in accept.items():
            self.piece[state], self.log_p[state] = i, lp
        self.bits = max(10, (8 * len(moves)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.states = np.zeros(1 << self.bits, dtype=np.int64)
        left_k, left_s = np.array(list(moves)), np.array(list(moves.values()))
        slot = self._slot(left_k)
        while len(left_k):  # open addressing, all keys of a round at once
            free = self.keys[slot] < 0
            _, one = np.unique(slot, return_index=True)
            win = np.zeros(len(slot), dtype=bool)
            win[one] = True
            win &= free
            self.keys[slot[win]], self.states[slot[win]] = left_k[win], left_s[win]
            left_k, left_s, slot = left_k[~win], left_s[~win], (slot[~win] + 1) & ((1 << self.bits) - 1)
        self.longest = max(len(model["pieces"][i]) for i in model["normal"])
        self.byte_ids = np.array([model["bytes"].get(b, 0) for b in range(256)], dtype=np.int32)
        self.byte_log_p = model["byte_log_p"]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def units_of(self, texts: list) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Units of each text: how many, the number of each among the distinct ones, those."""
        ready = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        flat = "".join(ready)
        raw = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(t) for t in ready]) if texts else np.zeros(0, np.int64)
        if not len(raw):
            return np.zeros(len(texts), dtype=np.int64), np.zeros(0, dtype=np.int64), []
        code = self.code_of[raw]
        cut = np.ones(len(raw) + 1, dtype=bool)
        cut[1:-1] = ~self.joined[code[:-1], code[1:]]
        cut[ends] = True
        at = np.flatnonzero(cut)
        begin, size = at[:-1], np.diff(at)
        run = np.concatenate([[0], np.cumsum(cut[:-1])])
        per_text = np.diff(np.concatenate([[0], run[ends]]))
        # a position-free 64-bit hash of each unit from one running sum
        with np.errstate(over="ignore"):
            power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(int(size.max()), HASH_BASE))])
            unit = np.repeat(begin, size)
            sums = np.add.reduceat(_mix(raw.astype(np.uint64) + np.uint64(7)) * power[np.arange(len(raw)) - unit], begin)
            sums = _mix(sums + size.astype(np.uint64))
        codes, _ = pd.factorize(sums)
        first = np.empty(codes.max() + 1, dtype=np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        return per_text, codes, [flat[a:a + n] for a, n in zip(begin[first].tolist(), size[first].tolist())]

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Next states, -1 where no piece goes on."""
        key = state * self.width + code
        slot = self._slot(key)
        seen = self.keys[slot]
        out = np.where(seen == key, self.states[slot], -1)
        open_ = np.flatnonzero((seen != key) & (seen >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[slot[open_]]
            hit = seen == key[open_]
            out[open_[hit]] = self.states[slot[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out


class Lattices:
    """Lattices of distinct units, built together.

    Nodes are numbered by the characters left to their unit's end, so node numbers below
    the number of units are ends, and backward sums go through the nodes group by group.
    ``cum`` is the node number plus the chance of the node's edges up to this one: one
    sorted array in which a node and a uniform number find their edge.
    """

    def __init__(self, v: Vocabulary, units: list[str]):
        size = np.array([len(u) for u in units], dtype=np.int64)
        raw = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum(size + 1) - 1
        total = int((size + 1).sum())
        inner = np.ones(total, dtype=bool)
        inner[ends] = False
        points, codes = np.zeros(total, dtype=np.int64), np.full(total, -1, dtype=np.int64)
        points[inner] = raw
        codes[inner] = v.code_of[raw]
        left = np.repeat(ends, size + 1) - np.arange(total)
        count = np.zeros(total, dtype=np.int64)
        start = np.flatnonzero(inner)
        state, at, found = np.zeros(len(start), dtype=np.int64), start, []
        spelled = inner.copy()
        for t in range(v.longest):
            known = codes[at] >= 0
            start, state, at = start[known], state[known], at[known]
            state = v.step(state, codes[at])
            there = state >= 0
            start, state, at = start[there], state[there], at[there] + 1
            hit = v.piece[state] >= 0
            own, s = start[hit], state[hit]
            if t == 0:
                spelled[own] = False
            found.append((own, at[hit], v.piece[s], v.log_p[s], count[own]))
            count[own] += 1
            if not len(start):
                break
        own = np.flatnonzero(spelled)  # characters that no piece holds
        utf8 = np.searchsorted(np.array([0x80, 0x800, 0x10000]), points[own], side="right") + 1
        found.append((own, own + 1, -1 - points[own], v.byte_log_p * utf8, count[own]))
        count[own] += 1
        order = np.argsort(left, kind="stable")
        place = np.empty(total, dtype=np.int64)
        place[order] = np.arange(total)
        per_node = count[order]
        self.first = np.concatenate([[0], np.cumsum(per_node)])
        edges = int(self.first[-1])
        self.to, self.ids, log_p = np.empty(edges, np.int64), np.empty(edges, np.int64), np.empty(edges)
        for own, to, piece, lp, rank in found:
            e = self.first[place[own]] + rank
            self.to[e], self.ids[e], log_p[e] = place[to], piece, lp
        back, self.chance = np.zeros(total), np.empty(edges)
        groups = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=1))]) if total else np.zeros(1, np.int64)
        for r in range(1, len(groups) - 1):
            n0, n1 = groups[r], groups[r + 1]
            e0, e1 = self.first[n0], self.first[n1]
            cut, n = self.first[n0:n1] - e0, per_node[n0:n1]
            x = log_p[e0:e1] + back[self.to[e0:e1]]
            top = np.maximum.reduceat(x, cut)
            x = np.exp(x - np.repeat(top, n))
            s = np.add.reduceat(x, cut)
            back[n0:n1] = top + np.log(s)
            self.chance[e0:e1] = x / np.repeat(s, n)
        self.node_of = np.repeat(np.arange(total), per_node)
        run = np.concatenate([[0.0], np.cumsum(self.chance)])
        self.cum = self.node_of + np.minimum(1.0, run[1:] - np.repeat(run[self.first[:-1]], per_node))
        last = self.first[1:][per_node > 0] - 1
        self.cum[last] = self.node_of[last] + 1.0
        self.log_chance = np.log(self.chance)
        with np.errstate(divide="ignore"):
            self.log_leave = np.log1p(-np.minimum(self.chance, 1.0))
        self.units = len(units)
        self.start = place[ends - size] if total else np.zeros(0, np.int64)
        self.byte_ids = v.byte_ids

    def id_arrays(self, path: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of paths laid end to end (``count`` edges each), and ids per path."""
        ids = self.ids[path]
        odd = np.flatnonzero(ids < 0)
        each = np.ones(len(ids), dtype=np.int64)
        spelled = [chr(-1 - x).encode("utf-8", "surrogatepass") for x in ids[odd].tolist()]
        each[odd] = [len(b) for b in spelled]
        out = np.repeat(ids, each).astype(np.int32)
        if len(odd):
            at = np.cumsum(each) - each
            where = np.repeat(at[odd], each[odd]) + np.concatenate([np.arange(len(b)) for b in spelled])
            out[where] = self.byte_ids[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
        run = np.concatenate([[0], np.cumsum(each)])
        ends = np.cumsum(count)
        return out, run[ends] - run[ends - count]


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: well spread bits from counters and keys."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keyed(key: np.ndarray, *parts) -> np.ndarray:
    with np.errstate(over="ignore"):
        for p in parts:
            key = _mix(key + np.asarray(p).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return key


def _uniform(key: np.ndarray, *parts) -> np.ndarray:
    """Numbers in (0, 1) for (key, parts...)."""
    return ((_keyed(key, *parts) >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0 ** 52


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def _truncated(at: np.ndarray, bound, g: np.ndarray) -> np.ndarray:
    """A Gumbel at ``at`` given that it is at most ``bound``, from a standard one ``g``."""
    with np.errstate(invalid="ignore", over="ignore"):
        v = bound - (g + at)
        out = bound - np.maximum(v, 0) - np.log1p(np.exp(-np.abs(v)))
    return np.where(np.isneginf(at), -np.inf, out)


class Sampler:
    def __init__(self, model: dict, k: int = K, seed: int = SEED):
        self.vocabulary, self.k, self.seed = Vocabulary(model), k, seed

    def _walk(self, lat: Lattices, nodes: np.ndarray, key: np.ndarray, place: np.ndarray, sample: int) -> tuple:
        """Exact path samples from ``nodes`` to their units' ends: edges, and edges per walk."""
        steps, count, t = [], np.zeros(len(nodes), dtype=np.int64), 0
        live = np.flatnonzero(nodes >= lat.units)
        at = nodes[live]
        base = _keyed(key, self.seed, sample, place)
        while len(live):
            e, u = lat.first[at], at + _uniform(base[live], t)
            on = np.flatnonzero(lat.cum[e] < u)
            while len(on):  # a node's last edge has the node number plus one
                e[on] += 1
                on = on[lat.cum[e[on]] < u[on]]
            steps.append((live, e))
            count[live] += 1
            at = lat.to[e]
            more = at >= lat.units
            live, at, t = live[more], at[more], t + 1
        begin = np.cumsum(count) - count
        path = np.empty(int(count.sum()), dtype=np.int64)
        for t, (live, e) in enumerate(steps):
            path[begin[live] + t] = e
        return path, count

    def sample(self, texts: list, keys: list[int]) -> tuple:
        """Samples of all texts: (text number, rank, log p, perturbed, log inclusion), ids, ids per sample."""
        per_text, codes, distinct = self.vocabulary.units_of(texts)
        lat = Lattices(self.vocabulary, distinct)
        nodes = lat.start[codes]
        key = np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], dtype=np.uint64)
        unit_begin = np.cumsum(per_text) - per_text
        root = _gumbel(_uniform(key, self.seed, 0, 1 << 40))
        # a text's open parts: [path before, bounds of its decisions, ruled out at the first, place of the first,
        #                       log mass before each decision, unit of each decision]
        parts: list[list[list]] = [[] for _ in texts]
        found: list[list[tuple]] = [[] for _ in texts]
        threshold = np.full(len(texts), -np.inf)
        todo = np.arange(len(texts))
        starts = [(np.zeros(0, np.int64), 0, (), 0.0, 1.0, np.zeros(0, np.int64))] * len(texts)
        g, tails, tail_units = root, nodes, [np.arange(n) for n in per_text]
        for n in range(self.k):
            # free walks through the rest of each text, for all texts at once
            per = np.array([len(u) for u in tail_units], dtype=np.int64)
            unit = np.concatenate(tail_units) if len(todo) else np.zeros(0, np.int64)
            path, count = self._walk(lat, tails, np.repeat(key[todo], per), unit + (n << 40), n)
            unit_of = np.repeat(unit, count)
            ends = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(per)])]
            size = np.diff(ends)
            base = np.repeat([s[3] for s in starts], size)
            run = np.concatenate([[0.0], np.cumsum(lat.log_chance[path])])
            before = run[:-1] - np.repeat(run[ends[:-1]], size) + base
            mass = before + lat.log_leave[path]
            # noise is bounded, so a decision far below k + 1 others cannot be among the k + 1 largest
            floor = np.array([_floor(mass[a:b], self.k + 1, x) for a, b, x in zip(ends[:-1], ends[1:], g)])
            some = np.flatnonzero(mass >= np.repeat(floor, size))
            owner = np.repeat(np.arange(len(todo)), size)[some]
            place = some - ends[:-1][owner] + np.array([s[1] for s in starts], dtype=np.int64)[owner]
            drawn = np.full(len(path), -np.inf)
            drawn[some] = _truncated(mass[some], g[owner], _gumbel(
                _uniform(key[todo][owner], self.seed, n, place, 1 << 41)))
            log_p = run[ends[1:]] - run[ends[:-1]]
            for i, text in enumerate(todo.tolist()):
                head, offset, ruled, base_i, rest, head_units = starts[i]
                a, b = ends[i], ends[i + 1]
                own = np.concatenate([head, path[a:b]]) if len(head) else path[a:b]
                units = np.concatenate([head_units, unit_of[a:b]]) if len(head) else unit_of[a:b]
                found[text].append((own, base_i + float(log_p[i]), float(g[i])))
                parts[text].append([own, drawn[a:b], ruled, offset, before[a:b], units])
            starts, next_g, next_todo, nodes_next, tail_units = [], [], [], [], []
            for text in todo.tolist():
                tops = [p[1].max(initial=-np.inf) for p in parts[text]]
                best = int(np.argmax(tops))
                if np.isneginf(tops[best]):
                    continue  # no other segmentation is left
                threshold[text] = tops[best]
                if n + 1 < self.k:
                    s = self._leave(lat, parts[text], best, key[text], n + 1, float(tops[best]))
                    starts.append(s[0])
                    nodes_next.append(s[1])
                    first_unit = unit_begin[text] + s[2]
                    nodes_next.append(nodes[first_unit + 1:unit_begin[text] + per_text[text]])
                    tail_units.append(np.arange(s[2], per_text[text]))
                    next_g.append(tops[best])
                    next_todo.append(text)
            todo, g = np.array(next_todo, dtype=np.int64), np.array(next_g)
            tails = np.concatenate(nodes_next) if nodes_next else np.zeros(0, np.int64)
            if not len(todo):
                break
        rows, paths = [], []
        for i, own in enumerate(found):
            bound = threshold[i] if len(own) == self.k else -np.inf
            for r, (path, lp, value) in enumerate(own, 1):
                rows.append((i, r, lp, value, _log_inclusion(lp, bound)))
                paths.append(path)
        count = np.array([len(p) for p in paths], dtype=np.int64)
        ids, per = lat.id_arrays(np.concatenate(paths) if paths else np.zeros(0, np.int64), count)
        return rows, ids, per

    def _leave(self, lat: Lattices, parts: list, best: int, key, n: int, g: float) -> tuple:
        """Enter the part with the largest value: another edge at its decision, the rest free.

        Returns the start of the new sample, the node after the new edge, and its unit.
        The part without the new edge too is added to ``parts``.
        """
        own, value, banned, offset, before, units = parts[best]
        j = int(value.argmax())
        d = offset + j
        ruled = (banned if j == 0 else ()) + (int(own[d]),)
        node = int(lat.node_of[own[d]])
        edges = [e for e in range(int(lat.first[node]), int(lat.first[node + 1])) if e not in ruled]
        weight = np.cumsum(lat.chance[edges])
        key = np.array([key], dtype=np.uint64)
        u = float(_uniform(key, self.seed, n, d, 1 << 42)[0])
        e = edges[min(int(np.searchsorted(weight, u * weight[-1])), len(edges) - 1)]
        others = [x for x in edges if x != e]
        value = value.copy()
        value[j] = -np.inf
        parts[best] = [own, value, banned, offset, before, units]
        mass = float(before[j])
        step = mass + float(np.log(lat.chance[e]))
        head = np.concatenate([own[:d], [e]])
        if others:
            rest = np.array([mass + float(np.log(lat.chance[others].sum()))])
            drawn = _truncated(rest, g, _gumbel(_uniform(key, self.seed, n, d, 1 << 43)))
            parts.append([head, drawn, ruled, d, np.array([mass]), units[:d + 1]])
        return (head, d + 1, (), step, 0.0, units[:d + 1]), [int(lat.to[e])], int(units[d])


def _floor(mass: np.ndarray, k: int, bound: float) -> float:
    """Below this no decision's value can be among the ``k`` largest."""
    for n in (64, len(mass)):
        best = mass[:n][np.isfinite(mass[:n])]
        if len(best) >= k:
            kth = np.partition(best, len(best) - k)[len(best) - k]
            return min(bound, kth + LEAST_NOISE) - np.log(2) - MOST_NOISE
    return -np.inf


def _log_inclusion(log_p: float, threshold: float) -> float:
    """log(1 - exp(-exp(log_p - threshold))), without loss for small and large differences."""
    if np.isneginf(threshold):
        return 0.0
    z = log_p - threshold
    if z < -30:
        return z
    return float(np.log(-np.expm1(-np.exp(min(z, 700.0)))))


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts; only a run's texts and lattices are held at a time."""
    at, units = 0, 0
    for end, size in enumerate(pc.utf8_length(texts).to_pylist(), 1):
        units += (size or 0) // 5
        if units >= UNITS or end == len(texts):
            yield at, end
            at, units = end, 0


def encode_samples(docs: DataFrame, key: Column, text: str = "text", carry: list[str] | None = None,
                   k: int = K, seed: int = SEED, model: str | dict = MODEL, back: str | None = None) -> DataFrame:
    """Rows (carried columns, rank, ids, log_prob, perturbed, log_inclusion), ``k`` a text;
    with ``back`` also a column of that name, the text decoded from the ids."""
    spark = docs.sparkSession
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    pieces = spark.sparkContext.broadcast(read_pieces(model) if isinstance(model, str) else model)
    more = [T.StructField(back, T.StringType())] if back else []
    d = docs.select(F.struct(*carry).alias("row") if carry else F.lit(None).cast("string").alias("row"),
                    F.coalesce(key.cast("long"), F.lit(0)).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([d.schema["row"], T.StructField("rank", T.IntegerType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("log_prob", T.DoubleType()), T.StructField("perturbed", T.DoubleType()),
                           T.StructField("log_inclusion", T.DoubleType()), *more])

    def run(batches):
        sampler, decoder = Sampler(pieces.value, k, seed), Decoder(pieces.value) if back else None
        for batch in batches:
            for at, end in _runs(batch.column("text")):
                rows, ids, per = sampler.sample(*(batch.column(c)[at:end].to_pylist() for c in ("text", "key")))
                texts_back = [pa.array([decoder.text(x) for x in np.split(ids, np.cumsum(per)[:-1])][:len(rows)],
                                       pa.string())] if back else []
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").take(pa.array([at + x[0] for x in rows], pa.int64())),
                    pa.array([x[1] for x in rows], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]).astype(np.int32)),
                                             pa.array(ids)),
                    *[pa.array([x[c] for x in rows], pa.float64()) for c in (2, 3, 4)], *texts_back],
                    names=schema.names)

    out = d.mapInArrow(run, schema)
    return out.select(*([F.col("row")[c].alias(c) for c in carry]), "rank", "ids", "log_prob", "perturbed",
                      "log_inclusion", *([back] if back else []))


class Decoder:
    """Text of sequences of ids; bytes that are no UTF-8 become U+FFFD, special ids nothing."""

    def __init__(self, model: dict):
        table_ = [p.replace(SPACE, " ") for p in model["pieces"]]
        for i in model["special"]:
            table_[i] = ""
        self.high = np.zeros(len(table_), dtype=bool)  # bytes that only make a character together
        self.byte_of = {}
        for b, i in model["bytes"].items():
            table_[i] = chr(b) if b < 0x80 else ""
            self.high[i] = b >= 0x80
            self.byte_of[i] = b
        self.table = np.array(table_, dtype=object)

    def text(self, ids: np.ndarray) -> str:
        parts = self.table[ids].tolist()
        at = np.flatnonzero(self.high[ids]).tolist()
        if at:
            run = bytearray()
            for n, a in enumerate(at):
                run.append(self.byte_of[int(ids[a])])
                if n + 1 == len(at) or at[n + 1] != a + 1:
                    parts[a] = run.decode("utf-8", "replace")
                    run = bytearray()
        text = "".join(parts)
        return text[1:] if text.startswith(" ") else text


def decoded(rows: DataFrame, ids: str = "ids", into: str = "text", model: str | dict = MODEL) -> DataFrame:
    """``rows`` with the text of ``ids``; null ids give a null text."""
    holder = rows.sparkSession.sparkContext.broadcast(Decoder(read_pieces(model) if isinstance(model, str) else model))

    @F.pandas_udf(T.StringType())
    def run(column: pd.Series) -> pd.Series:
        d = holder.value
        return pd.Series([None if x is None else d.text(x) for x in column], dtype=object)

    return rows.withColumn(into, run(F.col(ids)))


def encoded_docs(docs: DataFrame) -> DataFrame:
    """Last pipeline stage: the sampled segmentations of every row's text."""
    key = F.xxhash64("doc_id", "text")
    out = encode_samples(docs, key, carry=["doc_id"]).select(
        "doc_id", "rank", F.size("ids").cast("long").alias("n_pieces"), "ids", "log_prob", "perturbed",
        "log_inclusion")
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        return written(out, "encoded")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("text_hash", F.xxhash64(
        F.coalesce("text", F.lit(""))))
    s = encode_samples(docs, F.col("doc_id"), carry=["doc_id", "text_hash"], back="back")
    return s.select("doc_id", "rank", F.size("ids").cast("long").alias("n_pieces"),
                    F.xxhash64("ids").alias("ids_hash"), "log_prob", "perturbed", "log_inclusion",
                    (F.xxhash64("back") == F.col("text_hash")).alias("round_trip"))


QUERIES = {"op8_sentencepiece": op8_sentencepiece}
