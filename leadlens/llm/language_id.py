"""Language identification by a linear-chain conditional random field (operator 4).

A text's words are the chain, the learned languages its labels.  A word's potential sums
weights of hashed features: its prefixes and suffixes, character n-grams, and the lexicon
(the word itself, known in the sample per language).  Learned transitions tie neighbouring
words, so text that switches language in the middle is labelled word by word.
Forward-backward gives each word's label probabilities; a document's language is the one
with the largest sum over its words, weighted by their letters, and the score is its share.

Training: a bounded sample of the labelled rows, ``SAMPLE_PER_LANG`` documents of each
language, drawn by a hash over all of them.  Their words carry the document's label, and
pieces of two documents of different languages are put together so that transitions are
learned from switches.  Stochastic gradient steps on the exact conditional likelihood.

Prediction: a vectorised UDF.  Features of the distinct words of a batch are looked up
once; the recursions run over all texts of the batch at once, in windows of ``SPAN`` words
joined by exact transfer matrices, so one very long text takes no longer than its words.

Cases: a null text or one without a letter is ``und`` with score 0; rows with null
language are not learned from; repeated rows are predicted row by row; if nothing can be
learned every text is ``und``; extra columns pass through.
"""

from __future__ import annotations

import re
import zlib
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlens.llm.common import crc_mod, table

#: bound of the training sample: documents of a language
SAMPLE_PER_LANG = 160
#: words of a sampled document that a training chain holds at most; longer ones are cut into several chains
CHAIN = 64
MAX_LANGS = 64
BITS = 18
EPOCHS = 6
RATE = 0.25
RIDGE = 1e-5
SPAN = 64
HELD_OUT = 2
UND = "und"
WIDE = 20

WORD = re.compile(r"[^\W\d_]+")


def _hash(codes: np.ndarray, salt: int) -> np.ndarray:
    """Feature slots of integer rows (one row per word) under a salt."""
    h = np.full(len(codes), salt * 0x9E3779B1 + 1, dtype=np.uint64)
    for k in range(codes.shape[1]):
        h = (h ^ codes[:, k]) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(7)).astype(np.int64) & ((1 << BITS) - 1)


def word_features(words: list[str]) -> np.ndarray:
    """(words, features) slots; slot 0 stands for no feature.

    Letters beyond the first ``WIDE`` give no inner n-grams, but suffixes are the true ends.
    """
    n = len(words)
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    head = np.array([w[:WIDE] for w in words], dtype=f"U{WIDE}").view(np.uint32).reshape(n, WIDE).astype(np.uint64)
    tail = np.array([w[:-4:-1] for w in words], dtype="U3").view(np.uint32).reshape(n, 3).astype(np.uint64)
    whole = np.array([hash_word(w) for w in words], dtype=np.uint64)
    out = [_hash(whole[:, None], 1)]
    for k in (1, 2, 3):
        out.append(np.where(lengths >= k, _hash(head[:, :k], 10 + k), 0))
        out.append(np.where(lengths >= k, _hash(tail[:, :k], 20 + k), 0))
    for k in (2, 3):
        for at in range(WIDE - k + 1):
            there = lengths >= at + k
            if not there.any():
                break
            out.append(np.where(there, _hash(head[:, at:at + k], 30 + k), 0))
    return np.stack(out, axis=1)


def hash_word(word: str) -> int:
    """A stable 64-bit hash of a word, from two checksums of its bytes."""
    b = word.encode()
    return zlib.crc32(b) << 32 | zlib.adler32(b)


def potentials(weights: np.ndarray, words: list[str]) -> np.ndarray:
    """(words, labels) sums of feature weights."""
    if not words:
        return np.zeros((0, weights.shape[1]))
    slots = word_features(words)
    out = np.zeros((len(words), weights.shape[1]))
    for k in range(slots.shape[1]):
        out += weights[slots[:, k]]
    return out


def marginals(emit: np.ndarray, step: np.ndarray, lengths: np.ndarray, pairs: bool = False):
    """Label probabilities of the words of chains laid end to end (``lengths`` words each).

    With ``pairs`` also the summed probabilities of neighbouring labels, for training.

    Chains are cut into windows of ``SPAN`` words.  One pass multiplies each window's
    transfer matrices, a short pass links the windows of a chain, and a last pass runs
    forward and backward inside all windows at once.
    """
    total, k = emit.shape
    if not total:
        return emit
    local = np.exp(emit - emit.max(axis=1, keepdims=True))
    move = np.exp(step - step.max())
    per_chain = -(-lengths // SPAN)
    chain = np.repeat(np.arange(len(lengths)), per_chain)
    within = np.arange(len(chain)) - np.repeat(np.cumsum(per_chain) - per_chain, per_chain)
    begin = np.repeat(np.cumsum(lengths) - lengths, per_chain) + within * SPAN
    size = np.minimum(SPAN, np.repeat(np.cumsum(lengths), per_chain) - begin)
    order = np.argsort(-size, kind="stable")
    begin_o, size_o, head_o = begin[order], size[order], (within == 0)[order]
    active = [int(np.searchsorted(-size_o, -t, side="left")) for t in range(SPAN + 1)]  # windows longer than t
    first = np.ones((len(chain), k)) / k
    last = np.ones((len(chain), k))
    if (per_chain > 1).any():
        # transfer matrix of each window: from the label before it to its last label
        m = np.broadcast_to(np.eye(k), (len(chain), k, k)).copy()
        for t in range(SPAN):
            a = active[t]
            if not a:
                break
            x = m[:a] @ move
            if t == 0:  # nothing comes before a chain's first word
                x[head_o[:a]] = np.eye(k)
            x *= local[begin_o[:a] + t][:, None, :]
            m[:a] = x / x.sum(axis=(1, 2), keepdims=True)
        windows = np.empty_like(m)
        windows[order] = m
        ends = np.cumsum(per_chain)
        for c in np.flatnonzero(per_chain > 1):
            w = range(ends[c] - per_chain[c], ends[c])
            for i in w[1:]:
                v = first[i - 1] @ windows[i - 1]
                first[i] = v / v.sum()
            for i in reversed(w[:-1]):
                v = windows[i + 1] @ last[i + 1]
                last[i] = v / v.sum()
    forward = np.empty((total, k))
    v = first[order]
    for t in range(SPAN):
        a = active[t]
        if not a:
            break
        x = v[:a] @ move
        if t == 0:
            x = np.where(head_o[:a, None], 1.0, x)
        x = x * local[begin_o[:a] + t]
        v[:a] = x / x.sum(axis=1, keepdims=True)
        forward[begin_o[:a] + t] = v[:a]
    alpha = forward.copy() if pairs else None
    back = last[order]
    for t in range(SPAN - 1, -1, -1):
        a = active[t]
        if not a:
            continue
        at = begin_o[:a] + t
        x = back[:a]
        p = forward[at] * x
        forward[at] = p / p.sum(axis=1, keepdims=True)
        x = (local[at] * x) @ move.T
        back[:a] = x / x.sum(axis=1, keepdims=True)
    if not pairs:
        return forward
    inner = np.ones(total, dtype=bool)
    inner[np.cumsum(lengths) - lengths] = False
    i = np.flatnonzero(inner)
    ahead = local[i] * forward[i] / np.maximum(alpha[i], 1e-300)
    both = alpha[i - 1][:, :, None] * move[None] * ahead[:, None, :]
    return forward, (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0), i


def chains_of(texts: list[tuple[list[str], int]], rng: np.random.Generator) -> list[tuple[list[str], list[int]]]:
    """Training chains: pieces of one document, and pieces of two put together."""
    pieces = [(w[i:i + CHAIN], y) for w, y in texts for i in range(0, len(w), CHAIN)]
    out = [(w, [y] * len(w)) for w, y in pieces]
    if len({y for _, y in pieces}) > 1:
        for (a, ya), j in zip(pieces, rng.integers(0, len(pieces), len(pieces))):
            b, yb = pieces[j]
            if ya != yb:
                a, b = a[:int(rng.integers(4, CHAIN // 2))], b[:int(rng.integers(4, CHAIN // 2))]
                out.append((a + b, [ya] * len(a) + [yb] * len(b)))
    return out


def fit(texts: list[tuple[list[str], int]], n_labels: int, seed: int = 5, epochs: int = EPOCHS):
    """(feature weights, transition weights) by adaptive gradient steps on small batches of chains."""
    rng = np.random.default_rng(seed)
    chains = chains_of(texts, rng)
    vocab: dict[str, int] = {}
    ids = [np.array([vocab.setdefault(w, len(vocab)) for w in ws]) for ws, _ in chains]
    labels = [np.array(y) for _, y in chains]
    slots = word_features(list(vocab)) if vocab else np.zeros((0, 1), dtype=np.int64)
    weights, step = np.zeros((1 << BITS, n_labels)), np.zeros((n_labels, n_labels))
    sum_w, sum_s = np.full(weights.shape, 1e-3), np.full(step.shape, 1e-3)
    for _ in range(epochs):
        order = rng.permutation(len(chains))
        for at in range(0, len(order), 64):
            batch = order[at:at + 64]
            w = np.concatenate([ids[i] for i in batch])
            y = np.concatenate([labels[i] for i in batch])
            lengths = np.array([len(ids[i]) for i in batch])
            f = slots[w]
            emit = weights[f].sum(axis=1)
            p, both, i = marginals(emit, step, lengths, pairs=True)
            grad = p
            grad[np.arange(len(y)), y] -= 1
            used, back = np.unique(f, return_inverse=True)
            g = np.stack([np.bincount(back.ravel(), np.repeat(grad[:, c], f.shape[1]), len(used))
                          for c in range(n_labels)], axis=1)
            g = g / len(batch) + RIDGE * weights[used]
            g[used == 0] = 0
            sum_w[used] += g * g
            weights[used] -= RATE * g / np.sqrt(sum_w[used])
            seen = np.bincount(y[i - 1] * n_labels + y[i], minlength=n_labels ** 2).reshape(step.shape)
            gs = (both - seen) / len(batch) + RIDGE * step
            sum_s += gs * gs
            step -= RATE * gs / np.sqrt(sum_s)
    return weights.astype(np.float32), step


def training_sample(docs: DataFrame, text: str, lang: str, doc_id: str, held: int, per_lang: int) -> list:
    """At most ``per_lang`` labelled texts of each language: the smallest hash in each of so many cells."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (crc_mod(doc_id, 4) != held)).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
        F.xxhash64(F.lit("sample"), doc_id).alias("h"))
    rows = rows.withColumn("cell", F.pmod("h", F.lit(per_lang)))
    picked = rows.groupBy("lang", "cell").agg(F.min("h").alias("h"))
    langs = picked.select("lang").distinct().limit(MAX_LANGS + 1).count()
    if langs > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    chosen = rows.join(F.broadcast(picked), ["lang", "cell", "h"], "left_semi")
    out = chosen.groupBy("lang", "h").agg(F.max("text").alias("text")).orderBy("lang", "h").collect()
    return [(r.lang, r.text) for r in out]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
          held: int = HELD_OUT, per_lang: int = SAMPLE_PER_LANG) -> dict:
    sample = training_sample(docs, text, lang, doc_id, held, per_lang)
    langs = sorted({x for x, _ in sample})
    texts = [(WORD.findall(t.lower()), langs.index(x)) for x, t in sample]
    weights, step = fit([x for x in texts if x[0]], max(1, len(langs)))
    used = np.flatnonzero(np.abs(weights).any(axis=1))
    return {"langs": langs, "slots": used, "weights": weights[used], "step": step}


def _batch(texts, weights, step, langs, words_at_once: int = 200_000):
    """(language, score) of each text; a batch is worked off in runs of whole texts."""
    out: list[tuple[str, float]] = []
    run: list[list[str]] = []
    held = 0

    def flush():
        lengths = np.array([len(x) for x in run])
        codes, distinct = pd.factorize(np.array([w for x in run for w in x], dtype=object))
        emit = potentials(weights, list(distinct))[codes] if len(codes) else np.zeros((0, len(langs)))
        long = lengths > 0
        p = marginals(emit, step, lengths[long])
        if len(codes):
            size = np.array([len(w) for w in distinct], dtype=float)[codes]
            ends = np.cumsum(lengths[long]) - lengths[long]
            share = np.add.reduceat(p * size[:, None], ends)
            share /= share.sum(axis=1, keepdims=True)
            found = iter(share)
        for there in long:
            if there:
                s = next(found)
                out.append((langs[int(s.argmax())], float(min(1.0, s.max()))))
            else:
                out.append((UND, 0.0))
        run.clear()

    for t in texts:
        run.append(WORD.findall(t.lower()) if t and langs else [])
        held += len(run[-1])
        if held > words_at_once:
            flush()
            held = 0
    flush()
    return out


_RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict(docs: DataFrame, model: dict, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct (lang_pred, score) in ``into``."""
    holder = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS slots x languages at most

    @F.pandas_udf(_RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        m = holder.value
        weights = np.zeros((1 << BITS, len(m["langs"])), dtype=np.float32)
        weights[m["slots"]] = m["weights"]
        return pd.DataFrame(_batch(texts, weights, m["step"], m["langs"]), columns=["lang_pred", "score"])

    return docs.withColumn(into, run(F.col(text)))


def keep_known(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """Pipeline stage: texts without a letter, and those no language holds ``min_score`` of, go."""
    model = train(docs)
    d = docs.select(F.col("text").alias("_text"), F.struct(*docs.columns).alias("_row"))
    p = predict(d, model, "_text", "_lang")
    return p.filter((F.col("_lang.lang_pred") != UND) & (F.col("_lang.score") >= min_score)).select("_row.*")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs)
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_mod("doc_id", 4) == HELD_OUT).alias("held_out"),
        F.col("language.lang_pred").alias("lang_pred"), F.col("language.score").alias("score"))


QUERIES = {"op4_language_id": op4_language_id}
