"""Counting of phrases as texts."""

import numpy as np

from leadlens.llm import phrase_mining


def test_known_phrases_are_counted_without_their_texts(monkeypatch):
    asked, texts = [], phrase_mining._Words.texts
    monkeypatch.setattr(phrase_mining._Words, "texts", lambda w, at, n: (asked.append(len(at)), texts(w, at, n))[1])
    out = phrase_mining._Counts(3)
    for _ in range(3):
        w = next(phrase_mining._chunks(["A  b a\tb", "a b, c"], np.zeros(2, np.uint64), 1 << 20))
        langs = np.array(["en", "und"], object)
        one = np.arange(w.n)
        out.by_text(w.hash, one, w, 1, langs)
        two = np.flatnonzero(w.piece[1:] == w.piece[:-1])
        out.by_text(w.hash[two] * np.uint64(3) + w.hash[two + 1] + np.uint64(w.doc[two]), two, w, 2, langs)
    assert len(asked) == 2  # of three equal chunks only the first one's texts
    got = {}
    for b in out.rows():
        for lang, keys, counts in zip(*(b[c].to_pylist() for c in ("lang", "keys", "counts"))):
            for phrase, c in zip(keys.split(b"\n"), np.frombuffer(counts, np.uint32).tolist()):
                got[phrase] = got.get(phrase, 0) + c
    assert got == {b"a": 9, b"b": 9, b"c": 3, b"a b": 9, b"b a": 3}
