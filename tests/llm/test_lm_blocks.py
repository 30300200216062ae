"""What a block of the language model sends."""

import numpy as np

from leadlens.llm import suffix_tree_lm


def test_lm_keys_do_not_widen_with_the_parts():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 64, 20_000, dtype=np.uint64)
    codes = rng.integers(0, len(words), 60_000).astype(np.int32)

    class Row(dict):
        __getattr__ = dict.__getitem__

    row = Row(block=1, hashes=suffix_tree_lm._pack(words), codes=suffix_tree_lm._pack(codes), size=[len(codes)],
              past=[1], held_out=[False])
    size = {}
    for parts in (1, 100):
        sent = suffix_tree_lm.Block(row, parts).send(suffix_tree_lm.PAIR)
        keys = [suffix_tree_lm._unpack(x[3], np.uint64) for x in sent]
        assert sum(map(len, keys)) == len(np.unique(suffix_tree_lm.Block(row, parts).pair[1:]))
        # steps from a part's first hash stay inside it
        assert all(int(k.sum(dtype=np.uint64)) <= (1 << 64) // parts for k in keys)
        size[parts] = np.concatenate(keys).mean()
    assert size[100] < 1.1 * size[1]
