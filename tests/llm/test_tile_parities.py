"""The bound inside tiles tells large sets apart and never cuts a link."""

import numpy as np

from leadlens.llm import ngram_join as J


def _bound(a, b):
    fa, fb = (J._signature(np.sort(x))[1] for x in (a, b))
    assert len(fa) == J.TILE_BITS // 64
    return (len(a) + len(b) - int(np.bitwise_count((fa ^ fb).view(np.uint64)).sum())) // 2


def test_large_sets_without_overlap_fall_out_and_links_stay():
    hashes = np.random.default_rng(3).integers(0, 1 << 63, 40_000, dtype=np.uint64)
    links = lambda o, a, b: 100 * o >= J.PERCENT * (len(a) + len(b) - o)
    for n in (1000, 1200):
        a, b = hashes[:n], hashes[n:2 * n]
        assert not links(_bound(a, b), a, b)
    for n in (1, 6, 40, 300, 1000, 5000):
        a, b = hashes[:n], hashes[n // 13:n + n // 30]
        overlap = n - n // 13
        assert links(overlap, a, b) and _bound(a, b) >= overlap
