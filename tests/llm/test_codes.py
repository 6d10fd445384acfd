import math

import numpy as np
import pytest

from docgroups.llm import hamming


def _lookups(n):
    """Probes of a query among ``n`` random codes, whose 10th is at the distance within which ten are expected."""
    distance = next(d for d in range(64) if n * sum(math.comb(64, j) for j in range(d + 1)) >= 10 << 64)
    parts = hamming.segments(n)
    radius, last = divmod(distance, len(parts))
    return sum(sum(math.comb(w, r) for r in range(radius + (i <= last))) for i, (_, w) in enumerate(parts))


def test_lookups_of_a_query_grow_slower_than_the_rows():
    for n in (10_000, 50_000, 250_000, 1_250_000):
        assert _lookups(n) <= n / 100
        assert _lookups(5 * n) <= 5 * _lookups(n)


@pytest.mark.parametrize("chunk", [512, 8])
def test_search_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(hamming, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    bits = rng.integers(0, 2, (900, 64)).astype(np.uint8)
    bits[300:600] = bits[0] ^ (rng.random((300, 64)) < 0.02)  # near copies, so buckets fill more rows than one
    bits[600:700] = bits[1]  # exact copies
    plain = np.packbits(bits, axis=1).view(np.int64).ravel()
    codes = spark.createDataFrame([(i, int(c)) for i, c in enumerate(plain)], "id long, code long")
    got = hamming.search(codes, codes.where("id % 20 = 0"), 10).collect()
    want = set()
    for i in range(0, 900, 20):
        distance = np.bitwise_count((plain ^ plain[i]).view(np.uint64)).astype(int)
        order = [j for j in np.lexsort((np.arange(900), distance)).tolist() if j != i][:10]
        want |= {(i, rank, j, int(distance[j])) for rank, j in enumerate(order, 1)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
