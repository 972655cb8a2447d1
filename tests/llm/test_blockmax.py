import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazegrid.llm import blockmax


def plain(base, queries, k, scale=64):
    """(query_id, rank, vec_id, score) by scoring every pair."""
    q8 = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in base]
    wanted = {i for i, _ in queries}
    out = []
    for i, v in (x for x in q8 if x[0] in wanted):
        order = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in q8 if j != i and len(w) == len(v))
        out += [(i, n, j, -s) for n, (s, j) in enumerate(order[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, v string")


def answer(spark, rows, every, k, **options):
    df = blockmax.quantised(frame(spark, rows).repartition(3), 64)
    out = blockmax.top_k(df, df.where(F.col("id") % every == 0), k, **options)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out.collect())


@pytest.mark.parametrize("kind", ["noise", "clusters", "one hot vector", "positive"])
def test_against_all_pairs(spark, kind, monkeypatch):
    monkeypatch.setattr(blockmax, "SHARD", 3)
    monkeypatch.setattr(blockmax, "UNIT", 2)
    r = np.random.RandomState(1)
    x = r.randn(400, 8).astype(np.float32)
    if kind == "clusters":
        x = (r.randn(6, 8)[r.randint(0, 6, 400)] * 3 + 0.1 * x).astype(np.float32)
    if kind == "one hot vector":
        x[r.rand(400) < 0.4] = x[0]
    if kind == "positive":
        x = np.abs(x)
    rows = [(i, [float(v) for v in x[i]], 0, "x") for i in range(400)]
    want = plain([(i, v) for i, v, *_ in rows], [(i, v) for i, v, *_ in rows if i % 7 == 0], 5)
    assert answer(spark, rows, 7, 5, block=16, sample_rows=200) == want


def test_awkward_vectors(spark):
    """Nulls, non-finite parts, other lengths, empty and very large vectors, repeated rows; empty tables."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [1.0, -0.5]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (None, [1.0, 0.0]), (7, [0.0, 2.0]), (8, [1.0, 2.0, 3.0]), (10, []), (11, []), (20, [3e30, 1.0])]
    rows = [(i, v, 0, "x") for i, v in rows]
    got = answer(spark, rows, 10, 3)
    most = (1 << 63) - 1
    mine = [(20, most), (7, 4096), (1, 3072)]
    assert got == sorted([(0, n, i, s) for n, (i, s) in enumerate(mine, 1)] * 2 + [(10, 1, 11, 0)]
                         + [(20, 1, 0, most), (20, 2, 0, most), (20, 3, 1, most)])
    df, none = (blockmax.quantised(frame(spark, x), 64) for x in (rows, []))
    assert blockmax.top_k(df, none).count() == blockmax.top_k(none, df).count() == blockmax.top_k(none, none).count() == 0


def test_bounds_hold_and_skip():
    """No score in a block is above its bound, and blocks below the kth score are not scored."""
    r = np.random.RandomState(0)
    centres = r.randint(-60, 60, (10, 12))
    blocks = []
    for n, c in enumerate(centres):
        x = c + r.randint(-3, 4, (50, 12))
        blocks.append((np.arange(50) + 100 * n, x, x.max(0), x.min(0)))
    q = centres[:4] + r.randint(-3, 4, (4, 12))
    limit = blockmax.bounds(q, np.stack([b[2] for b in blocks]), np.stack([b[3] for b in blocks]))
    exact = np.stack([(q @ b[1].T).max(1) for b in blocks], 1)
    assert (limit >= exact).all()
    seen = []
    original = blockmax.products
    blockmax.products = lambda a, b: seen.append(len(a)) or original(a, b)
    try:
        found = blockmax.search(np.arange(-4, 0), q, blocks, 5, np.full(4, -np.inf))
    finally:
        blockmax.products = original
    assert sum(seen) < 4 * 10
    for row in range(4):
        every = sorted((-int(s), int(i)) for b in blocks for s, i in zip(b[1] @ q[row], b[0]))
        assert [(-int(s), int(i)) for _, s, i in found[found[:, 0] == row]] == every[:5]


def test_products_beyond_doubles():
    a, b = np.array([[1 << 40, 3]]), np.array([[1 << 20, 1], [1 << 30, -5]])
    assert blockmax.products(a, b).tolist() == [[(1 << 60) + 3, (1 << 63) - 1]]
