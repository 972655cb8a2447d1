import numpy as np
import pyarrow.parquet as pq
import pytest

from hazegrid.llm import ann

FOLDER = "/root/testdata/sf0.1/embeddings.parquet"


def plain_nearest(base, q, k):
    far = sorted((float(np.sqrt(((np.array(v, float) - np.array(q[1], float)) ** 2).sum())), i) for i, v in base if i != q[0])
    return far[:k]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id int, v string")


def test_recall_against_brute_force(spark):
    t = pq.read_table(FOLDER)
    x = np.array(t["embedding"].to_pylist(), float)
    ids = t["vec_id"].to_numpy()
    df = spark.read.parquet(FOLDER)
    out = ann.nearest(df, df.where("vec_id % 50 = 0")).collect()
    place = {i: n for n, i in enumerate(ids)}
    hits, queries = 0, [i for i in ids if i % 50 == 0]
    for q in queries:
        far = np.sqrt(((x - x[place[q]]) ** 2).sum(1))
        far[place[q]] = np.inf
        want = set(ids[np.argsort(far, kind="stable")[:10]])
        mine = sorted((r.rank, r.vec_id, r.score) for r in out if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(s - far[place[i]]) < 1e-12 for _, i, s in mine) and [m[2] for m in mine] == sorted(m[2] for m in mine)
        hits += len(want & {m[1] for m in mine})
    assert hits >= 0.9 * 10 * len(queries)


def test_whole_forest_is_exact_with_small_blocks_and_copies(spark):
    r = np.random.RandomState(0)
    rows = [(i, [float(np.float32(v)) for v in r.randn(6)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(150)]          # a hot vector
    df = frame(spark, [(i, v, 0, 1, "x") for i, v in rows])
    out = ann.nearest(df, df.where("vec_id % 10 = 0"), k=5, leaf_rows=20, sample_rows=200, trees=3, share=99.0, row_block=16, query_block=4).collect()
    for q in (x for x in rows if x[0] % 10 == 0):
        mine = sorted((x.rank, x.score, x.vec_id) for x in out if x.query_id == q[0])
        want = plain_nearest(rows, q, 5)
        assert [i for *_, i in mine] == [i for _, i in want] and [s for _, s, _ in mine] == pytest.approx([s for s, _ in want])


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (None, [1.0, 0.0]), (7, [0.0, 2.0]), (8, [1.0, 2.0, 3.0]), (100, [1.0, 0.0]), (200, [0.0, 0.0])]
    df = frame(spark, [(i, v, 0, 1, "x") for i, v in rows])
    out = ann.nearest(df, df.where("vec_id % 100 = 0")).collect()
    got = {q: [(r.rank, r.vec_id, r.score) for r in sorted(out, key=lambda r: r.rank) if r.query_id == q] for q in {r.query_id for r in out}}
    far = 5 ** 0.5
    assert got == {0: [(1, 1, 0.0), (2, 100, 0.0), (3, 7, far)], 100: [(1, 0, 0.0), (2, 1, 0.0), (3, 7, far)]}
    assert ann.nearest(frame(spark, []), frame(spark, [])).count() == 0
    assert ann.nearest(df, frame(spark, [])).count() == 0
