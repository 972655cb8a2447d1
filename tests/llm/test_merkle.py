import hashlib

import pytest
from pyspark.sql import functions as F

from hazegrid.llm import merkle
from hazegrid.llm.ranks import ranked
from tests.llm.helpers import ODD, no_docs, odd_docs

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def record(row):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def levels(hashes, fanout):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def siblings(tree, i, fanout):
    out = []
    for level in tree[:-1]:
        start = i // fanout * fanout
        run = level[start:start + fanout]
        out.append((run[:i - start], run[i - start + 1:]))
        i //= fanout
    return out


def plain(rows, fanout):
    """(id, leaf, subroot, root, path) of rows (doc_id, source, lang, n_chars, text)."""
    leaves = {}
    for r in rows:
        leaves.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, sha(record(r)), r[0]))
    names = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(leaves[s])], fanout) for s in names}
    top = levels([trees[s][-1][0] for s in names], fanout)
    out = []
    for k, s in enumerate(names):
        for i, x in enumerate(sorted(leaves[s])):
            path = [("".join(a), "".join(b)) for a, b in siblings(trees[s], i, fanout) + siblings(top, k, fanout)]
            out.append((x[3], x[2], trees[s][-1][0], top[-1][0], path))
    return out


def shown(df):
    return [(r.doc_id, r.leaf, r.subroot, r.root, [(s.left.hex(), s.right.hex()) for s in r.path]) for r in df.collect()]


@pytest.mark.parametrize("fanout, n", [(2, 37), (3, 27), (16, 300)])
def test_against_plain_trees(spark, fanout, n):
    names = [None, "", "a", "ä", "z", "Z", *["big"] * 9]  # one source holds most rows
    rows = [(i, names[i % 15], "en" if i % 4 else None, i if i % 5 else None, None if i % 11 == 3 else f"Text Ü {i}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert sorted(shown(merkle.manifest(df, fanout=fanout)), key=str) == sorted(plain(rows, fanout), key=str)


def test_folding_and_proof(spark):
    rows = [(i, f"s{i % 3}", "en", 1, f"Text {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    text = F.when(F.col("doc_id") % 10 == 0, F.lower("text")).otherwise(F.col("text"))
    seen = merkle.digest(merkle.record(*[F.col(c) for c in FIELDS[:4]], text))
    out = merkle.verified(merkle.manifest(df, fanout=4, seen=seen), "seen").withColumn("proof", merkle.proof(F.col("path"))).collect()
    want = {i: (root, path) for i, _, _, root, path in plain(rows, 4)}
    for r in out:
        root, path = want[r.doc_id]
        assert r.verified == (r.doc_id % 10 != 0) == (r.folded_root == root) and r.proof == sha(*[a + b for a, b in path])


def test_one_leaf_is_the_root(spark):
    row = (5, None, None, None, None)
    df = spark.createDataFrame([row], "doc_id long, source string, lang string, n_chars long, text string")
    leaf = sha(record(row))
    assert shown(merkle.manifest(df)) == [(5, leaf, leaf, leaf, [])]


def test_awkward_rows(spark):
    """Nulls, empty and long texts, repeated rows and clashing columns; an empty table."""
    got = shown(merkle.manifest(odd_docs(spark), fanout=3))
    rows = [(i, source, lang, n, text) for i, text, lang, source, n in ODD]
    assert sorted(got, key=str) == sorted(plain(rows, 3), key=str)
    assert merkle.manifest(no_docs(spark)).collect() == []


def test_ranks_of_one_hot_key(spark):
    df = spark.range(1000).select((F.col("id") % 10 > 3).cast("int").alias("k"), (F.col("id") % 7).alias("v"), "id").repartition(6)
    out = ranked(df, F.col("k"), F.col("v").desc(), F.col("id")).collect()
    assert [r.id for r in sorted(out, key=lambda r: r.rank)] == [r.id for r in sorted(out, key=lambda r: (r.k, -r.v, r.id))]
    assert sorted(r.rank for r in out) == list(range(1000))
