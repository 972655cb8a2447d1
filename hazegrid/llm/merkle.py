"""Merkle manifest of a dataset: a tree per source, and a tree over the sources' roots.

Every node is labelled with the interval of leaf ranks that it covers (leaves ranked by source and id), so trees nest:
a node's ancestors are the nodes whose intervals contain its own. Levels are built upwards, each a group of at most
``fanout`` nodes per bucket, then walked downwards: nodes meet their parent by bucket and containment, and what the
parent's interval holds besides their own, to the left and to the right, are the siblings of their proof.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.common import keep, small
from hazegrid.llm.ranks import ranked

FANOUT = 16
#: The tree over the sources' roots; a source's own tree is named by the rank of its first leaf.
TOP = -1


def record(*fields: Column) -> Column:
    """The fields one after another: ``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return F.concat(*[one(c) for c in fields])


def digest(text: Column) -> Column:
    """SHA-256 in lowercase hex."""
    return F.sha2(text.cast("binary"), 256)


def _hex(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def _joined(nodes: Column) -> Column:
    return F.aggregate(nodes, F.expr("X''"), lambda out, node: F.concat(out, node["digest"]))


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings of its path: per level those on its left and on its right."""
    return F.aggregate(path, leaf, lambda h, step: digest(F.concat(_hex(step["left"]), h, _hex(step["right"]))))


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: _hex(F.concat(step["left"], step["right"]))), ""))


def _levels(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The levels above ``nodes`` (tree, n nodes of the tree at the lowest level, nth, lo, hi, digest). A tree has rows
    up to the level where one node is left. Each level is written; it has a ``fanout``-th of the rows below it."""
    levels, width, most = [], 1, nodes.agg(F.max("n")).first()[0] or 0
    while width < most:
        below = levels[-1] if levels else nodes
        kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
        level = (below.where(F.col("n") > width).groupBy("tree", "n", F.floor(F.col("nth") / fanout).alias("nth"))
                 .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), kids.alias("kids"))
                 .withColumn("digest", F.unhex(digest(_hex(_joined(F.col("kids")))))))
        levels.append(keep(level, "level"))
        width *= fanout
    return levels


def _roots(nodes: DataFrame, levels: list[DataFrame], fanout: int) -> DataFrame:
    """Columns tree, n, lo, hi and digest of each tree's last node."""
    out, width = None, 1
    for level in [nodes, *levels]:
        last = level.where((F.col("n") <= width) & (F.col("n") * fanout > width)).select("tree", "n", "lo", "hi", "digest")
        out, width = last if out is None else out.union(last), width * fanout
    return out


def _attach(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with their ``path`` and the columns of ``tops`` (tree, n, lo, hi, path, more about a tree's root)."""
    carried = [c for c in tops.columns if c not in ("tree", "n", "lo", "hi", "path")]
    names = ["tree", "nth", "lo", "hi", "kids", "path", *carried]
    kind = "array<struct<lo:bigint,hi:bigint,digest:binary>>"
    width = fanout ** len(levels)
    above = None
    for depth in range(len(levels), -1, -1):
        level = levels[depth - 1] if depth else nodes
        # A tree's last node has no parent; its path goes on with that of the tree itself
        last = tops.where((F.col("n") <= width) & (F.col("n") * fanout > width)).withColumns(
            {"nth": F.lit(0).cast("long"), "kids": F.lit(None).cast(kind)}).select(*names)
        parents = last if above is None else above.select(*names).union(last)
        p = parents.select(*[F.col(c).alias(f"p_{c}") for c in names])
        inside = (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
        met = level.join(p, (F.col("tree") == F.col("p_tree")) & (F.floor(F.col("nth") / fanout) == F.col("p_nth")) & inside)
        left = _joined(F.filter("p_kids", lambda k: k["hi"] <= F.col("lo")))
        right = _joined(F.filter("p_kids", lambda k: k["lo"] >= F.col("hi")))
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        above = met.withColumn("path", F.when(F.col("p_kids").isNull(), F.col("p_path")).otherwise(F.concat(step, F.col("p_path")))).select(
            *level.columns, "path", *[F.col(f"p_{c}").alias(c) for c in carried])
        if depth:
            above = keep(above, "paths")
        width //= fanout
    return above


def manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id",
             source_col: str = "source", fanout: int = FANOUT, **carried: Column) -> DataFrame:
    """One row per document: id, source, ``leaf``, ``subroot`` of its source, ``root``, the leaf's rank ``lo``, the
    ``path`` (per level, from the leaf up to the root, the raw digests on its left and on its right) and ``carried``
    expressions over the columns of ``docs``.

    A leaf is the digest of the fields' ``record``. Leaves of a source ascend by id (null first), of equal ids by digest;
    repeated rows are leaves of their own. While a tree has several nodes, each run of ``fanout`` (the last may be shorter)
    becomes the digest of its digests; one leaf alone is its source's root. A null source comes first. Texts are read
    once and stay where they are: only digests are sorted and shuffled. Other columns are ignored; an empty table
    gives an empty result.
    """
    leaf = digest(record(*[docs[c] for c in fields]))
    # The last key spreads equal rows, which are as good as each other, over the partitions of the sort
    leaves = keep(docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), F.unhex(leaf).alias("digest"),
                              F.monotonically_increasing_id().alias("spread"), *[c.alias(name) for name, c in carried.items()]), "leaves")
    nulls_first = [F.col(c).asc_nulls_first() for c in ("source", "id")]
    leaves = ranked(leaves, *nulls_first, F.col("digest").asc(), F.col("spread").asc(), name="lo")
    sources = keep(leaves.groupBy("source").agg(F.min("lo").alias("tree"), F.count(F.lit(1)).alias("n")), "sources")
    of = small(sources.withColumnRenamed("source", "of"))
    nodes = leaves.join(of, F.col("source").eqNullSafe(F.col("of"))).withColumn("hi", F.col("lo") + 1).withColumn("nth", F.col("lo") - F.col("tree"))

    levels = _levels(nodes, fanout)
    roots = keep(_roots(nodes, levels, fanout), "roots")
    top = ranked(roots.withColumn("under", F.col("tree")), F.col("tree").asc(), name="nth").withColumns(
        {"tree": F.lit(TOP).cast("long"), "n": F.lit(roots.count()).cast("long")})
    top_levels = _levels(top, fanout)
    whole = _roots(top, top_levels, fanout)
    root = whole.first()
    empty = F.array().cast("array<struct<left:binary,right:binary>>")
    ends = whole.select("tree", "n", "lo", "hi", empty.alias("path"))
    tops = keep(_attach(top, top_levels, ends, fanout).select(F.col("under").alias("tree"), "path", F.col("digest").alias("subroot")), "tops")
    tops = roots.join(small(tops), "tree").drop("digest")
    found = _attach(nodes, levels, tops, fanout)
    return found.select(F.col("id").alias(id_col), F.col("source").alias(source_col), _hex(F.col("digest")).alias("leaf"),
                        _hex(F.col("subroot")).alias("subroot"), F.lit(root["digest"].hex() if root else None).alias("root"),
                        "lo", "path", *carried)


def verified(found: DataFrame, seen: str) -> DataFrame:
    """Rows of a ``manifest`` with ``folded_root``, recomputed from the leaf digest in column ``seen`` (of a copy of the data) and
    the manifest's siblings, and ``verified``: whether that is the root."""
    folded = fold(F.col(seen), F.col("path"))
    return found.withColumn("folded_root", folded).withColumn("verified", F.col("folded_root") == F.col("root"))
