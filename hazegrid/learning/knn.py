"""Exact k nearest neighbours between two tables, without a cross join.

Train points belong to the cell of the nearest of some pivots, whose number grows with the square root of the table. In
a first round every query searches the cell it lies in; the distance of its kth neighbour there is its own bound. In a
second round it visits only cells that can hold a nearer point by the triangle inequality. Cells are cut into blocks
of bounded size; each (query block, train block) pair is one small matrix product that preselects, distances of what it
selects are summed squared differences, so that equal points tie wherever they lie, and only the k best rows per query
leave the block. The bounds only skip work; they never lose a neighbour.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from hazegrid.constants import DATE, FEATURES, N_CLASSES, STATION
from hazegrid.functions.category import argmax, probabilities
from hazegrid.session import settle

ID = [STATION, DATE]
BLOCK = 4096
CELL = 64         # there are sqrt(rows / CELL) cells
SLACK = 1e-9      # relative; keeps rounding from pruning a point on the bound
STEP = 128        # queries of one product


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None, :] - 2.0 * a @ b.T, 0.0)


def _assign(df: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds the nearest pivot and the distance to it."""
    @F.pandas_udf("cell int, dist double")
    def nearest(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for v in parts:
            if len(v) == 0:
                yield pd.DataFrame({"cell": np.zeros(0, np.int32), "dist": np.zeros(0)})
                continue
            d = _squared(np.stack(v.to_numpy()), pivots)
            cell = d.argmin(1)
            yield pd.DataFrame({"cell": cell.astype(np.int32), "dist": np.sqrt(d[np.arange(len(d)), cell])})

    return df.withColumn("_a", nearest("v")).select("*", "_a.cell", "_a.dist").drop("_a")


def nearest_of(q: np.ndarray, t: np.ndarray, k: int, bound: np.ndarray, barred: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Query number, train number and squared distance of each query's k nearest within its squared bound; ties go to the
    lower train number. ``barred`` pairs do not count."""
    out = []
    for start in range(0, len(q), STEP):
        part = q[start:start + STEP]
        near = _squared(part, t)
        slack = SLACK * ((part ** 2).sum(1) + (t ** 2).sum(1).max(initial=0.0))     # of the product's rounding
        limit = bound[start:start + STEP] * (1 + SLACK)
        if barred is not None:
            near[barred[start:start + STEP]] = np.inf
        if len(t) > k:
            limit = np.minimum(limit, np.partition(near, k - 1, axis=1)[:, k - 1])
        x, y = np.nonzero((near <= (limit + slack)[:, None]) & np.isfinite(near))
        exact = ((part[x] - t[y]) ** 2).sum(1)
        order = np.lexsort((y, exact, x))
        x, y, exact = x[order], y[order], exact[order]
        first = np.arange(len(x)) - np.searchsorted(x, x) < k
        out.append((x[first] + start, y[first], exact[first]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def _search(pairs: DataFrame, t: DataFrame, k: int, exclude_self: bool, block: int) -> DataFrame:
    """The k best train rows of each (query, cell) pair; a pair has the query's id, vector and squared ``bound``."""
    blocks = F.ceil(F.count(F.lit(1)) / block).cast("long")
    tn, qn = (d.groupBy("cell").agg(blocks.alias(n)) for d, n in ((t, "tn"), (pairs, "qn")))     # a row per cell at most
    both = F.broadcast(tn.join(qn, "cell"))
    t2 = (t.join(both, "cell").withColumn("tb", F.pmod(F.xxhash64("t_station", "t_date"), F.col("tn")))
          .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qn") - 1)))
          .select("cell", "qb", "tb", "t_station", "t_date", "t_y", "v"))
    q2 = (pairs.join(both, "cell").withColumn("qb", F.pmod(F.xxhash64(*ID), F.col("qn")))
          .withColumn("tb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tn") - 1)))
          .select("cell", "qb", "tb", *ID, "v", "bound"))

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in (*ID, "t_station", "t_date", "t_y", "d2")})
        right = right.sort_values(["t_station", "t_date"], kind="stable").reset_index(drop=True)
        barred = None
        if exclude_self:
            barred = (left[STATION].to_numpy()[:, None] == right["t_station"].to_numpy()[None, :]) \
                & (left[DATE].to_numpy()[:, None] == right["t_date"].to_numpy()[None, :])
        x, y, d2 = nearest_of(np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy()), k, left["bound"].to_numpy(), barred)
        return pd.DataFrame({STATION: left[STATION].to_numpy()[x], DATE: left[DATE].to_numpy()[x],
                             "t_station": right["t_station"].to_numpy()[y], "t_date": right["t_date"].to_numpy()[y],
                             "t_y": right["t_y"].to_numpy()[y], "d2": d2})

    tile = ["cell", "qb", "tb"]
    return q2.groupBy(*tile).cogroup(t2.groupBy(*tile)).applyInPandas(
        best, "station string, date timestamp_ntz, t_station string, t_date timestamp_ntz, t_y int, d2 double")


def _others(asked: DataFrame, pivots: np.ndarray, radius: np.ndarray) -> DataFrame:
    """(query, cell) pairs of the second round: the cells, besides its own, that may hold a point within a query's bound."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if part.empty:
                continue
            far = np.sqrt(_squared(np.stack(part["v"].to_numpy()), pivots))
            bound = np.sqrt(part["bound"].to_numpy())
            reach = far - radius[None, :] <= (bound * (1 + SLACK) + SLACK * (1 + far.max()))[:, None]
            reach[np.arange(len(part)), part["cell"].to_numpy()] = False
            x, y = np.nonzero(reach)
            yield part.iloc[x].assign(cell=y.astype(np.int32))[[*ID, "v", "cell", "bound"]]

    return asked.select(*ID, "v", "cell", "bound").mapInPandas(run, "station string, date timestamp_ntz, v array<double>, cell int, bound double")


def neighbours(train: DataFrame, query: DataFrame, k: int, features: tuple[str, ...] = FEATURES, label: str = "y",
               exclude_self: bool = False, block: int = BLOCK, cells: int | None = None) -> DataFrame:
    """The k nearest train rows of every query row: its id, the neighbour's id and label, squared distance
    and rank. Equal distances are ordered by the neighbour's id."""
    spark = train.sparkSession
    vec = F.array(*[F.col(c).cast("double") for c in features]).alias("v")
    t = settle(train.select(F.col(STATION).alias("t_station"), F.col(DATE).alias("t_date"), F.col(label).cast("int").alias("t_y"), vec))
    many = cells or max(1, math.isqrt(t.count() // CELL))
    chosen = t.orderBy(F.xxhash64("t_station", "t_date"), "t_station", "t_date").limit(many).select("v").collect()
    if not chosen:
        return spark.createDataFrame([], "station string, date timestamp_ntz, t_station string, t_date timestamp_ntz, t_y int, d2 double, rn int")
    pivots = np.array([r.v for r in chosen])
    t, q = settle(_assign(t, pivots)), settle(_assign(query.select(*ID, vec), pivots))
    radius = np.full(len(pivots), -np.inf)      # of cells without a point
    for r in t.groupBy("cell").agg(F.max("dist").alias("r")).collect():
        radius[r.cell] = r.r
    none = F.lit(float("inf"))
    first = settle(_search(q.withColumn("bound", none), t, k, exclude_self, block))
    w = Window.partitionBy(*ID).orderBy("d2", "t_station", "t_date")
    kth = (first.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == k).select(*ID, F.col("d2").alias("bound")))
    asked = q.join(kth, ID, "left").withColumn("bound", F.coalesce("bound", none))
    rest = _search(settle(_others(asked, pivots, radius)), t, k, exclude_self, block)
    return first.unionByName(rest).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def votes(near: DataFrame, k: int) -> DataFrame:
    """Share of the k nearest rows per class (p0..p5) and the class with most votes, ties to the lowest."""
    shares = near.where(F.col("rn") <= k).groupBy(*ID).agg(
        *[(F.count_if(F.col("t_y") == c) / F.lit(float(k))).alias(f"p{c}") for c in range(N_CLASSES)])
    return shares.withColumn("prediction", argmax([F.col(p) for p in probabilities()]))


def knn_predict(train: DataFrame, query: DataFrame, k: int, features: tuple[str, ...] = FEATURES, label: str = "y",
                exclude_self: bool = False, block: int = BLOCK, cells: int | None = None) -> DataFrame:
    return votes(neighbours(train, query, k, features, label, exclude_self, block, cells), k)
