"""Approximate k nearest neighbours for large minorities (B6): random projection trees.

Locality-sensitive hashing whose buckets can't grow: in each of ``tables`` tables the
points are halved again and again at the median of their projection on a random
direction, until cells hold about ``cell`` points. Close points fall into one cell of
some table with high probability. Points are compared with those of their own cells
only, so the pairs grow with n, not with its square:

* every halving is one aggregate (an approximate median for each cell) joined back to
  the rows, for all tables at once, and written;
* a cell that no direction can halve (equal points) is dealt into blocks of twice the
  size by a hash of the id;
* a cell is compared in one ``applyInPandas`` group, with matrix products; the nearest
  by these are measured again exactly;
* the nearest over all tables stay.

What is found has its exact distance; what may be missed is measured by ``recall``. SMOTE itself takes the exact
neighbours at any size (``smote.py``).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from responsekit.catalog import ID_COL
from responsekit.operators.smote import knn_exact
from responsekit.session import discard, materialize

#: Chosen for a recall of 0.9 and more of five neighbours (README has measured figures).
TABLES, CELL = 12, 256
#: Up to so many rows ``knn`` is exact.
EXACT_ROWS = 50_000
#: Rows of a cell whose nearest are measured exactly at a time.
ROWS_AT_ONCE = 64


def directions(width: int, tables: int, levels: int, seed: int) -> np.ndarray:
    """(tables, levels, width) of standard normal numbers."""
    return np.random.default_rng(seed).standard_normal((tables, levels, width))


def project(points: DataFrame, ways: np.ndarray) -> DataFrame:
    """(id, t, p, cell): for every table the projections of each point, one for each level."""
    tables, levels, width = ways.shape
    flat = ways.reshape(-1, width).T

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, width)
            p = (x @ flat).reshape(n, tables, levels).transpose(1, 0, 2).reshape(-1)
            offsets = np.arange(0, len(p) + 1, levels, dtype=np.int32) if levels else np.zeros(n * tables + 1, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(batch.column(0).to_numpy(), tables)), pa.array(np.repeat(np.arange(tables, dtype=np.int32), n)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(p)), pa.array(np.zeros(n * tables, np.int64))],
                names=["id", "t", "p", "cell"])

    return points.select("id", "v").mapInArrow(run, "id long, t int, p array<double>, cell long")


def cells(points: DataFrame, n: int, width: int, tables: int, cell: int, seed: int) -> DataFrame:
    """(id, t, cell, block) of every point and table, written."""
    levels = max(0, math.ceil(math.log2(max(n, 1) / cell)))
    placed = materialize(project(points, directions(width, tables, levels, seed)))
    for level in range(levels):
        p = F.col("p")[level]
        cut = placed.groupBy("t", "cell").agg(F.percentile_approx(p, 0.5, 1000).alias("cut"))
        halved = materialize(placed.join(cut, ["t", "cell"]).select(
            "id", "t", "p", (F.col("cell") * 2 + (p > F.col("cut")).cast("long")).alias("cell")))
        discard(placed)
        placed = halved
    sizes = materialize(placed.groupBy("t", "cell").agg(F.ceil(F.count("*") / (2 * cell)).alias("blocks")))
    out = materialize(placed.join(sizes, ["t", "cell"]).select(
        "id", "t", "cell", F.pmod(F.xxhash64("id", "t"), F.col("blocks")).cast("int").alias("block")))
    discard(placed)
    return out


def _nearest(k: int):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x = pdf["id"].to_numpy(), np.stack(pdf["v"].to_numpy()).astype(float)
        out = []
        if len(ids) > 1:
            square = (x * x).sum(axis=1)
            rough = square[:, None] + square[None, :] - 2 * (x @ x.T)
            np.fill_diagonal(rough, np.inf)
            many = min(len(ids) - 1, 2 * k + 8)
            near = np.argpartition(rough, many - 1, axis=1)[:, :many]
            for first in range(0, len(ids), ROWS_AT_ONCE):
                c = near[first: first + ROWS_AT_ONCE]
                d = np.sqrt(((x[c] - x[first: first + len(c), None]) ** 2).sum(axis=2))
                best = np.lexsort((ids[c], d), axis=1)[:, :k]
                out.append((np.repeat(ids[first: first + len(c)], best.shape[1]), ids[np.take_along_axis(c, best, 1)].ravel(),
                            np.take_along_axis(d, best, 1).ravel()))
        parts = [np.concatenate([o[j] for o in out]) if out else [] for j in range(3)]
        return pd.DataFrame(dict(zip(("id", "nb_id", "dist"), parts))).astype({"id": "int64", "nb_id": "int64", "dist": "float64"})
    return fn


def knn_lsh(df: DataFrame, cols, k: int = 5, id_col: str = ID_COL, tables: int = TABLES, cell: int = CELL, seed: int = 42) -> DataFrame:
    """(id, nb_id, dist, nb_rank): the nearest of the points that share a cell, ties by neighbour id. Ids are unique."""
    cols = list(cols)
    points = materialize(df.select(F.col(id_col).cast("long").alias("id"), F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("v")))
    placed = cells(points, points.count(), len(cols), tables, cell, seed)
    found = placed.join(points, "id").groupBy("t", "cell", "block").applyInPandas(_nearest(k), "id long, nb_id long, dist double")
    once = found.groupBy("id", "nb_id").agg(F.min("dist").alias("dist"))
    order = Window.partitionBy("id").orderBy("dist", "nb_id")
    best = once.withColumn("nb_rank", F.row_number().over(order)).where(F.col("nb_rank") <= k)
    return best.select(F.col("id").alias(id_col), "nb_id", "dist", "nb_rank")


def pairs_compared(df: DataFrame, cols, id_col: str = ID_COL, tables: int = TABLES, cell: int = CELL, seed: int = 42) -> int:
    """How many pairs ``knn_lsh`` compares."""
    points = df.select(F.col(id_col).cast("long").alias("id"), F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("v"))
    placed = cells(points, points.count(), len(cols), tables, cell, seed)
    m = F.col("m")
    return int(placed.groupBy("t", "cell", "block").agg(F.count("*").alias("m")).agg(F.sum(m * (m - 1))).first()[0] or 0)


def recall(found: DataFrame, exact: DataFrame, id_col: str = ID_COL) -> float:
    """Share of the exact neighbours that were found, or others at their distance."""
    furthest = exact.groupBy(id_col).agg(F.max("dist").alias("reach"), F.count("*").alias("k"))
    hits = found.join(furthest, id_col, "right").groupBy(id_col).agg(
        F.first("k").alias("k"), F.count(F.when(F.col("dist") <= F.col("reach") + 1e-9, 1)).alias("hits"))
    r = hits.agg(F.sum(F.least("hits", "k")), F.sum("k")).first()
    return float(r[0] / r[1]) if r[1] else 1.0


def knn(df: DataFrame, cols, k: int = 5, id_col: str = ID_COL, exact_rows: int = EXACT_ROWS, **lsh) -> DataFrame:
    """The exact neighbours of up to ``exact_rows`` rows, else those of ``knn_lsh``."""
    return knn_exact(df, cols, k, id_col) if df.count() <= exact_rows else knn_lsh(df, cols, k, id_col, **lsh)
