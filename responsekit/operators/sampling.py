"""Splits, folds and class balancing.

Row selection is driven by a deterministic md5 hash of (id, seed), so a
split repeats whatever the partitioning, and per-class sizes are exact:
the class-wise rank threshold comes from ``rank_thresholds`` (no window over
a whole class).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from responsekit.catalog import ID_COL, TARGET_COL
from responsekit.operators.ranking import at_or_below, group_counts, hash_u32, rank_thresholds

HASH_COL = "_h"
TWO32 = float(2 ** 32)


def require_unique_ids(df: DataFrame, id_col: str = ID_COL) -> None:
    """Splits, folds, SMOTE and joins need an id per row: raise on a null or repeated one."""
    bad = df.groupBy(id_col).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(id_col).isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"{id_col} {bad[0][id_col]!r} is null or occurs {bad[0]['n']} times; it must be unique")


def with_hash(df: DataFrame, id_col: str = ID_COL, seed: int = 42) -> DataFrame:
    return df.withColumn(HASH_COL, hash_u32(id_col, seed=seed))


def stratified_split(df: DataFrame, label: str = TARGET_COL, fraction: float = 0.3, seed: int = 42,
                     id_col: str = ID_COL, flag: str = "is_valid") -> DataFrame:
    """B1: flag the ``ceil(fraction * n_y)`` rows of smallest hash in each class as validation."""
    h = with_hash(df, id_col, seed)
    counts = group_counts(h, label)
    th = rank_thresholds(h, label, HASH_COL, id_col, [fraction], counts)
    cond = F.lit(False)
    for y in counts:
        cond = cond | (F.col(label).eqNullSafe(F.lit(y)) & at_or_below(HASH_COL, id_col, th[(y, fraction)]))
    return h.withColumn(flag, cond.cast("int")).drop(HASH_COL)


def random_split(df: DataFrame, fraction: float = 0.2, seed: int = 42, id_col: str = ID_COL,
                 flag: str = "is_valid") -> DataFrame:
    """B2: hash threshold, no class information (used when only one class exists)."""
    return df.withColumn(flag, (hash_u32(id_col, seed=seed) < F.lit(int(fraction * TWO32))).cast("int"))


def split(df: DataFrame, label: str = TARGET_COL, fraction: float = 0.3, seed: int = 42,
          id_col: str = ID_COL) -> tuple[DataFrame, DataFrame]:
    """Stratified when the label has more than one value, else random."""
    n_classes = df.select(label).distinct().limit(2).count()
    flagged = (stratified_split(df, label, fraction, seed, id_col) if n_classes > 1
               else random_split(df, fraction, seed, id_col))
    return (flagged.filter("is_valid = 0").drop("is_valid"), flagged.filter("is_valid = 1").drop("is_valid"))


def kfold_assign(df: DataFrame, k: int = 5, label: str = TARGET_COL, seed: int = 42, id_col: str = ID_COL,
                 fold_col: str = "fold") -> DataFrame:
    """Stratified folds; within each class, hash rank r goes to fold #{j : r > ceil(j n / k)}."""
    h = with_hash(df, id_col, seed)
    counts = group_counts(h, label)
    qs = [j / k for j in range(1, k)]
    th = rank_thresholds(h, label, HASH_COL, id_col, qs, counts)
    fold = F.lit(0)
    for q in qs:
        past = F.lit(False)
        for y in counts:
            past = past | (F.col(label).eqNullSafe(F.lit(y)) & ~at_or_below(HASH_COL, id_col, th[(y, q)]))
        fold = fold + past.cast("int")
    return h.withColumn(fold_col, fold.cast("int")).drop(HASH_COL)


def class_counts(df: DataFrame, label: str = TARGET_COL) -> dict:
    return group_counts(df, label)


def imbalance_ratio(counts: dict) -> float:
    """min/max class count."""
    vals = list(counts.values())
    return min(vals) / max(vals) if len(vals) > 1 else 1.0


def is_imbalanced(counts: dict, limit: float = 0.2) -> bool:
    return len(counts) > 1 and imbalance_ratio(counts) < limit


def class_weights(counts: dict, mode: str = "Balanced") -> dict:
    """None -> 1; Balanced -> max count / own count; SqrtBalanced -> its square root."""
    if mode in (None, "None"):
        return {y: 1.0 for y in counts}
    top = max(counts.values())
    w = {y: top / n for y, n in counts.items()}
    if mode == "SqrtBalanced":
        return {y: math.sqrt(v) for y, v in w.items()}
    if mode == "Balanced":
        return w
    raise ValueError(f"unknown class weight mode {mode!r}")


def with_weights(df: DataFrame, weights: dict, label: str = TARGET_COL, out: str = "weight") -> DataFrame:
    expr = F.lit(1.0)
    for y, w in weights.items():
        expr = F.when(F.col(label) == F.lit(y), F.lit(float(w))).otherwise(expr)
    return df.withColumn(out, expr)


def pos_weight(counts: dict) -> float:
    """Negatives / positives, the usual scale for the positive class."""
    return counts.get(0, 0) / counts[1] if counts.get(1) else 1.0


def with_pos_weight(df: DataFrame, w: float, label: str = TARGET_COL, out: str = "weight") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(w))).otherwise(F.lit(1.0)))
