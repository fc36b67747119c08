"""Advanced row-wise features (A1, A7-A12) as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from responsekit.catalog import EPS, pairs


# Wide generated expressions are written as SQL text and parsed once on the
# JVM (one call per output column) instead of being assembled from hundreds of
# Column objects, each of which is a round trip to the JVM. The expressions
# are the same; Catalyst sees an identical plan.
def q(name: str) -> str:
    """A column as a double, in SQL text."""
    return "CAST(`" + name.replace("`", "``") + "` AS DOUBLE)"


def d(x: float) -> str:
    """An exact double literal in SQL text (repr round-trips every finite double)."""
    x = float(x)
    if math.isnan(x) or math.isinf(x):
        return f"CAST('{x}' AS DOUBLE)"
    return f"{x!r}D"


def _sum(terms) -> str:
    return "(" + " + ".join(terms) + ")"


def poly_interactions(cols, first_index: int | None = None) -> dict[str, Column]:
    """A1: degree-2 interaction products, named ``Poly_{i}`` after the linear terms."""
    start = len(cols) if first_index is None else first_index
    return {f"Poly_{start + k}": F.expr(f"{q(a)} * {q(b)}") for k, (a, b) in enumerate(pairs(cols))}


def pair_ratios(cols) -> dict[str, Column]:
    """``{a}_div_{b}`` = a / (b + 0.001) for every ordered pair."""
    return {f"{a}_div_{b}": F.expr(f"{q(a)} / ({q(b)} + {d(EPS)})") for a, b in pairs(cols)}


def pair_differences(cols) -> dict[str, Column]:
    """``{a}_minus_{b}``."""
    return {f"{a}_minus_{b}": F.expr(f"{q(a)} - {q(b)}") for a, b in pairs(cols)}


def _present(c: str) -> str:
    """The value, with NaN read as missing."""
    return f"(CASE WHEN NOT isnan({q(c)}) THEN {q(c)} END)"


def _count_mean_sql(cols) -> tuple[str, str]:
    vals = [_present(c) for c in cols]
    n = _sum(f"CAST({v} IS NOT NULL AS DOUBLE)" for v in vals)
    s = _sum(f"coalesce({v}, 0.0D)" for v in vals)
    return n, f"(CASE WHEN {n} > 0 THEN {s} / {n} END)"


def _std_sql(cols, n: str, mean: str) -> str:
    sq = _sum(f"coalesce(({v} - {mean}) * ({v} - {mean}), 0.0D)" for v in (_present(c) for c in cols))
    return f"(CASE WHEN {n} > 1 THEN sqrt({sq} / ({n} - 1.0D)) END)"


def row_count_mean(cols) -> tuple[Column, Column]:
    """Null-skipping count and mean over ``cols`` (first layer of A9/A10)."""
    n, mean = _count_mean_sql(cols)
    return F.expr(n), F.expr(mean)


def row_std(cols, n: str, mean: str) -> Column:
    """Sample std (ddof=1) given the count and mean columns by name (second layer of A9/A10)."""
    return F.expr(_std_sql(cols, f"`{n}`", f"`{mean}`"))


def add_row_stats(df, groups: dict) -> "DataFrame":
    """A9/A10 as two projection layers: count and mean first, then the std over the mean
    column, so the mean is computed once per row instead of once per term."""
    first = {}
    for prefix, cols in groups.items():
        n, mean = _count_mean_sql(cols)
        first[f"__n_{prefix}"] = F.expr(n)
        first[f"{prefix}_Mean"] = F.expr(mean)
    df = df.withColumns(first)
    second = {f"{prefix}_Std": row_std(cols, f"__n_{prefix}", f"{prefix}_Mean") for prefix, cols in groups.items()}
    return df.withColumns(second).drop(*[f"__n_{p}" for p in groups])


def row_mean_std(cols) -> tuple[Column, Column]:
    """Single-expression form (used where only the two values are selected)."""
    n, mean = _count_mean_sql(cols)
    return F.expr(mean), F.expr(_std_sql(cols, n, mean))


def extra_logs(nonneg: dict[str, bool]) -> dict[str, Column]:
    """log1p of each column whose fitted minimum is >= 0."""
    return {f"{c}_Log": F.expr(f"log1p({q(c)})") for c, ok in nonneg.items() if ok}


def exp_decay(col: str = "Recency", scale: float = 10.0) -> Column:
    """exp(-x / 10)."""
    return F.expr(f"exp(-{q(col)} / {d(scale)})")


def euclidean_sql(cols, centre) -> str:
    """Distance of the row vector ``cols`` to a literal centre, as SQL text."""
    return "sqrt(" + _sum(f"({q(c)} - {d(m)}) * ({q(c)} - {d(m)})" for c, m in zip(cols, centre)) + ")"


def euclidean(cols, centre) -> Column:
    """Distance of the row vector ``cols`` to a literal centre."""
    return F.expr(euclidean_sql(cols, centre))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def is_finite(x) -> bool:
    return x is not None and not (isinstance(x, float) and (math.isnan(x) or math.isinf(x)))
