"""Standardisation (E9, E10) fitted with one mergeable aggregate pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from responsekit.functions.advanced import d, q


@dataclass
class ScalerModel:
    means: dict[str, float]
    stds: dict[str, float]     # population std (ddof=0), as scikit-learn's scaler
    eps: float = 0.0           # added to std: 1e-6 for the MLP input form (E10)

    def columns(self, cols=None):
        out = {}
        for c in cols or list(self.means):
            m, s = self.means[c], self.stds[c]
            if s is None:  # null throughout: there is no mean to differ from
                out[c] = F.lit(0.0)
                continue
            den = s + self.eps
            if den == 0:  # constant column: scikit-learn leaves it at 0 after centring
                den = 1.0
            out[c] = F.expr(f"({q(c)} - {d(m)}) / {d(den)}")
        return out

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        cols = self.columns()
        return df.withColumns({f"{c}{suffix}": e for c, e in cols.items()})


def fit_scaler(df: DataFrame, cols, eps: float = 0.0) -> ScalerModel:
    """Mean and population std of each column in one pass."""
    cols = list(cols)
    row = df.agg(*[x for i, c in enumerate(cols) for x in (
        F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}"),
        F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}"))]).first()
    return ScalerModel({c: row[f"m{i}"] for i, c in enumerate(cols)},
                       {c: row[f"s{i}"] for i, c in enumerate(cols)}, eps)
