"""Base preprocessing: customer table -> numeric feature table.

``fit_features`` runs two small aggregate jobs on the training rows (date
minimum and category levels; then medians of the derived numeric columns)
and returns literals. ``transform_features`` is a pure projection built from
those literals, so it applies to training, validation and scoring rows alike
without re-fitting on them (the reference re-fits on every frame it sees;
``fit_on="self"`` reproduces that).
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from responsekit.catalog import (AGE_GROUP_LABELS, DATE_COL, DEFAULT_AS_OF_YEAR, EDU_COL, ENGINEERED_COLS,
                                 ID_COL, MARITAL_COL, NUMERICAL_COLS, TARGET_COL)
from responsekit.functions.base import add_base_features
from responsekit.functions.dates import parse_mixed_date
from responsekit.operators.align import align_columns, require_columns
from responsekit.operators.encode import MAX_LEVELS, fit_levels, level_value, onehot_wide
from responsekit.operators.fill import fit_medians, median_fill

INPUT_COLUMNS = [ID_COL, "Year_Birth", EDU_COL, MARITAL_COL, "Income", "Kidhome", "Teenhome", DATE_COL,
                 "Recency", "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts",
                 "MntGoldProds", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases",
                 "NumDealsPurchases", "NumWebVisitsMonth", "AcceptedCmp1", "AcceptedCmp2", "AcceptedCmp3",
                 "AcceptedCmp4", "AcceptedCmp5", "Complain"]


@dataclass
class FeatureModel:
    as_of_year: int
    min_date: str | None
    edu_levels: list[str]
    marital_levels: list[str]
    edu_marital_levels: list[str]
    medians: dict[str, float | None] = field(default_factory=dict)
    add_features: bool = True

    @property
    def numeric_cols(self) -> list[str]:
        return NUMERICAL_COLS + (ENGINEERED_COLS if self.add_features else [])

    @property
    def dummy_cols(self) -> list[str]:
        cols = [f"{EDU_COL}_{v}" for v in self.edu_levels] + [f"{MARITAL_COL}_{v}" for v in self.marital_levels]
        if self.add_features:
            cols += [f"Age_Group_{v}" for v in AGE_GROUP_LABELS]
            cols += [f"Edu_Marital_{v}" for v in self.edu_marital_levels]
        return cols

    @property
    def feature_cols(self) -> list[str]:
        return self.numeric_cols + self.dummy_cols

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> "FeatureModel":
        return FeatureModel(**json.loads(s))


def _with_base(df: DataFrame, min_date, as_of_year, add_features=True) -> DataFrame:
    if add_features:
        return add_base_features(df, min_date, as_of_year)
    from responsekit.functions.base import add_date_features
    return add_date_features(df, min_date).drop(*[c for c in ENGINEERED_COLS if c.startswith("Dt_")])


def _fit_dates_and_levels(df: DataFrame):
    """Date minimum and the three level lists in one grouped aggregate.

    One row per (Education, Marital_Status) pair carries the pair's earliest
    date; map-side partial aggregation keeps a hot pair cheap. Each of the two
    columns may have ``MAX_LEVELS`` levels, so there are at most ``MAX_LEVELS
    ** 2`` pairs; more rows mean that one of the columns has too many."""
    pairs = (df.groupBy(level_value(EDU_COL).alias("e"), level_value(MARITAL_COL).alias("m"))
             .agg(F.min(parse_mixed_date(F.col(DATE_COL))).alias("d")).limit(MAX_LEVELS ** 2 + 1).collect())
    edu, marital = sorted({r["e"] for r in pairs}), sorted({r["m"] for r in pairs})
    for name, levels in ((EDU_COL, edu), (MARITAL_COL, marital)):
        if len(levels) > MAX_LEVELS:
            raise ValueError(f"{name} has more than {MAX_LEVELS} levels")
    dates = [r["d"] for r in pairs if r["d"] is not None]
    return str(min(dates)) if dates else None, edu, marital, sorted({f"{r['e']}_{r['m']}" for r in pairs})


def fit_features(df: DataFrame, as_of_year: int = DEFAULT_AS_OF_YEAR, add_features: bool = True,
                 median_method: str = "exact") -> FeatureModel:
    require_columns(df, [c for c in INPUT_COLUMNS if c != ID_COL])
    min_date, edu, mar, both = _fit_dates_and_levels(df)
    model = FeatureModel(as_of_year, min_date, edu, mar, both, add_features=add_features)
    base = _with_base(df, min_date, as_of_year, add_features)
    model.medians = fit_medians(base, model.numeric_cols, method=median_method)
    return model


def transform_features(df: DataFrame, model: FeatureModel, keep_id: bool = True, fill: bool = True,
                       reference_columns=None) -> DataFrame:
    """ID, numeric features, one-hot dummies, Target when present (then aligned, if asked)."""
    base = _with_base(df, model.min_date, model.as_of_year, model.add_features)
    dummies = {}
    dummies.update(onehot_wide(EDU_COL, model.edu_levels))
    dummies.update(onehot_wide(MARITAL_COL, model.marital_levels))
    if model.add_features:
        dummies.update(onehot_wide("Age_Group", AGE_GROUP_LABELS, fill=AGE_GROUP_LABELS[0]))
        dummies.update(onehot_wide("Edu_Marital_Combined", model.edu_marital_levels, prefix="Edu_Marital",
                                   fill="Unknown_Unknown"))
    base = base.withColumns(dummies)
    if fill:
        base = median_fill(base, model.medians)
    cols = ([ID_COL] if keep_id and ID_COL in df.columns else []) + model.feature_cols
    if TARGET_COL in df.columns:
        cols.append(TARGET_COL)
    out = base.select(*[F.col(f"`{c}`") for c in cols])
    if reference_columns is not None:
        keep = [ID_COL] if keep_id else []
        ref = [c for c in reference_columns if c != TARGET_COL]
        if TARGET_COL in out.columns:
            ref = ref + [TARGET_COL]
        out = align_columns(out, ref, keep=keep)
    return out


def preprocess(df: DataFrame, as_of_year: int = DEFAULT_AS_OF_YEAR, fit_on: DataFrame | None = None,
               **kw) -> tuple[DataFrame, FeatureModel]:
    """Fit on ``fit_on`` (default: ``df`` itself, like the reference) and transform ``df``."""
    model = fit_features(fit_on if fit_on is not None else df, as_of_year)
    return transform_features(df, model, **kw), model
