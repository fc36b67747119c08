"""Schema selection and alignment.

All of these are plan-time projections: they read only the schema and emit
a ``select``, so they add no job and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """E5: numeric columns in schema order, minus an exclusion list."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def align_columns(df: DataFrame, reference, keep=()) -> DataFrame:
    """Missing reference columns become 0, extras are dropped, order follows ``reference``.

    ``keep`` columns (e.g. the id) are carried in front untouched.
    """
    have = set(df.columns)
    cols = [F.col(f"`{k}`") for k in keep if k in have]
    for c in reference:
        if c in keep:
            continue
        cols.append(F.col(f"`{c}`") if c in have else F.lit(0).cast("long").alias(c))
    return df.select(*cols)


def align_report(df: DataFrame, reference, keep=()) -> list[tuple[str, str]]:
    """E7 report: (column, action) with action in kept / added / dropped."""
    have, ref = list(df.columns), set(reference)
    out = [(c, "kept" if c in have else "added") for c in reference if c not in keep]
    out += [(c, "dropped") for c in have if c not in ref and c not in keep]
    return out


def require_columns(df: DataFrame, required) -> None:
    """Fail at plan time, before any job, when inputs lack columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
