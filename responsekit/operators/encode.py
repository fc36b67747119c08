"""Categorical encodings.

Levels are fitted on training rows and enter the plan as literals, so the
encoding itself is a narrow projection with no shuffle. Level discovery is
a distinct with a hard cap: a wide form with more than ``MAX_LEVELS`` columns
is an input error. Columns of more levels take the vector form (``vector_stages``):
one sparse vector per column, whatever its number of levels; the levels
themselves are the fitted model, so they do reach the driver.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_LEVELS = 1000
UNKNOWN = "Unknown"


def fit_levels(df: DataFrame, col: str, fill: str = UNKNOWN, max_levels: int = MAX_LEVELS) -> list[str]:
    """Sorted distinct levels (nulls read as ``fill``); raises past ``max_levels``."""
    rows = (df.select(F.coalesce(F.col(col).cast("string"), F.lit(fill)).alias("v"))
            .distinct().limit(max_levels + 1).collect())
    if len(rows) > max_levels:
        raise ValueError(f"column {col!r} has more than {max_levels} levels")
    return sorted(r["v"] for r in rows)


def level_value(col: str, fill: str = UNKNOWN) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(fill))


def onehot_wide(col: str, levels, prefix: str | None = None, fill: str = UNKNOWN) -> dict[str, Column]:
    """One 0/1 column per level, named ``{prefix}_{level}``."""
    prefix = prefix or col
    v = level_value(col, fill)
    return {f"{prefix}_{lvl}": (v == F.lit(lvl)).cast("long") for lvl in levels}


def with_known_levels(df: DataFrame, cols, fill: str = UNKNOWN) -> DataFrame:
    """``cols`` as strings, nulls read as ``fill``, as the wide form reads them."""
    return df.withColumns({c: level_value(c, fill) for c in cols})


def index_column(col: str) -> str:
    return f"{col}__index"


def vector_column(col: str) -> str:
    return f"{col}__vector"


def vector_stages(cols) -> list:
    """E1, vector form: pipeline stages that give each column (without nulls) the position of its level in
    alphabetical order and a sparse 0/1 vector of all levels; a level not seen in fitting has a slot of its own at
    the end."""
    cols = list(cols)
    index, vector = [index_column(c) for c in cols], [vector_column(c) for c in cols]
    return [StringIndexer(inputCols=cols, outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=index, outputCols=vector, dropLast=False)]


def onehot_capped(col: str, levels, width: int, fill: str = UNKNOWN) -> Column:
    """Fixed-width 0/1 array over the first ``width`` levels; others -> all zeros."""
    v = level_value(col, fill)
    items = [(v == F.lit(levels[i])).cast("int") if i < len(levels) else F.lit(0) for i in range(width)]
    return F.array(*items)


def level_table(spark, levels) -> DataFrame:
    """E3 dimension: level -> one-hot array of width len(levels)."""
    n = len(levels)
    rows = [(lvl, [1 if j == i else 0 for j in range(n)]) for i, lvl in enumerate(levels)]
    schema = T.StructType([T.StructField("level", T.StringType()),
                           T.StructField("onehot", T.ArrayType(T.IntegerType()))])
    return spark.createDataFrame(rows, schema)


def onehot_map_join(df: DataFrame, col: str, levels, out: str = "onehot") -> DataFrame:
    """Attach the one-hot array by a join with the level table.

    The level table is bounded by ``MAX_LEVELS`` (checked at fit), so it is
    broadcast; unseen levels get a null array (left join).
    """
    if len(levels) > MAX_LEVELS:
        raise ValueError("too many levels to broadcast")
    dim = F.broadcast(level_table(df.sparkSession, levels).withColumnRenamed("onehot", out))
    return df.join(dim, df[col] == dim["level"], "left").drop("level")
