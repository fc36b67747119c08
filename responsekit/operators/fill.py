"""Median fill.

``fit_medians`` returns exact medians (the mean of the two middle values for
an even count, as pandas does) without gathering a column in one task:

1. one pass of mergeable ``percentile_approx`` sketches gives, per column, a
   narrow value band [lo, hi] that must contain the middle ranks;
2. one aggregate counts, per column, the values below the band and in it. A
   band of one value (``lo == hi``) is the median itself;
3. the rows of the other bands are counted by value, and a prefix sum over
   the different values of a column (not its rows) finds the middle ranks.
If a band turns out not to contain the middle ranks (sketch error larger than
assumed) it is widened and retried for those columns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from responsekit.functions.advanced import d

ACCURACY = 10000


def _as_double(c: str) -> Column:
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)  # NaN is treated as missing, as pandas does


def fit_medians(df: DataFrame, cols, method: str = "exact", accuracy: int = ACCURACY) -> dict[str, float | None]:
    cols = list(cols)
    if not cols:
        return {}
    if method == "approx":
        row = df.agg(*[F.percentile_approx(_as_double(c), 0.5, accuracy).alias(f"m{i}")
                       for i, c in enumerate(cols)]).first()
        return {c: row[f"m{i}"] for i, c in enumerate(cols)}
    delta = 4.0 / accuracy
    result: dict[str, float | None] = {}
    pending = cols
    while pending:
        lo_q, hi_q = max(0.0, 0.5 - delta), min(1.0, 0.5 + delta)
        aggs = []
        for i, c in enumerate(pending):
            aggs += [F.count(_as_double(c)).alias(f"n{i}"),
                     F.percentile_approx(_as_double(c), [lo_q, hi_q], accuracy).alias(f"q{i}")]
        row = df.agg(*aggs).first()
        bounds = {}
        for i, c in enumerate(pending):
            n = row[f"n{i}"]
            if not n:
                result[c] = None
                continue
            lo, hi = row[f"q{i}"]
            if lo_q == 0.0:
                lo = float("-inf")
            if hi_q == 1.0:
                hi = float("inf")
            bounds[c] = (n, lo, hi)
        if not bounds:
            break
        got = _band_medians(df, bounds)
        retry = []
        for c in bounds:
            if got.get(c) is None:
                retry.append(c)
            else:
                result[c] = got[c]
        pending = retry
        delta *= 8
    return result


def _band_medians(df: DataFrame, bounds) -> dict[str, float]:
    """Medians of the columns whose middle ranks lie in their band (column -> (count, lo, hi))."""
    cols = list(bounds)
    v = {c: _as_double(c) for c in cols}
    aggs = []
    for i, c in enumerate(cols):
        _, lo, hi = bounds[c]
        aggs += [F.count(F.when(v[c] < F.lit(lo), 1)).alias(f"b{i}"),
                 F.count(F.when((v[c] >= F.lit(lo)) & (v[c] <= F.lit(hi)), 1)).alias(f"i{i}")]
    row = df.agg(*aggs).first()
    mids, below, out, wide = {}, {}, {}, []
    for i, c in enumerate(cols):
        n, lo, hi = bounds[c]
        mids[c], below[c] = ((n - 1) // 2 + 1, n // 2 + 1), row[f"b{i}"]
        if below[c] < mids[c][0] and mids[c][1] <= below[c] + row[f"i{i}"]:
            if lo == hi:  # every value of the band is the median, however many rows have it
                out[c] = lo
            else:
                wide.append(c)
    if not wide:
        return out
    # the others: rows of the band are counted by value first, so a value that many rows have is one row
    tagged = F.array(*[F.when((v[c] >= F.lit(bounds[c][1])) & (v[c] <= F.lit(bounds[c][2])),
                              F.struct(F.lit(c).alias("name"), v[c].alias("v"))) for c in wide])
    values = (df.select(F.explode(F.filter(tagged, lambda s: s.isNotNull())).alias("s"))
              .groupBy("s.name", "s.v").agg(F.count("*").alias("rows")))
    known = F.create_map(*[x for c in wide for x in (F.lit(c), F.array(F.lit(below[c]), F.lit(mids[c][0]), F.lit(mids[c][1])))])
    upto = Window.partitionBy("name").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (values.withColumn("k", known[F.col("name")]).withColumn("last", F.col("k")[0] + F.sum("rows").over(upto))
              .withColumn("first", F.col("last") - F.col("rows") + 1))
    holds = [F.col("k")[m].between(F.col("first"), F.col("last")) for m in (1, 2)]
    half = F.col("v") * (holds[0].cast("int") + holds[1].cast("int")) / 2
    for r in ranked.where(holds[0] | holds[1]).groupBy("name").agg(F.sum(half).alias("m")).collect():
        out[r["name"]] = r["m"]
    return out


def median_fill(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    """Replace null (and NaN) by the fitted median.

    Floating columns stay double. Whole-number columns keep their type when
    the median is a whole number and become double otherwise (pandas turns a
    column with a missing value into float the same way).
    """
    types = dict(df.dtypes)
    cols = {}
    for c, m in medians.items():
        if m is None or c not in types:
            continue
        ref = "`" + c.replace("`", "``") + "`"
        if types[c] in ("double", "float"):
            e = f"CAST(coalesce(CASE WHEN NOT isnan({ref}) THEN {ref} END, {d(m)}) AS DOUBLE)"
        elif float(m).is_integer():
            e = f"coalesce({ref}, CAST({int(m)} AS {types[c]}))"
        else:
            e = f"coalesce(CAST({ref} AS DOUBLE), {d(m)})"
        cols[c] = F.expr(e)  # SQL text: one JVM call per column
    return df.withColumns(cols) if cols else df
