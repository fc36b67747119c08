"""Exact per-group rank thresholds without ranking whole groups.

``rank_thresholds`` finds, for each group g and each quantile q, the row of
rank ``ceil(q * n_g)`` under the order (value, tie). A window partitioned by
the group would push a whole class through one task; instead:

1. grouped, mergeable ``percentile_approx`` gives a value band around each
   target rank (one pass);
2. in one query, rows below the band are counted and rows inside it are
   ranked (a window over ~2·δ·n_g rows per group and quantile); the count
   plus the rank inside the band picks the wanted row;
3. a band that misses its rank (sketch error larger than assumed) is
   widened and retried.

The result is a tiny table (groups x quantiles) used as literals.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10000


def hash_u32(*cols, seed: int = 42):
    """Deterministic 32-bit hash: first 8 hex digits of md5('<v1>:<v2>:...:<seed>').

    The same expression is available in DuckDB, so row selection by this hash
    can be checked against SQL.
    """
    parts = []
    for c in cols:
        parts += [F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit(":")]
    parts.append(F.lit(str(seed)))
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("long")


def group_counts(df: DataFrame, group: str) -> dict:
    return {r[group]: r["n"] for r in df.groupBy(group).agg(F.count("*").alias("n")).collect()}


def target_rank(q: float, n: int) -> int:
    return int(math.ceil(q * n))


def rank_thresholds(df: DataFrame, group: str, value: str, tie: str, quantiles,
                    counts: dict | None = None, ranks: dict | None = None) -> dict:
    """{(g, q): (value, tie) of the row with rank ceil(q * n_g)}; rank 0 -> None.

    ``ranks`` may give the exact wanted rank per (g, q) instead of ceil(q * n_g).
    """
    counts = counts if counts is not None else group_counts(df, group)
    quantiles = list(quantiles)
    want = {(g, q): target_rank(q, n) for g, n in counts.items() for q in quantiles}
    if ranks:
        want.update(ranks)
    out = {key: None for key, r in want.items() if r <= 0}
    pending = [key for key, r in want.items() if r > 0]
    delta = 4.0 / ACCURACY
    while pending:
        qs = sorted({q for _, q in pending})
        probes = []
        for q in qs:
            probes += [max(0.0, q - delta), min(1.0, q + delta)]
        rows = df.groupBy(group).agg(F.percentile_approx(F.col(value), probes, ACCURACY).alias("b")).collect()
        bands = {}
        for r in rows:
            for i, q in enumerate(qs):
                lo, hi = r["b"][2 * i], r["b"][2 * i + 1]
                if probes[2 * i] == 0.0:
                    lo = None
                if probes[2 * i + 1] == 1.0:
                    hi = None
                bands[(r[group], q)] = (lo, hi)
        got = _pick_in_bands(df, group, value, tie, {k: bands[k] for k in pending if k in bands},
                             {k: want[k] for k in pending})
        out.update(got)
        pending = [k for k in pending if k not in got]
        delta *= 8
        if delta > 1.0 and pending:
            raise RuntimeError("rank threshold search did not converge")
    return out


def _pick_in_bands(df, group, value, tie, bands, want):
    keys = list(bands)
    if not keys:
        return {}
    tagged = []
    for idx, (g, q) in enumerate(keys):
        lo, hi = bands[(g, q)]
        v = F.col(value)
        in_g = F.col(group).eqNullSafe(F.lit(g))
        below = in_g & (v < F.lit(lo)) if lo is not None else F.lit(False)
        inside = in_g & ((v >= F.lit(lo)) if lo is not None else F.lit(True)) & \
            ((v <= F.lit(hi)) if hi is not None else F.lit(True))
        tagged.append(F.when(below, F.struct(F.lit(idx).alias("k"), F.lit(-1).alias("tag")))
                      .when(inside, F.struct(F.lit(idx).alias("k"), F.lit(0).alias("tag"))))
    ex = (df.select(F.col(value).alias("v"), F.col(tie).alias("t"),
                    F.explode(F.filter(F.array(*tagged), lambda s: s.isNotNull())).alias("s"))
          .select("v", "t", "s.k", "s.tag"))
    # one query: per-band counts below (one row per key, a plan-time bound, so broadcast) are
    # added to the rank inside the band; the wanted global rank is a literal per key
    below = ex.filter("tag = -1").groupBy("k").agg(F.count("*").alias("below"))
    wanted = F.create_map(*[x for idx, key in enumerate(keys) for x in (F.lit(idx), F.lit(want[key]))])
    w = Window.partitionBy("k").orderBy("v", "t")
    picked = (ex.filter("tag = 0").withColumn("rn", F.row_number().over(w))
              .join(F.broadcast(below), "k", "left")
              .filter(F.coalesce(F.col("below"), F.lit(0)) + F.col("rn") == wanted[F.col("k")])
              .select("k", "v", "t").collect())
    # a rank at or below the band's lower edge is not found here and is retried with a wider band
    return {keys[r["k"]]: (r["v"], r["t"]) for r in picked}


def at_or_below(value: str, tie: str, threshold) -> F.Column:
    """(value, tie) <= threshold in lexicographic order; None threshold -> false."""
    if threshold is None:
        return F.lit(False)
    tv, tt = threshold
    return (F.col(value) < F.lit(tv)) | ((F.col(value) == F.lit(tv)) & (F.col(tie) <= F.lit(tt)))
