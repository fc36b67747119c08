"""Evaluation (V1-V8) as distributed aggregates.

Every metric is one or two aggregation jobs whose outputs are tiny
(confusion counts, a score histogram, per-bucket negatives), so nothing
grows with the number of scored rows except the map-side partial
aggregates.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from responsekit.catalog import ACC_THRESHOLDS_PCT, F1_THRESHOLDS_PCT

Y, P, PRED = "y", "p", "pred"


def label_threshold(p, t: float, strict: bool = False):
    """1 when p >= t (or p > t when ``strict``); NaN/null -> 0."""
    c = (p > F.lit(float(t))) if strict else (p >= F.lit(float(t)))
    return F.coalesce(F.when(~F.isnan(p), c), F.lit(False)).cast("int")


def confusion_counts(df: DataFrame, y: str = Y, pred: str = PRED) -> DataFrame:
    """One row: tp, fp, fn, tn (conditional sums, map-side combined)."""
    yy, pp = F.col(y), F.col(pred)
    return df.agg(F.sum(((yy == 1) & (pp == 1)).cast("long")).alias("tp"),
                  F.sum(((yy == 0) & (pp == 1)).cast("long")).alias("fp"),
                  F.sum(((yy == 1) & (pp == 0)).cast("long")).alias("fn"),
                  F.sum(((yy == 0) & (pp == 0)).cast("long")).alias("tn"))


def confusion(df: DataFrame, y: str = Y, pred: str = PRED) -> DataFrame:
    """V4: counts per (true, predicted)."""
    return df.groupBy(F.col(y).alias("true_label"), F.col(pred).alias("predicted")).agg(F.count("*").alias("n"))


def accuracy(df: DataFrame, y: str = Y, pred: str = PRED) -> DataFrame:
    """V1."""
    return df.agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.count("*").alias("n"))


def _div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_report(df: DataFrame, y: str = Y, pred: str = PRED) -> DataFrame:
    """V3: per-class precision/recall/F1/support, accuracy, macro and weighted averages."""
    c = confusion_counts(df, y, pred)
    tp, fp, fn, tn = (F.col(k).cast("double") for k in ("tp", "fp", "fn", "tn"))
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1 = _div(2 * p1 * r1, p1 + r1)
    f0 = _div(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    n = s1 + s0
    m = c.select(p0.alias("p0"), r0.alias("r0"), f0.alias("f0"), s0.alias("s0"),
                 p1.alias("p1"), r1.alias("r1"), f1.alias("f1"), s1.alias("s1"), n.alias("n"),
                 _div(tp + tn, n).alias("acc"))

    def row(label, pr, rc, f, s):
        return F.struct(F.lit(label).alias("label"), pr.cast("double").alias("precision"),
                        rc.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        s.cast("long").alias("support"))
    col = F.col
    rows = F.array(
        row("0", col("p0"), col("r0"), col("f0"), col("s0")),
        row("1", col("p1"), col("r1"), col("f1"), col("s1")),
        row("accuracy", F.lit(None), F.lit(None), col("acc"), col("n")),
        row("macro avg", (col("p0") + col("p1")) / 2, (col("r0") + col("r1")) / 2, (col("f0") + col("f1")) / 2,
            col("n")),
        row("weighted avg", _div(col("p0") * col("s0") + col("p1") * col("s1"), col("n")),
            _div(col("r0") * col("s0") + col("r1") * col("s1"), col("n")),
            _div(col("f0") * col("s0") + col("f1") * col("s1"), col("n")), col("n")))
    return m.select(F.explode(rows).alias("r")).select("r.*")


def log_loss(df: DataFrame, y: str = Y, p: str = P, eps: float = 1e-15) -> DataFrame:
    """V7: mean binary cross-entropy with clamped probabilities."""
    q = F.least(F.greatest(F.col(p).cast("double"), F.lit(eps)), F.lit(1 - eps))
    yy = F.col(y).cast("double")
    return df.agg(F.avg(-(yy * F.log(q) + (1 - yy) * F.log(1 - q))).alias("log_loss"))


def auc_exact(df: DataFrame, y: str = Y, p: str = P, buckets: int = 1000) -> DataFrame:
    """V2: tie-aware ROC AUC (Mann-Whitney), exact, without a global sort.

    Distinct scores are cut into ``buckets`` quantile ranges; negatives below
    each bucket come from a prefix over bucket totals (bounded table), and
    negatives below a score inside its bucket from a window per bucket.
    """
    d = df.groupBy(F.col(p).cast("double").alias("s")).agg(
        F.sum((F.col(y) == 1).cast("long")).alias("pos"), F.sum((F.col(y) == 0).cast("long")).alias("neg"))
    qs = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(d.approxQuantile("s", qs, 1.0 / (4 * buckets)))) if qs else []
    if cuts:
        splits = [float("-inf")] + cuts + [float("inf")]
        b = Bucketizer(splits=splits, inputCol="s", outputCol="bucket", handleInvalid="keep").transform(d)
    else:
        b = d.withColumn("bucket", F.lit(0.0))
    totals = {int(r["bucket"]): (r["bneg"], r["bpos"]) for r in
              b.groupBy("bucket").agg(F.sum("neg").alias("bneg"), F.sum("pos").alias("bpos")).collect()}
    before, acc = {}, 0
    for k in sorted(totals):
        before[k] = acc
        acc += totals[k][0]
    n_neg = acc
    n_pos = sum(v[1] for v in totals.values())
    pre = F.create_map(*[x for k, v in before.items() for x in (F.lit(float(k)), F.lit(v))]) if before else None
    w = Window.partitionBy("bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("neg").over(w), F.lit(0))
    below = (pre[F.col("bucket")] if pre is not None else F.lit(0)) + inner
    return (b.withColumn("below", below)
            .agg(F.try_divide(F.sum(F.col("pos") * (F.col("below") + 0.5 * F.col("neg"))),
                              F.lit(float(n_pos) * float(n_neg))).alias("auc"),  # null if a class is missing
                 F.lit(n_pos).alias("n_pos"), F.lit(n_neg).alias("n_neg")))


def auc_by_group(df: DataFrame, group: str, p: str = P, y: str = Y, buckets: int = 1024) -> DataFrame:
    """V2 for many score columns at once, laid out long: (group, auc), null where a class is missing.

    Exact with ties. Equal scores of a group are added up first; ``buckets`` ranges between a group's smallest and
    largest score then bound the windows: one runs over the bucket totals of a group, one inside each bucket."""
    same = df.groupBy(group, F.col(p).alias("s")).agg(F.sum((F.col(y) == 1).cast("long")).alias("pos"),
                                                      F.sum((F.col(y) == 0).cast("long")).alias("neg"))
    ends = df.groupBy(group).agg(F.min(p).alias("lo"), F.max(p).alias("hi"))
    cut = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("s") - F.col("lo")) / (F.col("hi") - F.col("lo")) * buckets)).otherwise(0)
    placed = same.join(ends, group).select(group, "s", "pos", "neg", cut.cast("int").alias("bucket"))
    before = Window.partitionBy(group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (placed.groupBy(group, "bucket").agg(F.sum("neg").alias("n")).select(
        group, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy(group, "bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("below", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(totals, [group, "bucket"])
    area = F.sum(F.col("pos") * (F.col("base") + F.col("below") + 0.5 * F.col("neg")))
    return ranked.groupBy(group).agg(F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def _grid(spark: SparkSession, pcts) -> DataFrame:
    return spark.createDataFrame([(int(k),) for k in pcts], "k int")


def _floor_pct(p):
    """Largest integer k with k/100 <= p, exact at the boundaries."""
    k0 = F.floor(p * 100)
    k1 = F.when(k0 / 100.0 > p, k0 - 1).otherwise(k0)
    return F.when((k1 + 1) / 100.0 <= p, k1 + 1).otherwise(k1)


def _ceil_pct(p):
    """Smallest integer k with k/100 >= p, exact at the boundaries."""
    c0 = F.ceil(p * 100)
    c1 = F.when((c0 - 1) / 100.0 >= p, c0 - 1).otherwise(c0)
    return F.when(c1 / 100.0 < p, c1 + 1).otherwise(c1)


def _counts_at(spark, df, y, bucket_expr, pcts, shift: int):
    """For each threshold k: positives/negatives with bucket >= k + shift, and the class totals.

    The score histogram has at most 104 buckets (-1..102); it is laid on a
    full bucket grid so every step is an equi-join or a window over that
    bounded grid.
    """
    b = F.least(F.greatest(bucket_expr, F.lit(-1)), F.lit(102)).cast("int")
    h = df.groupBy(b.alias("bucket")).agg(
        F.sum((F.col(y) == 1).cast("long")).alias("pos"), F.sum((F.col(y) == 0).cast("long")).alias("neg"))
    grid = spark.range(-1, 103).select(F.col("id").cast("int").alias("bucket"))
    full = grid.join(h, "bucket", "left").fillna(0, ["pos", "neg"])
    suffix = Window.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(1))
    suf = full.select((F.col("bucket") - F.lit(shift)).alias("k"),
                      F.sum("pos").over(suffix).alias("pp"), F.sum("neg").over(suffix).alias("np"),
                      F.sum("pos").over(everything).alias("P"), F.sum("neg").over(everything).alias("N"))
    return _grid(spark, pcts).join(suf, "k", "left")


def f1_sweep(df: DataFrame, y: str = Y, p: str = P, pcts=F1_THRESHOLDS_PCT) -> DataFrame:
    """V5: F1 of ``p > t`` for t = k/100."""
    spark = df.sparkSession
    c = _counts_at(spark, df, y, _ceil_pct(F.col(p).cast("double")), pcts, shift=1)
    tp, fp = F.col("pp").cast("double"), F.col("np").cast("double")
    fn = F.col("P") - F.col("pp")
    prec, rec = _div(tp, tp + fp), _div(tp, tp + fn)
    return c.select((F.col("k") / 100.0).alias("threshold"), F.col("pp").alias("tp"), F.col("np").alias("fp"),
                    fn.cast("long").alias("fn"), prec.alias("precision"), rec.alias("recall"),
                    _div(2 * prec * rec, prec + rec).alias("f1"))


def accuracy_sweep(df: DataFrame, y: str = Y, p: str = P, pcts=ACC_THRESHOLDS_PCT) -> DataFrame:
    """V6: accuracy of ``p >= t`` for t = k/100."""
    spark = df.sparkSession
    c = _counts_at(spark, df, y, _floor_pct(F.col(p).cast("double")), pcts, shift=0)
    correct = F.col("pp") + (F.col("N") - F.col("np"))
    return c.select((F.col("k") / 100.0).alias("threshold"), correct.cast("long").alias("correct"),
                    _div(correct, F.col("P") + F.col("N")).alias("accuracy"))


def best_threshold(sweep: DataFrame, metric: str) -> tuple[float, float]:
    """First maximum (lowest threshold among ties), from a bounded sweep table."""
    r = sweep.orderBy(F.col(metric).desc_nulls_last(), F.col("threshold").asc()).first()
    if r is None or r[metric] is None:  # nothing to choose by
        return 0.5, 0.0
    return float(r["threshold"]), float(r[metric])


def submission_agreement(submissions: dict[str, DataFrame], id_col: str = "ID", label: str = "Target") -> DataFrame:
    """Share of equal labels for every pair of submissions, over the ids both have: one shuffle for all pairs."""
    names = list(submissions)
    long = None
    for name, df in submissions.items():
        part = df.select(F.col(id_col).alias("id"), F.lit(name).alias("name"), F.col(label).alias("label"))
        long = part if long is None else long.unionByName(part)
    wide = long.groupBy("id").agg(*[F.max(F.when(F.col("name") == n, F.col("label"))).alias(f"l{k}") for k, n in enumerate(names)])
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1, len(names))]
    both = {p: F.col(f"l{p[0]}") == F.col(f"l{p[1]}") for p in pairs}
    row = wide.agg(*[x for i, j in pairs for x in (F.avg(both[i, j].cast("double")).alias(f"a{i}_{j}"),
                                                   F.count(both[i, j]).alias(f"n{i}_{j}"))])
    cells = F.array(*[F.struct(F.lit(names[i]).alias("sub_a"), F.lit(names[j]).alias("sub_b"),
                               F.col(f"a{i}_{j}").alias("agreement"), F.col(f"n{i}_{j}").alias("n")) for i, j in pairs])
    return row.select(F.explode(cells).alias("r")).select("r.*")


def submission_matrix(rows: DataFrame, id_col: str = "ID", label: str = "Target", name: str = "name") -> DataFrame:
    """P8 for any number of submissions laid out long: (sub_a, sub_b, agreement, n) for every pair, over the ids both
    have. One shuffle by id brings an id's labels together (as many as there are submissions); pairs are made from
    that row and pre-aggregated."""
    each = rows.where(F.col(label).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.array_sort(F.collect_set(F.struct(F.col(name).alias("name"), F.col(label).alias("label")))).alias("s"))
    pairs = F.expr("""flatten(transform(sequence(1, size(s) - 1), i -> transform(slice(s, i + 1, size(s)), b ->
        struct(s[i - 1].name AS sub_a, b.name AS sub_b, cast(s[i - 1].label = b.label AS double) AS same))))""")
    return (each.where(F.size("s") > 1).select(F.explode(pairs).alias("p")).groupBy("p.sub_a", "p.sub_b")
            .agg(F.avg("p.same").alias("agreement"), F.count("*").alias("n")))


def accuracy_gain(sweep: DataFrame) -> DataFrame:
    """V6: best threshold of an accuracy sweep, its accuracy, and the gain over the threshold 0.5."""
    best = F.max_by(F.struct("threshold", "accuracy"), F.struct("accuracy", -F.col("threshold")))
    half = F.max(F.when(F.col("threshold") == 0.5, F.col("accuracy")))
    return sweep.agg(best.alias("b"), half.alias("half")).select(
        F.col("b.threshold").alias("threshold"), F.col("b.accuracy").alias("accuracy"),
        F.col("half").alias("accuracy_at_half"), (F.col("b.accuracy") - F.col("half")).alias("gain"))

