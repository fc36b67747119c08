"""Splits, folds, kNN/SMOTE and metrics against brute force on small frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from responsekit.operators import evaluate as V
from responsekit.operators.sampling import (class_weights, imbalance_ratio, kfold_assign, random_split,
                                            stratified_split)
from responsekit.operators.smote import knn_exact, smote


def _labelled(spark, n=200, pos_every=7):
    return spark.createDataFrame([(i, int(i % pos_every == 0)) for i in range(n)], "ID long, Target long")


def test_stratified_split_exact_sizes_and_repeatable(spark):
    df = _labelled(spark, 203)
    a = stratified_split(df, fraction=0.3).collect()
    b = stratified_split(df.repartition(5), fraction=0.3).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    for y in (0, 1):
        n_y = sum(1 for r in a if r["Target"] == y)
        assert sum(r["is_valid"] for r in a if r["Target"] == y) == math.ceil(0.3 * n_y)


def test_folds_disjoint_and_balanced(spark):
    df = _labelled(spark, 211)
    rows = kfold_assign(df, k=5).collect()
    assert len({r["ID"] for r in rows}) == 211
    for y in (0, 1):
        sizes = np.bincount([r["fold"] for r in rows if r["Target"] == y], minlength=5)
        assert sizes.max() - sizes.min() <= 1


def test_random_split_fraction(spark):
    rows = random_split(spark.range(5000).withColumnRenamed("id", "ID"), 0.2).collect()
    assert abs(sum(r["is_valid"] for r in rows) / 5000 - 0.2) < 0.03


def test_class_weights():
    c = {0: 90, 1: 10}
    assert class_weights(c, "Balanced") == {0: 1.0, 1: 9.0}
    assert class_weights(c, "SqrtBalanced")[1] == pytest.approx(3.0)
    assert imbalance_ratio(c) == pytest.approx(10 / 90)


def _scores(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(400) < 0.3).astype(int)
    p = np.round(np.clip(0.3 * y + rng.random(400) * 0.7, 0, 1), 2)  # many ties, exact 0.xx values
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y long, p double"), y, p


def _auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    s = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


@pytest.mark.parametrize("buckets", [1, 4, 1000])
def test_auc_exact_tie_aware(spark, buckets):
    df, y, p = _scores(spark)
    assert V.auc_exact(df, buckets=buckets).first()["auc"] == pytest.approx(_auc(y, p))


def test_sweeps_match_brute_force(spark):
    df, y, p = _scores(spark)
    f1 = {round(r["threshold"], 2): r for r in V.f1_sweep(df).collect()}
    for k in range(10, 90, 5):
        t = k / 100
        pred = (p > t).astype(int)
        tp, fp, fn = int(((pred == 1) & (y == 1)).sum()), int(((pred == 1) & (y == 0)).sum()), int(((pred == 0) & (y == 1)).sum())
        prec = tp / (tp + fp) if tp + fp else 0.0
        rec = tp / (tp + fn) if tp + fn else 0.0
        want = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        assert f1[t]["tp"] == tp and f1[t]["f1"] == pytest.approx(want)
    acc = {round(r["threshold"], 2): r["accuracy"] for r in V.accuracy_sweep(df).collect()}
    for k in range(10, 90):
        t = k / 100
        assert acc[t] == pytest.approx(float(((p >= t).astype(int) == y).mean()))


def test_class_report_and_log_loss(spark):
    df, y, p = _scores(spark)
    s = df.withColumn("pred", V.label_threshold(F.col("p"), 0.5))
    rep = {r["label"]: r for r in V.class_report(s).collect()}
    pred = (p >= 0.5).astype(int)
    tp = ((pred == 1) & (y == 1)).sum()
    assert rep["1"]["precision"] == pytest.approx(tp / pred.sum())
    assert rep["accuracy"]["f1"] == pytest.approx((pred == y).mean())
    q = np.clip(p, 1e-15, 1 - 1e-15)
    ll = -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean()
    assert V.log_loss(df).first()["log_loss"] == pytest.approx(ll)


def _brute_knn(X, ids, k):
    out = {}
    for i in range(len(X)):
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        order = sorted((d[j], ids[j]) for j in range(len(X)) if j != i)[:k]
        out[ids[i]] = [b for _, b in order]
    return out


def test_knn_exact_multi_block(spark):
    rng = np.random.default_rng(5)
    X = np.vstack([rng.normal(size=(150, 3)), np.zeros((20, 3)), rng.normal(5, 1, size=(30, 3))])  # duplicates too
    ids = list(range(len(X)))
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in zip(ids, X)], "ID long, a double, b double, c double")
    got = knn_exact(df, ["a", "b", "c"], k=5, block_size=16).collect()
    by = {}
    for r in got:
        by.setdefault(r["ID"], []).append((r["nb_rank"], r["nb_id"], r["dist"]))
    want = _brute_knn(X, ids, 5)
    for i in ids:
        ranked = sorted(by[i])
        dists = [d for _, _, d in ranked]
        want_d = sorted(np.sqrt(((X - X[i]) ** 2).sum(axis=1))[[j for j in want[i]]])
        assert np.allclose(dists, want_d)
        assert [n for _, n, _ in ranked] == want[i]


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(9)
    X = rng.normal(size=(120, 2))
    y = [1 if i < 20 else 0 for i in range(120)]
    df = spark.createDataFrame([(i, float(a), float(b), t) for i, ((a, b), t) in enumerate(zip(X, y))],
                               "ID long, a double, b double, Target long")
    syn = smote(df, ["a", "b"], k=5).collect()
    # classes end equal: 20 minority + 80 synthetic = 100 majority
    assert len(syn) == y.count(0) - y.count(1) == 80
    for r in syn:
        s = np.array([r["a"], r["b"]])
        x0, x1 = X[r["source_id"]], X[r["nb_id"]]
        seg = x1 - x0
        lam = float(np.dot(s - x0, seg) / np.dot(seg, seg)) if np.dot(seg, seg) else 0.0
        assert -1e-9 <= lam <= 1 + 1e-9 and np.allclose(x0 + lam * seg, s)
        assert y[r["source_id"]] == 1 and y[r["nb_id"]] == 1


def test_cap_takes_the_most_important():
    from responsekit.operators.selection import cap_top, select_features, select_top
    imp = dict(zip("abcdefgh", [0, 0, 0, 0, .1, .1, .3, .5]))
    top = select_top(imp, 0.5, 0)
    assert top == ["e", "f", "g", "h"] and cap_top({c: imp[c] for c in top}, 2) == ["g", "h"]
    assert select_features(lambda cols: {c: imp[c] for c in cols}, list("abcdefgh"), "rfe", 0.25, 0) == ["g", "h"]
    with pytest.raises(ValueError):
        select_features(lambda cols: imp, list("abcdefgh"), "rfecv")


def test_auc_and_sweeps_without_a_class(spark):
    one = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, p double")
    r = V.auc_exact(one).first()
    assert r["auc"] is None and (r["n_pos"], r["n_neg"]) == (2, 0)
    none = one.limit(0)
    assert V.auc_exact(none).first()["auc"] is None
    assert {r["accuracy"] for r in V.accuracy_sweep(none).collect()} == {0.0}
    gain = V.accuracy_gain(V.accuracy_sweep(one)).first()
    assert (gain["threshold"], gain["accuracy"], gain["accuracy_at_half"], gain["gain"]) == (0.1, 1.0, 0.5, 0.5)


def test_null_labels_split_and_fold(spark):
    from responsekit.operators.sampling import kfold_assign, require_unique_ids, stratified_split
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 2) for i in range(90)], "ID long, Target long")
    got = {r["Target"]: r["n"] for r in stratified_split(df, fraction=0.3).where("is_valid = 1").groupBy("Target").agg(F.count("*").alias("n")).collect()}
    assert got == {None: 9, 0: 9, 1: 9}
    folds = kfold_assign(df, k=3).groupBy("Target", "fold").agg(F.count("*").alias("n")).collect()
    assert {r["n"] for r in folds} == {10} and len(folds) == 9
    require_unique_ids(df)
    for bad in (df.union(df.limit(1)), spark.createDataFrame([(None, 1)], "ID long, Target long")):
        with pytest.raises(ValueError):
            require_unique_ids(bad)


@pytest.mark.parametrize("n_min", [1, 2, 3, 5, 6, 7])
def test_smote_small_minority_gets_all_rows(spark, n_min):
    from responsekit.operators.sampling import kfold_assign
    from responsekit.operators.smote import oversample
    df = spark.createDataFrame([(10 * i, float(i), float(i * i % 7), int(i < n_min)) for i in range(40)], "ID long, a double, b double, Target long")
    rows = oversample(df, ["a", "b"]).collect()
    assert sum(r["Target"] for r in rows) == 40 - n_min and len({r["ID"] for r in rows}) == len(rows) == 2 * (40 - n_min)
    assert {r["ID"] for r in rows if r["ID"] <= 390} == {10 * i for i in range(40)}
    again = oversample(df.repartition(5), ["a", "b"])
    assert sorted(again.collect()) == sorted(rows)
    assert kfold_assign(again, k=4).where("fold is null").count() == 0


def test_median_of_hot_values(spark):
    from responsekit.operators.fill import fit_medians
    rng = np.random.default_rng(2)
    cols = {"flag": rng.integers(0, 2, 4001).astype(float), "hot": np.where(rng.random(4001) < 0.95, 7.0, rng.random(4001) * 20),
            "free": rng.random(4001), "even": np.r_[np.zeros(2000), np.ones(2000), np.nan], "none": np.full(4001, np.nan)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cols.values())], ", ".join(f"{c} double" for c in cols))
    got = fit_medians(df, list(cols))
    assert got.pop("none") is None
    assert got == {c: pytest.approx(float(np.nanmedian(cols[c]))) for c in got}


def test_correlation_is_pairwise(spark):
    from responsekit.operators.selection import correlation_long
    rng = np.random.default_rng(4)
    a, b = rng.random(30), rng.random(30)
    c = np.where(np.arange(30) < 27, None, rng.random(30))
    df = spark.createDataFrame([(float(x), float(y), None if z is None else float(z)) for x, y, z in zip(a, b, c)], "a double, b double, c double")
    got = {(x, y): r for x, y, r in correlation_long(df, ["a", "b", "c"])}
    assert got["a", "b"] == pytest.approx(abs(np.corrcoef(a, b)[0, 1]))
    m = np.arange(30) >= 27
    assert got["a", "c"] == pytest.approx(abs(np.corrcoef(a[m], c[m].astype(float))[0, 1]))


def test_kmeans_and_pca_keep_rows_with_nulls(spark):
    from responsekit.operators.advanced import fit_kmeans, fit_pca
    rng = np.random.default_rng(6)
    rows = [(float(x), float(y), None, None if x < 0.5 else float(x + y)) for x, y in rng.random((60, 2))]
    df = spark.createDataFrame(rows, "a double, b double, c double, e double")
    assert len(fit_kmeans(df, ["a", "b", "c", "e"], 2, n_init=2).centres) == 2
    assert fit_pca(df, ["a", "b", "c", "e"], 2).variance_ratio


def test_submission_agreement(spark):
    a = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "ID long, Target int")
    b = spark.createDataFrame([(3, 1), (1, 1), (9, 0)], "ID long, Target int")
    r = V.submission_agreement({"a": a, "b": b}).collect()
    assert [(x["sub_a"], x["sub_b"], x["agreement"], x["n"]) for x in r] == [("a", "b", 0.5, 2)]


def test_nearest_of_a_cell_against_brute_force(monkeypatch):
    """the rows of a cell are measured together, a few at a time; equal distances go by id."""
    import numpy as np
    import pandas as pd
    from responsekit.operators import lsh
    monkeypatch.setattr(lsh, "ROWS_AT_ONCE", 7)
    rng = np.random.default_rng(5)
    x, ids = rng.integers(0, 3, (60, 3)).astype(float), rng.permutation(1000)[:60]
    found = lsh._nearest(20)(pd.DataFrame({"id": ids, "v": list(x)}))
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for r in range(60):
        mine = found[found["id"] == ids[r]]
        # more points than are looked at lie at the last distance, so only the distances are unique there
        assert np.array_equal(np.sort(mine["dist"]), np.sort(np.delete(dist[r], r))[:20])
        assert all(dist[r, np.flatnonzero(ids == o)[0]] == d for o, d in zip(mine["nb_id"], mine["dist"])) and ids[r] not in set(mine["nb_id"])
    assert len(lsh._nearest(5)(pd.DataFrame({"id": ids[:1], "v": list(x[:1])}))) == 0


@pytest.mark.parametrize("limited", [False, True])
def test_search_equals_brute_force(limited):
    """Leaves that are passed over and matrix products change no neighbour, distance or tie."""
    from responsekit.operators.smote import search
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(400, 4)) * [1, 100, 1e4, 1e6], -1)
    x[50:90] = x[10]
    ids = rng.permutation(400).astype(np.int64) // 2  # ids occur twice: a row is no neighbour of its own id
    limit = np.abs(rng.normal(size=200)) * 1e6 if limited else np.full(200, np.inf)
    want = []
    for i in range(200):
        d = np.sqrt(((x[100:] - x[i]) ** 2).sum(axis=1))
        j = np.flatnonzero((ids[100:] != ids[i]) & (d <= limit[i]))
        want += [(ids[i], ids[100 + c], d[c]) for c in j[np.lexsort((ids[100 + j], d[j]))[:5]]]
    found = search(x[:200], ids[:200], x[100:], ids[100:], 5, 16, limit if limited else None)
    assert sorted(zip(*found)) == sorted(want)


def test_synthetic_rows_do_not_depend_on_a_limit_of_rows(spark, monkeypatch):
    """A minority of any size is interpolated towards its exact neighbours."""
    from responsekit.operators import lsh
    monkeypatch.setattr(lsh.knn, "__defaults__", (5, "ID", 20))
    monkeypatch.setattr(lsh, "CELL", 4)
    monkeypatch.setattr(lsh.knn_lsh, "__defaults__", (5, "ID", 1, 4, 42))  # one table of small cells misses neighbours
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, float(a), float(b), int(i < 60)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))],
                               "ID long, a double, b double, Target long")
    exact = knn_exact(df.where("Target = 1"), ["a", "b"])
    want = {tuple(r) for r in smote(df, ["a", "b"], neighbours=exact).collect()}
    assert {tuple(r) for r in smote(df, ["a", "b"]).collect()} == want and len(want) == 80
