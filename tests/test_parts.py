"""Log files, submissions, sketches, vector encoding and approximate neighbours."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F


# ---------------------------------------------------------------- S8, V8
def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


@pytest.fixture
def logs(tmp_path):
    root = str(tmp_path)
    write(f"{root}/fold-0", "test_error.tsv", "iter\tAccuracy\tLogloss\n0\t0.5\t0.7\n1\t0.8\t0.4\n2\t0.8\t0.6\n")
    write(f"{root}/fold_1", "test_error.tsv", "iter\tAUC\tLogloss\n0\t0.9\t0.3\n1\t0.7\t0.35\n")
    write(f"{root}/single", "test_error.tsv", "iter\tLogloss\n0\t0.3\n")
    write(f"{root}/fold-2", "test_error.tsv", "iter\tLogloss\tAUC\n0\t0.25\t0.6\n\n1\t\t0.65\n")
    write(f"{root}/empty", "test_error.tsv", "iter\tLogloss\n")
    write(f"{root}/fold-0", "time_left.tsv", "iter\tPassed\tRemaining\n0\t5\t10\n1\t11\t6\n")
    write(f"{root}/fold_1", "learn_error.tsv", "iter\tLogloss\n0\t0.2\n1\t0.1\n2\t0.05\n")
    return root


def test_logs_are_read_by_their_own_headers(spark, logs):
    from responsekit.sources.files import read_training_logs
    df = read_training_logs(spark, f"{logs}/*/test_error.tsv")
    assert df.columns == ["run", "fold", "iter", "AUC", "Accuracy", "Logloss"]
    assert {tuple(r) for r in df.collect()} == {
        ("fold-0", 0, 0, None, 0.5, 0.7), ("fold-0", 0, 1, None, 0.8, 0.4), ("fold-0", 0, 2, None, 0.8, 0.6),
        ("fold_1", 1, 0, 0.9, None, 0.3), ("fold_1", 1, 1, 0.7, None, 0.35), ("single", None, 0, None, None, 0.3),
        ("fold-2", 2, 0, 0.6, None, 0.25), ("fold-2", 2, 1, 0.65, None, None)}


def test_history_and_best_iterations(spark, logs):
    from responsekit.sources.files import best_iterations, training_history
    h = training_history(spark, learn=f"{logs}/*/learn_error.tsv", test=f"{logs}/*/test_error.tsv", time=f"{logs}/*/time_left.tsv")
    rows = {(r["run"], r["iter"]): r for r in h.collect()}
    assert len(rows) == 9  # the learning log of fold_1 has one iteration more
    assert rows["fold_1", 2]["learn_Logloss"] == 0.05 and rows["fold_1", 2]["test_Logloss"] is None
    assert rows["fold-0", 1]["time_Passed"] == 11 and rows["fold-0", 1]["test_Accuracy"] == 0.8
    best = {r["run"]: r for r in best_iterations(h, ["test_Accuracy", "test_AUC"], ["test_Logloss"]).collect()}
    assert best["fold-0"]["best_test_Accuracy"] == 1 and best["fold-0"]["best_test_Logloss"] == 1 and best["fold-0"]["best_test_AUC"] is None
    assert best["fold_1"]["best_test_AUC"] == 0 and best["fold-2"]["best_test_AUC"] == 1 and best["fold-2"]["best_test_Logloss"] == 0


# ---------------------------------------------------------------- P8
def test_submissions_by_file_name(spark, tmp_path):
    from responsekit.operators.evaluate import submission_matrix
    from responsekit.sources.files import read_submissions, write_submission
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 2, (5, 60))
    for k in range(5):  # the last ones lack some ids
        rows = [(i, int(labels[k, i])) for i in range(60) if k < 3 or i % (k + 1)]
        df = spark.createDataFrame(rows, "ID long, Target int")
        if k % 2:
            write_submission(df, str(tmp_path / f"sub_{k}"))
        else:
            write(str(tmp_path / f"f{k}"), f"sub_{k}.csv", "ID,Target\n" + "".join(f"{i},{t}\n" for i, t in rows))
    rows = read_submissions(spark, f"{tmp_path}/*/*.csv")
    assert {r["name"] for r in rows.select("name").distinct().collect()} == {f"sub_{k}" for k in range(5)}
    got = {(r["sub_a"], r["sub_b"]): (r["agreement"], r["n"]) for r in submission_matrix(rows).collect()}
    assert len(got) == 10
    for (a, b), (share, n) in got.items():
        i, j = int(a[-1]), int(b[-1])
        both = [x for x in range(60) if (i < 3 or x % (i + 1)) and (j < 3 or x % (j + 1))]
        assert n == len(both) and abs(share - np.mean([labels[i, x] == labels[j, x] for x in both])) < 1e-12


# ---------------------------------------------------------------- P4
def test_sketches_merge_and_keep_their_bound(spark):
    from responsekit.operators.distinct import column_sketches, distinct_estimates
    df = spark.range(200000).select(F.col("id").alias("a"), (F.col("id") % 1000).cast("string").alias("b"),
                                    F.when(F.col("id") % 3 == 0, F.col("id") % 70000).alias("c"), F.lit(None).cast("int").alias("d"))
    sketches = column_sketches(df.repartition(7), df.columns)
    assert sketches.select("part").distinct().count() == 7
    got = {r["column"]: r["n_distinct"] for r in distinct_estimates(sketches).collect()}
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first()
    assert all(abs(got[c] - exact[c]) <= 0.03 * exact[c] for c in df.columns) and got["d"] == 0
    # parts that come later are merged with those that are stored
    later = column_sketches(spark.range(200000, 260000).select(F.col("id").alias("a")), ["a"], F.lit("later"))
    more = {r["column"]: r["n_distinct"] for r in distinct_estimates(sketches.unionByName(later)).collect()}
    assert abs(more["a"] - 260000) <= 0.03 * 260000


# ---------------------------------------------------------------- E1, vector form
def test_a_hundred_thousand_levels(spark):
    from pyspark.ml.classification import LogisticRegression
    from responsekit.models import boosted as B
    from responsekit.operators.encode import fit_levels, vector_column, with_known_levels
    n = 100_000
    df = spark.range(2 * n).select(F.col("id").alias("ID"), F.format_string("level %06d", F.col("id") % n).alias("c"), (F.col("id") % 10).cast("double").alias("x"),
                                   (F.col("id") % n < n // 2).cast("long").alias("Target"))
    with pytest.raises(ValueError):
        fit_levels(df, "c")
    model = B.fit_pipeline(LogisticRegression(labelCol=B.LABEL, maxIter=5), df, ["x"], ["c"])
    new = spark.createDataFrame([(1, "level 000001", 1.0), (2, "level 099999", 1.0), (3, "never seen", 1.0), (4, None, 1.0)], "ID long, c string, x double")
    out = model.transform(with_known_levels(new, ["c"])).orderBy("ID").collect()
    v = [r[vector_column("c")] for r in out]
    assert [x.size for x in v] == [n + 1] * 4 and [list(x.indices) for x in v] == [[1], [n - 1], [n], [n]]
    p = {r["ID"]: r["p"] for r in B.probability(model, with_known_levels(new, ["c"])).collect()}
    assert p[1] > 0.5 > p[2] and 0 < p[3] < 1


# ---------------------------------------------------------------- B6, large minorities
def clustered(spark, n, d=30, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(4, n // 100), d)) * 3
    x = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, d))
    cols = [f"x{k}" for k in range(d)]
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "ID long, " + ", ".join(f"{c} double" for c in cols)), cols


def test_lsh_recall_and_exact_distances(spark):
    from responsekit.operators.lsh import knn_lsh, recall
    from responsekit.operators.smote import knn_exact
    df, cols = clustered(spark, 1500)
    found, exact = knn_lsh(df, cols, cell=64), knn_exact(df, cols)
    assert recall(found, exact) >= 0.9
    x = {r["ID"]: np.array(r[1:]) for r in df.collect()}
    rows = found.collect()
    assert all(abs(np.linalg.norm(x[r["ID"]] - x[r["nb_id"]]) - r["dist"]) < 1e-9 and r["ID"] != r["nb_id"] for r in rows)
    assert {r["nb_rank"] for r in rows} == {1, 2, 3, 4, 5}


def test_lsh_pairs_grow_with_the_rows(spark):
    from responsekit.operators.lsh import pairs_compared
    pairs = [pairs_compared(*clustered(spark, n, 8), tables=4, cell=64) for n in (500, 1000, 2000)]
    assert pairs[1] < 2.6 * pairs[0] and pairs[2] < 2.6 * pairs[1]  # the square would be 4 times


def test_lsh_odd_tables(spark):
    from responsekit.operators.lsh import knn, knn_lsh
    schema = "ID long, a double, b double"
    equal = spark.createDataFrame([(k, 1.0, 2.0) for k in range(400)], schema)
    rows = knn_lsh(equal, ["a", "b"], cell=32, tables=2).collect()
    assert len(rows) == 2000 and all(r["dist"] == 0 for r in rows)
    assert knn_lsh(equal.limit(0), ["a", "b"]).count() == 0 and knn_lsh(equal.limit(1), ["a", "b"]).count() == 0
    df, cols = clustered(spark, 300, 4)
    small = {tuple(r) for r in knn(df, cols).collect()}
    large = {tuple(r) for r in knn(df, cols, exact_rows=10, cell=512).collect()}  # one cell: exact as well
    assert {(a, b, d) for a, b, _, d in small} == {(a, b, d) for a, b, _, d in large}


def test_smote_of_a_large_minority(spark, monkeypatch):
    from responsekit.operators import lsh
    from responsekit.operators.smote import smote
    monkeypatch.setattr(lsh.knn, "__defaults__", (5, "ID", 50))
    df, cols = clustered(spark, 400, 4)
    df = df.withColumn("Target", (F.col("ID") % 4 == 0).cast("long"))
    rows = smote(df, cols).collect()
    assert len(rows) == 200 and len({r["ID"] for r in rows}) == 200


def test_neighbours_of_training_rows_use_the_trees_above_the_limit(spark, monkeypatch):
    from responsekit.operators import lsh
    from responsekit.plans import registry
    rows = spark.range(120).select(F.col("id").alias("ID"), F.lit(1).alias("Target"), (F.col("id") * 7 % 31).cast("double").alias("z_a"), F.col("id").cast("double").alias("z_b"))
    monkeypatch.setattr(registry, "train_minority_z", lambda *_: (rows, ["z_a", "z_b"]))
    exact = {tuple(r) for r in registry.QUERIES["smote_train_neighbours"](spark, "").collect()}
    asked, own = [], lsh.knn_lsh
    monkeypatch.setattr(lsh, "knn_lsh", lambda *a, **k: asked.append(1) or own(*a, **k))
    monkeypatch.setattr(lsh.knn, "__defaults__", (5, "ID", 50))
    found = {tuple(r) for r in registry.QUERIES["smote_train_neighbours"](spark, "").collect()}
    assert asked and found == exact  # one cell holds these rows: all neighbours are found


def test_order_spend_is_summed_in_whole_units(spark, tmp_path):
    """The sums of an order are longs, so a group of the aggregate is small, and exact to 10^-4."""
    from responsekit.sources.profile import SPEND_BY_TYPE, per_order_spend
    (first, economy), (second, large) = SPEND_BY_TYPE[:2]
    lines = [(1, 1, 9999999999.99, 0.01), (1, 1, 0.01, 0.99), (1, 2, 100.07, 0.05), (1, 3, 5.0, 0.0), (2, 2, None, 0.1), (2, 2, 7.0, 0.1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_extendedprice double, l_discount double").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, economy), (2, large), (3, None)], "p_partkey long, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    spend = per_order_spend(spark, str(tmp_path))
    assert {t for _, t in spend.dtypes} == {"bigint"}
    got = {r["l_orderkey"]: (r[first], r[second]) for r in spend.collect()}
    assert got == {1: (98999999999901 + 1, 950665), 2: (0, 63000)}


def test_orders_are_added_up_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    """The number of tasks that hold sums per order grows with the lines, not with the files or the defaults."""
    from responsekit.sources import profile as P
    spark.createDataFrame([(k % 40 if k % 50 else None, k % 3, 10.0, 0.1) for k in range(200)],
                          "l_orderkey long, l_partkey long, l_extendedprice double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, "ECONOMY") for k in range(3)], "p_partkey long, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(P, "LINES_PER_TASK", max(1, 200 // (cores + 5)))
    spend = P.per_order_spend(spark, str(tmp_path))
    assert spend.rdd.getNumPartitions() == P.order_tasks(spark, str(tmp_path)) > cores
    sums = {r["l_orderkey"]: r["MntWines"] for r in spend.collect()}
    assert sums == {o: 90_000 * sum(1 for k in range(200) if k % 50 and k % 40 == o) for o in range(40) if any(k % 50 and k % 40 == o for k in range(200))}
