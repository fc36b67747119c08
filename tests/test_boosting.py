"""The booster, AUC by round, stacking and search: small planted data, both ways of growing trees."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from responsekit.models import boosted as B
from responsekit.models import histboost as H
from responsekit.operators import evaluate as V


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    n, f = 600, 8
    x = rng.normal(size=(n, f)).round(1)
    x[:, 3] = x[:, 3] > 1
    x[:, 4] = 2.0  # a constant
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n) * 0.5) > 0).astype(int)
    rows = [(int(i), int(y[i]), int(i % 4), *[None if k == 5 and i % 7 == 0 else float(v) for k, v in enumerate(x[i])]) for i in range(n)]
    cols = [f"c{k}" for k in range(f)]
    df = spark.createDataFrame(rows, "ID long, Target long, fold int, " + ", ".join(f"{c} double" for c in cols)).repartition(4)
    return df, cols


def same(a: H.Tree, b: H.Tree) -> bool:
    return all((x == y).all() for x, y in ((a.feature, b.feature), (a.cut, b.cut), (a.value, b.value)))


@pytest.mark.parametrize("extra", [{}, dict(rows=0.7, columns=0.7, level_columns=0.6, min_rows=5, l1=0.05, min_gain=0.1)])
def test_blocks_and_levels_give_the_same_trees(planted, extra):
    """A table of one block grows its trees in a task, one of several blocks level by level: the trees are equal."""
    df, cols = planted
    p = H.Params(rate=0.1, depth=3, **extra)
    one = H.Booster(H.prepare(df, cols, "Target", "ID", fold="fold"), p, held_out=1, watch="auc")
    many = H.Booster(H.prepare(df, cols, "Target", "ID", fold="fold", block_rows=70), p, held_out=1, watch="auc")
    assert one.data.blocks == 1 and many.data.blocks > 5
    one.run(3)
    many.run(2)
    many.run(1)
    assert all(same(a, b) for a, b in zip(one.trees, many.trees)) and len(many.trees) == 3
    assert np.allclose(one.curve.test, many.curve.test) and np.allclose(one.curve.learn, many.curve.learn)
    assert np.allclose(one.curve.auc, many.curve.auc)


def test_small_cells_change_no_tree(planted, monkeypatch):
    df, cols = planted
    data, p = H.prepare(df, cols, "Target", "ID"), H.Params(depth=5)
    whole = H.Booster(data, p)
    whole.run(2)
    monkeypatch.setattr(H, "CELLS", 1)  # one node at a time; patched here only, so the block is grown here
    row = data.table.collect()[0].asDict()
    trees = H.advance(H.Block(row, len(cols)), p, data.bins(), 0, 2, None, lambda b: None)
    assert all(same(a, b) for a, b in zip(whole.trees, trees))


def test_a_fit_that_goes_on_is_the_fit_in_one_go(planted):
    df, cols = planted
    data, p = H.prepare(df, cols, "Target", "ID", fold="fold"), H.Params(rate=0.2, depth=3, rows=0.8)
    whole, parts = H.Booster(data, p, held_out=0), H.Booster(data, p, held_out=0)
    whole.run(12)
    for n in (1, 4, 7):
        parts.run(n)
    assert all(same(a, b) for a, b in zip(whole.trees, parts.trees))
    # margins stored, scores of the model, curve and metrics agree
    stored = {r["id"]: r["p"] for r in parts.held_out_scores().collect()}
    scored = {r["ID"]: r["p"] for r in B.probability(parts.model(), df.where("fold = 0")).collect()}
    assert stored.keys() == scored.keys() and all(abs(stored[k] - scored[k]) < 1e-12 for k in stored)
    s = parts.held_out_scores().withColumn("y", F.col("y").cast("long"))
    assert abs(V.log_loss(s).first()["log_loss"] - parts.curve.test[-1]) < 1e-9
    # the best prefix is cut out, not fitted again
    assert all(same(a, b) for a, b in zip(whole.model(5).trees, whole.trees)) and len(whole.model(5).trees) == 5


def test_first_tree_against_brute_force(planted):
    """The root split and leaf values of one round of depth 1, by trying every threshold."""
    df, cols = planted
    data = H.prepare(df, cols, "Target", "ID")
    fit = H.Booster(data, H.Params(rate=1.0, depth=1, l2=2.0))
    fit.run(1)
    pdf = df.toPandas()
    y, best = pdf["Target"].to_numpy(), (0.0, None)
    g, h = 0.5 - y, np.full(len(y), 0.25)

    def worth(m):
        return g[m].sum() ** 2 / (h[m].sum() + 2.0)
    for k, c in enumerate(cols):
        for cut, e in enumerate(data.edges[k]):
            left = (pdf[c] <= e).to_numpy()
            gain = 0.5 * (worth(left) + worth(~left) - worth(np.full(len(y), True)))
            if gain > best[0] + 1e-9:
                best = gain, (k, cut, -g[left].sum() / (h[left].sum() + 2), -g[~left].sum() / (h[~left].sum() + 2))
    t = fit.trees[0]
    assert (t.feature[0], t.cut[0]) == best[1][:2] and abs(t.gain[0] - best[0]) < 1e-4
    assert abs(t.value[1] - best[1][2]) < 1e-5 and abs(t.value[2] - best[1][3]) < 1e-5


def test_patience_and_best_round():
    curve = [0.9, 0.8, 0.85, 0.84, 0.7, 0.75, 0.72, 0.73]
    assert H.patience_ends(curve, "log_loss", 2) == 4 and H.patience_ends(curve, "log_loss", 3) == 8
    assert H.patience_ends(curve, "log_loss", 4) is None
    assert H.best_round(curve, "log_loss") == 4 and H.best_round([0.5, 0.9, 0.9], "auc") == 1


def test_budget_of_steps_does_not_change_the_result(planted, monkeypatch):
    df, cols = planted
    data, p = H.prepare(df, cols, "Target", "ID", fold="fold"), H.Params(rate=0.5, depth=4)
    found = []
    for step in (7, 50):
        monkeypatch.setattr(H, "STEP", step)
        fit = H.Booster(data, p, held_out=2)
        found.append((fit.run_until(200, 10), len(fit.trees), fit.curve.test))
    assert found[0][:2] == found[1][:2] and np.allclose(found[0][2], found[1][2])
    assert found[0][1] - found[0][0] == 10


def test_odd_tables(spark):
    schema = "ID long, Target long, x double"
    one_class = spark.createDataFrame([(k, 1, float(k)) for k in range(30)], schema)
    m = B.fit_rounds(one_class, ["x"], "simple", 3)
    assert all(0.5 < r["p"] <= 1 for r in B.probability(m, one_class).collect())
    constant = spark.createDataFrame([(k, k % 2, 1.0) for k in range(30)], schema)
    assert {round(r["p"], 6) for r in B.probability(B.fit_rounds(constant, ["x"], "simple", 3), constant).collect()} == {0.5}
    nulls = spark.createDataFrame([(k, k % 2, float(k) if k % 2 else None) for k in range(40)], schema)
    p = {r["ID"]: r["p"] for r in B.probability(B.fit_rounds(nulls, ["x"], "simple", 60), nulls).collect()}
    assert len(p) == 40 and all(0 <= v <= 1 for v in p.values())


def test_model_as_json_and_importances(planted):
    df, cols = planted
    m = B.fit_rounds(df, cols, "simple", 10)
    back = H.BoostedModel.from_json(m.to_json())
    a, b = ({r["ID"]: r["p"] for r in B.probability(x, df).collect()} for x in (m, back))
    assert a == b
    imp = B.importances(m)
    assert abs(sum(imp.values()) - 1) < 1e-9 and imp["c4"] == 0 and max(imp, key=imp.get) == "c0"


def test_auc_by_group_is_exact_on_every_round(spark):
    rng = np.random.default_rng(3)
    rows = [(r, float(np.round(rng.random() ** (1 + r % 3), 2 + r % 4)), int(rng.random() < 0.3)) for r in range(6) for _ in range(300)]
    rows += [(6, 0.5, k % 2) for k in range(10)] + [(7, float(k), 1) for k in range(5)]  # all tied; one class
    df = spark.createDataFrame(rows, "round int, p double, y int")
    for buckets in (1, 8, 1024):
        got = {r["round"]: r["auc"] for r in V.auc_by_group(df, "round", buckets=buckets).collect()}
        for r in range(7):
            assert abs(got[r] - V.auc_exact(df.where(F.col("round") == r)).first()["auc"]) < 1e-12
        assert got[7] is None


def test_two_thousand_rounds_plan_and_run(spark):
    """Scores of 2,000 rounds lie long: the plan does not grow with them, and a row per round comes back."""
    import re
    state = spark.range(40).select(F.array([F.lit(float(k % 2)) for k in range(5)]).alias("held_y"), F.col("id"))
    state = state.select("held_y", F.transform(F.sequence(F.lit(0), F.lit(1999)), lambda r: F.transform(
        F.sequence(F.lit(0), F.lit(4)), lambda k: ((r * 7 + k * 13 + F.col("id")) % 101).cast("double"))).alias("scores"))
    table = V.auc_by_group(H.round_scores(state, 0), "round", "score", "y")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange", plan)) < 20 and len(plan) < 60_000
    got = table.collect()
    assert len(got) == 2000 and all(0 <= r["auc"] <= 1 for r in got)
    k = 1234
    want = V.auc_exact(H.round_scores(state, 0).where(F.col("round") == k).select(F.col("score").alias("p"), F.col("y").cast("int").alias("y")))
    assert abs({r["round"]: r["auc"] for r in got}[k] - want.first()["auc"]) < 1e-12


def test_stack_holds_out_folds(planted):
    """Out-of-fold scores come from fits that did not see the fold; a fold's metrics are those of its rows."""
    from responsekit.models.ensemble import fold_metrics, train_stacked
    df, cols = planted
    m = train_stacked(df.drop("fold"), cols[:4], cv=3, max_iter=8)
    table = m.out_of_fold
    assert table.count() == df.count() == table.select("ID").distinct().count()
    got = {(r["fold"], r["model"]): r for r in fold_metrics(table, m.names).collect()}
    assert len(got) == 9
    for (fold, name), r in got.items():
        s = table.where(F.col("fold") == fold).select("Target", F.col(f"p_{name}").alias("p"))
        want = B.validation_metrics(s)
        assert all(math.isclose(want[k], r[k], abs_tol=1e-9) for k in want) and r["n"] == s.count()


def test_search_lists_trials_that_the_clock_stops(planted):
    from responsekit.models.search import random_search
    df, cols = planted
    small = {"maxIter": ("int", 2000, 3000), "stepSize": ("log", 0.001, 0.002), "maxDepth": ("int", 2, 2)}
    tr, va = df.where("fold < 3"), df.where("fold = 3")
    trials, best = random_search(tr, va, cols, n_trials=4, space=small, at_once=2, timeout=6)
    rows = {r["trial"]: r for r in trials.collect()}
    assert set(rows) == {0, 1, 2, 3} and {r["status"] for r in rows.values()} <= {"complete", "stopped", "not started"}
    assert any(r["status"] != "complete" for r in rows.values())
    assert all((r["accuracy"] is None) == (r["status"] == "not started") for r in rows.values())
    assert set(best) == set(small)
    free, _ = random_search(tr, va, cols, n_trials=2, space={**small, "maxIter": ("int", 2, 3)}, at_once=2)
    assert [r["status"] for r in free.collect()] == ["complete"] * 2


@pytest.mark.parametrize("space", ["catboost", "xgboost", "mlp"])
def test_spaces_cover_their_ranges(space):
    import random
    from responsekit.models import search as S
    from responsekit.models.mlp import layers_for
    drawn = [S.sample_params(random.Random(k), S.SPACES[space]) for k in range(300)]
    for p in drawn:
        for k, v in S.SPACES[space].items():
            if v[0] == "choice":
                assert p[k] in v[1]
            elif v[0] == "ratios":
                assert len(p[k]) == p["n_layers"] - 1
                assert all(r in (v[1] if i < p["n_layers"] / 2 else v[2]) for i, r in enumerate(p[k], 1))
                assert min(layers_for(10, **p)[1:-1]) >= 16
            else:
                assert v[1] <= p[k] <= v[2]
    if space == "mlp":
        assert any(2.0 in p["ratios"] for p in drawn)


def test_fits_over_several_blocks_share_jobs(planted):
    """Fits side by side over several blocks: the trees, curves and best rounds of fits on their own over one block."""
    df, cols = planted
    params = [H.Params(rounds=7, rate=0.5, depth=3), H.Params(rounds=9, rate=0.5, depth=2, rows=0.8, columns=0.7, min_rows=4)]
    alone, shared = {}, {}
    for out, block_rows in ((alone, None), (shared, 150)):
        data = H.prepare(df, cols, "Target", "ID", fold="fold", block_rows=block_rows)
        jobs = H.fit_jobs({(k, f): H.Booster(data, p, held_out=f) for k, p in enumerate(params) for f in (0, None)}, None)
        assert len(jobs) == (4 if block_rows is None else 1)
        for job in jobs.values():
            out.update(job())
    for k, (a, _) in alone.items():
        b, _ = shared[k]
        assert len(a.trees) == len(b.trees) and all(same(x, y) for x, y in zip(a.trees, b.trees))
        assert np.allclose(a.curve.learn, b.curve.learn) and np.allclose(a.curve.test, b.curve.test, equal_nan=True)


def test_ninety_thousand_rows_are_one_block(spark):
    """0.1 GB of customers: a round is a part of one task, not a job for each level."""
    df = spark.range(90_000).select(F.col("id").alias("ID"), (F.col("id") % 2).alias("Target"), (F.col("id") % 7).cast("double").alias("x"))
    assert H.prepare(df, ["x"], "Target", "ID").blocks == 1


def test_packed_columns_have_the_sums_of_each():
    rng = np.random.default_rng(5)
    bins = np.array([2, 250, 3, 2, 1, 40, 2, 2, 2, 2, 2, 2, 2, 256, 5])
    b = np.stack([rng.integers(0, k, 40_000) for k in bins]).astype(np.uint8)
    packs, block = H.Packs(bins), type("B", (), {})()
    block.bins, block.n, block.codes = b, b.shape[1], packs.codes(b)
    assert len(packs.columns) < len(bins) and sorted(c for p in packs.columns for c in p) == list(range(len(bins)))
    rows = np.flatnonzero(rng.random(40_000) < 0.9)
    slot, g, h = rng.integers(0, 3, len(rows)), rng.integers(-2 ** 24, 2 ** 24, len(rows)).astype(float), rng.integers(0, 2 ** 22, len(rows)).astype(float)
    columns = np.array([0, 1, 2, 5, 6, 9, 12, 13, 14])
    starts = H.starts_of(bins, columns)
    assert len(rows) * len(columns) <= H.FEW_CELLS
    few = H.node_sums(slot, block, packs, rows, columns, g, h, 3, starts, True)
    limit, H.FEW_CELLS = H.FEW_CELLS, 0
    try:
        assert (H.node_sums(slot, block, packs, rows, columns, g, h, 3, starts, True) == few).all()
    finally:
        H.FEW_CELLS = limit


def test_runs_of_rows_and_joined_blocks_give_the_same_trees(spark, monkeypatch):
    """A table of up to 2^27 cells is one block, binned in many tasks; a task works through it in short runs of rows."""
    from responsekit.models import histboost as H
    assert H.ONE_BLOCK >= 900_000 * 119
    rng = np.random.default_rng(3)
    x = rng.integers(0, 60, (900, 4)).astype(float)
    data = [(k, int(a[0] + a[1] + rng.normal() > 60), *map(float, a)) for k, a in enumerate(x)]
    rows = spark.createDataFrame(data, "ID long, Target int, a double, b double, c double, d double").repartition(5)

    def trees():
        table = H.prepare(rows, ["a", "b", "c", "d"], "Target", "ID")
        fit = H.Booster(table, H.Params(rounds=4, depth=4, rows=0.8, min_rows=3))
        fit.run(4)
        [held] = table.table.collect()
        here = {}
        for run in (H.RUN, 100):  # patched in this process only, so the block is grown here
            with monkeypatch.context() as m:
                m.setattr(H, "RUN", run)
                m.setattr(H, "FEW_CELLS", 0)
                here[run] = [t.pack() for t in H.advance(H.Block(held.asDict(), 4), fit.params, table.bins(), 0, 4, None, lambda b: None)]
        assert here[100] == here[H.RUN] == [t.pack() for t in fit.trees]
        return table.blocks, sorted(np.frombuffer(held["id"], np.int64)), here[100]

    whole = trees()
    monkeypatch.setattr(H, "BLOCK_ROWS", 64)
    own, asked = H.materialize, []
    monkeypatch.setattr(H, "materialize", lambda df: asked.append(1) or own(df))
    joined = trees()
    assert len(asked) == 3  # the binned parts, the block, the step
    assert whole == joined
    assert whole[0] == 1 and whole[1] == list(range(900))


def test_columns_that_follow_from_others_need_no_count_of_their_own():
    r = np.random.default_rng(5)
    n = 6_000
    a, b, c = r.integers(0, 200, n), r.integers(0, 3, n), r.integers(0, 25, n)
    # a twice, a group of a, one-hot columns of c and its rest by 5; b is apart from them
    rows = np.stack([a, a, a // 50, *[(c == k) for k in range(25)], c % 5, b]).astype(np.uint8)
    bins = rows.max(axis=1).astype(np.int64) + 1
    packs = H.BlockPacks(bins, rows)
    assert len(packs.columns) == 2 and packs.same[1] == 0
    np.testing.assert_array_equal(packs.different(np.array([1, 2, 29])), [1, 2, 29])
    y = (r.random(n) < 0.2 + 0.3 * (a > 120) + 0.3 * (c % 5 == 1)).astype(float)

    def block():
        data = dict(key=np.arange(n), y=y, w=np.where(y > 0, 3.0, 1.0), fold=(np.arange(n) % 4 == 0).astype(np.int32),
                    bins=rows, margin=np.zeros(n))
        return H.Block({"n": n, **{k: v.tobytes() for k, v in data.items()}}, len(rows))

    def plain(bins, _):
        packs = H.Packs(bins)
        packs.different = lambda columns: columns
        return packs

    for p in (H.Params(depth=4, min_rows=5), H.Params(depth=5, columns=0.7, level_columns=0.8, rows=0.6, l1=0.1, min_gain=0.05)):
        ways = []
        for make in (H.BlockPacks, plain):
            with pytest.MonkeyPatch.context() as m:
                m.setattr(H, "BlockPacks", make)
                m.setattr(H, "FEW_CELLS", 0)
                one = block()
                ways.append(([t.pack() for t in H.advance(one, p, bins, 0, 6, 1, lambda _: None)], one.margin))
        assert ways[0][0] == ways[1][0]
        np.testing.assert_array_equal(ways[0][1], ways[1][1])


@pytest.mark.parametrize("extra", [dict(depth=4, min_rows=5), dict(depth=5, rows=0.7, columns=0.8, level_columns=0.8, l1=0.1, min_gain=0.01),
                                   dict(depth=9, min_hessian=0.5, l2=0.0)])
def test_rounds_in_the_jvm_give_the_trees_of_the_numpy_loops(spark, monkeypatch, extra):
    """Rounds over one block run in the task's JVM and give equal trees, margins, losses and scores."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 5))
    rows = [(i, *map(float, r), float(round(r[0])), 1.0, float(r[1]), int(r[0] + r[1] * r[2] > 0), float(1 + i % 3), i % 4) for i, r in enumerate(x)]
    cols = ["a", "b", "c", "d", "e", "few", "one", "again"]
    df = spark.createDataFrame(rows, "ID long, " + ", ".join(f"{c} double" for c in cols) + ", Target int, w double, fold int")
    data, p = H.prepare(df, cols, "Target", "ID", bins=40, weight="w", fold="fold"), H.Params(rate=0.3, **extra)
    assert data.blocks == 1 and H.jvm_steps.column(spark, []) is not None
    names = [c.split()[0] for c in H.BLOCK.split(", ")]

    def two_steps(table):
        out = []
        for first in (0, 5):
            state = H.step_in_task(table, p, data.bins(), first, 5, 2, True)
            out.append(state.select("trees", "margin", "curve", "held_y", "scores").first())
            table = state.select(*names)
        return out

    there = two_steps(data.table)
    monkeypatch.setattr(H.jvm_steps, "column", lambda *_: None)
    for got, want in zip(there, two_steps(data.table)):
        assert all(same(H.Tree.unpack(a), H.Tree.unpack(b)) for a, b in zip(got.trees, want.trees)) and len(got.trees) == 5
        assert np.allclose(np.frombuffer(got.margin), np.frombuffer(want.margin), rtol=0, atol=1e-12)
        assert np.allclose(got.curve, want.curve, rtol=1e-12) and got.held_y == want.held_y
        assert np.allclose(got.scores, want.scores, rtol=0, atol=1e-12)
