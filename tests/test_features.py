"""Scalar features, encodings, fill and alignment on small hand-made frames."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from responsekit.functions.dates import calendar_parts, parse_mixed_date
from responsekit.operators.align import align_columns, align_report, numeric_columns, require_columns
from responsekit.operators.encode import fit_levels, onehot_capped, onehot_wide
from responsekit.operators.fill import fit_medians, median_fill
from responsekit.operators.scale import fit_scaler


def test_mixed_date_parse(spark):
    rows = [("2013-01-02",), ("13-04-2014",), ("02/03/2012",), ("02-03-2012",), ("13/04/2014",), (None,), ("junk",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(parse_mixed_date(F.col("s"))).collect()]
    assert got == [dt.date(2013, 1, 2), dt.date(2014, 4, 13), dt.date(2012, 2, 3), dt.date(2012, 2, 3),
                   dt.date(2014, 4, 13), None, None]


def test_calendar_parts_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 31),), (None,)], "d date")
    parts = calendar_parts(F.col("d"))
    r = df.select(*[e.alias(n) for n, e in parts.items()]).collect()
    assert r[0]["Dt_DayOfWeek"] == 0 and r[0]["Dt_Is_Month_Start"] == 1
    assert r[1]["Dt_Is_Month_End"] == 1 and r[1]["Dt_Is_Weekend"] == 0
    assert r[2]["Dt_Year"] is None and r[2]["Dt_Is_Weekend"] == 0


def _base(spark, **columns):
    """``add_base_features`` over customers that are null but for their ID and ``columns`` (lists of equal length)."""
    from responsekit.catalog import CUSTOMER_SCHEMA
    from responsekit.functions.base import add_base_features
    n = len(next(iter(columns.values())))
    columns.setdefault("ID", list(range(n)))
    rows = [tuple(columns[f.name][k] if f.name in columns else None for f in CUSTOMER_SCHEMA) for k in range(n)]
    return add_base_features(spark.createDataFrame(rows, CUSTOMER_SCHEMA), None, 2025)


def test_age_groups_right_closed(spark):
    ages = [0, 30, 31, 40, 60, 61, 100, 101, None]
    got = [r[0] for r in _base(spark, Year_Birth=[None if a is None else 2025 - a for a in ages]).select("Age_Group").collect()]
    assert got == ["<30", "<30", "30-40", "30-40", "50-60", "60+", "60+", "<30", "<30"]


def test_null_row_sum_and_log(spark):
    r = _base(spark, MntWines=[None, -2.0, 0.0]).select("Total_Spent", "MntWines_Log").collect()
    assert r[0]["Total_Spent"] == 0 and r[0]["MntWines_Log"] is None
    assert r[1]["MntWines_Log"] is None and r[2]["MntWines_Log"] == 0.0


def test_onehot_and_levels(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "e string")
    lv = fit_levels(df, "e")
    assert lv == ["Unknown", "a", "b", "c"]
    wide = df.select(*[e.alias(n) for n, e in onehot_wide("e", lv).items()]).collect()
    assert [list(r) for r in wide] == [[0, 0, 1, 0], [0, 1, 0, 0], [1, 0, 0, 0], [0, 0, 0, 1]]
    capped = [r[0] for r in df.select(onehot_capped("e", ["a", "b"], 3)).collect()]
    assert capped == [[0, 1, 0], [1, 0, 0], [0, 0, 0], [0, 0, 0]]


def test_fit_levels_guard(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("e"))
    with pytest.raises(ValueError):
        fit_levels(df, "e", max_levels=10)


@pytest.mark.parametrize("n", [1, 2, 7, 10, 501])
def test_exact_median_matches_numpy(spark, n):
    rng = np.random.default_rng(n)
    vals = rng.normal(size=n).round(3)
    rows = [(float(v), float(v) if i % 3 else None, 5.0) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    med = fit_medians(df, ["a", "b", "c"])
    assert med["a"] == pytest.approx(float(np.median(vals)))
    b = [v for i, v in enumerate(vals) if i % 3]
    assert (med["b"] is None) if not b else med["b"] == pytest.approx(float(np.median(b)))
    assert med["c"] == 5.0


def test_exact_median_band_retry(spark):
    # a tiny sketch accuracy forces band misses and the widening path
    from responsekit.operators import fill
    vals = list(range(1000))
    df = spark.createDataFrame([(float(v),) for v in vals], "a double")
    assert fill.fit_medians(df, ["a"], accuracy=20)["a"] == pytest.approx(499.5)


def test_median_fill_and_nan(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), None), (None, 3), (5.0, 5)], "x double, k long")
    out = median_fill(df, {"x": 3.0, "k": 3.0}).collect()
    assert [r["x"] for r in out] == [1.0, 3.0, 3.0, 5.0]
    assert [r["k"] for r in out] == [1, 3, 3, 5]


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    sc = fit_scaler(df, ["x"])
    assert sc.stds["x"] == pytest.approx(np.std([1, 2, 3, 4]))
    z = [r[0] for r in df.select(sc.columns(["x"])["x"]).collect()]
    assert np.mean(z) == pytest.approx(0.0) and np.std(z) == pytest.approx(1.0)


def test_alignment(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 7)], "ID long, a double, s string, extra long")
    out = align_columns(df, ["b", "a"], keep=["ID"])
    assert out.columns == ["ID", "b", "a"] and out.first()["b"] == 0
    rep = dict(align_report(df, ["b", "a"], keep=["ID"]))
    assert rep == {"b": "added", "a": "kept", "s": "dropped", "extra": "dropped"}
    assert numeric_columns(df, exclude=["ID"]) == ["a", "extra"]
    with pytest.raises(ValueError):
        require_columns(df, ["a", "missing"])


def test_sql_double_literal_round_trip(spark):
    """Generated SQL text must carry every fitted double exactly (centres, medians, scalers)."""
    from responsekit.functions.advanced import d
    vals = [0.001, 1e-05, -0.5, 1.5e+20, 123456.78901234567, -3.14159e-12, 0.1 + 0.2, -0.0, 5e-324]
    row = spark.range(1).select(*[F.expr(d(v)).alias(f"c{i}") for i, v in enumerate(vals)]).first()
    for got, want in zip(row, vals):
        assert got == want and math.copysign(1, got) == math.copysign(1, want)


def test_cluster_label_nearest_centre_first_wins_ties(spark):
    from responsekit.operators.advanced import ClusterModel
    from responsekit.operators.scale import ScalerModel
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 3.0), (3, 1.5, 1.5)], "ID long, a double, b double")
    sc = ScalerModel({"a": 0.0, "b": 0.0}, {"a": 1.0, "b": 1.0})
    got = ClusterModel(2, ["a", "b"], sc, [[0.0, 0.0], [3.0, 3.0]], 0.0).transform(df)
    assert got.columns == ["ID", "a", "b", "Cluster_2", "Cluster_2_Dist_0", "Cluster_2_Dist_1"]
    rows = {r["ID"]: r for r in got.collect()}
    assert [rows[i]["Cluster_2"] for i in (1, 2, 3)] == [0, 1, 0]  # row 3 is equidistant: first centre
    assert math.isclose(rows[2]["Cluster_2_Dist_0"], math.sqrt(18.0))
