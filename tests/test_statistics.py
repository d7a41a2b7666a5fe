import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keepwell.functions import exact, ordering
from keepwell.functions.ordering import numbered, order_statistics, quantiles
from keepwell.operators import profiling


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 997])
def test_quantiles_equal_numpy(spark, n):
    values = [float(random.Random(n).randint(0, n // 2 + 1)) for _ in range(n)]
    got = quantiles(frame(spark, values), "v", [0.0, 0.25, 0.5, 0.99, 1.0])
    assert np.allclose(got, np.percentile(values, [0, 25, 50, 99, 100]), rtol=0, atol=1e-9)


def test_quantiles_with_a_narrow_bracket_and_a_hot_value(spark, monkeypatch):
    """A coarse sketch over many rows: most rows collapse, the answer stays exact."""
    monkeypatch.setattr(ordering, "ACCURACY", 200)
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 7919 % 100_003).cast("double")).alias("v"))
    values = [r[0] for r in df.collect()]
    assert np.allclose(quantiles(df, "v", [0.1, 0.5, 0.95, 0.99]), np.percentile(values, [10, 50, 95, 99]), rtol=0, atol=1e-9)


def test_quantiles_of_nothing(spark):
    assert order_statistics(frame(spark, []), "v", [0.5]) == []
    assert quantiles(frame(spark, []), "v", [0.5]) == [None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40), st.floats(0, 1))
def test_any_quantile(spark, values, p):
    assert np.isclose(quantiles(frame(spark, values), "v", [p])[0], np.percentile(values, 100 * p), rtol=1e-9, atol=1e-6)


def test_numbered_is_dense_and_ordered(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 as f").repartition(6)
    rows = numbered(df, [F.desc("f"), F.col("id")], "pos").collect()
    want = sorted(((r["f"], r["id"]) for r in rows), key=lambda x: (-x[0], x[1]))
    assert [(r["f"], r["id"]) for r in sorted(rows, key=lambda r: r["pos"])] == want
    assert sorted(r["pos"] for r in rows) == list(range(5000))


def test_money_is_independent_of_row_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9, 0.005] * 50
    got = {frame(spark, v).repartition(7).agg(exact.total("v", 4).alias("s")).first()["s"] for v in (values, values[::-1], sorted(values))}
    assert got == {30.25}


def test_ratio_guards_zero(spark):
    row = spark.range(1).select(exact.ratio(F.lit(1), F.lit(0)).alias("z"), exact.ratio(F.lit(1), F.lit(8)).alias("e")).first()
    assert row["z"] is None and row["e"] == 0.13


def test_histogram_conserves_rows_and_survives_a_constant_column(spark):
    df = frame(spark, [1.0, 2.0, 2.5, 10.0])
    assert profiling.bins(df, "v", 5).agg(F.sum("n")).first()[0] == 4
    assert [tuple(r) for r in profiling.bins(frame(spark, [3.0, 3.0]), "v").collect()] == [(0, 2, "v")]


def test_null_report_is_one_scan(spark, lake):
    report = profiling.null_report(lake.raw("reviews"), "reviews")
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    nulls = {r["column_name"]: r["nulls"] for r in report.collect()}
    assert nulls["review_id"] == 0 and nulls["review_text"] > 0


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 7.0, 5.0)], "a double, b double, c double")
    row = df.agg(exact.correlation("a", "b").alias("ab"), exact.correlation("a", "c").alias("ac")).first()
    assert row["ac"] is None and np.isclose(row["ab"], np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1])


def test_correlation_uses_the_rows_that_have_both(spark):
    from keepwell.functions.exact import correlation
    rows = [(1.0, 2.0, 7.0), (2.0, None, 7.0), (3.0, 5.0, 7.0), (4.0, 4.0, 7.0), (None, 100.0, 7.0)]
    got = spark.createDataFrame(rows, "a double, b double, c double").agg(correlation("a", "b").alias("ab"), correlation("a", "c").alias("ac")).first()
    assert np.isclose(got.ab, np.corrcoef([1, 3, 4], [2, 5, 4])[0, 1]) and got.ac is None


def test_what_is_ranked_stays_small(spark, monkeypatch):
    from keepwell.functions import ordering
    monkeypatch.setattr(ordering, "ACCURACY", 50)
    monkeypatch.setattr(ordering, "WIDEST", 400)
    ranked = []
    over = ordering.Window.orderBy
    monkeypatch.setattr(ordering.Window, "orderBy", lambda *a: (ranked.append(a), over(*a))[1])
    values = spark.range(300_000).selectExpr("cast(id * 7919 % 300007 as double) as v").cache()
    got = ordering.order_statistics(values, "v", [0.001, 0.5, 0.99])
    expect = np.sort(values.toPandas()["v"].to_numpy())
    for (low, high, _), p in zip(got, [0.001, 0.5, 0.99]):
        r = (len(expect) - 1) * p
        assert (low, high) == (expect[int(np.floor(r))], expect[int(np.ceil(r))])
    values.unpersist()
