"""A row with each of its values replaced in turn: scored where it lies, and as if each variant were a row."""

import random

import pytest
from pyspark.sql import functions as F

from keepwell.operators import audits, churn, trees
from keepwell.operators.features import LABEL

NODES = "tree int, node int, yes int, no int, feature int, threshold double, value double"
# tree 0: x <= 1 -> 10, else (y <= 5 -> 20, else 30); tree 1: one leaf; tree 2: x <= 1, then x <= 0
BY_HAND = [(0, 0, 1, 2, 0, 1.0, None), (0, 1, None, None, None, None, 10.0), (0, 2, 3, 4, 1, 5.0, None), (0, 3, None, None, None, None, 20.0),
           (0, 4, None, None, None, None, 30.0), (1, 0, None, None, None, None, 0.5),
           (2, 0, 1, 4, 0, 1.0, None), (2, 1, 2, 3, 0, 0.0, None), (2, 2, None, None, None, None, 1.0), (2, 3, None, None, None, None, 2.0), (2, 4, None, None, None, None, 4.0)]
STEPS = ("Exchange", "Sort", "ObjectHashAggregate")


def _plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    draw = random.Random(5)
    rows = [(f"C{i}", i % 2, *[round(draw.random() * 9 + (i % 2) * j % 3, 2) for j in range(len(churn.MODEL_FEATURES))]) for i in range(120)]
    rows = spark.createDataFrame(rows, ", ".join(["customer_id string", f"{LABEL} int", *[f"{f} double" for f in churn.MODEL_FEATURES]]))
    model = churn.fit_boosted(rows, 4)
    path = churn.save(model, str(tmp_path_factory.mktemp("models") / "boosted"))
    return rows, model, path


def test_variants_by_hand(spark):
    rules = trees.Rules(spark.createDataFrame(BY_HAND, NODES), 3)
    df = spark.createDataFrame([(1, 0.5, 9.0), (2, 1.5, 5.0), (3, None, 5.0)], "k int, x double, y double")
    got = {r.k: (r.totals, r.leaves) for r in rules.varied(df, ["k"], F.array("x", "y", F.lit(0.0)), [2.0, 7.0, 1.0]).collect()}
    assert got[1] == ([34.5, 12.5, 12.5, 12.5], [2, 2, 2, 2])
    assert got[2] == ([24.5, 34.5, 24.5, 24.5], [2, 2, 2, 2])
    assert got[3][1][0] == 2 and got[3][0][0] == 24.5 and got[3][1][3] == 0  # only the replaced value is known


def test_more_rows_than_are_held_at_once(spark):
    rules = trees.Rules(spark.createDataFrame(BY_HAND, NODES), 3)
    df = spark.range(3 * trees.VARIED + 7).coalesce(1).select("id", F.array(F.col("id") / 100, F.col("id") % 11 + 0.0, F.lit(0.0)).alias("x"))
    others = [0.7, 4.0, 0.0]
    got = {r.id: r for r in rules.varied(df, ["id"], F.col("x"), others).collect()}
    for i in range(4):
        one = rules.total(df, ["id"], F.transform("x", lambda v, j: F.when(j == i, F.lit(others[min(i, 2)])).otherwise(v)))
        assert all((got[r.id].totals[i], got[r.id].leaves[i]) == (r.total, r.leaves) for r in one.collect())


def test_effects_are_scored_row_by_row(fitted, capsys):
    rows, model, _ = fitted
    effects = churn.replaced_by_mean(model, rows)
    assert not any(step in _plan(effects, capsys) for step in STEPS)
    own = {r.customer_id: r.churn_probability for r in churn.probability(model, rows).collect()}
    means = churn.feature_means(rows)
    found = {(r.customer_id, r.feature_no): r for r in effects.collect()}
    assert len(found) == len(own) * len(means)
    for i, f in enumerate(churn.MODEL_FEATURES):
        for r in churn.probability(model, rows.withColumn(f, F.lit(means[i]))).collect():
            assert abs(found[r.customer_id, i].delta - (own[r.customer_id] - r.churn_probability)) < 1e-12
    assert {(r.customer_id, r[f]) for r in rows.collect()} == {(c, e.value) for (c, _), e in found.items() if e.feature == f}


def test_rules_of_the_audit_meet_a_customer_once(spark, fitted, capsys):
    rows, model, path = fitted
    ensemble = trees.Ensemble(spark, path, churn.MODEL_FEATURES)
    means = churn.feature_means(rows)
    varied = ensemble.varied(rows, ["customer_id"], means)
    assert not any(step in _plan(varied, capsys) for step in (*STEPS, "Generate"))
    got = {r.customer_id: r.probabilities for r in varied.collect()}
    for i, f in enumerate([*churn.MODEL_FEATURES, None]):
        changed = rows if f is None else rows.withColumn(f, F.lit(means[i]))
        for r in churn.probability(model, changed).collect():
            assert abs(got[r.customer_id][i] - r.churn_probability) < 1e-9
    effects = churn.replaced_by_mean(model, rows)
    audit = audits.importance_follows(churn.importance(effects), effects, ensemble, rows).collect()
    assert len(audit) == len(means) and all(r.customers == 120 and r.effects_follow and r.importance_follows for r in audit)
