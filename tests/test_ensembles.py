"""Ensembles as relations: rules by hand, scores against the fitted model, and audits that turn red when a leaf is changed."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from keepwell.operators import audits, churn, features as feat, trees

NODES = "tree int, node int, yes int, no int, feature int, threshold double, value double"
INF = float("inf")
# tree 0: x <= 1 -> 10, else (y <= 5 -> 20, else 30); tree 1: one leaf; tree 2: x <= 1, then x <= 0
BY_HAND = [(0, 0, 1, 2, 0, 1.0, None), (0, 1, None, None, None, None, 10.0), (0, 2, 3, 4, 1, 5.0, None), (0, 3, None, None, None, None, 20.0),
           (0, 4, None, None, None, None, 30.0), (1, 0, None, None, None, None, 0.5),
           (2, 0, 1, 4, 0, 1.0, None), (2, 1, 2, 3, 0, 0.0, None), (2, 2, None, None, None, None, 1.0), (2, 3, None, None, None, None, 2.0), (2, 4, None, None, None, None, 4.0)]


@pytest.fixture(scope="module")
def by_hand(spark):
    return trees.Rules(spark.createDataFrame(BY_HAND, NODES), 3)


def test_rules_are_the_intervals_on_the_way_to_a_leaf(by_hand):
    leaf = {(r.tree, r.bit): r.value for r in by_hand.leaves.collect()}
    rules = {(leaf[r.tree, r.bit], r.feature, r.low, r.high) for r in by_hand.rules.collect()}
    assert rules == {(10.0, 0, -INF, 1.0), (20.0, 0, 1.0, INF), (20.0, 1, -INF, 5.0), (30.0, 0, 1.0, INF), (30.0, 1, 5.0, INF),
                     (1.0, 0, -INF, 0.0), (2.0, 0, 0.0, 1.0), (4.0, 0, 1.0, INF)}
    assert (by_hand.constant, by_hand.trees, by_hand.all_trees) == (0.5, 2, 3)


def test_values_on_a_threshold_belong_to_the_lower_side(spark, by_hand):
    rows = [(1, 1.0, 9.0), (2, 1.5, 5.0), (3, 1.5, 5.1), (4, 0.0, 0.0), (5, -7.0, 99.0), (6, 1e300, -1e300)]
    df = spark.createDataFrame(rows, "k int, x double, y double")
    total = by_hand.total(df, ["k"], F.array("x", "y", F.lit(0.0)))
    got = {r.k: (r.total, r.leaves) for r in total.collect()}
    assert got == {1: (12.5, 2), 2: (24.5, 2), 3: (34.5, 2), 4: (11.5, 2), 5: (11.5, 2), 6: (24.5, 2)}


def test_rows_are_scored_where_they_lie(spark, by_hand, capsys):
    """Neither multiplied by trees and features nor shuffled: 300 trees would make thousands of rows of one."""
    df = spark.createDataFrame([(1, 1.0, 9.0), (2, None, 5.0), (3, float("nan"), 5.0), (4, INF, INF), (5, -INF, 5.0), (6, -0.0, None)], "k int, x double, y double")
    total = by_hand.total(df, ["k"], F.array("x", "y", F.lit(0.0)))
    assert {r.k: (r.total, r.leaves) for r in total.collect()} == {1: (12.5, 2), 4: (34.5, 2), 6: (11.5, 2)}  # an unknown value rules nothing out
    total.explain()
    plan = capsys.readouterr().out
    assert not any(step in plan for step in ("Exchange", "Join", "Generate"))


def test_a_tree_with_too_many_leaves_is_refused(spark):
    chain = [(0, 2 * i, 2 * i + 1, 2 * i + 2, 0, float(i), None) for i in range(70)] + [(0, 2 * i + 1, None, None, None, None, 1.0) for i in range(70)]
    with pytest.raises(ValueError, match="71 leaves"):
        trees.Rules(spark.createDataFrame([*chain, (0, 140, None, None, None, None, 1.0)], NODES), 1)


@pytest.fixture(scope="module")
def fits(spark, lake, tmp_path_factory):
    rows = feat.as_doubles(lake.features()).withColumn("weight", F.when(F.col(feat.LABEL) == 1, 2.0).otherwise(1.0)).cache()
    found = {}
    for name, classifier in (("forest", RandomForestClassifier(numTrees=7, maxDepth=6, seed=3)), ("boosted", GBTClassifier(maxIter=6, maxDepth=6, stepSize=0.3, seed=3))):
        classifier.setFeaturesCol("features").setLabelCol(feat.LABEL).setWeightCol("weight")
        model = Pipeline(stages=[VectorAssembler(inputCols=list(churn.MODEL_FEATURES), outputCol="features"), classifier]).fit(rows)
        path = churn.save(model, str(tmp_path_factory.mktemp("models") / name))
        found[name] = model, path, trees.Ensemble(spark, path, churn.MODEL_FEATURES)
    yield rows, found
    rows.unpersist()


@pytest.mark.parametrize("name", ["forest", "boosted"])
def test_rules_score_like_the_model_and_a_changed_leaf_shows(spark, fits, name):
    rows, (model, path, ensemble) = fits[0], fits[1][name]
    sound = audits.trees_follow(model, ensemble, rows, name)
    assert sound.count() == rows.count() and sound.where("not follows").count() == 0
    nodes = trees.nodes(spark, path)
    leaf = nodes.where("tree = 2 and value is not null").agg(F.min("node")).first()[0]
    changed = nodes.withColumn("value", F.when((F.col("tree") == 2) & (F.col("node") == leaf), F.col("value") + 0.01).otherwise(F.col("value")))
    hit = audits.trees_follow(model, trees.Ensemble(spark, path, churn.MODEL_FEATURES, changed), rows, name).where("not follows").count()
    assert 0 < hit < rows.count()
    moved = nodes.withColumn("threshold", F.when((F.col("tree") == 0) & (F.col("node") == 0), F.lit(-1e18)).otherwise(F.col("threshold")))
    assert audits.trees_follow(model, trees.Ensemble(spark, path, churn.MODEL_FEATURES, moved), rows, name).where("not follows").count() > 0


def test_comparison_audit(spark, fits):
    rows, found = fits
    models = {name: model for name, (model, *_) in found.items()}
    reported = churn.compare_models(models, rows)
    scored = {name: ensemble.probability(rows, ["customer_id", feat.LABEL]) for name, (_, _, ensemble) in found.items()}
    sound = audits.comparison_follows(reported, scored).collect()
    assert all(r.auc_follows and r.best_follows and r.test_rows == rows.count() for r in sound)
    worse = {**scored, "forest": scored["forest"].withColumn("probability", F.round(F.col("probability"), 1))}
    assert [r.model for r in audits.comparison_follows(reported, worse).collect() if not r.auc_follows] == ["forest"]


def test_importance_audit(fits):
    rows, (model, _, ensemble) = fits[0], fits[1]["boosted"]
    effects = churn.replaced_by_mean(model, rows.drop("weight")).cache()
    sound = audits.importance_follows(churn.importance(effects), effects, ensemble, rows)
    assert sound.count() == len(churn.MODEL_FEATURES)
    assert sound.where("effects_follow and importance_follows").count() == len(churn.MODEL_FEATURES)
    touched = effects.withColumn("delta", F.when(F.col("feature_no") == 4, F.col("delta") + 1e-3).otherwise(F.col("delta")))
    red = audits.importance_follows(churn.importance(touched), touched, ensemble, rows)
    assert [r.feature for r in red.where("not effects_follow and not importance_follows").collect()] == [churn.MODEL_FEATURES[4]]
    effects.unpersist()


def test_rank_auc_counts_ties_half(spark):
    rows = spark.createDataFrame([(0.1, 0), (0.5, 1), (0.5, 0), (0.9, 1), (0.9, 1), (0.2, 0)], f"probability double, {feat.LABEL} int")
    assert abs(audits.rank_auc(rows) - (3 * 2 + 2.5) / 9) < 1e-12
    assert audits.rank_auc(rows.where(f"{feat.LABEL} = 1")) is None
