"""The audits must turn red when a model's output is tampered with."""

from pyspark.sql import functions as F

from keepwell.operators import audits, churn, features as feat, segments
from keepwell.plans import fitted


def _wrong(df, flag):
    return df.where(~F.col(flag)).count()


def test_predictions_audit(lake):
    table = feat.as_doubles(lake.features())
    model = churn.logistic(50).fit(churn.balanced(table))
    effects = churn.replaced_by_mean(model, table).cache()
    made = churn.predictions(churn.probability(model, table), churn.top_reason(effects), lake.last_day())
    again = churn.linear_probability(churn.logistic_weights(model), model.stages[-1].intercept, table).select("customer_id", "probability")
    sound = audits.predictions_follow(made, effects, again)
    assert sound.count() == table.count()
    assert all(_wrong(sound, f) == 0 for f in ("in_range", "probability_follows", "band_follows", "reason_follows"))
    raised = audits.predictions_follow(made.withColumn("churn_probability", F.col("churn_probability") + 1.5), effects, again)
    assert _wrong(raised, "in_range") == _wrong(raised, "probability_follows") == table.count()
    assert _wrong(audits.predictions_follow(made.withColumn("churn_risk_band", F.lit("Low")), effects, again), "band_follows") > 0
    assert _wrong(audits.predictions_follow(made.withColumn("top_churn_reason", F.lit("pct_social")), effects, again), "reason_follows") > 0
    effects.unpersist()


def test_logistic_audit(lake):
    train = churn.balanced(feat.as_doubles(lake.features())).cache()
    assert audits.logistic_stationary(churn.logistic().fit(train), train).first()["stationary"]
    assert not audits.logistic_stationary(churn.logistic(1).fit(train), train).first()["stationary"]
    train.unpersist()


def test_power_audit(lake):
    df, powers = fitted.clipped(lake), fitted.powers(lake)
    sound = audits.powers_follow(df, powers)
    assert sound.where("improvable or not standardised").count() == 0
    moved = {c: segments.Power(p.lam + 0.2, p.mean, p.std) for c, p in powers.items()}
    assert audits.powers_follow(df, moved).where("improvable and not standardised").count() == 3


def test_segment_audit(lake):
    points = fitted.points(lake)
    powers = fitted.powers(lake)
    model = segments.best_kmeans(points, restarts=3)
    assigned = model.transform(points)
    centres = points.sparkSession.createDataFrame([(i, *map(float, c)) for i, c in enumerate(model.clusterCenters())],
                                                  ["cluster_id", *segments.SCALED])
    table = segments.segment_table(segments.with_names(assigned, powers), lake.rule_predictions(), "KMeans", 0.0, lake.last_day())
    flags = ("nearest", "name_follows", "priority_follows")
    sound = audits.segments_follow(table, points, centres)
    assert sound.count() == points.count() and all(_wrong(sound, f) == 0 for f in flags)
    shuffled = table.withColumn("rfm_cluster_id", (F.abs(F.xxhash64("customer_id")) % 3).cast("int"))
    assert _wrong(audits.segments_follow(shuffled, points, centres), "nearest") > 0
    moved = centres.withColumn(segments.SCALED[0], F.when(F.col("cluster_id") == 0, F.col(segments.SCALED[0]) + 1.0).otherwise(F.col(segments.SCALED[0])))
    assert _wrong(audits.segments_follow(table, points, moved), "nearest") > 0
    assert _wrong(audits.segments_follow(table.withColumn("rfm_segment", F.lit(segments.LOYAL)), points, centres), "name_follows") > 0
    assert _wrong(audits.segments_follow(table.withColumn("retention_priority", F.lit("Low")), points, centres), "priority_follows") > 0


def test_recommendation_audit(spark):
    recs = spark.createDataFrame(
        [("a", "p1", 1, 0.9, "als"), ("a", "p2", 2, 0.5, "als"), ("b", "p1", 1, 0.2, "als"), ("b", "p3", 2, 0.4, "als"),
         ("b", "p3", 1, 0.0, "popularity_fallback")], "customer_id string, product_id string, rank int, als_score double, rec_source string")
    found = {r.customer_id: tuple(r)[1:] for r in audits.recommendations_follow(recs).collect()}
    assert found["a"] == ("als", 2, 1, 0)
    assert found["b"][:3] == ("als+popularity_fallback", 2, 2) and found["b"][3] > 0
