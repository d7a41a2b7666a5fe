import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepwell.operators import churn, features as feat, recommend, rerank, segments
from keepwell.plans import fitted, reference_rules as rules


def test_feature_table_has_one_complete_row_per_ordering_customer(lake):
    table = lake.features()
    assert table.count() == table.select("customer_id").distinct().count() == lake.table("orders").where("customer_id is not null").select("customer_id").distinct().count()
    assert table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in table.columns]).first().asDict() == dict.fromkeys(table.columns, 0)
    assert table.where("abandon_rate < 0 or abandon_rate > 1").count() == 0


def test_no_cart_additions_mean_no_abandonment(spark):
    df = spark.createDataFrame([(None, 3.0), (0, 3.0), (4, 1.0), (2, 9.0)], "adds int, orders double")
    assert [r[0] for r in df.select(feat.abandonment(F.col("adds"), F.col("orders"))).collect()] == [0.0, 0.0, 0.75, 0.0]


def test_payment_tie_goes_to_the_first_name(spark):
    orders = spark.createDataFrame([("o1", "c"), ("o2", "c")], "order_id string, customer_id string")
    payments = spark.createDataFrame([("o1", "wallet"), ("o2", "COD")], "order_id string, payment_method string")
    assert feat.preferred_payment(orders, payments).first()["preferred_payment"] == "COD"


def test_label_inputs_are_not_model_inputs():
    assert not set(churn.LABEL_INPUTS) & set(churn.MODEL_FEATURES) and len(churn.MODEL_FEATURES) == 12


def test_split_is_exact_per_class_and_independent_of_partitioning(lake):
    a = churn.stratified_split(lake.features())
    b = churn.stratified_split(lake.features().repartition(5))
    assert a.select("customer_id", "split").exceptAll(b.select("customer_id", "split")).count() == 0
    for r in a.groupBy(feat.LABEL).agg(F.count_if(F.col("split") == "train").alias("t"), F.count("*").alias("n")).collect():
        assert r["t"] == math.floor(0.7 * (r["n"] - 1)) + 1


def test_risk_bands_are_right_closed(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.25, 0.2500001, 0.5, 0.75, 0.76, 1.0, None)], "p double")
    assert [r[0] for r in df.select(churn.risk_band(F.col("p"))).collect()] == ["Low", "Low", "Medium", "Medium", "High", "Critical", "Critical", None]


def test_auc_with_ties_equals_pair_counting(spark):
    rows = [(0.1, 0.0), (0.4, 0.0), (0.4, 1.0), (0.8, 1.0), (0.4, 1.0), (0.9, 0.0)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = np.mean([1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg])
    assert churn.auc(spark.createDataFrame(rows, f"churn_probability double, {feat.LABEL} double")) == pytest.approx(want)


def test_effects_by_replacement_match_the_model_and_survive_saving(spark, lake, tmp_path):
    table = feat.as_doubles(lake.features())
    model = churn.logistic(20).fit(churn.balanced(table))
    loaded = churn.load(spark, churn.save(model, str(tmp_path / "model")))
    p = {r[0]: r[1] for r in churn.probability(model, table).select("customer_id", "churn_probability").collect()}
    assert p == {r[0]: r[1] for r in churn.probability(loaded, table).select("customer_id", "churn_probability").collect()}
    effects = churn.replaced_by_mean(model, table).where("feature = 'refund_rate'").collect()
    assert len(effects) == len(p)
    means, w, b = churn.feature_means(table), churn.logistic_weights(model), model.stages[-1].intercept
    i = churn.MODEL_FEATURES.index("refund_rate")
    for row in table.limit(5).collect():
        margin = b + sum(w[f] * row[f] for f in churn.MODEL_FEATURES)
        moved = margin - w["refund_rate"] * (row["refund_rate"] - means[i])
        want = 1 / (1 + math.exp(-margin)) - 1 / (1 + math.exp(-moved))
        assert next(e["delta"] for e in effects if e["customer_id"] == row["customer_id"]) == pytest.approx(want, abs=1e-9)
    assert churn.top_reason(churn.replaced_by_mean(model, table)).count() == len(p)
    assert churn.importance(churn.replaced_by_mean(model, table)).count() == 12


def test_power_transform_round_trip_and_moments(lake):
    powers = fitted.powers(lake)
    scaled = segments.scaled(fitted.clipped(lake), powers)
    row = scaled.agg(*[f(c) for c in segments.SCALED for f in (F.avg, F.stddev_pop)]).first()
    assert np.allclose(row[::2], 0, atol=1e-6) and np.allclose(row[1::2], 1, atol=1e-6)
    gap = [F.max(F.abs(segments.unscaled(F.col(s), powers[c]) - F.col(c)) / (F.abs(F.col(c)) + 1)) for c, s in zip(segments.RFM, segments.SCALED)]
    assert max(scaled.agg(*gap).first()) < 1e-6


def test_power_fit_maximises_the_likelihood(spark):
    df = spark.range(400).select(F.exp(F.col("id") / 100.0).alias("x"), (-F.col("id") / 10.0).alias("y"))
    fitted_powers = segments.fit_power(df, ("x", "y"))
    for c in ("x", "y"):
        x = np.array([r[0] for r in df.select(c).collect()])

        def loglik(lam):
            safe = np.where(x >= 0, (np.power(np.abs(x) + 1, lam) - 1) / lam, -(np.power(np.abs(x) + 1, 2 - lam) - 1) / (2 - lam))
            return -len(x) / 2 * np.log(safe.var()) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))
        best = max((loglik(lam), lam) for lam in np.arange(-2.0013, 3, 0.01))[1]
        assert abs(fitted_powers[c].lam - best) < 0.02


def test_names_follow_spend_not_cluster_numbers(spark):
    centers = spark.createDataFrame([(0, 10.0), (1, 500.0), (2, 90.0)], "cluster_id int, total_spent double")
    assert {r["cluster_id"]: r["rfm_segment"] for r in segments.named(centers).collect()} == {1: "Champions", 2: "Loyal Customers", 0: "At Risk"}


def test_retention_priority_with_unknown_probability(spark):
    rows = [("Champions", 0.5), ("Champions", None), ("Loyal Customers", 0.9), ("Loyal Customers", None), ("At Risk", 0.9)]
    df = spark.createDataFrame(rows, "s string, p double")
    assert [r[0] for r in df.select(segments.retention_priority(F.col("s"), F.col("p"))).collect()] == ["Urgent", "High", "High", "Medium", "Low"]


def test_clustering_scores(lake):
    points = fitted.points(lake)
    model = segments.best_kmeans(points, restarts=3)
    scores = segments.calinski_harabasz(model.transform(points)).first()
    assert scores["k"] == 3 and scores["inertia"] == pytest.approx(model.summary.trainingCost, rel=1e-4)


def test_als_end_to_end(lake):
    recs = fitted.recommendation_table(lake)
    served = recs.where("rec_source = 'als'")
    assert served.groupBy("customer_id").count().where("count > 10").count() == 0
    assert recommend.rank_inversions(served).count() == 0
    train, test = fitted.split(lake)
    assert train.count() + test.count() == lake.interactions().where("order_date is not null").count()
    assert recommend.rmse_evaluator().evaluate(fitted.als_model(lake).transform(test)) > 0


def test_evaluation_against_brute_force(spark):
    recs = spark.createDataFrame([("a", "p1", 1), ("a", "p2", 2), ("b", "p1", 1), ("c", "p9", 1)], "customer_id string, product_id string, rank int")
    held = spark.createDataFrame([("a", "p2"), ("a", "p2"), ("b", "p1"), ("z", "p1")], "customer_id string, product_id string")
    row = recommend.evaluate(recs, held).first()
    assert (row["hits"], row["users"]) == (2, 3)
    assert row["ndcg"] == pytest.approx((1 / math.log2(3) + 1.0) / recommend.IDEAL_DCG / 3, abs=1e-8)


def test_entropy_weights_and_multiplier(lake):
    z = rerank.standardised(rerank.with_baskets(lake.rule_segments(), rerank.basket_size(lake.table("cart_events"))))
    row = z.agg(*[f(c) for c in rerank.Z.values() for f in (F.avg, F.stddev_pop)]).first()
    assert np.allclose(row[::2], 0, atol=1e-9) and np.allclose(row[1::2], 1, atol=1e-9)
    weights = rerank.entropy_weights(z)
    assert sum(v for k, v in weights.items() if k.startswith("w_")) == pytest.approx(1.0)
    low, high = rerank.multiplier(z, weights).agg(F.min("rfmq_weight"), F.max("rfmq_weight")).first()
    assert (low, high) == (pytest.approx(0.5), pytest.approx(1.5))


def test_reranking_never_reorders_within_a_customer(lake):
    assert lake.rule_reranked().where("rank <> rfmq_rank").count() == 0


def test_matrix_covers_all_combinations(lake):
    assert len(rerank.WEIGHT_MATRIX) == 12
    assert rerank.matrix_coverage(lake.rule_segments()).where("not is_listed").count() == 0


def test_linear_effects_add_up(lake):
    table = feat.as_doubles(lake.features())
    total = churn.linear_effects(table, rules.EFFECTS).groupBy("feature").agg(F.sum("delta").alias("s")).agg(F.max(F.abs("s"))).first()[0]
    assert total < 1e-6


def test_a_customer_without_a_readable_date_is_flagged_not_aged(spark):
    from datetime import date
    orders = spark.createDataFrame(
        [("o1", "a", date(2024, 1, 1), 10.0, 0.0), ("o2", "a", date(2024, 1, 2), 10.0, 0.0), ("o3", "b", date(2024, 7, 1), 30.0, 0.0),
         ("o4", "c", None, 20.0, 0.0), ("o5", "c", None, None, 0.0), ("o6", "d", date(2024, 6, 30), None, 0.0)],
        "order_id string, customer_id string, order_date date, order_amount double, discount_amount double")

    def none(schema):
        return spark.createDataFrame([], schema)
    got = {r.customer_id: r for r in feat.feature_table(
        orders, none("order_id string, payment_method string"), none("customer_id string, refund_id string"),
        none("customer_id string, action string, event_id string"),
        none("customer_id string, session_id string, channel string, pages_viewed int, session_duration_seconds int"),
        none("customer_id string, rating int")).collect()}
    assert (got["a"].recency_days, got["b"].recency_days, got["d"].recency_days) == (181, 0, 1)
    assert got["c"].recency_days == (181 + 0 + 1) // 3
    assert {c: (r.recency_unknown, r.spent_unknown, r.churn_label) for c, r in got.items()} == {
        "a": (0, 0, 1), "b": (0, 0, 0), "c": (1, 0, 0), "d": (0, 1, 0)}
