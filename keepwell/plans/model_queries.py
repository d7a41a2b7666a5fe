"""Queries over the models: churn, segments, recommendations, re-ranking, insight, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from keepwell.operators import audits, churn, features as feat, insight, interactions, recommend, reports, rerank, retrieval, segments, sentiment
from keepwell.operators.profiling import stacked
from keepwell.plans import fitted
from keepwell.plans import reference_rules as rules
from keepwell.plans.registry import query

# ---------------------------------------------------------------- churn
query("churn_split")(lambda lake: churn.stratified_split(lake.features()).select("customer_id", feat.LABEL, "split"))
query("churn_predictions")(lambda lake: rules.predictions(feat.as_doubles(lake.features()), lake.last_day()))


@query("churn_linear_effects")
def _linear(lake):
    return churn.linear_effects(feat.as_doubles(lake.features()), rules.EFFECTS).select(
        "customer_id", "feature", "value", F.round("delta", 6).alias("delta"))


@query("churn_auc")
def _auc(lake):
    scored = lake.features().join(lake.rule_predictions(), "customer_id").select(
        "churn_probability", F.col(feat.LABEL).cast("double").alias(feat.LABEL), F.col("avg_rating").cast("double"))
    return lake.spark.createDataFrame(
        [(c, round(churn.auc(scored, c), 6)) for c in ("churn_probability", "avg_rating")], "score string, auc double")


query("churn_model_comparison")(fitted.model_comparison)
query("churn_predictions_fitted")(fitted.predictions)
query("churn_importance")(lambda lake: churn.importance(fitted.effects(lake)))

# ---------------------------------------------------------------- segments
query("segment_clip")(lambda lake: feat.winsorised(feat.as_doubles(lake.features()).select("customer_id", "total_spent"), ["total_spent"]))


@query("segment_scaled")
def _scaled(lake):
    """A saved transform applied, and taken back."""
    scaled = rules.assigned(lake.features())
    back = [F.round(segments.unscaled(F.col(s), rules.POWERS[c]), 4).alias(f"{c}_back") for c, s in zip(segments.RFM, segments.SCALED)]
    return scaled.select("customer_id", *[F.round(s, 6).alias(s) for s in segments.SCALED], *back)


query("segment_scores")(lambda lake: segments.calinski_harabasz(rules.assigned(lake.features())))
query("segment_names")(lambda lake: segments.named(segments.centroids(rules.assigned(lake.features()), rules.POWERS)).select(
    "cluster_id", "rfm_segment", "customers", *[F.round(c, 4).alias(c) for c in segments.RFM]))
query("segment_table")(lambda lake: rules.segment_table(lake.features(), lake.rule_predictions(), lake.last_day()))
query("segment_priority_counts")(lambda lake: segments.priority_counts(lake.rule_segments()))
query("segment_kmeans")(fitted.segment_table)
query("segment_sweep")(lambda lake: segments.sweep(fitted.points(lake)))
query("segment_algorithms")(lambda lake: segments.flat_against_hierarchical(fitted.points(lake)))


@query("segment_power_fit")
def _power_fit(lake):
    rows = [(c, p.lam, p.mean, p.std) for c, p in fitted.powers(lake).items()]
    return lake.spark.createDataFrame(rows, "feature string, lam double, mean double, std double")


# ---------------------------------------------------------------- recommendations
query("recommend_interactions")(lambda lake: interactions.interaction_matrix(*[lake.table(t) for t in ("orders", "cart_events", "reviews")]))
query("recommend_user_ids")(lambda lake: recommend.integer_ids(lake.interactions(), "customer_id", "user_idx"))
query("recommend_item_ids")(lambda lake: recommend.integer_ids(lake.interactions(), "product_id", "item_idx"))


@query("recommend_split")
def _split(lake):
    train, test = recommend.temporal_split(lake.interactions(), recommend.split_date(lake.interactions()))
    return stacked([train.withColumn("split", F.lit("train")), test.withColumn("split", F.lit("test"))])


query("recommend_fallback")(lambda lake: recommend.popularity_fallback(lake.table("orders")))
query("recommend_history_ranking")(lambda lake: recommend.history_ranking(lake.interactions()))


def _holdout(lake):
    return recommend.temporal_split(lake.interactions(), recommend.split_date(lake.interactions()))[1]


@query("recommend_evaluation")
def _evaluation(lake):
    catalogue = lake.interactions().agg(F.count_distinct("product_id")).scalar()
    return recommend.evaluate(lake.rule_recommendations(), _holdout(lake), catalogue=catalogue)


query("recommend_rank_inversions")(lambda lake: recommend.rank_inversions(
    lake.rule_recommendations().withColumn("als_score", F.when(F.col("rank") == 4, F.col("als_score") * 5).otherwise(F.col("als_score")))))
query("recommend_segment_samples")(lambda lake: recommend.segment_samples(lake.rule_recommendations(), lake.rule_segments()))
query("recommend_als")(fitted.recommendation_table)
query("recommend_als_overlap")(lambda lake: recommend.overlap(fitted.recommendation_table(lake)))


@query("recommend_best_items")
def _best_items(lake):
    """The exact search over stand-in factors of every customer and product."""
    users, items = fitted.ids(lake)
    found = retrieval.searched(rules.factors(users, "customer_id", "user_idx", False), rules.factors(items, "product_id", "item_idx", True), "id", "id")
    return retrieval.best(found)


query("recommend_search_effort")(lambda lake: retrieval.effort(fitted.searched(lake)))


@query("recommend_als_quality")
def _als_quality(lake):
    """Test RMSE beside precision, NDCG and lift of the fitted model."""
    train, test = fitted.split(lake)
    rmse = recommend.rmse_evaluator().evaluate(fitted.als_model(lake).transform(test))
    catalogue = lake.interactions().agg(F.count_distinct("product_id")).scalar()
    served = fitted.recommendation_table(lake).where("rec_source = 'als'")
    return recommend.evaluate(served, test, catalogue=catalogue).withColumn("rmse", F.lit(float(rmse)))


@query("recommend_als_grid")
def _als_grid(lake):
    train = fitted.split(lake)[0].select("user_idx", "item_idx", "confidence").cache()
    tuned = recommend.tune(train)
    train.unpersist()
    return recommend.grid_report(tuned, lake.spark)


# ---------------------------------------------------------------- re-ranking
def _rfmq(lake):
    baskets = lake.once("baskets", lambda: rerank.basket_size(lake.table("cart_events")))
    return rerank.with_baskets(lake.rule_segments(), baskets)


query("rerank_basket_size")(lambda lake: rerank.basket_size(lake.table("cart_events")))
query("rerank_basket_summary")(lambda lake: rerank.basket_summary(rerank.basket_size(lake.table("cart_events"))))
query("rerank_basket_filled")(lambda lake: _rfmq(lake).select("customer_id", "rfm_segment", "avg_qty_per_order"))
query("rerank_segment_baskets")(lambda lake: rerank.segment_baskets(_rfmq(lake)))
query("rerank_standardised")(lambda lake: rerank.standardised(_rfmq(lake)).select(
    "customer_id", *[F.round(z, 6).alias(z) for z in rerank.Z.values()]))


@query("rerank_entropy_weights")
def _entropy(lake):
    weights = rerank.entropy_weights(rerank.standardised(_rfmq(lake)))
    return lake.spark.createDataFrame([tuple(round(v, 6) for v in weights.values())], ", ".join(f"{k} double" for k in weights))


query("rerank_multiplier")(lambda lake: lake.rule_weighted().select(
    "customer_id", F.round("rfmq_raw_score", 6).alias("rfmq_raw_score"), F.round("rfmq_weight", 6).alias("rfmq_weight")))
query("rerank_multiplier_summary")(lambda lake: stacked([
    rerank.multiplier_summary(lake.rule_weighted(), by) for by in ("rfm_segment", "retention_priority")]))
query("rerank_multiplier_medians")(lambda lake: stacked([
    rerank.group_medians(lake.rule_weighted(), "rfm_segment", list(segments.NAMES_BY_SPEND)),
    rerank.group_medians(lake.rule_weighted(), "retention_priority", list(reports.PRIORITIES))]))
query("rerank_matrix_weights")(lambda lake: lake.rule_segments().select(
    "customer_id", rerank.matrix_weight(F.col("rfm_segment"), F.col("retention_priority")).alias("rfmq_weight")))
query("rerank_matrix_coverage")(lambda lake: rerank.matrix_coverage(lake.rule_segments()))
query("rerank_table")(lambda lake: rerank.rerank_table(lake.rule_reranked(), lake.last_day()).select(
    "customer_id", "product_id", "rfmq_rank", "als_score", *[F.round(c, 6).alias(c) for c in ("rfmq_weight", "rfmq_score")],
    "segment", "retention_priority", "churn_probability", "scored_date"))
query("rerank_summary")(lambda lake: rerank.rerank_summary(rerank.rerank_table(lake.rule_reranked(), lake.last_day())))
query("rerank_lift")(lambda lake: rerank.lift(lake.rule_reranked(), _holdout(lake)))
query("rerank_als_lift")(fitted.als_lift)

# ---------------------------------------------------------------- review insight
query("insight_text_coverage")(lambda lake: insight.text_coverage(lake.table("reviews")))
query("insight_scorable")(lambda lake: insight.scorable(lake.table("reviews")))


def _old_and_new(lake):
    """Reviews dated up to the middle of the year count as scored earlier."""
    scored = insight.labelled(insight.parsed(lake.scored_reviews()), lake.last_day())
    return scored.where("review_date < date '2024-07-01'")


query("insight_unscored")(lambda lake: insight.unscored(insight.scorable(lake.table("reviews")), _old_and_new(lake)).select("review_id", "review_date"))
query("insight_scores")(lambda lake: insight.score(insight.scorable(lake.table("reviews"))).select("review_id", "sentiment_raw"))
query("insight_parsed")(lambda lake: insight.labelled(insight.parsed(lake.scored_reviews()), lake.last_day()).drop("review_text"))


def _folded(df, key: str, text: str):
    read = df.select(key, sentiment.folded(F.col(text)).alias("read"))
    return read.select(key, F.col("read.total").alias("balance"), F.col("read.hits").alias("hits"), sentiment.verdict(F.col("read")).alias("sentiment"))


query("insight_folded_reviews")(lambda lake: _folded(insight.scorable(lake.table("reviews")), "review_id", "review_text"))
query("insight_folded_documents")(lambda lake: _folded(lake.spark.read.parquet(f"{lake.sf_dir}/documents.parquet"), "doc_id", "text"))


@query("insight_parse_failures")
def _failures(lake):
    """Replies cut in half on every seventh review: those must count as failures, not as scores."""
    cut = F.when(F.col("helpful_votes") % 7 == 0, F.expr("substr(sentiment_raw, 1, 12)")).otherwise(F.col("sentiment_raw"))
    return insight.parse_failures(insight.parsed(lake.scored_reviews().withColumn("sentiment_raw", cut)))


query("insight_distribution")(lambda lake: insight.sentiment_distribution(lake.rule_insights()))
query("insight_hidden_dissatisfaction")(lambda lake: insight.hidden_dissatisfaction(lake.rule_insights()))


@query("insight_table")
def _insights(lake):
    """Incremental run: earlier scores, new scores, and tonight's customer columns on all of them."""
    old = _old_and_new(lake)
    new = insight.labelled(insight.parsed(insight.score(insight.unscored(insight.scorable(lake.table("reviews")), old))), lake.last_day())
    return insight.insights(insight.merged(old, new), lake.rule_predictions(), lake.rule_segments())


query("insight_urgent_negative")(lambda lake: insight.urgent_negative(lake.rule_insights()))
query("insight_by_risk_band")(lambda lake: insight.by_risk_band(insight.labelled(insight.parsed(lake.scored_reviews()), lake.last_day()).join(
    rules.banded(lake.rfm_filled()), "customer_id", "left")))
query("insight_complaints")(lambda lake: insight.complaints(lake.rule_insights()))
query("insight_with_complaint")(lambda lake: insight.with_complaint(lake.rule_insights(), "slow delivery").select("review_id", "customer_id", "issues"))

# ---------------------------------------------------------------- reports


def _three(lake):
    return lake.rule_predictions(), lake.rule_segments(), lake.rule_insights()


query("report_funnel")(lambda lake: reports.funnel(*_three(lake)))
query("report_call_list")(lambda lake: reports.call_list(*_three(lake), lake.rule_reranked()))
query("report_value_at_risk")(lambda lake: reports.value_at_risk(reports.call_list(*_three(lake), lake.rule_reranked())))
query("report_heat_map")(lambda lake: reports.heat_map(lake.rule_segments()))
query("report_reasons_by_band")(lambda lake: reports.reasons_by_band(lake.rule_predictions()))
query("report_call_list_fitted")(fitted.call_list)

# ---------------------------------------------------------------- what must hold for the fitted models, so that SQL can say it
query("audit_churn_predictions")(lambda lake: audits.predictions_follow(fitted.predictions(lake), fitted.effects(lake), fitted.ruled(lake)))


@query("audit_churn_logistic")
def _audit_logistic(lake):
    """The model that `churn_model_comparison` measures."""
    train = churn.balanced(fitted.modelling_table(lake).where("split = 'train'"))
    return audits.logistic_stationary(churn.load(lake.spark, fitted.compared(lake)["logistic_regression"]), train)


@query("audit_churn_trees")
def _audit_trees(lake):
    rows = feat.as_doubles(lake.features())
    return stacked([audits.trees_follow(churn.load(lake.spark, fitted.compared(lake)[name]), fitted.ensemble(lake, name), rows, name)
                    for name in ("random_forest", "boosted_trees")])


@query("audit_churn_comparison")
def _audit_comparison(lake):
    test = fitted.modelling_table(lake).where("split = 'test'")
    linear = churn.load(lake.spark, fitted.compared(lake)["logistic_regression"])
    scored = {"logistic_regression": churn.linear_probability(churn.logistic_weights(linear), linear.stages[-1].intercept, test)}
    for name in ("random_forest", "boosted_trees"):
        scored[name] = fitted.ensemble(lake, name).probability(test, ["customer_id", feat.LABEL])
    return audits.comparison_follows(fitted.model_comparison(lake), scored)


query("audit_churn_importance")(lambda lake: audits.importance_follows(
    churn.importance(fitted.effects(lake)), fitted.effects(lake), fitted.ensemble(lake, "boosted_trees"), feat.as_doubles(lake.features())))


@query("churn_rules")
def _rules(lake):
    """What the rules of the two ensembles consist of, and in how many leaves each row of the modelling table ends."""
    def described(name):
        e = fitted.ensemble(lake, name)
        return e.rules.total(lake.features(), ["customer_id"], e.values()).agg(
            F.lit(name).alias("model"), F.lit(e.rules.all_trees).alias("trees"), F.count(F.lit(1)).alias("customers"),
            F.every(F.col("leaves") == e.rules.trees).alias("one_leaf_per_tree"))
    return stacked([described(name) for name in ("random_forest", "boosted_trees")])


query("audit_segment_powers")(lambda lake: audits.powers_follow(fitted.clipped(lake), fitted.powers(lake)))
query("audit_segments")(lambda lake: audits.segments_follow(
    fitted.segment_table(lake), fitted.points(lake), fitted.centres(lake)))
@query("audit_best_items")
def _audit_best_items(lake):
    model = fitted.als_model(lake)
    return audits.best_items_follow(retrieval.best(fitted.searched(lake)), model.userFactors, model.itemFactors, recommend.TOP).join(
        fitted.ids(lake)[0].withColumn("user", F.col("user_idx").cast("long")), "user").select("customer_id", "offers", "scores_follow", "none_better")


query("audit_recommendations")(lambda lake: audits.recommendations_follow(fitted.recommendation_table(lake)))
