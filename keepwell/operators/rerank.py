"""Value-weighted re-ranking: recency, frequency, spend and basket size into one multiplier per customer."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.functions import exact
from keepwell.functions.ordering import grouped_quantiles, quantiles
from keepwell.operators import recommend
from keepwell.operators.segments import AT_RISK, CHAMPIONS, LOYAL

DIMENSIONS = ("recency_days", "total_orders", "total_spent", "avg_qty_per_order")
Z = {"recency_days": "R_scaled", "total_orders": "F_scaled", "total_spent": "M_scaled", "avg_qty_per_order": "Q_scaled"}
INVERTED = ("recency_days",)
# fixed values
SHIFT, LOW, HIGH = 0.0001, 0.5, 1.5
WEIGHT_MATRIX = {
    (CHAMPIONS, "Urgent"): 1.5, (CHAMPIONS, "High"): 1.3, (CHAMPIONS, "Medium"): 1.1, (CHAMPIONS, "Low"): 1.0,
    (LOYAL, "Urgent"): 1.3, (LOYAL, "High"): 1.2, (LOYAL, "Medium"): 1.0, (LOYAL, "Low"): 0.9,
    (AT_RISK, "Urgent"): 1.1, (AT_RISK, "High"): 1.0, (AT_RISK, "Medium"): 0.9, (AT_RISK, "Low"): 0.8,
}
DEFAULT_WEIGHT = 1.0


def basket_size(cart_events: DataFrame) -> DataFrame:
    """Mean items added per cart session and the number of sessions, per customer."""
    added = cart_events.where("action = 'cart_add' and customer_id is not null and quantity > 0")
    sessions = added.groupBy("customer_id", "session_id").agg(F.sum("quantity").alias("items"))
    return sessions.groupBy("customer_id").agg(exact.mean("items").alias("avg_qty_per_order"), F.count("session_id").alias("session_count"))


def basket_summary(baskets: DataFrame) -> DataFrame:
    q = F.col("avg_qty_per_order")
    quartiles = zip(("p25_q", "median_q", "p75_q"), quantiles(baskets, "avg_qty_per_order", [0.25, 0.5, 0.75]))
    return baskets.agg(F.min(q).alias("min_q"), F.max(q).alias("max_q"), exact.mean(q, 6).alias("mean_q"),
                       *[F.round(F.max(F.lit(v).cast("double")), 6).alias(name) for name, v in quartiles])


def with_baskets(segments: DataFrame, baskets: DataFrame) -> DataFrame:
    """Basket size per segmented customer; the median stands in where there is no cart signal."""
    median = F.lit(quantiles(baskets, "avg_qty_per_order", [0.5])[0]).cast("double")
    q = baskets.select("customer_id", "avg_qty_per_order")
    return segments.join(q, "customer_id", "left").withColumn("avg_qty_per_order", F.coalesce("avg_qty_per_order", median))


def segment_baskets(rfmq: DataFrame) -> DataFrame:
    return rfmq.groupBy("rfm_segment").agg(exact.mean("avg_qty_per_order").alias("avg_q"))


def standardised(rfmq: DataFrame) -> DataFrame:
    """Population z-scores; recency is turned round so that larger is always better.

    The four means and deviations are fitted first (eight numbers) and enter as constants.
    """
    x = {c: F.col(c).cast("double") for c in DIMENSIONS}
    fitted = rfmq.agg(*[f(x[c]).alias(f"{c}_{n}") for c in DIMENSIONS for n, f in (("mean", F.avg), ("std", F.stddev_pop))]).first()

    def z(c: str) -> Column:
        mean, std, sign = fitted[f"{c}_mean"], fitted[f"{c}_std"], -1.0 if c in INVERTED else 1.0
        return (x[c] - F.lit(mean)) / F.lit(std) * F.lit(sign) if std else F.lit(0.0)
    return rfmq.withColumns({Z[c]: z(c) for c in DIMENSIONS})


def entropy_weights(z_scores: DataFrame) -> dict[str, float]:
    """Entropy e_* and weight w_* of each dimension; the weights add up to 1.

    Scores are shifted above zero and taken as proportions p = x / S. Since
    e = -sum(p ln p) / ln n = (ln S - sum(x ln x) / S) / ln n, the sums S and sum(x ln x) are enough:
    one aggregate for the shifts and one for the sums.
    """
    columns = [Z[c] for c in DIMENSIONS]
    lows = z_scores.agg(*[F.min(c) for c in columns]).first()
    sums = []
    for c, low in zip(columns, lows):
        x = F.col(c) + F.lit(abs(low) + SHIFT)
        sums += [F.sum(x), F.sum(F.when(x > 0, x * F.ln(x)).otherwise(0.0))]
    n, *totals = z_scores.agg(F.count(F.lit(1)), *sums).first()
    if n < 2:
        return {f"{k}_{c[0]}": v for c in columns for k, v in (("e", 1.0), ("w", 1.0 / len(columns)))}
    entropy = {c[0]: (math.log(s) - t / s) / math.log(n) for c, s, t in zip(columns, totals[::2], totals[1::2])}
    spread = sum(1.0 - e for e in entropy.values())
    return {**{f"e_{d}": e for d, e in entropy.items()}, **{f"w_{d}": (1.0 - e) / spread for d, e in entropy.items()}}


def multiplier(z_scores: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weighted score per customer, stretched to [0.5, 1.5]."""
    scored = z_scores.withColumn("rfmq_raw_score", sum((F.lit(weights[f"w_{z[0]}"]) * F.col(z) for z in Z.values()), F.lit(0.0)))
    low, high = scored.agg(F.min("rfmq_raw_score"), F.max("rfmq_raw_score")).first()
    position = (F.col("rfmq_raw_score") - F.lit(low)) / F.lit(high - low) if low is not None and high > low else F.lit(0.5)
    return scored.withColumn("rfmq_weight", position * F.lit(HIGH - LOW) + F.lit(LOW))


def multiplier_summary(weighted: DataFrame, by: str) -> DataFrame:
    """Spread of the multiplier per segment or priority; the median is exact per group."""
    groups = weighted.groupBy(by).agg(F.round(F.avg("rfmq_weight"), 6).alias("mean_weight"), F.round(F.min("rfmq_weight"), 6).alias("min_weight"),
                                      F.round(F.max("rfmq_weight"), 6).alias("max_weight"), F.count(F.lit(1)).alias("customers"))
    return groups.withColumnRenamed(by, "group_name").withColumn("grouped_by", F.lit(by))


def group_medians(weighted: DataFrame, by: str, values: list[str]) -> DataFrame:
    """Exact median multiplier of each listed group, all groups in the same passes; null where a group is empty."""
    medians = grouped_quantiles(weighted, [by], "rfmq_weight", [0.5]).select(F.col(by).alias("group_name"), F.round("value", 6).alias("median_weight"))
    listed = weighted.sparkSession.createDataFrame([(by, v) for v in values], "grouped_by string, group_name string")
    return listed.join(medians, "group_name", "left").select("grouped_by", "group_name", "median_weight")


def matrix_weight(segment: Column, priority: Column) -> Column:
    """Weight from the fixed segment x priority matrix, 1.0 for combinations it does not list."""
    pairs = [F.lit(x) for (s, p), w in WEIGHT_MATRIX.items() for x in (f"{s}|{p}", w)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.concat_ws("|", segment, priority)), F.lit(DEFAULT_WEIGHT))


def matrix_coverage(segments: DataFrame) -> DataFrame:
    """Which combinations occur, how often, and whether the matrix lists them."""
    listed = F.concat_ws("|", "rfm_segment", "retention_priority").isin([f"{s}|{p}" for s, p in WEIGHT_MATRIX])
    return (segments.groupBy("rfm_segment", "retention_priority").agg(F.count(F.lit(1)).alias("customers"))
            .withColumns({"rfmq_weight": matrix_weight(F.col("rfm_segment"), F.col("retention_priority")), "is_listed": listed}))


def reranked(recs: DataFrame, weighted: DataFrame) -> DataFrame:
    """Scores times the customer's multiplier, ranked again within the customer.

    The multiplier is one positive number per customer, so the order within a customer stays.
    """
    weights = weighted.select("customer_id", "rfmq_weight", "rfm_segment", "retention_priority", "churn_probability")
    scored = recs.join(weights, "customer_id").withColumn("rfmq_score", F.col("als_score") * F.col("rfmq_weight"))
    order = Window.partitionBy("customer_id").orderBy(F.desc("rfmq_score"), F.col("rank"))
    return scored.withColumn("rfmq_rank", F.row_number().over(order))


def rerank_table(scored: DataFrame, as_of: Column) -> DataFrame:
    return scored.select("customer_id", "product_id", "rfmq_rank", "als_score", "rfmq_weight", "rfmq_score",
                         F.col("rfm_segment").alias("segment"), "retention_priority", "churn_probability", as_of.alias("scored_date"))


def rerank_summary(table: DataFrame) -> DataFrame:
    return table.groupBy("segment", "retention_priority").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.avg("rfmq_score"), 6).alias("avg_rfmq_score"),
        F.round(F.max("rfmq_score"), 6).alias("max_rfmq_score"), F.round(F.avg("rfmq_weight"), 6).alias("avg_weight"))


def lift(scored: DataFrame, holdout: DataFrame) -> DataFrame:
    """Both rankings judged on the same holdout, with the relative change of each measure."""
    from keepwell.operators.profiling import stacked
    both = stacked([recommend.evaluate(scored, holdout, column).withColumn("ranking", F.lit(name))
                    for name, column in (("als", "rank"), ("rfmq", "rfmq_rank"))])
    base = both.where("ranking = 'als'").select(F.struct("precision", "ndcg").alias("b")).scalar()
    return both.withColumns({"precision_lift_pct": F.round(F.try_divide(F.col("precision") - base["precision"], base["precision"]) * 100, 6),
                             "ndcg_lift_pct": F.round(F.try_divide(F.col("ndcg") - base["ndcg"], base["ndcg"]) * 100, 6)})
