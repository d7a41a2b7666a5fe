"""Reports across the models: funnel, call list, value at risk, heat map and reasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.functions import exact

RECOVERY = 0.25
PRIORITIES = ("Urgent", "High", "Medium", "Low")


def latest_complaint(insights: DataFrame) -> DataFrame:
    """Newest negative review with a named issue, per customer."""
    named = insights.where("sentiment = 'negative' and issues is not null and issues <> '[]'")
    newest = F.max(F.struct("review_date", "review_id", "issues"))
    return named.groupBy("customer_id").agg(newest["review_id"].alias("review_id"), newest["issues"].alias("issues"))


def _joined(churn: DataFrame, segments: DataFrame, insights: DataFrame) -> DataFrame:
    """One row per scored customer: every side is unique on the customer."""
    return (churn.select("customer_id", "churn_probability", "churn_risk_band", "top_churn_reason")
            .join(segments.select("customer_id", "rfm_segment", "retention_priority", "total_spent"), "customer_id", "left")
            .join(latest_complaint(insights), "customer_id", "left"))


def funnel(churn: DataFrame, segments: DataFrame, insights: DataFrame) -> DataFrame:
    """Scored customers down to those worth a call today."""
    urgent = F.coalesce(F.col("retention_priority") == "Urgent", F.lit(False))
    return _joined(churn, segments, insights).agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.col("churn_risk_band") == "Critical").alias("critical"),
        F.count_if(urgent).alias("urgent_champions"), F.count_if(urgent & F.col("issues").isNotNull()).alias("call_ready"))


def offers(reranked: DataFrame, n: int = 3) -> DataFrame:
    """The first `n` products of each customer in rank order, as one text."""
    ranked = F.sort_array(F.collect_list(F.struct("rfmq_rank", "product_id")))
    return reranked.where(F.col("rfmq_rank") <= n).groupBy("customer_id").agg(
        F.array_join(F.transform(ranked, lambda r: r["product_id"]), ", ").alias("offers"))


def call_list(churn: DataFrame, segments: DataFrame, insights: DataFrame, reranked: DataFrame) -> DataFrame:
    """Who to call, why, what went wrong and what to offer."""
    callers = _joined(churn, segments, insights).where("retention_priority = 'Urgent' and issues is not null")
    return callers.join(offers(reranked), "customer_id", "left").select(
        "customer_id", "rfm_segment", "churn_probability", "churn_risk_band", "top_churn_reason", "issues", "total_spent", "offers")


def value_at_risk(calls: DataFrame, share: float = RECOVERY) -> DataFrame:
    return calls.agg(F.count(F.lit(1)).alias("customers"), F.coalesce(exact.total("total_spent"), F.lit(0.0)).alias("spend_at_risk")).withColumns({
        "recovered_customers": F.ceil(F.col("customers") * F.lit(share)),
        "recovered_spend": F.round(exact.money("spend_at_risk") * F.lit(share).cast("decimal(4,2)"), 2).cast("double")})


def heat_map(segments: DataFrame) -> DataFrame:
    return segments.groupBy("rfm_segment").pivot("retention_priority", list(PRIORITIES)).agg(F.count(F.lit(1))).fillna(0)


def reasons_by_band(churn: DataFrame) -> DataFrame:
    return churn.groupBy("churn_risk_band", "top_churn_reason").agg(F.count(F.lit(1)).alias("customers"))
