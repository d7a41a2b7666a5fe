"""Closed-form stand-ins for fitted models.

A fitted classifier or factorisation cannot be recomputed in SQL. Everything downstream of a model
(bands, names, priorities, re-ranking, reports) is therefore checked on predictions that follow a
stated rule over the same feature table. The fitted models run through the same operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.operators import churn, segments
from keepwell.operators.segments import Power

HALF_RISK_DAYS, FACTORS = 40.0, 8
EFFECTS = {"total_spent": -0.0000004, "avg_order_value": 0.00002, "refund_count": 0.05, "refund_rate": 2.5, "abandon_rate": 1.5,
           "avg_pages_viewed": -0.06, "avg_session_duration": -0.000001, "session_count": -0.04, "pct_organic": 0.3,
           "pct_social": -0.2, "avg_rating": -0.35, "payment_idx": 0.08}
POWERS = {"recency_days": Power(0.3, 6.0, 3.0), "total_orders": Power(0.7, 14.0, 4.0), "total_spent": Power(0.5, 2400.0, 500.0)}
CENTERS = {0: (0.2, 0.0, 0.0), 1: (0.0, 0.9, 1.0), 2: (0.6, -1.1, -1.1)}


def risk(recency: Column) -> Column:
    return recency / (recency + F.lit(HALF_RISK_DAYS))


def banded(rfm: DataFrame) -> DataFrame:
    """(customer_id, churn_probability, churn_risk_band): the part of `predictions` that recency alone decides."""
    p = risk(F.col("recency_days").cast("double"))
    return rfm.select("customer_id", p.alias("churn_probability"), churn.risk_band(p).alias("churn_risk_band"))


def predictions(features: DataFrame, as_of: Column) -> DataFrame:
    scored = features.withColumn("churn_probability", risk(F.col("recency_days").cast("double")))
    reasons = churn.top_reason(churn.linear_effects(features, EFFECTS))
    return churn.predictions(scored, reasons, as_of)


def assigned(features: DataFrame) -> DataFrame:
    """Customers on the given power transform, assigned to the given centers."""
    rfm = features.select("customer_id", *[F.col(c).cast("double").alias(c) for c in segments.RFM])
    return segments.nearest(segments.scaled(rfm, POWERS), CENTERS)


def segment_table(features: DataFrame, predictions: DataFrame, as_of: Column) -> DataFrame:
    return segments.segment_table(segments.with_names(assigned(features), POWERS), predictions, "nearest_center", None, as_of)


# ---------------------------------------------------------------- factors
def factors(ids: DataFrame, key: str, index: str, scaled: bool) -> DataFrame:
    """(id, features): whole numbers from hashes of the natural id, in place of learned factors. `scaled` gives norms that differ."""
    def byte(mark: str) -> Column:
        return F.conv(F.substring(F.md5(F.concat(F.col(key), F.lit(f"#{mark}"))), 1, 2), 16, 10).cast("double")
    size = F.pow(F.lit(2.0), F.floor(byte("n") / 32)) if scaled else F.lit(1.0)
    return ids.select(F.col(index).alias("id"), F.array(*[(byte(str(i)) - 128) * size for i in range(FACTORS)]).alias("features"))
