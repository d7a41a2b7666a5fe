"""Alert on a fresh negative review of a valuable customer who is likely to leave."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.operators import insight
from keepwell.operators.segments import CHAMPIONS

THRESHOLD = 0.5


def alerts(reviews: DataFrame, churn: DataFrame, segments: DataFrame, offers: DataFrame, threshold: float = THRESHOLD,
           scorer: insight.Scorer = insight.lexicon_scorer) -> DataFrame:
    """Streaming or batch reviews -> alert rows. The customer tables are static sides of stream-static joins."""
    watched = (churn.where(F.col("churn_probability") >= threshold)
               .select("customer_id", "churn_probability", "churn_risk_band", "top_churn_reason")
               .join(segments.where(F.col("rfm_segment") == CHAMPIONS).select("customer_id", "rfm_segment", "retention_priority"), "customer_id")
               .join(offers, "customer_id", "left"))
    negative = insight.parsed(insight.score(insight.scorable(reviews), scorer)).where("sentiment = 'negative'")
    return negative.select("review_id", "customer_id", "rating", "review_date", "sentiment", "sentiment_score", "issues").join(watched, "customer_id")
