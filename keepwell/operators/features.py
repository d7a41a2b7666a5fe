"""Behavioural features per customer and the churn label.

Every source is reduced to one row per customer before it is joined, and all reductions are hash
partitioned on the customer, so the joins need no further shuffle and no join key repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.functions import exact
from keepwell.functions.ordering import quantiles
from keepwell.session import stored

# fixed values
CLIP = 0.99
CHURN_DAYS, CHURN_MIN_ORDERS = 90, 2
DEFAULT_PAYMENT, DEFAULT_RATING = "UPI", 3.0
ORGANIC, SOCIAL = "organic_search", "social_media"

FEATURES = ("recency_days", "total_orders", "total_spent", "avg_order_value", "refund_count", "refund_rate", "abandon_rate",
            "avg_pages_viewed", "avg_session_duration", "session_count", "pct_organic", "pct_social", "avg_rating", "payment_idx")
LABEL = "churn_label"
DECIMALS = {"total_spent": "decimal(18,2)", "avg_order_value": "decimal(18,2)", "refund_rate": "decimal(9,2)",
            "avg_pages_viewed": "decimal(9,2)", "avg_session_duration": "decimal(12,2)", "avg_rating": "decimal(3,1)"}


def known_orders(orders: DataFrame) -> DataFrame:
    """Orders with a customer; the order total is recomputed, and unknown where the discount is."""
    net = exact.money("order_amount") - exact.money("discount_amount")
    return orders.where("customer_id is not null").withColumn("total_amount", net.cast("double"))


def as_of_column(orders: DataFrame, as_of=None) -> Column:
    return F.lit(as_of).cast("date") if as_of else orders.agg(F.max("order_date")).scalar()


def rfm_base(orders: DataFrame, as_of=None) -> DataFrame:
    """Recency counts from `as_of` (default: last order date); it is null for a customer none of whose dates
    could be read."""
    per_customer = known_orders(orders).groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"), F.count("order_id").alias("total_orders"),
        exact.total("total_amount").alias("total_spent"), exact.mean("total_amount").alias("avg_order_value"))
    return per_customer.withColumn("recency_days", F.datediff(as_of_column(orders, as_of), F.col("last_order_date")))


def winsorised(df: DataFrame, columns: list[str], p: float = CLIP) -> DataFrame:
    """Cap each column at its exact p-quantile; as `least` skips nulls, an unknown value takes the cap.
    `df` should be written or cached: finding the cap reads it twice."""
    caps = {c: F.lit(quantiles(df, c, [p])[0]).cast("double") for c in columns}
    return df.withColumns({c: F.least(F.col(c).cast("double"), cap) for c, cap in caps.items()})


def refund_features(refunds: DataFrame) -> DataFrame:
    return refunds.where("customer_id is not null").groupBy("customer_id").agg(F.count("refund_id").alias("refund_count"))


def cart_adds(cart_events: DataFrame) -> DataFrame:
    return (cart_events.where("action = 'cart_add' and customer_id is not null").groupBy("customer_id")
            .agg(F.count("event_id").alias("cart_adds")))


def abandonment(adds: Column, orders: Column) -> Column:
    """Share of cart additions not followed by an order, within [0, 1]; no additions means 0."""
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(adds - orders, adds)))
    return F.when(adds > 0, share).otherwise(F.lit(0.0))


def session_features(sessions: DataFrame) -> DataFrame:
    """Engagement and channel shares together: one aggregation of the sessions."""
    def share(channel: str) -> Column:
        return F.avg(F.when(F.col("channel") == channel, 1).otherwise(0))
    return sessions.where("customer_id is not null").groupBy("customer_id").agg(
        exact.mean("pages_viewed").alias("avg_pages_viewed"), exact.mean("session_duration_seconds").alias("avg_session_duration"),
        F.count("session_id").alias("session_count"), share(ORGANIC).alias("pct_organic"), share(SOCIAL).alias("pct_social"))


def preferred_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Most used payment method over a customer's orders; equal counts go to the first name."""
    used = (orders.where("customer_id is not null").select("order_id", "customer_id")
            .join(payments.where("payment_method is not null").select("order_id", "payment_method"), "order_id")
            .groupBy("customer_id", "payment_method").agg(F.count("order_id").alias("uses")))
    best = F.min(F.struct((-F.col("uses")).alias("rank"), "payment_method"))["payment_method"]
    return used.groupBy("customer_id").agg(best.alias("preferred_payment"))


def rating_features(reviews: DataFrame) -> DataFrame:
    return reviews.where("customer_id is not null").groupBy("customer_id").agg(exact.mean("rating", 1).alias("avg_rating"))


def churn_label(recency: Column, orders: Column) -> Column:
    """1 for a lapsed repeat customer; 0 where the recency is unknown."""
    return F.when((recency > CHURN_DAYS) & (orders >= CHURN_MIN_ORDERS), 1).otherwise(0)


def by_frequency(df: DataFrame, column: str, name: str) -> DataFrame:
    """Index of each value by descending frequency, ties by value.

    Meant for columns with a closed set of values (payment methods): the ranking runs over the
    distinct values only. `ordering.numbered` is the version for keys of any number.
    """
    from pyspark.sql import Window
    ranked = df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).select(
        column, (F.row_number().over(Window.orderBy(F.desc("n"), column)) - 1).cast("double").alias(name))
    return df.join(ranked, column, "left")


def customer_base(known: DataFrame) -> DataFrame:
    """`rfm_base`, written, with orders and spend capped and what is unknown flagged; recency is not filled yet."""
    flags = {"recency_unknown": F.col("recency_days").isNull().cast("int"), "spent_unknown": F.col("total_spent").isNull().cast("int")}
    return winsorised(known.withColumns(flags), ["total_orders", "total_spent"])


def usual_recency(base: DataFrame) -> Column:
    """Whole days of the mean recency, for customers whose own is unknown."""
    return F.coalesce(base.agg(F.floor(F.avg("recency_days")).cast("int")).scalar(), F.lit(0))


def _rounded(c: str) -> Column:
    return F.round(c, 2 if c != "avg_rating" else 1).cast(DECIMALS[c]).alias(c) if c in DECIMALS else F.col(c)


def rfm_filled(base: DataFrame) -> DataFrame:
    """Recency, orders and spend as they stand in the feature table; they follow from the orders alone."""
    return base.withColumn("recency_days", F.coalesce("recency_days", usual_recency(base))).select(
        "customer_id", *[_rounded(c) for c in ("recency_days", "total_orders", "total_spent")])


def feature_table(orders: DataFrame, payments: DataFrame, refunds: DataFrame, cart_events: DataFrame,
                  sessions: DataFrame, reviews: DataFrame, as_of=None, base: DataFrame | None = None) -> DataFrame:
    """One row per ordering customer: id, 14 features, label; no nulls.

    An unknown recency takes part in the label as unknown and is then filled with the whole days of the mean recency; an
    unknown spend takes the cap. `recency_unknown` and `spent_unknown` flag both."""
    if base is None:
        base = customer_base(stored(rfm_base(orders, as_of), "rfm_base"))
    joined = base
    for side in (refund_features(refunds), cart_adds(cart_events), session_features(sessions),
                 preferred_payment(orders, payments), rating_features(reviews)):
        joined = joined.join(side, "customer_id", "left")
    filled = joined.fillna({"refund_count": 0, "avg_pages_viewed": 0.0, "avg_session_duration": 0.0, "session_count": 0,
                            "pct_organic": 0.0, "pct_social": 0.0, "preferred_payment": DEFAULT_PAYMENT,
                            "avg_rating": DEFAULT_RATING, "avg_order_value": 0.0})
    derived = filled.withColumns({
        "refund_rate": exact.ratio(F.col("refund_count"), F.col("total_orders")),
        "abandon_rate": abandonment(F.col("cart_adds"), F.col("total_orders")),
        LABEL: churn_label(F.col("recency_days"), F.col("total_orders"))}).withColumn("recency_days", F.coalesce("recency_days", usual_recency(base)))
    indexed = by_frequency(derived, "preferred_payment", "payment_idx")
    return indexed.select("customer_id", *map(_rounded, FEATURES), "recency_unknown", "spent_unknown", LABEL)


def as_doubles(features: DataFrame) -> DataFrame:
    """Decimals back to doubles, the form the models take."""
    return features.withColumns({c: F.col(c).cast("double") for c in DECIMALS})
