"""The customer-product signals behind the recommender, and reports about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.operators.profiling import pct, stacked

# fixed values: confidence of each signal
PURCHASE, CART, LIKED = 1.0, 0.5, 2.0
CART_SIGNALS = ("cart_add", "wishlist_add")
MIN_LIKED_RATING = 4
COLD_CUSTOMER, COLD_PRODUCT, THIN_HISTORY = 3, 5, 5


def purchases(orders: DataFrame) -> DataFrame:
    return orders.where("customer_id is not null and product_id is not null")


def cart_signals(cart_events: DataFrame) -> DataFrame:
    return cart_events.where(F.col("action").isin(*CART_SIGNALS))


def real_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.where(~F.col("_is_ghost_order"))


def liked(reviews: DataFrame) -> DataFrame:
    return real_reviews(reviews).where(F.col("rating") >= MIN_LIKED_RATING)


def within_months(df: DataFrame, date: str, months: int, as_of: Column) -> DataFrame:
    """Rows at most `months` months before `as_of`; undated rows drop out. The plain bound in front of the exact test is one
    that a scan can use; it is a few days wider, for the ends of months."""
    earliest = F.date_sub(F.add_months(as_of, -months), 4)
    return df.where((F.col(date) >= earliest) & (F.months_between(as_of, F.col(date)) <= months))


def signals(orders: DataFrame, cart_events: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every signal with its confidence; purchases also carry their date. A pair needs both ids."""
    def signal(df: DataFrame, confidence: float, date: Column) -> DataFrame:
        return df.where("customer_id is not null and product_id is not null").select("customer_id", "product_id", F.lit(confidence).alias("confidence"), date.alias("order_date"))
    undated = F.lit(None).cast("date")
    return (signal(purchases(orders), PURCHASE, F.col("order_date"))
            .unionByName(signal(cart_signals(cart_events), CART, undated))
            .unionByName(signal(liked(reviews), LIKED, undated)))


def interaction_matrix(orders: DataFrame, cart_events: DataFrame, reviews: DataFrame) -> DataFrame:
    """Strongest signal and latest purchase date per pair: one shuffle, combined map-side."""
    return (signals(orders, cart_events, reviews).groupBy("customer_id", "product_id")
            .agg(F.max("confidence").alias("confidence"), F.max("order_date").alias("order_date")))


def windowed_matrix(orders: DataFrame, cart_events: DataFrame, reviews: DataFrame, months: int, as_of: Column) -> DataFrame:
    return interaction_matrix(within_months(orders, "order_date", months, as_of),
                              within_months(cart_events, "event_date", months, as_of),
                              within_months(reviews, "review_date", months, as_of))


# ---------------------------------------------------------------- reports
def matrix_size(orders: DataFrame) -> DataFrame:
    """Customers, products, possible pairs, observed orders and the share of empty cells."""
    n = purchases(orders).agg(F.count_distinct("customer_id").alias("customers"), F.count_distinct("product_id").alias("products"),
                              F.count("order_id").alias("interactions"))
    possible = F.col("customers") * F.col("products")
    return n.withColumns({"possible_pairs": possible,
                          "sparsity": F.round(1 - F.try_divide(F.col("interactions"), possible), 8)})


def cold_warm(orders: DataFrame, key: str, threshold: int) -> DataFrame:
    per_key = purchases(orders).groupBy(key).agg(F.count("order_id").alias("orders"))
    return (per_key.agg(F.count_if(F.col("orders") < threshold).alias("cold"), F.count_if(F.col("orders") >= threshold).alias("warm"))
            .select(F.lit(key).alias("entity"), "cold", "warm", pct(F.col("cold"), F.col("cold") + F.col("warm"), 1).alias("cold_pct")))


def top_products(orders: DataFrame, n: int = 10) -> DataFrame:
    return (purchases(orders).groupBy("product_id")
            .agg(F.count("order_id").alias("purchase_count"), F.count_distinct("customer_id").alias("unique_buyers"))
            .orderBy(F.desc("purchase_count"), "product_id").limit(n))


def repeat_purchases(orders: DataFrame) -> DataFrame:
    return (purchases(orders).groupBy("customer_id", "product_id").agg(F.count("order_id").alias("times"))
            .agg(F.count_if(F.col("times") > 1).alias("repeat_pairs"), F.count(F.lit(1)).alias("pairs")))


def pairs_per_signal(orders: DataFrame, cart_events: DataFrame, reviews: DataFrame) -> DataFrame:
    sources = {"purchase": purchases(orders), "cart": cart_signals(cart_events), "liked_review": liked(reviews)}
    return stacked([df.groupBy("customer_id", "product_id").agg(F.lit(1)).agg(F.count(F.lit(1)).alias("pairs"))
                    .select(F.lit(name).alias("signal"), "pairs") for name, df in sources.items()])


def confidence_distribution(matrix: DataFrame) -> DataFrame:
    return matrix.groupBy("confidence").agg(F.count(F.lit(1)).alias("pairs"))


def window_coverage(orders: DataFrame, months: list[int], as_of: Column) -> DataFrame:
    """Orders, customers and products kept by each trailing window.

    An entity is kept when its latest order is, so one row per entity answers every window.
    """
    def kept(column: str, m: int) -> Column:
        return F.coalesce(F.months_between(as_of, F.col(column)) <= m, F.lit(False))

    def per(entity: str) -> DataFrame:
        latest = purchases(orders).groupBy(f"{entity}_id").agg(
            F.max("order_date").alias("latest"), F.count("order_id").alias("n"),
            *[F.count_if(kept("order_date", m)).alias(f"n{m}") for m in months])
        windows = [F.struct(F.lit(m).alias("months"), F.sum(f"n{m}").alias("orders"),
                            F.count_if(kept("latest", m)).alias(f"{entity}s")).alias(f"w{m}") for m in months]
        totals = latest.agg(F.sum("n").alias("all_orders"), F.count(F.lit(1)).alias(f"all_{entity}s"), *windows)
        return totals.select("all_orders", f"all_{entity}s", F.inline(F.array(*[f"w{m}" for m in months])))

    both = per("customer").join(per("product").drop("orders", "all_orders"), "months")
    return both.withColumns({"order_pct": pct(F.col("orders"), F.col("all_orders"), 1),
                             "customer_pct": pct(F.col("customers"), F.col("all_customers"), 1),
                             "product_pct": pct(F.col("products"), F.col("all_products"), 1)})


def signal_density(matrix: DataFrame) -> DataFrame:
    per_customer = matrix.groupBy("customer_id").agg(F.count("product_id").alias("signals"))
    return (per_customer.agg(F.round(F.avg("signals"), 6).alias("mean_signals"), F.max("signals").alias("max_signals"),
                             F.count_if(F.col("signals") < THIN_HISTORY).alias("thin_customers"), F.count(F.lit(1)).alias("customers"))
            .withColumn("thin_pct", pct(F.col("thin_customers"), F.col("customers"), 1)))


def rating_split(reviews: DataFrame) -> DataFrame:
    r = F.col("rating")
    return real_reviews(reviews).agg(F.count_if(r >= 4).alias("high"), F.count_if(r == 3).alias("neutral"), F.count_if(r <= 2).alias("low"))


def missing_products(orders: DataFrame) -> DataFrame:
    """Orders that lost their product, by status, with and without a customer."""
    return (orders.where("product_id is null").groupBy("order_status")
            .agg(F.count(F.lit(1)).alias("orders"), F.count("customer_id").alias("with_customer"))
            .withColumn("without_customer", F.col("orders") - F.col("with_customer")))


def date_range(orders: DataFrame) -> DataFrame:
    return purchases(orders).agg(F.min("order_date").alias("earliest"), F.max("order_date").alias("latest"))
