"""Clean tables -> star schema: dimensions, facts and three aggregates.

No broadcast hints: dimensions are joined as they are, so Spark broadcasts a side only when its
measured size is under the session threshold and otherwise shuffles (with AQE skew splitting).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.functions import exact

# ---------------------------------------------------------------- calendar
# Single event days, multi-day events and yearly events of the sales calendar.
DIWALI = ("2020-11-14", "2021-11-04", "2022-10-24", "2023-11-12", "2024-11-01", "2025-10-20", "2026-11-08")
DHANTERAS = ("2020-11-13", "2021-11-02", "2022-10-22", "2023-11-10", "2024-10-29", "2025-10-18", "2026-11-06")
HOLI = ("2020-03-09", "2021-03-28", "2022-03-18", "2023-03-07", "2024-03-25", "2025-03-14", "2026-03-04")
DHAMAKA = (("2020-11-02", "2020-11-11"), ("2021-10-23", "2021-11-01"), ("2022-10-12", "2022-10-21"), ("2023-10-31", "2023-11-09"),
           ("2024-10-20", "2024-10-29"), ("2025-10-08", "2025-10-17"), ("2026-10-27", "2026-11-05"))
NAVRATRI = (("2020-10-17", "2020-10-25"), ("2021-10-07", "2021-10-15"), ("2022-10-02", "2022-10-10"), ("2023-10-15", "2023-10-23"),
            ("2024-10-03", "2024-10-11"), ("2025-09-22", "2025-09-30"), ("2026-10-11", "2026-10-19"))
LOCKDOWN = ("2020-03-25", "2020-06-07")
WEDDING_PATTERN = "month in (12, 1, 2, 4) or (month in (11, 3) and day >= 15)"
EOS_PATTERN = "month in (3, 6) and day between 20 and 29"
# label priority, highest first; these events also make a day festive
FESTIVE = (("is_diwali", "Diwali"), ("is_dhanteras", "Dhanteras"), ("is_dhamaka_days", "Dhamaka Days"),
           ("is_navratri", "Navratri"), ("is_holi", "Holi"), ("is_republic_day", "Republic Day"),
           ("is_independence_day", "Independence Day"), ("is_valentines_day", "Valentine's Day"),
           ("is_christmas", "Christmas"), ("is_eos_sale", "End of Season Sale"))
CALENDAR_START, CALENDAR_END = "2020-01-01", "2026-12-31"


def _on(days) -> Column:
    return F.col("date_key").isin([F.lit(d).cast("date") for d in days])


def _during(runs) -> Column:
    """Inside one of the runs of days, both ends included."""
    return reduce(Column.__or__, [F.col("date_key").between(*[F.lit(x).cast("date") for x in run]) for run in runs])


def dim_date(spark, start=CALENDAR_START, end=CALENDAR_END) -> DataFrame:
    """One row per day with calendar parts, April-March fiscal periods and event flags."""
    as_date = [x if isinstance(x, Column) else F.lit(x) for x in (start, end)]
    days = spark.range(1).select(F.explode(F.sequence(*[c.cast("date") for c in as_date])).alias("date_key"))
    return calendar(days)


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes for the distinct days in `date_key`."""
    d = F.col("date_key")
    parts = days.select(
        d, F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"), F.dayofweek(d).alias("day_of_week"), F.dayofyear(d).alias("day_of_year"),
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("month_short"),
        F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "yyyy-MM").alias("year_month"))
    april_based = F.add_months(d, -3)
    flags = parts.withColumns({
        "year_quarter": F.format_string("%d-Q%d", "year", "quarter"),
        "is_weekend": F.col("day_of_week").isin(1, 7),
        "fiscal_year": F.year(april_based), "fiscal_quarter": F.quarter(april_based),
        "is_diwali": _on(DIWALI), "is_dhanteras": _on(DHANTERAS), "is_holi": _on(HOLI),
        "is_dhamaka_days": _during(DHAMAKA), "is_navratri": _during(NAVRATRI),
        "is_republic_day": F.expr("month = 1 and day = 26"), "is_independence_day": F.expr("month = 8 and day = 15"),
        "is_valentines_day": F.expr("month = 2 and day = 14"), "is_christmas": F.expr("month = 12 and day = 25"),
        "is_new_year": F.expr("month = 1 and day = 1"), "is_eos_sale": F.expr(EOS_PATTERN),
        "is_wedding_season": F.expr(WEDDING_PATTERN),
        "is_covid_lockdown": d.between(*[F.lit(x).cast("date") for x in LOCKDOWN])})
    label = F.coalesce(*[F.when(F.col(flag), name) for flag, name in FESTIVE])
    return flags.withColumns({"festive_event_name": label, "is_festive_day": label.isNotNull()})


# dates of the facts, which the calendar must cover: silver table -> columns
FACT_DATES = {"orders": ("order_date",), "payments": ("payment_date",), "shipments": ("shipped_date", "actual_delivery", "estimated_delivery"),
              "refunds": ("requested_date", "processed_date"), "reviews": ("review_date",), "sessions": ("session_date",), "cart_events": ("event_date",),
              "campaign_responses": ("event_time",), "inventory": ("snapshot_date", "last_updated")}


def sales_calendar(orders: DataFrame, extents: DataFrame) -> DataFrame:
    """Every day of the fixed calendar, widened where a fact lies outside it, with the number of orders of each day.

    `extents` has `first_day` and `last_day` of every date column of the facts, as kept when they were written."""
    bounds = extents.agg(F.struct(F.least(F.min("first_day"), F.lit(CALENDAR_START).cast("date")).alias("lo"),
                                  F.greatest(F.max("last_day"), F.lit(CALENDAR_END).cast("date")).alias("hi")).alias("b")).scalar()
    days = dim_date(orders.sparkSession, bounds["lo"], bounds["hi"])
    placed = orders.groupBy(F.col("order_date").alias("date_key")).agg(F.count("order_id").alias("orders_placed"))
    return days.join(placed, "date_key", "left").fillna(0, subset=["orders_placed"])


# ---------------------------------------------------------------- dimensions
def _tier(value: str, steps, otherwise: str) -> Column:
    """First label whose test holds; null and everything else gets `otherwise`."""
    arms = [F.when(test, label) for test, label in steps(F.col(value))]
    return F.coalesce(*arms, F.lit(otherwise))


def dim_customer(customers: DataFrame, geo: DataFrame) -> DataFrame:
    place = geo.select("pincode", "region", "latitude", "longitude")
    return (customers.join(place, "pincode", "left")
            .fillna({"region": "Unknown", "latitude": 0.0, "longitude": 0.0})
            .withColumn("full_name", F.concat_ws(" ", "first_name", "last_name")))


def dim_product(products: DataFrame, brands: DataFrame, categories: DataFrame) -> DataFrame:
    price, cost = exact.money("retail_price"), exact.money("cost_price")
    return (products.drop("unit_size")
            .join(brands.select("brand_id", "brand_name", F.col("is_premium").alias("is_premium_brand")), "brand_id", "left")
            .join(categories.select("category_id", "category_name", "parent_category"), "category_id", "left")
            .fillna({"brand_name": "Unknown", "is_premium_brand": False, "category_name": "Unknown", "parent_category": ""})
            .withColumns({
                "margin": (price - cost).cast("double"),
                "margin_pct": F.coalesce(F.when(price > 0, exact.ratio(price - cost, price, 2, 100)), F.lit(0.0)),
                "price_tier": _tier("retail_price", lambda p: [(p < 500, "Budget"), (p < 2000, "Mid-Range"),
                                                               (p < 10000, "Premium")], "Luxury")}))


def dim_seller(sellers: DataFrame) -> DataFrame:
    return (sellers.withColumn("seller_tier", _tier("rating", lambda r: [
                (r >= 4.5, "Platinum"), (r >= 4.0, "Gold"), (r >= 3.0, "Silver")], "Bronze"))
            .withColumnsRenamed({"city": "seller_city", "state": "seller_state", "rating": "seller_rating"})
            .drop("email", "phone"))


def dim_warehouse(warehouses: DataFrame) -> DataFrame:
    return warehouses.withColumnsRenamed({"city": "warehouse_city", "state": "warehouse_state"})


def dim_geo(geo: DataFrame) -> DataFrame:
    return geo.select("pincode", "city", "state", "region", "latitude", "longitude")


# ---------------------------------------------------------------- facts
def _is(column: str, value: str) -> Column:
    return F.coalesce(F.col(column) == value, F.lit(False))


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column) != "", F.lit(False))


def _real_orders(df: DataFrame) -> DataFrame:
    return df.where(~F.col("_is_ghost_order")).drop("_is_ghost_order", "_ingested_at")


def fact_orders(orders: DataFrame) -> DataFrame:
    computed = exact.money("order_amount") + exact.money("freight_value") - exact.money("discount_amount")
    return (orders.fillna(0.0, subset=["discount_amount"])
            .withColumns({"total_amount": F.coalesce(F.col("total_amount"), computed.cast("double")),
                          "used_coupon": _filled("coupon_code"), "is_cancelled": _is("order_status", "cancelled"),
                          "is_delivered": _is("order_status", "delivered")})
            .drop("order_items_json", "_ingested_at"))


def fact_payments(payments: DataFrame) -> DataFrame:
    return payments.drop("_ingested_at").withColumn("is_successful", _is("payment_status", "success"))


def fact_shipments(shipments: DataFrame) -> DataFrame:
    return _real_orders(shipments).withColumns({
        "delivery_days": F.datediff("actual_delivery", "shipped_date"),
        "delay_days": F.datediff("actual_delivery", "estimated_delivery"),
        "is_late": F.coalesce(F.col("actual_delivery") > F.col("estimated_delivery"), F.lit(False))})


def fact_reviews(reviews: DataFrame) -> DataFrame:
    return _real_orders(reviews).withColumns({
        "sentiment": _tier("rating", lambda r: [(r >= 4, "Positive"), (r == 3, "Neutral")], "Negative"),
        "has_review_text": _filled("review_text")})


def fact_refunds(refunds: DataFrame) -> DataFrame:
    return _real_orders(refunds).withColumn("processing_days", F.datediff("processed_date", "requested_date"))


def fact_commissions(commissions: DataFrame) -> DataFrame:
    return commissions.drop("_ingested_at")


def fact_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.withColumns({
        "quantity_free": F.expr("quantity_available - quantity_reserved"),
        "needs_reorder": F.expr("coalesce(quantity_available <= reorder_level, false)")})


def fact_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.select("session_id", "customer_id", "event_type", "channel", "device_type", "pages_viewed",
                           "session_start", "event_time")


def fact_cart_events(cart_events: DataFrame) -> DataFrame:
    return (cart_events.where(~F.col("_is_zero_amount"))
            .drop("_is_zero_amount", "event_date", "_source", "_ingested_at"))


def fact_campaign_responses(campaign_responses: DataFrame) -> DataFrame:
    return campaign_responses.select("response_id", "campaign_id", "customer_id", "campaign_type", "action",
                                     "category_id", "event_time")


# ---------------------------------------------------------------- aggregates
def _not_cancelled(orders: DataFrame) -> DataFrame:
    """Rows without a status go too: their comparison is null."""
    return orders.where(F.col("order_status") != "cancelled")


def _sales_measures(*names: str) -> list[Column]:
    amount = {"revenue": exact.total("order_amount"), "avg_order_value": exact.mean("order_amount"),
              "total_orders": F.count("order_id"), "delivered_orders": F.count_if(F.col("order_status") == "delivered")}
    return [amount[n] for n in names]


def agg_customer_360(orders: DataFrame, reviews: DataFrame, refunds: DataFrame, as_of=None) -> DataFrame:
    """Order, review and refund history per customer; a missing customer id forms its own row.

    Each side is reduced to one row per customer before the joins, so no join key repeats.
    `as_of` defaults to the last order date instead of the wall clock.
    """
    n, revenue, aov, delivered = _sales_measures("total_orders", "revenue", "avg_order_value", "delivered_orders")
    bought = _not_cancelled(orders).groupBy("customer_id").agg(
        n.alias("total_orders"), revenue.alias("lifetime_revenue"), aov.alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"),
        delivered.alias("delivered_orders"))
    reviewed = reviews.where(~F.col("_is_ghost_order")).groupBy("customer_id").agg(
        F.count("review_id").alias("total_reviews"), exact.mean("rating").alias("avg_rating"))
    refunded = refunds.where(~F.col("_is_ghost_order")).groupBy("customer_id").agg(
        F.count("refund_id").alias("total_refunds"), exact.total("refund_amount").alias("total_refund_amount"))
    today = F.lit(as_of).cast("date") if as_of else orders.agg(F.max("order_date")).scalar()
    return (bought.join(reviewed, "customer_id", "left").join(refunded, "customer_id", "left")
            .fillna(0, subset=["lifetime_revenue", "avg_order_value", "total_reviews", "avg_rating",
                               "total_refunds", "total_refund_amount"])
            .withColumns({
                "days_since_last_order": F.datediff(today, F.col("last_order_date")),
                "refund_rate_pct": F.coalesce(exact.ratio(F.col("total_refunds"), F.col("total_orders"), 2, 100), F.lit(0.0))}))


def agg_daily_sales(orders: DataFrame) -> DataFrame:
    n, revenue, aov, delivered = _sales_measures("total_orders", "revenue", "avg_order_value", "delivered_orders")
    return (_not_cancelled(orders).where(F.col("order_date").isNotNull()).groupBy("order_date")
            .agg(n.alias("total_orders"), revenue.alias("total_revenue"), aov.alias("avg_order_value"),
                 delivered.alias("delivered_orders")))


def agg_seller_performance(orders: DataFrame, reviews: DataFrame, commissions: DataFrame) -> DataFrame:
    n, revenue = _sales_measures("total_orders", "revenue")
    sold = (_not_cancelled(orders).where(F.col("seller_id").isNotNull()).groupBy("seller_id")
            .agg(n.alias("total_orders"), revenue.alias("total_revenue")))
    rated = reviews.where(~F.col("_is_ghost_order")).groupBy("seller_id").agg(
        exact.mean("rating").alias("avg_rating"), F.count("review_id").alias("total_reviews"))
    earned = commissions.groupBy("seller_id").agg(exact.total("commission_amount").alias("total_commission"))
    return sold.join(rated, "seller_id", "left").join(earned, "seller_id", "left").fillna(0)


def build(name: str, silver) -> DataFrame:
    """Gold table `name` from `silver(table) -> DataFrame`."""
    inputs = {
        "dim_customer": ("customers", "geo"), "dim_product": ("products", "brands", "categories"),
        "dim_seller": ("sellers",), "dim_warehouse": ("warehouses",), "dim_geo": ("geo",),
        "fact_orders": ("orders",), "fact_payments": ("payments",), "fact_shipments": ("shipments",),
        "fact_reviews": ("reviews",), "fact_refunds": ("refunds",), "fact_commissions": ("commissions",),
        "fact_inventory": ("inventory",), "fact_sessions": ("sessions",), "fact_cart_events": ("cart_events",),
        "fact_campaign_responses": ("campaign_responses",),
        "agg_customer_360": ("orders", "reviews", "refunds"), "agg_daily_sales": ("orders",),
        "agg_seller_performance": ("orders", "reviews", "commissions")}[name]
    return globals()[name](*[silver(t) for t in inputs])


TABLES = ("dim_customer", "dim_product", "dim_seller", "dim_warehouse", "dim_geo", "fact_orders", "fact_payments",
          "fact_shipments", "fact_reviews", "fact_refunds", "fact_commissions", "fact_inventory", "fact_sessions",
          "fact_cart_events", "fact_campaign_responses", "agg_customer_360", "agg_daily_sales", "agg_seller_performance")
