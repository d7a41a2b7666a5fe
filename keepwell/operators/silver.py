"""Raw tables -> clean tables: trimmed text, real types, one row per key, flagged defects.

Every builder takes the raw DataFrame and returns the clean one before expectations; `RULES` holds
the expectations per table and `clean(name, raw)` applies the dropping ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.functions.parsing import (calendar_date, currency, dates, day_of, first_of, is_ghost, is_zero,
                                        moment, text, texts, typed, typed_all)
from keepwell.operators.dedup import latest_by_key, one_by_key
from keepwell.operators.quality import drop, drop_violations, warn


def customers(raw: DataFrame) -> DataFrame:
    names = texts("customer_id", "first_name", "last_name", "email", "gender", "city", "state", "pincode", "loyalty_tier")
    return one_by_key(raw.select(
        *names, text("phone_number").alias("phone"), *typed_all("date", "date_of_birth", "registration_date"),
        *typed_all("boolean", "is_active")), "customer_id")


def products(raw: DataFrame) -> DataFrame:
    return one_by_key(raw.select(
        *texts("product_id", "product_name", "category_id", "brand_id", "unit_size"),
        currency("retail_price").alias("retail_price"), *typed_all("double", "cost_price", "weight_kg"),
        *typed_all("int", "stock_quantity"), *typed_all("boolean", "is_active")), "product_id")


def sellers(raw: DataFrame) -> DataFrame:
    return one_by_key(raw.select(
        *texts("seller_id", "seller_name", "gstin", "email", "city", "state", "phone"),
        *typed_all("double", "rating"), *typed_all("date", "joined_date"), *typed_all("boolean", "is_active")), "seller_id")


def brands(raw: DataFrame) -> DataFrame:
    return one_by_key(raw.select(
        *texts("brand_id", "brand_name", "country_origin"), *typed_all("boolean", "is_premium", "is_active"),
        *typed_all("int", "established_year")), "brand_id")


def categories(raw: DataFrame) -> DataFrame:
    return one_by_key(raw.select(
        *texts("category_id", "category_name", "parent_category"), *typed_all("int", "level"),
        *typed_all("boolean", "is_active")), "category_id")


def warehouses(raw: DataFrame) -> DataFrame:
    return one_by_key(raw.select(
        *texts("warehouse_id", "warehouse_name", "city", "state"), *typed_all("int", "capacity_sqft"),
        *typed_all("boolean", "is_active")), "warehouse_id")


def orders(raw: DataFrame) -> DataFrame:
    """History files and live events use different names for amount, shipping and date."""
    return latest_by_key(raw.select(
        *texts("order_id", "customer_id", "product_id", "seller_id", "order_status", "payment_method",
               "session_id", "channel", "coupon_code", "delivery_pincode", "warehouse_id"),
        first_of(typed("order_amount", "double"), typed("subtotal", "double")).alias("order_amount"),
        first_of(typed("freight_value", "double"), typed("delivery_charge", "double"), default=0.0).alias("freight_value"),
        *typed_all("double", "discount_amount", "total_amount"),
        first_of(calendar_date("order_date"), day_of("order_timestamp")).alias("order_date"),
        *dates("estimated_delivery"),
        F.col("order_items").alias("order_items_json"), "_source", "_ingested_at"), "order_id")


def payments(raw: DataFrame) -> DataFrame:
    return latest_by_key(raw.select(
        *texts("payment_id", "order_id", "customer_id", "payment_method", "gateway", "upi_id"),
        first_of(typed("payment_amount", "double"), typed("amount", "double")).alias("payment_amount"),
        first_of(text("payment_status"), text("status")).alias("payment_status"),
        first_of(calendar_date("payment_date"), day_of("payment_time")).alias("payment_date"),
        "_source", "_ingested_at"), "payment_id")


def shipments(raw: DataFrame) -> DataFrame:
    return latest_by_key(raw.select(
        *texts("shipment_id", "order_id", "warehouse_id", "carrier", "tracking_number", "status"),
        *dates("shipped_date", "estimated_delivery", "actual_delivery"),
        *typed_all("boolean", "late_delivery_risk"), *typed_all("double", "weight_kg"),
        is_ghost("order_id").alias("_is_ghost_order"), "_ingested_at"), "shipment_id")


def reviews(raw: DataFrame) -> DataFrame:
    return latest_by_key(raw.select(
        *texts("review_id", "order_id", "product_id", "customer_id", "seller_id", "review_text"),
        *typed_all("int", "rating", "helpful_votes"), *dates("review_date"),
        is_ghost("order_id").alias("_is_ghost_order"), "_ingested_at"), "review_id")


def refunds(raw: DataFrame) -> DataFrame:
    return latest_by_key(raw.select(
        *texts("refund_id", "order_id", "customer_id", "product_id", "reason", "status"),
        *typed_all("double", "refund_amount"), *dates("requested_date", "processed_date"),
        is_ghost("order_id").alias("_is_ghost_order"), "_ingested_at"), "refund_id")


def commissions(raw: DataFrame) -> DataFrame:
    return latest_by_key(raw.select(
        *texts("commission_id", "seller_id", "order_id", "month_year", "payment_status"),
        *typed_all("double", "sale_amount", "commission_rate", "commission_amount"), "_ingested_at"), "commission_id")


def sessions(raw: DataFrame) -> DataFrame:
    """Live sessions carry an event type and always end in a purchase; history only says `converted`."""
    bought = typed("converted", "int")
    return one_by_key(raw.select(
        *texts("session_id", "customer_id", "channel", "device_type", "utm_source"),
        first_of(text("event_type"), F.when(bought == 1, "session_start").otherwise("session_bounce")).alias("event_type"),
        *typed_all("int", "pages_viewed", "session_duration_seconds"),
        moment("session_start").alias("session_start"), moment("session_end").alias("session_end"),
        first_of(moment("event_time"), moment("session_start")).alias("event_time"),
        first_of(bought, default=1).alias("converted"),
        first_of(calendar_date("session_date"), day_of("session_start")).alias("session_date"),
        "_source", "_ingested_at"), "session_id")


def cart_events(raw: DataFrame) -> DataFrame:
    amount = first_of(typed("total_amount", "double"), typed("price_at_event", "double"))
    return one_by_key(raw.select(
        first_of(text("event_id"), text("cart_event_id")).alias("event_id"),
        *texts("session_id", "customer_id", "product_id"),
        first_of(text("action"), text("event_type")).alias("action"), *typed_all("int", "quantity"),
        first_of(typed("unit_price", "double"), typed("price_at_event", "double")).alias("unit_price"),
        amount.alias("total_amount"), first_of(text("channel"), default="organic_search").alias("channel"),
        first_of(moment("event_time"), moment("event_timestamp")).alias("event_time"),
        first_of(calendar_date("event_date"), day_of("event_time")).alias("event_date"),
        is_zero(amount).alias("_is_zero_amount"), "_source", "_ingested_at"), "event_id")


# fixed values: funnel stages from the highest down, and the values a missing flag stands for
FUNNEL = ("converted", "clicked", "opened", "sent")
FLAG_DEFAULTS = {"sent": 1, "opened": 0, "clicked": 0, "converted": 0}


def campaign_responses(raw: DataFrame) -> DataFrame:
    reached = F.coalesce(*[F.when(typed(stage, "int") == 1, stage) for stage in FUNNEL], F.lit("sent"))
    flags = [first_of(typed(s, "int"), default=d).alias(f"was_{s}") for s, d in FLAG_DEFAULTS.items()]
    return one_by_key(raw.select(
        *texts("response_id", "customer_id", "category_id", "order_id", "coupon_code"),
        first_of(text("campaign_id"), default="HIST_CAMPAIGN").alias("campaign_id"),
        first_of(text("campaign_type"), text("channel")).alias("campaign_type"),
        first_of(text("action"), reached).alias("action"), *flags,
        first_of(moment("event_time"), moment("response_date"), moment("campaign_date")).alias("event_time"),
        "_source", "_ingested_at"), "response_id")


def inventory(raw: DataFrame) -> DataFrame:
    return one_by_key(raw.select(
        *texts("inventory_id", "product_id", "warehouse_id"),
        *typed_all("int", "quantity_available", "quantity_reserved", "reorder_level"),
        moment("last_updated").alias("last_updated"), *dates("snapshot_date")), "inventory_id")


def geo(raw: DataFrame) -> DataFrame:
    return one_by_key(raw.select(
        *texts("pincode", "city", "state", "region"), *typed_all("double", "latitude", "longitude")), "pincode")


BUILDERS = {f.__name__: f for f in (
    customers, products, sellers, brands, categories, warehouses, orders, payments, shipments, reviews, refunds,
    commissions, sessions, cart_events, campaign_responses, inventory, geo)}


def _has(column: str, name: str | None = None, rule=warn):
    return rule(name or f"valid_{column}", f"{column} is not null")


RULES = {
    "customers": [_has("customer_id"), _has("email")],
    "products": [_has("product_id"), _has("category_id"), warn("positive_cost", "cost_price > 0")],
    "sellers": [_has("seller_id")],
    "brands": [_has("brand_id")],
    "categories": [_has("category_id")],
    "warehouses": [_has("warehouse_id")],
    "orders": [_has("order_id", rule=drop), _has("customer_id", "has_customer"), warn("positive_amount", "order_amount > 0")],
    "payments": [_has("payment_id", rule=drop), _has("order_id", rule=drop), warn("positive_amount", "payment_amount > 0")],
    "shipments": [_has("shipment_id", rule=drop), _has("order_id"),
                  warn("delivery_after_ship", "actual_delivery is null or actual_delivery >= shipped_date")],
    "reviews": [_has("review_id", rule=drop), warn("valid_rating", "rating between 1 and 5")],
    "refunds": [_has("refund_id", rule=drop), warn("positive_refund", "refund_amount > 0")],
    "commissions": [_has("commission_id", rule=drop), warn("valid_rate", "commission_rate between 0 and 1"),
                    warn("positive_amount", "commission_amount >= 0")],
    "sessions": [_has("session_id", rule=drop), _has("customer_id")],
    "cart_events": [_has("event_id", rule=drop), _has("product_id", "has_product")],
    "campaign_responses": [_has("response_id", rule=drop), _has("customer_id")],
    "inventory": [_has("inventory_id", rule=drop), warn("reserved_within_stock", "quantity_reserved <= quantity_available")],
    "geo": [_has("pincode", rule=drop)],
}


def clean(name: str, raw: DataFrame) -> DataFrame:
    """Clean table with its dropping expectations applied."""
    return drop_violations(BUILDERS[name](raw), RULES[name])
