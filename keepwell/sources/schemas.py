"""Declared schemas of the raw feeds: what arrives before cleaning."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def text_schema(columns: str) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns.split()])


# fixed values: fields of the five live topics; everything is text until it is cleaned
TOPICS = {
    "sessions": text_schema("session_id customer_id event_type channel device_type pages_viewed session_start event_time"),
    "cart_events": text_schema("event_id session_id customer_id product_id action quantity unit_price total_amount channel event_time"),
    "campaign_responses": text_schema("response_id campaign_id customer_id campaign_type action category_id event_time"),
    "orders": text_schema("order_id session_id customer_id order_items order_status channel subtotal discount_amount delivery_charge "
                          "total_amount coupon_code delivery_pincode warehouse_id estimated_delivery order_timestamp"),
    "payments": text_schema("payment_id order_id customer_id payment_method amount status upi_id payment_time"),
}
# columns of the history files of the same five tables
HISTORY = {
    "sessions": text_schema("session_id customer_id channel device_type pages_viewed session_start converted utm_source "
                            "session_duration_seconds session_end session_date"),
    "cart_events": text_schema("session_id customer_id product_id quantity cart_event_id event_type price_at_event event_timestamp event_date"),
    "campaign_responses": text_schema("response_id customer_id channel sent opened clicked converted order_id coupon_code response_date campaign_date"),
    "orders": text_schema("order_id customer_id product_id seller_id order_status order_amount freight_value discount_amount total_amount "
                          "order_date payment_method estimated_delivery"),
    "payments": text_schema("payment_id order_id customer_id payment_method payment_amount payment_status payment_date gateway"),
}
FILES_ONLY = ("shipments", "reviews", "refunds", "commissions", "inventory", "geo")
DUAL = tuple(TOPICS)
