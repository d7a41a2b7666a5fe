"""Quality, profiling, recommendation-data and feature queries in SQL."""

from __future__ import annotations

from checks import layers  # noqa: F401  (the clean tables come first)
from checks.book import BOOK, add, day, half_up, money_mean, money_total, num, units

CHECKS: dict[str, str] = {}


def pct(part: str, total: str, digits: int = 2) -> str:
    return half_up(f"({part}) * 100", total, digits)


def union(parts) -> str:
    return "\nunion all\n".join(parts)


# ---------------------------------------------------------------- expectations (counted before dropping)
_RULES = {
    "customers": [("valid_customer_id", "warn", "customer_id is not null"), ("valid_email", "warn", "email is not null")],
    "products": [("valid_product_id", "warn", "product_id is not null"), ("valid_category_id", "warn", "category_id is not null"),
                 ("positive_cost", "warn", "cost_price > 0")],
    "sellers": [("valid_seller_id", "warn", "seller_id is not null")],
    "brands": [("valid_brand_id", "warn", "brand_id is not null")],
    "categories": [("valid_category_id", "warn", "category_id is not null")],
    "warehouses": [("valid_warehouse_id", "warn", "warehouse_id is not null")],
    "orders": [("valid_order_id", "drop", "order_id is not null"), ("has_customer", "warn", "customer_id is not null"),
               ("positive_amount", "warn", "order_amount > 0")],
    "payments": [("valid_payment_id", "drop", "payment_id is not null"), ("valid_order_id", "drop", "order_id is not null"),
                 ("positive_amount", "warn", "payment_amount > 0")],
    "shipments": [("valid_shipment_id", "drop", "shipment_id is not null"), ("valid_order_id", "warn", "order_id is not null"),
                  ("delivery_after_ship", "warn", "actual_delivery is null or actual_delivery >= shipped_date")],
    "reviews": [("valid_review_id", "drop", "review_id is not null"), ("valid_rating", "warn", "rating between 1 and 5")],
    "refunds": [("valid_refund_id", "drop", "refund_id is not null"), ("positive_refund", "warn", "refund_amount > 0")],
    "commissions": [("valid_commission_id", "drop", "commission_id is not null"),
                    ("valid_rate", "warn", "commission_rate between 0 and 1"), ("positive_amount", "warn", "commission_amount >= 0")],
    "sessions": [("valid_session_id", "drop", "session_id is not null"), ("valid_customer_id", "warn", "customer_id is not null")],
    "cart_events": [("valid_event_id", "drop", "event_id is not null"), ("has_product", "warn", "product_id is not null")],
    "campaign_responses": [("valid_response_id", "drop", "response_id is not null"), ("valid_customer_id", "warn", "customer_id is not null")],
    "inventory": [("valid_inventory_id", "drop", "inventory_id is not null"),
                  ("reserved_within_stock", "warn", "quantity_reserved <= quantity_available")],
    "geo": [("valid_pincode", "drop", "pincode is not null")],
}
for _t in _RULES:
    _sql = BOOK[f"silver_{_t}"]
    if _sql.startswith("select * from (") and ") where " in _sql:
        _sql = _sql[len("select * from ("):_sql.rindex(") where ")]
    add(f"undropped_{_t}", _sql)
CHECKS["quality_expectations"] = union(
    f"select '{t}' as table_name, count(*) as rows_in, '{r}' as rule, '{a}' as action, "
    f"count(*) filter (where not coalesce({c}, false)) as violations from undropped_{t}"
    for t, rules in _RULES.items() for r, a, c in rules)

_DROPS = {t: [c for _, a, c in rules if a == "drop"] for t, rules in _RULES.items()}
_ASIDE = {t: " or ".join(f"not coalesce({c}, false)" for c in drops) or "false" for t, drops in _DROPS.items()}
CHECKS["quality_conservation"] = union(
    f"select '{t}' as table_name, count(*) as rows_in, count(*) filter (where not ({aside})) as rows_kept, count(*) filter (where {aside}) as rows_quarantined, "
    f"true as balanced from undropped_{t}" for t, aside in _ASIDE.items())
CHECKS["quality_quarantined"] = union(
    f"select '{t}' as table_name, concat_ws(',', " + ", ".join(f"case when not coalesce({c}, false) then '{r}' end" for r, _, c in _RULES[t])
    + f") as broken_rules, count(*) as rows from undropped_{t} where {aside} group by all" for t, aside in _ASIDE.items())

# ---------------------------------------------------------------- profiling
_COLUMNS = {
    "customers": "customer_id first_name last_name email phone_number date_of_birth gender city state pincode loyalty_tier registration_date is_active",
    "products": "product_id product_name category_id brand_id retail_price cost_price weight_kg stock_quantity unit_size is_active",
    "sellers": "seller_id seller_name gstin email city state phone rating joined_date is_active",
    "reviews": "review_id order_id product_id customer_id seller_id rating review_text helpful_votes review_date",
    "commissions": "commission_id seller_id order_id sale_amount commission_rate commission_amount month_year payment_status",
    "sessions": "session_id customer_id event_type channel device_type pages_viewed session_start converted utm_source session_duration_seconds session_end session_date event_time",
    "cart_events": "session_id customer_id product_id quantity cart_event_id event_type price_at_event event_timestamp event_date event_id action unit_price total_amount channel event_time",
    "campaign_responses": "response_id customer_id channel sent opened clicked converted order_id coupon_code response_date campaign_date campaign_id campaign_type action category_id event_time",
    "geo": "pincode city state region latitude longitude",
    "brands": "brand_id brand_name country_origin is_premium established_year is_active",
    "categories": "category_id category_name parent_category level is_active",
    "warehouses": "warehouse_id warehouse_name city state capacity_sqft is_active",
    "orders": """order_id customer_id product_id seller_id order_status order_amount freight_value discount_amount total_amount order_date payment_method
      estimated_delivery session_id order_items channel subtotal delivery_charge coupon_code delivery_pincode warehouse_id order_timestamp""",
    "payments": "payment_id order_id customer_id payment_method payment_amount payment_status payment_date gateway amount status payment_time upi_id",
    "shipments": """shipment_id order_id warehouse_id carrier tracking_number shipped_date estimated_delivery actual_delivery status
      late_delivery_risk weight_kg""",
    "refunds": "refund_id order_id customer_id product_id refund_amount reason status requested_date processed_date",
    "inventory": "inventory_id product_id warehouse_id quantity_available quantity_reserved reorder_level last_updated snapshot_date",
}
CHECKS["profile_nulls"] = union(
    f"select '{t}' as table_name, count(*) as total, '{c}' as column_name, count(*) - count({c}) as nulls, "
    f"{pct(f'count(*) - count({c})', 'count(*)')} as null_pct from raw_{t}" for t, cs in _COLUMNS.items() for c in cs.split())
_KEYS = dict(customers="customer_id", products="product_id", orders="order_id", payments="payment_id", shipments="shipment_id",
             reviews="review_id", refunds="refund_id", commissions="commission_id", inventory="inventory_id", sellers="seller_id", brands="brand_id",
             categories="category_id", warehouses="warehouse_id", sessions="session_id", cart_events="coalesce(event_id, cart_event_id)",
             campaign_responses="response_id", geo="pincode")
CHECKS["profile_duplicates"] = union(
    f"select '{t}' as table_name, total, uniques, total - uniques as duplicates, {pct('total - uniques', 'total')} as duplicate_pct "
    f"from (select count(*) as total, count(distinct coalesce({k}, '~none')) as uniques from raw_{t})" for t, k in _KEYS.items())
CHECKS["profile_castability"] = """
select count(retail_price) as present, count(*) filter (retail_price is not null and try_cast(retail_price as double) is null) as not_castable
from raw_products"""
_COVERED = {"orders": "order_amount subtotal freight_value delivery_charge order_date order_timestamp",
            "payments": "payment_amount amount payment_status status payment_date payment_time gateway upi_id"}
CHECKS["profile_coverage"] = union(f"select _source, '{c}' as column_name, count({c}) as filled, '{t}' as table_name from raw_{t} group by _source"
                                   for t, cs in _COVERED.items() for c in cs.split())
_CATEGORICAL = {"orders": "_source order_status", "payments": "_source payment_method", "shipments": "status", "reviews": "rating",
                "refunds": "status", "cart_events": "action", "campaign_responses": "campaign_type", "geo": "region",
                "sessions": "channel device_type"}
CHECKS["profile_categories"] = union(f"select '{t}' as table_name, '{c}' as column_name, {c} as value, count(*) as n from raw_{t} group by {c}"
                                     for t, cs in _CATEGORICAL.items() for c in cs.split())


def _layout(table: str, column: str, layouts: dict[str, str], where: str = "true") -> str:
    arms = " ".join(f"when try_strptime({column}, '{f}') is not null then '{name}'" for name, f in layouts.items())
    return (f"select '{table}' as table_name, '{column}' as column_name, layout, count(*) as n from (select case {arms} "
            f"when {column} is null then 'missing' else 'other' end as layout from raw_{table} where {where}) group by layout")


_DAYS = {"yyyy-MM-dd": "%Y-%m-%d", "dd-MM-yyyy": "%d-%m-%Y"}
CHECKS["profile_layouts"] = union([
    _layout("orders", "order_date", _DAYS, "_source = 'history_files'"), _layout("reviews", "review_date", _DAYS),
    _layout("inventory", "last_updated", {"dd-MM-yyyy HH:mm": "%d-%m-%Y %H:%M"}),
    _layout("sessions", "event_time", {"yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S"})])
CHECKS["profile_layout_samples"] = """
select distinct order_id, order_date from raw_orders where order_date is not null and try_strptime(order_date, '%Y-%m-%d') is null
order by order_id, order_date limit 5"""


def _rate(measure: str, table: str, test: str, where: str = "true") -> str:
    return (f"select '{measure}' as measure, total, hits, {pct('hits', 'total')} as hit_pct from "
            f"(select count(*) as total, count(*) filter ({test}) as hits from raw_{table} where {where})")


CHECKS["profile_defect_rates"] = union([
    _rate("history orders without customer", "orders", "customer_id is null", "_source = 'history_files'"),
    _rate("live orders with zero total", "orders", "try_cast(total_amount as double) = 0", "_source = 'live_events'"),
    _rate("live orders without pincode", "orders", "delivery_pincode is null", "_source = 'live_events'"),
    _rate("orders without customer and product", "orders", "customer_id is null and product_id is null"),
    _rate("orders without product", "orders", "product_id is null"),
    _rate("live payments with zero amount", "payments", "try_cast(amount as double) = 0", "_source = 'live_events'"),
    _rate("cart events with zero total", "cart_events", "try_cast(total_amount as double) = 0"),
    *[_rate(f"{t} of ghost orders", t, "starts_with(order_id, 'ORD_GHOST_')") for t in ("shipments", "reviews", "refunds")]])
CHECKS["profile_customer_coverage"] = union(
    f"select '{t}' as table_name, n as customers, {pct('n', 'base')} as coverage_pct from (select count(distinct customer_id) as n, "
    f"(select count(distinct customer_id) from silver_orders) as base from silver_{t})"
    for t in ("orders", "sessions", "cart_events", "reviews", "refunds", "payments"))
CHECKS["profile_monthly_orders"] = """
select strftime(order_date, '%Y-%m') as ym, count(*) as orders from silver_orders where order_date is not null group by 1"""

# ---------------------------------------------------------------- features
_NET = f"({units('order_amount')} - {units('discount_amount')})"
add("rfm_base", f"""
select customer_id, last_order_date, total_orders, total_spent, avg_order_value,
  cast((select max(order_date) from silver_orders) - last_order_date as integer) as recency_days
from (select customer_id, max(order_date) as last_order_date, count(order_id) as total_orders,
  {half_up(f'sum({_NET})', '10000', 2)} as total_spent, {half_up(f'sum({_NET})', f'10000 * count({_NET})', 2)} as avg_order_value
  from silver_orders where customer_id is not null group by customer_id)""")
_RFM = ("recency_days", "total_orders", "total_spent")
CHECKS["profile_rfm_summary"] = union(
    f"select '{c}' as feature, round(min({c}), 6) as min_value, round(max({c}), 6) as max_value, round(avg({c}), 6) as mean_value, "
    f"round(stddev_samp({c}), 6) as std_value from rfm_base" for c in _RFM)
CHECKS["profile_spend_percentiles"] = """
select round(quantile_cont(total_spent, 0.5), 6) as p50, round(quantile_cont(total_spent, 0.95), 6) as p95,
  round(quantile_cont(total_spent, 0.99), 6) as p99 from rfm_base"""
CHECKS["profile_skewness"] = "select " + ", ".join(f"round(skewness({c}), 6) as {c}_skew" for c in _RFM) + " from rfm_base"
CHECKS["profile_correlation"] = union(
    f"select '{a}' as left_feature, '{b}' as right_feature, round(corr({a}, {b}), 6) as correlation from rfm_base"
    for a, b in (("recency_days", "total_orders"), ("recency_days", "total_spent"), ("total_orders", "total_spent")))
CHECKS["profile_spend_share"] = f"""
select count(*) filter (total_spent <= 1000000) as under, count(*) filter (total_spent > 1000000) as over, count(total_spent) as n,
  {pct('count(*) filter (total_spent <= 1000000)', 'count(total_spent)')} as under_pct from rfm_base"""
add("clipped", """
select customer_id, least(cast(total_orders as double), (select quantile_cont(cast(total_orders as double), 0.99) from rfm_base)) as total_orders,
  least(total_spent, (select quantile_cont(total_spent, 0.99) from rfm_base)) as total_spent, avg_order_value, recency_days,
  cast(recency_days is null as integer) as recency_unknown, cast(total_spent is null as integer) as spent_unknown
from rfm_base""")
add("refund_counts", "select customer_id, count(refund_id) as refund_count from silver_refunds group by customer_id")
add("cart_add_counts", "select customer_id, count(event_id) as cart_adds from silver_cart_events where action = 'cart_add' group by customer_id")
add("session_stats", f"""
select customer_id, {money_mean('pages_viewed')} as avg_pages_viewed, {money_mean('session_duration_seconds')} as avg_session_duration,
  count(session_id) as session_count, avg(case when channel = 'organic_search' then 1 else 0 end) as pct_organic,
  avg(case when channel = 'social_media' then 1 else 0 end) as pct_social
from silver_sessions where customer_id is not null group by customer_id""")
add("payment_modes", """
select customer_id, payment_method as preferred_payment from (select o.customer_id, p.payment_method,
  row_number() over (partition by o.customer_id order by count(o.order_id) desc, p.payment_method) as rn
  from silver_orders o join silver_payments p on o.order_id = p.order_id
  where o.customer_id is not null and p.payment_method is not null group by o.customer_id, p.payment_method) where rn = 1""")
add("rating_means", f"select customer_id, {money_mean('rating', 1)} as avg_rating from silver_reviews where customer_id is not null group by customer_id")
_ABANDON = "case when cart_adds > 0 then greatest(0.0, least(1.0, (cart_adds - {0}) / cast(cart_adds as double))) else 0.0 end"
add("features_unindexed", f"""
select c.customer_id, coalesce(recency_days, (select cast(floor(avg(recency_days)) as integer) from rfm_base), 0) as recency_days,
  recency_unknown, spent_unknown, total_orders, {half_up('round(total_spent * 10000000000)', '10000000000', 2)} as total_spent,
  coalesce(avg_order_value, 0.0) as avg_order_value, coalesce(refund_count, 0) as refund_count,
  {half_up('coalesce(refund_count, 0) * 10000', units('total_orders'), 2)} as refund_rate,
  {_ABANDON.format('total_orders')} as abandon_rate, coalesce(avg_pages_viewed, 0.0) as avg_pages_viewed,
  coalesce(avg_session_duration, 0.0) as avg_session_duration, coalesce(session_count, 0) as session_count,
  coalesce(pct_organic, 0.0) as pct_organic, coalesce(pct_social, 0.0) as pct_social, coalesce(avg_rating, 3.0) as avg_rating,
  coalesce(preferred_payment, 'UPI') as preferred_payment,
  cast(case when c.recency_days > 90 and total_orders >= 2 then 1 else 0 end as integer) as churn_label
from clipped c left join refund_counts r on c.customer_id = r.customer_id left join cart_add_counts a on c.customer_id = a.customer_id
left join session_stats s on c.customer_id = s.customer_id left join payment_modes p on c.customer_id = p.customer_id
left join rating_means g on c.customer_id = g.customer_id""")
add("feature_table", """
select f.* exclude (preferred_payment), payment_idx from features_unindexed f join (
  select preferred_payment, cast(row_number() over (order by count(*) desc, preferred_payment) - 1 as double) as payment_idx
  from features_unindexed group by preferred_payment) i on f.preferred_payment = i.preferred_payment""")
CHECKS["feature_rfm_base"] = "select * from rfm_base"
CHECKS["feature_winsorised"] = "select customer_id, total_orders, total_spent from clipped"
CHECKS["feature_sessions"] = "select * from session_stats"
CHECKS["feature_preferred_payment"] = "select * from payment_modes"
CHECKS["feature_ratings"] = "select * from rating_means"
CHECKS["feature_refunds_and_carts"] = f"""
select b.customer_id, total_orders, coalesce(refund_count, 0) as refund_count, cart_adds,
  {half_up('coalesce(refund_count, 0)', 'total_orders', 2)} as refund_rate, {_ABANDON.format('total_orders')} as abandon_rate
from rfm_base b left join refund_counts r on b.customer_id = r.customer_id left join cart_add_counts a on b.customer_id = a.customer_id"""
CHECKS["feature_payment_index"] = """
select customer_id, m.preferred_payment, payment_idx from payment_modes m join (
  select preferred_payment, cast(row_number() over (order by count(*) desc, preferred_payment) - 1 as double) as payment_idx
  from payment_modes group by preferred_payment) i on m.preferred_payment = i.preferred_payment"""
CHECKS["feature_table"] = "select * from feature_table"
CHECKS["profile_class_balance"] = f"""
select churned, active, {pct('churned', 'churned + active')} as churn_pct, {half_up('active', 'churned', 4)} as positive_weight
from (select count(*) filter (churn_label = 1) as churned, count(*) filter (churn_label = 0) as active from feature_table)"""


def _bins(table: str, c: str, by: str = "") -> str:
    extra = f"{by}, " if by else ""
    return (f"select {extra}cast(least(coalesce(floor((v - lo) / nullif((hi - lo) / 50.0, 0)), 0), 49) as integer) as bin, count(*) as n, "
            f"'{c}' as feature from (select *, cast({c} as double) as v from {table}), (select cast(min({c}) as double) as lo, "
            f"cast(max({c}) as double) as hi from {table}) where v is not null group by {'1, 2' if by else '1'}")


CHECKS["profile_recency_by_label"] = _bins("feature_table", "recency_days", "churn_label")
CHECKS["profile_histograms"] = union([
    *[_bins("feature_table", c) for c in ("recency_days", "total_orders", "total_spent", "refund_count", "abandon_rate")],
    *[_bins("silver_sessions", c) for c in ("pages_viewed", "session_duration_seconds")]])

# ---------------------------------------------------------------- recommendation data
add("purchases", "select * from silver_orders where customer_id is not null and product_id is not null")
add("cart_signals", "select * from silver_cart_events where action in ('cart_add', 'wishlist_add')")
add("liked", "select * from silver_reviews where not _is_ghost_order and rating >= 4")
add("interactions", """
select customer_id, product_id, max(confidence) as confidence, max(order_date) as order_date from (
  select customer_id, product_id, 1.0::double as confidence, order_date from purchases
  union all select customer_id, product_id, 0.5, null from cart_signals
  union all select customer_id, product_id, 2.0, null from liked)
where customer_id is not null and product_id is not null group by customer_id, product_id""")
CHECKS["recdata_matrix_size"] = """
select customers, products, interactions, customers * products as possible_pairs,
  round(1 - interactions / cast(customers * products as double), 8) as sparsity
from (select count(distinct customer_id) as customers, count(distinct product_id) as products, count(order_id) as interactions from purchases)"""
CHECKS["recdata_cold_warm"] = union(
    f"select '{k}' as entity, cold, warm, {pct('cold', 'cold + warm', 1)} as cold_pct from (select count(*) filter (n < {lim}) as cold, "
    f"count(*) filter (n >= {lim}) as warm from (select {k}, count(order_id) as n from purchases group by {k}))"
    for k, lim in (("customer_id", 3), ("product_id", 5)))
CHECKS["recdata_top_products"] = """
select product_id, count(order_id) as purchase_count, count(distinct customer_id) as unique_buyers from purchases
group by product_id order by purchase_count desc, product_id limit 10"""
CHECKS["recdata_repeat_purchases"] = """
select count(*) filter (times > 1) as repeat_pairs, count(*) as pairs from (
  select customer_id, product_id, count(order_id) as times from purchases group by customer_id, product_id)"""
CHECKS["recdata_pairs_per_signal"] = union(
    f"select '{s}' as signal, count(*) as pairs from (select distinct customer_id, product_id from {t})"
    for s, t in (("purchase", "purchases"), ("cart", "cart_signals"), ("liked_review", "liked")))
CHECKS["recdata_confidence"] = "select confidence, count(*) as pairs from interactions group by confidence"


def months_between(a: str, b: str) -> str:
    """Whole months when the days match or both are month ends, else with a day fraction of 31."""
    return (f"((year({a}) - year({b})) * 12 + month({a}) - month({b}) + case when day({a}) = day({b}) or "
            f"({a} = last_day({a}) and {b} = last_day({b})) then 0 else (day({a}) - day({b})) / 31.0 end)")


_LAST = "(select max(order_date) from silver_orders)"
_LAST_REVIEW = "(select max(review_date) from silver_reviews)"
CHECKS["recdata_window_coverage"] = union(
    f"select {m} as months, all_orders, all_customers, all_products, orders, customers, products, {pct('orders', 'all_orders', 1)} as order_pct, "
    f"{pct('customers', 'all_customers', 1)} as customer_pct, {pct('products', 'all_products', 1)} as product_pct from ("
    f"select count(order_id) as all_orders, count(distinct customer_id) as all_customers, count(distinct product_id) as all_products, "
    f"count(*) filter (age <= {m}) as orders, count(distinct customer_id) filter (age <= {m}) as customers, "
    f"count(distinct product_id) filter (age <= {m}) as products from (select *, {months_between('last', 'order_date')} as age "
    f"from (select *, {_LAST} as last from purchases)))" for m in (6, 12))


def _recent(table: str, c: str) -> str:
    return f"(select *, {_LAST_REVIEW} as last from {table}) where {months_between('last', c)} <= 6"


add("interactions_6m", f"""
select customer_id, product_id, max(confidence) as confidence from (
  select customer_id, product_id, 1.0::double as confidence from {_recent('purchases', 'order_date')}
  union all select customer_id, product_id, 0.5 from {_recent('cart_signals', 'event_date')}
  union all select customer_id, product_id, 2.0 from {_recent('liked', 'review_date')})
where customer_id is not null and product_id is not null group by customer_id, product_id""")
CHECKS["recdata_windowed_matrix"] = "select * from interactions_6m"
CHECKS["recdata_signal_density"] = union(
    f"select round(avg(n), 6) as mean_signals, max(n) as max_signals, count(*) filter (n < 5) as thin_customers, count(*) as customers, "
    f"{pct('count(*) filter (n < 5)', 'count(*)', 1)} as thin_pct, '{h}' as history from (select customer_id, count(product_id) as n from {t} group by customer_id)"
    for h, t in (("full", "interactions"), ("6 months", "interactions_6m")))
CHECKS["recdata_rating_split"] = """
select count(*) filter (rating >= 4) as high, count(*) filter (rating = 3) as neutral, count(*) filter (rating <= 2) as low
from silver_reviews where not _is_ghost_order"""
CHECKS["recdata_missing_products"] = """
select order_status, count(*) as orders, count(customer_id) as with_customer, count(*) - count(customer_id) as without_customer
from silver_orders where product_id is null group by order_status"""
CHECKS["recdata_date_range"] = "select min(order_date) as earliest, max(order_date) as latest from purchases"

CHECKS["profile_amounts_by_product"] = union(
    f"select product_id, _source, count(order_amount) as n, {p}::double as prob, round(quantile_cont(order_amount, {p}), 6) as order_amount "
    "from silver_orders where order_amount is not null group by product_id, _source" for p in (0.25, 0.5, 0.75, 1.0))
