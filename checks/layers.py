"""Clean tables and star schema in SQL."""

from __future__ import annotations

from checks.book import add, day, flag, half_up, iso_day, keep_one, money_mean, money_total, num, stamp, units, whole

T = "trim({0}) as {0}"


def _silver(name: str, key: str, columns: dict[str, str], latest: bool = False, where: str = "") -> None:
    """columns: output name -> expression; the tie-break order follows the declared order."""
    body = ", ".join(f"{expr} as {out}" for out, expr in columns.items())
    names = list(columns)
    if latest:
        names = ["_ingested_at"] + [c for c in names if c != "_ingested_at"]
    sql = keep_one(f"select {body} from raw_{name}", key, names)
    if where:
        sql = f"select * from ({sql}) where {where}"
    add(f"silver_{name}", sql)


def t(*names: str) -> dict[str, str]:
    return {n: f"trim({n})" for n in names}


def n(*names: str) -> dict[str, str]:
    return {c: num(c) for c in names}


def i(*names: str) -> dict[str, str]:
    return {c: whole(c) for c in names}


def d(*names: str) -> dict[str, str]:
    return {c: day(c) for c in names}


SOURCE = {"_source": "_source", "_ingested_at": "_ingested_at"}
LOADED = {"_ingested_at": "_ingested_at"}
GHOST = {"_is_ghost_order": "coalesce(starts_with(order_id, 'ORD_GHOST_'), false)"}

_silver("customers", "customer_id", {
    **t("customer_id", "first_name", "last_name", "email", "gender", "city", "state", "pincode", "loyalty_tier"),
    "phone": "trim(phone_number)", "date_of_birth": "try_cast(date_of_birth as date)",
    "registration_date": "try_cast(registration_date as date)", "is_active": flag("is_active")})
_silver("products", "product_id", {
    **t("product_id", "product_name", "category_id", "brand_id", "unit_size"),
    "retail_price": num("regexp_replace(retail_price, '[^0-9.]', '', 'g')"), **n("cost_price", "weight_kg"),
    **i("stock_quantity"), "is_active": flag("is_active")})
_silver("sellers", "seller_id", {
    **t("seller_id", "seller_name", "gstin", "email", "city", "state", "phone"), **n("rating"),
    "joined_date": "try_cast(joined_date as date)", "is_active": flag("is_active")})
_silver("brands", "brand_id", {**t("brand_id", "brand_name", "country_origin"), "is_premium": flag("is_premium"),
                               "is_active": flag("is_active"), **i("established_year")})
_silver("categories", "category_id", {**t("category_id", "category_name", "parent_category"), **i("level"),
                                      "is_active": flag("is_active")})
_silver("warehouses", "warehouse_id", {**t("warehouse_id", "warehouse_name", "city", "state"), **i("capacity_sqft"),
                                       "is_active": flag("is_active")})
_silver("orders", "order_id", {
    **t("order_id", "customer_id", "product_id", "seller_id", "order_status", "payment_method", "session_id", "channel",
        "coupon_code", "delivery_pincode", "warehouse_id"),
    "order_amount": f"coalesce({num('order_amount')}, {num('subtotal')})",
    "freight_value": f"coalesce({num('freight_value')}, {num('delivery_charge')}, 0.0)",
    **n("discount_amount", "total_amount"),
    "order_date": f"coalesce({day('order_date')}, {iso_day('order_timestamp')})", **d("estimated_delivery"),
    "order_items_json": "order_items", **SOURCE}, latest=True, where="order_id is not null")
_silver("payments", "payment_id", {
    **t("payment_id", "order_id", "customer_id", "payment_method", "gateway", "upi_id"),
    "payment_amount": f"coalesce({num('payment_amount')}, {num('amount')})",
    "payment_status": "coalesce(trim(payment_status), trim(status))",
    "payment_date": f"coalesce({day('payment_date')}, {iso_day('payment_time')})", **SOURCE},
    latest=True, where="payment_id is not null and order_id is not null")
_silver("shipments", "shipment_id", {
    **t("shipment_id", "order_id", "warehouse_id", "carrier", "tracking_number", "status"),
    **d("shipped_date", "estimated_delivery", "actual_delivery"), "late_delivery_risk": flag("late_delivery_risk"),
    **n("weight_kg"), **GHOST, **LOADED}, latest=True, where="shipment_id is not null")
_silver("reviews", "review_id", {
    **t("review_id", "order_id", "product_id", "customer_id", "seller_id", "review_text"), **i("rating", "helpful_votes"),
    **d("review_date"), **GHOST, **LOADED}, latest=True, where="review_id is not null")
_silver("refunds", "refund_id", {
    **t("refund_id", "order_id", "customer_id", "product_id", "reason", "status"), **n("refund_amount"),
    **d("requested_date", "processed_date"), **GHOST, **LOADED}, latest=True, where="refund_id is not null")
_silver("commissions", "commission_id", {
    **t("commission_id", "seller_id", "order_id", "month_year", "payment_status"),
    **n("sale_amount", "commission_rate", "commission_amount"), **LOADED}, latest=True, where="commission_id is not null")
_silver("sessions", "session_id", {
    **t("session_id", "customer_id", "channel", "device_type", "utm_source"),
    "event_type": f"coalesce(trim(event_type), case when {whole('converted')} = 1 then 'session_start' else 'session_bounce' end)",
    **i("pages_viewed", "session_duration_seconds"), "session_start": stamp("session_start"), "session_end": stamp("session_end"),
    "event_time": f"coalesce({stamp('event_time')}, {stamp('session_start')})",
    "converted": f"coalesce({whole('converted')}, 1)",
    "session_date": f"coalesce({day('session_date')}, {iso_day('session_start')})", **SOURCE}, where="session_id is not null")
_AMOUNT = f"coalesce({num('total_amount')}, {num('price_at_event')})"
_silver("cart_events", "event_id", {
    "event_id": "coalesce(trim(event_id), trim(cart_event_id))", **t("session_id", "customer_id", "product_id"),
    "action": "coalesce(trim(action), trim(event_type))", **i("quantity"),
    "unit_price": f"coalesce({num('unit_price')}, {num('price_at_event')})", "total_amount": _AMOUNT,
    "channel": "coalesce(trim(channel), 'organic_search')",
    "event_time": f"coalesce({stamp('event_time')}, {stamp('event_timestamp')})",
    "event_date": f"coalesce({day('event_date')}, {iso_day('event_time')})",
    "_is_zero_amount": f"coalesce({_AMOUNT} = 0, false)", **SOURCE}, where="event_id is not null")
_silver("campaign_responses", "response_id", {
    **t("response_id", "customer_id", "category_id", "order_id", "coupon_code"),
    "campaign_id": "coalesce(trim(campaign_id), 'HIST_CAMPAIGN')", "campaign_type": "coalesce(trim(campaign_type), trim(channel))",
    "action": "coalesce(trim(action), case when converted = '1' then 'converted' when clicked = '1' then 'clicked' "
              "when opened = '1' then 'opened' else 'sent' end)",
    "was_sent": f"coalesce({whole('sent')}, 1)", "was_opened": f"coalesce({whole('opened')}, 0)",
    "was_clicked": f"coalesce({whole('clicked')}, 0)", "was_converted": f"coalesce({whole('converted')}, 0)",
    "event_time": f"coalesce({stamp('event_time')}, {stamp('response_date')}, {stamp('campaign_date')})", **SOURCE},
    where="response_id is not null")
_silver("inventory", "inventory_id", {
    **t("inventory_id", "product_id", "warehouse_id"), **i("quantity_available", "quantity_reserved", "reorder_level"),
    "last_updated": stamp("last_updated"), **d("snapshot_date")}, where="inventory_id is not null")
_silver("geo", "pincode", {**t("pincode", "city", "state", "region"), **n("latitude", "longitude")}, where="pincode is not null")

# ------------------------------------------------------------------ star schema
_IN = "date_key in ({})"


def _in(days: str) -> str:
    return "date_key in (" + ", ".join(f"date '{x}'" for x in days.split()) + ")"


def _runs(*pairs: str) -> str:
    return "(" + " or ".join("date_key between date '{}' and date '{}'".format(*p.split()) for p in pairs) + ")"


add("sales_days", "select order_date as date_key, count(order_id) as n from silver_orders group by order_date")
add("fact_days", " union all ".join(
    f"select cast(min({c}) as date) as lo, cast(max({c}) as date) as hi from silver_{t}" for t, c in (
        ("orders", "order_date"), ("payments", "payment_date"), ("shipments", "shipped_date"), ("shipments", "actual_delivery"),
        ("shipments", "estimated_delivery"), ("refunds", "requested_date"), ("refunds", "processed_date"), ("reviews", "review_date"),
        ("sessions", "session_date"), ("cart_events", "event_date"), ("campaign_responses", "event_time"),
        ("inventory", "snapshot_date"), ("inventory", "last_updated"))))
add("gold_dim_date", f"""
select *, festive_event_name is not null as is_festive_day from (select *,
  case when is_diwali then 'Diwali' when is_dhanteras then 'Dhanteras' when is_dhamaka_days then 'Dhamaka Days'
    when is_navratri then 'Navratri' when is_holi then 'Holi' when is_republic_day then 'Republic Day'
    when is_independence_day then 'Independence Day' when is_valentines_day then 'Valentine''s Day'
    when is_christmas then 'Christmas' when is_eos_sale then 'End of Season Sale' end as festive_event_name
from (select date_key, cast(year(date_key) as integer) as year, cast(month(date_key) as integer) as month,
  cast(day(date_key) as integer) as day, cast(quarter(date_key) as integer) as quarter,
  cast(dayofweek(date_key) + 1 as integer) as day_of_week, cast(dayofyear(date_key) as integer) as day_of_year,
  strftime(date_key, '%B') as month_name, strftime(date_key, '%b') as month_short, strftime(date_key, '%A') as day_name,
  strftime(date_key, '%Y-%m') as year_month, year(date_key) || '-Q' || quarter(date_key) as year_quarter,
  dayofweek(date_key) in (0, 6) as is_weekend,
  cast(case when month(date_key) >= 4 then year(date_key) else year(date_key) - 1 end as integer) as fiscal_year,
  cast(case when month(date_key) <= 3 then 4 else quarter(date_key) - 1 end as integer) as fiscal_quarter,
  {_in('2020-11-14 2021-11-04 2022-10-24 2023-11-12 2024-11-01 2025-10-20 2026-11-08')} as is_diwali,
  {_in('2020-11-13 2021-11-02 2022-10-22 2023-11-10 2024-10-29 2025-10-18 2026-11-06')} as is_dhanteras,
  {_in('2020-03-09 2021-03-28 2022-03-18 2023-03-07 2024-03-25 2025-03-14 2026-03-04')} as is_holi,
  {_runs('2020-11-02 2020-11-11', '2021-10-23 2021-11-01', '2022-10-12 2022-10-21', '2023-10-31 2023-11-09',
         '2024-10-20 2024-10-29', '2025-10-08 2025-10-17', '2026-10-27 2026-11-05')} as is_dhamaka_days,
  {_runs('2020-10-17 2020-10-25', '2021-10-07 2021-10-15', '2022-10-02 2022-10-10', '2023-10-15 2023-10-23',
         '2024-10-03 2024-10-11', '2025-09-22 2025-09-30', '2026-10-11 2026-10-19')} as is_navratri,
  month(date_key) = 1 and day(date_key) = 26 as is_republic_day, month(date_key) = 8 and day(date_key) = 15 as is_independence_day,
  month(date_key) = 2 and day(date_key) = 14 as is_valentines_day, month(date_key) = 12 and day(date_key) = 25 as is_christmas,
  month(date_key) = 1 and day(date_key) = 1 as is_new_year,
  month(date_key) in (3, 6) and day(date_key) between 20 and 29 as is_eos_sale,
  month(date_key) in (12, 1, 2, 4) or (month(date_key) in (11, 3) and day(date_key) >= 15) as is_wedding_season,
  {_runs('2020-03-25 2020-06-07')} as is_covid_lockdown, coalesce(n, 0) as orders_placed
from (select cast(x as date) as date_key from (select unnest(generate_series(lo, hi, interval 1 day)) as x
      from (select cast(least(min(lo), date '2020-01-01') as timestamp) as lo, cast(greatest(max(hi), date '2026-12-31') as timestamp) as hi from fact_days)))
left join sales_days using (date_key)))""")

add("gold_dim_customer", """
select c.*, concat_ws(' ', first_name, last_name) as full_name, coalesce(g.region, 'Unknown') as region,
  coalesce(g.latitude, 0.0) as latitude, coalesce(g.longitude, 0.0) as longitude
from silver_customers c left join silver_geo g on c.pincode = g.pincode""")
_P, _C = units("retail_price"), units("cost_price")
add("gold_dim_product", f"""
select product_id, product_name, p.category_id, coalesce(category_name, 'Unknown') as category_name,
  coalesce(parent_category, '') as parent_category, p.brand_id, coalesce(brand_name, 'Unknown') as brand_name,
  coalesce(is_premium, false) as is_premium_brand, retail_price, cost_price,
  cast({_P} - {_C} as double) / 10000 as margin,
  case when retail_price > 0 then coalesce({half_up(f'({_P} - {_C}) * 100', _P, 2)}, 0.0) else 0.0 end as margin_pct,
  weight_kg, stock_quantity, p.is_active,
  case when retail_price < 500 then 'Budget' when retail_price < 2000 then 'Mid-Range'
       when retail_price < 10000 then 'Premium' else 'Luxury' end as price_tier
from silver_products p left join silver_brands b on p.brand_id = b.brand_id
left join silver_categories c on p.category_id = c.category_id""")
add("gold_dim_seller", """
select seller_id, seller_name, gstin, city as seller_city, state as seller_state, rating as seller_rating, joined_date, is_active,
  case when rating >= 4.5 then 'Platinum' when rating >= 4 then 'Gold' when rating >= 3 then 'Silver' else 'Bronze' end as seller_tier
from silver_sellers""")
add("gold_dim_warehouse", "select warehouse_id, warehouse_name, city as warehouse_city, state as warehouse_state, capacity_sqft, is_active from silver_warehouses")
add("gold_dim_geo", "select pincode, city, state, region, latitude, longitude from silver_geo")
add("gold_fact_orders", f"""
select order_id, customer_id, product_id, seller_id, order_status, order_amount, freight_value,
  coalesce(discount_amount, 0.0) as discount_amount,
  coalesce(total_amount, cast({units('order_amount')} + {units('freight_value')} - {units('coalesce(discount_amount, 0.0)')} as double) / 10000) as total_amount,
  order_date, estimated_delivery, payment_method, session_id, channel, coupon_code, delivery_pincode, warehouse_id, _source,
  coupon_code is not null and coupon_code <> '' as used_coupon,
  coalesce(order_status = 'cancelled', false) as is_cancelled, coalesce(order_status = 'delivered', false) as is_delivered
from silver_orders""")
add("gold_fact_payments", """
select payment_id, order_id, customer_id, payment_method, payment_amount, payment_status, payment_date, gateway, upi_id, _source,
  coalesce(payment_status = 'success', false) as is_successful from silver_payments""")
add("gold_fact_shipments", """
select shipment_id, order_id, warehouse_id, carrier, tracking_number, shipped_date, estimated_delivery, actual_delivery, status,
  late_delivery_risk, weight_kg, cast(actual_delivery - shipped_date as integer) as delivery_days,
  cast(actual_delivery - estimated_delivery as integer) as delay_days, coalesce(actual_delivery > estimated_delivery, false) as is_late
from silver_shipments where not _is_ghost_order""")
add("gold_fact_reviews", """
select review_id, order_id, product_id, customer_id, seller_id, rating, review_text, helpful_votes, review_date,
  case when rating >= 4 then 'Positive' when rating = 3 then 'Neutral' else 'Negative' end as sentiment,
  review_text is not null and review_text <> '' as has_review_text
from silver_reviews where not _is_ghost_order""")
add("gold_fact_refunds", """
select refund_id, order_id, customer_id, product_id, refund_amount, reason, status, requested_date, processed_date,
  cast(processed_date - requested_date as integer) as processing_days
from silver_refunds where not _is_ghost_order""")
add("gold_fact_commissions", """
select commission_id, seller_id, order_id, sale_amount, commission_rate, commission_amount, month_year, payment_status from silver_commissions""")
add("gold_fact_inventory", """
select inventory_id, product_id, warehouse_id, quantity_available, quantity_reserved, quantity_available - quantity_reserved as quantity_free,
  reorder_level, coalesce(quantity_available <= reorder_level, false) as needs_reorder, last_updated, snapshot_date from silver_inventory""")
add("gold_fact_sessions", """
select session_id, customer_id, event_type, channel, device_type, pages_viewed, session_start, event_time from silver_sessions""")
add("gold_fact_cart_events", """
select event_id, session_id, customer_id, product_id, action, quantity, unit_price, total_amount, channel, event_time
from silver_cart_events where not _is_zero_amount""")
add("gold_fact_campaign_responses", """
select response_id, campaign_id, customer_id, campaign_type, action, category_id, event_time from silver_campaign_responses""")
add("bought", f"""
select customer_id, count(order_id) as total_orders, {money_total('order_amount')} as lifetime_revenue,
  {money_mean('order_amount')} as avg_order_value, min(order_date) as first_order_date, max(order_date) as last_order_date,
  count(*) filter (order_status = 'delivered') as delivered_orders
from silver_orders where order_status <> 'cancelled' group by customer_id""")
add("reviewed", f"""
select customer_id, count(review_id) as total_reviews, {money_mean('rating')} as avg_rating
from silver_reviews where not _is_ghost_order group by customer_id""")
add("refunded", f"""
select customer_id, count(refund_id) as total_refunds, {money_total('refund_amount')} as total_refund_amount
from silver_refunds where not _is_ghost_order group by customer_id""")
add("gold_agg_customer_360", f"""
select b.customer_id, total_orders, coalesce(lifetime_revenue, 0.0) as lifetime_revenue, coalesce(avg_order_value, 0.0) as avg_order_value,
  first_order_date, last_order_date, delivered_orders,
  cast((select max(order_date) from silver_orders) - last_order_date as integer) as days_since_last_order,
  coalesce(total_reviews, 0) as total_reviews, coalesce(avg_rating, 0.0) as avg_rating,
  coalesce(total_refunds, 0) as total_refunds, coalesce(total_refund_amount, 0.0) as total_refund_amount,
  case when total_orders > 0 then {half_up('coalesce(total_refunds, 0) * 100', 'total_orders', 2)} else 0.0 end as refund_rate_pct
from bought b left join reviewed v on b.customer_id = v.customer_id left join refunded f on b.customer_id = f.customer_id""")
add("gold_agg_daily_sales", f"""
select order_date, count(order_id) as total_orders, {money_total('order_amount')} as total_revenue,
  {money_mean('order_amount')} as avg_order_value, count(*) filter (order_status = 'delivered') as delivered_orders
from silver_orders where order_date is not null and order_status <> 'cancelled' group by order_date""")
add("gold_agg_seller_performance", f"""
select o.seller_id, total_orders, coalesce(total_revenue, 0.0) as total_revenue, coalesce(avg_rating, 0.0) as avg_rating,
  coalesce(total_reviews, 0) as total_reviews, coalesce(total_commission, 0.0) as total_commission
from (select seller_id, count(order_id) as total_orders, {money_total('order_amount')} as total_revenue from silver_orders
      where order_status <> 'cancelled' and seller_id is not null group by seller_id) o
left join (select seller_id, {money_mean('rating')} as avg_rating, count(review_id) as total_reviews from silver_reviews
      where not _is_ghost_order group by seller_id) r on o.seller_id = r.seller_id
left join (select seller_id, {money_total('commission_amount')} as total_commission from silver_commissions group by seller_id) c
  on o.seller_id = c.seller_id""")
