"""Ingested tables must equal the raw rows they were written from."""

from __future__ import annotations

from checks.reports import union
from keepwell.sources.schemas import HISTORY, TOPICS

CHECKS: dict[str, str] = {}
_TRUE = "true as has_file, true as has_time"
for _t in ("shipments", "refunds", "commissions"):
    CHECKS[f"ingest_{_t}"] = f"select * exclude (_ingested_at), {_TRUE} from raw_{_t}"
# blank text and missing text are the same thing in a CSV field
CHECKS["ingest_reviews"] = f"select * exclude (_ingested_at, copy), {_TRUE} from raw_reviews"
CHECKS["ingest_inventory"] = f"select *, {_TRUE} from raw_inventory"
CHECKS["ingest_geo"] = f"select *, {_TRUE} from raw_geo"
for _t in ("sessions", "cart_events", "campaign_responses", "orders", "payments"):
    CHECKS[f"ingest_{_t}"] = f"select * exclude (_ingested_at), {_TRUE} from raw_{_t}"
CHECKS["ingest_topic_counts"] = union(f"select '{t}' as table_name, count(*) as rows from raw_{t} where _source = 'live_events'"
                                      for t in ("sessions", "cart_events", "campaign_responses", "orders", "payments"))
_TYPES = {"commission_id": "string", "seller_id": "string", "order_id": "string", "sale_amount": "double", "commission_rate": "double",
          "commission_amount": "double", "month_year": "string", "payment_status": "string"}
CHECKS["ingest_inferred_types"] = union(
    f"select '{c}' as column_name, '{t}' as type, count({c}) as filled from raw_commissions" for c, t in _TYPES.items())
CHECKS["ingest_schema_evolution"] = """
select refund_id, order_id, customer_id, product_id, refund_amount, status, requested_date,
  case when status <> 'pending' then reason end as reason, case when status <> 'pending' then processed_date end as processed_date from raw_refunds"""
CHECKS["ingest_master_counts"] = union(f"select '{t}' as table_name, count(*) as rows from raw_{t}"
                                       for t in ("customers", "products", "sellers", "brands", "categories", "warehouses"))
CHECKS["ingest_incremental_append"] = "select payment_id, payment_amount, payment_date from silver_payments"
for _t in ("orders", "payments", "shipments", "refunds"):
    CHECKS[f"ingest_nightly_{_t}"] = f"select * from undropped_{_t}"
CHECKS["report_alerts_streamed"] = """
select review_id, i.customer_id, rating, review_date, sentiment, sentiment_score, issues, i.churn_probability, i.churn_risk_band, i.top_churn_reason,
  i.rfm_segment, i.retention_priority, offers from rule_insights i left join (
  select customer_id, string_agg(product_id, ', ' order by rfmq_rank) as offers from rule_reranked where rfmq_rank <= 3 group by customer_id) o
  on i.customer_id = o.customer_id where i.rfm_segment = 'Champions' and i.churn_probability >= 0.5 and sentiment = 'negative'"""
for _p in ("day", "quarter", "year"):
    CHECKS[f"report_alerts_once_a_{_p}"] = f"""
select * exclude (n) from (select *, row_number() over (partition by customer_id, date_trunc('{_p}', review_date) order by rating nulls last, review_id) as n
  from ({CHECKS["report_alerts_streamed"]}) where review_date is not null and customer_id is not null) where n = 1"""


def _evolved(table: str, names: list[str], where: str = "") -> str:
    """The earlier delivery, chosen by the first digit of the key's md5, has no last column."""
    early = f"coalesce(substr(md5(cast({names[0]} as varchar)), 1, 1) < '8', false)"
    return (f"select {', '.join(names[:-1])}, case when not {early} then {names[-1]} end as {names[-1]}, {_TRUE} from raw_{table} {where}")


_COLUMNS = {
    "shipments": "shipment_id order_id warehouse_id carrier tracking_number shipped_date estimated_delivery actual_delivery status late_delivery_risk weight_kg",
    "reviews": "review_id order_id product_id customer_id seller_id rating review_text helpful_votes review_date",
    "refunds": "refund_id order_id customer_id product_id refund_amount reason status requested_date processed_date",
    "commissions": "commission_id seller_id order_id sale_amount commission_rate commission_amount month_year payment_status",
    "inventory": "inventory_id product_id warehouse_id quantity_available quantity_reserved reorder_level last_updated snapshot_date",
    "geo": "pincode city state region latitude longitude"}
for _t, _names in _COLUMNS.items():
    CHECKS[f"ingest_evolving_{_t}"] = _evolved(_t, _names.split())
for _t, _schema in HISTORY.items():
    CHECKS[f"ingest_evolving_{_t}"] = _evolved(_t, _schema.fieldNames(), "where _source = 'history_files'")
CHECKS["ingest_corrupt_messages"] = union(
    f"""select '{t}' as topic, '{kind}' as kind, count(*) as messages from raw_{t} where _source = 'live_events'
  and {test} coalesce(substr(md5({schema.fieldNames()[0]}), 1, 1) = '0', false)"""
    for t, schema in TOPICS.items() for kind, test in (("rows", "not"), ("corrupt", "")))

_CUT = {t: f"coalesce(substr(md5({schema.fieldNames()[0]}), 1, 1) = '0', false)" for t, schema in TOPICS.items()}
CHECKS["ingest_rule_counts"] = union(
    f"""select '{t}' as table_name, count(*) as rows_in, count(*) filter (where {cut}) as rows_quarantined, '{rule}' as rule, '{action}' as action,
  count(*) filter (where {cut} or {test}) as violations, count(*) filter (where not {cut}) as rows_kept from raw_{t} where _source = 'live_events'"""
    for t, cut in _CUT.items() for rule, action, test in (("readable", "drop", "false"), ("has_customer", "warn", "customer_id is null")))

# kinds of text, as bits: int 1, long 2, double 4, date 8, timestamp 16, other 32
_KIND = r"""case when v is null then null
  when regexp_full_match(v, '-?(0|[1-9][0-9]{0,17})') then case when abs(try_cast(v as bigint)) <= 2147483647 then 1 else 2 end
  when regexp_full_match(v, '-?(0|[1-9][0-9]*)(\.[0-9]+([eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+)') then 4
  when regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') and try_cast(v as date) is not null then 8
  when regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}') and try_cast(v as timestamp) is not null then 16 else 32 end"""
_JOINED = """case when k is null or k >= 32 or (k & 7 <> 0 and k & 24 <> 0) then 'string' when k & 16 <> 0 then 'timestamp' when k & 8 <> 0 then 'date'
  when k & 4 <> 0 then 'double' when k & 2 <> 0 then 'bigint' else 'int' end"""


def _typed_columns(table: str, names: list[str], where: str = "") -> str:
    early = f"coalesce(substr(md5(cast({names[0]} as varchar)), 1, 1) < '8', false)"
    values = {n: f"nullif(cast({n} as varchar), '')" if n != names[-1] else f"case when not {early} then nullif(cast({n} as varchar), '') end" for n in names}
    return union(f"""select '{table}' as table_name, '{n}' as column_name, {_JOINED} as type, filled from (
  select bit_or({_KIND}) as k, count(v) as filled from (select {v} as v from raw_{table} {where}))""" for n, v in values.items())


CHECKS["ingest_column_types"] = union([
    *(_typed_columns(t, names.split()) for t, names in _COLUMNS.items()),
    *(_typed_columns(t, schema.fieldNames(), "where _source = 'history_files'") for t, schema in HISTORY.items())])
_DAY = "regexp_full_match(payment_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') and try_cast(payment_date as date) is not null"
CHECKS["ingest_typed_payments"] = f"""
select payment_id, order_id, customer_id, payment_method, cast(payment_amount as double) as payment_amount, payment_status, gateway,
  case when {_DAY} then cast(payment_date as date) end as payment_date, case when not ({_DAY}) then payment_date end as other_date, {_TRUE}
from raw_payments where _source = 'history_files'"""
