"""Every query by name: a Spark function of (spark, directory) and, where SQL can say it, its check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keepwell.operators import gold, silver
from keepwell.plans.lake import Lake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a function of a Lake."""
    def wrap(fn: Callable[[Lake], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, sf_dir: fn(Lake(spark, sf_dir))
        return fn
    return wrap


for _name in silver.BUILDERS:
    query(f"silver_{_name}")(lambda lake, n=_name: lake.silver(n))
for _name in ("dim_date", *gold.TABLES):
    query(f"gold_{_name}")(lambda lake, n=_name: lake.gold(n))


# ---------------------------------------------------------------- data quality and profiling
from pyspark.sql import functions as F  # noqa: E402

from keepwell.functions.ordering import grouped_quantiles  # noqa: E402
from keepwell.functions.parsing import is_ghost  # noqa: E402
from keepwell.operators import features as feat  # noqa: E402
from keepwell.operators import interactions as inter  # noqa: E402
from keepwell.operators import profiling as prof  # noqa: E402
from keepwell.operators.quality import conservation  # noqa: E402


@query("quality_expectations")
def _expectations(lake):
    """What was counted when the tables were written."""
    return prof.stacked([lake.checked(name).counts for name in silver.BUILDERS]).drop("rows_quarantined")


query("quality_conservation")(lambda lake: conservation({name: lake.checked(name) for name in silver.BUILDERS}))


@query("quality_quarantined")
def _quarantined(lake):
    """Rows that were set aside, by the rules they break."""
    return prof.stacked([lake.checked(name).quarantined.groupBy(F.array_join("broken_rules", ",").alias("broken_rules")).agg(
        F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "broken_rules", "rows") for name in silver.BUILDERS])


KEYED = {"customers": "customer_id", "products": "product_id", "sellers": "seller_id", "brands": "brand_id", "categories": "category_id",
         "warehouses": "warehouse_id", "orders": "order_id", "payments": "payment_id", "shipments": "shipment_id", "reviews": "review_id",
         "refunds": "refund_id", "commissions": "commission_id", "sessions": "session_id", "cart_events": "coalesce(event_id, cart_event_id)",
         "campaign_responses": "response_id", "inventory": "inventory_id", "geo": "pincode"}
COVERED = {"orders": ["order_amount", "subtotal", "freight_value", "delivery_charge", "order_date", "order_timestamp"],
           "payments": ["payment_amount", "amount", "payment_status", "status", "payment_date", "payment_time", "gateway", "upi_id"]}
CATEGORICAL = {"orders": ["_source", "order_status"], "payments": ["_source", "payment_method"], "shipments": ["status"],
               "reviews": ["rating"], "refunds": ["status"], "cart_events": ["action"], "campaign_responses": ["campaign_type"],
               "geo": ["region"], "sessions": ["channel", "device_type"]}
HISTOGRAMS = ("recency_days", "total_orders", "total_spent", "refund_count", "abandon_rate")
RFM = ["recency_days", "total_orders", "total_spent"]

query("profile_nulls")(lambda lake: prof.stacked([prof.null_report(lake.raw(t), t) for t in silver.BUILDERS]))
query("profile_duplicates")(lambda lake: prof.stacked([prof.duplicate_report(lake.raw(t), k, t) for t, k in KEYED.items()]))
query("profile_castability")(lambda lake: prof.castability(lake.raw("products"), "retail_price", "double"))
query("profile_coverage")(lambda lake: prof.stacked([prof.coverage_matrix(lake.raw(t), c, t) for t, c in COVERED.items()]))
query("profile_categories")(lambda lake: prof.stacked([
    prof.distributions(lake.raw(t), columns, t) for t, columns in CATEGORICAL.items()]))


@query("profile_layouts")
def _layouts(lake):
    def day(c):
        return {"yyyy-MM-dd": F.try_to_date(F.col(c), "yyyy-MM-dd").isNotNull(),
                "dd-MM-yyyy": F.try_to_date(F.col(c), "dd-MM-yyyy").isNotNull()}

    def moment(c, *layouts):
        return {x: F.try_to_timestamp(F.col(c), F.lit(x)).isNotNull() for x in layouts}
    return prof.stacked([
        prof.layout_share(lake.raw("orders").where("_source = 'history_files'"), "order_date", day("order_date"), "orders"),
        prof.layout_share(lake.raw("reviews"), "review_date", day("review_date"), "reviews"),
        prof.layout_share(lake.raw("inventory"), "last_updated", moment("last_updated", "dd-MM-yyyy HH:mm"), "inventory"),
        prof.layout_share(lake.raw("sessions"), "event_time", moment("event_time", "yyyy-MM-dd HH:mm:ss"), "sessions")])


@query("profile_layout_samples")
def _layout_samples(lake):
    """The five first order dates that are not ISO: a sample report, so the limit is the feature."""
    odd = F.try_to_date(F.col("order_date"), "yyyy-MM-dd").isNull() & F.col("order_date").isNotNull()
    return lake.raw("orders").where(odd).select("order_id", "order_date").distinct().orderBy("order_id", "order_date").limit(5)


@query("profile_defect_rates")
def _defects(lake):
    live, history, every = F.col("_source") == "live_events", F.col("_source") == "history_files", F.lit(True)

    def zero(c):
        return F.coalesce(F.col(c).try_cast("double") == 0, F.lit(False))

    def missing(c):
        return F.col(c).isNull()
    return prof.stacked([prof.rates(lake.raw(table), tests) for table, tests in {
        "orders": {"history orders without customer": (history, missing("customer_id")), "live orders with zero total": (live, zero("total_amount")),
                   "live orders without pincode": (live, missing("delivery_pincode")), "orders without product": (every, missing("product_id")),
                   "orders without customer and product": (every, missing("customer_id") & missing("product_id"))},
        "payments": {"live payments with zero amount": (live, zero("amount"))},
        "cart_events": {"cart events with zero total": (every, zero("total_amount"))},
        **{t: {f"{t} of ghost orders": (every, is_ghost("order_id"))} for t in ("shipments", "reviews", "refunds")}}.items()])


@query("profile_customer_coverage")
def _coverage(lake):
    return prof.customer_coverage(lake.table("orders").where("customer_id is not null"),
                                  {t: lake.table(t) for t in ("sessions", "cart_events", "reviews", "refunds", "payments")})


query("profile_monthly_orders")(lambda lake: prof.monthly_orders(lake.table("orders")))
query("profile_rfm_summary")(lambda lake: prof.summary(lake.rfm(), RFM))
query("profile_spend_percentiles")(lambda lake: prof.percentiles(lake.rfm(), "total_spent"))
query("profile_amounts_by_product")(lambda lake: grouped_quantiles(lake.table("orders"), ["product_id", "_source"], "order_amount", [0.25, 0.5, 0.75, 1.0]).select(
    "product_id", "_source", "n", "prob", F.round("value", 6).alias("order_amount")))
query("profile_skewness")(lambda lake: prof.sample_skewness(lake.rfm(), RFM))
query("profile_correlation")(lambda lake: prof.correlations(lake.rfm(), RFM))
query("profile_spend_share")(lambda lake: prof.share_under(lake.rfm(), "total_spent", 1_000_000.0))
query("profile_class_balance")(lambda lake: prof.class_balance(lake.features(), feat.LABEL))
query("profile_recency_by_label")(lambda lake: prof.bins(lake.features(), "recency_days", 50, [feat.LABEL]))
query("profile_histograms")(lambda lake: prof.stacked([
    *[prof.bins(feat.as_doubles(lake.features()), c) for c in HISTOGRAMS],
    *[prof.bins(lake.table("sessions"), c) for c in ("pages_viewed", "session_duration_seconds")]]))

# ---------------------------------------------------------------- recommendation data
_signal_tables = ("orders", "cart_events", "reviews")


def _last_day(lake):
    return lake.table("orders").agg(F.max("order_date")).scalar()


def _last_review(lake):
    return lake.table("reviews").agg(F.max("review_date")).scalar()


query("recdata_matrix_size")(lambda lake: inter.matrix_size(lake.table("orders")))
query("recdata_cold_warm")(lambda lake: prof.stacked([
    inter.cold_warm(lake.table("orders"), "customer_id", inter.COLD_CUSTOMER),
    inter.cold_warm(lake.table("orders"), "product_id", inter.COLD_PRODUCT)]))
query("recdata_top_products")(lambda lake: inter.top_products(lake.table("orders")))
query("recdata_repeat_purchases")(lambda lake: inter.repeat_purchases(lake.table("orders")))
query("recdata_pairs_per_signal")(lambda lake: inter.pairs_per_signal(*[lake.table(t) for t in _signal_tables]))
query("recdata_confidence")(lambda lake: inter.confidence_distribution(
    inter.interaction_matrix(*[lake.table(t) for t in _signal_tables])))
query("recdata_window_coverage")(lambda lake: inter.window_coverage(lake.table("orders"), [6, 12], _last_day(lake)))
query("recdata_windowed_matrix")(lambda lake: inter.windowed_matrix(
    *[lake.table(t) for t in _signal_tables], 6, _last_review(lake)).drop("order_date"))
query("recdata_signal_density")(lambda lake: prof.stacked([
    inter.signal_density(lake.interactions()).withColumn("history", F.lit("full")),
    inter.signal_density(inter.windowed_matrix(*[lake.table(t) for t in _signal_tables], 6, _last_review(lake)))
         .withColumn("history", F.lit("6 months"))]))
query("recdata_rating_split")(lambda lake: inter.rating_split(lake.table("reviews")))
query("recdata_missing_products")(lambda lake: inter.missing_products(lake.table("orders")))
query("recdata_date_range")(lambda lake: inter.date_range(lake.table("orders")))

# ---------------------------------------------------------------- churn features
query("feature_rfm_base")(lambda lake: feat.rfm_base(lake.table("orders")))
query("feature_winsorised")(lambda lake: feat.winsorised(
    lake.rfm(), ["total_orders", "total_spent"]).select("customer_id", "total_orders", "total_spent"))
query("feature_sessions")(lambda lake: feat.session_features(lake.table("sessions")))
query("feature_preferred_payment")(lambda lake: feat.preferred_payment(lake.table("orders"), lake.table("payments")))
query("feature_ratings")(lambda lake: feat.rating_features(lake.table("reviews")))


@query("feature_refunds_and_carts")
def _refunds_and_carts(lake):
    base = lake.rfm().select("customer_id", "total_orders")
    joined = (base.join(feat.refund_features(lake.table("refunds")), "customer_id", "left")
              .join(feat.cart_adds(lake.table("cart_events")), "customer_id", "left").fillna(0, subset=["refund_count"]))
    return joined.withColumns({"refund_rate": feat.exact.ratio(F.col("refund_count"), F.col("total_orders")),
                               "abandon_rate": feat.abandonment(F.col("cart_adds"), F.col("total_orders"))})


@query("feature_payment_index")
def _payment_index(lake):
    return feat.by_frequency(feat.preferred_payment(lake.table("orders"), lake.table("payments")), "preferred_payment", "payment_idx")


query("feature_table")(lambda lake: feat.as_doubles(feat.feature_table(
    *[lake.table(t) for t in ("orders", "payments", "refunds", "cart_events", "sessions", "reviews")])))
