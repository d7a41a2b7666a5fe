import datetime as dt

from pyspark.sql import functions as F

from keepwell.functions import parsing as p
from keepwell.operators import gold, silver
from keepwell.operators.dedup import latest_by_key
from keepwell.operators.quality import (ExpectationFailed, check_failed, drop, drop_violations, enforce, expect, fail,
                                        violation_report, warn)
import pytest


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "c string").select(column.alias("out")).first()["out"]


@pytest.mark.parametrize("text, want", [
    ("2024-01-05", dt.date(2024, 1, 5)), ("05-01-2024", dt.date(2024, 1, 5)), ("5th of May", None), ("", None), (None, None),
    ("31-02-2024", None)])
def test_dates_in_both_layouts(spark, text, want):
    assert one(spark, text, p.calendar_date("c")) == want


@pytest.mark.parametrize("text, want", [
    ("2024-01-05T10:30:00", dt.datetime(2024, 1, 5, 10, 30)), ("2024-01-05 10:30:00", dt.datetime(2024, 1, 5, 10, 30)),
    ("05-01-2024 06:45", dt.datetime(2024, 1, 5, 6, 45)), ("2024-01-05", dt.datetime(2024, 1, 5)), ("soon", None)])
def test_timestamps_in_all_layouts(spark, text, want):
    assert one(spark, text, p.moment("c")) == want


@pytest.mark.parametrize("text, want", [("Rs 1,299.50", 1299.5), ("1299", 1299.0), ("Call for price", None), (None, None)])
def test_currency(spark, text, want):
    assert one(spark, text, p.currency("c")) == want


def test_ghost_flag_is_never_null(spark):
    rows = spark.createDataFrame([("ORD_GHOST_1",), ("ORD1",), (None,)], "order_id string").select(p.is_ghost("order_id").alias("g")).collect()
    assert [r["g"] for r in rows] == [True, False, False]


def test_dedup_keeps_latest_and_is_stable_on_equal_times(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, None), (None, 1, "n"), (None, 1, "n")]
    for shuffled in (rows, rows[::-1]):
        df = spark.createDataFrame(shuffled, "k string, _ingested_at int, v string")
        assert sorted(map(tuple, latest_by_key(df, "k").collect()), key=str) == sorted([("a", 2, "z"), ("b", 1, None), (None, 1, "n")], key=str)


def test_dedup_reduces_a_hot_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k", "id as _ingested_at", "id as v")
    plan = latest_by_key(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Partial") > plan.index("Exchange")


def test_expectations_count_drop_and_fail(spark):
    df = spark.createDataFrame([("1", 5.0), (None, 1.0), ("3", None)], "id string, amount double")
    rules = [drop("has_id", "id is not null"), warn("positive", "amount > 0")]
    kept, seen = expect(df, rules, "counts")
    assert kept.count() == 2
    assert seen.get == {"rows_in": 3, "has_id": 1, "positive": 1}
    report = {r["rule"]: r["violations"] for r in violation_report(df, rules, "t").collect()}
    assert report == {"has_id": 1, "positive": 1}
    strict = [fail("positive", "amount > 0")]
    with pytest.raises(Exception, match="expectation failed: positive"):
        enforce(df, strict).count()
    counted, seen = expect(df, strict, "strict")
    counted.count()
    with pytest.raises(ExpectationFailed):
        check_failed(strict, seen)
    assert drop_violations(df, strict).count() == 3


def test_silver_is_unmoved_by_duplicates_and_flipped_dates(spark, lake):
    raw = lake.raw("shipments")
    flipped = F.concat_ws("-", F.substring("shipped_date", 9, 2), F.substring("shipped_date", 6, 2), F.substring("shipped_date", 1, 4))
    iso = F.col("shipped_date").rlike("^[0-9]{4}-")
    changed = raw.withColumn("shipped_date", F.when(iso, flipped).otherwise(F.col("shipped_date"))).unionByName(raw)
    a, b = silver.clean("shipments", raw), silver.clean("shipments", changed)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_null_price_and_null_rating_tiers(spark):
    products = spark.createDataFrame([("p1", None, 10.0), ("p2", 499.99, 10.0), ("p3", 500.0, 10.0), ("p4", 0.0, 1.0)],
                                     "product_id string, retail_price double, cost_price double").selectExpr(
        "*", "'n' as product_name", "'b' as brand_id", "'c' as category_id", "1.0 as weight_kg", "1 as stock_quantity", "'x' as unit_size", "true as is_active")
    brands = spark.createDataFrame([], "brand_id string, brand_name string, is_premium boolean")
    categories = spark.createDataFrame([], "category_id string, category_name string, parent_category string")
    got = {r["product_id"]: (r["price_tier"], r["margin_pct"], r["brand_name"]) for r in gold.dim_product(products, brands, categories).collect()}
    assert got == {"p1": ("Luxury", 0.0, "Unknown"), "p2": ("Budget", 98.0, "Unknown"), "p3": ("Mid-Range", 98.0, "Unknown"), "p4": ("Budget", 0.0, "Unknown")}
    sellers = spark.createDataFrame([("a", None), ("b", 4.5), ("c", 3.0)], "seller_id string, rating double").selectExpr("*", "'c' city", "'s' state", "'e' email", "'p' phone")
    assert {r["seller_id"]: r["seller_tier"] for r in gold.dim_seller(sellers).collect()} == {"a": "Bronze", "b": "Platinum", "c": "Silver"}


def test_calendar(spark):
    days = {str(r["date_key"]): r for r in gold.dim_date(spark).collect()}
    assert len(days) == 2557
    assert days["2024-11-01"]["festive_event_name"] == "Diwali" and days["2024-11-01"]["fiscal_quarter"] == 3
    assert days["2026-01-01"]["is_new_year"] and not days["2026-01-01"]["is_festive_day"]
    assert days["2023-03-31"]["fiscal_year"] == 2022 and days["2020-11-11"]["is_dhamaka_days"] and not days["2020-11-12"]["is_dhamaka_days"]
    assert not days["2024-03-10"]["is_wedding_season"] and days["2024-03-15"]["is_wedding_season"]


def test_customer_360_keeps_the_missing_customer_and_drops_missing_status(spark, lake):
    table = lake.gold("agg_customer_360")
    assert table.where("customer_id is null").count() == 1
    kept = lake.silver("orders").where("order_status <> 'cancelled'").count()
    assert table.agg(F.sum("total_orders")).first()[0] == kept


def test_left_joins_do_not_change_row_counts(lake):
    assert lake.gold("dim_customer").count() == lake.silver("customers").count()
    assert lake.gold("dim_product").count() == lake.silver("products").count()
