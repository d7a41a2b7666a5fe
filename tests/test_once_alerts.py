"""Alerts once per customer and period: repeats, restarts and late reviews."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepwell.session import scratch_path
from keepwell.streaming import once_alerts

KIND = "review_id string, customer_id string, rating int, review_date date"


def _deliver(spark, base, *rows):
    spark.createDataFrame([(r, c, n, d and dt.date.fromisoformat(d)) for r, c, n, d in rows], KIND).coalesce(1).write.mode("append").parquet(f"{base}/in")


def _run(spark, base, period="day", delay="3 days"):
    arriving = spark.readStream.schema(KIND).parquet(f"{base}/in")
    query = once_alerts.run(once_alerts.once(arriving, period, delay), f"{base}/out", f"{base}/check")
    return once_alerts.late_rows(query), sorted(r.review_id for r in spark.read.schema(KIND).parquet(f"{base}/out").collect())


def test_one_alert_per_customer_and_day_over_restarts_and_late_reviews(spark):
    base = scratch_path(spark, "once")
    _deliver(spark, base, ("r3", "a", 2, "2024-05-01"), ("r1", "a", None, "2024-05-01"), ("r2", "a", 1, "2024-05-01"),
             ("r4", "b", 1, "2024-05-01"), ("r5", "a", 1, "2024-05-02"), ("r6", None, 1, "2024-05-01"), ("r7", "a", 1, None))
    assert _run(spark, base) == (0, ["r2", "r4", "r5"])
    assert _run(spark, base) == (0, ["r2", "r4", "r5"])  # nothing new: nothing happens
    _deliver(spark, base, ("r0", "a", 0, "2024-05-01"), ("r8", "b", 5, "2024-05-03"))
    assert _run(spark, base) == (0, ["r2", "r4", "r5", "r8"])  # the day has had its alert, a lower rating too late
    _deliver(spark, base, ("r9", "a", 1, "2024-06-01"))
    assert _run(spark, base)[1] == ["r2", "r4", "r5", "r8", "r9"]
    _deliver(spark, base, ("l1", "c", 1, "2024-05-20"), ("l2", "a", 1, "2024-05-01"), ("on", "c", 1, "2024-05-30"))
    assert _run(spark, base) == (2, ["on", "r2", "r4", "r5", "r8", "r9"])  # late ones are counted, those within the delay alert
    assert spark.conf.get(once_alerts.STORE, None) != once_alerts.ROCKSDB


@pytest.mark.parametrize("period", ["week", "month", "quarter", "year"])
def test_periods_equal_a_window_over_all_rows(spark, period):
    """Ties of the rating, one customer with a third of the rows."""
    base = scratch_path(spark, "once")
    rows = spark.range(600).selectExpr(
        "concat('r', id) review_id", "if(id % 3 = 0, 'hot', concat('c', id % 7)) customer_id",
        "cast(id * 7 % 5 as int) rating", "date_add(date'2023-11-01', cast(id * 37 % 100 as int)) review_date")
    rows.coalesce(1).write.parquet(f"{base}/in")
    ranked = rows.withColumn("n", F.expr(f"row_number() over (partition by customer_id, date_trunc('{period}', review_date) order by rating, review_id)"))
    assert _run(spark, base, period)[1] == sorted(r.review_id for r in ranked.where("n = 1").collect())


def test_no_reviews_no_alerts(spark):
    base = scratch_path(spark, "once")
    _deliver(spark, base)
    assert _run(spark, base) == (0, [])
