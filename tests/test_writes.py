"""How layers are written: settings during a write, raw tables that one reader goes through, and the sort of a dedup."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from keepwell.functions.parsing import calendar_date
from keepwell.operators.dedup import latest_by_key
from keepwell.plans import lake as lakes
from keepwell.session import HUGE, WRITERS, wide_writes


@pytest.fixture
def plain(spark):
    """The session with Spark's defaults for both settings."""
    before = {key: spark.conf.get(key) for key in (HUGE, WRITERS)}
    spark.conf.set(HUGE, 65535)
    spark.conf.set(WRITERS, 0)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def test_settings_hold_during_a_write_only(plain):
    with pytest.raises(ValueError), wide_writes(plain):
        assert (plain.conf.get(HUGE), plain.conf.get(WRITERS)) == ("8000", "4")
        raise ValueError
    assert (plain.conf.get(HUGE), plain.conf.get(WRITERS)) == ("65535", "0")
    plain.conf.set(HUGE, 4000)
    plain.conf.set(WRITERS, 9)
    with wide_writes(plain):
        assert (plain.conf.get(HUGE), plain.conf.get(WRITERS)) == ("4000", "9")


def test_a_checked_table_needs_no_written_raw_table(plain, tmp_path, monkeypatch):
    lake, read = lakes.Lake(plain, str(tmp_path)), []
    rows = plain.createDataFrame([("B1", " b ", "India", "true", "1950", "true"), ("B1", "a", "India", "true", "1951", "true"),
                                  (None, "c", None, None, "x", None)],
                                 "brand_id string, brand_name string, country_origin string, is_premium string, established_year string, is_active string")
    monkeypatch.setattr(lake.source, "table", lambda name: read.append(name) or rows)
    kept = lake.table("brands").select("brand_id", "brand_name", "established_year")
    assert sorted(map(tuple, kept.collect()), key=str) == [("B1", "b", 1950), (None, "c", None)]
    key = (plain.sparkContext.applicationId, str(tmp_path), "bronze_brands")
    assert key not in lakes._WRITTEN and read == ["brands"]
    lake.raw("brands")
    assert lake.unwritten("brands") is lakes._WRITTEN[key] and read == ["brands", "brands"]


def test_dedup_sorts_by_a_hash_of_the_key_first(spark):
    rows = spark.createDataFrame([("ORD000000001", 1, "a"), ("ORD000000001", 2, "b"), ("ORD000000002", 1, None), (None, 3, "x"), (None, 4, "y"),
                                  ("ORD000000001", 2, "c")], "id string, at int, what string")
    latest = latest_by_key(rows, "id", "at")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64(id" in plan and plan.count("WindowGroupLimit") == 2
    assert sorted(map(tuple, latest.collect()), key=str) == [("ORD000000001", 2, "c"), ("ORD000000002", 1, None), (None, 4, "y")]
    assert latest.columns == rows.columns


def test_dates_in_both_layouts_and_in_none(spark):
    texts = ["2020-01-15", "15-01-2020", "99-01-2020", "1-1-2020", "15", "", "  -2020", "-2020-01-01", "+2020-01-01", "not a date", "20-0-01", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plainly = F.coalesce(*[F.try_to_date("t", layout) for layout in ("yyyy-MM-dd", "dd-MM-yyyy")])
    got = df.select(calendar_date("t").cast("string").alias("a"), plainly.cast("string").alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got] and got[0].a == got[1].a == "2020-01-15"
