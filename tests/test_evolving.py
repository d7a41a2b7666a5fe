"""Feeds whose columns and types change from delivery to delivery."""

import pytest
from pyspark.sql import functions as F

from keepwell.session import scratch_path
from keepwell.streaming import evolving


def _deliver(spark, base, number, text):
    path = f"{base.removeprefix('file:')}/in/{number}"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)


def _ingest(spark, base, options=evolving.CSV):
    return evolving.ingest_evolving(spark, f"{base}/in", f"{base}/table", f"{base}/check", options)


def _types(spark, base):
    return {r.column_name: r.type for r in evolving.types(spark, f"{base}/table").collect()}


def test_types_widen_with_deliveries_and_never_narrow(spark):
    base = scratch_path(spark, "widen")
    _deliver(spark, base, 1, "id,amount,day,code,empty\n1,5,2024-01-02,7,\n2,,2024-02-30,8,")
    _ingest(spark, base)
    assert _types(spark, base) == {"id": "int", "amount": "int", "day": "string", "code": "int", "empty": "string"}
    _deliver(spark, base, 2, "﻿amount,id,at\n2.50,3000000000,2024-01-01 10:00:00\n7,4,2024-01-01")
    _ingest(spark, base)
    assert _types(spark, base) == {"id": "bigint", "amount": "double", "day": "string", "code": "int", "empty": "string", "at": "timestamp"}
    rows = {r.id: r for r in evolving.typed(spark, f"{base}/table").collect()}
    assert rows[3_000_000_000].amount == 2.5 and rows[1].amount == 5.0 and rows[4].code is None and rows[2].day == "2024-02-30"
    _deliver(spark, base, 3, "id,code\n5,007")
    text = {r.id: r for r in _ingest(spark, base).collect()}
    assert _types(spark, base)["code"] == "string" and text["5"].code == "007" and text["3000000000"].amount == "2.50"  # nothing is lost
    held = {r.id: r for r in evolving.typed(spark, f"{base}/table", {"code": "int", "day": "date"}).collect()}
    assert held[5].code is None and held[5]._rescued == {"code": "007"} and held[1].code == 7 and held[1]._rescued is None
    assert held[2].day is None and held[2]._rescued == {"day": "2024-02-30"} and str(held[1].day) == "2024-01-02"


def test_cells_without_a_name_are_rescued(spark):
    base = scratch_path(spark, "loose")
    _deliver(spark, base, 1, 'a,b,a\n1,"x, ""y""",2,beyond\n3\n,,\n1,1,1')
    _deliver(spark, base, 2, "only,header")
    rows = _ingest(spark, base)
    assert set(rows.columns) == {"a", "b", "only", "header", "_ingested_at", "_source_file"}
    stored = spark.read.option("mergeSchema", "true").parquet(f"{base}/table")
    assert sorted((r.a or "", r.b or "", str(r._rescued)) for r in stored.collect()) == sorted([
        ("1", 'x, "y"', "{'#3': '2', '#4': 'beyond'}"), ("3", "", "None"), ("", "", "None"), ("1", "1", "{'#3': '1'}")])


def test_a_row_too_wide_is_an_error(spark):
    base = scratch_path(spark, "wide")
    _deliver(spark, base, 1, "a\n" + ",".join("x" * evolving.WIDEST))
    with pytest.raises(Exception, match="cells or more"):
        _ingest(spark, base)


def test_order_and_repetition_of_deliveries_do_not_matter(spark):
    values = ["1", "3000000000", "1.5", "2024-01-01", "2024-01-01 00:00:00", "-0", "01", "1e5", ".5", "9" * 19, "2024-02-30", " 1", "-7", "x"]
    kinds = {r.v: r.k for r in spark.createDataFrame([(v,) for v in values], "v string").select("v", evolving.kind(F.col("v")).alias("k")).collect()}
    assert [kinds[v] for v in values] == [1, 2, 4, 8, 16, 1, 32, 4, 32, 32, 32, 32, 1, 32]
    joined = {r.k: r.t for r in spark.range(64).select(F.col("id").cast("int").alias("k")).select("k", evolving.joined_type(F.col("k")).alias("t")).collect()}
    assert [joined[k] for k in (0, 1, 3, 5, 7, 8, 24, 9, 33, 16)] == ["string", "int", "bigint", "double", "double", "date", "timestamp", "string", "string", "timestamp"]


def test_rows_of_several_lines(spark):
    base = scratch_path(spark, "lines")
    _deliver(spark, base, 1, 'id,text\n1,"two\nlines"\n2,one')
    rows = _ingest(spark, base, {**evolving.CSV, "multiLine": "true"})
    assert {(r.id, r.text) for r in rows.collect()} == {("1", "two\nlines"), ("2", "one")}
