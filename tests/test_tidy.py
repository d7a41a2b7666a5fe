"""What is written on the way and read no more doesn't stay."""

import os
import re
import time

from pyspark.sql import functions as F

from keepwell.plans import ingest_queries
from keepwell.plans.registry import QUERIES
from keepwell.session import TIDY, scratch_path, stored
from keepwell.streaming import evolving


def _shuffles(spark):
    """Ids of the shuffles that have files."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return set(re.findall(r"shuffle_(\d+)_", files))


def test_shuffle_files_go_when_a_table_is_stored(spark):
    before, setting = _shuffles(spark), spark.conf.get(TIDY)
    rows = spark.range(5000).repartition(3, "id")
    kept = stored(rows.groupBy((F.col("id") % 70).alias("k")).count(), "tidy")
    until = time.monotonic() + 20
    while _shuffles(spark) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not _shuffles(spark) - before
    assert kept.agg(F.sum("count"), F.count("k")).first() == (5000, 70) and rows.count() == 5000
    assert stored(rows, "tidy-again").count() == 5000 and spark.conf.get(TIDY) == setting


def _names(folder):
    return sorted(os.listdir(folder.removeprefix("file:")))


def test_staged_batches_go_when_they_have_landed(spark):
    base, found = scratch_path(spark, "landed"), []
    for number, text in enumerate(("id,a\n1,x\n2,", "b,id\ny,3")):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(f"{base}/in/{number}")
        rows = evolving.ingest_evolving(spark, f"{base}/in", f"{base}/table", f"{base}/check", keep_staged=False)
        found.append(sorted((r.id, r.a) for r in rows.collect()))
    assert found == [[("1", "x"), ("2", None)], [("1", "x"), ("2", None), ("3", None)]]
    assert [n for n in _names(f"{base}/table-staged") if n.startswith("batch")] == [] and len(_names(f"{base}/table-types")) == 2


def test_only_kinds_stay_of_a_feed_whose_types_were_asked_for(spark, monkeypatch):
    monkeypatch.setattr(ingest_queries, "FILES_ONLY", ("inventory",))
    monkeypatch.setattr(ingest_queries, "DUAL", ())
    bases = []
    monkeypatch.setattr(ingest_queries, "scratch_path", lambda *a: bases.append(scratch_path(*a)) or bases[-1])
    types = QUERIES["ingest_column_types"](spark, "/root/testdata/sf0.001")
    assert {(r.column_name, r.type) for r in types.collect()} >= {("inventory_id", "string"), ("quantity_available", "int"), ("snapshot_date", "date")}
    assert [_names(base) for base in bases] == [["table-types"]]
