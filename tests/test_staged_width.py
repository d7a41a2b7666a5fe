"""Cells of evolving feeds as staged."""

from pyspark.sql import functions as F

from keepwell.session import scratch_path
from keepwell.streaming import evolving


def test_rows_are_staged_at_their_own_width(spark):
    base = scratch_path(spark, "width")
    spark.createDataFrame([("a,b,c\n1\n,,3\n1,2,3,4\n1,,3,,5",)], "value string").coalesce(1).write.option("lineSep", "\n").text(
        f"{base.removeprefix('file:')}/in/1")
    evolving.ingest_evolving(spark, f"{base}/in", f"{base}/table", f"{base}/check")
    staged = spark.read.parquet(f"{base}/table-staged")
    assert sorted(r[0] for r in staged.select(F.size("cells")).collect()) == [1, 3, 3, 4, 5]
    rows = spark.read.parquet(f"{base}/table").select("a", "b", "c", "_rescued").collect()
    assert sorted(map(str, map(tuple, rows))) == sorted([
        "('1', None, None, None)", "(None, None, '3', None)", "('1', '2', '3', {'#4': '4'})", "('1', None, '3', {'#5': '5'})"])
