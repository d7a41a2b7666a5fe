"""Keep-latest from night to night: a table in key ranges, of which a night rewrites only those that it touches.

Folders of a table: `rows` (a partition per bucket), `staged/<night>` (the buckets as the night leaves them) and `borders/<night>`
(the smallest key of every bucket, written last). A night that was cut off is run again with the same number: a staged one is only
copied once more, a copied one is not repeated. Readers see the table between nights; while one is copied they may see parts of it.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.operators.dedup import latest_by_key
from keepwell.session import finished, stored

BUCKET = "_bucket"


def start(df: DataFrame, key: str, path: str, buckets: int, when: str = "_ingested_at") -> DataFrame:
    """Night 0: the latest row per key, cut into at most `buckets` key ranges of like size."""
    spark = df.sparkSession
    if not finished(spark, f"{path}/borders/0"):
        kept = latest_by_key(df, key, when).repartitionByRange(buckets, F.col(key).asc_nulls_first())
        kept.withColumn(BUCKET, F.spark_partition_id()).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/rows")
        _publish(spark.read.schema(f"{_kind(df, key)}, {BUCKET} int").parquet(f"{path}/rows"), key, path, 0)
    return read(spark, path, df)


def apply(delta: DataFrame, key: str, path: str, night: int, largest: int = 5_000_000, when: str = "_ingested_at") -> DataFrame:
    """Rows of night `night` (1, 2, ... in order) merged into the table; returns it.

    The latest row per key stays, ties settled as in `latest_by_key`, so the nights give what one run over all rows gives, in whatever
    order they come. Only buckets that hold a key of the night, or would hold it, are read and written. A bucket of more than
    `largest` rows is split by key on the way: keys that grow with time all fall into the last one. Null keys count as one
    smallest key. A night without rows changes nothing.
    """
    spark = delta.sparkSession
    if finished(spark, f"{path}/borders/{night}"):
        return read(spark, path, delta)
    borders = _borders(spark, path, night - 1)
    staged = f"{path}/staged/{night}"
    if not finished(spark, staged):
        new = stored(latest_by_key(delta, key, when).withColumn(BUCKET, _bucket_of(F.col(key), borders)), "night")
        touched = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most one row per bucket
        old = spark.read.schema(new.schema).parquet(f"{path}/rows").where(F.col(BUCKET).isin(touched))
        # the bucket follows from the key, so keys meet within their bucket
        merged = stored(latest_by_key(old.unionByName(new), key, when), "merged")
        _split(merged, key, largest, max((b for b, _ in borders), default=-1)).write.mode("overwrite").partitionBy(BUCKET).parquet(staged)
    ready = spark.read.schema(_with_bucket(delta)).parquet(staged)
    _by_bucket(ready).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(f"{path}/rows")
    again = ready.groupBy(BUCKET).agg(F.min(key).alias("low"))
    kept = spark.createDataFrame(borders, f"{BUCKET} int, low {_kind(delta, key).split(' ', 1)[1]}")
    kept.join(again, BUCKET, "left_anti").unionByName(again).coalesce(1).write.mode("overwrite").parquet(f"{path}/borders/{night}")
    return read(spark, path, delta)


def read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table, with the columns of `like`."""
    return spark.read.schema(_with_bucket(like)).parquet(f"{path}/rows").drop(BUCKET)


def rewritten(spark: SparkSession, path: str, night: int) -> list[int]:
    """The buckets that a night wrote."""
    return [r[0] for r in spark.read.schema(f"{BUCKET} int").parquet(f"{path}/staged/{night}").distinct().orderBy(BUCKET).collect()]


# ---------------------------------------------------------------- buckets
def _kind(df: DataFrame, key: str) -> str:
    return f"{key} {df.schema[key].dataType.simpleString()}"


def _with_bucket(df: DataFrame):
    return df.select(*[c for c in df.columns if c != BUCKET], F.lit(0).alias(BUCKET)).schema


def _publish(rows: DataFrame, key: str, path: str, night: int) -> None:
    rows.groupBy(BUCKET).agg(F.min(key).alias("low")).coalesce(1).write.mode("overwrite").parquet(f"{path}/borders/{night}")


def _borders(spark: SparkSession, path: str, night: int) -> list[tuple[int, object]]:
    """(bucket, smallest key) in key order: a row per bucket, whatever the rows. A bucket with a null key only comes first."""
    if not finished(spark, f"{path}/borders/{night}"):
        raise ValueError(f"night {night} of {path} has not been applied")
    return [tuple(r) for r in spark.read.parquet(f"{path}/borders/{night}").select(BUCKET, "low").orderBy(F.col("low").asc_nulls_first()).collect()]


def _bucket_of(key: Column, borders: list[tuple[int, object]]) -> Column:
    """The last bucket that begins at or before the key, else the first. Borders are passed over in strides, then one by one."""
    if not borders:
        return F.lit(0)
    lows = [low for _, low in borders[1:]]
    if not lows:
        return F.lit(borders[0][0])
    stride = isqrt(len(lows)) + 1
    passed = F.size(F.filter(F.array(*map(F.lit, lows[stride - 1::stride] or [None])), lambda low: low <= key)) * stride
    place = passed + F.size(F.filter(F.slice(F.array(*map(F.lit, lows)), passed + 1, F.lit(stride)), lambda low: low <= key))
    return F.element_at(F.array(*[F.lit(b) for b, _ in borders]), place + 1)


def _by_bucket(rows: DataFrame) -> DataFrame:
    """Few files per bucket; a large bucket still goes to several tasks."""
    return rows.hint("rebalance", BUCKET)


def _split(merged: DataFrame, key: str, largest: int, last: int) -> DataFrame:
    """Buckets of more than `largest` rows cut into key ranges of about half that; the first range keeps the bucket's number."""
    over = {r[0]: r[1] for r in merged.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > largest).collect()}
    if not over:
        return _by_bucket(merged)
    parts = sum(-(-2 * rows // largest) for rows in over.values())
    ranged = merged.where(F.col(BUCKET).isin(list(over))).repartitionByRange(parts, BUCKET, F.col(key).asc_nulls_first())
    ranged = stored(ranged.withColumn("_part", F.spark_partition_id()), "split")
    cuts = [tuple(r) for r in ranged.select(BUCKET, "_part").distinct().orderBy(BUCKET, "_part").collect()]  # at most parts + buckets
    firsts = {bucket: part for bucket, part in reversed(cuts)}
    numbers = {}
    for bucket, part in cuts:
        if firsts[bucket] == part:
            numbers[bucket, part] = bucket
        else:
            last += 1
            numbers[bucket, part] = last
    table = merged.sparkSession.createDataFrame([(b, p, n) for (b, p), n in numbers.items()], f"{BUCKET} int, _part int, _number int")
    cut = ranged.join(F.broadcast(table), [BUCKET, "_part"]).withColumn(BUCKET, F.col("_number")).drop("_part", "_number")
    return _by_bucket(merged.where(~F.col(BUCKET).isin(list(over))).unionByName(cut))
