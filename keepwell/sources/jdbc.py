"""Snapshots of master tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASTERS = ("customers", "products", "sellers", "brands", "categories", "warehouses")
SOURCE = "jdbc_snapshot"


def options(url: str, table: str, *, driver: str | None = None, user: str | None = None, password: str | None = None,
            split_on: str | None = None, bounds: tuple | None = None, partitions: int = 8, fetch: int = 10_000) -> dict[str, str]:
    """Reader options. With `split_on` and `bounds` the table is read by several tasks, not one."""
    out = {"url": url, "dbtable": table, "fetchsize": str(fetch)}
    out.update({k: v for k, v in (("driver", driver), ("user", user), ("password", password)) if v})
    if split_on:
        if bounds is None:
            raise ValueError("bounds are needed to split a read; get them with `extent`")
        out.update(partitionColumn=split_on, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions))
    return out


def subquery(sql: str, alias: str = "t") -> str:
    """A query the database runs itself: counts, top n, catalogue listings."""
    return f"({sql.strip().rstrip(';')}) {alias}"


def read(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**options(url, table, **kwargs)).load()


def extent(spark: SparkSession, url: str, table: str, column: str, **kwargs) -> tuple:
    """Smallest and largest split value, computed by the database."""
    row = read(spark, url, subquery(f"select min({column}) as lo, max({column}) as hi from {table}"), **kwargs).first()
    return row[0], row[1]


def stamped(df: DataFrame, source: str = SOURCE) -> DataFrame:
    """Lower-case names, load time and source of a snapshot."""
    return df.toDF(*[c.lower() for c in df.columns]).withColumns({"_ingested_at": F.current_timestamp(), "_source": F.lit(source)})


def snapshot(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return stamped(read(spark, url, table, **kwargs))
