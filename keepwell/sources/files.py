"""File sources and table sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from keepwell.operators.profiling import stacked

# a header that differs from the schema is an error, not a shift of columns; streaming.evolving reads deliveries whose headers differ
CSV = {"header": "true", "escape": '"', "enforceSchema": "false"}
# text with line breaks: such files cannot be split, so it is asked for only where needed
MULTILINE = {**CSV, "multiLine": "true"}
# layouts a value must match to be inferred as a date or time; '2024-05' stays text
INFER = {"inferSchema": "true", "dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}


def lineage(df: DataFrame, source: str | None = None, file: Column | str | None = None) -> DataFrame:
    """Where a row came from and when it was read."""
    origin = F.col("_metadata.file_path") if file is None else F.lit(file) if isinstance(file, str) else file
    tagged = df.withColumns({"_ingested_at": F.current_timestamp(), "_source_file": origin})
    return tagged.withColumn("_source", F.lit(source)) if source else tagged


def read_csv(spark: SparkSession, folder: str, schema: StructType | None = None, options: dict = CSV) -> DataFrame:
    """A header CSV folder or file; all text unless a schema is given."""
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema else reader).csv(folder)


def pinned_schema(spark: SparkSession, folder: str) -> StructType:
    """Column types inferred once from the files at hand, to be fixed for the stream."""
    return spark.read.options(**CSV, **INFER).csv(folder).schema


def all_text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in schema])


def merged_schema(spark: SparkSession, folders: list[str]) -> StructType:
    """Union of the headers of several deliveries, first seen first: the schema after columns were added."""
    fields: dict[str, StructField] = {}
    for folder in folders:
        for f in spark.read.options(**CSV).csv(folder).schema:
            fields.setdefault(f.name, StructField(f.name, StringType()))
    return StructType(list(fields.values()))


def read_evolving(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Deliveries with differing headers as one table; columns a delivery lacks are null."""
    out = None
    for folder in folders:
        part = read_csv(spark, folder)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Full refresh: data and schema. `df` must not read from `path`."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.parquet(path)


def append_scored(old: DataFrame | None, new: DataFrame, path: str) -> DataFrame:
    """Earlier rows plus new ones in a fresh folder. The caller switches readers to it, so nothing
    is overwritten while it is being read."""
    both = new if old is None else old.unionByName(new, allowMissingColumns=True)
    both.write.mode("errorifexists").parquet(path)
    return new.sparkSession.read.parquet(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Audit: rows per table, one scan each, ordered by name."""
    return stacked([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
                    for n, df in tables.items()]).orderBy("table_name")
