"""File feeds whose header changes: columns added, dropped or reordered by later deliveries, and types that widen.

Spark maps CSV columns by position when a schema is given, so a stream with one schema would shift values. Here the stream reads
cells by position, once, into a staged table. The header of a file is its first row there; rows meet the header of their own file
and become columns by name, so a column that a delivery lacks is null and a new one is added. What has no name of its own (cells
beyond the header, repeated names) is kept in the map `_rescued` under its position. A batch writes its own folders, so a repeated
batch replaces itself. What reaches the driver are the distinct column names of a batch.

Values stay the text that arrived. Their types are a stored relation: for each batch and column the kinds of values met, as bits.
Kinds of several deliveries are joined by `bit_or`, so the order of deliveries and a repeated one change nothing:
int < long < double < text and date < timestamp < text; number and date are text together, and so are numbers with leading zeros
or of 19 digits and more. `typed` reads the table with the types joined so far; a column may be held at a type, whose misfits then
go to `_rescued`. An empty cell is null and of no kind; a column without any value is text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from keepwell.session import removed, wide_writes
from keepwell.sources.files import CSV, lineage
from keepwell.streaming.ingest import FILES_PER_TRIGGER

#: cells of the widest row that is read unless told otherwise; one that fills the last of them is an error, never cut
WIDEST = 64
RESCUED = "_rescued"
#: kinds of values: bit -> type; a value is of the first kind that it fits
KINDS = {1: "int", 2: "bigint", 4: "double", 8: "date", 16: "timestamp", 32: "string"}
NUMBERS, TIMES, TEXT = 1 | 2 | 4, 8 | 16, 32
#: kinds that a type holds without a loss
HOLDS = {"int": 1, "bigint": 1 | 2, "double": NUMBERS, "date": 8, "timestamp": TIMES, "string": 63}


def _cells(spark: SparkSession, folder: str, options: dict, files_per_trigger: int, widest: int) -> DataFrame:
    """A stream of (file, block, cells, filled): every row of every new file, header rows too, and the place of its last cell."""
    # one place more than is read: where fewer columns are asked for than declared, the parser hands over just those, null where a
    # row is shorter; a row shorter than all that is declared would go through the exceptions of a malformed record
    places = StructType([StructField(f"c{i}", StringType()) for i in range(widest + 1)])
    plain = {k: v for k, v in options.items() if k not in ("header", "enforceSchema")}
    rows = (spark.readStream.schema(places).options(**plain).option("maxFilesPerTrigger", files_per_trigger)
            .option("recursiveFileLookup", "true").csv(folder))
    filled = F.coalesce(*[F.when(F.col(f"c{i}").isNotNull(), i + 1) for i in reversed(range(widest))], F.lit(0))
    last = F.col(f"c{widest - 1}")
    whole = F.when(last.isNotNull(), F.raise_error(F.lit(f"a row has {widest} cells or more"))).otherwise(F.slice(F.array(*places.fieldNames()[:widest]), F.lit(1), filled))
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), whole.alias("cells"),
                       filled.alias("filled"))


def headers(staged: DataFrame) -> DataFrame:
    """(file, names, line): the first row of each file. Only the split at a file's start can hold it."""
    lines = staged.where("block = 0").groupBy("file").agg(F.min("line").alias("first"))
    first = staged.drop("file").join(F.broadcast(lines), F.col("line") == F.col("first"))  # a row per file of the batch
    width = F.array_max(F.transform("cells", lambda x, i: F.when(x.isNotNull(), i + 1)))
    return first.select("file", F.transform(F.slice("cells", F.lit(1), width), lambda x: F.ltrim(x, F.lit("﻿"))).alias("names"), "first")


def by_name(staged: DataFrame, found: DataFrame, source: str | None = None) -> DataFrame:
    """Staged cells as columns by name, with lineage and `_rescued`. `found` has a row per file of the batch, at most as many as a
    trigger takes.

    Where a name stands is settled once per file. Cells are gone through one by one only where some may have no name: in rows that
    are wider than their header, and below headers with a repeated or missing name."""
    names = sorted(r[0] for r in found.select(F.explode("names")).distinct().collect() if r[0] is not None)
    places = F.array(*[F.array_position("names", F.lit(n)).cast("int") - 1 for n in names])
    unsure = F.coalesce(F.size(F.array_distinct(F.array_compact("names"))) < F.size("names"), F.lit(True))
    rows = staged.join(F.broadcast(found.withColumns({"places": places, "unsure": unsure})), "file").where("block > 0 or line > first")
    values = [F.get("cells", F.get("places", F.lit(i))).alias(n) for i, n in enumerate(names)]
    placed = F.transform("cells", lambda x, i: F.struct(F.concat(F.lit("#"), (i + 1).cast("string")).alias("key"), x.alias("value"), i.alias("i")))
    loose = F.filter(placed, lambda e: e["value"].isNotNull() & ~F.array_position("names", F.get("names", e["i"])).eqNullSafe(e["i"] + 1))
    rescued = F.when(F.col("unsure") | (F.col("filled") > F.size("names")), F.map_from_entries(F.transform(loose, lambda e: F.struct(e["key"], e["value"]))))
    kept = rows.select(*values, F.when(F.size(rescued) > 0, rescued).alias(RESCUED), F.col("file").alias("_file"))
    return lineage(kept, source, F.col("_file")).drop("_file")


def kind(value: Column) -> Column:
    """The bit of a value's kind, null for an empty one."""
    first = F.ascii(value)  # all kinds but text begin with a digit or a minus
    number = value.rlike(r"^-?(0|[1-9][0-9]{0,17})$")
    long = F.when(number, value.try_cast("bigint"))
    return (F.when(value.isNull(), None)
            .when(~(first.between(48, 57) | (first == 45)), 32)
            .when(number, F.when(long.between(-2**31, 2**31 - 1), 1).otherwise(2))
            .when(value.rlike(r"^-?(0|[1-9][0-9]*)(\.[0-9]+([eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+)$"), 4)
            .when(value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & value.try_cast("date").isNotNull(), 8)
            .when(value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$") & value.try_cast("timestamp").isNotNull(), 16)
            .otherwise(32))


def _columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (RESCUED, "_ingested_at", "_source_file", "_source", "batch")]


def kinds_of(rows: DataFrame) -> DataFrame:
    """(column_name, kinds, filled) of text columns, in one scan."""
    names = _columns(rows)
    # positions for aliases, so that no column name can clash or needs quoting
    cells = rows.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    one = cells.agg(*[F.struct(F.bit_or(kind(F.col(f"c{i}"))).alias("kinds"), F.count(f"c{i}").alias("filled")).alias(f"s{i}") for i in range(len(names))])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}.kinds").alias("kinds"), F.col(f"s{i}.filled").alias("filled")) for i, c in enumerate(names)]
    return one.select(F.inline(F.array(*entries)))


def joined_type(kinds: Column) -> Column:
    """The least type that holds all kinds met."""
    mixed = ((kinds.bitwiseAND(NUMBERS) != 0) & (kinds.bitwiseAND(TIMES) != 0)) | (kinds.bitwiseAND(TEXT) != 0) | kinds.isNull() | (kinds == 0)
    widest = reduce(lambda out, bit: F.when(kinds.bitwiseAND(bit) != 0, F.lit(KINDS[bit])).otherwise(out), sorted(KINDS), F.lit("string"))
    return F.when(mixed, F.lit("string")).otherwise(widest)


def types(spark: SparkSession, path: str) -> DataFrame:
    """(column_name, type, filled) over all batches of a table."""
    met = spark.read.parquet(f"{path}-types").groupBy("column_name").agg(F.bit_or("kinds").alias("kinds"), F.sum("filled").alias("filled"))
    return met.select("column_name", joined_type(F.col("kinds")).alias("type"), "filled")


def _land(batch: DataFrame, number: int, path: str, source: str | None, keep_staged: bool) -> None:
    spark = batch.sparkSession
    staged = f"{path}-staged/batch={number}"
    with wide_writes(spark):
        batch.withColumn("line", F.monotonically_increasing_id()).write.mode("overwrite").parquet(staged)
        cells = spark.read.parquet(staged)
        if not cells.isEmpty():
            headers(cells).write.mode("overwrite").parquet(f"{path}-headers/batch={number}")
            by_name(cells, spark.read.parquet(f"{path}-headers/batch={number}"), source).write.mode("overwrite").parquet(f"{path}/batch={number}")
            kinds_of(spark.read.parquet(f"{path}/batch={number}")).write.mode("overwrite").parquet(f"{path}-types/batch={number}")
    if not keep_staged:
        removed(spark, staged)


def ingest_evolving(spark: SparkSession, folder: str, path: str, checkpoint: str, options: dict = CSV, source: str | None = None,
                    files_per_trigger: int = FILES_PER_TRIGGER, widest: int = WIDEST, keep_staged: bool = True) -> DataFrame:
    """Append every new file of `folder`, whatever its header, and read the table with all columns seen so far, as text.

    The staged copy of a batch is read while the batch lands only; a batch that is repeated stages its files anew. Without
    `keep_staged` it goes when its batch has landed, and no more than one batch is staged at a time."""
    (_cells(spark, folder, options, files_per_trigger, widest).writeStream.foreachBatch(
        lambda batch, number: _land(batch, number, path, source, keep_staged))
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    return spark.read.option("mergeSchema", "true").parquet(path).drop("batch", RESCUED)


def typed(spark: SparkSession, path: str, held: dict[str, str] | None = None) -> DataFrame:
    """The table with the types joined over all deliveries. Columns of `held` stay at the type named there; the text of
    values that don't fit it is in `_rescued` under the column's name."""
    rows = spark.read.option("mergeSchema", "true").parquet(path).drop("batch")
    now = {r.column_name: r.type for r in types(spark, path).collect()} | (held or {})  # a row per column
    fits = {c: F.col(f"`{c}`").isNull() | (kind(F.col(f"`{c}`")).bitwiseAND(HOLDS[t]) != 0) for c, t in (held or {}).items()}
    misfits = [F.when(~fit, F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").alias("value"))) for c, fit in fits.items()]
    none = F.array().cast("array<struct<key:string,value:string>>")
    loose = F.concat(F.coalesce(F.map_entries(RESCUED), none), F.array_compact(F.array(*misfits)) if misfits else none)
    rescued = F.when(F.size(loose) > 0, F.map_from_entries(loose)).alias(RESCUED)
    values = {c: F.when(fits.get(c, F.lit(True)), F.col(f"`{c}`").try_cast(now[c])).alias(c) for c in _columns(rows)}
    return rows.select(*[rescued if c == RESCUED else values.get(c, F.col(f"`{c}`")) for c in rows.columns])
