"""Raw tables as append-only streams: history files and live topics into one table.

Every stream is stateless and runs with `availableNow`, so the same code serves a nightly batch and,
with another trigger, a continuous job. Checkpoint and sink sit side by side; a restart resumes
where the last committed batch ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from keepwell.operators.quality import BROKEN, QUARANTINED, Rule, RuleCounts, count_rows, observed
from keepwell.sources.files import CSV, lineage
from keepwell.sources.schemas import HISTORY, TOPICS

HISTORY_SOURCE, LIVE_SOURCE = "history_files", "live_events"
# topic reads start at the beginning; offsets that expired before they were read are an error
KAFKA = {"startingOffsets": "earliest", "failOnDataLoss": "true"}
FILES_PER_TRIGGER = 1000


def file_stream(spark: SparkSession, folder: str, schema: StructType, source: str | None = None,
                files_per_trigger: int = FILES_PER_TRIGGER, options: dict = CSV) -> DataFrame:
    """New CSV files of a folder with their lineage."""
    raw = (spark.readStream.schema(schema).options(**options).option("maxFilesPerTrigger", files_per_trigger)
           .option("recursiveFileLookup", "true").csv(folder))
    return lineage(raw, source)


def kafka_options(servers: str, topic: str, per_trigger: int | None = None, tolerate_loss: bool = False, **security: str) -> dict[str, str]:
    """Reader options of a topic; `security` holds further `kafka.` settings with underscores for dots. Without `per_trigger`
    a trigger takes all there is; `tolerate_loss` goes on after expired offsets, which then are missing."""
    out = {**KAFKA, "kafka.bootstrap.servers": servers, "subscribe": topic, "failOnDataLoss": str(not tolerate_loss).lower()}
    if per_trigger:
        out["maxOffsetsPerTrigger"] = str(per_trigger)
    out.update({"kafka." + k.replace("_", "."): v for k, v in security.items()})
    return out


def bounded(options: dict[str, str]) -> dict[str, str]:
    """The same topic as one finite read, for inspection."""
    return {**{k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}, "endingOffsets": "latest"}


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def json_lines(spark: SparkSession, folder: str, streaming: bool = True, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """A folder of JSON lines shaped like a topic: one `value` column."""
    schema = StructType([StructField("value", StringType())])
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger) if streaming else spark.read
    return reader.text(folder).select(F.col("value").cast("binary").alias("value"))


CORRUPT, ASIDE = "_corrupt_record", "is_corrupt"


def _opened(messages: DataFrame, topic: str) -> DataFrame:
    """(value, data): the message's text and its fields, with the text again in CORRUPT where it is no JSON object."""
    schema = StructType([*TOPICS[topic].fields, StructField(CORRUPT, StringType())])
    text = F.col("value").cast("string")
    read = messages.select(text.alias("value"), F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("data"))
    return read.withColumn("broken", F.col("data").isNull() | F.col(f"data.{CORRUPT}").isNotNull())


def decode(messages: DataFrame, topic: str) -> DataFrame:
    """Binary messages -> typed columns of the topic -> lineage. Messages that are no JSON object are not rows of the
    topic; `corrupt` has them."""
    fields = _opened(messages, topic).where("not broken").select("data.*").drop(CORRUPT)
    return lineage(fields, LIVE_SOURCE, "topic")


def corrupt(messages: DataFrame, topic: str) -> DataFrame:
    """The messages that `decode` can't read, as they came: the side table to write beside the topic's own."""
    broken = _opened(messages, topic).where("broken").select(F.lit(topic).alias("topic"), F.col("value").alias(CORRUPT))
    return lineage(broken, LIVE_SOURCE, "topic")


def received(messages: DataFrame, topic: str) -> DataFrame:
    """Every message of a topic: the rows of `decode`, and those of `corrupt` marked ASIDE, with their text only."""
    opened = _opened(messages, topic)
    fields = [F.when(~F.col("broken"), F.col("data")[c]).alias(c) for c in TOPICS[topic].fieldNames()]
    return lineage(opened.select(*fields, F.when(F.col("broken"), F.col("value")).alias(CORRUPT), F.col("broken").alias(ASIDE)), LIVE_SOURCE, "topic")


def dual_source(spark: SparkSession, table: str, history_folder: str, messages: DataFrame) -> DataFrame:
    """History files and live messages of one table; columns only one side has are null on the other. Messages that can't be read
    are marked ASIDE."""
    history = file_stream(spark, history_folder, HISTORY[table], HISTORY_SOURCE).withColumn(ASIDE, F.lit(False))
    return history.unionByName(received(messages, table), allowMissingColumns=True)


def append(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rows marked ASIDE or QUARANTINED go to a partition of their own by the same commit, so none is lost when the checkpoint moves on."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    marks = [c for c in (QUARANTINED, ASIDE) if c in df.columns]
    return (writer.partitionBy(*marks) if marks else writer).outputMode("append").trigger(availableNow=True).start()


def ingest_checked(df: DataFrame, rules: list[Rule], name: str, path: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """Append everything that is new, with the rules each row breaks; rows that break a dropping rule stay in the table, quarantined.

    Returns the kept rows of the whole table and a row per rule with the counts of this run, as the stream told them."""
    spark, told = df.sparkSession, RuleCounts()
    rows = observed(df, rules, name)
    spark.streams.addListener(told)
    try:
        query = append(rows, path, checkpoint)
        query.awaitTermination()
        told.settled(query, name)
    finally:
        spark.streams.removeListener(told)
    nothing = {"rows_in": 0, "rows_quarantined": 0, **{f"v{i}": 0 for i in range(len(rules))}}
    kept = spark.read.schema(rows.schema).parquet(path).where(~F.col(QUARANTINED)).drop(BROKEN, QUARANTINED)
    return kept, count_rows(spark, name, rules, told.total(name) or nothing)


def ingest(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append everything that is new and read the table, without rows marked ASIDE: `set_aside` reads those."""
    append(df, path, checkpoint).awaitTermination()
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return table.where(~F.col(ASIDE)).select([c for c in df.columns if c not in (ASIDE, CORRUPT)]) if ASIDE in df.columns else table


def set_aside(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Side table of an ingested topic: the messages that could not be read, as they came, with their lineage."""
    kinds = f"{CORRUPT} string, _ingested_at timestamp, _source_file string, _source string, {ASIDE} boolean"
    return spark.read.schema(kinds).parquet(path).where(ASIDE).drop(ASIDE).select(F.lit(topic).alias("topic"), "*")


def topic_counts(topics: dict[str, DataFrame]) -> DataFrame:
    """Rows per topic of binary messages; a topic with messages that can't be read has their count on a line of its own."""
    from keepwell.sources.files import row_counts
    rows = row_counts({n: decode(m, n) for n, m in topics.items()})
    return rows.unionByName(row_counts({f"{n}_corrupt": corrupt(m, n) for n, m in topics.items()}).where("rows > 0")).orderBy("table_name")
