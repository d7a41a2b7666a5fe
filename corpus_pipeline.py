"""The corpus pipeline: five stages over `documents`, each a table that the next one reads.

Every stage works on all that its predecessor kept. The first four return the columns of `documents`; the last adds
`copy_no`. Nulls, empty texts and repeated rows pass as the operators define; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.llm import decontamination, minhash, mixing, suffixes, toxicity
from keepwell.session import stored


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity score of 0.5 or more. The model learns from the labelled documents among `docs`."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(toxicity.training_rows(docs.select("doc_id", "text"), labels))
    return toxicity.with_score(docs, model, score_col="_score").where("_score < 0.5").drop("_score")


def numbered_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs`, written with a number per row, and the name of that column: ids may be null or repeat, these may not."""
    number = "row_number"
    while number in docs.columns:
        number += "_"
    return stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered-documents"), number


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five-word shingles, similarity 0.8): the one with the smallest id.

    Rows are told by a number of their own: a row without an id is a document like any other, of rows that repeat an id and a
    text one stays, and rows that share an id but not a text are judged by their own texts. A row with an id stays before one without."""
    rows, number = numbered_rows(docs)
    found = minhash.near_duplicates(rows, words=5, threshold=0.8, id_col=number).select(F.col("id").alias(number), "component_id", "n_shingles")
    alone = F.when(F.col("doc_id").isNotNull(), F.concat_ws(":", F.lit("text"), "doc_id", F.md5("text"))).otherwise(F.concat_ws(":", F.lit("row"), number))
    group = F.when(F.col("n_shingles") > 0, F.concat_ws(":", F.lit("group"), "component_id")).otherwise(alone)  # no words: no near duplicate
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", number)).alias("first")
    kept = rows.select(number, "doc_id", "text").join(found, number).groupBy(group.alias("group")).agg(first).select(f"first.{number}")
    return rows.join(kept, number, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 or more words that an earlier document has; a document that was nothing else goes."""
    cut = suffixes.without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a ten-word window (or the whole, if shorter) of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    rows, number = numbered_rows(docs)
    found = decontamination.contamination(rows.select(number, "text"), benchmark, id_col=number)
    gone = found.where("n_hit > 0").select(F.col("id").alias(number))
    return rows.join(gone, number, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that sources come near their target words; `copy_no` counts a document's copies."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("minhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("mixing to target weights", mixing_sources),
]

#: The learned toxicity model can't be stated in SQL; tests hold each stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return docs
