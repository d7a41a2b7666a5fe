"""Registered queries of the operators: name -> (spark, directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.llm import chat, decontamination, embeddings, html_text, infill, minhash, mixing, negatives, suffixes, tokens, topk, toxicity, warc
from keepwell.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, threshold=0.8).withColumnRenamed("id", "doc_id")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit = 2048
    return tokens.token_prefixes(table(spark, sf_dir, "documents"), limits=(limit,), keep=False).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
        F.col("fits")[0].alias("chars_within_limit"))


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = spark.range(2).select(F.lit(-1).cast("long").alias("conversation"), F.col("id").alias("order"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = chat.turns_of_table(table(spark, sf_dir, "conversations")).unionByName(control)
    back = chat.read_back(chat.formatted(turns))
    listed = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(F.col("conversation").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(listed, ""), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                       F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.with_score(docs, model).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                                                   (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per passage: where it is, which documents it was matched with, and whether this document is the lowest that has it."""
    found = suffixes.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.explode("spans").alias("s")).select(
        "doc_id", F.col("s.start").alias("start_word"), F.col("s.end").alias("end_word"), F.col("s.byte_start").alias("start_byte"),
        F.col("s.byte_end").alias("end_byte"), F.col("s.others").alias("other_doc_ids"), F.col("s.first").alias("is_first"))


@query
def op8_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fire drill: archives all pages twice, the second time with some records damaged (the last character, 1 of 64) or left out
    (1 of 1024), both chosen by the id's md5, and returns what the audit finds."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    mark = F.md5(F.col("page_id").cast("string"))
    records = pages.select(mark.alias("mark"), warc.record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    struck = F.coalesce(F.col("mark").rlike("^0[0-3]"), F.lit(False))
    lost = F.coalesce(F.col("mark").rlike("^ff[0-3]"), F.lit(False))
    hurt = F.concat(F.substr("record", F.lit(1), F.length("record") - 1), F.lit("#"))
    first, second = scratch_path(spark, "warc-first"), scratch_path(spark, "warc-second")
    warc.write_warc(records, first)
    warc.write_warc(records.where(~lost).withColumn("record", F.when(struck, hurt).otherwise(F.col("record"))), second)
    found = warc.audit(warc.leaves(spark, first), warc.leaves(spark, second))
    return found.select(F.col("id").cast("long").alias("page_id"), "fault", F.col("length").alias("record_bytes"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.filled_in_middle(table(spark, sf_dir, "documents"))
    return cut.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), "id % 100 = 0", label)


@query
def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "id % 100 = 0").withColumnRenamed("id", "vec_id")
