"""Ingestion queries: the raw tables are written out as files and messages, then read back as streams.

Folders live under the shared folder, one fresh folder per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.operators import nightly, quality, reports, silver
from keepwell.plans.registry import query
from keepwell.session import removed, scratch_path, wide_writes
from keepwell.sources import files, jdbc
from keepwell.sources.schemas import DUAL, FILES_ONLY, HISTORY, TOPICS
from keepwell.streaming import alerts, evolving, ingest, once_alerts


def _plain(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def _as_csv(df: DataFrame, folder: str) -> str:
    with wide_writes(df.sparkSession):
        df.write.options(header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(folder)
    return folder


def _as_messages(df: DataFrame, topic: str, folder: str) -> str:
    """One JSON object per line, as the event producers send them."""
    with wide_writes(df.sparkSession):
        df.select(F.to_json(F.struct(*TOPICS[topic].fieldNames())).alias("value")).write.text(folder)
    return folder


def _file_only(lake, name: str) -> DataFrame:
    base = scratch_path(lake.spark, f"land_{name}")
    folder = _as_csv(_plain(lake.raw(name)), f"{base}/in")
    options = files.MULTILINE if name == "reviews" else files.CSV
    schema = files.all_text(files.read_csv(lake.spark, folder, options=options).schema)
    return ingest.ingest(ingest.file_stream(lake.spark, folder, schema, options=options), f"{base}/table", f"{base}/checkpoint")


def _traced(df: DataFrame) -> DataFrame:
    """Lineage as facts that do not change from run to run."""
    return df.withColumns({"has_file": F.col("_source_file").isNotNull(), "has_time": F.col("_ingested_at").isNotNull()}).drop("_source_file", "_ingested_at")


for _name in FILES_ONLY:
    query(f"ingest_{_name}")(lambda lake, n=_name: _traced(_file_only(lake, n)))


def _landed(lake, name: str) -> tuple[str, str, str]:
    base, raw = scratch_path(lake.spark, f"land_{name}"), lake.raw(name)
    history = _as_csv(raw.where("_source = 'history_files'").select(*HISTORY[name].fieldNames()), f"{base}/history")
    messages = _as_messages(raw.where("_source = 'live_events'"), name, f"{base}/live")
    return base, history, messages


def _dual(lake, name: str) -> DataFrame:
    base, history, messages = _landed(lake, name)
    both = ingest.dual_source(lake.spark, name, history, ingest.json_lines(lake.spark, messages))
    return ingest.ingest(both, f"{base}/table", f"{base}/checkpoint")


for _name in DUAL:
    query(f"ingest_{_name}")(lambda lake, n=_name: _traced(_dual(lake, n)))


@query("ingest_topic_counts")
def _topics(lake):
    """Bounded batch reads of every topic."""
    return ingest.topic_counts({n: ingest.json_lines(lake.spark, _landed(lake, n)[2], streaming=False) for n in DUAL})


@query("ingest_inferred_types")
def _inferred(lake):
    """Types pinned from the files, as one row per column."""
    base = scratch_path(lake.spark, "land_types")
    folder = _as_csv(_plain(lake.raw("commissions")), base)
    schema = files.pinned_schema(lake.spark, folder)
    rows = files.read_csv(lake.spark, folder, schema)
    entries = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("type"),
                                 F.col(f.name).alias("filled")) for f in schema])
    return rows.agg(*[F.count(f.name).alias(f.name) for f in schema]).select(F.inline(entries))


@query("ingest_schema_evolution")
def _evolution(lake):
    """A later delivery brings two new columns; earlier rows have them empty."""
    base, raw = scratch_path(lake.spark, "land_evolving"), _plain(lake.raw("refunds"))
    first = _as_csv(raw.where("status = 'pending'").drop("reason", "processed_date"), f"{base}/first")
    second = _as_csv(raw.where("status <> 'pending'"), f"{base}/second")
    return files.read_evolving(lake.spark, [first, second])


def _evolving(lake, name: str) -> tuple[DataFrame, str]:
    """Two deliveries of a feed: the first lacks its last column, the second has all of them in reverse order. (rows, path)"""
    base, raw = scratch_path(lake.spark, f"land_evolving_{name}"), lake.unwritten(name)
    raw = raw.where("_source = 'history_files'").select(*HISTORY[name].fieldNames()) if name in HISTORY else _plain(raw)
    key = raw.columns[0]
    early = F.coalesce(F.substring(F.md5(F.col(key).cast("string")), 1, 1) < "8", F.lit(False))
    _as_csv(raw.where(early).drop(raw.columns[-1]), f"{base}/in/first")
    _as_csv(raw.where(~early).select(*reversed(raw.columns)), f"{base}/in/second")
    options = files.MULTILINE if name == "reviews" else files.CSV
    return evolving.ingest_evolving(lake.spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint", options, keep_staged=False), f"{base}/table"


for _name in (*FILES_ONLY, *DUAL):
    query(f"ingest_evolving_{_name}")(lambda lake, n=_name: _traced(_evolving(lake, n)[0]))


@query("ingest_column_types")
def _column_types(lake):
    """The types of every column of every feed, joined over its deliveries. A feed is landed whole; of what this query has written
    for it, only the kinds are read afterwards, so the rest goes before the next feed."""
    parts = []
    for name in (*FILES_ONLY, *DUAL):
        path = _evolving(lake, name)[1]
        for folder in (path, f"{path}-staged", f"{path}-headers", f"{path.removesuffix('/table')}/in", f"{path.removesuffix('/table')}/checkpoint"):
            removed(lake.spark, folder)
        parts.append(evolving.types(lake.spark, path).select(F.lit(name).alias("table_name"), "column_name", "type", "filled"))
    return files.stacked(parts)


@query("ingest_typed_payments")
def _typed(lake):
    """A delivery of whole amounts, then one with fractions: the column widens. The date is held at its type, other layouts are rescued."""
    base, raw = scratch_path(lake.spark, "land_typed"), lake.raw("payments").where("_source = 'history_files'").select(*HISTORY["payments"].fieldNames())
    whole = F.coalesce(F.col("payment_amount").cast("string").rlike("^[0-9]+([.]0*)?$"), F.lit(True))
    _as_csv(raw.where(whole).withColumn("payment_amount", F.regexp_replace(F.col("payment_amount").cast("string"), "[.]0*$", "")), f"{base}/in/first")
    evolving.ingest_evolving(lake.spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint")
    _as_csv(raw.where(~whole), f"{base}/in/second")
    evolving.ingest_evolving(lake.spark, f"{base}/in", f"{base}/table", f"{base}/checkpoint")
    rows = evolving.typed(lake.spark, f"{base}/table", {"payment_date": "date"})
    return _traced(rows.withColumn("other_date", F.col(evolving.RESCUED)["payment_date"]).drop(evolving.RESCUED))


def _cut_messages(lake, topic: str) -> str:
    """The messages of a topic, one in sixteen cut short."""
    schema = TOPICS[topic]
    sent = F.to_json(F.struct(*schema.fieldNames()), {"ignoreNullFields": "false"})
    cut = F.coalesce(F.substring(F.md5(F.col(schema.fieldNames()[0])), 1, 1) == "0", F.lit(False))
    value = F.when(cut, F.substr(sent, F.lit(1), F.length(sent) - 1)).otherwise(sent)
    base = scratch_path(lake.spark, f"land_cut_{topic}")
    lake.raw(topic).where("_source = 'live_events'").select(value.alias("value")).write.text(f"{base}/live")
    return base


@query("ingest_corrupt_messages")
def _corrupt(lake):
    """How many messages the stream landed as rows and how many aside."""
    parts = []
    for topic in TOPICS:
        base = _cut_messages(lake, topic)
        arriving = ingest.received(ingest.json_lines(lake.spark, f"{base}/live"), topic)
        table = ingest.ingest(arriving, f"{base}/table", f"{base}/checkpoint")
        for kind, rows in (("rows", table), ("corrupt", ingest.set_aside(lake.spark, f"{base}/table", topic))):
            parts.append(rows.agg(F.count(F.lit(1)).alias("messages")).select(F.lit(topic).alias("topic"), F.lit(kind).alias("kind"), "messages"))
    return files.stacked(parts)


@query("ingest_rule_counts")
def _rule_counts(lake):
    """Rules on arriving messages, counted batch by batch while the stream writes them."""
    parts = []
    for topic in TOPICS:
        base = _cut_messages(lake, topic)
        arriving = ingest.received(ingest.json_lines(lake.spark, f"{base}/live", files_per_trigger=3), topic)
        rules = [quality.drop("readable", f"not {ingest.ASIDE}"), quality.warn("has_customer", "customer_id is not null")]
        kept, counts = ingest.ingest_checked(arriving, rules, topic, f"{base}/table", f"{base}/checkpoint")
        parts.append(counts.join(kept.agg(F.count(F.lit(1)).alias("rows_kept"))))
    return files.stacked(parts)


query("ingest_master_counts")(lambda lake: files.row_counts({t: jdbc.stamped(lake.raw(t)) for t in jdbc.MASTERS}))


@query("ingest_incremental_append")
def _append(lake):
    """Two scoring runs appended, each into a fresh folder."""
    base, orders = scratch_path(lake.spark, "append"), lake.table("payments").select("payment_id", "payment_amount", "payment_date")
    first = files.append_scored(None, orders.where("payment_date < date '2023-01-01'"), f"{base}/1")
    return files.append_scored(first, orders.where("payment_date >= date '2023-01-01' or payment_date is null"), f"{base}/2")


def _nights(lake, name: str, key: str) -> DataFrame:
    """The raw rows arrive in three nights by load time; rows without one, and a fourth of the second night once more, in the last."""
    raw, path = lake.raw(name), scratch_path(lake.spark, f"nights_{name}")
    loaded, again = F.col("_ingested_at"), F.coalesce(F.substring(F.md5(key), 1, 1) < "4", F.lit(False))
    first, second = loaded < "2023-01-01", (loaded >= "2023-01-01") & (loaded < "2024-01-01")
    table = nightly.start(silver.BUILDERS[name](raw.where(first)), key, path, 32)
    for number, night in enumerate((second, ~F.coalesce(first | second, F.lit(False)) | (second & again)), 1):
        table = nightly.apply(silver.BUILDERS[name](raw.where(night)), key, path, number)
    return table


for _name, _key in (("orders", "order_id"), ("payments", "payment_id"), ("shipments", "shipment_id"), ("refunds", "refund_id")):
    query(f"ingest_nightly_{_name}")(lambda lake, n=_name, k=_key: _nights(lake, n, k))


def _alerting(lake) -> tuple[str, DataFrame]:
    """Reviews arriving as files against the customer tables."""
    base = scratch_path(lake.spark, "alerts")
    lake.table("reviews").write.parquet(f"{base}/in")
    arriving = lake.spark.readStream.schema(lake.table("reviews").schema).parquet(f"{base}/in")
    return base, alerts.alerts(arriving, lake.rule_predictions(), lake.rule_segments(), reports.offers(lake.rule_reranked()))


@query("report_alerts_streamed")
def _alerts(lake):
    base, found = _alerting(lake)
    return ingest.ingest(found, f"{base}/table", f"{base}/checkpoint")


def _alerts_once(lake, period: str) -> DataFrame:
    """One alert per customer and period; all reviews lie in one delivery, so none is late."""
    base, found = _alerting(lake)
    once_alerts.run(once_alerts.once(found, period), f"{base}/table", f"{base}/checkpoint")
    return lake.spark.read.schema(found.schema).parquet(f"{base}/table")


for _name in ("day", "quarter", "year"):
    query(f"report_alerts_once_a_{_name}")(lambda lake, p=_name: _alerts_once(lake, p))
