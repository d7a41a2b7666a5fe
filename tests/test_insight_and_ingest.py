import json

import pytest
from pyspark.sql import functions as F

from keepwell.operators import insight
from keepwell.plans import ingest_queries  # noqa: F401
from keepwell.plans.registry import QUERIES
from keepwell.session import scratch_path, shared_folder
from keepwell.sources import files, jdbc
from keepwell.sources.schemas import HISTORY, TOPICS
from keepwell.streaming import ingest

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("text, sentiment, issues", [
    ("Great quality, I LOVE it.", "positive", []), ("It arrived broken and late.", "negative", ["slow delivery", "damaged product"]),
    ("It is okay.", "neutral", []), ("Good idea, bad service", "neutral", []), ("goodness lately", "neutral", [])])
def test_lexicon(spark, text, sentiment, issues):
    reply = json.loads(spark.createDataFrame([(text,)], "t string").select(insight.lexicon_scorer(F.col("t"))).first()[0])
    assert (reply["sentiment"], reply["issues"]) == (sentiment, issues) and 0.5 <= reply["score"] <= 1.0


def test_batch_scorer_sees_whole_texts(spark):
    def client(prompts):
        return [json.dumps({"sentiment": "positive", "score": 1.0, "issues": [str(len(p))]}) for p in prompts]
    long = "x" * 50_000
    df = spark.createDataFrame([(long,)], "review_text string")
    out = insight.parsed(insight.score(df, insight.batch_scorer(client))).first()
    assert out["sentiment"] == "positive" and int(json.loads(out["issues"])[0]) == len(insight.prompt(long))


def test_malformed_replies_are_kept_as_failures(spark):
    df = spark.createDataFrame([("{\"sentiment\":\"pos",), ("no json",), ("{\"sentiment\":\"negative\",\"score\":\"high\",\"issues\":[]}",)], "sentiment_raw string")
    rows = insight.parsed(df).collect()
    assert [r["sentiment"] for r in rows] == [None, None, "negative"] and rows[2]["sentiment_score"] is None
    assert tuple(insight.parse_failures(insight.parsed(df)).first()) == (1, 2)


def test_blank_and_null_texts_are_not_scored(spark):
    df = spark.createDataFrame([("a", "fine", False), ("b", "  ", False), ("c", "null", False), ("d", None, False), ("e", "fine", True)],
                               "review_id string, review_text string, _is_ghost_order boolean")
    assert [r["review_id"] for r in insight.scorable(df).collect()] == ["a"]


def test_incremental_scoring_conserves_reviews(lake):
    reviews = insight.scorable(lake.table("reviews"))
    scored = insight.labelled(insight.parsed(lake.scored_reviews()), lake.last_day())
    old = scored.where("review_date < date '2024-07-01'")
    new = insight.unscored(reviews, old)
    assert new.count() + old.count() == reviews.count() and insight.unscored(reviews, None).count() == reviews.count()
    table = lake.rule_insights()
    assert table.count() == scored.count()


def test_stream_equals_batch_and_restart_adds_nothing(spark, lake):
    base, history, messages = ingest_queries._landed(lake, "payments")
    both = ingest.dual_source(spark, "payments", history, ingest.json_lines(spark, messages))
    first = ingest.ingest(both, f"{base}/table", f"{base}/checkpoint").count()
    again = ingest.ingest(both, f"{base}/table", f"{base}/checkpoint").count()
    assert first == again == lake.raw("payments").count()
    # a new message arrives
    spark.createDataFrame([(json.dumps({"payment_id": "new"}),)], "value string").write.mode("append").text(messages)
    assert ingest.ingest(both, f"{base}/table", f"{base}/checkpoint").count() == first + 1


def test_topic_schemas_have_the_declared_fields():
    assert {k: len(v) for k, v in TOPICS.items()} == {"sessions": 8, "cart_events": 10, "campaign_responses": 7, "orders": 15, "payments": 8}


def test_kafka_and_jdbc_options():
    live = ingest.kafka_options("host:9093", "orders", sasl_mechanism="PLAIN")
    assert "maxOffsetsPerTrigger" not in live and live["failOnDataLoss"] == "true" and live["startingOffsets"] == "earliest" and live["kafka.sasl.mechanism"] == "PLAIN"
    limited = ingest.kafka_options("host:9093", "orders", per_trigger=500, tolerate_loss=True)
    assert limited["maxOffsetsPerTrigger"] == "500" and limited["failOnDataLoss"] == "false"
    assert ingest.bounded(live)["endingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in ingest.bounded(live)
    split = jdbc.options("jdbc:x", "products", split_on="id", bounds=(1, 9), partitions=4)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "9", "4")
    with pytest.raises(ValueError):
        jdbc.options("jdbc:x", "products", split_on="id")
    assert jdbc.subquery("select 1;") == "(select 1) t"


def test_snapshot_lineage(spark):
    row = jdbc.stamped(spark.createDataFrame([(1,)], "PRODUCT_ID int")).first().asDict()
    assert row["product_id"] == 1 and row["_source"] == "jdbc_snapshot" and row["_ingested_at"] is not None


def test_full_refresh_replaces_rows_and_columns(spark):
    path = scratch_path(spark, "refresh")
    files.replace_table(spark.range(5), path)
    assert files.replace_table(spark.range(2).selectExpr("id as other"), path).columns == ["other"]


def test_shared_folder_comes_from_the_session(spark):
    assert spark.conf.get("spark.checkpoint.dir", None) in (None, shared_folder(spark))


def test_alert_stream(spark):
    out = QUERIES["report_alerts_streamed"](spark, SMALL)
    assert {"review_id", "offers", "churn_probability"} <= set(out.columns)


def test_reordered_header_is_an_error_and_an_evolving_feed(spark):
    from keepwell.sources.schemas import text_schema
    from keepwell.streaming import evolving
    base = scratch_path(spark, "drift")
    spark.createDataFrame([("R1", "open")], "refund_id string, status string").write.option("header", True).csv(f"{base}/in/1")
    spark.createDataFrame([("R2", "damaged", "closed")], "refund_id string, reason string, status string").write.option("header", True).csv(f"{base}/in/2")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, f"{base}/in/2", text_schema("refund_id status")).collect()
    got = evolving.ingest_evolving(spark, f"{base}/in", f"{base}/out", f"{base}/check")
    assert {(r.refund_id, r.reason, r.status) for r in got.collect()} == {("R1", None, "open"), ("R2", "damaged", "closed")}
    spark.createDataFrame([("new", "x", "R3")], "extra string, status string, refund_id string").write.option("header", True).csv(f"{base}/in/3")
    got = evolving.ingest_evolving(spark, f"{base}/in", f"{base}/out", f"{base}/check")
    assert {(r.refund_id, r.status, r.extra) for r in got.collect()} == {("R1", "open", None), ("R2", "closed", None), ("R3", "x", "new")}


def test_corrupt_messages_are_kept_aside(spark):
    sent = spark.createDataFrame([(b'{"payment_id": "1"}',), (b'{"payment_id": ',), (b"",), (None,)], "value binary")
    assert [r.payment_id for r in ingest.decode(sent, "payments").collect()] == ["1"]
    assert ingest.corrupt(sent, "payments").count() == 3


def test_corrupt_messages_land_beside_the_table(spark):
    base, columns = scratch_path(spark, "aside"), HISTORY["payments"].fieldNames()
    spark.createDataFrame([tuple(["h1", *[None] * (len(columns) - 1)])], ", ".join(f"{c} string" for c in columns)).write.csv(f"{base}/history", header=True)
    broken = ['{"payment_id": ', '{"payment_id": "2", "order_id": "9"', "no json"]
    spark.createDataFrame([(v,) for v in ['{"payment_id": "1"}', *broken]], "value string").write.text(f"{base}/live")
    both = ingest.dual_source(spark, "payments", f"{base}/history", ingest.json_lines(spark, f"{base}/live"))
    for _ in range(2):  # a restart adds nothing
        table = ingest.ingest(both, f"{base}/table", f"{base}/checkpoint")
        aside = ingest.set_aside(spark, f"{base}/table", "payments").collect()
        assert {(r.payment_id, r._source) for r in table.collect()} == {("h1", "history_files"), ("1", "live_events")}
        assert not {"is_corrupt", "_corrupt_record"} & set(table.columns)
        assert sorted(r._corrupt_record for r in aside) == sorted(broken)
        assert all(r.topic == "payments" and r._ingested_at is not None and r._source == "live_events" for r in aside)
    counts = ingest.topic_counts({"payments": ingest.json_lines(spark, f"{base}/live", streaming=False)})
    assert {(r.table_name, r.rows) for r in counts.collect()} == {("payments", 1), ("payments_corrupt", 3)}
