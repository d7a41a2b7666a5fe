"""Rules counted while rows are written: kept, quarantined and stopped; the same from streams, across restarts."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from keepwell.operators import quality
from keepwell.operators.quality import drop, fail, warn
from keepwell.streaming import ingest

RULES = [drop("has_key", "k is not null"), warn("positive", "amount > 0"), drop("small", "amount < 100 or amount is null")]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([("a", 1.0, "2024-01-05"), (None, 2.0, "2031-01-01"), ("b", -1.0, "2024-03-01"), ("c", None, None), (None, 500.0, "2023-01-01"),
                                  ("d", 700.0, "2022-01-01")], "k string, amount double, day string").repartition(3)


def test_rows_are_kept_or_quarantined_and_counted_in_one_write(rows, tmp_path):
    done = quality.write_checked(rows, RULES, str(tmp_path / "t"), "t", ["day"])
    assert sorted(r.k for r in done.kept.collect()) == ["a", "b", "c"] and done.kept.columns == rows.columns
    assert sorted((r.k or "", tuple(r.broken_rules)) for r in done.quarantined.collect()) == [("", ("has_key",)), ("", ("has_key", "small")), ("d", ("small",))]
    assert {(r.rule, r.action): (r.rows_in, r.rows_quarantined, r.violations) for r in done.counts.collect()} == {
        ("has_key", "drop"): (6, 3, 2), ("positive", "warn"): (6, 3, 2), ("small", "drop"): (6, 3, 2)}
    assert [tuple(map(str, r)) for r in done.extents.collect()] == [("t", "day", "2024-01-05", "2024-03-01")]  # of kept rows
    told = quality.conservation({"t": done}).first()
    assert (told.rows_in, told.rows_kept, told.rows_quarantined, told.balanced) == (6, 3, 3, True)


def test_a_lost_row_is_seen(rows, tmp_path):
    done = quality.write_checked(rows, RULES, str(tmp_path / "t"), "t")
    fewer = quality.Checked(done.rows.where("k is null or k <> 'a'"), done.counts, done.extents)
    assert not quality.conservation({"t": fewer}).first().balanced


def test_a_failing_rule_stops_the_write_and_leaves_no_table(rows, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(quality.ExpectationFailed, match="t not written, violated: never_negative"):
        quality.write_checked(rows, [*RULES, fail("never_negative", "amount >= 0 or amount is null")], path, "t")
    assert not os.path.exists(f"{path}/counts")
    assert not any(name.endswith(".parquet") or name == "_SUCCESS" for _, _, names in os.walk(path) for name in names)
    sound = quality.write_checked(rows, [*RULES, fail("has_day_or_not", "true")], path, "t")
    assert sound.counts.where("rule = 'has_day_or_not'").first().violations == 0


def test_no_rules_and_no_rows(spark, rows, tmp_path):
    free = quality.write_checked(rows, [], str(tmp_path / "free"), "free")
    assert free.kept.count() == 6 and free.counts.count() == 0
    empty = quality.write_checked(rows.where("false"), RULES, str(tmp_path / "empty"), "empty", ["day"])
    assert empty.kept.count() == empty.quarantined.count() == 0
    assert {r.violations for r in empty.counts.collect()} == {0}
    assert empty.extents.first().first_day is None


def test_rules_with_equal_names_are_counted_apart(rows, tmp_path):
    done = quality.write_checked(rows, [warn("same", "amount > 0"), warn("same", "k is not null")], str(tmp_path / "t"), "t")
    assert [r.violations for r in done.counts.collect()] == [2, 2]


def _messages(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_streams_tell_counts_per_run_and_keep_broken_messages(spark, tmp_path):
    rules = [drop("readable", f"not {ingest.ASIDE}"), warn("has_customer", "customer_id is not null")]
    live = tmp_path / "live"
    for i in range(4):  # a batch each
        _messages(live, f"{i}.json", ['{"payment_id": "p%d", "customer_id": "c"}' % i, '{"payment_id": "q%d"}' % i, '{"payment_id": "cut'])

    def run():
        arriving = ingest.received(ingest.json_lines(spark, str(live), files_per_trigger=1), "payments")
        kept, counts = ingest.ingest_checked(arriving, rules, "payments", str(tmp_path / "table"), str(tmp_path / "checkpoint"))
        return kept.count(), {r.rule: (r.rows_in, r.rows_quarantined, r.violations) for r in counts.collect()}
    assert run() == (8, {"readable": (12, 4, 4), "has_customer": (12, 4, 8)})
    _messages(live, "late.json", ['{"payment_id": "r", "customer_id": "c"}', "not json"])
    assert run() == (9, {"readable": (2, 1, 1), "has_customer": (2, 1, 1)})  # counts of the second run alone
    assert run() == (9, {"readable": (0, 0, 0), "has_customer": (0, 0, 0)})
    table = spark.read.parquet(str(tmp_path / "table"))
    assert table.where("is_quarantined = 'true'").select(ingest.CORRUPT).distinct().count() == 2
    assert table.where("is_quarantined = 'true'").agg(F.every(F.array_contains("broken_rules", "readable"))).first()[0]


def test_a_batch_told_twice_counts_once():
    class Row(dict):
        def asDict(self):
            return dict(self)

    class Event:
        def __init__(self, batch, n):
            self.progress = type("P", (), {"batchId": batch, "observedMetrics": {"s": Row(rows_in=n, v0=None)}})()
    told = quality.RuleCounts()
    for batch, n in ((0, 5), (0, 5), (1, 7)):
        told.onQueryProgress(Event(batch, n))
    assert told.total("s") == {"rows_in": 12, "v0": 0} and told.total("other") == {}
