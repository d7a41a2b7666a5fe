"""Nightly merges must give what one run over all rows gives, and touch little."""

import pytest
from pyspark.sql import functions as F

from keepwell.operators import nightly
from keepwell.operators.dedup import latest_by_key
from keepwell.session import scratch_path

KIND = "id string, v string, _ingested_at int"


def _table(spark, n, stamp, low=0):
    return spark.range(low, low + n).selectExpr("lpad(cast(id as string), 9, '0') id", f"concat('v', id, '-', {stamp}) v", f"cast({stamp} as int) _ingested_at")


def _rows(df):
    return sorted(df.select("id", "v", "_ingested_at").collect(), key=str)


def test_a_night_of_one_percent_writes_one_percent_of_the_buckets(spark):
    path, base = scratch_path(spark, "nightly"), _table(spark, 20_000, 1)
    nightly.start(base, "id", path, 100)
    delta = _table(spark, 200, 2, 7_000)
    got = nightly.apply(delta, "id", path, 1)
    assert _rows(got) == _rows(latest_by_key(base.unionByName(delta), "id"))
    assert 1 <= len(nightly.rewritten(spark, path, 1)) <= 3


def test_nights_equal_a_full_rebuild(spark):
    path = scratch_path(spark, "nightly")
    nights = [[("b", "1", 1), ("b", "2", 1), (None, "n", 1), ("d", "x", 5), ("f", "x", 1)],
              [("d", "late", 4), ("a", "first", 1), (None, "m", 2), ("b", None, 1), ("zz", "new", 1), ("zz", "new", 1)],
              [], [("c", None, None), ("d", "y", 5), ("f", "z", None)]]
    frames = [spark.createDataFrame(rows, KIND) for rows in nights]
    got = nightly.start(frames[0], "id", path, 3)
    seen = frames[0]
    for number, frame in enumerate(frames[1:], 1):
        got, seen = nightly.apply(frame, "id", path, number), seen.unionByName(frame)
        assert _rows(got) == _rows(latest_by_key(seen, "id"))


@pytest.mark.parametrize("largest", [5, 50])
def test_growing_buckets_are_split(spark, largest):
    """Keys that rise with time fall into the last bucket; repeated splits keep every key in one place."""
    path, seen = scratch_path(spark, "nightly"), _table(spark, 40, 0)
    nightly.start(seen, "id", path, 2)
    for night in (1, 2, 3):
        delta = _table(spark, 60, night, 20 + 30 * night)
        got, seen = nightly.apply(delta, "id", path, night, largest=largest), seen.unionByName(delta)
        assert _rows(got) == _rows(latest_by_key(seen, "id"))
    written = {b for night in (1, 2, 3) for b in nightly.rewritten(spark, path, night)}  # a bucket no night touches stays as it is
    sizes = spark.read.parquet(f"{path}/rows").where(F.col(nightly.BUCKET).isin(written)).groupBy(nightly.BUCKET).count()
    assert len(written) > 2 and sizes.agg(F.max("count")).first()[0] <= largest


def test_an_empty_start_and_a_number_as_key(spark):
    path, kind = scratch_path(spark, "nightly"), "id int, _ingested_at int"
    assert nightly.start(spark.createDataFrame([], kind), "id", path, 4).count() == 0
    got = nightly.apply(spark.createDataFrame([(2, 1), (10, 1), (10, 2), (None, 1)], kind), "id", path, 1)
    got = nightly.apply(spark.createDataFrame([(10, 3), (9, 1)], kind), "id", path, 2)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(2, 1), (10, 3), (None, 1), (9, 1)], key=str)


def test_nights_repeat_and_resume(spark, monkeypatch):
    path, base = scratch_path(spark, "nightly"), _table(spark, 100, 1)
    nightly.start(base, "id", path, 5)
    delta = _table(spark, 30, 2, 90)
    with pytest.raises(ValueError, match="night 1"):
        nightly.apply(delta, "id", path, 2)
    monkeypatch.setattr(nightly, "_kind", lambda *_: 1 / 0)  # lost after the copy, before the borders
    with pytest.raises(ZeroDivisionError):
        nightly.apply(delta, "id", path, 1)
    monkeypatch.undo()
    whole = _rows(latest_by_key(base.unionByName(delta), "id"))
    assert _rows(nightly.apply(delta, "id", path, 1)) == whole
    assert _rows(nightly.apply(_table(spark, 5, 9), "id", path, 1)) == whole  # a finished night is not run again
