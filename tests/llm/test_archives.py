"""Audits of damaged archives: bytes that are no text, shards that break off, lost records, repeated and missing ids."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from keepwell.llm import warc
from keepwell.session import scratch_path


def _archive(spark, rows, parts=1):
    table = spark.createDataFrame(rows, "id long, url string, html string").coalesce(parts)
    path = scratch_path(spark, "archive")
    warc.write_warc(table.select(warc.record(F.col("id"), F.col("url"), F.col("html")).alias("record")), path)
    return path


def _shard(path):
    return glob.glob(f"{path.removeprefix('file:')}/part-00000*.gz")[0]


def _replica(path, content):
    """An archive of one shard with other bytes, without the checksum file of the local file system."""
    name, copy = _shard(path), f"{path.removeprefix('file:')}-hurt"
    os.makedirs(copy)
    with open(f"{copy}/{os.path.basename(name)}", "wb") as f:
        f.write(content)
    return copy


def _faults(a, b):
    return {(r.id, r.fault) for r in warc.audit(a, b).collect()}


ROWS = [(i, f"http://x/{i}", f"<p>page {i * 7919 % 1000} {'word ' * (i % 9)}</p>") for i in range(400)]


@pytest.fixture(scope="module")
def whole(spark):
    return warc.leaves(spark, _archive(spark, ROWS))


def test_bytes_that_are_no_text_are_damage(spark, whole):
    path = _archive(spark, ROWS)
    content = bytearray(gzip.open(_shard(path)).read())
    content[content.index(b"page 7919 ".replace(b"7919", b"919"))] = 0xFF
    path = _replica(path, gzip.compress(bytes(content)))
    hurt = {i for i, _, t in ROWS if "page 919 " in t}
    assert len(hurt) == 1 and _faults(whole, warc.leaves(spark, path)) == {(str(i), "damaged") for i in hurt}
    payloads = {int(r.id): r.payload for r in warc.read_warc(spark, path).collect()}
    assert payloads == {i: None if i in hurt else t for i, _, t in ROWS}


def test_a_shard_that_breaks_off_is_reported_from_there_on(spark, whole):
    path = _archive(spark, ROWS)
    content = open(_shard(path), "rb").read()
    path = _replica(path, content[:len(content) // 2])
    found = {int(i): f for i, f in _faults(whole, warc.leaves(spark, path))}
    first = min(found)
    assert 10 < first < 390 and set(found) == set(range(first, 400)) and {f for i, f in found.items() if i > first} == {"unreadable"}
    assert {int(r.id) for r in warc.read_warc(spark, path).collect()} - {first} == set(range(first))


def test_reading_goes_on_at_the_next_member(spark, whole):
    path = _archive(spark, ROWS)
    text = gzip.open(_shard(path)).read()
    third = text.index(b"WARC/1.0", len(text) // 3)
    members = [gzip.compress(x) for x in (text[:third], text[third:])]
    broken = bytearray(members[0])
    broken[len(broken) // 2] ^= 0xFF
    path = _replica(path, bytes(broken) + members[1])
    faults = {int(i): f for i, f in _faults(whole, warc.leaves(spark, path)) if i}
    kept = text[third:].count(b"WARC/1.0")
    assert 0 < len(faults) <= 400 - kept and max(faults) < 400 - kept


def test_a_lost_record_changes_its_own_ranges_only(spark, whole):
    without = warc.leaves(spark, _archive(spark, [r for r in ROWS if r[0] != 3]))
    assert _faults(whole, without) == {("3", "missing")} and _faults(without, whole) == {("3", "extra")}
    wrong, _ = warc.differing_ranges(whole, without)
    assert wrong.count() <= 2 and whole.select(F.col("ranges")[0]).distinct().count() > 10


def test_repeated_and_missing_ids_and_empty_replicas(spark):
    rows = [(None, None, f"<p>{i}</p>") for i in range(600)] + [(9, "u", "same")] * 3
    a = warc.leaves(spark, _archive(spark, rows))
    b = warc.leaves(spark, _archive(spark, [*rows[:-1], (8, "v", None)]))
    assert _faults(a, b) == {("9", "missing"), ("8", "extra")} and warc.audit(a, a).count() == 0
    widest = a.groupBy(F.col("ranges")[0]).count().agg(F.max("count")).first()[0]
    assert widest <= warc.LONGEST_RUN  # one id never makes one unbounded range
    empty = warc.leaves(spark, _archive(spark, []))
    assert warc.audit(empty, empty).count() == 0
    gone = warc.audit(a, empty).collect()
    assert len(gone) == 603 and {r.fault for r in gone} == {"missing"}


def test_very_long_records_cross_many_chunks(spark):
    rows = [(1, "u", "ab" * 3_000_000), (2, "u", "\r\n\r\nWARC/1.0\r\n" * 3), (3, "u", "x")]
    path = _archive(spark, rows)
    assert {int(r.id): r.payload for r in warc.read_warc(spark, path).collect()} == {i: t for i, _, t in rows}
    assert warc.leaves(spark, path).where("not intact").count() == 0
