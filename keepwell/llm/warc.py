"""WARC files and a Merkle audit of their replicas.

Records are written as WARC/1.0 text by Spark's own writer, one gzip shard per task. A replica is read as bytes, each shard once
and a chunk at a time, and every record is hashed together with its place: (shard, sequence, offset, length, digest). A tree over
ordered ranges follows, about FANOUT children to a node, from records to shard roots to the root of the replica. Two replicas are
compared from the root down, and only the children of nodes that differ are looked at; the records below them are matched by id.

Borders of ranges are drawn by the ids, not by position: a record whose id has a hash that ends in zero begins a range, so a lost
or added record changes its own ranges and no later ones. After LONGEST_RUN records without a border one is set, whatever the ids.

Damage is reported, it stops nothing. Bytes that are no UTF-8 are hashed like any others. Where a shard can't be inflated, reading
goes on at its next gzip member, if there is one, and records of the other replica from there on are `unreadable`. In `read_warc`
a payload that can't be decoded is null. A shard is held whole, compressed, by one task, so it must be under 2 GB.

Null urls and pages are empty ones. Payloads that hold the separator of records are written in base64, so a page can't forge a record.
Repeated and null ids are told apart by their number among the records with that id in a damaged range. An empty replica has one
empty root. Very long records need memory of about three times their size. Further columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keepwell.session import stored

FANOUT_BITS = 4
#: levels that ranges are drawn for; a shard of more than 16^6 records only has more children at its root
DEEPEST = 6
LONGEST_RUN = 256
CHUNK = 1 << 16
BEGIN, BETWEEN = "WARC/1.0\r\n", "\r\n\r\n"
SEPARATOR, MEMBER = (BETWEEN + BEGIN).encode(), b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
LEAVES = "shard int, sequence long, offset long, length long, id string, digest binary, intact boolean, ranges array<long>"


def record(id_col: Column, url: Column, payload: Column) -> Column:
    """The text of a WARC resource record."""
    payload = F.coalesce(payload, F.lit(""))
    unsafe = F.contains(payload, F.lit(BETWEEN + BEGIN.rstrip()))
    body = F.when(unsafe, F.base64(F.encode(payload, "UTF-8"))).otherwise(payload)
    return F.concat(
        F.lit(f"{BEGIN}WARC-Type: resource\r\nWARC-Date: {DATE}\r\nWARC-Record-ID: <urn:page:"), F.coalesce(id_col.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", " "),
        F.when(unsafe, F.lit("\r\nContent-Transfer-Encoding: base64")).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nWARC-Block-Digest: sha256:"), F.sha2(body, 256), F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit(BETWEEN), body)


def write_warc(records: DataFrame, path: str) -> None:
    """Writes the `record` column, a gzip shard per partition."""
    (records.select("record").write.option("lineSep", BETWEEN).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def _shards(spark: SparkSession, path: str) -> DataFrame:
    """(shard, content): the number of each part file and its bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"), "content")


def _inflated(content: bytes) -> Iterator[bytes | None]:
    """The bytes of all gzip members, piece by piece; None where a member breaks off."""
    start = 0
    while 0 <= start < len(content):
        inflate, at = zlib.decompressobj(31), start
        try:
            while not inflate.eof:
                piece = inflate.unconsumed_tail
                if not piece:
                    piece, at = content[at:at + CHUNK], at + CHUNK
                    if not piece:
                        raise zlib.error("cut short")
                yield inflate.decompress(piece, 16 * CHUNK)
            start = min(at, len(content)) - len(inflate.unused_data)
        except zlib.error:
            yield None
            start = content.find(MEMBER, start + 1)


def _records(content: bytes) -> Iterator[bytes | None]:
    """The records of a shard without what stands between them; None after a record that a break cut off."""
    held, seen = bytearray(), 0
    for piece in _inflated(content):
        held += piece or b""
        while (at := held.find(SEPARATOR, seen)) >= 0:
            yield bytes(held[:at])
            del held[:at + len(BETWEEN)]
            seen = 0
        seen = max(0, len(held) - len(SEPARATOR))
        if piece is None:
            if held:
                yield bytes(held)
            yield None
            held, seen = bytearray(), 0
    if held:
        yield bytes(held.removesuffix(BETWEEN.encode()))


def _parsed(raw: bytes) -> tuple[str, str, bytes, bool, bool]:
    """(id, url, payload as stored, whether it is what the record declares, whether it is base64)."""
    head, _, body = raw.partition(BETWEEN.encode())
    fields = dict(line.partition(": ")[::2] for line in head.decode(errors="replace").split("\r\n"))
    found = re.fullmatch(r"<urn:page:(.*)>", fields.get("WARC-Record-ID", ""))
    whole = fields.get("Content-Length") == str(len(body)) and fields.get("WARC-Block-Digest") == f"sha256:{hashlib.sha256(body).hexdigest()}"
    return found[1] if found else "", fields.get("WARC-Target-URI", ""), body, whole, fields.get("Content-Transfer-Encoding") == "base64"


def _hash(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("\n".join(map(str, parts)).encode(), digest_size=8).digest(), "big", signed=True)


class _Ranges:
    """The range of each level that a record falls into, record after record of a shard."""

    def __init__(self):
        self.now, self.run, self.met = [0] * DEEPEST, 0, Counter()

    def of(self, name: str) -> list[int]:
        mark = None
        if not _hash(name) & (1 << FANOUT_BITS) - 1:
            self.met[name] += 1
            mark, self.run = _hash(name, self.met[name]), 0
        elif self.run and self.run % LONGEST_RUN == 0:
            mark = _hash(self.now[0], self.run, "")
        self.run += 1
        if mark is not None:
            zeros = (mark & -mark).bit_length() - 1 if mark else 64
            for level in range(min(DEEPEST, 1 + zeros // FANOUT_BITS)):
                self.now[level] = mark
        return list(self.now)


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per record; a row without digest where a shard breaks off."""
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.bool_(), pa.list_(pa.int64()))
    names = ["shard", "sequence", "offset", "length", "id", "digest", "intact", "ranges"]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    rows: list[tuple] = []
    for batch in batches:
        for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            sequence, offset, ranges = 0, 0, _Ranges()
            for raw in _records(content.as_py()):
                if raw is None:
                    rows.append((shard, sequence, offset, 0, "", None, False, ranges.now[:]))
                    continue
                name, _, _, whole, _ = _parsed(raw)
                rows.append((shard, sequence, offset, len(raw), name, hashlib.sha256(raw).digest(), whole, ranges.of(name)))
                sequence, offset = sequence + 1, offset + len(raw) + len(BETWEEN)
                if len(rows) == 4096:
                    yield made(rows)
                    rows = []
    if rows:
        yield made(rows)


def _text(body: bytes, encoded: bool) -> str | None:
    try:
        return (base64.b64decode(body, validate=True) if encoded else body).decode()
    except (UnicodeDecodeError, binascii.Error):
        return None


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(id, url, payload) of every record that can be read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(1):
                for raw in _records(content.as_py()):
                    if raw is not None:
                        name, url, body, _, encoded = _parsed(raw)
                        yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (name, url, _text(body, encoded))], names=["id", "url", "payload"])
    return _shards(spark, path).mapInArrow(run, "id string, url string, payload string")


def leaves(spark: SparkSession, path: str) -> DataFrame:
    return stored(_shards(spark, path).mapInArrow(_leaves, LEAVES), "warc-leaves")


def _range_at(level: int, depth: int) -> Column:
    """The range of a level; the highest level has one for each shard."""
    return (F.lit(0).cast("long") if level >= depth else F.col("ranges")[level - 1]).alias("place")


def _above(nodes: DataFrame, place: Column) -> DataFrame:
    """The next level: each node hashes the lengths and digests of its children in order."""
    grouped = nodes.groupBy("shard", place).agg(F.array_sort(F.collect_list(F.struct("first", "last", "digest"))).alias("parts"), F.min_by("ranges", "first").alias("ranges"))
    text = F.array_join(F.transform("parts", lambda p: F.concat_ws(":", (p["last"] - p["first"]).cast("string"), p["digest"])), ",")
    return grouped.select("shard", "place", F.array_min(F.col("parts")["first"]).alias("first"), F.array_max(F.col("parts")["last"]).alias("last"),
                          F.sha2(text, 256).alias("digest"), "ranges")


def levels(leaf_table: DataFrame, depth: int) -> list[DataFrame]:
    """Nodes of levels 1 to `depth`, with their ranges of offsets; the last level has one node per shard."""
    below = leaf_table.select("shard", F.col("offset").alias("first"), (F.col("offset") + F.col("length")).alias("last"),
                              F.coalesce(F.hex("digest"), F.lit("unreadable")).alias("digest"), "ranges")
    out = []
    for level in range(1, depth + 1):
        below = stored(_above(below, _range_at(level, depth)), "warc-level")
        out.append(below)
    return out


def _shard_levels(roots: DataFrame, widest: int) -> list[DataFrame]:
    """The replica's own tree: shard roots in the order of their numbers, up to one node. Shards keep their numbers, so places do here."""
    out = [roots.select(F.lit(0).alias("shard"), F.col("shard").cast("long").alias("place"), F.lit(0).cast("long").alias("first"), "last", "digest", "ranges")]
    while widest > 0:
        parts = out[-1].withColumnRenamed("place", "child").withColumn("first", F.col("child")).withColumn("last", F.col("child") + F.col("last"))
        out.append(stored(_above(parts, F.shiftright("child", FANOUT_BITS).alias("place")), "warc-level"))
        widest >>= FANOUT_BITS
    return out


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(shard, place) of nodes that differ or that one side lacks."""
    met = left.select("shard", "place", F.col("digest").alias("a")).join(right.select("shard", "place", F.col("digest").alias("b")), ["shard", "place"], "full")
    return stored(met.where(~F.col("a").eqNullSafe(F.col("b"))).select("shard", "place"), "warc-differing")


def differing_ranges(left: DataFrame, right: DataFrame) -> tuple[DataFrame, int]:
    """((shard, place) of the lowest ranges that differ, depth), reached from the roots through nodes that differ."""
    widest = left.unionByName(right).agg(F.max("sequence"), F.max("shard")).first()
    depth = next((d for d in range(1, DEEPEST) if (widest[0] or 0) < 1 << FANOUT_BITS * d), DEEPEST)
    a, b = (levels(x, depth) for x in (left, right))
    tops = [_shard_levels(x[-1], widest[1] or 0) for x in (a, b)]
    under = None
    for x, y in zip(*map(reversed, tops), strict=True):
        if under is not None:
            parents = under.select(F.col("place").alias("up"))
            x, y = (t.withColumn("up", F.shiftright("place", FANOUT_BITS)).join(parents, "up", "left_semi") for t in (x, y))
        under = _differing(x, y)
    under = under.select(F.col("place").cast("int").alias("shard"), F.lit(0).cast("long").alias("place"))
    for level in range(depth - 1, 0, -1):
        parents = under.withColumnRenamed("place", "up")
        x, y = (t[level - 1].withColumn("up", _range_at(level + 1, depth)).join(parents, ["shard", "up"], "left_semi") for t in (a, b))
        under = _differing(x, y)
    return under, depth


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """(id, fault, shard, offset, length): records of the replica with leaves `left` that `right` has damaged, lacks or adds, or
    that stand in `left` at or after the place where a shard of `right` breaks off (unreadable)."""
    wrong, depth = differing_ranges(left, right)

    def below(side: DataFrame, name: str) -> DataFrame:
        chosen = side.where("digest is not null").withColumn("place", _range_at(1, depth)).join(wrong, ["shard", "place"], "left_semi")
        number = F.row_number().over(Window.partitionBy("shard", "id").orderBy("sequence"))
        return chosen.select("shard", "id", number.alias("number"), F.struct("sequence", "offset", "length", "digest").alias(name))

    breaks = right.where("digest is null").groupBy("shard").agg(F.min("sequence").alias("breaks"))
    met = below(left, "a").join(below(right, "b"), ["shard", "id", "number"], "full").where(
        "a is null or b is null or a.digest != b.digest").join(breaks, "shard", "left")
    gone = F.when(F.col("a.sequence") >= F.col("breaks") - 1, "unreadable").otherwise("missing")
    fault = F.when(F.col("b").isNull(), gone).when(F.col("a").isNull(), "extra").otherwise("damaged")
    return met.select("id", fault.alias("fault"), "shard", F.coalesce("a.offset", "b.offset").alias("offset"), F.coalesce("a.length", "b.length").alias("length"))
