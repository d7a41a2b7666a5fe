"""Passages that repeat across documents, by a sparse suffix array over words.

Suffixes are kept at minimiser positions only: where the hash of GRAM words is the smallest of SPREAD consecutive ones, so
the choice depends on the content alone. Any passage of LEAST words has such a position among its first SPREAD words, and
at least LEAST - SPREAD + 1 of its words follow from there. The kept suffixes of all documents are sorted by (the hash of)
that many words and range partitioned by (prefix, document), so a prefix that a third of all documents share spreads over
partitions. Neighbours with the same prefix are matches of that length.

Each match is then extended to the left and right: every start from which a passage of LEAST words reaches the match gives
a suffix of LEAST words, and these are compared across documents exactly (by 64-bit hashes of their words). Starts that match join into maximal
passages of any length. Only lowest and highest document per passage are kept, never the pairs of a group. Equal texts are
extended once, and what is found goes to all of them.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased. Rows with the same id are one document: what only they share is no
repeat. A null text has no words; rows with a null id are left as they are and found in no other document. Texts shorter than
LEAST words hold no passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.hashing import SPACED, Words, list_column, shingles, signed, text_slices
from keepwell.session import stored

LEAST, GRAM, SPREAD = 50, 8, 16
COPIES = 1024  #: copies of one text that a task serves at a time


def _running(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of each `width` consecutive values; width a power of two."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:]) if len(values) > step else values[:0]
        step *= 2
    return values


def minimisers(words: np.ndarray, gram: int = GRAM, spread: int = SPREAD) -> np.ndarray:
    """Places whose gram hash is the smallest in some run of `spread` grams."""
    hashes = shingles(words, gram)
    least = _running(hashes, spread, np.minimum)
    if not len(least):
        return np.zeros(0, np.int64)
    # a place is chosen if it is the minimum of any run that covers it
    padded = np.concatenate([np.zeros(spread - 1, np.uint64), least, np.zeros(spread - 1, np.uint64)])
    return np.flatnonzero(_running(padded, spread, np.maximum) == hashes)


def _suffixes(least: int):
    """(id, text) -> (key, id, places): kept suffixes, one row per document and prefix."""
    reach = least - SPREAD + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in text_slices(batch.column(1)):
                words = Words(data, offsets, SPACED)
                places = minimisers(words.hash)
                doc = np.searchsorted(words.first, places, "right") - 1
                inside = places + reach <= words.first[doc + 1]
                places, doc = places[inside], doc[inside]
                if not len(places):
                    continue
                key = shingles(words.hash, reach)[places]
                order = np.lexsort((places, key, doc))
                places, doc, key = places[order], doc[order], key[order]
                new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])
                first = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(key[first])), pa.array(ids[row + doc[first]].astype(np.int64)),
                     list_column((places - words.first[doc]).astype(np.int32), np.append(first, len(places)), pa.int32())],
                    names=["key", "id", "places"])
    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those whose neighbour has the same one. The ends of a partition, whose neighbours are elsewhere,
    pass too: the exact comparison comes later."""
    held: pa.RecordBatch | None = None
    before: int | None = None
    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = batch.column(0).to_numpy()
        same = key[1:] == key[:-1]
        keep = np.concatenate([[first or key[0] == before], same]) | np.concatenate([same, [False]])
        held, before = batch.slice(batch.num_rows - 1), key[-2] if len(key) > 1 else before
        done = batch.slice(0, batch.num_rows - 1).filter(pa.array(keep[:-1]))
        if batch.num_rows > 1:
            first = False
        if done.num_rows:
            yield done.select(["id", "places"])
    if held is not None:
        yield held.select(["id", "places"])


def _extended(least: int):
    """(row, low, high, text, places) -> (key, row, low, high, starts): every suffix of `least` words that reaches a match, one
    row per text and key, so a text that repeats one word doesn't make its key hot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [batch.column(c).to_numpy() for c in range(3)]
            places = batch.column(4)
            for row, data, offsets in text_slices(batch.column(3)):
                words = Words(data, offsets, SPACED)
                runs = shingles(words.hash, least)
                for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True), row):
                    if b - a < least:
                        continue
                    near = np.zeros(b - a + 1, np.int32)  # +1 where a range of starts begins, -1 where it ends
                    at = places[i].values.to_numpy()
                    np.add.at(near, np.maximum(at - SPREAD + 1, 0).clip(0, b - a), 1)
                    np.add.at(near, (at + 1).clip(0, b - a), -1)
                    starts = np.flatnonzero(np.cumsum(near[:b - a - least + 1]) > 0)
                    if len(starts):
                        order = np.argsort(runs[a + starts], kind="stable")
                        starts = starts[order]
                        key = runs[a + starts]
                        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(signed(key[first])), *[pa.array(np.full(len(first), c[i])) for c in own],
                             list_column(starts.astype(np.int32), np.append(first, len(starts)), pa.int32())],
                            names=["key", "row", "low", "high", "starts"])
    return run


def _left(start: np.ndarray, own: np.ndarray, words: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(covered, cut, whole): words in a repeated run, those of them in no run that is kept here, and the runs that lose no word."""
    depth = np.zeros((2, words + 1), np.int32)
    for k, some in enumerate((start, start[own])):
        np.add.at(depth[k], some, 1)
        np.add.at(depth[k], some + least, -1)
    covered, kept = np.cumsum(depth, axis=1)[:, :words] > 0
    cut = covered & ~kept
    lost = np.concatenate([[0], np.cumsum(cut)])
    return covered, cut, lost[start + least] == lost[start]


def _standing(least: int):
    """(id, starts, keys, keepers) -> (key, id): runs that stay whole in a document that is not their keeper, as runs that it
    keeps cover them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_pylist(), [batch.column(i) for i in (1, 2, 3)]
            for i, own_id in enumerate(ids):
                start, key, keeper = (c[i].values.to_numpy() for c in lists)
                own = keeper == own_id
                if own.any() and not own.all():
                    _, _, whole = _left(start, own, int(start.max()) + least, least)
                    keys = np.unique(key[whole & ~own])
                    if len(keys):
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.full(len(keys), own_id, np.int64))], names=["key", "id"])
    return run


def _merged(covered: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(id, words, first and last word, bytes, arrays) of each row of (id, text, arrays ...)."""
    ids, lists = batch.column(0).to_pylist(), [batch.column(i) for i in range(2, batch.num_columns)]
    for row, data, offsets in text_slices(batch.column(1)):
        words = Words(data, offsets, SPACED)
        for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True), row):
            yield ids[i], words, a, b, data[offsets[i - row]:offsets[i - row + 1]], offsets[i - row], [c[i].values.to_numpy() for c in lists]


def _spans(least: int):
    """(id, text, starts, low, high) -> a row per text with its maximal passages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own_id, words, a, b, _, text_start, (start, low, high) in _rows(batch):
                own = low == own_id
                covered, _, _ = _left(start, own, b - a, least)
                spans = []
                for x, y in _merged(covered):
                    inside = (start >= x) & (start < y)
                    other = np.where(own[inside], high[inside], low[inside])
                    spans.append({"start": x, "end": y, "byte_start": int(words.start[a + x] - text_start), "byte_end": int(words.end[a + y - 1] - text_start),
                                  "others": np.unique(other).tolist(), "first": bool(own[inside].all())})
                out.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, SPAN_LIST)], names=["id", "text", "spans"])
    return run


def _cuts(least: int):
    """(id, text, starts, keepers, holders) -> (id, text, cut): the text without the passages that other documents keep. Of a
    run that stands whole in several documents all but its holder lose every word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own_id, words, a, b, data, text_start, (start, keeper, holder) in _rows(batch):
                _, cut, whole = _left(start, keeper == own_id, b - a, least)
                for x in start[whole & (holder != own_id)]:
                    cut[x:x + least] = True
                raw, parts, at = data.tobytes(), [], 0
                for x, y in _merged(cut):
                    begin, stop = int(words.start[a + x] - text_start), int(words.end[a + y - 1] - text_start)
                    parts.append(raw[at:begin].rstrip(b" \t"))
                    at = stop
                parts.append(raw[at:] if not parts else raw[at:].lstrip(b" \t"))
                out.append(b" ".join(p for p in parts if p).strip() if len(parts) > 1 else raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.decode() for c in out], pa.string())], names=["id", "text", "cut"])
    return run


SPAN_LIST = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("byte_start", pa.int64()), ("byte_end", pa.int64()),
                                ("others", pa.list_(pa.int64())), ("first", pa.bool_())]))
SPAN_SCHEMA = "id long, text string, spans array<struct<start: int, end: int, byte_start: long, byte_end: long, others: array<long>, first: boolean>>"


def _shared(docs: DataFrame, least: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(held, versions, shared): texts with a match, their groups of equal ones, and (key, row, low, starts, lowest, highest) of
    each run of `least` words that several documents hold, for one text of each group."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    kept = texts.mapInArrow(_suffixes(least), "key long, id long, places array<int>")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    matched = (kept.repartitionByRange(partitions, "key", "id").sortWithinPartitions("key", "id")
               .mapInArrow(_neighbours, "id long, places array<int>")
               .groupBy("id").agg(F.flatten(F.collect_list("places")).alias("places")))
    matched = stored(matched, "suffix-matches")
    held = texts.join(matched, "id").dropDuplicates(["id", "text"]).select(
        F.monotonically_increasing_id().alias("row"), F.md5("text").alias("digest"), "id", "text", "places")
    held = stored(held, "suffix-texts")
    # equal texts have the same suffixes, so one of them stands for all of them with their lowest and highest id
    versions = stored(held.groupBy("digest").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.min_by("row", "id").alias("first_row"),
                                                 F.ceil(F.count("*") / COPIES).cast("int").alias("groups")), "suffix-versions")
    shown = held.join(versions.select(F.col("first_row").alias("row"), "low", "high"), "row")
    starts = shown.select("row", "low", "high", "text", "places").mapInArrow(_extended(least), "key long, row long, low long, high long, starts array<int>")
    starts = stored(starts, "suffix-starts")
    repeated = (starts.groupBy("key").agg(F.min("low").alias("lowest"), F.max("high").alias("highest")).where("lowest < highest"))
    return held, versions, starts.select("key", "row", "low", "starts").join(repeated, "key")


def _listed(shared: DataFrame, *columns: str) -> DataFrame:
    """A row per text: its starts, and arrays that hold the columns of each start."""
    return shared.groupBy("row").agg(F.flatten(F.collect_list("starts")).alias("starts"),
                                     *[F.flatten(F.collect_list(F.array_repeat(c, F.size("starts")))).alias(f"{c}s") for c in columns])


def _with_copies(held: DataFrame, versions: DataFrame, found: DataFrame) -> DataFrame:
    """(id, text, columns of `found`): what was found for a text goes to its copies in groups of COPIES, so no task serves all
    copies of one text."""
    columns = [c for c in found.columns if c != "row"]
    dealt = (found.join(versions.select(F.col("first_row").alias("row"), "digest", "groups"), "row").drop("row")
             .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups"))
    members = (held.select("row", "digest").join(versions.select("digest", "groups"), "digest")
               .select("row", "digest", F.pmod(F.xxhash64("row"), "groups").cast("int").alias("group")))
    found = members.join(dealt, ["digest", "group"]).select("row", *columns)
    return held.join(found, "row").select("id", "text", *columns)


def repeated_passages(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, spans) for each distinct text that shares a passage of `least` or more words with another document.

    A span has word and byte offsets, the documents it was matched with (per word run the lowest document that has it, or for
    that one the highest), and whether this document is the lowest for all of it."""
    held, versions, shared = _shared(docs, least, id_col, text_col)
    return _with_copies(held, versions, _listed(shared, "lowest", "highest")).mapInArrow(_spans(least), SPAN_SCHEMA)


def _rehomed(shared: DataFrame, least: int, keeper: str, name: str) -> DataFrame:
    """(key, name): for runs that stand whole in documents other than their keeper, the lowest of those."""
    own = shared.groupBy("row").agg(F.first("low").alias("id"), F.flatten(F.collect_list("starts")).alias("starts"),
                                    *[F.flatten(F.collect_list(F.array_repeat(c, F.size("starts")))).alias(f"{c}s") for c in ("key", keeper)])
    found = own.select("id", "starts", "keys", f"{keeper}s").mapInArrow(_standing(least), "key long, id long")
    return stored(found.groupBy("key").agg(F.min("id").alias(name)), f"suffix-{name}")


def passage_cuts(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, cut) for the texts of `repeated_passages`: `cut` is the text without the passages that other documents keep.

    A run of `least` words is kept by the lowest document that has it, unless it stands whole in another document anyway, inside
    the runs which that one keeps: then by the lowest such document. What still stands in several documents is cut from all but
    the lowest of them, every word, though runs that reach into it go too. So after the cut no repeated run is in two documents,
    and each of its words is left in one. Words that a cut brings together count as no passage."""
    held, versions, shared = _shared(docs, least, id_col, text_col)
    shared = stored(shared.drop("highest"), "suffix-shared")
    shared = shared.join(_rehomed(shared, least, "lowest", "moved"), "key", "left").withColumn("keeper", F.coalesce("moved", "lowest"))
    shared = shared.join(_rehomed(shared, least, "keeper", "contested"), "key", "left").withColumn("holder", F.least("contested", "keeper"))
    return _with_copies(held, versions, _listed(shared, "keeper", "holder")).mapInArrow(_cuts(least), "id long, text string, cut string")


def without_repeats(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with each repeated passage left in one document, the lowest that has it or one that keeps it within a longer passage
    (`passage_cuts`). A document of which nothing is left goes; all others stay, and those without repeats stay unchanged."""
    found = stored(passage_cuts(docs, least, id_col, text_col).where("cut != text").select("id", "text", "cut"), "suffix-cuts")
    changed = found.select(F.col("id").alias("_id"), F.xxhash64("text").alias("_version"), F.col("cut").alias("_cut"))
    met = docs.withColumn("_own", F.xxhash64(text_col)).join(
        changed, (F.col(id_col) == F.col("_id")) & (F.col("_own") == F.col("_version")), "left")
    text = F.coalesce(F.col("_cut"), F.col(text_col))
    return met.where("_cut is null or _cut != ''").select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])
