"""Benchmark decontamination: a prefix-filtered containment join of item windows against documents.

A window is `size` consecutive item words (a shorter item is one window). Its shingles of up to three words are ordered by
rarity, which is their count in all documents. A document that contains a window contains all its shingles, so for
containment of 1 the necessary prefix is the one rarest shingle: only its places in documents are candidates. From its
place in the window follow the window's place in the document, which must lie inside the document's words (position and
length bounds); there all words are compared.

The documents are scanned twice and never shuffled; rarity is counted per task and summed. What is broadcast are the
windows, at most BLOCK_WINDOWS at once (some 100 bytes each): a larger benchmark is taken in several such blocks, each
against all documents, whose findings are then united per document.

Nulls: a null text has no words; an item with a null id is ignored; a null document id is passed on. Items and documents
may repeat. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.hashing import ALPHANUMERIC, Words, list_column, shingles, signed, text_slices
from keepwell.session import stored

WINDOW, SHINGLE, BLOCK_WINDOWS = 10, 3, 400_000
RESULT = "row long, id long, n_words long, starts array<int>, ends array<int>, items array<string>"


def _windows(size: int):
    """(item, text) -> (item, words as bytes, shingle length, places, shingles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, ids, words, lengths, grams = batch.column(0).to_pylist(), [], [], [], []
            for row, data, offsets in text_slices(batch.column(1)):
                found = Words(data, offsets, ALPHANUMERIC)
                for i, (a, b) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True), row):
                    for start in range(a, max(a + 1, b - size + 1) if b > a else a):
                        own = found.hash[start:min(b, start + size)]
                        k = min(SHINGLE, len(own))
                        ids.append(items[i])
                        words.append(own.tobytes())
                        lengths.append(k)
                        grams.append(signed(shingles(own, k)).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(words, pa.binary()),
                                              pa.array(lengths, pa.int32()), pa.array(grams, pa.list_(pa.int64()))],
                                             names=["item", "words", "k", "grams"])
    return run


class _Filter:
    """Places of a sorted set of hashes in a long array."""

    def __init__(self, wanted: np.ndarray):
        self.wanted = np.unique(wanted)
        self.shift = np.uint64(64 - 22)
        self.some = np.zeros(1 << 22, bool)
        self.some[(self.wanted >> self.shift).astype(np.int64)] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.some[(hashes >> self.shift).astype(np.int64)])
        found = np.searchsorted(self.wanted, hashes[maybe])
        found[found == len(self.wanted)] = 0
        return maybe[self.wanted[found] == hashes[maybe]] if len(self.wanted) else maybe[:0]


def _count(shared):
    """Texts -> (k, shingle, count) of the benchmark's shingles; one row per task and shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {k: _Filter(np.array(v, np.int64).view(np.uint64)) for k, v in shared.value.items()}
        total = {k: np.zeros(len(f.wanted), np.int64) for k, f in wanted.items()}
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                words = Words(data, offsets, ALPHANUMERIC)
                for k, f in wanted.items():
                    hashes = shingles(words.hash, k)
                    at = np.searchsorted(f.wanted, hashes[f.places(hashes)])
                    total[k] += np.bincount(at, minlength=len(f.wanted))
        for k, counts in total.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(signed(wanted[k].wanted[some])),
                                              pa.array(counts[some])], names=["k", "gram", "count"])
    return run


def _hits(shared):
    """(row, id, text) -> RESULT for the windows of one block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_k = {}
        for k in {w[1] for w in shared.value}:
            own = [w for w in shared.value if w[1] == k]
            gram = np.array([w[2] for w in own], np.int64).view(np.uint64)
            order = np.argsort(gram, kind="stable")
            words = [np.frombuffer(own[i][4], np.uint64) for i in order]
            by_k[k] = (_Filter(gram), gram[order], np.array([own[i][3] for i in order]), np.array([len(w) for w in words]), words,
                       [own[i][0] for i in order])
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(2)):
                words = Words(data, offsets, ALPHANUMERIC)
                first, n = words.first, len(offsets) - 1
                starts, ends, items = [], [], []
                for k, (needed, gram, offset, length, own, names) in by_k.items():
                    hashes = shingles(words.hash, k)
                    for place in needed.places(hashes).tolist():
                        doc = np.searchsorted(first, place, "right") - 1
                        low, high = np.searchsorted(gram, hashes[place]), np.searchsorted(gram, hashes[place], "right")
                        for w in range(low, high):
                            start = place - offset[w]
                            end = start + length[w]
                            if start >= first[doc] and end <= first[doc + 1] and (words.hash[start:end] == own[w]).all():
                                starts.append(start)
                                ends.append(end)
                                items.append((doc, names[w]))
                docs = np.searchsorted(first, np.array(starts, np.int64), "right") - 1
                order = np.argsort(docs, kind="stable")
                cuts = np.searchsorted(docs[order], np.arange(n + 1))
                base = first[docs[order]] if len(order) else np.zeros(0, np.int64)
                flat = lambda v: list_column((np.array(v, np.int64)[order] - base).astype(np.int32), cuts, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), batch.column(1).slice(row, n), pa.array(np.diff(first).astype(np.int64)),
                     flat(starts), flat(ends),
                     pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array([items[i][1] for i in order.tolist()], pa.string()))],
                    names=["row", "id", "n_words", "starts", "ends", "items"])
    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping hits become maximal spans; n_hit is the number of words in any."""
    for batch in batches:
        starts, ends, hit = [], [], []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            spans: list[list[int]] = []
            for x, y in sorted(zip(a, b, strict=True)):
                if spans and x <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], y)
                else:
                    spans.append([x, y])
            starts.append([s[0] for s in spans])
            ends.append([s[1] for s in spans])
            hit.append(sum(y - x for x, y in spans))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())),
             pa.array(hit, pa.int64()), batch.column(4)], names=["id", "n_words", "starts", "ends", "n_hit", "items"])


def prefixes(docs: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, doc_text: str, size: int) -> DataFrame:
    """(item, words, k, gram, place, block): each distinct window with its rarest shingle; `block` deals them out."""
    spark = docs.sparkSession
    windows = stored(benchmark.where(F.col(item_col).isNotNull())
                     .select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
                     .mapInArrow(_windows(size), "item string, words binary, k int, grams array<long>")
                     .dropDuplicates(["item", "words"]), "benchmark-windows")
    placed = windows.select("item", "words", "k", F.posexplode("grams").alias("place", "gram"))
    grams = placed.select("k", "gram").distinct()
    blocks = max(1, -(-grams.count() // BLOCK_WINDOWS))
    dealt = stored(grams.withColumn("block", F.pmod(F.xxhash64("k", "gram"), F.lit(blocks))), "benchmark-shingles")
    counts = None
    for block in range(blocks):  # at most some BLOCK_WINDOWS numbers at a time
        wanted: dict[int, list[int]] = {}
        for r in dealt.where(F.col("block") == block).toLocalIterator():
            wanted.setdefault(r.k, []).append(r.gram)
        shared = spark.sparkContext.broadcast(wanted)
        part = docs.select(F.col(doc_text).alias("text")).mapInArrow(_count(shared), "k int, gram long, count long")
        counts = part if counts is None else counts.unionByName(part)
    counts = counts.groupBy("k", "gram").agg(F.sum("count").alias("count"))
    rarest = (placed.join(counts, ["k", "gram"], "left")
              .groupBy("item", "words", "k").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "gram", "place")).alias("least")))
    # a window with a shingle that no document has occurs nowhere
    return stored(rarest.where("least.count > 0").select("item", "words", "k", "least.gram", "least.place"), "benchmark-prefixes")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, n_words, starts, ends, n_hit, items) per row of `docs`: spans of hit words and the items that occur, sorted as strings."""
    spark = docs.sparkSession
    windows = prefixes(docs, benchmark, item_col, item_text, text_col, size)
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    windows = windows.withColumn("block", F.pmod(F.xxhash64("gram", "words"), F.lit(blocks)))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = None
    for block in range(blocks):
        own = [(r.item, r.k, r.gram, r.place, r.words) for r in windows.where(F.col("block") == block).toLocalIterator()]
        part = texts.mapInArrow(_hits(spark.sparkContext.broadcast(own)), RESULT)
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        found = found.groupBy("row").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"),
                                         *[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")])
    return found.select("id", "n_words", "starts", "ends", F.array_sort(F.array_distinct("items")).alias("items")).mapInArrow(
        _united, "id long, n_words long, starts array<int>, ends array<int>, n_hit long, items array<string>")
