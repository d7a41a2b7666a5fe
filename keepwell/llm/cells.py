"""A stated set of query vectors against all vectors, in cells: one group of vectors meets one block of queries in each.

A vector goes once to each block of at most BLOCK queries (hashed, so about that many), a query once to each group. The number
of groups is fixed until a group would hold more than GROUP vectors, so what the cells return grows with the queries and
not with queries times vectors. Groups and blocks are dealt by a row number, never by id, label or vector: rows that repeat
or share a key spread like any others. A task holds one block of queries and one Arrow batch of vectors at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.session import stored

BLOCK, GROUPS, GROUP = 4096, 32, 1 << 20


def _scaled(scale: float):
    """(id, array of numbers, label) -> (id, floor(scale * x) as packed doubles, label); rows that take no part are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            numbers = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become nan
            ends = np.cumsum([n or 0 for n in pa.compute.list_value_length(column).to_pylist()])
            rows, out, at = [], [], 0
            for i, end in enumerate(ends.tolist()):
                v, at = numbers[at:end], end
                if len(v) and np.isfinite(v).all():
                    rows.append(i)
                    out.append(np.floor(scale * v).astype("<f8").tobytes())
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(out, pa.binary()), batch.column(2).take(rows)],
                                             names=["id", "vector", "label"])
    return run


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: float, label: Column | None = None) -> DataFrame:
    """(id, vector, label, width, row), written once: `vector` holds floor(scale * component) as packed doubles, `row` is unique."""
    label = F.lit(None).cast("string") if label is None else label.cast("string")
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), label.alias("label"))
    usable = given.where("id is not null and vector is not null").mapInArrow(_scaled(scale), "id long, vector binary, label string")
    return stored(usable.select("*", (F.length("vector") / 8).cast("int").alias("width"),
                                F.monotonically_increasing_id().alias("row")), "whole-numbers")


class Queries:
    """The block of queries of a cell: `row`, `id`, `label`, `matrix` (a row of doubles per query) and `marks` (a list of longs each)."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        self.row, self.id = table["row"].to_pylist(), table["id"].to_pylist()
        self.label, self.marks = table["label"].to_pylist(), table["marks"].to_pylist()
        self.matrix = matrix(table["vector"].to_pylist())

    def __len__(self) -> int:
        return len(self.row)


def matrix(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), -1)


def _over_cells(make: Callable):
    """Rows sorted by cell, queries first -> what `make(queries)` answers after it was offered every batch of the cell's vectors.

    `offer(ids, labels, matrix)` takes vectors of the queries' length, `answers()` returns columns (row, id, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, asked, cell = None, [], None

        def ended() -> Iterator[pa.RecordBatch]:
            if cell is not None:
                rows, ids, scores = cell.answers()
                for at in range(0, len(rows), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[at:at + 50_000], pa.int64()) for x in (rows, ids, scores)],
                                                     names=["row", "id", "score"])

        for batch in batches:
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            turns = np.flatnonzero(np.any([x[1:] != x[:-1] for x in keys], axis=0)) + 1
            for start, end in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
                if start == end:
                    continue
                here = tuple(int(x[start]) for x in keys[:3])
                if here != key:
                    yield from ended()
                    key, asked, cell = here, [], None
                part = batch.slice(start, end - start)
                if keys[3][start] == 0:
                    asked.append(part)
                    continue
                if asked:
                    cell, asked = make(Queries(asked)), []
                if cell is not None:
                    cell.offer(np.array(part.column(5).to_pylist(), np.int64), part.column(7).to_pylist(), matrix(part.column(6).to_pylist()))
        yield from ended()
    return run


def answered(points: DataFrame, queries: DataFrame, make: Callable) -> DataFrame:
    """(row, id, score): for each query `row` what the cells found. `queries` has the columns of `points` and `marks` (array of longs)."""
    blocks = max(1, math.ceil(queries.count() / BLOCK))
    groups = max(GROUPS, math.ceil(points.count() / GROUP))

    def dealt(rows: DataFrame, side: int, marks: Column, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return rows.select("width", F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int").alias(own),
                           F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other), F.lit(side).alias("side"),
                           "row", "id", "vector", "label", marks.cast("array<long>").alias("marks"))

    columns = ["width", "group", "block", "side", "row", "id", "vector", "label", "marks"]
    both = (dealt(queries, 0, F.col("marks"), "block", blocks, "group", groups).select(columns)
            .unionAll(dealt(points, 1, F.lit(None), "group", groups, "block", blocks).select(columns)))
    return (both.repartition(groups * blocks, "width", "group", "block").sortWithinPartitions("width", "group", "block", "side")
            .mapInArrow(_over_cells(make), "row long, id long, score long"))
