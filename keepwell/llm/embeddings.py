"""Near-duplicate vectors: random-hyperplane sign codes in several tables, exact cosine, connected components.

A table holds the signs of `bits` projections; two vectors at the least cosine agree in one sign with probability
p = 1 - acos(cosine) / pi, and share a table's code with p^bits. `bits` grows with the logarithm of the number of
vectors, so buckets of unrelated vectors keep their size, and the number of tables follows from `miss`, the chance
to miss a pair that is exactly at the threshold (pairs above it are missed less often).

A bucket is compared in blocks of at most BLOCK vectors, so no task holds a whole hot bucket, and pairs don't leave a
block: it returns link counts per vector and a spanning forest of its links. A pair that meets in several tables counts
in the first of them, which both sides' codes tell. Identical vectors are one class with a weight.

Nulls, zero vectors, non-finite components and null components link with nothing; vectors of different lengths never
link. A null id gets a null component and is kept. A repeated id stays as it is: one row each, links counted per row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.components import connected_components
from keepwell.session import stored

COSINE, MISS, BLOCK = 0.9, 5e-4, 1024


def plan(n: int, cosine: float, miss: float) -> tuple[int, int]:
    """(bits, tables) for n vectors."""
    bits = min(30, max(6, math.ceil(math.log2(max(n, 2) / 64))))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - agree))


def _planes(width: int, count: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([11, width])).standard_normal((width, count))


def _codes(bits: int, tables: int):
    """(class, bytes of a vector) -> (class, vector, codes): one code per table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (np.int64(1) << np.arange(bits, dtype=np.int64))
        for batch in batches:
            raw = batch.column(1).to_pylist()
            widths = np.array([len(x) for x in raw]) // 8
            codes = np.zeros((len(raw), tables), np.int32)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                vectors = np.stack([np.frombuffer(raw[i], "<f8") for i in at])
                vectors /= np.abs(vectors).max(axis=1, keepdims=True)
                signs = (vectors @ _planes(int(width), bits * tables) >= 0).reshape(len(at), tables, bits)
                codes[at] = signs @ weights
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x.tobytes() for x in codes], pa.binary())],
                names=["id", "vector", "codes"])
    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, array of numbers) -> (id, doubles as bytes); null where the vector can't link."""
    for batch in batches:
        column = batch.column(1)
        values = column.flatten().cast(pa.float64())
        numbers = values.to_numpy(zero_copy_only=False)  # nulls become nan
        ends = np.cumsum([n or 0 for n in pa.compute.list_value_length(column).to_pylist()])
        out, at = [], 0
        for end in ends.tolist():
            v = numbers[at:end]
            out.append(v.astype("<f8").tobytes() if len(v) and np.isfinite(v).all() and v.any() else None)
            at = end
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "vector"])


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the links of one block."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    a, b = [], []
    for x, y in zip(left.tolist(), right.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[rx] = ry
            a.append(x)
            b.append(y)
    return a, b


def _linked(cosine: float):
    """Rows (table, code, i, j, side, id, weight, vector, codes) sorted by the first four -> (id, links, a, b)."""
    def compare(table, side, ids, weight, raw, codes):
        unit = np.stack([np.frombuffer(x, "<f8") for x in raw])
        unit = unit / np.abs(unit).max(axis=1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        own = side[0] == 0
        found = []
        for k in range(0, len(left), 256):
            x, y = np.nonzero(unit[left[k:k + 256]] @ unit[right].T >= cosine)
            x, y = left[x + k], right[y]
            if own:
                x, y = x[x < y], y[x < y]
            if table and len(x):
                fresh = ~(codes[x, :table] == codes[y, :table]).any(axis=1)
                x, y = x[fresh], y[fresh]
            found.append((x, y))
        x, y = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        if not len(x):
            return None
        counts = np.bincount(x, weight[y], len(ids)) + np.bincount(y, weight[x], len(ids))
        a, b = _forest(ids[x], ids[y])
        some = np.flatnonzero(counts)
        return ids[some], counts[some].astype(np.int64), a, b

    def emitted(rows):
        width = [len(x) for x in rows["vector"]]
        for w in sorted(set(width)):
            at = [i for i, x in enumerate(width) if x == w]
            if len(at) < 2:
                continue
            side = np.array([rows["side"][i] for i in at])
            if side[0] and (side == side[0]).all() and side.max() > 0 and len(set(side.tolist())) == 1:
                continue
            out = compare(rows["table"][0], side, np.array([rows["id"][i] for i in at], np.int64),
                          np.array([rows["weight"][i] for i in at], np.float64), [rows["vector"][i] for i in at],
                          np.stack([np.frombuffer(rows["codes"][i], np.int32) for i in at]))
            if out:
                ids, counts, a, b = out
                n, m = len(ids), len(a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*ids.tolist(), *[None] * m], pa.int64()), pa.array([*counts.tolist(), *[None] * m], pa.int64()),
                     pa.array([*[None] * n, *a], pa.int64()), pa.array([*[None] * n, *b], pa.int64())], names=["id", "links", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            rows = batch.to_pydict()
            keys = list(zip(rows["table"], rows["code"], rows["i"], rows["j"], strict=True))
            at = 0
            for end in range(1, len(keys) + 1):
                if end == len(keys) or keys[end] != keys[at]:
                    part = {c: v[at:end] for c, v in rows.items()}
                    if keys[at] == key:
                        held = {c: held[c] + v for c, v in part.items()}
                    else:
                        if held:
                            yield from emitted(held)
                        key, held = keys[at], part
                    at = end
        if held:
            yield from emitted(held)
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                 miss: float = MISS) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of `vectors`."""
    packed = stored(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
                    .mapInArrow(_packed, "id long, vector binary"), "vectors")
    usable = packed.where("vector is not null and id is not null").withColumn("digest", F.sha2("vector", 256))
    members = usable.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("weight"))
    members = stored(members, "vector-classes")
    bits, tables = plan(members.count(), cosine, miss)
    classes = (usable.join(members.where("first is not null").withColumnRenamed("first", "id"), ["id", "digest"])
               .dropDuplicates(["id", "digest"]).select("id", "vector", "weight"))
    coded = stored(classes.select("id", "vector").mapInArrow(_codes(bits, tables), "id long, vector binary, codes binary")
                   .join(classes.select("id", "weight"), "id"), "vector-codes")
    code = F.explode(F.array(*[
        F.struct(F.lit(t).alias("table"), F.substring("codes", 4 * t + 1, 4).alias("code")) for t in range(tables)])).alias("at")
    keyed = coded.select("id", code).select("id", "at.table", "at.code")
    sizes = (keyed.groupBy("table", "code").agg(F.count("*").alias("size")).where("size > 1")
             .select("table", "code", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    spread = (keyed.join(sizes, ["table", "code"]).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("table", "code", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"), "id"))
    met = spread.join(coded, "id").select("table", "code", "i", "j", "side", "id", "weight", "vector", "codes")
    found = stored(met.repartition("table", "code", "i", "j").sortWithinPartitions("table", "code", "i", "j", "side")
                   .mapInArrow(_linked(cosine), "id long, links long, a long, b long"), "vector-links")
    component = connected_components(found.where("a is not null").select("a", "b"))
    links = found.where("id is not null").groupBy("id").agg(F.sum("links").alias("links"))

    known = (members.join(links.withColumnRenamed("id", "first"), "first", "left")
             .join(component.withColumnRenamed("id", "first"), "first", "left")
             .where("weight > 1 or links is not null")
             .select("digest", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "first").alias("component")))
    out = packed.withColumn("digest", F.when(F.col("id").isNotNull(), F.sha2("vector", 256))).join(known, "digest", "left")
    component_id = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"),
                      F.coalesce(F.col("id") == component_id, F.lit(True)).alias("kept"))
