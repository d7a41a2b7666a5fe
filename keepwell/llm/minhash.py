"""Near-duplicate texts by b-bit MinHash.

Each text is its set of distinct word shingles. 96 minima are taken per set; 24 bands of 4 of them give candidate
buckets, and of each minimum only 4 bits stay, packed into six 64-bit numbers. Equal lanes of two signatures are counted
with bit operations; since unequal minima agree in 4 bits with probability 1/16, the share of equal lanes E stands for a
similarity of (E - 1/16) / (1 - 1/16). Candidates whose estimate is below the threshold less 0.2 (over 4.5 standard
deviations) go; the rest are confirmed on the full sets. A pair at similarity 0.8 shares no bucket with probability
(1 - 0.8^4)^24 = 3e-6.

No bucket is expanded into all its pairs. Texts with the same set form one class. In a bucket, every class is first
compared with the smallest one; then only classes that are still in different components are compared, in blocks of bounded
size. Signatures decide which rows of a block need their texts; what a block returns is a spanning forest of its links.

Classes are told by their sets, never by an id: an id with several texts is one document in all their classes, linked through
each of them, and which one confirms a link does not depend on the order of rows.

Nulls: a null text is an empty one; an empty set links with nothing. A null id gets a null component and is kept. Repeated
rows are one document. A very long text is hashed in one task, a slice of a batch at a time, and only its row of numbers
moves until it has to confirm a link. An empty table gives no rows. Only the two named columns are read, so others may
have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.components import connected_components
from keepwell.llm.hashing import SPACED, Words, list_column, mixed, shingles, signed, text_slices
from keepwell.session import stored

MINIMA, ROWS, BITS = 96, 4, 4  #: minima per set, minima per band, bits kept of each
BANDS, LANES = MINIMA // ROWS, 64 // BITS
MARGIN = 0.2
BLOCK = 1024  #: classes of a bucket compared at a time; also texts confirmed against one in a task

_RNG = np.random.Generator(np.random.PCG64(7))
_FACTORS = _RNG.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _RNG.integers(0, 2**63, MINIMA, dtype=np.uint64)
_LOW = np.uint64(0x1111111111111111)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer than k words is one shingle."""
    words = Words(data, offsets, SPACED)
    runs, out = shingles(words.hash, k), []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(runs[a:b - k + 1]))
        else:
            out.append(shingles(words.hash[a:b], b - a) if b > a else runs[:0])
    return out


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Packed low bits (texts x 6) and band keys (texts x 24) of non-empty sets."""
    values = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets[:-1])])
    minima = np.empty((MINIMA, len(sets)), np.uint64)
    for j in range(MINIMA):
        minima[j] = np.minimum.reduceat(values * _FACTORS[j] + _ADDED[j], first)
    minima = mixed(minima)
    lanes = (minima >> np.uint64(64 - BITS)).reshape(MINIMA // LANES, LANES, -1)
    packed = np.zeros((MINIMA // LANES, len(sets)), np.uint64)
    for i in range(LANES):
        packed |= lanes[:, i] << np.uint64(BITS * i)
    bands = np.zeros((BANDS, len(sets)), np.uint64)
    for i in range(ROWS):
        bands = mixed(bands + minima.reshape(BANDS, ROWS, -1)[:, i])
    bands = mixed(bands + np.arange(BANDS, dtype=np.uint64)[:, None])
    return packed.T.copy(), bands.T.copy()


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(1)):
                sets = shingle_sets(data, offsets, k)
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                sums, other = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
                per_sig, per_band = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
                sig = bands = np.zeros((0, 0), np.uint64)
                if len(full):
                    held = [sets[i] for i in full]
                    values, first = np.concatenate(held), np.cumsum([0, *(len(s) for s in held[:-1])])
                    sums[full] = np.add.reduceat(values, first)
                    other[full] = np.add.reduceat(mixed(values + np.uint64(99)), first)
                    sig, bands = signatures(held)
                    per_sig[full], per_band[full] = sig.shape[1], bands.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(sets)), batch.column(2).slice(row, len(sets)), pa.array(n), pa.array(signed(sums)), pa.array(signed(other)),
                     list_column(signed(sig.ravel()), np.concatenate([[0], np.cumsum(per_sig)]), pa.int64()),
                     list_column(signed(bands.ravel()), np.concatenate([[0], np.cumsum(per_band)]), pa.int64())],
                    names=["id", "digest", "n", "set_a", "set_b", "sig", "bands"])
    return run


def sign(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    return _digested(docs, id_col, text_col).mapInArrow(
        _sign(words), "id long, digest string, n long, set_a long, set_b long, sig array<long>, bands array<long>")


def _digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, digest): the digest tells an id's texts apart."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.md5(F.col(text_col)).alias("digest"))


def least_lanes(threshold: float) -> int:
    """Equal lanes that a candidate needs."""
    chance = 2.0 ** -BITS
    return int(np.ceil(MINIMA * ((threshold - MARGIN) * (1 - chance) + chance)))


def _equal_lanes(a: str, b: str):
    """Equal lanes of two packed signatures, by bit counts."""
    unequal = F.lit(0)
    for i in range(MINIMA // LANES):
        z = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        for shift in (1, 2):
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
        unequal = unequal + F.bit_count(z.bitwiseAND(F.lit(int(_LOW))))
    return F.lit(MINIMA) - unequal


def _sized(a: str, b: str, percent: int):
    """Sets this different in size can't reach the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _confirm(k: int, percent: int):
    """Rows (a, salt, role, b, text), a group's own text first: pairs that reach the threshold on the full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, key = None, None
        for batch in batches:
            a, role, b = (batch.column(i).to_pylist() for i in range(3))
            left, right = [], []
            for row, data, offsets in text_slices(batch.column(3)):
                for i, s in enumerate(shingle_sets(data, offsets, k), row):
                    if role[i] == 0:
                        own, key = s, a[i]
                        continue
                    assert key == a[i], "a group's own text comes first"
                    both = len(np.intersect1d(own, s, assume_unique=True))
                    if both and 100 * both >= percent * (len(own) + len(s) - both):
                        left.append(a[i])
                        right.append(b[i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
    return run


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold. Pairs meet by a, at most BLOCK to a group, so a text that many others
    are compared with moves once per group and not once per pair. texts: (id, text), ids unique."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("groups"))
    dealt = pairs.join(sizes, "a").select("a", F.pmod(F.xxhash64("b"), "groups").alias("salt"), F.lit(1).alias("role"), "b")
    heads = dealt.groupBy("a", "salt").agg(F.lit(0).alias("role")).select("a", "salt", "role", F.col("a").alias("b"))
    rows = dealt.unionByName(heads).join(texts.withColumnRenamed("id", "b"), "b")
    return (rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
            .select("a", "role", "b", "text").mapInArrow(_confirm(words, percent), "a long, b long"))


def _survivors(rows: dict[str, np.ndarray], least: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one block of a bucket, the pairs of different components that may reach the threshold, each only in the first
    band that it shares."""
    side, comp, n, sig, bands, band = (rows[c] for c in ("side", "component", "n", "sig", "bands", "band"))
    left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
    if side[0] and (side == side[0]).all():
        return left[:0], right[:0]
    unequal = np.zeros((len(left), len(right)), np.uint8)
    for c in range(sig.shape[1]):
        z = sig[left, c][:, None] ^ sig[right, c][None, :]
        z |= z >> np.uint64(1)
        z |= z >> np.uint64(2)
        unequal += np.bitwise_count(z & _LOW)
    x, y = np.nonzero((unequal <= MINIMA - least) & (comp[left][:, None] != comp[right][None, :]))
    x, y = left[x], right[y]
    if side[0] == 0:
        x, y = x[x < y], y[x < y]
    fits = np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent
    x, y = x[fits], y[fits]
    if len(x) and band[0]:
        first = ~(bands[x, :band[0]] == bands[y, :band[0]]).any(axis=1)
        x, y = x[first], y[first]
    return x, y


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that hold one block each, of rows sorted by (key, i, j)."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        keys = np.stack([table.column(c).to_numpy() for c in range(3)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
            yield table.slice(a, b - a)
        rest = table.slice(cuts[-1] if len(cuts) else 0)
    if rest is not None and rest.num_rows:
        yield rest


def _arrays(table: pa.Table) -> dict[str, np.ndarray]:
    out = {c: table.column(c).to_numpy() for c in ("side", "component", "n", "band")}
    for c, width in (("sig", MINIMA // LANES), ("bands", BANDS)):
        out[c] = table.column(c).combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, width)
    return out


def _filtered(least: int, percent: int):
    """Blocks -> their rows that are in any surviving pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            if table.num_rows > 1:
                x, y = _survivors(_arrays(table), least, percent)
                if len(x):
                    yield from table.take(pa.array(np.union1d(x, y))).combine_chunks().to_batches()
    return run


def _exact(k: int, least: int, percent: int):
    """Blocks with texts -> a spanning forest of the links among their surviving pairs, confirmed on the full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            x, y = _survivors(_arrays(table), least, percent)
            sets: list[np.ndarray] = []
            for _, data, offsets in text_slices(table.column("text")):
                sets += shingle_sets(data, offsets, k)
            sizes = np.array([len(s) for s in sets])
            _, ids = np.unique(np.concatenate(sets), return_inverse=True)
            at = np.concatenate([[0], np.cumsum(sizes)])
            mine, parent, found = np.zeros(ids.max() + 1, bool), list(range(len(sets))), []

            def root(i: int, parent=parent) -> int:
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            for i in np.unique(x).tolist():
                others = y[x == i]
                mine[ids[at[i]:at[i + 1]]] = True
                for j in others.tolist():
                    if root(i) != root(j):
                        both = int(mine[ids[at[j]:at[j + 1]]].sum())
                        if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                            parent[root(j)] = root(i)
                            found.append((i, j))
                mine[ids[at[i]:at[i + 1]]] = False
            if found:
                names = table.column("id").to_numpy()
                i, j = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(names[i]), pa.array(names[j])], names=["a", "b"])
    return run


BLOCK_SCHEMA = "key long, i int, j int, id long, side int, component long, n long, band int, sig array<long>, bands array<long>"


def cross_links(members: DataFrame, classes: DataFrame, component: DataFrame, texts: DataFrame, words: int, threshold: float,
                percent: int) -> DataFrame:
    """Links (a, b) between classes that share a bucket but lie in different components so far.

    Blocks first meet with signatures alone; only rows in a surviving pair move again, with their texts. Pairs never leave
    a block: of its links it returns a spanning forest."""
    placed = members.join(component, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed_buckets = (placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                               F.count("*").alias("size"))
                     .where("low < high").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    rows = (placed.join(mixed_buckets, "key").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .join(classes.select("id", "n", "sig", "bands"), "id"))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    met = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", side.alias("side"),
                      "component", "n", "band", "sig", "bands")
    least = least_lanes(threshold)
    # rows of a block's two sides that survive keep their order and side, so blocks can be told apart again
    left = stored(met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
                  .mapInArrow(_filtered(least, percent), BLOCK_SCHEMA), "minhash-blocks")
    full = left.join(texts, "id").select(*[c.split()[0] for c in BLOCK_SCHEMA.split(", ")], "text")
    return (full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
            .mapInArrow(_exact(words, least, percent), "a long, b long"))


def near_duplicates(docs: DataFrame, words: int = 5, threshold: float = 0.8, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of `docs`; see the module's docstring."""
    percent = round(threshold * 100)
    signed_docs = stored(sign(docs, id_col, text_col, words), "minhash-signed")
    held = signed_docs.where("n > 0 and id is not null")
    sets = held.groupBy("set_a", "set_b", "n").agg(F.min(F.struct("id", "digest")).alias("one"), F.max("id").alias("last"))
    # a class has a number of its own, given when it is written
    sets = stored(sets.select(F.monotonically_increasing_id().alias("class"), "set_a", "set_b", "n", F.col("one.id").alias("first"),
                              F.col("one.digest").alias("digest"), "last"), "minhash-classes")
    classes = held.join(sets.select("class", "set_a", "set_b", "n", F.col("first").alias("id"), "digest"), ["id", "digest", "set_a", "set_b", "n"])
    classes = stored(classes.dropDuplicates(["class"]).select(F.col("class").alias("id"), "n", "sig", "bands"), "minhash-representatives")

    keyed = classes.select("id", F.posexplode("bands").alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("size")).where("size > 1").select("key", "hub")
    members = stored(keyed.join(shared, "key"), "minhash-members")
    in_bucket = members.select(F.col("id").alias("class")).distinct().join(sets, "class").select("class", F.col("first").alias("id"), "digest")
    texts = _digested(docs, id_col, text_col).join(in_bucket, ["id", "digest"])
    texts = stored(texts.dropDuplicates(["class"]).select(F.col("class").alias("id"), "text"), "minhash-texts")

    signature = classes.select("id", "n", "sig")
    hubs = (members.where("id != hub").select("hub", "id").distinct()
            .join(signature.select("id", F.col("n").alias("n_b"), F.col("sig").alias("sig_b")), "id")
            .join(signature.select(F.col("id").alias("hub"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a")), "hub")
            .where(_sized("n_a", "n_b", percent)).withColumn("lanes", _equal_lanes("sig_a", "sig_b"))
            .where(F.col("lanes") >= least_lanes(threshold)))
    nearest = hubs.groupBy(F.col("id").alias("b")).agg(F.max(F.struct("lanes", "hub")).alias("best")).select(F.col("best.hub").alias("a"), "b")
    links = stored(confirmed(nearest, texts, words, percent), "minhash-links")

    component = connected_components(links)
    more = stored(cross_links(members.select("key", "band", "id"), classes, component, texts, words, threshold, percent), "minhash-cross-links")
    # an id with several texts ties their classes together
    several = held.groupBy("id").agg(F.min(F.struct("set_a", "set_b", "n")).alias("a"), F.max(F.struct("set_a", "set_b", "n")).alias("z")).where("a != z")
    of_several = held.join(several.select("id"), "id", "left_semi").select("id", "set_a", "set_b", "n").distinct().join(
        sets.select("class", "set_a", "set_b", "n"), ["set_a", "set_b", "n"])
    tied = stored(of_several.join(of_several.groupBy("id").agg(F.min("class").alias("a")), "id").where("a != class").select("a", F.col("class").alias("b")), "minhash-tied")
    component = connected_components(links.unionByName(more).unionByName(tied))

    placed = sets.join(component.withColumnRenamed("id", "class"), "class", "left").withColumn("group", F.coalesce("component", "class"))
    lowest = placed.where("component is not null").groupBy("group").agg(F.min("first").alias("component"))
    placed = (placed.drop("component").join(lowest, "group", "left").where("component is not null or first < last")
              .select("set_a", "set_b", "n", F.coalesce("component", "first").alias("component")))
    out = signed_docs.select("id", "n", "set_a", "set_b").join(placed, ["set_a", "set_b", "n"], "left")
    component_id = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select("id", F.col("n").alias("n_shingles"), component_id.alias("component_id"),
                      F.coalesce(F.col("id") == component_id, F.lit(True)).alias("kept"))
