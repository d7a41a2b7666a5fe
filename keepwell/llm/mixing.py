"""Mixing sources to target weights: whole documents, repeated floor(rate) times plus one hash-seeded Bernoulli copy.

Sizes are words. Sources in code-point order (null last) weigh 3, 1, 2 and so on; together the targets are `share` of all
words. A target is at most `most` times its source; what is above is dealt again by weight to the others until no target
is above, which is the same as filling all sources to one level of target / weight, so it is computed from running sums
over the sources ordered by the level at which each is full. A document's rate is target / source words.

The Bernoulli draw compares a hash of seed, id and text with the fraction. Of SEEDS fixed seeds, each source uses the one
whose draws bring its taken words nearest to its target: still one draw per document, and reruns agree.

Null or empty texts have size 0 and are taken as often as any other text of the source. Repeated rows draw alike, and so do
rows with equal id and text; sources that are equally far from full go by code point. The choice among seeds is made for a source
as a whole: a document's own chance to be copied stays the fraction up to what one draw in SEEDS can shift. A text of any
length is one row and is never cut. Sources without words have target 0 and rate 0. An empty table gives none. Columns with
names that are used here stay what they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.session import stored

WEIGHTS, SHARE, MOST, SEEDS = (3, 1, 2), 1.5, 2, 32
SPAN = 2 ** 24


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(digest: Column, seed: int | Column) -> Column:
    """A number in [0, 1) with 24 bits."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.conv(F.substring(F.md5(F.concat_ws(":", seed.cast("string"), digest)), 1, 6), 16, 10).cast("long") / F.lit(SPAN)


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size) -> with target and rate. One row per source: a small table."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    full = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy()) * share
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # were all sources that fill up before this one full, the rest would stand at this level
    leveled = full.withColumn("level", (total - before) / after)
    return (leveled.withColumn("above", F.col("level") >= F.col("cap") / F.col("weight"))
            .withColumn("level", F.min(F.when(~F.col("above"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(Window.partitionBy())["level"])
            .withColumn("target", F.when(F.col("above"), F.col("cap")).otherwise(F.col("level") * F.col("weight")).cast("double"))
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
            .select("source", "source_size", "target", "rate"))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def digest(id_col: str, text_col: str) -> Column:
    return F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def copies(key: Column) -> Column:
    """Times a document is taken, beside the columns of `plan`."""
    return F.floor("rate") + (draw(key, F.col("seed")) < F.col("rate") - F.floor("rate")).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(text_col).alias("size"),
                              digest(id_col, text_col).alias("digest")), "mixing-sizes")


def plan(sized: DataFrame) -> DataFrame:
    """(source, source_size, target, rate, seed): one row per source, written, so joins broadcast it by its known size."""
    per_source = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "mixing-targets")
    rated = sized.alias("d").join(per_source.alias("s"), _same("d", "s")).select("d.*", "s.source_size", "s.target", "s.rate")
    fraction = F.col("rate") - F.floor("rate")
    taken = [F.sum(F.when(draw(F.col("digest"), k) < fraction, F.col("size")).otherwise(0)).alias(f"taken{k}") for k in range(SEEDS)]
    off = lambda k: F.abs(F.col(f"taken{k}") + F.floor("rate") * F.col("source_size") - F.col("target"))
    nearest = F.array_min(F.array(*[F.struct(off(k).alias("off"), F.lit(k).alias("seed")) for k in range(SEEDS)]))
    return stored(rated.groupBy("source", "source_size", "target", "rate").agg(*taken)
                  .select("source", "source_size", "target", "rate", nearest["seed"].alias("seed")), "mixing-plan")


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source, source_size, target, rate, copies, taken) of every row."""
    sized = sizes(docs, id_col, text_col, source_col)
    drawn = sized.alias("d").join(plan(sized).alias("s"), _same("d", "s")).select("d.*", "s.source_size", "s.target", "s.rate", "s.seed")
    return (drawn.withColumn("copies", copies(F.col("digest"))).withColumn("taken", F.col("copies") * F.col("size"))
            .drop("digest", "seed"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """`docs`, each row as often as the mix takes it, its copies numbered from 0 in `copy_no`. Texts don't move. Columns of `docs` may
    have any name; one named `copy_no` is replaced."""
    kept = [c for c in docs.columns if c != "copy_no"]
    per_source = plan(sizes(docs, id_col, text_col, source_col)).select("source", "rate", "seed").alias("s")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(source_col).alias("source"), digest(id_col, text_col).alias("key")).alias("d")
    taken = rows.join(per_source, _same("d", "s")).withColumn("times", copies(F.col("key"))).where("times > 0")
    return taken.select("row.*", F.explode(F.sequence(F.lit(0), F.col("times").cast("int") - 1)).alias("copy_no"))
