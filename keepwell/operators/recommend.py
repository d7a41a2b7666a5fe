"""Implicit-feedback recommendations: ids, temporal split, ALS, popularity fallback and evaluation."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepwell.functions.ordering import numbered
from keepwell.operators.dedup import top_by_key
from keepwell.operators.interactions import COLD_CUSTOMER, purchases

TOP, ALPHA, SEED, TRAIN_SHARE = 10, 40.0, 42, 0.7
CHECKPOINTS = 2  #: iterations of the served model whose shuffle files are held; a fit lets go of them when it checkpoints
# fixed values: the hyper-parameter grid
RANKS, REGULARISATION, ITERATIONS, FOLDS = (10, 20, 50), (0.01, 0.1, 1.0), (10, 20), 3
IDEAL_DCG = sum(1.0 / math.log2(r + 1) for r in range(1, TOP + 1))


# ---------------------------------------------------------------- ids and split
def integer_ids(interactions: DataFrame, key: str, name: str) -> DataFrame:
    """Dense integer per key, by number of interactions descending, then key.

    Keys are numbered by a distributed sort, so neither a task nor the driver holds them all.
    """
    counted = interactions.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return numbered(counted, [F.desc("n"), F.col(key)], name, f"ids_{key}").select(key, F.col(name).cast("int").alias(name))


def with_ids(interactions: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Attach the stored ids. A product in a third of all rows is split by AQE's skew join."""
    return interactions.join(users, "customer_id").join(items, "product_id")


def split_date(interactions: DataFrame, share: float = TRAIN_SHARE) -> Column:
    """First date by which `share` of the dated pairs had happened (counts per day, then a running sum over days)."""
    days = interactions.where("order_date is not null").groupBy("order_date").agg(F.count(F.lit(1)).alias("n"))
    running = days.withColumns({"until": F.sum("n").over(Window.orderBy("order_date")), "all": F.sum("n").over(Window.partitionBy())})
    return running.where(F.col("until") >= F.col("all") * F.lit(share)).agg(F.min("order_date")).scalar()


def temporal_split(interactions: DataFrame, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """Pairs last bought up to the cutoff, and after it; pairs never bought are in neither."""
    return interactions.where(F.col("order_date") <= cutoff), interactions.where(F.col("order_date") > cutoff)


# ---------------------------------------------------------------- model
def als(rank: int = 10, reg: float = 0.01, iterations: int = 10, seed: int = SEED) -> ALS:
    return ALS(userCol="user_idx", itemCol="item_idx", ratingCol="confidence", implicitPrefs=True, coldStartStrategy="drop",
               alpha=ALPHA, seed=seed, rank=rank, regParam=reg, maxIter=iterations)


def rmse_evaluator() -> RegressionEvaluator:
    return RegressionEvaluator(metricName="rmse", labelCol="confidence", predictionCol="prediction")


def tune(train: DataFrame, ranks: Iterable[int] = RANKS, regs: Iterable[float] = REGULARISATION,
         iterations: Iterable[int] = ITERATIONS, folds: int = FOLDS, parallelism: int = 4) -> CrossValidatorModel:
    model = als()
    grid = (ParamGridBuilder().addGrid(model.rank, list(ranks)).addGrid(model.regParam, list(regs))
            .addGrid(model.maxIter, list(iterations)).build())
    return CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=rmse_evaluator(), numFolds=folds,
                          seed=SEED, parallelism=parallelism).fit(train)


def grid_report(tuned: CrossValidatorModel, spark) -> DataFrame:
    rows = [tuple([int(p[k]) if k != "regParam" else float(p[k]) for k in ("rank", "regParam", "maxIter")] + [float(m)])
            for p, m in (({key.name: v for key, v in params.items()}, metric)
                         for params, metric in zip(tuned.getEstimatorParamMaps(), tuned.avgMetrics))]
    return spark.createDataFrame(rows, "rank int, reg double, iterations int, rmse double").orderBy("rmse")


def with_natural_ids(found: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Best items (user, item, rank, score) with natural ids; ids unknown to the mapping drop out."""
    named = found.join(users.withColumn("user", F.col("user_idx").cast("long")), "user").join(items.withColumn("item", F.col("item_idx").cast("long")), "item")
    return named.select("customer_id", "product_id", "rank", F.col("score").alias("als_score"))


# ---------------------------------------------------------------- fallback and output
def popular_products(orders: DataFrame, n: int = TOP) -> Column:
    """The `n` most bought products with their rank, as one array (a scalar subquery of n rows)."""
    top = purchases(orders).groupBy("product_id").agg(F.count("order_id").alias("n")).orderBy(F.desc("n"), "product_id").limit(n)
    return top.agg(F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "product_id"))),
        lambda x, i: F.struct(x["product_id"].alias("product_id"), (i + 1).cast("int").alias("rank")))).scalar()


def popularity_fallback(orders: DataFrame, n: int = TOP) -> DataFrame:
    """The popular products for customers with too few orders to learn from."""
    counts = orders.where("customer_id is not null").groupBy("customer_id").agg(F.count("order_id").alias("n"))
    return counts.where(F.col("n") < COLD_CUSTOMER).select("customer_id", F.inline(popular_products(orders, n))).withColumns(
        {"als_score": F.lit(0.0), "rec_source": F.lit("popularity_fallback")})


def recommendations(model_recs: DataFrame, fallback: DataFrame, as_of: Column, only_missing: bool = False) -> DataFrame:
    """Model rows and fallback rows. `only_missing` keeps the fallback for customers the model did not serve."""
    if only_missing:
        fallback = fallback.join(model_recs.select("customer_id").distinct(), "customer_id", "left_anti")
    return model_recs.withColumn("rec_source", F.lit("als")).unionByName(fallback).withColumn("scored_date", as_of)


def overlap(recs: DataFrame) -> DataFrame:
    """Customers who received both model and fallback rows."""
    both = recs.groupBy("customer_id").agg(F.count_distinct("rec_source").alias("sources"))
    return both.agg(F.count_if(F.col("sources") > 1).alias("customers_with_both"), F.count(F.lit(1)).alias("customers"))


# ---------------------------------------------------------------- evaluation
def evaluate(recs: DataFrame, holdout: DataFrame, rank: str = "rank", catalogue: Column | None = None, n: int = TOP) -> DataFrame:
    """Hits against held-out purchases: hits per user, precision, NDCG and lift over random picks."""
    actual = holdout.select("customer_id", "product_id").distinct()
    found = recs.join(actual.withColumn("hit", F.lit(1)), ["customer_id", "product_id"], "left")
    gain = F.when(F.col("hit") == 1, F.lit(1.0) / F.log2(F.col(rank) + 1))
    per_user = found.groupBy("customer_id").agg(F.count("hit").alias("hits"), F.coalesce(F.sum(gain), F.lit(0.0)).alias("dcg"))
    total = per_user.agg(F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("users"),
                         F.round(F.avg(F.col("dcg") / F.lit(IDEAL_DCG)), 8).alias("ndcg"))
    measures = {"hits_per_user": F.round(F.col("hits") / F.col("users"), 8),
                "precision": F.round(F.col("hits") / (F.col("users") * n), 8)}
    if catalogue is not None:
        measures["random_baseline"] = F.round(F.lit(float(n)) / catalogue, 8)
        measures["lift"] = F.round(F.col("hits") / F.col("users") / (F.lit(float(n)) / catalogue), 6)
    return total.withColumns(measures)


def rank_inversions(recs: DataFrame) -> DataFrame:
    """Rows scored above the row ranked before them: none in a sound table."""
    before = F.lag("als_score").over(Window.partitionBy("customer_id").orderBy("rank"))
    return recs.withColumn("score_before", before).where(F.col("als_score") > F.col("score_before"))


def segment_samples(recs: DataFrame, segments: DataFrame, n: int = 3) -> DataFrame:
    """Top `n` of the last customer id of every segment, as a spot check."""
    chosen = segments.groupBy(F.col("rfm_segment").alias("segment")).agg(F.max("customer_id").alias("customer_id"))
    return recs.where(F.col("rank") <= n).join(chosen, "customer_id").select("segment", "customer_id", "product_id", "rank", "als_score")


def history_ranking(interactions: DataFrame, n: int = TOP) -> DataFrame:
    """A rule-based ranking of each customer's own pairs: strongest signal, latest purchase, product id.

    Deterministic, so the evaluation and re-ranking operators can be checked against SQL on it.
    """
    order = [F.desc("confidence"), F.col("order_date").desc_nulls_last(), F.col("product_id")]
    ranked = top_by_key(interactions, ["customer_id"], order, n, "rank")
    return ranked.select("customer_id", "product_id", "rank", (F.col("confidence") / F.col("rank")).alias("als_score"))
