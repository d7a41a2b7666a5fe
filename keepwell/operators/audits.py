"""Audits of fitted models: whether each output follows from the model and its inputs.

A fitted model can't be recomputed in SQL, but what must hold for its output can be stated: one row per customer or
feature with flags that are all true for a sound model.
"""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepwell.functions.ordering import numbered
from keepwell.operators import churn, retrieval, segments, trees
from keepwell.operators.features import LABEL
from keepwell.session import stored

FLAT = 1e-3  #: largest mean gradient per standard deviation of a feature that counts as none
CLOSE = 1e-9  #: largest difference between two ways to add up the same numbers
NUDGE = 0.01  #: distance at which neighbouring powers are tried


def predictions_follow(predictions: DataFrame, effects: DataFrame, scored: DataFrame) -> DataFrame:
    """Per prediction: probability within [0, 1] and the one that the model's rules give (`scored`), band by quarters, and no
    feature with a larger effect than the reason."""
    p = F.col("churn_probability")
    quarter = F.greatest(F.ceil(p * 4), F.lit(1)).cast("int")
    bands = F.array(*[F.lit(name) for _, name in churn.BANDS])
    sizes = effects.groupBy("customer_id").agg(
        F.max(F.abs("delta")).alias("largest"), F.map_from_entries(F.collect_list(F.struct("feature", F.abs("delta")))).alias("size"))
    own = F.try_element_at("size", F.col("top_churn_reason"))
    return predictions.join(sizes, "customer_id", "left").join(scored, "customer_id", "left").select(
        "customer_id", F.coalesce(p.between(0, 1), F.lit(False)).alias("in_range"),
        F.coalesce(F.abs(p - F.col("probability")) < CLOSE, F.lit(False)).alias("probability_follows"),
        F.coalesce(F.col("churn_risk_band") == F.get(bands, quarter - 1), F.lit(False)).alias("band_follows"),
        F.coalesce(own == F.col("largest"), F.lit(False)).alias("reason_follows"))


def logistic_stationary(model: PipelineModel, train: DataFrame) -> DataFrame:
    """Whether the weighted likelihood is flat at the fitted weights: every mean gradient, in standard deviations of its
    feature, is zero."""
    scored = model.transform(train).withColumn("gap", F.col("weight") * (vector_to_array("probability")[1] - F.col(LABEL)))
    slopes = [F.sum("gap") / F.sum("weight")]
    for f in churn.MODEL_FEATURES:
        x = F.col(f).cast("double")
        slopes.append(F.coalesce(F.try_divide(F.sum(F.col("gap") * x) / F.sum("weight"), F.stddev_pop(x)), F.lit(0.0)))
    return scored.agg(F.count(F.lit(1)).alias("train_rows"), F.greatest(*[F.abs(s) for s in slopes]).alias("slope")).select(
        F.lit("logistic_regression").alias("model"), "train_rows", (F.col("slope") < FLAT).alias("stationary"))


def trees_follow(model: PipelineModel, ensemble: trees.Ensemble, rows: DataFrame, name: str) -> DataFrame:
    """Per customer: whether the rules of the ensemble lead to one leaf of every tree and to the model's probability."""
    ruled = ensemble.probability(rows, ["customer_id"])
    return churn.probability(model, rows).join(ruled, "customer_id", "left").select(
        F.lit(name).alias("model"), "customer_id",
        F.coalesce(F.abs(F.col("probability") - F.col("churn_probability")) < CLOSE, F.lit(False)).alias("follows"))


def rank_auc(scored: DataFrame, score: str = "probability", label: str = LABEL) -> float | None:
    """Area under the ROC curve from mean ranks of a distributed sort; None where a class is missing."""
    placed = numbered(scored.select(F.round(score, churn.DIGITS).alias("score"), F.col(label).alias("label")), [F.col("score")], "place", "auc")
    ties = placed.groupBy("score").agg(F.avg(F.col("place") + 1).alias("mean_rank"), F.count_if(F.col("label") == 1).alias("pos"),
                                       F.count(F.lit(1)).alias("n"))
    total = ties.agg(F.sum(F.col("mean_rank") * F.col("pos")).alias("ranks"), F.sum("pos").alias("pos"), F.sum("n").alias("n")).first()
    pos, neg = total["pos"] or 0, (total["n"] or 0) - (total["pos"] or 0)
    return (total["ranks"] - pos * (pos + 1) / 2) / (pos * neg) if pos and neg else None


def comparison_follows(reported: DataFrame, scored: dict[str, DataFrame]) -> DataFrame:
    """Per model: rows it was tested on, and whether AUC and best model are those of `scored`, the same rows scored anew."""
    found = {name: rank_auc(rows) for name, rows in scored.items()}
    best = max(found, key=lambda name: found[name] or 0.0)
    rows = [(r["model"], scored[r["model"]].count(), abs(r["auc"] - found[r["model"]]) < CLOSE, r["is_best"] == (r["model"] == best))
            for r in reported.collect()]  # a row per model
    return reported.sparkSession.createDataFrame(rows, "model string, test_rows long, auc_follows boolean, best_follows boolean")


def importance_follows(reported: DataFrame, effects: DataFrame, ensemble: trees.Ensemble, rows: DataFrame) -> DataFrame:
    """Per feature: customers, whether each one's effect is the one that the rules give, and whether the importance is their mean."""
    ruled = ensemble.varied(rows, ["customer_id"], churn.feature_means(rows))
    own, changed = F.element_at("probabilities", -1), F.get("probabilities", F.col("feature_no"))
    again = effects.join(ruled, "customer_id", "left").select("feature", "delta", (own - changed).alias("ruled"))
    per_feature = again.groupBy("feature").agg(
        F.count(F.lit(1)).alias("customers"), F.every(F.coalesce(F.abs(F.col("delta") - F.col("ruled")) < CLOSE, F.lit(False))).alias("effects_follow"),
        F.avg(F.abs("ruled")).alias("mean_ruled"))
    return per_feature.join(reported, "feature", "left").select(
        "feature", "customers", "effects_follow",
        F.coalesce(F.abs(F.col("mean_effect") - F.col("mean_ruled")) < CLOSE, F.lit(False)).alias("importance_follows"))


def powers_follow(df: DataFrame, powers: dict[str, segments.Power]) -> DataFrame:
    """Per feature: no higher likelihood at the powers beside the fitted one, and scaled values with mean 0 and deviation 1."""
    rows = []
    for c, power in powers.items():
        x = F.col(c).cast("double")
        tried = [power.lam, power.lam - NUDGE, power.lam + NUDGE]
        z = (segments.yeo_johnson(c, power.lam) - F.lit(power.mean)) / F.lit(power.std)
        n, logs, mean, std, *spread = df.agg(
            F.count(c), F.sum(F.signum(x) * F.log1p(F.abs(x))), F.avg(z), F.stddev_pop(z),
            *[F.var_pop(segments.yeo_johnson(c, lam)) for lam in tried]).first()
        level = [-n / 2 * math.log(v) + (lam - 1) * logs if v else -math.inf for lam, v in zip(tried, spread, strict=True)]
        rows.append((c, n, max(level[1:]) > level[0], abs(mean) < 1e-6 and abs(std - 1) < 1e-6))
    return df.sparkSession.createDataFrame(rows, "feature string, customers long, improvable boolean, standardised boolean")


def segments_follow(table: DataFrame, points: DataFrame, centres: DataFrame) -> DataFrame:
    """Per customer: assigned to the nearest of the model's own centres (cluster_id and the scaled measures, k rows), named by
    the place of the centre's spend, priority by name and risk."""
    listed = centres.agg(F.collect_list(F.struct("cluster_id", *segments.SCALED))).scalar()  # k entries

    def distance(centre):
        return F.sqrt(sum(((F.col(c) - centre[c]) ** 2 for c in segments.SCALED), F.lit(0.0)))
    spend = segments.SCALED[2]
    met = table.join(points.select("customer_id", *segments.SCALED), "customer_id").withColumn("centres", listed)
    mine = F.element_at(F.filter("centres", lambda x: x["cluster_id"] == F.col("rfm_cluster_id")), 1)
    nearest = F.array_min(F.transform("centres", distance))
    richer = F.size(F.filter("centres", lambda x: x[spend] > F.col("mine")[spend]))
    names = F.array(*[F.lit(n) for n in segments.NAMES_BY_SPEND])
    risky = F.coalesce(F.col("churn_probability") >= segments.CHURN_CUT, F.lit(False))
    steps = F.array(F.lit("Low"), F.lit("Medium"), F.lit("High"), F.lit("Urgent"))
    step = F.when(F.col("place") == 2, 0).otherwise(F.lit(2) - F.col("place") + risky.cast("int"))
    return (met.withColumn("mine", mine).withColumn("place", richer).select(
        "customer_id", (distance(F.col("mine")) <= nearest + CLOSE).alias("nearest"),
        (F.col("rfm_segment") == F.get(names, F.col("place"))).alias("name_follows"),
        (F.col("retention_priority") == F.get(steps, step)).alias("priority_follows")))


def recommendations_follow(recs: DataFrame) -> DataFrame:
    """Per customer: source, number of different products, rows ranked first, and rows scored above the row before them."""
    before = F.lag("als_score").over(Window.partitionBy("customer_id").orderBy("rank"))
    return recs.withColumn("before", before).groupBy("customer_id").agg(
        F.array_join(F.array_sort(F.collect_set("rec_source")), "+").alias("rec_source"), F.count_distinct("product_id").alias("offers"),
        F.count_if(F.col("rank") == 1).alias("first_ranks"), F.count_if(F.col("als_score") > F.col("before")).alias("inversions"))


def best_items_follow(found: DataFrame, users: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """Per user: offers, whether each score is the product of the two factor rows, and whether none is better: different items, ranked
    by score, and among all items no more above the last offer than were offered. Fewer than `n` offers must be all items there are."""
    def product(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
    mine = (found.join(users.select(F.col("id").cast("long").alias("user"), F.col("features").alias("u")), "user")
            .join(items.select(F.col("id").cast("long").alias("item"), F.col("features").alias("v")), "item")
            .withColumn("right", F.abs(F.col("score") - product("u", "v")) < CLOSE))
    listed = mine.groupBy("user").agg(
        F.count("item").alias("offers"), F.every(F.coalesce("right", F.lit(False))).alias("right"), F.count_distinct("item").alias("items"),
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("listed"))
    last = F.element_at("listed", -1)["score"]
    slack = F.when(F.col("offers") >= n, F.greatest(F.abs(last), F.lit(1.0)) * F.lit(CLOSE))
    ordered = F.transform("listed", lambda x, i: (x["rank"] == i + 1) & ((i == 0) | (x["score"] <= F.get("listed", i - 1)["score"])))
    judged = stored(users.select(F.col("id").cast("long").alias("user"), "features").join(listed, "user", "left").select(
        "user", "features", F.coalesce("offers", F.lit(0)).alias("offers"), F.coalesce("right", F.lit(False)).alias("right"),
        F.coalesce((F.col("items") == F.col("offers")) & F.forall(ordered, lambda x: x), F.lit(False)).alias("sorted"),
        F.coalesce(last + slack, F.lit(float("-inf"))).alias("bar"),
        F.when(slack.isNull(), F.coalesce("offers", F.lit(0))).otherwise(
            F.size(F.filter("listed", lambda x: x["score"] > last + slack / 2))).cast("long").alias("held")), "best-items-judged")
    more = retrieval.above(judged, retrieval.placed(items, "id"), "user", "bar")
    return judged.join(more, "user", "left").select(
        "user", "offers", F.col("right").alias("scores_follow"),
        (F.col("sorted") & F.coalesce(F.col("above") <= F.col("held"), F.lit(False))).alias("none_better"))
