"""Churn classifiers, scoring, risk bands and per-customer reasons, all as distributed transforms."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.functions.exact import correlation
from keepwell.functions.ordering import order_statistics
from keepwell.operators.features import FEATURES, LABEL

# The label is defined by recency and order count, so neither may be an input.
LABEL_INPUTS = ("recency_days", "total_orders")
MODEL_FEATURES = tuple(f for f in FEATURES if f not in LABEL_INPUTS)
TRAIN_SHARE, SEED = 0.7, 42
DIGITS = 12  #: of a probability that count when scores are ranked; the rest depends on the order of a sum
# fixed values: upper ends of the right-closed probability bands
BANDS = ((0.25, "Low"), (0.50, "Medium"), (0.75, "High"), (1.0, "Critical"))


# ---------------------------------------------------------------- split
def hash_position(key: str, seed: int = SEED) -> Column:
    """52 bits of md5 as a number: the same on every engine and in every run."""
    digest = F.md5(F.concat(F.col(key), F.lit(f"#{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def stratified_split(df: DataFrame, key: str = "customer_id", label: str = LABEL, share: float = TRAIN_SHARE,
                     seed: int = SEED) -> DataFrame:
    """Adds `split`: in every class the `share` with the smallest hash positions is for training.

    The cut is the exact order statistic of each class, so no class is sorted in one place.
    """
    placed = df.withColumn("_place", hash_position(key, seed))

    def cut(value: int) -> Column:
        found = order_statistics(placed.where(F.col(label) == value), "_place", [share])
        return F.lit(int(found[0][0]) if found else -1)
    limit = F.when(F.col(label) == 1, cut(1)).otherwise(cut(0))
    return placed.withColumn("split", F.when(F.col("_place") <= limit, "train").otherwise("test")).drop("_place")


def balanced(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Weight n / (2 n_class) per row."""
    n = df.agg(F.struct(F.count(F.lit(1)).alias("all"), F.count_if(F.col(label) == 1).alias("pos")).alias("n")).scalar()
    own = F.when(F.col(label) == 1, n["pos"]).otherwise(n["all"] - n["pos"])
    return df.withColumn("weight", F.try_divide(n["all"], 2 * own))


def positive_weighted(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Weight negatives / positives on the positive rows, 1 elsewhere."""
    n = df.agg(F.struct(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).alias("n")).scalar()
    return df.withColumn("weight", F.when(F.col(label) == 1, F.try_divide(n["neg"], n["pos"])).otherwise(F.lit(1.0)))


# ---------------------------------------------------------------- models
def _with(classifier) -> Pipeline:
    classifier.setFeaturesCol("features").setLabelCol(LABEL).setWeightCol("weight")
    return Pipeline(stages=[VectorAssembler(inputCols=list(MODEL_FEATURES), outputCol="features"), classifier])


def logistic(iterations: int = 1000) -> Pipeline:
    return _with(LogisticRegression(maxIter=iterations))


def random_forest(trees: int = 100, seed: int = SEED) -> Pipeline:
    return _with(RandomForestClassifier(numTrees=trees, seed=seed))


def boosted_trees(rounds: int = 300, depth: int = 6, step: float = 0.05, seed: int = SEED) -> Pipeline:
    return _with(GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed))


def fit_baselines(train: DataFrame, trees: int = 100) -> dict[str, PipelineModel]:
    """The two class-balanced models the boosted trees are measured against."""
    even = balanced(train).cache()
    try:
        return {"logistic_regression": logistic().fit(even), "random_forest": random_forest(trees).fit(even)}
    finally:
        even.unpersist()


def fit_boosted(train: DataFrame, rounds: int = 300) -> PipelineModel:
    positive = positive_weighted(train).cache()
    try:
        return boosted_trees(rounds).fit(positive)
    finally:
        positive.unpersist()


def probability(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds `churn_probability`; the model's working columns are dropped."""
    scored = model.transform(df).withColumn("churn_probability", vector_to_array("probability")[1])
    return scored.select(*df.columns, "churn_probability")


def auc(scored: DataFrame, score: str = "churn_probability", label: str = LABEL) -> float:
    """Exact area under the ROC curve: no binning, so ties and ranks count fully."""
    return BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, numBins=0).evaluate(scored)


def compare_models(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """AUC per model, best first."""
    def ranked(model):
        return probability(model, test).withColumn("churn_probability", F.round("churn_probability", DIGITS))
    rows = [(name, float(auc(ranked(m)))) for name, m in models.items()]
    best = max(rows, key=lambda r: r[1])[0]
    return test.sparkSession.createDataFrame([(n, a, n == best) for n, a in rows], "model string, auc double, is_best boolean") \
        .orderBy(F.desc("auc"))


def save(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- bands and reasons
def risk_band(p: Column) -> Column:
    """[0, .25] Low, (.25, .5] Medium, (.5, .75] High, (.75, 1] Critical; null outside [0, 1]."""
    arms = [F.when((p >= 0) & (p <= top), name) for top, name in BANDS]
    return F.coalesce(*arms)


def feature_means(df: DataFrame) -> list[float]:
    """Mean of every model feature: twelve numbers."""
    return [float(m) for m in df.agg(*[F.avg(F.col(f).cast("double")) for f in MODEL_FEATURES]).first()]


def replaced_by_mean(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Effect of each feature: probability minus the probability with that feature at its mean.

    Long form (customer_id, feature, value, delta). A customer's thirteen probabilities are columns of one row, so a row is scored
    where it lies: nothing is multiplied by features, moved or regrouped before the effects are listed. This is not a
    Shapley value: interactions are credited to every feature that takes part in them.
    """
    n, classifier = len(MODEL_FEATURES), model.stages[-1]
    means = feature_means(df)
    x = [F.col(f"x{i}") for i in range(n)]
    scored = df.select("customer_id", *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(MODEL_FEATURES)])
    for i in range(n + 1):  # variant n changes nothing and is the customer's own probability
        variant = F.array(*[F.lit(means[j]) if j == i else x[j] for j in range(n)])
        own = classifier.copy({classifier.featuresCol: "_features", classifier.probabilityCol: f"_p{i}", classifier.rawPredictionCol: "", classifier.predictionCol: ""})
        scored = own.transform(scored.withColumn("_features", array_to_vector(variant))).withColumn(f"p{i}", vector_to_array(f"_p{i}")[1]).drop("_features", f"_p{i}")
    entries = F.array(*[
        F.struct(F.lit(i).alias("feature_no"), F.lit(f).alias("feature"), x[i].alias("value"), (F.col(f"p{n}") - F.col(f"p{i}")).alias("delta"))
        for i, f in enumerate(MODEL_FEATURES)])
    return scored.select("customer_id", F.inline(entries))


def linear_effects(df: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Exact effects of a linear score: weight x (value - mean), long form."""
    means = feature_means(df)
    entries = F.array(*[
        F.struct(F.lit(i).alias("feature_no"), F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                 (F.lit(float(weights[f])) * (F.col(f).cast("double") - F.lit(means[i]))).alias("delta"))
        for i, f in enumerate(MODEL_FEATURES)])
    return df.select("customer_id", F.inline(entries))


def logistic_weights(model: PipelineModel) -> dict[str, float]:
    return dict(zip(MODEL_FEATURES, [float(w) for w in model.stages[-1].coefficients], strict=True))


def linear_probability(weights: dict[str, float], intercept: float, df: DataFrame) -> DataFrame:
    """(customer_id, label, probability) of a logistic model from its weights alone."""
    margin = sum((F.lit(w) * F.col(f).cast("double") for f, w in weights.items()), F.lit(float(intercept)))
    return df.select("customer_id", LABEL, (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias("probability"))


def top_reason(effects: DataFrame) -> DataFrame:
    """Feature with the largest absolute effect per customer; the earlier feature wins a tie."""
    best = F.max(F.struct(F.abs("delta").alias("size"), (-F.col("feature_no")).alias("first"), "feature"))
    return effects.groupBy("customer_id").agg(best["feature"].alias("top_churn_reason"))


def importance(effects: DataFrame) -> DataFrame:
    """Mean absolute effect per feature and whether larger values raise the risk."""
    return effects.groupBy("feature").agg(
        F.avg(F.abs("delta")).alias("mean_effect"), correlation("value", "delta").alias("direction")).orderBy(F.desc("mean_effect"))


def predictions(scored: DataFrame, reasons: DataFrame, as_of: Column) -> DataFrame:
    """The prediction table: probability, band, main reason and date per customer."""
    return (scored.select("customer_id", "churn_probability")
            .join(reasons, "customer_id", "left")
            .withColumns({"churn_risk_band": risk_band(F.col("churn_probability")), "scored_date": as_of}))
