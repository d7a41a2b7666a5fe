"""RFM segmentation: power transform, k-means with restarts, quality scores, names and priorities."""

from __future__ import annotations

import math
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RFM = ("recency_days", "total_orders", "total_spent")
SCALED = ("recency_scaled", "orders_scaled", "spent_scaled")
K, RESTARTS, SEED = 3, 10, 42
# fixed values
CHAMPIONS, LOYAL, AT_RISK = "Champions", "Loyal Customers", "At Risk"
NAMES_BY_SPEND = (CHAMPIONS, LOYAL, AT_RISK)
CHURN_CUT = 0.5


# ---------------------------------------------------------------- Yeo-Johnson
@dataclass(frozen=True)
class Power:
    lam: float
    mean: float = 0.0
    std: float = 1.0


def _box(x: Column, lam: float | Column) -> Column:
    """((x + 1)^lam - 1) / lam for x >= 0, the logarithm at lam = 0."""
    if isinstance(lam, Column):
        return F.when(lam == 0, F.log1p(x)).otherwise((F.pow(x + 1.0, lam) - 1.0) / lam)
    return F.log1p(x) if lam == 0 else (F.pow(x + 1.0, F.lit(float(lam))) - 1.0) / F.lit(float(lam))


def yeo_johnson(column: str, lam: float | Column) -> Column:
    x = F.col(column).cast("double")
    return F.when(x >= 0, _box(x, lam)).otherwise(-_box(-x, 2.0 - lam))


def inverse_yeo_johnson(y: Column, lam: float) -> Column:
    def unbox(v: Column, power: float) -> Column:
        return F.expm1(v) if power == 0 else F.pow(v * power + 1.0, F.lit(1.0 / power)) - 1.0
    return F.when(y >= 0, unbox(y, lam)).otherwise(-unbox(-y, 2.0 - lam))


def spreads(df: DataFrame, grids: dict[str, list[float]]) -> DataFrame:
    """(place, i, var): variance of the `place`-th column under each power of its grid.

    Powers are rows, not columns: as columns, each would be an aggregate of its own in one method that is too long to be compiled.
    """
    tried = [F.struct(F.lit(place).alias("place"), F.col(c).cast("double").alias("x"), F.array(*[F.lit(round(g, 12)) for g in grid]).alias("grid"))
             for place, (c, grid) in enumerate(grids.items())]
    rows = df.select(F.inline(F.array(*tried))).select("place", "x", F.posexplode("grid").alias("i", "lam"))
    return rows.groupBy("place", "i").agg(F.var_pop(yeo_johnson("x", F.col("lam"))).alias("var"))


def fit_power(df: DataFrame, columns=RFM, low: float = -5.0, high: float = 5.0, points: int = 21, rounds: int = 4) -> dict[str, Power]:
    """Maximum-likelihood lambda per column by a grid that is refined around its best point.

    Each round is one aggregate over the table; only the variances come back.
    log L(lam) = -n/2 ln var(y) + (lam - 1) sum sign(x) ln(|x| + 1)
    """
    grids = {c: [low + i * (high - low) / (points - 1) for i in range(points)] for c in columns}
    step = (high - low) / (points - 1)
    best: dict[str, float] = {}
    measures = []
    for c in columns:
        x = F.col(c).cast("double")
        measures += [F.count(c).alias(f"{c}_n"), F.sum(F.signum(x) * F.log1p(F.abs(x))).alias(f"{c}_s")]
    row = df.agg(*measures).first()
    for _ in range(rounds):
        found = {(r["place"], r["i"]): r["var"] for r in spreads(df, grids).collect()}  # points per column
        for place, c in enumerate(columns):
            def likelihood(i: int, c=c, place=place) -> float:
                var = found.get((place, i))
                if not var or math.isnan(var) or math.isinf(var):
                    return -math.inf
                return -row[f"{c}_n"] / 2.0 * math.log(var) + (grids[c][i] - 1.0) * row[f"{c}_s"]
            best[c] = round(grids[c][max(range(len(grids[c])), key=likelihood)], 12)
            grids[c] = [best[c] + step * (2.0 * i / (points - 1) - 1.0) for i in range(points)]
        step = 2.0 * step / (points - 1)
    moments = df.agg(*[F.struct(F.avg(yeo_johnson(c, best[c])), F.stddev_pop(yeo_johnson(c, best[c]))).alias(c) for c in columns]).first()
    return {c: Power(best[c], moments[c][0], moments[c][1] or 1.0) for c in columns}


def scaled(df: DataFrame, powers: dict[str, Power], columns=RFM, names=SCALED) -> DataFrame:
    """Apply fitted transforms: z-scores of the transformed columns."""
    return df.withColumns({n: (yeo_johnson(c, powers[c].lam) - powers[c].mean) / powers[c].std for c, n in zip(columns, names)})


def unscaled(z: Column, power: Power) -> Column:
    return inverse_yeo_johnson(z * power.std + power.mean, power.lam)


# ---------------------------------------------------------------- clustering
def vectors(df: DataFrame, columns=SCALED) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def best_kmeans(points: DataFrame, k: int = K, restarts: int = RESTARTS, seed: int = SEED, parallelism: int = 4):
    """The cheapest of `restarts` fits. `points` should be cached; the fits share it and run side by side."""
    def fit(i: int):
        return KMeans(k=k, seed=seed + i, featuresCol="features", predictionCol="cluster_id").fit(points)
    with ThreadPool(min(parallelism, restarts)) as pool:
        models = pool.map(fit, range(restarts))
    return min(models, key=lambda m: m.summary.trainingCost)


def silhouette(assigned: DataFrame) -> float:
    """Spark's silhouette uses squared distances, so it reads higher than a plain Euclidean one."""
    return ClusteringEvaluator(featuresCol="features", predictionCol="cluster_id").evaluate(assigned)


def calinski_harabasz(assigned: DataFrame, columns=SCALED, digits: int = 4) -> DataFrame:
    """(between / (k - 1)) / (within / (n - k)) from the variances per cluster and overall."""
    def spread(frame_cols) -> Column:
        return sum((F.var_pop(c) for c in frame_cols), F.lit(0.0)) * F.count(F.lit(1))
    within = (assigned.groupBy("cluster_id").agg(spread(columns).alias("w"))
              .agg(F.struct(F.sum("w").alias("within"), F.count(F.lit(1)).alias("k")).alias("s")).scalar())
    total = assigned.agg(spread(columns).alias("total"), F.count(F.lit(1)).alias("n"))
    score = F.try_divide((F.col("total") - within["within"]) / (within["k"] - 1), within["within"] / (F.col("n") - within["k"]))
    return total.select(within["k"].alias("k"), F.round(within["within"], digits).alias("inertia"),
                        F.round(score, digits).alias("calinski_harabasz"))


def sweep(points: DataFrame, ks=range(2, 11), restarts: int = RESTARTS) -> DataFrame:
    """Inertia, silhouette and Calinski-Harabasz for every k, each on the best of the restarts."""
    rows = []
    for k in ks:
        model = best_kmeans(points, k, restarts)
        assigned = model.transform(points)
        ch = calinski_harabasz(assigned).first()["calinski_harabasz"]
        rows.append((int(k), float(model.summary.trainingCost), float(silhouette(assigned)), float(ch)))
    return points.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, calinski_harabasz double")


def flat_against_hierarchical(points: DataFrame, k: int = K, seed: int = SEED) -> DataFrame:
    """K-means and divisive hierarchical clustering scored on the same rows; the whole table, no sample.

    The points are moved off the origin first: distances stay, but the divisive fit perturbs a centre
    in proportion to its length and could not split a cloud centred exactly on zero.
    """
    points = vectors(points.drop("features").withColumns({c: F.col(c) + 10.0 for c in SCALED})).cache()
    tree = BisectingKMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster_id").fit(points)
    rows = []
    for name, model in (("kmeans", best_kmeans(points, k)), ("hierarchical", tree)):
        assigned = model.transform(points)
        rows.append((name, float(silhouette(assigned)), float(calinski_harabasz(assigned).first()["calinski_harabasz"])))
    best = max(rows, key=lambda r: r[1])[0]
    return points.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows],
                                               "algorithm string, silhouette double, calinski_harabasz double, is_best boolean")


def nearest(df: DataFrame, centers: dict[int, tuple[float, ...]], columns=SCALED) -> DataFrame:
    """Assign rows to given centers; the smaller id wins a tie."""
    def distance(center) -> Column:
        return sum(((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(columns, center)), F.lit(0.0))
    best = F.array_min(F.array(*[F.struct(distance(v).alias("d"), F.lit(i).alias("i")) for i, v in centers.items()]))
    return df.withColumn("cluster_id", best["i"])


# ---------------------------------------------------------------- naming and priority
def centroids(assigned: DataFrame, powers: dict[str, Power]) -> DataFrame:
    """Cluster centers back in days, orders and money; one row per cluster."""
    means = assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("customers"), *[F.avg(c).alias(c) for c in SCALED])
    return means.select("cluster_id", "customers", *[unscaled(F.col(s), powers[c]).alias(c) for c, s in zip(RFM, SCALED)])


def named(centers: DataFrame) -> DataFrame:
    """Names by descending spend of the center, never by cluster number. One row per cluster."""
    place = F.row_number().over(Window.orderBy(F.desc("total_spent"), "cluster_id"))
    names = F.array(*[F.lit(n) for n in NAMES_BY_SPEND])
    return centers.withColumn("rfm_segment", F.get(names, F.least(place, F.lit(len(NAMES_BY_SPEND))) - 1))


def with_names(assigned: DataFrame, powers: dict[str, Power]) -> DataFrame:
    labels = named(centroids(assigned, powers)).select("cluster_id", "rfm_segment")
    return assigned.join(F.broadcast(labels), "cluster_id")  # one row per cluster: k rows


def retention_priority(segment: Column, p: Column) -> Column:
    """An unknown probability counts as below the cut."""
    risky = F.coalesce(p >= CHURN_CUT, F.lit(False))
    return (F.when(segment == CHAMPIONS, F.when(risky, "Urgent").otherwise("High"))
            .when(segment == LOYAL, F.when(risky, "High").otherwise("Medium")).otherwise("Low"))


def segment_table(assigned: DataFrame, churn: DataFrame, algorithm: str, score: float | None, as_of: Column) -> DataFrame:
    """One row per customer: segment, RFM values, churn probability and retention priority."""
    joined = assigned.join(churn.select("customer_id", "churn_probability"), "customer_id", "left")
    return joined.select(
        "customer_id", "rfm_segment", F.col("cluster_id").alias("rfm_cluster_id"), *RFM, F.lit(algorithm).alias("algorithm_used"),
        F.lit(score).cast("double").alias("silhouette_score"), "churn_probability",
        retention_priority(F.col("rfm_segment"), F.col("churn_probability")).alias("retention_priority"), as_of.alias("segmented_date"))


def priority_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("rfm_segment", "retention_priority").agg(F.count(F.lit(1)).alias("customers"))
