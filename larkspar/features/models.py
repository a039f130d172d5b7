"""Model pipelines, parameter search and persistence on MLlib."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    PCA,
    Binarizer,
    HashingTF,
    MinMaxScaler,
    StringIndexer,
    Tokenizer,
    UnivariateFeatureSelector,
    VectorAssembler,
)
from pyspark.ml.param import Param
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspar.session import cut_lineage

PREDICTION = "predictioncol"
WEIGHT = "weight"


def text_classifier(features: int = 1 << 18) -> tuple[Pipeline, LogisticRegression]:
    """Words, hashed term counts, logistic regression."""
    words = Tokenizer(inputCol="text", outputCol="tokentext")
    counts = HashingTF(inputCol="tokentext", outputCol="hashFeatures", numFeatures=features)
    lr = LogisticRegression(labelCol="label", featuresCol="hashFeatures", predictionCol=PREDICTION)
    return Pipeline(stages=[words, counts, lr]), lr


def tree_regressor(threshold: float = 0.5, depth: int = 5, bins: int = 32) -> tuple[Pipeline, DecisionTreeRegressor]:
    """Binarised features, regression tree."""
    binary = Binarizer(inputCol="features", outputCol="features_binarizer", threshold=threshold)
    tree = DecisionTreeRegressor(
        featuresCol="features_binarizer", labelCol="label", predictionCol=PREDICTION, maxDepth=depth, maxBins=bins, seed=1
    )
    return Pipeline(stages=[binary, tree]), tree


def selector(features: str, label: str, out: str, keep: int, categorical: bool) -> UnivariateFeatureSelector:
    """Keep the features most related to the label: chi-square for categories, F-test for numbers.

    The chi-square test counts every distinct value, so it only suits features with few values.
    """
    chosen = UnivariateFeatureSelector(featuresCol=features, outputCol=out, labelCol=label, selectionMode="numTopFeatures")
    chosen.setFeatureType("categorical" if categorical else "continuous").setLabelType("categorical")
    return chosen.setSelectionThreshold(keep)


def measurement_pipeline(label: str, numbers: list[str], keep: int = 1, categorical: bool = False) -> Pipeline:
    """Index the label, assemble, project on two components, scale to [0, 1], select."""
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="classlabel"),
        VectorAssembler(inputCols=numbers, outputCol="features"),
        PCA(inputCol="features", outputCol="pcaFeatures", k=2),
        MinMaxScaler(inputCol="pcaFeatures", outputCol="minmaxFeatures"),
        selector("minmaxFeatures", "classlabel", "selected", keep, categorical),
    ])


def accuracy(label: str = "label", prediction: str = PREDICTION) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="accuracy")


def rmse(label: str = "label", prediction: str = PREDICTION) -> RegressionEvaluator:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse")


def hashed_part(key: str | Column, parts: int) -> Column:
    """A part from 0 to ``parts`` - 1 by a multiplicative hash of an integer key, the same in every run and engine.

    Neighbouring keys fall into different parts, and a row's part does not depend on the other rows.
    """
    spread = F.pmod(F.pmod(F.col(key) if isinstance(key, str) else key, F.lit(1 << 31)) * 2654435761, F.lit(1 << 32))
    return F.pmod(F.shiftright(spread, 16), F.lit(parts)).cast("int")


def hashed_part_sql(key: str, parts: int) -> str:
    return f"CAST(((({key} % 2147483648) * 2654435761) % 4294967296 >> 16) % {parts} AS INTEGER)"


def combined(data: DataFrame, features: str, label: str, fold: str) -> DataFrame:
    """The rows of a fold with equal ``features`` as one or two points with a weight.

    Number, mean and variance of the labels stay the same, and a least-squares tree and a root mean squared error
    depend on nothing else. Features with many different values give no fewer points. Labels that are
    null in some rows stay null, to be refused by the estimator.
    """
    known = F.count(label) == F.count(F.lit(1))
    groups = data.groupBy(fold, features).agg(
        F.count(F.lit(1)).alias("n"), F.when(known, F.avg(label)).alias("mean"), F.stddev_pop(label).alias("spread")
    )
    one = F.array(F.struct(F.col("mean").alias(label), F.col("n").cast("double").alias(WEIGHT)))
    ends = [F.struct((F.col("mean") + sign * F.col("spread")).alias(label), (F.col("n") / 2).alias(WEIGHT)) for sign in (-1, 1)]
    points = F.when(F.col("spread") > 0, F.array(*ends)).otherwise(one)
    return groups.select(fold, features, F.inline(points))


@dataclass
class Search:
    """What a parameter search found: scores per fold and grid point, the best point, and its model on all rows."""

    scores: DataFrame
    best: dict[Param, object]
    best_model: Model

    def means(self) -> DataFrame:
        """Grid points with their mean score over the folds."""
        points = [c for c in self.scores.columns if c not in ("fold", "n_fitted", "n_scored", "score")]
        return self.scores.groupBy(*points).agg(F.avg("score").alias("mean_score"))


def searched(
    estimator: Estimator, grid: list[dict[Param, object]], evaluator: Evaluator, data: DataFrame, fold: str,
    folds: list[int], parallelism: int = 4, weight: str | None = None,
) -> Search:
    """Fit each grid point on the rows outside each of ``folds`` and score it on the rows inside.

    ``fold`` is a column of ``data``, ``weight`` the one that tells how many rows a row stands for. The best point
    has the best mean score, the earliest of equal ones, and is fitted once more on all rows. ``data`` is
    read for each fit and should be stored. The fits beside each other share its partitions out, as
    each partition of a fit sends sums as long as the model in every iteration.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight).cast("long")
    sizes = {r[0]: r[1] for r in data.groupBy(fold).agg(rows).collect()}
    total = sum(sizes.values())
    tasks = [(number, point) for number in folds for point in range(len(grid))]
    shared = data.coalesce(ceil(max(1, data.rdd.getNumPartitions()) / max(1, min(parallelism, len(tasks)))))

    def score(task: tuple[int, int]) -> float:
        number, point = task
        fitted = estimator.fit(shared.where(F.col(fold) != number), grid[point])
        return evaluator.evaluate(fitted.transform(shared.where(F.col(fold) == number), grid[point]))

    with ThreadPool(parallelism) as pool:
        found = dict(zip(tasks, pool.map(inheritable_thread_target(data.sparkSession)(score), tasks)))
    better = max if evaluator.isLargerBetter() else min
    means = [sum(found[number, point] for number in folds) / len(folds) for point in range(len(grid))]
    best = grid[means.index(better(means))]
    names = [p.name for p in grid[0]]
    rows = [
        (number, *[float(v) for v in grid[point].values()], total - sizes.get(number, 0), sizes.get(number, 0), float(s))
        for (number, point), s in found.items()
    ]
    kinds = ", ".join(["fold int", *[f"{n} double" for n in names], "n_fitted long", "n_scored long", "score double"])
    return Search(data.sparkSession.createDataFrame(rows, kinds), best, estimator.fit(data, best))


def cross_validated(
    estimator: Estimator, grid: list[dict[Param, object]], evaluator: Evaluator, data: DataFrame, key: str,
    folds: int = 3, parallelism: int = 4,
) -> Search:
    """k-fold search over folds by the hash of ``key``."""
    parts = data.withColumn("fold", hashed_part(key, folds))
    return searched(estimator, grid, evaluator, parts, "fold", list(range(folds)), parallelism)


def split_validated(
    estimator: Estimator, grid: list[dict[Param, object]], evaluator: Evaluator, data: DataFrame, key: str,
    parts: int = 5, parallelism: int = 4, combine: bool = False,
) -> Search:
    """Search on a single split: one of ``parts`` parts by the hash of ``key`` is scored, the others are fitted.

    ``combine`` is for a regression tree and its root mean squared error on features with few different values:
    all rows are read once and trained on as ``combined`` points.
    """
    split = data.withColumn("fold", hashed_part(key, parts))
    if not combine:
        return searched(estimator, grid, evaluator, split, "fold", [0], parallelism)
    if estimator.getMinInstancesPerNode() > 1:
        raise ValueError("a point stands for many rows, so rows of a node cannot be counted")
    points = cut_lineage(combined(split, estimator.getFeaturesCol(), estimator.getLabelCol(), "fold"))
    tree, error = estimator.copy({estimator.weightCol: WEIGHT}), evaluator.copy({evaluator.weightCol: WEIGHT})
    return searched(tree, grid, error, points, "fold", [0], parallelism, WEIGHT)


def losses(spark: SparkSession, fitted: Model) -> DataFrame:
    """The loss of a fitted classifier before training and after each iteration, as rows (iteration, loss)."""
    rows = [(i, float(x)) for i, x in enumerate(fitted.summary.objectiveHistory)]
    return spark.createDataFrame(rows, "iteration int, loss double")


def saved_and_loaded(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def same_predictions(first: DataFrame, second: DataFrame, id_column: str, prediction: str = PREDICTION) -> DataFrame:
    """Rows scored by both, and how many agree."""
    a = first.select(id_column, F.col(prediction).alias("a"))
    b = second.select(id_column, F.col(prediction).alias("b"))
    return a.join(b, id_column).agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(F.col("a") == F.col("b")).alias("n_equal")
    )
