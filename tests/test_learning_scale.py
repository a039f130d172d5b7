"""Learning queries on own rows: large vectors, whole encodings, training rows stored and combined."""

from __future__ import annotations

from collections import Counter
from functools import partial

import pytest
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from larkspar.catalog import JOBS, learning
from larkspar.features import models
from larkspar.tables import Tables


def tables(spark, tmp_path, **rows) -> Tables:
    """Tables of own rows: name=(rows, schema)."""
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return Tables(spark, str(tmp_path))


def test_hashed_counts_never_make_the_zeros(spark, tmp_path, monkeypatch):
    """2^31 - 1 buckets as an array are 16 GB a row."""
    t = tables(spark, tmp_path, documents=([(1, "a b a"), (2, "one"), (3, ""), (4, "x  y ")], "doc_id long, text string"))
    monkeypatch.setattr(learning, "HashingTF", partial(HashingTF, numFeatures=(1 << 31) - 1))
    got = {r.doc_id: r.total for r in JOBS["ml_hashing_tf"](t).collect()}
    assert got == {1: 3.0, 2: 1.0, 3: 1.0, 4: 3.0}


def test_encodings_are_given_whole(spark, tmp_path):
    """Every place of every encoded vector is a row, also those that are zero."""
    t = tables(spark, tmp_path, events=([(1, "a"), (2, "b"), (3, "a"), (3, "c")], "event_id long, event_type string"))
    got = Counter((r.event_id, r.position, r.hot) for r in JOBS["ml_one_hot"](t).collect())
    places = [(1, 0), (2, 1), (3, 0), (3, 2)]
    assert got == Counter((event, place, float(place == own)) for event, own in places for place in range(3))


def test_tree_search_trains_on_combined_rows(spark, tmp_path, monkeypatch):
    """Before, each of the 17 fits read every line several times."""
    lines = [(i, 900.0 + 733.7 * (i % 137), (i % 11) / 100) for i in range(600)]
    t = tables(spark, tmp_path, lineitem=(lines, "l_orderkey long, l_extendedprice double, l_discount double"))
    seen = []

    def watched(estimator, grid, evaluator, data, *others):
        seen.append(data.count())
        return searched(estimator, grid, evaluator, data, *others)

    searched = models.searched
    monkeypatch.setattr(models, "searched", watched)
    rows = JOBS["ml_tree_search"](t).collect()
    assert len(rows) == 16 and all(r.n_fitted + r.n_scored == 600 and r.scored and r.best_has_best_mean for r in rows)
    assert seen[0] <= 5 * 2 * 2  # folds, different features, points


@pytest.mark.parametrize("values", [2, 7])
def test_combined_rows_give_the_same_trees(spark, values):
    rows = [(i, [float(i % values), float(i // 7 % 2)], 1e4 + 91.5 * (i * i % 53) + 4000.0 * (i % values)) for i in range(400)]
    rows += [(400, [99.0, 1.0], 7.0), *rows[:30]]  # one of its kind, and rows that come twice
    data = spark.createDataFrame(rows, "key long, x array<double>, label double")
    data = data.select("key", "label", array_to_vector("x").alias("x")).cache()
    tree = DecisionTreeRegressor(featuresCol="x", labelCol="label", predictionCol=models.PREDICTION)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [1, 3, 6]).build()
    was, now = (models.split_validated(tree, grid, models.rmse(), data, "key", combine=c) for c in (False, True))
    by_depth = lambda search: {r.maxDepth: (r.n_fitted, r.n_scored, pytest.approx(r.score, rel=1e-9)) for r in search.scores.collect()}
    assert by_depth(was) == {r.maxDepth: (r.n_fitted, r.n_scored, r.score) for r in now.scores.collect()}
    assert list(was.best.values()) == list(now.best.values())
    predicted = lambda search: [r[0] for r in search.best_model.transform(data).orderBy("key").select(models.PREDICTION).collect()]
    assert predicted(was) == pytest.approx(predicted(now), rel=1e-9)


def test_unknown_labels_are_not_combined_away(spark):
    data = spark.createDataFrame([(1, [0.0], 1.0), (1, [0.0], None), (1, [1.0], 2.0)], "fold int, x array<double>, label double")
    points = models.combined(data, "x", "label", "fold").orderBy("x").collect()
    assert [(r.label, r.weight) for r in points] == [(None, 2.0), (2.0, 1.0)]


def test_partitions_of_training_do_not_grow_with_the_rows(spark):
    """Each partition of a fit sends 2 MB per iteration with 2^18 features."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(4000).select("id", (F.col("id") % 2).cast("double").alias("label"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        data = learning.stored(rows)
        assert data.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
        assert data.count() == 4000 and data.distinct().count() == 4000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_fits_beside_each_other_share_the_partitions(spark, monkeypatch):
    data = spark.range(0, 200, 1, 8).select(
        F.col("id").alias("key"), (F.col("id") % 3 % 2).cast("double").alias("label"), array_to_vector(F.array((F.col("id") % 3).cast("double"))).alias("x")
    )
    tree = DecisionTreeRegressor(featuresCol="x", labelCol="label", predictionCol=models.PREDICTION)
    fitted, fit = [], DecisionTreeRegressor.fit
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda self, d, p=None: (fitted.append(d.rdd.getNumPartitions()), fit(self, d, p))[1])
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [1, 2, 3, 4, 5]).build()
    search = models.split_validated(tree, grid, models.rmse(), data, "key")
    assert fitted == [2] * 5 + [8]
    assert {(r.n_fitted + r.n_scored) for r in search.scores.collect()} == {200}
