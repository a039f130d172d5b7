"""Small inputs with known results."""

from __future__ import annotations

import json
import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import (
    PCA,
    Binarizer,
    Bucketizer,
    IndexToString,
    MaxAbsScaler,
    MinMaxScaler,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from larkspar.features import models
from larkspar.features.stats import (
    assembled,
    column_stats,
    correlations,
    fit_to_uniform,
    independence,
    p_value,
)
from larkspar.functions.text import numbers
from larkspar.operators.aggregates import multi_level
from larkspar.operators.projections import explode_words, word_count
from larkspar.operators.windows import numbered, ranks
from larkspar.session import new_folder
from larkspar.sources import keyvalue
from larkspar.sources.cells import from_cells, to_cells
from larkspar.sources.files import read_libsvm, text_records


def _readings():
    """Meter readings of three lines over some weeks; one line has no name, one week no number."""
    rng = random.Random(11)
    return [
        (rng.choice(["north", "south", "harbour", None]), rng.choice([7, 8, 9, None]), rng.randrange(-5, 40))
        for _ in range(60)
    ]


@pytest.fixture(scope="module")
def readings(spark):
    return spark.createDataFrame(_readings(), "line string, week int, amount int").withColumn("n", F.lit(1))


def _totals_by_hand(levels):
    """Sums of each level; a key that a level leaves out is null, as is a null key that it keeps."""
    total = Counter()
    for line, week, amount in _readings():
        for level, (with_line, with_week) in enumerate(levels):
            total[level, line if with_line else None, week if with_week else None] += amount
    return Counter((line, week, amount) for (_, line, week), amount in total.items())


@pytest.mark.parametrize("kind, levels", [
    ([["line", "week"], []], [(1, 1), (0, 0)]),
    ([["week"], ["line"]], [(0, 1), (1, 0)]),
    ("rollup", [(1, 1), (1, 0), (0, 0)]),
    ("cube", [(1, 1), (1, 0), (0, 1), (0, 0)]),
])
def test_levels_of_totals(readings, kind, levels):
    done = multi_level(readings, ["line", "week"], kind).collect()
    assert Counter((r["line"], r["week"], int(r["sum_amount"])) for r in done) == _totals_by_hand(levels)


def test_rank_semantics(spark):
    """Numbers, ranks with gaps and ranks without, against counting, with many ties and a null group."""
    rng = random.Random(5)
    rows = [(i, rng.choice(["oak", "elm", None]), rng.randrange(6)) for i in range(80)]
    trees = spark.createDataFrame(rows, "id int, kind string, height int")
    done = ranks(trees, ["kind"], ["height"], [F.desc("height")])
    done = numbered(done, ["kind"], [F.desc("height"), F.asc("id")], "num")
    for r in done.collect():
        taller = [h for _, k, h in rows if k == r["kind"] and h > r["height"]]
        before = [i for i, k, h in rows if k == r["kind"] and h == r["height"] and i < r["id"]]
        want = (len(taller) + len(before) + 1, len(taller) + 1, len(set(taller)) + 1)
        assert (r["num"], r["rank"], r["dense_rank"]) == want


def test_split_drops_only_empty_words_at_the_end(spark):
    lines = [(1, "a  b "), (2, ""), (3, "   "), (4, " x"), (5, "y")]
    got = explode_words(spark.createDataFrame(lines, "id int, line string"), "line")
    assert sorted(tuple(r) for r in got.collect()) == [(1, ""), (1, "a"), (1, "b"), (2, ""), (4, ""), (4, "x"), (5, "y")]


def test_word_count(spark):
    lines = ["tide tide", "", "ebb  tide", "Tide flow ebb", None]
    want = Counter(w for line in lines if line is not None for w in (line.split(" ") if line else [""]))
    text = spark.createDataFrame([(x,) for x in lines], "value string")
    assert {r["word"]: r["n"] for r in word_count(text, "value").collect()} == want


def test_missing_values(spark):
    rows = [(10, "ash", 3.5), (11, "", 0.0), (12, "n/a", float("nan")), (13, None, 7.25), (14, None, None), (None, None, None)]
    df = spark.createDataFrame(rows, "id int, tree string, girth double")
    ids = lambda d: sorted((r["id"] for r in d.collect()), key=str)
    assert ids(df.na.drop()) == [10, 11]
    assert ids(df.na.drop("any", subset=["id", "girth"])) == [10, 11, 13]
    assert ids(df.na.drop("all")) == [10, 11, 12, 13, 14]
    assert ids(df.na.drop("all", subset=["tree", "girth"])) == [10, 11, 12, 13]
    filled = {r["id"]: (r["tree"], r["girth"]) for r in df.na.fill(-1).na.fill("?").collect()}
    assert filled == {10: ("ash", 3.5), 11: ("", 0.0), 12: ("n/a", -1.0), 13: ("?", 7.25), 14: ("?", -1.0), -1: ("?", -1.0)}
    renamed = df.na.replace({"n/a": "unknown"}, subset=["tree"])
    assert [r["tree"] for r in renamed.where("id >= 11").orderBy("id").collect()] == ["", "unknown", None, None]


def test_text_records(spark):
    """Fields of nested quotes and line breaks, missing fields, other types, and lines that are no records."""
    record = {"ticket": "T-0017", "price": 12, "zone": None, "note": 'a "b"\n,c', "more": [1]}
    lines = [json.dumps(record), json.dumps({"price": "x"}), "[1, 2", "", None]
    fields = {"ticket": "string", "price": "double", "zone": "string", "note": "string"}
    got = text_records(spark.createDataFrame([(x,) for x in lines[:3]], "line string"), "line", fields).collect()
    assert tuple(got[0]) == ("T-0017", "12.0", None, 'a "b"\n,c', None)
    assert tuple(got[2]) == (None, None, None, None, "[1, 2")


def test_numbers(spark):
    got = spark.createDataFrame([("1 2.5 x",)], "s string").select(numbers(F.col("s"))).first()[0]
    assert got == [1.0, 2.5, None]


def test_libsvm(spark):
    path = new_folder(spark, "libsvm-golden")
    lines = ["2 1:-1.5 3:0.125 5:4 ", "0 2:7.75", "2 ", "1 4:-0.001 5:1e3"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = [(r["label"], r["features"].toArray().tolist()) for r in read_libsvm(spark, path, 5).collect()]
    assert rows == [
        (2.0, [-1.5, 0.0, 0.125, 0.0, 4.0]), (0.0, [0.0, 7.75, 0.0, 0.0, 0.0]), (2.0, [0.0] * 5), (1.0, [0.0, 0.0, 0.0, -0.001, 1000.0]),
    ]


def test_hash_table_round_trip(spark):
    rows = [("pier:9", 4, 1.5), ("quay", None, -2.0), ("", 0, None), ("lone", None, None)]
    berths = spark.createDataFrame(rows, "berth string, depth int, tide double")
    store = keyvalue.to_hashes(berths, "harbour", "berth")
    assert sorted(tuple(r) for r in store.collect()) == [
        ("harbour:", "hash", "depth", "0"), ("harbour:pier:9", "hash", "depth", "4"), ("harbour:pier:9", "hash", "tide", "1.5"),
        ("harbour:quay", "hash", "tide", "-2.0"),
    ]
    other = keyvalue.to_hashes(berths, "harbours", "berth")
    back = keyvalue.from_hashes(store.unionByName(other), "harbour", "berth", berths.schema)
    assert Counter(map(tuple, back.select(*berths.columns).collect())) == Counter(rows[:3])
    random_keys = keyvalue.to_hashes(berths, "harbour")
    assert random_keys.select("key").distinct().count() == 4 and random_keys.count() == 8


@pytest.mark.parametrize("glob, yes, no", [
    ("user:*:a.b?", ["user::a.bx", "user:1\n2:a.b\n"], ["user:1:axbx", "user:1:a.b", "xuser:1:a.bx"]),
    ("k[a-c]", ["ka", "kc"], ["kd", "k", "kaa"]),
    ("k[^a-c]", ["kd", "k\n", "k]"], ["ka", "k"]),
    ("k[c-a-]x", ["kbx", "k-x"], ["kdx"]),
    ("k[\\]^]", ["k]", "k^"], ["k\\", "k["]),
    ("a\\*b\\[", ["a*b["], ["axb["]),
    ("a\\", ["a\\"], ["a"]),
    ("h[ae", ["ha", "he"], ["hb", "h[ae"]),
    ("k[]", [], ["k", "k[]"]),
    ("é?[ü-ÿ]", ["é日ý"], ["éaa"]),
    ("$^.(x)*", ["$^.(x)", "$^.(x)\n$"], ["$^x(x)"]),
    ("", [""], ["a"]),
    ("*", ["", "a", "\n"], []),
    ("plain", ["plain"], ["plain\n", "plai"]),
])
def test_key_globs(spark, glob, yes, no):
    store = spark.createDataFrame([(k,) for k in [*yes, *no]] + [(None,)], "key string")
    assert sorted(r["key"] for r in keyvalue.keys_like(store, glob).collect()) == sorted(yes)


def test_the_beginning_of_a_glob_reaches_the_scan(spark):
    path = new_folder(spark, "keys")
    spark.createDataFrame([("a:1",), ("b:1",)], "key string").write.parquet(path)
    text = lambda g: keyvalue.keys_like(spark.read.parquet(path), g)._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(key,a:[)" in text("a:\\[*x") and "EqualTo(key,a:1)" in text("a:1")
    assert "PushedFilters: [IsNotNull(key)]" in text("*x")


def test_cells_round_trip(spark):
    catalog = """{"table": {"namespace": "default", "name": "buoy"}, "rowkey": "mark", "columns": {
        "mark": {"cf": "rowkey", "col": "m", "type": "string"}, "lit": {"cf": "state", "col": "on", "type": "boolean"},
        "drift": {"cf": "place", "col": "d", "type": "double"}, "hits": {"cf": "state", "col": "h", "type": "long"}}}"""
    rows = [("b1", True, 0.25, 2**40), ("b2", None, -1.0, None), ("b3", False, None, 0), ("b4", None, None, None)]
    buoys = spark.createDataFrame(rows, "mark string, lit boolean, drift double, hits long")
    stored = to_cells(buoys, catalog)
    assert ("b1", "state", "h", str(2**40), 0) in [tuple(r) for r in stored.collect()] and stored.count() == 6
    assert sorted(tuple(r) for r in from_cells(stored, catalog).select(*buoys.columns).collect()) == rows[:3]


def test_the_newest_cell_counts(spark):
    """Several writers of a cell, and markers for a cell, a family and a row."""
    from larkspar.sources.cells import delete_markers, scan_column

    catalog = """{"table": {"namespace": "default", "name": "t"}, "rowkey": "id", "columns": {
        "id": {"cf": "rowkey", "col": "id", "type": "int"}, "a": {"cf": "x", "col": "a", "type": "string"},
        "b": {"cf": "x", "col": "b", "type": "int"}, "c": {"cf": "y", "col": "c", "type": "int"}}}"""
    write = lambda rows, at: to_cells(spark.createDataFrame(rows, "id int, a string, b int, c int"), catalog, at)
    keys = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    cells = (
        write([(1, "zz", 1, 1), (2, "a", 2, 2), (3, "a", 3, 3), (4, "a", 4, 4), (5, "a", 5, None)], 1)
        .unionByName(write([(1, "aa", None, 9)], 2)).unionByName(write([(1, "old", 0, 0)], 0))
        .unionByName(delete_markers(keys(2), "id", 1, "x", "a")).unionByName(delete_markers(keys(3, 5), "id", 5, "x"))
        .unionByName(delete_markers(keys(4), "id", 3)).unionByName(write([(4, None, 7, None)], 4))
        .unionByName(delete_markers(keys(1), "id", 0)).unionByName(delete_markers(keys(99), "id", 9))
    ).repartition(5)
    want = {1: ("aa", 1, 9), 2: (None, 2, 2), 3: (None, None, 3), 4: (None, 7, None)}
    for order in (cells, cells.orderBy("value")):
        assert {r["id"]: (r["a"], r["b"], r["c"]) for r in from_cells(order, catalog).select("id", "a", "b", "c").collect()} == want
        assert {tuple(r) for r in scan_column(order, "x", "b").collect()} == {("1", "1"), ("2", "2"), ("4", "7")}
    with pytest.raises(ValueError):
        delete_markers(keys(1), "id", 1, None, "a")


# Fixed values from here to the chi-square tests: published example vectors, and the results they must give.


def vectors(spark, rows, names):
    return spark.createDataFrame([tuple(Vectors.dense(x) if isinstance(x, list) else x for x in r) for r in rows], names)


def values(df, name):
    return [r[name].toArray().tolist() for r in df.orderBy("id").collect()]


def close(got, want, within=1e-9):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b, abs=within)


def test_label_encoding(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "a"), (4, "a"), (5, "c")], "id int, category string")
    model = StringIndexer(inputCol="category", outputCol="i").fit(df)
    indexed = model.transform(df)
    assert [r["i"] for r in indexed.orderBy("id").collect()] == [0.0, 2.0, 1.0, 0.0, 0.0, 1.0]
    back = IndexToString(inputCol="i", outputCol="b", labels=model.labels).transform(indexed)
    assert back.where("b <> category").count() == 0
    hot = OneHotEncoder(inputCol="i", outputCol="hot", dropLast=False).fit(indexed).transform(indexed)
    assert values(hot, "hot") == [[1, 0, 0], [0, 0, 1], [0, 1, 0], [1, 0, 0], [1, 0, 0], [0, 1, 0]]


def test_scalers(spark):
    df = vectors(spark, [(0, [1.0, 0.5, -1.0]), (1, [2.0, 1.0, 1.0]), (2, [4.0, 10.0, 2.0])], ["id", "features"])
    run = lambda s: values(s.setInputCol("features").setOutputCol("o").fit(df).transform(df), "o")
    close(run(MinMaxScaler()), [[0, 0, 0], [1 / 3, 0.05263157894736842, 2 / 3], [1, 1, 1]])
    close(run(MaxAbsScaler()), [[0.25, 0.05, -0.5], [0.5, 0.1, 0.5], [1, 1, 1]])
    close(run(StandardScaler()), [
        [0.6546536707079771, 0.09352195295828246, -0.6546536707079771],
        [1.3093073414159542, 0.18704390591656492, 0.6546536707079771],
        [2.6186146828319083, 1.8704390591656492, 1.3093073414159542],
    ])


def test_discretising(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 8.0), (2, 0.2), (3, -2.0), (4, 0.0)], "label int, feature double")
    binary = Binarizer(inputCol="feature", outputCol="b", threshold=0.5).transform(df)
    assert [r["b"] for r in binary.orderBy("label").collect()] == [0.0, 1.0, 0.0, 0.0, 0.0]
    buckets = Bucketizer(inputCol="feature", outputCol="b", splits=[-math.inf, 0, 5, math.inf]).transform(df)
    assert [r["b"] for r in buckets.orderBy("label").collect()] == [1.0, 2.0, 1.0, 0.0, 1.0]


def test_assemble(spark):
    df = vectors(spark, [(0, 18, 1.0, [0.0, 10.0, 0.5], 1.0)], ["id", "hour", "mobile", "userFeatures", "clicked"])
    assert values(assembled(df, ["hour", "mobile", "userFeatures", "clicked"]), "features") == [[18.0, 1.0, 0.0, 10.0, 0.5, 1.0]]


@pytest.fixture(scope="module")
def clicks(spark):
    return vectors(spark, [
        (7, [0.0, 0.0, 18.0, 1.0], 1.0), (8, [0.0, 1.0, 12.0, 0.0], 0.0), (9, [1.0, 0.0, 15.0, 0.1], 0.0),
    ], ["id", "features", "clicked"])


def test_chi_square_selection(clicks):
    done = models.selector("features", "clicked", "o", 2, categorical=True).fit(clicks).transform(clicks)
    assert values(done, "o") == [[18.0, 1.0], [12.0, 0.0], [15.0, 0.1]]


def test_pca(clicks):
    got = values(PCA(inputCol="features", outputCol="o", k=2).fit(clicks).transform(clicks), "o")
    want = [[17.681719144883022, 0.5910509417080694], [11.517306699961809, 0.5866681457448389], [14.61657922764673, 0.5984520165752177]]
    close([[abs(x) for x in row] for row in got], want, 1e-6)


def test_column_stats(spark):
    df = vectors(spark, [(0, [1.0, 2.0, 3.0]), (1, [4.0, 5.0, 6.0]), (2, [7.0, 8.0, 9.0])], ["id", "features"])
    rows = column_stats(df, "features").orderBy("position").collect()
    assert [r["mean"] for r in rows] == [4.0, 5.0, 6.0]
    assert [r["variance"] for r in rows] == [9.0, 9.0, 9.0]
    assert [r["normL1"] for r in rows] == [12.0, 15.0, 18.0]
    assert [round(r["normL2"], 4) for r in rows] == [8.1240, 9.6437, 11.2250]
    assert [r["count"] for r in rows] == [3, 3, 3]
    some = column_stats(df, "features", ("mean", "max")).orderBy("position").collect()
    assert [tuple(r) for r in some] == [(0, 4.0, 7.0), (1, 5.0, 8.0), (2, 6.0, 9.0)]


def test_correlations(spark):
    pair = spark.createDataFrame([(float(i), 2.0 * i) for i in range(1, 5)], "a double, b double")
    assert pair.select(F.corr("a", "b")).first()[0] == pytest.approx(1.0, abs=1e-12)
    rows = [(Vectors.sparse(4, [(0, 1.0), (3, -2.0)]),), (Vectors.dense(4, 5, 0, 3),), (Vectors.dense(6, 7, 0, 8),), (Vectors.sparse(4, [(0, 9.0), (3, 1.0)]),)]
    got = {(r["i"], r["j"]): r["r"] for r in correlations(spark.createDataFrame(rows, ["features"]), "features").collect()}
    assert got[0, 1] == pytest.approx(0.055641488407465814, abs=1e-12)
    assert got[0, 3] == pytest.approx(0.4004714203168137, abs=1e-12)
    assert got[1, 3] == pytest.approx(0.9135958615342522, abs=1e-12)
    assert got[2, 2] == 1.0 and math.isnan(got[0, 2]) and math.isnan(got[2, 3])


def test_chi_square_tests(spark):
    df = vectors(spark, [
        (0.0, [0.5, 10.0]), (0.0, [1.5, 20.0]), (1.0, [1.5, 30.0]), (0.0, [3.5, 30.0]), (0.0, [3.5, 40.0]), (1.0, [3.5, 40.0]),
    ], ["label", "features"])
    rows = independence(df, "features", "label").orderBy("featureIndex").collect()
    assert [r["degreesOfFreedom"] for r in rows] == [2, 3]
    close([r["statistic"] for r in rows], [0.75, 1.5])
    close([r["pValue"] for r in rows], [0.6873, 0.6823], 1e-4)
    fit = fit_to_uniform(spark.createDataFrame([(x,) for x in range(1, 6)], "o int"), "o").first()
    assert fit["statistic"] == pytest.approx(10 / 3) and fit["degrees_of_freedom"] == 4
    assert p_value(spark, fit["statistic"], 4) == pytest.approx(0.50367, abs=1e-5)


@pytest.fixture(scope="module")
def texts(spark):
    """Notes of two kinds: those of label 1 speak of sails, the others do not."""
    rng = random.Random(9)
    common = ["rope", "deck", "noon", "salt", "crew", "calm"]
    rows = []
    for i in range(40):
        words = rng.sample(common, 3) + (["sail"] if i % 2 else ["anchor"] * (i % 4 > 0))
        rng.shuffle(words)
        rows.append((i, " ".join(words), float(i % 2)))
    return spark.createDataFrame(rows, "id long, text string, label double")


def test_text_classifier(spark, texts):
    model = models.text_classifier()[0].fit(texts)
    new = spark.createDataFrame([(1, "sail rope unseen"), (2, "rope deck"), (3, "anchor"), (4, "calm SAIL noon")], "id long, text string")
    assert [r[models.PREDICTION] for r in model.transform(new).orderBy("id").collect()] == [1.0, 0.0, 0.0, 1.0]
    assert models.accuracy().evaluate(model.transform(texts)) == 1.0
    again = models.saved_and_loaded(model, new_folder(spark, "model"))
    assert tuple(models.same_predictions(model.transform(texts), again.transform(texts), "id").first()) == (40, 40)


def test_fit_parameters_win(texts):
    pipeline, lr = models.text_classifier()
    lr.setMaxIter(5).setRegParam(0.9)
    fitted = pipeline.fit(texts, {lr.maxIter: 101, lr.regParam: 0.01, lr.threshold: 0.55}).stages[-1]
    assert (fitted.getMaxIter(), fitted.getRegParam(), fitted.getThreshold()) == (101, 0.01, 0.55)


def test_tree_search_has_a_row_per_grid_point(spark):
    from pyspark.ml.tuning import ParamGridBuilder

    rows = [(i, float(i % 2), Vectors.dense(float(i % 2), float(i % 3))) for i in range(60)]
    data = spark.createDataFrame(rows, ["id", "label", "features"])
    pipeline, tree = models.tree_regressor()
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [2, 5]).addGrid(tree.maxBins, [5, 10]).build()
    search = models.cross_validated(pipeline, grid, models.rmse(), data, "id", folds=2)
    got = search.scores.collect()
    points = [(2.0, 5.0), (2.0, 10.0), (5.0, 5.0), (5.0, 10.0)]
    assert sorted((r["fold"], r["maxDepth"], r["maxBins"]) for r in got) == [(f, *p) for f in (0, 1) for p in points]
    assert all(r["score"] == pytest.approx(0.0, abs=1e-9) for r in got)
    assert all(r["n_fitted"] + r["n_scored"] == 60 and r["n_scored"] > 10 for r in got)
    assert search.best == grid[0] and search.best_model.stages[-1].getMaxDepth() == 2
    assert sorted((r["maxDepth"], r["maxBins"]) for r in search.means().collect()) == points


def test_search_keeps_the_best_point_and_fits_it_on_all_rows(spark):
    from pyspark.ml.tuning import ParamGridBuilder

    rows = [(i, float(i % 8), Vectors.dense(float(i % 8))) for i in range(400)]
    data = spark.createDataFrame(rows, ["id", "label", "features"])
    _, tree = models.tree_regressor()
    tree.setFeaturesCol("features")
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [1, 4, 2]).build()
    for search in (models.cross_validated, models.split_validated):
        found = search(tree, grid, models.rmse(), data, "id")
        assert list(found.best.values()) == [4]
        means = {r["maxDepth"]: r["mean_score"] for r in found.means().collect()}
        assert means[4.0] == min(means.values()) < means[2.0] < means[1.0]
        assert found.best_model.getMaxDepth() == 4 and found.best_model.numNodes == 15


def test_parts_by_hash(spark):
    import duckdb

    ids = spark.range(0, 3000).select(F.col("id"), models.hashed_part("id", 7).alias("part")).collect()
    want = duckdb.sql(f"SELECT id, {models.hashed_part_sql('id', 7)} FROM range(3000) r(id)").fetchall()
    assert sorted(map(tuple, ids)) == sorted(want)
    assert max(Counter(r["part"] for r in ids).values()) < 3000 / 7 * 1.2


def test_losses_are_rows(spark, texts):
    found = models.losses(spark, models.text_classifier()[0].fit(texts).stages[-1]).orderBy("iteration").collect()
    assert [r["iteration"] for r in found] == list(range(len(found))) and len(found) > 2
    assert all(a["loss"] >= b["loss"] for a, b in zip(found, found[1:]))


def test_measurement_pipeline(spark):
    rows = [(f"c{i % 3}", 5.0 + i % 3 + (i % 7) / 10, 3.0 - i % 3, 1.0 + 2 * (i % 3), 0.2 + (i % 5) / 20) for i in range(90)]
    names = ["hull", "beam", "mast", "keel"]
    data = spark.createDataFrame(rows, ", ".join(["class string", *[f"{n} double" for n in names]]))
    for categorical in (True, False):
        done = models.measurement_pipeline("class", names, 1, categorical).fit(data).transform(data)
        flat = [r["selected"].toArray().tolist() for r in done.collect()]
        assert len(flat) == 90 and all(len(x) == 1 and -1e-9 <= x[0] <= 1 + 1e-9 for x in flat)


def test_user_functions_pass_nulls_on(spark):
    from larkspar.functions.udfs import SpacedWords, dollars

    amounts = spark.createDataFrame([(5,), (None,)], "a long").select(dollars("a").alias("d"))
    assert sorted((r["d"] for r in amounts.collect()), key=str) == ["$5", None]
    spark.udtf.register("spaced_words_test", SpacedWords)
    lines = spark.createDataFrame([(1, "a  b "), (2, None), (3, "  "), (4, "")], "id int, line string")
    got = spark.sql("SELECT id, w.word FROM {l}, LATERAL spaced_words_test(line) w", l=lines)
    assert sorted(tuple(r) for r in got.collect()) == [(1, ""), (1, "a"), (1, "b"), (4, "")]


def test_user_defined_aggregate_over_many_batches(spark):
    from larkspar.operators.aggregates import combine_by_key

    def partial(batch):
        return batch.groupby("k", as_index=False, dropna=False).agg(s=("v", "sum"), n=("v", "count"))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(200).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
        done = combine_by_key(
            df, "k", partial, "k long, s double, n long", merge={"s": F.sum("s"), "n": F.sum("n")},
            finish={"mean": F.col("s") / F.col("n")},
        )
        got = {r["k"]: r["mean"] for r in done.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {k: sum(range(k, 200, 3)) / len(range(k, 200, 3)) for k in range(3)}
