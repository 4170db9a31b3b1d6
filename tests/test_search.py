from __future__ import annotations

import weakref

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rowan import CUSTOMER_SPEC
from rowan.operators import forests, stacked, tuning
from rowan.operators.cv import FOLD, fold_preprocessors
from rowan.operators.features import FEATURES, fit_categories, fit_categories_folds, fit_numeric, fit_numeric_folds
from rowan.operators.forests import Trees, forest_confusion, largest
from rowan.operators.learners import LABEL, PREDICTION, RAW, WEIGHT, build_estimator, logistic_regression
from rowan.operators.metrics import confusion
from rowan.operators.split import stratified_folds
from rowan.operators.stacked import StackedFit, fit_stacked, stacked_confusion
from customer_data import rows as customers
from customer_data import table


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(8)
    n = 900
    x = np.column_stack([draw.normal(size=(n, 3)), draw.integers(0, 2, (n, 4))])
    y = (x[:, 0] + 2 * x[:, 3] - x[:, 4] * x[:, 1] + draw.normal(size=n) > 1).astype(float)
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    cells = [(Vectors.dense(a), float(b), float(c), k % 3) for k, (a, b, c) in enumerate(zip(x, y, w, strict=True))]
    frame = spark.createDataFrame(cells, [FEATURES, LABEL, WEIGHT, FOLD]).repartition(4).persist()
    return frame, x, y, w


def test_stacked_fits_equal_single_ones(rows):
    frame, *_ = rows
    fits = [StackedFit(fold, c) for fold in range(3) for c in (0.01, 0.3, 10.0)]
    together = fit_stacked(frame, F.col(FOLD), fits, 7, 4)
    for fit, point in zip(fits, together, strict=True):
        alone = fit_stacked(frame, F.col(FOLD), [fit], 7, 4)
        assert alone[0] == pytest.approx(point, abs=1e-9)
        part = frame.filter(F.col(FOLD) == fit.fold)
        size = part.agg(F.sum(WEIGHT)).first()[0]
        model = logistic_regression({"C": fit.strength, "max_iter": 500}, size, tol=1e-12).fit(part)
        assert model.coefficients.toArray() == pytest.approx(point[:-1], abs=1e-4)
        assert model.intercept == pytest.approx(point[-1], abs=1e-4)


def test_both_kinds_of_steps_end_at_the_same_point(rows, monkeypatch):
    frame, *_ = rows
    fits = [StackedFit(0, c) for c in (0.05, 5.0)]
    newton = fit_stacked(frame, F.col(FOLD), fits, 7, 4, tolerance=1e-9)
    monkeypatch.setattr(stacked, "HESSIAN_CELLS", 0)
    assert fit_stacked(frame, F.col(FOLD), fits, 7, 4, tolerance=1e-9) == pytest.approx(newton, abs=1e-6)


def test_passes_do_not_grow_with_fits(rows, monkeypatch):
    frame, *_ = rows
    passes = []
    summed = stacked.summed
    monkeypatch.setattr(stacked, "summed", lambda *a: passes.append(1) or summed(*a))
    counts = []
    for strengths in ([0.5], [0.5] * 20):
        passes.clear()
        fit_stacked(frame, F.col(FOLD), [StackedFit(0, c) for c in strengths], 7, 4)
        counts.append(len(passes))
    assert counts[0] == counts[1] < 15


def test_stacked_confusion_counts_each_fold(rows):
    frame, x, y, _ = rows
    fits = [StackedFit(0, 1.0), StackedFit(2, 1.0)]
    points = fit_stacked(frame, F.col(FOLD), fits, 7, 4)
    got = {r["fit"]: r for r in stacked_confusion(frame, F.col(FOLD), fits, points).collect()}
    for k, fit in enumerate(fits):
        own = np.arange(900) % 3 == fit.fold
        said = x[own] @ points[k, :-1] + points[k, -1] > 0
        assert got[k]["tp"] == (said & (y[own] == 1)).sum() and got[k]["fn"] == (~said & (y[own] == 1)).sum()
        assert got[k]["fp"] + got[k]["tn"] == (y[own] == 0).sum()


def test_a_fit_without_rows_is_refused(rows):
    with pytest.raises(ValueError, match="No rows"):
        fit_stacked(rows[0], F.col(FOLD), [StackedFit(7, 1.0)], 7, 4)


@pytest.fixture(scope="module")
def forest(spark, rows):
    frame = rows[0].coalesce(1)
    settings = {"n_estimators": 12, "max_depth": None, "min_samples_leaf": 2}
    model = build_estimator("random_forest", settings, 900, 3).fit(frame)
    return model, Trees.of(spark, model)


def test_whole_trees_vote_as_the_model(rows, forest):
    frame, x, *_ = rows
    model, trees = forest
    got = trees.calls(x, [(30, 12)])[:, 0]
    want = {tuple(r[FEATURES]): r for r in model.transform(frame).collect()}
    for a, said in zip(x, got, strict=True):
        assert said == (want[tuple(a)][PREDICTION] == 1)
        assert want[tuple(a)][RAW].toArray().sum() == pytest.approx(12)


def plain_call(model, tree_count, depth, a):
    """A walk down each of the first trees in its JVM form, cut at a depth."""
    votes = np.zeros(2)
    for tree in list(model._java_obj.trees())[:tree_count]:
        def shape(node, level):
            """(class, stats) of a leaf or (None, node, left, right), leaves of one class merged."""
            stats = np.array(list(node.impurityStats().stats()))
            if node.getClass().getSimpleName() != "InternalNode" or level == depth:
                return float(node.prediction()), stats
            left, right = shape(node.leftChild(), level + 1), shape(node.rightChild(), level + 1)
            if len(left) == len(right) == 2 and left[0] == right[0]:
                return left[0], stats
            return None, node, left, right

        part = shape(tree.rootNode(), 0)
        while len(part) > 2:
            split = part[1].split()
            value = a[split.featureIndex()]
            if split.getClass().getSimpleName() == "ContinuousSplit":
                down = value <= split.threshold()
            else:
                down = value in list(split.leftCategories())
            part = part[2] if down else part[3]
        votes += part[1] / part[1].sum()
    return votes[1] > votes[0]


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_prefixes_and_cuts_vote_as_the_first_trees(rows, forest, depth):
    _, x, *_ = rows
    model, trees = forest
    sample = x[::60]
    got = trees.calls(sample, [(depth, 5)])[:, 0]
    assert got.tolist() == [plain_call(model, 5, depth, a) for a in sample]


def test_one_forest_answers_all_trials_of_a_leaf_size(rows, forest):
    frame, x, y, _ = rows
    _, trees = forest
    trials = [
        {"n_estimators": n, "max_depth": d, "min_samples_leaf": 2} for n, d in ((3, 2), (12, None), (7, 5))
    ]
    assert largest(trials) == {2: {"max_depth": 30, "n_estimators": 12, "min_samples_leaf": 2}}
    got = {r["fit"]: r for r in forest_confusion(frame, {2: trees}, trials, 7).collect()}
    said = trees.calls(x, [(2, 3), (30, 12), (5, 7)])
    for k in range(3):
        assert got[k]["tp"] == (said[:, k] & (y == 1)).sum()
        assert got[k]["tp"] + got[k]["fp"] + got[k]["fn"] + got[k]["tn"] == 900
    alone = trees.first(7).calls(x, [(5, 7)])[:, 0]
    assert (alone == said[:, 2]).all()


def test_trees_are_cut_once_for_all_rows_of_a_task(rows, forest, monkeypatch):
    _, x, y, _ = rows
    trees = forest[1]
    trials = [
        {"n_estimators": 3, "max_depth": 2, "min_samples_leaf": 2},
        {"n_estimators": 12, "max_depth": None, "min_samples_leaf": 2},
    ]
    vectors = {
        "type": np.ones(len(x), np.int8), "size": np.zeros(len(x), np.int32),
        "indices": [[]] * len(x), "values": x.tolist(),
    }
    kinds = {"indices": pa.list_(pa.int32())}
    cells = pa.StructArray.from_arrays(
        [pa.array(v, kinds.get(name)) for name, v in vectors.items()], names=list(vectors)
    )
    batch = pa.RecordBatch.from_pydict({"y": pa.array(y), "x": cells})
    said = trees.calls(x, [(2, 3), (30, 12)])
    cuts, cut = [], Trees.cut
    monkeypatch.setattr(Trees, "cut", lambda self, depth: cuts.append(depth) or cut(self, depth))
    # Two batches of two blocks.
    counted = next(forests._counts({2: trees}, trials, 7)(iter([batch, batch]))).to_pylist()
    assert sorted(cuts) == [2, 30]
    for k, c in enumerate(counted):
        assert c["tp"] == 2 * (said[:, k] & (y == 1)).sum()
        assert c["fp"] == 2 * (said[:, k] & (y == 0)).sum()


def test_trees_are_held_in_few_bytes_a_node(forest):
    model, trees = forest
    parts = [trees.feature, trees.threshold, trees.left, trees.right, trees.votes, trees.call]
    assert {len(p) for p in parts} == {model.totalNumNodes}
    assert sum(p.nbytes for p in parts) < 40 * model.totalNumNodes


def test_trees_come_over_without_row_objects(spark, forest, monkeypatch):
    model, trees = forest

    def refuse(*_):
        raise AssertionError("a Python object for every node")

    # As in a session without Arrow.
    monkeypatch.setattr(type(spark.range(1)), "collect", refuse)
    monkeypatch.setattr(type(spark.range(1)), "toPandas", refuse)
    again = Trees.of(spark, model)
    for name in ("roots", "feature", "threshold", "left", "right", "votes", "call"):
        assert (getattr(again, name) == getattr(trees, name)).all()


def test_only_rows_not_in_a_leaf_go_down(rows, forest):
    _, x, *_ = rows
    trees = forest[1]
    steps, leaf = 0, trees.left < 0
    for a in x[:50]:
        node = trees.roots[~leaf[trees.roots]]
        while len(node):
            steps += len(node)
            node = np.where(a[trees.feature[node]] <= trees.threshold[node], trees.left[node], trees.right[node])
            node = node[~leaf[node]]

    taken = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            taken.append(np.size(at))
            return np.asarray(self)[at]

    watched = Trees(
        trees.roots, trees.feature, trees.threshold.view(Counted), trees.left, trees.right, trees.votes, trees.call
    )
    assert (watched.calls(x[:50], [(30, 12)]) == trees.calls(x[:50], [(30, 12)])).all()
    assert sum(taken) == steps


def test_a_forest_is_counted_and_dropped_before_the_next(spark, monkeypatch):
    space = {"n_estimators": (2, 4), "max_depth": (2, None), "min_samples_leaf": (1, 2, 4)}
    monkeypatch.setattr(tuning, "FOREST_SPACE", space)
    df = table(spark, customers(200)).withColumn(LABEL, F.when(F.col("Churn") == "Yes", 1.0).otherwise(0.0))
    columns = CUSTOMER_SPEC.feature_columns(df.columns)
    folds = stratified_folds(df, LABEL, "customerID", 2, 1)
    asked, alive, most = [], set(), []
    confusion_of, read = tuning.forest_confusion, Trees.of

    def counted(held_out, grown, trials, width):
        asked.append((list(grown), sorted({t["min_samples_leaf"] for t in trials})))
        return confusion_of(held_out, grown, trials, width)

    def of(*given):
        trees = read(*given)
        alive.add(id(trees.votes))
        weakref.finalize(trees.votes, alive.discard, id(trees.votes))
        most.append(len(alive))
        return trees

    monkeypatch.setattr(tuning, "forest_confusion", counted)
    monkeypatch.setattr(Trees, "of", of)
    found, sampled = tuning.run_trials(df, CUSTOMER_SPEC, {"random_forest": {}}, folds, columns, 8, 5, parallelism=1)
    leaves = sorted({t["min_samples_leaf"] for t in sampled["random_forest"]})
    assert len(leaves) > 1
    assert sorted(asked) == sorted([([leaf], [leaf]) for leaf in leaves for _ in range(2)])
    assert max(most) == 1
    got = found.orderBy("trial").collect()
    assert [r["trial"] for r in got] == list(range(8)) and all(0 <= r["f1_mean"] <= 1 for r in got)


def test_forests_in_flight_follow_the_slots():
    # Small tables: as many as may run. Large ones: enough for all slots, at least two.
    assert tuning.forests_at_once(1, 12, 8) == 8
    assert tuning.forests_at_once(11, 12, 8) == 4
    assert tuning.forests_at_once(70, 12, 8) == 2
    assert tuning.forests_at_once(70, 12, 1) == 1


def test_cut_forests_are_as_good_as_grown_ones(rows, forest):
    frame, x, y, _ = rows
    settings = {"n_estimators": 12, "max_depth": 3, "min_samples_leaf": 2}
    grown = build_estimator("random_forest", settings, 900, 3).fit(frame.coalesce(1))
    counted = confusion(grown.transform(frame), (), LABEL, PREDICTION).first()
    cut = (forest[1].calls(x, [(3, 12)])[:, 0] == (y == 1)).mean()
    assert abs(cut - (counted["tp"] + counted["tn"]) / 900) < 0.05


@pytest.mark.parametrize("exact_rows", [1000, 20])
def test_statistics_of_all_folds_equal_those_of_each(spark, exact_rows):
    df = table(spark, customers(400)).withColumn(FOLD, F.pmod(F.xxhash64("customerID"), F.lit(4)).cast("int"))
    columns = CUSTOMER_SPEC.feature_columns(df.columns)
    numbers = CUSTOMER_SPEC.numeric_features(df.schema, columns)
    texts = CUSTOMER_SPEC.categorical_features(df.schema, columns)
    numeric = fit_numeric_folds(df, FOLD, 4, numbers, exact_rows)
    categories = fit_categories_folds(df, FOLD, 4, texts)
    for j in range(4):
        fitting = df.filter(F.col(FOLD) != j)
        for got, want in zip(numeric[j], fit_numeric(fitting, numbers, exact_rows), strict=True):
            assert (got.column, got.median) == (want.column, want.median)
            assert (got.mean, got.std) == pytest.approx((want.mean, want.std), rel=1e-12)
        assert categories[j] == fit_categories(fitting, texts)


def test_a_column_with_values_in_one_fold_only(spark):
    cells = [(k, k % 3, float(k) if k % 3 == 0 else None, "a" if k % 3 == 0 else None) for k in range(30)]
    df = spark.createDataFrame(cells, f"k int, {FOLD} int, v double, c string")
    numeric = fit_numeric_folds(df, FOLD, 3, ["v"])
    assert numeric[0] == [] and [s.median for s in numeric[1]] == [13.5]
    categories = fit_categories_folds(df, FOLD, 3, ["c"])
    assert categories[0] == [] and categories[1][0].categories == ("a",)


def test_jobs_of_the_statistics_do_not_grow_with_folds(spark):
    df = table(spark, customers(200)).withColumn(LABEL, F.when(F.col("Churn") == "Yes", 1.0).otherwise(0.0))
    columns = CUSTOMER_SPEC.feature_columns(df.columns)
    counts = []
    for k in (2, 5):
        folds = stratified_folds(df, LABEL, "customerID", k, 1)
        group = f"folds-{k}"
        spark.sparkContext.setJobGroup(group, group)
        fold_preprocessors(df, CUSTOMER_SPEC, folds, columns)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1]
