from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rowan.operators.features import FEATURES
from rowan.operators.learners import LABEL
from rowan.operators.mlp import (
    AdamState,
    EarlyStopping,
    NetworkSettings,
    SparseRows,
    gradient,
    initial_parameters,
    layers_of,
    logits,
    parameter_count,
    place_of,
    train_mlp,
    weighted_loss,
)
from rowan.sources.epochs import EpochLog

# A published validation loss curve; best epoch 2, stopped after 6.
CURVE = (0.727387, 0.712621, 0.714417, 0.714617, 0.714623, 0.715285)


def test_early_stopping_on_the_published_curve():
    rule = EarlyStopping(4, 0.0005)
    for epoch, loss in enumerate(CURVE, 1):
        if not rule.improved(epoch, loss) and rule.stop:
            break
    assert (rule.best_epoch, epoch) == (2, 6)
    small = EarlyStopping(2, 0.01)
    assert small.improved(1, 1.0) and not small.improved(2, 0.995)


def test_loss_is_weighted_cross_entropy():
    z, y = np.array([-2.0, 0.3, 4.0, 800.0]), np.array([0.0, 1.0, 1.0, 0.0])
    p = 1 / (1 + np.exp(-z[:3]))
    want = -(3 * y[:3] * np.log(p) + (1 - y[:3]) * np.log(1 - p))
    got = weighted_loss(z, y, 3.0)
    assert got[:3] == pytest.approx(want)
    assert got[3] == 800.0


def test_gradient_against_differences():
    dims = [4, 5, 3, 1]
    rng = np.random.default_rng(0)
    flat = initial_parameters(dims, 1).astype(np.float64)
    assert len(flat) == parameter_count(dims) == 4 * 5 + 5 + 5 * 3 + 3 + 3 + 1
    x, y = rng.normal(size=(20, 4)), rng.integers(0, 2, 20).astype(float)
    _, grad = gradient(flat, dims, x, y, 2.5)
    for i in range(0, len(flat), 7):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        high, low = (weighted_loss(logits(f, dims, x), y, 2.5).mean() for f in (up, down))
        assert grad[i] == pytest.approx((high - low) / 2e-5, abs=1e-5)


def test_adam_step_by_hand():
    state = AdamState.start(np.array([1.0, -2.0]))
    state.step(np.array([0.5, 0.0]), learning_rate=0.1, weight_decay=0.01)
    # The first step moves by the learning rate against the sign of gradient + decay * weight.
    assert state.flat == pytest.approx([0.9, -1.9], abs=1e-5)
    state.step(np.array([0.5, 0.0]), 0.1, 0.01)
    g1, g2 = 0.51, 0.5 + 0.01 * 0.9
    m = 0.9 * 0.1 * g1 + 0.1 * g2
    v = 0.999 * 0.001 * g1**2 + 0.001 * g2**2
    step = 0.1 * (m / (1 - 0.9**2)) / (np.sqrt(v / (1 - 0.999**2)) + 1e-8)
    assert state.flat[0] == pytest.approx(0.9 - step, abs=1e-5)


def test_initial_weights_are_bounded_by_fan_in():
    for w, b in layers_of(initial_parameters([100, 25, 1], 3), [100, 25, 1]):
        bound = 1 / np.sqrt(w.shape[0])
        assert abs(w).max() <= bound and abs(b).max() <= bound


def test_sparse_rows_multiply_like_dense_ones(spark):
    rng = np.random.default_rng(4)
    dense = rng.normal(size=(30, 7)) * (rng.random((30, 7)) < 0.3)
    dense[5] = 0
    mixed = [
        Vectors.dense(r) if i % 3 == 0 else Vectors.sparse(7, {int(k): r[k] for k in np.flatnonzero(r)})
        for i, r in enumerate(dense)
    ]
    rows = spark.createDataFrame([(v,) for v in mixed], ["x"]).coalesce(1)
    sparse = SparseRows.of(rows.toArrow().combine_chunks().column("x").chunk(0), 7)
    w, delta = rng.normal(size=(7, 4)), rng.normal(size=(30, 2))
    assert sparse @ w == pytest.approx(dense @ w, abs=1e-6)
    assert sparse.T @ delta == pytest.approx(dense.T @ delta, abs=1e-6)
    part = SparseRows.joined([sparse[3:9], sparse[20:21]])
    assert part @ w == pytest.approx(dense[[*range(3, 9), 20]] @ w, abs=1e-6)


def rows_of(spark, n, partitions):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 0).astype(float)
    rows = [(k, Vectors.dense(a), float(b)) for k, (a, b) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, ["k", FEATURES, LABEL]).repartition(partitions)
    df = df.select("*", place_of("k", 5))
    return df.filter(f"k < {n}"), df.filter("k >= 480")


@pytest.fixture(scope="module")
def data(spark):
    return tuple(part.persist() for part in rows_of(spark, 480, 1))


def accuracy(model, df):
    rows = model.probability(df).select(LABEL, "probability").collect()
    return np.mean([(r["probability"] >= 0.5) == (r[LABEL] == 1) for r in rows])


def train(data, tasks=None, epochs=16, log=None, **settings):
    train_rows, held = data
    given = {"batch_size": 16, "learning_rate": 0.01, "hidden_dims": (16, 8), "dropout": 0.0, **settings}
    options = NetworkSettings(epochs=epochs, tasks=tasks, **given)
    sizes = (train_rows.count(), held.count())
    return train_mlp(train_rows, held, PipelineModel([]), sizes, 1.0, options, 5, log)


def same(a, b):
    return a.summary == b.summary and np.array_equal(a.flat, b.flat)


# One unit a batch, and batches of many units.
BATCHES = [{}, {"batch_size": 96, "unit_rows": 16, "learning_rate": 0.05}]


@pytest.mark.parametrize("batches", BATCHES)
def test_training_learns_and_restores_the_best_epoch(data, batches):
    model = train(data, **batches)
    s = model.summary
    losses = [e["val_loss"] for e in s.history]
    assert s.epochs_completed == len(losses) <= 16
    assert losses[s.best_epoch - 1] <= min(losses) + 0.0005
    assert s.history[-1]["train_loss"] < s.history[0]["train_loss"]
    assert accuracy(model, data[1]) > 0.8


@pytest.mark.parametrize("batches", BATCHES)
def test_training_is_the_same_in_any_number_of_tasks(data, batches):
    one, *more = (train(data, tasks, epochs=2, dropout=0.2, **batches) for tasks in (1, 4, 16))
    assert all(same(one, other) for other in more)


def test_training_does_not_depend_on_input_partitions(spark):
    one, *more = (train(rows_of(spark, 480, p), epochs=3) for p in (1, 7, 8))
    assert all(same(one, other) for other in more)


def test_tasks_follow_the_rows(data, monkeypatch):
    from rowan.operators import mlp

    epoch = mlp._Epoch([3, 4, 1], NetworkSettings(batch_size=16), 1.0, 5, 1)
    assert mlp._Dealt(mlp._network_input(data[0], F.col("__place")).toDF("y", "x", "place"), 480, epoch).tasks == 1
    monkeypatch.setattr(mlp, "ROWS_PER_TASK", 50)
    dealt = mlp._Dealt(mlp._network_input(data[0], F.col("__place")).toDF("y", "x", "place"), 480, epoch)
    homes = {r["home"]: r["count"] for r in dealt.frame.groupBy("home").count().collect()}
    assert dealt.tasks == 10 and set(homes) == set(range(10)) and max(homes.values()) < 100


def test_every_epoch_deals_all_rows_anew(data):
    from rowan.operators import mlp

    rows = mlp._network_input(data[0], F.col("__place")).toDF("y", "x", "place")
    steps = []
    for epoch in (1, 2):
        settings = NetworkSettings(batch_size=48)
        frame = mlp._Dealt(rows, 480, mlp._Epoch([3, 4, 1], settings, 1.0, 5, epoch)).frame
        steps.append({r["place"]: r["step"] for r in frame.select("place", "step").collect()})
    assert len(steps[0]) == len(steps[1]) == 480 and set(steps[0].values()) == set(range(10))
    # A row meets others each time: one in ten stays in its step by chance.
    assert sum(steps[0][k] == steps[1][k] for k in steps[0]) < 100


def test_a_step_is_one_update_with_the_mean_gradient_of_its_rows(data):
    model = train(data, epochs=1, batch_size=480, unit_rows=64, tasks=3)
    rows = data[0].select(FEATURES, LABEL).collect()
    x = np.array([r[FEATURES].toArray() for r in rows], np.float32)
    y = np.array([r[LABEL] for r in rows], np.float32)
    dims = [3, 16, 8, 1]
    state = AdamState.start(initial_parameters(dims, 5))
    loss, grad = gradient(state.flat, dims, x, y, 1.0)
    state.step(grad, 0.01, NetworkSettings().weight_decay)
    assert model.summary.history[0]["train_loss"] == pytest.approx(loss, abs=1e-5)
    assert model.flat == pytest.approx(state.flat, abs=1e-4)


def test_fewer_rows_than_tasks(spark):
    rows, held = rows_of(spark, 5, 2)
    for batches in BATCHES:
        assert train((rows, held), 7, epochs=1, **batches).summary.epochs_completed == 1


def test_without_validation_the_last_epoch_is_kept(data):
    options = NetworkSettings(epochs=2, hidden_dims=(4,))
    model = train_mlp(data[0], None, PipelineModel([]), (480, 0), 1.0, options, 1)
    s = model.summary
    assert (s.best_epoch, s.epochs_completed, s.used_validation_split) == (2, 2, False)
    assert "val_loss" not in s.history[0]


@pytest.mark.parametrize("batches", BATCHES)
def test_a_stopped_training_goes_on_from_its_log(spark, data, tmp_path, batches):
    whole = train(data, epochs=5, dropout=0.1, **batches)
    log = EpochLog(spark, f"{tmp_path}/log")
    part = train(data, epochs=3, log=log, dropout=0.1, **batches)
    assert part.summary.history == whole.summary.history[:3]
    again = train(data, 4, epochs=5, log=EpochLog(spark, f"{tmp_path}/log"), dropout=0.1, **batches)
    assert same(again, whole)
    # All epochs are there: nothing is trained, and the best is found in the log.
    assert same(train(data, epochs=5, log=log, dropout=0.1, **batches), whole)


def test_an_epoch_that_was_cut_short_leaves_no_trace(spark, data, tmp_path, monkeypatch):
    from rowan.operators import mlp

    whole = train(data, epochs=4)
    train_epoch = mlp._Dealt.train

    def lost(self, state):
        if self.epoch.epoch == 3:
            raise RuntimeError("driver lost")
        return train_epoch(self, state)

    monkeypatch.setattr(mlp._Dealt, "train", lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        train(data, epochs=4, log=EpochLog(spark, f"{tmp_path}/log"))
    monkeypatch.undo()
    assert same(train(data, epochs=4, log=EpochLog(spark, f"{tmp_path}/log")), whole)


def test_early_stopping_goes_on_from_the_log(spark, data, tmp_path):
    settings = {"early_stopping_patience": 2, "min_delta": 0.5}
    whole = train(data, **settings)
    assert whole.summary.epochs_completed == 3
    train(data, epochs=2, log=EpochLog(spark, f"{tmp_path}/log"), **settings)
    assert same(train(data, log=EpochLog(spark, f"{tmp_path}/log"), **settings), whole)


def test_a_log_serves_one_training_only(spark, data, tmp_path):
    train(data, epochs=1, log=EpochLog(spark, f"{tmp_path}/log"))
    with pytest.raises(ValueError, match="another training"):
        train(data, epochs=2, log=EpochLog(spark, f"{tmp_path}/log"), learning_rate=0.5)


def test_many_vectors_are_added_up_in_a_tree(spark):
    from rowan.operators.sums import FAN_IN, SCHEMA, summed, vector_row

    n = FAN_IN * FAN_IN + 5

    def task(batches):
        for batch in batches:
            for k in batch.column("id").to_pylist():
                if k % 7:
                    yield vector_row(k, np.array([0.1, k / 3]))

    def total(partitions):
        return summed(spark.range(n).repartition(partitions).mapInArrow(task, SCHEMA), n)

    kept = [k for k in range(n) if k % 7]
    assert total(3) == pytest.approx([0.1 * len(kept), sum(kept) / 3])
    assert total(3).tolist() == total(8).tolist()
    assert summed(spark.createDataFrame([], SCHEMA), n) is None


def test_units_pass_arrow_batches(spark):
    import pyarrow as pa

    from rowan.operators.mlp import _units

    x = spark.createDataFrame([(Vectors.sparse(2, [1], [float(k)]),) for k in range(15)], ["x"])
    x = x.coalesce(1).toArrow().combine_chunks().column("x").chunk(0)
    steps = pa.array([0] * 3 + [1] * 7 + [2] * 5, pa.int32())
    units = pa.array([0] * 3 + [0] * 2 + [4] * 5 + [0] * 5, pa.int32())
    whole = pa.RecordBatch.from_arrays([pa.array(np.arange(15.0)), x, steps, units], ["y", "x", "step", "unit"])
    cut = [whole.slice(at, n) for at, n in ((0, 4), (4, 0), (4, 9), (13, 2))]
    parts = list(_units(iter(cut), 2))
    assert [(s, u, len(y)) for s, u, _, y in parts] == [(0, 0, 3), (1, 0, 2), (1, 4, 5), (2, 0, 5)]
    assert np.concatenate([y for *_, y in parts]).tolist() == list(range(15))
    assert np.concatenate([(m @ np.eye(2))[:, 1] for _, _, m, _ in parts]).tolist() == list(range(15))


def test_scores_of_sparse_and_dense_vectors(spark, data):
    model = train(data, epochs=1)
    rows = [(Vectors.sparse(3, [1], [2.0]),), (Vectors.dense(0.0, 2.0, 0.0),), (Vectors.sparse(3, [], []),)]
    scored = [r["probability"] for r in model.probability(spark.createDataFrame(rows, [FEATURES])).collect()]
    z = logits(model.flat, model.dims, np.array([[0, 2, 0], [0, 2, 0], [0, 0, 0]], np.float32))
    assert scored == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-6)
