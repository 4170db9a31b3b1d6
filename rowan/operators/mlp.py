"""Multilayer perceptron with early stopping, trained by mini-batches over the whole table.

Every epoch deals all rows anew: a hash of key, seed and epoch names the step a row belongs to and its
unit inside the step. A step is one Adam update with the mean gradient of all its rows. The rows of a
unit lie side by side in one task, in the order of their hashes, and units add up in their own order, so
that losses and parameters are the same whatever the number of tasks or the partitions rows come in.

Batches of one unit have nothing to add up: tasks hold runs of steps, and an epoch is a chain of jobs,
one for each task, each handing its state to the next. Larger batches are dealt over all tasks unit by
unit, and every step is a job whose gradients meet in a tree. A task holds one unit and the network;
feature vectors stay sparse. The number of tasks follows the number of rows.

With a log, state and losses of every epoch are kept as one row written at once, and a training that
starts with the log of an earlier one goes on where that ended, with the same result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowan.functions.text import column
from rowan.operators.features import FEATURES
from rowan.operators.learners import LABEL
from rowan.operators.sparse import SparseRows
from rowan.operators.sums import SCHEMA, summed, vector_row
from rowan.sources.epochs import EpochLog, EpochRecord

BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
PLACE = "__place"
# Rows a task should at least have.
ROWS_PER_TASK = 20_000


# The default settings.
@dataclass(frozen=True)
class NetworkSettings:
    enabled: bool = True
    epochs: int = 20
    batch_size: int = 128
    learning_rate: float = 0.001
    hidden_dims: tuple[int, ...] = (128, 64)
    dropout: float = 0.1
    weight_decay: float = 0.0001
    validation_split: float = 0.2
    early_stopping_patience: int = 4
    min_delta: float = 0.0005
    # Rows whose gradients one task adds up; a batch is as many units as it needs.
    unit_rows: int = 1024
    # Tasks that hold the rows; by default as many as they are worth. No result hangs on it.
    tasks: int | None = None


@dataclass
class EarlyStopping:
    """Stop after ``patience`` epochs in a row without a gain of more than ``min_delta``."""

    patience: int
    min_delta: float
    best_loss: float = float("inf")
    best_epoch: int = 0
    stale: int = 0

    def improved(self, epoch: int, loss: float) -> bool:
        if loss + self.min_delta < self.best_loss:
            self.best_loss, self.best_epoch, self.stale = loss, epoch, 0
            return True
        self.stale += 1
        return False

    @property
    def stop(self) -> bool:
        return self.stale >= self.patience


Layers = list[tuple[np.ndarray, np.ndarray]]


def parameter_count(dims: Sequence[int]) -> int:
    return sum(a * b + b for a, b in zip(dims[:-1], dims[1:], strict=True))


def layers_of(flat: np.ndarray, dims: Sequence[int]) -> Layers:
    """Weight and bias views into the flat parameter vector."""
    layers, at = [], 0
    for a, b in zip(dims[:-1], dims[1:], strict=True):
        w = flat[at : at + a * b].reshape(a, b)
        at += a * b
        layers.append((w, flat[at : at + b]))
        at += b
    return layers


def initial_parameters(dims: Sequence[int], seed: int) -> np.ndarray:
    """Uniform in ±1/sqrt(fan-in), weights and biases."""
    rng = np.random.default_rng(seed)
    flat = np.empty(parameter_count(dims), dtype=np.float32)
    for w, b in layers_of(flat, dims):
        bound = 1.0 / math.sqrt(w.shape[0])
        w[:] = rng.uniform(-bound, bound, w.shape)
        b[:] = rng.uniform(-bound, bound, b.shape)
    return flat


def logits(flat: np.ndarray, dims: Sequence[int], x: np.ndarray | SparseRows) -> np.ndarray:
    layers = layers_of(flat, dims)
    for w, b in layers[:-1]:
        x = np.maximum(x @ w + b, 0.0)
    w, b = layers[-1]
    return (x @ w + b)[:, 0]


def weighted_loss(z: np.ndarray, y: np.ndarray, pos_weight: float) -> np.ndarray:
    """Per-row binary cross-entropy on logits, positives weighted."""
    return (1.0 - y) * z + (1.0 + (pos_weight - 1.0) * y) * np.logaddexp(0.0, -z)


def gradient(
    flat: np.ndarray,
    dims: Sequence[int],
    x: np.ndarray | SparseRows,
    y: np.ndarray,
    pos_weight: float,
    dropout: float = 0.0,
    rng: np.random.Generator | None = None,
) -> tuple[float, np.ndarray]:
    """Mean loss of a batch and its gradient over the flat parameters."""
    layers = layers_of(flat, dims)
    inputs, masks = [x], []
    for w, b in layers[:-1]:
        h = inputs[-1] @ w + b
        mask = (h > 0).astype(np.float32)
        if dropout > 0 and rng is not None:
            mask *= (rng.random(h.shape, dtype=np.float32) >= dropout) / np.float32(1.0 - dropout)
        masks.append(mask)
        inputs.append(h * mask)
    w, b = layers[-1]
    z = (inputs[-1] @ w + b)[:, 0]
    loss = float(weighted_loss(z, y, pos_weight).mean())
    # d/dz of the loss, with sigmoid(-z) written so that it cannot overflow.
    sigmoid_neg = np.exp(-np.logaddexp(0.0, z))
    delta = (((1.0 - y) - (1.0 + (pos_weight - 1.0) * y) * sigmoid_neg) / len(y))[:, None]
    delta = delta.astype(np.float32)
    out = np.empty_like(flat)
    slots = layers_of(out, dims)
    for i in range(len(layers) - 1, -1, -1):
        slots[i][0][:] = inputs[i].T @ delta
        slots[i][1][:] = delta.sum(axis=0)
        if i:
            delta = (delta @ layers[i][0].T) * masks[i - 1]
    return loss, out


@dataclass
class AdamState:
    flat: np.ndarray
    m: np.ndarray
    v: np.ndarray
    steps: int = 0

    @classmethod
    def start(cls, flat: np.ndarray) -> AdamState:
        return cls(flat, np.zeros_like(flat), np.zeros_like(flat))

    def step(self, grad: np.ndarray, learning_rate: float, weight_decay: float) -> None:
        """One Adam update in place; weight decay enters as an L2 term of the gradient."""
        self.steps += 1
        grad = grad + weight_decay * self.flat
        self.m += (1.0 - BETA1) * (grad - self.m)
        self.v += (1.0 - BETA2) * (grad * grad - self.v)
        scale = math.sqrt(1.0 - BETA2**self.steps)
        rate = learning_rate / (1.0 - BETA1**self.steps)
        self.flat -= rate * self.m / (np.sqrt(self.v) / scale + EPSILON)


def _rows_of(batch: pa.RecordBatch, width: int) -> tuple[SparseRows, np.ndarray]:
    y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.float32)
    return SparseRows.of(batch.column("x"), width), y


_STATE_SCHEMA = "n bigint, loss double, steps bigint, state binary"


def _units(
    batches: Iterator[pa.RecordBatch], width: int
) -> Iterator[tuple[int, int, SparseRows, np.ndarray]]:
    """Step, unit and rows of every unit, in order; a unit may span Arrow batches."""
    key: tuple[int, int] | None = None
    parts: list[tuple[SparseRows, np.ndarray]] = []

    def joined() -> tuple[int, int, SparseRows, np.ndarray]:
        return *key, SparseRows.joined([x for x, _ in parts]), np.concatenate([y for _, y in parts])

    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = _rows_of(batch, width)
        names = np.stack([batch.column(c).to_numpy() for c in ("step", "unit")], axis=1)
        cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
        for at, to in zip([0, *cuts], [*cuts, len(y)], strict=True):
            if key is not None and key != tuple(names[at]):
                yield joined()
                parts = []
            key = tuple(int(k) for k in names[at])
            parts.append((x[at:to], y[at:to]))
    if key is not None:
        yield joined()


@dataclass(frozen=True)
class _Epoch:
    """What a task needs to know of the training and its epoch."""

    dims: Sequence[int]
    settings: NetworkSettings
    pos_weight: float
    seed: int
    epoch: int

    def gradient(self, flat: np.ndarray, step: int, unit: int, x: SparseRows, y: np.ndarray):
        rng = np.random.default_rng([self.seed, self.epoch, step, unit])
        return gradient(flat, self.dims, x, y, self.pos_weight, self.settings.dropout, rng)


def _steps(state: AdamState, n: int, loss: float, epoch: _Epoch):
    """Take the steps of a task's rows one after another, from the state that the task before left."""
    packed, start, settings = np.stack([state.flat, state.m, state.v]), state.steps, epoch.settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = AdamState(packed[0].copy(), packed[1].copy(), packed[2].copy(), start)
        rows, total = n, loss
        for step, unit, x, y in _units(batches, epoch.dims[0]):
            mean, grad = epoch.gradient(local.flat, step, unit, x, y)
            local.step(grad, settings.learning_rate, settings.weight_decay)
            rows, total = rows + len(y), total + mean * len(y)
        if local.steps > start:
            state = np.stack([local.flat, local.m, local.v]).tobytes()
            columns = {"n": [rows], "loss": [total], "steps": [local.steps], "state": [state]}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _gradients(flat: np.ndarray, epoch: _Epoch):
    """Rows, loss and gradient of every unit of a step, summed over its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step, unit, x, y in _units(batches, epoch.dims[0]):
            mean, grad = epoch.gradient(flat, step, unit, x, y)
            yield vector_row(unit, np.concatenate([[1.0, mean], grad.astype(np.float64)]) * len(y))

    return run


class _Dealt:
    """The rows of one epoch, in tasks, steps and units."""

    def __init__(self, data: DataFrame, rows: int, epoch: _Epoch) -> None:
        settings = epoch.settings
        self.epoch = epoch
        self.tasks = settings.tasks or max(1, math.ceil(rows / ROWS_PER_TASK))
        self.steps = max(1, math.ceil(rows / settings.batch_size))
        self.units = max(1, math.ceil(settings.batch_size / settings.unit_rows))
        mixed = F.xxhash64("place", F.lit(epoch.seed), F.lit(epoch.epoch))
        frame = data.withColumn("mixed", mixed).withColumns(
            {
                "step": F.pmod("mixed", F.lit(self.steps)).cast("int"),
                "unit": F.pmod(F.xxhash64("mixed"), F.lit(self.units)).cast("int"),
            }
        )
        # Runs of steps, or the units of every step.
        run = F.floor(F.col("step") * F.lit(self.tasks) / F.lit(self.steps))
        home = run if self.units == 1 else F.pmod("unit", F.lit(self.tasks))
        frame = frame.withColumn("home", home.cast("int"))
        frame = frame.repartitionById(self.tasks, F.col("home"))
        self.frame = frame.sortWithinPartitions("step", "unit", "mixed", "place", "y")

    def train(self, state: AdamState) -> tuple[AdamState, float]:
        """The state after the epoch and the mean loss on the way."""
        many = self.units > 1 or self.tasks > 1
        if many:
            self.frame.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n, loss, state = (self._chain if self.units == 1 else self._summed)(state)
        finally:
            if many:
                self.frame.unpersist()
        return state, loss / n

    def _chain(self, state: AdamState) -> tuple[int, float, AdamState]:
        n, loss = 0, 0.0
        for task in range(self.tasks):
            rows = self.frame if self.tasks == 1 else self.frame.filter(F.col("home") == task)
            # One network from one task.
            for r in rows.mapInArrow(_steps(state, n, loss, self.epoch), _STATE_SCHEMA).collect():
                n, loss = r["n"], r["loss"]
                flat, m, v = np.frombuffer(r["state"], dtype=state.flat.dtype).reshape(3, -1).copy()
                state = AdamState(flat, m, v, r["steps"])
        return n, loss, state

    def _summed(self, state: AdamState) -> tuple[int, float, AdamState]:
        n, loss, settings = 0, 0.0, self.epoch.settings
        state = AdamState(state.flat.copy(), state.m.copy(), state.v.copy(), state.steps)
        for step in range(self.steps):
            rows = self.frame.filter(F.col("step") == step)
            total = summed(rows.mapInArrow(_gradients(state.flat, self.epoch), SCHEMA), self.units)
            if total is None:
                continue
            grad = (total[2:] / total[0]).astype(state.flat.dtype)
            state.step(grad, settings.learning_rate, settings.weight_decay)
            n, loss = n + int(total[0]), loss + float(total[1])
        return n, loss, state


def _loss_sum(
    flat: np.ndarray, dims: Sequence[int], pos_weight: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = _rows_of(batch, dims[0])
                losses = weighted_loss(logits(flat, dims, x).astype(np.float64), y, pos_weight)
                yield pa.RecordBatch.from_pydict({"loss": [math.fsum(losses)], "n": [len(y)]})

    return run


def _network_input(df: DataFrame, *more: Column) -> DataFrame:
    return df.select(F.col(LABEL).cast("float").alias("y"), F.col(FEATURES).alias("x"), *more)


@dataclass
class TrainingSummary:
    train_rows: int
    validation_rows: int
    best_epoch: int = 0
    epochs_completed: int = 0
    used_validation_split: bool = False
    history: list[dict[str, float]] = field(default_factory=list)

    def as_dict(self) -> dict[str, Any]:
        return asdict(self)


@dataclass
class MLPModel:
    """Fitted network with the transformation its inputs need."""

    preprocessor: PipelineModel
    dims: list[int]
    flat: np.ndarray
    dropout: float
    summary: TrainingSummary | None = None

    def probability(
        self, features: DataFrame, output: str = "probability", column: str = FEATURES
    ) -> DataFrame:
        """Add the positive-class probability to an assembled table; vectors stay sparse."""
        flat, dims = self.flat, list(self.dims)

        @F.arrow_udf("double")
        def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for part in parts:
                z = logits(flat, dims, SparseRows.of(part, dims[0])).astype(np.float64)
                yield pa.array(np.exp(-np.logaddexp(0.0, -z)))

        return features.withColumn(output, score(F.unwrap_udt(column)))


def place_of(key: str, seed: int) -> Column:
    """A row's place among all rows: a hash of seed and key."""
    return F.xxhash64(F.lit(seed), column(key).cast("string")).alias(PLACE)


def train_mlp(
    train: DataFrame,
    validation: DataFrame | None,
    preprocessor: PipelineModel,
    rows: tuple[int, int],
    pos_weight: float,
    settings: NetworkSettings = NetworkSettings(),
    seed: int = 42,
    log: EpochLog | None = None,
) -> MLPModel:
    """Train on assembled rows; ``rows`` are the known sizes of the two parts.

    Training rows carry ``place_of`` their key: which step and unit a row falls into follows from it,
    the seed and the epoch alone. ``log`` keeps every epoch; epochs it holds already are not trained
    again.
    """
    data = _network_input(train, F.col(PLACE).alias("place"))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    held = None
    if validation is not None:
        held = _network_input(validation).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        width = data.select("x").first()["x"].size
        dims = [width, *settings.hidden_dims, 1]
        state = AdamState.start(initial_parameters(dims, seed))
        best = state.flat
        rule = EarlyStopping(settings.early_stopping_patience, settings.min_delta)
        summary = TrainingSummary(rows[0], rows[1], used_validation_split=held is not None)
        done: list[EpochRecord] = []
        if log is not None:
            # What the epochs hang on; how many there may be and who computes them is free.
            told = {**asdict(settings), "epochs": 0, "tasks": 0}
            prints = data.agg(F.sum(F.xxhash64("place", "y").cast("decimal(38,0)"))).first()[0]
            given = (sorted(told.items()), dims, rows, pos_weight, seed, held is not None, str(prints))
            log.open(repr(given))
            done = log.records()

        def stopped(epoch: int, train_loss: float, loss: float | None) -> bool:
            """Note an epoch; whether it is the last."""
            record = {"epoch": epoch, "train_loss": round(train_loss, 6)}
            summary.history.append(record)
            if loss is None:
                summary.best_epoch = epoch
                return False
            record["val_loss"] = round(loss, 6)
            rule.improved(epoch, loss)
            summary.best_epoch = rule.best_epoch
            return rule.stop

        over = any([stopped(r.epoch, r.train_loss, r.val_loss) for r in done])
        if done:
            state = AdamState(*log.state(done[-1].epoch), done[-1].steps)
            best = log.state(summary.best_epoch)[0] if summary.best_epoch else best
        epoch = len(done)
        while epoch < settings.epochs and not over:
            epoch += 1
            dealt = _Dealt(data, rows[0], _Epoch(dims, settings, pos_weight, seed, epoch))
            state, train_loss = dealt.train(state)
            loss = None
            if held is not None:
                sums = (
                    held.mapInArrow(_loss_sum(state.flat, dims, pos_weight), "loss double, n bigint")
                    # Decimals add up alike in any order.
                    .agg(F.sum(F.col("loss").cast("decimal(38,10)")).alias("loss"), F.sum("n").alias("n"))
                    .first()
                )
                loss = float(sums["loss"]) / sums["n"]
            if log is not None:
                record = EpochRecord(epoch, state.steps, train_loss, loss)
                log.append(record, np.stack([state.flat, state.m, state.v]))
            over = stopped(epoch, train_loss, loss)
            if summary.best_epoch == epoch:
                best = state.flat
        summary.epochs_completed = len(summary.history)
    finally:
        data.unpersist()
        if held is not None:
            held.unpersist()
    return MLPModel(preprocessor, dims, best.copy(), settings.dropout, summary)
