"""Small classifiers: parameter tables, scoring and training under privacy noise.

The data stays distributed, and an epoch is one job whatever its number of steps. The
rows drawn for its steps are dealt out over tasks that run at the same time (a barrier
stage) and read them in the order of the steps. At each step every task adds up its
per-example-clipped gradients, the tasks exchange these sums (about 800 numbers a model),
and each moves its own copy of the parameters by the same noisy sum. All models of a
sweep share the epoch's job. A lost executor costs that epoch: parameters, optimiser
state and the noise's seed at its start are with the driver.
"""

from __future__ import annotations

import base64
import math
import secrets
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from veilmark.functions import kernels
from veilmark.functions.arrays import let
from veilmark.functions.text import uniform
from veilmark.sources.shared import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a batch that make another task worth its exchange of sums.
ROWS_PER_TASK = 2048
#: Tasks of an epoch: each gets the sums of all others at every step.
MOST_TASKS = 64
PARAMS_SCHEMA = "model string, epsilon double, layer int, w array<array<double>>, b array<double>"


@dataclass
class Model:
    """Dense layers (weights, bias) with tanh in between and two outputs."""

    layers: list[tuple[np.ndarray, np.ndarray]]
    name: str = "model"
    epsilon: float = 8.0

    @staticmethod
    def random(dims: list[int], seed: int = 42, name: str = "model", epsilon: float = 8.0) -> Model:
        rng = np.random.default_rng(seed)
        layers = [(rng.normal(0, 1 / math.sqrt(a), (a, b)), np.zeros(b)) for a, b in zip(dims, dims[1:])]
        return Model(layers, name, epsilon)

    @staticmethod
    def by_rule(dims: list[int], phase: float = 0.0, name: str = "rule", epsilon: float = 8.0) -> Model:
        """Parameters from a formula, for checks that must know them elsewhere."""
        layers = [
            (
                np.array([[round(math.sin(3.0 * i + 5.0 * j + 7.0 * k + phase), 6) for j in range(b)] for i in range(a)]),
                np.array([round(math.cos(2.0 * j + k), 6) for j in range(b)]),
            )
            for k, (a, b) in enumerate(zip(dims, dims[1:]))
        ]
        return Model(layers, name, epsilon)

    def flat(self) -> np.ndarray:
        return np.concatenate([t.ravel() for pair in self.layers for t in pair])

    def with_flat(self, v: np.ndarray) -> Model:
        layers, at = [], 0
        for w, b in self.layers:
            layers.append((v[at : at + w.size].reshape(w.shape), v[at + w.size : at + w.size + b.size]))
            at += w.size + b.size
        return replace(self, layers=layers)

    @property
    def input_dim(self) -> int:
        return self.layers[0][0].shape[0]


def score(df: DataFrame, model: Model, features: str = "features") -> DataFrame:
    """Adds ``pred`` (0/1) and ``prob`` (of class 1)."""
    scored = df.withColumn("_s", kernels.mlp(model.layers)(F.col(features)))
    return scored.select("*", F.col("_s.pred").alias("pred"), F.col("_s.prob").alias("prob")).drop("_s")


def params_table(spark: SparkSession, models: list[Model]) -> DataFrame:
    rows = [
        (m.name, float(m.epsilon), i, w.tolist(), b.tolist()) for m in models for i, (w, b) in enumerate(m.layers)
    ]
    return spark.createDataFrame(rows, PARAMS_SCHEMA)


def epsilon_of(name: str) -> float:
    """Budget from a directory-like name: what follows the last underscore."""
    return float(name.rstrip("/").split("/")[-1].split("_")[-1])


@dataclass
class Config:
    """Stored settings of a model: number of features, width of the hidden layers, budget."""

    input_dim: int = 6
    hidden_size: int = 32
    epsilon: float | None = None


def read_config(spark: SparkSession, path: str) -> Config:
    """Settings from a JSON object in a file; those that are absent or null, and all
    of a file that does not exist, have their defaults. Other fields are ignored."""
    schema = "input_dim int, hidden_size int, epsilon double, _bad string"
    try:
        rows = spark.read.json(path, schema=schema, multiLine=True, columnNameOfCorruptRecord="_bad").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return Config()
    if len(rows) != 1 or rows[0]["_bad"] is not None:
        raise ValueError(f"{path} is not one JSON object")
    return Config(**{k: v for k, v in rows[0].asDict().items() if v is not None})


def load_model(spark: SparkSession, path: str, name: str | None = None, config: Config | None = None) -> Model:
    """Model from a parameter table; ``name`` defaults to the best, then the last.

    Layers that do not have the widths of ``config`` raise a ValueError. The budget is
    the table's, else the configuration's, else the one in the folder's name.
    """
    rows = spark.read.parquet(path)
    if name is None:
        first = rows.agg(*[F.min(F.when(F.col("model").startswith(p), F.col("model"))).alias(p) for p in ("best", "last")]).first()
        name = first["best"] or first["last"]
        if name is None:
            raise FileNotFoundError(f"no best or last model in {path}")
    layers = rows.where(F.col("model") == name).orderBy("layer").collect()
    if not layers:
        raise FileNotFoundError(f"no model {name!r} in {path}")
    weights = [(np.array(r["w"]), np.array(r["b"])) for r in layers]
    eps = layers[0]["epsilon"]
    if config is not None:
        widths = [w.shape[0] for w, _ in weights]
        if widths[0] != config.input_dim:
            raise ValueError(f"model {name!r} has {widths[0]} features, its configuration {config.input_dim}")
        if len(widths) > 1 and widths[1] != config.hidden_size:
            raise ValueError(f"model {name!r} has {widths[1]} hidden units, its configuration {config.hidden_size}")
        eps = config.epsilon if eps is None else eps
    return Model(weights, name, epsilon_of(path) if eps is None else eps)


# -- privacy strategies ----------------------------------------------------------


@dataclass
class Strategy:
    """How gradients are clipped and how much noise they get."""

    clip: float = 0.3
    eps_floor: float = 0.0
    noise_factor: float = 1.0
    noise_by_norm: bool = False
    multiplier: str = "gaussian"  # or "inverse": max(0.1, 2 / eps)
    loss: str = "cross_entropy"  # "weighted", "sigmoid"
    weights: tuple[float, float] = (1.0, 1.0)
    per_tensor: bool = False
    weight_decay: float = 0.0
    delta: float = 1e-5

    def sigma(self, epsilon: float) -> float:
        """Standard deviation of the noise on the clipped sum of one step."""
        if epsilon <= 0 and self.eps_floor <= 0:
            return 0.0
        eps = max(epsilon, self.eps_floor)
        if self.multiplier == "inverse":
            return max(0.1, 2.0 / eps) * self.clip
        return self.noise_factor * self.clip * math.sqrt(2 * math.log(1.25 / self.delta)) / eps


#: variants differ in clip norm, budget floor, noise and loss (fixed values)
STRATEGIES: dict[str, Strategy] = {
    "final": Strategy(clip=0.3),
    "improved": Strategy(clip=0.5, eps_floor=0.1, noise_by_norm=True, loss="weighted", weight_decay=1e-4),
    "simple": Strategy(clip=0.5, eps_floor=1.0, noise_factor=0.5, loss="sigmoid", weights=(1.0, 3.0)),
    "proper": Strategy(clip=1.0),
    "inverse": Strategy(clip=1.0, multiplier="inverse", weight_decay=0.01),
}


@dataclass
class _Adam:
    lr: float
    decay: float
    m: np.ndarray
    v: np.ndarray
    t: int = 0

    def step(self, params: np.ndarray, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * grad
        self.v = 0.999 * self.v + 0.001 * grad**2
        mhat, vhat = self.m / (1 - 0.9**self.t), self.v / (1 - 0.999**self.t)
        return params - self.lr * (mhat / (np.sqrt(vhat) + 1e-8) + self.decay * params)


@dataclass
class Trained:
    best: Model
    last: Model
    history: list[dict] = field(default_factory=list)


def draw_steps(data: DataFrame, ids: list[str], steps: int, q: float, seed: int) -> DataFrame:
    """Poisson sampling for all steps in one pass: (step, features, label, key).

    Each row joins each step with probability q. The gaps between the steps of a row
    are geometric, so a row jumps from hit to hit: the work is the expected number of
    hits, whatever the number of steps. A row takes up to a number of hits that is
    exceeded with a chance below 1e-20.
    """
    mean = steps * q
    most = math.ceil(min(steps, mean + 12 * math.sqrt(mean) + 40))

    def jump(state: Column, i: Column) -> Column:
        u = uniform(F.lit(seed), i, *[F.col(c) for c in ids])
        gap = F.floor(F.log(1 - u) / F.lit(math.log1p(-q))) if q < 1 else F.lit(0)
        at = F.least(state["at"] + 1 + gap, F.lit(steps)).cast("long")

        def arrive(at: Column) -> Column:
            return F.struct(at.alias("at"), F.when(at < steps, F.array_append(state["hits"], at)).otherwise(state["hits"]).alias("hits"))

        # One number a jump, and none once a row is past the last step.
        return F.when(state["at"] < steps, let(at, arrive)).otherwise(state)

    start = F.struct(F.lit(-1).cast("long").alias("at"), F.array().cast("array<bigint>").alias("hits"))
    hits = F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, jump)["hits"]
    drawn = data.select("features", "label", F.xxhash64(*ids).alias("key"), F.explode_outer(hits).alias("step"))
    return drawn.where("step IS NOT NULL").withColumn("step", F.col("step").cast("int"))


def _tasks(spark: SparkSession, batch_size: int) -> int:
    """How many tasks share a batch. They run at the same time, which sessions that ask
    for executors as they go do not offer."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 1
    return max(1, min(math.ceil(batch_size / ROWS_PER_TASK), MOST_TASKS, spark.sparkContext.defaultParallelism))


EPOCH_SCHEMA = "model int, params array<double>, m array<double>, v array<double>, loss double, norm double, n long"


def _by_step(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(step, features, labels) of rows in the order of steps; the rows of one step may
    come in several pieces."""
    for part in batches:
        if not part.num_rows:
            continue
        steps = part["step"].to_numpy(zero_copy_only=False)
        x = part["features"].flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)
        y = part["label"].to_numpy(zero_copy_only=False).astype(float)
        cuts = np.flatnonzero(np.diff(steps)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, part.num_rows], strict=True):
            yield int(steps[lo]), x[lo:hi], y[lo:hi]


def _epoch(
    models: list[Model], opts: list[_Adam], strategies: list[Strategy], seeds: list[list[int]], steps: int, expected: float, width: int, tasks: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """mapInArrow body: the steps of one epoch over this task's rows, sorted by step.

    ``seeds`` are those of each model's noise, the same in all tasks, so that their
    parameters stay equal. The first task returns them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get() if tasks > 1 else None
        now, state = list(models), [replace(o) for o in opts]
        rngs = [np.random.default_rng(s) for s in seeds]
        size = models[0].flat().size
        facts = np.zeros((len(models), 3))  # loss, norm, rows
        pieces = _by_step(batches, width)
        ahead = next(pieces, None)
        for step in range(steps):
            sums = np.zeros((len(models), size + 3))
            while ahead is not None and ahead[0] == step:
                _, x, y = ahead
                for k, (m, how) in enumerate(zip(now, strategies)):
                    g, loss, norm = kernels.clipped_gradient(m.layers, x, y, how.clip, how.loss, how.weights, how.per_tensor)
                    sums[k, :size] += g
                    sums[k, size:] += loss, norm, len(x)
                ahead = next(pieces, None)
            if context is not None:
                told = context.allGather(base64.b64encode(sums.tobytes()).decode())
                sums = sum(np.frombuffer(base64.b64decode(t)).reshape(sums.shape) for t in told)
            for k, m in enumerate(now):
                noisy = _add_noise(sums[k, :size], strategies[k], m.epsilon, rngs[k], m)
                now[k] = m.with_flat(state[k].step(m.flat(), noisy / max(expected, 1.0)))
            facts += sums[:, size:]
        if context is None or context.partitionId() == 0:
            doubles = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(now)), pa.int32()),
                    *(pa.array([v.tolist() for v in vs], doubles) for vs in ([m.flat() for m in now], [o.m for o in state], [o.v for o in state])),
                    pa.array(facts[:, 0]), pa.array(facts[:, 1]), pa.array(facts[:, 2].astype(np.int64)),
                ],
                names=["model", "params", "m", "v", "loss", "norm", "n"],
            )

    return run


def train(
    data: DataFrame,
    ids: list[str],
    budgets: list[float],
    strategy: Strategy | str = "final",
    **options,
) -> dict[float, Trained]:
    """Train one model per budget on (ids, features, label) rows; ``options`` as for
    :func:`train_runs`."""
    done = train_runs(data, ids, [(e, strategy) for e in budgets], **options)
    return dict(zip(budgets, done))


def train_runs(
    data: DataFrame,
    ids: list[str],
    runs: list[tuple[float, Strategy | str]],
    hidden: int = 32,
    lr: float = 5e-4,
    batch_size: int = 32,
    epochs: int = 15,
    patience: int = 5,
    seed: int | None = None,
    validation: DataFrame | None = None,
    select_by: str = "f1",
    init_seed: int = 42,
) -> list[Trained]:
    """Train one model per (budget, strategy) on (ids, features, label) rows, all of them
    over the same draws.

    Deliberate differences from common practice in small scripts: clipping is per
    example, every step draws fresh noise (``seed`` is for tests only), and
    no budget floor applies unless the strategy names one. Without ``validation`` a tenth
    of the rows, by hash of their ids, is held out for it (all rows, if that is none).
    """
    strategies = [STRATEGIES[s] if isinstance(s, str) else s for _, s in runs]
    spark = data.sparkSession
    sample_seed = seed if seed is not None else secrets.randbits(31)
    noise_seed = seed if seed is not None else secrets.randbits(128)
    data = data.select(*ids, "features", "label")
    if validation is None:
        held_out = uniform(F.lit("validation"), F.lit(init_seed), *[F.col(i) for i in ids]) < 0.1
        data = cut(data.withColumn("_held", held_out), "training")
        if not data.where("_held").isEmpty() and not data.where("NOT _held").isEmpty():
            data, validation = data.where("NOT _held"), data.where("_held")
    else:
        data = cut(data, "training")
    facts = data.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("d")).first()
    n, width = facts["n"], facts["d"]
    if not n:
        raise ValueError("no training rows")
    q = min(1.0, batch_size / n)
    per_epoch = max(1, math.ceil(n / batch_size))
    tasks = _tasks(spark, batch_size)

    dims = [width, hidden, hidden // 2, 2]
    models = [Model.random(dims, init_seed, f"eps_{e}", e) for e, _ in runs]
    opts = [_Adam(lr, s.weight_decay, np.zeros(m.flat().size), np.zeros(m.flat().size)) for m, s in zip(models, strategies)]
    # Runs of one strategy have noise of their own.
    own = [strategies[:k].count(s) for k, s in enumerate(strategies)]
    out = [Trained(m, m) for m in models]
    best = [-math.inf] * len(runs)
    stale = [0] * len(runs)
    active = list(range(len(models)))

    for epoch in range(epochs):
        drawn = draw_steps(data, ids, per_epoch, q, sample_seed + epoch)
        # Dealt out by row, so that an id with many rows is spread as well.
        dealt = drawn.withColumn("row", F.monotonically_increasing_id()).repartition(tasks, "row").sortWithinPartitions("step")
        body = _epoch(
            [models[k] for k in active], [opts[k] for k in active], [strategies[k] for k in active],
            [[noise_seed, epoch, own[k]] for k in active], per_epoch, q * n, width, tasks,
        )
        # One row per model, whatever the data size.
        done = {r["model"]: r for r in dealt.select("step", "features", "label").mapInArrow(body, EPOCH_SCHEMA, barrier=tasks > 1).collect()}
        for slot, k in enumerate(active):
            row = done[slot]
            models[k] = models[k].with_flat(np.array(row["params"]))
            opts[k] = replace(opts[k], m=np.array(row["m"]), v=np.array(row["v"]), t=opts[k].t + per_epoch)
        judged = _validate(validation if validation is not None else data, [models[k] for k in active])
        for slot, k in enumerate(list(active)):
            loss, norm, count = done[slot]["loss"], done[slot]["norm"], done[slot]["n"]
            entry = {
                "epsilon": runs[k][0], "epoch": epoch,
                "train_loss": loss / max(count, 1), "grad_norm": norm / max(count, 1),
            }
            entry |= judged[slot]
            out[k].history.append(entry)
            out[k].last = models[k]
            quality = entry["val_f1"] if select_by == "f1" else -entry["val_loss"]
            if quality > best[k]:
                best[k], stale[k], out[k].best = quality, 0, replace(models[k], name=f"best_eps_{runs[k][0]}")
            else:
                stale[k] += 1
            if stale[k] >= patience or entry["train_loss"] > 10.0:
                active.remove(k)
        if not active:
            break
    return out


def _add_noise(grad, strategy: Strategy, epsilon: float, rng, model: Model) -> np.ndarray:
    sigma = strategy.sigma(epsilon)
    if sigma == 0.0:
        return grad
    noise = rng.normal(0.0, 1.0, grad.size)
    if strategy.noise_by_norm:
        at = 0
        for w, b in model.layers:
            for t in (w, b):
                noise[at : at + t.size] *= np.linalg.norm(grad[at : at + t.size]) + 1e-10
                at += t.size
    return grad + sigma * noise


def _validate(data: DataFrame, models: list[Model]) -> list[dict[str, float]]:
    """Metrics of every model over the same rows, in one job."""
    from veilmark.operators.evaluate import confusion, metrics

    scored = data.select("label", *[kernels.mlp(m.layers)(F.col("features")).alias(f"_m{k}") for k, m in enumerate(models)])
    each = F.array(*[F.struct(F.lit(k).alias("model"), F.col(f"_m{k}.pred").alias("pred"), F.col(f"_m{k}.prob").alias("prob")) for k in range(len(models))])
    rows = scored.select("label", F.explode(each).alias("x")).select("label", "x.*")
    p1 = F.least(F.greatest(F.col("prob"), F.lit(1e-12)), F.lit(1 - 1e-12))
    loss = F.avg(-F.log(F.when(F.col("label") == 1, p1).otherwise(1 - p1)))
    none = {"val_loss": None} | dict.fromkeys(("accuracy", "precision", "recall", "f1_score"), 0.0)  # without rows
    found = {r["model"]: r for r in metrics(confusion(rows, "label", "pred", by=["model"], extra={"val_loss": loss})).collect()}
    return [
        {
            "val_loss": row["val_loss"], "val_acc": row["accuracy"], "val_precision": row["precision"],
            "val_recall": row["recall"], "val_f1": row["f1_score"],
        }
        for row in (found.get(k, none) for k in range(len(models)))
    ]


def history_table(spark: SparkSession, trained: dict[float, Trained]) -> DataFrame:
    """One row per budget and epoch."""
    schema = (
        "epsilon double, epoch int, train_loss double, grad_norm double, val_loss double, "
        "val_acc double, val_precision double, val_recall double, val_f1 double"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(h[c] for c in names) for t in trained.values() for h in t.history], schema)
