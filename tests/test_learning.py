"""Models, training, accounting and evaluation."""

from __future__ import annotations

import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilmark import catalog
from veilmark.functions import features as ft
from veilmark.functions import kernels
from veilmark.operators import accounting as acc
from veilmark.operators import evaluate, model as md
from veilmark.plans.sweep import sweep
from veilmark.sources import synth


def test_scoring(spark):
    m = md.Model.by_rule([3, 4, 2, 2])
    x = np.random.default_rng(1).normal(size=(50, 3))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, features array<double>")
    rows = md.score(df, m).orderBy("id").collect()
    h = np.tanh(np.tanh(x @ m.layers[0][0] + m.layers[0][1]) @ m.layers[1][0] + m.layers[1][1])
    z = h @ m.layers[2][0] + m.layers[2][1]
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    assert [r["prob"] for r in rows] == pytest.approx(p[:, 1].tolist())
    assert [r["pred"] for r in rows] == p.argmax(axis=1).tolist()


def test_equal_vectors_are_scored_once(monkeypatch):
    layers = md.Model.random([6, 32, 32, 2]).layers
    rng = np.random.default_rng(3)
    few = np.round(rng.normal(size=(40, 6)), 1)
    few[0], few[1, 2], few[2, 2] = np.nan, 0.0, -0.0
    x, seen = few[rng.integers(0, 40, 5000)], []
    want = kernels.softmax(kernels.forward(layers, x)[-1])
    inner = kernels.forward
    monkeypatch.setattr(kernels, "forward", lambda layers, x: seen.append(len(x)) or inner(layers, x))
    assert np.allclose(kernels.probabilities(layers, x), want, rtol=1e-13, atol=0, equal_nan=True)
    assert seen == [40]
    different = rng.normal(size=(100, 6))
    assert np.allclose(kernels.probabilities(layers, different), kernels.softmax(inner(layers, different)[-1]), rtol=1e-13)
    assert seen == [40, 100] and kernels.probabilities(layers, x[:0]).shape == (0, 2)



def test_parameter_table(spark, tmp_path):
    a, b = md.Model.random([3, 4, 2], name="best_x", epsilon=2.0), md.Model.random([3, 4, 2], 7, name="last_x")
    path = str(tmp_path / "run_3.0")
    md.params_table(spark, [a, b]).write.parquet(path)
    assert np.array_equal(md.load_model(spark, path).flat(), a.flat())
    assert np.array_equal(md.load_model(spark, path, "last_x").flat(), b.flat())
    assert md.epsilon_of("x/run_epsilon_3.0") == 3.0
    with pytest.raises(FileNotFoundError):
        md.load_model(spark, path, "none")


def test_stored_configuration(spark, tmp_path):
    path, settings = str(tmp_path / "run_3.0"), tmp_path / "config.json"
    md.params_table(spark, [md.Model.random([6, 32, 32, 2], name="best_x")]).withColumn("epsilon", F.lit(None).cast("double")).write.parquet(path)
    assert md.read_config(spark, str(settings)) == md.Config(6, 32, None)  # no file: defaults
    model = md.load_model(spark, path, config=md.read_config(spark, str(settings)))
    assert model.epsilon == 3.0 and model.input_dim == 6
    settings.write_text('{\n "hidden_size": 32, "epsilon": 1.5, "layers": [1], "input_dim": null\n}')
    config = md.read_config(spark, str(settings))
    assert config == md.Config(6, 32, 1.5) and md.load_model(spark, path, config=config).epsilon == 1.5
    for other in (md.Config(input_dim=9), md.Config(hidden_size=64)):
        with pytest.raises(ValueError, match="its configuration"):
            md.load_model(spark, path, config=other)
    for text in ("[]", "{", '[{"epsilon": 1.0}, {}]'):
        settings.write_text(text)
        with pytest.raises(ValueError, match="one JSON object"):
            md.read_config(spark, str(settings))



@pytest.mark.parametrize("kind, weights", [("cross_entropy", (1.0, 1.0)), ("weighted", (1.0, 2.5)), ("sigmoid", (1.0, 3.0))])
def test_gradient_against_differences(kind, weights):
    m = md.Model.random([3, 4, 2, 2], 3)
    x, y = np.random.default_rng(2).normal(size=(5, 3)), np.array([0.0, 1, 1, 0, 1])
    g, loss, _ = kernels.clipped_gradient(m.layers, x, y, 1e9, kind, weights, False)

    def total(v):
        return kernels.loss_and_slope(kind, kernels.forward(m.with_flat(v).layers, x)[-1], y, weights)[0].sum()

    v, numeric = m.flat(), []
    for i in range(v.size):
        step = np.zeros(v.size)
        step[i] = 1e-6
        numeric.append((total(v + step) - total(v - step)) / 2e-6)
    assert loss == pytest.approx(total(v))
    assert g == pytest.approx(np.array(numeric), abs=1e-5)


def test_clipping_is_per_example():
    m = md.Model.random([3, 4, 2, 2], 3)
    x, y = np.random.default_rng(2).normal(size=(8, 3)) * 50, np.ones(8)
    one = [kernels.clipped_gradient(m.layers, x[i : i + 1], y[i : i + 1], 0.1, "cross_entropy", (1, 1), False)[0] for i in range(8)]
    assert all(np.linalg.norm(g) <= 0.1 + 1e-9 for g in one)
    both = kernels.clipped_gradient(m.layers, x, y, 0.1, "cross_entropy", (1, 1), False)[0]
    assert both == pytest.approx(sum(one))


@pytest.mark.parametrize("per_tensor", [False, True])
def test_clipped_sums_equal_a_plain_loop(per_tensor):
    m, clip = md.Model.random([3, 4, 2, 2], 3), 0.4
    x, y = np.random.default_rng(2).normal(size=(9, 3)) * 3, np.arange(9) % 2.0
    total = np.zeros(m.flat().size)
    for i in range(9):
        g = kernels.clipped_gradient(m.layers, x[i : i + 1], y[i : i + 1], 1e12, "cross_entropy", (1, 1), False)[0]
        ends = np.cumsum([t.size for pair in m.layers for t in pair])
        parts = np.split(g, ends[:-1]) if per_tensor else [g]
        total += np.concatenate([p * min(1.0, clip / np.linalg.norm(p)) for p in parts])
    assert kernels.clipped_gradient(m.layers, x, y, clip, "cross_entropy", (1, 1), per_tensor)[0] == pytest.approx(total)


def test_gradients_of_single_examples_are_not_written_out():
    m = md.Model.random([6, 32, 16, 2], 3)
    x = np.random.default_rng(2).normal(size=(20_000, 6))
    tracemalloc.start()
    kernels.clipped_gradient(m.layers, x, np.zeros(len(x)), 0.3, "cross_entropy", (1, 1), False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.shape[0] * m.flat().size * 8 / 2


def test_strategies_share_draws_and_jobs(spark):
    """The same histories as one training each, and no job more for a second strategy."""
    data = training_set(spark, 120).cache()
    args = dict(lr=0.05, batch_size=40, epochs=2, seed=5, hidden=4)
    tracker = spark.sparkContext.statusTracker()

    def jobs(runs):
        group = f"runs-{len(runs)}"
        spark.sparkContext.setJobGroup(group, "")
        done = md.train_runs(data, ["id"], runs, **args)
        spark.sparkContext._jsc.clearJobGroup()
        return done, len(tracker.getJobIdsForGroup(group))

    both, of_both = jobs([(8.0, "final"), (8.0, "simple")])
    first, of_one = jobs([(8.0, "final")])
    assert of_both == of_one > 0
    for trained, alone in zip(both, [first[0], md.train(data, ["id"], [8.0], "simple", **args)[8.0]]):
        for a, b in zip(trained.history, alone.history, strict=True):
            assert a == pytest.approx(b)


def test_noise_scales():
    base = math.sqrt(2 * math.log(1.25 / 1e-5))
    s = md.STRATEGIES
    assert s["final"].sigma(0.5) == pytest.approx(0.3 * base / 0.5)  # no floor unless asked for
    assert md.Strategy(eps_floor=1.0).sigma(0.5) == pytest.approx(md.Strategy(eps_floor=1.0).sigma(1.0))
    assert s["simple"].sigma(2.0) == pytest.approx(0.5 * 0.5 * base / 2)
    assert s["improved"].sigma(0.01) == pytest.approx(0.5 * base / 0.1)
    assert s["proper"].sigma(0.0) == 0.0
    assert s["inverse"].sigma(4.0) == 0.5 and s["inverse"].sigma(100.0) == 0.1


def training_set(spark, n=400):
    rows = synth.feature_matrix(spark.range(n), "id", 6, 0.3)
    return rows.withColumn("label", (F.get("features", F.lit(0)) + F.get("features", F.lit(1)) > 0.5).cast("int"))


def test_training_learns_and_repeats(spark):
    data = training_set(spark)
    args = dict(lr=0.05, batch_size=100, epochs=4, seed=5, hidden=8)
    done = md.train(data, ["id"], [1e6, 0.05], "final", **args)
    again = md.train(data.repartition(5), ["id"], [1e6], "final", **args)
    free, noisy = done[1e6].history, done[0.05].history
    assert free[-1]["val_f1"] > 0.85 and free[-1]["train_loss"] < free[0]["train_loss"]
    assert free[-1]["val_loss"] < noisy[-1]["val_loss"]
    assert len(free) == 4 and free[0]["grad_norm"] > 0
    # another partitioning gives the same draws; noise differs by the number of models only
    assert again[1e6].history[0]["train_loss"] == pytest.approx(free[0]["train_loss"], rel=0.05)
    table = md.history_table(spark, done)
    best = evaluate.best_epoch(table, ["epsilon"], "epoch", "val_f1").where("epsilon = 1000000").first()
    assert done[1e6].best.name == "best_eps_1000000.0" and best["epochs"] == 4


@pytest.mark.parametrize("rows_per_task", [2048, 50])
def test_an_epoch_equals_a_plain_loop(spark, monkeypatch, rows_per_task):
    """Steps, exchanged sums, noise and optimiser state over epochs, by one task and by two."""
    monkeypatch.setattr(md, "ROWS_PER_TASK", rows_per_task)
    data = training_set(spark, 200).cache()
    budgets, strategy = [1e6, 2.0], md.STRATEGIES["improved"]
    done = md.train(data, ["id"], budgets, strategy, lr=0.05, batch_size=100, epochs=3, seed=5, hidden=6, validation=data)
    assert md._tasks(spark, 100) == (1 if rows_per_task == 2048 else 2)
    models = [md.Model.random([6, 6, 3, 2], 42, f"eps_{e}", e) for e in budgets]
    opts = [md._Adam(0.05, strategy.weight_decay, 0.0, 0.0) for _ in models]
    for epoch in range(3):
        drawn = md.draw_steps(data, ["id"], 2, 0.5, 5 + epoch).orderBy("key").collect()
        rngs = [np.random.default_rng([5, epoch, k]) for k in range(2)]
        facts = np.zeros((2, 2))
        for step in range(2):
            batch = [r for r in drawn if r["step"] == step]
            x, y = np.array([r["features"] for r in batch]), np.array([float(r["label"]) for r in batch])
            for k, m in enumerate(models):
                g, loss, _ = kernels.clipped_gradient(m.layers, x, y, strategy.clip, strategy.loss, strategy.weights, False)
                facts[k] += loss, len(x)
                models[k] = m.with_flat(opts[k].step(m.flat(), md._add_noise(g, strategy, m.epsilon, rngs[k], m) / 100))
        for k, e in enumerate(budgets):
            assert done[e].history[epoch]["train_loss"] == pytest.approx(facts[k, 0] / facts[k, 1], rel=1e-9)
    for m, e in zip(models, budgets):
        assert done[e].last.flat() == pytest.approx(m.flat(), rel=1e-6, abs=1e-9)


def test_jobs_do_not_grow_with_steps(spark):
    data = training_set(spark, 60)
    tracker = spark.sparkContext.statusTracker()

    def jobs(batch_size):
        spark.sparkContext.setJobGroup(f"steps-{batch_size}", "")
        md.train(data, ["id"], [8.0], batch_size=batch_size, epochs=1, seed=1, hidden=4)
        spark.sparkContext._jsc.clearJobGroup()
        return len(tracker.getJobIdsForGroup(f"steps-{batch_size}"))

    assert jobs(2) == jobs(60) > 0


def test_empty_steps_and_repeated_ids(spark):
    """A step without rows only moves the parameters by noise; copies of an id are all drawn."""
    data = training_set(spark, 3).unionByName(training_set(spark, 1))
    done = md.train(data, ["id"], [1.0], batch_size=1, epochs=2, seed=3, hidden=4, validation=data)
    assert len(done[1.0].history) == 2 and np.isfinite(done[1.0].last.flat()).all()
    with pytest.raises(ValueError):
        md.train(data.limit(0), ["id"], [1.0])


def test_poisson_draws(spark):
    rows = spark.range(2000).select("id", F.array(F.lit(1.0)).alias("features"), F.lit(0).alias("label"))
    counts = md.draw_steps(rows, ["id"], 10, 0.1, 3).groupBy("step").count().collect()
    assert len(counts) == 10 and all(120 < r["count"] < 280 for r in counts)


def test_sweep(spark):
    rows = sweep(training_set(spark, 200), ["id"], [8.0, 1.0], lr=0.05, batch_size=100, epochs=1, seed=1, hidden=4).collect()
    assert [r["epsilon"] for r in rows] == [1.0, 8.0] and sum(r["is_best"] for r in rows) == 1
    assert all(r["n"] == 200 and r["epochs"] == 1 for r in rows)


def test_standardise(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "id long, a double, b double")
    fitted = ft.scaler(df, ["a", "b"])
    rows = ft.standardise(df, ["a", "b"]).orderBy("id").collect()
    assert [(r["a"], r["b"]) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]
    other = spark.createDataFrame([(9, 5.0, 6.0)], "id long, a double, b double")
    assert tuple(ft.standardise(other, ["a", "b"], fitted).first()) == (9, 3.0, 1.0)


# -- accounting -------------------------------------------------------------------------


def test_accounting_values(spark):
    row = spark.range(1).select(
        acc.simplified_cost(F.lit(0.25), F.lit(0.08), F.lit(39), F.lit(1e-5)).alias("cost"),
        acc.noise_multiplier(F.lit(3500), F.lit(32), F.lit(8.0), F.lit(1e-5), F.lit(15)).alias("sigma"),
        acc.noise_multiplier(F.lit(10), F.lit(32), F.lit(8.0), F.lit(1e-5), F.lit(1)).alias("one"),
        acc.noise_multiplier(F.lit(3500), F.lit(32), F.lit(0.0), F.lit(1e-5), F.lit(15)).alias("none"),
        acc.gaussian_sigma(F.lit(0.0), F.lit(1e-5)).alias("off"),
        acc.unsampled_rdp(F.lit(0.0), F.lit(2)).alias("endless"),
    ).first()
    assert row["cost"] == pytest.approx(0.42379433367, rel=1e-9)
    base = math.sqrt(2 * math.log(1.25 / 1e-5)) / 8
    assert row["sigma"] == pytest.approx(max(base / math.sqrt(15 * 3500 // 32), 0.1))
    assert row["one"] == pytest.approx(base) and row["none"] == 0.0 and row["off"] == 0.0 and row["endless"] == math.inf


def epsilon_after(sigmas):
    rdp = {a: sum(a / (2 * s * s) if s > 0 else math.inf for s in sigmas) for a in range(2, 65)}
    return min(r + math.log(1e5) / (a - 1) for a, r in rdp.items())


def test_accountant(spark):
    data = [("a", i, s) for i, s in enumerate([4.0, 4.0, 6.0, 9.0])] + [("b", 0, 20.0)] + [("z", 0, 0.0)]
    df = spark.createDataFrame(data, "k string, step long, sigma double")
    spent = {r["k"]: (r["steps"], r["epsilon"]) for r in acc.spent(df, ["k"]).collect()}
    assert spent["a"] == (4, pytest.approx(epsilon_after([4, 4, 6, 9]))) and spent["z"][1] == math.inf
    assert spent["b"][1] == pytest.approx(epsilon_after([20]))
    path = [r["epsilon"] for r in acc.spent_so_far(df, ["k"], ["step"]).where("k = 'a'").orderBy("step").collect()]
    assert path == pytest.approx([epsilon_after([4.0, 4.0, 6.0, 9.0][: i + 1]) for i in range(4)])
    lower = [epsilon_after([s]) for s in (1.0, 2.0, 5.0)]
    assert lower == sorted(lower, reverse=True)


# -- evaluation -------------------------------------------------------------------------

# Published confusion matrices and metrics by budget (fixed values).
PUBLISHED = {
    8.0: ((621, 4, 0, 125), (0.9947, 0.9690, 1.0000, 0.9843, 0.1613)),
    5.0: ((557, 68, 0, 125), (0.9093, 0.6477, 1.0000, 0.7862, 0.0760)),
    3.0: ((538, 87, 0, 125), (0.8840, 0.5896, 1.0000, 0.7418, 0.0507)),
    2.0: ((517, 108, 0, 125), (0.8560, 0.5365, 1.0000, 0.6983, 0.0227)),
    1.0: ((443, 182, 5, 120), (0.7507, 0.3974, 0.9600, 0.5621, -0.0827)),
    0.5: ((443, 182, 5, 120), (0.7507, 0.3974, 0.9600, 0.5621, -0.0827)),
}


def test_published_metrics(spark):
    cells = [(e, y, p, c) for e, (m, _) in PUBLISHED.items() for (y, p), c in zip([(0, 0), (0, 1), (1, 0), (1, 1)], m)]
    df = spark.createDataFrame(cells, "epsilon double, y int, p int, c int").select(
        "epsilon", "y", "p", F.explode(F.array_repeat(F.lit(1), F.col("c"))).alias("one")
    )
    rows = evaluate.metrics(evaluate.confusion(df, "y", "p", by=["epsilon"]))
    got = {r["epsilon"]: r for r in rows.collect()}
    for e, (m, (acc_, prec, rec, f1, gain)) in PUBLISHED.items():
        r = got[e]
        assert (r["tn"], r["fp"], r["fn"], r["tp"]) == m
        assert [r["accuracy"], r["precision"], r["recall"], r["f1_score"], r["improvement"]] == pytest.approx(
            [acc_, prec, rec, f1, gain], abs=5.1e-5
        )
        assert r["baseline_accuracy"] == pytest.approx(0.8333, abs=5e-5)
    best = [r["epsilon"] for r in evaluate.compare_budgets(rows).collect() if r["is_best"]]
    assert best == [8.0]
    named = {r["epsilon"]: r["report_level"] for r in evaluate.privacy_levels(rows).collect()}
    assert named == {e: c for e, _, _, c in catalog.PRIVACY_LEVELS}


F1_HISTORY = {  # published validation F1 by epoch
    "eps8": [0.7130919, 0.7058824, 0.7272727, 0.7543860, 0.7914110, 0.8164557, 0.8716216, 0.9084507, 0.9772727, 0.9961390],
    "eps05": [0.6291560, 0.5104408, 0.5057471, 0.5288889, 0.5353982, 0.5600000],
}


def test_run_histories(spark):
    rows = [(run, i, v, 1.0 - v) for run, vs in F1_HISTORY.items() for i, v in enumerate(vs)]
    rows += [("boom", i, 0.5, v) for i, v in enumerate([0.5, 1.0, 11.0])] + [("fine", 0, 0.9, 0.05)]
    df = spark.createDataFrame(rows, "run string, epoch int, f1 double, loss double")
    best = {r["run"]: r["best_epoch"] for r in evaluate.best_epoch(df, ["run"], "epoch", "f1").collect()}
    assert best["eps8"] == 9 and best["eps05"] == 0 and best["boom"] == 0
    lowest = {r["run"]: r["best_epoch"] for r in evaluate.best_epoch(df, ["run"], "epoch", "loss", smaller=True).collect()}
    assert lowest["eps8"] == 9 and lowest["boom"] == 0
    stop = {r["run"]: r["stop_epoch"] for r in evaluate.early_stop(df, ["run"], "epoch", "f1", 5).collect()}
    assert stop["eps05"] == 5 and stop["eps8"] is None
    alarms = {r["run"]: (r["exploded"], r["diverged"], r["converged"]) for r in evaluate.loss_alarms(df, ["run"], "epoch", "loss").collect()}
    assert alarms["boom"] == (True, True, False) and alarms["fine"] == (False, False, True)
    ranks = {r["run"]: r["rank"] for r in evaluate.rank_runs(df, "run", "f1").collect()}
    assert ranks == {"eps8": 1, "fine": 2, "eps05": 3, "boom": 4}
    assert evaluate.rank_runs(df.where("run = 'eps8'"), "run", "f1").count() == 0


def test_curves(spark):
    data = [(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.3), (0, 0.2), (0, 0.2), (0, 0.1)]
    df = spark.createDataFrame(data, "y int, s double")
    pairs = [(p > n) + 0.5 * (p == n) for y, p in data if y for z, n in data if not z]
    assert evaluate.auc(df, "y", "s").first()["auc"] == pytest.approx(sum(pairs) / len(pairs))
    roc = [(r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df, "y", "s").orderBy(F.desc("threshold")).collect()]
    want = [(0, 1 / 3), (0.25, 2 / 3), (0.25, 1.0), (0.75, 1.0), (1.0, 1.0)]
    assert [v for point in roc for v in point] == pytest.approx([v for point in want for v in point])
    pr = [(r["precision"], r["recall"]) for r in evaluate.precision_recall_curve(df, "y", "s").orderBy(F.desc("threshold")).collect()]
    assert pr[0] == (1.0, pytest.approx(1 / 3)) and pr[-1] == (pytest.approx(3 / 7), 1.0)


def test_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = evaluate.metrics(evaluate.confusion(df, "y", "p")).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_losses(spark):
    z, y = [[0.3, -1.2], [2.0, 2.5], [-30.0, 40.0]], [1, 0, 0]
    df = spark.createDataFrame(list(zip(z, y)), "z array<double>, y int")
    rows = df.select(
        evaluate.cross_entropy(F.col("z"), F.col("y")).alias("ce"),
        evaluate.weighted_cross_entropy(F.col("z"), F.col("y"), (1.0, 2.0)).alias("w"),
        evaluate.weighted_sigmoid(F.col("z"), F.col("y"), 3.0).alias("s"),
    ).collect()
    for r, a, t in zip(rows, np.array(z), y):
        for value, kind, weights in ((r["ce"], "cross_entropy", (1, 1)), (r["w"], "weighted", (1.0, 2.0)), (r["s"], "sigmoid", (1.0, 3.0))):
            assert value == pytest.approx(kernels.loss_and_slope(kind, a[None], np.array([float(t)]), weights)[0][0])


def test_runs_without_a_metric_have_no_rank(spark):
    rows = spark.createDataFrame([("a", 0.5), ("b", None), ("c", 0.7), ("a", 0.1)], "run string, f1 double")
    assert {r["run"]: r["rank"] for r in evaluate.rank_runs(rows, "run", "f1").collect()} == {"c": 1, "a": 2}
