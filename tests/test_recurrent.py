import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtrail.operators import recurrent
from fixtrail.operators.recurrent_cells import Architecture, Autoencoder, TrainingState, train_epoch


def test_parameter_counts():
    assert Architecture(3, 7, "gru").size == 12_999
    assert Architecture(3, 7, "lstm").size == 16_871
    with pytest.raises(ValueError, match="cell must be"):
        Architecture(3, 7, "rnn")


@pytest.mark.parametrize("cell", ["gru", "lstm"])
@pytest.mark.parametrize("activation", ["tanh", "relu"])
def test_gradient_by_finite_differences(cell, activation):
    arch = Architecture(3, 2, cell, activation, dropout=0.0)
    rng = np.random.default_rng(0)
    flat = arch.initial([(1, 0), (1, 1)]) + rng.normal(0, 0.05, (2, arch.size))
    x = rng.normal(size=(2, 3, 4, 2))
    net = Autoencoder(arch, flat)
    grad = net.backward(2 * (net.forward(x) - x))

    def loss(weights):
        return np.sum((Autoencoder(arch, weights).forward(x) - x) ** 2, axis=(1, 2, 3))

    step = 1e-6
    checked = 0
    for i in rng.choice(arch.size, 120, replace=False):
        up, down = flat.copy(), flat.copy()
        up[:, i] += step
        down[:, i] -= step
        numeric = (loss(up) - loss(down)) / (2 * step)
        np.testing.assert_allclose(grad[:, i], numeric, rtol=1e-3, atol=1e-5)
        checked += int(np.any(np.abs(numeric) > 1e-4))
    assert checked > 20


@pytest.mark.parametrize("cell", ["gru", "lstm"])
def test_cell_formula_step_by_step(cell):
    """First encoder layer against the published gate equations."""
    arch = Architecture(2, 3, cell, dropout=0.0)
    rng = np.random.default_rng(4)
    flat = arch.initial([(2, 0)]) + rng.normal(0, 0.1, (1, arch.size))
    w = {k: v[0] for k, v in arch.views(flat).items()}
    x = rng.normal(size=(1, 2, 1, 3))
    got = Autoencoder(arch, flat).layers[0].forward(x)[0, :, 0]

    def sig(v):
        return 1 / (1 + np.exp(-v))

    h, c = np.zeros(32), np.zeros(32)
    for t in range(2):
        a = x[0, t, 0] @ w["w0"] + w["b0"][0]
        if cell == "gru":
            b = h @ w["u0"] + w["b0"][1]
            z, r = sig(a[:32] + b[:32]), sig(a[32:64] + b[32:64])
            h = z * h + (1 - z) * np.tanh(a[64:] + r * b[64:])
        else:
            a = a + h @ w["u0"]
            i, f, o = sig(a[:32]), sig(a[32:64]), sig(a[96:])
            c = f * c + i * np.tanh(a[64:96])
            h = o * np.tanh(c)
        np.testing.assert_allclose(got[t], h, rtol=1e-10)


def test_initial_weights():
    arch = Architecture(3, 7, "lstm")
    w = arch.views(arch.initial([(5, 0)]))
    np.testing.assert_allclose(w["u0"][0] @ w["u0"][0].T, np.eye(32), atol=1e-10)
    assert np.all(w["b0"][0, 0, 32:64] == 1) and np.all(w["b0"][0, 0, :32] == 0)
    assert np.abs(w["wd"]).max() <= np.sqrt(6 / (32 + 7))


def test_models_learn_only_from_their_rows():
    arch = Architecture(3, 2, dropout=0.0)
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(100, 3, 2))
    members = np.zeros((2, 100), bool)
    members[0, :70] = members[1, 30:] = True
    flat = arch.initial([(1, 0), (1, 1)])

    def run(keep):
        part = flat[keep]
        state = TrainingState(part.copy(), np.zeros_like(part), np.zeros_like(part), np.zeros(len(part)))
        train_epoch(arch, state, rows, members[keep], 200, np.random.default_rng(1))
        return state.weights

    # full batches do not depend on the row order, so training together changes nothing
    np.testing.assert_allclose(run([0, 1])[1], run([1])[0], atol=1e-9)


@pytest.fixture(scope="module")
def windows(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(600, 1))
    rows = [
        (i, [float(v) for v in np.repeat(b, 6) + rng.normal(0, 0.05, 6)]) for i, b in enumerate(base)
    ]
    rows.append((600, None))
    rows.append((601, [1.0, None, 1.0, 1.0, 1.0, 1.0]))
    return spark.createDataFrame(rows, "row_id long, seq array<double>").cache()


ARCH = Architecture(3, 2)


@pytest.mark.parametrize("cell", ["gru", "lstm"])
def test_training_lowers_the_loss(windows, cell):
    arch = Architecture(3, 2, cell)
    models = recurrent.train_autoencoders(
        windows, {"all": F.lit(True), "none": F.col("row_id") < 0}, arch, epochs=8, batch_size=16
    )
    assert list(models) == ["all"]
    losses = models["all"].losses
    assert len(losses) == 8 and losses[-1] < 0.6 * losses[0]
    out = recurrent.with_autoencoder_scores(windows, models).orderBy("row_id").collect()
    assert [r["all_score"] for r in out[600:]] == [None, None]
    assert np.mean([r["all_score"] for r in out[:600]]) < losses[0]


def test_scores_match_numpy(windows):
    models = recurrent.train_autoencoders(windows, {"a": F.lit(True), "b": F.col("row_id") < 99}, ARCH, epochs=1)
    out = recurrent.with_autoencoder_scores(windows.where("row_id < 600"), models).toPandas()
    x = np.stack(out["seq"]).reshape(-1, 3, 2)
    for name in "ab":
        net = Autoencoder(ARCH, models[name].weights[None].astype(np.float64))
        guess = net.forward(x.swapaxes(0, 1)[None])[0].swapaxes(0, 1)
        want = np.mean((x - guess) ** 2, axis=(1, 2))
        np.testing.assert_allclose(out[f"{name}_score"], want, rtol=1e-4)


def test_training_ignores_partitioning(windows):
    def run(df):
        return recurrent.train_autoencoders(
            df, {"a": F.lit(True), "b": F.col("row_id") < 300}, ARCH, epochs=2, rows_per_shard=100
        )

    one, two = run(windows), run(windows.repartition(7, "seq"))
    for name in "ab":
        np.testing.assert_allclose(one[name].weights, two[name].weights, atol=1e-6)


def test_one_shard_is_sequential_training(windows):
    """Spark with a single shard against the same mini-batches run in this process."""
    trained = recurrent.train_autoencoders(windows, {"a": F.lit(True)}, ARCH, epochs=3, seed=5)["a"]
    rows = [r["seq"] for r in windows.where("row_id < 600").orderBy("row_id").collect()]
    x = np.array(rows, dtype=np.float32).reshape(-1, 3, 2)
    flat = ARCH.initial([(5, 0)]).astype(np.float32)
    state = TrainingState(flat, np.zeros_like(flat), np.zeros_like(flat), np.zeros(1))
    losses = []
    for epoch in range(3):
        rng = np.random.default_rng([5, epoch, 0])
        losses.append(train_epoch(ARCH, state, x, np.ones((1, 600), bool), 64, rng)[0] / 600)
    np.testing.assert_allclose(trained.losses, losses, rtol=1e-5)
    np.testing.assert_allclose(trained.weights, state.weights[0], atol=1e-5)


def test_early_stop_keeps_the_best_weights(windows, monkeypatch):
    losses = iter([3.0, 1.0, 2.0, 2.5, 2.0, 9.0])
    seen = []

    def fake(table, arch, state, active, *rest):
        loss = next(losses)
        seen.append(loss)
        vector = np.full(3 * arch.size + 2, loss)
        return [{"scenario": i, "state": vector} for i in active]

    monkeypatch.setattr(recurrent, "_epoch_results", fake)
    model = recurrent.train_autoencoders(windows, {"a": F.lit(True)}, ARCH, epochs=10)["a"]
    assert seen == [3.0, 1.0, 2.0, 2.5, 2.0]
    assert np.all(model.weights == 1.0)


def test_many_shards_average_by_rows(windows, monkeypatch):
    """Merging in groups gives the same mean as one merge."""

    def run():
        return recurrent.train_autoencoders(
            windows, {"a": F.lit(True)}, ARCH, epochs=1, rows_per_shard=10
        )["a"]

    one = run()
    monkeypatch.setattr(recurrent, "_MERGE_GROUPS", 4)
    two = run()
    np.testing.assert_allclose(one.weights, two.weights, atol=1e-6)
    assert one.losses == pytest.approx(two.losses)


def test_save_and_load(spark, windows, tmp_path):
    models = recurrent.train_autoencoders(windows, {"a": F.lit(True)}, ARCH, epochs=1)
    recurrent.save_models(spark, models, str(tmp_path / "ae"))
    back = recurrent.load_models(spark, str(tmp_path / "ae"))["a"]
    assert back.arch == ARCH and back.losses == models["a"].losses
    np.testing.assert_array_equal(back.weights, models["a"].weights)


def test_mean_squared_error(spark):
    df = spark.createDataFrame([([1.0, 2.0], [0.0, 4.0])], "a array<double>, b array<double>")
    assert df.select(recurrent.mean_squared_error(F.col("a"), F.col("b"))).first()[0] == 2.5
