import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fixtrail.functions.quantiles import exact_percentiles
from fixtrail.operators import hbos
from fixtrail.operators.features import build_features, scaled_features
from fixtrail.operators.iforest import IsolationForest, average_path, isolation_labels
from fixtrail.operators.onehot import categories
from fixtrail.operators.rowindex import is_train, with_row_id
from fixtrail.operators.scaler import StandardScaler


def frame(spark, columns, ids=True):
    pdf = pd.DataFrame(columns)
    if ids:
        pdf.insert(0, "row_id", np.arange(len(pdf)))
    return spark.createDataFrame(pdf)


def brute_hbos(train, x, bins):
    """Histogram scores by direct search over NumPy's own histogram edges."""
    total = np.zeros(len(x))
    for f in range(train.shape[1]):
        hist, edges = np.histogram(train[:, f], bins=bins, density=True)
        table = np.log2(hist + 0.1)
        for i, v in enumerate(x[:, f]):
            below = int(np.sum(edges < v))
            if below == 0:
                near = edges[0] - v <= 0.5 * (edges[1] - edges[0])
                total[i] -= table[0] if near else table.min()
            elif below == bins + 1:
                near = v - edges[-1] <= 0.5 * (edges[-1] - edges[-2])
                total[i] -= table[-1] if near else table.min()
            else:
                total[i] -= table[below - 1]
    return total


@pytest.mark.parametrize("bins", [1, 7, 10, 20])
def test_hbos_against_brute_force(spark, bins):
    rng = np.random.default_rng(bins)
    train = np.column_stack(
        [rng.normal(size=400), rng.integers(0, 7, 400), np.full(400, 3.0), rng.exponential(size=400)]
    ).astype(float)
    x = np.vstack([train, train[:60] * 3 - 4, [[9, 6.3, 3.4, 0], [-9, -0.2, 2.4, 99]]])
    names = list("abcd")
    fitted = frame(spark, dict(zip(names, train.T, strict=True)))
    model = hbos.fit_hbos(fitted, names, [bins])
    scored = hbos.with_hbos_scores(frame(spark, dict(zip(names, x.T, strict=True))), model, {bins: "s"})
    got = scored.orderBy("row_id").toPandas()["s"]
    np.testing.assert_allclose(got, brute_hbos(train, x, bins), rtol=0, atol=1e-12)


def test_hbos_constant_feature(spark):
    df = frame(spark, {"a": np.zeros(50)})
    models = hbos.fit_hbos(df, ["a"], [10, 5])
    out = hbos.with_hbos_scores(df, models, {10: "even", 5: "odd"}).first()
    assert out["even"] == pytest.approx(-math.log2(0.1))  # the edge reads the empty bin
    assert out["odd"] == pytest.approx(-math.log2(5 + 0.1))


def test_hbos_missing_value_has_no_score(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "a double")
    out = hbos.with_hbos_scores(df, hbos.fit_hbos(df, ["a"], [10]), {10: "s"})
    assert [r["s"] is None for r in out.orderBy("a").collect()] == [True, False, False]


def test_contamination_labels(spark):
    df = frame(spark, {"s": np.arange(100.0)})
    out = hbos.contamination_labels(df, "s", 0.1)
    assert out.agg(F.sum("label")).first()[0] == 10
    assert out.agg(F.min(F.when(F.col("label") == 1, F.col("s")))).first()[0] == 90


def golden_hbos(sample):
    table = with_row_id(sample)
    df = build_features(table.rows, categories(sample)).withColumn("is_train", is_train(70))
    wanted = scaled_features(df.columns)
    scaled = StandardScaler.fit(df.where("is_train"), wanted).transform(df).cache()
    names = ["velocidade_kmh", "aceleracao", "dist_m", "hora", "dia_sem", "eh_feriado"]
    models = hbos.fit_hbos(scaled.where("is_train"), names, [10, 20])
    return hbos.with_hbos_scores(scaled, models, {10: "s10", 20: "s20"})


def test_hbos_known_scores(sample):
    rows = golden_hbos(sample).orderBy("row_id").collect()
    first, last = rows[0], rows[-1]
    assert first["s10"] == pytest.approx(4.353541058892629, abs=1e-12)
    assert first["s20"] == pytest.approx(0.6446569481046254, abs=1e-12)
    assert last["s10"] == pytest.approx(5.06989852432606, abs=1e-12)
    assert last["s20"] == pytest.approx(2.1402905081310157, abs=1e-12)


def test_scaler(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = rng.normal(5, 2, 200)
    df = frame(spark, {"a": x, "b": np.full(200, 7.1), "c": x})
    scaler = StandardScaler.fit(df.where("row_id < 150"), ["a", "b", "absent"])
    assert scaler.features == ["a", "b"]
    got = scaler.transform(df).orderBy("row_id").toPandas()
    np.testing.assert_allclose(got["a"], (x - x[:150].mean()) / x[:150].std(), atol=1e-12)
    np.testing.assert_allclose(got["b"], 0, atol=1e-12)
    np.testing.assert_array_equal(got["c"], x)
    scaler.save(spark, str(tmp_path / "s"))
    assert StandardScaler.load(spark, str(tmp_path / "s")) == scaler
    with pytest.raises(ValueError, match="no features"):
        StandardScaler.fit(df, ["absent"])
    with pytest.raises(ValueError, match="without training rows"):
        StandardScaler.fit(df.where("false"), ["a"])


def test_average_path():
    assert [average_path(n) for n in (0, 1, 2)] == [0, 0, 1]
    assert average_path(256) == pytest.approx(10.244770920, abs=1e-6)


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1000, 3))
    x[:10] += 8
    return frame(spark, dict(zip("abc", x.T, strict=True))).cache()


def test_forest_ranks_outliers_first(spark, cloud):
    forest = IsolationForest.fit(cloud, 1000, list("abc"), 100)
    out = forest.with_scores(cloud, {50: "small", 100: "large"})
    top = {r["row_id"] for r in out.orderBy(F.desc("large")).limit(10).collect()}
    assert top == set(range(10))
    limits = out.agg(F.min("small"), F.max("large")).first()
    assert 0 < limits[0] and limits[1] < 1
    labels = isolation_labels(out, "large")
    assert labels.where("label = 1 and large <= 0.5").count() == 0
    assert isolation_labels(out, "large", 0.02).agg(F.sum("label")).first()[0] == 20


def test_forest_ignores_partitioning(spark, cloud, tmp_path):
    a = IsolationForest.fit(cloud, 1000, list("abc"), 20, seed=7)
    b = IsolationForest.fit(cloud.repartition(5, "a"), 1000, list("abc"), 20, seed=7)
    pd.testing.assert_frame_equal(a.nodes, b.nodes)
    bigger = IsolationForest.fit(cloud, 1000, list("abc"), 30, seed=7)
    pd.testing.assert_frame_equal(a.nodes, bigger.nodes[bigger.nodes["tree"] < 20])
    a.save(spark, str(tmp_path / "f"))
    back = IsolationForest.load(spark, str(tmp_path / "f"))
    one = a.with_scores(cloud, {20: "s"}).orderBy("row_id").toPandas()["s"]
    two = back.with_scores(cloud, {20: "s"}).orderBy("row_id").toPandas()["s"]
    pd.testing.assert_series_equal(one, two)


def test_forest_scores_by_walking(spark, cloud):
    forest = IsolationForest.fit(cloud, 1000, list("abc"), 10)
    got = forest.with_scores(cloud, {10: "s"}).orderBy("row_id").toPandas()
    trees = {t: g.set_index("node") for t, g in forest.nodes.groupby("tree")}
    for i in (0, 5, 500, 999):
        x = got.loc[i, list("abc")].to_numpy(np.float32)
        total = 0.0
        for nodes in trees.values():
            at = 0
            while nodes.at[at, "left"] != at:
                side = "left" if x[nodes.at[at, "feature"]] <= nodes.at[at, "threshold"] else "right"
                at = nodes.at[at, side]
            total += nodes.at[at, "path"]
        assert got.loc[i, "s"] == pytest.approx(2 ** (-total / 10 / average_path(256)))


def test_forest_on_constant_rows(spark):
    df = frame(spark, {"a": np.ones(30)})
    forest = IsolationForest.fit(df, 30, ["a"], 5)
    assert len(forest.nodes) == 5
    assert forest.with_scores(df, {5: "s"}).first()["s"] == pytest.approx(0.5)


@pytest.mark.parametrize("limit", [10, 200, 1_000_000])
def test_exact_percentiles(spark, limit):
    rng = np.random.default_rng(limit)
    n = 6000
    columns = {
        "normal": rng.normal(size=n),
        "ties": rng.integers(0, 5, n).astype(float),
        "heavy": np.where(rng.random(n) < 0.4, 1.5, rng.normal(size=n)),
        "wide": np.exp(rng.normal(size=n) * 50),
        "same": np.full(n, 2.0),
        "gaps": np.where(rng.random(n) < 0.5, np.nan, rng.normal(size=n)),
    }
    df = frame(spark, columns).repartition(6)
    ps = [0, 1, 33.3, 50, 90, 95, 99, 99.9, 100]
    got = exact_percentiles(df, {c: F.col(c) for c in columns}, ps, direct_limit=limit)
    for c, v in columns.items():
        want = np.percentile(v[~np.isnan(v)], ps)
        assert [got[c][p] for p in ps] == list(want), c


def test_percentiles_without_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "a double")
    assert exact_percentiles(df, {"a": F.col("a")}, [50]) == {}
