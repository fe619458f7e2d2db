import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fixtrail.operators.evaluate import (
    compare_labels,
    compare_with_reference,
    confusion_counts,
    reference_label,
)
from fixtrail.operators.profile import (
    categorical_describe,
    column_profile,
    dataset_profile,
    entities_per_region,
    numeric_describe,
)
from fixtrail.operators.scenarios import scenario_grid
from fixtrail.operators.thresholds import (
    calibrate,
    score_ranges,
    score_statistics,
    strict_flags,
    threshold_metrics,
    with_labels,
)


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"row_id": np.arange(100), "score": rng.random(100)})
    pdf["part"] = pdf["score"].where(pdf["row_id"] % 4 > 0)  # NaN on every fourth row
    df = spark.createDataFrame(pdf)
    return df.withColumn("other", F.when(F.col("row_id") % 4 > 0, F.col("score"))).cache(), pdf


def test_thresholds_on_all_rows(scored):
    df, pdf = scored
    found = calibrate(df, {"M": "score"}, [99, 90, 95])
    assert [t.percentile for t in found] == [90, 95, 99]
    assert [t.value for t in found] == list(np.percentile(pdf["score"], [90, 95, 99]))
    out = with_labels(df, found, {"M": "score"})
    assert {"M_p90_label", "M_p95_label", "M_p99_label"} <= set(out.columns)
    rows = threshold_metrics(out, found).collect()
    assert [(r["Percentile"], r["Anomalies_Detected"]) for r in rows] == [(90, 10), (95, 5), (99, 1)]
    assert {r["Calibrated_On"] for r in rows} == {"full"}
    assert rows[0]["Threshold_Value"] == round(np.percentile(pdf["score"], 90), 6)


@pytest.mark.parametrize("column", ["part", "other"])
def test_missing_scores(scored, column):
    df, pdf = scored
    found = calibrate(df, {"M": column}, [50], {"M": F.col("row_id") < 60})
    inside = pdf["part"][pdf["row_id"] < 60].dropna()
    assert found[0].value == np.percentile(inside, 50)
    row = threshold_metrics(with_labels(df, found, {"M": column}), found).first()
    hits = int((pdf["part"] >= found[0].value).sum())
    # rows without a score count in the percentage
    assert (row["Anomalies_Detected"], row["Pct_Dataset"]) == (hits, float(hits))
    assert row["Calibrated_On"] == "train"


def test_no_calibration_scores(scored):
    df, _ = scored
    found = calibrate(df, {"M": "score"}, [90], {"M": F.lit(False)})
    assert found == []
    assert with_labels(df, found, {"M": "score"}).columns == df.columns
    assert threshold_metrics(df, found).count() == 0
    with pytest.raises(ValueError, match="do not exist"):
        calibrate(df, {"M": "absent"}, [90])
    with pytest.raises(ValueError, match="0..100"):
        calibrate(df, {"M": "score"}, [200])


def test_score_summaries(scored):
    df, pdf = scored
    row = score_ranges(df, {"M": "part"}, {"M": F.col("row_id") < 50}).first()
    inside = pdf["part"][:50].dropna()
    assert tuple(row)[1:] == (inside.min(), inside.max(), pdf["part"].min(), pdf["part"].max())
    stats = score_statistics(df, "part").first().asDict()
    s = pdf["part"].dropna().to_numpy()
    want = {
        "mean": s.mean(),
        "median": np.median(s),
        "std": s.std(),
        "min": s.min(),
        "max": s.max(),
        "p95": np.percentile(s, 95),
        "p99": np.percentile(s, 99),
    }
    assert stats == pytest.approx(want)


def test_strict_flags(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 3, 3]], "score double")
    flags, limit = strict_flags(df, "score", 50)
    assert limit == 3 and flags.where("anomaly").count() == 0
    flags, limit = strict_flags(df, "score", 25)
    assert limit == 2 and flags.where("anomaly").count() == 3
    with pytest.raises(ValueError, match="no scores"):
        strict_flags(df.where("false"), "score")


def test_comparison_against_counting(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({c: rng.integers(0, 2, 333) for c in ("gt", "a", "b")})
    pdf["never"] = 0
    df = spark.createDataFrame(pdf)
    with pytest.warns(UserWarning, match="absent"):
        rows = compare_labels(df, "gt", ["b", "absent", "a", "never"]).collect()
    assert [r["Model"] for r in rows] == ["b", "a", "never"]
    for r in rows:
        tp = int((pdf["gt"] & pdf[r["Model"]]).sum())
        predicted, actual = int(pdf[r["Model"]].sum()), int(pdf["gt"].sum())
        assert r["Precision"] == (round(tp / predicted, 4) if predicted else 0)
        assert r["Recall"] == round(tp / actual, 4)
        assert r["F1_Score"] == round(2 * tp / (predicted + actual), 4)
        assert r["Accuracy"] == round(float((pdf["gt"] == pdf[r["Model"]]).mean()), 4)
    counts = confusion_counts(df, "gt", ["a"]).first()
    assert counts["tp"] + counts["fp"] + counts["fn"] + counts["tn"] == 333
    assert compare_labels(df, "gt", []).count() == 0


def test_reference_label(spark):
    labels = ["ISO_n100_p95_label", "ISO_n200_p95_label", "ISO_n200_p99_label", "HBOS_p95_label"]
    assert reference_label(labels) == "ISO_n200_p95_label"
    assert reference_label(["HBOS_p95_label"]) is None
    df = spark.createDataFrame([(1,)], "HBOS_p95_label int")
    assert compare_with_reference(df) is None


def test_scenario_grid():
    grid = scenario_grid(["ISO_n100", "ISO_n200"], ["HBOS_bins10", "HBOS_bins20"])
    assert len(grid) == 9
    assert grid[0].name == "LSTM_Uniao_ISO_n100_HBOS_bins10"
    assert grid[1].name == "LSTM_Inter_ISO_n100_HBOS_bins10"
    assert grid[-1].name == "LSTM_Sujo"
    with pytest.raises(RuntimeError, match="isolation"):
        scenario_grid([], ["HBOS_bins10"])
    with pytest.raises(RuntimeError, match="histogram"):
        scenario_grid(["ISO_n100"], [])


def test_scenario_masks(spark):
    df = spark.createDataFrame(
        [(i, h, t) for i in (0, 1) for h in (0, 1) for t in (True, False)],
        "ISO_p95_label int, HBOS_p95_label int, train boolean",
    )
    both, either, control = scenario_grid(["ISO"], ["HBOS"])
    for row in df.select(
        "*",
        both.mask(F.col("train")).alias("both"),
        either.mask(F.col("train")).alias("either"),
        control.mask(F.col("train")).alias("control"),
    ).collect():
        normal = [row["ISO_p95_label"] == 0, row["HBOS_p95_label"] == 0]
        assert row["both"] == (all(normal) and row["train"])
        assert row["either"] == (any(normal) and row["train"])
        assert row["control"] == row["train"]


def test_profile(sample):
    row = dataset_profile(sample).first()
    assert (row["total_veiculos"], row["dias_analise"], row["meses_analise"]) == (10, 1, 1)
    assert row["periodo"] == "2025-12-02 18:30:00 a 2025-12-02 20:00:00"
    assert (row["local_mais_fluxo_latitude"], row["fluxo_veiculos_local"]) == (-15.8099, 1)
    assert row["vel_media"] == 0
    nowhere = sample.withColumn("latitude", F.lit(None).cast("double"))
    assert dataset_profile(nowhere).first()["fluxo_veiculos_local"] is None
    regions = {r[0]: r[1] for r in entities_per_region(sample).collect()}
    assert regions == {"Lago Norte": 10, "Paranoa": 10, "Varjao": 10}
    with pytest.raises(ValueError, match="without the columns"):
        entities_per_region(sample.drop("placa"))


def test_describe(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, np.nan, 10.0], "n": [3, 1, 2, 2], "t": ["b", "a", "b", None]})
    df = spark.createDataFrame(pdf).withColumn("t", F.when(F.col("t") != "NaN", F.col("t")))
    for row in numeric_describe(df).collect():
        want = pdf[row["coluna"]].describe()
        got = [row[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        assert got == pytest.approx(list(want))
    assert [tuple(r) for r in categorical_describe(df).collect()] == [("t", 3, 2, "b", 2)]
    columns = {r["Coluna"]: (r["Tipo"], r["Nulos"], r["num_linhas"]) for r in column_profile(df).collect()}
    assert columns["t"] == ("string", 1, 4) and columns["n"] == ("bigint", 0, 4)
    with pytest.raises(ValueError, match="no numeric"):
        numeric_describe(df.select("t"))
    with pytest.raises(ValueError, match="no text"):
        categorical_describe(df.select("x"))
