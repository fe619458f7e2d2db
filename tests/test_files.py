import json
from datetime import datetime
from glob import glob

import pytest
from conftest import sample_rows

from fixtrail.config import ExperimentConfig
from fixtrail.operators.staging import stage
from fixtrail.plans.experiment import run_experiment, run_from_files
from fixtrail.plans.reports import write_base_report, write_region_report
from fixtrail.sources.sinks import family_results, write_family_metrics
from fixtrail.sources.tables import read_families, read_first, read_table, standardize

MAP = ExperimentConfig().column_map


@pytest.fixture
def sample_csv(tmp_path):
    path = tmp_path / "sightings.csv"
    lines = ["placa,timestamp,latitude,longitude,RA"]
    lines += [f"{p},{t},{lat:.6f},{lon:.6f},{r}" for p, t, lat, lon, r in sample_rows()]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_is_typed(spark, sample_csv):
    df = standardize(read_table(spark, sample_csv), MAP)
    assert dict(df.dtypes)["timestamp"] == "timestamp_ntz"
    assert dict(df.dtypes)["latitude"] == "double"
    assert "regiao_adm" in df.columns and df.count() == 100


def test_missing_cells(spark, tmp_path):
    path = tmp_path / "gaps.csv"
    path.write_text(
        "placa,timestamp,latitude,longitude\n"
        "A,2025-01-01 10:00:00,NaN,-47\n"
        ",2025-01-01 10:00:00,-15,-47\n"
        "NULL,2025-01-01 10:00:00,-15,-47\n"
        "B,,-15,-47\n"
        "C,2025-01-01T10:00:00.5,-15,n/a\n"
    )
    rows = standardize(read_table(spark, str(path)), MAP).orderBy("placa").collect()
    assert [(r["placa"], r["latitude"], r["longitude"]) for r in rows] == [
        ("A", None, -47.0),
        ("C", -15.0, None),
    ]
    assert rows[1]["timestamp"] == datetime(2025, 1, 1, 10, 0, 0, 500000)


@pytest.mark.parametrize(
    ("row", "message"),
    [("A,yesterday,-15,-47", "cannot read timestamp"), ("A,2025-01-01,north,-47", "cannot read latitude")],
)
def test_unreadable_cells_are_errors(spark, tmp_path, row, message):
    path = tmp_path / "bad.csv"
    path.write_text(f"placa,timestamp,latitude,longitude\n{row}\n")
    with pytest.raises(Exception, match=message):
        standardize(read_table(spark, str(path)), MAP).collect()


def test_any_source_name_can_be_mapped(spark):
    df = spark.createDataFrame([("A", "2025-01-01 00:00:00")], "PLATE string, seen string")
    out = standardize(df, {"PLATE": "placa", "seen": "timestamp", "absent": "latitude"})
    assert out.columns == ["placa", "timestamp"]
    with pytest.raises(ValueError, match="lacks the columns"):
        standardize(df, {"PLATE": "placa"})


def test_first_existing_input(spark, sample, tmp_path, sample_csv):
    parquet = str(tmp_path / "sightings.parquet")
    sample.write.parquet(parquet)
    missing = str(tmp_path / "none.csv")
    assert read_first(spark, [missing, parquet]).count() == 100
    assert read_first(spark, [sample_csv, parquet]).columns[-1] == "RA"
    with pytest.raises(FileNotFoundError):
        read_first(spark, [missing, str(tmp_path / "none.parquet")])


def test_filter_reaches_the_scan(spark, sample, tmp_path):
    path = str(tmp_path / "p.parquet")
    sample.write.parquet(path)
    plan = standardize(read_table(spark, path), MAP).select("placa")._jdf.queryExecution().toString()
    assert "IsNotNull(placa)" in plan.split("PushedFilters")[1]
    assert "latitude" not in plan.split("ReadSchema")[-1]


def test_families_are_stacked_by_name(spark, tmp_path):
    (tmp_path / "describe_ISO_a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "describe_ISO_b.csv").write_text("y,z\n3,4\n")
    (tmp_path / "describe_LSTM_HBOS.csv").write_text("x\n5\n")
    (tmp_path / "describe_other.csv").write_text("x\n6\n")
    got = read_families(spark, str(tmp_path / "describe_*.csv"))
    assert sorted(got) == ["HBOS", "ISO"]
    rows = {tuple(r) for r in got["ISO"].select("x", "y", "z").collect()}
    assert rows == {("1", "2", None), (None, "3", "4")}


def test_staged_table_keeps_schema_and_order_of_columns(spark, sample):
    df = sample.selectExpr("latitude > -15.805 AS `is train`", "placa", "timestamp AS `RA_Lago Norte`")
    out = stage(df, "check", partition_by=["is train"])
    assert out.schema == df.schema
    assert sorted(out.collect()) == sorted(df.collect())
    assert stage(df.where("false"), "empty", partition_by=["is train"]).count() == 0


def test_metrics_files(spark, tmp_path):
    schema = "Model string, Percentile int"
    metrics = spark.createDataFrame([("ISO_n1", 90), ("LSTM_a", 90)], schema)
    assert write_family_metrics(metrics, str(tmp_path)) == [
        f"{tmp_path}/iso_metrics.csv",
        f"{tmp_path}/lstm_metrics.csv",
    ]
    assert not glob(f"{tmp_path}/hbos*")
    with pytest.raises(RuntimeError, match="no threshold metrics"):
        write_family_metrics(metrics.where("false"), str(tmp_path))


def test_family_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "ISO_a int, placa int, HBOS_b int, other int")
    assert family_results(df, "ISO").columns == ["placa", "ISO_a"]


def test_base_reports(spark, sample, tmp_path):
    write_base_report(sample, str(tmp_path))
    profile = read_table(spark, f"{tmp_path}/DescricaoInicial_BaseDados.csv")
    assert [r["Coluna"] for r in profile.collect()] == sample.columns
    numeric = read_table(spark, f"{tmp_path}/EstatisticasIniciais_Numericas.csv")
    assert {r["coluna"] for r in numeric.collect()} == {"latitude", "longitude"}
    texts = read_table(spark, f"{tmp_path}/EstatisticasIniciais_Categoricas.csv")
    assert {r["coluna"]: r["unique"] for r in texts.collect()} == {"placa": "10", "regiao_adm": "3"}
    write_region_report(sample, str(tmp_path))
    (part,) = glob(f"{tmp_path}/quantidade_carros_por_ra.json/part-*")
    with open(part) as f:
        assert json.load(f) == {"Lago Norte": 10, "Paranoa": 10, "Varjao": 10}
    with pytest.warns(UserWarning, match="regiao_adm"):
        write_region_report(sample.drop("regiao_adm"), str(tmp_path / "x"))


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    path = folder / "sightings.csv"
    lines = ["placa,timestamp,latitude,longitude,RA"]
    lines += [f"{p},{t},{lat:.6f},{lon:.6f},{r}" for p, t, lat, lon, r in sample_rows()]
    path.write_text("\n".join(lines) + "\n")
    config = ExperimentConfig(epochs=2)
    return run_from_files(spark, [str(path)], str(folder / "out"), config), str(folder / "out")


def test_run_counts(run):
    result, _ = run
    metrics = result.metrics.collect()
    flagged = {(r["Model"], r["Percentile"]): r["Anomalies_Detected"] for r in metrics}
    assert len(metrics) == 39
    assert [flagged["HBOS_bins10", p] for p in (90, 95, 99)] == [20, 20, 20]
    assert [flagged["HBOS_bins20", p] for p in (90, 95, 99)] == [20, 20, 20]
    thresholds = {(r["Model"], r["Percentile"]): r["Threshold_Value"] for r in metrics}
    assert thresholds["HBOS_bins10", 95] == 4.353541
    assert thresholds["HBOS_bins20", 95] == 0.644657
    # random trees: the level is close to the published run
    assert thresholds["ISO_n200", 90] == pytest.approx(0.6147, abs=0.02)
    for model in [m for m, _ in flagged if m.startswith("LSTM")]:
        assert [flagged[model, p] for p in (90, 95, 99)] == [15, 13, 11]
        assert thresholds[model, 90] == pytest.approx(365, abs=8)
    assert {r["Calibrated_On"] for r in metrics} == {"train"}


def test_run_comparison(run):
    result, _ = run
    rows = {r["Model"]: r for r in result.comparison.collect()}
    assert len(rows) == 38 and "ISO_n200_p95_label" not in rows
    hbos = rows["HBOS_bins10_p95_label"]
    assert (hbos["Precision"], hbos["Recall"], hbos["F1_Score"], hbos["Accuracy"]) == (0.3, 1, 0.4615, 0.86)
    control = rows["LSTM_Sujo_p99_label"]
    assert (control["F1_Score"], control["Accuracy"]) == (0, 0.83)


def test_run_files(spark, run):
    _, folder = run
    master = spark.read.parquet(f"{folder}/master_table/resultado_final.parquet")
    assert master.count() == 100 and "row_id" not in master.columns
    assert {"RA_Lago Norte", "dia_semana", "hora", "LSTM_Sujo_score"} <= set(master.columns)
    assert master.where("LSTM_Sujo_score IS NULL").count() == 20
    hbos = read_table(spark, f"{folder}/metrics/hbos_results.csv")
    assert hbos.columns == [
        "placa",
        "timestamp",
        "latitude",
        "longitude",
        "HBOS_bins10_score",
        "HBOS_bins10_p90_label",
        "HBOS_bins10_p95_label",
        "HBOS_bins10_p99_label",
        "HBOS_bins20_score",
        "HBOS_bins20_p90_label",
        "HBOS_bins20_p95_label",
        "HBOS_bins20_p99_label",
    ]
    assert hbos.where("timestamp = '2025-12-02 18:30:00'").count() == 10
    for name, rows in {"iso": 6, "hbos": 6, "lstm": 27}.items():
        assert read_table(spark, f"{folder}/metrics/{name}_metrics.csv").count() == rows
    assert read_table(spark, f"{folder}/metrics/comparativo_completo.csv").count() == 38
    (part,) = glob(f"{folder}/metrics/perfil_dados.json/part-*.json")
    with open(part) as f:
        profile = json.load(f)
    assert profile["vel_media"] == pytest.approx(0.0833271205555973, rel=1e-12)
    assert profile["split_temporal"] == {
        "cutoff_timestamp": "2025-12-02 19:40:00",
        "train_size": 70,
        "test_size": 30,
        "train_ratio": 0.7,
    }
    assert profile["features_hbos"][3] == "hora" and profile["features_iso"][-1] == "RA_Varjao"


def test_run_with_hot_entities_and_short_histories(spark, sample):
    config = ExperimentConfig(epochs=1, isolation_trees=(5,), histogram_bins=(10,))
    cut = ExperimentConfig(
        epochs=1, isolation_trees=(5,), histogram_bins=(10,), max_rows_per_entity_task=4
    )
    columns = ["placa", "timestamp", "velocidade_kmh", "ISO_n5_score", "HBOS_bins10_score"]
    columns += ["LSTM_Sujo_score"]
    one = run_experiment(sample, config).master.select(columns).orderBy(columns[:2]).collect()
    two = run_experiment(sample, cut).master.select(columns).orderBy(columns[:2]).collect()
    for a, b in zip(one, two, strict=True):
        assert list(a)[:5] == list(b)[:5]
        assert (a[5] is None) == (b[5] is None)
        if a[5] is not None:
            assert a[5] == pytest.approx(b[5], rel=1e-4)
    long_window = ExperimentConfig(window_size=11, isolation_trees=(5,), histogram_bins=(10,))
    with pytest.warns(UserWarning, match="no window"):
        result = run_experiment(sample, long_window)
    assert result.autoencoders == {} and result.metrics.count() == 6
    with pytest.raises(ValueError, match="empty"):
        run_experiment(sample.where("false"), config)
