import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import SIGHTING_SCHEMA
from pyspark.sql import functions as F

from fixtrail.config import ExperimentConfig, check_percentiles, features_for_model
from fixtrail.functions.calendar import holiday_table, with_calendar_features, with_holiday_flag
from fixtrail.operators.features import build_features, scaled_features
from fixtrail.operators.kinematics import LOOKBACK, with_kinematics
from fixtrail.operators.lookback import entity_frames
from fixtrail.operators.onehot import categories, with_one_hot
from fixtrail.operators.rowindex import temporal_split, with_row_id

T0 = datetime(2025, 1, 1, 12)


def fixes(spark, rows):
    return spark.createDataFrame(rows, SIGHTING_SCHEMA)


def motion(df, order=("timestamp", "latitude"), max_rows=1_000_000):
    frames = entity_frames(df, LOOKBACK, max_rows, order=order)
    return frames.finish(with_kinematics(frames.rows, frames.window))


def reference_motion(pdf):
    """Row-by-row computation of the motion features."""
    out = []
    for _, group in pdf.sort_values(["placa", "timestamp"], kind="stable").groupby("placa"):
        last_speed, last = 0.0, None
        for row in group.itertuples():
            dist = speed = accel = 0.0
            if last is not None:
                dt = (row.timestamp - last.timestamp).total_seconds()
                p1, p2 = math.radians(row.latitude), math.radians(last.latitude)
                a = (
                    math.sin(math.radians(last.latitude - row.latitude) / 2) ** 2
                    + math.cos(p1)
                    * math.cos(p2)
                    * math.sin(math.radians(last.longitude - row.longitude) / 2) ** 2
                )
                dist = 2 * 6371000 * math.atan2(math.sqrt(a), math.sqrt(1 - a))
                if dt:
                    speed = (dist / 1000) / (dt / 3600)
                    accel = ((speed - last_speed) * 1000 / 3600) / dt
            out.append((row.placa, row.timestamp, dist, speed, accel))
            last, last_speed = row, speed
    return pd.DataFrame(out, columns=["placa", "timestamp", "dist_m", "velocidade_kmh", "aceleracao"])


def random_fixes(spark, vehicles=5, n=300, seed=1):
    rng = np.random.default_rng(seed)
    owner = rng.choice(vehicles, n, p=[0.6, 0.2, 0.1, 0.05, 0.05])
    seconds = rng.permutation(n * 60)[:n]
    rows = [
        (
            f"V{v}",
            T0 + timedelta(seconds=int(s)),
            float(-15.8 + rng.normal() / 100),
            float(-47.9 + rng.normal() / 100),
            None,
        )
        for v, s in zip(owner, seconds, strict=True)
    ]
    return fixes(spark, rows)


def test_kinematics_match_row_by_row(spark):
    df = random_fixes(spark)
    got = motion(df).toPandas().sort_values(["placa", "timestamp"], ignore_index=True)
    want = reference_motion(df.toPandas()).sort_values(["placa", "timestamp"], ignore_index=True)
    for c in ("dist_m", "velocidade_kmh", "aceleracao"):
        np.testing.assert_allclose(got[c], want[c], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("max_rows", [1, 7, 60])
def test_hot_entities_give_the_same_kinematics(spark, max_rows):
    df = random_fixes(spark)
    columns = ["placa", "timestamp", "dist_m", "velocidade_kmh", "aceleracao"]
    whole = motion(df).select(columns).orderBy(columns).collect()
    cut = motion(df, max_rows=max_rows).select(columns).orderBy(columns).collect()
    assert cut == whole


def test_same_instant_gives_zero(spark):
    df = fixes(spark, [("A", T0, -15.0, -47.0, None), ("A", T0, -15.5, -47.5, None)])
    rows = motion(df).collect()
    assert all(r["velocidade_kmh"] == 0 and r["aceleracao"] == 0 for r in rows)
    assert max(r["dist_m"] for r in rows) > 0


def test_missing_coordinates(spark):
    step = timedelta(seconds=60)
    df = fixes(
        spark,
        [
            ("A", T0, None, -47.0, None),
            ("A", T0 + step, -15.0, -47.1, None),
            ("A", T0 + 2 * step, None, -47.2, None),
        ],
    )
    rows = motion(df, order=("timestamp",)).orderBy("timestamp").collect()
    assert rows[0]["dist_m"] == 0
    # previous latitude missing: only the longitude moved
    east = 2 * 6371000 * math.asin(math.cos(math.radians(15)) * math.sin(math.radians(0.05)))
    assert rows[1]["dist_m"] == pytest.approx(east, rel=1e-9)
    assert rows[2]["dist_m"] == 0 and rows[2]["velocidade_kmh"] == 0


def test_first_fix_and_second_acceleration(spark):
    df = fixes(spark, [("A", T0, 0.0, 0.0, None), ("A", T0 + timedelta(seconds=10), 0.0, 0.001, None)])
    first, second = motion(df).orderBy("timestamp").collect()
    assert (first["dist_m"], first["velocidade_kmh"], first["aceleracao"]) == (0, 0, 0)
    assert second["aceleracao"] == pytest.approx(second["velocidade_kmh"] * 1000 / 3600 / 10)


def test_calendar_features(spark):
    # a Monday and a Sunday
    df = fixes(
        spark,
        [("A", datetime(2024, 1, 1, 6), 0.0, 0.0, None), ("A", datetime(2024, 1, 7), 0.0, 0.0, None)],
    )
    a, b = with_calendar_features(df).orderBy("timestamp").collect()
    assert (a["hora"], a["dia_sem"], b["dia_sem"]) == (6, 0, 6)
    assert a["hora_sin"] == pytest.approx(1) and a["hora_cos"] == pytest.approx(0, abs=1e-12)
    assert (b["hora_sin"], b["hora_cos"]) == (0, 1)


def test_good_fridays(spark):
    known = {  # published dates
        1961: "03-31",
        1981: "04-17",
        2000: "04-21",
        2008: "03-21",
        2019: "04-19",
        2024: "03-29",
        2025: "04-18",
        2038: "04-23",
        2049: "04-16",
        2076: "04-17",
    }
    days = {str(r["day"]) for r in holiday_table(spark).collect()}
    for year, day in known.items():
        assert f"{year}-{day}" in days
    assert "2023-11-20" not in days and "2024-11-20" in days
    assert "1995-11-30" not in days and "1996-11-30" in days


def test_holiday_table_matches_computus(spark):
    from dateutil.easter import easter

    days = {r["day"] for r in holiday_table(spark).collect()}
    missing = [y for y in range(1900, 2101) if easter(y) - timedelta(days=2) not in days]
    assert missing == []
    per_year = {}
    for d in days:
        per_year[d.year] = per_year.get(d.year, 0) + 1
    # nothing but the fixed dates and one movable day
    assert max(per_year.values()) <= 12


def test_own_holiday_table(spark):
    df = fixes(spark, [("A", T0, 0.0, 0.0, None), ("B", T0 + timedelta(days=1), 0.0, 0.0, None)])
    own = spark.sql("SELECT date'2025-01-02' AS day UNION ALL SELECT date'2025-01-02'")
    rows = with_holiday_flag(df, own).orderBy("timestamp").collect()
    assert [r["eh_feriado"] for r in rows] == [0, 1]


def test_one_hot(spark):
    df = fixes(
        spark,
        [("A", T0, 0.0, 0.0, "b x"), ("B", T0, 0.0, 0.0, None), ("C", T0, 0.0, 0.0, "a")],
    )
    names = categories(df)
    out = with_one_hot(df, names).orderBy("placa")
    assert names == ["a", "b x"] and out.columns[-2:] == ["RA_a", "RA_b x"]
    assert "regiao_adm" not in out.columns
    assert [(r["RA_a"], r["RA_b x"]) for r in out.collect()] == [(0, 1), (0, 0), (1, 0)]
    with pytest.raises(ValueError, match="more than 1"):
        categories(df, limit=1)


def test_feature_blocks_follow_the_columns(spark, sample):
    full = build_features(sample, categories(sample))
    assert full.count() == 100
    assert scaled_features(full.columns)[:4] == ["hora_sin", "hora_cos", "dia_sem", "eh_feriado"]
    slim = build_features(sample.drop("latitude", "regiao_adm"))
    assert scaled_features(slim.columns) == ["hora_sin", "hora_cos", "dia_sem", "eh_feriado"]
    assert full.agg(F.avg("velocidade_kmh")).first()[0] == pytest.approx(0.0833271205555973, rel=1e-12)


def test_features_for_model():
    columns = ["placa", "latitude", "RA_x", "hora", "dist_m", "hora_sin", "dia_sem", "RA_y"]
    assert features_for_model("isolation_forest", columns) == [
        "hora_sin",
        "dia_sem",
        "dist_m",
        "RA_x",
        "RA_y",
    ]
    assert features_for_model("hbos", columns) == ["dist_m", "hora", "dia_sem"]
    assert features_for_model("autoencoder", columns) == ["dist_m", "latitude", "hora_sin"]
    with pytest.raises(ValueError, match="unknown model"):
        features_for_model("other", columns)


def test_percentile_check():
    assert check_percentiles([99, 90]) == [90, 99]
    with pytest.raises(ValueError, match="0..100"):
        check_percentiles([90, 200])
    assert ExperimentConfig().percentiles == (90, 95, 99)


def test_row_id_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, numPartitions=13).select(
        F.concat(F.lit("V"), F.col("id") % 7).alias("placa"),
        # a third of all rows share one instant, and many rows are exact copies
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("s"),
    )
    df = df.select("placa", F.timestamp_seconds("s").cast("timestamp_ntz").alias("timestamp"))
    table = with_row_id(df)
    got = [(r["row_id"], r["timestamp"], r["placa"]) for r in table.rows.collect()]
    got.sort()
    assert table.count == 5000
    assert [g[0] for g in got] == list(range(5000))
    assert [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_split_positions(spark, sample):
    table = with_row_id(sample)
    split = temporal_split(table)
    assert (split.train_size, split.test_size) == (70, 30)
    assert split.cutoff_time() == datetime(2025, 12, 2, 19, 40)
    ninety = with_row_id(sample.where("timestamp < '2025-12-02 20:00:00'"))
    assert temporal_split(ninety).train_size == 62
    with pytest.raises(ValueError, match="empty"):
        temporal_split(with_row_id(sample.where("false")))
