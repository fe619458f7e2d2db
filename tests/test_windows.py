from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fixtrail.functions.calendar import moment_text
from fixtrail.config import ROW_ID
from fixtrail.operators import lookback as lookback_module
from fixtrail.operators.lookback import entity_frames
from fixtrail.operators.rowindex import with_row_id
from fixtrail.operators.windows import (
    GAP,
    SPAN,
    window_counters,
    window_lookback,
    window_values,
    with_window_flags,
)

T0 = datetime(2025, 1, 1)


def flagged(df, size, gap, rule=GAP, max_rows=1_000_000, features=()):
    rows = with_row_id(df).rows
    frames = entity_frames(rows, window_lookback(size), max_rows)
    out = with_window_flags(frames.rows, frames, size, gap, rule)
    if features:
        out = out.withColumn("seq", window_values(frames, size, features))
    return frames.finish(out)


def brute(pdf, size, gap, rule):
    """Ends (entity, time) of valid windows, by direct enumeration."""
    ends = set()
    for entity, group in pdf.sort_values("timestamp").groupby("placa"):
        times = list(group["timestamp"])
        if len(times) < size or (rule == SPAN and len(times) <= size):
            continue
        for i in range(size - 1, len(times)):
            part = times[i - size + 1 : i + 1]
            steps = [(b - a).total_seconds() for a, b in zip(part, part[1:], strict=False)]
            if any(s > gap for s in steps):
                continue
            if rule == SPAN and (part[-1] - part[0]).total_seconds() > gap:
                continue
            ends.add((entity, times[i]))
    return ends


@pytest.mark.parametrize("rule", [GAP, SPAN])
@pytest.mark.parametrize("size", [1, 2, 3, 6])
@pytest.mark.parametrize("max_rows", [9, 1_000_000])
def test_windows_match_enumeration(spark, rule, size, max_rows):
    rng = np.random.default_rng(size)
    n = 160
    pdf = pd.DataFrame(
        {
            "placa": rng.choice(list("ABCDE"), n, p=[0.5, 0.3, 0.15, 0.03, 0.02]),
            "timestamp": [T0 + timedelta(seconds=int(s)) for s in rng.permutation(6000)[:n]],
        }
    )
    df = spark.createDataFrame(pdf, "placa string, timestamp timestamp_ntz")
    out = flagged(df, size, 120, rule, max_rows).where("window_valid")
    got = [(r["placa"], r["timestamp"]) for r in out.collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(pdf, size, 120, rule)


@pytest.mark.parametrize(
    ("gap", "rule", "want"),
    [(1800, GAP, 80), (600, GAP, 80), (599, GAP, 0), (599.999999, GAP, 0), (1800, SPAN, 80), (600, SPAN, 0)],
)
def test_sample_windows(sample, gap, rule, want):
    assert flagged(sample, 3, gap, rule).where("window_valid").count() == want


def test_row_offsets_start_no_python_workers(spark, sample):
    for df in (sample, sample.limit(0)):
        rows = with_row_id(df).rows
        assert "ExistingRDD" not in rows._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["row_id"] for r in rows.select("row_id").collect()) == list(range(df.count()))


def test_microsecond_above_the_limit(spark):
    late = timedelta(seconds=10, microseconds=1)
    df = spark.createDataFrame([("A", T0), ("A", T0 + late)], "placa string, timestamp timestamp_ntz")
    assert flagged(df, 2, 10).where("window_valid").count() == 0
    assert flagged(df, 2, 10.000001).where("window_valid").count() == 1


def test_two_vehicles_of_ten_rows(spark):
    rows = [("A" if i < 10 else "B", T0 + timedelta(seconds=i), float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "placa string, timestamp timestamp_ntz, x double")
    for rule in (GAP, SPAN):
        out = flagged(df, 3, 100, rule, features=["x", "x", "x"]).where("window_valid")
        seqs = [r["seq"] for r in out.orderBy("row_id").collect()]
        assert len(seqs) == 16
        assert all(len(s) == 3 and all(len(step) == 3 for step in s) for s in seqs)
        assert [step[0] for step in seqs[0]] == [0, 1, 2]


def test_exactly_one_window(spark):
    rows = [("A", T0 + timedelta(seconds=i)) for i in range(3)] + [("B", T0)]
    df = spark.createDataFrame(rows, "placa string, timestamp timestamp_ntz")
    assert flagged(df, 3, 100, GAP).where("window_valid").count() == 1
    assert flagged(df, 3, 100, SPAN).where("window_valid").count() == 0


@pytest.mark.parametrize("max_rows", [2, 1_000_000])
def test_counters(spark, max_rows):
    seconds = [0, 1, 2, 50, 51, 52]
    rows = [("A", T0 + timedelta(seconds=s)) for s in seconds] + [("B", T0)]
    df = spark.createDataFrame(rows, "placa string, timestamp timestamp_ntz")
    out = window_counters(flagged(df, 3, 10, max_rows=max_rows), 3).first()
    assert tuple(out) == (2, 2, 1)


@pytest.mark.parametrize("max_rows", [5, 13])
def test_payload_of_hot_entities(spark, max_rows):
    rng = np.random.default_rng(5)
    rows = [
        (str(v), T0 + timedelta(seconds=int(s)), float(rng.normal()))
        for v, s in zip(rng.choice(3, 90, p=[0.8, 0.15, 0.05]), rng.permutation(90), strict=True)
    ]
    df = spark.createDataFrame(rows, "placa string, timestamp timestamp_ntz, x double")
    whole = flagged(df, 4, 1000, features=["x"]).where("window_valid").orderBy("row_id")
    cut = flagged(df, 4, 1000, max_rows=max_rows, features=["x"]).where("window_valid").orderBy("row_id")
    assert [(r["row_id"], r["seq"]) for r in cut.collect()] == [
        (r["row_id"], r["seq"]) for r in whole.collect()
    ]


def test_bad_arguments(sample):
    with pytest.raises(ValueError, match="at least one row"):
        flagged(sample, 0, 10)
    with pytest.raises(ValueError, match="unknown window rule"):
        flagged(sample, 2, 10, "other")


def test_clock_changes_of_the_session_zone_do_not_matter(spark):
    """Timestamps carry no zone; local midnight did not exist in this zone on that day."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        before = datetime(2018, 11, 3, 23, 50)
        rows = [("A", before), ("A", before + timedelta(minutes=30))]
        df = spark.createDataFrame(rows, "placa string, timestamp timestamp_ntz")
        assert flagged(df, 2, 1800).where("window_valid").count() == 1
        assert flagged(df, 2, 1799).where("window_valid").count() == 0
        text = df.select(moment_text(F.col("timestamp"))).orderBy("timestamp").collect()
        assert text[1][0] == "2018-11-04 00:20:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_moment_text(spark):
    rows = [(T0,), (T0 + timedelta(microseconds=500_000),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz").orderBy("t")
    texts = [r[0] for r in df.select(moment_text(F.col("t"))).collect()]
    assert texts == ["2025-01-01 00:00:00", "2025-01-01 00:00:00.500000"]


def test_thin_hot_entity_is_copied_once(spark):
    """Every tenth row is of one entity: blocks are full all the same, and a row is copied at most once."""
    n, lookback, limit = 3000, 61, 100
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id"))).alias("placa"), F.col("id").alias("row_id")
    )
    frames = entity_frames(rows.withColumnRenamed("row_id", ROW_ID), lookback, limit)
    assert frames.split and frames.rows.count() <= n + (300 // limit) * lookback
    w = frames.window
    got = frames.finish(frames.rows.withColumn("back", F.lag(ROW_ID, lookback).over(w)).withColumn("all", frames.fixes()))
    hot = {r[ROW_ID]: (r["back"], r["all"]) for r in got.where("placa = 'hot'").collect()}
    assert hot == {k: (k - 10 * lookback if k >= 10 * lookback else None, 300) for k in range(0, n, 10)}
    assert got.count() == n


def test_starts_of_many_cells(spark, monkeypatch):
    monkeypatch.setattr(lookback_module, "_COUNTS_TOGETHER", 3)
    counts = spark.range(40).select(F.lit("a").alias("placa"), F.col("id").alias("_cell"), (F.col("id") % 4 + 1).alias("_n"))
    got = {r["_cell"]: r["_start"] for r in lookback_module._starts(counts, "placa", 40).collect()}
    assert got == {k: sum(i % 4 + 1 for i in range(k)) for k in range(40)}
