"""Registered queries: each runs one operator over whole tables of a data folder.

The ``events`` table serves as sightings: the user is the entity, and coordinates follow
from the value and the event id, so that any SQL engine can derive the same trajectories.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtrail.config import (
    ENTITY,
    LAT,
    LON,
    REGION,
    ROW_ID,
    TIME,
    ExperimentConfig,
    features_for_model,
    score_column,
)
from fixtrail.functions.calendar import (
    moment_text,
    month_of,
    weekday_name,
    with_calendar_features,
    with_holiday_flag,
)
from fixtrail.functions.quantiles import exact_percentiles
from fixtrail.operators import hbos, recurrent
from fixtrail.operators.evaluate import compare_labels, compare_with_reference, confusion_counts
from fixtrail.operators.features import build_features, scaled_features
from fixtrail.operators.iforest import IsolationForest, isolation_labels, walk_forest
from fixtrail.operators.kinematics import LOOKBACK, with_kinematics
from fixtrail.operators.lookback import entity_frames
from fixtrail.operators.onehot import categories, with_category_index, with_one_hot
from fixtrail.operators.profile import (
    approximate_entities,
    categorical_describe,
    column_profile,
    dataset_profile,
    entities_per_region,
    entity_sketches,
    merged_sketches,
    numeric_describe,
)
from fixtrail.operators.recurrent_cells import Architecture
from fixtrail.operators.rowindex import is_train, temporal_split, with_row_id
from fixtrail.operators.scaler import StandardScaler
from fixtrail.operators.scenarios import (
    Scenario,
    at_window_end,
    has_member,
    membership_bits,
    scenario_grid,
    write_back,
)
from fixtrail.operators.staging import scratch_root, stage
from fixtrail.operators.thresholds import (
    Threshold,
    calibrate,
    score_ranges,
    score_statistics,
    strict_flags,
    threshold_metrics,
    with_labels,
)
from fixtrail.operators.windows import (
    GAP,
    SPAN,
    window_counters,
    window_lookback,
    window_values,
    with_window_flags,
)
from fixtrail.plans.experiment import run_experiment
from fixtrail.plans.reports import REGION_FILE, write_region_report
from fixtrail.sources.sinks import (
    family_metrics,
    family_results,
    publish,
    published_run,
    write_compiled_families,
    write_csv,
    write_family_metrics,
    write_family_results,
)
from fixtrail.sources.tables import read_csv, read_families, read_table, standardize

EVENT = "event_id"
WINDOW, GAP_SECONDS = 3, 43_200
CONFIG = ExperimentConfig(max_gap_seconds=GAP_SECONDS, epochs=2)
SEQUENCE_FEATURES = ("dist_m", "hora_sin", "hora_cos")

MODELS = {f"HBOS_bins{b}": score_column(f"HBOS_bins{b}") for b in CONFIG.histogram_bins}
TRUTH = "HBOS_bins20_p95_label"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sightings(spark: SparkSession, folder: str) -> DataFrame:
    """Trajectories derived from ``events``."""
    raw = _table(spark, folder, "events").select(
        EVENT,
        "user_id",
        "ts",
        (F.lit(-15.8) - F.col("value") / F.lit(1000.0)).alias(LAT),
        (F.lit(-47.98) - (F.col(EVENT) % 97).cast("double") / F.lit(1000.0)).alias(LON),
        "event_type",
    )
    return standardize(raw, {"user_id": ENTITY, "ts": TIME, "event_type": REGION})


def _features(spark: SparkSession, folder: str, regions: bool = False) -> DataFrame:
    df = sightings(spark, folder)
    names = categories(df) if regions else ()
    return build_features(df if regions else df.drop(REGION), names, order=(TIME, EVENT))


def _indexed_features(spark: SparkSession, folder: str, regions: bool = False):
    """Features with row ids, staged by training membership, and the split."""
    df = sightings(spark, folder)
    names = categories(df) if regions else ()
    table = with_row_id(df if regions else df.drop(REGION), ties=[EVENT])
    split = temporal_split(table)
    rows = build_features(table.rows, names, total_rows=table.count)
    rows = rows.withColumn("is_train", is_train(split.cutoff))
    return stage(rows, "features", partition_by=["is_train"]), split


def _scaled(spark: SparkSession, folder: str) -> tuple[DataFrame, StandardScaler]:
    """Scaled features; statistics keep ten digits, so that no bin edge hangs on a last bit."""
    features, _ = _indexed_features(spark, folder)
    wanted = [*scaled_features(features.columns), "hora"]
    fitted = StandardScaler.fit(features.where("is_train"), wanted).rounded(10)
    return _without_hour(fitted).transform(features), fitted


def _without_hour(fitted: StandardScaler) -> StandardScaler:
    """The hour stays unscaled; its statistics only give the histogram range."""
    return StandardScaler(tuple(s for s in fitted.stats if s.feature != "hora"))


def _ranges(fitted: StandardScaler) -> dict[str, tuple[float, float]]:
    raw = {s.feature: (float(s.low), float(s.high)) for s in fitted.stats if s.feature == "hora"}
    return _without_hour(fitted).ranges() | raw


def _hbos(
    scaled: DataFrame, fitted: StandardScaler, bins: Sequence[int] = CONFIG.histogram_bins
) -> dict[int, hbos.HbosModel]:
    names = features_for_model("hbos", scaled.columns)
    return hbos.fit_hbos(scaled.where("is_train"), names, bins, _ranges(fitted))


def _hbos_scored(spark: SparkSession, folder: str) -> DataFrame:
    scaled, fitted = _scaled(spark, folder)
    outputs = {b: score_column(f"HBOS_bins{b}") for b in CONFIG.histogram_bins}
    return hbos.with_hbos_scores(scaled, _hbos(scaled, fitted), outputs).select(
        ROW_ID,
        EVENT,
        ENTITY,
        TIME,
        LAT,
        LON,
        "is_train",
        *[F.round(c, 9).alias(c) for c in outputs.values()],
    )


def _labelled(spark: SparkSession, folder: str) -> tuple[DataFrame, list[Threshold]]:
    scored = stage(_hbos_scored(spark, folder), "hbos_scores", partition_by=["is_train"])
    found = calibrate(scored.where("is_train"), MODELS, CONFIG.percentiles)
    found = [Threshold(t.model, t.percentile, t.value, "train") for t in found]
    return with_labels(scored, found, MODELS), found


def _windows(
    spark: SparkSession,
    folder: str,
    rule: str = GAP,
    features: Sequence[str] = SEQUENCE_FEATURES,
) -> DataFrame:
    """One row per fix with the flags and, where valid, the values of its window."""
    table = with_row_id(sightings(spark, folder).drop(REGION), ties=[EVENT])
    lookback = LOOKBACK + window_lookback(WINDOW)
    limit = CONFIG.max_rows_per_entity_task
    frames = entity_frames(table.rows, lookback, limit, total_rows=table.count)
    df = with_calendar_features(with_kinematics(frames.rows, frames.window))
    df = with_window_flags(df, frames, WINDOW, GAP_SECONDS, rule)
    values = window_values(frames, WINDOW, features, F.col("window_valid"))
    return frames.finish(df.withColumn("seq", values))


# --- scans, types, projections -------------------------------------------------------------


@query
def standardize_sightings(spark, folder):
    """Rename, parse and filter a raw table whose cells are text and partly missing."""
    raw = _table(spark, folder, "events").select(
        EVENT,
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        F.col("ts").cast("string").alias("ts"),
        F.col("value").cast("string").alias("lat"),
        "event_type",
    )
    names = {"user_id": ENTITY, "ts": TIME, "lat": LAT, "event_type": REGION, "RA": "absent"}
    return standardize(raw, names)


@query
def csv_scan(spark, folder):
    """Sightings written as CSV and read back without schema inference."""
    path = f"{scratch_root(spark)}/csv-{uuid.uuid4().hex}"
    write_csv(sightings(spark, folder), path)
    back = standardize(read_table(spark, path), {})
    return back.select(F.col(EVENT).cast("long"), F.col(ENTITY).cast("long"), TIME, LAT, LON, REGION)


@query
def csv_scan_quoted(spark, folder):
    """Texts with separators, quotes and line breaks written as CSV and read back."""
    path = f"{scratch_root(spark)}/csv-{uuid.uuid4().hex}"
    awkward = F.concat(F.lit(' "'), F.col("source"), F.lit('",\n'), F.col("text"), F.lit('\\"\r\n, '))
    write_csv(_table(spark, folder, "documents").select("doc_id", awkward.alias("text"), "lang"), path)
    back = read_csv(spark, path)
    return back.select(F.col("doc_id").cast("long"), "text", "lang")


@query
def timestamps_of_patterns(spark, folder):
    """Order dates as text of three patterns in one column."""
    day = F.col("o_orderdate")
    rest = F.col("o_orderkey") % 3
    text = F.when(rest == 0, day.cast("string")).when(rest == 1, F.date_format(day, "dd/MM/yyyy HH:mm"))
    text = text.otherwise(F.date_format(day, "yyyyMMdd HHmmss"))
    raw = _table(spark, folder, "orders").select("o_orderkey", "o_custkey", text.alias("quando"))
    return standardize(raw, {"o_custkey": ENTITY, "quando": TIME}, time_patterns=["dd/MM/yyyy HH:mm", "yyyyMMdd HHmmss"])


@query
def parquet_scan(spark, folder):
    return standardize(
        read_table(spark, f"{folder}/events.parquet"), {"user_id": ENTITY, "ts": TIME}
    ).select(EVENT, ENTITY, TIME, "event_type", "value")


@query
def temporal_features(spark, folder):
    df = with_calendar_features(sightings(spark, folder))
    return df.select(
        EVENT,
        "hora",
        "dia_sem",
        F.round("hora_sin", 6).alias("hora_sin"),
        F.round("hora_cos", 6).alias("hora_cos"),
        weekday_name(F.col(TIME)).alias("dia_semana"),
        F.to_date(TIME).cast("string").alias("dia"),
        month_of(F.col(TIME)).cast("string").alias("mes"),
        moment_text(F.col(TIME)).alias("momento"),
    )


@query
def holiday_flag(spark, folder):
    """Orders cover several years, so movable holidays matter."""
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return with_holiday_flag(orders, time="o_orderdate")


@query
def region_one_hot(spark, folder):
    df = sightings(spark, folder).select(EVENT, REGION)
    return with_one_hot(df, categories(df))


@query
def one_hot_index(spark, folder):
    """Names of parts, far more than named columns would allow, as numbers of a sorted list."""
    parts = _table(spark, folder, "part").select("p_partkey", "p_name")
    return with_category_index(parts, "p_name", "indice", vector=None)


def _rounded_motion(df: DataFrame) -> DataFrame:
    return df.select(
        EVENT,
        F.round("dist_m", 4).alias("dist_m"),
        F.round("velocidade_kmh", 6).alias("velocidade_kmh"),
        F.round("aceleracao", 9).alias("aceleracao"),
    )


@query
def kinematics(spark, folder):
    df = sightings(spark, folder)
    frames = entity_frames(df, LOOKBACK, CONFIG.max_rows_per_entity_task, order=(TIME, EVENT))
    return _rounded_motion(frames.finish(with_kinematics(frames.rows, frames.window)))


@query
def kinematics_of_hot_entities(spark, folder):
    """Same result with every entity above 40 fixes cut into blocks of the row order."""
    df = sightings(spark, folder)
    frames = entity_frames(df, LOOKBACK, 40, order=(TIME, EVENT))
    return _rounded_motion(frames.finish(with_kinematics(frames.rows, frames.window)))


@query
def feature_table(spark, folder):
    df = _features(spark, folder, regions=True)
    digits = {"dist_m": 4, "velocidade_kmh": 6, "aceleracao": 9, "hora_sin": 6, "hora_cos": 6}
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


# --- profiles ------------------------------------------------------------------------------


@query
def profile_of_sightings(spark, folder):
    df = _features(spark, folder)
    return dataset_profile(df).withColumn("vel_media", F.round("vel_media", 6))


@query
def vehicles_per_region(spark, folder):
    return entities_per_region(sightings(spark, folder))


@query
def vehicles_per_region_sketched(spark, folder):
    """Sketches by region and day, merged by region: is the estimate within five standard errors (or one) of the exact count?"""
    df = sightings(spark, folder).withColumn("day", F.to_date(TIME))
    merged = merged_sketches(entity_sketches(df, (REGION, "day")), (REGION,))
    both = approximate_entities(merged, "about").join(entities_per_region(df), REGION)
    error = F.abs(F.col("about") - F.col("veiculos"))
    near = error <= F.greatest(F.lit(1.0), F.col("veiculos") * (5 * 1.04 / 64))
    return both.select(REGION, "veiculos", near.alias("near"))


@query
def regions_written(spark, folder):
    """Orders per customer as one JSON object, written sorted and read back."""
    root = f"{scratch_root(spark)}/regions-{uuid.uuid4().hex}"
    orders = _table(spark, folder, "orders")
    named = orders.select(F.concat(F.lit('cliente "'), "o_custkey", F.lit('"')).alias(REGION), F.col("o_orderkey").alias(ENTITY))
    write_region_report(named, root)
    member = F.concat(F.lit("{"), F.regexp_extract("value", r"^[{,](.*?)\}?$", 1), F.lit("}"))
    lines = spark.read.text(f"{root}/{REGION_FILE}").select(F.from_json(member, "map<string,bigint>").alias("m"))
    return lines.select(F.explode("m").alias(REGION, "veiculos"))


@query
def columns_with_nan(spark, folder):
    """NaN counts as null in the column profile."""
    discount = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    tax = F.when(F.col("l_tax") > 0, F.col("l_tax"))
    return column_profile(_table(spark, folder, "lineitem").select("l_orderkey", discount.alias("l_discount"), tax.alias("l_tax")))


@query
def columns_of_lineitem(spark, folder):
    return column_profile(_table(spark, folder, "lineitem"))


@query
def numbers_of_lineitem(spark, folder):
    out = numeric_describe(_table(spark, folder, "lineitem"))
    return out.withColumns({c: F.round(c, 4) for c, t in out.dtypes if t == "double"})


@query
def categories_of_orders(spark, folder):
    return categorical_describe(_table(spark, folder, "orders"))


@query
def exact_price_percentiles(spark, folder):
    """Percentiles by rank search with a buffer far below the table size."""
    items = _table(spark, folder, "lineitem")
    columns = ["l_extendedprice", "l_discount"]
    wanted = [1, 25, 50, 90, 95, 99.9]
    found = exact_percentiles(items, {c: F.col(c) for c in columns}, wanted, direct_limit=500)
    rows = [
        F.struct(
            F.lit(c).alias("coluna"),
            F.lit(float(p)).alias("percentil"),
            F.lit(round(v, 6)).alias("valor"),
            F.col(f"n_{c}").alias("linhas"),
        )
        for c, values in found.items()
        for p, v in values.items()
    ]
    counted = items.agg(*[F.count(c).alias(f"n_{c}") for c in columns])
    return counted.select(F.inline(F.array(*rows)))


# --- split and scaling ---------------------------------------------------------------------


@query
def split_by_time(spark, folder):
    table = with_row_id(sightings(spark, folder), ties=[EVENT])
    split = temporal_split(table)
    return table.rows.select(
        EVENT,
        ROW_ID,
        is_train(split.cutoff).alias("is_train"),
        F.lit(str(split.cutoff_time())).cast("timestamp_ntz").alias("cutoff_timestamp"),
        F.lit(split.train_size).cast("long").alias("train_size"),
        F.lit(split.test_size).cast("long").alias("test_size"),
    )


@query
def standard_scale(spark, folder):
    features, _ = _indexed_features(spark, folder, regions=True)
    wanted = scaled_features(features.columns)
    fitted = StandardScaler.fit(features.where("is_train"), wanted).rounded(10)
    scaled = fitted.transform(features)
    return scaled.select(EVENT, *[F.round(c, 6).alias(c) for c in wanted])


# --- histogram scores ----------------------------------------------------------------------


@query
def hbos_bins(spark, folder):
    scaled, fitted = _scaled(spark, folder)
    return hbos.models_to_df(spark, _hbos(scaled, fitted)).select(
        "bins",
        "feature",
        "bin",
        F.round("edge_low", 6).alias("edge_low"),
        F.round("edge_high", 6).alias("edge_high"),
        "count",
        F.round("density", 6).alias("density"),
        F.round("bin_score", 6).alias("bin_score"),
    )


def _hbos_query(bins: int) -> Query:
    def run(spark, folder):
        scaled, fitted = _scaled(spark, folder)
        scored = hbos.with_hbos_scores(scaled, _hbos(scaled, fitted, [bins]), {bins: "score"})
        return scored.select(EVENT, F.round("score", 6).alias("score"))

    run.__name__ = f"hbos_scores_{bins}"
    return query(run)


hbos_scores_10 = _hbos_query(10)
hbos_scores_20 = _hbos_query(20)


@query
def hbos_labels(spark, folder):
    train = _hbos_scored(spark, folder).where("is_train")
    return hbos.contamination_labels(train, "HBOS_bins10_score", 0.1).select(EVENT, "label")


@query
def model_roundtrip(spark, folder):
    """Scaler and histograms saved as tables, loaded again, then used for scoring."""
    features, _ = _indexed_features(spark, folder)
    wanted = [*scaled_features(features.columns), "hora"]
    root = f"{scratch_root(spark)}/models-{uuid.uuid4().hex}"
    StandardScaler.fit(features.where("is_train"), wanted).rounded(10).save(spark, f"{root}/scaler")
    fitted = StandardScaler.load(spark, f"{root}/scaler")
    scaled = _without_hour(fitted).transform(features)
    hbos.save_models(spark, _hbos(scaled, fitted), f"{root}/hbos")
    models = hbos.load_models(spark, f"{root}/hbos")
    outputs = {b: f"score_{b}" for b in models}
    return hbos.with_hbos_scores(scaled, models, outputs).select(
        EVENT, *[F.round(c, 6).alias(c) for c in outputs.values()]
    )


@query
def score_range(spark, folder):
    scored = _hbos_scored(spark, folder)
    out = score_ranges(scored, MODELS, {m: F.col("is_train") for m in MODELS})
    return out.withColumns({c: F.round(c, 6) for c, t in out.dtypes if t == "double"})


@query
def score_stats(spark, folder):
    out = score_statistics(_hbos_scored(spark, folder), "HBOS_bins10_score")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


# --- windows -------------------------------------------------------------------------------


@query
def gap_windows(spark, folder):
    return _windows(spark, folder).where("window_valid").select(ROW_ID, EVENT, ENTITY)


@query
def gap_windows_span(spark, folder):
    return _windows(spark, folder, SPAN).where("window_valid").select(ROW_ID, EVENT, ENTITY)


@query
def gap_windows_of_hot_entities(spark, folder):
    """Span rule with every entity above 40 fixes cut into blocks of the row order."""
    df = with_row_id(sightings(spark, folder), ties=[EVENT]).rows
    frames = entity_frames(df, window_lookback(WINDOW), 40)
    flagged = frames.finish(with_window_flags(frames.rows, frames, WINDOW, GAP_SECONDS, SPAN))
    return flagged.where("window_valid").select(ROW_ID, EVENT, ENTITY)


@query
def windows_counted(spark, folder):
    df = sightings(spark, folder)
    frames = entity_frames(df, window_lookback(60), CONFIG.max_rows_per_entity_task, order=(TIME, EVENT))
    flagged = frames.finish(with_window_flags(frames.rows, frames, 60, 5 * GAP_SECONDS))
    return window_counters(flagged, 60)


@query
def window_payload(spark, folder):
    valid = _windows(spark, folder).where("window_valid")
    cells = [
        F.round(F.col("seq")[t][f], 6).alias(f"t{t}_{name}")
        for t in range(WINDOW)
        for f, name in enumerate(SEQUENCE_FEATURES)
    ]
    return valid.select(EVENT, *cells)


def _mean_errors(windows: DataFrame) -> DataFrame:
    """Error of reconstructing each step by the mean of its window."""
    means = F.array(
        *[
            sum(F.col("seq")[t][f] for t in range(WINDOW)) / WINDOW
            for f in range(len(SEQUENCE_FEATURES))
        ]
    )
    error = recurrent.mean_squared_error(
        F.flatten("seq"), F.flatten(F.array_repeat(means, WINDOW))
    )
    return windows.where("window_valid").withColumn("score", error)


@query
def reconstruction_mse(spark, folder):
    scored = _mean_errors(_windows(spark, folder))
    return scored.select(EVENT, F.round("score", 3).alias("score"))


@query
def score_writeback(spark, folder):
    """Scores of windows joined back to all rows, and masks joined to windows."""
    table = with_row_id(sightings(spark, folder).drop(REGION), ties=[EVENT])
    split = temporal_split(table)
    masks = table.rows.select(ROW_ID, is_train(split.cutoff).alias("in_train"))
    scored = _mean_errors(_windows(spark, folder)).select(ROW_ID, F.round("score", 3).alias("score"))
    ends = at_window_end(scored, masks, ROW_ID)
    return write_back(table.rows.select(ROW_ID, EVENT), ends, ROW_ID).select(
        EVENT, "score", F.coalesce(F.col("in_train").cast("int"), F.lit(-1)).alias("in_train")
    )


# --- thresholds, scenarios, evaluation -----------------------------------------------------


@query
def threshold_labels(spark, folder):
    labelled, found = _labelled(spark, folder)
    return labelled.select(EVENT, *[t.label for t in found])


@query
def threshold_table(spark, folder):
    labelled, found = _labelled(spark, folder)
    return threshold_metrics(labelled, found)


@query
def scenario_masks(spark, folder):
    """The two histogram models stand in for the two detector families."""
    labelled, _ = _labelled(spark, folder)
    train = F.col("is_train")
    pair = tuple(MODELS)
    return labelled.select(
        EVENT,
        Scenario("Uniao", pair, both=True).mask(train).alias("uniao"),
        Scenario("Inter", pair, both=False).mask(train).alias("inter"),
        Scenario("Sujo").mask(train).alias("sujo"),
    )


@query
def grid_masks(spark, folder):
    """Rows of every scenario of a grid, counted from the bit sets that training uses."""
    labelled, _ = _labelled(spark, folder)
    grid = scenario_grid(list(MODELS), list(MODELS))
    bits = membership_bits([s.mask(F.col("is_train")) for s in grid])
    counts = labelled.select(bits.alias("bits")).agg(*[F.count_if(has_member(F.col("bits"), i)).alias(f"n{i}") for i in range(len(grid))])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(s.name).alias("cenario"), F.col(f"n{i}").alias("linhas")) for i, s in enumerate(grid)])))


@query
def comparison_with_reference(spark, folder):
    """All labels against the reference label, the last isolation label at the 95th percentile."""
    items = _walked(spark, folder).select(F.round("score", 9).alias("ISO_walk_score"), "l_extendedprice", "l_quantity")
    items = stage(items, "walked")
    scores = {"ISO_walk": "ISO_walk_score", "ISO_price": "l_extendedprice", "HBOS_quantity": "l_quantity"}
    return compare_with_reference(with_labels(items, calibrate(items, scores, [90, 95]), scores))


@query
def model_comparison(spark, folder):
    labelled, found = _labelled(spark, folder)
    return compare_labels(labelled, TRUTH, [t.label for t in found if t.label != TRUTH])


@query
def confusion_table(spark, folder):
    labelled, found = _labelled(spark, folder)
    return confusion_counts(labelled, TRUTH, [t.label for t in found])


@query
def flags_above_percentile(spark, folder):
    scored = _mean_errors(_windows(spark, folder)).select(EVENT, F.round("score", 3).alias("score"))
    flagged, limit = strict_flags(stage(scored, "window_scores"), "score", 95)
    return flagged.select(EVENT, "anomaly", F.lit(round(limit, 3)).alias("threshold"))


@query
def results_of_family(spark, folder):
    labelled, _ = _labelled(spark, folder)
    out = family_results(labelled, "HBOS")
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c.endswith("_score")})


@query
def metrics_of_family(spark, folder):
    labelled, found = _labelled(spark, folder)
    return family_metrics(threshold_metrics(labelled, found), "HBOS_bins20")


@query
def family_files_compiled(spark, folder):
    """Metrics written per family and compiled again from the files."""
    labelled, found = _labelled(spark, folder)
    root = f"{scratch_root(spark)}/reports-{uuid.uuid4().hex}"
    metrics = threshold_metrics(labelled, found)
    write_csv(metrics.where("Model = 'HBOS_bins10'"), f"{root}/describe_HBOS_a.csv")
    slim = metrics.where("Model = 'HBOS_bins20'").drop("Pct_Dataset")
    write_csv(slim, f"{root}/describe_HBOS_b.csv")
    write_family_metrics(metrics, root)
    parts = [
        df.select(F.lit(family).alias("family"), "Model", "Percentile", "Pct_Dataset")
        for family, df in read_families(spark, f"{root}/describe_*.csv").items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        "family",
        "Model",
        F.col("Percentile").cast("int").alias("Percentile"),
        F.col("Pct_Dataset").cast("double").alias("Pct_Dataset"),
    )


@query
def families_written(spark, folder):
    """Result files of a family stacked, written as one table and read back."""
    labelled, found = _labelled(spark, folder)
    root = f"{scratch_root(spark)}/compiled-{uuid.uuid4().hex}"
    metrics = threshold_metrics(labelled, found)
    write_csv(metrics.where("Model = 'HBOS_bins10'"), f"{root}/describe_HBOS_a.csv")
    write_csv(metrics.where("Model = 'HBOS_bins20'").drop("Pct_Dataset"), f"{root}/describe_HBOS_b.csv")
    (path,) = write_compiled_families(spark, f"{root}/describe_*.csv", root)
    columns = {"Percentile": "int", "Anomalies_Detected": "long", "Pct_Dataset": "double"}
    return read_table(spark, path).select("Model", *[F.col(c).cast(t).alias(c) for c, t in columns.items()])


@query
def sinks_read_back(spark, folder):
    """Results of a family published as a whole run, twice, and read through the manifest."""
    labelled, _ = _labelled(spark, folder)
    root = f"{scratch_root(spark)}/published-{uuid.uuid4().hex}"
    publish(spark, root, lambda run: write_family_results(labelled.limit(0), run))
    publish(spark, root, lambda run: write_family_results(labelled, run))
    back = read_table(spark, f"{published_run(spark, root)}/hbos_results.csv")
    kinds = {c: "int" if c.endswith("_label") else "double" for c in back.columns} | {ENTITY: "long", TIME: "timestamp_ntz"}
    typed = back.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()])
    return typed.withColumns({c: F.round(c, 6) for c in typed.columns if c.endswith("_score")})


# --- trees as tables -----------------------------------------------------------------------

FOREST_FEATURES = ("l_quantity", "l_extendedprice", "l_discount")
FOREST_SAMPLE = 256
#: A small forest written out: (tree, node, feature, threshold, left, right, path); a leaf points at itself.
FOREST_NODES = (
    (0, 0, 1, 30000.5, 1, 2, 0.0),
    (0, 1, 0, 20.0, 3, 4, 0.0),
    (0, 2, 2, 0.05, 5, 6, 0.0),
    (0, 3, 0, float("inf"), 3, 3, 9.25),
    (0, 4, 0, float("inf"), 4, 4, 8.5),
    (0, 5, 0, float("inf"), 5, 5, 6.75),
    (0, 6, 0, float("inf"), 6, 6, 4.0),
    (1, 0, 2, 0.02, 1, 2, 0.0),
    (1, 1, 0, float("inf"), 1, 1, 5.5),
    (1, 2, 0, 45.0, 3, 4, 0.0),
    (1, 3, 1, 10000.0, 5, 6, 0.0),
    (1, 4, 0, float("inf"), 4, 4, 2.0),
    (1, 5, 0, float("inf"), 5, 5, 7.0),
    (1, 6, 0, float("inf"), 6, 6, 10.5),
    (2, 0, 0, float("inf"), 0, 0, 11.0),
)
_NODES = "tree int, node int, feature int, threshold double, left int, right int, path double"


def _walked(spark: SparkSession, folder: str) -> DataFrame:
    nodes = spark.createDataFrame(list(FOREST_NODES), _NODES)
    return walk_forest(_table(spark, folder, "lineitem"), nodes, FOREST_FEATURES, FOREST_SAMPLE)


@query
def forest_walk(spark, folder):
    """Every line item through a forest given as a table of nodes, inside the JVM, with labels."""
    scored = isolation_labels(_walked(spark, folder), "score")
    return scored.select("l_orderkey", "l_linenumber", F.round("path", 9).alias("path"), F.round("score", 9).alias("score"), "label")


@query
def forest_invariants(spark, folder):
    """What holds for any forest grown here, whatever its random numbers."""
    features, split = _indexed_features(spark, folder)
    features = features.withColumn("velocidade_kmh", F.when(F.col(EVENT) % 50 != 0, F.col("velocidade_kmh")))
    wanted = features_for_model("isolation_forest", features.columns)
    train = features.where("is_train").fillna(0.0, subset=wanted)
    forest = IsolationForest.fit(train, split.train_size, wanted, 20, CONFIG.seed)
    nodes = forest.to_df(spark)
    leaf = F.col("left") == F.col("node")
    per_tree = nodes.groupBy("tree").agg(
        F.count_if(leaf).alias("leaves"), F.count_if(~leaf).alias("inner"), F.sum(F.when(leaf, F.col("size"))).alias("points")
    )
    trees = per_tree.agg(
        F.count(F.lit(1)).alias("trees"),
        F.count_if(F.col("leaves") == F.col("inner") + 1).alias("binary_trees"),
        F.count_if(F.col("points") == forest.sample_size).alias("full_trees"),
    )
    walked = walk_forest(forest.with_scores(features, {20: "vector"}), nodes, wanted, forest.sample_size)
    same = F.col("vector").eqNullSafe(F.col("score")) | (F.abs(F.col("vector") - F.col("score")) < 1e-12)
    rows = walked.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.coalesce(same, F.lit(False))).alias("walks_differ"),
        F.count("score").alias("scored"),
        F.count_if((F.col("score") <= 0) | (F.col("score") > 1)).alias("out_of_range"),
    )
    return rows.select("*", *[trees.select(c).scalar().alias(c) for c in trees.columns])


# --- seeded models -------------------------------------------------------------------------


@query
def iforest_scores(spark, folder):
    features, split = _indexed_features(spark, folder, regions=True)
    scaled = StandardScaler.fit(
        features.where("is_train"), scaled_features(features.columns)
    ).transform(features)
    wanted = features_for_model("isolation_forest", scaled.columns)
    forest = IsolationForest.fit(scaled.where("is_train"), split.train_size, wanted, 200, CONFIG.seed)
    outputs = {n: score_column(f"ISO_n{n}") for n in CONFIG.isolation_trees}
    scored = forest.with_scores(scaled, outputs).select(EVENT, *outputs.values())
    return isolation_labels(scored, "ISO_n100_score")


def _autoencoder_query(name: str, cell: str, activation: str, dropout: float, rule: str) -> Query:
    def run(spark, folder):
        wanted = ["dist_m", "latitude", "longitude", "hora_sin", "hora_cos"]
        windows = _windows(spark, folder, rule, wanted)
        windows = stage(
            windows.select(EVENT, ROW_ID, F.flatten("seq").alias("seq")), "windows"
        )
        models = recurrent.train_autoencoders(
            windows,
            {"all": F.lit(True)},
            Architecture(WINDOW, len(wanted), cell, activation, dropout),
            epochs=CONFIG.epochs,
        )
        return recurrent.with_autoencoder_scores(windows, models).select(EVENT, "all_score")

    run.__name__ = name
    return query(run)


gru_scores = _autoencoder_query("gru_scores", "gru", "tanh", 0.2, GAP)
lstm_scores = _autoencoder_query("lstm_scores", "lstm", "tanh", 0.2, GAP)
lstm_relu_span_scores = _autoencoder_query("lstm_relu_span_scores", "lstm", "relu", 0.0, SPAN)
gru_relu_scores = _autoencoder_query("gru_relu_scores", "gru", "relu", 0.0, GAP)


@query
def master_table(spark, folder):
    return run_experiment(sightings(spark, folder), CONFIG, ties=[EVENT]).master


@query
def master_fixed_part(spark, folder):
    """What an end-to-end run gives besides random models: order, calendar and standardised features."""
    config = replace(CONFIG, isolation_trees=(5,), histogram_bins=(10,), epochs=1)
    master = run_experiment(sightings(spark, folder), config, ties=[EVENT]).master
    motion = ("velocidade_kmh", "dist_m", "aceleracao", "hora_sin", "hora_cos", "dia_sem", "eh_feriado")
    return master.select(EVENT, ROW_ID, ENTITY, "hora", "dia_semana", *[F.round(c, 6).alias(c) for c in motion])


@query
def flagged_sightings(spark, folder):
    """Sightings whose histogram score reaches the 99th percentile of the training part."""
    labelled, _ = _labelled(spark, folder)
    return labelled.where("HBOS_bins10_p99_label = 1").select(
        EVENT, ENTITY, TIME, F.round("HBOS_bins10_score", 6).alias("score")
    )
