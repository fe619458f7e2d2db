"""The end-to-end run: sightings in, scored and labelled master table and reports out."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtrail.config import (
    ENTITY,
    REGION,
    ROW_ID,
    TIME,
    ExperimentConfig,
    check_percentiles,
    features_for_model,
    score_column,
)
from fixtrail.functions.calendar import weekday_name
from fixtrail.operators import hbos, recurrent
from fixtrail.operators.evaluate import compare_with_reference
from fixtrail.operators.features import apply_features, has_coordinates, scaled_features
from fixtrail.operators.iforest import IsolationForest
from fixtrail.operators.kinematics import LOOKBACK
from fixtrail.operators.lookback import entity_frames
from fixtrail.operators.onehot import few_categories, with_category_index
from fixtrail.operators.profile import dataset_profile
from fixtrail.operators.recurrent_cells import Architecture
from fixtrail.operators.rowindex import TemporalSplit, is_train, temporal_split, with_row_id
from fixtrail.operators.scaler import StandardScaler
from fixtrail.operators.scenarios import scenario_grid
from fixtrail.operators.staging import stage
from fixtrail.operators.thresholds import Threshold, calibrate, threshold_metrics, with_labels
from fixtrail.operators.windows import window_lookback, window_values, with_window_flags
from fixtrail.sources.sinks import (
    publish,
    write_csv,
    write_family_metrics,
    write_family_results,
    write_json,
    write_parquet,
)
from fixtrail.sources.tables import read_first, standardize

# Fixed value: the note in place of the figures of an empty profile.
NOTHING_LOCATED = "Base vazia ou sem agrupamento possível"

_TRAIN = "is_train"
_SEQ = "seq"


@dataclass(frozen=True)
class ExperimentResult:
    """Tables of one run; all are scans over staged results."""

    master: DataFrame
    metrics: DataFrame
    comparison: DataFrame | None
    profile: DataFrame
    split: TemporalSplit
    thresholds: list[Threshold]
    scaler: StandardScaler
    forest: IsolationForest
    histograms: dict[int, hbos.HbosModel]
    autoencoders: dict[str, recurrent.TrainedAutoencoder]


def feature_table(
    sightings: DataFrame, config: ExperimentConfig, ties: Sequence[str] | None = None
) -> tuple[DataFrame, TemporalSplit]:
    """Indexed feature table with the raw window values that end on each row, staged once.

    One range exchange gives the row order, one hash exchange by entity serves the features
    and the windows alike. The table is partitioned by training membership, so later passes
    over the training rows read only those.
    """
    indexed = with_row_id(sightings, (TIME, ENTITY), ties)
    split = temporal_split(indexed, config.train_ratio)
    rows = indexed.rows
    regions: Sequence = ()
    if REGION in rows.columns:
        regions = few_categories(rows, REGION, config.max_one_hot_categories)
        if regions is None:  # more values than named columns: an index and a sparse vector, which no detector reads
            rows, regions = with_category_index(rows), ()
    lookback = LOOKBACK + window_lookback(config.window_size)
    frames = entity_frames(
        rows, lookback, config.max_rows_per_entity_task, ENTITY, (ROW_ID,), indexed.count
    )
    df = apply_features(frames, regions)
    df = with_window_flags(df, frames, config.window_size, config.max_gap_seconds)
    sequence = features_for_model(config.arch, df.columns)
    if sequence:
        values = window_values(frames, config.window_size, sequence, F.col("window_valid"))
        df = df.withColumn(_SEQ, F.flatten(values))
    df = frames.finish(df).drop("window_full", "window_valid")
    df = df.withColumn(_TRAIN, is_train(split.cutoff))
    return stage(df, "features", partition_by=[_TRAIN]), split


def _scale_sequence(
    scaler: StandardScaler, features: Sequence[str], window: int
) -> F.Column:
    """Scale the flattened window values; coordinates are not scaled."""
    known = {s.feature: s for s in scaler.stats}
    means = [known[f].mean if f in known else 0.0 for f in features] * window
    scales = [known[f].scale if f in known else 1.0 for f in features] * window
    shifted = F.zip_with(F.col(_SEQ), F.lit(means), lambda v, m: v - m)
    return F.zip_with(shifted, F.lit(scales), lambda v, s: v / s)


def base_scores(
    features: DataFrame, split: TemporalSplit, config: ExperimentConfig
) -> tuple[DataFrame, StandardScaler, IsolationForest, dict[int, hbos.HbosModel]]:
    """Scaled table with isolation and histogram scores.

    One aggregate over the training rows gives the scaler and the histogram ranges, one
    counting pass the histograms, one broadcast join the tree samples.
    """
    train = features.where(_TRAIN)
    hist_features = features_for_model("hbos", features.columns)
    wanted = scaled_features(features.columns)
    unscaled = [f for f in hist_features if f not in wanted]
    stats = StandardScaler.fit(train, [*wanted, *unscaled])
    scaler = StandardScaler(tuple(s for s in stats.stats if s.feature in wanted))
    ranges = scaler.ranges() | {
        s.feature: (s.low, s.high) for s in stats.stats if s.feature in unscaled
    }
    scaled = scaler.transform(features)
    histograms = hbos.fit_hbos(scaled.where(_TRAIN), hist_features, config.histogram_bins, ranges)
    forest = IsolationForest.fit(
        scaled.where(_TRAIN),
        split.train_size,
        features_for_model("isolation_forest", features.columns),
        max(config.isolation_trees),
        config.seed,
    )
    outputs = {n: score_column(f"ISO_n{n}") for n in config.isolation_trees}
    scored = hbos.with_hbos_scores(
        forest.with_scores(scaled, outputs),
        histograms,
        {b: score_column(f"HBOS_bins{b}") for b in histograms},
    )
    if _SEQ in scored.columns:
        sequence = features_for_model(config.arch, features.columns)
        scored = scored.withColumn(_SEQ, _scale_sequence(scaler, sequence, config.window_size))
    return scored, scaler, forest, histograms


def run_experiment(
    sightings: DataFrame, config: ExperimentConfig | None = None, ties: Sequence[str] | None = None
) -> ExperimentResult:
    """Run all stages over standardised sightings.

    ``ties`` are the columns that order rows of one entity and instant; by default all.
    """
    config = config or ExperimentConfig()
    percentiles = check_percentiles(config.percentiles)
    features, split = feature_table(sightings, config, ties)
    if not split.train_size:
        raise ValueError("the training part is empty")
    scored, scaler, forest, histograms = base_scores(features, split, config)
    scored = stage(scored, "base_scores", partition_by=[_TRAIN])

    iso = [f"ISO_n{n}" for n in config.isolation_trees]
    hist = [f"HBOS_bins{b}" for b in config.histogram_bins]
    base = {m: score_column(m) for m in [*iso, *hist]}
    train = F.col(_TRAIN)
    thresholds = calibrate(scored.where(train), base, percentiles)
    thresholds = [Threshold(t.model, t.percentile, t.value, "train") for t in thresholds]
    labelled = with_labels(scored, thresholds, base)

    scenarios = {s.name: s.mask(train) for s in scenario_grid(iso, hist)}
    models: dict[str, recurrent.TrainedAutoencoder] = {}
    if _SEQ in labelled.columns:
        sequence = features_for_model(config.arch, features.columns)
        models = recurrent.train_autoencoders(
            labelled.where(train),
            scenarios,
            Architecture(config.window_size, len(sequence), config.arch),
            _SEQ,
            config.epochs,
            config.batch_size,
            config.seed,
            config.rows_per_training_shard,
        )
    if models:
        master = stage(
            recurrent.with_autoencoder_scores(labelled, models, _SEQ).drop(_SEQ),
            "sequence_scores",
            partition_by=[_TRAIN],
        )
        scores = {m: score_column(m) for m in models}
        found = calibrate(
            master.where(train), scores, percentiles, {m: scenarios[m] for m in models}
        )
        master = with_labels(master, found, scores)
        thresholds += found
    else:
        warnings.warn(
            "no window of consecutive fixes was trained on: too few rows per entity, gaps "
            "above the limit, or a window longer than the histories",
            stacklevel=2,
        )
        master = labelled.drop(_SEQ)
    if not thresholds:
        raise RuntimeError("no threshold metrics were produced")
    master = _arranged(master.withColumn("dia_semana", weekday_name(F.col(TIME))), thresholds)
    # each report is one pass over the master table; staged, it is not repeated per output
    comparison = compare_with_reference(master)
    return ExperimentResult(
        master.drop(_TRAIN),
        stage(threshold_metrics(master, thresholds), "metrics"),
        None if comparison is None else stage(comparison, "comparison"),
        _profile(features, split),
        split,
        thresholds,
        scaler,
        forest,
        histograms,
        models,
    )


def _arranged(df: DataFrame, thresholds: Sequence[Threshold]) -> DataFrame:
    """Scores last, each followed by its labels."""
    results = []
    for t in thresholds:
        results += [c for c in (score_column(t.model), t.label) if c not in results]
    others = [c for c in df.columns if c not in results]
    return df.select(*[f"`{c}`" for c in [*others, *results]])


def _profile(features: DataFrame, split: TemporalSplit) -> DataFrame:
    """Dataset profile with the feature lists and the split facts.

    Without any located row a note takes the place of the figures.
    """
    profile = None
    if has_coordinates(features):
        profile = stage(dataset_profile(features), "profile")
        if profile.where("fluxo_veiculos_local IS NOT NULL").isEmpty():
            profile = None
    if profile is None:
        profile = features.agg(F.lit(NOTHING_LOCATED).alias("info"))
    lists = {
        "features_iso": features_for_model("isolation_forest", features.columns),
        "features_hbos": features_for_model("hbos", features.columns),
        "features_gru": features_for_model("gru", features.columns),
    }
    return profile.withColumns(
        {
            **{name: F.lit(values) for name, values in lists.items()},
            "split_temporal": F.struct(
                F.lit(str(split.cutoff_time())).alias("cutoff_timestamp"),
                F.lit(split.train_size).alias("train_size"),
                F.lit(split.test_size).alias("test_size"),
                F.lit(split.train_ratio).alias("train_ratio"),
            ),
        }
    )


def write_outputs(result: ExperimentResult, folder: str) -> None:
    """Master table, per-family metrics and results, comparison, profile and models."""
    spark = result.master.sparkSession
    write_parquet(result.master.drop(ROW_ID), f"{folder}/master_table/resultado_final.parquet")
    master = spark.read.parquet(f"{folder}/master_table/resultado_final.parquet")
    write_family_metrics(result.metrics, f"{folder}/metrics")
    if result.comparison is not None:
        write_csv(result.comparison.coalesce(1), f"{folder}/metrics/comparativo_completo.csv")
    write_family_results(master, f"{folder}/metrics")
    write_json(result.profile, f"{folder}/metrics/perfil_dados.json")
    models = f"{folder}/models_saved"
    result.scaler.save(spark, f"{models}/scaler")
    result.forest.save(spark, f"{models}/isolation_forest")
    hbos.save_models(spark, result.histograms, f"{models}/hbos")
    if result.autoencoders:
        recurrent.save_models(spark, result.autoencoders, f"{models}/autoencoders")


def run_from_files(
    spark: SparkSession,
    inputs: Sequence[str],
    output: str | None = None,
    config: ExperimentConfig | None = None,
    whole_runs: bool = False,
) -> ExperimentResult:
    """Read the first input that exists, run all stages and write the outputs.

    Outputs go straight below ``output``, or with ``whole_runs`` into a run folder of their own that is
    published when it is complete (see ``sources/sinks.py``).
    """
    config = config or ExperimentConfig()
    sightings = standardize(read_first(spark, inputs), config.column_map, time_patterns=config.time_patterns)
    result = run_experiment(sightings, config)
    if output is not None:
        folder = output.rstrip("/")
        if whole_runs:
            publish(spark, folder, lambda run: write_outputs(result, run))
        else:
            write_outputs(result, folder)
    return result
