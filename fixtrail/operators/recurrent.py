"""Data-parallel training and scoring of recurrent autoencoders over gap-aware windows.

One Spark job per epoch trains all scenarios at once: each shard of the windows runs
mini-batches from the common weights inside its task, and Spark averages the resulting
weights and optimiser moments by row count (parameter averaging). With a single shard this
is plain sequential mini-batch training. Only one weight vector per scenario and epoch
reaches the driver, whatever the number of windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtrail.config import ROW_ID, score_column
from fixtrail.operators.recurrent_cells import Architecture, Autoencoder, TrainingState, train_epoch
from fixtrail.operators.scenarios import any_member, has_member, member_rows, membership_bits
from fixtrail.operators.staging import stage

_PATIENCE = 3
_SCORE_CHUNK = 256  # keeps the activations in the processor cache
_FILES_PER_CORE = 4
_SHARDS_PER_FILE = 512
# partial averages are merged in groups of this many tasks before the final merge
_MERGE_GROUPS = 32

_MODEL_SCHEMA = (
    "scenario string, window int, features int, cell string, activation string, "
    "dropout double, losses array<double>, weights array<double>"
)


@dataclass(frozen=True)
class TrainedAutoencoder:
    scenario: str
    arch: Architecture
    weights: np.ndarray
    losses: tuple[float, ...]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _shards(batches: Iterator[pa.RecordBatch], width: int):
    """Collect the rows of one shard at a time; rows arrive grouped by shard.

    A shard has a bounded number of rows by construction.
    """
    current, parts = None, []

    def gather():
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    for batch in batches:
        shard = batch.column("shard").to_numpy()
        values = _matrix(batch.column("seq"), width)
        members = batch.column("members").flatten().to_numpy().reshape(batch.num_rows, -1)
        cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1), len(shard)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if current is not None and shard[a] != current:
                yield current, *gather()
                parts = []
            current = shard[a]
            parts.append((values[a:b], members[a:b]))
    if parts:
        yield current, *gather()


def _epoch_results(
    table: DataFrame,
    arch: Architecture,
    state: TrainingState,
    active: Sequence[int],
    batch_size: int,
    seed: Sequence[int],
    groups: int,
) -> list:
    """Averaged state and loss of every active scenario after one pass over ``table``."""
    width = arch.window * arch.features
    active = list(active)
    start = TrainingState(*(a[active] for a in vars(state).values()))
    seed = list(seed)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(active), 3 * arch.size))
        counts, steps, losses = (np.zeros(len(active)) for _ in range(3))
        last = 0
        for shard, values, bits in _shards(batches, width):
            members = member_rows(bits, active)
            own = start.copy()
            rows = values.reshape(-1, arch.window, arch.features)
            rng = np.random.default_rng([*seed, int(shard)])
            losses += train_epoch(arch, own, rows, members, batch_size, rng)
            n = members.sum(axis=1).astype(np.float64)
            sums += n[:, None] * np.concatenate([own.weights, own.first, own.second], axis=1)
            steps += n * own.steps
            counts += n
            last = int(shard)
        seen = [i for i in range(len(active)) if counts[i]]
        if seen:
            yield pa.RecordBatch.from_pydict(
                {
                    "scenario": pa.array([active[i] for i in seen], pa.int32()),
                    "part": pa.array([last % groups] * len(seen), pa.int32()),
                    "n": pa.array(counts[seen]),
                    "state": pa.array(
                        [
                            np.concatenate([sums[i], [steps[i], losses[i]]]) / counts[i]
                            for i in seen
                        ],
                        pa.list_(pa.float64()),
                    ),
                }
            )

    done = table.mapInArrow(train, "scenario int, part int, n double, state array<double>")
    weighted = done.withColumn("state", array_to_vector("state"))
    mean = Summarizer.mean(F.col("state"), F.col("n"))
    if groups > 1:
        weighted = weighted.groupBy("scenario", "part").agg(mean.alias("state"), F.sum("n").alias("n"))
    # one row per scenario
    return weighted.groupBy("scenario").agg(vector_to_array(mean).alias("state")).collect()


def training_table(
    windows: DataFrame,
    members: Mapping[str, Column],
    seq: str,
    rows_per_shard: int,
    row_id: str = ROW_ID,
) -> tuple[DataFrame, dict[str, int], int]:
    """Stage the windows that any scenario trains on, laid out by shard.

    The shard depends on the row id only, so training does not depend on how the input was
    partitioned. Windows with a missing value are left out. Returns the table, the number
    of training windows per scenario and the number of shards.
    """
    bits = membership_bits(list(members.values()))
    complete = F.col(seq).isNotNull() & ~F.exists(F.col(seq), lambda v: v.isNull() | F.isnan(v))
    picked = (
        windows.where(complete)
        .select(row_id, F.col(seq).cast("array<float>").alias("seq"), bits.alias("members"))
        .where(any_member(F.col("members")))
    )
    sizes = picked.agg(
        F.count(F.lit(1)).alias("all"),
        *[
            F.count_if(has_member(F.col("members"), i)).alias(f"s{i}")
            for i in range(len(members))
        ],
    ).first()
    counts = {name: sizes[f"s{i}"] for i, name in enumerate(members)}
    shards = max(1, math.ceil(sizes["all"] / rows_per_shard))
    cores = windows.sparkSession.sparkContext.defaultParallelism
    files = min(shards, max(cores * _FILES_PER_CORE, math.ceil(shards / _SHARDS_PER_FILE)))
    sharded = picked.withColumn("shard", F.pmod(F.xxhash64(row_id), F.lit(shards)).cast("long"))
    file = F.expr(f"cast(shard * {files} div {shards} as int)")
    placed = sharded.repartitionById(files, file).sortWithinPartitions("shard", row_id)
    table = stage(placed, "training")
    return table.select("shard", "members", "seq"), counts, shards


def train_autoencoders(
    windows: DataFrame,
    members: Mapping[str, Column],
    arch: Architecture,
    seq: str = "seq",
    epochs: int = 10,
    batch_size: int = 64,
    seed: int = 42,
    rows_per_shard: int = 4_096,
    row_id: str = ROW_ID,
) -> dict[str, TrainedAutoencoder]:
    """Train a fresh model per scenario on the windows of its mask.

    ``seq`` is an array of window x features doubles, oldest row first. A scenario stops
    after three epochs without a lower loss and keeps its best weights. A scenario without
    training windows is absent from the result.
    """
    table, counts, shards = training_table(windows, members, seq, rows_per_shard, row_id)
    names = list(members)
    flat = arch.initial([(seed, i) for i in range(len(names))]).astype(np.float32)
    state = TrainingState(flat, np.zeros_like(flat), np.zeros_like(flat), np.zeros(len(names)))
    best = flat.copy()
    history: dict[int, list[float]] = {i: [] for i in range(len(names))}
    active = [i for i, name in enumerate(names) if counts[name]]
    groups = _MERGE_GROUPS if shards > _MERGE_GROUPS * 2 else 1
    size = arch.size
    for epoch in range(epochs):
        if not active:
            break
        for row in _epoch_results(table, arch, state, active, batch_size, [seed, epoch], groups):
            i, values = row["scenario"], np.array(row["state"])
            state.weights[i], state.first[i], state.second[i] = (
                values[k * size : (k + 1) * size] for k in range(3)
            )
            state.steps[i] = round(values[-2])
            if not history[i] or values[-1] < min(history[i]):
                best[i] = state.weights[i]
            history[i].append(float(values[-1]))
        active = [
            i for i in active if len(history[i]) - 1 - int(np.argmin(history[i])) < _PATIENCE
        ]
    return {
        name: TrainedAutoencoder(name, arch, best[i], tuple(history[i]))
        for i, name in enumerate(names)
        if counts[name]
    }


def reconstruction_scores(models: Sequence[TrainedAutoencoder], seq: Column) -> Column:
    """Array with the reconstruction error of every model; NULL for incomplete windows."""
    arch = models[0].arch
    if any(m.arch != arch for m in models):
        raise ValueError("models of one scoring pass must share their architecture")
    flat = np.stack([m.weights for m in models])
    width = arch.window * arch.features

    @F.arrow_udf("array<double>")
    def score(column: pa.Array) -> pa.Array:
        out = np.full((len(column), len(flat)), np.nan)
        present = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
        if present.size:
            values = _matrix(column.drop_null(), width)
            net = Autoencoder(arch, flat)
            for at in range(0, len(values), _SCORE_CHUNK):
                chunk = values[at : at + _SCORE_CHUNK]
                rows = chunk.reshape(-1, arch.window, arch.features)
                out[present[at : at + len(chunk)]] = net.errors(rows).T
        offsets = pa.array(np.arange(0, out.size + 1, len(flat)), pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(out.ravel(), from_pandas=True))

    return score(seq)


def with_autoencoder_scores(
    df: DataFrame, models: Mapping[str, TrainedAutoencoder], seq: str = "seq"
) -> DataFrame:
    """Add ``<scenario>_score`` for every model in one pass over the windows."""
    if not models:
        return df
    scored = df.withColumn("_errors", reconstruction_scores(list(models.values()), F.col(seq)))
    return scored.withColumns(
        {score_column(name): F.get("_errors", F.lit(i)) for i, name in enumerate(models)}
    ).drop("_errors")


def mean_squared_error(actual: Column, guess: Column) -> Column:
    """Mean squared difference of two equally long arrays, as a column expression."""
    squares = F.zip_with(actual, guess, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v) / F.size(actual)


def models_to_df(spark: SparkSession, models: Mapping[str, TrainedAutoencoder]) -> DataFrame:
    rows = [
        (
            m.scenario,
            m.arch.window,
            m.arch.features,
            m.arch.cell,
            m.arch.activation,
            m.arch.dropout,
            list(m.losses),
            m.weights.astype(float).tolist(),
        )
        for m in models.values()
    ]
    return spark.createDataFrame(rows, _MODEL_SCHEMA)


def save_models(spark: SparkSession, models: Mapping[str, TrainedAutoencoder], path: str) -> None:
    models_to_df(spark, models).write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> dict[str, TrainedAutoencoder]:
    """One row per scenario."""
    stored = spark.read.schema(_MODEL_SCHEMA).parquet(path).orderBy("scenario").collect()
    return {
        r["scenario"]: TrainedAutoencoder(
            r["scenario"],
            Architecture(r["window"], r["features"], r["cell"], r["activation"], r["dropout"]),
            np.array(r["weights"], dtype=np.float32),
            tuple(r["losses"]),
        )
        for r in stored
    }
