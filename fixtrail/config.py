"""Column names, feature lists and run settings.

Everything here lives on the driver and only shapes plans; no row data passes through.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from types import MappingProxyType

# Canonical column names (fixed values).
ENTITY = "placa"
TIME = "timestamp"
LAT = "latitude"
LON = "longitude"
REGION = "regiao_adm"
ROW_ID = "row_id"

ONE_HOT_PREFIX = "RA"

# Feature lists per detector (fixed values, in scoring order).
ISOLATION_BASE = (
    "hora_sin",
    "hora_cos",
    "dia_sem",
    "eh_feriado",
    "velocidade_kmh",
    "aceleracao",
    "dist_m",
)
HISTOGRAM_BASE = (
    "velocidade_kmh",
    "aceleracao",
    "dist_m",
    "hora",
    "dia_sem",
    "eh_feriado",
)
SEQUENCE_BASE = (
    "velocidade_kmh",
    "aceleracao",
    "dist_m",
    "latitude",
    "longitude",
    "hora_sin",
    "hora_cos",
)


MODEL_FEATURES: Mapping[str, tuple[str, ...]] = MappingProxyType(
    {
        "isolation_forest": ISOLATION_BASE,
        "hbos": HISTOGRAM_BASE,
        **dict.fromkeys(("gru", "lstm", "autoencoder"), SEQUENCE_BASE),
    }
)
#: Models that also take the 0/1 columns of the regions.
MODELS_WITH_REGIONS = frozenset({"isolation_forest"})


def features_for_model(model: str, columns: Sequence[str]) -> list[str]:
    """Ordered features of ``model`` that exist among ``columns``."""
    if model not in MODEL_FEATURES:
        raise ValueError(f"unknown model {model!r}; expected one of {sorted(MODEL_FEATURES)}")
    present = set(columns)
    found = [f for f in MODEL_FEATURES[model] if f in present]
    if model in MODELS_WITH_REGIONS:
        found += [c for c in columns if c.startswith(f"{ONE_HOT_PREFIX}_")]
    return found


def label_column(model: str, percentile: float) -> str:
    return f"{model}_p{percentile}_label"


def score_column(model: str) -> str:
    return f"{model}_score"


def check_percentiles(percentiles: Sequence[float]) -> list[float]:
    """Sorted percentiles; values outside 0..100 are rejected up front."""
    bad = [p for p in percentiles if not 0 <= p <= 100]
    if bad:
        raise ValueError(f"percentiles must lie in 0..100, got {bad}")
    return sorted(percentiles)


@dataclass(frozen=True)
class ExperimentConfig:
    """Settings of one end-to-end run; defaults are the shipped configuration."""

    # source name -> canonical name (fixed values); names absent from the input are ignored
    column_map: Mapping[str, str] = field(
        default_factory=lambda: {
            "placa": ENTITY,
            "timestamp": TIME,
            "latitude": LAT,
            "longitude": LON,
            "RA": REGION,
        }
    )
    # patterns of times that are not ISO text, in the order to try them
    time_patterns: tuple[str, ...] = ()
    percentiles: tuple[float, ...] = (90, 95, 99)
    train_ratio: float = 0.7
    isolation_trees: tuple[int, ...] = (100, 200)
    histogram_bins: tuple[int, ...] = (10, 20)
    window_size: int = 3
    max_gap_seconds: float = 1800
    arch: str = "gru"
    epochs: int = 5
    batch_size: int = 64
    seed: int = 42
    # scale settings
    max_rows_per_entity_task: int = 2_000_000
    max_one_hot_categories: int = 1_000
    rows_per_training_shard: int = 4_096
