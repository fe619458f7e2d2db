"""Training scenarios: which rows count as normal according to which detectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixtrail.config import label_column

INLIER_PERCENTILE = 95


def inlier(model: str, percentile: float = INLIER_PERCENTILE) -> Column:
    return F.col(label_column(model, percentile)) == 0


@dataclass(frozen=True)
class Scenario:
    """``detectors`` is empty for the control, which trains on all training rows."""

    name: str
    detectors: tuple[str, ...] = ()
    both: bool = True

    def mask(self, train: Column) -> Column:
        """Rows the scenario trains on: inliers of both (or of either) detector."""
        if not self.detectors:
            return train
        first, second = (inlier(d) for d in self.detectors)
        return ((first & second) if self.both else (first | second)) & train


CONTROL = Scenario("LSTM_Sujo")


def scenario_grid(isolation: Sequence[str], histogram: Sequence[str]) -> list[Scenario]:
    """Two scenarios per detector pair and the control, in evaluation order."""
    if not isolation:
        raise RuntimeError("no isolation forest was trained")
    if not histogram:
        raise RuntimeError("no histogram model was trained")
    grid = [
        Scenario(f"LSTM_{kind}_{i}_{h}", (i, h), both)
        for i in isolation
        for h in histogram
        for kind, both in (("Uniao", True), ("Inter", False))
    ]
    return [*grid, CONTROL]


#: Scenarios in one word of a bit set; the sign bit stays free.
_WORD = 62


def membership_bits(masks: Sequence[Column]) -> Column:
    """A bit set (array of long) of the masks that hold for a row; any number of masks fits."""

    def word(part: Sequence[Column]) -> Column:
        bits = F.lit(0).cast("long")
        for i, mask in enumerate(part):
            bits = bits + F.when(mask, F.lit(1 << i)).otherwise(0).cast("long")
        return bits

    return F.array(*[word(masks[k : k + _WORD]) for k in range(0, len(masks), _WORD)]).cast("array<long>")


def has_member(bits: Column, number: int) -> Column:
    return F.get(bits, F.lit(number // _WORD)).bitwiseAND(F.lit(1 << number % _WORD)) != 0


def any_member(bits: Column) -> Column:
    return F.exists(bits, lambda word: word != 0)


def member_rows(words: np.ndarray, numbers: Sequence[int]) -> np.ndarray:
    """The masks of some scenarios (scenarios x rows) out of bit sets (rows x words)."""
    return np.stack([(words[:, n // _WORD] >> (n % _WORD)) & 1 == 1 for n in numbers])


def write_back(df: DataFrame, scores: DataFrame, row_id: str) -> DataFrame:
    """Attach scores kept in another table by row id; rows without a score stay NULL."""
    return df.join(scores, row_id, "left")


def at_window_end(windows: DataFrame, masks: DataFrame, row_id: str) -> DataFrame:
    """Mask values of the rows on which windows end, for masks kept in another table."""
    return windows.join(masks, row_id, "inner")
