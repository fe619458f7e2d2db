"""Quality rules: counts of the whole text, and a linear-chain CRF over its lines.

Base rules are exact counts. Beyond them, every line with a word is labelled content or boilerplate:
a conditional random field with two states scores each line by its features and each step by
a transition, and Viterbi decoding finds the best sequence. The share of words in content lines
decides whether the document stays.

The field is fitted here, by maximum likelihood from a documented start, on at most ``PER_CLASS`` expected
labelled documents of either quality (chosen by a hash of doc_id, so reruns agree). A line inherits its
document's label. Without labels of both kinds the start weights are used as they are.

Null texts have no words and fail the base rules, as do empty ones. Repeated rows are judged
alike; extra columns stay out of the way, and ``keep_good`` returns all columns unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtrail.llm.words import words_of

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
#: Expected number of labelled documents of each quality that the field is fitted on.
PER_CLASS = 500
#: Lines of a labelled document used in fitting.
FIT_LINES = 120
MIN_CONTENT = 0.5
FEATURES = (
    "bias", "symbols", "upper_words", "bars", "exclamations", "earlier_line", "same_words",
    "digits", "few_words", "no_letters", "link", "sentence_end",
)
# Start: a line is content unless something speaks against it.
_START = np.array([2.0, -12.0, -5.0, -6.0, -6.0, -1.5, -6.0, -2.0, -0.3, -3.0, -1.0, 0.5])
_STAY = 1.0


@dataclass(frozen=True)
class LineField:
    """Weights of content against boilerplate, and the score of staying in a state."""

    weights: np.ndarray
    stay: float

    def decode(self, features: np.ndarray) -> np.ndarray:
        """True for content, for each line; Viterbi, ties to content."""
        gain = (features @ self.weights).tolist()
        if not gain:
            return np.empty(0, bool)
        stay = self.stay
        content, other = gain[0], 0.0
        back: list[tuple[bool, bool]] = []
        for g in gain[1:]:
            a, b = content + stay, other
            c, d = other + stay, content
            back.append((a >= b, d >= c))
            content, other = max(a, b) + g, max(c, d)
        state = content >= other
        labels = [state]
        for from_content, other_from_content in reversed(back):
            state = from_content if state else other_from_content
            labels.append(state)
        return np.array(labels[::-1], bool)


def line_features(lines: list[str], earlier: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and word counts of the lines."""
    rows, sizes = [], []
    for line, seen in zip(lines, earlier, strict=True):
        words = line.split()
        n = max(len(words), 1)
        letters = max(len(line) - line.count(" "), 1)
        symbols = sum(map(line.count, "#*$%&<>"))
        upper = sum(map(str.isupper, words))
        rows.append((
            1.0, min(1.0, symbols / letters), upper / n, min(1.0, 2 * line.count("|") / n), min(1.0, line.count("!") / n),
            float(seen), 1 - len(set(words)) / n, sum(map(str.isdigit, words)) / n, float(n < 3),
            float(line.lower() == line.upper()), float("://" in line or "www." in line), float(line.rstrip()[-1:] in ".?!:…"),
        ))
        sizes.append(len(words))
    return np.array(rows).reshape(-1, len(FEATURES)), np.array(sizes, np.int64)


def worded_lines(text: str) -> tuple[list[str], list[bool]]:
    """The lines that hold a word, and whether each equals an earlier one."""
    seen: set[str] = set()
    lines, earlier = [], []
    for line in text.split("\n"):
        if line.strip(_SPACES):
            lines.append(line)
            earlier.append(line in seen)
            seen.add(line)
    return lines, earlier


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    pairs = ids[:-1] * len(known) + ids[1:]
    if len(known) > 2_000_000:  # a product of three would not fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(known) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = np.diff(windows[order]) == 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def judge(text: str | None, field: LineField, min_content: float = MIN_CONTENT) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept."""
    text = text or ""
    words = words_of(text, lower=False)
    chars = len(text) - sum(map(text.count, _SPACES))
    lines, earlier = worded_lines(text)
    repeats = repeat_words(words)
    failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    features, sizes = line_features(lines, earlier)
    content = field.decode(features)
    share = float(sizes[content].sum() / sizes.sum()) if sizes.sum() else 0.0
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), chars, symbols, sum(earlier), repeats, failed, share, not failed and share >= min_content


_JUDGED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, content_share double, kept boolean"
)


def judge_documents(docs: DataFrame, field: LineField, min_content: float = MIN_CONTENT) -> DataFrame:
    """doc_id and the counts, content share and verdict of every document."""
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    names = [x.split() for x in _JUDGED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(x.as_py(), field, min_content) for x in batch["text"]]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, names, strict=True)]
            yield pa.record_batch([batch["doc_id"], *arrays], ["doc_id", *[x for x, _ in names]])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, f"doc_id long, {_JUDGED}")


def keep_good(docs: DataFrame, field: LineField, min_content: float = MIN_CONTENT) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [judge(x.as_py(), field, min_content)[-1] for x in batch["text"]]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))


def _labelled_features(docs: DataFrame, labels: DataFrame, per_class: int) -> list[tuple[int, np.ndarray]]:
    """(quality, features of the first lines) of a hash sample of labelled documents."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_quality")
    )
    sizes = {r["_quality"]: r["count"] for r in known.groupBy("_quality").count().collect()}  # two rows
    if len(sizes) < 2:
        return []
    place = F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) / 1_000_000
    chosen = known.where(
        F.when(F.col("_quality") == 1, place < per_class / sizes[1]).otherwise(place < per_class / sizes[0])
    ).limit(4 * per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                lines, earlier = worded_lines(text.as_py() or "")
                out.append(line_features(lines[:FIT_LINES], earlier[:FIT_LINES])[0].ravel().tolist())
            yield pa.record_batch([batch["_quality"], pa.array(out, pa.list_(pa.float64()))], ["quality", "features"])

    # at most 4 * per_class ids are broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "_id").select("_quality", "text").limit(8 * per_class)
    rows = sample.mapInArrow(run, "quality int, features array<double>").collect()
    return sorted(
        [(r["quality"], np.array(r["features"]).reshape(-1, len(FEATURES))) for r in rows if r["features"]],
        key=lambda x: (x[0], len(x[1]), x[1].tobytes()),
    )


def _expectations(gain: np.ndarray, mask: np.ndarray, stay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chance of content per line, chance of staying per step, and steps that exist."""
    docs, length = gain.shape
    emit = np.stack([np.zeros_like(gain), gain], -1)
    step = np.array([[stay, 0.0], [0.0, stay]])
    forward = np.empty((docs, length, 2))
    backward = np.zeros((docs, length, 2))
    forward[:, 0] = emit[:, 0]
    for k in range(1, length):
        into = np.logaddexp.reduce(forward[:, k - 1, :, None] + step, axis=1) + emit[:, k]
        forward[:, k] = np.where(mask[:, k, None], into, forward[:, k - 1])
    for k in range(length - 2, -1, -1):
        out = np.logaddexp.reduce(step + (emit[:, k + 1] + backward[:, k + 1])[:, None, :], axis=2)
        backward[:, k] = np.where(mask[:, k + 1, None], out, 0.0)
    total = np.logaddexp.reduce(forward[:, -1], axis=1)
    content = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None]) * mask
    steps = mask[:, 1:]
    stays = sum(
        np.exp(forward[:, :-1, s] + stay + emit[:, 1:, s] + backward[:, 1:, s] - total[:, None]) for s in (0, 1)
    )
    return content, stays * steps, steps


def fit_field(sample: list[tuple[int, np.ndarray]], rounds: int = 80, ridge: float = 2e-3) -> LineField:
    """Regularised maximum likelihood from the start weights; each document weighs the same."""
    weights, stay = _START.copy(), _STAY
    if len({q for q, _ in sample}) < 2:
        return LineField(weights, stay)
    length = max(len(x) for _, x in sample)
    features = np.zeros((len(sample), length, len(FEATURES)))
    mask = np.zeros((len(sample), length), bool)
    truth = np.zeros((len(sample), length))
    share = np.mean([q for q, _ in sample])
    each = np.array([0.5 / len(x) / (share if q else 1 - share) for q, x in sample]) / len(sample)
    for k, (quality, x) in enumerate(sample):
        features[k, : len(x)], mask[k, : len(x)], truth[k, : len(x)] = x, True, quality
    first, second = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)
    for t in range(1, rounds + 1):
        content, stays, steps = _expectations(features @ weights, mask, stay)
        slope = np.einsum("d,dl,dlk->k", each, (truth - content) * mask, features) - ridge * (weights - _START)
        slope_stay = float((each[:, None] * (steps - stays)).sum()) - ridge * (stay - _STAY)
        both = np.append(slope, slope_stay)
        first, second = 0.9 * first + 0.1 * both, 0.99 * second + 0.01 * both**2
        move = 0.15 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
        weights, stay = weights + move[:-1], float(np.clip(stay + move[-1], 0.0, 4.0))
    return LineField(weights, stay)


def fit_line_field(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> LineField:
    return fit_field(_labelled_features(docs, labels, per_class))
