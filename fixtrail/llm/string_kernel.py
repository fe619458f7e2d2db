"""Language identification with a blended-spectrum string kernel.

Two texts are compared by the n-grams of 1 to 3 characters that both contain: the kernel is the size
of the intersection over the root of the product of the set sizes. A set of landmark texts gives the
Nystroem features of a text, and one-versus-rest kernel ridge regression on these features
gives a value for each language. A batch of texts is scored with two matrix products: presence of
the landmarks' n-grams times the landmarks, and the result times the regression.

Landmarks and regression are fitted on a hash sample of at most ``PER_LANGUAGE`` training documents of
each language, about, and ``SAMPLE_ROWS`` in all: with many languages each has fewer, one at least
(``LANDMARKS`` landmarks, or one a language). Of a long training text a piece is taken from anywhere. Texts to label are read whole, in pieces of ``PIECE`` characters whose n-gram sets are merged.

A text that is null, empty or without any letter is ``und`` with score 0. Without a training document
everything is ``und``. Repeated rows and ties get the same answer (ties: the language that
comes first by name). Only doc_id and text are read in labelling.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixtrail.operators.staging import stage

LONGEST = 3
LANDMARKS = 96
PER_LANGUAGE = 300
SAMPLE_ROWS = 20_000
RIDGE = 1e-2
UNDETERMINED = "und"
#: Characters of a training text that may become a landmark or a regression row.
FIT_CHARS = 4000
PIECE = 1 << 16
_BITS = 21  # a code point


def grams(text: str) -> np.ndarray:
    """Sorted distinct n-grams of 1 to 3 characters as exact 64-bit codes; letters count in lower case."""
    found = []
    text = text.lower()
    for start in range(0, len(text), PIECE):
        piece = text[start : start + PIECE + LONGEST - 1]
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
        two = (codes[:-1] << _BITS) | codes[1:]
        three = (two[:-1] << _BITS) | codes[2:]
        found += [np.unique(codes), np.unique(two), np.unique(three)]
    if len(found) == 3:
        return np.concatenate(found)  # longer n-grams have larger codes
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


@dataclass(frozen=True)
class KernelModel:
    """``rows``: presence of ``codes`` (sorted n-grams of all landmarks) in each landmark, scaled by its set size."""

    languages: list[str]
    codes: np.ndarray
    rows: np.ndarray  # codes x landmarks, float32
    weights: np.ndarray  # landmarks x languages: whitening and regression in one
    bias: np.ndarray

    def kernel(self, texts: list[str]) -> np.ndarray:
        """Kernel of each text with each landmark."""
        present = np.zeros((len(texts), len(self.codes)), np.float32)
        sizes = np.ones(len(texts))
        for k, text in enumerate(texts):
            own = grams(text)
            sizes[k] = max(len(own), 1)
            at = np.searchsorted(self.codes, own)
            at[at == len(self.codes)] = 0
            present[k, at[self.codes[at] == own]] = 1.0
        return (present @ self.rows) / np.sqrt(sizes)[:, None]

    def values(self, texts: list[str]) -> np.ndarray:
        return self.kernel(texts) @ self.weights + self.bias

    def label(self, texts: list[str | None], block: int = 64) -> tuple[list[str], list[float]]:
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        live = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        for start in range(0, len(live), block):
            chosen = live[start : start + block]
            values = self.values([texts[k] for k in chosen])
            best = values.argmax(1)
            for k, b, v in zip(chosen, best, values, strict=True):
                names[k] = self.languages[b]
                # a regression on 0 and 1 already estimates a probability
                scores[k] = float(np.clip(v[b], 0.0, 1.0))
        return names, scores


def fit_kernel(sample: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> KernelModel:
    """``sample``: (language, text); the landmarks are its first rows of every language in turn."""
    languages = sorted({x for x, _ in sample})
    if not languages:
        return KernelModel([], np.empty(0, np.int64), np.empty((0, 0), np.float32), np.empty((0, 0)), np.empty(0))
    by_language = {x: [t for y, t in sample if y == x] for x in languages}
    longest = max(map(len, by_language.values()))
    turns = [by_language[x][k] for k in range(longest) for x in languages if k < len(by_language[x])]
    chosen = turns[: max(landmarks, len(languages))]
    sets = [grams(t) for t in chosen]
    codes = np.unique(np.concatenate(sets)) if any(map(len, sets)) else np.zeros(1, np.int64)
    rows = np.zeros((len(codes), len(chosen)), np.float32)
    for k, own in enumerate(sets):
        rows[np.searchsorted(codes, own), k] = 1 / np.sqrt(max(len(own), 1))
    model = KernelModel(languages, codes, rows, np.zeros((len(chosen), len(languages))), np.zeros(len(languages)))
    texts = [t for _, t in sample]
    against = np.concatenate([model.kernel(texts[k : k + 64]) for k in range(0, len(texts), 64)]).astype(float)
    own = model.kernel(chosen).astype(float)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    kept = values > 1e-8 * values.max()
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    z = against @ whiten
    y = np.array([[float(x == lang) for lang in languages] for x, _ in sample])
    weight = 1 / np.array([len(by_language[x]) for x, _ in sample])  # every language counts the same
    weight /= weight.sum()
    mean_z, mean_y = weight @ z, weight @ y
    centred = z - mean_z
    gram = centred.T @ (centred * weight[:, None]) + ridge * np.eye(z.shape[1]) / 10
    solved = np.linalg.solve(gram, centred.T @ ((y - mean_y) * weight[:, None]))
    return KernelModel(languages, codes, rows, whiten @ solved, mean_y - mean_z @ solved)


def held_out(modulus: int, rest: int = 2) -> Column:
    """Whether crc32 of doc_id as text leaves ``rest``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == rest


def _piece(chars: int) -> Column:
    """``chars`` characters of a text from a place drawn by hash, or from its first letter if there is none in them."""
    length = F.length("text")
    drawn = F.substring("text", F.pmod(F.xxhash64("text"), F.greatest(length - chars + 1, F.lit(1))).cast("int") + 1, F.lit(chars))
    return F.when(drawn.rlike(r"\p{L}"), drawn).otherwise(F.substring("text", F.regexp_instr("text", F.lit(r"\p{L}")), F.lit(chars)))


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE, rows: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """(lang, piece of text) of a hash sample of every language: ``per_language`` rows, fewer where that makes more than ``rows``."""
    known = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(4))
    # a small table as a rule, which Spark then broadcasts by its size
    place = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(0))), F.lit(1_000_000)) / 1_000_000
    counts = stage(known.groupBy("lang").agg(F.count("*").alias("_rows"), F.min(place).alias("_least")), "languages")
    share = max(1, min(per_language, rows // max(counts.count(), 1)))
    # of a rare language at least the row of least place
    chosen = known.join(counts, "lang").where((place < share / F.col("_rows")) | (place == F.col("_least")))
    found = sorted({(r["lang"], r["text"]) for r in chosen.select("lang", _piece(FIT_CHARS).alias("text")).collect()})
    found = [(lang, text) for lang, text in found if any(map(str.isalpha, text))]
    order = np.random.default_rng(7).permutation(len(found))
    return [found[k] for k in order]


def label_languages(docs: DataFrame, model: KernelModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    fitted = fit_kernel(training_sample(docs)) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(fitted)  # landmarks x their n-grams: some 30 MB at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = shared.value.label(batch["text"].to_pylist())
            columns = [batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch(columns, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(4).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
