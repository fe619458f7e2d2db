"""Toxicity of texts: gradient-boosted trees over dense features, with isotonic calibration.

A text is cut at white space; every word is looked up once and its traits (letters, capitals, marks,
obfuscation, pronoun, entries of the lexicons) are added up with NumPy. The features of a text are
densities of the lexicons, how near their words stand to a second person, shares of capitals, marks and
disguised words, and the length. Whole texts are read, one batch at a time.

There are two lexicons. The fixed one holds common insults. The learned one is taken from the labels: words, and
beginnings of words of 4 to 6 letters, whose presence goes with the label more than chance allows (likelihood ratio
against the number of entries tried). Texts that are equal count once there.

Lexicon, trees and calibration are fitted on a hash sample of about ``SAMPLE`` labelled texts of each class at
most, weighted back to the shares of the classes. The sample is cut into folds: the lexicon seen by the trees for a fold comes
from the other folds, and the calibration is a weighted isotonic regression on scores of trees
that haven't seen the fold. Only counts of words, the best entries of the lexicon and the numbers of the
sampled texts reach the driver.

Null and empty texts have no words and get the score of such a text. Ids and labels that are null are not learned from; of
several labels of a document the largest counts, and documents of equal id are all learned from. Repeated rows get equal scores.
Without a toxic (or without a clean) labelled text the score is the share of toxic ones (0 without labels). Columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixtrail.operators.staging import stage

#: Labelled texts of each class that are learned from, at most (but for the spread of a hash sample).
SAMPLE = 6000
FOLDS = 4
#: Entries of the learned lexicon, at most.
LEXICON = 400
TREES = 60
DEPTH = 3
BINS = 32
THRESHOLD = 0.3
_MOST_KNOWN = 300_000
_MOST_COUNTED = 200_000
_STEMS = (4, 5, 6)
_NEAR = 4

# Common insults, curses and threats; the second person in some languages.
_INSULTS = frozenset(
    "arsehole asshole bastard bitch clown coward creep cretin degenerate dimwit dumb dumbass dumb fool freak garbage idiot idiots "
    "idiotic imbecile jerk loser losers lowlife lunatic maggot moron morons moronic pathetic parasite pig rat retard retarded scum "
    "scumbag simpleton slut stupid subhuman trash twat ugly useless vermin whore wimp worm worthless abschaum arschloch "
    "dreck dummkopf idiotin miststück schlampe schwein versager wertlos basura cabrón estúpido estúpida gilipollas idiota "
    "imbécil inútil mierda perdedor puta abruti connard connasse crétin débile imbécile ordure pute salaud salope".split()
)
_CURSES = frozenset(
    "bloody bullshit crap damn damned fuck fucked fucker fucking hell piss shit shitty disgusting disgust hate hated hateful "
    "despise loathe sickening vile kotzt scheiße scheisse verdammt hasse joder coño odio asco merde putain déteste dégoûtant".split()
)
_THREATS = frozenset(
    "beat burn choke destroy die dies hang hurt kill killed kys murder rape shoot stab strangle suffer töten sterben "
    "umbringen matar morir mata tuer mourir crève".split()
)
_YOU = frozenset(
    "you your yours yourself u ur youre you're du dich dir dein deine ihr euch euer sie ihnen tu te toi ton ta tes vous "
    "votre vos tú ti tuyo usted ustedes vosotros os".split()
)
_DISGUISE = str.maketrans("013457@$!|€", "oieastasiie")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INSIDE = re.compile(r"[^\W\d_][*@$#!|\d]+[^\W\d_]|^[@$|\d][^\W\d_]{2}")
_LONG_RUN = re.compile(r"([^\W\d_])\1\1")

TRAITS = (
    "letters", "capitals", "shouted", "exclaims", "asks", "marks", "digits", "disguised", "stretched", "single",
    "you", "insult", "curse", "threat", "learned", "strong", "weight",
)
_AT = {name: k for k, name in enumerate(TRAITS)}
_BAD = [_AT[name] for name in ("insult", "curse", "threat", "strong")]
FEATURES = (
    "insult_rate", "curse_rate", "threat_rate", "learned_rate", "strong_rate", "weight_rate", "insults", "curses", "threats",
    "learned", "strong", "weight", "kinds", "near_you", "near_you_rate", "closest_you", "you_rate", "capital_share", "shouted_share",
    "exclaim_rate", "ask_rate", "mark_share", "digit_share", "disguised_share", "stretched_share", "single_share", "longest_spelled", "words",
)


def plain(word: str) -> str:
    """A word in lower case without marks at its ends, and with letters in place of the usual disguises inside."""
    found = _EDGES.sub("", word.lower())
    if _INSIDE.search(found):
        found = found.translate(_DISGUISE).replace("*", "")
    return found


def entries(word: str) -> list[str]:
    """What of a plain word may stand in the learned lexicon: the word and its beginnings (marked by a hyphen)."""
    return [word, *(f"{word[:n]}-" for n in _STEMS if len(word) > n)] if len(word) > 2 else []


class Words:
    """Traits of words, remembered in a bounded table."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self._lexicon = lexicon
        self._known: dict[str, int] = {}
        self._buffer = np.empty((4096, len(TRAITS)), np.float32)

    def _traits(self, word: str) -> tuple[float, ...]:
        start = word[:-1] if word[-1] in ".," else word
        if len(start) > 2 and start.isalpha() and start.islower() and not _LONG_RUN.search(start):  # most words
            weight = max((self._lexicon.get(e, 0.0) for e in entries(start)), default=0.0)
            marks = len(word) - len(start)
            known = (start in _YOU, start in _INSULTS, start in _CURSES, start in _THREATS)
            return (len(start), 0, False, 0, 0, marks, 0, False, False, False, *known, weight > 0, weight > 3, weight)
        base = plain(word)
        letters = sum(map(str.isalpha, word))
        capitals = sum(map(str.isupper, word))
        marks = sum(not (c.isalnum() or c.isspace()) for c in word)
        weight = max((self._lexicon.get(e, 0.0) for e in entries(base)), default=0.0)
        return (
            letters, capitals, capitals == letters > 2, word.count("!"), word.count("?"), marks, sum(map(str.isdigit, word)),
            bool(_INSIDE.search(word)), bool(_LONG_RUN.search(word)), letters == len(base) == 1,
            base in _YOU, base in _INSULTS, base in _CURSES, base in _THREATS, weight > 0, weight > 3, weight,
        )

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word in the table, and the table."""
        known = self._known
        if len(known) > _MOST_KNOWN:
            known.clear()
        start = len(known)
        fresh = list(set(words).difference(known))
        while start + len(fresh) > len(self._buffer):
            self._buffer = np.concatenate([self._buffer, np.empty_like(self._buffer)])
        if fresh:
            self._buffer[start : start + len(fresh)] = [self._traits(w) for w in fresh]
            known.update(zip(fresh, range(start, start + len(fresh)), strict=True))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words)), self._buffer


def features(text: str | None, words: Words) -> np.ndarray:
    split = (text or "").split()
    n = len(split)
    if not n:
        return np.zeros(len(FEATURES))
    at, table = words(split)
    kinds, used = np.unique(at, return_counts=True)
    total = used.astype(float) @ table[kinds]
    t = dict(zip(TRAITS, total.tolist(), strict=True))
    bad_kinds = kinds[table[kinds][:, _BAD].any(1)]
    near = closest = 0.0
    if len(bad_kinds) and t["you"]:
        you, bad = np.flatnonzero(table[at, _AT["you"]]), np.flatnonzero(np.isin(at, bad_kinds))
        right = np.searchsorted(you, bad)
        gap = np.minimum(np.abs(bad - you[np.minimum(right, len(you) - 1)]), np.abs(bad - you[np.maximum(right - 1, 0)]))
        near, closest = float((gap <= _NEAR).sum()), 1.0 / (1.0 + float(gap.min()))
    spelled = 0
    if t["single"] > 2:  # letters set apart from each other
        single = np.concatenate([[0], table[at, _AT["single"]], [0]])
        edges = np.flatnonzero(np.diff(single))
        spelled = int((edges[1::2] - edges[::2]).max())
    chars = max(t["letters"] + t["marks"] + t["digits"], 1.0)
    letters = max(t["letters"], 1.0)
    return np.array([
        t["insult"] / n, t["curse"] / n, t["threat"] / n, t["learned"] / n, t["strong"] / n, t["weight"] / n,
        t["insult"], t["curse"], t["threat"], t["learned"], t["strong"], t["weight"], len(bad_kinds), near, near / n, closest, t["you"] / n,
        t["capitals"] / letters, t["shouted"] / n, t["exclaims"] / n, t["asks"] / n, t["marks"] / chars, t["digits"] / chars,
        t["disguised"] / n, t["stretched"] / n, t["single"] / n, spelled, math.log1p(n),
    ])


def lexicon_of(words: list[str], toxic: np.ndarray, clean: np.ndarray, texts: tuple[int, int], tried: int) -> dict[str, float]:
    """Entries that go with toxic texts beyond chance, and their weights (log odds).

    ``toxic`` and ``clean`` count the texts with an entry, ``texts`` those in all, and ``tried`` the entries in all.
    """
    all_toxic, all_clean = texts
    if not all_toxic or not all_clean or not words:
        return {}
    share = all_toxic / (all_toxic + all_clean)

    def part(found: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(found > 0, found * np.log(np.maximum(found, 0.5) / expected), 0.0)

    with_entry, without = np.maximum(toxic + clean, 1e-9), np.maximum(all_toxic + all_clean - toxic - clean, 1e-9)
    ratio = part(toxic, with_entry * share) + part(clean, with_entry * (1 - share))
    ratio += part(all_toxic - toxic, without * share) + part(all_clean - clean, without * (1 - share))
    weight = np.log((toxic + 0.5) / (all_toxic + 1)) - np.log((clean + 0.5) / (all_clean + 1))
    good = np.flatnonzero((2 * ratio > 2 * math.log(tried + 1) + 4) & (weight > 1.0) & (toxic > 2))
    best = sorted(good.tolist(), key=lambda k: (-ratio[k], words[k]))[:LEXICON]
    return {words[k]: float(weight[k]) for k in best}


@dataclass(frozen=True)
class Trees:
    """Full binary trees of one depth: a feature and a bound per inner node, a value per leaf."""

    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray
    base: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
            out += leaf[at - len(feature)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, rate: float = 0.15, ridge: float = 2.0) -> Trees:
    """Weighted logistic boosting, one level of a tree at a time, on bins between quantiles; deterministic."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    edges = [np.unique(np.concatenate([e, [0.0]])) if (c > 0).any() else e for e, c in zip(edges, x.T, strict=True)]
    width = max(map(len, edges)) + 1
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], 1)
    mean = float(np.clip(weight @ y / weight.sum(), 1e-4, 1 - 1e-4))
    score = np.full(len(x), math.log(mean / (1 - mean)))
    base, inner = score[0] if len(score) else 0.0, 2**DEPTH - 1
    features_, bounds, leaves = [], [], []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-score))
        slope, bend = weight * (y - chance), weight * chance * (1 - chance)
        at = np.zeros(len(x), np.int64)
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, nodes = 2**level - 1, 2**level
            best = np.full(nodes, 1e-7)
            cut = np.full(nodes, width)
            for k, e in enumerate(edges):
                if not len(e):
                    continue
                cell = (at - first) * width + binned[:, k]
                g = np.bincount(cell, slope, nodes * width).reshape(nodes, width)
                h = np.bincount(cell, bend, nodes * width).reshape(nodes, width)
                left_g, left_h = g.cumsum(1)[:, : len(e)], h.cumsum(1)[:, : len(e)]
                all_g, all_h = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
                j = gain.argmax(1)
                gained = gain[np.arange(nodes), j]
                for node in np.flatnonzero(gained > best):
                    best[node], cut[node] = gained[node], j[node]
                    feature[first + node], bound[first + node] = k, e[j[node]]
            right = binned[np.arange(len(x)), feature[at]] > cut[at - first]
            at = 2 * at + 1 + right
        place = at - inner
        leaf = rate * np.bincount(place, slope, inner + 1) / (np.bincount(place, bend, inner + 1) + ridge)
        score = score + leaf[place]
        features_.append(feature)
        bounds.append(bound)
        leaves.append(leaf)
    return Trees(np.array(features_), np.array(bounds), np.array(leaves), float(base))


def isotonic(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted isotonic regression by pooling of neighbours: scores and the shares between which to interpolate."""
    levels, at = np.unique(score, return_inverse=True)
    mass = np.bincount(at, weight, len(levels))
    mean = np.bincount(at, weight * y, len(levels)) / mass
    blocks: list[list[float]] = []  # share, weight, lowest and highest score
    for s, v, w in zip(levels.tolist(), mean.tolist(), mass.tolist(), strict=True):
        blocks.append([v, w, s, s])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v1, w1, _, high = blocks.pop()
            v0, w0, low, _ = blocks.pop()
            blocks.append([(v0 * w0 + v1 * w1) / (w0 + w1), w0 + w1, low, high])
    ends = [(s, v) for v, _, low, high in blocks for s in ([low, high] if high > low else [low])]
    return np.array([s for s, _ in ends]), np.array([v for _, v in ends])


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, float]
    trees: Trees | None
    scores: np.ndarray
    shares: np.ndarray

    def chance(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.shares[0])
        return np.clip(np.interp(self.trees(x), self.scores, self.shares), 0.0, 1.0)


def held_out(modulus: int, rest: int = 2) -> Column:
    """Whether crc32 of doc_id as text leaves ``rest``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == rest


def _labelled(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[DataFrame, dict[int, float], dict[int, int]]:
    """toxic, fold and text of the sampled labelled texts; weight and number of labels of each class."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(4))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    rate = {c: min(1.0, sample / max(counts.get(c, 0), 1)) for c in (0, 1)}
    place = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1_000_000)) / 1_000_000
    chosen = known.where(place < F.when(F.col("toxic") == 1, rate[1]).otherwise(rate[0]))
    # some 2 * sample rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(chosen), "doc_id")
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")  # equal texts share a fold
    return joined.select("toxic", fold.alias("fold"), "text"), {c: 1 / r for c, r in rate.items()}, counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each fold and class every entry occurs, summed while a task's table lasts."""
    counts: Counter[tuple[str, int, int]] = Counter()

    def flushed() -> pa.RecordBatch:
        names, folds, classes = zip(*counts, strict=True) if counts else ((), (), ())
        columns = [pa.array(names, pa.string()), pa.array(folds, pa.int32()), pa.array(classes, pa.int32()), pa.array(counts.values(), pa.int64())]
        out = pa.record_batch(columns, ["entry", "fold", "toxic", "n"])
        counts.clear()
        return out

    for batch in batches:
        for toxic, fold, text in zip(batch["toxic"].to_pylist(), batch["fold"].to_pylist(), batch["text"].to_pylist(), strict=True):
            found = {e for w in {plain(w) for w in set(text.split())} for e in entries(w)}
            counts.update((e, fold, toxic) for e in found | {""})
            if len(counts) > _MOST_COUNTED:
                yield flushed()
    yield flushed()


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    rows, weights, counts = _labelled(docs, labels, sample)
    overall = counts.get(1, 0) / max(sum(counts.values()), 1)
    single = ToxicityModel({}, None, np.zeros(1), np.array([overall]))
    if not counts.get(0) or not counts.get(1):
        return single
    rows = stage(rows, "labelled_texts")
    distinct = rows.groupBy("text", "toxic").agg(F.first("fold").alias("fold"))
    wide = distinct.mapInArrow(_counted, "entry string, fold int, toxic int, n long").groupBy("entry")
    sums = [F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == t), F.col("n")).otherwise(0)).alias(f"n{t}_{f}") for t in (1, 0) for f in range(FOLDS)]
    table = stage(wide.agg(*sums), "entry_counts")
    tried = table.count()
    toxic, clean = (sum((F.col(f"n{t}_{f}") for f in range(FOLDS)), F.lit(0)) for t in (1, 0))
    texts = table.where(F.col("entry") == "").select(toxic.alias("t"), clean.alias("c"), "*").collect()
    if not texts:
        return single
    # a bounded number of entries: those that may pass the test, by how much they have against chance
    lift = toxic / (toxic + clean) * ((texts[0]["t"] + texts[0]["c"]) / max(texts[0]["t"], 1))
    likely = table.where((F.col("entry") != "") & (toxic > 2) & (lift > 1.5))
    found = likely.orderBy(F.desc(toxic * F.log(lift)), "entry").limit(20 * LEXICON).collect()
    words = [r["entry"] for r in found]
    n = {t: np.array([[r[f"n{t}_{f}"] for r in found] for f in range(FOLDS)], float).reshape(FOLDS, -1) for t in (0, 1)}
    of = {t: np.array([texts[0][f"n{t}_{f}"] for f in range(FOLDS)]) for t in (0, 1)}

    def learned(folds: list[int]) -> dict[str, float]:
        return lexicon_of(words, n[1][folds].sum(0), n[0][folds].sum(0), (of[1][folds].sum(), of[0][folds].sum()), tried)

    lexicons = [learned([g for g in range(FOLDS) if g != f]) for f in range(FOLDS)]
    lexicon = learned(list(range(FOLDS)))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Words(x) for x in lexicons]
        for batch in batches:
            folds = batch["fold"].to_pylist()
            x = [features(text, tables[f]) for text, f in zip(batch["text"].to_pylist(), folds, strict=True)]
            yield pa.record_batch([batch["toxic"], batch["fold"], pa.array(x, pa.list_(pa.float64()))], ["toxic", "fold", "x"])

    # some 2 * sample rows of numbers
    got = rows.mapInArrow(measured, "toxic int, fold int, x array<double>").toPandas()
    x = np.stack(got["x"].to_numpy()).astype(float)
    order = np.lexsort((*x.T, got["toxic"].to_numpy()))
    x, y, fold = x[order], got["toxic"].to_numpy(float)[order], got["fold"].to_numpy()[order]
    weight = np.where(y > 0, weights[1], weights[0])
    weight = weight / weight.mean()
    outside = np.zeros(len(x))
    for f in range(FOLDS):
        mine = fold == f
        if mine.any():
            outside[mine] = boost(x[~mine], y[~mine], weight[~mine])(x[mine])
    scores, shares = isotonic(outside, y, weight)
    return ToxicityModel(lexicon, boost(x, y, weight), scores, shares)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, model: ToxicityModel | None = None) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    fitted = fit_toxicity(docs, labels) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(fitted)  # a lexicon and some trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value.lexicon)
        for batch in batches:
            x = np.array([features(t.as_py(), words) for t in batch["text"]]).reshape(-1, len(FEATURES))
            columns = [batch["doc_id"], batch["held_out"], pa.array(shared.value.chance(x), pa.float64())]
            yield pa.record_batch(columns, ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(4).alias("held_out"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
