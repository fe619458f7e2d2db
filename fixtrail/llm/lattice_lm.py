"""Language-model scores from subword lattices.

None of the public vocabularies holds the scores of a unigram model. The ranks of a merge vocabulary stand in for them.

A word's probability is summed over all its segmentations into pieces of an existing vocabulary, by a
forward recursion in log space; a text is its words and one end token. The pieces start from the scores
of the vocabulary (merge ranks, read as a Zipf distribution) and are re-estimated on the words of the
training documents: expected piece counts, weighted by word counts, plus the start distribution as prior.

How it runs: documents are staged with the number of a block of adjoining rows, blocks of about equal size; every block counts its
own distinct words; the counts of all blocks are summed per word; each distinct word of the corpus is scored once, in
parallel; each block then gets back the scores of the words it asked for and scores its whole texts. So what is shuffled are distinct words
per block, never (document, word) pairs, and no key gathers more rows than there are blocks.

``base_score`` is the add-one unigram score of the same tokens. Null and empty texts are the end
token alone. Null ids count as held out or not by the empty text; repeated rows are scored alike; an
empty table, or one without training documents, is scored with the start distribution.
Characters outside the vocabulary are spelled in bytes. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtrail.llm.string_kernel import held_out
from fixtrail.llm.words import words_of
from fixtrail.operators.staging import stage

_SPACE = "▁"
#: Offset of the Zipf distribution over merge ranks, and the share of the byte pieces in it.
ZIPF_OFFSET = 10.0
BYTE_SHARE = 1e-3
#: Weight of the start distribution against the expected counts, in tokens.
PRIOR_TOKENS = 2000.0
_SPLIT_BYTES = 32 << 20
_ROWS = 20_000


@dataclass(frozen=True)
class Lattice:
    """Natural log probability of every piece; pieces of one byte are keyed by their number."""

    pieces: dict[str, float]
    bytes_: list[float]
    end: float
    longest: int

    def edges(self, text: str) -> list[list[tuple[int, object, float]]]:
        """For every end position the pieces that end there: (start, piece, log probability)."""
        out = []
        known, longest = self.pieces, self.longest
        for j in range(1, len(text) + 1):
            here = []
            for i in range(max(0, j - longest), j):
                lp = known.get(text[i:j])
                if lp is not None:
                    here.append((i, text[i:j], lp))
            if not here or here[-1][0] != j - 1:
                raw = text[j - 1].encode("utf-8", "surrogatepass")
                here.append((j - 1, raw, sum(self.bytes_[b] for b in raw)))
            out.append(here)
        return out

    def word(self, word: str) -> float:
        """Log of the summed probability of all segmentations."""
        text = _SPACE + word
        known, longest = self.pieces.get, self.longest
        forward = [0.0]
        for j in range(1, len(text) + 1):
            into = []
            single = False
            for i in range(max(0, j - longest), j):
                lp = known(text[i:j])
                if lp is not None:
                    into.append(forward[i] + lp)
                    single = i == j - 1
            if not single:
                into.append(forward[j - 1] + sum(self.bytes_[b] for b in text[j - 1].encode("utf-8", "surrogatepass")))
            top = max(into)
            forward.append(top if len(into) == 1 else top + math.log(sum([math.exp(x - top) for x in into])))
        return forward[-1]

    def expected(self, word: str) -> Iterator[tuple[object, float]]:
        """Expected number of times each piece is used in the word."""
        text = _SPACE + word
        edges = self.edges(text)
        forward = [0.0]
        for here in edges:
            into = [forward[i] + lp for i, _, lp in here]
            top = max(into)
            forward.append(top + math.log(sum([math.exp(x - top) for x in into])))
        total = forward[-1]
        backward = [-math.inf] * len(text) + [0.0]
        for j in range(len(text), 0, -1):
            for i, piece, lp in edges[j - 1]:
                out = lp + backward[j]
                yield piece, math.exp(forward[i] + out - total)
                a, b = max(backward[i], out), min(backward[i], out)
                backward[i] = a + math.log1p(math.exp(b - a))


#: Longer words are scored one by one; cells of a lattice that are held at once.
_LONGEST_TOGETHER = 48
_CELLS = 4_000_000


class WordBatch:
    """Lattices of many words at once: words of equal length are the columns of one array.

    All pieces that match somewhere are found by walking a trie of the vocabulary from every start of every
    word together. Gives what ``Lattice.word`` and ``Lattice.expected`` give, up to rounding.
    """

    def __init__(self, lattice: Lattice) -> None:
        self._lattice = lattice
        self._names = list(lattice.pieces)
        self._scores = np.array([lattice.pieces[p] for p in self._names])
        letters = sorted({ord(c) for p in self._names for c in p})
        self._letters = np.zeros(0x110000, np.int64)  # 0: in no piece
        self._letters[letters] = np.arange(1, len(letters) + 1)
        self._width = len(letters) + 1
        steps, piece_at = {}, [-1]
        for k, piece in enumerate(self._names):
            node = 0
            for c in piece:
                step = node * self._width + int(self._letters[ord(c)])
                node = steps.setdefault(step, len(piece_at))
                if node == len(piece_at):
                    piece_at.append(-1)
            piece_at[node] = k
        self._steps = np.array(sorted(steps), np.int64)
        self._next = np.array([steps[s] for s in self._steps.tolist()], np.int64)
        self._piece_at = np.array(piece_at)
        self._bytes: dict[int, float] = {}

    def _spelled(self, code: int) -> float:
        """Score of a character written in bytes."""
        if code not in self._bytes:
            self._bytes[code] = sum(self._lattice.bytes_[b] for b in chr(code).encode("utf-8", "surrogatepass"))
        return self._bytes[code]

    def _matches(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, start, column, piece) of all pieces in the words; codes by (position, word)."""
        size, _ = codes.shape
        letters = self._letters[codes]
        start, column = np.nonzero(letters)
        node = np.zeros(len(start), np.int64)
        for length in range(1, min(size, self._lattice.longest) + 1):
            step = node * self._width + letters[start + length - 1, column]
            at = np.minimum(np.searchsorted(self._steps, step), len(self._steps) - 1)
            hit = self._steps[at] == step
            start, column, node = start[hit], column[hit], self._next[at[hit]]
            piece = self._piece_at[node]
            whole = piece >= 0
            yield length, start[whole], column[whole], piece[whole]
            more = start + length < size
            start, column, node = start[more], column[more], node[more]

    def _groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, code points by (position, word)) of words of equal length, the space before them included."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(lengths)
        for n in np.unique(lengths):
            if n < _LONGEST_TOGETHER:
                places = np.flatnonzero(lengths == n)
                most = max(1, _CELLS // ((n + 1) * self._lattice.longest))
                for k in range(0, len(places), most):
                    some = places[k : k + most]
                    codes = flat[(ends[some] - n)[None, :] + np.arange(n)[:, None]]
                    yield some, np.vstack([np.full((1, len(some)), ord(_SPACE), np.uint32), codes])

    def _forward(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """Log sums up to every position, edges by (end, length - 1, word), where bytes are used, and all matches."""
        size, n = codes.shape
        longest = min(size, self._lattice.longest)
        edges = np.full((size + 1, longest, n), -np.inf)
        found = list(self._matches(codes))
        for length, start, column, piece in found:
            edges[start + length, length - 1, column] = self._scores[piece]
        spelled = np.isneginf(edges[1:, 0])
        edges[1:, 0][spelled] = [self._spelled(c) for c in codes[spelled].tolist()]
        forward = np.zeros((size + 1, n))
        for j in range(1, size + 1):
            k = min(j, longest)
            forward[j] = _log_sum(forward[j - k : j][::-1] + edges[j, :k])
        return forward, edges, spelled, found

    def scores(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words))
        for places, codes in self._groups(words):
            out[places] = self._forward(codes)[0][-1]
        for k in self._long(words):
            out[k] = self._lattice.word(words[k])
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> dict[object, float]:
        """Expected uses of the pieces (and bytes, by number), each word as often as it counts."""
        uses, spelled_uses = np.zeros(len(self._names)), defaultdict(float)
        for places, codes in self._groups(words):
            forward, edges, spelled, found = self._forward(codes)
            size = len(codes)
            backward = np.zeros_like(forward)
            for i in range(size - 1, -1, -1):
                k = min(size - i, edges.shape[1])
                backward[i] = _log_sum(edges[np.arange(i + 1, i + k + 1), np.arange(k)] + backward[i + 1 : i + k + 1])
            often = counts[places]
            for length, start, column, piece in found:
                share = np.exp(forward[start, column] + self._scores[piece] + backward[start + length, column] - forward[-1, column])
                uses += np.bincount(piece, share * often[column], len(uses))
            start, column = np.nonzero(spelled)
            share = np.exp(forward[start, column] + edges[start + 1, 0, column] + backward[start + 1, column] - forward[-1, column])
            letters, at = np.unique(codes[spelled], return_inverse=True)
            for code, use in zip(letters.tolist(), np.bincount(at, share * often[column], len(letters)).tolist(), strict=True):
                spelled_uses[chr(code).encode("utf-8", "surrogatepass")] += use
        for k in self._long(words):
            for piece, share in self._lattice.expected(words[k]):
                spelled_uses[piece] += share * counts[k]
        out: dict[object, float] = defaultdict(float)
        for k in np.flatnonzero(uses).tolist():
            out[self._names[k]] = float(uses[k])
        for piece, use in spelled_uses.items():
            for key in [piece] if isinstance(piece, str) else piece:
                out[key] += float(use)
        return out

    @staticmethod
    def _long(words: list[str]) -> list[int]:
        return [k for k, w in enumerate(words) if len(w) >= _LONGEST_TOGETHER]


def _log_sum(terms: np.ndarray) -> np.ndarray:
    top = terms.max(0)
    return top + np.log(np.exp(terms - top).sum(0))


def start_lattice(path: str | None = None) -> Lattice:
    """The vocabulary with the probabilities that its own scores give."""
    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    weight = {}
    for k in range(model.get_piece_size()):
        if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
            weight[model.id_to_piece(k)] = 1.0 / (ZIPF_OFFSET - model.get_score(k))
    total = sum(weight.values())
    ends = 0.05  # before anything is counted, a text ends after some twenty pieces
    share = (1 - BYTE_SHARE - ends) / total
    pieces = {p: math.log(w * share) for p, w in weight.items()}
    return Lattice(pieces, [math.log(BYTE_SHARE / 256)] * 256, math.log(ends), max(map(len, pieces)))


def refit(start: Lattice, counts: dict[object, float], ends: float, prior: float = PRIOR_TOKENS) -> Lattice:
    """New probabilities from expected piece counts (text pieces, and bytes by number) and ends."""
    if not ends and not counts:
        return start
    total = sum(counts.values()) + ends + prior
    new = lambda key, lp: math.log((counts.get(key, 0.0) + prior * math.exp(lp)) / total)
    pieces = {p: new(p, lp) for p, lp in start.pieces.items()}
    end = math.log((ends + prior * math.exp(start.end)) / total)
    return Lattice(pieces, [new(b, lp) for b, lp in enumerate(start.bytes_)], end, start.longest)


def _with_block(docs: DataFrame) -> DataFrame:
    """doc_id, text, held_out and block, staged: rows of a block adjoin and have about ``_SPLIT_BYTES`` of text.

    A block is a run of rows of a task that writes the table. Its number is stored, so later readings agree however
    they are cut into tasks.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(7).alias("held_out"))
    count, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    together = max(1, count * _SPLIT_BYTES // max(size, 1))
    number = F.monotonically_increasing_id()  # the task above, its rows below 33 bits
    place = F.floor(number.bitwiseAND((1 << 33) - 1) / together)
    return stage(rows.withColumn("block", F.xxhash64(F.shiftright(number, 33), place)), "lm_documents", compression="zstd")


def _requests(blocks: DataFrame) -> DataFrame:
    """block, word, count (in training documents) of the distinct words of every split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Counter] = defaultdict(Counter)
        for batch in batches:
            for text, held, block in zip(batch["text"], batch["held_out"].to_pylist(), batch["block"].to_pylist(), strict=True):
                words = words_of(text.as_py())
                if held:
                    own = found[block]
                    for w in [w for w in set(words) if w not in own]:
                        own[w] = 0
                else:
                    found[block].update(words)
        for block, counts in found.items():
            words = list(counts)
            for k in range(0, len(words), _ROWS):
                some = words[k : k + _ROWS]
                columns = [
                    pa.array(np.full(len(some), block)), pa.array(some, pa.binary()), pa.array([counts[w] for w in some], pa.int64()),
                ]
                yield pa.record_batch(columns, ["block", "word", "count"])

    return blocks.mapInArrow(run, "block long, word binary, count long")


def _expected_counts(words: DataFrame, lattice: Lattice) -> dict[object, float]:
    """Expected use of every piece in the training words: as many rows as the vocabulary has pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = WordBatch(lattice)
        found: dict[object, float] = defaultdict(float)
        for batch in batches:
            words = [w.decode("utf-8", "surrogatepass") for w in batch["word"].to_pylist()]
            for piece, use in together.expected(words, batch["count"].to_numpy(zero_copy_only=False)).items():
                found[piece] += use
        keys = [f"t{k}" if isinstance(k, str) else f"b{k}" for k in found]
        yield pa.record_batch([pa.array(keys, pa.string()), pa.array(list(found.values()), pa.float64())], ["piece", "uses"])

    parts = words.where(F.col("count") > 0).select("word", "count").mapInArrow(run, "piece string, uses double")
    # at most one row per piece of the vocabulary reaches the driver; the order fixes the sum
    rows = parts.groupBy("piece").agg(F.sort_array(F.collect_list("uses")).alias("uses")).collect()
    return {(r["piece"][1:] if r["piece"][0] == "t" else int(r["piece"][1:])): math.fsum(r["uses"]) for r in rows}


def _scored_words(words: DataFrame, lattice: Lattice, base: float) -> DataFrame:
    """word, known, base (log10), lattice (log10) of every distinct word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = WordBatch(lattice)
        for batch in batches:
            counts = batch["count"].to_numpy(zero_copy_only=False)
            scores = together.scores([w.decode("utf-8", "surrogatepass") for w in batch["word"].to_pylist()]) / math.log(10)
            columns = [
                batch["word"], pa.array(counts > 0), pa.array(np.log10((counts + 1) / base)), pa.array(scores, pa.float64()),
            ]
            yield pa.record_batch(columns, ["word", "known", "base", "lattice"])

    return words.mapInArrow(run, "word binary, known boolean, base double, lattice double")


@dataclass(frozen=True)
class CorpusModel:
    """Word counts of the corpus (all distinct words, also those of held-out texts) and the fitted lattice."""

    words: DataFrame  # word, count in training documents
    train_docs: int
    train_tokens: int
    distinct: int
    lattice: Lattice

    @property
    def base(self) -> float:
        return float(self.train_tokens + self.distinct + 1)


def fit_lattice(requests: DataFrame, train_docs: int, vocabulary: str | None = None) -> CorpusModel:
    words = stage(requests.groupBy("word").agg(F.sum("count").alias("count")), "word_counts")
    total, distinct = words.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count_if(F.col("count") > 0)).first()
    start = start_lattice(vocabulary)
    lattice = refit(start, _expected_counts(words, start), train_docs)
    return CorpusModel(words, train_docs, total + train_docs, distinct + (train_docs > 0), lattice)


def score_documents(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    blocks = _with_block(docs)
    requests = stage(_requests(blocks), "lm_requests")
    train_docs = blocks.where(~F.col("held_out")).count()
    model = fit_lattice(requests, train_docs, vocabulary)
    replies = requests.select("block", "word").join(_scored_words(model.words, model.lattice, model.base), "word")
    end_known = train_docs > 0
    end_base = math.log10((train_docs + 1) / model.base)
    end_score = model.lattice.end / math.log(10)
    tokens = model.train_tokens
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(key: tuple, texts: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        place = {w: k for k, w in enumerate(map(bytes, words["word"]))}
        known, base, lattice = words["known"].to_numpy(bool), words["base"].to_numpy(float), words["lattice"].to_numpy(float)
        rows = []
        for doc_id, text, held in zip(texts["doc_id"], texts["text"], texts["held_out"], strict=True):
            own = words_of(text)
            at = np.fromiter(map(place.__getitem__, own), np.int64, len(own))
            rows.append((
                doc_id, held, len(own) + 1, int(known[at].sum()) + end_known, tokens,
                float(base[at].sum()) + end_base, float(lattice[at].sum()) + end_score,
            ))
        out = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
        return out.astype({"doc_id": "Int64"})

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(score, schema)
