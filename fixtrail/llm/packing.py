"""Sum-of-squares packing of token sequences.

Every text becomes token ids plus an end id. Only documents above the capacity are cut: from the
end into full pieces, so that the first piece holds the rest. Pieces are then packed into as few
sequences as possible: the longest first, each into the open sequence whose gap changes
the sum over all gaps of (open sequences with that gap) squared the least, so that no gap piles
up unused. A new sequence is opened only when no gap is wide enough; classical
sum-of-squares also opens them early, which costs sequences once the order is by length.

Pieces are dealt to shards of about ``shard_pieces`` rows by a hash of their place in the
staged table, so equal or repeated documents spread evenly. Each shard is packed in one task; its
memory is bounded by ``shard_pieces``, and a shard leaves at most a handful of sequences less full.

Null or empty texts are one piece of the end id alone. Null ids, repeated rows and ties are kept
as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtrail.operators.staging import stage

CAPACITY = 2048
END_ID = 0
#: Pieces packed together by one task.
SHARD_PIECES = 8192
#: Words with known ids; when there are more, those met lately stay, if they are few enough.
_MOST_CACHED = 750_000
_MOST_KEPT = _MOST_CACHED * 3 // 4
_LONGEST_CACHED = 48
_WORDS_IN_TEXT = 1000
_SPACE = "Ġ"  # how the vocabulary writes a space (fixed value)
#: Bytes of text whose new words are encoded together.
_TOGETHER = 2_000_000
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
#: Marks that the pre-tokenizer cuts off a run of letters when one ends a word.
_MARKS = frozenset(",.;:!?")


class Encoder:
    """Ids of whole texts, with a bounded table of the ids of frequent words.

    The pre-tokenizer always cuts in front of a space that follows other text, so a text is looked up
    piece by piece; a piece begins with its space, or spaces, and ends before the next. The new pieces of many
    texts are encoded together.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        # a task has one core: threads for a handful of words cost more than the words
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        vocabulary = self._tokenizer.get_vocab()
        self._spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self._spaced[[i for token, i in vocabulary.items() if token.startswith(_SPACE)]] = True
        self._known: dict[str, bytes] = {}
        self._late: set[str] = set()  # known words met since the table is half full
        self._marks = dict(zip(sorted(_MARKS), self._encode(sorted(_MARKS)), strict=True))

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word behind a space. Words without another space are encoded as one text, in which only
        the first token of a word begins with a space."""
        out: list[bytes] = []
        for k in range(0, len(words), _WORDS_IN_TEXT):
            some = words[k : k + _WORDS_IN_TEXT]
            ids = np.frombuffer(self._encode([" " + " ".join(some)])[0], "<u4")
            starts = np.flatnonzero(self._spaced[ids])
            if len(starts) == len(some) and "" not in some:
                raw = ids.tobytes()
                ends = [*(4 * starts).tolist(), len(raw)]
                out += [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            else:
                out += self._encode([" " + w for w in some])
        return out

    def _add(self, words: list[str]) -> dict[str, bytes]:
        """Remember new words; those too long to keep are returned. Letters before a mark are a word of their own."""
        known, marks = self._known, self._marks
        ended = [w for w in words if w[-1:] in _MARKS and w[:-1].isalpha()]
        plain = set(words).difference(ended)
        plain.update([w[:-1] for w in ended])
        plain = list(plain.difference(known))
        found = dict(zip(plain, self._encode_words(plain), strict=True))
        extra = {w: found.pop(w) for w in plain if len(w) > _LONGEST_CACHED}
        known.update(found)
        for word in ended:
            stem = word[:-1]
            ids = (known[stem] if stem in known else extra[stem]) + marks[word[-1]]
            (known if len(word) <= _LONGEST_CACHED else extra)[word] = ids
        return extra

    @staticmethod
    def _words(text: str) -> list[str]:
        """The pieces of a text; all but the first without their first space."""
        if "  " not in text:
            return text.split(" ")
        first, *rest = _BEFORE_SPACE.split(text)
        return [first, *(w[1:] for w in rest)]

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of every text."""
        known = self._known
        split = [self._words(t) if t else [""] for t in texts]
        heads = self._encode([w[0] for w in split])
        met = set().union(*[w[1:] for w in split])
        new = met.difference(known)
        extra = self._add(list(new)) if new else {}
        out = []
        for head, words in zip(heads, split, strict=True):
            rest = words[1:]
            if extra and not extra.keys().isdisjoint(rest):
                joined = head + b"".join([known[w] if w in known else extra[w] for w in rest])
            else:
                joined = head + b"".join(map(known.__getitem__, rest))
            out.append(np.frombuffer(joined, "<u4"))
        if len(known) > _MOST_CACHED // 2:
            self._late |= met.difference(extra)
        if len(known) > _MOST_CACHED:
            self._known = {w: known[w] for w in self._late} if len(self._late) <= _MOST_KEPT else {}
            self._late = set()
        return out

    def __call__(self, text: str | None) -> np.ndarray:
        return self.batch([text])[0]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder of this Python worker, which its tasks share: frequent words stay known from one to the next."""
    return Encoder(path)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of a document: full ones from the end, the rest in front."""
    first = length % capacity or capacity
    starts = [0, *range(first, length, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length], strict=True)]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a bounded number of characters, or of one text."""
    for batch in batches:
        sizes = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in batch["text"]])
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + _TOGETHER, side="right")))
            yield batch.slice(start, end - start)
            start = end


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = True
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, the ids of every piece."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in _parts(batches):
            rows: list[tuple] = []
            for doc_id, found in zip(batch["doc_id"].to_pylist(), encoder.batch(batch["text"].to_pylist()), strict=True):
                ids = np.append(found, np.uint32(END_ID)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start : start + length]
                    row = (doc_id, k, start, length, zlib.crc32(own.tobytes()))
                    rows.append((*row, own.astype(np.int32)) if with_ids else row)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = [x.split()[0] for x in schema.split(", ")]
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types[: len(names)], strict=True)]
            yield pa.record_batch(arrays, names)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(pieces, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece of one shard."""
    open_bins = np.zeros(capacity + 1, np.int64)  # by gap
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    number = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    last = -1
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        gap = 0
        if size < capacity:
            there = open_bins[size:capacity]  # by gap - size
            # half the change of the sum of squares, up to a constant; a full bin has no gap left
            change = open_bins[: capacity - size] - there
            change[0] = -there[0]
            change[there == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            gap = size + best if there[best] else 0
        if gap:
            open_bins[gap] -= 1
            number[i] = waiting[gap].pop()
        else:
            last, gap = last + 1, capacity
            number[i] = last
        offset[i] = capacity - gap
        if gap > size:
            open_bins[gap - size] += 1
            waiting[gap - size].append(int(number[i]))
    return number, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` (a scan with a ``length``) with sequence_id and offset."""
    count = pieces.count()
    shards = -(-max(count, 1) // shard_pieces)
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards))
    dealt = pieces.withColumn("_shard", place.cast("long"))
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        number, offset = sum_of_squares(group["length"].to_numpy(), capacity)
        shard = int(group["_shard"].iloc[0])
        return group.drop(columns="_shard").assign(sequence_id=number * shards + shard, offset=offset)

    return dealt.groupBy("_shard").applyInPandas(packed, schema)


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    shard_pieces: int = SHARD_PIECES,
    with_ids: bool = True,
) -> DataFrame:
    """All documents as packed pieces: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset."""
    pieces = stage(token_pieces(docs, capacity, tokenizer, with_ids), "token_pieces")
    return pack(pieces, capacity, shard_pieces)
