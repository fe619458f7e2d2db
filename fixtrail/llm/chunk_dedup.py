"""Exact substring deduplication, with content-defined chunks as anchors.

A passage is a run of at least ``MIN_WORDS`` words. A word is cut from a document if it lies in a passage that an
earlier document (smaller id) has word for word; repeats within one document stay. Every match of over 50
words with one earlier document is a union of windows of exactly ``MIN_WORDS`` words, so the windows decide, and
cuts begin and end with the real match.

How candidates are found: a gear hash rolls over the bytes of the text, its words set apart by single spaces. It has 16 bits
and is shifted by one a byte, so it remembers 16 bytes, at most eight words. A word end is a boundary if its value is the least
of some ``r`` successive word ends, so boundaries follow the content: an insertion moves them along and changes only those
near it. Between boundaries lie chunks of 1 to ``r`` words, known by a digest of their words.

Why no passage is missed: a boundary is decided by the words from ``r + 6`` before it to ``r - 1`` behind it, so within a window of ``MIN_WORDS`` words
the boundaries of a middle part follow from the window alone, and ``r`` is chosen so that this part has at least
``2 r`` word ends, two boundaries and so a whole chunk. The longest such chunk of a window is its anchor. Equal windows have equal anchors; only
windows whose anchor is in more than one document are compared. Anchors and windows are known by 64-bit
hashes of their words; white space between words doesn't count.

How it runs: every task compares the anchors (later the windows) of its own rows first and sends on one row per
distinct hash, so a passage that a third of all documents share is as many rows as there are
partitions; what is already known to be shared travels under a key of its own, windows as runs. Anchors and copies
are then gathered per document; both joins read the same shuffle of the texts.

Null texts stay null, empty ones empty; a document whose words are all copies has an empty text. Rows
of equal id and text are one document and are cut alike; null ids come last in order, and documents of equal id are
ordered by a checksum of their text. An empty table gives an empty result. All columns of ``docs`` are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fixtrail.llm.words import WordHashes, mixed

#: Least words of a cut: passages of over 50 words.
MIN_WORDS = 51
#: Rows that a task compares at a time.
_HELD_ROWS = 2_000_000
_SPAN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "words")])
_LAST = (1 << 63) - 1
_FACTOR = 0x9E3779B97F4A7C15
_GEAR_BITS = 16
#: Words that a gear hash can remember: 16 bytes of single letters and the spaces before them.
_MEMORY = _GEAR_BITS // 2
_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_ROWS = "key long, order long, place long, run int"


def reach(min_words: int) -> int:
    """Successive word ends of which the least is a boundary.

    The middle of a window, ``min_words - 2 r - 5`` word ends, has to hold two boundaries, so 2 r ends. Fewer than the most
    leave room for several chunks, and adjoining windows share the longest of them.
    """
    if min_words < _MEMORY + 2:
        raise ValueError(f"passages need at least {_MEMORY + 2} words")
    return max(1, (min_words - _MEMORY) // 5)


def gear(words: list[bytes]) -> np.ndarray:
    """The rolling hash at the end of every word, over the words with a space before each."""
    text = np.frombuffer(b" " + b" ".join(words), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    value = _GEAR[text]
    for span in (1, 2, 4, 8):  # from the last ``span`` bytes to twice as many
        value[span:] += value[:-span] << np.uint16(span)
    return value[ends]


def boundaries(value: np.ndarray, r: int) -> np.ndarray:
    """Word ends whose value is the least, and the first of equal ones, of some ``r`` successive ones."""
    if len(value) < r:
        return np.empty(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(value, r).argmin(1) + np.arange(len(value) - r + 1)
    return least[np.append(True, least[1:] != least[:-1])]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse."""
    up = np.full(n, _FACTOR, np.uint64)
    down = np.full(n, pow(_FACTOR, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def runs_hashed(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of the words from each start to before its end, from sums of powers that end with the run."""
    with np.errstate(over="ignore"):
        up, down = _powers(len(hashes) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1])])
        return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` words."""
    start = np.arange(max(0, len(hashes) - width + 1))
    return runs_hashed(hashes, start, start + width)


class Passages:
    """Hashes of one text's chunks and windows; window k begins with word k."""

    def __init__(self, raw: bytes, hashes: WordHashes, min_words: int = MIN_WORDS) -> None:
        words = raw.split()
        self.count = max(0, len(words) - min_words + 1)
        self._split = words if self.count else []
        self._words = hashes(words) if self.count else np.empty(0, np.uint64)
        self._min_words = min_words

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word and digest of every chunk, and which chunk (or one of the same digest) is the anchor of each window."""
        r = reach(self._min_words)
        ends = boundaries(gear(self._split), r)
        start, length = ends[:-1] + 1, np.diff(ends)
        digest = runs_hashed(self._words, start, start + length)
        # long chunks first, then by digest
        rank = length.astype(np.uint64) << np.uint64(56) | digest >> np.uint64(8)
        window = np.arange(self.count)
        first = np.searchsorted(ends, window + _MEMORY + r - 2)
        last = np.searchsorted(ends, window + self._min_words - r, side="right") - 1  # chunks from first to before last
        fresh = np.append(True, (first[1:] != first[:-1]) | (last[1:] != last[:-1]))[: self.count]
        pairs = np.column_stack([first[fresh], last[fresh]]).ravel()
        best = np.maximum.reduceat(np.append(rank, np.uint64(0)), pairs)[::2]
        by_rank = np.argsort(rank, kind="stable")
        chosen = by_rank[np.searchsorted(rank[by_rank], best)]
        return start, digest, chosen[np.cumsum(fresh) - 1]

    def windows(self) -> np.ndarray:
        return rolling(self._words, self._min_words)


def spans(raw: bytes, copied: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(first byte, last byte, words) of the runs of words that copied windows cover."""
    space = np.ones(len(raw) + 2, bool)
    space[1:-1] = _IS_SPACE[np.frombuffer(raw, np.uint8)]
    starts = np.flatnonzero(space[:-2] & ~space[1:-1])
    ends = np.flatnonzero(~space[1:-1] & space[2:]) + 1
    at = np.flatnonzero(copied)
    change = np.zeros(len(starts) + 2, np.int64)
    change[at + 1] += 1
    change[at + min_words + 1] -= 1
    turns = np.flatnonzero(np.diff(np.cumsum(change) > 0, append=False))
    return [(int(starts[a]), int(ends[b - 1]), int(b - a)) for a, b in zip(turns[::2], turns[1::2], strict=True)]


def without(raw: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    """The text without the spans and the white space after each."""
    kept, at = [], 0
    for a, b, _ in spans:
        kept.append(raw[at:a])
        rest = raw[b:]
        at = b + len(rest) - len(rest.lstrip())
    kept.append(raw[at:])
    out = b"".join(kept)
    return out.rstrip() if at == len(raw) and spans else out


def _order(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST))


def _text_mark() -> Column:
    """31 bits of the text, to tell documents of equal id apart."""
    return F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).bitwiseAND(0x7FFFFFFF)


def _scattered(order: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mixed(place.view(np.uint64) ^ mixed(order.view(np.uint64))).view(np.int64)


def _runs(order: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjoining places of one document as first place and length."""
    by = np.lexsort((place, order))
    order, place = order[by], place[by]
    fresh = np.append(True, (order[1:] != order[:-1]) | (place[1:] != place[:-1]))[: len(order)]
    order, place = order[fresh], place[fresh]
    first = np.flatnonzero(np.append(True, (order[1:] != order[:-1]) | (place[1:] != place[:-1] + 1))[: len(order)])
    return order[first], place[first], np.diff(np.append(first, len(order)))


def _anchors_known(other: np.ndarray, starts: np.ndarray, order: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Every anchor of a group with more than one document is shared."""
    shared = np.repeat(np.logical_or.reduceat(other, starts), np.diff(np.append(starts, len(order))))
    return order[shared], place[shared], np.ones(int(shared.sum()), np.int64)


def _windows_known(other: np.ndarray, starts: np.ndarray, order: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Every window of a later document of its group is a copy."""
    return _runs(order[other], place[other])


def _compared(found: Iterator[tuple[np.ndarray, int, np.ndarray]], known: Callable[..., tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """One row per distinct hash (run 0) and what the task's own rows tell; place is text mark << 32 | word."""

    def settle(held: list) -> Iterator[pa.RecordBatch]:
        key, order, place = (np.concatenate(x) for x in zip(*held, strict=True))
        by = np.lexsort((place, order, key))
        key, order, place = key[by], order[by], place[by]
        first = np.append(True, key[1:] != key[:-1])
        starts = np.flatnonzero(first)
        origin = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        other = (order != order[origin]) | (place >> 32 != place[origin] >> 32)
        more, at, run = known(other, starts, order, place)
        key = np.concatenate([key[starts], _scattered(more, at)])
        order, place = np.concatenate([order[starts], more]), np.concatenate([place[starts], at])
        run = np.concatenate([np.zeros(len(starts), np.int32), run.astype(np.int32)])
        for k in range(0, len(key), 100_000):
            part = slice(k, k + 100_000)
            yield pa.record_batch([pa.array(x[part]) for x in (key, order, place, run)], ["key", "order", "place", "run"])

    held, size = [], 0
    for keys, order, places in found:
        held.append((keys.view(np.int64), np.full(len(keys), order, np.int64), places))
        size += len(keys)
        if size >= _HELD_ROWS:
            yield from settle(held)
            held, size = [], 0
    if size:
        yield from settle(held)


def shared_anchors(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """order, place, run: every anchor that more than one document has, by its first place in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def found() -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
            for batch in batches:
                for order, text in zip(batch["order"].to_pylist(), batch["text"], strict=True):
                    raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                    passages = Passages(raw, hashes, min_words)
                    if passages.count:
                        start, digest, anchor = passages.chunks()
                        anchor = np.unique(anchor)
                        own, first = np.unique(digest[anchor], return_index=True)
                        yield own, order, (zlib.crc32(raw) & 0x7FFFFFFF) << 32 | start[anchor[first]]

        yield from _compared(found(), _anchors_known)

    texts = docs.select(_order().alias("order"), F.col("text").cast("string").alias("text"))
    doc = F.struct("order", F.shiftright("place", 32))
    group = Window.partitionBy("key")
    asked = F.when(F.col("run") == 0, doc)
    rows = texts.mapInArrow(run, _ROWS).withColumns({"_a": F.min(asked).over(group), "_b": F.max(asked).over(group)})
    return rows.where((F.col("run") > 0) | (F.col("_a") != F.col("_b"))).select("order", "place", "run")


def copied_windows(candidates: DataFrame, text_at: int, min_words: int = MIN_WORDS) -> DataFrame:
    """order, place, run: windows that an earlier document has, as runs or (run 0) by their first place in the document.

    The last columns of ``candidates`` are order and the places of shared anchors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def found() -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
            for batch in batches:
                orders, anchors = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
                for text, order, places in zip(batch.column(text_at), orders.to_pylist(), anchors, strict=True):
                    raw = text.as_py().encode("utf-8", "surrogatepass")
                    passages = Passages(raw, hashes, min_words)
                    start, digest, anchor = passages.chunks()
                    shared = np.isin(digest, digest[np.searchsorted(start, places.values.to_numpy())])
                    at = np.flatnonzero(shared[anchor])
                    yield passages.windows()[at], order, (zlib.crc32(raw) & 0x7FFFFFFF) << 32 | at

        yield from _compared(found(), _windows_known)

    doc = F.struct("order", F.shiftright("place", 32))
    earliest = F.min(F.when(F.col("run") == 0, doc)).over(Window.partitionBy("key"))  # a row per task at most
    rows = candidates.mapInArrow(run, _ROWS).withColumn("_first", earliest)
    return rows.where((F.col("run") > 0) | (doc != F.col("_first"))).select("order", "place", "run")


def _gathered(found: DataFrame, value: Column, name: str) -> DataFrame:
    doc = (F.col("order").alias("_order"), F.shiftright("place", 32).alias("_mark"))
    return found.groupBy(*doc).agg(F.collect_list(value).alias(name))


def dedup_passages(docs: DataFrame, min_words: int = MIN_WORDS, with_spans: bool = True) -> DataFrame:
    """``docs`` with copied passages cut out of ``text``; with_spans adds ``removed`` (start, length, words).

    Starts and lengths are code points of the text as it was.
    """
    fields = list(docs.schema.fields)
    names = [f.name for f in fields]
    text_at = names.index("text")
    own = [f"c{k}" for k in range(len(names))]  # positions can't clash
    texts = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(names, own, strict=True)], _order().alias("order"), _text_mark().alias("mark"))
    same = (F.col("order") == F.col("_order")) & (F.col("mark") == F.col("_mark"))
    word = F.col("place").bitwiseAND(0xFFFFFFFF)
    anchors = _gathered(shared_anchors(docs, min_words), word.cast("int"), "_anchors")
    candidates = texts.join(anchors, same).select(*own, "order", "_anchors")
    copies = _gathered(copied_windows(candidates, text_at, min_words), F.shiftleft(word, 32).bitwiseOR(F.col("run").cast("long")), "_copies")
    joined = texts.join(copies, same, "left").select(*own, "_copies")
    span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("words", pa.int64())])
    out = T.StructType(fields)
    if with_spans:
        out = T.StructType([*fields, T.StructField("removed", T.ArrayType(_SPAN))])

    def copied(raw: bytes, found: np.ndarray, hashes: WordHashes) -> np.ndarray:
        windows = Passages(raw, hashes, min_words).windows()
        start, run = found >> 32, found & 0xFFFFFFFF
        change = np.zeros(len(windows) + 1, np.int64)
        np.add.at(change, start[run > 0], 1)
        np.add.at(change, (start + run)[run > 0], -1)
        return (np.cumsum(change)[:-1] > 0) | np.isin(windows, windows[start[run == 0]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts: list[str | None] = []
            removed: list[list[dict]] = []
            for text, copies in zip(batch.column(text_at), batch.column(batch.num_columns - 1), strict=True):
                text = text.as_py()
                cut: list[tuple[int, int, int]] = []
                if text and copies.is_valid:
                    raw = text.encode("utf-8", "surrogatepass")
                    cut = spans(raw, copied(raw, copies.values.to_numpy(), hashes), min_words)
                    text = without(raw, cut).decode("utf-8", "surrogatepass")
                texts.append(text)
                if with_spans:
                    chars = lambda x, y: len(raw[x:y].decode("utf-8", "surrogatepass"))  # noqa: B023, E731
                    removed.append([{"start": chars(0, a), "length": chars(a, b), "words": w} for a, b, w in cut])
            columns = [batch.column(k) for k in range(len(names))]
            columns[text_at] = pa.array(texts, pa.string())
            if with_spans:
                columns.append(pa.array(removed, pa.list_(span)))
            yield pa.RecordBatch.from_arrays(columns, [*names, *(["removed"] if with_spans else [])])

    return joined.mapInArrow(run, out)
