"""Words as all corpus operators see them: runs of bytes that are no ASCII white space.

``bytes.split`` cuts exactly at space and 0x09-0x0D, the class ``[^\\x20\\x09-\\x0D]+``, and
``bytes.lower`` changes only A-Z.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX_2 = np.uint64(0xBF58476D1CE4E5B9)
_MOST_CACHED = 400_000


def n_words(text: Column | str) -> Column:
    """Number of words of a text inside the JVM, 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def words_of(text: str | None, lower: bool = True) -> list[bytes]:
    if text is None:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


class WordHashes:
    """64-bit hashes of words; frequent words are remembered in a bounded table."""

    def __init__(self) -> None:
        self._known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self._known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w, 7)
        found = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        if len(known) > _MOST_CACHED:
            known.clear()
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (finaliser of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_2
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; a shorter text is one run."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    width = min(size, n)
    with np.errstate(over="ignore"):
        total = np.full(n - width + 1, width, np.uint64)
        factor = _MIX
        for k in range(width):
            total += hashes[k : n - width + 1 + k] * factor
            factor = factor * _MIX  # odd, so no word is lost
        return np.unique(mixed(total))


_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Bytes whose words are hashed together, and the powers that hash them.
_TOGETHER = 1 << 18
_LOWER = np.arange(256) + 32 * ((np.arange(256) >= 0x41) & (np.arange(256) <= 0x5A))
_BYTE = mixed(_MIX * (_LOWER.astype(np.uint64) + np.uint64(1)))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd factor and of its inverse, kept for texts of usual length."""
    if not _POWERS or len(_POWERS[0]) < n:
        up, down = np.full(max(n, 2 * _TOGETHER), _MIX), np.full(max(n, 2 * _TOGETHER), np.uint64(pow(int(_MIX), -1, 1 << 64)))
        up[0] = down[0] = 1
        found = [np.cumprod(up), np.cumprod(down)]
        if n > 2 * _TOGETHER:
            return found[0], found[1]
        _POWERS[:] = found
    return _POWERS[0], _POWERS[1]


def hashed_words(texts: pa.Array) -> Iterator[np.ndarray]:
    """64-bit hashes of the words of each text, A-Z lowered; a null text has none.

    The bytes of many texts are hashed at once: a word's hash is a polynomial of its bytes, from running sums.
    """
    held: list[bytes] = []
    size = 0
    for text in texts:
        raw = bytes(text.as_buffer()) if text.is_valid else b""
        if size and size + len(raw) > _TOGETHER:
            yield from _hashed(held)
            held, size = [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield from _hashed(held)


def _hashed(raws: list[bytes]) -> Iterator[np.ndarray]:
    data = np.frombuffer(b" ".join([*raws, b""]), np.uint8)
    space = np.ones(len(data) + 1, bool)
    space[1:] = _IS_SPACE[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    ends = np.flatnonzero(~space[:-1] & space[1:])
    with np.errstate(over="ignore"):
        up, down = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
        words = mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    cuts = np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raws]))
    yield from np.split(words, cuts[:-1])
