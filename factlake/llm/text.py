"""Byte-level helpers over Arrow columns: words, 64-bit word hashes and hashes of word ranges.

Words are the maximal runs of bytes other than 0x20 and 0x09-0x0D.  These bytes never occur inside a
multi-byte UTF-8 character, so the byte view and the character view give the same words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one numpy pass takes; a longer document is a pass of its own.
PASS_BYTES = 1 << 19
#: Longer words are hashed by BLAKE2 (a polynomial modulo 2^64 has known collisions from 1024 symbols on).
LONG_WORD = 512

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def documents(df: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only, so that further columns of any name do no harm."""
    return df.select(F.col("doc_id").cast(T.LongType()).alias("doc_id"), F.col("text").cast(T.StringType()).alias("text"))


def keyed(df: DataFrame) -> DataFrame:
    """``documents`` with a hash of the text, which tells rows of one ``doc_id`` apart."""
    return documents(df).withColumn("text_key", F.xxhash64("text"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores after them as long as a column of ``df`` has such a name (in any case of letters)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64, a bijection of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int, inverse: bool) -> np.ndarray:
    known = _POWERS.get((base, inverse))
    if known is None or len(known) < n:
        size = max(n, PASS_BYTES + 4096)
        factor = np.full(size, pow(base, -1, 1 << 64) if inverse else base, dtype=_U)
        factor[0] = 1
        known = np.cumprod(factor, dtype=_U)
        if size <= 4 * PASS_BYTES:
            _POWERS[base, inverse] = known
    return known[:n]


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values * _powers(base, len(values), False), out=out[1:])
    return out


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[s:e]`` for each pair, in constant time per range."""
    sums = _sums(values, _BASES[0])
    raw = (sums[ends] - sums[starts]) * _powers(_BASES[0], len(values) + 1, True)[starts]
    return mix(raw + (ends - starts).astype(_U) * _U(0xA24BAED4963EE407))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in a byte array."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(inside))
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    wide = data.astype(_U) + _U(1)
    out = np.zeros(len(starts), dtype=_U)
    for salt, base in enumerate(_BASES):
        sums = _sums(wide, base)
        raw = (sums[ends] - sums[starts]) * _powers(base, len(data) + 1, True)[starts]
        out = mix(out * _U(3) + mix(raw + _U(salt)) + (ends - starts).astype(_U))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all else unchanged."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each row; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


class Words:
    """The words of consecutive rows: hashes, the row of each word, and the words of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, last: int, lower: bool = False):
        base = offsets[first]
        part = data[base : offsets[last]]
        rows = offsets[first : last + 1] - base
        # a space between rows, so that no word runs from one into the next
        spread = np.full(len(part) + last - first, 32, dtype=np.uint8)
        where = np.arange(len(part)) + np.repeat(np.arange(last - first), np.diff(rows))
        spread[where] = lower_ascii(part) if lower else part
        starts, ends = word_spans(spread)
        self.bytes, self.starts, self.ends = spread, starts, ends
        self.hashes = word_hashes(spread, starts, ends)
        row_starts = rows[:-1] + np.arange(last - first)
        self.bounds = np.append(np.searchsorted(starts, row_starts), len(starts))  # words of row i: bounds[i]..bounds[i+1]
        self.row = np.repeat(np.arange(last - first), np.diff(self.bounds))


def passes(offsets: np.ndarray, size: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes; every row is in exactly one run."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last
