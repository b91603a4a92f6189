"""What the operators of this subpackage share: settled tables, Arrow text buffers and vectorised words.

A word is a maximal run of characters outside ``[\\x20\\x09-\\x0D]``. Words are found and hashed on the
UTF-8 bytes of a whole Arrow batch at once, so that no Python object is made for a word.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.settled import shared_dir, shelve, unshelve  # noqa: F401

#: Bytes of text that the vectorised steps take at once (a longer single text is taken alone).
CHUNK_BYTES = 2 << 20
#: Rows that they take at once, whatever the session's Arrow batches are.
CHUNK_ROWS = 1 << 15

U64 = np.uint64


def identity(df: DataFrame, columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row's columns; together they tell rows apart. Columns that hold maps are hashed as JSON."""
    of = [F.to_json(F.struct(c), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}) if "map<" in df.schema[c].dataType.simpleString() else F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*of), F.xxhash64(F.lit(0x5BD1E995), *of)


def fresh(name: str, taken: list[str]) -> str:
    """name, with as many _ behind it as no (case-insensitively) equal column of `taken` needs."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


_KEPT: dict[str, Callable[[], object]] = {}
_AT_WORK = [""]


def keep(owner: str, drop: Callable[[], object]) -> None:
    """Say how to drop what an operator keeps in a Python worker between tasks."""
    _KEPT[owner] = drop


def at_work(owner: str) -> None:
    """Called where an operator begins in a worker: what others have kept there, in a session of many steps, goes, and freed memory goes back to the system."""
    gc.enable()
    if _AT_WORK[0] not in ("", owner):
        for name, drop in _KEPT.items():
            if name != owner:
                drop()
        gc.collect()
    _give_back()
    _AT_WORK[0] = owner


def _give_back() -> None:
    """Freed memory goes back to the system: Arrow's and the C library's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def worker(owner: str):
    """For functions of Arrow batches: at_work() before the first, and memory given back after the last, for a worker may then be idle beside others."""

    def around(f):
        @functools.wraps(f)
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at_work(owner)
            try:
                yield from f(batches)
            finally:
                _give_back()

        return run

    return around


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece holds at most limit bytes of column, or one row, and at most CHUNK_ROWS rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, min(at + CHUNK_ROWS, int(np.searchsorted(ends, done + limit, "right"))))
            yield batch.slice(at, to - at)
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finalizer of splitmix64)."""
    x = np.asarray(x, U64).copy()
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}
keep("powers", _POWERS.clear)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, modulo 2**64, of the hash's base and of its inverse; kept (32 MB at most) unless one text is longer than a chunk."""
    size = 1 << max(16, (n - 1).bit_length())
    found = []
    for base in (_BASE, _INVERSE):
        if (table := _POWERS.get(base)) is None or len(table) < n:
            steps = np.full(size, base, U64)
            steps[0] = 1
            table = np.cumprod(steps)
            if size <= CHUNK_BYTES:
                _POWERS[base] = table
        found.append(table)
    return found[0], found[1]


class Words(NamedTuple):
    """Words of a batch: byte spans, 64-bit hashes, and for each text where its words begin (n + 1 entries)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def words(data: np.ndarray, offsets: np.ndarray, hashes: bool = True, lower: bool = False) -> Words:
    """Find and hash the words of texts that lie one after the other in data."""
    n = len(data)
    inside = np.empty(n + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~is_space(data)
    begin = inside[1:] & ~inside[:-1]
    stop = inside[:-1] & ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    both = inside[cut] & inside[cut + 1]  # a word that would run over the end of a text
    begin[cut[both]] = True
    stop[cut[both]] = True
    start, end = np.flatnonzero(begin[:-1]), np.flatnonzero(stop)
    first = np.searchsorted(start, offsets)
    if not hashes:
        return Words(start, end, np.empty(0, U64), first)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * power[:n], out=sums[1:])
    return Words(start, end, mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64)), first)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the len(h) - k + 1 runs of k words, whichever text they are of."""
    out = np.zeros(max(len(h) - k + 1, 0), U64)
    for i in range(k):
        out = out * U64(0xD1342543DE82EF95) + h[i : i + len(out)]
    return mix(out)


def owners(first: np.ndarray) -> np.ndarray:
    """For each word, the row of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def arrow(names: list[str], arrays: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in arrays], names)
