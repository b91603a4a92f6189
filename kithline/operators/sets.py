"""Sets of tokens and n-grams of many rows at once, as flat arrays."""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc


def spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... n[i] of them, one after the other."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def sets(rows, kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(entries of the rows' sets, ends): distinct tokens of a row, given as hashes, or n-grams of its text with two spaces before and behind."""
    if kind == "h":
        size = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        return rows.flatten().to_numpy(), np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    texts = [f"  {t}  " if t else "" for t in rows.to_pylist()]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    runs = np.where(size > 0, size - (n - 1), 0)
    at = spread(np.cumsum(size) - size, runs)
    code = np.zeros(len(at), np.int64)
    for j in range(n):
        code = code << 21 | points[at + j]
    known, code = np.unique(code, return_inverse=True)
    key = np.unique(np.repeat(np.arange(len(texts)), runs) * max(1, len(known)) + code)
    return known[key % max(1, len(known))] if len(known) else known, np.searchsorted(key, np.arange(len(texts) + 1) * max(1, len(known)))
