"""Similarities of two strings: set overlaps in the JVM, subsequence and edit distance by one Arrow UDF.

Spark's levenshtein knows no transposition and it has no subsequence function, so these two run as
bit-parallel kernels (Crochemore et al. 2001; Hyyro 2003), all pairs of an Arrow batch side by side.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import padded_ngrams, token_set
from .normalize import tokens


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    if a == b:
        return len(a)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def osa_distance(a: str, b: str) -> int:
    """Optimal string alignment: insertions, deletions, substitutions and swaps of neighbours that are not touched again."""
    if a == b:
        return 0
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, zero, before, distance = full, 0, 0, 0, len(a)
    for c in b:
        hit = where.get(c, 0)
        swap = (~zero & hit) << 1 & before
        zero = ((((hit & up) + up) ^ up) | hit | down | swap) & full
        rise, fall = (down | ~(zero | up)) & full, zero & up
        distance += bool(rise & top) - bool(fall & top)
        rise = rise << 1 | 1
        up = ((fall << 1) | ~(zero | rise)) & full
        down = zero & rise & full
        before = hit
    return distance


#: Longer strings are taken one pair at a time; words of all masks of a batch that are held at once.
LONG, _MASKS = 512, 1 << 21


def _coded(texts: list[str], size: np.ndarray) -> np.ndarray:
    """Code points, a row a text."""
    width = max(1, int(size.max()))
    return np.array(texts, f"<U{width}").view(np.uint32).reshape(len(texts), width)


def _symbols(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points of both, the place of each one among them): by a table, not by a sort."""
    both = np.concatenate([x.ravel(), y.ravel()])
    table = np.zeros(int(both.max()) + 1, np.int32)
    table[both] = 1
    symbols = np.flatnonzero(table)
    table[symbols] = np.arange(len(symbols))
    return symbols, table[both]


def _carried(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x + y of numbers whose 64-bit words lie along the first axis, the lowest first."""
    out = x + y
    over = out < x
    for k in range(1, len(out)):
        plus = out[k] + over[k - 1]
        over[k] |= plus < out[k]
        out[k] = plus
    return out


def _shifted(x: np.ndarray) -> np.ndarray:
    """x << 1, likewise."""
    out = x << np.uint64(1)
    out[1:] |= x[:-1] >> np.uint64(63)
    return out


def _lcs_step(state: dict, hit: np.ndarray) -> None:
    row = state["row"]
    both = row & hit
    state["row"] = _carried(row, both) | (row & ~hit)


def _osa_step(state: dict, hit: np.ndarray) -> None:
    up, down, zero, before = state["up"], state["down"], state["zero"], state["before"]
    swap = _shifted(~zero & hit) & before
    zero = (_carried(hit & up, up) ^ up) | hit | down | swap
    rise, fall = down | ~(zero | up), zero & up
    word, bit, at = state["word"], state["bit"], np.arange(len(state["word"]))
    state["distance"] += (rise[word, at] >> bit & np.uint64(1)).astype(np.int64) - (fall[word, at] >> bit & np.uint64(1)).astype(np.int64)
    rise = _shifted(rise)
    rise[0] |= np.uint64(1)
    state |= {"up": _shifted(fall) | ~(zero | rise), "down": zero & rise, "zero": zero, "before": hit}


def _batch(kind: str, a: list[str], b: list[str]) -> np.ndarray:
    """lcs_length or osa_distance of many pairs, their bit vectors side by side."""
    n_a, n_b = np.fromiter(map(len, a), np.int64, len(a)), np.fromiter(map(len, b), np.int64, len(b))
    out = np.zeros(len(a), np.int64) if kind == "lcs" else n_a + n_b
    short = (n_a <= LONG) & (n_b <= LONG)
    one = {"lcs": lcs_length, "osa": osa_distance}[kind]
    for i in np.flatnonzero(~short).tolist():
        out[i] = one(a[i], b[i])
    some = np.flatnonzero(short & (n_a > 0) & (n_b > 0))
    some = some[np.lexsort((-n_b[some], -n_a[some] // 64))]  # like sizes together
    at = 0
    while at < len(some):
        words = int(n_a[some[at]] + 63) // 64
        part = some[at : at + max(64, _MASKS // (64 * words))]
        part = part[np.argsort(-n_b[part], kind="stable")]
        x, y, size, end = _coded([a[i] for i in part], n_a[part]), _coded([b[i] for i in part], n_b[part]), n_a[part], n_b[part]
        symbols, code = _symbols(x, y)
        if len(part) > 64 and len(part) * len(symbols) * words > 4 * _MASKS:  # a large alphabet: fewer at once
            part = part[: max(64, 4 * _MASKS // (len(symbols) * words))]
            x, y, size, end = x[: len(part)], y[: len(part)], size[: len(part)], end[: len(part)]
            symbols, code = _symbols(x, y)
            rest = np.setdiff1d(some[at:], part)
            some = np.concatenate([some[:at], part, rest[np.lexsort((-n_b[rest], -n_a[rest] // 64))]])
        words = int(size.max() + 63) // 64
        cx, cy, row = code[: x.size].reshape(x.shape), code[x.size :].reshape(y.shape), np.arange(len(part))
        mask = np.zeros((len(symbols), words, len(part)), np.uint64)
        for j in range(x.shape[1]):
            on = row[size > j]
            mask[cx[on, j], j // 64, on] |= np.uint64(1 << j % 64)
        state = {k: np.zeros((words, len(part)), np.uint64) for k in ("down", "zero", "before")}
        state |= {k: np.full((words, len(part)), ~np.uint64(0)) for k in ("row", "up")}
        state |= {"distance": size.copy(), "word": (size - 1) // 64, "bit": ((size - 1) % 64).astype(np.uint64)}
        step = _lcs_step if kind == "lcs" else _osa_step
        done = []
        live = len(part)
        for j in range(y.shape[1]):
            if (still := int(np.searchsorted(-end, -j, "left"))) < live:  # b of the others has ended
                done.append({k: v[..., still:] for k, v in state.items()})
                state = {k: v[..., :still].copy() for k, v in state.items()}
                live = still
            if not live:
                break
            step(state, mask[cy[:live, j], :, row[:live]].T)
        done.append(state)
        last = {k: np.concatenate([s[k] for s in reversed(done)], axis=-1) for k in ("row", "distance")}
        if kind == "osa":
            out[part] = last["distance"]
        else:
            bits = np.clip(size - 64 * np.arange(words)[:, None], 0, 64)
            full = np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << np.minimum(bits, 63).astype(np.uint64)) - np.uint64(1))
            out[part] = size - np.bitwise_count(last["row"] & full).sum(axis=0)
        at += len(part)
    return out


def _each(kind: str, pairs: list[tuple[Column, Column]]) -> Column:
    """Array of the measure of the pairs: the strings cross to Python once, in Arrow batches."""

    @F.pandas_udf("array<int>")
    def run(*sides: pd.Series) -> pd.Series:
        texts = [s.tolist() for s in sides]
        return pd.Series(list(np.stack([_batch(kind, x, y) for x, y in zip(texts[::2], texts[1::2], strict=True)], axis=1).astype(np.int32)))

    return run(*[c for pair in pairs for c in pair])


def lcs_lengths(pairs: list[tuple[Column, Column]]) -> Column:
    """Array of the pairs' subsequence lengths."""
    return _each("lcs", pairs)


def osa_distances(pairs: list[tuple[Column, Column]]) -> Column:
    """Array of the pairs' edit distances."""
    return _each("osa", pairs)


def lcs_ratio(length: Column, a: Column, b: Column) -> Column:
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(2.0 * length / (F.length(a) + F.length(b)))


def osa_ratio(distance: Column, a: Column, b: Column) -> Column:
    return F.when((a == "") & (b == ""), 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - distance / F.greatest(F.length(a), F.length(b))))


def _overlap(x: Column, y: Column) -> Column:
    """Shared entries over all; both sets are made once, though they are looked at several times."""

    def share(s: Column) -> Column:
        n, m, both = F.size(s["x"]), F.size(s["y"]), F.size(F.array_intersect(s["x"], s["y"]))
        return F.when((n == 0) & (m == 0), 1.0).when((n == 0) | (m == 0), 0.0).otherwise(F.get(F.transform(F.array(both), lambda k: k / (n + m - k)), F.lit(0)))

    return F.get(F.transform(F.array(F.struct(x.alias("x"), y.alias("y"))), share), F.lit(0))


def jaccard(a: Column, b: Column) -> Column:
    return _overlap(token_set(a), token_set(b))


def ngram_similarity(a: Column, b: Column, n: int = 3) -> Column:
    return _overlap(padded_ngrams(a, n), padded_ngrams(b, n))


def sorted_tokens(a: Column) -> Column:
    return F.array_join(F.array_sort(tokens(a)), " ")


def length_difference(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def digits(a: Column) -> Column:
    return F.regexp_replace(a, r"[^\p{Nd}²³¹⁰⁴-⁹₀-₉]", "")


def exact(a: Column, b: Column) -> Column:
    return F.when((a != "") & (a == b), 1.0).otherwise(0.0)


def both_present(a: Column, b: Column) -> Column:
    return F.when((a != "") & (b != ""), 1.0).otherwise(0.0)


def first_token(a: Column) -> Column:
    return F.get(tokens(a), F.lit(0))


def first_token_match(a: Column, b: Column) -> Column:
    return F.when((a != "") & (b != "") & (first_token(a) == first_token(b)), 1.0).otherwise(0.0)


def dice(a: Column, b: Column) -> Column:
    """Extension: twice the shared tokens over all."""
    x, y = token_set(a), token_set(b)
    return dice_of(F.size(F.array_intersect(x, y)), F.size(x), F.size(y))


def overlap_coefficient(a: Column, b: Column) -> Column:
    """Extension: shared tokens over the smaller set."""
    x, y = token_set(a), token_set(b)
    return overlap_of(F.size(F.array_intersect(x, y)), F.size(x), F.size(y))


def shared_of(jaccard: Column, n: Column, m: Column) -> Column:
    """How many entries sets of n and m share: both / (n + m - both) is their jaccard."""
    return F.round(jaccard * (n + m) / (1 + jaccard))


def dice_of(both: Column, n: Column, m: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * both, n + m), F.lit(1.0))


def overlap_of(both: Column, n: Column, m: Column) -> Column:
    return F.coalesce(F.try_divide(both.cast("double"), F.least(n, m)), F.when(n + m == 0, 1.0).otherwise(0.0))
