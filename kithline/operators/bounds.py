"""Which pairs cannot reach a matcher's threshold, told from small sketches of their records.

A sketch holds a record's sizes, hashes, bags of characters and bit sets of its tokens and n-grams. Two of them
bound every clean feature from both sides, and boosted trees with bounds of their features have a greatest
score: the best leaf of each tree that the bounds leave open. A pair whose greatest score lies below the
threshold is no match, whatever its features are. The others are scored by the model itself, so the matches are
those of all pairs. Of a tree at most 64 leaves are a word, best leaf first; each bound masks some (Lucchese et al. 2015).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import token_set
from .features import CLEAN_FEATURES, CLEAN_OVERLAPS
from .sets import sets

_TEXTS = ["business_name_core", "business_name_blockkey", "business_address_clean"]
_EXACT = {"name_exact_match": 0, "blockkey_exact_match": 1, "addr_exact_match": 2, "postal_match": 3, "legal_suffix_match": 4}
_HASHED = [*_TEXTS, "postal_code", "legal_suffix"]
_BOTH = {"postal_both_present": 0, "legal_suffix_both_present": 1, "country_both_known": 2}
#: Words of an overlap's bit set; classes of characters in a bag, whose counts are bytes.
_WORDS, _BAG = (1, 4, 2, 2, 6), 32
#: Entries of a mask table; trees between two looks at what is ruled out; room for features as floats.
_TABLE, _TREES, _SLACK = 1024, 8, 1e-6

SKETCH = np.dtype(
    [("len", "i4", 3), ("n", "i4", len(_WORDS)), ("hash", "u4", len(_HASHED)), ("known", "u1", 3), ("s3", "u1"), ("loose", "u1"), ("pad", "u1", 3), ("bag", "u1", (3, _BAG))]
    + [(f"set{j}", "u8", w) for j, w in enumerate(_WORDS)]
)


def _bits(entries: np.ndarray, end: np.ndarray, words: int) -> np.ndarray:
    """A bit set of each row's entries."""
    n = len(end) - 1
    at = (entries.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(64 * words)
    on = np.zeros((n, 64 * words), bool)
    on[np.repeat(np.arange(n), np.diff(end)), at.astype(np.int64)] = True
    return np.packbits(on, axis=1).view(np.uint64)


def sketches(texts: list[pa.Array], hashes: pa.Array, known: pa.Array, tokens: list[pa.Array]) -> np.ndarray:
    """texts, in order of _TEXTS; lists of a record's five hashes, and of its four flags; token hashes of name and address."""
    out = np.zeros(len(texts[0]), SKETCH)
    for j, column in enumerate(texts):
        rows = [t or "" for t in column.to_pylist()]
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        points = np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32)
        bag = np.bincount(np.repeat(np.arange(len(rows)), size) * _BAG + points % _BAG, minlength=len(rows) * _BAG)
        out["len"][:, j], out["bag"][:, j] = size, np.minimum(bag, 255).reshape(-1, _BAG)
        out["loose"] |= size > 255
    out["hash"] = hashes.flatten().to_numpy().reshape(-1, len(_HASHED)).astype(np.uint32)
    flags = known.flatten().to_numpy(zero_copy_only=False).astype(np.uint8).reshape(-1, 5)
    out["known"], out["s3"] = flags[:, :3], flags[:, 3]
    out["loose"] |= flags[:, 4]
    for j, ((c, n), words) in enumerate(zip(CLEAN_OVERLAPS.values(), _WORDS, strict=True)):
        text = _TEXTS.index(c)
        entries, end = sets(texts[text], "t", n) if n else sets(tokens[text // 2], "h", 0)
        out["n"][:, j], out[f"set{j}"] = np.diff(end), _bits(entries, end, words)
    return out


def sketched(records: DataFrame) -> DataFrame:
    """Cleaned records with sketch, as unpacked() reads it."""

    @F.arrow_udf("binary")
    def sketch(name: pa.Array, key: pa.Array, addr: pa.Array, hashes: pa.Array, known: pa.Array, of_name: pa.Array, of_addr: pa.Array) -> pa.Array:
        made = sketches([name, key, addr], hashes, known, [of_name, of_addr])
        return pa.array([x.tobytes() for x in made], pa.binary())

    hashes = F.array(*[F.xxhash64(F.coalesce(c, F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF)) for c in _HASHED])
    unknown = F.greatest(*[F.col(c).isNull() for c in [*_HASHED, "country"]])
    known = F.array(*[F.coalesce(F.col(c) != "", F.lit(False)) for c in ("postal_code", "legal_suffix", "country")], F.col("entity_id").startswith("S3-"), unknown)
    tokens = [F.transform(token_set(F.coalesce(c, F.lit(""))), lambda x: F.xxhash64(x)) for c in (_TEXTS[0], _TEXTS[2])]
    return records.withColumn("sketch", sketch(*_TEXTS, hashes, known, *tokens))


def unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), SKETCH)


def _only_in(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Entries of a that b surely lacks."""
    return sum(np.bitwise_count(a[:, w] & ~b[:, w]).astype(np.int32) for w in range(a.shape[1]))


def feature_bounds(a: np.ndarray, b: np.ndarray, shares: list[np.ndarray] | None = None) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """(least, greatest) of every clean feature of pairs, from the sketches of a query and a corpus record; shares: the overlaps, if known."""
    none, made = np.zeros(len(a)), {}
    for j, name in enumerate(CLEAN_OVERLAPS):
        if shares is None:
            n, m = a["n"][:, j], b["n"][:, j]
            both = np.minimum(n - _only_in(a[f"set{j}"], b[f"set{j}"]), m - _only_in(b[f"set{j}"], a[f"set{j}"]))
            empty = ((n == 0) & (m == 0)).astype(float)
            made[name] = empty, np.maximum(both / np.maximum(n + m - both, 1), empty)
        else:
            made[name] = shares[j], shares[j]
    for j, (osa, lcs, gap) in enumerate((("name_dl_ratio", "name_lcs_ratio", "name_len_diff_ratio"), ("blockkey_dl_ratio", None, None), ("addr_dl_ratio", "addr_lcs_ratio", "addr_len_diff_ratio"))):
        n, m = a["len"][:, j], b["len"][:, j]
        both, longer, empty = np.minimum(a["bag"][:, j], b["bag"][:, j]).sum(axis=1, dtype=np.int32), np.maximum(np.maximum(n, m), 1), ((n == 0) & (m == 0)).astype(float)
        made[osa] = empty, np.maximum(both / longer, empty)
        if lcs:
            made[lcs] = empty, np.maximum(2.0 * both / np.maximum(n + m, 1), empty)
            made[gap] = (np.abs(n - m) / longer,) * 2
    for name, j in _EXACT.items():
        there = a["len"][:, j] > 0 if j < 3 else a["known"][:, j - 3] > 0
        made[name] = none, (there & (a["hash"][:, j] == b["hash"][:, j])).astype(float)
    for name, j in _BOTH.items():
        made[name] = ((a["known"][:, j] & b["known"][:, j]).astype(float),) * 2
    made["country_match"] = made["country_both_known"]  # pairs are of one country
    made["source_is_s3"] = (b["s3"].astype(float),) * 2
    loose = (a["loose"] | b["loose"]) > 0
    return {name: (np.where(loose, 0.0, lo) - _SLACK, np.where(loose, 1.0, hi) + _SLACK) for name, (lo, hi) in made.items()}


Node = tuple[int, float, "Node | float", "Node | float"]


def parsed(said: str) -> list[tuple[float, Node | float]] | None:
    """(weight, tree) of each tree of a boosted model's toDebugString; None where that is not understood."""
    lines = [x.strip() for x in said.splitlines() if x.strip()]
    number = r"(-?[\d.]+(?:E-?\d+)?)"
    at, trees = 0, []

    def node() -> Node | float:
        nonlocal at
        line = lines[at]
        at += 1
        if leaf := re.fullmatch(rf"Predict: {number}", line):
            return float(leaf[1])
        split = re.fullmatch(rf"If \(feature (\d+) <= {number}\)", line)
        if not split:
            raise ValueError(line)
        left = node()
        if not re.fullmatch(rf"Else \(feature {split[1]} > {re.escape(split[2])}\)", lines[at]):
            raise ValueError(lines[at])
        at += 1
        return int(split[1]), float(split[2]), left, node()

    try:
        while at < len(lines):
            head = re.fullmatch(rf"Tree {len(trees)} \(weight {number}\):", lines[at])
            at += 1
            if head:
                trees.append((float(head[1]), node()))
            elif trees:
                return None
    except (ValueError, IndexError):
        return None
    return trees or None


@dataclass
class Bounds:
    """The greatest scores of pairs under boosted trees over CLEAN_FEATURES, against the least that counts."""

    trees: list[tuple[float, Node | float]]
    least: float
    columns: list[tuple[str, int, np.ndarray]] = field(default_factory=list)  # feature, 0 for its lower and 1 for its upper bound, thresholds

    @staticmethod
    def of(model, features: list[str], threshold: float) -> Bounds | None:
        """None where the model is not made of such trees: then every pair has to be scored."""
        said = getattr(model, "toDebugString", "")
        trees = parsed(said) if list(features) == CLEAN_FEATURES and said.startswith("GBTClassificationModel") and 0 < threshold < 1 else None
        if not trees or len(trees) != len(model.trees):
            return None
        made = Bounds(trees, math.log(threshold / (1 - threshold)) / 2 - _SLACK)  # score = 1 / (1 + exp(-2 sum))
        return made if made._tabulate() else None

    def _tabulate(self) -> bool:
        splits, leaves = [], []  # of each tree: (feature, threshold, leaves left, leaves right) and values
        for _, tree in self.trees:
            of, values = [], []

            def walk(node: Node | float, of=of, values=values) -> list[int]:
                if isinstance(node, float):
                    values.append(node)
                    return [len(values) - 1]
                left, right = walk(node[2]), walk(node[3])
                of.append((CLEAN_FEATURES[node[0]], node[1], left, right))
                return left + right

            walk(tree)
            if len(values) > 64:
                return False
            splits.append(of)
            leaves.append(values)
        cuts = {f: np.unique([t for of in splits for g, t, _, _ in of if g == f]) for f in CLEAN_FEATURES}
        self.columns = [(f, side, t) for f, t in cuts.items() if len(t) for side in (0, 1)]
        self.groups, size = [], _TABLE + 1
        for j, (_, _, t) in enumerate(self.columns):
            if size * (len(t) + 1) > _TABLE:
                self.groups.append([])
                size = 1
            self.groups[-1].append(j)
            size *= len(t) + 1
        self.values, self.tables = [], []
        for (weight, _), of, values in zip(self.trees, splits, leaves, strict=True):
            order = np.argsort([-weight * v for v in values], kind="stable")
            bit = {int(leaf): 1 << i for i, leaf in enumerate(order)}
            best = [weight * values[leaf] for leaf in order]
            self.values.append(np.array(best + [best[0]] * (65 - len(best))))
            masks = []
            for f, side, t in self.columns:
                mask = [(1 << len(values)) - 1] * (len(t) + 1)
                for g, cut, *below in of:
                    if g == f:
                        gone, j = sum(bit[leaf] for leaf in below[side]), int(np.searchsorted(t, cut))
                        for k in range(j + 1, len(t) + 1) if side == 0 else range(j + 1):  # k thresholds lie below the bound
                            mask[k] &= ~gone
                masks.append(np.array(mask, np.uint64))
            tables = []
            for group in self.groups:
                table = np.array([~np.uint64(0)])
                for j in group:
                    table = (table[:, None] & masks[j][None, :]).ravel()
                tables.append(table)
            self.tables.append(tables)
        self.rest = np.append(np.cumsum([v[0] for v in self.values][::-1])[::-1], 0.0)
        return True

    def may_reach(self, a: np.ndarray, b: np.ndarray, shares: list[np.ndarray] | None = None) -> np.ndarray:
        """Whether each pair may score the least or more."""
        bounds = feature_bounds(a, b, shares)
        codes = []
        for group in self.groups:
            code = np.zeros(len(a), np.int64)
            for f, side, t in (self.columns[j] for j in group):
                code = code * (len(t) + 1) + np.searchsorted(t, bounds[f][side], "left")
            codes.append(code)
        out, where, most = np.zeros(len(a), bool), np.arange(len(a)), np.zeros(len(a))
        for k, (tables, values) in enumerate(zip(self.tables, self.values, strict=True)):
            if k % _TREES == 0 and k:
                on = most + self.rest[k] >= self.least
                if on.sum() < 0.8 * len(on):
                    where, most, codes = where[on], most[on], [c[on] for c in codes]
            if not len(where):
                break
            open_ = np.full(len(where), ~np.uint64(0)) if not tables else tables[0][codes[0]]
            for table, code in zip(tables[1:], codes[1:], strict=True):
                open_ &= table[code]
            best = np.bitwise_count((open_ & (~open_ + np.uint64(1))) - np.uint64(1))
            most += values[best]
        out[where[most >= self.least]] = True
        return out
