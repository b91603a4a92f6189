"""Operator 3: language-model scoring by logistic mixing of context bit predictors.

A text is the sequence of its UTF-8 bytes and a closing 255; a byte is eight binary decisions. For each
order in ORDERS there is a predictor for that many bytes before and the bits of this byte so far: how
often a 0 and a 1 came there in all learning texts. Their log-odds are combined by a set of weights
gated by bit position and by how much the predictors have seen; an adaptive table then maps the mixed
log-odds to the frequency met. Weights and table are fitted on every byte of all learning texts: equal
windows have equal predictors, so a byte counts by its window and how often that was learned. PASSES Newton
steps from even weights, each from sums over all windows (a few thousand numbers); the table has the
frequencies of the last pass. Of each window's counts its own occurrence is taken off meanwhile.

The counts are exact, and their table grows with the corpus: one row for each distinct window (a byte
and the five before it), from a grouped sum. All predictors are sums over windows that share their last
bytes. Windows are dealt by the last three bytes before; what shorter contexts need is a table of the
strings of three bytes met, 2**24 at most, whatever the corpus.

The probability of a byte depends on its window only, so it is worked out once a distinct window. The
HEAD_WINDOWS most frequent windows are looked up in the tasks; rarer ones go through a join.

The base score is the add-one unigram score of the text's words (A-Z lower-cased) and one end token.
The HEAD most frequent words are looked up in the tasks (a table of fixed size); rarer ones go through
a join on the word's 64-bit hash, already added up within a text.

Defined cases: a null text is empty (its end token and closing byte are scored); no learning text at
all: every predictor is even, N is 0; repeated rows count as often as they occur; rows are told apart by a
64-bit hash of key and text (of 10^10 different rows about three pairs would share one); further columns are
not carried.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, arrow, chunks, keep, owners, shelve, text_bytes, unshelve, words, worker

#: Bytes before that address a predictor; "word": those of the present word, as far as REACH goes.
ORDERS = (1, 2, 3, 4, 5, "word")
#: Of these, the amount seen gates the weights.
GATES = (3, 4, 5)
#: Of a small model that is given as a table of hashed predictors (see Mixer).
SLOT_BITS = 20
REACH = 6
#: Newton steps, and how much a weight is held to where it began, in bits seen.
PASSES, RIDGE = 3, 20.0
#: Rows of a batch that goes back to Spark.
_ROWS = 100_000
HEAD = 65_536
#: Windows looked up in the tasks, by a table of 2**MEMORY_BITS places first.
HEAD_WINDOWS, MEMORY_BITS = 1 << 20, 21
#: Windows mixed at once.
_STEP = 50_000
_STEPS = 33


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each byte and closing 255 with the bytes before it, as one number; text's row)."""
    n = len(offsets) - 1
    pad = REACH - 1
    last = offsets[1:] + np.arange(n) * (pad + 1)  # of each closing byte; behind it zeros, which the next text has before it
    flat = np.zeros(pad + len(data) + n * (pad + 1), np.uint8)
    here = flat[pad:]
    body = np.ones(len(here), bool)
    body[(last[:, None] + np.arange(pad + 1)).ravel()] = False
    here[body], here[last], body[last] = data, 255, True
    win = here.astype(U64)
    for j in range(1, REACH):
        win |= flat[pad - j : pad - j + len(here)].astype(U64) << U64(8 * j)
    return win[body], np.repeat(np.arange(n), np.diff(offsets) + 1)


def contexts(win: np.ndarray) -> list[np.ndarray]:
    """For each order, the hashed bytes before."""
    before = win >> U64(8)
    return [(before & (_word_mask(before) if order == "word" else U64((1 << 8 * order) - 1))) * U64(0x9E3779B97F4A7C15) + U64(k) for k, order in enumerate(ORDERS)]


def nodes(win: np.ndarray, bit: int) -> np.ndarray:
    """Hash of the bits of the last byte before its bit-th decision."""
    return ((U64(1) << U64(bit)) | (win & U64(255)) >> U64(8 - bit)) * U64(0xD1342543DE82EF95)


def slots(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Of one order: the predictor of a decision."""
    h = context + node
    h ^= h >> U64(32)
    h *= U64(0xBF58476D1CE4E5B9)
    h >>= U64(64 - SLOT_BITS)
    return h.view(np.int64)


def _word_mask(before: np.ndarray) -> np.ndarray:
    """Of the bytes before, those behind the last white space, and that one."""
    mask = np.zeros(len(before), U64)
    inside = np.ones(len(before), bool)
    for j in range(REACH - 1):
        byte = before >> U64(8 * j) & U64(255)
        mask[inside] |= U64(255 << 8 * j)
        inside &= ~((byte == U64(32)) | ((byte >= U64(9)) & (byte <= U64(13))) | (byte == U64(0)))
    return mask


def _distinct(win: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct windows and the sums of their weights; quick where the windows are a few sorted runs."""
    order = np.argsort(win, kind="stable")
    win = win[order]
    head = np.flatnonzero(np.concatenate([[True], win[1:] != win[:-1]])) if len(win) else np.empty(0, np.int64)
    return win[head], *(np.add.reduceat(w[order], head) if len(head) else w for w in weights)


@worker("bit_mixer")
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each task: distinct windows, how often they came, and how often in learning texts."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    keys: list[np.ndarray] = []

    def settle() -> None:
        key = np.sort(np.concatenate(keys))
        keys.clear()
        win = key >> U64(1)
        head = np.flatnonzero(np.concatenate([[True], win[1:] != win[:-1]]))
        held.append((win[head], np.diff(np.append(head, len(win))), np.add.reduceat((key & U64(1)).view(np.int64), head)))

    for part in chunks(batches, limit=1 << 19):
        win, row = windows(*text_bytes(part.column(0)))
        taught = part.column(1).to_numpy(zero_copy_only=False).astype(U64)
        keys.append(win << U64(1) | taught[row])
        if sum(map(len, keys)) < 1 << 21:
            continue
        settle()
        if sum(len(h[0]) for h in held) > 1_200_000:
            held = [_distinct(*map(np.concatenate, zip(*held, strict=True)))]
            if len(held[0][0]) > 800_000:
                yield from _sliced(["win", "n", "m"], held[0][0].view(np.int64), held[0][2], held[0][1])
                held = []
    if keys:
        settle()
    if held:
        win, m, n = _distinct(*map(np.concatenate, zip(*held, strict=True)))
        yield from _sliced(["win", "n", "m"], win.view(np.int64), n, m)


def _sliced(names: list[str], *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), _ROWS):
        yield arrow(names, [c[at : at + _ROWS] for c in columns])


def window_counts(docs: DataFrame) -> DataFrame:
    """(win, n, m): how often each window of the texts (text, learned) came in learning texts, and in all. Grows with the corpus."""
    return docs.select("text", "learned").mapInArrow(_count, "win bigint, n bigint, m bigint").groupBy("win").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def _nested(key: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(keys, 9): of sorted keys, context and byte: how often the context and the first b bits of the byte came, for b of 0 to 8."""
    out = np.zeros((len(key), 9))
    for b in range(9 if len(key) else 0):
        k = key >> U64(8 - b)
        head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        out[:, b] = np.repeat(np.add.reduceat(n, head), np.diff(np.append(head, len(k))))
    return out


def _tail(win: np.ndarray, order: int) -> np.ndarray:
    """The byte and `order` bytes before."""
    return win & U64((1 << 8 * (order + 1)) - 1)


class Evidence:
    """Exact predictors of all orders from windows and how often each was learned; `low` has (keys, counts) of orders that are already known."""

    def __init__(self, win: np.ndarray, n: np.ndarray, low: dict[int, tuple[np.ndarray, np.ndarray]] | None = None):
        self.tables = dict(low or {})
        for order in range(1, REACH):
            if order not in self.tables:
                key, total = _distinct(_tail(win, order), n)
                self.tables[order] = key, _nested(key, total)

    def of(self, win: np.ndarray) -> np.ndarray:
        """(windows, orders, 9): the counts of _nested at each of these windows, which are among those given. A word's context is that of as many bytes as it has."""
        every = np.zeros((len(win), REACH - 1, 9))
        for order, (key, count) in self.tables.items():
            every[:, order - 1] = count[np.searchsorted(key, _tail(win, order))]
        return _by_order(every, win)


def _by_order(every: np.ndarray, win: np.ndarray) -> np.ndarray:
    mask = _word_mask(win >> U64(8))
    length = np.sum([mask >> U64(8 * j) & U64(1) for j in range(REACH - 1)], axis=0).astype(np.int64)
    return np.stack([every[np.arange(len(win)), length - 1] if order == "word" else every[:, order - 1] for order in ORDERS], axis=1)


def _low(counts: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Predictors of orders 1 and 2, from the strings of three bytes that were met."""
    met = counts.groupBy(F.col("win").bitwiseAND((1 << 24) - 1).alias("win")).agg(F.sum("n").alias("n")).toArrow()
    win, n = met["win"].to_numpy().view(U64), met["n"].to_numpy()
    made = {}
    for order in (1, 2):
        key, total = _distinct(_tail(win, order), n)
        made[order] = key, total
    return made


def _whole_contexts(batches: Iterator[pa.RecordBatch], low: dict) -> Iterator[tuple[np.ndarray, Evidence]]:
    """Of windows (c, win, n) sorted by c, the last three bytes before: windows and evidence for them, by whole values of c."""
    low = {order: (key, _nested(key, n)) for order, (key, n) in low.items()}
    held: list[pa.RecordBatch] = []

    def made(table: pa.Table) -> tuple[np.ndarray, Evidence]:
        win = table["win"].to_numpy().view(U64)
        return win, Evidence(win, table["n"].to_numpy(), low)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= 2 * _STEP and (batch.column(0)[-1] != held[0].column(0)[0]):
            table = pa.Table.from_batches(held)
            c = table["c"].to_numpy()
            cut = int(np.searchsorted(c, c[-1]))
            yield made(table.slice(0, cut))
            held = table.slice(cut).to_batches()
    if held:
        yield made(pa.Table.from_batches(held))


def _fitted(low, mixer: Mixer):
    """Mixer.told of all learned windows of a part, as rows (k, v) of the numbers that are not 0."""

    @worker("bit_mixer")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = np.zeros(_TOLD)
        for win, evidence in _whole_contexts(batches, low.value):
            own, times = evidence.tables[REACH - 1]  # each window once, and how often it was learned
            taught = np.flatnonzero(times[:, 8] > 0)
            for at in range(0, len(taught), _STEP):
                some = taught[at : at + _STEP]
                w = own[some]
                told += mixer.told(w, times[some, 8], evidence.of(w))
        k = np.flatnonzero(told)
        yield arrow(["k", "v"], [k, told[k]])

    return run


def _mixed(low, mixer: Mixer):
    """Each window with the log10 of its chance."""

    @worker("bit_mixer")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for win, evidence in _whole_contexts(batches, low.value):
            for at in range(0, len(win), _STEP):
                w = win[at : at + _STEP]
                yield arrow(["win", "p"], [w.view(np.int64), mixer.log10(w, evidence.of(w))])

    return run


_CELLS, _WIDTH = 8 * 3 ** len(GATES), len(ORDERS) + 1
_TOLD = _CELLS * (_WIDTH * _WIDTH + _WIDTH + 1) + 8 * 2 * _STEPS
_EVEN = np.tile(1 / (1 + np.exp(-np.linspace(-8, 8, _STEPS))), (8, 1)).astype(np.float32)


def _views(told: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Curvature, slope, loss by cell, and (bit, came or all, place) of the table."""
    a, b, c = _CELLS * _WIDTH * _WIDTH, _CELLS * _WIDTH * (_WIDTH + 1), _CELLS * (_WIDTH * (_WIDTH + 1) + 1)
    return told[:a].reshape(_CELLS, _WIDTH, _WIDTH), told[a:b].reshape(_CELLS, _WIDTH), told[b:c], told[c:].reshape(8, 2, _STEPS)


def _by_bit(counts: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.moveaxis(counts, 2, 0))


class Mixer:
    """Gated weights and the adaptive table. `n` is for small models: (orders, 2**SLOT_BITS, 2) hashed predictors, used where no counts are given."""

    def __init__(self, n: np.ndarray | None = None):
        self.n = n
        self.weights = np.full((_CELLS, _WIDTH), 0.3, np.float32)
        self.weights[:, -1] = 0
        self.table = _EVEN.copy()

    def inputs(self, win: np.ndarray, bit: int, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(log-odds of the predictors and a 1, cell of the gate). counts: (9, windows, orders)."""
        if counts is None:
            node = nodes(win, bit)
            seen = np.stack([self.n[k][slots(c, node)] for k, c in enumerate(contexts(win))], axis=1)
            none, one = seen[..., 0], seen[..., 1]
        else:
            same, all_ = counts[bit + 1], counts[bit]
            came = (win >> U64(7 - bit) & U64(1)).astype(bool)[:, None]
            one = np.where(came, same, all_ - same)
            none = all_ - one
        x = np.ones((len(win), len(ORDERS) + 1), np.float32)
        x[:, :-1] = np.log((one + 0.4) / (none + 0.4))
        gate = np.full(len(win), bit)
        for k in GATES:
            seen = one[:, k] + none[:, k]
            gate = gate * 3 + (seen >= 1) + (seen >= 8)
        return x, gate

    def probability(self, x: np.ndarray, gate: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(mixed, refined, cell, share of the next cell) chance of a 1."""
        z = np.einsum("nk,nk->n", x, self.weights[gate])
        z = np.clip(z, -8, 8)
        mixed = 1 / (1 + np.exp(-z))
        at = (z + 8) * (_STEPS - 1) / 16
        cell = np.minimum(at.astype(np.int64), _STEPS - 2)
        part = (at - cell).astype(np.float32)
        refined = self.table[bit, cell] * (1 - part) + self.table[bit, cell + 1] * part
        return mixed, refined, cell, part

    def told(self, win: np.ndarray, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of windows that were learned n times: by cell of the gate the sums of curvature, slope and loss, by place of the table what came and how much. Sums of parts add up."""
        curve, slope, loss, table = _views(told := np.zeros(_TOLD))
        counts = _by_bit(counts) - 1  # their own occurrence
        for bit in range(8):
            x, gate = self.inputs(win, bit, counts)
            came = (win >> U64(7 - bit) & U64(1)).astype(np.float64)
            mixed, _, cell, part = self.probability(x, gate, bit)
            for c, share in ((cell, n * (1 - part)), (cell + 1, n * part)):
                table[bit, 0] += np.bincount(c, share * came, _STEPS)
                table[bit, 1] += np.bincount(c, share, _STEPS)
            away, weight = n * (mixed - came), n * mixed * (1 - mixed)
            lost = -n * np.log(np.where(came > 0, mixed, 1 - mixed))
            order = np.argsort(gate.astype(np.uint8), kind="stable")
            ends = np.flatnonzero(np.diff(gate[order], append=-1)) + 1
            for a, b in zip([0, *ends[:-1]], ends, strict=True):
                some = order[a:b]
                seen, g = x[some].astype(np.float64), gate[some[0]]
                curve[g] += seen.T @ (seen * weight[some, None])
                slope[g] += away[some] @ seen
                loss[g] += lost[some].sum()
        return told

    def learn(self, told: np.ndarray, before: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """A Newton step from the sums over all learned windows, and the table of their frequencies. Cells whose last step made it worse take half of that step back instead. Gives (weights, losses) before it."""
        curve, slope, loss, table = _views(told)
        even = Mixer().weights.astype(np.float64)
        now = self.weights.astype(np.float64)
        own = loss + RIDGE / 2 * ((now - even) ** 2).sum(1)
        made = now - np.linalg.solve(curve + RIDGE * np.eye(now.shape[1]), (slope + RIDGE * (now - even))[..., None])[..., 0]
        if before is not None:
            worse = own > before[1]
            made[worse] = (now[worse] + before[0][worse]) / 2
        self.weights = made.astype(np.float32)
        self.table = ((table[:, 0] + 50 * _EVEN) / (table[:, 1] + 50)).astype(np.float32)
        return now, own

    def log10(self, win: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
        """log10 of the chance of each window's last byte."""
        out = np.zeros(len(win))
        counts = None if counts is None else _by_bit(counts)
        for bit in range(8):
            x, gate = self.inputs(win, bit, counts)
            mixed, refined, _, _ = self.probability(x, gate, bit)
            p = np.clip((mixed + refined) / 2, 1 / 4096, 1 - 1 / 4096)
            out += np.log10(np.where(win >> U64(7 - bit) & U64(1), p, 1 - p))
        return out


_MEMORY: dict[str, tuple[_Known, _Known]] = {}
keep("bit_mixer", _MEMORY.clear)


class _Known:
    """Values of distinct keys: by two tables of places, and those that find no place of their own by search."""

    def __init__(self, known: np.ndarray, value: np.ndarray):
        self.tables = []
        for bits in (MEMORY_BITS, MEMORY_BITS - 1):
            bits = min(bits, max(1, len(known)).bit_length() + 1)
            table = np.zeros((1 << bits, 2), U64)
            at = self._place(known, bits)
            table[at, 0], table[at, 1] = known + U64(1), value.astype(np.float64).view(U64)  # of keys with one place the last one stays
            self.tables.append((bits, table))
            out = table[at, 0] != known + U64(1)
            known, value = known[out], value[out]
        self.known, self.value = known, value

    def _place(self, key: np.ndarray, bits: int) -> np.ndarray:
        return ((key + U64(bits)) * U64(0xD1342543DE82EF95) >> U64(64 - bits)).view(np.int64)

    def look(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value or 0, whether it is known) of each key."""
        value, hit, rest = np.zeros(len(key)), np.zeros(len(key), bool), None
        for bits, table in self.tables:
            k = key if rest is None else key[rest]
            got = table.take(self._place(k, bits), axis=0)
            on = got[:, 0] == k + U64(1)
            on &= got[:, 0] != U64(0)
            if rest is None:
                hit, value = on, np.where(on, got[:, 1], U64(0)).view(np.float64)
                rest = np.flatnonzero(~on)
            else:
                hit[rest[on]], value[rest[on]] = True, got[on, 1].view(np.float64)
                rest = rest[~on]
        if len(rest) and len(self.known):
            k = key[rest]
            at = np.minimum(np.searchsorted(self.known, k), len(self.known) - 1)
            on = self.known[at] == k
            hit[rest[on]], value[rest[on]] = True, self.value[at[on]]
        return value, hit


def _of_head(head, words_of, name: str) -> tuple[_Known, _Known]:
    """Frequent windows and words with the log10 of their chances."""
    if name not in _MEMORY:
        _MEMORY.clear()
        _MEMORY[name] = _Known(*head.value), _Known(*words_of.value)
    return _MEMORY[name]


def _score(head, words_of, name: str):
    """Of each text: the sums over its frequent windows and words, and its rarer windows and words with how often each comes."""

    @worker("bit_mixer")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, frequent_words = _of_head(head, words_of, name)
        for part in chunks(batches, limit=1 << 19):
            data, offsets = text_bytes(part.column(3))
            win, row = windows(data, offsets)
            p, hit = frequent.look(win)
            score = np.bincount(row, p, part.num_rows).astype(float)
            rest = np.flatnonzero(~hit)
            far, far_n = _by_text(win[rest], row[rest], part.num_rows)
            del win, p, hit, rest
            w = words(data, offsets, lower=True)
            row, (p, hit) = owners(w.first), frequent_words.look(w.hash)
            base = np.bincount(row, p, part.num_rows).astype(float)
            rare, rare_n = _by_text(w.hash[~hit], row[~hit], part.num_rows)
            columns = [*part.columns[:3], np.diff(offsets), score, np.diff(w.first), np.bincount(row[hit], minlength=part.num_rows), base, far, far_n, rare, rare_n]
            yield arrow(["key", "learned", "uid", "n_bytes", "score", "n_words", "n_frequent", "base", "far", "far_n", "rare", "rare_n"], columns)

    return run


def _by_text(value: np.ndarray, row: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """For each of n texts the list of its distinct values, and of how often each comes."""
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])])) if len(value) else np.empty(0, np.int64)
    ends = np.searchsorted(row[first], np.arange(n + 1)).astype(np.int32)
    return tuple(pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (value[first].view(np.int64), np.diff(np.append(first, len(value))).astype(np.int64)))


@worker("bit_mixer")
def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    for part in chunks(batches):
        held.append(words(*text_bytes(part.column(0)), lower=True).hash)
        if sum(map(len, held)) > 1_000_000:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held = []
            yield from _sliced(["h", "n"], h.view(np.int64), n)
    if held:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        yield from _sliced(["h", "n"], h.view(np.int64), n)


def _head(spark, seen: DataFrame, chance: DataFrame):
    """(broadcast (windows, log10 of their chances) of at most HEAD_WINDOWS, the most frequent ones; whether there are others)."""
    level = F.floor(F.log2(F.col("m")) * 8).cast("int")
    of_level = sorted(((r.level, r["count"]) for r in seen.groupBy(level.alias("level")).count().collect()), reverse=True)
    least, size = 1 << 30, 0
    for at, count in of_level:
        if size + count > HEAD_WINDOWS:
            break
        least, size = at, size + count
    top = seen.where(level >= least).select("win").join(chance, "win").toArrow()
    win, p = top["win"].to_numpy().view(U64), top["p"].to_numpy()
    order = np.argsort(win)
    return spark.sparkContext.broadcast((win[order], p[order])), size < sum(count for _, count in of_level)


def score_texts(df: DataFrame, learn: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, learned, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every row; rows where the SQL condition `learn` holds are learned from."""
    spark = df.sparkSession
    docs = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.expr(learn), F.lit(False)).alias("learned"))
    docs = docs.withColumn("uid", F.xxhash64("key", "text"))
    lesson = docs.where("learned").select("text")

    seen = shelve(window_counts(docs))
    low = spark.sparkContext.broadcast(_low(seen))
    dealt = seen.select(F.shiftright("win", 8).bitwiseAND((1 << 24) - 1).alias("c"), "win", "n").repartition("c").sortWithinPartitions("c")
    mixer, before = Mixer(), None
    for _ in range(PASSES):
        sums = dealt.mapInArrow(_fitted(low, mixer), "k bigint, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()
        told = np.zeros(_TOLD)
        told[sums["k"].to_numpy()] = sums["v"].to_numpy()
        before = mixer.learn(told, before)
    chance = shelve(dealt.mapInArrow(_mixed(low, mixer), "win bigint, p double"))
    head, rest = _head(spark, seen, chance)
    name = uuid.uuid4().hex

    counts = shelve(lesson.mapInArrow(_word_counts, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")))
    ends = docs.where("learned").count()
    sums = counts.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    total, distinct = (sums.n or 0) + ends, sums.v + (ends > 0)
    floor = math.log10(total + distinct + 1)
    top = counts.orderBy(F.desc("n"), "h").limit(HEAD).toArrow()
    h, log_p = top["h"].to_numpy().view(U64), np.log10(top["n"].to_numpy() + 1.0) - floor
    order = np.argsort(h)
    shared = spark.sparkContext.broadcast((h[order], log_p[order]))
    kind = T.StructType([T.StructField("key", docs.schema["key"].dataType), T.StructField("learned", T.BooleanType())])
    for type_, fields in ((T.LongType(), ["uid", "n_bytes"]), (T.DoubleType(), ["score"]), (T.LongType(), ["n_words", "n_frequent"]), (T.DoubleType(), ["base"]), (T.ArrayType(T.LongType()), ["far", "far_n", "rare", "rare_n"])):
        for field in fields:
            kind = kind.add(field, type_)
    of_text = shelve(docs.select("key", "learned", "uid", "text").mapInArrow(_score(head, shared, name), kind))
    listed = lambda c, value: of_text.select("uid", F.explode(F.arrays_zip(c, f"{c}_n")).alias("x")).select("uid", F.col(f"x.{c}").alias(value), F.col(f"x.{c}_n").alias("times"))
    found = listed("rare", "h").join(counts.select("h", F.col("n").alias("c")), "h", "left")
    of_word = F.col("times") * (F.log10(F.coalesce("c", F.lit(0)) + 1.0) - floor)
    more = found.select("uid", of_word.alias("rare_base"), F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0).alias("n_rare"), F.lit(0.0).alias("further"), F.lit(0).alias("texts"))
    more = more.unionByName(of_text.select("uid", F.lit(0.0).alias("rare_base"), F.lit(0).cast("bigint").alias("n_rare"), F.lit(0.0).alias("further"), F.lit(1).alias("texts")))
    if rest:
        far = listed("far", "win").join(chance, "win")
        more = more.unionByName(far.select("uid", F.lit(0.0).alias("rare_base"), F.lit(0).cast("bigint").alias("n_rare"), (F.col("times") * F.col("p")).alias("further"), F.lit(0).alias("texts")))
    rare = more.groupBy("uid").agg(*[F.sum(c).alias(c) for c in ("rare_base", "n_rare", "further", "texts")])
    joined = of_text.drop("far", "far_n", "rare", "rare_n").join(rare, "uid").withColumn("score", F.col("score") + F.col("further") / F.col("texts"))
    return joined.select(
        F.col("key").alias(key),
        "learned",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_frequent") + (F.col("n_rare") / F.col("texts")).cast("bigint") + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.col("rare_base") / F.col("texts") + (math.log10(ends + 1) - floor)).alias("base_score"),
        "score",
        (-F.col("score") * math.log2(10) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )
