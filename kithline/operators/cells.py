"""The best candidates of each record without a shuffle of pairs.

Query records are dealt into parts of a country. Each part meets all corpus records of its country in one
task, in id order: they come by one shuffle, a row a corpus record and part, and pairs exist only in the
task, a few million at a time; of them the best k a record stay. What is asked of the pairs' records (texts)
comes behind them in the same stream, so no join has to carry it to the pairs either; overlaps of their sets of
tokens or n-grams are counted there, each set made once a record. A task holds one part: its keys, sets,
k places a record, and the ids of the country's corpus.

Keys are told apart by a 64-bit hash of signal and key, tokens by one of the token, n-grams of 3 at most by themselves. Frequent keys are counted by Spark and come with the part.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import similarity as S
from ..functions.keys import token_set
from .blocking import ALL, Signal, frequent_keys, scores, top_candidates
from .bounds import Bounds, sketched, unpacked
from .sets import sets as _sets
from .sets import spread as _spread

#: Records of a part at most; parts of a country at least, where each has MIN_PART records.
MAX_PART, PARTS, MIN_PART = 65_536, 6, 128
#: Corpus records met at once; cells and shared keys counted at once; rows of a batch that goes back; lists likewise; pairs bounded at once.
_CORPUS, _CELLS, _MET, _ROWS, _LISTS, _BOUND = 8_192, 1 << 20, 1 << 20, 10_000, 256, 16_384
_QUERY, _FREQUENT, _KEYS, _TEXT = range(4)
_NAMES = [s.name for s in ALL]


def _hashed(side: str) -> list[Column]:
    def of(signal: Signal) -> Column:
        return F.transform(getattr(signal, side)(), lambda key: F.xxhash64(F.lit(signal.name), key))

    return list(map(of, ALL))


def _changes(ids: pa.Array, last: str | None) -> np.ndarray:
    """Whether each id differs from the one before it."""
    new = np.ones(len(ids), bool)
    new[1:] = pc.not_equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)
    new[0] = ids[0].as_py() != last
    return new


class _Shares:
    """Shared entries over all, of pairs of a part's sets and those of corpus records."""

    def __init__(self, rows, kind: str, n: int):
        self.kind, self.n = kind, n
        flat, self.end = _sets(rows, kind, n)
        self.known, self.entry = np.unique(flat, return_inverse=True)
        self.size = np.diff(self.end)

    def of(self, left: np.ndarray, right: np.ndarray, rows) -> np.ndarray:
        """For pairs in order of `right`, a place in rows."""
        flat, end = _sets(rows, self.kind, self.n)
        at = np.searchsorted(self.known, flat)
        at[at == len(self.known)] = 0
        on = self.known[at] == flat if len(self.known) else np.zeros(len(flat), bool)
        owner, at = np.repeat(np.arange(len(rows)), np.diff(end))[on], at[on]
        width, both = max(1, len(self.known)), np.zeros(len(left), np.int64)
        step = max(1, _MET // width)
        for first in range(0, len(rows), step):
            a, b = np.searchsorted(right, [first, first + step])
            mine = slice(*np.searchsorted(owner, [first, first + step]))
            has = np.zeros(min(step, len(rows) - first) * width, np.int8)
            has[(owner[mine] - first) * width + at[mine]] = 1
            for c in range(a, b, _MET // 64):
                some = slice(c, min(b, c + _MET // 64))
                n = self.size[left[some]]
                hit = has[np.repeat((right[some] - first) * width, n) + self.entry[_spread(self.end[left[some]], n)]]
                total = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
                ends = np.cumsum(n)
                both[some] = total[ends] - total[ends - n]
        n, m = self.size[left], np.diff(end)[right]
        return np.where((n == 0) & (m == 0), 1.0, np.where((n == 0) | (m == 0), 0.0, both / np.maximum(n + m - both, 1)))


class _Part:
    """Query records of one part, and the best candidates of each so far."""

    def __init__(self, k: int, min_ngrams: int, min_address: int, texts: list[int], overlaps: list[tuple[str, int, int]]):
        self.k, self.min_ngrams, self.min_address, self.texts, self.overlaps = k, min_ngrams, min_address, texts, overlaps
        self.rows, self.frequent, self.waiting, self.ids = [], [], [], []
        self.last, self.base, self.ready, self.ended, self.at, self.last_text = None, 0, False, False, -1, None

    def add(self, kind: int, batch: pa.RecordBatch) -> Iterator[dict]:
        if kind == _QUERY:
            self.rows.append(batch)
        elif kind == _FREQUENT:
            self.frequent.append(batch.column("keys").flatten().to_numpy())
        elif kind == _KEYS:
            self.waiting.append(batch)
            if sum(b.num_rows for b in self.waiting) >= _CORPUS:
                self._meet()
        else:
            self._end()
            yield from self._with_texts(batch)

    def close(self) -> Iterator[dict]:
        self._end()
        if not self.texts and not self.overlaps:
            for at in range(0, len(self.row), _ROWS):
                some = slice(at, at + _ROWS)
                yield self._columns(self.row_ids.take(pa.array(self.row[some])), self.cand_ids.take(pa.array(self.place[some])), np.arange(at, min(at + _ROWS, len(self.row))))

    def _columns(self, s1: pa.Array, cand: pa.Array, pair: np.ndarray) -> dict:
        return {"s1_id": s1, "cand_id": cand, "score": pa.array(self.score[pair]), "rank": pa.array(self.rank[pair])}

    def _begin(self) -> None:
        self.ready = True
        self.row, self.place, self.score = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0)
        self.new, self.held = [], 0
        self.query = pa.Table.from_batches(self.rows).combine_chunks() if self.rows else None
        self.rows = []
        if (local := self._known()) is None:
            return
        keys = pa.concat_arrays(self.query["keys"].chunks)
        size = pc.fill_null(pc.list_value_length(keys), 0).to_numpy()
        flat = keys.flatten().to_numpy()
        sizes = pa.concat_arrays(self.query["sizes"].chunks).flatten().to_numpy()  # of the signals, none where keys are null
        signal = np.repeat(np.tile(np.arange(len(ALL)), len(sizes) // len(ALL)), sizes)
        row = np.repeat(local, size)
        if self.frequent:
            on = ~np.isin(flat, np.concatenate(self.frequent))
            flat, signal, row = flat[on], signal[on], row[on]
        self.vocabulary, self.key = np.unique(flat, return_inverse=True)
        self.signal = signal.astype(np.int64)
        self.first = np.searchsorted(row, np.arange(self.n + 1))
        self.owner = row
        self.least = np.full(self.n, -np.inf)

    def _known(self) -> np.ndarray | None:
        """The place of each query row among the part's distinct ids."""
        if self.query is None:
            self.n, self.row_ids = 0, pa.array([], pa.string())
            return None
        ids = pa.concat_arrays(self.query["entity_id"].chunks)
        first = _changes(ids, None)
        local = np.cumsum(first) - 1
        self.n, self.row_ids = int(local[-1]) + 1, ids.filter(pa.array(first))
        self.row_start, self.row_count = np.flatnonzero(first), np.diff(np.append(np.flatnonzero(first), len(ids)))
        return local

    def _meet(self) -> None:
        """Count what the waiting corpus records share with the part."""
        if not self.ready:
            self._begin()
        table = pa.Table.from_batches(self.waiting)
        self.waiting = []
        if not table.num_rows:
            return
        ids = pa.concat_arrays(table["entity_id"].chunks)
        new = _changes(ids, self.last)
        self.last = ids[-1].as_py()
        place = self.base + np.cumsum(new) - 1  # of the distinct ids
        self.ids.append(ids.filter(pa.array(new)))
        self.base = int(place[-1]) + 1
        if not self.n or not len(self.vocabulary):
            return
        keys = pa.concat_arrays(table["keys"].chunks)
        flat, owner = keys.flatten().to_numpy(), np.repeat(place - place[0], pc.fill_null(pc.list_value_length(keys), 0).to_numpy())
        at = np.searchsorted(self.vocabulary, flat)
        at[at == len(self.vocabulary)] = 0
        known = self.vocabulary[at] == flat
        at, owner = at[known], owner[known]
        owner = owner[np.argsort(at, kind="stable")]
        count = np.bincount(at, minlength=len(self.vocabulary))
        start = np.cumsum(count) - count
        n, width = count[self.key], int(place[-1] - place[0]) + 1
        met = np.concatenate([[0], np.cumsum(n)])[self.first]  # before each query record
        most, a = max(1, _CELLS // width), 0
        while a < self.n:
            b = min(a + most, max(a + 1, int(np.searchsorted(met, met[a] + _MET, "right")) - 1), self.n)
            self._count(a, b, n, start, owner, width, int(place[0]))
            a = b
        if self.held > max(1 << 20, self.n * self.k // 2):
            self._settle()

    def _count(self, a: int, b: int, n: np.ndarray, start: np.ndarray, owner: np.ndarray, width: int, base: int) -> None:
        some = slice(self.first[a], self.first[b])
        times = n[some]
        if not times.any():
            return
        code = np.repeat((self.owner[some] - a) * width, times) + owner[_spread(start[self.key[some]], times)]
        cell = np.flatnonzero(np.bincount(code, minlength=(b - a) * width))
        where = np.empty((b - a) * width, np.int64)
        where[cell] = np.arange(len(cell)) * len(ALL)
        shared = np.bincount(where[code] + np.repeat(self.signal[some], times), minlength=len(cell) * len(ALL)).reshape(-1, len(ALL))
        token, ngram, address, postal = (shared[:, _NAMES.index(s)] for s in ("token", "ngram", "address", "postal"))
        grams, words = ngram >= self.min_ngrams, (address >= self.min_address) & (address > 0)
        points = np.where(token > 0, 3.0, 0.0) + np.where(grams, ngram * 0.2, 0.0) + np.where(words, address * 2.0, 0.0) + postal * 10.0
        row = cell // width + a
        on = np.flatnonzero(((token > 0) | grams | words | (postal > 0)) & (points > self.least[row]))  # later ids lose ties
        self.new.append((row[on].astype(np.int32), (cell[on] % width + base).astype(np.int32), points[on]))
        self.held += len(on)

    def _settle(self) -> None:
        """Keep the best k of each record; of equal scores the smaller ids, which came first."""
        row, place, score = (np.concatenate([x, *y]) for x, y in zip((self.row, self.place, self.score), zip(*self.new, strict=True), strict=True)) if self.new else (self.row, self.place, self.score)
        self.new, self.held = [], 0
        order = np.lexsort((-score, row))
        row = row[order]
        first = np.searchsorted(row, np.arange(self.n + 1))
        rank = np.arange(len(row)) - first[row] + 1
        on = rank <= self.k
        order = order[on]
        self.row, self.place, self.score, self.rank = row[on], place[order], score[order], rank[on].astype(np.int32)
        full = np.flatnonzero(np.diff(first) >= self.k)
        self.least[full] = self.score[np.searchsorted(self.row, full) + self.k - 1]

    def _end(self) -> None:
        if self.ended:
            return
        self.ended = True
        if self.waiting:
            self._meet()
        if not self.ready:
            self._begin()
        self.rank = np.empty(0, np.int32)
        if self.n:
            self._settle()
        self.cand_ids = pa.concat_arrays(self.ids) if self.ids else pa.array([], pa.string())
        self.ids = []
        self._sort()

    def _sort(self) -> None:
        """The pairs in order of the corpus record, as texts come."""
        if self.texts or self.overlaps:
            self.shares = [_Shares(pa.concat_arrays(self.query[f"{kind}{c}"].chunks), kind, n) for kind, c, n in self.overlaps] if self.n else []
            self.by_place = np.argsort(self.place, kind="stable").astype(np.int32)
            self.sorted = self.place[self.by_place]

    def _with_texts(self, batch: pa.RecordBatch) -> Iterator[dict]:
        """The pairs of these corpus records, with the texts of both."""
        ids = batch.column("entity_id")
        new = _changes(ids, self.last_text)
        self.last_text = ids[-1].as_py()
        place = self.at + np.cumsum(new)
        self.at = int(place[-1])
        begin = np.searchsorted(self.sorted, place)
        n = np.searchsorted(self.sorted, place, "right") - begin
        pair, right = self.by_place[_spread(begin, n)], np.repeat(np.arange(len(ids)), n)
        left = self.row[pair]
        if not len(pair):
            return
        if self.n != self.query.num_rows:  # records that come more than once
            times = self.row_count[left]
            left_row = _spread(self.row_start[left], times)
            pair, right, left = np.repeat(pair, times), np.repeat(right, times), np.repeat(left, times)
        else:
            left_row = left
        for some in self._hopeful(left_row, right, batch):
            yield from self._made(batch, pair[some], left[some], left_row[some], right[some])

    def _hopeful(self, left_row: np.ndarray, right: np.ndarray, batch: pa.RecordBatch) -> Iterator[np.ndarray | slice]:
        """Which of the pairs are worth their overlaps: all."""
        yield slice(None)

    def _wanted(self, shares: list[np.ndarray], left_row: np.ndarray, right: np.ndarray, batch: pa.RecordBatch) -> np.ndarray | slice:
        """Which of the pairs are given back: all."""
        return slice(None)

    def _made(self, batch: pa.RecordBatch, pair: np.ndarray, left: np.ndarray, left_row: np.ndarray, right: np.ndarray) -> Iterator[dict]:
        ids = batch.column("entity_id")
        if not len(pair):
            return
        met, among = np.unique(right, return_inverse=True)
        shares = [x.of(left_row, among, batch.column(f"{kind}{c}").take(pa.array(met))) for x, (kind, c, _) in zip(self.shares, self.overlaps, strict=True)]
        on = self._wanted(shares, left_row, right, batch)
        pair, left, left_row, right, shares = pair[on], left[on], left_row[on], right[on], [x[on] for x in shares]
        for at in range(0, len(pair), _ROWS):
            some = slice(at, at + _ROWS)
            made = self._columns(self.row_ids.take(pa.array(left[some])), ids.take(pa.array(right[some])), pair[some])
            for side, of, which in (("l", self.query, left_row), ("r", batch, right)):
                made |= {f"{side}{t}": of.column(f"t{t}").take(pa.array(which[some])) for t in self.texts}
            yield made | {f"o{j}": pa.array(x[some]) for j, x in enumerate(shares)}


class _Lists(_Part):
    """Gives one row a query record: ids and places, among the ids of its country's corpus, of its best candidates."""

    def close(self) -> Iterator[dict]:
        self._end()
        for at in range(0, self.n, _LISTS):
            end = np.searchsorted(self.row, np.arange(at, min(at + _LISTS, self.n) + 1))
            place, offsets = pa.array(self.place[end[0] : end[-1]]), pa.array((end - end[0]).astype(np.int32))
            yield {"entity_id": self.row_ids[at : at + _LISTS], "cands": pa.ListArray.from_arrays(offsets, self.cand_ids.take(place)), "places": pa.ListArray.from_arrays(offsets, place)}


class _Listed(_Part):
    """Pairs by the places of _Lists; with bounds only those that may reach their least score."""

    def __init__(self, texts: list[int], overlaps: list[tuple[str, int, int]], bounds: Bounds | None):
        super().__init__(0, 0, 0, texts, overlaps)
        self.bounds = bounds

    def _columns(self, s1: pa.Array, cand: pa.Array, pair: np.ndarray) -> dict:
        return {"s1_id": s1, "cand_id": cand}

    def _end(self) -> None:
        if self.ended:
            return
        self.ended, self.row, self.place = True, np.empty(0, np.int32), np.empty(0, np.int32)
        self.query = pa.Table.from_batches(self.rows).combine_chunks() if self.rows else None
        self.rows = []
        if self._known() is not None:
            lists = pa.concat_arrays(self.query["places"].chunks).take(pa.array(self.row_start))
            self.row = np.repeat(np.arange(self.n, dtype=np.int32), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            self.place = lists.flatten().to_numpy()
            if self.bounds:
                self.sketches = unpacked(pa.concat_arrays(self.query["sketch"].chunks))
        self._sort()

    def _hopeful(self, left_row: np.ndarray, right: np.ndarray, batch: pa.RecordBatch) -> Iterator[np.ndarray | slice]:
        if not self.bounds:
            yield from super()._hopeful(left_row, right, batch)
            return
        self.others = unpacked(batch.column("sketch"))
        some = [np.empty(0, np.int64)]
        for at in range(0, len(right), _BOUND):
            a, b = self.sketches[left_row[at : at + _BOUND]], self.others[right[at : at + _BOUND]]
            some.append(at + np.flatnonzero(self.bounds.may_reach(a, b)))
        yield np.concatenate(some)

    def _wanted(self, shares: list[np.ndarray], left_row: np.ndarray, right: np.ndarray, batch: pa.RecordBatch) -> np.ndarray | slice:
        return self.bounds.may_reach(self.sketches[left_row], self.others[right], shares) if self.bounds else slice(None)


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.Table.from_pydict(columns).combine_chunks().to_batches()[0]


def _met(new: Callable[[], _Part]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, of = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = list(zip(batch.column("country").to_pylist(), batch.column("part").to_pylist(), batch.column("kind").to_pylist(), strict=True))
            at = 0
            for end in range(1, len(key) + 1):
                if end < len(key) and key[end] == key[at]:
                    continue
                if key[at][:2] != of:
                    if part:
                        yield from map(_batch, part.close())
                    part, of = new(), key[at][:2]
                yield from map(_batch, part.add(key[at][2], batch.slice(at, end - at)))
                at = end
        if part:
            yield from map(_batch, part.close())

    return run


def of_many_countries(records: DataFrame) -> bool:
    """Whether an id has records of different countries."""
    country = F.coalesce("country", F.lit("\0"))
    return bool(records.groupBy("entity_id").agg(F.min(country).alias("a"), F.max(country).alias("b")).where("a <> b").head(1))


def best_candidates(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 300,
    share: float = 0.01,
    cap: int = 2000,
    min_ngrams: int = 3,
    min_address: int = 1,
    carry: list[str] | None = None,
    overlaps: dict[str, tuple[str, int]] | None = None,
    carry_as: dict[str, Column] | None = None,
) -> DataFrame:
    """(s1_id, cand_id, score, rank): top_candidates(scores(...)); with carry, these columns of both records as l_* and r_*.

    overlaps: names of columns that have jaccard (column, 0) or ngram_similarity (column, n, 3 at most) of both records' column; a null one is empty.
    carry_as: what of a carried column the pairs get, if not all of it: made once a record.
    """
    carry, overlaps, carry_as = carry or [], overlaps or {}, carry_as or {}
    queries, corpus = (side.withColumns({f"_of_{c}": of for c, of in carry_as.items()}) for side in (queries, corpus))
    names = {f"_of_{c}" if c in carry_as else c: c for c in carry}
    carry = list(names)
    fields = list(dict.fromkeys([*carry, *(c for c, _ in overlaps.values())]))
    if of_many_countries(queries) or of_many_countries(corpus):  # such an id's keys add up over countries
        pairs = top_candidates(scores(queries, corpus, share, cap, min_ngrams, min_address), k)
        for side, id_, of in (("l", "s1_id", queries), ("r", "cand_id", corpus)):
            pairs = pairs.join(of.select(F.col("entity_id").alias(id_), *[F.col(c).alias(f"{side}_{c}") for c in fields]), id_) if fields else pairs
        two = lambda c: (F.coalesce(f"l_{c}", F.lit("")), F.coalesce(f"r_{c}", F.lit("")))
        pairs = pairs.withColumns({f"_o{j}": S.ngram_similarity(*two(c), n) if n else S.jaccard(*two(c)) for j, (c, n) in enumerate(overlaps.values())})
        made = [F.col(f"_o{j}").alias(name) for j, name in enumerate(overlaps)]
        return pairs.select("s1_id", "cand_id", "score", "rank", *[F.col(f"{side}_{c}").alias(f"{side}_{name}") for side in "lr" for c, name in names.items()], *made)
    asked_for = [("t" if n else "h", fields.index(c), n) for c, n in overlaps.values()]
    stream = _dealt(queries, corpus, fields, carry, overlaps, share, cap)
    made = T.StructType([T.StructField("s1_id", T.StringType()), T.StructField("cand_id", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    carried = [(f"{side}{fields.index(c)}", f"{side}_{name}", corpus.schema[c].dataType) for side in "lr" for c, name in names.items()]
    carried += [(f"o{j}", name, T.DoubleType()) for j, name in enumerate(overlaps)]
    for x, _, type_ in carried:
        made = made.add(x, type_)
    texts = [fields.index(c) for c in carry]
    got = stream.mapInArrow(_met(lambda: _Part(k, min_ngrams, min_address, texts, asked_for)), made)
    return got.select("s1_id", "cand_id", "score", "rank", *[F.col(x).alias(name) for x, name, _ in carried])


def _dealt(queries: DataFrame, corpus: DataFrame, fields: list[str], carry: list[str], overlaps: dict[str, tuple[str, int]], share: float = 0.01, cap: int = 2000, lists: list[str] | None = None) -> DataFrame:
    """What the tasks read: a part's query records, its country's frequent keys, corpus keys and corpus texts. lists: columns that come with the records instead of keys."""
    parts = F.greatest(F.ceil(F.col("n") / MAX_PART), F.least(F.lit(PARTS), F.ceil(F.col("n") / MIN_PART))).cast("int")
    sizes = queries.where("country is not null").groupBy("country").agg(F.count("*").alias("n")).select("country", parts.alias("parts"))
    every = sizes.agg(F.sum("parts")).first()[0] or 1
    sizes = F.broadcast(sizes)
    no_keys, no_sizes = F.lit(None).cast("array<bigint>"), F.lit(None).cast("array<int>")
    # of the fields: those that are carried or cut into n-grams, and those whose tokens are asked for
    whole = [i for i, c in enumerate(fields) if c in carry or any(c == x and n for x, n in overlaps.values())]
    cut = [i for i, c in enumerate(fields) if (c, 0) in overlaps.values()]

    def rows(of: DataFrame, kind: int, part: Column, keys: Column, sizes_: Column, texts: bool) -> DataFrame:
        text = [(F.col(fields[i]) if texts else F.lit(None)).cast(corpus.schema[fields[i]].dataType).alias(f"t{i}") for i in whole]
        hashed = [(F.transform(token_set(F.coalesce(fields[i], F.lit(""))), lambda x: F.xxhash64(x)) if texts else F.lit(None)).cast("array<bigint>").alias(f"h{i}") for i in cut]
        # made before a record is dealt to several parts: Spark works out what stands beside an explode above it, once a row it gives
        key = [keys.alias("keys"), sizes_.alias("sizes")] if lists is None else lists
        made = of.select("country", "parts", F.lit(kind).alias("kind"), "entity_id", *key, *text, *hashed)
        return made.select("country", part.alias("part"), *made.columns[2:])

    own, all_ = F.pmod(F.xxhash64("entity_id"), F.col("parts")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    if lists is None:
        asked = _hashed("query_keys")
        counts = F.when(F.concat(*asked).isNotNull(), F.array(*map(F.size, asked)))
        frequent = frequent_keys(corpus, ALL, share, cap).select("country", F.lit("").alias("entity_id"), F.array(F.xxhash64("signal", "key")).alias("keys"))
        stream = rows(queries.join(sizes, "country"), _QUERY, own, F.concat(*asked), counts, True)
        stream = stream.unionByName(rows(frequent.join(sizes, "country"), _FREQUENT, all_, F.col("keys"), no_sizes, False))
        stream = stream.unionByName(rows(corpus.join(sizes, "country"), _KEYS, all_, F.concat(*_hashed("corpus_keys")), no_sizes, False))
    else:
        stream = rows(queries.join(sizes, "country"), _QUERY, own, no_keys, no_sizes, True)
    if fields:
        stream = stream.unionByName(rows(corpus.join(sizes, "country"), _TEXT, all_, no_keys, no_sizes, True))
    return stream.repartition(4 * math.ceil(every), "country", "part").sortWithinPartitions("country", "part", "kind", "entity_id")


def best_lists(queries: DataFrame, corpus: DataFrame, k: int = 300) -> DataFrame:
    """(entity_id, cands, places): best_candidates as one row a query record; places are those of the ids in their country's corpus. No id may have records of two countries."""
    made = "entity_id string, cands array<string>, places array<int>"
    return _dealt(queries, corpus, [], [], {}).mapInArrow(_met(lambda: _Lists(k, 3, 1, [], [])), made)


def listed_pairs(lists: DataFrame, queries: DataFrame, corpus: DataFrame, carry: list[str], overlaps: dict[str, tuple[str, int]], bounds: Bounds | None = None) -> DataFrame:
    """The pairs of lists (entity_id, places as of best_lists of the same corpus) as (s1_id, cand_id) with carry and overlaps as best_candidates gives them; with bounds without pairs that cannot reach their least score."""
    fields = list(dict.fromkeys([*carry, *(c for c, _ in overlaps.values())]))
    own = ["places"]
    if bounds:
        own, (queries, corpus) = ["places", "sketch"], map(sketched, (queries, corpus))
    queries, corpus = queries.join(lists.select("entity_id", "places"), "entity_id"), corpus.withColumn("places", F.lit(None).cast("array<int>"))
    asked_for = [("t" if n else "h", fields.index(c), n) for c, n in overlaps.values()]
    texts = [fields.index(c) for c in carry]
    carried = [(f"{side}{fields.index(c)}", f"{side}_{c}", corpus.schema[c].dataType) for side in "lr" for c in carry]
    carried += [(f"o{j}", name, T.DoubleType()) for j, name in enumerate(overlaps)]
    made = T.StructType([T.StructField("s1_id", T.StringType()), T.StructField("cand_id", T.StringType()), *[T.StructField(x, type_) for x, _, type_ in carried]])
    got = _dealt(queries, corpus, fields, carry, overlaps, lists=own).mapInArrow(_met(lambda: _Listed(texts, asked_for, bounds)), made)
    return got.select("s1_id", "cand_id", *[F.col(x).alias(name) for x, name, _ in carried])
