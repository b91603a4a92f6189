"""Operator 7: SentencePiece encoding and decoding by a score-ordered agenda of adjacent symbol pairs.

A text gets one leading mark, spaces become the mark, and it falls into segments (marks, then other
characters). No piece of a merge-type vocabulary used here has a mark behind another character
(checked when the model is loaded; otherwise a text is one segment), so no merge crosses a segment
and equal segments are encoded once. Within one, the pair with the best score, then the leftmost, is
merged until none is in the vocabulary; characters outside it fall back to their bytes. The new
segments of a batch keep their agendas side by side, as rows of an array for each length: one step
takes the best pair of every row. Long ones, and runs of marks, whose scores tie, have a heap each.

In each Arrow batch, every newly met segment and one whole text are held against the sentencepiece
library; a difference raises. A bounded memory of segments is kept in each worker.

Nulls and empty texts give no ids and an empty decoding. Repeated rows are encoded alike. Further
columns, and one whose name the result needs, are not carried: only the key is.
"""

from __future__ import annotations

import gc
import heapq
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, arrow, chunks, keep, worker

MARK = "▁"
SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Bytes of segments and their ids, with what Python adds to each, that a worker remembers; the older half is dropped when they are full.
REMEMBERED_BYTES = 64 << 20
#: Longer segments have an agenda of their own.
LONG = 40
NONE = np.int32(2**31 - 1)


def _weight(segment: str, ids: bytes) -> int:
    """Bytes that a remembered segment takes: the string (two a character, four for the rarest), the ids, two objects and their place."""
    return (2 if segment.isascii() or max(segment) < "\U00010000" else 4) * len(segment) + len(ids) + 220


class Codec:
    """Encodes and decodes with one model. encode() is this module's; library is the sentencepiece processor."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        kinds = range(lib.get_piece_size())
        plain = [i for i in kinds if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.ids = {lib.id_to_piece(i): i for i in plain}
        self.scores = {p: -lib.get_score(i) for p, i in self.ids.items()}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = all(map(lib.is_byte, self.bytes))
        self.split = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self._arrays()
        self.kind = "H" if len(lib) <= 1 << 16 else "I"
        self.decimal = [str(i) for i in range(len(lib))]
        self.young: dict[str, bytes] = {}  # ids of remembered segments
        self.old: dict[str, bytes] = {}
        self.held = 0  # bytes of young

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment by the agenda."""
        sym = list(segment)
        n, scores = len(sym), self.scores
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(s, i, i + 1, 2) for i in range(n - 1) if (s := scores.get(sym[i] + sym[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            left, right = sym[i], sym[j]
            if not left or not right or len(left) + len(right) != size:
                continue  # one of them has been merged since
            sym[i], sym[j] = left + right, ""
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := scores.get(sym[i] + sym[k])) is not None:
                    heapq.heappush(agenda, (s, i, k, size + len(sym[k])))
            if (k := before[i]) >= 0 and (s := scores.get(sym[k] + sym[i])) is not None:
                heapq.heappush(agenda, (s, k, i, size + len(sym[k])))
        out: list[int] = []
        for x in sym:
            if x:
                if (i := self.ids.get(x)) is not None:
                    out.append(i)
                elif self.fallback:
                    out.extend(self.bytes[b] for b in x.encode())
                elif not out or out[-1] != self.library.unk_id():
                    out.append(self.library.unk_id())
        return out

    def _arrays(self) -> None:
        """Tables for many segments at once: symbols of characters, and the ranks of pairs in a cascade of hash tables."""
        self.symbol = np.arange(0x110000, dtype=np.int64) + len(self.library)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        ranked = sorted((p for p in self.ids if set(p) != {MARK} or len(p) == 1), key=self.scores.__getitem__)
        self.side_by_side = len({self.scores[p] for p in ranked}) == len(ranked)
        self.by_rank = np.array([self.ids[p] for p in ranked], np.int64)
        known = lambda x: int(self.symbol[ord(x)]) if len(x) == 1 else self.ids.get(x)
        pairs = {}
        for r, p in enumerate(ranked):
            for k in range(1, len(p)):
                left, right = known(p[:k]), known(p[k:])
                if left is not None and right is not None:
                    pairs[left << 21 | right] = r
        keys, ranks = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int32)
        self.tables = []
        while len(keys):
            odd = U64(0x9E3779B97F4A7C15 + 2 * len(self.tables) * 0x51ED27)
            bits = len(keys).bit_length() + 2
            at = (keys.astype(U64) * odd >> U64(64 - bits)).astype(np.int64)
            held, value = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
            held[at], value[at] = keys, ranks
            left_out = held[at] != keys
            shared = np.zeros(1 << bits, bool)  # places whose other pairs are in the next table
            shared[at[left_out]] = True
            self.tables.append((odd, U64(64 - bits), held, value, shared))
            keys, ranks = keys[left_out], ranks[left_out]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE if it can't be merged."""
        key = (left << 21 | right).ravel()
        out = np.full(len(key), NONE, np.int32)
        todo = None
        for odd, shift, held, value, shared in self.tables:
            k = key if todo is None else key[todo]
            at = (k.view(U64) * odd >> shift).view(np.int64)
            hit = held[at] == k
            here = np.flatnonzero(hit)
            out[here if todo is None else todo[here]] = value[at[here]]
            more = np.flatnonzero(~hit & shared[at])
            if not len(more):
                break
            todo = more if todo is None else todo[more]
        return out.reshape(left.shape)

    def merge_rows(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments of one length, their agendas side by side."""
        n, width = len(segments), len(segments[0])
        rows = self.symbol[np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)].reshape(n, width)
        out: list[list[int]] = [[]] * n
        who, ranks = np.arange(n), self.rank(rows[:, :-1], rows[:, 1:])
        while len(who):
            at = ranks.argmin(axis=1) if width > 1 else np.zeros(len(who), np.int64)
            best = ranks[np.arange(len(who)), at] if width > 1 else np.full(len(who), NONE, np.int32)
            over = best == NONE
            for i, ids in zip(who[over].tolist(), rows[over].tolist(), strict=True):
                out[i] = ids
            live = ~over
            who, rows, ranks, at, best = who[live], rows[live], ranks[live], at[live], best[live]
            if not len(who):
                break
            cell, col, place = np.arange(len(who)), np.arange(width - 1), at[:, None]
            rows = np.where(col <= place, rows[:, :-1], rows[:, 1:])
            rows[cell, at] = self.by_rank[best]
            width -= 1
            ranks = np.where(col[:-1] < place, ranks[:, :-1], ranks[:, 1:])
            for k, ok in ((at - 1, at > 0), (at, at < width - 1)):
                ranks[cell[ok], k[ok]] = self.rank(rows[cell[ok], k[ok]], rows[cell[ok], k[ok] + 1])
        size = len(self.library)
        if max(map(max, out)) >= size:
            out = [self.spelled(ids) if max(ids) >= size else ids for ids in out]
        return out

    def spelled(self, ids: list[int]) -> list[int]:
        """With the bytes of characters that the vocabulary lacks."""
        size, found = len(self.library), []
        for i in ids:
            if i < size:
                found.append(i)
            elif self.fallback:
                found.extend(self.bytes[b] for b in chr(i - size).encode())
            elif not found or found[-1] != self.library.unk_id():
                found.append(self.library.unk_id())
        return found

    def merge_all(self, segments: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(segments)
        by_length = defaultdict(list)
        for i, s in enumerate(segments):
            by_length[len(s) if self.side_by_side and len(s) <= LONG and MARK + MARK not in s else 0].append(i)
        for length, those in by_length.items():
            made = self.merge_rows([segments[i] for i in those]) if length else [self.merge(segments[i]) for i in those]
            for i, ids in zip(those, made, strict=True):
                out[i] = ids
        return out

    def segments(self, text: str) -> list[str]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return SEGMENT.findall(marked) if self.split else [marked]

    def learn(self, new: list[str]) -> None:
        """Encode segments not met before, and hold them against the library."""
        asked = [s for s in new if s != MARK]
        made = self.merge_all(asked)
        theirs = self.library.encode([s[1:].replace(MARK, " ") for s in asked], num_threads=1)
        if made != theirs:
            s, ours, wanted = next(x for x in zip(asked, made, theirs, strict=True) if x[1] != x[2])
            raise ValueError(f"the agenda gives {ours} for {s!r}, the library {wanted}")
        for s, ours in zip(asked, made, strict=True):
            self.young[s] = kept = array(self.kind, ours).tobytes()
            self.held += _weight(s, kept)
        if len(asked) < len(new):
            self.young[MARK] = array(self.kind, self.merge(MARK)).tobytes()

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if self.held > REMEMBERED_BYTES // 2:
            self.old, self.young, self.held = self.young, {}, 0
        young, old = self.young, self.old
        cut = [self.segments(t) for t in texts]
        new = []
        for s in set(chain.from_iterable(cut)):
            if s not in young:
                if (known := old.get(s)) is not None:
                    young[s] = known
                    self.held += _weight(s, known)
                else:
                    new.append(s)
        self.learn(new)
        out = [np.frombuffer(b"".join(map(young.__getitem__, segs)), self.kind) for segs in cut]
        whole = next((i for i, t in enumerate(texts) if t), None)
        if whole is not None and self.library.encode(texts[whole], num_threads=1) != out[whole].tolist():
            raise ValueError("the agenda and the library differ on a whole text")
        return out


@lru_cache(maxsize=2)
def codec(model: bytes) -> Codec:
    return Codec(model)


keep("piece_codec", codec.cache_clear)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_decode(df: DataFrame, model: bytes, key: str = "doc_id", text: str = "text", ids_as: str = "array") -> DataFrame:
    """key, n_tokens, ids (array of int, or with ids_as="text" their decimals joined by commas) and decoded of every row.

    model: the bytes of a model file (about 0.5 MB, sent with the tasks; executors read no local file).
    """
    if ids_as not in ("array", "text"):
        raise ValueError("ids_as is array or text")

    @worker("piece_codec")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        gc.disable()  # nothing here makes cycles, and going through the remembered segments costs a fifth of the time
        for part in chunks(batches):
            made = c.encode_batch([t or "" for t in part.column(1).to_pylist()])
            n = np.fromiter(map(len, made), np.int64, len(made))
            lists = [x.tolist() for x in made]
            if ids_as == "array":
                flat = np.concatenate(made).astype(np.int32) if len(made) else np.empty(0, np.int32)
                shown = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), flat)
            else:
                shown = pa.array([",".join(map(c.decimal.__getitem__, x)) for x in lists], pa.string())
            decoded = pa.array([c.library.decode(x) for x in lists], pa.string())
            yield arrow(["key", "n_tokens", "ids", "decoded"], [part.column(0), n, shown, decoded])

    kind = "array<int>" if ids_as == "array" else "string"
    narrow = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {narrow.schema['key'].dataType.simpleString()}, n_tokens bigint, ids {kind}, decoded string"
    return narrow.mapInArrow(run, schema).withColumnRenamed("key", key)
