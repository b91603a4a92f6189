"""Operator 8: removal of repeated passages by compressed FM-indexes.

A window is `window` consecutive words of one text. Every word that lies in a window whose words also
start anywhere else (the same text included) is removed; windows are judged on the input.

1. Anchors. Of each `spread` consecutive word grams the one with the smallest hash is an anchor. Which
   anchors a window has depends on its own words only, so two equal windows have equal anchors. Anchors
   are counted over all texts by a grouped sum.
2. Segments. A window all of whose anchors occur twice may be repeated. Neighbouring ones that are led
   by the same anchor make a segment, sent to the shard of that anchor. Windows led by an anchor that
   occurs more than `hot` times go singly to shards of their own content, so no anchor fills a task.
   A task writes the words of a segment once and otherwise only where it stands; equal segments are
   added up before the shuffle. Equal windows always meet in one shard.
3. Shards. Over each shard's segments an FM-index is built; the segments are streamed against it by
   backward search, and the matching statistics say which windows occur twice in all.
4. The answers go back to the texts, whose covered words are removed.

Whole texts are shuffled twice, for 2 and 4; each step is settled, and the files of the steps before it
are deleted as soon as nothing reads them.

Candidates come from 64-bit hashes, decisions from words. Places are told apart by 128 bits of key and
text, segments by the 64 bits of their anchor and 64 more of their words.

Defined cases: a null text has no words; a text shorter than the window keeps all; repeated rows are
copies of each other (all their windows are repeated); further columns are not carried, and may have
any name. A text is held in memory as a whole, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Words, arrow, chunks, grams, identity, mix, owners, shelve, text_bytes, unshelve, words, worker
from .fm_index import FMIndex, repeated_starts

GRAM, SPREAD, HOT = 16, 10, 1_000
#: Segments for one FM-index, beyond which the next begins at the next shard key.
SEGMENTS = 6_000
#: Windows that one segment may start.
MOST_STARTS = 48
#: Digests of segments whose words a task has written, kept at once; beyond it the words are written again.
WRITTEN = 200_000


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` values, the place of its (first) smallest."""
    size = len(values) - width + 1
    if size <= 0:
        return np.empty(0, np.int64)
    least, place = values[:size].copy(), np.zeros(size, np.int8)
    for i in range(1, width):
        less = values[i : i + size] < least
        place[less] = i
        np.minimum(least, values[i : i + size], out=least)
    return place + np.arange(size)


def _anchors(w: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the gram at each word, place of the anchor of each run of grams, and whether that run stays within its text."""
    h = grams(w.hash, GRAM)
    best = _minima(h, SPREAD)
    text_end = np.repeat(w.first[1:], np.diff(w.first))
    long = np.repeat(np.diff(w.first) >= window, np.diff(w.first))
    at = np.arange(len(best))
    return h, best, (at + GRAM + SPREAD - 1 <= text_end[: len(best)]) & long[: len(best)]


def _emit_anchors(window: int, places: bool):
    """Rows uid, text (places), or text: to the anchors, with uid and place or alone."""

    @worker("substring_dedup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            w = words(*text_bytes(part.column(part.num_columns - 1)))
            h, best, ok = _anchors(w, window)
            best = best[ok]
            at = best[np.concatenate([[True], best[1:] != best[:-1]])] if len(best) else best  # they ascend
            if not places:
                yield arrow(["anchor"], [h[at].view(np.int64)])
                continue
            row = owners(w.first)[at]
            yield arrow(["anchor", "uid", "at"], [h[at].view(np.int64), part.column(0).take(pa.array(row)), (at - w.first[row]).astype(np.int32)])

    return run


def _cut(window: int):
    """Rows uid, check, text, ats (places of repeated anchors; negative minus one where the anchor is hot) to segments, whose words are null where the task has written them before."""
    inside = window - GRAM - SPREAD + 2  # runs of grams within a window

    @worker("substring_dedup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written: set[bytes] = set()
        for part in chunks(batches, limit=1 << 20):
            data, offsets = text_bytes(part.column(2))
            w = words(data, offsets)
            n = len(w.hash)
            h, best, ok = _anchors(w, window)
            if not len(best) or len(best) < inside:
                continue
            ats = part.column(3)
            row = np.repeat(np.arange(part.num_rows), ats.value_lengths().to_numpy(zero_copy_only=False))
            at = ats.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            is_hot = np.zeros(n, bool)
            place = np.where(at < 0, -at - 1, at) + w.first[row]
            here = place < w.first[row + 1]  # those of another text with the same uid may lie beyond
            place, at = place[here], at[here]
            is_hot[place[at < 0]] = True
            seen = np.zeros(n, bool)
            seen[place] = True
            fits = np.concatenate([[0], np.cumsum(ok & seen[best])])
            start = np.flatnonzero(fits[inside:] - fits[:-inside] == inside)  # windows all of whose anchors are repeated
            if not len(start):
                continue
            lead_at = _minima(h[best], inside)[start]
            lead = h[best[lead_at]]
            owner = owners(w.first)[start]
            single = is_hot[best[lead_at]]
            if single.any():
                lead[single] = mix(grams(w.hash, window)[start[single]] ^ lead[single])
            fresh = np.ones(len(start), bool)
            fresh[1:] = (start[1:] != start[:-1] + 1) | (lead[1:] != lead[:-1]) | (owner[1:] != owner[:-1]) | single[1:] | single[:-1]
            head = np.flatnonzero(fresh)
            count = np.diff(np.append(head, len(start)))
            if (count > MOST_STARTS).any():  # the same words over and over: cut long runs
                extra = [np.arange(a, a + c, MOST_STARTS) for a, c in zip(head, count, strict=True)]
                head = np.concatenate(extra)
                count = np.diff(np.append(head, len(start)))
            raw = data.tobytes()
            first = start[head]
            last = first + count + window - 2
            shard = lead[head].view(np.int64)
            text, ids = [], []
            if len(written) > WRITTEN:
                written.clear()
            for a, b, of in zip(w.start[first].tolist(), w.end[last].tolist(), shard.tolist(), strict=True):
                t = b" ".join(raw[a:b].split())
                digest = hashlib.blake2b(t, digest_size=16, key=of.to_bytes(8, "little", signed=True)).digest()
                ids.append(digest[:8])
                text.append(None if digest in written else t.decode())
                written.add(digest)
            row = pa.array(owner[head])
            at = (first - w.first[owner[head]]).astype(np.int32)
            ids = np.frombuffer(b"".join(ids), np.int64)
            yield arrow(["shard", "segment_id", "segment", "uid", "check", "at"], [shard, ids, pa.array(text, pa.string()), part.column(0).take(row), part.column(1).take(row), at])

    return run


def _judge(window: int):
    """Rows shard, segment, copies, sorted by shard: to the starts of repeated windows, as bits."""

    def decide(pdf: pd.DataFrame) -> pa.RecordBatch:
        cut = [s.split(" ") for s in pdf["segment"]]
        lengths = np.fromiter(map(len, cut), np.int64, len(cut))
        codes, _ = pd.factorize(np.array([x for c in cut for x in c], object))
        index = FMIndex(codes.astype(np.int64) + 1, lengths, pdf["copies"].to_numpy(), window)
        good = repeated_starts(index, window)
        bits = np.zeros(len(cut), np.int64)
        place = np.flatnonzero(good)
        owner = np.searchsorted(index.first, place, "right") - 1
        np.bitwise_or.at(bits, owner, np.int64(1) << (place - index.first[owner]))
        return arrow(["shard", "segment_id", "bits"], [pdf["shard"].to_numpy(), pdf["segment_id"].to_numpy(), bits])

    @worker("substring_dedup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch.to_pandas())
            size += batch.num_rows
            if size < SEGMENTS:
                continue
            pdf = pd.concat(held, ignore_index=True)
            shard = pdf["shard"].to_numpy()
            ends = np.flatnonzero(shard[1:] != shard[:-1]) + 1
            at = 0
            while (k := np.searchsorted(ends, at + SEGMENTS)) < len(ends):
                yield decide(pdf.iloc[at : ends[k]])
                at = int(ends[k])
            held, size = [pdf.iloc[at:]], len(pdf) - at
        if size:
            yield decide(pd.concat(held, ignore_index=True))

    return run


def _strip(window: int, layout: bool):
    """Rows key, text, starts, bits: to the kept words; with layout, a text that keeps all stays as it is."""

    @worker("substring_dedup")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            data, offsets = text_bytes(part.column(1))
            w = words(data, offsets, hashes=False)
            n = len(w.start)
            cover = np.zeros(n + 1, np.int64)
            starts = part.column(2)
            row = np.repeat(np.arange(part.num_rows), starts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            at = starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + w.first[row]
            bits = part.column(3).flatten().to_numpy(zero_copy_only=False)
            for b in range(MOST_STARTS):
                on = at[(bits >> b & 1).astype(bool)] + b
                np.add.at(cover, on, 1)
                np.add.at(cover, on + window, -1)
            keep = np.cumsum(cover[:-1]) == 0
            raw = data.tobytes()
            kept = []
            removed = np.zeros(part.num_rows, np.int64)
            for i in range(part.num_rows):
                a, b = w.first[i], w.first[i + 1]
                if keep[a:b].all():
                    whole = raw[offsets[i] : offsets[i + 1]]
                    kept.append(whole if layout else b" ".join(whole.split()))
                else:
                    on = a + np.flatnonzero(keep[a:b])
                    removed[i] = b - a - len(on)
                    kept.append(b" ".join([raw[s:e] for s, e in zip(w.start[on].tolist(), w.end[on].tolist(), strict=True)]))
            yield arrow(["key", "n_words", "n_removed", "kept"], [part.column(0), np.diff(w.first).astype(np.int64), removed, pa.array([k.decode() for k in kept], pa.string())])

    return run


def remove_repeats(df: DataFrame, window: int = 35, key: str = "doc_id", text: str = "text", layout: bool = False) -> DataFrame:
    """key, n_words, n_removed and kept of every row: the words left, joined by one space; with layout, the text itself where none goes."""
    if window < GRAM + SPREAD or window % 1:
        raise ValueError(f"a window has {GRAM + SPREAD} words at least")
    docs = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    uid, check = identity(docs, ["key", "text"])
    docs = docs.withColumns({"uid": uid, "check": check})
    anchors = docs.select("text").mapInArrow(_emit_anchors(window, False), "anchor bigint")
    # settled, so that the join below has a shuffle of its own on either side and Spark can divide a frequent anchor
    twice = shelve(anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n >= 2").select("anchor", (F.col("n") > HOT).alias("hot")))
    placed = docs.select("uid", "text").mapInArrow(_emit_anchors(window, True), "anchor bigint, uid bigint, at int")
    places = placed.join(twice, "anchor").select("uid", F.expr("if(hot, -at - 1, at)").alias("at"))
    by_text = shelve(places.groupBy("uid").agg(F.collect_set("at").alias("ats")))
    unshelve(twice)
    whole = docs.select("uid", "check", "text").join(by_text, "uid").select("uid", "check", "text", "ats")
    segments = shelve(whole.mapInArrow(_cut(window), "shard bigint, segment_id bigint, segment string, uid bigint, check bigint, at int"))
    unshelve(by_text)
    distinct = segments.groupBy("shard", "segment_id").agg(F.first("segment", True).alias("segment"), F.count("*").alias("copies"))
    dealt = distinct.select("shard", "segment_id", "segment", "copies").repartition("shard").sortWithinPartitions("shard")
    judged = shelve(dealt.mapInArrow(_judge(window), "shard bigint, segment_id bigint, bits bigint").where("bits != 0"))
    back = segments.select("shard", "segment_id", "uid", "check", "at").join(judged, ["shard", "segment_id"])
    covered = shelve(back.groupBy("uid", "check").agg(F.collect_set(F.struct("at", "bits")).alias("hits")))
    unshelve(segments, judged)
    joined = docs.join(covered, ["uid", "check"], "left").select("key", "text", F.col("hits.at").alias("at"), F.col("hits.bits").alias("bits"))
    kind = docs.schema["key"].dataType.simpleString()
    return joined.mapInArrow(_strip(window, layout), f"key {kind}, n_words bigint, n_removed bigint, kept string").withColumnRenamed("key", key)
