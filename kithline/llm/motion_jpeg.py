"""Operator 4: media columns as AVI motion JPEG.

A payload is stored as 24 x 24 grey frames of 8-bit samples, each an intra frame of lossless JPEG
(process 14 of ITU-T T.81: left predictor, Huffman-coded differences), in a RIFF file with one video
stream and an index. Reading parses the RIFF chunks, takes the frames from the index, reads each
frame's JPEG segments and decodes all frames of a piece side by side, one sample at a step. Shots are
cut where the difference of two frames' 16-bin histograms exceeds the mean of the shot's last LOOK
differences by more than twice their deviation (whole numbers, so equal media have equal shots); the
shots are the timed clip rows.

Memory: a medium is held as a whole, its frames decoded PIECE at a time.

Defined cases: a null text is an empty payload, padded like any other; repeated rows give equal media;
a damaged medium raises; further columns are not carried.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, chunks, text_bytes, worker

SIDE, RATE = 24, 25
FRAME = SIDE * SIDE
PIECE = 4_096
BINS, LOOK, LEAST_CHANGE = 16, 8, FRAME // 4


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


@lru_cache(maxsize=1)
def _frame_head() -> bytes:
    """SOI, frame header, Huffman table and scan header: all that stands before a frame's coded samples."""
    frame = struct.pack(">BHHBBBB", 8, SIDE, SIDE, 1, 1, 0x11, 0)
    sizes = [0] * 16
    sizes[3] = 9  # nine categories of difference, four bits each
    table = bytes([0, *sizes, *range(9)])
    return b"\xff\xd8" + _segment(0xC3, frame) + _segment(0xC4, table) + _segment(0xDA, bytes([1, 1, 0, 1, 0, 0]))


@lru_cache(maxsize=1)
def _codes() -> tuple[np.ndarray, np.ndarray]:
    """(code with its additional bits, number of bits) of each difference -255..255, at index difference + 255."""
    value, bits = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        value[d + 255] = size << size | (d if d >= 0 else d + (1 << size) - 1)
        bits[d + 255] = 4 + size
    return value, bits


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """A lossless JPEG of each frame of samples (frames, FRAME)."""
    n = len(samples)
    s = samples.reshape(n, SIDE, SIDE).astype(np.int64)
    d = np.empty_like(s)
    d[:, :, 1:] = s[:, :, 1:] - s[:, :, :-1]
    d[:, 1:, 0] = s[:, 1:, 0] - s[:, :-1, 0]
    d[:, 0, 0] = s[:, 0, 0] - 128
    d = d.reshape(n, FRAME) + 255
    value, size = _codes()
    v, bits = value[d], size[d]
    to = np.cumsum(bits, axis=1)
    n_bytes = (to[:, -1] + 7) >> 3
    begin = np.concatenate([[0], np.cumsum(n_bytes)])
    at = (to - bits + (begin[:-1, None] << 3)).ravel()
    bits, byte = bits.ravel(), at >> 3
    v = v.ravel() << (24 - (at & 7) - bits)
    total = int(begin[-1])
    out = np.zeros(total + 3)
    for k in range(3):
        out[k : k + total] += np.bincount(byte, (v >> (16 - 8 * k)) & 255, total)
    packed = out[:total].astype(np.uint8)
    packed[begin[1:] - 1] |= ((1 << (-to[:, -1] & 7)) - 1).astype(np.uint8)  # the last byte is filled with ones
    full = packed == 255  # a zero follows each coded 255
    moved = np.arange(total) + np.concatenate([[0], np.cumsum(full)[:-1]])
    stuffed = np.zeros(total + int(full.sum()), np.uint8)
    stuffed[moved] = packed
    cut = begin + np.concatenate([[0], np.cumsum(full)])[begin]
    raw, head = stuffed.tobytes(), _frame_head()
    return [head + raw[a:b] + b"\xff\xd9" for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(frames: list[bytes]) -> bytes:
    """RIFF AVI of one MJPG stream with an index."""
    largest = max(map(len, frames))
    main = struct.pack("<14I", 1_000_000 // RATE, largest * RATE, 0, 0x10, len(frames), 0, 1, largest, SIDE, SIDE, 0, 0, 0, 0)
    stream = b"vidsMJPG" + struct.pack("<IHHIIIIIIIIhhhh", 0, 0, 0, 0, 1, RATE, 0, len(frames), largest, 0xFFFFFFFF, 0, 0, 0, SIDE, SIDE)
    form = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    head = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", main) + _chunk(b"LIST", b"strl" + _chunk(b"strh", stream) + _chunk(b"strf", form)))
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        movi.append(_chunk(b"00dc", f))
        at += len(movi[-1])
    body = b"AVI " + head + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index))
    return _chunk(b"RIFF", body)


def read_index(media: bytes) -> tuple[list[tuple[int, int]], float]:
    """((offset, size) of each frame by the file's index; seconds a frame)."""
    if media[:4] != b"RIFF" or media[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    at, end = 12, 8 + struct.unpack_from("<I", media, 4)[0]
    movi, index, micros = None, None, 0
    while at + 8 <= end:
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"LIST" and media[at + 8 : at + 12] == b"hdrl":
            inner = at + 12
            while inner + 8 <= at + 8 + size:
                if media[inner : inner + 4] == b"avih":
                    micros = struct.unpack_from("<I", media, inner + 8)[0]
                inner += 8 + struct.unpack_from("<I", media, inner + 4)[0]
        elif name == b"LIST" and media[at + 8 : at + 12] == b"movi":
            movi = at + 8
        elif name == b"idx1":
            index = np.frombuffer(media, np.dtype([("name", "S4"), ("flags", "<u4"), ("at", "<u4"), ("size", "<u4")]), size // 16, at + 8)
        at += 8 + size + (size & 1)
    if movi is None or index is None:
        raise ValueError("an AVI file without frames or index")
    return list(zip((movi + 8 + index["at"].astype(np.int64)).tolist(), index["size"].tolist(), strict=True)), micros / 1e6


def _scan_start(jpeg: bytes, at: int) -> tuple[int, bytes, int]:
    """(where coded samples begin, the Huffman table's segment, predictor) by the frame's segments."""
    if jpeg[at : at + 2] != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    at, table = at + 2, b""
    while True:
        marker, size = jpeg[at + 1], struct.unpack_from(">H", jpeg, at + 2)[0]
        body = jpeg[at + 4 : at + 2 + size]
        if marker == 0xC3 and struct.unpack_from(">BHHB", body) != (8, SIDE, SIDE, 1):
            raise ValueError("another kind of frame")
        if marker == 0xC4:
            table = body
        at += 2 + size
        if marker == 0xDA:
            return at, table, body[3]


@lru_cache(maxsize=4)
def _decoder(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each 16 bits to come: (difference, bits that it takes)."""
    difference, taken = np.zeros(1 << 16, np.int16), np.zeros(1 << 16, np.int8)
    code, symbol = 0, 17
    for length in range(1, 17):
        for _ in range(table[length]):
            size = table[symbol]
            symbol += 1
            low = code << (16 - length)
            high = low + (1 << (16 - length))
            x = np.arange(low, high)
            extra = x >> (16 - length - size) & ((1 << size) - 1)
            difference[low:high] = np.where(extra >> max(size - 1, 0) & 1, extra, extra - (1 << size) + 1) if size else 0
            taken[low:high] = length + size
            code += 1
        code <<= 1
    return difference, taken


def decode_frames(media: list[bytes], places: list[list[tuple[int, int]]]) -> np.ndarray:
    """Samples (frames, FRAME) of the given frames of some media, side by side."""
    coded, table = [], None
    for m, frames in zip(media, places, strict=True):
        head = None
        for at, size in frames:
            if head is None or m[at : at + len(head)] != head:
                start, own, predictor = _scan_start(m, at)
                if predictor != 1 or (table is not None and own != table):
                    raise ValueError("another predictor or code")
                head, table = m[at:start], own
            coded.append(m[at + len(head) : at + size - 2])
    n = len(coded)
    size = np.fromiter(map(len, coded), np.int64, n)
    flat = np.frombuffer(b"".join(coded) + b"\0\0\0", np.uint8)
    stuffed = np.zeros(len(flat), bool)
    stuffed[1:] = (flat[:-1] == 255) & (flat[1:] == 0)
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    begin = begin - np.concatenate([[0], np.cumsum(stuffed)])[begin]
    plain = np.concatenate([flat[~stuffed], np.zeros(4, np.uint8)]).astype(np.uint32)
    ahead = plain[:-3] << np.uint32(24) | plain[1:-2] << np.uint32(16) | plain[2:-1] << np.uint32(8) | plain[3:]
    difference, taken = _decoder(table)
    at = begin << 3
    d = np.empty((FRAME, n), np.int16)
    for i in range(FRAME):
        window = (ahead[at >> 3] >> (np.uint32(16) - (at & 7).astype(np.uint32))) & np.uint32(0xFFFF)
        d[i] = difference[window]
        at += taken[window]
    d = d.T.reshape(n, SIDE, SIDE).astype(np.int32)
    d[:, :, 0] = 128 + np.cumsum(d[:, :, 0], axis=1)
    return (np.cumsum(d, axis=2) & 255).astype(np.uint8).reshape(n, FRAME)


def shots(histograms: np.ndarray) -> list[tuple[int, int]]:
    """(first frame, last frame + 1) of each shot."""
    change = np.abs(np.diff(histograms.astype(np.int64), axis=0)).sum(axis=1)
    cuts, last = [0], 0
    for i in (np.flatnonzero(change >= LEAST_CHANGE) + 1).tolist():
        recent = change[max(last, i - 1 - LOOK) : i - 1].tolist()
        n, total = len(recent), sum(recent)
        above = n * int(change[i - 1]) - total
        if n == 0 or above > 0 and above * above > 4 * (n * sum(x * x for x in recent) - total * total):
            cuts.append(i)
            last = i
    return list(zip(cuts, [*cuts[1:], len(histograms)], strict=True))


def store(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes (of the UTF-8 text) and media (the AVI file of its padded payload) of every row."""

    @worker("motion_jpeg")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, limit=1 << 20):
            data, offsets = text_bytes(part.column(1))
            size = np.diff(offsets)
            frames = np.maximum(1, -(-size // FRAME))
            first = np.concatenate([[0], np.cumsum(frames)])
            payload = np.full(int(first[-1]) * FRAME, 255, np.uint8)
            payload[np.arange(len(data)) + np.repeat(first[:-1] * FRAME - offsets[:-1], size)] = data
            payload = payload.reshape(-1, FRAME)
            made: list[bytes] = []
            for at in range(0, len(payload), PIECE):
                made += encode_frames(payload[at : at + PIECE])
            media = [write_avi(made[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            yield arrow(["key", "n_bytes", "media"], [part.column(0), size, pa.array(media, pa.binary())])

    narrow = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return narrow.mapInArrow(run, f"key {narrow.schema['key'].dataType.simpleString()}, n_bytes bigint, media binary").withColumnRenamed("key", key)


def read(df: DataFrame, media: str = "media") -> DataFrame:
    """df with payload (the stored bytes read back), clips (array of clip, start_s, end_s, frames) and feature of its media."""
    kept = [c for c in df.columns if c != media]

    @worker("motion_jpeg")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "media", 2 << 20):
            files = part.column(len(kept)).to_pylist()
            indexes = [read_index(m) for m in files]
            n = [len(x[0]) for x in indexes]
            first = np.concatenate([[0], np.cumsum(n)])
            samples = np.empty((int(first[-1]), FRAME), np.uint8)
            flat = [(i, p) for i, (places, _) in enumerate(indexes) for p in places]
            for at in range(0, len(flat), PIECE):
                some = flat[at : at + PIECE]
                which = sorted({i for i, _ in some})
                by_file = {i: [] for i in which}
                for i, p in some:
                    by_file[i].append(p)
                samples[at : at + PIECE] = decode_frames([files[i] for i in which], [by_file[i] for i in which])
            bin_ = (samples >> 4).astype(np.int64) + (np.arange(len(samples)) * BINS)[:, None]
            histograms = np.bincount(bin_.ravel(), minlength=len(samples) * BINS).reshape(-1, BINS)
            payloads, clips, features = [], [], []
            for i, (_, second) in enumerate(indexes):
                a, b = first[i], first[i + 1]
                payloads.append(samples[a:b].tobytes())
                cut = shots(histograms[a:b])
                clips.append([{"clip": k, "start_s": x * second, "end_s": y * second, "frames": y - x} for k, (x, y) in enumerate(cut)])
                features.append(f"{b - a} frames, {len(cut)} shots: " + " ".join(map(str, histograms[a:b].sum(axis=0).tolist())))
            kind = pa.list_(pa.struct([("clip", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("frames", pa.int32())]))
            yield arrow([*kept, "payload", "clips", "feature"], [*part.columns[: len(kept)], pa.array(payloads, pa.binary()), pa.array(clips, kind), pa.array(features, pa.string())])

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept]
    clips = "array<struct<clip:int,start_s:double,end_s:double,frames:int>>"
    return df.select(*kept, F.col(media).alias("media")).mapInArrow(run, ", ".join([*fields, "payload binary", f"clips {clips}", "feature string"]))


def clip_rows(df: DataFrame, key: str = "doc_id", media: str = "media") -> DataFrame:
    """One row for each shot of each medium: key, clip, start_s, end_s, frames."""
    return read(df.select(key, media), media).select(key, F.inline("clips"))
