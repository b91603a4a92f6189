import hashlib
import random
import zlib

import numpy as np
import pytest

from kithline.llm import motion_jpeg as M
from kithline.llm.queries import op4_media_columns


def slow_decode(jpeg):
    """One frame by the letter of the standard, bit by bit."""
    start, table, predictor = M._scan_start(jpeg, 0)
    assert predictor == 1
    codes, code, k = {}, 0, 17
    for length in range(1, 17):
        for _ in range(table[length]):
            codes[length, code] = table[k]
            code, k = code + 1, k + 1
        code <<= 1
    body = jpeg[start:-2].replace(b"\xff\x00", b"\xff")
    bits = "".join(f"{b:08b}" for b in body)
    at, out = 0, []
    for i in range(M.FRAME):
        length = 1
        while (length, int(bits[at : at + length], 2)) not in codes:
            length += 1
        size = codes[length, int(bits[at : at + length], 2)]
        at += length
        extra = int(bits[at : at + size] or "0", 2)
        at += size
        d = 0 if not size else extra if extra >> (size - 1) else extra - (1 << size) + 1
        before = out[i - 1] if i % M.SIDE else out[i - M.SIDE] if i else 128
        out.append((before + d) & 255)
    assert set(bits[at:]) <= {"1"}
    assert len(bits) - at < 8
    return out


def test_frames_come_back_and_follow_the_standard():
    rng = np.random.default_rng(0)
    s = np.concatenate([rng.integers(0, 256, (5, M.FRAME)), np.full((1, M.FRAME), 255), np.zeros((1, M.FRAME)), np.tile([0, 255], (2, M.FRAME // 2)), 128 + rng.integers(-2, 3, (3, M.FRAME))]).astype(np.uint8)
    frames = M.encode_frames(s)
    assert [slow_decode(f) for f in frames] == s.tolist()
    avi = M.write_avi(frames)
    places, second = M.read_index(avi)
    assert [avi[a : a + n] for a, n in places] == frames
    assert second == 1 / M.RATE
    assert (M.decode_frames([avi, avi], [places, places[:3]]) == np.concatenate([s, s[:3]])).all()
    with pytest.raises(ValueError, match="AVI"):
        M.read_index(b"RIFFxxxxWAVE")


def test_shots():
    quiet, other = np.array([M.FRAME] + [0] * 15), np.array([0] * 15 + [M.FRAME])
    assert M.shots(np.array([quiet] * 10 + [other] * 5 + [quiet])) == [(0, 10), (10, 15), (15, 16)]
    assert M.shots(np.array([quiet])) == [(0, 1)]


@pytest.mark.parametrize("piece", [4096, 3])
def test_round_trip(spark, monkeypatch, piece):
    monkeypatch.setattr(M, "PIECE", piece)
    rng = random.Random(0)
    texts = [None, "", "a", "é" * 288, "x" * 576, "x" * 577, "".join(chr(rng.choice([65, 233, 8364, 128512])) for _ in range(6000)), "ab " * 90_000] + ["same"] * 2
    df = spark.createDataFrame([(i, t, 1, b"x") for i, t in enumerate(texts)], "doc_id long, text string, payload int, media binary").repartition(3)
    media = M.store(df)
    rows = {r.doc_id: r for r in M.read(media).collect()}
    for i, t in enumerate(texts):
        b = (t or "").encode()
        assert bytes(rows[i].payload) == b + b"\xff" * (-len(b) % 576 or 576 * (not b))
        assert rows[i].n_bytes == len(b)
        assert rows[i].clips[-1].end_s == pytest.approx(len(rows[i].payload) / 576 / 25)
    assert rows[8].feature == rows[9].feature
    clips = M.clip_rows(media).collect()
    assert len(clips) == sum(len(r.clips) for r in rows.values())
    assert M.read(M.store(df.where("false"))).count() == 0


def test_query_on_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {r.doc_id: r for r in op4_media_columns(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for d in docs:
        b = d.text.encode()
        p = b + b"\xff" * (-len(b) % 576 or 576 * (not b))
        r = got[d.doc_id]
        avi = M.write_avi(M.encode_frames(np.frombuffer(p, np.uint8).reshape(-1, 576)))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
        assert (r.media_bytes, r.media_sha256) == (len(avi), hashlib.sha256(avi).hexdigest())
