import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kithline.llm import bit_mixer
from kithline.llm.bit_mixer import Mixer, score_texts, windows
from kithline.llm.queries import op3_lm_scoring


def base(rows, learns):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    cut = [re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None] for _, t in rows]
    c = Counter(w for (i, _), ws in zip(rows, cut, strict=True) if learns(i) for w in ws)
    n, v = sum(c.values()), len(c)
    return [(len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for ws in cut]


@pytest.mark.parametrize("head", [65_536, 3])
def test_base_score_against_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(bit_mixer, "HEAD", head)
    rows = [(0, "The the THE É é x"), (1, None), (2, ""), (3, "a b\tc\n a \x1c b"), (4, "x y z " * 300), (5, "unseen words only"), (6, "  "), (7, "w" * 3000)] + [(8, "same row"), (8, "same row")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, score string").repartition(3)
    got = sorted(score_texts(df, "doc_id != 5").collect(), key=lambda r: r.doc_id)
    for (i, t), r, (n, known, total, score) in zip(rows, got, base(rows, lambda i: i != 5), strict=True):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == (i, n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9)
        assert r.score < 0
        assert r.bits_per_byte == pytest.approx(-r.score * math.log2(10) / max(1, len((t or "").encode())))


def test_a_byte_has_chances_that_add_up_to_one():
    rng = np.random.default_rng(0)
    n = rng.integers(0, 9, (len(bit_mixer.ORDERS), 1 << bit_mixer.SLOT_BITS, 2)).astype(float)
    before = windows(np.frombuffer(b"hello", np.uint8), np.array([0, 5]))[0][-1]
    every = (before & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
    assert (10 ** Mixer(n).log10(every)).sum() == pytest.approx(1, abs=1e-3)


def test_the_whole_table_and_bits_of_held_out_texts(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    got = {r.doc_id: r for r in op3_lm_scoring(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for (i, _), (n, known, total, score) in zip(docs, base(docs, lambda i: not held(i)), strict=True):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9)
    out = [r for r in got.values() if r.held_out]
    bits = -sum(r.score for r in out) * math.log2(10) / sum(len(t.encode()) for i, t in docs if held(i))
    assert bits < 2.7, bits


def test_empty_table_and_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "ab"), (None, None)], "doc_id long, text string")
    assert score_texts(df.where("false"), "true").count() == 0
    for r in score_texts(df, "false").collect():
        assert (r.n_known, r.train_tokens) == (0, 0)
        assert r.base_score == 0


@pytest.mark.parametrize("head", [1 << 20, 40, 0])
def test_counts_are_those_of_the_contexts_alone(spark, monkeypatch, head):
    """Predictors against counting in Python, on more contexts than fit a small table, and scores that no bound of a table changes."""
    rng = np.random.default_rng(5)
    texts = [" ".join("".join(rng.choice(list("abcdefé"), rng.integers(1, 7))) for _ in range(60)) for _ in range(30)] + ["a\0b", "", "ab ab ab"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(3, texts[3])], "doc_id long, text string").repartition(3)
    want = {r.doc_id: r.score for r in score_texts(df, "doc_id % 4 != 1").collect()}
    monkeypatch.setattr(bit_mixer, "HEAD_WINDOWS", head)
    monkeypatch.setattr(bit_mixer, "SLOT_BITS", 2)
    got = {r.doc_id: r.score for r in score_texts(df, "doc_id % 4 != 1").collect()}
    assert got == pytest.approx(want, rel=1e-9)

    win = windows(np.frombuffer("".join(texts).encode(), np.uint8), np.array([0, len("".join(texts).encode())]))[0]
    own, n = np.unique(win, return_counts=True)
    counts = bit_mixer.Evidence(own, n).of(own)
    seen = [w.to_bytes(8, "little")[:6] for w in win.tolist()]
    for w, of_window in list(zip(own.tolist(), counts, strict=True))[::97]:
        byte, *before = w.to_bytes(8, "little")[:6]
        space = next((j + 1 for j, c in enumerate(before) if c in b"\0\t\n\x0b\x0c\r "), 5)
        for order, c in zip(bit_mixer.ORDERS, of_window, strict=True):
            k = space if order == "word" else order
            alike = [s[0] for s in seen if list(s[1 : k + 1]) == before[:k]]
            assert c.tolist() == [sum(x >> 8 - b == byte >> 8 - b for x in alike) for b in range(9)]


def test_one_known_byte_before_is_evidence():
    """Inside a word, after two bytes that never came together: the last one alone tells what follows."""
    learned, met = (windows(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in (b" qz" * 9, b" abcxqz"))
    own = np.union1d(learned, met)
    n = np.array([(learned == w).sum() for w in own])
    counts = bit_mixer.Evidence(own, n).of(met[6:7])
    assert chr(int(met[6]) & 255) == "z"
    assert counts.max(axis=1).tolist() == [[9] * 9]
    assert Mixer().log10(met[6:7], counts) > Mixer().log10(met[6:7], counts * 0)


def test_weights_are_fitted_on_every_learned_byte(spark, monkeypatch):
    """Each pass counts all bytes of all learning texts once, also beyond 400 KB, and its slope is that of the loss."""
    rng = np.random.default_rng(7)
    rows = [(i, " ".join("".join(rng.choice(list("abcde"), 5)) for _ in range(1500))) for i in range(56)] + [(100, "ab" * 60_000), (101, None)]
    passes, learn = [], Mixer.learn
    monkeypatch.setattr(Mixer, "learn", lambda self, told, *more: passes.append(told) or learn(self, told, *more))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert score_texts(df, "doc_id % 7 != 2").count() == len(rows)
    learned = [(t or "").encode() for i, t in rows if i % 7 != 2]
    assert sum(map(len, learned)) > 400_000 and len(passes) == bit_mixer.PASSES
    for told in passes:
        assert bit_mixer._views(told)[3][:, 1].sum(axis=1) == pytest.approx([sum(len(t) + 1 for t in learned)] * 8)

    own, n = np.unique(windows(np.frombuffer(learned[0], np.uint8), np.array([0, len(learned[0])]))[0], return_counts=True)
    counts, mixer = bit_mixer.Evidence(own, n).of(own), Mixer()
    whole, half = mixer.told(own, n, counts), len(own) // 2
    assert mixer.told(own[:half], n[:half], counts[:half]) + mixer.told(own[half:], n[half:], counts[half:]) == pytest.approx(whole)
    _, slope, loss, _ = bit_mixer._views(whole)
    cell, k, step = *np.unravel_index(np.argmax(np.abs(slope)), slope.shape), 1 / 64
    near = []
    for sign in (1, -1):
        moved = Mixer()
        moved.weights[cell, k] += sign * step
        near.append(bit_mixer._views(moved.told(own, n, counts))[2][cell])
    assert (near[0] - near[1]) / (2 * step) == pytest.approx(slope[cell, k], rel=0.05)
    before = mixer.learn(whole)
    assert bit_mixer._views(mixer.told(own, n, counts))[2].sum() < loss.sum() == before[1].sum()
