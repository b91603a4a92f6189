import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from kithline.llm import substring_dedup
from kithline.llm.fm_index import FMIndex, repeated_starts
from kithline.llm.queries import op8_substring_dedup
from kithline.llm.substring_dedup import remove_repeats


def brute(texts, window=35):
    cut = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    n = Counter(tuple(c[i : i + window]) for c in cut for i in range(len(c) - window + 1))
    out = []
    for c in cut:
        gone = [False] * len(c)
        for i in range(len(c) - window + 1):
            if n[tuple(c[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(c), sum(gone), " ".join(w for w, g in zip(c, gone, strict=True) if not g)))
    return out


def fixture(seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    passages = [[word() for _ in range(n)] for n in (34, 35, 36, 60, 150)]
    texts = [None, "", "  \n", "a" * 500, "x " * 400, "x y " * 90, "x y z " * 60, " ".join(passages[3]), " ".join(passages[3])]
    for i in range(60):
        parts = [word() for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 2)):
            p = list(rng.choice(passages))
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = word()
            parts += p[rng.randrange(3) :]
            parts += [word() for _ in range(rng.randint(0, 50))]
        texts.append(rng.choice([" ", "\n", "\t  "]).join(parts))
    texts += texts[20:24]  # exact copies
    return texts


def test_matching_statistics_against_counting():
    rng = np.random.default_rng(1)
    for window in (3, 5):
        for _ in range(20):
            lengths = rng.integers(window, 20, 12)
            symbols = rng.integers(1, 4, lengths.sum())
            weights = rng.integers(1, 3, 12)
            index = FMIndex(symbols, lengths, weights, window)
            got = repeated_starts(index, window)
            seqs = np.split(symbols, np.cumsum(lengths)[:-1])
            n = Counter()
            for s, w in zip(seqs, weights, strict=True):
                for i in range(len(s) - window + 1):
                    n[tuple(s[i : i + window])] += w
            for f, s in zip(index.first, seqs, strict=False):
                assert [bool(got[f + i]) for i in range(len(s) - window + 1)] == [n[tuple(s[i : i + window])] > 1 for i in range(len(s) - window + 1)]


@pytest.mark.parametrize(("hot", "segments"), [(20_000, 6_000), (2, 5)])
def test_against_brute_force(spark, monkeypatch, hot, segments):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "SEGMENTS", segments)
    texts = fixture()
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, uid string, at int").repartition(3)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_repeated_rows_null_keys_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (None, text), (1, "short"), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in remove_repeats(df).collect())
    assert got == [(0, 0, 0), (0, 40, 40), (0, 40, 40), (1, 1, 0)]
    assert remove_repeats(df.where("false")).count() == 0


def test_query_on_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op8_substring_dedup(spark, sf_dir).collect()}
    for d, (n, gone, kept) in zip(docs, brute([d.text for d in docs]), strict=True):
        assert got[d.doc_id] == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
