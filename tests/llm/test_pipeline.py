import hashlib
import re

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline as P
from tests.llm.test_op5 import brute as classes
from tests.llm.test_op8 import brute as strip
from tests.llm.test_op10 import targets


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory):
    """The rows after each stage, written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_all_but_the_last_return_documents(kept):
    for df in kept[:-1]:
        assert dict(df.dtypes) == dict(kept[0].dtypes)


def test_language_id_keeps_clean_documents(kept):
    gone = {r.doc_id: r.text for r in kept[0].collect()}
    for r in kept[1].collect():
        assert gone.pop(r.doc_id) == r.text
    assert all(not re.search("[A-Za-z\x80-\U0010ffff]", t or "") for t in gone.values())


def test_one_of_each_class_stays(spark, kept):
    rows = [(r.doc_id, r.text) for r in kept[1].collect()]
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted(set(classes(spark, rows).values()))


def test_repeated_windows_go(kept):
    rows = [(r.doc_id, r.text) for r in kept[2].collect()]
    want = {i: (t if not gone else left) for (i, t), (n, gone, left) in zip(rows, strip([t for _, t in rows]), strict=True) if not gone or gone < n}
    got = {r.doc_id: r for r in kept[3].collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_the_mix_meets_its_targets(kept):
    n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size, taken, copies = {}, {}, {}
    for r in kept[3].collect():
        size[r.source] = size.get(r.source, 0) + n(r.text)
    for r in kept[4].collect():
        taken[r.source] = taken.get(r.source, 0) + n(r.text)
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 3
    for s, want in targets(size).items():
        assert abs(taken.get(s, 0) - want) <= 60 + 0.02 * want


def test_ids_as_the_library(kept):
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted((r.doc_id, lib.encode(r.text or "")) for r in kept[4].collect())
    got = sorted((r.doc_id, r.ids, r.n_tokens, r.decoded_sha256) for r in kept[5].collect())
    assert [(i, x) for i, x, _, _ in got] == want
    assert all(k == len(x) and d == hashlib.sha256(lib.decode(x).encode()).hexdigest() for _, x, k, d in got)


def test_nulls_repeats_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(50))
    odd = [(None, None, None, None, None), (1, text, "en", "a", 9), (1, text, "en", "a", 9), (1, "other words", None, None, 1), (None, "", "en", "a", 0), (2, "!!! 12", "en", "b", 6)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        for _, stage in P.STAGES:
            docs = P.shelve(stage(spark, docs, ""))
        assert docs.count() <= 6
        assert not rows or docs.where("doc_id = 1").count() >= 1


def test_further_columns_stay_as_they_are(spark):
    """Names that the stages use themselves, in any case, and a map."""
    rows = [(i, f"{'alpha beta gamma delta ' * 3}{i} " + " ".join(f"w{i}x{j}" for j in range(30)), "en", "a", 1, 77, 5, 6, {"a": i}, "r") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _uid long, _copy int, _MARK int, m map<string,int>, row string")
    for _, stage in P.STAGES[:-1]:
        docs = P.shelve(stage(spark, docs, ""))
        assert docs.columns == "doc_id text lang source n_chars _uid _copy _MARK m row".split()
        assert {(r.doc_id, r._uid, r._copy, r._MARK, r.m["a"], r.row) for r in docs.collect()} == {(i, 77, 5, 6, i, "r") for i in range(12)}
    assert P.STAGES[-1][1](spark, docs, "").count() >= 12
