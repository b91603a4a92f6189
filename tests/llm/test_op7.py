import hashlib

import public_tokenizers
import sentencepiece

from kithline.llm.piece_codec import encode_decode, read_model
from kithline.llm.queries import op7_sentencepiece

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "   a", "a ", "a  b   c    ", "\n\t x\r\n", "▁", "a▁b ▁ c", "日本語 한국어 ゼ梦", "\U0001f600 x\u0000y", "<s> </s> <unk> <0x41>", "x" * 5000, "ab " * 4000, "1234567890 12"]


def test_whole_texts_as_the_library(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    df = spark.createDataFrame([(i, t, "q", "w") for i, t in enumerate(ODD * 2)], "doc_id long, text string, ids string, decoded string")
    for as_text in ("array", "text"):
        for r in encode_decode(df, read_model(PATH), ids_as=as_text).collect():
            ids = lib.encode(ODD[r.doc_id % len(ODD)] or "")
            assert r.n_tokens == len(ids)
            assert r.ids == (ids if as_text == "array" else ",".join(map(str, ids)))
            assert r.decoded == lib.decode(ids)


def test_query_on_the_whole_table(spark, sf_dir):
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: r for r in op7_sentencepiece(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = lib.encode(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_empty_table(spark):
    assert encode_decode(spark.createDataFrame([], "doc_id long, text string"), read_model(PATH)).count() == 0
