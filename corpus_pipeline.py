"""The corpus pipeline: language ID, near-duplicates, repeated passages, mixing, SentencePiece ids.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return
the columns of documents. run() applies them to documents, each stage written and read again.

Rows are told apart by two 64-bit hashes of all their columns, so null and repeated doc_ids do no harm;
rows that are equal in every column are treated alike. Further columns stay as they are, whatever their
names and types: what a stage adds for itself has a name that no column has. The session's Arrow batches
are made smaller, if they are larger than BATCH_ROWS, and stay so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kithline.llm.common import fresh, identity, shelve
from kithline.llm.language_id import identify
from kithline.llm.mixing import mix_sources
from kithline.llm.near_dedup import near_duplicates
from kithline.llm.piece_codec import encode_decode, read_model
from kithline.llm.substring_dedup import remove_repeats

BATCH_ROWS = 1_000


def _small_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_ROWS at most in this session: a batch lies in the JVM and in its worker at once, and a step takes 2 MB of it at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def _marked(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a column that tells its rows apart, and that column's name."""
    name = fresh("_mark", docs.columns)
    return docs.withColumn(name, F.concat_ws(".", *[h.cast("string") for h in identity(docs, docs.columns)])), name


def _kept(marked: DataFrame, mark: str, kept: DataFrame) -> DataFrame:
    """(k, row): the rows of marked whose mark is in kept's column k."""
    rows = marked.select(F.col(mark).alias("k"), F.struct(*[F.col(f"`{c}`") for c in marked.columns if c != mark]).alias("row"))
    return rows.join(kept.select("k").distinct(), "k", "left_semi")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter, or with no likely language, go. lang is the label that is learned from, by other documents only."""
    _small_batches(spark)
    none = F.lit(None).cast("string")
    marked, mark = _marked(docs)
    records = marked.select(F.col(mark).alias("k"), "text", none.alias("declared"), F.col("source").alias("host"), none.alias("hint"))
    told = identify(records, docs.select("text", "lang"), ["k"])
    return _kept(marked, mark, told.where("keep")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the least doc_id."""
    _small_batches(spark)
    marked, mark = _marked(docs)
    keyed = marked.select(F.struct("doc_id", F.col(mark).alias("mark")).alias("k"), "text")
    first = near_duplicates(keyed, key="k").where("k = class_id").select(F.col("k.mark").alias("k"))
    return _kept(marked, mark, first).dropDuplicates(["k"]).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated windows of 35; one of which nothing is left goes, one without any stays as it is."""
    _small_batches(spark)
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    made = remove_repeats(docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("k"), "text"), key="k", layout=True).where("n_removed = 0 OR n_removed < n_words")
    made = made.select("k.*", F.col("kept").alias("text")).withColumn("n_chars", F.char_length("text").cast("bigint"))
    return made.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    _small_batches(spark)
    marked, mark = _marked(docs)
    taken = mix_sources(marked, key=mark).groupBy(F.col(mark).alias("k")).agg(F.sum("copies").alias("copies")).where("copies > 0")
    one = _kept(marked, mark, taken).dropDuplicates(["k"]).join(taken, "k")
    return one.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of what they decode to."""
    _small_batches(spark)
    import public_tokenizers

    made = encode_decode(docs, read_model(public_tokenizers.path("piece_bpe_32k.model")))
    return made.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language ID", language_id), ("near duplicates", near_dedup), ("substring dedup", substring_dedup), ("mixing", mixing), ("sentencepiece", sentencepiece)]

#: No stage but mixing's targets can be said in SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = shelve(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
