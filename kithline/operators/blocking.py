"""Blocking: a bounded list of candidates for each record, by joins on rare keys within a country.

A signal is a key function and what its shared keys are worth. Keys of the corpus that more than
min(max(50, share * rows of the country), cap) postings have are dropped before the join, so each probe
meets at most `cap` postings; postal codes are never dropped, their join is left to Spark's skew
handling. The keys of all signals are made in one pass over each side, meet in one join, and their
contributions are added up in one partial aggregation per pair.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import block_ngrams, token_list, token_set


@dataclass(frozen=True)
class Signal:
    """name; keys of a corpus record; keys of a query record (a list counts a repeated key again); whether frequent keys are dropped."""

    name: str
    corpus_keys: Callable[[], Column]
    query_keys: Callable[[], Column]
    pruned: bool = True


def _postal() -> Column:
    return F.when(F.col("postal_code") != "", F.array("postal_code")).otherwise(F.array().cast("array<string>"))


TOKEN = Signal("token", lambda: token_set(F.col("business_name_blockkey")), lambda: token_set(F.col("business_name_blockkey")))
NGRAM = Signal("ngram", lambda: block_ngrams(F.col("business_name_core")), lambda: block_ngrams(F.col("business_name_core")))
ADDRESS = Signal("address", lambda: token_set(F.col("business_address_clean")), lambda: token_list(F.col("business_address_clean")))
POSTAL = Signal("postal", _postal, _postal, pruned=False)


ALL = (TOKEN, NGRAM, ADDRESS, POSTAL)


def keyed(records: DataFrame, id_: str, signals: tuple[Signal, ...], side: str) -> DataFrame:
    """(country, id_, signal, key), a row a key, in one pass over the records."""

    def named(signal: Signal) -> Column:
        return F.transform(getattr(signal, side)(), lambda key: F.struct(F.lit(signal.name).alias("signal"), key.alias("key")))

    keys = F.explode(F.concat(*map(named, signals)))
    return records.select("country", F.col("entity_id").alias(id_), keys.alias("k")).select("country", id_, "k.signal", "k.key")


def postings(corpus: DataFrame, *signals: Signal, share: float = 0.01, cap: int = 2000) -> DataFrame:
    """(country, entity_id, signal, key), a row a posting; frequent keys dropped where the signal says so.

    The frequent keys, the smaller table by far, are counted map-side first and taken out by an anti-join.
    """
    rows = keyed(corpus, "entity_id", signals, "corpus_keys")
    if not any(s.pruned for s in signals):
        return rows
    return rows.join(frequent_keys(corpus, signals, share, cap), ["country", "signal", "key"], "left_anti")


def frequent_keys(corpus: DataFrame, signals: tuple[Signal, ...], share: float = 0.01, cap: int = 2000) -> DataFrame:
    """(country, signal, key): keys with more postings than min(max(50, share * rows of the country), cap), of signals that drop them."""
    size = corpus.groupBy("country").agg(F.count("*").alias("rows"))
    most = F.least(F.greatest(F.lit(50), F.floor(F.col("rows") * F.lit(share))), F.lit(cap))
    rows = keyed(corpus, "entity_id", signals, "corpus_keys").where(F.col("signal").isin([s.name for s in signals if s.pruned]))
    counts = rows.groupBy("country", "signal", "key").agg(F.count("*").alias("n"))
    return counts.where("n > 50").join(size, "country").where(F.col("n") > most).select("country", "signal", "key")


def _met(queries: DataFrame, corpus: DataFrame, signals: tuple[Signal, ...], **prune) -> DataFrame:
    asked = keyed(queries, "s1_id", signals, "query_keys")
    return asked.join(postings(corpus, *signals, **prune), ["country", "signal", "key"]).withColumnRenamed("entity_id", "cand_id")


def hits(queries: DataFrame, corpus: DataFrame, signal: Signal, share: float = 0.01, cap: int = 2000) -> DataFrame:
    """(s1_id, cand_id, n): how many shared keys, or postings of them, each pair has."""
    return _met(queries, corpus, (signal,), share=share, cap=cap).groupBy("s1_id", "cand_id").agg(F.count("*").alias("n"))


def scores(queries: DataFrame, corpus: DataFrame, share: float = 0.01, cap: int = 2000, min_ngrams: int = 3, min_address: int = 1) -> DataFrame:
    """(s1_id, cand_id, score): 3 for any rare name token, 0.2 a trigram, 2 an address token, 10 a postal code. One join and one aggregation for all signals."""
    return score_hits(_met(queries, corpus, ALL, share=share, cap=cap).withColumn("n", F.lit(1)), min_ngrams, min_address)


def score_hits(rows: DataFrame, min_ngrams: int = 3, min_address: int = 1) -> DataFrame:
    """(s1_id, cand_id, score) from (s1_id, cand_id, signal, n). One expression in one order, so equal counts give equal doubles."""
    of = lambda name: F.coalesce(F.sum(F.when(F.col("signal") == name, F.col("n"))), F.lit(0)).alias(name)
    pairs = rows.groupBy("s1_id", "cand_id").agg(*[of(s.name) for s in ALL])
    ngram, address = F.col("ngram") >= min_ngrams, (F.col("address") >= min_address) & (F.col("address") > 0)
    pairs = pairs.where((F.col("token") > 0) | ngram | address | (F.col("postal") > 0))
    points = (
        F.when(F.col("token") > 0, 3.0).otherwise(0.0)
        + F.when(ngram, F.col("ngram") * F.lit(0.2)).otherwise(0.0)
        + F.when(address, F.col("address") * F.lit(2.0)).otherwise(0.0)
        + F.col("postal") * F.lit(10.0)
    )
    return pairs.select("s1_id", "cand_id", points.alias("score"))


def top_candidates(scored: DataFrame, k: int = 300) -> DataFrame:
    """The k best candidates of each record; ties go to the smaller id."""
    best = Window.partitionBy("s1_id").orderBy(F.desc("score"), "cand_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def candidate_lists(queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """(source1_entity_id, ids): every query record with its sorted candidates, if any."""
    got = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_set("cand_id")).alias("ids"))
    every = queries.select(F.col("entity_id").alias("source1_entity_id"))
    joined = every.join(got, F.col("source1_entity_id") == F.col("s1_id"), "left")
    return joined.select("source1_entity_id", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))


def block(queries: DataFrame, corpus: DataFrame, max_candidates: int = 300, **options) -> DataFrame:
    """candidate_lists of the best candidates by all four signals."""
    return candidate_lists(queries, top_candidates(scores(queries, corpus, **options), max_candidates))


def recall(lists: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: how much of the truth (source1_entity_id, matched_entity_ids as text) the candidate lists hold."""
    last = F.col("matched_entity_ids")
    truth = truth.groupBy("source1_entity_id").agg(F.max(last).alias("m"))
    wanted = F.when(F.coalesce("m", F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split("m", ",", -1)))
    one = lists.join(truth, "source1_entity_id", "left").select("ids", wanted.alias("wanted"))
    one = one.select(F.size("ids").alias("given"), F.size("wanted").alias("true"), F.size(F.array_intersect("ids", "wanted")).alias("found"))
    sums = one.agg(
        F.count("*").alias("entities"), F.sum("true").alias("true_pairs"), F.sum("found").alias("found_pairs"), F.sum((F.col("found") == F.col("true")).cast("int")).alias("full_recall"), F.sum("given").alias("candidates")
    )
    share = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b))
    return sums.select("*", share("found_pairs", "true_pairs").alias("pair_recall"), share("full_recall", "entities").alias("entity_recall"), share("candidates", "entities").alias("avg_candidates"))
