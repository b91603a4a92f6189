"""Macro F0.5 of predicted matches, and the threshold that is best for it."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRID = [float(x) for x in np.arange(0.05, 0.96, 0.01)]


def f_beta(precision: Column, recall: Column, beta: float = 0.5) -> Column:
    square = beta * beta
    below = square * precision + recall
    return F.when((precision > 0) & (recall > 0) & (below > 0), (1 + square) * precision * recall / below).otherwise(0.0)


def set_score(found: Column, given: Column, true: Column) -> Column:
    """F0.5 of one record from three counts: 1 if nothing is given and true, 0 if one of them is empty."""
    p, r = F.coalesce(F.try_divide(found.cast("double"), given), F.lit(0.0)), F.coalesce(F.try_divide(found.cast("double"), true), F.lit(0.0))
    return F.when((given == 0) & (true == 0), 1.0).when((given == 0) | (true == 0), 0.0).otherwise(f_beta(p, r))


def _id_set(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.split(text, ",", -1)))


def macro_f05(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """One row, macro_f05: the mean over the truth's records. Both: (source1_entity_id, matched_entity_ids as text)."""
    joined = truth.select("source1_entity_id", _id_set(F.col("matched_entity_ids")).alias("t")).join(predicted.select("source1_entity_id", F.col("matched_entity_ids").alias("p")), "source1_entity_id", "left")
    joined = joined.withColumn("p", _id_set(F.col("p")))
    return joined.agg(F.coalesce(F.avg(set_score(F.size(F.array_intersect("t", "p")), F.size("p"), F.size("t"))), F.lit(0.0)).alias("macro_f05"))


def matches(scored: DataFrame, threshold: float) -> DataFrame:
    """(source1_entity_id, matched_entity_ids): ids with score >= threshold joined by comma, in id order."""
    kept = scored.where(F.col("score") >= threshold)
    return kept.groupBy(F.col("s1_id").alias("source1_entity_id")).agg(F.array_join(F.array_distinct(F.array_sort(F.collect_list("cand_id"))), ",").alias("matched_entity_ids"))


def _place(score: Column, grid: list[float]) -> Column:
    """How many values of an ascending grid are at most the score: whole blocks first, then those of the block it falls into."""
    width = math.isqrt(len(grid))
    values = F.array(*map(F.lit, grid))
    one = lambda t: F.when(score >= t, 1).otherwise(0)
    whole = sum(one(F.lit(t)) for t in grid[width - 1 :: width]) * width
    return whole + sum(one(F.get(values, whole + j)) for j in range(width - 1))


def threshold_sweep(scored: DataFrame, truth: DataFrame, grid: list[float] = GRID) -> DataFrame:
    """(threshold, f05) of every grid value in one pass.

    scored: (s1_id, cand_id, score); truth: (s1_id, cand_id), both distinct. A pair counts for all
    thresholds up to its own place in the grid: counts per (record, place) are added up from the top.
    scored may have hit, how often truth has the pair; then pairs are counted where they are, without a join.
    """
    place = _place(F.col("score"), grid)
    if "hit" not in scored.columns:
        scored = scored.join(truth.select("s1_id", "cand_id").withColumn("hit", F.lit(1)), ["s1_id", "cand_id"], "left")
    hit = F.coalesce("hit", F.lit(0))
    counts = scored.groupBy("s1_id", place.alias("place")).agg(F.sum(F.greatest(hit, F.lit(1))).alias("n"), F.sum(hit).alias("ok"))
    records = counts.groupBy("s1_id").agg(F.collect_list(F.struct("place", "n", "ok")).alias("at"))  # at most a row a grid value
    true = records.join(truth.groupBy("s1_id").agg(F.count("*").alias("true")), "s1_id", "left").withColumn("true", F.coalesce("true", F.lit(0)))
    every = true.select("at", "true", F.explode(F.sequence(F.lit(1), F.lit(len(grid)))).alias("place"))
    above = lambda c: F.aggregate("at", F.lit(0).cast("bigint"), lambda sum_, x: sum_ + F.when(x["place"] >= F.col("place"), x[c]).otherwise(0))
    one = every.select("place", set_score(above("ok"), above("n"), F.col("true")).alias("f"))
    at = F.element_at(F.array(*map(F.lit, grid)), F.col("place"))
    return one.groupBy("place").agg(F.round(F.avg("f"), 9).alias("f05")).select(at.alias("threshold"), "f05")


def best_threshold(sweep: DataFrame, default: float = 0.5) -> float:
    """The smallest threshold of the best score; the default if no score is above 0."""
    best = sweep.where("f05 > 0").orderBy(F.desc("f05"), "threshold").first()
    return best.threshold if best else default
