"""The matcher: boosted trees over pair features, a tuned threshold, and one list of matches per record.

Trees grow level by level and training stops on validation loss; both differ from leaf-wise boosting
with a ranking stop, so scores differ, not their use.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bounds import Bounds
from .evaluation import best_threshold, matches, threshold_sweep
from .labels import in_validation


BACKENDS = ("gbt", "forest", "logistic")
#: Rows of a task that learns.
LESSONS = 250_000


@dataclass
class Matcher:
    model: PipelineModel
    features: list[str]
    threshold: float

    def score(self, pairs: DataFrame) -> DataFrame:
        """pairs with score, the chance that they match."""
        made = self.model.transform(pairs.na.fill(0.0, self.features))
        return made.withColumn("score", F.get(vector_to_array("probability"), F.lit(1))).select(*pairs.columns, "score")

    def bounds(self) -> Bounds | None:
        """Tells pairs that cannot reach the threshold; None for models that it does not know."""
        return Bounds.of(self.model.stages[-1], self.features, self.threshold)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        SparkSession.active().createDataFrame([(json.dumps({"features": self.features, "threshold": self.threshold}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/matcher")

    @staticmethod
    def load(spark, path: str) -> Matcher:
        kept = json.loads(spark.read.text(f"{path}/matcher").first().value)
        return Matcher(PipelineModel.load(f"{path}/model"), kept["features"], kept["threshold"])


def _estimator(backend: str, rounds: int, depth: int, seed: int):
    if backend == "gbt":
        return GBTClassifier(
            maxIter=rounds, maxDepth=depth, stepSize=0.05, minInstancesPerNode=20, subsamplingRate=0.8, featureSubsetStrategy="0.9", seed=seed, weightCol="weight", validationIndicatorCol="held"
        )
    if backend == "forest":
        return RandomForestClassifier(numTrees=rounds, maxDepth=depth, minInstancesPerNode=20, subsamplingRate=0.8, seed=seed, weightCol="weight")
    if backend == "logistic":
        return LogisticRegression(maxIter=rounds, weightCol="weight")
    raise ValueError(f"backend is one of {', '.join(BACKENDS)}")


def class_counts(pairs: DataFrame) -> DataFrame:
    """(label, n): their quotient weighs the positives."""
    return pairs.groupBy("label").agg(F.count("*").alias("n"))


def scoped_truth(lists: DataFrame, pairs: DataFrame) -> DataFrame:
    """The truth lists of the records that have at least one pair."""
    return lists.join(pairs.select(F.col("s1_id").alias("source1_entity_id")).distinct(), "source1_entity_id", "left_semi")


def fit(
    pairs: DataFrame, truth: DataFrame, features: list[str], rounds: int = 40, depth: int = 6, validation: float = 0.2, seed: int = 42, backend: str = "gbt"
) -> tuple[Matcher, DataFrame]:
    """(matcher, threshold sweep on the held-out records). pairs: s1_id, cand_id, label and features; truth: (s1_id, cand_id)."""
    held = in_validation("s1_id", validation, seed)
    rows = pairs.na.fill(0.0, features).withColumn("held", held).persist()  # boosting reads it once a round
    try:
        classes = {r.label: r.n for r in class_counts(rows.where("not held")).collect()}
        weight = classes.get(0, 0) / max(classes.get(1, 0), 1)
        rows_w = rows.withColumn("weight", F.when(F.col("label") == 1, max(weight, 1e-6)).otherwise(1.0)).withColumn("label", F.col("label").cast("double"))
        assembler = VectorAssembler(inputCols=features, outputCol="features")
        learner = _estimator(backend, rounds, depth, seed)
        lessons = rows_w if backend == "gbt" else rows_w.where("not held")  # boosting needs the held-out rows to know when to stop
        tasks = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(sum(classes.values()) / LESSONS))
        lessons = lessons.coalesce(tasks)  # boosting runs hundreds of small jobs over the same rows
        model = PipelineModel([assembler, learner.fit(assembler.transform(lessons))])
        matcher = Matcher(model, features, 0.5)
        scored = matcher.score(rows.where("held").select("s1_id", "cand_id", *features)).select("s1_id", "cand_id", "score")
        sweep = threshold_sweep(scored, truth)
        matcher.threshold = best_threshold(sweep)
    finally:
        rows.unpersist()
    return matcher, sweep


def capped(scored: DataFrame, threshold: float, most: int | None = None) -> DataFrame:
    """Pairs with score >= threshold, of each record at most `most` (0 or None: all): the best, ties to the smaller id."""
    kept = scored.where(F.col("score") >= threshold)
    if not most:
        return kept
    best = Window.partitionBy("s1_id").orderBy(F.desc("score"), "cand_id")
    return kept.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= most).drop("_n")


def assemble(queries: DataFrame, kept: DataFrame) -> DataFrame:
    """(source1_entity_id, matched_entity_ids): every query record, with its matches joined by comma."""
    every = queries.select(F.col("entity_id").alias("source1_entity_id")).distinct()
    return every.join(matches(kept, float("-inf")), "source1_entity_id", "left").select("source1_entity_id", F.coalesce("matched_entity_ids", F.lit("")).alias("matched_entity_ids"))


def predict(matcher: Matcher, featured: DataFrame, queries: DataFrame, threshold: float | None = None, most: int | None = None) -> DataFrame:
    """One row for each query record with its matches."""
    return assemble(queries, capped(matcher.score(featured), matcher.threshold if threshold is None else threshold, most))
