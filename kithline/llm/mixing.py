"""Operator 10: mixing sources to target weights by entropy balancing.

Targets. Sources in code-point order, null last, have the given weights in turn and share `share` of
all sizes (words). A source gets at most `most` times its own size; what exceeds that is shared anew by
weight until none is above.

Rates. A document of size n in a source of mean size m has the feature f = n / (n + m). The rates that
meet a source's token constraint and lie closest to 1 in relative entropy, documents counting n + m,
are exponentially tilted: exp(lambda * f), cut at `most`. The convex dual is solved by Newton steps,
each a grouped sum over all (source, size) counts, kept in a bracket that halves where a step leaves it.

Copies. Rates are rounded within strata of about STRATUM documents of one source, from large to small,
carrying the words owed to the next: a source's words come within a few small documents of its target
(where a stratum has small ones), and no document exceeds `most` copies. Rows equal in id, source and
size are added up first and share what they get as evenly as can be; strata are made by hash of id and
size, so the largest source is spread like any other even where ids are null or repeat, and reruns agree.

Defined cases: a null text has size 0 and is taken with 0 words; null is a source of its own; an empty
table gives none; a row is returned for every row, repeated ones too; a dual that does not settle in
ROUNDS steps raises; further columns are not carried.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shelve, unshelve

STRATUM = 5_000
ROUNDS = 100
#: Equal rows that one row stands for on its way out of a stratum, at most.
TOGETHER = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def with_targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """sources (source, source_size, n) with weight and target. Water-filling by grouped sums, no list of sources on the driver."""
    spark = sources.sparkSession
    order = sources.orderBy(F.col("source").isNotNull().desc(), "source").select("source", "source_size", "n")
    ranked = order.rdd.zipWithIndex().map(lambda x: (*x[0], float(weights[x[1] % len(weights)])))
    table = shelve(spark.createDataFrame(ranked, "source string, source_size bigint, n bigint, weight double"))
    total, level, capped = share * (table.agg(F.sum("source_size")).first()[0] or 0), 0.0, -1
    full = F.col("weight") * F.lit(level) > most * F.col("source_size")
    while True:
        got = table.agg(
            F.sum(F.when(full, most * F.col("source_size")).otherwise(0.0)).alias("held"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(full.cast("int")).alias("capped"),
        ).first()
        if got.capped is None or got.capped == capped or not got.weight:
            break
        capped, level = got.capped if level else -1, (total - got.held) / got.weight
        full = F.col("weight") * F.lit(level) > most * F.col("source_size")
    return table.withColumn("target", F.least(F.col("weight") * F.lit(level), most * F.col("source_size")))


def tilts(sizes: DataFrame, targets: DataFrame, most: float, rounds: int = ROUNDS) -> DataFrame:
    """targets with tilt, the lambda of each source. sizes: (source, size, n). Raises where a source does not settle."""
    mean = F.col("source_size") / F.col("n")
    state = targets.withColumn("mean", F.coalesce(mean, F.lit(0.0))).withColumns({"tilt": F.lit(0.0), "low": F.lit(-4096.0), "high": F.lit(4096.0), "done": (F.col("target") >= most * F.col("source_size")) | (F.col("source_size") == 0)})
    state = shelve(state)
    counts = sizes.where("size > 0").select(F.col("source").alias("of"), "size", F.col("n").alias("docs"))
    for _ in range(rounds):
        open_ = state.where("not done")
        f = F.col("size") / (F.col("size") + F.col("mean"))
        rate = F.exp(F.col("tilt") * f)
        words = F.col("size").cast("double") * F.col("docs")
        sums = (
            counts.join(open_.select("source", "mean", "tilt"), F.col("of").eqNullSafe(F.col("source")))
            .groupBy("of")
            .agg(F.sum(words * F.least(rate, F.lit(float(most)))).alias("got"), F.sum(F.when(rate < most, words * f * rate).otherwise(0.0)).alias("slope"))
        )
        moved = state.join(sums, F.col("of").eqNullSafe(F.col("source")), "left")
        miss = F.col("got") - F.col("target")
        low, high = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low")), F.when(miss > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - miss / F.when(F.col("slope") > 0, F.col("slope"))
        moved = moved.withColumns({"low": low, "high": high, "step": newton, "close": F.abs(miss) <= 1e-9 * F.col("target")})
        inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        tilt = F.when(F.col("done") | F.col("close"), F.col("tilt")).when(inside, F.col("step")).otherwise((F.col("low") + F.col("high")) / 2)
        before, state = state, shelve(moved.select(*[c for c in state.columns if c not in ("tilt", "done")], tilt.alias("tilt"), (F.col("done") | F.coalesce("close", F.lit(True))).alias("done")))
        unshelve(before)
        if state.where("not done").isEmpty():
            return state
    left = state.where("not done").count()
    raise RuntimeError(f"the rates of {left} sources have not settled in {rounds} steps")


def _round(most: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Copies of the rows of one stratum, `times` equal ones at once: the nearest whole number to their rate and the words owed."""
        pdf = pdf.sort_values(["size", "mark"], ascending=[False, True], kind="stable")
        owed, at, copies, times = 0.0, [], [], []
        for i, (size, rate, n) in enumerate(zip(pdf["size"].to_numpy().tolist(), pdf["rate"].to_numpy().tolist(), pdf["times"].to_numpy().tolist(), strict=True)):
            all_ = max(0, min(most * n, int(rate * n + owed / size + 0.5))) if size else n
            owed += (rate * n - all_) * size
            each, more = divmod(all_, n)
            for c, m in ((each + 1, more), (each, n - more)):
                for k in range(0, m, TOGETHER):
                    at.append(i)
                    copies.append(c)
                    times.append(min(TOGETHER, m - k))
        return pdf.iloc[at].assign(copies=copies, times=times)[["id", "source", "size", "source_size", "target", "rate", "copies", "times"]]

    return run


def mix_sources(
    df: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, most: float = 3.0, key: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """key, source, size, source_size, target (of the source), rate, copies and taken (words) of every row."""
    rows = shelve(df.select(F.col(key).alias("id"), F.col(source).cast("string").alias("source"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")))
    rows = rows.groupBy("id", "source", "size").agg(F.count("*").alias("times"))
    sizes = shelve(rows.groupBy("source", "size").agg(F.sum("times").alias("n")))
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    solved = tilts(sizes, with_targets(sources, weights, share, most), most)
    solved = solved.select(F.col("source").alias("of"), "source_size", "target", "tilt", "mean", "n")
    one = rows.join(solved, F.col("source").eqNullSafe(F.col("of")))
    f = F.coalesce(F.try_divide(F.col("size"), F.col("size") + F.col("mean")), F.lit(0.0))
    capped = F.col("target") >= most * F.col("source_size")
    one = one.withColumn("rate", F.when(capped & (F.col("source_size") > 0), F.lit(float(most))).otherwise(F.least(F.exp(F.col("tilt") * f), F.lit(float(most)))))
    one = one.withColumn("mark", F.xxhash64("id", "source", "size")).withColumn("stratum", F.pmod(F.xxhash64(F.lit(1), "id", "size"), F.ceil(F.col("n") / STRATUM)))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, source string, size bigint, source_size bigint, target double, rate double, copies bigint, times bigint"
    made = one.select("id", "source", "size", "source_size", "target", "rate", "mark", "stratum", "times").groupBy("source", "stratum").applyInPandas(_round(int(most)), schema)
    made = made.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")
    return made.withColumn("taken", F.col("copies") * F.col("size")).withColumnRenamed("id", key)
