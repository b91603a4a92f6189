"""Command line: python -m kithline.cli preprocess | block | train | predict | validate."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.normalize import clean_records
from .operators import blocking as B
from .operators import features as X
from .operators import labels as L
from .operators import matching as M
from .operators import validate as V
from .operators.evaluation import macro_f05, matches
from .sources import tables as T

FIELDS = ["business_name_core", "business_name_blockkey", "business_address_clean", "postal_code", "legal_suffix", "country"]


# Names and defaults of the flags are the interface.
def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kithline")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("preprocess")
    for name in ("--input", "--output", "--input-dir", "--output-dir"):
        p.add_argument(name)
    p.add_argument("--chunksize", type=int, default=200_000, help="kept for old scripts; splits are made by Spark")
    p = sub.add_parser("block")
    p.add_argument("--clean-dir", required=True)
    p.add_argument("--split", choices=["train", "test"], required=True)
    p.add_argument("--ground-truth")
    p.add_argument("--output", required=True)
    p.add_argument("--max-df-ratio", type=float, default=0.01)
    p.add_argument("--min-ngram-overlap", type=int, default=3)
    p.add_argument("--min-addr-overlap", type=int, default=1)
    p.add_argument("--max-candidates", type=int, default=300)
    for name in ("train", "predict"):
        p = sub.add_parser(name)
        for x in ("--source1", "--source2", "--source3", "--candidate-pairs"):
            p.add_argument(x, required=True)
        if name == "train":
            p.add_argument("--ground-truth", required=True)
            p.add_argument("--model-out", default="models/matcher")
            p.add_argument("--val-fraction", type=float, default=0.2)
            p.add_argument("--seed", type=int, default=42)
            p.add_argument("--neg-per-pos", type=int, default=20)
            p.add_argument("--min-neg-per-entity", type=int, default=5)
            p.add_argument("--max-neg-per-entity", type=int, default=200)
            p.add_argument("--rounds", type=int, default=40)
            p.add_argument("--backend", choices=M.BACKENDS, default=M.BACKENDS[0])
        else:
            p.add_argument("--model", required=True)
            p.add_argument("--out-dir", default="output")
            p.add_argument("--threshold", type=float)
            p.add_argument("--max-matches-per-entity", type=int)
            p.add_argument("--batch-size", type=int, default=50_000, help="kept for old scripts; batches are Arrow's")
    p = sub.add_parser("validate")
    for x in ("--source1", "--source2", "--source3", "--lists"):
        p.add_argument(x, required=True)
    p.add_argument("--list-column", default="candidate_entity_ids")
    return top


def _sources(spark: SparkSession, a: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    s1, s2, s3 = (T.read_clean(spark, p, T.CLEAN_COLUMNS) for p in (a.source1, a.source2, a.source3))
    return X.lookup(s1, FIELDS), X.merged_lookup(s2, s3, FIELDS)


def _pairs(spark: SparkSession, path: str) -> DataFrame:
    return L.exploded(T.read_id_list(spark, path, "source1_entity_id", "candidate_entity_ids"), "source1_entity_id", "candidate_entity_ids").distinct()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("kithline").getOrCreate()
    if a.command == "preprocess":
        if a.input and a.output:
            files = [(a.input, a.output)]
        elif a.input_dir and a.output_dir:
            files = [(path, f"{a.output_dir}/{name}") for path, name in T.directory_files(spark, a.input_dir)]
        else:
            parser().error("give --input and --output, or --input-dir and --output-dir")
        for source, target in files:
            T.write_tsv(clean_records(T.read_raw(spark, source)), target)
    elif a.command == "block":
        s1, s2, s3 = (T.read_clean(spark, f"{a.clean_dir}/{a.split}_source{k}_clean.tsv", T.BLOCK_COLUMNS) for k in (1, 2, 3))
        lists = B.block(s1, s2.unionByName(s3), a.max_candidates, share=a.max_df_ratio, min_ngrams=a.min_ngram_overlap, min_address=a.min_addr_overlap)
        T.write_id_list(lists.withColumnRenamed("ids", "candidate_entity_ids"), a.output, "source1_entity_id", "candidate_entity_ids")
        if a.split == "train" and a.ground_truth:
            kept = T.read_id_list(spark, a.output, "source1_entity_id", "candidate_entity_ids")
            ids = kept.select("source1_entity_id", F.filter(F.split("candidate_entity_ids", ","), lambda x: x != "").alias("ids"))
            B.recall(ids, T.read_id_list(spark, a.ground_truth, "source1_entity_id", "matched_entity_ids")).show(truncate=False)
    elif a.command == "train":
        s1, corpus = _sources(spark, a)
        truth_lists = L.truth_of_all(s1, T.read_id_list(spark, a.ground_truth, "source1_entity_id", "matched_entity_ids"))
        truth = L.exploded(truth_lists, "source1_entity_id", "matched_entity_ids")
        pairs = _pairs(spark, a.candidate_pairs)
        print(f"true pairs that blocking has lost: {L.missed(pairs, truth).count()}")
        sample = L.sampled(pairs, truth, a.seed, per_positive=a.neg_per_pos, least=a.min_neg_per_entity, most=a.max_neg_per_entity)
        featured = X.clean_features(sample, s1, corpus)
        matcher, sweep = M.fit(featured, truth.distinct(), X.CLEAN_FEATURES, rounds=a.rounds, backend=a.backend, validation=a.val_fraction, seed=a.seed)
        matcher.save(a.model_out)
        held = featured.where(L.in_validation("s1_id", a.val_fraction, a.seed))
        scoped = M.scoped_truth(truth_lists, held)
        scored = matcher.score(held)
        for t in (matcher.threshold, 0.5):
            print(f"validation macro F0.5 at {t:.2f}: {macro_f05(matches(scored, t), scoped).first()[0]:.4f}")
    elif a.command == "predict":
        s1, corpus = _sources(spark, a)
        pairs = _pairs(spark, a.candidate_pairs)
        unknown = V.unknown_candidates(pairs, corpus)
        print(f"unknown candidates dropped: {unknown.count()}")
        pairs = pairs.join(corpus.select(F.col("entity_id").alias("cand_id")), "cand_id", "left_semi").select("s1_id", "cand_id")
        made = M.predict(M.Matcher.load(spark, a.model), X.clean_features(pairs, s1, corpus), s1, a.threshold, a.max_matches_per_entity)
        T.write_tsv(made, f"{a.out_dir}/matching_results.tsv")
        if a.candidate_pairs.rstrip("/") != f"{a.out_dir}/candidate_pairs.tsv":
            T.write_tsv(T.read_id_list(spark, a.candidate_pairs, "source1_entity_id", "candidate_entity_ids"), f"{a.out_dir}/candidate_pairs.tsv")
    else:
        s1, s2, s3 = (T.read_clean(spark, p, ["entity_id"]) for p in (a.source1, a.source2, a.source3))
        lists = T.read_id_list(spark, a.lists, "source1_entity_id", a.list_column)
        lists = lists.select("source1_entity_id", F.filter(F.split(a.list_column, ","), lambda x: x != "").alias("ids"))
        issues = {r.metric: r.value for r in V.validate_lists(lists, s1, s2.unionByName(s3)).collect()}
        print("\n".join(f"{k}: {v}" for k, v in issues.items()))
        return int(any(issues[k] for k in ("missing", "unexpected", "duplicates", "rows_with_unknown_ids", "rows_with_repeated_ids")))
    return 0


if __name__ == "__main__":
    sys.exit(main())
