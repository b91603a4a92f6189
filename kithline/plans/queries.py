"""One query for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import normalize as N
from ..functions import similarity as S
from ..operators import blocking as B
from ..operators import cells as C
from ..operators import evaluation as E
from ..operators import features as X
from ..operators import inspect as I
from ..operators import labels as L
from ..operators import matching as M
from ..operators import validate as V
from ..sources.settled import shelve, unshelve
from . import fixtures as fx

#: Candidates of a record that the feature queries look at, and that the list queries keep: blocking's own default.
FEW = KEPT = 300


def norm_name(spark, d):
    r = N.clean_records(fx.records(spark, d))
    return r.select("entity_id", "business_name_clean", "business_name_core", "business_name_blockkey", "legal_suffix")


def norm_addr(spark, d):
    return N.clean_records(fx.records(spark, d)).select("entity_id", "business_address_clean")


def postal_extract(spark, d):
    return fx.records(spark, d).select("entity_id", N.postal_code(F.col("business_address"), F.col("country")).alias("postal_code"))


def norm_raw(spark, d):
    r = fx.records(spark, d)
    return r.select("entity_id", N.raw_name(F.col("business_name")).alias("name"), N.raw_address(F.col("business_address")).alias("address"))


def norm_country(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet")
    names = n.select("n_nationkey", F.explode(F.array("n_name", F.lit(" USA "), F.lit("u.s."), F.lit("IN"), F.lit("fr"))).alias("country"))
    return names.select("n_nationkey", "country", N.raw_country(F.col("country")).alias("name"))


def tokens(spark, d):
    s1, _ = fx.sources(spark, d)
    return s1.select("entity_id", _joined_col(K.token_set(F.col("business_name_blockkey"))).alias("tokens"), F.size(K.token_list(F.col("business_address_clean"))).alias("n_address_tokens"))


def _joined_col(c):
    return F.array_join(F.array_sort(c), "|")


def trigrams(spark, d):
    s1, _ = fx.sources(spark, d)
    return s1.select("entity_id", _joined_col(K.block_ngrams(F.col("business_name_core"))).alias("trigrams"))


def padded_ngrams(spark, d):
    s1, _ = fx.sources(spark, d)
    return s1.select("entity_id", _joined_col(K.padded_ngrams(F.col("business_name_core"), 2)).alias("bigrams"), _joined_col(K.padded_ngrams(F.col("business_name_core"))).alias("trigrams"))


def inverted_index_pruned(spark, d):
    _, corpus = fx.sources(spark, d)
    return B.postings(corpus, B.NGRAM).groupBy("country", "key").agg(F.count("*").alias("n_postings"))


def _hits(signal):
    def run(spark, d):
        s1, corpus = fx.sources(spark, d)
        return B.hits(s1, corpus, signal)

    return run


def block_token(spark, d):
    """Pairs that share any rare name token."""
    return _hits(B.TOKEN)(spark, d).select("s1_id", "cand_id")


def block_ngram(spark, d):
    return _hits(B.NGRAM)(spark, d).where("n >= 3")


def block_scores(spark, d):
    return B.scores(*fx.sources(spark, d))


def candidates_topk(spark, d):
    return C.best_candidates(*fx.sources(spark, d), KEPT).select("s1_id", "cand_id", "score", "rank")


def _lists(spark, d):
    s1, corpus = fx.sources(spark, d)
    return s1, corpus, B.block(s1, corpus, KEPT)


def candidate_lists(spark, d):
    return _lists(spark, d)[2].select("source1_entity_id", F.array_join("ids", ",").alias("candidate_entity_ids"))


def blocking_recall(spark, d):
    return E_round(B.recall(_lists(spark, d)[2], fx.truth_lists(spark, d)))


def E_round(df):
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c).cast("bigint").alias(c) for c, t in df.dtypes])


def _pairs(sources, k=KEPT):
    return C.best_candidates(*sources, k).select("s1_id", "cand_id", "score")


def label_pairs(spark, d):
    return L.labelled(_pairs(fx.sources(spark, d)).select("s1_id", "cand_id"), fx.truth(spark, d))


def missed_truth(spark, d):
    return L.missed(_pairs(fx.sources(spark, d), FEW), fx.truth(spark, d))


def truth_lists(spark, d):
    return L.truth_of_all(fx.sources(spark, d, clean=False)[0], fx.truth_lists(spark, d))


def truth_pairs(spark, d):
    return L.exploded(truth_lists(spark, d), "source1_entity_id", "matched_entity_ids")


def neg_budget(spark, d):
    n = fx.truth(spark, d).groupBy("s1_id").agg(F.count("*").alias("n_true"))
    every = fx.sources(spark, d, clean=False)[0].select(F.col("entity_id").alias("s1_id")).join(n, "s1_id", "left").withColumn("n_true", F.coalesce("n_true", F.lit(0)))
    return every.select("s1_id", "n_true", L.negative_budget(F.col("n_true")).cast("bigint").alias("budget"))


def neg_sample(spark, d):
    return L.sampled(_pairs(fx.sources(spark, d)).select("s1_id", "cand_id"), fx.truth(spark, d)).select("s1_id", "cand_id", "label")


def group_split(spark, d):
    return fx.sources(spark, d, clean=False)[0].select(F.col("entity_id").alias("s1_id")).withColumn("held", L.in_validation())


_SHORT = {"name": "business_name_core", "addr": "business_address_clean"}


def _text_pairs(spark, d, *names, overlaps=None, **made):
    """Names or addresses, as asked for, of each record and its best candidates; made: by name, what of them the pairs get."""
    carry_as = {_SHORT[name]: of(F.col(_SHORT[name])) for name, of in made.items()}
    pairs = C.best_candidates(*fx.sources(spark, d), FEW, carry=[_SHORT[name] for name in names], overlaps=overlaps, carry_as=carry_as)
    return pairs.withColumnsRenamed({f"{p}_{_SHORT[name]}": f"{p}_{name}" for p in "lr" for name in names})


def _overlaps(spark, d, *names, truth=None):
    """Overlaps of each record and its best candidates, by their names as features; with truth also hit, how often it has the pair."""
    s1, corpus = fx.sources(spark, d)
    asked = {name: X.CLEAN_OVERLAPS[name] for name in names}
    if truth is None:
        return C.best_candidates(s1, corpus, FEW, overlaps=asked)
    lists = truth.groupBy(F.col("s1_id").alias("entity_id")).agg(F.collect_list("cand_id").alias("matched"))  # a record brings its few matches along: no join has to find them among all pairs
    pairs = C.best_candidates(s1.join(lists, "entity_id", "left"), corpus.withColumn("matched", F.lit(None).cast("array<string>")), FEW, carry=["matched"], overlaps=asked)
    return pairs.withColumn("hit", F.when(F.col("l_matched").isNotNull(), F.size(F.filter("l_matched", lambda x: x == F.col("cand_id")))).otherwise(0))


def jaccard(spark, d):
    return _overlaps(spark, d, "addr_jaccard").select("s1_id", "cand_id", F.round("addr_jaccard", 9).alias("sim"))


def ngram_sim(spark, d):
    return _overlaps(spark, d, "name_ngram3_sim").select("s1_id", "cand_id", F.round("name_ngram3_sim", 9).alias("sim"))


def lcs_ratio(spark, d):
    p = _text_pairs(spark, d, "name")
    a, b = F.col("l_name"), F.col("r_name")
    return p.withColumn("n", F.get(S.lcs_lengths([(a, b)]), F.lit(0))).select("s1_id", "cand_id", F.round(S.lcs_ratio(F.col("n"), a, b), 9).alias("sim"))


def osa_ratio(spark, d):
    p = _text_pairs(spark, d, "name")
    a, b = F.col("l_name"), F.col("r_name")
    return p.withColumn("n", F.get(S.osa_distances([(a, b)]), F.lit(0))).select("s1_id", "cand_id", F.round(S.osa_ratio(F.col("n"), a, b), 9).alias("sim"))


def token_sort_ratio(spark, d):
    p = _text_pairs(spark, d, "name").withColumns({"a": S.sorted_tokens(F.col("l_name")), "b": S.sorted_tokens(F.col("r_name"))})
    a, b = F.col("a"), F.col("b")
    return p.withColumn("n", F.get(S.osa_distances([(a, b)]), F.lit(0))).select("s1_id", "cand_id", F.round(S.osa_ratio(F.col("n"), a, b), 9).alias("sim"))


def pair_flags(spark, d):
    p = _text_pairs(spark, d, "name", "addr", name=lambda a: F.struct(a.alias("text"), S.first_token(a).alias("first")), addr=S.digits)
    a, b, x, y = F.col("l_name.text"), F.col("r_name.text"), F.col("l_addr"), F.col("r_addr")
    first = S.exact(F.col("l_name.first"), F.col("r_name.first"))
    return p.select("s1_id", "cand_id", F.round(S.length_difference(a, b), 9).alias("len_diff"), S.exact(a, b).alias("exact"), S.both_present(a, b).alias("present"), first.alias("first"), S.exact(x, y).alias("digits"))


def set_extensions(spark, d):
    p = _text_pairs(spark, d, "addr", overlaps={"jaccard": X.CLEAN_OVERLAPS["addr_jaccard"]}, addr=lambda a: F.size(K.token_set(a)))
    n, m = F.col("l_addr"), F.col("r_addr")
    both = S.shared_of(F.col("jaccard"), n, m)
    return p.select("s1_id", "cand_id", F.round(S.dice_of(both, n, m), 9).alias("dice"), F.round(S.overlap_of(both, n, m), 9).alias("overlap"))


def _rounded(df, names):
    return df.select("s1_id", "cand_id", *[F.round(F.col(c).cast("double"), 5).alias(c) for c in names])


def features_clean(spark, d):
    pairs = C.best_candidates(*fx.sources(spark, d), FEW, carry=X.CLEAN_FIELDS, overlaps=X.CLEAN_OVERLAPS)
    return _rounded(X.clean_features_of(pairs, ["s1_id", "cand_id"]), X.CLEAN_FEATURES)


def features_raw(spark, d):
    raw = {f"raw_{c}": made for c, made in X.raw_fields().items()}  # cleaned records have their raw columns still
    s1, corpus = (side.withColumns(raw) for side in fx.sources(spark, d))
    as_raw = {"business_name_core": "raw_name", "business_address_clean": "raw_address"}
    pairs = C.best_candidates(s1, corpus, FEW, carry=list(raw), overlaps={name: (as_raw[c], n) for name, (c, n) in X.CLEAN_OVERLAPS.items()})
    pairs = pairs.withColumnsRenamed({f"{p}_raw_{c}": f"{p}_{c}" for p in "lr" for c in X.raw_fields()})
    return _rounded(X.raw_features_of(pairs, ["s1_id", "cand_id"]), X.RAW_FEATURES)


def record_lookup(spark, d):
    """Records of two sources with clashing ids: the second source's stay."""
    _, corpus = fx.sources(spark, d, clean=False)
    s2, s3 = corpus.where(F.col("entity_id").startswith("S2-")), corpus.where(F.col("entity_id").startswith("S3-"))
    clash = s2.where("country = 'US'").select("entity_id", F.lit("other").alias("business_name"), "business_address", "country")
    return X.merged_lookup(s2, s3.unionByName(clash), ["business_name", "country"])


def _surrogate(spark, d, truth=None):
    """A score that stands in for a model's: the mean of two similarities; with truth also hit."""
    mean = (F.col("addr_jaccard") + F.col("name_ngram3_sim")) / 2
    hit = [] if truth is None else ["hit"]
    return _overlaps(spark, d, "addr_jaccard", "name_ngram3_sim", truth=truth).select("s1_id", "cand_id", F.round(mean, 6).alias("score"), *hit)


def macro_f05(spark, d):
    s1 = fx.sources(spark, d, clean=False)[0]
    return E_round(E.macro_f05(M.assemble(s1, M.capped(_surrogate(spark, d), 0.3)), L.truth_of_all(s1, fx.truth_lists(spark, d))))


def threshold_sweep(spark, d):
    truth = shelve(fx.truth(spark, d))
    return E.threshold_sweep(_surrogate(spark, d, truth), truth).select(F.round("threshold", 2).alias("threshold"), "f05")


def match_cap(spark, d):
    return M.capped(_surrogate(spark, d), 0.1, 2)


def matches_assemble(spark, d):
    return M.assemble(fx.sources(spark, d, clean=False)[0], M.capped(_surrogate(spark, d), 0.1))


def validate_candidates(spark, d):
    s1, corpus, lists = _lists(spark, d)
    return V.validate_lists(lists, s1, corpus)


def sample_records(spark, d):
    return I.sample_rows(fx.records(spark, d), "France").select("entity_id", "country")


def inspect_candidates(spark, d):
    s1, _, lists = _lists(spark, d)
    return I.beside_candidates(s1.select("entity_id", "country"), lists).select("entity_id", "country", "n_candidates")


def matched_counts(spark, d):
    return I.matched_counts(matches_assemble(spark, d))


def unknown_candidates(spark, d):
    """Candidates that a corpus without its S3 half does not know."""
    s1, corpus = fx.sources(spark, d)
    return V.unknown_candidates(_pairs((s1, corpus), FEW).select("s1_id", "cand_id"), corpus.where(F.col("entity_id").startswith("S2-")))


def model_fit_predict(spark, d):
    """Fit on sampled pairs, tune, score and assemble: one row for each S1 record."""
    s1, corpus = fx.sources(spark, d)
    truth = shelve(fx.truth(spark, d))
    if C.of_many_countries(s1) or C.of_many_countries(corpus):
        pairs = shelve(C.best_candidates(s1, corpus, KEPT, overlaps=X.CLEAN_OVERLAPS).drop("score", "rank"))
        featured = X.clean_features_of(C.best_candidates(s1, corpus, KEPT, carry=X.CLEAN_FIELDS, overlaps=X.CLEAN_OVERLAPS), ["s1_id", "cand_id"])
        matcher, _ = M.fit(X.clean_features(L.sampled(pairs, truth), s1, corpus), truth, X.CLEAN_FEATURES)
        unshelve(pairs, truth)
        return M.predict(matcher, featured, s1)
    lists = shelve(C.best_lists(s1, corpus, KEPT))  # blocking is done once; pairs are made where their texts are
    drawn = C.listed_pairs(L.sampled_lists(lists, truth), s1, corpus, X.CLEAN_FIELDS, X.CLEAN_OVERLAPS)
    train = L.labelled(X.clean_features_of(drawn, ["s1_id", "cand_id"]), truth)
    matcher, _ = M.fit(train, truth, X.CLEAN_FEATURES)
    hopeful = C.listed_pairs(lists, s1, corpus, X.CLEAN_FIELDS, X.CLEAN_OVERLAPS, matcher.bounds())
    unshelve(truth)
    return M.predict(matcher, X.clean_features_of(hopeful, ["s1_id", "cand_id"]), s1)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        norm_name, norm_addr, postal_extract, norm_raw, norm_country, tokens, trigrams, padded_ngrams, inverted_index_pruned, block_token, block_ngram,
        block_scores, candidates_topk, candidate_lists, blocking_recall, label_pairs, missed_truth, truth_lists, truth_pairs, neg_budget, neg_sample, group_split,
        jaccard, ngram_sim, lcs_ratio, osa_ratio, token_sort_ratio, pair_flags, set_extensions, features_clean, features_raw, record_lookup, macro_f05,
        threshold_sweep, match_cap, matches_assemble, validate_candidates, unknown_candidates, sample_records, inspect_candidates, matched_counts, model_fit_predict,
    )
} | {"block_addr": _hits(B.ADDRESS), "block_postal": _hits(B.POSTAL)}
