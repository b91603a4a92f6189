"""Pairs that are left out by their bounds are those that cannot reach the threshold."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kithline.operators import bounds as Bo
from kithline.operators import cells as C
from kithline.operators import features as X
from kithline.operators import labels as L
from kithline.plans import queries as Q

FIELDS = ["entity_id", *X.CLEAN_FIELDS]


def records(spark, prefix, n, seed):
    of = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["é", "𝄞x", "long" * 70]
    rows = []
    for i in range(n):
        name = " ".join(of.choices(words[:-1] if i % 31 else words, k=of.randint(0, 4)))
        address = " ".join(of.choices(words[:-1], k=of.randint(0, 6)))
        rows.append((f"{prefix}{i:05d}", name, " ".join(sorted(name.split())), None if i % 29 == 0 else address, of.choice(["", "12345", "999"]), of.choice(["", "ltd", None]), of.choice(["US", "France", ""])))
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in FIELDS))


@pytest.fixture(scope="module")
def made(spark):
    """Query records, corpus, their lists, and the 22 features of all their pairs."""
    s1, corpus = records(spark, "S1-", 60, 1), records(spark, "S3-", 300, 2)
    lists = C.best_lists(s1, corpus, 20).persist()
    pairs = C.best_candidates(s1, corpus, 20, carry=X.CLEAN_FIELDS, overlaps=X.CLEAN_OVERLAPS)
    features = {(r.s1_id, r.cand_id): [0.0 if r[c] is None else r[c] for c in X.CLEAN_FEATURES] for r in X.clean_features_of(pairs, ["s1_id", "cand_id"]).collect()}
    return s1, corpus, lists, features


def grown(of, depth, values):
    if not depth or of.random() < 0.1:
        return of.uniform(-1, 1)
    f = of.randrange(len(X.CLEAN_FEATURES))
    return f, of.choice(values)[f] + of.choice([0.0, 1e-3, -1e-3]), grown(of, depth - 1, values), grown(of, depth - 1, values)


def walked(node, x):
    while not isinstance(node, float):
        node = node[2] if x[node[0]] <= node[1] else node[3]
    return node


def test_lists_hold_the_best_candidates(made):
    lists, features = made[2], made[3]
    rows = lists.collect()
    assert sorted((r.entity_id, c) for r in rows for c in r.cands) == sorted(features) and len(features) > 500
    assert all(len(r.cands) == len(r.places) for r in rows)


def test_every_feature_lies_within_its_bounds(made):
    s1, corpus, _, features = made
    a, b = ({r.entity_id: np.frombuffer(r.sketch, Bo.SKETCH)[0] for r in Bo.sketched(x).collect()} for x in (s1, corpus))
    got = Bo.feature_bounds(np.array([a[x] for x, _ in features]), np.array([b[y] for _, y in features]))
    narrow = 0
    for j, name in enumerate(X.CLEAN_FEATURES):
        lo, hi = got[name]
        value = np.array([x[j] for x in features.values()])
        assert (lo <= value).all() and (value <= hi).all(), name
        narrow += (hi < 0.99).sum()
    assert narrow > 3 * len(features)


@pytest.mark.parametrize("seed", range(3))
def test_pairs_left_out_score_below_the_least(spark, made, seed):
    s1, corpus, lists, features = made
    of = random.Random(seed)
    trees = [(1.0 if not i else 0.3, grown(of, 6, list(features.values()))) for i in range(12)]
    score = {pair: sum(w * walked(t, x) for w, t in trees) for pair, x in features.items()}
    least = sorted(score.values())[-40]
    bounds = Bo.Bounds(trees, least)
    assert bounds._tabulate()
    got = {(r.s1_id, r.cand_id) for r in C.listed_pairs(lists, s1, corpus, X.CLEAN_FIELDS, X.CLEAN_OVERLAPS, bounds).collect()}
    assert {pair for pair, x in score.items() if x >= least + 1e-9} <= got <= set(features)
    assert len(got) < len(features)


def test_without_bounds_listed_pairs_are_all_pairs_with_their_features(made):
    s1, corpus, lists, features = made
    rows = X.clean_features_of(C.listed_pairs(lists, s1, corpus, X.CLEAN_FIELDS, X.CLEAN_OVERLAPS), ["s1_id", "cand_id"]).collect()
    assert {(r.s1_id, r.cand_id): [0.0 if r[c] is None else r[c] for c in X.CLEAN_FEATURES] for r in rows} == features


def test_sampled_lists_are_the_sampled_pairs(spark, made):
    _, _, lists, features = made
    pairs = sorted(features)
    truth = spark.createDataFrame(random.Random(5).sample(pairs, 60) + pairs[:2] + [("S1-00001", "S3-none")], "s1_id string, cand_id string")
    want = L.sampled(spark.createDataFrame(pairs, "s1_id string, cand_id string"), truth, per_positive=3, most=7).select("s1_id", "cand_id")
    by_place = lists.select("entity_id", F.explode(F.arrays_zip("cands", "places")).alias("x")).select("entity_id", "x.*")
    taken = L.sampled_lists(lists, truth, per_positive=3, most=7).select("entity_id", F.explode("places").alias("places"))
    got = taken.join(by_place, ["entity_id", "places"]).select("entity_id", "cands")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and taken.count() == want.count() < len(pairs)


def test_a_models_text_is_read_whole_or_not_at_all():
    said = "GBTClassificationModel: uid = x, numTrees=2, numClasses=2, numFeatures=22\n  Tree 0 (weight 1.0):\n    If (feature 3 <= 0.5)\n     Predict: -1.0\n    Else (feature 3 > 0.5)\n     Predict: 1.5E-4\n  Tree 1 (weight 0.05):\n    Predict: 0.25\n"
    assert Bo.parsed(said) == [(1.0, (3, 0.5, -1.0, 1.5e-4)), (0.05, 0.25)]
    assert Bo.parsed(said.replace("<= 0.5", "in {0.0}")) is None
    assert Bo.parsed(said.replace("     Predict: 1.5E-4\n", "")) is None


def test_the_model_query_blocks_once_and_matches_as_all_pairs_do(spark, sf_dir, monkeypatch):
    asked, kept, frequent, bounds = [], [], C.frequent_keys, Q.M.Matcher.bounds
    monkeypatch.setattr(C, "frequent_keys", lambda *x: asked.append(1) or frequent(*x))
    monkeypatch.setattr(Q.M.Matcher, "bounds", lambda self: kept.append(self) or bounds(self))
    got = {r.source1_entity_id: r.matched_entity_ids for r in Q.model_fit_predict(spark, sf_dir).collect()}
    assert len(asked) == 1 and kept[0].bounds()
    s1, corpus = Q.fx.sources(spark, sf_dir)
    pairs = C.best_candidates(s1, corpus, Q.KEPT, carry=X.CLEAN_FIELDS, overlaps=X.CLEAN_OVERLAPS)
    want = Q.M.predict(kept[0], X.clean_features_of(pairs, ["s1_id", "cand_id"]), s1).collect()
    assert got == {r.source1_entity_id: r.matched_entity_ids for r in want} and any(got.values())
