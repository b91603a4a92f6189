"""The best candidates without a shuffle of pairs, held against the plain join and window."""

import random

import pytest
from pyspark.sql import functions as F

from kithline.functions import similarity as S
from kithline.operators import blocking as B
from kithline.operators import cells as C
from kithline.operators import evaluation as E
from kithline.operators import features as X
from kithline.plans import files
from kithline.plans.queries import QUERIES as PLAIN

QUERIES = PLAIN | files.QUERIES
FIELDS = ["entity_id", "business_name_core", "business_name_blockkey", "business_address_clean", "postal_code", "country"]


def records(spark, prefix, n, seed, countries=("US", "France", None)):
    of = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "𝄞x"]
    rows = []
    for i in range(n):
        name = " ".join(of.choices(words, k=of.randint(0, 4)))
        address = " ".join(of.choices(words, k=of.randint(0, 6)))
        rows.append((f"{prefix}{i % (n - 3):05d}", name, " ".join(sorted(name.split())), None if i % 29 == 0 else address, of.choice(["", "12345", "999"]), countries[i % (n - 3) % len(countries)]))
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in FIELDS))


@pytest.mark.parametrize("countries", [("US", "France", None), ("US",)])
def test_best_candidates_are_those_of_the_plain_way(spark, monkeypatch, countries):
    queries, corpus = records(spark, "q", 90, 1, countries), records(spark, "c", 400, 2, countries)
    monkeypatch.setattr(C, "MIN_PART", 8)
    want = sorted(map(tuple, B.top_candidates(B.scores(queries, corpus), 7).select("s1_id", "cand_id", "score", "rank").collect()))
    got = sorted(map(tuple, C.best_candidates(queries, corpus, 7).collect()))
    assert len(want) > 300 and got == want


def test_carried_columns_are_those_of_a_join_and_repeated_records_give_repeated_pairs(spark):
    queries, corpus = records(spark, "q", 60, 3), records(spark, "c", 200, 4)
    pairs = B.top_candidates(B.scores(queries, corpus), 5).select("s1_id", "cand_id", "score")
    of = lambda df, id_, side: df.selectExpr(f"entity_id {id_}", f"business_name_core {side}_business_name_core", f"business_address_clean {side}_business_address_clean")
    want = pairs.join(of(queries, "s1_id", "l"), "s1_id").join(of(corpus, "cand_id", "r"), "cand_id")
    got = C.best_candidates(queries, corpus, 5, carry=["business_name_core", "business_address_clean"]).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("countries", [("US", "France", None), ("US",)])
def test_overlaps_are_those_of_the_jvm(spark, countries):
    queries, corpus = (records(spark, x, n, n, countries).na.fill("") for x, n in (("q", 50), ("c", 150)))
    asked = {"t": ("business_address_clean", 0), "g2": ("business_name_core", 2), "g3": ("business_address_clean", 3)}
    got = C.best_candidates(queries, corpus, 9, carry=["business_name_core", "business_address_clean"], overlaps=asked)
    made = {"t": S.jaccard(F.col("l_business_address_clean"), F.col("r_business_address_clean")), "g2": S.ngram_similarity(F.col("l_business_name_core"), F.col("r_business_name_core"), 2)}
    made["g3"] = S.ngram_similarity(F.col("l_business_address_clean"), F.col("r_business_address_clean"))
    assert got.count() > 200 and got.where(" or ".join(f"{c} > 0 and {c} < 1" for c in made)).count() > 100
    assert got.select(*asked, *[x.alias(f"{c}_") for c, x in made.items()]).where("t <> t_ or g2 <> g2_ or g3 <> g3_ or t + g2 + g3 is null").count() == 0


def test_ids_of_several_countries_and_no_queries(spark):
    queries, corpus = records(spark, "q", 30, 5), records(spark, "c", 90, 6)
    both = corpus.unionByName(corpus.replace({"US": "France"}, subset=["country"]))
    want = B.top_candidates(B.scores(queries, both), 4).select("s1_id", "cand_id", "score", "rank")
    assert sorted(C.best_candidates(queries, both, 4).collect()) == sorted(want.collect())
    assert C.best_candidates(queries.limit(0), corpus, 4).count() == 0
    assert C.best_candidates(queries, corpus.limit(0), 4, carry=["business_name_core"]).count() == 0


@pytest.mark.parametrize("name", ["candidates_topk", "jaccard", "features_clean", "features_raw", "kept_model_predict", "lcs_ratio", "match_cap", "macro_f05", "matched_counts", "matches_assemble", "osa_ratio", "pair_flags", "ngram_sim", "set_extensions", "token_sort_ratio"])
def test_pairs_are_not_shuffled(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "cand_id" in x.split(")")[0]]


@pytest.mark.parametrize("name, texts", [("lcs_ratio", ["name_core"]), ("osa_ratio", ["name_core"]), ("token_sort_ratio", ["name_core"]), ("set_extensions", ["address_clean"]), ("pair_flags", ["name_core", "address_clean"])])
def test_only_texts_that_are_asked_for_are_shuffled(spark, sf_dir, monkeypatch, name, texts):
    asked, best = [], C.best_candidates
    monkeypatch.setattr(C, "best_candidates", lambda *a, carry, **more: asked.append(carry) or best(*a, carry=carry, **more))
    QUERIES[name](spark, sf_dir)
    assert asked == [[f"business_{x}" for x in texts]]


def test_overlaps_that_pairs_have_are_not_worked_out_again(spark):
    fields = {c: "" for c in X.CLEAN_FIELDS}
    records = spark.createDataFrame([{"entity_id": "a"} | fields])
    pairs = spark.createDataFrame([("a", "a", 0.25)], "s1_id string, cand_id string, addr_jaccard double")
    row = X.clean_features(pairs, records, records).first()
    assert row.addr_jaccard == 0.25 and row.name_jaccard == 1.0


def test_keys_are_made_once_a_record_however_many_parts_it_goes_to(spark, capfd):
    C.best_candidates(records(spark, "q", 60, 7), records(spark, "c", 90, 8), 5, overlaps={"t": ("business_address_clean", 0)}).explain()
    plan = capfd.readouterr().out.splitlines()
    at = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
    above = [p for i, p in enumerate(plan) if "Project [" in p and i + 1 < len(plan) and "Generate explode(sequence(" in plan[i + 1] and at(plan[i + 1]) > at(p)]
    assert len(above) >= 3 and not [p for p in above if "xxhash64" in p]


def test_the_sweep_shuffles_no_pairs(spark, sf_dir):
    plan = QUERIES["threshold_sweep"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString().splitlines()
    from_pairs = [i for i, x in enumerate(plan) if "MapInArrow" in x or "PythonMapInArrow" in x]
    last = max(i for i in range(from_pairs[0]) if "Exchange " in plan[i])
    assert from_pairs and any("HashAggregate" in x for x in plan[last:from_pairs[0]])


def test_a_sweep_of_pairs_that_know_their_hits_is_that_of_a_join(spark):
    scored = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.4), ("b", "z", 0.5), ("b", "y", 0.7)], "s1_id string, cand_id string, score double")
    truth = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "y"), ("b", "v"), ("c", "x")], "s1_id string, cand_id string")
    hits = {("a", "x"): 1, ("b", "y"): 2}
    known = spark.createDataFrame([(*r, hits.get((r.s1_id, r.cand_id), 0)) for r in scored.collect()], "s1_id string, cand_id string, score double, hit int")
    assert sorted(E.threshold_sweep(known, truth).collect()) == sorted(E.threshold_sweep(scored, truth).collect())


@pytest.mark.parametrize("grid", [E.GRID, E.GRID[:1], E.GRID[:7], E.GRID[:16]])
def test_the_place_of_a_score_is_the_number_of_grid_values_up_to_it(spark, grid):
    scores = [*E.GRID, *[x + 1e-9 for x in E.GRID], *[x - 1e-9 for x in E.GRID], 0.0, 1.0, float("nan"), None]
    got = spark.createDataFrame([(x,) for x in scores], "score double").select("score", E._place(F.col("score"), grid).alias("place")).collect()
    assert [r.place for r in got] == [0 if x is None else len(grid) if x != x else sum(t <= x for t in grid) for x in scores]


def test_pairs_get_what_is_made_of_a_carried_column(spark):
    queries, corpus = records(spark, "q", 60, 3), records(spark, "c", 200, 4)
    both = corpus.unionByName(corpus.replace({"US": "France"}, subset=["country"]))
    size = F.length("business_address_clean")
    for of in (corpus, both):
        whole = C.best_candidates(queries, of, 5, carry=["business_name_core", "business_address_clean"], overlaps={"g": ("business_address_clean", 3)})
        want = whole.withColumns({c: F.length(c) for c in ("l_business_address_clean", "r_business_address_clean")})
        got = C.best_candidates(queries, of, 5, carry=["business_name_core", "business_address_clean"], overlaps={"g": ("business_address_clean", 3)}, carry_as={"business_address_clean": size})
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("name", ["pair_flags", "set_extensions"])
def test_tokens_and_digits_are_made_once_a_record_not_once_a_pair(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    of_pairs = plan[: next(i for i, x in enumerate(plan) if "MapInArrow" in x)]
    assert of_pairs and not [x for x in of_pairs if any(f in x for f in ("regexp_replace(", "split(", "array_intersect("))]


def test_shared_entries_come_back_from_a_jaccard(spark):
    rows = [(both, n, m, both / (n + m - both) if n + m else 1.0) for n in range(41) for m in range(41) for both in range(min(n, m) + 1)]
    got = spark.createDataFrame(rows, "k int, n int, m int, j double").select("k", S.shared_of(F.col("j"), F.col("n"), F.col("m")).alias("s"))
    assert got.where("s <> k or s is null").count() == 0
