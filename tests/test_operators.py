import pytest
from pyspark.sql import functions as F

from kithline.cli import main
from kithline.functions.normalize import clean_records
from kithline.operators import blocking as B
from kithline.operators import evaluation as E
from kithline.operators import features as X
from kithline.operators import labels as L
from kithline.operators import matching as M
from kithline.operators import validate as V
from kithline.plans import fixtures as fx
from kithline.sources import tables as T
from kithline.streaming.arrivals import block_stream, build_index

RECORD = "entity_id string, business_name string, business_address string, country string"
MINI = [
    ("S1-001", "Starbucks Coffee Pvt Ltd", "MG Road, Delhi", "India"), ("S2-101", "Starbucks Coffee Private Limited", "M.G. Road Delhi", "India"),
    ("S2-102", "ABC Restaurant", "Connaught Place", "India"), ("S3-201", "Starbucks Coffee", "MG Rd, New Delhi", "India"), ("S3-202", "Starbucks Coffee", "Mumbai", "India"),
    ("S3-203", "Starbucks Coffee", "MG Rd Delhi", "US"),
]


@pytest.fixture(scope="module")
def mini(spark):
    rows = clean_records(spark.createDataFrame(MINI, RECORD))
    return rows.where("entity_id LIKE 'S1%'"), rows.where("entity_id NOT LIKE 'S1%'")


def test_blocking_stays_in_the_country_and_scores(mini):
    got = {r.cand_id: r.score for r in B.scores(*mini).collect()}
    assert set(got) == {"S2-101", "S3-201", "S3-202"}
    assert got["S2-101"] == pytest.approx(3 + 14 * 0.2 + 6)
    assert got["S3-202"] == pytest.approx(3 + 14 * 0.2)
    lists = B.block(*mini, 2).collect()
    assert [(r.source1_entity_id, r.ids) for r in lists] == [("S1-001", ["S2-101", "S3-201"])]


def test_a_repeated_address_token_counts_again(spark):
    q = clean_records(spark.createDataFrame([("S1-1", "x", "oak oak", "US"), ("S1-2", "", "", "US")], RECORD))
    c = clean_records(spark.createDataFrame([("S2-1", "y", "oak", "US")], RECORD))
    assert [tuple(r) for r in B.scores(q, c).collect()] == [("S1-1", "S2-1", 4.0)]
    assert sorted((r.source1_entity_id, r.ids) for r in B.block(q, c).collect()) == [("S1-1", ["S2-1"]), ("S1-2", [])]


def test_frequent_keys_are_dropped(spark):
    c = clean_records(spark.createDataFrame([(f"S2-{i}", "common" + (" rare" if i < 50 else ""), "", "US") for i in range(51)], RECORD))
    assert {r.key for r in B.postings(c, B.TOKEN).collect()} == {"rare"}


def test_recall(spark):
    lists = spark.createDataFrame([("a", ["x", "y"]), ("b", ["z"]), ("c", [])], "source1_entity_id string, ids array<string>")
    truth = spark.createDataFrame([("a", "x,q"), ("b", "z"), ("d", "r")], "source1_entity_id string, matched_entity_ids string")
    r = B.recall(lists, truth).first()
    assert (r.entities, r.true_pairs, r.found_pairs, r.full_recall, r.pair_recall, r.avg_candidates) == (3, 3, 2, 2, 2 / 3, 1.0)


def test_negative_budget_and_sample(spark):
    assert [tuple(r) for r in spark.createDataFrame([(0,), (3,), (50,)], "n int").select(L.negative_budget(F.col("n"))).collect()] == [(20,), (60,), (200,)]
    pairs = spark.createDataFrame([("a", f"c{i}") for i in range(40)] + [("a", "c1")], "s1_id string, cand_id string")
    truth = spark.createDataFrame([("a", "c1"), ("a", "lost")], "s1_id string, cand_id string")
    got = L.sampled(pairs, truth, per_positive=5, least=1, most=8).collect()
    assert (sum(r.label for r in got), len(got)) == (1, 9)
    assert [tuple(r) for r in L.missed(pairs, truth).collect()] == [("a", "lost")]


def test_id_lists_are_trimmed(spark):
    lists = spark.createDataFrame([("a", " x, ,y ,"), ("b", ""), ("c", None)], "s string, l string")
    assert sorted(tuple(r) for r in L.exploded(lists, "s", "l").collect()) == [("a", "x"), ("a", "y")]


def test_macro_f05_and_sweep(spark):
    schema = "source1_entity_id string, matched_entity_ids string"
    truth = spark.createDataFrame([("a", ""), ("b", ""), ("c", "x,y"), ("d", "x")], schema)
    given = spark.createDataFrame([("b", "z"), ("c", "x"), ("d", "")], schema)
    assert E.macro_f05(given, truth).first()[0] == pytest.approx((1 + 0 + 1.25 * 0.5 / 0.75 + 0) / 4)
    scored = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.4), ("b", "z", 0.5)], "s1_id string, cand_id string, score double")
    pairs = spark.createDataFrame([("a", "x")], "s1_id string, cand_id string")
    sweep = E.threshold_sweep(scored, pairs)
    for r in sweep.collect():
        kept = scored.where(F.col("score") >= r.threshold)
        lists = spark.createDataFrame([("a", "x"), ("b", "")], schema)
        assert r.f05 == pytest.approx(E.macro_f05(E.matches(kept, 0.0), lists).first()[0], abs=1e-8)
        if r.threshold > 0.6:
            break
    assert E.best_threshold(sweep) == E.GRID[45]  # the grid value next to 0.5 lies above it


def test_features_of_unknown_records(spark, mini):
    pairs = spark.createDataFrame([("S1-001", "S3-201"), ("S1-001", "nobody")], "s1_id string, cand_id string")
    got = {r.cand_id: r for r in X.clean_features(pairs, *mini).collect()}
    assert list(got["S3-201"].asDict())[2:] == X.CLEAN_FEATURES
    assert (got["S3-201"].name_exact_match, got["S3-201"].source_is_s3, got["S3-201"].country_match) == (1.0, 1.0, 1.0)
    assert (got["nobody"].name_dl_ratio, got["nobody"].country_both_known) == (0.0, 0.0)


def test_validation(spark):
    lists = spark.createDataFrame([("a", ["x", "x"]), ("a", ["q"]), ("z", [])], "source1_entity_id string, ids array<string>")
    of = lambda *ids: spark.createDataFrame([(i,) for i in ids], "entity_id string")
    got = {r.metric: r.value for r in V.validate_lists(lists, of("a", "b"), of("x", "y")).collect()}
    assert got == {"missing": 1, "unexpected": 1, "duplicates": 1, "empty_rows": 1, "rows_with_unknown_ids": 1, "rows_with_repeated_ids": 1, "candidates": 3}


def test_merged_lookup(spark):
    s2 = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c")], "entity_id string, name string")
    s3 = spark.createDataFrame([("2", "d")], "entity_id string, name string")
    assert sorted(tuple(r) for r in X.merged_lookup(s2, s3, ["name"]).collect()) == [("1", "b"), ("2", "d")]


def test_plans_do_not_depend_on_the_number_of_partitions(spark, sf_dir):
    s1, corpus = fx.sources(spark, sf_dir)
    got = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(sorted((r.source1_entity_id, r.ids) for r in B.block(s1, corpus, 20).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]
    assert all(len(ids) <= 20 for _, ids in got[0])
    assert len(got[0]) == s1.count()


def test_stream_of_arrivals(spark, sf_dir, tmp_path):
    s1, corpus = fx.sources(spark, sf_dir)
    build_index(corpus, str(tmp_path / "index"))
    raw = fx.records(spark, sf_dir).where("entity_id LIKE 'S1-%'")
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    block_stream(spark, stream, str(tmp_path / "index"), str(tmp_path / "out"), str(tmp_path / "state"), 20).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("s1_id", "cand_id", "score", "rank")
    want = B.top_candidates(B.scores(s1, corpus), 20)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("s1_id", "cand_id", "score", "rank").collect()))
    assert spark.read.parquet(str(tmp_path / "out")).select("batch").distinct().count() == 3


def test_command_line_from_raw_files_to_results(spark, sf_dir, tmp_path, capsys):
    rows = fx.records(spark, sf_dir).withColumns({"business_name": F.regexp_replace("business_name", r"\s+", " "), "business_address": F.regexp_replace("business_address", r"\s+", " ")})
    for k in (1, 2, 3):
        T.write_tsv(rows.where(F.col("entity_id").startswith(f"S{k}-")), str(tmp_path / f"raw/train_source{k}.tsv"))
    truth = fx.truth_lists(spark, sf_dir).select("source1_entity_id", F.split("matched_entity_ids", ",").alias("matched_entity_ids"))
    T.write_id_list(truth, str(tmp_path / "raw/train_ground_truth.tsv"), "source1_entity_id", "matched_entity_ids")
    with pytest.raises(SystemExit):
        main(["preprocess", "--input", "x"], spark)
    assert main(["preprocess", "--input-dir", str(tmp_path / "raw"), "--output-dir", str(tmp_path / "clean")], spark) == 0
    clean = [str(tmp_path / f"clean/train_source{k}_clean.tsv") for k in (1, 2, 3)]
    assert T.read_clean(spark, clean[0]).columns[:4] == T.RAW_COLUMNS
    pairs = str(tmp_path / "pairs.tsv")
    gold = str(tmp_path / "raw/train_ground_truth.tsv")
    assert main(["block", "--clean-dir", str(tmp_path / "clean"), "--split", "train", "--ground-truth", gold, "--output", pairs, "--max-candidates", "15"], spark) == 0
    sources = ["--source1", clean[0], "--source2", clean[1], "--source3", clean[2]]
    assert main(["validate", *sources, "--lists", pairs], spark) == 0
    model, out = str(tmp_path / "model"), str(tmp_path / "out")
    assert main(["train", *sources, "--ground-truth", gold, "--candidate-pairs", pairs, "--model-out", model, "--rounds", "3"], spark) == 0
    assert main(["predict", *sources, "--candidate-pairs", pairs, "--model", model, "--out-dir", out, "--max-matches-per-entity", "2"], spark) == 0
    made = T.read_id_list(spark, f"{out}/matching_results.tsv", "source1_entity_id", "matched_entity_ids").collect()
    assert len(made) == 67
    given = {r.source1_entity_id: set(r.candidate_entity_ids.split(",")) for r in T.read_id_list(spark, pairs, "source1_entity_id", "candidate_entity_ids").collect()}
    for r in made:
        ids = [x for x in r.matched_entity_ids.split(",") if x]
        assert len(ids) <= 2
        assert set(ids) <= given[r.source1_entity_id]
    loaded = M.Matcher.load(spark, model)
    assert loaded.features == X.CLEAN_FEATURES
    assert "recall" in capsys.readouterr().out


@pytest.mark.parametrize("backend", ["gbt", "forest", "logistic"])
def test_a_matcher_learns_what_tells_pairs_apart(spark, backend):
    rows = [(f"S1-{i}", f"S2-{i}-{j}", int(j == 0), 0.9 - 0.001 * (i % 7) if j == 0 else 0.1 * j, float(i % 3)) for i in range(150) for j in range(4)]
    pairs = spark.createDataFrame(rows, "s1_id string, cand_id string, label int, a double, b double")
    truth = pairs.where("label = 1").select("s1_id", "cand_id")
    matcher, sweep = M.fit(pairs, truth, ["a", "b"], rounds=5, depth=3, backend=backend)
    made = M.predict(matcher, pairs, pairs.select(F.col("s1_id").alias("entity_id")).distinct())
    lists = truth.select(F.col("s1_id").alias("source1_entity_id"), F.col("cand_id").alias("matched_entity_ids"))
    assert E.macro_f05(made, lists).first()[0] > 0.95
    assert sweep.count() == 91
