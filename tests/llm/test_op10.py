import random
import re

import pytest

from kithline.llm import mixing
from kithline.llm.mixing import mix_sources
from kithline.llm.queries import op10_mixing


def targets(sizes, weights=(5, 2, 1), most=3.0):
    """Sharing and resharing as told, source by source."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            return got | {s: level * weight[s] for s in free}
        got |= {s: most * sizes[s] for s in over}
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return got


def check(rows, made, slack):
    size = {}
    for _, s, t in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(size)
    taken = dict.fromkeys(size, 0)
    assert len(made) == len(rows)
    for r in made:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 3 * r.size
        assert r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= slack(s, want[s]), (s, taken[s], want[s])


@pytest.mark.parametrize(("stratum", "slack"), [(5_000, 40), (40, 1_000)])
def test_targets_and_copies(spark, monkeypatch, stratum, slack):
    monkeypatch.setattr(mixing, "STRATUM", stratum)
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "c", "é", "Z", None, ""] + ["hot"] * 4), "w " * int(rng.paretovariate(1) * 5)) for i in range(600)]
    rows += [(None, "tiny", "one two"), (7, "tiny", None), (8, "none", ""), (8, "none", "")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, size int, id int").repartition(3)
    one = mix_sources(df).collect()
    check(rows, one, lambda s, want: slack + 0.001 * want)
    two = mix_sources(df.repartition(5)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.size, r.taken)
    assert sorted(map(key, one)) == sorted(map(key, two))


def test_query_on_the_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    made = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    check(docs, made, lambda s, want: 60 + 0.005 * want)
    assert {(r.doc_id, r.taken) for r in op10_mixing(spark, sf_dir).collect()} == {(r.doc_id, r.taken) for r in made}


def test_many_rows_without_an_id_are_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRATUM", 50)
    round_ = mixing._round
    monkeypatch.setattr(mixing, "_round", lambda most: lambda pdf: round_(most)(pdf).assign(source_size=len(pdf)))
    rng = random.Random(1)
    rows = [(None, "a", "w " * rng.randint(0, 400)) for _ in range(2_000)] + [(None, "b", "same text")] * 3_000 + [(1, "c", "x y z")] * 500
    made = mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert len(made) == len(rows)
    assert max(r.source_size for r in made) <= 100  # rows of the largest group
    monkeypatch.undo()
    check(rows, mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect(), lambda s, want: 40 + 0.001 * want)


def test_rates_that_do_not_settle_raise(spark, monkeypatch):
    sizes = spark.createDataFrame([("a", 1, 5), ("a", 90, 2)], "source string, size long, n long")
    goals = spark.createDataFrame([("a", 185, 7, 5.0, 60.0)], "source string, source_size long, n long, weight double, target double")
    assert mixing.tilts(sizes, goals, 3.0).first().tilt < 0
    with pytest.raises(RuntimeError, match="1 sources"):
        mixing.tilts(sizes, goals, 3.0, rounds=1)


def test_empty_table(spark):
    assert mix_sources(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0
