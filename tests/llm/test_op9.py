import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from kithline.llm import top_k
from kithline.llm.queries import OP9_SQL
from kithline.llm.top_k import exact_top_k, threshold_search


def brute(rows, asks, k=5):
    """Every row is a candidate, repeated ones too; rows of one query id share a ranking."""
    sound = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q in {i for i, _ in sound if asks(i)}:
        found = sorted((-sum(a * b for a, b in zip(u, v, strict=True)), i) for j, u in sound if j == q for i, v in sound if i != q and len(u) == len(v))[:k]
        out |= {(q, r + 1): (i, -s) for r, (s, i) in enumerate(found)}
    return out


@pytest.mark.parametrize(("block", "query_block"), [(8_192, 20_000), (13, 5)])
def test_against_brute_force(spark, monkeypatch, block, query_block):
    monkeypatch.setattr(top_k, "BLOCK", block)
    monkeypatch.setattr(top_k, "QUERY_BLOCK", query_block)
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(120)]  # many ties
    rows += [(200 + i, rng.normal(size=6).tolist()) for i in range(8)]
    rows += [(300, None), (305, []), (310, [1.0, None, 2.0, 3.0]), (315, [1.0, float("nan"), 0.0, 0.0]), (320, [float("inf")] * 4), (None, [1.0] * 4), (325, [0.0] * 4), (330, [1e6, -1e6, 1e5, 1e9]), (0, rows[0][1]), *[(7, rows[7][1])] * 8]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, id string")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in exact_top_k(df, F.col("vec_id") % 5 == 0).collect()}
    assert got == brute(rows, lambda i: i % 5 == 0)


def test_the_search_stops_early_where_it_can():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(5000, 3)) ** 3
    order = np.argsort(v.T, axis=1)
    q = np.array([1.0, -0.5, 2.0])
    ids, scores, seen = threshold_search(np.arange(5000), v, order, q, -1, 5)
    assert set(ids) == set(np.argsort(-(v @ q))[:5])
    assert seen < 1000


def test_repeated_rows_as_in_sql(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0, 1.0]), (3, [0.5, 0.25]), (50, [2.0, 0.0]), (50, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted(tuple(r) for r in exact_top_k(df, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score").collect())
    con = duckdb.connect()
    table = pa.table({"vec_id": [i for i, _ in rows], "embedding": pa.array([v for _, v in rows], pa.list_(pa.float32()))})
    con.register("embeddings", table)
    assert got == sorted(con.execute(OP9_SQL).fetchall())
    assert [r[2] for r in got if r[0] == 0] == [1, 1, 2, 50, 50]


def test_huge_components(spark):
    near = [(0, [1e7, 1.0]), (1, [3.0, -1.0]), (2, [-3e6, 5.0]), (3, [1.0, 1.0]), (4, [3.0, -1e7])]  # their bound does not fit into 64 bits, the scores do
    df = spark.createDataFrame(near, "vec_id long, embedding array<double>")
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in exact_top_k(df, F.col("vec_id") == 0).collect()} == brute(near, lambda i: i == 0)
    for far in ([(0, [1e17, 0.0]), (1, [1e17, 0.0])], [(0, [1e15, 0.0]), (1, [1e15, 0.0])]):
        with pytest.raises(PythonException):
            exact_top_k(spark.createDataFrame(far, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()


def test_empty_table(spark):
    assert exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 5 == 0).count() == 0
