"""Each query with an oracle, held against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from kithline.plans import files, fixtures
from kithline.plans.oracles import ORACLES, SLOW
from kithline.plans.queries import QUERIES as PLAIN

QUERIES = PLAIN | files.QUERIES
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(x):
    return round(x, 6) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    compare(QUERIES[name](spark, sf_dir), duck, ORACLES[name])


@pytest.fixture(scope="module")
def few_documents(tmp_path_factory):
    """A folder with 72 documents of the smallest tables, and DuckDB with them."""
    folder = tmp_path_factory.mktemp("few")
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id LIMIT 72) TO '{folder}/documents.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", sorted(SLOW))
def test_same_rows_as_slow_sql_on_a_small_fixture(spark, few_documents, name):
    df = QUERIES[name](spark, few_documents[0])
    assert df.count() > 100
    compare(df, few_documents[1], SLOW[name])


def compare(df, duck, sql):
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=str)
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    want = sorted((tuple(plain(dict(zip(columns, r, strict=True))[c]) for c in names) for r in cursor.fetchall()), key=str)
    assert got == want


def test_the_model_gives_every_record_a_row(spark, sf_dir):
    rows = QUERIES["model_fit_predict"](spark, sf_dir).collect()
    assert len({r.source1_entity_id for r in rows}) == len(rows) == 67


def test_entry(spark):
    assert entry_module.entry(spark).count() == 67
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", ["jaccard", "features_raw", "label_pairs"])
def test_every_candidate_of_blocking_is_looked_at(spark, sf_dir, name):
    of = {}
    for r in QUERIES["block_scores"](spark, sf_dir).collect():
        of.setdefault(r.s1_id, []).append((-r.score, r.cand_id))
    want = sorted((s1, cand) for s1, found in of.items() for _, cand in sorted(found)[:300])
    assert max(map(len, of.values())) > 3
    assert sorted((r.s1_id, r.cand_id) for r in QUERIES[name](spark, sf_dir).collect()) == want


def test_missed_truth_is_what_blocking_does_not_find(spark, sf_dir):
    found = {(r.s1_id, r.cand_id) for r in QUERIES["block_scores"](spark, sf_dir).collect()}
    true = {(r.s1_id, r.cand_id) for r in fixtures.truth(spark, sf_dir).collect()}
    assert {(r.s1_id, r.cand_id) for r in QUERIES["missed_truth"](spark, sf_dir).collect()} == true - found
