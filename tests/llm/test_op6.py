import re

import duckdb
import pytest

import __spark_entry__ as entry_module
from kithline.llm.license_scan import DRIFT, PHRASES, TEMPLATES, cut, scan
from kithline.llm.license_texts import WHOLE
from kithline.llm.queries import op6_license_scan


def base(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, label) for p, label in PHRASES.items() for k in [p.split()] for i in range(len(w) - len(k) + 1) if w[i : i + len(k)] == k]
    return len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at})), w


def method(w):
    """Templates whose first key phrase stands, with all others near their relative places, and the best share of words in place."""
    found, score = set(), 0.0
    for label, text, phrases in TEMPLATES:
        t = cut(text)
        offsets = []
        for p in map(cut, phrases):
            start = next(i for i in range(len(t)) if t[i : i + len(p)] == p)
            offsets.append([i - start for i in range(len(w)) if w[i : i + len(p)] == p])
        for off in offsets[0]:
            if all(any(abs(o - off) <= DRIFT for o in other) for other in offsets):
                found.add(label)
                score = max(score, sum(0 <= off + i < len(w) and w[off + i] == x for i, x in enumerate(t)) / len(t))
    return found, score


def put(text, at, n):
    """text with n words put in at a word's place."""
    w = text.split()
    return " ".join(w[:at] + ["word"] * n + w[at:])


TEXTS = [
    None, "", "...", "MIT License", "mit-license MIT  LICENSE; xmit license", "the Apache License, Version 2.0 and the Apache License", "GENERAL public\nlicense general public licence",
    "mit é license", "mitKa License İ", "Released under the MIT License.", "a b c " * 500 + "This work is licensed under the GNU General Public License, version 3", "GNU GPL version 3",
    *[t for _, t, _ in WHOLE], *[put(t, 30, n) for _, t, _ in WHOLE for n in (1, DRIFT, DRIFT + 1)], " ".join(t for _, t, _ in WHOLE) * 3, " ".join(reversed(WHOLE[0][1].split())), "word " * 70_000 + WHOLE[0][1],
    "Permission is hereby granted free of charge to any one", "version 3 license public general gnu", "x" * 9000, "licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0 " * 40, "under the " * 2000,
]


def check(rows, got):
    assert len(got) == len(rows)
    for (i, t), r in zip(rows, sorted(got, key=lambda r: r.doc_id), strict=True):
        *want, w = base(t)
        assert [r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels] == want, (i, t)
        found, score = method(w)
        assert r.labels == ",".join(sorted(found | set(filter(None, r.base_labels.split(","))))), (i, t)
        assert r.score == pytest.approx(score)


def test_against_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(99, TEXTS[3])] * 2
    check(rows, scan(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, hits int").repartition(3)).collect())


def test_query_on_the_whole_table(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    check(docs, op6_license_scan(spark, sf_dir).collect())


def test_no_python_in_the_plan(spark, sf_dir):
    made = op6_license_scan(spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow", made._jdf.queryExecution().toString())


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("template", WHOLE, ids=[t[0] for t in WHOLE])
def test_a_whole_text_is_found_with_changed_words_and_not_without_a_key_phrase(spark, template):
    label, text, phrases = template
    w = cut(text)
    near = " ".join("changed" if i % 23 == 22 and not any(x in cut(p) for p in phrases) else x for i, x in enumerate(w))
    gone = " ".join(w).replace(" ".join(cut(phrases[-1])), "something else")
    a, b, c = sorted(scan(spark.createDataFrame([(0, text), (1, near), (2, gone)], "doc_id long, text string")).collect(), key=lambda r: r.doc_id)
    assert label in a.labels.split(",") and a.score == 1.0
    assert label in b.labels.split(",") and b.score > 0.8
    assert label not in c.labels.split(",")


def test_two_and_three_clauses_are_told_apart(spark):
    of = {label: t for label, t, _ in WHOLE}
    two, three = sorted(scan(spark.createDataFrame([(0, of["bsd-2-clause"]), (1, of["bsd-3-clause"])], "doc_id long, text string")).collect(), key=lambda r: r.doc_id)
    assert two.labels == "bsd,bsd-2-clause" and three.labels == "bsd,bsd-3-clause"


def test_sql_on_whole_texts(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    cursor = con.execute(entry_module.oracle_sql()["op6_license_scan"])
    names = [d[0] for d in cursor.description]
    want = sorted(cursor.fetchall())
    got = sorted(tuple(r[n] for n in names) for r in scan(docs).collect())
    assert [g[:-1] for g in got] == [x[:-1] for x in want]
    assert [g[-1] for g in got] == pytest.approx([x[-1] for x in want])


@pytest.mark.parametrize("phrases", [[], ["not there"]])
def test_a_template_without_its_key_phrase_raises(spark, phrases):
    with pytest.raises(ValueError):
        scan(spark.createDataFrame([(0, "x")], "doc_id long, text string"), templates=[("a", "some text", phrases)])
