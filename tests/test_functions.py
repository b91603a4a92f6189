import random

import pytest
from pyspark.sql import functions as F

from kithline.functions import keys as K
from kithline.functions import normalize as N
from kithline.functions import similarity as S


def names(spark, rows, country="US"):
    df = spark.createDataFrame([(str(i), n, a, c) for i, (n, a, c) in enumerate(rows)], "entity_id string, business_name string, business_address string, country string")
    return sorted(N.clean_records(df).collect(), key=lambda r: int(r.entity_id))


def test_worked_names_and_addresses(spark):
    rows = [
        ("Foo L.L.C.", "", "US"), ("Company Ltd", "", "US"), ("Privilege Foods", "", "US"), ("Starbucks Coffee Pvt Ltd", "MG Road, Delhi", "India"),
        ("Starbucks Coffee Private Limited", "M.G. Road Delhi", "India"), ("लिमिटेड", "", "India"), (None, None, None), ("Zoë & Söhne Corporate, Inc.", "12 Main Street\x1cSuite 5", "US"),
    ]
    got = names(spark, rows)
    assert [(r.business_name_core, r.legal_suffix) for r in got[:3]] == [("foo", "llc"), ("", "co ltd"), ("pvt foods", "")]
    for r in got[3:5]:
        assert (r.business_name_core, r.legal_suffix, r.business_name_blockkey, r.business_address_clean) == ("starbucks coffee", "pvt ltd", "coffee starbucks", "mg rd delhi")
    assert got[5].business_name_clean == "ltd"
    assert (got[6].business_name_clean, got[6].postal_code, got[6].country) == ("", "", "")
    assert (got[7].business_name_clean, got[7].business_name_core, got[7].business_address_clean) == ("zoe and sohne corp inc", "zoe and sohne", "12 main st ste 5")


@pytest.mark.parametrize(
    ("address", "country", "code"),
    [("1 A St 90210-1234", "US", "90210"), ("12345 Main St 90210", "US", "12345"), ("MG Road 110025", "India", "110025"), ("75001 Paris", "France", "75001"), ("दिल्ली ११००२५", "India", "११००२५"), ("110025 x", "France", "110025"), ("x110025", "India", ""), ("110025", "US", "")],
)
def test_postal_codes(spark, address, country, code):
    assert names(spark, [("a", address, country)])[0].postal_code == code


def test_transliteration():
    assert N.transliterate("लिमिटेड") == "limittedd"
    assert N.transliterate("मार्केटिंग") == "maarkettiNg"
    assert N.transliterate("Straße Æon ½ Ａ") == "Strasse AEon 12 A"


def test_raw_path(spark):
    df = spark.createDataFrame([("Müller & Co. Ltd_x",), ("राम",), (" NaN ",), (None,)], "x string")
    assert [r[0] for r in df.select(N.raw_name(F.col("x"))).collect()] == ["muller company ltd_x", "र म", "", ""]
    c = spark.createDataFrame([(" U.S.A. ",), ("Fr",), ("Peru",), (None,)], "x string")
    assert [r[0] for r in c.select(N.raw_country(F.col("x"))).collect()] == ["united states", "france", "peru", ""]


def test_keys(spark):
    df = spark.createDataFrame([("ab cd",), ("ab",), ("",), ("a",)], "x string")
    got = df.select(K.block_ngrams(F.col("x")), K.padded_ngrams(F.col("x")), K.token_set(F.col("x"))).collect()
    assert [sorted(r[0]) for r in got] == [["_cd", "ab_", "b_c"], ["ab"], [], ["a"]]
    assert sorted(got[3][1]) == ["  a", " a ", "a  "]
    assert got[2][1] == []
    assert got[2][2] == []


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def slow_osa(a, b):
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_kernels_against_tables():
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(0, 12)))
    for _ in range(3000):
        a, b = word(), word()
        assert S.lcs_length(a, b) == slow_lcs(a, b)
        assert S.osa_distance(a, b) == slow_osa(a, b), (a, b)
    assert (S.osa_distance("CA", "ABC"), S.osa_distance("ab", "ba"), S.lcs_length("abcde", "xacxe")) == (3, 1, 3)


@pytest.mark.parametrize(("letters", "longest"), [("ab", 140), ("abc é日", 30), ("a", 600), ("".join(map(chr, range(0x4E00, 0x4E00 + 3000))), 70)])
def test_batches_of_pairs_as_one_by_one(letters, longest):
    rng = random.Random(longest)
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(0, longest)))
    a = [word() for _ in range(300)] + ["", "", "ab"]
    b = []
    for x in a[:300]:
        y = list(x)
        for _ in range(rng.randint(0, 5)):
            if len(y) > 1:
                i = rng.randrange(len(y) - 1)
                y[i : i + 2] = rng.choice([[y[i + 1], y[i]], [y[i]], [y[i], rng.choice(letters), y[i + 1]]])
        b.append("".join(y) if rng.random() < 0.8 else word())
    b += ["", "ab", ""]
    assert S._batch("lcs", a, b).tolist() == [S.lcs_length(x, y) for x, y in zip(a, b, strict=True)]
    assert S._batch("osa", a, b).tolist() == [S.osa_distance(x, y) for x, y in zip(a, b, strict=True)]


def test_ratios_of_empty_strings(spark):
    df = spark.createDataFrame([("", ""), ("a", ""), ("abc technologies private limited", "abc technologies pvt ltd")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    df = df.withColumns({"l": F.get(S.lcs_lengths([(a, b)]), F.lit(0)), "o": F.get(S.osa_distances([(a, b)]), F.lit(0))})
    got = df.select(S.lcs_ratio(F.col("l"), a, b), S.osa_ratio(F.col("o"), a, b), S.jaccard(a, b), S.ngram_similarity(a, b), S.exact(a, b), S.length_difference(a, b)).collect()
    assert [tuple(r) for r in got[:2]] == [(1.0, 1.0, 1.0, 1.0, 0.0, 0.0), (0.0, 0.0, 0.0, 0.0, 0.0, 1.0)]
    assert got[2][2] == pytest.approx(2 / 6)
