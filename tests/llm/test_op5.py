import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kithline.llm import near_dedup
from kithline.llm.common import text_bytes
from kithline.llm.near_dedup import inverse_frequencies, near_duplicates, samples, shingles, similarity
from kithline.llm.queries import op5_near_duplicates


def brute(spark, rows, threshold=0.8):
    """Class of each row from all pairs of texts, and each text's number of links."""
    df = spark.createDataFrame([(t or "",) for _, t in rows], "text string")
    idf = inverse_frequencies(df)
    texts = sorted({t or "" for _, t in rows})
    row, h, c = shingles(*text_bytes(pa.array(texts)))
    w = c * idf[(h >> np.uint64(64 - near_dedup.IDF_BITS)).astype(int)]
    sets = [(h[row == i], w[row == i]) for i in range(len(texts))]
    comp = list(range(len(texts)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i][0]) and similarity(sets[i], sets[j]) >= threshold:
                comp[root(i)] = root(j)
    of = {t: root(i) for i, t in enumerate(texts)}
    least = {}
    for k, t in rows:
        if k is not None:
            least[of[t or ""]] = min(k, least.get(of[t or ""], k))
    return {k: least[of[t or ""]] for k, t in rows if k is not None}


def fixture(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    texts = [None, "", "one two", "one two", "two one", "a b c d e", "x " * 300]
    for _ in range(12):
        base = [word() for _ in range(rng.randint(30, 200))]
        for _ in range(rng.randint(1, 8)):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
                t[rng.randrange(len(t))] = word()
            texts.append(" ".join(t))
    return [(i, t) for i, t in enumerate(texts)] + [(None, texts[20]), (5, "a b c d e")]


def test_samples_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 300).astype(np.uint64)
    w = rng.uniform(1, 3, 300)
    a, b = np.sort(h[:200]), np.sort(h[60:260])
    weight = dict(zip(h.tolist(), w.tolist(), strict=True))
    wa, wb = np.array([weight[x] for x in a.tolist()]), np.array([weight[x] for x in b.tolist()]) * 1.2
    row = np.repeat([0, 1], [len(a), len(b)])
    s = samples(row, np.concatenate([a, b]), np.concatenate([wa, wb]), 2, 3000)
    assert abs((s[0] == s[1]).mean() - similarity((a, wa), (b, wb))) < 0.04


def test_classes_against_all_pairs(spark):
    rows = fixture()
    df = spark.createDataFrame([(i, t, 0, "u") for i, t in rows], "doc_id long, text string, n_links int, uid string").repartition(3)
    got = near_duplicates(df).collect()
    assert len(got) == len(rows)
    want = brute(spark, rows)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == want
    assert [r.class_id for r in got if r.doc_id is None] == [want[20]]


def test_weights_and_classes_against_counted_tuples(spark):
    """Shingles as tuples of words with their true document frequencies; pairs within 0.005 of the threshold may go either way."""
    rows = [(i, t) for i, t in fixture(11) if t and i is not None]
    rows = list({i: (i, t) for i, t in rows}.values()) + [(1_000 + i, f"u{i} v{i} w{i} x{i} y{i} z{i}") for i in range(150)]
    bags = {}
    for i, t in rows:
        w = t.split()
        bags[i] = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])
    df = Counter(s for b in bags.values() for s in b)
    idf = {s: 1 + math.log(min(1, max(0.01, n / len(rows)))) / math.log(0.01) for s, n in df.items()}
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    sure, perhaps = {i: i for i in bags}, {i: i for i in bags}

    def root(of, i):
        while of[i] != i:
            i = of[i]
        return i

    met = 0
    for i in bags:
        for j in bags:
            if i < j and (common := bags[i].keys() & bags[j].keys()):
                low = sum(min(bags[i][s], bags[j][s]) * idf[s] for s in common)
                both = sum(n * idf[s] for b in (bags[i], bags[j]) for s, n in b.items()) - low
                for of, least in ((sure, 0.805), (perhaps, 0.795)):
                    if low / both >= least:
                        of[root(of, i)] = root(of, j)
                met += low / both >= 0.805
    assert met > 10
    for i in bags:
        for j in bags:
            if root(sure, i) == root(sure, j):
                assert got[i] == got[j]
            if got[i] == got[j]:
                assert root(perhaps, i) == root(perhaps, j)


def test_a_shingle_weighs_the_same_at_every_size(spark):
    """One shingle in a tenth of the texts, one in all, one in a single text; a thousand texts and ten thousand."""
    found = []
    for n in (1_000, 10_000):
        texts = spark.range(n).selectExpr("concat('a b c d e ', case when id % 10 = 0 then 'f g h i j ' else '' end, 'p', id, ' q r s t') AS text")
        idf = inverse_frequencies(texts)
        at = lambda t: float(idf[near_dedup._bucket(shingles(*text_bytes(pa.array([t])))[1])[0]])
        found.append((at("a b c d e"), at("f g h i j"), at("p7 q r s t")))
    assert found[0] == pytest.approx((1, 1.5, 2), abs=0.02)
    assert found[1] == pytest.approx(found[0], abs=0.02)


def test_equal_rows_of_two_near_copies(spark):
    """Rows without a key and with equal texts are one text to all comparisons; each row is in the result."""
    words = [f"w{i}" for i in range(200)]
    near = [*words[:100], "other", *words[101:]]
    rows = [(None, " ".join(words))] * 3_000 + [(None, " ".join(near))] * 3_000 + [(7, " ".join(near)), (9, "some other text of its own")]
    got = Counter((r.doc_id, r.class_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    assert got == {(None, 7): 6_000, (7, 7): 1, (9, 9): 1}


def test_hot_keys_meet_by_broadcast(spark):
    rows = spark.range(3_000).selectExpr("id", "if(id % 3 = 0, -1, id % 1500) AS k")
    of_key = rows.groupBy("k").count().selectExpr("k", "k * 2 AS twice", "count AS n")
    got = near_dedup.spread_join(rows, of_key, "k").collect()
    assert len(got) == 3_000 and all(r.twice == 2 * r.k for r in got) and len({r.id for r in got}) == 3_000


def test_batches_of_many_rows_are_cut():
    batch = pa.RecordBatch.from_arrays([pa.array([""] * 70_000)], ["text"])
    assert [b.num_rows for b in near_dedup.chunks(iter([batch]))] == [32_768, 32_768, 4_464]


@pytest.mark.parametrize("many", [1_500, 4])
def test_drifting_copies_and_divided_buckets(spark, monkeypatch, many):
    """Copies of copies: members of a class are far from each other, and classes lie close together."""
    monkeypatch.setattr(near_dedup, "MANY", many)
    rng = random.Random(1)
    rows = []
    for _ in range(3):
        family = [[f"w{rng.randrange(10**6)}" for _ in range(120)]]
        for _ in range(25):
            t = list(rng.choice(family))
            for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
                t[rng.randrange(120)] = f"w{rng.randrange(10**6)}"
            family.append(t)
        rows += [" ".join(t) for t in family]
    rows = list(enumerate(rows))
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(spark, rows)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_on_the_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in op5_near_duplicates(spark, sf_dir).collect()}
    assert got == brute(spark, docs)


def test_one_text_against_many_gives_the_same_similarities():
    rng = random.Random(9)
    texts = ["", "a b", "a b"] + [" ".join(rng.choice("abcd") for _ in range(rng.randint(3, 60))) for _ in range(30)]
    idf = np.linspace(1, 2, 1 << near_dedup.IDF_BITS).astype(np.float32)
    row, h, c = shingles(*text_bytes(pa.array(texts)))
    w = (c * idf[near_dedup._bucket(h)]).astype(np.float64)
    sets = [(h[row == i], w[row == i]) for i in range(len(texts))]
    i, j = np.triu_indices(len(texts), 1)
    got = near_dedup.one_to_many(pa.array(texts), idf, i, j)
    assert got == pytest.approx([similarity(sets[x], sets[y]) for x, y in zip(i, j, strict=True)], abs=1e-9)


def test_every_pair_of_different_classes_of_a_large_bucket_stays_in_a_group(spark, monkeypatch):
    """Texts that share one band and no other, in a bucket over MANY: all their own class, then some in one."""
    monkeypatch.setattr(near_dedup, "MANY", 4)
    signed = spark.createDataFrame([(u, [7, 1000 + u, 2000 + u]) for u in range(13)], "uid long, bands array<long>")
    for comp in (list(range(13)), [0 if u < 9 else u for u in range(13)], [u % 3 for u in range(13)]):
        of = {}
        for r in near_dedup.tiles_of(near_dedup.buckets_of(signed), spark.createDataFrame(list(enumerate(comp)), "uid long, comp long")).collect():
            of.setdefault(r.group, set()).add(r.uid)
        met = {(a, b) for g in of.values() for a in g for b in g if a < b}
        assert {(a, b) for b in range(13) for a in range(b) if comp[a] != comp[b]} <= met


def test_a_large_class_makes_rows_in_proportion_to_its_members(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "MANY", 40)
    rows = {}
    for m in (400, 800):
        signed = spark.createDataFrame([(u, [7]) for u in range(m + 5)], "uid long, bands array<long>")
        comp = spark.createDataFrame([(u, 0 if u < m else u) for u in range(m + 5)], "uid long, comp long")
        buckets = near_dedup.buckets_of(signed)
        rows[m] = [d.count() for d in (near_dedup.blocks_of(buckets), near_dedup.leaders_of(buckets, comp), near_dedup.tiles_of(buckets, comp))]
    assert rows[400][:2] == [405, 6]
    assert rows[800][2] <= 2.1 * rows[400][2] < 2.1 * 600


def plain_classes(rows, threshold):
    """Classes from all pairs, without any code of the operator: words by a pattern, shingles as tuples, exact document frequencies."""
    cut = {t or "": re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows}
    grams = {t: Counter([tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)) for t, w in cut.items()}
    df = Counter(g for _, t in rows for g in grams[t or ""])
    n = len(rows)
    weight = {t: {g: k * (1 + math.log((n + 1) / (df[g] + 1)) / math.log(n + 1)) for g, k in c.items()} for t, c in grams.items()}
    texts = sorted(weight)
    total = {t: sum(weight[t].values()) for t in texts}
    holds = {}
    for t in texts:
        for g in weight[t]:
            holds.setdefault(g, []).append(t)
    comp = {t: t for t in texts}

    def root(t):
        while comp[t] != t:
            t = comp[t]
        return t

    for t in texts:
        both = Counter()
        for g, w in weight[t].items():
            for u in holds[g]:
                if u < t:
                    both[u] += min(w, weight[u][g])
        for u, low in both.items():
            if low / (total[t] + total[u] - low) >= threshold:
                comp[root(t)] = root(u)
    return {t: root(t) for t in texts}


def test_against_plain_python(spark, monkeypatch):
    """Between the classes at thresholds a hundredth apart: document frequencies share buckets."""
    monkeypatch.setattr(near_dedup, "MANY", 20)
    rng = random.Random(8)
    rows = fixture(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    for i in range(120):  # one large group of near copies
        t = list(base)
        t[rng.randrange(150)] = f"e{i}"
        rows.append((1000 + i, " ".join(t)))
    rows = [(k, t) for k, t in rows if k is not None]
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    low, high = plain_classes(rows, 0.79), plain_classes(rows, 0.81)
    for i, t in rows:
        for j, u in rows:
            if high[t or ""] == high[u or ""]:
                assert got[i] == got[j]
            if got[i] == got[j]:
                assert low[t or ""] == low[u or ""]
    assert len({got[1000 + i] for i in range(120)}) == 1


def test_a_bucket_that_holds_several_classes(spark, monkeypatch):
    """One band of one sample: unlike texts meet, and the rounds have to sort them out."""
    monkeypatch.setattr(near_dedup, "ROWS", 1)
    monkeypatch.setattr(near_dedup, "BANDS", 12)
    common = [f"c{i}" for i in range(60)]
    rng = random.Random(1)
    rows = []
    for g in range(6):
        own = [f"g{g}w{i}" for i in range(60)]
        for v in range(5):
            t = common + own
            for _ in range(v):
                t[rng.randrange(120)] = f"e{len(rows)}x{v}"
            rows.append((len(rows), " ".join(t)))
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(spark, rows)
