import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from kithline.llm import language_id as L
from kithline.llm.language_id import from_html, identify
from kithline.llm.queries import op1_language_id

NONE = lambda: F.lit(None).cast("string")


def brute(rows, labelled):
    """rows: (text, declared, host, hint). The same evidence, added up in plain Python."""
    size = 1 << L.BUCKET_BITS

    def buckets(t):
        b = (t or "").encode()
        b = bytes(x + 32 if 65 <= x <= 90 else x for x in b)
        return [(((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 0x9E3779B97F4A7C15) & (2**64 - 1)) >> (64 - L.BUCKET_BITS) for i in range(len(b) - 2)]

    langs = sorted({x for _, x in labelled if x})
    half = lambda t: zlib.crc32((t or "").encode()) % 2
    n = np.full((2, len(langs), size), 0.5)
    for t, x in labelled:
        if x:
            for b in buckets(t):
                n[1 - half(t), langs.index(x), b] += 1
    model = np.log(n / n.sum(2, keepdims=True))
    ll = [L.TEMPER * sum((model[half(t)][:, b] for b in buckets(t)), np.zeros(len(langs))) for t, *_ in rows]

    def shares(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    def levels(h):
        parts = h.split(".")
        return h, ".".join(parts[-2:]), parts[-1]

    counts = {}
    whole = np.zeros(len(langs))
    for (t, _, h, _), x in zip(rows, ll, strict=True):
        p = shares(x) if buckets(t) else np.zeros(len(langs))
        whole += p
        for k, v in enumerate(levels(h) if h is not None else ()):
            counts[k, v] = counts.get((k, v), 0) + p
    smooth = lambda c, above: (c + L.STRENGTH * above) / (c.sum() + L.STRENGTH)
    said = {}
    for (t, d, _, _), x in zip(rows, ll, strict=True):
        if d in langs and buckets(t):
            said.setdefault(d, []).append(shares(x)[langs.index(d)])
    sure = {d: min(0.99, max(0.05, (sum(p) + 9) / (len(p) + 10))) for d, p in said.items()}
    out = []
    for (t, d, h, hint), x in zip(rows, ll, strict=True):
        prior = smooth(whole, np.full(len(langs), 1 / len(langs)))
        for k in (2, 1, 0):
            if h is not None:
                prior = smooth(counts[k, levels(h)[k]], prior)
        x = x + np.log(prior)
        for said, trust in ((d, sure.get(d, 0.9)), (hint, 0.8)):
            if said in langs:
                x = x + np.array([math.log(trust) if y == said else math.log((1 - trust) / max(len(langs) - 1, 1) + 1e-6) for y in langs])
        p = shares(x)
        letters = any(c.isalpha() and c.isascii() or ord(c) > 127 for c in t or "")
        out.append((langs[int(p.argmax())], p.max(), letters and p.max() >= 0.5))
    return out


def test_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()
    labelled = [(d.text[:400], d.lang) for d in docs[:40]] + [(None, "en"), ("x", None)]
    rows = [(d.text[:80], [d.lang, None, "xx", "de"][i % 4], ["a.example.org", "b.example.org", "example.com", "org", None, "x"][i % 6], [None, "fr"][i % 2]) for i, d in enumerate(docs)]
    rows += [(None, "fr", "a.example.org", None), ("", None, None, None), ("12 34!", None, "new.host", "es"), ("ab", None, "", None)] + rows[:2]
    df = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "doc_id long, text string, declared string, host string, hint string, ll string").repartition(3)
    got = {r.doc_id: r for r in identify(df, spark.createDataFrame(labelled, "text string, lang string"), ["doc_id"]).collect()}
    for i, (lang, p, keep) in enumerate(brute(rows, labelled)):
        assert abs(got[i].probability - p) < 1e-4, i
        assert (got[i].lang, got[i].keep) == (lang, keep), i


def test_held_out_accuracy_and_clean_documents_stay(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    asked = docs.where(held).select("doc_id", "text", NONE().alias("declared"), NONE().alias("host"), NONE().alias("hint"))
    got = identify(asked, docs.where(~held).select("text", "lang"), ["doc_id"]).join(docs.select("doc_id", F.col("lang").alias("truth")), "doc_id").collect()
    assert sum(r.lang == r.truth for r in got) >= 0.97 * len(got)
    assert zlib.crc32(b"1") % 5 == spark.range(1).select(F.pmod(F.crc32(F.lit("1")), F.lit(5))).first()[0]
    made = op1_language_id(spark, sf_dir)
    assert made.where("doc_id IS NOT NULL").count() == 200
    assert made.where("page_id IS NOT NULL").count() == 50
    assert made.where("keep").count() >= 248


def test_no_label_is_evidence_for_its_own_text(spark):
    """Labels of a language that nothing in the texts tells: they are guessed no better than by chance."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["ab", "cd", "ef", "gh"], 40)), "xy"[i % 2]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    asked = df.select("doc_id", "text", NONE().alias("declared"), NONE().alias("host"), NONE().alias("hint"))
    got = identify(asked, df.select("text", "lang"), ["doc_id"]).join(df.select("doc_id", F.col("lang").alias("truth")), "doc_id")
    assert abs(got.where("lang = truth").count() - 200) < 50


def test_accuracy_of_the_query_on_documents_that_the_model_has_not_seen(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    made = op1_language_id(spark, sf).where("doc_id IS NOT NULL").join(truth, "doc_id")
    assert made.where("lang = truth").count() >= 0.97 * truth.count()


def test_declarations_are_trusted_as_texts_show(spark, sf_dir):
    """A language that is declared wrongly loses to the text; one that is right helps where there is little text."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text", "lang").where("lang IN ('en', 'de')").limit(300)
    wrong = docs.select("text", F.lit("de").alias("declared"), "lang").where("lang = 'en'")
    right = docs.select("text", F.lit("en").alias("declared"), "lang").where("lang = 'en'")
    for rows, declared, p in ((wrong, "de", 0.3), (right, "en", 0.9)):
        short = spark.createDataFrame([("a1", declared, "en")], "text string, declared string, lang string")
        asked = rows.unionByName(short).select("text", "declared", NONE().alias("host"), NONE().alias("hint"))
        got = {r.text: r for r in identify(asked, docs, ["text"]).collect()}["a1"]
        assert (got.probability > p) if declared == "en" else (got.lang == "en")


def test_more_languages_than_are_modelled(spark):
    rows = [(i, f"{chr(97 + i % 20)}{chr(98 + i % 20)} " * 9, f"l{i % 300}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    asked = df.select("doc_id", "text", NONE().alias("declared"), NONE().alias("host"), NONE().alias("hint"))
    assert identify(asked, df.select("text", "lang"), ["doc_id"]).count() == 600


def test_markup(spark):
    html = '<!DOCTYPE html><HTML class="a" lang="fr-CA"><style>p{}</style><script>var t="</p>";</script><!-- no --><p>Mot<br>deux</html>'
    df = spark.createDataFrame([(html, "https://WWW.x.de/es/1"), (None, None), ("", "http://a.fr"), ("<p", "x")], "html string, url string")
    got = [(" ".join(r.text.split()), r.declared, r.host, r.hint) for r in from_html(df).collect()]
    assert got == [("Mot deux", "fr", "www.x.de", "es"), ("", None, None, None), ("", None, "a.fr", "fr"), ("<p", None, None, None)]


def test_empty_and_unlabelled(spark):
    df = spark.createDataFrame([(1, "abc", None, "h", None), (2, "1", "en", None, None)], "doc_id long, text string, declared string, host string, hint string")
    none = spark.createDataFrame([], "text string, lang string, declared string")
    assert sorted((r.doc_id, r.lang, r.keep) for r in identify(df, none, ["doc_id"]).collect()) == [(1, None, True), (2, None, False)]
    assert identify(df.where("false"), none, ["doc_id"]).count() == 0
