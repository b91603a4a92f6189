"""Operator 6: licence scans by a positional index of rare licence words. DataFrame operations only.

A word is a run of 0-9, a-z and characters from U+0080 on, once A-Z are lower-cased. A template is a whole
licence text or a notice (license_texts.py) with one or more mandatory key phrases.

1. One pass cuts each text into words and keeps the places of those that a key phrase has, as one number
   each (place and word), and all words of a text that has every word of some template's first phrase.
2. The document frequencies of these words (a fixed list) give their inverse document frequencies; the
   index holds the postings of the RAREST highest-weighted words of each key phrase. The words of the
   index that a file has are looked up; postings that give the same relative position vote for that
   alignment of file and template. Where all postings of a phrase vote, all its words must stand.
3. A template is found where its first key phrase stands and every other one stands at its relative
   position, or up to DRIFT words beside it: words may be changed between the phrases, and a few put in
   or left out. Its score is the largest share of its words that stand at their places for that alignment.
4. Base labels: every place where a phrase's words stand consecutively.

Only a file's licence words leave its task, joins are on (file, place), and votes are added up before
the shuffle; so neither a file full of licences nor a common licence fills a task.

Defined cases: a null text has no words; a file without a phrase has null first_word and last_word, an
empty list of labels and score 0; a notice within a whole text gives its label too; repeated rows are
scanned one by one; further columns are not carried; a template without a key phrase, or whose text lacks
one, raises.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shelve
from .license_texts import NOTICES, WHOLE

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RAREST = 5
#: Words by which a key phrase may stand beside its place.
DRIFT = 8
#: A place and a word of the list in one number: place * WORDS + word.
WORDS = 1 << 20

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

TEMPLATES = NOTICES + WHOLE


def cut(text: str) -> list[str]:
    """The words of a template or phrase."""
    return re.findall("[0-9a-z]+", text.lower())


def phrase_starts(text: list[str], phrases: list[list[str]]) -> list[int]:
    """Where each phrase first stands in a template's words."""
    at = [next((i for i in range(len(text) - len(p) + 1) if p and text[i : i + len(p)] == p), None) for p in phrases]
    if None in at or not at:
        raise ValueError(f"a template that begins with {' '.join(text[:8])!r} lacks a key phrase")
    return at


def _places(hits: Column, phrase: list[int]) -> Column:
    """Places in hits where the words of phrase stand consecutively."""
    at = F.transform(hits, lambda x, i: F.struct(x.alias("x"), i.alias("i")))

    def stands(h: Column) -> Column:
        ok = h["x"] % WORDS == phrase[0]
        for k, w in enumerate(phrase[1:], 1):
            ok = ok & F.coalesce(F.get(hits, h["i"] + k) == h["x"] + (k * WORDS + w - phrase[0]), F.lit(False))
        return ok

    return F.transform(F.filter(at, stands), lambda h: F.floor(h["x"] / WORDS))


def _kept(keyed: list[tuple[str, int, list[str], int]], known: dict[str, int]) -> Column:
    """The words of a text that has all words of some template's first key phrase; else null."""
    first = sorted({tuple(sorted({known[w] for w in p})) for _, k, p, _ in keyed if k == 0})
    return F.when(F.exists(F.array(*[F.size(F.array_except(F.array(*map(F.lit, p)), F.col("has"))) == 0 for p in first]), lambda x: x) if first else F.lit(False), F.col("words"))


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", phrases: dict[str, str] | None = None, templates: list[tuple[str, str, list[str]]] | None = None) -> DataFrame:
    """key, n_words, n_base, first_word, last_word, base_labels, labels and score of every row."""
    phrases, templates = phrases or PHRASES, TEMPLATES if templates is None else templates
    spark = df.sparkSession
    keyed = []  # label, number of the phrase, its words, where it starts
    for label, body, keys in templates:
        split = [cut(p) for p in keys]
        keyed += [(label, k, p, start) for k, (p, start) in enumerate(zip(split, phrase_starts(cut(body), split), strict=True))]
    known = {w: i for i, w in enumerate(sorted({w for p in phrases for w in cut(p)} | {w for x in keyed for w in x[2]}))}
    if len(known) > WORDS:
        raise ValueError(f"phrases have more than {WORDS} words")
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))
    number = F.create_map(*[F.lit(x) for p in known.items() for x in p])
    met = F.filter(F.transform("words", lambda w, i: F.struct(i.cast("bigint").alias("at"), w.alias("word"))), lambda x: x["word"].isin(list(known)))
    hits = F.transform(met, lambda x: x["at"] * WORDS + F.element_at(number, x["word"]))
    rows = df.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), words.alias("words"))
    rows = shelve(rows.select("key", "row", F.size("words").cast("bigint").alias("n_words"), hits.alias("hits"), "words").withColumn("has", F.array_distinct(F.transform("hits", lambda x: (x % WORDS).cast("int")))).select("key", "row", "n_words", "hits", _kept(keyed, known).alias("words")))

    n = rows.count()
    seen = rows.select(F.explode(F.array_distinct(F.transform("hits", lambda x: x % WORDS))).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()  # a row a known word at most
    idf = {r.word: math.log((n + 1) / (r.n + 1)) for r in seen}
    post, lookup = [], []  # postings of all words of the key phrases; of those in the index
    for label, k, p, start in keyed:
        own = [(label, k, start, i, known[w], len(p)) for i, w in enumerate(p)]
        rare = set(sorted({x[4] for x in own}, key=lambda w: (-idf.get(w, math.log(n + 1)), w))[:RAREST])
        post += own
        lookup += [(label, k, start + i, w, sum(x[4] in rare for x in own)) for _, _, _, i, w, _ in own if w in rare]
    rare_words = sorted({x[3] for x in lookup})

    some = rows.select("row", F.filter("hits", lambda x: (x % WORDS).isin(rare_words)).alias("own"), "hits").where(F.size("own") > 0)
    looked = some.select("row", F.explode("own").alias("x")).select("row", F.floor(F.col("x") / WORDS).alias("pos"), (F.col("x") % WORDS).cast("int").alias("word"))
    table = F.broadcast(spark.createDataFrame(lookup, "label string, phrase int, at int, word int, could int"))
    votes = looked.join(table, "word").groupBy("row", "label", "phrase", (F.col("pos") - F.col("at")).alias("offset")).agg(F.count("*").alias("votes"), F.first("could").alias("could"))
    lined = shelve(votes.where("votes = could").select("row", "label", "phrase", "offset"))
    full = F.broadcast(spark.createDataFrame(post, "label string, phrase int, start int, i int, word int, size int"))
    wanted = lined.join(full, ["label", "phrase"]).select("row", "label", "phrase", "offset", "size", ((F.col("offset") + F.col("start") + F.col("i")) * WORDS + F.col("word")).alias("x"))
    all_hits = some.select("row", "hits").join(lined.select("row").distinct(), "row", "left_semi").select("row", F.explode("hits").alias("x"))
    stood = wanted.join(all_hits, ["row", "x"]).groupBy("row", "label", "phrase", "offset").agg(F.count("*").alias("n"), F.first("size").alias("size")).where("n = size")

    beside = Window.partitionBy("row", "label").orderBy("offset").rangeBetween(-DRIFT, DRIFT)
    needed = F.broadcast(spark.createDataFrame([(t[0], len(t[2]), len(cut(t[1]))) for t in templates], "label string, n_phrases int, size int"))
    placed = stood.select("row", "label", "phrase", "offset", F.size(F.collect_set("phrase").over(beside)).alias("met")).where("phrase = 0").join(needed, "label").where("met = n_phrases")
    placed = shelve(placed.select("row", "label", "offset", "size"))

    body = spark.createDataFrame([(label, i, w) for label, t, _ in templates for i, w in enumerate(cut(t))], "label string, i int, word string")
    every = sorted({w for _, t, _ in templates for w in cut(t)})
    of_text = rows.join(placed.select("row").distinct(), "row", "left_semi").select("row", F.posexplode("words").alias("pos", "word")).where(F.col("word").isin(every))
    spots = placed.join(F.broadcast(body), "label").select("row", "label", "offset", "size", (F.col("offset") + F.col("i")).alias("pos"), "word")
    shares = spots.join(of_text, ["row", "pos", "word"]).groupBy("row", "label", "offset").agg((F.count("*") / F.first("size")).alias("share"))
    verified = shares.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("share").alias("score"))

    places = {p: _places(F.col("hits"), [known[w] for w in cut(p)]) for p in phrases}
    base = rows.withColumns({f"p{i}": c for i, c in enumerate(places.values())})
    starts = F.concat(*[f"p{i}" for i in range(len(phrases))])
    given = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.size(f"p{i}") > 0, F.lit(label)) for i, label in enumerate(phrases.values())]))))
    base = base.select("key", "row", "n_words", starts.alias("starts"), given.alias("base"))
    out = base.join(verified, "row", "left")
    return out.select(
        F.col("key").alias(key),
        "n_words",
        F.size("starts").cast("bigint").alias("n_base"),
        F.array_min("starts").cast("bigint").alias("first_word"),
        F.array_max("starts").cast("bigint").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
