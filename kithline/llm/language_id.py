"""Operator 1: language identification by Bayesian evidence fusion.

Evidence of one record, as log-odds that add up:
- its text: hashed byte trigrams under one multinomial model per language, learned from labelled
  records by a grouped sum (2**BUCKET_BITS buckets a language, smoothed), tempered by TEMPER because
  neighbouring trigrams are not independent. Labelled texts fall into two halves by a hash of the text,
  and each text is judged by the model of the other half: no text, nor a copy of it, is judged by its
  own label;
- its declared markup language (`<html lang=...>`), right with the probability that the texts of the
  records that declare it show: the mean of their text posteriors for it by a grouped sum, language by
  language, with DECLARED pseudo-records of TRUST;
- the suffix of its address (country domain, or a path segment that is a language code);
- its host: a prior smoothed level by level - all records, last label, parent domain, host - each level
  the posterior mean of the level above with STRENGTH pseudo-records. The counts are sums of the text
  posteriors over all records, one grouped sum a level, so a host of any size is one row per task.

A record is kept unless it has no letters at all, or no language reaches `least`.

The MOST_LANGUAGES languages with the most labelled records are modelled (a documented bound: a language
is 2**BUCKET_BITS numbers for each half); texts of others are judged among those.

Defined cases: a null or empty text has no evidence of its own: its language is what declaration,
address and host say, and it is rejected; no labelled record at all: the language is null and
everything with letters is kept; a null host has the global prior; repeated rows are judged alike, and
count as often as they occur; further columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, arrow, chunks, shelve, text_bytes, worker

BUCKET_BITS, TEMPER, STRENGTH = 14, 0.1, 20.0
TRUST, DECLARED, HINT = 0.9, 10.0, 0.8
MOST_LANGUAGES = 200
#: Bytes of text taken at once: trigrams take some 80 bytes of memory for each.
PIECE_BYTES = 512 << 10


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the trigram that ends at each byte, text's row), for bytes at least two into their text. A-Z count as a-z."""
    low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(U64)
    if len(low) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    g = (low[:-2] << U64(16)) | (low[1:-1] << U64(8)) | low[2:]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    same = row[:-2] == row[2:]
    bucket = (g * U64(0x9E3779B97F4A7C15) >> U64(64 - BUCKET_BITS)).astype(np.int64)
    return bucket[same], row[2:][same]


def _half(text: str) -> Column:
    """Of two, the half of the labelled texts that a text is in, or would be."""
    return (F.crc32(F.coalesce(F.col(text).cast("string"), F.lit(""))) % 2).cast("int")


@worker("language_id")
def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each task: how often each language has each bucket in each half."""
    counts: dict[str, np.ndarray] = {}
    size = 2 << BUCKET_BITS
    for part in chunks(batches, limit=PIECE_BYTES):
        bucket, row = _trigrams(*text_bytes(part.column(0)))
        langs = part.column(1).dictionary_encode()
        code = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + part.column(2).to_numpy()
        n = np.bincount(code[row] << BUCKET_BITS | bucket, minlength=len(langs.dictionary) * size)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            counts[lang] = counts.get(lang, 0) + n[k * size : (k + 1) * size]
    for lang, n in counts.items():
        some = np.flatnonzero(n)
        yield arrow(["lang", "bucket", "n"], [pa.array([lang] * len(some), pa.string()), some.astype(np.int32), n[some]])


def text_model(labelled: DataFrame, most: int = MOST_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """(languages, log-probability of each bucket in each, for texts of each half) from (text, lang)."""
    labelled = labelled.where("lang IS NOT NULL").select("text", "lang", _half("text").alias("half"))
    langs = sorted(r.lang for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most).collect())
    size = 1 << BUCKET_BITS
    n = np.zeros((2, len(langs), size))
    if langs:
        found = labelled.where(F.col("lang").isin(langs)).mapInArrow(_learn, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
        at = {x: i for i, x in enumerate(langs)}
        bucket = found["bucket"].to_numpy()
        n[1 - (bucket >> BUCKET_BITS), [at[x] for x in found["lang"].to_pylist()], bucket & (size - 1)] = found["n"].to_numpy()
    n += 0.5
    return langs, np.log(n / n.sum(axis=2, keepdims=True)).astype(np.float32)


def _likelihoods(model: np.ndarray):
    by_lang = [np.concatenate([model[0, i], model[1, i]]) for i in range(model.shape[1])]

    @worker("language_id")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, limit=PIECE_BYTES):
            data, offsets = text_bytes(part.column(part.num_columns - 1))
            bucket, row = _trigrams(data, offsets)
            n = np.bincount(row, minlength=part.num_rows)
            place = bucket + (part.column(part.num_columns - 2).to_numpy().astype(np.int64)[row] << BUCKET_BITS)
            ll = np.stack([np.bincount(row, m[place], part.num_rows) for m in by_lang], 1).astype(float) if len(by_lang) else np.zeros((part.num_rows, 0))
            letter = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | (data >= 128)
            letters = np.concatenate([[0], np.cumsum(letter)])
            soft = _shares(ll * TEMPER) * (n > 0)[:, None]
            names = [*part.schema.names[:-2], "ll", "soft", "n_grams", "letters"]
            yield arrow(names, [*part.columns[:-2], _lists(ll), _lists(soft), n.astype(np.int64), (letters[offsets[1:]] - letters[offsets[:-1]]).astype(np.int64)])

    return run


def _fuse(langs: list[str], trust: dict[str, float], everywhere: np.ndarray, least: float):
    """Rows keys, ll, declared, hint, letters, prior: to keys, lang, probability, keep."""
    k, at = len(langs), {x: i for i, x in enumerate(langs)}

    def told(said: pa.Array, sure) -> np.ndarray:
        """Log-odds of statements, each right with the probability sure(said); none for a language not modelled."""
        said = said.dictionary_encode()
        table = np.zeros((len(said.dictionary) + 1, k))
        for i, x in enumerate(said.dictionary.to_pylist()):
            if x in at:
                table[i] = np.log((1 - sure(x)) / max(k - 1, 1) + 1e-6)
                table[i, at[x]] = np.log(sure(x))
        return table[pc.fill_null(said.indices, len(said.dictionary)).to_numpy(zero_copy_only=False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ll, declared, hint, letters, prior = b.columns[-5:]
            own = ll.flatten().to_numpy(zero_copy_only=False).reshape(-1, k) * TEMPER
            own = own + told(declared, lambda x: trust.get(x, TRUST)) + told(hint, lambda x: HINT)
            has = prior.is_valid().to_numpy(zero_copy_only=False)
            before = np.tile(everywhere, (len(own), 1))
            before[has] = prior.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            p = _shares(own + np.log(before))
            best = p.argmax(axis=1)
            top = p[np.arange(len(p)), best]
            yield arrow([*b.schema.names[:-5], "lang", "probability", "keep"], [*b.columns[:-5], pa.array(langs, pa.string()).take(pa.array(best)), top, (letters.to_numpy() > 0) & (top >= least)])

    return run


def _shares(log: np.ndarray) -> np.ndarray:
    """Probabilities from rows of log-odds."""
    e = np.exp(log - log.max(axis=1, keepdims=True)) if log.shape[1] else log
    return e / e.sum(axis=1, keepdims=True)


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))


def _host_levels(url_host: Column) -> dict[str, Column]:
    labels = F.split(url_host, r"\.")
    return {"host": url_host, "domain": F.when(F.size(labels) > 1, F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))).otherwise(url_host), "suffix": F.element_at(labels, -1)}


def identify(
    df: DataFrame,
    labelled: DataFrame,
    keys: list[str],
    text: str = "text",
    declared: str = "declared",
    host: str = "host",
    hint: str = "hint",
    least: float = 0.5,
) -> DataFrame:
    """keys, lang, probability and keep of every row of df (with text, declared, host and hint: the address's language code).

    labelled: (text, lang).
    """
    langs, model = text_model(labelled.select("text", "lang"))
    k = len(langs)
    names = F.array(*map(F.lit, langs)) if k else F.array().cast("array<string>")
    base = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], F.col(declared).alias("declared"), F.col(host).alias("host"), F.col(hint).alias("hint"), _half(text).alias("half"), F.col(text).cast("string").alias("text"))
    fields = [f"{c} {t}" for c, t in base.dtypes if c not in ("text", "half")]
    scored = base.mapInArrow(_likelihoods(model), ", ".join([*fields, "ll array<double>", "soft array<double>", "n_grams bigint", "letters bigint"]))
    scored = shelve(scored.withColumns(_host_levels(F.col("host"))))
    if not k:
        return scored.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keys)], F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("probability"), (F.col("letters") > 0).alias("keep"))

    said = scored.where(F.col("declared").isin(langs) & (F.col("n_grams") > 0)).select("declared", F.get("soft", F.array_position(names, F.col("declared")).cast("int") - 1).alias("p"))
    said = said.groupBy("declared").agg(F.sum("p").alias("p"), F.count("*").alias("n")).collect()  # a row a language at most
    trust = {r.declared: min(0.99, max(0.05, (r.p + DECLARED * TRUST) / (r.n + DECLARED))) for r in said}
    summed = [F.sum(F.get("soft", F.lit(i))).alias(f"c{i}") for i in range(k)]
    counted = F.array(*[f"c{i}" for i in range(k)])
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    smooth = lambda c, above: F.zip_with(c, above, lambda x, p: (x + STRENGTH * p) / (total(c) + STRENGTH))
    hosts = shelve(scored.groupBy("suffix", "domain", "host").agg(*summed).withColumn("c", counted).select("suffix", "domain", "host", "c"))
    each = [F.sum(F.get("c", F.lit(i))).alias(f"c{i}") for i in range(k)]
    whole = hosts.agg(*each).first()  # k numbers
    whole = np.array([x or 0 for x in whole], float)
    everywhere = (whole + STRENGTH / k) / (whole.sum() + STRENGTH)
    suffixes = hosts.groupBy("suffix").agg(*each).select("suffix", smooth(counted, F.array(*map(F.lit, everywhere.tolist()))).alias("p_suffix"))
    domains = hosts.groupBy("suffix", "domain").agg(*each).withColumn("c", counted).join(suffixes, "suffix").select("domain", smooth(F.col("c"), F.col("p_suffix")).alias("p_domain"))
    priors = hosts.join(domains, "domain").select("host", smooth(F.col("c"), F.col("p_domain")).alias("prior"))
    joined = scored.join(priors, "host", "left").select(*[f"k{i}" for i in range(len(keys))], "ll", "declared", "hint", "letters", "prior")
    kept = ", ".join([f"k{i} {joined.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keys))] + ["lang string", "probability double", "keep boolean"])
    placed = joined.mapInArrow(_fuse(langs, trust, everywhere, least), kept)
    return placed.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keys)], "lang", "probability", "keep")


def from_html(df: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """df with text (markup taken out), declared (of <html lang>), host and hint of its pages."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    said = F.lower(F.regexp_extract(F.coalesce(F.col(html), F.lit("")), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    at = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"://([^/?#]*)", 1))
    path = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"://[^/?#]*/([A-Za-z]{2})(?:[/?#]|$)", 1))
    suffix = F.regexp_extract(at, r"\.([a-z]{2})$", 1)
    none = lambda c: F.when(c != "", c)
    return df.withColumns({"text": bare, "declared": none(said), "host": none(at), "hint": F.coalesce(none(path), none(suffix))})
