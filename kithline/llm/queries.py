"""The queries of this subpackage, as (spark, sf_dir) -> DataFrame, and the SQL that some are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document and every page (doc_id or page_id is null), and whether it is kept. The documents' lang column is the label; only pages declare a language."""
    from .language_id import from_html, identify

    documents = table(spark, sf_dir, "documents")
    none = F.lit(None).cast("string")
    records = documents.select("doc_id", F.lit(None).cast("bigint").alias("page_id"), "text", none.alias("declared"), F.col("source").alias("host"), none.alias("hint"))
    pages = from_html(table(spark, sf_dir, "pages")).select(F.lit(None).cast("bigint").alias("doc_id"), "page_id", "text", "declared", "host", "hint")
    return identify(records.unionByName(pages), documents.select("text", "lang"), ["doc_id", "page_id"])


#: (host, path, verdict)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, longest fitting rule and verdict of every page's URL."""
    from .url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


OP2_SQL = """
WITH p AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rhost, rpath, rverdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
f AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(rverdict, length(rhost || rpath)) AS rverdict
      FROM q JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT q.page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM q LEFT JOIN f USING (page_id)
"""


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text, learned from six sevenths of the documents."""
    from .bit_mixer import score_texts

    made = score_texts(table(spark, sf_dir, "documents"), "crc32(cast(doc_id AS string)) % 7 != 2")
    return made.withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 7 == 2).drop("learned")


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text stored as lossless motion JPEG and read back, as digests, with its shots."""
    from .motion_jpeg import read, store

    media = store(table(spark, sf_dir, "documents")).withColumns({"media_bytes": F.length("media").cast("bigint"), "media_sha256": F.sha2("media", 256)})
    made = read(media)
    return made.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -32, 32)")).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        "feature",
        F.size("clips").alias("n_shots"),
    )


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document at a weighted Jaccard similarity of 0.8."""
    from .near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 34) AS g FROM (SELECT doc_id, w, unnest(range(1, length(w) - 33)) AS i FROM d)),
rep AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win JOIN rep USING (g)),
pos AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, length(w) + 1)) AS p FROM d),
k AS (SELECT doc_id, array_to_string(list(x ORDER BY p), ' ') AS kept, count(*) AS n FROM pos ANTI JOIN cov USING (doc_id, p) GROUP BY 1)
SELECT doc_id, length(w)::BIGINT AS n_words, (length(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products of every fiftieth vector with all others."""
    from .top_k import exact_top_k

    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken so that sources meet the weights 5, 2, 1."""
    from .mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates of every whole text."""
    from .license_scan import scan

    return scan(table(spark, sf_dir, "documents"))


def _op6_sql() -> str:
    """The phrases and templates as tables, found by comparing slices of each text's words."""
    from .license_scan import DRIFT, LOWER, PHRASES, TEMPLATES, UPPER, cut, phrase_starts

    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    phrases = ", ".join(f"({quoted(cut(p))}, '{label}')" for p, label in PHRASES.items())
    templates = ", ".join(f"('{label}', {quoted(cut(t))}, {len(keys)})" for label, t, keys in TEMPLATES)
    keyed = ", ".join(f"('{label}', {k}, {quoted(cut(p))}, {start})" for label, t, keys in TEMPLATES for k, (p, start) in enumerate(zip(keys, phrase_starts(cut(t), list(map(cut, keys))), strict=True)))
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
ph(p, label) AS (VALUES {phrases}), tp(label, t, n) AS (VALUES {templates}), kp(label, k, p, start) AS (VALUES {keyed}),
o AS (SELECT doc_id, w, unnest(range(1, length(w) + 1)) AS i FROM d WHERE list_has_any(w, (SELECT list(p[1]) FROM (SELECT p FROM ph UNION ALL SELECT p FROM kp)))),
b AS (SELECT doc_id, count(*) AS n, min(i) - 1 AS a, max(i) - 1 AS z, list(DISTINCT label) AS l FROM o JOIN ph ON w[i] = p[1] AND list_slice(w, i, i + length(p) - 1) = p GROUP BY 1),
po AS (SELECT doc_id, label, k, i - 1 - start AS off FROM o JOIN kp ON w[i] = p[1] AND list_slice(w, i, i + length(p) - 1) = p),
al AS (SELECT x.doc_id, x.label, x.off FROM po x JOIN po y ON x.doc_id = y.doc_id AND x.label = y.label AND abs(x.off - y.off) <= {DRIFT} JOIN tp ON tp.label = x.label WHERE x.k = 0 GROUP BY ALL HAVING count(DISTINCT y.k) = any_value(tp.n)),
m AS (SELECT doc_id, label, length(list_filter(range(1, length(t) + 1), lambda k: off + k >= 1 AND w[off + k] = t[k]))::DOUBLE / length(t) AS s FROM al JOIN tp USING (label) JOIN d USING (doc_id)),
g AS (SELECT doc_id, max(s) AS s, list(DISTINCT label) AS l FROM m GROUP BY 1)
SELECT d.doc_id, length(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(b.l), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.l, []), coalesce(g.l, [])))), ','), '') AS labels, coalesce(s, 0.0)::DOUBLE AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN g USING (doc_id)
"""


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as ids and back, as digests."""
    import public_tokenizers

    from .piece_codec import encode_decode, read_model

    made = encode_decode(table(spark, sf_dir, "documents"), read_model(public_tokenizers.path("piece_bpe_32k.model")), ids_as="text")
    return made.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every text once each word of a repeated window of 35 words is gone."""
    from .substring_dedup import remove_repeats

    made = remove_repeats(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_url_filter, op3_lm_scoring, op4_media_columns, op5_near_duplicates, op6_license_scan, op7_sentencepiece, op8_substring_dedup, op9_exact_top_k, op10_mixing)
}

ORACLES: dict[str, str] = {"op2_url_filter": OP2_SQL, "op6_license_scan": _op6_sql(), "op8_substring_dedup": OP8_SQL, "op9_exact_top_k": OP9_SQL}
