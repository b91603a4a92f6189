"""Features of candidate pairs. Records are normalised before they are joined to pairs, once each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.normalize import raw_address, raw_country, raw_name

# The features and their order, the contract of the output.
CLEAN_FEATURES = [
    "name_dl_ratio", "name_jaccard", "name_ngram3_sim", "name_ngram2_sim", "name_lcs_ratio", "name_exact_match", "name_len_diff_ratio",
    "blockkey_dl_ratio", "blockkey_exact_match", "addr_lcs_ratio", "addr_dl_ratio", "addr_jaccard", "addr_ngram3_sim", "addr_len_diff_ratio",
    "addr_exact_match", "postal_match", "postal_both_present", "legal_suffix_match", "legal_suffix_both_present", "country_match",
    "country_both_known", "source_is_s3",
]
RAW_FEATURES = [
    "name_dl_ratio", "name_dl_ratio_sorted", "name_jaccard", "name_ngram3_sim", "name_ngram2_sim", "name_lcs_ratio", "name_exact_match",
    "name_len_diff_ratio", "name_first_token_match", "addr_lcs_ratio", "addr_dl_ratio", "addr_jaccard", "addr_ngram3_sim",
    "addr_len_diff_ratio", "addr_exact_match", "addr_digit_jaccard", "country_match", "country_both_known", "source_is_s3",
]

# Columns of cleaned records that the clean path reads.
CLEAN_FIELDS = ["business_name_core", "business_name_blockkey", "business_address_clean", "postal_code", "legal_suffix", "country"]

# Features that are overlaps of two sets: a record's column, and n of its n-grams (0: tokens).
CLEAN_OVERLAPS = {
    "name_jaccard": ("business_name_core", 0), "name_ngram3_sim": ("business_name_core", 3), "name_ngram2_sim": ("business_name_core", 2),
    "addr_jaccard": ("business_address_clean", 0), "addr_ngram3_sim": ("business_address_clean", 3),
}


def lookup(df: DataFrame, fields: list[str]) -> DataFrame:
    """One row for each entity_id; of several, the last in the order of their fields."""
    last = Window.partitionBy("entity_id").orderBy(*[F.desc(c) for c in fields])
    return df.select("entity_id", *fields).withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def merged_lookup(s2: DataFrame, s3: DataFrame, fields: list[str]) -> DataFrame:
    """Records of both sources; where an id is in both, those of s3."""
    both = s2.select("entity_id", *fields, F.lit(0).alias("_of")).unionByName(s3.select("entity_id", *fields, F.lit(1).alias("_of")))
    best = Window.partitionBy("entity_id").orderBy(F.desc("_of"), *[F.desc(c) for c in fields])
    return both.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n", "_of")


def _joined(pairs: DataFrame, left: DataFrame, right: DataFrame, fields: list[str]) -> DataFrame:
    """pairs (s1_id, cand_id, ...) with fields of both sides as l_* and r_*; an unknown id has empty ones."""
    a = left.select(F.col("entity_id").alias("s1_id"), *[F.col(c).alias(f"l_{c}") for c in fields])
    b = right.select(F.col("entity_id").alias("cand_id"), *[F.col(c).alias(f"r_{c}") for c in fields])
    empty = {f"{side}_{c}": F.coalesce(f"{side}_{c}", F.lit("")) for side in "lr" for c in fields}
    return pairs.join(a, "s1_id", "left").join(b, "cand_id", "left").withColumns(empty)


def _named(df: DataFrame, keep: list[str], osa: list[tuple[Column, Column]], lcs: list[tuple[Column, Column]], made: dict[str, Column], order: list[str]) -> DataFrame:
    made |= {c: F.col(c) for c in made if c in df.columns}  # worked out where the pairs were made
    df = df.withColumns({"_osa": S.osa_distances(osa), "_lcs": S.lcs_lengths(lcs)})
    return df.select(*keep, *[made[c].cast("float").alias(c) for c in order])


def clean_features(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """pairs with the 22 features of the clean path; those of CLEAN_OVERLAPS that pairs already have stay."""
    return clean_features_of(_joined(pairs, left, right, CLEAN_FIELDS), [c for c in pairs.columns if c not in CLEAN_FEATURES])


def clean_features_of(df: DataFrame, keep: list[str]) -> DataFrame:
    """The columns to keep and the 22 features, from pairs that have the CLEAN_FIELDS of both records as l_* and r_*."""
    of = lambda c: (F.col(f"l_{c}"), F.col(f"r_{c}"))
    name, key, addr, postal, suffix, country = map(of, ("business_name_core", "business_name_blockkey", "business_address_clean", "postal_code", "legal_suffix", "country"))
    osa, lcs = [F.get("_osa", F.lit(i)) for i in range(3)], [F.get("_lcs", F.lit(i)) for i in range(2)]
    made = {
        "name_dl_ratio": S.osa_ratio(osa[0], *name), "name_jaccard": S.jaccard(*name), "name_ngram3_sim": S.ngram_similarity(*name), "name_ngram2_sim": S.ngram_similarity(*name, 2),
        "name_lcs_ratio": S.lcs_ratio(lcs[0], *name), "name_exact_match": S.exact(*name), "name_len_diff_ratio": S.length_difference(*name),
        "blockkey_dl_ratio": S.osa_ratio(osa[1], *key), "blockkey_exact_match": S.exact(*key), "addr_lcs_ratio": S.lcs_ratio(lcs[1], *addr), "addr_dl_ratio": S.osa_ratio(osa[2], *addr),
        "addr_jaccard": S.jaccard(*addr), "addr_ngram3_sim": S.ngram_similarity(*addr), "addr_len_diff_ratio": S.length_difference(*addr), "addr_exact_match": S.exact(*addr),
        "postal_match": S.exact(*postal), "postal_both_present": S.both_present(*postal), "legal_suffix_match": S.exact(*suffix), "legal_suffix_both_present": S.both_present(*suffix),
        "country_match": S.exact(*country), "country_both_known": S.both_present(*country), "source_is_s3": F.col("cand_id").startswith("S3-").cast("double"),
    }
    return _named(df, keep, [name, key, addr], [name, addr], made, CLEAN_FEATURES)


def raw_fields() -> dict[str, Column]:
    """name, address and country of the raw path, from the raw columns."""
    return {"name": raw_name(F.col("business_name")), "address": raw_address(F.col("business_address")), "country": raw_country(F.col("country"))}


def raw_records(df: DataFrame) -> DataFrame:
    """entity_id with name, address and country of the raw path."""
    return df.select("entity_id", *[made.alias(c) for c, made in raw_fields().items()])


def raw_features(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """pairs with the 19 features of the raw path; left and right: raw_records."""
    return raw_features_of(_joined(pairs, left, right, ["name", "address", "country"]), pairs.columns)


def raw_features_of(df: DataFrame, keep: list[str]) -> DataFrame:
    """The columns to keep and the 19 features, from pairs that have name, address and country of both raw_records as l_* and r_*."""
    of = lambda c: (F.col(f"l_{c}"), F.col(f"r_{c}"))
    name, addr, country = of("name"), of("address"), of("country")
    sorted_ = tuple(map(S.sorted_tokens, name))
    digits = tuple(map(S.digits, addr))
    osa, lcs = [F.get("_osa", F.lit(i)) for i in range(3)], [F.get("_lcs", F.lit(i)) for i in range(2)]
    made = {
        "name_dl_ratio": S.osa_ratio(osa[0], *name), "name_dl_ratio_sorted": S.osa_ratio(osa[1], *sorted_), "name_jaccard": S.jaccard(*name), "name_ngram3_sim": S.ngram_similarity(*name),
        "name_ngram2_sim": S.ngram_similarity(*name, 2), "name_lcs_ratio": S.lcs_ratio(lcs[0], *name), "name_exact_match": S.exact(*name), "name_len_diff_ratio": S.length_difference(*name),
        "name_first_token_match": S.first_token_match(*name), "addr_lcs_ratio": S.lcs_ratio(lcs[1], *addr), "addr_dl_ratio": S.osa_ratio(osa[2], *addr), "addr_jaccard": S.jaccard(*addr),
        "addr_ngram3_sim": S.ngram_similarity(*addr), "addr_len_diff_ratio": S.length_difference(*addr), "addr_exact_match": S.exact(*addr), "addr_digit_jaccard": S.exact(*digits),
        "country_match": S.exact(*country), "country_both_known": S.both_present(*country), "source_is_s3": F.col("cand_id").startswith("S3-").cast("double"),
    }
    return _named(df, keep, [name, sorted_, addr], [name, addr], made, RAW_FEATURES)
