"""Business records for the queries, derived from the documents table by fixed expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import clean_records
from ..sources.settled import shelve


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, business_name, business_address, country: a third of the documents for each of the sources S1, S2, S3."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    source = F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"))
    suffix = F.element_at(F.array(*map(F.lit, [" Ltd", " Pvt Ltd", " Inc", " Company", ""])), (F.col("doc_id") % 5 + 1).cast("int"))
    country = F.element_at(F.create_map(*map(F.lit, ["en", "US", "fr", "France", "de", "Germany", "es", "India"])), F.col("lang"))
    code = F.when(F.col("lang") == "es", 110000 + F.col("doc_id") % 97).otherwise(10000 + F.col("doc_id") % 97)
    return d.select(
        F.concat(source, F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("entity_id"),
        F.concat(F.substring("text", 1, 48), suffix).alias("business_name"),
        F.concat(F.substring("text", 49, 80), F.lit(" "), code.cast("string")).alias("business_address"),
        country.alias("country"),
    )


def sources(spark: SparkSession, sf_dir: str, clean: bool = True) -> tuple[DataFrame, DataFrame]:
    """(S1 records, S2 and S3 records), raw, or cleaned and settled: a query cleans once, however often it reads them. Cleaning is spread over all cores: one file is one scan task."""
    rows = records(spark, sf_dir)
    rows = shelve(clean_records(rows.repartition("entity_id"))) if clean else rows
    return rows.where(F.col("entity_id").startswith("S1-")), rows.where(~F.col("entity_id").startswith("S1-"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, cand_id): records of one country whose texts begin alike, for beginnings that at most 20 documents of the country have."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", F.substring("text", 1, 48).alias("head"))
    rare = d.groupBy("lang", "head").agg(F.count("*").alias("n")).where("n <= 20").select("lang", "head")
    d = d.join(rare, ["lang", "head"])
    name = lambda: F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"), F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 8, "0"))
    left = d.where("doc_id % 3 = 0").select("lang", "head", name().alias("s1_id"))
    right = d.where("doc_id % 3 <> 0").select("lang", "head", name().alias("cand_id"))
    return left.join(right, ["lang", "head"]).select("s1_id", "cand_id")


def truth_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = truth(spark, sf_dir)
    return pairs.groupBy(F.col("s1_id").alias("source1_entity_id")).agg(F.array_join(F.array_sort(F.collect_set("cand_id")), ",").alias("matched_entity_ids"))
