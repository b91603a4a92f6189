"""Queries of sources, sinks and kept models: what is written into the shared folder is read back."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import functions as F

from ..functions.normalize import clean_records
from ..operators import features as X
from ..operators import labels as L
from ..operators import matching as M
from ..sources import tables as T
from ..sources.settled import shared_dir
from . import fixtures as fx
from .queries import _overlaps, label_pairs

#: Threshold of the kept matcher, and the one that a caller gives instead.
KEPT_AT, GIVEN_AT = 0.5, 0.35


def _folder(spark) -> str:
    """A fresh folder in the one that driver and executors share."""
    return f"{shared_dir(spark).rstrip('/')}/kithline-files-{uuid.uuid4().hex}"


def _raw(spark, d):
    """Raw records, every tenth with a country that means "nothing", every seventh with awkward signs in its name."""
    n = F.substring("entity_id", 4, 8).cast("int")
    awkward = F.concat(F.lit(' "'), F.col("business_name"), F.lit('"\t \n x '))
    return fx.records(spark, d).select(
        "entity_id", F.when(n % 7 == 0, awkward).otherwise(F.col("business_name")).alias("business_name"), "business_address", F.when(n % 10 == 0, "N/A").otherwise(F.col("country")).alias("country"), (n % 3).cast("string").alias("extra")
    )


def raw_files(spark, d):
    """Raw records through a tab-separated file; a further column stays."""
    path = f"{_folder(spark)}/raw.tsv"
    T.write_tsv(_raw(spark, d), path)
    return T.read_raw(spark, path)


def clean_files(spark, d):
    """Every raw file of a folder, cleaned into one of its own and read back with the columns of blocking."""
    folder = _folder(spark)
    raw = fx.records(spark, d)
    for k in (1, 2, 3):
        T.write_tsv(raw.where(F.col("entity_id").startswith(f"S{k}-")), f"{folder}/raw/source{k}.tsv")
    T.write_tsv(raw, f"{folder}/raw/ground_truth.tsv")
    T.write_tsv(raw, f"{folder}/raw/other.txt")
    made = []
    for source, name in T.directory_files(spark, f"{folder}/raw"):
        T.write_tsv(clean_records(T.read_raw(spark, source)), f"{folder}/{name}")
        T.read_clean(spark, f"{folder}/{name}")  # all its columns are there
        made.append(T.read_clean(spark, f"{folder}/{name}", T.BLOCK_COLUMNS).withColumn("file", F.lit(name)))
    return made[0].unionByName(made[1]).unionByName(made[2])


def id_list_files(spark, d):
    """True lists, each id twice, through an id-list file: the first of equal ids stays."""
    path = f"{_folder(spark)}/lists.tsv"
    ids = F.filter(F.split("matched_entity_ids", ","), lambda x: x != "")
    lists = L.truth_of_all(fx.sources(spark, d, clean=False)[0], fx.truth_lists(spark, d)).select("source1_entity_id", F.concat(ids, F.reverse(ids)).alias("matched_entity_ids"))
    T.write_id_list(lists, path, "source1_entity_id", "matched_entity_ids")
    return T.read_id_list(spark, path, "source1_entity_id", "matched_entity_ids")


def short_rows(spark, d):
    """An id-list file with short, blank and overlong rows, one a document."""
    folder = _folder(spark)
    n = F.col("doc_id") % 5
    name = F.concat(F.lit("D"), F.col("doc_id").cast("string"))
    row = F.when(n == 0, name).when(n == 1, "").when(n == 2, F.concat(name, F.lit("\t"))).when(n == 3, F.concat(name, F.lit("\ta, b"))).otherwise(F.concat(name, F.lit("\tc\tmore")))
    lines = spark.read.parquet(f"{d}/documents.parquet").select(row.alias("value"))
    head = spark.createDataFrame([("id\tids",)], "value string")
    head.coalesce(1).write.text(f"{folder}/a.tsv")
    empty = T.read_id_list(spark, f"{folder}/a.tsv", "id", "ids")  # a file with a header alone has no rows
    # each part has a header of its own, as those of a written table have
    lines.repartition(3, "value").mapInArrow(_with_header, "value string").write.text(f"{folder}/b.tsv")
    return T.read_id_list(spark, f"{folder}/b.tsv", "id", "ids").unionByName(empty)


def _with_header(batches):
    yield pa.RecordBatch.from_pydict({"value": ["id\tids"]})
    yield from batches


def raw_lookup(spark, d):
    """Raw records of which some ids come twice: one row an id, the last in field order."""
    raw = fx.records(spark, d)
    again = raw.where("country = 'US'").withColumn("business_name", F.lit("~ again"))
    return X.lookup(raw.unionByName(again), T.RAW_COLUMNS[1:])


def _scored(spark, d):
    one = lambda c: c.cast("float").cast("double")
    of = ("name_jaccard", "addr_jaccard")
    s1, _ = fx.sources(spark, d, clean=False)
    return s1, _overlaps(spark, d, *of).select("s1_id", "cand_id", *[one(F.col(c)).alias(c) for c in of])


def _kept_matcher(spark):
    """A matcher with a fixed score, the mean of two features, that has been written and loaded."""
    path = f"{_folder(spark)}/matcher"
    mean = SQLTransformer(statement="SELECT *, (name_jaccard + addr_jaccard) / 2 AS p1, 1 - (name_jaccard + addr_jaccard) / 2 AS p0 FROM __THIS__")
    model = PipelineModel([mean, VectorAssembler(inputCols=["p0", "p1"], outputCol="probability")])
    M.Matcher(model, ["name_jaccard", "addr_jaccard"], KEPT_AT).save(path)
    return M.Matcher.load(spark, path)


def kept_model_predict(spark, d):
    """Matches by a loaded matcher at its own threshold."""
    s1, pairs = _scored(spark, d)
    return M.predict(_kept_matcher(spark), pairs, s1)


def threshold_override(spark, d):
    """Matches by a loaded matcher at a given threshold, three a record at most, through the results file."""
    s1, pairs = _scored(spark, d)
    path = f"{_folder(spark)}/matching_results.tsv"
    T.write_tsv(M.predict(_kept_matcher(spark), pairs, s1, GIVEN_AT, 3), path)
    return T.read_id_list(spark, path, "source1_entity_id", "matched_entity_ids")


def class_counts(spark, d):
    return M.class_counts(label_pairs(spark, d))


def scoped_truth(spark, d):
    """True lists of the held-out records that blocking gave a candidate."""
    held = label_pairs(spark, d).where(L.in_validation())
    return M.scoped_truth(L.truth_of_all(fx.sources(spark, d, clean=False)[0], fx.truth_lists(spark, d)), held)


QUERIES = {f.__name__: f for f in (raw_files, clean_files, id_list_files, short_rows, raw_lookup, kept_model_predict, threshold_override, class_counts, scoped_truth)}
