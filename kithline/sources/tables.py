"""Sources and sinks: tab-separated records and id lists, Parquet for what is kept between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the files.
RAW_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
CLEAN_COLUMNS = ["entity_id", "business_name_clean", "business_name_core", "business_name_blockkey", "legal_suffix", "business_address_clean", "postal_code", "country"]
BLOCK_COLUMNS = ["entity_id", "business_name_core", "business_name_blockkey", "business_address_clean", "postal_code", "country"]
# Cells of a raw file that mean "nothing".
NA_CELLS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

_TSV = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True, "maxCharsPerColumn": -1, "encoding": "UTF-8", "mode": "PERMISSIVE"}


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns are missing: {', '.join(missing)}; there are {', '.join(df.columns)}")
    return df


def _read(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """All columns as text. With multi_line a quoted cell may hold line breaks and a file is one task; without, files are split."""
    options = _TSV | {"multiLine": multi_line}
    header = spark.read.options(**options).csv(path)  # reads the header alone: nothing is inferred
    df = spark.read.options(**options).schema(T.StructType([T.StructField(c, T.StringType()) for c in header.columns])).csv(path)
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def read_raw(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """Raw records; further columns stay. Cells that mean "nothing" become empty. multi_line: cells may hold line breaks; without, a file is split among tasks."""
    df = require(_read(spark, path, multi_line), RAW_COLUMNS)
    return df.select(*[F.when(F.col(f"`{c}`").isin(NA_CELLS), "").otherwise(F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_clean(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Clean records (TSV, or Parquet if the path says so); columns: which of them to read."""
    parquet = str(path if isinstance(path, str) else path[0]).rstrip("/").endswith(".parquet")
    df = spark.read.parquet(path) if parquet else _read(spark, path)
    return require(df, columns or CLEAN_COLUMNS).select(*(columns or df.columns))


def read_id_list(spark: SparkSession, path: str, id_col: str, list_col: str) -> DataFrame:
    """Two columns of an id-list file; short rows have an empty list, rows without anything are skipped. Ids hold no line breaks, so a file is split among tasks."""
    df = require(_read(spark, path, multi_line=False), [id_col, list_col]).select(id_col, list_col)
    return df.where((F.col(id_col) != "") | (F.col(list_col) != ""))


def directory_files(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """(path, name of its clean file) of each *.tsv of a folder but ground truths, by name. The folder may be in any store that Spark reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    names = sorted(s.getPath().getName() for s in path.getFileSystem(conf).listStatus(path))
    return [(f"{folder}/{n}", f"{n[:-4]}_clean.tsv") for n in names if n.endswith(".tsv") and "ground_truth" not in n]


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with a header; empty cells are empty, white space around a cell stays."""
    plain = {"emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(sep="\t", header=True, quote='"', escape='"', **plain).csv(path)


def write_id_list(df: DataFrame, path: str, id_col: str, list_col: str) -> None:
    """ids of list_col (an array) joined by commas, the first of equal ones kept."""
    write_tsv(df.select(id_col, F.array_join(F.array_distinct(list_col), ",").alias(list_col)), path)
