"""Records that arrive: a stream of query records is blocked against a kept index, batch by batch.

The index (postings of each signal) is written once as Parquet, partitioned by country; each
micro-batch is cleaned and joined to it. Nothing is kept between batches, so there is no state to lose;
the sink is written once per batch id, so a batch that is run again overwrites its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.normalize import clean_records
from ..operators import blocking as B


def build_index(corpus: DataFrame, path: str, share: float = 0.01, cap: int = 2000) -> None:
    """Postings of a clean corpus, for probe()."""
    B.postings(corpus, *B.ALL, share=share, cap=cap).write.mode("overwrite").partitionBy("country").parquet(path)


def probe(queries: DataFrame, index: DataFrame, k: int = 300) -> DataFrame:
    """Best candidates of clean query records against an index: (s1_id, cand_id, score, rank)."""
    met = B.keyed(queries, "s1_id", B.ALL, "query_keys").join(index, ["country", "signal", "key"]).withColumn("n", F.lit(1))
    return B.top_candidates(B.score_hits(met.withColumnRenamed("entity_id", "cand_id")), k)


def block_stream(spark: SparkSession, arrivals: DataFrame, index_path: str, out: str, checkpoint: str, k: int = 300, once: bool = True) -> StreamingQuery:
    """Start a stream of raw records into Parquet candidates under out, one folder a batch."""
    index = spark.read.parquet(index_path)

    def batch(rows: DataFrame, batch_id: int) -> None:
        probe(clean_records(rows), index, k).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = arrivals.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
