"""Streaming ingestion: new books' entries merge into the corpus micro-batch by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lexispark.operators.merge import merge_books
from lexispark.sources.books import CORPUS


def read_entries(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """JSON lines of entries as they arrive."""
    return spark.readStream.schema(CORPUS + ", book string, page_number int, idx int").option("maxFilesPerTrigger", files_per_batch).json(path)


def merge_stream(entries: DataFrame, store: str, corpus: str, checkpoint: str) -> StreamingQuery:
    """Appends each batch's entries to the store and replaces the merged corpus.

    A batch is written under its number, so one that runs again after a failure replaces itself.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.withColumnRenamed("pos", "part_of_speech").write.mode("overwrite").parquet(f"{store}/batch={number}")
        merge_books(spark.read.parquet(store)).write.mode("overwrite").parquet(corpus)

    return entries.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
