"""Incremental ingest of extraction results into the paper store, with Structured Streaming.

The checkpoint of the stream takes the place of a hand-kept set of finished ids:
each file of results is merged once, also after a restart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexloom.operators.records import merge_parsed
from lexloom.sources.readers import RESULTS, folders_of, read_folders
from lexloom.sources.writers import replace_papers


def stream_results(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """New files of results as a stream, with `delivered`, which orders them."""
    at = F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return spark.readStream.schema(RESULTS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder).select("*", at.alias("delivered"))


def merge_into_store(results: DataFrame, data_dir: str, source: str, backend: str = "pymupdf4llm") -> list[str]:
    """Merges results into data_dir/<source>; gives the year folders it rewrote.

    The years to rewrite are found by a semi join on ids alone, then only those
    are read whole.  A damaged file there is an error, before anything has been
    touched: skipping it would lose its rows when the year is replaced.
    """
    spark = results.sparkSession
    folders = folders_of(spark, data_dir, source, results.where(F.col("text") != ""))
    if not folders:
        return []
    merged = merge_parsed(read_folders(spark, data_dir, source, folders), results, backend)
    return replace_papers(merged.drop("_matched"), data_dir, source)


def merge_stream(results: DataFrame, data_dir: str, source: str, checkpoint: str, backend: str = "pymupdf4llm", once: bool = True) -> StreamingQuery:
    """Merges each micro-batch into data_dir/<source>, rewriting the years it touches.

    A batch that is done again after a failure sets the same values again.
    """

    def merge(batch: DataFrame, _: int) -> None:
        merge_into_store(batch, data_dir, source, backend)

    writer = results.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
