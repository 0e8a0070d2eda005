"""Incremental ingestion of published files with Structured Streaming. An extension: it gives the idempotent
re-ingest of a file (same bytes, nothing to do) for folders of any number of files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """path, sha256, length, content of files as they arrive, whatever time they bear."""
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", glob).option("maxFileAge", "36500d").load(folder)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), "content")


def _written(spark: SparkSession, out: str) -> DataFrame:
    try:
        return spark.read.parquet(out).select("sha256")
    except AnalysisException:  # nothing there yet
        return spark.createDataFrame([], "sha256 string")


def ingest_available(spark: SparkSession, folder: str, out: str, checkpoint: str, glob: str = "*.csv") -> StreamingQuery:
    """Take what is there and stop. Files seen before, under the same checkpoint, are skipped; so are bytes that ``out`` has
    already, under any name and of any age: they are compared with the written table, not with a window of time."""

    def put(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates(["sha256"]).join(_written(batch.sparkSession, out), "sha256", "left_anti")
        fresh.select("path", "sha256", "length", "content").write.mode("append").parquet(out)

    return new_files(spark, folder, glob).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
