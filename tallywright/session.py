"""Session settings that the results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Codes such as 011002 keep their leading zero when they are partition values.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str | None = None, name: str = "tallywright", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | more).getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Put the settings on a session made elsewhere; all of them can be changed at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
