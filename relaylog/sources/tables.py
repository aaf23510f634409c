"""Source tables: reading them, and the ascending snapshot of the configured columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylog.model import Source


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A source table. ``fmt="jdbc"`` takes the usual options (url, dbtable, partitionColumn, ...)."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load() if fmt == "jdbc" else reader.load(path)


def snapshot_scan(df: DataFrame, source: Source) -> DataFrame:
    """The configured columns only, in config order, ascending by serial, marked as snapshot reads."""
    return df.select(*[F.col(f"`{c}`") for c in source.columns], F.lit("r").alias("op")).orderBy(
        F.col(f"`{source.serial_column}`")
    )
