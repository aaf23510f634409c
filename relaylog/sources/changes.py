"""The change log: building records from table rows, their positions, and reading and writing the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylog.functions.values import format_sql_timestamp, micros_from_ntz, ntz_from_micros
from relaylog.model import RAW_RECORD, Identity, Source
from relaylog.operators.scale import numbered


def partition_of(key: Column, partitions: int) -> Column:
    """Same key, same partition."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def assign_positions(
    df: DataFrame, identity: Identity, partition: Column | None = None, chunks: int | None = None
) -> DataFrame:
    """Add ``partition`` (by key) and ``offset``: gapless from 0 per partition, in serial order.

    Log partitions are few and huge, so the numbering is chunked by serial (see ``operators.scale``).
    """
    if partition is None:
        partition = partition_of(F.col(f"`{identity.partitioning_column}`"), identity.partitions)
    placed = df.withColumn("partition", partition.cast("int"))
    return numbered(placed, ["partition"], identity.serial_column, "offset", chunks)


def change_value(name: str, type_name: str) -> Column:
    """A column as it appears in a change record."""
    col = F.col(f"`{name}`")
    if type_name == "bytea":
        return F.base64(col)
    if type_name == "timestamp":
        return micros_from_ntz(col)
    if type_name == "timestamptz":
        text = format_sql_timestamp(ntz_from_micros(F.unix_micros(col)))
        return F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit("Z"))
    return col


_WITH_NULLS = {"ignoreNullFields": "false"}


def encode_changes(df: DataFrame, source: Source, identity: Identity, topic: str, op: Column | str = "c") -> DataFrame:
    """Table rows with positions -> raw change records. A delete carries no row image."""
    op = F.lit(op) if isinstance(op, str) else op
    row = F.struct(*[change_value(c.name, c.type).alias(c.name) for c in identity.columns])
    key = F.struct(change_value(identity.partitioning_column, identity.column(identity.partitioning_column).type).alias(
        identity.partitioning_column
    ))
    value = F.struct(
        F.lit(None).cast("string").alias("before"),
        F.when(op != "d", row).alias("after"),
        F.struct(F.lit("public").alias("schema"), F.lit(source.table).alias("table")).alias("source"),
        op.alias("op"),
    )
    return df.select(
        F.lit(topic).alias("topic"),
        "partition",
        "offset",
        F.to_json(key, _WITH_NULLS).alias("key"),
        F.to_json(value, _WITH_NULLS).alias("value"),
    )


#: Records of a log partition that are written in one task.
_RUN = 1 << 15


def write_changes(df: DataFrame, path: str) -> None:
    """Append to the log. One folder per log partition, so readers prune by topic and partition.

    A file holds runs of offsets in order, so a reader of a range opens the files and pages of its run and not all of the partition's.
    """
    run = F.floor(F.col("offset") / _RUN)
    dealt = df.repartition("topic", "partition", run).sortWithinPartitions("topic", "partition", "offset")
    dealt.write.mode("append").partitionBy("topic", "partition").parquet(path)


def _records(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_RECORD.fields])


def read_changes(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """All raw records of a log, from the start. ``fmt="kafka"`` takes the usual Kafka options instead of a path."""
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "failOnDataLoss": "true", **options}
        return _records(spark.read.format("kafka").options(**options).load())
    return _records(spark.read.format(fmt).schema(RAW_RECORD).options(**options).load(path))


def read_changes_stream(
    spark: SparkSession, path: str, per_trigger: int | None = None, fmt: str = "parquet", bytes_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Follow a log from its start, at most ``per_trigger`` new files (Kafka: records) per micro-batch.

    Or at most ``bytes_per_trigger`` bytes of new files, one file at least; not both. Lost history fails the query;
    positions are never reset.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "failOnDataLoss": "true", **options}
        if per_trigger:
            options["maxOffsetsPerTrigger"] = str(per_trigger)
        return _records(reader.options(**options).load())
    if per_trigger:
        options["maxFilesPerTrigger"] = str(per_trigger)
    if bytes_per_trigger:
        options["maxBytesPerTrigger"] = str(bytes_per_trigger)
    return _records(reader.schema(RAW_RECORD).options(**options).load(path))


def log_bounds(raw: DataFrame) -> DataFrame:
    """First and end offset per log partition."""
    return raw.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("end_offset")
    )
