"""Ordered scans per key that stay distributed when one key holds a large part of the rows.

A plain ``Window.partitionBy(key).orderBy(seq)`` sorts a whole key in one task. Here the order column is cut into
chunks at quantiles of the whole frame, and the window runs per (key, chunk). What a chunk needs from the ones before
it arrives as one more row at its head, the carry, taken from a summary with one row per (key, chunk). So the data
itself is shuffled once. This is the only path, for every size: there are as many chunks as four times the shuffle
partitions of the session, so a chunk of a key is never more than a share of a task's usual input.

Everything is lazy. The quantiles are a sketch over whole numbers, held by a scalar subquery that Spark runs once for
all uses in a query; only that one row reaches the driver. Cuts are compared as whole numbers, so they are
exact for ids of any size. Ties stay in one chunk. A null order value is an error, as a null has no place.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Items the quantile sketch keeps per level: ranks are right to about a thousandth.
_SKETCH = 2048

#: What a side may hold to be broadcast on its row bound; beyond it AQE decides by the size it measures.
MAX_BROADCAST_BYTES = 32 << 20

_CHUNK = "__chunk"
_CARRY = "__carry"
_VALUE = "__value"


def _whole_number(df: DataFrame, order_col: str) -> Column:
    """The order column as a whole number that sorts the same way."""
    kind, col = df.schema[order_col].dataType, F.col(f"`{order_col}`")
    if isinstance(kind, T.IntegralType):
        number = col.cast("long")
    elif isinstance(kind, T.TimestampType):
        number = F.unix_micros(col)
    elif isinstance(kind, T.TimestampNTZType):
        number = F.unix_micros(F.convert_timezone(F.current_timezone(), F.lit("UTC"), col).cast("timestamp"))
    elif isinstance(kind, T.DateType):
        number = F.unix_date(col).cast("long")
    else:
        raise TypeError(f"the order column {order_col} is {kind.simpleString()}, not a whole number, date or timestamp")
    return F.coalesce(number, F.raise_error(F.lit(f"null in the order column {order_col}")).cast("long"))


def _power_of_two(n: int) -> int:
    return 1 << max(1, n - 1).bit_length()


def with_chunk(df: DataFrame, order_col: str, chunks: int | None = None) -> DataFrame:
    """``df`` with a chunk number that never falls as ``order_col`` rises; ``chunks`` is rounded up to a power of two."""
    if chunks is None:
        chunks = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(2, _power_of_two(chunks))
    number = _whole_number(df, order_col)
    ranks = F.array(*[F.lit(i / chunks) for i in range(1, chunks)])
    cuts = df.select(number.alias("n")).agg(F.kll_sketch_agg_bigint("n", F.lit(_SKETCH)).alias("s"))
    # An empty frame has no quantiles, and no rows to place.
    cuts = cuts.select(F.when(F.kll_sketch_get_n_bigint("s") > 0, F.kll_sketch_get_quantile_bigint("s", ranks)).alias("cuts"))
    placed = df.withColumn("__n", number).withColumn("__cuts", cuts.scalar()).withColumn(_CHUNK, F.lit(0))
    half = chunks // 2
    while half:  # a binary search, step by step
        below = F.get("__cuts", F.col(_CHUNK) + (half - 1)) < F.col("__n")
        placed = placed.withColumn(_CHUNK, F.col(_CHUNK) + F.when(below, half).otherwise(0))
        half //= 2
    return placed.drop("__n", "__cuts")


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast ``df`` if ``rows``, a bound that configuration proves, times its row width is small; else leave it to AQE.

    Only the strategy depends on it, not the result.
    """
    width = 16 + sum(_width(f.dataType) for f in df.schema.fields)
    return F.broadcast(df) if rows * width <= MAX_BROADCAST_BYTES else df


def few_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A frame of a few rows of numbers, booleans and text, as one literal: a frame made from Python rows starts Python tasks wherever it is read."""
    names = T.StructType.fromDDL(schema).names
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    kind = f"array<struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in T.StructType.fromDDL(schema).fields)}>>"
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), kind)))


def _width(kind: T.DataType) -> int:
    """A generous size of a value in bytes."""
    if isinstance(kind, T.StructType):
        return 8 + sum(_width(f.dataType) for f in kind.fields)
    return 8 if isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)) else 256


def _with_carry(chunked: DataFrame, carry: DataFrame) -> DataFrame:
    """The rows of all chunks, each chunk headed by its carry if it has one."""
    heads = carry.filter(F.col(_VALUE).isNotNull()).withColumn(_CARRY, F.lit(0))
    return chunked.withColumn(_CARRY, F.lit(1)).unionByName(heads, allowMissingColumns=True)


def _without_carry(df: DataFrame) -> DataFrame:
    return df.filter(F.col(_CARRY) == 1).drop(_CHUNK, _CARRY, _VALUE)


def running_sum(
    df: DataFrame, keys: Sequence[str], order_col: str, value: Column, out: str, chunks: int | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    """Sum of ``value`` per key up to and including each row, in ``order_col`` order; rows that tie go by ``ties``."""
    chunked = with_chunk(df.withColumn(_VALUE, value), order_col, chunks)
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    totals = chunked.groupBy(*keys, _CHUNK).agg(F.sum(_VALUE).alias("__total"))
    # A window over a key's chunks: their number does not grow with the key.
    carry = totals.select(*keys, _CHUNK, F.sum("__total").over(before).alias(_VALUE))
    window = Window.partitionBy(*keys, _CHUNK).orderBy(_CARRY, order_col, *ties).rowsBetween(Window.unboundedPreceding, 0)
    return _without_carry(_with_carry(chunked, carry).withColumn(out, F.sum(_VALUE).over(window)))


def numbered(
    df: DataFrame, keys: Sequence[str], order_col: str, out: str, chunks: int | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    """Gapless numbers from 0 per key, in ``order_col`` order; rows that tie go by ``ties``."""
    one = F.lit(1).cast("long")
    return running_sum(df, keys, order_col, one, out, chunks, ties).withColumn(out, F.col(out) - 1)


def with_previous(
    df: DataFrame, keys: Sequence[str], order_col: str, columns: Sequence[str], out: str, chunks: int | None = None
) -> DataFrame:
    """Struct of ``columns`` of the row before each row of its key; null for the first.

    Columns that are numbers keep the summary in a hash aggregate; others sort it.
    """
    row = F.struct(*columns)
    chunked = with_chunk(df, order_col, chunks).withColumn(_VALUE, row)
    lasts = chunked.groupBy(*keys, _CHUNK).agg(*[F.max_by(F.col(c), order_col).alias(f"__last_{i}") for i, c in enumerate(columns)])
    last = F.struct(*[F.col(f"__last_{i}").alias(c) for i, c in enumerate(columns)])
    carry = lasts.select(*keys, _CHUNK, F.lag(last).over(Window.partitionBy(*keys).orderBy(_CHUNK)).alias(_VALUE))
    window = Window.partitionBy(*keys, _CHUNK).orderBy(_CARRY, order_col)
    return _without_carry(_with_carry(chunked, carry).withColumn(out, F.lag(_VALUE).over(window)))
