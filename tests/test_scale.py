"""Chunked scans equal plain windows, with one key holding a third of the rows, for few and for many chunks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from relaylog.operators import scale


@pytest.fixture(scope="module")
def rows(spark):
    # Ids are unique and unevenly spaced; key 0 holds a third of the rows, one key is null.
    i = F.col("id")
    key = F.when(i % 3 == 0, 0).when(i % 50 == 1, None).otherwise(1 + i % 7)
    return spark.range(3000).select(
        (i * i + (i % 5)).alias("seq"),
        key.cast("int").alias("k"),
        (i % 4).alias("v"),
        F.when(i % 2 == 0, F.lit("a")).alias("s"),
    ).cache()


@pytest.fixture(scope="module")
def window(rows):
    return Window.partitionBy("k").orderBy("seq")


def same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(*a.columns).collect()), key=repr)


CHUNKS = [2, 16, 500]


@pytest.mark.parametrize("chunks", CHUNKS)
def test_numbered(rows, window, chunks):
    got = scale.numbered(rows, ["k"], "seq", "n", chunks)
    assert same(got, rows.withColumn("n", (F.row_number().over(window) - 1).cast("long")))


@pytest.mark.parametrize("chunks", CHUNKS)
def test_running_sum(rows, window, chunks):
    got = scale.running_sum(rows, ["k"], "seq", F.col("v"), "total", chunks)
    assert same(got, rows.withColumn("total", F.sum("v").over(window)))


@pytest.mark.parametrize("chunks", CHUNKS)
def test_with_previous(rows, window, chunks):
    got = scale.with_previous(rows, ["k"], "seq", ["s", "v"], "before", chunks)
    assert same(got, rows.withColumn("before", F.lag(F.struct("s", "v")).over(window)))


def test_chunks_are_bounded_and_ordered(rows):
    groups = scale.with_chunk(rows, "seq", 16).groupBy("__chunk")
    found = groups.agg(F.count("*").alias("n"), F.min("seq").alias("low"), F.max("seq").alias("high")).orderBy("__chunk").collect()
    assert len(found) == 16 and max(r.n for r in found) < 1.1 * 3000 / 16
    assert all(a.high < b.low for a, b in zip(found, found[1:]))
    assert scale.with_chunk(rows.limit(0), "seq").collect() == []
    assert scale.numbered(rows.limit(0), ["k"], "seq", "n").collect() == []


def _kinds(spark):
    """Order columns of other kinds, each with the same order as ``n``."""
    n = F.col("id")
    df = spark.range(400).select(n.alias("n"), (n % 3).alias("k"), n.alias("v"))
    return {
        "dense from 2**60": df.withColumn("seq", F.lit(1 << 60) + F.col("n")),
        "both ends": df.withColumn("seq", F.when(F.col("n") < 200, F.lit(-(1 << 63)) + F.col("n")).otherwise(F.lit((1 << 63) - 500) + F.col("n"))),
        "int": df.withColumn("seq", F.col("n").cast("int")),
        "timestamp": df.withColumn("seq", F.timestamp_micros(F.col("n"))),
        "timestamp_ntz": df.withColumn("seq", F.timestamp_micros(F.col("n")).cast("timestamp_ntz")),
        "date": df.withColumn("seq", F.date_add(F.lit("2020-01-01").cast("date"), F.col("n").cast("int"))),
    }


@pytest.mark.parametrize("kind", ["dense from 2**60", "both ends", "int", "timestamp", "timestamp_ntz", "date"])
def test_order_columns(spark, kind):
    df = _kinds(spark)[kind]
    window = Window.partitionBy("k").orderBy("seq")
    for chunks in (2, 64):
        assert same(scale.running_sum(df, ["k"], "seq", F.col("v"), "t", chunks), df.withColumn("t", F.sum("v").over(window)))
    sizes = [r["count"] for r in scale.with_chunk(df, "seq", 64).groupBy("__chunk").count().collect()]
    assert len(sizes) == 64 and max(sizes) <= 8


@pytest.mark.parametrize("chunks", CHUNKS)
def test_null_order_values_are_refused(spark, chunks):
    df = spark.range(50).select(F.when(F.col("id") != 7, F.col("id")).alias("seq"), F.lit(1).alias("k"))
    with pytest.raises(Exception, match="null in the order column seq"):
        scale.numbered(df, ["k"], "seq", "n", chunks).collect()


def test_other_order_columns_are_refused(spark):
    for kind in ("string", "double", "decimal(10,0)"):
        with pytest.raises(TypeError, match="order column"):
            scale.numbered(spark.range(3).select(F.col("id").cast(kind).alias("seq"), F.lit(1).alias("k")), ["k"], "seq", "n")


def test_building_runs_no_job(spark, rows):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    scale.numbered(rows, ["k"], "seq", "n")
    scale.with_previous(rows, ["k"], "seq", ["s"], "before")
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_no_window_over_the_bare_key(rows):
    plan = scale.numbered(rows, ["k"], "seq", "n", 100)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("__chunk" in line.split("windowspecdefinition")[1] for line in windows) == 2


def test_small_side_has_another_way(spark):
    big, small = spark.range(100), spark.range(5)

    def hinted(rows):
        return "broadcast" in big.join(scale.small_side(small, rows), "id")._jdf.queryExecution().analyzed().toString().lower()

    assert hinted(5) and not hinted(scale.MAX_BROADCAST_BYTES // 24 + 1)
