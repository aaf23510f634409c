import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaylog.model import Source
from relaylog.operators import contract, decode
from relaylog.session import shared_dir
from relaylog.sources import changes
from relaylog.sources.tables import read_table, snapshot_scan

NAMES = ("Id", "tenant", "small", "ratio", "ok", "doc", "blob", "at", "at_tz", "note")
SOURCE = Source("s", "S", "Event_Store", NAMES, "Id", "tenant")


@pytest.fixture(scope="module")
def table(spark):
    schema = T.StructType(
        [
            T.StructField("Id", T.LongType()),
            T.StructField("tenant", T.StringType()),
            T.StructField("small", T.ShortType()),
            T.StructField("ratio", T.DoubleType()),
            T.StructField("ok", T.BooleanType()),
            T.StructField("doc", T.StringType(), True, {"type": "json"}),
            T.StructField("blob", T.BinaryType()),
            T.StructField("at", T.TimestampNTZType()),
            T.StructField("at_tz", T.TimestampType()),
            T.StructField("note", T.StringType()),
            T.StructField("extra", T.StringType()),
        ]
    )
    row = (
        -5, 1.25e300, True, '{"a": [1.0, "|x|"]}', b"\x00\xff", datetime(2024, 1, 2, 3, 4, 5, 120000),
        datetime(1969, 12, 31, 23, 59, 59, 999999, tzinfo=timezone.utc), 'quote " é \n',
    )
    data = [(i, "hot" if i % 3 else f"t{i}", *(row if i % 2 else (None,) * len(row)), "x") for i in range(60, 0, -1)]
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def identity(table):
    return contract.identity_from(table, SOURCE, 4)


def test_snapshot_reads_only_the_configured_columns(spark, table):
    path = shared_dir(spark, "table")
    table.write.parquet(path)
    scan = snapshot_scan(read_table(spark, path), SOURCE)
    assert scan.columns == [*NAMES, "op"]
    assert [r.Id for r in scan.collect()] == list(range(1, 61))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("chunk", [7, 1000])
def test_positions(table, identity, chunk):
    placed = changes.assign_positions(table, identity, chunks=chunk).collect()
    assert len(placed) == 60
    by_key, by_partition = {}, {}
    for r in sorted(placed, key=lambda r: r.Id):
        by_key.setdefault(r.tenant, set()).add(r.partition)
        by_partition.setdefault(r.partition, []).append(r.offset)
    assert all(len(p) == 1 for p in by_key.values())
    assert all(0 <= p < 4 for p in by_partition)
    assert all(offsets == list(range(len(offsets))) for offsets in by_partition.values())


def test_encode_and_decode_give_the_table_back(table, identity):
    log = changes.encode_changes(changes.assign_positions(table, identity), SOURCE, identity, "topic", "r")
    decoded = decode.decode_changes(log, SOURCE, identity, 1)
    assert decoded.filter("reject_reason is not null").count() == 0
    back = decoded.select("row.*")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, table.drop("extra").collect()), key=repr)
    payloads = {json.loads(r.payload)["Id"]: json.loads(r.payload) for r in decoded.select("payload").collect()}
    assert payloads[2]["doc"] is None and payloads[1]["doc"] == '{"a": [1.0, "|x|"]}'
    assert payloads[1]["at"] == "2024-01-02 03:04:05.12" and payloads[1]["at_tz"] == "1969-12-31 23:59:59.999999+00"
    assert float(payloads[1]["ratio"]) == 1.25e300 and payloads[1]["blob"] == "AP8="


def test_records(table, identity):
    one = changes.assign_positions(table, identity).filter("Id = 1")
    row = changes.encode_changes(one, SOURCE, identity, "topic", F.lit("d")).first()
    assert json.loads(row.key) == {"tenant": "hot"}
    assert json.loads(row.value) == {
        "before": None, "after": None, "source": {"schema": "public", "table": "Event_Store"}, "op": "d",
    }


def test_log_written_by_partition(spark, table, identity):
    path = shared_dir(spark, "log")
    log = changes.encode_changes(changes.assign_positions(table, identity), SOURCE, identity, "topic")
    changes.write_changes(log, path)
    back = changes.read_changes(spark, path)
    assert back.columns == ["topic", "partition", "offset", "key", "value"]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, log.collect()))
    one = back.filter((F.col("partition") == 1) & (F.col("offset") >= 3))
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition" in scan and "GreaterThanOrEqual(offset,3)" in scan
    bounds = {r.partition: (r.first_offset, r.end_offset) for r in changes.log_bounds(back).collect()}
    counts = {r.partition: r["count"] for r in back.groupBy("partition").count().collect()}
    assert bounds == {p: (0, n) for p, n in counts.items()}


def test_files_of_the_log_hold_runs_of_offsets_in_order(spark, monkeypatch):
    """A reader of a range opened every file of a partition: each held offsets from all over it."""
    monkeypatch.setattr(changes, "_RUN", 50)
    path = shared_dir(spark, "log")
    shuffled = spark.range(0, 400, numPartitions=8).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), ((F.col("id") * 7) % 400).alias("offset"), F.lit("k").alias("key"), F.lit("v").alias("value")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        changes.write_changes(shuffled, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = changes.read_changes(spark, path).select("offset", F.input_file_name().alias("file")).collect()
    of = {}
    for r in found:
        of.setdefault(r["file"], []).append(r["offset"])
    assert all(o == sorted(o) for o in of.values()) and sorted(o for v in of.values() for o in v) == list(range(400))
    assert all(len(v) == 50 * len({o // 50 for o in v}) for v in of.values())
