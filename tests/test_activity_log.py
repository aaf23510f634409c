"""The stored activity log: what stays after trimming, cursors, lookups, crashes; the job's use of it."""

import os

import pytest
from pyspark.sql import functions as F

from relaylog.functions import keys
from relaylog.operators import activity
from relaylog.session import shared_dir
from relaylog.sources import activity_log
from relaylog.sources.activity_log import ActivityLog


def entries(spark, first, last, boot="boot"):
    return spark.range(first, last + 1, numPartitions=3).select(
        F.col("id").alias("sequence"), F.concat(F.lit("e"), "id").alias("event_id"), (F.col("id") % 7).cast("string").alias("aggregate_id"),
        F.lit("made").alias("event_name"), F.lit("info").alias("level"), F.lit("acknowledged").alias("message"),
    ).withColumn("id", keys.cursor_for(F.lit(boot), F.col("sequence")))


def fill(spark, cuts, keep=10, boot="boot", log=None):
    log = log or ActivityLog(spark, shared_dir(spark, "activity"), keep=keep)
    for low, high in zip(cuts, cuts[1:], strict=False):
        assert log.append(entries(spark, low + 1, high, boot), boot) == high
    return log


def stored_lines(spark, log):
    return sorted(r.sequence for r in spark.read.schema(activity_log.ENTRY).json(f"{log.path}/{log.lines}").collect())


@pytest.mark.parametrize("cuts", [[0, 3], [0, 4, 8, 12, 16, 20], [0, 100], [0, 25, 26, 27], [0, 5, 60, 64], [0, 10, 20]])
def test_the_newest_stay_and_little_else(spark, cuts):
    log = fill(spark, cuts)
    last = cuts[-1]
    newest = list(range(max(1, last - 9), last + 1))
    assert sorted(r.sequence for r in log.recent().collect()) == newest
    lines = stored_lines(spark, log)
    assert lines[-len(newest) :] == newest and len(lines) < 20 and len(set(lines)) == len(lines)
    assert sorted(r.sequence for r in log.history().collect()) == list(range(1, last + 1))


def test_lines_that_would_be_trimmed_are_not_written(spark, monkeypatch):
    written = []
    write = activity.write_activity
    monkeypatch.setattr(activity, "write_activity", lambda entries, *a: written.append(entries.count()) or write(entries, *a))
    log = fill(spark, [0, 100, 115])
    assert written == [10, 15] and log.history().count() == 115


def test_the_copy_holds_what_its_lines_say(spark):
    log = ActivityLog(spark, shared_dir(spark, "activity"))
    rows = entries(spark, 1, 3).withColumn("time", F.timestamp_micros(F.lit(1_700_000_000_123_456))).withColumn("attempt", F.when(F.col("sequence") == 2, 1))
    log.append(rows, "boot")
    lines = spark.read.schema(activity_log.ENTRY).json(log.segments()[0].folder)
    assert sorted(map(tuple, log.history().collect()), key=str) == sorted(map(tuple, lines.collect()), key=str)


def test_cursors_as_on_the_whole_log(spark):
    log, last = fill(spark, [0, 6, 13, 31, 33]), 33
    whole = entries(spark, 1, last)
    for cursor in ("", "boot:30", "boot:23", "boot:22", "boot:33", "boot:34", "other:33", "boot:0"):
        got, want = log.read_after("boot", cursor), activity.read_after(whole, "boot", cursor, 10)
        assert got[1:] == want[1:]
        assert [r.sequence for r in got[0].collect()] == [r.sequence for r in want[0].collect()]
    with pytest.raises(activity.InvalidCursor):
        log.read_after("boot", "boot")


def test_bounds_and_pages_open_no_old_lines(spark):
    log = fill(spark, [0, 6, 13, 31, 33])
    assert {s.last for s in log.segments()} == {31, 33} and log.last("boot") == 33
    page, _, _ = log.read_after("boot", "boot:31")
    assert len(page.inputFiles()) <= 1 + sum(f.endswith(".json") for f in os.listdir(log.segments()[0].folder.removeprefix("file:"))) + 3


def test_lives_share_the_limit_and_keep_their_cursors_apart(spark):
    log = fill(spark, [0, 8], boot="a:b/c=1")
    fill(spark, [0, 4], boot="second", log=log)
    assert [(s.boot, s.first, s.last) for s in log.segments()] == [("a:b/c=1", 1, 8), ("second", 1, 4)]
    assert log.recent().count() == 10 and log.recent("second").count() == 4
    assert log.read_after("second", "second:1")[1:] == ("second:4", False)
    fill(spark, [4, 30], boot="second", log=log)
    assert {s.boot for s in log.segments()} == {"second"} and log.find(event_id="e3").count() == 2


def test_nothing_appended(spark):
    log = ActivityLog(spark, shared_dir(spark, "activity"))
    assert log.append(entries(spark, 1, 0), "boot") == 0
    assert log.recent().count() == log.history().count() == log.find(event_id="e1").count() == 0
    assert log.read_after("boot")[1:] == ("boot:0", False)
    fill(spark, [0, 5], log=log)
    assert log.append(entries(spark, 1, 0), "boot") == 5 and log.recent().count() == 5


def test_a_failed_append_is_not_read(spark, monkeypatch):
    log = fill(spark, [0, 5])
    monkeypatch.setattr(ActivityLog, "_write_copy", lambda *_: (_ for _ in ()).throw(OSError("down")))
    with pytest.raises(OSError):
        log.append(entries(spark, 6, 9), "boot")
    monkeypatch.undo()
    assert log.recent().count() == log.history().count() == 5
    fill(spark, [5, 8], log=log)
    assert stored_lines(spark, log) == list(range(1, 9)) and log.history().count() == 8


def test_a_crash_while_trimming_loses_nothing(spark, monkeypatch):
    log = fill(spark, [0, 5])
    delete = ActivityLog._delete
    monkeypatch.setattr(ActivityLog, "_delete", lambda *_: (_ for _ in ()).throw(OSError("down")))
    with pytest.raises(OSError):
        log.append(entries(spark, 6, 60), "boot")
    monkeypatch.setattr(ActivityLog, "_delete", delete)
    assert sorted(r.sequence for r in log.recent().collect()) == list(range(51, 61))
    fill(spark, [60, 62], log=log)
    assert stored_lines(spark, log) == list(range(51, 63)) and log.history().count() == 62


def test_merged_copies_hold_every_entry_once(spark, monkeypatch):
    monkeypatch.setattr(activity_log, "_MERGED", 3)
    log = fill(spark, list(range(0, 45, 4)))
    assert sorted(r.sequence for r in log.history().collect()) == list(range(1, 45))
    assert len(log._copies()) <= 2 * 3 and max(c.level for c in log._copies()) == 2
    assert len(log._all_copies()) <= 3 * 3


def rows_read(df):
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        if name == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_a_lookup_skips_what_cannot_match(spark, monkeypatch):
    """One id among many appends whose ids overlap in range: the Bloom filters tell them apart."""
    monkeypatch.setattr(activity_log, "_MERGED", 100)
    log = ActivityLog(spark, shared_dir(spark, "activity"))
    for k in range(4):
        rows = entries(spark, 1 + 5000 * k, 5000 * (k + 1)).withColumn("event_id", F.concat(F.lit("e"), F.col("sequence") % 5000, F.lit(f"x{k}")))
        log.append(rows, "boot")
    found = log.find(event_id="e42x2")
    assert [r.sequence for r in found.collect()] == [10042]
    assert 0 < rows_read(found) <= 5000
    assert rows_read(log.find(event_id="e42x9")) == 0
    assert rows_read(log.find(event_name="made")) == 20_000


def test_order_beyond_any_product_of_offset_and_place(spark):
    rows = spark.createDataFrame(
        [("d", "t", 0, 2**62, 2), ("d", "t", 0, 2**62, 0), ("d", "t", 1, 2**62, 1), ("c", "t", 0, 2**62, 5), ("d", "t", 0, 1, 9)],
        "destination_id string, topic string, partition int, offset long, step long",
    )
    got = activity.stamped(rows, "b", activity.record_order()).orderBy("sequence").collect()
    assert [(r.destination_id, r.partition, r.offset, r.step, r.sequence) for r in got] == [
        ("d", 0, 1, 9, 1), ("c", 0, 2**62, 5, 2), ("d", 0, 2**62, 0, 3), ("d", 0, 2**62, 2, 4), ("d", 1, 2**62, 1, 5),
    ]
