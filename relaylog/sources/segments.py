"""Live logs: appends of new rows, segments that become visible whole and in order, and a manifest of their files.

A log is a folder with one file or more per partition and segment. Beside the records it holds, in folders that readers skip,

- ``_staging``: a segment while it is written. Only one that is complete is published: its files are moved into the log in
  offset order, so a record is never visible before all with lower offsets. A crash in between is made good by the next
  append, which moves the rest; a segment that was never complete is dropped, and its rows are still new;
- ``_manifest``: a row per file (partition, offsets, records, bytes), so bounds and range reads choose files without opening one;
- ``_captured``: the serial of every record, so that an append finds the rows that the log does not hold yet.

Manifest and serials are read off the published files, each once. Files that have no entry, because another writer
wrote them or an append was cut off, are scanned by readers until the next append indexes them. Entries of files that are gone
do not count. A log has one writer.

Rows are new if their *serial* is not in the log, never because it is larger than the last one: a transaction that
commits late adds a row with a smaller serial, which is appended at the end like any other.
"""

from __future__ import annotations

import os
import re
import uuid
from collections import Counter
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylog.model import RAW_RECORD, Identity, Source
from relaylog.operators.scale import numbered, small_side
from relaylog.operators.tables import hadoop_path
from relaylog.sources import changes

_MANIFEST = "topic string, partition int, first_offset bigint, end_offset bigint, records bigint, bytes bigint, file string"
_CAPTURED = "topic string, partition int, offset bigint, serial bigint"
_BOUNDS = "topic string, partition int, first_offset bigint, end_offset bigint"
#: Records of a file: the unit that is written by one task and moved at once.
SEGMENT_RECORDS = 1 << 20
#: Records, in whole files, that one task writes; files smaller than that share a folder while staged.
_DEALT_RECORDS = 1 << 14
#: Files above which a range read names whole folders where it can.
_LISTED = 1000
#: Files of the manifest above which they are written together.
_COMPACT = 64
_IN_LOG = re.compile(r"(topic=[^/]+/partition=[^/]+/[^/]+)$")


def _side(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/_{name}"


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    """The paths as one text: a call to the JVM for each of them would cost more than listing them."""
    fs, target = hadoop_path(spark, pattern)
    found = fs.globStatus(target)
    if found is None or not len(found):
        return []
    jvm = spark.sparkContext._jvm
    paths = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, len(found))
    jvm.java.lang.System.arraycopy(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found), 0, paths, 0, len(found))
    return sorted(jvm.org.apache.hadoop.util.StringUtils.join("\n", jvm.java.util.Arrays.asList(paths)).split("\n"))


def _log_files(spark: SparkSession, path: str) -> list[str]:
    """The log's files as names below its folder. One name a file, as Spark's own listing holds."""
    return [_IN_LOG.search(f)[1] for f in _glob(spark, f"{path.rstrip('/')}/topic=*/partition=*/*.parquet")]


def _stored(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    if not _glob(spark, f"{folder}/*.parquet"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def _records_of(spark: SparkSession, path: str, places: Sequence[str]) -> DataFrame:
    """The records of files or whole folders, by their names below the log's folder."""
    root = path.rstrip("/")
    return spark.read.schema(RAW_RECORD).option("basePath", root).parquet(*[f"{root}/{p}" for p in places])


def _folder(file: str) -> str:
    return file.rpartition("/")[0]


def _by_folder(files: Sequence[str], listed: Sequence[str], share: float = 1.0) -> list[str]:
    """``files`` as few places: a folder instead of its files if they are at least ``share`` of all that are ``listed`` in it.

    Spark looks for each place on its own, so thousands of files would take longer to find than to read.
    """
    chosen, all_of = Counter(map(_folder, files)), Counter(map(_folder, listed))
    whole = {f for f, n in chosen.items() if n >= share * all_of[f]}
    return sorted(whole | {f for f in files if _folder(f) not in whole})


def record_bytes() -> Column:
    """The size of a record: its key and value."""
    return (F.coalesce(F.octet_length("key"), F.lit(0)) + F.coalesce(F.octet_length("value"), F.lit(0))).cast("long")


def _entries(records: DataFrame) -> DataFrame:
    """Manifest rows of the files that ``records`` reads."""
    name = F.regexp_extract("_metadata.file_path", _IN_LOG.pattern, 1)
    sized = records.select("topic", "partition", "offset", record_bytes().alias("size"), name.alias("file"))
    return sized.groupBy("topic", "partition", "file").agg(
        F.min("offset").alias("first_offset"),
        (F.max("offset") + 1).alias("end_offset"),
        F.count(F.lit(1)).alias("records"),
        F.sum("size").alias("bytes"),
    ).select("topic", "partition", "first_offset", "end_offset", "records", "bytes", "file")


def _split(spark: SparkSession, path: str) -> tuple[DataFrame, list[str], list[str]]:
    """(manifest rows of files that exist, files without a row, all files)."""
    files = _log_files(spark, path)
    stored = _stored(spark, _side(path, "manifest"), _MANIFEST).dropDuplicates(["file"])
    known = {r["file"] for r in stored.select("file").collect()}
    gone = sorted(known.difference(files))
    if gone:
        stored = stored.join(F.broadcast(spark.createDataFrame([(f,) for f in gone], "file string")), "file", "left_anti")
    return stored.select(*[c.split()[0] for c in _MANIFEST.split(", ")]), [f for f in files if f not in known], files


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row per file of the log. Files with an entry are not opened, the others are scanned."""
    known, unknown, files = _split(spark, path)
    return known.unionByName(_entries(_records_of(spark, path, _by_folder(unknown, files)))) if unknown else known


def log_bounds(spark: SparkSession, path: str, entries: DataFrame | None = None) -> DataFrame:
    """First and end offset per log partition, as ``changes.log_bounds`` of the whole log gives them.

    ``entries``: the log's ``manifest``, if the caller has it; else the files are listed for it.
    """
    entries = manifest(spark, path) if entries is None else entries
    return entries.groupBy("topic", "partition").agg(
        F.min("first_offset").alias("first_offset"), F.max("end_offset").alias("end_offset")
    )


def read_range(spark: SparkSession, path: str, ranges: Sequence[tuple[str, int, int, int]]) -> DataFrame:
    """The records of ``ranges`` (topic, partition, first offset, offset after the last), from the files that can hold them.

    One range per log partition at most.
    """
    wanted = spark.createDataFrame(list(ranges), "topic string, partition int, low bigint, high bigint")
    wanted = small_side(wanted, len(ranges))
    known, unknown, listed = _split(spark, path)
    near = known.join(wanted, ["topic", "partition"]).filter("first_offset < high and end_offset > low")
    files = [r["file"] for r in near.select("file").collect()]
    parts = {f"topic={t}/partition={p}/" for t, p, *_ in ranges}
    files += [f for f in unknown if _folder(f) + "/" in parts]
    if not files:
        return spark.createDataFrame([], RAW_RECORD)
    # From half of a folder's files on, Spark finds the folder sooner than its files; the filters below hold for all of them.
    records = _records_of(spark, path, _by_folder(files, listed, 0.5) if len(files) > _LISTED else sorted(files))
    lowest, highest = min(r[2] for r in ranges), max(r[3] for r in ranges)
    records = records.filter((F.col("offset") >= lowest) & (F.col("offset") < highest))
    found = records.join(wanted, ["topic", "partition"]).filter("offset >= low and offset < high")
    return found.select(*RAW_RECORD.names)


def index_log(spark: SparkSession, path: str, serials: dict[str, str] | None = None) -> int:
    """Read what the manifest and the serials lack off the log's files, each file once; how many files that were.

    ``serials``: the serial column by topic. A file's manifest row comes last, so a crash repeats it; serials
    that are there twice change nothing.
    """
    _, unknown, files = _split(spark, path)
    if not unknown:
        return 0
    records = _records_of(spark, path, _by_folder(unknown, files))
    for topic, column in (serials or {}).items():
        serial = F.get_json_object("value", f"$.after.{column}").cast("long")
        own = records.filter(F.col("topic") == topic).select("topic", "partition", "offset", serial.alias("serial"))
        own.filter(F.col("serial").isNotNull()).write.mode("append").parquet(_side(path, "captured"))
    _entries(records).coalesce(1).write.mode("append").parquet(_side(path, "manifest"))  # a row a file
    _compact(spark, path)
    return len(unknown)


def _compact(spark: SparkSession, path: str) -> None:
    """Write many small files of the manifest together. A crash in between leaves rows twice, which changes nothing."""
    old = _glob(spark, f"{_side(path, 'manifest')}/*.parquet")
    if len(old) > _COMPACT:
        _stored(spark, _side(path, "manifest"), _MANIFEST).dropDuplicates(["file"]).coalesce(1).write.mode("append").parquet(_side(path, "manifest"))
        for file in old:
            fs, target = hadoop_path(spark, file)
            fs.delete(target, False)


def write_segment(records: DataFrame, path: str, segment_records: int = SEGMENT_RECORDS) -> None:
    """Write raw change records with positions as one segment: all of it becomes visible, in offset order, or none."""
    spark = records.sparkSession
    # A task gets whole runs of records and cuts them into files itself, so a run has one folder and not each of its files.
    run = segment_records * max(1, _DEALT_RECORDS // segment_records)
    chunk = F.floor(F.col("offset") / run).cast("long")
    staged = f"{_side(path, 'staging')}/{uuid.uuid4().hex}"
    keys = ["topic", "partition", "chunk"]
    dealt = records.withColumn("chunk", chunk).repartition(*keys).sortWithinPartitions(*keys, "offset")
    dealt.write.option("maxRecordsPerFile", segment_records).partitionBy(*keys).parquet(staged)
    publish(spark, path)


#: A staged file: log partition, chunk, name, and its number among the files that its task wrote of the chunk.
_STAGED = re.compile(r"(topic=[^/]+/partition=[^/]+)/chunk=(\d+)/([^/]*?(?:\.c(\d+))?\.[^/]*)$")


def publish(spark: SparkSession, path: str) -> None:
    """Move the files of complete segments into the log, in offset order; drop segments that were never complete."""
    root = path.rstrip("/")
    fs, staging = hadoop_path(spark, _side(path, "staging"))
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # each mention would be looked up anew
    for folder in _glob(spark, f"{staging}/*"):
        segment = folder.rpartition("/")[2]
        target = at(folder)
        if fs.exists(at(target, "_SUCCESS")):
            of: dict[str, list[re.Match]] = {}
            for file in _glob(spark, f"{folder}/*/*/*/*.parquet"):
                m = _STAGED.search(file)
                of.setdefault(m[1], []).append(m)

            def move(place: str) -> None:
                fs.mkdirs(at(f"{root}/{place}"))
                for m in sorted(of[place], key=lambda m: (int(m[2]), int(m[4] or 0))):  # noqa: B023
                    new = at(f"{root}/{place}/{int(m[2]):012d}-{int(m[4] or 0):06d}-{segment}-{m[3]}")  # noqa: B023
                    if not fs.rename(at(m.string), new):
                        raise OSError(f"could not move {m.string} into the log")

            # Log partitions have no order among each other.
            with ThreadPoolExecutor(min(len(of), os.cpu_count() or 1) or 1) as movers:
                list(movers.map(move, of))
        fs.delete(target, True)


def new_rows(spark: SparkSession, table: DataFrame, source: Source, topic: str, path: str, settled: int | None = None) -> DataFrame:
    """The rows of ``table`` whose serial the log does not hold.

    ``settled``: a serial below which no transaction is open any more and all rows are captured, if the
    caller knows one; both sides are then read from there on only.
    """
    serial = F.col(f"`{source.serial_column}`")
    captured = _stored(spark, _side(path, "captured"), _CAPTURED).filter(F.col("topic") == topic)
    if settled is not None:
        table, captured = table.filter(serial >= settled), captured.filter(F.col("serial") >= settled)
    held = captured.select(F.col("serial").alias("__serial"))
    return table.join(held, serial == F.col("__serial"), "left_anti")


def append_rows(
    table: DataFrame,
    source: Source,
    identity: Identity,
    topic: str,
    path: str,
    partition: Column | None = None,
    settled: int | None = None,
    segment_records: int = SEGMENT_RECORDS,
) -> int:
    """Append the rows of ``table`` that the log at ``path`` does not hold; how many those were.

    Offsets go on from each partition's end, in serial order within one append. The first append of a topic is its
    snapshot (op ``r``), later ones are changes (``c``). Appending the same rows again adds nothing.
    """
    spark = table.sparkSession
    publish(spark, path)
    index_log(spark, path, {topic: source.serial_column})
    ends = log_bounds(spark, path).filter(F.col("topic") == topic).select("partition", F.col("end_offset").alias("__end"))
    begun = not ends.isEmpty()
    rows = new_rows(spark, table, source, topic, path, settled)
    if partition is None:
        partition = changes.partition_of(F.col(f"`{identity.partitioning_column}`"), identity.partitions)
    placed = numbered(rows.withColumn("partition", partition.cast("int")), ["partition"], identity.serial_column, "__place")
    placed = placed.join(small_side(ends, identity.partitions), "partition", "left")
    placed = placed.withColumn("offset", F.col("__place") + F.coalesce("__end", F.lit(0))).drop("__place", "__end")
    records = changes.encode_changes(placed, source, identity, topic, "c" if begun else "r")
    before = _count(spark, path, topic)
    write_segment(records, path, segment_records)
    index_log(spark, path, {topic: source.serial_column})
    return _count(spark, path, topic) - before


def _count(spark: SparkSession, path: str, topic: str) -> int:
    return manifest(spark, path).filter(F.col("topic") == topic).agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]


def within_bytes(records: DataFrame, most: int, size: Column | None = None) -> DataFrame:
    """Of each log partition the records from its first one on that hold at most ``most`` bytes together, one at least.

    ``records`` is a bounded range per log partition, such as a round's; a partition is ordered in one task.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("topic", "partition").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    own = record_bytes() if size is None else size.cast("long")
    summed = records.withColumn("__own", own).withColumn("__sum", F.sum("__own").over(order))
    return summed.filter((F.col("__sum") <= most) | (F.col("__sum") == F.col("__own"))).drop("__own", "__sum")
