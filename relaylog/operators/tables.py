"""Control state: insert-if-absent, folds over command logs, observations and health."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylog.operators.outcomes import OUTCOMES, RECORD_KEY
from relaylog.operators.scale import with_previous


def insert_if_absent(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table`` plus the rows whose key it lacks; stored rows stay untouched."""
    new = rows.dropDuplicates(list(keys)).join(table, list(keys), "left_anti")
    return table.unionByName(new)


def ensure_subscriptions(table: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New subscriptions start running at revision 1."""
    fresh = ids.select(*keys, F.lit("running").alias("desired"), F.lit(1).cast("long").alias("revision"))
    return insert_if_absent(table, fresh, keys)


def fold_desired(
    subscriptions: DataFrame, commands: DataFrame, keys: Sequence[str], chunks: int | None = None
) -> DataFrame:
    """Apply a command log (``keys, seq, state``) to stored subscriptions (``keys, desired, revision``).

    The revision grows by one per real change; repeating a state changes nothing. Commands other than
    running and paused, and those for unknown subscriptions, have no effect.
    """
    valid = commands.filter(F.col("state").isin("running", "paused"))
    # States as numbers: aggregates over text sort their input instead of hashing it.
    paused = valid.select(*keys, "seq", (F.col("state") == "paused").cast("int").alias("paused"))
    steps = with_previous(paused, keys, "seq", ["paused"], "before", chunks)
    folded = steps.groupBy(*keys).agg(
        F.max_by("paused", "seq").alias("last"),
        F.min_by("paused", "seq").alias("first"),
        F.count_if(F.col("before.paused") != F.col("paused")).alias("changes"),
    )
    joined = subscriptions.join(folded, list(keys), "left")
    first_change = F.when((F.col("first") == 1) != (F.col("desired") == "paused"), 1).otherwise(0)
    last_state = F.when(F.col("last") == 1, "paused").when(F.col("last") == 0, "running")
    return joined.select(
        *keys,
        F.coalesce(last_state, "desired").alias("desired"),
        (F.col("revision") + F.coalesce(F.col("changes") + first_change, F.lit(0))).cast("long").alias("revision"),
    )


def latest_by_revision(observations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upserts accepted only at the same or a higher revision: the last arrival of the highest one stands."""
    # The place of an arrival and the state are found by number; the state's text is joined back on.
    revision, arrival = (F.col(c).cast("decimal(19,0)") for c in ("revision", "arrival"))
    place = (revision * F.lit("9223372036854775808").cast("decimal(19,0)") + arrival).cast("decimal(38,0)")
    placed = observations.select(*keys, "revision", "state", place.alias("__place"))
    last = placed.groupBy(*keys).agg(F.max("__place").alias("__place"))
    return placed.join(last, [*keys, "__place"]).select(*keys, "revision", "state").distinct()


def observed_everywhere(
    members: DataFrame, observations: DataFrame, keys: Sequence[str], member: str, revision: str, state: str
) -> DataFrame:
    """Per ``keys``: true only if every member has an observation with the wanted state and revision.

    ``members`` holds the wanted ``revision`` and ``state`` columns; a key without members has no row.
    """
    seen = observations.select(*keys, member, F.col("revision").alias("__revision"), F.col("state").alias("__state"))
    joined = members.join(seen, [*keys, member], "left")
    matched = F.coalesce(
        (F.col("__revision") >= F.col(revision)) & (F.col("__state") == F.col(state)), F.lit(False)
    )
    return joined.groupBy(*keys).agg(F.bool_and(matched).alias("observed"))


def terminal_everywhere(routed: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Per record: true only if every destination it was routed to has finished it."""
    finished = outcomes.filter(F.col("outcome").isNotNull()).select(*RECORD_KEY, F.lit(True).alias("finished")).distinct()
    joined = routed.select(*RECORD_KEY).join(finished, RECORD_KEY, "left")
    return joined.groupBy("topic", "partition", "offset").agg(
        F.bool_and(F.coalesce(F.col("finished"), F.lit(False))).alias("terminal")
    )


def best_outcomes(sent: DataFrame) -> DataFrame:
    """One row per destination and position over all rounds: its outcome if any round has one."""
    codes = F.array(*[F.lit(o) for o in OUTCOMES])
    code = F.max(F.array_position(codes, F.col("outcome")).cast("int"))
    return sent.groupBy(*RECORD_KEY).agg(code.alias("code")).select(*RECORD_KEY, F.get(codes, F.col("code") - 1).alias("outcome"))


def latch_blocks(events: DataFrame) -> DataFrame:
    """Blocked sources and the latest reason. A block never clears; an empty reason is no block."""
    named = events.filter(F.trim("reason") != "").select("source_id", "seq", "reason").distinct()
    last = named.groupBy("source_id").agg(F.max("seq").alias("seq"))
    latest = named.join(last, ["source_id", "seq"])
    # Of reasons with one seq, the one that hashes least: a number, so nothing is sorted.
    one = latest.groupBy("source_id").agg(F.min(F.xxhash64("reason")).alias("__hash"))
    return latest.join(one, "source_id").filter(F.xxhash64("reason") == F.col("__hash")).select("source_id", "reason")


def state_changes(observed: DataFrame, chunks: int | None = None) -> DataFrame:
    """The observations (``source_id, seq, state, reason``) that differ from the one before."""
    steps = with_previous(observed, ["source_id"], "seq", ["state", "reason"], "before", chunks)
    now = F.struct("state", "reason")
    return steps.filter(F.col("before").isNull() | ~now.eqNullSafe(F.col("before"))).drop("before")


def health_rollup(sources: DataFrame, subscriptions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``ready`` iff all sources run and all subscriptions run or are paused, else ``degraded``."""
    healthy = sources.select(*keys, F.col("state").isin("running").alias("ok")).unionByName(
        subscriptions.select(*keys, F.col("state").isin("running", "paused").alias("ok"))
    )
    return healthy.groupBy(*keys).agg(
        F.when(F.bool_and(F.coalesce(F.col("ok"), F.lit(False))), "ready").otherwise("degraded").alias("status")
    )


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def last_version(spark: SparkSession, path: str) -> int | None:
    """The newest version folder whose write was committed."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return None
    jvm = spark.sparkContext._jvm
    versions = [
        int(s.getPath().getName()[2:])
        for s in fs.listStatus(target)
        if s.getPath().getName().startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
    ]
    return max(versions, default=None)


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The current version of a state table; empty before its first write."""
    version = last_version(spark, path)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_version_path(path, version))


#: Versions that stay whatever their age, and the age in seconds up to which all others stay: a lazy frame from
#: ``read_state`` may be read that long.
KEPT_VERSIONS = 20
KEPT_SECONDS = 6 * 3600


def write_state(df: DataFrame, path: str, kept_seconds: float = KEPT_SECONDS) -> None:
    """A new version next to the old ones. Readers see it only once it is complete. A table has one writer.

    Versions go once they are neither among the last ``KEPT_VERSIONS`` nor younger than ``kept_seconds``.
    """
    spark = df.sparkSession
    version = last_version(spark, path)
    version = 0 if version is None else version + 1
    df.write.mode("overwrite").parquet(_version_path(path, version))
    fs, folder = hadoop_path(spark, path)
    oldest = time.time() - kept_seconds
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v=") and int(name[2:]) <= version - KEPT_VERSIONS and status.getModificationTime() / 1000 < oldest:
            fs.delete(status.getPath(), True)


def _version_path(path: str, version: int) -> str:
    return f"{path}/v={version:020d}"


def merge_rows(table: DataFrame, updates: DataFrame, keys: Sequence[str], mode: str) -> DataFrame:
    """``mode="insert"`` keeps stored rows; ``mode="upsert"`` lets the update of a key replace its row."""
    if mode == "insert":
        return insert_if_absent(table, updates, keys)
    if mode == "upsert":
        return table.join(updates, list(keys), "left_anti").unionByName(updates)
    raise ValueError(f"unknown merge mode {mode!r}")


def merge_table(path: str, updates: DataFrame, keys: Sequence[str], mode: str = "upsert") -> DataFrame:
    """Merge into a stored state table and return its new version. At most one update per key for upserts."""
    spark = updates.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in updates.schema.fields)
    write_state(merge_rows(read_state(spark, path, schema), updates, keys, mode), path)
    return read_state(spark, path, schema)
