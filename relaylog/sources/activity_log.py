"""The activity log on disk: JSON lines of the newest entries, and a columnar copy of all of them for lookups.

Every append is a *segment*: a folder of JSON lines, the newest ones at once where it is large, with a marker beside them whose name says which numbers it holds. Readers
skip the marker; bounds, cursors and trimming go by the names, so they open no data. Trimming drops whole segments that are
older than the newest ``keep`` entries, and writes the end of one anew if it holds more than ``keep`` old ones. So
at most twice ``keep`` entries are stored as lines, however long the log lives and however large an append is.

The copy is Parquet with Bloom filters on the identifiers by which entries are looked for, sorted by event id. An append adds
a folder; ``_MERGED`` folders of a level become one of the next level, so an entry is written anew a logarithm of
times, and the number of folders stays small. A merge is complete once its folder has its name; the folders that it
covers do not count from then on, and are deleted by the next merge, so a reader that has just listed them can finish.

The log has one writer. A segment without a marker is what a failed append left; it is not read, and the next append deletes
it. Where only the marker was missing, lookups find its entries, under numbers that may be given again.
"""

from __future__ import annotations

import re
import urllib.parse
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from relaylog.operators import activity
from relaylog.operators.tables import hadoop_path

ENTRY = (
    "id string, sequence bigint, time timestamp, level string, message string, source_id string, destination_id string, "
    "generation int, topic string, partition int, offset bigint, event_id string, aggregate_id string, event_name string, "
    "attempt int, outcome string, error string"
)
#: What entries are looked up by.
IDENTIFIERS = ("event_id", "aggregate_id", "event_name")

_MERGED = 16
_MARKER = re.compile(r"_span-(\d+)-(\d+)-(\d+)-(.+)")
_LEVEL = re.compile(r"L(\d+)-(\d+)-(\d+)")
_ROW_GROUP = 16 << 20


@dataclass(frozen=True, order=True)
class Segment:
    """``number`` counts the appends of all lives of the log; ``first`` to ``last`` are the entries' own numbers."""

    number: int
    first: int
    last: int
    boot: str = field(compare=False)
    folder: str = field(compare=False)


@dataclass(frozen=True, order=True)
class _Copy:
    level: int
    low: int
    high: int
    folder: str = field(compare=False)


def _typed(entries: DataFrame) -> DataFrame:
    """Entries as they are read back from their lines: all columns, and times to the millisecond."""
    columns = []
    for field in StructType.fromDDL(ENTRY):
        value = F.col(field.name) if field.name in entries.columns else F.lit(None)
        value = F.date_trunc("millisecond", value) if field.name == "time" else value
        columns.append(value.cast(field.dataType).alias(field.name))
    return entries.select(*columns)


@dataclass
class ActivityLog:
    """``path`` must be on storage every executor can reach. ``lines`` is the pattern of the segments' folders below it."""

    spark: SparkSession
    path: str
    lines: str = "lines/*"
    keep: int = activity.RETAINED

    def segments(self) -> list[Segment]:
        """From the markers, oldest first. Of two folders of one append, the shorter one counts: its old end was trimmed."""
        return sorted({s.number: s for s in sorted(self._marked())}.values())

    def _marked(self) -> list[Segment]:
        found = []
        for path in self._glob(f"{self.lines}/_span-*"):
            folder, name = path.rsplit("/", 1)
            if m := _MARKER.fullmatch(name):
                found.append(Segment(int(m[1]), int(m[2]), int(m[3]), urllib.parse.unquote(m[4]), folder))
        return found

    def last(self, boot: str) -> int:
        return max((s.last for s in self.segments() if s.boot == boot), default=0)

    def append(self, entries: DataFrame, boot: str, folder: str | None = None) -> int:
        """Append stamped entries and trim; returns the number of the last entry. No entries leave the log as it is.

        ``folder``: where their lines go, a new folder that matches ``lines``.
        """
        known = self.segments()
        marked = {s.folder for s in self._marked()}
        for left in self._glob(self.lines):
            if left not in marked:
                self._delete(left)
        folder = folder or f"{self.path}/{self.lines.replace('*', uuid.uuid4().hex, 1)}"
        copies = self._copies()
        number = 1 + max([s.number for s in known] + [c.high for c in copies], default=0)
        copy = self._write_copy(_typed(entries).sortWithinPartitions("event_id", "sequence"), 0, number, number)
        if copy is None:
            return self.last(boot)
        own = self._read([copy], "parquet")
        ends = own.agg(F.min("sequence").alias("first"), F.max("sequence").alias("last")).first()
        # Only the lines that trimming would leave.
        first, last = ends["first"], ends["last"]
        first = first if last - first < 2 * self.keep else last - self.keep + 1
        lines = own.filter(F.col("sequence") >= first).select(*[c for c in entries.columns if c in own.columns])
        activity.write_activity(lines.coalesce(1), folder, "overwrite")
        self._mark(folder, number, first, last, boot)
        self._trim()
        self._merge()
        return last

    def recent(self, boot: str | None = None) -> DataFrame:
        """The newest ``keep`` entries, or those of one life among them."""
        left, rows = self.keep, None
        for s in reversed(self.segments()):
            if left <= 0:
                break
            part = self._read([s.folder], "json").filter(F.col("sequence") > s.last - left)
            left -= s.last - s.first + 1
            if boot is None or s.boot == boot:
                rows = part if rows is None else rows.unionByName(part)
        return self.spark.createDataFrame([], ENTRY) if rows is None else rows

    def read_after(self, boot: str, cursor: str = "") -> tuple[DataFrame, str, bool]:
        """As ``activity.read_after``; segments that the page does not reach are not opened."""
        mine = [s for s in self.segments() if s.boot == boot]
        last = max((s.last for s in mine), default=0)
        log = self._read([s.folder for s in mine if s.last > last - self.keep], "json")
        return activity.read_after(log, boot, cursor, self.keep, last)

    def find(self, **identifiers: str | None) -> DataFrame:
        """``activity.find_activity`` over all entries ever appended; statistics and Bloom filters skip what can't match."""
        return activity.find_activity(self.history(), **identifiers)

    def history(self) -> DataFrame:
        return self._read([c.folder for c in self._copies()], "parquet")

    # -- files ------------------------------------------------------------------------------------------------------

    def _glob(self, pattern: str) -> list[str]:
        fs, target = hadoop_path(self.spark, f"{self.path}/{pattern}")
        return [str(f.getPath()) for f in fs.globStatus(target) or []]

    def _qualified(self, path: str) -> str:
        fs, target = hadoop_path(self.spark, path)
        return str(fs.makeQualified(target))

    def _delete(self, path: str) -> None:
        fs, target = hadoop_path(self.spark, path)
        fs.delete(target, True)
        above = target.getParent()
        if fs.exists(above) and not len(fs.listStatus(above)):
            fs.delete(above, False)

    def _read(self, folders: list[str], fmt: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).format(fmt).load(folders)

    def _mark(self, folder: str, number: int, first: int, last: int, boot: str) -> None:
        name = f"_span-{number}-{first}-{last}-{urllib.parse.quote(boot, safe='')}"
        fs, target = hadoop_path(self.spark, f"{folder}/{name}")
        fs.create(target, True).close()

    def _trim(self) -> None:
        newer, valid = 0, []
        for s in reversed(self.segments()):
            wanted, size = self.keep - newer, s.last - s.first + 1
            newer += size
            if wanted > 0 and size <= wanted + self.keep:
                valid.append(s.folder)
            elif wanted > 0:
                kept = f"{self.path}/{self.lines.replace('*', uuid.uuid4().hex, 1)}"
                # At most ``keep`` rows.
                ends = self._read([s.folder], "json").filter(F.col("sequence") > s.last - wanted)
                activity.write_activity(ends.coalesce(1), kept)
                self._mark(kept, s.number, s.last - wanted + 1, s.last, s.boot)
                valid.append(self._qualified(kept))
        for s in self._marked():
            if s.folder not in valid:
                self._delete(s.folder)

    def _all_copies(self) -> list[_Copy]:
        names = [(p, _LEVEL.fullmatch(p.rsplit("/", 1)[1])) for p in self._glob("history/L*")]
        return sorted(_Copy(int(m[1]), int(m[2]), int(m[3]), p) for p, m in names if m)

    def _copies(self) -> list[_Copy]:
        """Those that no merged one covers."""
        found = self._all_copies()
        return [c for c in found if not any(o.level > c.level and o.low <= c.low and c.high <= o.high for o in found)]

    def _write_copy(self, rows: DataFrame, level: int, low: int, high: int) -> str | None:
        """The folder of the copy; none, and no folder, if there are no rows."""
        draft = f"{self.path}/history/_draft-{uuid.uuid4().hex}"
        writer = rows.write.option("parquet.block.size", str(_ROW_GROUP)).option("parquet.bloom.filter.adaptive.enabled", "true")
        for name in IDENTIFIERS:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer.parquet(draft)
        if self._read([draft], "parquet").isEmpty():
            return self._delete(draft)
        fs, source = hadoop_path(self.spark, draft)
        named, target = hadoop_path(self.spark, f"{self.path}/history/L{level}-{low}-{high}")
        if not fs.rename(source, target):
            raise OSError(f"cannot name {target}")
        return str(named.makeQualified(target))

    def _merge(self) -> None:
        live = self._copies()
        for old in set(self._all_copies()) - set(live):
            self._delete(old.folder)
        for level in sorted({c.level for c in live}):
            same = [c for c in self._copies() if c.level == level]
            if len(same) >= _MERGED:
                rows = self._read([c.folder for c in same], "parquet")
                # By id and number, so entries without an id or of one busy id are many ranges.
                ranged = rows.repartitionByRange("event_id", "sequence").sortWithinPartitions("event_id", "sequence")
                self._write_copy(ranged, level + 1, same[0].low, same[-1].high)
