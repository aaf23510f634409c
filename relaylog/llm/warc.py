"""WARC archives without repeated payloads: revisit records are resolved by shuffling headers, never payloads.

``write_archives`` writes a response record per page. ``deduplicate`` takes the headers of such archives, with the place
of each record, shuffles them by payload digest and decides: of records with equal payloads of at least ``MIN_BYTES``
bytes, the one with the smallest page_id stays a response, the others become revisits of it. Then tasks, each with
a run of neighbouring records, copy them from place to place: every record gets fresh headers, revisits lose their payload
and name the record, address and date that they refer to. Records that are revisits already are joined to the response that
holds their payload, wherever it is now; one whose payload is nowhere among the archives stays as it is.
``read_archives`` reads every record of a folder of archives, this module's or others', and ``resolved`` joins revisits to
the responses that they refer to.

Files are ``.warc.gz`` with one gzip member a record, so each record can be read by its place alone. A file ends at
``FILE_BYTES``. A task that runs again writes files under other names; only files that the committed headers name are
kept. A digest that a large part of all records share is no hot key: the few groups that hold more than a
``HEAVY_SHARE``-th of the records each are broadcast (fewer than ``HEAVY_SHARE`` rows), the rest is joined by shuffle.

A null html is empty. Payloads below ``MIN_BYTES`` are all responses. Null page_ids come after all others; of records with
equal payload and page_id, the first in the archives is the response. A null url has no ``WARC-Target-URI``. Control
characters in a url are percent-encoded. A record whose payload does not match its digest is an error. An empty table
gives a folder without archives. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaylog.llm.common import Target, file_system, stored

#: Smaller payloads are not worth a revisit record.
MIN_BYTES = 100
#: Size at which a task begins another archive.
FILE_BYTES = 256 << 20
#: Compressed bytes that a rewriting task copies, and what it reads at once.
TASK_BYTES = 64 << 20
READ_BYTES = 8 << 20
#: Groups with more than this part of all records are broadcast.
HEAVY_SHARE = 1000
LEVEL = 1

# Names of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "application/http; msgtype=response"
_PAGE_ID = "X-Page-Id"

#: A record's headers and place.
INDEX = T.StructType(
    [T.StructField(name, T.LongType() if name in ("offset", "size", "page_id", "payload_bytes") else T.StringType())
     for name in ("file", "offset", "size", "record_id", "record_type", "page_id", "uri", "date",
                  "payload_digest", "payload_bytes", "refers_to_id")]
)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _header(name: str, value: object) -> str:
    return "" if value is None else f"{name}: {value}\r\n"


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(_header(*h) for h in headers) + _header("Content-Length", len(block))
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _http(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def _common(kind: str, record_id: str, row: dict) -> list[tuple[str, object]]:
    return [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", row["date"]),
        ("WARC-Target-URI", row["uri"]),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("Content-Type", _HTTP),
        (_PAGE_ID, row["page_id"]),
    ]


def response_record(row: dict, payload: bytes) -> bytes:
    return _record(_common("response", row["record_id"], row), _http(len(payload)) + payload)


def revisit_record(row: dict) -> bytes:
    refers = [
        ("WARC-Profile", _PROFILE),
        ("WARC-Refers-To", f"<{row['refers_to_id']}>" if row["refers_to_id"] else None),
        ("WARC-Refers-To-Target-URI", row.get("refers_to_uri")),
        ("WARC-Refers-To-Date", row.get("refers_to_date")),
    ]
    return _record(_common("revisit", row["record_id"], row) + refers, _http(row["payload_bytes"]))


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """The headers, by lower-cased name, and the block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode(errors="replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    return headers, rest[: int(headers["content-length"])]


def _payload_of(block: bytes) -> tuple[bytes, int | None]:
    """What follows the HTTP headers of a block, and the length that they tell."""
    head, _, payload = block.partition(b"\r\n\r\n")
    found = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    return payload, int(found[1]) if found else None


def _described(data: bytes) -> tuple[dict, bytes] | None:
    """The index columns of a record, without its place, and its payload; none if it is neither response nor revisit."""
    headers, block = parse_record(data)
    kind = headers.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    payload, length = _payload_of(block)
    told = headers.get("warc-payload-digest", "").removeprefix("sha256:").lower() or None
    if kind == "response":
        digest, length = hashlib.sha256(payload).hexdigest(), len(payload)
        if told is not None and ":" not in told and told != digest:
            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    else:
        digest = told
    refers = headers.get("warc-refers-to")
    row = {
        "record_id": headers["warc-record-id"].strip("<>"),
        "record_type": kind,
        "page_id": int(headers[_PAGE_ID.lower()]) if _PAGE_ID.lower() in headers else None,
        "uri": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"),
        "payload_digest": digest,
        "payload_bytes": length,
        "refers_to_id": refers.strip("<>") if refers else None,
    }
    return row, payload


class _Archives:
    """The files that one task writes. ``add`` gives the place of a record."""

    def __init__(self, folder: str, file_bytes: int):
        self.folder, self.file_bytes, self.number, self.target, self.at = folder, file_bytes, 0, None, 0
        context = TaskContext.get()
        self.stem = f"part-{context.partitionId():05d}-{context.taskAttemptId()}"

    def add(self, record: bytes) -> tuple[str, int, int]:
        if self.target is None:
            self.name = f"{self.stem}-{self.number:04d}.warc.gz"
            self.target, self.at = Target(self.folder, self.name), 0
            about = b"format: WARC File Format 1.1\r\n"
            head = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Filename", self.name)]
            self._write(_record([*head, ("Content-Type", "application/warc-fields")], about))
        place = (self.name, self.at, self._write(record))
        if self.at >= self.file_bytes:
            self.close()
        return place

    def _write(self, record: bytes) -> int:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        self.target.out.write(member)
        self.at += len(member)
        return len(member)

    def close(self) -> None:
        if self.target is not None:
            self.target.close()
            self.target, self.number = None, self.number + 1


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _index_schema() -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(INDEX)


def _record_id(*parts: object) -> str:
    return uuid.UUID(bytes=hashlib.sha256(":".join(map(str, parts)).encode()).digest()[:16], version=4).urn


def _keep_named(spark: SparkSession, folder: str, index: DataFrame) -> None:
    """Delete what attempts whose headers were not taken have left. One row a file reaches the driver."""
    store, root = file_system(folder)
    named = {r["file"] for r in index.select("file").distinct().collect()}
    for info in store.get_file_info(fs.FileSelector(root)):
        if info.is_file and info.base_name not in named:
            store.delete_file(info.path)


def write_archives(pages: DataFrame, folder: str, date: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """A response record for every row of ``pages`` (page_id, url, html) in the new ``folder``; returns the stored headers."""
    store, root = file_system(folder)
    store.create_dir(root, recursive=True)
    schema = _index_schema()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, part, count = _Archives(folder, file_bytes), TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode()
                row = {
                    "record_id": _record_id(folder, part, count),
                    "record_type": "response",
                    "page_id": page_id,
                    "uri": None if url is None else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url),
                    "date": date,
                    "payload_digest": hashlib.sha256(payload).hexdigest(),
                    "payload_bytes": len(payload),
                    "refers_to_id": None,
                }
                row["file"], row["offset"], row["size"] = archives.add(response_record(row, payload))
                rows.append(row)
                count += 1
            yield _batch(rows, schema)
        archives.close()

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    index = stored(rows.mapInArrow(write, INDEX), "headers")
    _keep_named(pages.sparkSession, folder, index)
    return index


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``groups``, one row per ``key``, whose ``count`` bounds the rows that have it.

    Groups with more than a ``HEAVY_SHARE``-th of ``total`` rows, fewer than ``HEAVY_SHARE`` of them, are broadcast.
    Both frames are read twice: give stored ones.
    """
    heavy = groups.filter(F.col(count) > total // HEAVY_SHARE).drop(count)
    others = groups.filter(F.col(count) <= total // HEAVY_SHARE).drop(count)
    keys = F.broadcast(heavy.select(key))
    by_broadcast = rows.join(F.broadcast(heavy), key)
    by_shuffle = rows.join(keys, key, "left_anti").join(others, key, "left")
    return by_broadcast.unionByName(by_shuffle)


def decided(index: DataFrame) -> DataFrame:
    """Stored headers with ``new_type`` and the record that revisits refer to: columns refers_to_id, _uri and _date."""
    total = index.count()
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "offset", "record_id", "uri", "date")
    holds = (F.col("record_type") == "response") & (F.col("payload_bytes") >= MIN_BYTES)
    groups = index.filter(F.col("payload_bytes") >= MIN_BYTES).groupBy("payload_digest").agg(
        F.min(F.when(holds, order)).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    groups = stored(groups.filter((F.col("copies") > 1) & F.col("first").isNotNull()), "originals")
    joined = join_groups(index, groups, "payload_digest", "copies", total)
    revisits = F.col("first").isNotNull() & (F.col("first.record_id") != F.col("record_id"))
    return joined.select(
        *[c for c in INDEX.names if c not in ("refers_to_id",)],
        F.when(revisits, "revisit").otherwise(F.col("record_type")).alias("new_type"),
        F.when(revisits, F.col("first.record_id")).otherwise(F.col("refers_to_id")).alias("refers_to_id"),
        F.when(revisits, F.col("first.uri")).alias("refers_to_uri"),
        F.when(revisits, F.col("first.date")).alias("refers_to_date"),
    )


def _spans(rows: list[dict]) -> Iterator[tuple[str, int, int, list[dict]]]:
    """Neighbouring records of a file that are read at once: (file, first byte, bytes, records)."""
    at, span = 0, []
    for row in rows:
        near = span and row["file"] == span[0]["file"] and row["offset"] + row["size"] - span[0]["offset"] <= READ_BYTES
        if span and not near:
            yield span[0]["file"], span[0]["offset"], at - span[0]["offset"], span
            span = []
        span.append(row)
        at = row["offset"] + row["size"]
    if span:
        yield span[0]["file"], span[0]["offset"], at - span[0]["offset"], span


def deduplicate(index: DataFrame, source: str, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records of ``index``, which are in the folder ``source``, to the new ``folder``; returns the new headers."""
    spark = index.sparkSession
    target, root = file_system(folder)
    target.create_dir(root, recursive=True)
    schema = _index_schema()
    decisions = stored(decided(index), "decisions")
    size = decisions.agg(F.sum("size")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, (store, place) = _Archives(folder, file_bytes), file_system(source)
        name = stream = None
        for batch in batches:
            rows = []
            for file, first, length, span in _spans(batch.to_pylist()):
                if file != name:
                    if stream is not None:
                        stream.close()
                    name, stream = file, store.open_input_file(f"{place}/{file}")
                stream.seek(first)
                data = stream.read(length)
                for row in span:
                    start = row["offset"] - first
                    if row["new_type"] == "revisit":
                        record = revisit_record(row)
                    else:
                        found = _described(zlib.decompress(data[start : start + row["size"]], 31))
                        if found is None or found[0]["record_id"] != row["record_id"]:
                            raise ValueError(f"{file} has another record at {row['offset']} than {row['record_id']}")
                        record = response_record(row, found[1])
                    row["record_type"] = row.pop("new_type")
                    row["file"], row["offset"], row["size"] = archives.add(record)
                    rows.append({n: row[n] for n in schema.names})
            yield _batch(rows, schema)
        archives.close()
        if stream is not None:
            stream.close()

    dealt = decisions.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    new = stored(dealt.mapInArrow(write, INDEX), "headers")
    _keep_named(spark, folder, new)
    return new


def _members(stream) -> Iterator[tuple[int, int, bytes]]:
    """(first byte, bytes, content) of each gzip member of a file."""
    at = size = 0
    unpack, out = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 16):
        while chunk:
            out.append(unpack.decompress(chunk))
            size += len(chunk) - len(unpack.unused_data)
            chunk = unpack.unused_data
            if unpack.eof:
                yield at, size, b"".join(out)
                at, size, unpack, out = at + size, 0, zlib.decompressobj(31), []
    if size:
        raise ValueError("the archive ends within a record")


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Headers and place, and if asked for the ``payload``, of every response and revisit record of a folder's archives.

    A file is read by one task. Payloads are held against their digests.
    """
    store, root = file_system(folder)
    files = sorted((i.base_name, i.size) for i in store.get_file_info(fs.FileSelector(root)) if i.is_file and i.base_name.endswith(".warc.gz"))
    out = T.StructType([*INDEX.fields, T.StructField("payload", T.BinaryType())]) if payloads else INDEX
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for offset, size, data in _members(stream):
                        if (found := _described(data)) is None:
                            continue
                        row, payload = found
                        row.update(file=name, offset=offset, size=size)
                        if payloads:
                            row["payload"] = payload if row["record_type"] == "response" else None
                            held += len(payload)
                        rows.append(row)
                        if len(rows) == 1024 or held > READ_BYTES:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)

    if not files:
        return spark.createDataFrame([], out)
    tasks = max(1, min(len(files), spark.sparkContext.defaultParallelism * 16))
    return spark.createDataFrame(files, "file string, size long").repartition(tasks, "file").select("file").mapInArrow(read, out)


def resolved(records: DataFrame) -> DataFrame:
    """Stored records with the page_id of the response that each revisit refers to, as ``refers_to``; else null.

    A revisit's length is that of the response.
    """
    total = records.count()
    bodies = records.filter(F.col("record_type") == "response")
    asked = records.filter((F.col("record_type") == "revisit") & F.col("refers_to_id").isNotNull())
    counts = asked.groupBy("refers_to_id").agg(F.count(F.lit(1)).alias("copies"))
    originals = bodies.select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes")
    )
    groups = stored(originals.join(counts, "refers_to_id").dropDuplicates(["refers_to_id"]), "originals")
    linked = join_groups(asked, groups, "refers_to_id", "copies", total)
    others = records.filter((F.col("record_type") != "revisit") | F.col("refers_to_id").isNull())
    whole = linked.unionByName(others, allowMissingColumns=True)
    return whole.withColumn("payload_bytes", F.coalesce("full_bytes", "payload_bytes")).drop("full_bytes")


def forget_archives(folder: str) -> None:
    store, root = file_system(folder)
    store.delete_dir(root)
