"""Token ids as flat binary files with 64-bit document offsets, to be memory-mapped by a training job.

A dataset is a folder of parts in ascending order of doc_id:

- ``part-00007.ids``: the ids of its documents one after another, little-endian unsigned 16-bit integers if the
  vocabulary fits, else 32-bit;
- ``part-00007.idx``: doc ids (signed 64-bit, the smallest number for a null), then one more unsigned 64-bit offset
  than there are documents. Offsets count ids from the start of the whole dataset;
- ``dataset.json``: the integer type and, for each part, its number, documents and ids.

Documents are dealt out by ranges of doc_id. Each task streams the ids of its range to its own part and notes how
many each document has. Prefix sums over the parts' totals (one row a part) give every part its base, and a second
small job writes the offsets. A task writes under a name of its own and renames at the end, so a task that runs
twice leaves the same file.

Null texts are empty; an empty text has only the end id. Rows with the same doc_id follow each other ordered by text.
Null doc ids come first. An empty table gives a dataset without parts. Other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylog.llm.common import Target, file_system, text_column
from relaylog.llm.pieces import MANY_PIECES, encoder, id_type

_NULL = np.iinfo(np.int64).min
_SUMMARY = "part int, documents long, ids long"


def _name(part: int, kind: str) -> str:
    return f"part-{part:05d}.{kind}"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Encode ``docs`` (doc_id, text) into the empty ``folder``."""
    dtype = id_type(tokenizer)
    target, root = file_system(folder)
    target.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer, dtype, MANY_PIECES), TaskContext.get().partitionId()
        end = np.array([end_id], dtype).tobytes()
        ids = lengths = None
        documents = total = 0
        for batch in batches:
            if ids is None:
                ids, lengths = Target(folder, _name(part, "ids")), Target(folder, _name(part, "len"))
            counts = []
            for own in encode.texts(batch.column(1).to_pylist()):
                ids.out.write(own.tobytes() + end)
                counts.append(len(own) + 1)
            doc_ids = batch.column(0).fill_null(_NULL).to_numpy()
            lengths.out.write(np.stack([doc_ids, np.array(counts, np.int64)], axis=1).astype("<i8").tobytes())
            documents, total = documents + len(counts), total + sum(counts)
        if documents:
            ids.close()
            lengths.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([documents]), pa.array([total])], names=["part", "documents", "ids"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    parts = sorted(tuple(r) for r in ordered.mapInArrow(write, _SUMMARY).collect())  # one row a file
    starts = np.concatenate([[0], np.cumsum([ids for _, _, ids in parts], dtype=np.uint64)])
    bases = [(part, int(base)) for (part, _, _), base in zip(parts, starts, strict=False)]
    _write_offsets(docs.sparkSession, folder, bases)
    description = {"dtype": dtype, "parts": [{"part": p, "documents": d, "ids": n} for p, d, n in parts]}
    with target.open_output_stream(f"{root}/dataset.json") as out:
        out.write(json.dumps(description).encode())


def _per_part(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A row for each part, dealt out over the cluster."""
    tasks = max(1, min(len(rows), spark.sparkContext.defaultParallelism * 4))
    return spark.createDataFrame(rows, schema).repartition(tasks)


def _write_offsets(spark: SparkSession, folder: str, bases: list[tuple[int, int]]) -> None:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, root = file_system(folder)
        for batch in batches:
            for part, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with source.open_input_stream(f"{root}/{_name(part, 'len')}") as f:
                    doc_ids, counts = np.frombuffer(f.read(), "<i8").reshape(-1, 2).T
                offsets = np.concatenate([[base], base + np.cumsum(counts)]).astype("<u8")
                index = Target(folder, _name(part, "idx"))
                index.out.write(doc_ids.tobytes() + offsets.tobytes())
                index.close()
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32())], names=["part"])

    if bases:
        _per_part(spark, bases, "part int, base long").mapInArrow(write, "part int").write.format("noop").mode("overwrite").save()


def _mapped(source, path: str):
    """The file's bytes: memory-mapped where it is local, else read."""
    from pyarrow import fs

    if isinstance(source, fs.LocalFileSystem):
        return pa.memory_map(path).read_buffer()
    with source.open_input_file(path) as f:
        return f.read_buffer()


def read_token_files(spark: SparkSession, folder: str, ids: bool = False) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32 (of its ids as unsigned 32-bit integers) and, if asked for, ids."""
    source, root = file_system(folder)
    with source.open_input_stream(f"{root}/dataset.json") as f:
        description = json.loads(f.read())
    dtype = description["dtype"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, root = file_system(folder)
        for batch in batches:
            for part, documents in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                index = np.frombuffer(_mapped(source, f"{root}/{_name(part, 'idx')}"), "<i8")
                offsets = index[documents:]
                tokens = np.frombuffer(_mapped(source, f"{root}/{_name(part, 'ids')}"), dtype)
                for at in range(0, documents, 1024):
                    doc_ids, bounds = index[at : min(at + 1024, documents)], offsets[at : at + 1025]
                    own = [tokens[a:b].astype("<u4") for a, b in zip(bounds - offsets[0], bounds[1:] - offsets[0], strict=False)]
                    columns = [
                        pa.array(doc_ids, mask=doc_ids == _NULL),
                        pa.array(bounds[: len(own)]),
                        pa.array([len(x) for x in own], pa.int64()),
                        pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                    ]
                    if ids:
                        columns.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    parts = [(p["part"], p["documents"]) for p in description["parts"]]
    return _per_part(spark, parts, "part int, documents long").mapInArrow(read, schema)
