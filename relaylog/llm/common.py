"""What several of these operators share: input columns, shared folders, row numbers, files, word hashes."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylog.session import configure, shared_dir

#: Rows, and bytes, per Arrow batch: bounds what a Python worker holds when texts are long.
BATCH_ROWS = 256
BATCH_BYTES = 4 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and small Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def text_column(name: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and it survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a frame that ``stored`` returned, once nothing reads it any more."""
    context = df.sparkSession.sparkContext
    for file in df.inputFiles()[:1]:
        folder = context._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def map_batches(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``df`` through ``rows``, which turns an Arrow batch into columns of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = rows(batch)
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def row_numbers(first: int, count: int) -> np.ndarray:
    """Numbers for the rows of one task, unlike those of any other task. Stable once written to a table."""
    return (np.int64(TaskContext.get().partitionId()) << np.int64(40)) + np.arange(first, first + count, dtype=np.int64)


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the path in it; plain paths are local."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


class Target:
    """A file that gets its name only once it is whole."""

    def __init__(self, folder: str, name: str):
        self.fs, root = file_system(folder)
        self.path = f"{root}/{name}"
        self.draft = f"{self.path}.{TaskContext.get().taskAttemptId()}"
        self.out = self.fs.open_output_stream(self.draft)

    def close(self) -> None:
        self.out.close()
        # An earlier attempt of the task may have left the file; not every store lets a move replace it.
        if self.fs.get_file_info(self.path).type != fs.FileType.NotFound:
            self.fs.delete_file(self.path)
        self.fs.move(self.draft, self.path)


# -- words: the longest runs of bytes other than ASCII white space --------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BLOCK = 1 << 22


@functools.cache
def _powers(size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(size, 0x9E3779B97F4A7C15, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finaliser, so that every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes_of_block(b: np.ndarray) -> np.ndarray:
    inside = ~_SPACE[b]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    lengths = edges[1::2] - edges[0::2]
    if not len(lengths):
        return np.zeros(0, np.uint64)
    firsts = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    longest = 1 << int(lengths.max()).bit_length()
    terms = (b[inside].astype(np.uint64) + np.uint64(1)) * _powers(longest)[at]
    return mix(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order. Long texts go through in blocks that end at white space."""
    b = np.frombuffer(data, np.uint8)
    if len(b) <= _BLOCK:
        return _hashes_of_block(b)
    parts, start = [], 0
    while start < len(b):
        end = min(len(b), start + _BLOCK)
        while end < len(b):  # to the end of the word
            spaces = np.flatnonzero(_SPACE[b[end : end + _BLOCK]])
            end = end + int(spaces[0]) if len(spaces) else min(len(b), end + _BLOCK)
            if len(spaces):
                break
        parts.append(_hashes_of_block(b[start:end]))
        start = end
    return np.concatenate(parts)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of ``size`` words; none if there are fewer words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = total * np.uint64(0xD1342543DE82EF95) + words[k : k + count]
    return mix(total)
