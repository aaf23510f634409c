"""Best-fit decreasing packing of documents into sequences of a fixed number of tokens.

Items go in falling length into the open sequence that they leave least room in. Which item of a length goes where
makes no difference, so the whole corpus is packed from its histogram of lengths: never more rows than the capacity,
however many documents there are. A segment tree over remaining capacities finds the tightest open sequences for a
length in logarithmic time; sequences that are filled alike are kept as a run. The result is a plan: the items of
a length with ranks r0 to r1 go to these sequences at that place. Its size depends on the capacity alone. Every item
gets its rank among the items of its length: its place within its task, plus a prefix sum over the tasks before it.

Documents longer than the capacity are cut into pieces of full capacity, after a first one with what is over. Null texts
are empty, so a document has at least the end id. Repeated rows are packed each. An empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relaylog.llm.common import stored, text_column
from relaylog.llm.pieces import HALF_PIECES, encoder, id_type

_PIECES = "part int, rank long, doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, ids: bool = False, kept: int = HALF_PIECES) -> DataFrame:
    """Pieces of at most ``capacity`` ids, as a stored table. ``rank`` counts the pieces of a length within a ``part``.

    ``kept``: what a worker keeps of the ids it has found (see ``pieces``).
    """
    dtype = id_type(tokenizer)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = _PIECES + (", ids array<int>" if ids else "")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def cut(batches):
        encode, part = encoder(tokenizer, dtype, kept), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out = {name: [] for name in arrow.names}
            for doc_id, own in zip(batch.column(0).to_pylist(), encode.texts(batch.column(1).to_pylist()), strict=True):
                own = np.append(own.astype("<u4"), np.uint32(end_id))
                for piece, end in enumerate(range((len(own) - 1) % capacity + 1, len(own) + 1, capacity)):
                    start = max(0, end - capacity)
                    tokens = own[start:end]
                    row = (part, int(seen[len(tokens)]), doc_id, piece, start, len(tokens), zlib.crc32(tokens.tobytes()), tokens)
                    seen[len(tokens)] += 1
                    for name, value in zip(arrow.names, row, strict=False):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return stored(rows.mapInArrow(cut, schema), "pieces")


class _OpenSequences:
    """Runs of open sequences by remaining capacity; a segment tree tells the smallest capacity that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _set(self, room: int) -> None:
        node = self.leaves + room
        self.any[node] = bool(self.runs[room])
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def put(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.runs[room].append((first, count))
            self._set(room)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._set(room)
        return run

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least ``need`` that an open sequence has."""
        node = self.leaves + need
        if self.any[node]:
            return need
        while node > 1:  # up, until there is a subtree to the right that has one
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Steps (length, first rank, rank after the last, first sequence, items in each sequence, place of the first)."""
    steps, free, sequences = [], _OpenSequences(capacity), 0
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit a sequence of {capacity}")
        rank, left = 0, histogram[length]
        while left:
            room = free.tightest(length)
            if room is None:  # new sequences, each filled as far as this length goes
                room, each = capacity, capacity // length
                first, count = sequences, -(-left // each)
                sequences += count
            else:
                each = room // length
                first, count = free.take(room)
            items = min(left, count * each)
            full, rest = divmod(items, each)
            steps.append((length, rank, rank + items, first, each, capacity - room))
            free.put(room - each * length, first, full)
            if rest:
                free.put(room - rest * length, first + full, 1)
            used = full + bool(rest)
            free.put(room, first + used, count - used)
            rank, left = rank + items, left - items
    return steps


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (part, rank, length, ...) with sequence_id and offset, without part and rank.

    ``pieces`` must give the same rows each time it is read, as a stored table does.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    steps = best_fit_decreasing(histogram, capacity)
    plan = spark.createDataFrame(steps, "length long, __r0 long, __r1 long, __first long, __each long, __place long")
    ranked = pieces.join(bases, ["part", "length"]).withColumn("__r", F.col("rank") + F.col("__base"))
    within = (F.col("__r") >= F.col("__r0")) & (F.col("__r") < F.col("__r1"))
    # The plan is bounded by the capacity, not by the corpus.
    placed = ranked.alias("p").join(F.broadcast(plan).alias("s"), (F.col("p.length") == F.col("s.length")) & within)
    at = F.col("__r") - F.col("__r0")
    kept = [F.col(f"p.{c}").alias(c) for c in pieces.columns if c not in ("part", "rank")]
    return placed.select(
        *kept,
        (F.col("__first") + F.expr("(__r - __r0) div __each")).alias("sequence_id"),
        (F.col("__place") + at % F.col("__each") * F.col("p.length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence, from packed pieces that carry ``ids``. A group holds one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.transform(parts, lambda p: p["ids"]))
    return packed.groupBy("sequence_id").agg(ids.alias("ids"))
