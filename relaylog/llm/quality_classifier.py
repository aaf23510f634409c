"""Quality of texts from random-indexing word vectors and a small neural network.

Random indexing: every word has a sparse random index vector, four signs in 64 places, drawn by hash from the word, its
shape (case, digits, marks) and its ends. A word's vector is the sum of the index vectors of the words beside
it, over all texts given. Words share a fixed number of rows by hash, so the table has the same
size however large the corpus is; Spark adds up the tables of all tasks. A document is pooled into the mean and the spread
of its words' vectors and index vectors, how alike neighbours are, and how often words come again.

A two-layer network in numpy is fitted to a bounded sample of labelled rows (``sample`` of each class, those with the
least hash), with classes weighted alike. A part of the sample is set aside to find the temperature that makes the
probabilities calibrated; then the share of each class among all training rows is taken in as the prior. Every
text is scored on all its words.

Training rows are those whose crc32 of the doc_id's text leaves another remainder than ``held_out``; rows without a
doc_id or label are no training rows. A null or empty text is pooled to zeros. Without labels of both classes every
score is 1. Rows that repeat get the same score each. Other columns are ignored, and kept by ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaylog.llm.common import _SPACE, map_batches, mix, text_column, word_hashes
from relaylog.llm.toxicity import Training, labelled_sample, training_rows

ROWS = 1 << 12
PLACES = 64
_SIGNS = 4
_SHAPES = 1 << 9

_U = np.uint64


@dataclass(frozen=True)
class _Words:
    """Of each word of a text: its row in the table, and its shape."""

    row: np.ndarray
    shape: np.ndarray
    hash: np.ndarray


def _class_table() -> np.ndarray:
    """Bits of a byte: small letter, capital, digit, end mark, other sign, not ASCII."""
    table = np.zeros(256, np.uint8)
    for bit, signs in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?!'\"-()")):
        table[list(signs)] |= 1 << bit
    table[33:127][table[33:127] == 0] = 1 << 4
    table[128:] = 1 << 5
    return table


_CLASS = _class_table()


def words_of(text: str) -> _Words:
    data = text.encode()
    b = np.frombuffer(data, np.uint8)
    hashes = word_hashes(data)
    if not len(hashes):
        empty = np.zeros(0, np.int64)
        return _Words(empty, empty, hashes)
    inside = ~_SPACE[b]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edges[0::2], edges[1::2]
    kinds = np.bitwise_or.reduceat(np.append(_CLASS[b], 0), np.ravel(np.column_stack([starts, ends])))[::2]
    length = np.minimum(np.frompyfunc(int.bit_length, 1, 1)((ends - starts).tolist()).astype(np.int64), 7)
    shape = kinds.astype(np.int64) | length << 6
    return _Words((mix(hashes) % _U(ROWS)).astype(np.int64), shape, hashes)


def _index_vectors(count: int, seed: int) -> np.ndarray:
    """Sparse signs by number: the same on every machine."""
    numbers = np.arange(count, dtype=np.uint64)
    out = np.zeros((count, PLACES), np.float32)
    for k in range(_SIGNS):
        draw = mix(numbers * _U(0x9E3779B97F4A7C15) + _U((seed * _SIGNS + k + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1))
        out[np.arange(count), (draw % _U(PLACES)).astype(np.int64)] += np.where(draw >> _U(63), 1, -1)
    return out


_BY_WORD, _BY_SHAPE = _index_vectors(ROWS, 1), _index_vectors(_SHAPES, 2)


def _accumulate(table: np.ndarray, words: _Words) -> None:
    """Add to each word's row the index vectors of the words before and after it."""
    if len(words.row) < 2:
        return
    index = _BY_WORD[words.row] + _BY_SHAPE[words.shape]
    beside = np.zeros_like(index)
    beside[1:] += index[:-1]
    beside[:-1] += index[1:]
    order = np.argsort(words.row, kind="stable")
    ordered = words.row[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    table[ordered[first]] += np.add.reduceat(beside[order], first, axis=0)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of word vectors over all texts: a fixed number of rows, each scaled to length 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((ROWS, PLACES), np.float64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for at in _blocks(text):
                    _accumulate(table, words_of(at))
        used = np.flatnonzero(np.abs(table).sum(1))
        values = pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * PLACES, pa.array(table[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), values], names=["row", "vector"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = np.zeros((ROWS, PLACES)), np.zeros(ROWS, bool)
        for batch in batches:
            rows = batch.column(0).to_numpy()
            np.add.at(table, rows, batch.column(1).flatten().to_numpy().reshape(-1, PLACES))
            seen[rows] = True
        used = np.flatnonzero(seen)
        values = pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * PLACES, pa.array(table[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), values], names=["row", "vector"])

    schema = "row long, vector array<double>"
    tables = docs.select(text_column().alias("text")).mapInArrow(count, schema)
    # Rows meet by number; every task then holds the sums of its own rows.
    summed = tables.repartition("row").mapInArrow(add, schema).collect()
    out = np.zeros((ROWS, PLACES), np.float64)
    for row, vector in summed:
        out[row] += vector
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _blocks(text: str, size: int = 1 << 20) -> Iterator[str]:
    """A long text in parts that end after a line or a space, if there is one: bounds memory."""
    at = 0
    while len(text) - at > size:
        end = max(text.rfind("\n", at, at + size), text.rfind(" ", at, at + size)) + 1
        end = end if end > at else at + size
        yield text[at:end]
        at = end
    yield text[at:]


def pooled(text: str, table: np.ndarray) -> np.ndarray:
    """A document as numbers: word vectors, shapes and repetition, pooled over all its words."""
    sums = np.zeros(4 * PLACES)
    by_shape = np.zeros(_SHAPES)
    alike = same = total = 0.0
    distinct: set[int] = set()
    for block in _blocks(text):
        words = words_of(block)
        n = len(words.row)
        if not n:
            continue
        rows, counts = np.unique(words.row, return_counts=True)
        vectors, shapes = table[rows], np.bincount(words.shape, minlength=_SHAPES)
        index = _BY_SHAPE * shapes[:, None]
        sums += np.concatenate([counts @ vectors, counts @ vectors**2, index.sum(0), shapes @ (_BY_SHAPE**2)])
        by_shape += shapes
        alike += float(np.einsum("ij,ij->", table[words.row[1:]], table[words.row[:-1]]))
        same += float(np.count_nonzero(words.hash[1:] == words.hash[:-1]))
        distinct.update(np.unique(words.hash).tolist())
        total += n
    if not total:
        return np.zeros(4 * PLACES + 13)
    kinds = np.array([by_shape[(np.arange(_SHAPES) >> bit & 1) > 0].sum() for bit in range(6)]) / total
    lengths = np.arange(_SHAPES) >> 6
    mean_length = (by_shape * lengths).sum() / total
    only_marks = by_shape[(np.arange(_SHAPES) & 7) == 0].sum() / total
    rest = [alike / total, same / total, len(distinct) / total, np.log1p(total) / 10, mean_length, only_marks, 1.0]
    return np.concatenate([sums / total, kinds, rest])


# -- the network ----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Network:
    """Two layers on scaled inputs, fitted to classes of equal weight; the temperature and the prior of their output."""

    table: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float
    prior: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(np.clip((x - self.centre) / self.scale, -6, 6) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature + self.prior, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, table: np.ndarray, hidden: int = 24, rounds: int = 60, seed: int = 7) -> Network:
    """Mini-batch gradient steps with momentum, then the temperature with the least loss on rows set aside."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    aside, rows = order[: len(x) // 5], order[len(x) // 5 :]
    centre, scale = x[rows].mean(0), x[rows].std(0) + 1e-3
    z = np.clip((x - centre) / scale, -6, 6)
    parameters = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.2, hidden), np.zeros(1)]
    means = [np.zeros_like(p) for p in parameters]
    squares = [np.zeros_like(p) for p in parameters]
    positive = max(1, y[rows].sum())
    weight = np.where(y == 1, len(rows) / (2 * positive), len(rows) / (2 * max(1, len(rows) - positive)))
    step = 0
    for _ in range(rounds):
        for batch in np.array_split(rng.permutation(rows), max(1, len(rows) // 128)):
            step += 1
            w1, b1, w2, b2 = parameters
            h = np.tanh(z[batch] @ w1 + b1)
            p = 1 / (1 + np.exp(-np.clip(h @ w2 + b2, -30, 30)))
            error = weight[batch] * (p - y[batch]) / len(batch)
            back = np.outer(error, w2) * (1 - h**2)
            gradients = [z[batch].T @ back + 1e-4 * w1, back.sum(0), h.T @ error + 1e-4 * w2, np.array([error.sum()])]
            for k, g in enumerate(gradients):
                means[k] = 0.9 * means[k] + 0.1 * g
                squares[k] = 0.999 * squares[k] + 0.001 * g**2
                parameters[k] = parameters[k] - 0.003 * (means[k] / (1 - 0.9**step)) / (np.sqrt(squares[k] / (1 - 0.999**step)) + 1e-8)
    w1, b1, w2, b2 = parameters
    plain = Network(table, centre, scale, w1, b1, w2, float(b2[0]), 1.0)
    out, truth = plain.logits(x[aside]), y[aside]

    def loss(t: float) -> float:
        return float(np.sum(weight[aside] * np.logaddexp(0, -np.where(truth == 1, 1, -1) * out / t)))

    best = min(np.exp(np.linspace(-1.5, 2.5, 81)), key=loss)
    return Network(table, centre, scale, w1, b1, w2, float(b2[0]), float(best))


#: What the contract sets for the fold, and the documented bound of the sample.
QUALITY = Training(fold=4, held_out=2, sample=6000)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", training: Training = QUALITY) -> Network | None:
    """A network from the texts of ``docs`` and the labels of training rows; None if a class has none."""
    table = word_vectors(docs)

    def rows(batch: pa.RecordBatch) -> dict:
        x = [pooled(t, table) for t in batch.column(2).to_pylist()]
        return {"doc_id": batch.column(0), "label": batch.column(1), "x": x}

    sample = labelled_sample(docs, labels, label, training).withColumn("label", F.col("label").cast("int"))
    found = map_batches(sample, rows, "doc_id long, label int, x array<double>").collect()
    found.sort(key=lambda r: (r[0], r[1], r[2]))
    y = np.array([r[1] for r in found], float)
    if not len(y) or y.min() == y.max():
        return None
    counts = training_rows(labels, label, training).join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    of = {r[0]: r[1] for r in counts.groupBy("label").count().collect()}
    return replace(fit(np.array([r[2] for r in found]), y, table), prior=float(np.log(of[1] / of[0])))


def score(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, text_key and score of every text."""
    text = text_column()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    if network is None:
        return source.select("doc_id", "text_key", F.lit(1.0).alias("score"))

    def rows(batch: pa.RecordBatch) -> dict:
        x = np.array([pooled(t, network.table) for t in batch.column(2).to_pylist()])
        scores = network.probability(x) if len(x) else np.zeros(0)
        return {"doc_id": batch.column(0), "text_key": batch.column(1), "score": scores}

    return map_batches(source, rows, "doc_id long, text_key long, score double")


def accepted(docs: DataFrame, network: Network | None, least: float) -> DataFrame:
    """The documents with a score of at least ``least``, in their own columns."""
    if network is None:
        return docs
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            if texts:
                x = np.array([pooled(t, network.table) for t in texts])
                yield batch.filter(pa.array(network.probability(x) >= least))

    return docs.mapInArrow(keep, docs.schema)
