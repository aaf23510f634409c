"""Toxicity of texts, scored after a noisy channel has been undone.

Writers hide words by leetspeak, by spaces or marks between letters, and by repeating letters. A suspicious run is
turned into a lattice: each sign may stand for itself, for a letter that it looks like, or for nothing; a
repeated letter may be a single one; a separator may end a word or be nothing. The Viterbi path under a character trigram model
is what was meant. The model is counted over the plain words of all texts given, in a fixed table of symbol triples. A run
whose best reading is what is written, or nothing, stays as it is. Suspicious are words with signs or separators inside, with a
letter twice in a row, and three or more single letters or signs with separators between.

The scorer is a logistic regression on parts of words of the restored text: whole words and their runs of four and five
letters. It is fitted on a bounded sample of labelled rows (``sample`` of each class, those with the least hash), with
features that occur clearly more often with label 1; how often is counted by Spark, and only the chosen features and
the sample's rows of feature numbers reach the driver. Every text is scored on all its words.

Training rows are those whose crc32 of the doc_id's text leaves ``fold`` no remainder of 0; rows without a doc_id or
label are no training rows. A null or empty text has no features and gets the score of the intercept. Without labels of
both classes every score is 0. Rows that repeat get the same score each. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaylog.llm.common import map_batches, stored, text_column

#: The letters of the model, and what a sign may stand for. Number 0 is the end of a word.
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâäçèéêëìíîïñòóôöùúûüœß"
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
#: What may stand between the letters of a word.
SEPARATORS = " ._-/"
_SYMBOLS = len(LETTERS) + 1
_NUMBER = {c: i + 1 for i, c in enumerate(LETTERS)}
_CODES = np.zeros(0x250, np.uint8)
for _c, _i in _NUMBER.items():
    _CODES[ord(_c)] = _i
    if len(_c.upper()) == 1 and ord(_c.upper()) < 0x250:
        _CODES[ord(_c.upper())] = _i

# -- the character model --------------------------------------------------------------------------------------------


def _triples(text: str) -> np.ndarray:
    """Numbers of the triples of symbols of a text; what is no letter ends a word, and runs of ends are one."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    codes = np.where(points < len(_CODES), _CODES[np.minimum(points, len(_CODES) - 1)], 0).astype(np.int64)
    codes = np.concatenate([[0, 0], codes, [0]])
    keep = np.ones(len(codes), bool)
    keep[2:] = (codes[2:] > 0) | (codes[1:-1] > 0)
    codes = codes[keep]
    return (codes[:-2] * _SYMBOLS + codes[1:-1]) * _SYMBOLS + codes[2:]


def character_counts(docs: DataFrame) -> np.ndarray:
    """How often each triple of symbols occurs in all texts. A table of fixed size, added up by Spark."""

    def count(batches):
        table = np.zeros(_SYMBOLS**3, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(table, _triples(text), 1)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], names=["triple", "n"])

    rows = docs.select(text_column().alias("text")).mapInArrow(count, "triple long, n long").groupBy("triple").agg(F.sum("n")).collect()
    table = np.zeros(_SYMBOLS**3, np.int64)
    table[[r[0] for r in rows]] = [r[1] for r in rows]
    return table


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Of the third symbol after two: triples, pairs and single symbols, interpolated."""
    c3 = counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS).astype(float)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1.sum() + _SYMBOLS)
    p2 = (c2 + 5 * p1) / (c2.sum(1, keepdims=True) + 5)
    return np.log((c3 + 5 * p2) / (c3.sum(2, keepdims=True) + 5))


# -- the channel ----------------------------------------------------------------------------------------------------

# What is left out saves a symbol's own cost, about 2.5, so leaving out must cost more than that where it is rare: a sign, or the
# second of just two equal letters. Of three and more, all but one are noise.
_REPLACED, _DROPPED, _DOUBLE, _SINGLE = -1.0, -8.0, -5.0, -0.5
# A slash is more often meant.
_JOINED = {" ": -0.3, ".": -0.3, "_": -0.3, "-": -0.3, "/": -3.0}


class Restorer:
    """Restores words by the best path through their lattices."""

    def __init__(self, log_p: np.ndarray):
        self.log_p = log_p.tolist()
        self.known: dict[str, str] = {}
        # By the letter before, the doubled one and the letter after.
        self.stays: dict[tuple[str, str, str], bool] = {}

    def word(self, token: str) -> str:
        """The most likely word, or words, behind a token in lower case."""
        if (found := self.known.get(token)) is None:
            if len(self.known) > 100_000:
                self.known.clear()
            found = self.known[token] = self._decode(token)
        return found

    def doubles(self, text: str) -> str:
        """``text`` with the doubled letters of its plain words restored, as ``word`` restores them.

        Whether a second letter goes depends on the letters beside the two alone, as a reading is scored by triples.
        """

        def one(m: re.Match) -> str:
            before, after = text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]
            place = (before if before in _NUMBER else "", m[1], after if after in _NUMBER else "")
            if (stays := self.stays.get(place)) is None:
                y, c, z = (_NUMBER.get(x, 0) for x in place)
                p = self.log_p
                stays = self.stays[place] = p[y][c][c] + p[c][c][z] >= p[y][c][z] + _DOUBLE
            return m[0] if stays else m[1]

        return _TWICE.sub(one, text)

    def _decode(self, token: str) -> str:
        # A state is the last two symbols; it has its score, and what was written on the way to it, last sign first.
        states = {(0, 0): (0.0, None)}
        for i, sign in enumerate(token):
            ways = []  # (symbol or None for nothing, cost)
            if sign in SEPARATORS:
                ways += [(0, 0.0), (None, _JOINED[sign])]
            elif sign in _NUMBER:
                ways.append((_NUMBER[sign], 0.0))
                if sign == token[i - 1 : i]:
                    longer = sign in (token[i + 1 : i + 2], token[i - 2 : i - 1] if i > 1 else "")
                    ways.append((None, _SINGLE if longer else _DOUBLE))
            else:
                ways += [(_NUMBER[x], _REPLACED) for x in LOOKS_LIKE.get(sign, "")]
                ways.append((None, _DROPPED))
            after: dict[tuple[int, int], tuple] = {}
            for state, (score, path) in states.items():
                row = self.log_p[state[0]][state[1]]
                for symbol, cost in ways:
                    if symbol is None:
                        to, value, way = state, score + cost, path
                    elif symbol:
                        to, value, way = (state[1], symbol), score + cost + row[symbol], (LETTERS[symbol - 1], path)
                    elif state[1]:
                        to, value, way = (state[1], 0), score + cost + row[0], (sign, path)
                    else:  # as in the counts, ends in a row are one
                        to, value, way = state, score + cost, (sign, path)
                    if to not in after or value > after[to][0]:
                        after[to] = (value, way)
            states = after
        ends = ((score + (self.log_p[a][b][0] if b else 0.0), path) for (a, b), (score, path) in states.items())
        _, path = max(ends, key=lambda x: x[0])
        letters = []
        while path:
            letters.append(path[0])
            path = path[1]
        return "".join(reversed(letters)) or token


_SIGNS = re.escape("".join(LOOKS_LIKE))
_LETTER = f"[{LETTERS}]"
_SEPARATOR = r"[._\-/]"
_ANY = f"[{LETTERS}{_SIGNS}]"
# Single letters or signs with separators between; a word with signs or separators in it.
_RUNS = (
    rf"(?<![\w{_SIGNS}])(?P<spaced>{_ANY}(?:[\x20._\-*/]{{1,2}}{_ANY}){{2,}})(?![\w{_SIGNS}])"
    rf"|(?<!\S)[^\w\s{_SIGNS}]*+(?P<leet>{_LETTER}*+(?:[{_SIGNS}]|{_SEPARATOR}(?={_ANY}))(?:{_ANY}|{_SEPARATOR}(?={_ANY}))*+)"
)
_SUSPICIOUS = re.compile(_RUNS)
# And a word with a letter three times in a row, for the texts that have one.
_THRICE = re.compile(rf"({_LETTER})\1\1")
_SUSPICIOUS_LONG = re.compile(rf"{_RUNS}|(?<!{_LETTER})(?P<long>{_LETTER}*?({_LETTER})\4\4{_LETTER}*)")
_TRAILING = "!*$+|("
_TWICE = re.compile(rf"({_LETTER})\1")
_LETTERS_IN = re.compile(_LETTER)


def restored(text: str, restorer: Restorer) -> str:
    """The text in lower case with its suspicious runs restored."""

    def replace(m: re.Match) -> str:
        token = m["leet"] or m["spaced"] or m[0]
        lead = m[0][: len(m[0]) - len(token)]
        if m["spaced"]:
            # Numbers in a row are no word.
            return m[0] if len(_LETTERS_IN.findall(token)) < 2 else lead + restorer.word(token)
        core = token.rstrip(_TRAILING)
        if not _LETTERS_IN.search(core) or core.isalpha() and not _TWICE.search(core):
            return m[0]
        return lead + restorer.word(core) + token[len(core) :]

    text = text.lower()
    parts, at = [], 0
    for m in (_SUSPICIOUS_LONG if _THRICE.search(text) else _SUSPICIOUS).finditer(text):
        parts += [restorer.doubles(text[at : m.start()]), replace(m)]
        at = m.end()
    return "".join([*parts, restorer.doubles(text[at:])])


# -- features and the scorer ----------------------------------------------------------------------------------------

_WORDS = re.compile(rf"{_LETTER}+")


def parts(word: str) -> list[str]:
    """A word with its ends marked, and its runs of four and five signs."""
    marked = f"^{word}$"
    return [marked] + [marked[i : i + n] for n in (4, 5) for i in range(len(marked) - n + 1) if len(marked) > n]


class Features(dict):
    """Numbers of the chosen parts that a word has, kept by word."""

    def __init__(self, chosen: dict[str, int]):
        super().__init__()
        self.chosen = chosen

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 500_000:
            self.clear()
        found = self[word] = tuple({self.chosen[p] for p in parts(word) if p in self.chosen})
        return found

    def text(self, text: str) -> list[int]:
        return sorted(set().union(*map(self.__getitem__, set(_WORDS.findall(text)))))


@dataclass(frozen=True)
class Model:
    """What scoring needs. Its size is bounded by the symbols and the number of features."""

    log_p: np.ndarray
    chosen: dict[str, int]
    weights: np.ndarray
    intercept: float


@dataclass(frozen=True)
class Training:
    """The documented bounds of the fit."""

    fold: int = 5
    held_out: int = 0
    sample: int = 4000
    features: int = 2048
    least_documents: int = 3
    least_z: float = 4.0


def remainder(fold: int) -> Column:
    """crc32 of the doc_id's text modulo ``fold``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % fold


def training_rows(labels: DataFrame, label: str, training: Training) -> DataFrame:
    """doc_id and label (0 or 1) of the rows that may be learned from, one for each doc_id."""
    rows = labels.select(F.col("doc_id").cast("long").alias("__id"), F.col(label).alias("label"))
    rows = rows.filter("__id is not null and label in (0, 1)").groupBy("__id").agg(F.max("label").alias("label"))
    return rows.withColumnRenamed("__id", "doc_id").filter(remainder(training.fold) != training.held_out)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, training: Training) -> DataFrame:
    """label and text of at most ``sample`` training rows of each class: those with the least hash of their doc_id."""
    rows = training_rows(labels, label, training)
    order = F.xxhash64("doc_id")
    # A bounded heap in every task instead of a global sort.
    least = [rows.filter(F.col("label") == c).orderBy(order, "doc_id").limit(training.sample) for c in (0, 1)]
    chosen = least[0].unionByName(least[1]).select(F.col("doc_id").alias("__id"), "label")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    # At most twice ``sample`` rows of two numbers.
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))
    return joined.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def _choose(sample: DataFrame, training: Training) -> dict[str, int]:
    """The parts that most clearly occur more often in texts with label 1."""

    def count(batches):
        by_class = (Counter(), Counter())
        documents = [0, 0]
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                documents[label] += 1
                by_class[label].update({p for w in set(_WORDS.findall(text)) for p in parts(w)})
        names = list(by_class[0].keys() | by_class[1].keys())
        columns = [names + [""]] + [[c[n] for n in names] + [d] for c, d in zip(by_class, documents, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], names=["part", "n0", "n1"])

    counted = sample.select(F.col("label").cast("int").alias("label"), "text").mapInArrow(count, "part string, n0 long, n1 long")
    totals = stored(counted.groupBy("part").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "parts")
    of = totals.filter("part = ''").first()
    if of is None or not of["n0"] or not of["n1"]:
        return {}
    n0, n1 = of["n0"], of["n1"]
    share = (F.col("n0") + F.col("n1") + 1) / (n0 + n1 + 2)
    apart = (F.col("n1") + 0.5) / (n1 + 1) - (F.col("n0") + 0.5) / (n0 + 1)
    rows = totals.filter((F.col("part") != "") & (F.col("n0") + F.col("n1") >= training.least_documents))
    rows = rows.withColumn("z", apart / F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))).filter(F.col("z") >= training.least_z)
    best = rows.orderBy(F.desc("z"), "part").limit(training.features).select("part").collect()
    return {r[0]: i for i, r in enumerate(best)}


def _fit(rows: list[tuple[int, list[int]]], features: int, l2: float = 0.02, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression with classes weighted alike, by gradient steps with momentum."""
    y = np.array([r[0] for r in rows], float)
    owner = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    number = np.concatenate([np.array(r[1], np.int64) for r in rows]) if len(owner) else np.zeros(0, np.int64)
    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, b = np.zeros(features), 0.0
    mw, mb, vw, vb = np.zeros(features), 0.0, np.zeros(features), 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(owner, w[number], minlength=len(rows)) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        gw, gb = np.bincount(number, error[owner], minlength=features) + l2 * w / features, error.sum()
        mw, mb = 0.9 * mw + 0.1 * gw, 0.9 * mb + 0.1 * gb
        vw, vb = 0.99 * vw + 0.01 * gw**2, 0.99 * vb + 0.01 * gb**2
        w = w - 0.05 * (mw / (1 - 0.9**t)) / (np.sqrt(vw / (1 - 0.99**t)) + 1e-8)
        b = b - 0.05 * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", training: Training = Training()) -> Model | None:  # noqa: B008
    """A model from the texts of ``docs`` and the labels of training rows; None if a class has none."""
    log_p = log_probabilities(character_counts(docs))

    def restore(batch: pa.RecordBatch) -> dict:
        restorer = _restorer(log_p)
        return {"label": batch.column(1), "text": [restored(t, restorer) for t in batch.column(2).to_pylist()]}

    raw = labelled_sample(docs, labels, label, training).withColumn("label", F.col("label").cast("int"))
    sample = stored(map_batches(raw, restore, "label int, text string"), "sample")
    chosen = _choose(sample, training)
    if not chosen:
        return None

    def numbers(batch: pa.RecordBatch) -> dict:
        features = Features(chosen)
        return {"label": batch.column(0), "numbers": [features.text(t) for t in batch.column(1).to_pylist()]}

    rows = [(r[0], r[1]) for r in map_batches(sample, numbers, "label int, numbers array<int>").collect()]
    weights, intercept = _fit(rows, len(chosen))
    return Model(log_p, chosen, weights, intercept)


_kept: dict[str, object] = {}


def _restorer(log_p: np.ndarray) -> Restorer:
    """One per worker and model, so that what it has restored serves all its tasks."""
    key = hash(log_p.tobytes())
    if _kept.get("restorer_key") != key:
        _kept.update(restorer_key=key, restorer=Restorer(log_p))
    return _kept["restorer"]


def _features(chosen: dict[str, int]) -> Features:
    key = hash(tuple(chosen))
    if _kept.get("features_key") != key:
        _kept.update(features_key=key, features=Features(chosen))
    return _kept["features"]


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score and the restored text's feature count of every text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_features"))

    def scored(batch: pa.RecordBatch) -> dict:
        restorer, features = _restorer(model.log_p), _features(model.chosen)
        own = [features.text(restored(t, restorer)) for t in batch.column(1).to_pylist()]
        z = np.array([model.weights[x].sum() for x in own]) + model.intercept
        return {"doc_id": batch.column(0), "score": 1 / (1 + np.exp(-np.clip(z, -30, 30))), "n_features": [len(x) for x in own]}

    return map_batches(rows, scored, "doc_id long, score double, n_features long")
