"""Byte-level BPE by merge ranks, with a rank queue instead of a scan for the lowest pair.

The pairs of a word wait in buckets, one for each merge rank. A bucket is a list of positions of the pairs' left parts.
A hierarchy of bitmaps tells which buckets are not empty: a bit stands for a bucket, a bit of the level above for a
word of bits below. Find-first-set, from the top, gives the lowest rank in two steps. A merge changes its two
neighbours' pairs; their old entries stay and are skipped once they come up, because the pair's rank is then another
one. Pairs that still have a rank are counted, so the entries left when there are none need not come up. A word of n bytes
takes O(n) steps and a sort of each bucket, also if it is a hundred thousand bytes long.

Ids are the ranks. Each match of the splitting pattern is encoded on its own. Null texts are empty and have no ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaylog.llm.common import map_batches, text_column
from relaylog.llm.pieces import Pieces

_BITS = 256
_BIT = [1 << i for i in range(_BITS)]
_NONE = -1
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Letters of every Unicode version; letters with marks after them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_WORD = re.compile(f" [{_LETTERS}]+")
_MARKED = re.compile(f" ([{_LETTERS}]+)([{re.escape(_MARKS)}]+)")


class RankQueue:
    """Entries by rank. ``top`` has a bit for each word of ``words`` that is there, a word a bit for each rank.

    Entries stand in ``buckets``. A caller that merges inlines what ``push`` and ``pop`` do.
    """

    def __init__(self, ranks: int):
        self.ranks = ranks
        self.buckets: dict[int, list[int]] = {}
        self.words: dict[int, int] = {}
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        if not 0 <= rank < self.ranks:
            raise ValueError(f"rank {rank} is not below {self.ranks}")
        if (bucket := self.buckets.get(rank)) is None:
            word = rank // _BITS
            self.top |= 1 << word
            self.words[word] = self.words.get(word, 0) | _BIT[rank % _BITS]
            self.buckets[rank] = [position]
        else:
            bucket.append(position)

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank that has entries, and their positions from left to right. There must be one."""
        word = (self.top & -self.top).bit_length() - 1
        bits = self.words[word]
        rank = word * _BITS + (bits & -bits).bit_length() - 1
        if bits := bits & (bits - 1):
            self.words[word] = bits
        else:
            del self.words[word]
            self.top &= self.top - 1
        return rank, sorted(self.buckets.pop(rank))


class BytePairs:
    """Encodes and decodes by a table of ranks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        # The pattern's white space is Unicode's, without the four separators that Python adds.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        # Whether a space and letters are one match of the pattern, and marks after them another.
        self.parts_marks = all(self.split.findall(f" aZé{m}{n}") == [" aZé", m + n] for m in _MARKS for n in _MARKS)
        self.pieces = Pieces(self._piece)
        self.words = Pieces(self._word)  # other matches of the pattern

    def word(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern: the lowest-ranked pair is merged first, the leftmost among equals."""
        get = self.ranks.get
        if (whole := get(data)) is not None:
            return [whole]
        n = len(data)
        ends = list(range(1, n + 1))  # a part is data[i:ends[i]]
        before = list(range(-1, n))
        pair = [_NONE] * n  # the rank of the pair that begins at a part; none for the last and for merged parts
        buckets, words, top, live = {}, {}, 0, 0  # live: how many of ``pair`` have a rank
        for i in range(n - 1):
            if (new := get(data[i : i + 2], _NONE)) != _NONE:
                pair[i] = new
                live += 1
                if new in buckets:
                    buckets[new].append(i)
                else:
                    buckets[new] = [i]
                    at = new >> 8
                    if at in words:
                        words[at] |= _BIT[new & 255]
                    else:
                        words[at] = _BIT[new & 255]
                        top |= 1 << at
        while live:
            at = (top & -top).bit_length() - 1
            bits = words[at]
            rank = (at << 8) + (bits & -bits).bit_length() - 1
            if bits := bits & (bits - 1):
                words[at] = bits
            else:
                del words[at]
                top &= top - 1
            waiting = buckets.pop(rank)
            if len(waiting) > 1:
                waiting.sort()
            for i in waiting:
                if pair[i] != rank:  # stale
                    continue
                right = ends[i]
                end = ends[i] = ends[right]
                if pair[right] != _NONE:
                    live -= 1
                pair[right] = pair[i] = _NONE
                live -= 1
                lowest = rank + 1
                if end < n:
                    before[end] = i
                    if (new := get(data[i : ends[end]], _NONE)) != _NONE:
                        pair[i] = new
                        live += 1
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            at = new >> 8
                            if at in words:
                                words[at] |= _BIT[new & 255]
                            else:
                                words[at] = _BIT[new & 255]
                                top |= 1 << at
                        if new < lowest:
                            lowest = new
                if (left := before[i]) >= 0:
                    if pair[left] != _NONE:
                        live -= 1
                    pair[left] = new = get(data[left:end], _NONE)
                    if new != _NONE:
                        live += 1
                        if new in buckets:
                            buckets[new].append(left)
                        else:
                            buckets[new] = [left]
                            at = new >> 8
                            if at in words:
                                words[at] |= _BIT[new & 255]
                            else:
                                words[at] = _BIT[new & 255]
                                top |= 1 << at
                        if new < lowest:
                            lowest = new
                if lowest <= rank:  # that goes first; the rest of this bucket goes back
                    for later in waiting:
                        if later > i and pair[later] == rank:
                            if rank in buckets:
                                buckets[rank].append(later)
                            else:
                                buckets[rank] = [later]
                                at = rank >> 8
                                if at in words:
                                    words[at] |= _BIT[rank & 255]
                                else:
                                    words[at] = _BIT[rank & 255]
                                    top |= 1 << at
                    break
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[data[i : ends[i]]])
            i = ends[i]
        return ids

    def _word(self, word: str) -> bytes:
        # A match stands in ``words`` for itself, so the space that ``Pieces`` puts before it goes again.
        return array("I", self.word(word[1:].encode())).tobytes()

    def _piece(self, piece: str) -> bytes:
        if self.parts_marks:
            if _WORD.fullmatch(piece):
                return array("I", self.word(piece.encode())).tobytes()
            if m := _MARKED.fullmatch(piece):
                return self.pieces[m[1]] + self.words[m[2]]
        return b"".join(map(self.words.__getitem__, self.split.findall(piece)))

    def encode(self, text: str) -> bytes:
        """Packed little-endian unsigned 32-bit ids of a whole text."""
        return self.pieces.text(text)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[tuple[str, str], BytePairs] = {}


def byte_pairs(path: str, pattern: str) -> BytePairs:
    """One per worker process, so that what it keeps serves all its tasks."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = BytePairs(path, pattern)
    return _loaded[path, pattern]


def encode_decode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, ids (packed) and the decoded bytes of every text."""

    def rows(batch: pa.RecordBatch) -> dict:
        pairs = byte_pairs(ranks, pattern)
        ids = [pairs.encode(text) for text in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "ids": ids, "decoded": [pairs.decode(x) for x in ids]}

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return map_batches(source, rows, "doc_id long, ids binary, decoded binary")


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the decoded bytes, made where they are encoded."""

    def rows(batch: pa.RecordBatch) -> dict:
        pairs = byte_pairs(ranks, pattern)
        ids = [pairs.encode(text) for text in batch.column(1).to_pylist()]
        return {
            "doc_id": batch.column(0),
            "n_tokens": [len(x) // 4 for x in ids],
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(pairs.decode(x)).hexdigest() for x in ids],
        }

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return map_batches(source, rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
