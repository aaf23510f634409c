"""Ids of whole texts from the tokenizers library, at the cost of encoding each distinct piece once.

The pattern of the byte-level vocabulary never lets a token cross a space that stands before something other
than white space: such a space always begins a token. So a text can be cut there, and the ids of the pieces one
after another are the ids of the text. Pieces repeat, so a worker keeps their ids, and looks each piece of a text up once.
New pieces are mostly words with marks after them, perhaps over the end of a line. The pattern parts these too, so a word
goes through the library once, whatever marks and words stand beside it. The other new pieces of a group of texts go
through it together, as one text with a space before each: where the ids of a piece begin is told by the tokens
themselves, as the first token of each piece, and no other, begins with a space.
"""

from __future__ import annotations

import codecs
import os
import re
import string
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
from tokenizers import Tokenizer

#: Distinct pieces in each of the two halves of what ``Pieces`` keeps.
KEPT_PIECES = 500_000
#: Distinct pieces in each of the two halves of what a worker keeps, some 40 MB a half, and characters in them per piece.
HALF_PIECES = 250_000
CHARS_A_PIECE = 13
#: The same for jobs that do little else: some 100 MB a half.
MANY_PIECES = 650_000
#: A batch of texts is taken in groups of so many characters, and new pieces are encoded in texts of so many.
GROUP_CHARS = 1 << 20
JOINED_CHARS = 1 << 16
#: What begins a text or a line is kept up to so many characters.
FIRST_CHARS = 64

_CUT = re.compile(r" (?=\S)")
_SPACE_RUN = re.compile(r" \s")
# ASCII marks other than the apostrophe: the pattern always parts them from letters before them and from an end of line after.
_MARKS = string.punctuation.replace("'", "")
# How a byte-level vocabulary writes bytes: printable ones as themselves, the others from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = "".join(chr(b if b in _PRINTED else 256 + len(set(range(b)) - _PRINTED)) for b in range(256))
# Stands for ids that are not known yet; unlike any, as its length is odd.
_LACKING = b"?"


def cut(text: str) -> list[str]:
    """The pieces of a text: joined with single spaces they are the text again."""
    return _CUT.split(text) if text.endswith(" ") or _SPACE_RUN.search(text) else text.split(" ")


def _grouped(texts: Iterable[str], chars: int) -> Iterator[list[str]]:
    """Groups of neighbours with at most ``chars`` characters, or of one text."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > chars:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text) + 1
    if group:
        yield group


class Pieces(dict):
    """Packed ids by piece, one at a time. A piece stands for itself with a space before it.

    They are kept in two halves: what is still in use comes back from the older one.
    """

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}
        self.chars = 0

    def __missing__(self, piece: str) -> bytes:
        if (ids := self.older.get(piece)) is None:
            ids = self.encode(" " + piece)
        if len(self) >= KEPT_PIECES or self.chars > KEPT_PIECES * CHARS_A_PIECE:
            self.older, self.chars = dict(self), 0
            self.clear()
        self[piece] = ids
        self.chars += len(piece)
        return ids

    def text(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = cut(text)
        return self.encode(first) + b"".join(map(self.__getitem__, rest))


class _Known(dict):
    """Packed ids by piece. What it lacks comes from ``find``; pieces that this can't tell either are noted, in order."""

    def __init__(self, find: Callable[[str], bytes | None]):
        super().__init__()
        self.find = find
        self.lacking: list[str] = []

    def __missing__(self, piece: str) -> bytes:
        if (ids := self.find(piece)) is None:
            self.lacking.append(piece)
            return _LACKING
        self[piece] = ids
        return ids


class LibraryEncoder:
    """Ids by the tokenizers library as little-endian unsigned integers of ``dtype``; special tokens are plain text."""

    def __init__(self, path: str, dtype: str = "<u2", kept: int = HALF_PIECES):
        self.kept = kept
        # Spark runs a worker on every core already; the library's own threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype(dtype)
        size = self.tokenizer.get_vocab_size()
        if size > np.iinfo(self.dtype).max + 1:
            raise ValueError(f"{path} has ids that do not fit {dtype}")
        tokens = (self.tokenizer.id_to_token(i) or "" for i in range(size))
        self.begins = np.fromiter((t.startswith("Ġ") for t in tokens), bool, size)
        # Packed ids by piece. A piece stands for itself with a space before it.
        self.pieces = _Known(self._find)
        self.older: dict[str, bytes] = {}
        # The same for what begins a text or a line, without a space, and for marks after a word.
        self.firsts: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.chars = 0

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _word(self, match: str) -> bytes:
        """Letters, perhaps after a space: one match of the pattern, which goes to the model as it is."""
        written, _ = codecs.charmap_decode(match.encode(), "strict", _BYTES)
        return array(self.dtype.char, [t.id for t in self.tokenizer.model.tokenize(written)]).tobytes()

    def _first(self, piece: str) -> bytes:
        """What begins a text or a line, without a space before it. Long ones are hardly seen again and not kept."""
        if len(piece) > FIRST_CHARS:
            return self._plain(piece)
        if (ids := self.firsts.get(piece)) is None:
            ids = self.firsts[piece] = self._word(piece) if piece.isalpha() else self._plain(piece)
            self.chars += len(piece)
        return ids

    def _after(self, marks: str) -> bytes:
        """Marks or an end of line after a word."""
        if (ids := self.marks.get(marks)) is None:
            ids = self.marks[marks] = self._plain(marks)
            self.chars += len(marks)
        return ids

    def _find(self, piece: str) -> bytes | None:
        """The ids of a piece that is in the older half, or a word with marks after it and perhaps another such on a new line."""
        ids = self.older.get(piece)
        if ids is None:
            if piece.isalpha():
                ids = self._word(" " + piece)
            else:
                line, end, next_line = piece.partition("\n")
                word, first = line.rstrip(_MARKS), next_line.rstrip(_MARKS)
                if not word.isalpha() or (end and not first.isalpha()):
                    return None
                ids = self.pieces[word]
                if word != line:
                    ids += self._after(line[len(word) :])
                if end:
                    ids += self._after(end) + self._first(first)
                    if first != next_line:
                        ids += self._after(next_line[len(first) :])
        self.chars += len(piece)
        return ids

    def _learn(self, new: set[str]) -> None:
        known = self.pieces
        self.chars += sum(map(len, new))
        for group in _grouped((p for p in new if p and " " not in p), JOINED_CHARS):
            [encoded] = self.tokenizer.encode_batch_fast([" " + " ".join(group)], add_special_tokens=False)
            ids = np.array(encoded.ids, self.dtype)
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) != len(group):  # another vocabulary might part a space from what follows it
                known.update((p, self._plain(" " + p)) for p in group)
                continue
            packed, edges = ids.tobytes(), (np.append(starts, len(ids)) * self.dtype.itemsize).tolist()
            known.update(zip(group, map(packed.__getitem__, map(slice, edges, edges[1:])), strict=True))
        known.update((p, self._plain(" " + p)) for p in new if not p or " " in p)

    def texts(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        for group in _grouped(texts, GROUP_CHARS):
            if len(self.pieces) + len(self.firsts) + len(self.marks) >= self.kept or self.chars > self.kept * CHARS_A_PIECE:
                # Pieces that are still in use come back from the older half.
                self.older, self.pieces, self.firsts, self.marks, self.chars = self.pieces, _Known(self._find), {}, {}, 0
            known = self.pieces
            known.lacking = lacking = []
            parts = []  # each text's packed ids by piece, and where its lacking pieces end
            for text in group:
                first, *pieces = cut(text)
                parts.append(([self._first(first) if first else b"", *map(known.__getitem__, pieces)], len(lacking)))
            self._learn(set(lacking))
            done = 0
            for ids, end in parts:
                at = 0
                for piece in lacking[done:end]:
                    at = ids.index(_LACKING, at + 1)
                    ids[at] = known[piece]
                done = end
                yield np.frombuffer(b"".join(ids), self.dtype)

    def __call__(self, text: str) -> np.ndarray:
        return next(self.texts([text]))


_encoders: dict[tuple[str, str], LibraryEncoder] = {}


def encoder(path: str, dtype: str = "<u2", kept: int = HALF_PIECES) -> LibraryEncoder:
    """One per worker process, so that what it keeps serves all its tasks. It keeps as much as its last task asked for."""
    if (path, dtype) not in _encoders:
        _encoders[path, dtype] = LibraryEncoder(path, dtype)
    _encoders[path, dtype].kept = kept
    return _encoders[path, dtype]


def id_type(path: str) -> str:
    """The smallest unsigned integer that holds every id."""
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"
