"""Token files, packing and byte-level BPE against the libraries and plain versions."""

import base64
import bisect
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from relaylog.llm import bpe, packing, pieces, token_files
from relaylog.llm.queries import END_ID, RANKS, TOKENIZER
from relaylog.session import shared_dir

LIBRARY = Tokenizer.from_file(TOKENIZER)
LIBRARY.encode_special_tokens = True
with open(RANKS, "rb") as f:
    RANK = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
OTHER = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANK, special_tokens={})

texts = st.lists(
    st.sampled_from([" ", "  ", "\n", "\t", "'s", "'", "the", "Haus", "é", "一", "12", "!!", "<|endoftext|>", " ", "\x1c", "aaaa", "😀", ".", "ing"]),
    max_size=30,
).map("".join)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(texts)
def test_pieces_give_the_ids_of_the_whole_text(text):
    assert " ".join(pieces.cut(text)) == text
    assert pieces.encoder(TOKENIZER)(text).tolist() == ids(text)


def test_older_pieces_are_looked_up_and_not_gone_over():
    class Older(dict):
        def __iter__(self):
            raise AssertionError("every older piece is read for each group of texts")

    encode = pieces.LibraryEncoder(TOKENIZER)
    known = [f"known{i}" for i in range(100)]
    encode.older = Older((w, np.array(ids(" " + w), "<u2").tobytes()) for w in known)
    text = "first known7 and new known99"
    assert encode(text).tolist() == ids(text)
    assert {"known7", "known99", "and", "new"} == set(encode.pieces)


class Recorded:
    """The library, and what goes through it."""

    def __init__(self, library):
        self.library, self.model, self.seen = library, self, []

    def tokenize(self, word):
        self.seen.append(word)
        return self.library.model.tokenize(word)

    def encode(self, text, **options):
        self.seen.append(text)
        return self.library.encode(text, **options)

    def encode_batch_fast(self, batch, **options):
        self.seen += batch
        return self.library.encode_batch_fast(batch, **options)


def test_a_word_goes_through_the_library_once():
    encode = pieces.LibraryEncoder(TOKENIZER)
    encode.tokenizer = recorded = Recorded(encode.tokenizer)
    text = "At wordone,\nWordtwo wordone.\nWordtwo, wordone wordone;\nWordthree\u00e9 wordone!!\nWordtwo! wordone,"
    assert encode(text).tolist() == ids(text)
    assert encode(text + " " + text).tolist() == ids(text + " " + text)
    seen = " ".join(recorded.seen)
    assert [seen.count(w) for w in ("wordone", "Wordtwo", "Wordthree")] == [1, 1, 1]


lines = st.lists(st.sampled_from(["the", "Haus", "é", "\u00df", "一", "12", "!!", ".", ",", "'", "'s", "_", "\n", " ", "\r", "\x1c", "\u00a0", "\u0301"]), max_size=40)


@settings(max_examples=500, deadline=None)
@given(st.lists(lines.map("".join), min_size=1, max_size=8), st.sampled_from([1, 4, 1000]), st.sampled_from([1, 30, 1 << 20]))
def test_words_marks_and_lines_give_the_ids_of_the_whole_texts(many, kept, chars):
    """Also when what is kept is moved to the older half, and when a consumer stops early."""
    encode, before = _small, pieces.GROUP_CHARS
    encode.kept, pieces.GROUP_CHARS = kept, chars
    try:
        next(encode.texts(many))
        assert [own.tolist() for own in encode.texts(many * 2)] == [ids(t) for t in many * 2]
    finally:
        pieces.GROUP_CHARS = before


_small = pieces.LibraryEncoder(TOKENIZER)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_rank_queue_gives_the_ids_of_the_library(text):
    pairs = bpe.byte_pairs(RANKS, P.PATTERN)
    packed = pairs.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == OTHER.encode_ordinary(text)
    assert pairs.decode(packed) == text.encode()


@pytest.mark.parametrize("text", ["ab" * 40_000, "a" * 50_000, "xyzw" * 10_000, "é" * 20_000])
def test_very_long_words(text):
    assert np.frombuffer(bpe.byte_pairs(RANKS, P.PATTERN).encode(text), "<u4").tolist() == OTHER.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.randoms(use_true_random=False))
def test_any_table_of_ranks_merges_the_lowest_leftmost_pair(data, rng):
    """Also where a merge makes a pair of a lower rank than its own."""
    data = bytes(b % 3 for b in data)
    known = {bytes([b]) for b in range(3)} | {bytes(rng.choices(range(3), k=rng.randint(2, 4))) for _ in range(25)}
    order = sorted(known)
    rng.shuffle(order)
    pairs = bpe.BytePairs.__new__(bpe.BytePairs)
    pairs.ranks = {token: i for i, token in enumerate(order)}
    pairs.queue = bpe.RankQueue(len(order))
    parts = [data[i : i + 1] for i in range(len(data))]
    while data not in pairs.ranks and len(parts) > 1:
        rank, i = min((pairs.ranks.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1))
        if rank == 1 << 30:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    want = [pairs.ranks[data]] if data in pairs.ranks else [pairs.ranks[p] for p in parts]
    assert (pairs.word(data) if data else []) == want


def test_rank_queue_keeps_order():
    queue = bpe.RankQueue(200_000)
    rng = random.Random(1)
    entries = [(rng.choice([0, 255, 256, 65_535, 65_536, 199_999, rng.randrange(200_000)]), i) for i in range(500)]
    for rank, i in entries:
        queue.push(rank, i)
    out = []
    while queue.top:
        rank, positions = queue.pop()
        out += [(rank, i) for i in positions]
    assert out == sorted(entries)


def test_token_files(llm, frame, hard_rows):
    folder = shared_dir(llm, "test-tokens")
    token_files.write_token_files(frame(hard_rows), folder, TOKENIZER, END_ID)
    got = token_files.read_token_files(llm, folder, ids=True).orderBy("start").collect()
    rows = sorted(hard_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    assert len(got) == len(rows)
    for row, (doc_id, text) in zip(got, rows, strict=True):
        own = np.array([*ids(text), END_ID], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(own), zlib.crc32(own.tobytes()))
        assert row.ids == own.tolist()
        start += len(own)


def test_token_files_of_an_empty_table(llm, frame):
    folder = shared_dir(llm, "test-tokens")
    token_files.write_token_files(frame([]), folder, TOKENIZER, END_ID)
    assert token_files.read_token_files(llm, folder).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 40), min_size=1), st.integers(20, 24))
def test_plan_is_best_fit_decreasing(histogram, capacity):
    steps = packing.best_fit_decreasing(histogram, capacity)
    rooms, sequences = [], {}
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            k = bisect.bisect_left(rooms, length)
            bisect.insort(rooms, (rooms.pop(k) if k < len(rooms) else capacity) - length)
    placed = {n: 0 for n in histogram}
    for length, r0, r1, first, each, place in steps:
        assert r0 == placed[length]
        placed[length] = r1
        for i in range(r1 - r0):
            sequences.setdefault(first + i // each, []).append((place + i % each * length, length))
    assert placed == histogram
    left = []
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        left.append(capacity - at)
    assert sorted(left) == rooms


def test_packed_documents(llm, frame, hard_rows):
    capacity = 64
    cut = packing.cut_documents(frame(hard_rows), TOKENIZER, END_ID, capacity, ids=True)
    packed = packing.pack(cut, capacity)
    rows = packed.collect()
    by_document = {}
    for r in rows:
        by_document.setdefault(r.doc_id, []).append(r)
        assert 0 < r.length <= capacity and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    total = 0
    for doc_id in {r[0] for r in hard_rows}:
        want = sorted([*ids(t), END_ID] for i, t in hard_rows if i == doc_id)
        own, texts = sorted(by_document[doc_id], key=lambda r: r.piece), []
        # Rows with one doc_id can't be told apart by it: their pieces are the same as a whole.
        assert sorted(x for r in own for x in r.ids) == sorted(x for w in want for x in w)
        if len(want) == 1:
            texts = [x for r in own for x in r.ids]
            assert texts == want[0] and [r.piece for r in own] == list(range(len(own)))
            assert [r.start for r in own] == [sum(p.length for p in own[:i]) for i in range(len(own))]
        total += sum(map(len, want))
    sequences = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert sum(map(len, sequences.values())) == total
    for r in rows:
        assert sequences[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    rooms = []
    for length in sorted((r.length for r in rows), reverse=True):
        k = bisect.bisect_left(rooms, length)
        bisect.insort(rooms, (rooms.pop(k) if k < len(rooms) else capacity) - length)
    assert len(sequences) == len(rooms)
    assert packing.pack(packing.cut_documents(frame([]), TOKENIZER, END_ID, capacity), capacity).count() == 0


def test_only_the_first_piece_is_shorter(llm, frame):
    capacity, word = 8, ids(" the")
    assert len(word) == 1
    rows = [(n, " the" * (n - 1)) for n in (1, 7, 8, 9, 15, 16, 17, 24, 30)]
    got = packing.cut_documents(frame(rows), TOKENIZER, END_ID, capacity, ids=True).collect()
    for n, _ in rows:
        own, whole = sorted((r for r in got if r.doc_id == n), key=lambda r: r.piece), [*word * (n - 1), END_ID]
        full = (n - 1) // capacity
        assert [r.length for r in own] == [n - full * capacity] + [capacity] * full
        assert [r.start for r in own] == [0, *(n - k * capacity for k in range(full, 0, -1))]
        assert [r.ids for r in own] == [whole[r.start : r.start + r.length] for r in own]
        assert [r.ids_crc32 for r in own] == [zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in own]


def test_byte_pairs_of_documents(frame, hard_rows):
    got = bpe.digests(frame(hard_rows), RANKS, P.PATTERN).collect()
    want = []
    for doc_id, text in hard_rows:
        own = np.array(OTHER.encode_ordinary(text or ""), "<u4").tobytes()
        want.append((doc_id, len(own) // 4, hashlib.sha256(own).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    back = bpe.encode_decode(frame(hard_rows), RANKS, P.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t in hard_rows)
    assert bpe.digests(frame([]), RANKS, P.PATTERN).count() == 0
