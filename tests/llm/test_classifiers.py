"""Toxicity and quality: the parts against plain versions, the whole on held-out labels."""

import itertools
import re
import zlib

import numpy as np
import pytest

from relaylog.llm import quality_classifier as qc
from relaylog.llm import queries, toxicity
from relaylog.llm.common import documents

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def restorer():
    plain = "stupid idiots moron the trash is in loser letter good clown worthless tree book hello pathetic " * 200
    counts = np.bincount(toxicity._triples(plain), minlength=toxicity._SYMBOLS**3)
    return toxicity.Restorer(toxicity.log_probabilities(counts))


@pytest.mark.parametrize(
    ("written", "meant"),
    [
        ("what a $tup1d thing", "what a stupid thing"), ("you m0r0n!", "you moron!"), ("s t u p i d text", "stupid text"),
        ("an i.d.i.o.t here", "an idiot here"), ("such a looooser", "such a loser"), ("tr@sh", "trash"), ("cl*wn", "clown"),
        ("the good book", "the good book"), ("hello letter tree", "hello letter tree"), ("THE!! GOOD!! BOOK!!", "the!! good!! book!!"),
        ("i d 1 0 t", "idiot"), ("such i.d.1.o.t talk", "such idiot talk"), ("st.u.p.1.d", "stupid"), ("a/1d10t", "a/idiot"),
        ("stuupiid", "stupid"), ("sttupid", "stupid"), ("st-upid", "stupid"), ("s-t-u-p-1-d", "stupid"), ("i_d_i_o_t", "idiot"),
        ("the/good/book", "the/good/book"), ("the good-book.", "the good-book."), ("1 2 3 4", "1 2 3 4"), ("in 2 3 rows", "in 2 3 rows"),
        ("", ""),
    ],
)
def test_restored(restorer, written, meant):
    assert toxicity.restored(written, restorer) == meant


@pytest.mark.parametrize("token", ["1d1o7", "l0ser", "m00ron", "tr33", "$$op", "aab", "4*1d", "b00k5", "ll|ll", "i d 1", "a/1d", "s-t.u", "t. r", "oo_n", "aaab", "looo"])
def test_the_path_is_the_best_of_all_readings(restorer, token):
    """Every reading of the lattice, one by one."""
    ways = []
    for i, sign in enumerate(token):
        if sign in toxicity.SEPARATORS:
            ways.append([(sign, 0.0), ("", toxicity._JOINED[sign])])
        elif sign in toxicity._NUMBER:
            run = re.search(rf"{sign}*\Z", token[:i])[0] + re.match(rf"{sign}+", token[i:])[0]
            noise = toxicity._SINGLE if len(run) > 2 else toxicity._DOUBLE
            ways.append([(sign, 0.0)] + ([("", noise)] if i and token[i - 1] == sign else []))
        else:
            ways.append([(x, toxicity._REPLACED) for x in toxicity.LOOKS_LIKE.get(sign, "")] + [("", toxicity._DROPPED)])

    def value(letters):
        codes = [0, 0]
        for code in [*(toxicity._NUMBER.get(c, 0) for c in letters), 0]:
            if code or codes[-1] or len(codes) == 2 and not letters:
                codes.append(code)  # ends in a row are one
        return sum(restorer.log_p[a][b][c] for a, b, c in zip(codes, codes[1:], codes[2:], strict=False))

    readings = [("".join(x for x, _ in way), sum(c for _, c in way)) for way in itertools.product(*ways)]
    best = max(value(letters) + cost for letters, cost in readings)
    found = restorer.word(token)
    assert max(value(found) + cost for letters, cost in readings if letters == found) == pytest.approx(best)


def test_doubles_are_decided_as_on_the_whole_lattice(restorer):
    """Every word of up to five letters of three, without three equal ones in a row."""
    for size in range(1, 6):
        for letters in itertools.product("ots", repeat=size):
            word = "".join(letters)
            if not re.search(r"(.)\1\1", word):
                assert restorer.doubles(word) == restorer.word(word)
                assert toxicity.restored(f'"{word}", so', restorer) == f'"{restorer.word(word)}", so'


def test_what_reads_as_nothing_stays(restorer):
    assert restorer.word("9") == "9" or restorer.word("9") in toxicity.LOOKS_LIKE["9"]
    assert restorer.word("") == ""


def _held_out(llm, rows, label, fold, held_out):
    labels = {r.doc_id: r[label] for r in llm.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold == held_out)
        assert 0 <= r.score <= 1
    own = [r for r in rows if r.held_out and r.doc_id in labels]
    return own, np.array([labels[r.doc_id] for r in own]), np.array([r.score for r in own])


def _auc(y, s):
    return np.mean([(a > b) + (a == b) / 2 for a in s[y == 1] for b in s[y == 0]])


def test_toxicity_held_out(llm):
    rows = queries.op8_toxicity(llm, SF_DIR).collect()
    own, y, s = _held_out(llm, rows, "toxic", 5, 0)
    assert len(rows) == 10_000 and all(r.predicted == (r.score >= 0.5) for r in rows)
    assert _auc(y, s) > 0.95
    assert (s[y == 0] >= 0.5).mean() < 0.01 and (s[y == 1] >= 0.5).mean() > 0.85


def test_quality_held_out(llm):
    rows = queries.op10_quality_classifier(llm, SF_DIR).collect()
    own, y, s = _held_out(llm, rows, "quality", 4, 2)
    assert len(rows) == 10_000 and all(r.predicted == (r.score >= 0.7) for r in rows)
    assert _auc(y, s) > 0.97
    assert ((s >= 0.7) == (y == 1)).mean() > 0.93


def _labels(llm, rows):
    return llm.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, label string")


def test_hidden_words_are_scored(llm, frame):
    """A word learned in plain is found in disguise, and clean rows stay clean."""
    docs = [(i, f"some text {i} about the weather and an idiot in town") if i % 4 == 0 else (i, f"some text {i} about the weather and a book in town") for i in range(400)]
    extra = [(1000, "some text about an 1d10t in town"), (1001, "some text about an i d i o t in town"), (1002, "some text about a b00k in town"), (1003, None), (1004, "")]
    df = frame(docs + extra)
    model = toxicity.train(df, _labels(llm, [(i, 1, int(i % 4 == 0), "t", "l") for i, _ in docs]))
    scores = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert scores[1000] > 0.5 and scores[1001] > 0.5
    assert all(scores[i] < 0.5 for i in (1002, 1003, 1004, 1, 2, 3))


def test_edges_of_both(llm, frame, hard_rows):
    docs = frame(hard_rows)
    few = _labels(llm, [(7, 1, 0, "t", "l"), (None, 0, 1, "t", "l"), (3, None, None, "t", "l"), (7, 1, 0, "t", "l")])
    assert toxicity.train(docs, few) is None and qc.train(docs, few) is None
    assert [r.score for r in toxicity.score(docs, None).collect()] == [0.0] * len(hard_rows)
    assert [r.score for r in qc.score(docs, None).collect()] == [1.0] * len(hard_rows)
    assert qc.accepted(docs, None, 0.7).count() == len(hard_rows)
    both = _labels(llm, [(i, int(i % 2 == 0), int(i % 2 == 0), "t", "l") for i in range(3, 23)])
    network = qc.train(docs, both)
    rows = qc.score(docs, network).collect()
    assert len(rows) == len(hard_rows) and all(0 <= r.score <= 1 for r in rows)
    kept = qc.accepted(docs, network, 0.7)
    assert kept.schema == docs.schema and kept.count() == sum(r.score >= 0.7 for r in rows)
    for train, score in ((toxicity.train, toxicity.score), (qc.train, qc.score)):
        assert score(frame([]), train(frame([]), both)).count() == 0


def test_word_vectors_are_sums_over_all_texts(frame):
    """The same table from any number of tasks."""
    rows = [(i, f"the {w} runs over the hill with {w}s and more") for i, w in enumerate("dog cat horse bird fox hen".split() * 5)]
    one, many = (qc.word_vectors(frame(rows, n)) for n in (1, 6))
    assert np.allclose(one, many, atol=1e-5) and np.abs(one).sum() > 0
    table = np.zeros((qc.ROWS, qc.PLACES))
    for _, text in rows:
        words = qc.words_of(text)
        index = qc._BY_WORD[words.row] + qc._BY_SHAPE[words.shape]
        for i, row in enumerate(words.row):
            for j in (i - 1, i + 1):
                if 0 <= j < len(index):
                    table[row] += index[j]
    norm = np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)
    assert np.allclose(table / norm, one, atol=1e-5)


def test_pooling_of_long_texts_in_blocks(monkeypatch):
    table = np.random.default_rng(1).normal(size=(qc.ROWS, qc.PLACES)).astype(np.float32)
    text = "some words that go on\nand on " * 200
    whole = qc.pooled(text, table)
    monkeypatch.setattr(qc, "_blocks", lambda t: [t[:2900], t[2900:]])
    assert np.allclose(whole[: 4 * qc.PLACES], qc.pooled(text, table)[: 4 * qc.PLACES])


def test_temperature_calibrates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 5))
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    network = qc.fit(x, y, np.zeros((1, 1)))
    p = network.probability(x)
    assert abs(p.mean() - y.mean()) < 0.05
    for low in (0.1, 0.4, 0.7):
        inside = (p >= low) & (p < low + 0.2)
        assert abs(p[inside].mean() - y[inside].mean()) < 0.12


def test_documents_reader(llm):
    assert documents(llm, SF_DIR + "/").count() == 10_000
