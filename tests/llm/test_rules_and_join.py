"""Quality rules and the n-gram join against plain versions, and both against SQL."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle_check
from relaylog.llm import ngram_join, quality_rules, queries, sql
from relaylog.llm.common import word_hashes
from relaylog.llm.ngram_join import Similarity

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_rules(rows, limits):
    def lines(text):
        return [x for x in (" ".join(WORD.findall(y.lower())) for y in text.split("\n")) if x]

    docs = [(i, t or "", s or "", lines(t or "")) for i, t, s in rows]
    texts = {(host, text): set(own) for _, text, host, own in docs}
    carriers = {}
    for (host, text), own in texts.items():
        for line in own:
            carriers.setdefault((host, line), []).append(text)
    candidates = {key for key, found in carriers.items() if len(found) > limits.min_documents}
    anchors, votes = {}, Counter()
    for (host, text), own in texts.items():
        rest = [x.split(" ") for x in own if (host, x) not in candidates]
        n_rest = sum(len(x.split(" ")) for x in lines(text) if (host, x) not in candidates)
        if n_rest < 5 or len(rest) == len(own):
            continue
        windows = [" ".join(x[k : k + 5]) for x in rest for k in range(max(1, len(x) - 4))]
        hashes = [hashlib.md5(w.encode()).hexdigest()[:16] for w in windows]
        back = [h[::-1] for h in hashes]
        anchors[host, text] = list(enumerate([min(hashes), max(hashes), min(back), max(back)]))
        votes.update((host, a) for a in anchors[host, text])

    def document(host, text):
        return min(anchors.get((host, text), [None]), key=lambda a: (-votes[host, a], a))

    gone = {(host, line) for host, line in candidates if len({document(host, t) for t in carriers[host, line]}) > limits.min_documents}
    out = []
    for i, text, host, own in docs:
        words = WORD.findall(text)
        windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        repeated = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
        real = [x for x in text.split("\n") if WORD.search(x)]
        removed = sum(len(x.split(" ")) for x in own if (host, x) in gone)
        failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
        left = len(words) - removed
        kept = not failed and left >= limits.min_words and left >= limits.min_share * len(words)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        out.append((i, len(words), sum(map(len, words)), symbols, len(real) - len(set(real)), len(repeated), failed, removed, kept))
    return out, gone


NOTES = [
    "All rights reserved by us", "Read more here and there", "Share this page with friends", "Terms of use may apply", "Back to the first page"
]


def rule_rows(hard_rows):
    rng = random.Random(3)
    rows = [(*r, "hard") for r in hard_rows]
    for i in range(60):
        own = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(5, 25))) for _ in range(rng.randint(0, 3))]
        notes = [NOTES[i % 5], NOTES[(i + 1) % 5].upper().replace(" ", "  ")][: i % 3]
        rows.append((100 + i, "\n".join([*notes, *own]), ["a", "b", None][i % 2 if i % 7 else 2]))
    copied = "\n".join(" ".join(f"c{rng.randrange(900)}" for _ in range(n)) for n in (12, 30, 9))
    rows += [(300 + i, copied + f"\nseen by {i} people", "a") for i in range(40)]
    rows += [(402, "\n".join(NOTES), "a"), (403, "\n".join(NOTES), "other"), (400, "All rights reserved by us\n" * 6, "a"), (401, "one two | three <b> # $ % & *\n" * 9, "a")]
    return rows


def test_rules_against_a_plain_version(frame, hard_rows):
    limits = quality_rules.Limits(min_documents=4)
    rows = rule_rows(hard_rows)
    want, gone = plain_rules(rows, limits)
    assert gone and any(not w[6] and not w[-1] for w in want) and any(w[7] and w[-1] for w in want)
    got = quality_rules.quality_rules(frame(rows), limits=limits)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words", "kept"]
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, want))
    # The group of copies keeps its own lines.
    assert all(w[-1] for w in want if isinstance(w[0], int) and 300 <= w[0] < 340)


def test_clean_takes_lines_and_documents_away(frame, hard_rows):
    limits = quality_rules.Limits(min_documents=4)
    rows = rule_rows(hard_rows)
    want, gone = plain_rules(rows, limits)
    docs = frame(rows)
    cleaned = quality_rules.clean(docs, limits=limits)
    assert cleaned.schema == docs.schema
    expected = Counter()
    for (i, text, host), w in zip(rows, want, strict=True):
        if w[-1]:
            kept = [x for x in text.split("\n") if (host or "", " ".join(WORD.findall(x.lower()))) not in gone]
            expected[i, "\n".join(kept), len("\n".join(kept)), host] += 1
    assert Counter((r.doc_id, r.text, r.n_chars, r.source) for r in cleaned.collect()) == expected
    assert quality_rules.clean(frame([])).count() == 0
    assert quality_rules.quality_rules(frame([])).count() == 0


@pytest.mark.parametrize(("host_size", "own_words"), [(300, 9), (2000, 20), (6000, 30)])
def test_a_long_notice_goes_from_every_document_however_large_the_host(frame, host_size, own_words):
    """A notice longer than what else its documents hold goes beside another common line; a group of edited copies keeps its text."""
    rng = random.Random(host_size)

    def words(n, mark):
        return " ".join(f"{mark}{rng.randrange(10**6)}" for _ in range(n))

    notice, footer, page = words(60, "n"), words(8, "f"), [words(n, "p") for n in (40, 40, 40)]
    rows = [(i, f"{words(own_words, 'o')}\n{notice}\n{footer}\n{words(own_words, 'o')}", "a") for i in range(60)]
    rows += [(100 + i, words(25, "x"), "a") for i in range(host_size)]
    for i in range(300):
        copy = list(page)
        edited = copy[i % 3].split(" ")
        edited[rng.randrange(40)] = words(1, "e")
        copy[i % 3] = " ".join(edited)
        rows.append((10_000 + i, "\n".join(copy), "a"))
    got = {r.doc_id: r for r in quality_rules.quality_rules(frame(rows)).collect()}
    assert all(got[i].removed_words == 68 and got[i].kept == (own_words >= 20) for i in range(60))
    assert all(r.kept and r.removed_words == 0 for i, r in got.items() if i >= 100)


def test_clean_keeps_columns_of_any_name(frame):
    docs = frame([(i, f"{'same line here again ' * 3}\n{' '.join(f'w{i}x{j}' for j in range(30))}", "a") for i in range(25)])
    docs = docs.withColumn("Text key", F.lit("x")).withColumn("kept", F.lit(5)).withColumn("gone", F.lit("y")).withColumn("doc", F.lit(None).cast("int"))
    got = quality_rules.clean(docs)
    assert got.schema.names == docs.schema.names
    assert all(r.kept == 5 and r.gone == "y" and r.doc is None and "same line" not in r.text for r in got.collect()) and got.count() == 25


def test_word_hashes_of_blocks(monkeypatch):
    data = b" ".join(b"word%d" % (i * 7919 % 1000) for i in range(5000)) + b" " + b"z" * 9000 + b" end\n"
    whole = word_hashes(data)
    monkeypatch.setattr("relaylog.llm.common._BLOCK", 1000)
    assert np.array_equal(word_hashes(data), whole) and len(whole) == 5002


# -- the join -------------------------------------------------------------------------------------------------------


def plain_join(rows, rule=Similarity()):  # noqa: B008
    sets = []
    for _, text in rows:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
        n = min(rule.words, len(words))
        sets.append({tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rule.den * len(sets[i] & sets[j]) >= rule.num * len(sets[i] | sets[j]):
                links += 1
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        mates = [rows[j][0] for j in range(len(rows)) if sets[j] and root(j) == root(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), (min(mates) if mates else None) if sets[i] else doc_id))
    return out, links


def near_rows(seed, bases=12, copies=9):
    """Families of texts with edits around the threshold, sharing a passage; sizes from a word to hundreds."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(50)]
    rows, n = [], 0
    for _ in range(bases):
        base = [f"v{rng.randrange(3000)}" for _ in range(rng.choice([1, 3, 4, 5, 6, 9, 17, 40, 80, 150, 300]))]
        if rng.random() < 0.5:
            at = rng.randrange(len(base) + 1)
            base[at:at] = passage
        for _ in range(rng.randrange(1, copies)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, len(words) // 25, len(words) // 12])):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
            words = words[: len(words) - rng.choice([0, 0, 1, len(words) // 6])]
            rows.append((n * 7 % 1009, rng.choice([" ", "\n", "  "]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
            n += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_join_against_a_plain_version(frame, seed):
    rows = near_rows(seed, bases=30)
    want, links = plain_join(rows)
    assert links > 10
    assert Counter(map(tuple, ngram_join.ngram_components(frame(rows)).collect())) == Counter(want)


@pytest.mark.parametrize("seed", range(300))
def test_linked_documents_share_a_key(seed):
    """Whatever counts as frequent, and in fine and coarse sketches."""
    rng = random.Random(seed)
    rule = Similarity()
    n = rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 31, 32, 60, 64, 70, 100, 127, 128, 200, 255, 256, 300, 600])
    pool = np.array([rng.getrandbits(64) for _ in range(3 * n + 10)], np.uint64)
    a = set(pool[:n].tolist())
    b = set(a)
    frequent = np.array([rng.random() < rng.choice([0, 0.3, 1]) for _ in range(1 << 18)])
    for x in rng.sample(sorted(a), min(len(a) - 1, rng.randint(0, max(1, n // 6)))):
        b.discard(x)
    b |= set(pool[n : n + rng.randint(0, max(1, n // 5))].tolist())
    both = [np.array(sorted(s), np.uint64) for s in (a, b)]
    linked = rule.den * len(a & b) >= rule.num * len(a | b)
    for fine in (True, False):
        own = [ngram_join.keys(s, rule, frequent, fine) for s in both]
        if linked and all(k is not None for k in own):
            assert set(own[0].tolist()) & set(own[1].tolist())
        assert not fine or all(k is not None for k in own)


def test_sketches_differ_in_no_more_words_than_sets():
    rng = np.random.default_rng(2)
    frequent = np.zeros(1 << 18, bool)
    for _ in range(50):
        pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        a, b = np.unique(pool[:300]), np.unique(pool[rng.integers(5, 60) : 320])
        left, right = (dict(zip(*(x.tolist() for x in ngram_join.sketch(s, 96, frequent)[:2]), strict=True)) for s in (a, b))
        apart = sum(left.get(k) != right.get(k) for k in left.keys() | right.keys())
        assert apart <= len(np.setxor1d(a, b))


def test_bit_sketches_rule_out_no_link():
    rng = random.Random(6)
    rule = Similarity()
    ruled_out = 0
    for _ in range(400):
        n = rng.choice([1, 2, 5, 30, 64, 65, 128, 200, 513, 1000])
        pool = np.array([rng.getrandbits(64) for _ in range(2 * n + 10)], np.uint64)
        a, b = pool[:n], pool[rng.randint(0, n // 3) : n + rng.randint(0, n // 4)]
        x, y = (ngram_join.parity_bits(s) for s in (a, b))
        to = 8 * min(len(x), len(y))
        bits = [ngram_join._folded(int.from_bytes(s, "little"), 8 * len(s), to) for s in (x, y)]
        shared = len(np.intersect1d(a, b))
        assert (bits[0] ^ bits[1]).bit_count() <= len(a) + len(b) - 2 * shared
        linked = len(b) and rule.den * shared >= rule.num * (len(a) + len(b) - shared)
        passed = ngram_join.may_link(x, len(a), y, len(b), rule)
        assert passed or not linked
        ruled_out += not passed
    assert ruled_out > 100


def test_large_keys_are_compared_in_blocks(frame, monkeypatch):
    rows = near_rows(12, bases=20)
    monkeypatch.setattr(ngram_join, "_BLOCK", 2)
    for rounds in (0, 1):
        got = ngram_join.ngram_components(frame(rows), star_rounds=rounds)
        assert Counter(map(tuple, got.collect())) == Counter(plain_join(rows)[0])


def test_join_edges(frame, hard_rows):
    want, _ = plain_join(hard_rows)
    assert Counter(map(tuple, ngram_join.ngram_components(frame(hard_rows)).collect())) == Counter(want)
    assert ngram_join.ngram_components(frame([])).count() == 0
    assert ngram_join.ngram_components(frame([(1, None), (2, "")])).count() == 2


def test_weak_sketches_fall_back(frame, monkeypatch):
    """With far too narrow sketches the join takes a word for each shingle, with the same result."""
    rows = near_rows(9, bases=25)
    monkeypatch.setattr(ngram_join, "_width", lambda band: 3 if band >= 6 else 0)
    assert Counter(map(tuple, ngram_join.ngram_components(frame(rows)).collect())) == Counter(plain_join(rows)[0])


def test_chains_close_without_star_rounds(frame):
    """A chain of texts that each link with the next only; and every pair met in the last round."""
    words = [f"u{k}" for k in range(300)]
    rows = [(50 - i, " ".join(words[9 * i : 9 * i + 120])) for i in range(20)]
    want, links = plain_join(rows)
    assert links >= 19 and len({w[2] for w in want}) == 1
    for rounds in (0, 3):
        got = ngram_join.ngram_components(frame(rows), star_rounds=rounds)
        assert Counter(map(tuple, got.collect())) == Counter(want)


def test_keep_first(frame, hard_rows):
    rows = hard_rows + [(i + 100, t) for i, t in near_rows(4)]
    docs = frame(rows)
    kept = ngram_join.keep_first(docs)
    assert kept.schema == docs.schema
    want, _ = plain_join(rows)
    got = Counter(r.doc_id for r in kept.collect())
    expected = Counter(w[2] for w in {w for w in want if w[1] and w[2] is not None} if w[0] == w[2])
    alone = Counter(w[0] for w in want if not w[1] or w[2] is None)
    assert got == expected + alone
    assert ngram_join.keep_first(frame([])).count() == 0


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(sql.all_sql()))
def test_same_rows_as_sql(llm, con, name):
    assert oracle_check.compare(llm, con, name, queries.all_queries()[name], sql.all_sql()[name], SF_DIR) == ""
