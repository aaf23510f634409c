"""Tool calls, syncmer fingerprints and secret scans against plain versions."""

import hashlib
import json
import random
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from relaylog.llm import chat, secret_scan, syncmers

# -- tool calls -----------------------------------------------------------------------------------------------------

SCHEMAS = {
    "find": {"type": "object", "required": ["q"], "properties": {"q": {"type": "string", "minLength": 1}, "n": {"type": "integer", "maximum": 5}}, "additionalProperties": False},
    "list": {"type": "object", "properties": {"ids": {"type": "array", "items": {"type": ["integer", "null"]}}}},
}
MESSAGES = f"conv_id long, turn long, role string, text string, calls {chat.CALLS}, result_of string, after string, row string, depth int"


def messages(llm, rows):
    return llm.createDataFrame([(*r, "x", 1) for r in rows], MESSAGES)


def call(i, name="find", arguments='{"q":"a"}'):
    return (i, name, arguments)


def test_links_and_order(llm):
    rows = [
        (1, 0, "user", "hello", None, None, None),
        (1, 1, "tool", "early result", None, "b", None),
        (1, 2, "assistant", None, [call("a"), call("z")], None, None),
        (1, 3, "assistant", None, [call("b")], None, "a"),
        (1, 4, "tool", "result a", None, "a", None),
        (1, 5, "tool", "again a", None, "a", None),
        (1, 6, "tool", "nobody asked", None, "q", None),
        (1, 7, "assistant", None, [call("a")], None, None),
        (2, 0, "tool", "other conversation", None, "a", None),
        (3, 0, "assistant", None, [call("c")], None, "c"),
        (3, 1, "tool", "cycle", None, "c", None),
        (None, 0, "assistant", None, [call(None)], None, None),
        (4, None, None, None, None, None, None),
    ]
    got = chat.link_calls(messages(llm, rows), SCHEMAS).collect()
    by = {(r.conv_id, r.turn): r for r in got}
    assert len(got) == len(rows)
    first = sorted((r for r in got if r.conv_id == 1), key=lambda r: (r.sort_turn, r.depth, r.turn))
    assert [r.turn for r in first] == [0, 2, 4, 3, 1, 5, 6, 7]
    results = {k: r.result for k, r in by.items() if r.result}
    assert results == {(1, 1): "linked", (1, 4): "linked", (1, 5): "repeated", (1, 6): "without call", (2, 0): "without call", (3, 1): "linked"}
    assert (by[1, 2].n_calls, by[1, 2].n_unanswered, by[1, 2].n_repeated) == (2, 1, 0)
    assert by[1, 7].n_repeated == 1
    assert [by[3, t].cyclic for t in (0, 1)] == [True, True] and not by[1, 3].cyclic
    assert [by[3, t].sort_turn for t in (0, 1)] == [0, 1]
    assert by[4, 0].message == '{"content":null,"role":null}'


def test_long_chains_keep_order(llm):
    """Every call needs the result of the one after it: the whole conversation turns round."""
    n = 40
    rows = []
    for i in range(n):
        rows.append((1, 2 * i, "assistant", None, [call(f"c{i}")], None, f"c{i + 1}"))
        rows.append((1, 2 * i + 1, "tool", "x", None, f"c{i}", None))
    got = chat.link_calls(messages(llm, rows), SCHEMAS).collect()
    order = [r.turn for r in sorted(got, key=lambda r: (r.sort_turn, r.depth, r.turn))]
    assert order == [t for i in reversed(range(n)) for t in (2 * i, 2 * i + 1)]


@pytest.mark.parametrize(
    ("arguments", "name", "error"),
    [
        ('{"q":"a","n":5}', "find", None),
        ('{"n":5.0,"q":"ü"}', "find", None),
        ('{"q":""}', "find", "$.q: wrong length"),
        ('{"q":"a","n":6}', "find", "$.n: out of range"),
        ('{"q":"a","n":true}', "find", "$.n: not of type integer"),
        ('{"n":1}', "find", "$: q is missing"),
        ('{"q":"a","x":1}', "find", "$: x is unknown"),
        ('{"ids":[1,null,2.5]}', "list", "$.ids[2]: not of type ['integer', 'null']"),
        ("{}", "other", "unknown tool"),
        ("[1]", "find", "arguments are no object"),
        ('{"q":NaN}', "find", "arguments are no JSON"),
        ('{"q"', "find", "arguments are no JSON"),
        (None, "find", "arguments are no JSON"),
        ("[" * 100_000, "find", "arguments are no JSON"),
        ('{"q":1e999}', "find", "arguments are no JSON"),
    ],
)
def test_arguments(arguments, name, error):
    assert chat.parsed_arguments(arguments, name, SCHEMAS)[1] == error


def test_canonical_json():
    assert chat.canonical(json.loads('{ "b" : [1.0, 2.50, "é\\u0041"], "a": {"z":null,"y":true} }')) == '{"a":{"y":true,"z":null},"b":[1,2.5,"éA"]}'


def test_derived_calls(llm):
    turns = llm.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "one two"), (1, 2, "assistant", "yes"), (1, 3, "user", None), (2, 0, "assistant", "alone")],
        "conv_id long, turn long, role string, text string",
    )
    got = {(r.conv_id, r.turn): r for r in chat.link_calls(chat.turns_as_calls(turns), chat.ASK).collect()}
    assert got[1, 2].result == "linked" and got[2, 0].result == "without call"
    assert got[1, 1].errors == "" and got[1, 3].errors == "t3: $: question is missing" and got[1, 3].n_unanswered == 1
    assert '"arguments":{"question":"one two","words":2}' in got[1, 1].message
    assert chat.link_calls(chat.turns_as_calls(turns.limit(0)), chat.ASK).count() == 0


# -- fingerprints ---------------------------------------------------------------------------------------------------


def test_fingerprints(frame, hard_rows):
    rows = hard_rows + [(1000 + i, " ".join(f"t{(i * j * j) % 991}" for j in range(5 + 3 * i))) for i in range(40)]
    got = syncmers.fingerprints(frame(rows)).collect()
    assert len(got) == len(rows)
    by_text = {}
    ids = [r[0] for r in rows]
    single = sorted((r for r in rows if ids.count(r[0]) == 1 and r[0] is not None), key=lambda r: r[0])
    found = {r.doc_id: r for r in got if ids.count(r.doc_id) == 1}
    after = dict(zip([r[0] for r in single], single[1:], strict=False))
    for doc_id, text in single:
        r, text = found[doc_id], text or ""
        assert r.n_chars == len(text) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        if doc_id in after and doc_id != 3 and doc_id >= 11:
            half, following = len(text) // 2, after[doc_id][1] or ""
            edited = text[: len(text) - half] + following[:half]
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert by_text.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
            assert (r.all_near_edited == 1) == (edited == text) or len(text) < 12
            assert r.near_edited == 1 or edited != text
    assert len(set(by_text.values())) == len(by_text)
    # Null ids come first, so the last document's next is the one without an id.
    last, first = single[-1], next(r for r in rows if r[0] is None)
    edited = last[1][: len(last[1]) - len(last[1]) // 2] + first[1][: len(last[1]) // 2]
    assert found[last[0]].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def plain_fingerprint(text):
    """Closed syncmers one by one: the k-mers whose least inner run is their first or last one."""
    def h(seed, *values):
        for v in values:
            seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed % (1 << 64))
            seed -= (seed >> 63) << 64
        return seed

    units = re.findall("[^ aeiouAEIOU\x80-\U0010ffff]{0,5}[ aeiouAEIOU\x80-\U0010ffff]|[^ aeiouAEIOU\x80-\U0010ffff]{1,6}", re.sub(r"\s+", " ", text, flags=re.A))
    units = [h(42, u) for u in units]
    if units:
        units = [h(42, "")] * 9 + units + [h(42, "")] * 9
    found = set()
    for i in range(len(units) - 9):
        runs = [h(42, *units[i + j : i + j + 7]) for j in range(4)]
        if min(runs) in (runs[0], runs[-1]):
            found.add(h(42, runs[0], runs[-1]))
    hashes = sorted(found) or [h(42, text, 0)] if text else [None]
    low = sum(x is not None and x < -(1 << 63) + (1 << 62) for x in hashes)
    return hashes[: max(low, 128)]


def plain_likeness(a, b):
    a, b = ([x[i : i + 16] for i in range(0, len(x), 16)] for x in (a, b))
    a, b = ([int(x, 16) - ((int(x, 16) >> 63) << 64) for x in side] for side in (a, b))
    cut = min([x[-1] for x in (a, b) if len(x) >= 128], default=1 << 63)
    a, b = ({x for x in side if x <= cut} for side in (a, b))
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0


def test_fingerprints_against_a_plain_version(frame):
    """Every anchor is recomputed, and both likenesses follow from the fingerprints alone."""
    rng = random.Random(12)
    letters = "abcdefgh stuv  xyzé漢,.\n"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.choice([1, 7, 60, 500, 2500])))) for i in range(40)]
    rows += [(50 + i, rows[i][1] + " some more at the end") for i in range(40)]
    got = sorted(syncmers.fingerprints(frame(rows)).collect(), key=lambda r: r.doc_id)
    for r, (_, text), following in zip(got, rows, [*got[1:], got[0]], strict=True):
        assert r.fingerprint == "".join(f"{x % (1 << 64):016X}" for x in plain_fingerprint(text))
        assert abs(r.near_edited - plain_likeness(r.fingerprint, r.edited_fingerprint)) < 1e-12
        assert abs(r.near_next - plain_likeness(r.fingerprint, following.fingerprint)) < 1e-12


def test_anchors_of_joined_texts_are_those_of_the_whole(llm):
    """With white space, long runs without an end of a unit, and nothing on either side of the joint."""
    rng = random.Random(9)
    signs = ["bcdfgh stuv aeio xyzé漢,.\n\t ", "bcdfg12345", " \n\t", "bcdfghjklm a"]
    text = lambda: "".join(rng.choice(rng.choice(signs[:1] + signs)) for _ in range(rng.choice([0, 1, 2, 9, 40, 300])))
    plain = lambda n: "".join(rng.choice(signs[1]) for _ in range(n))
    rows = [(text(), text(), rng.random(), rng.random()) for _ in range(300)]
    rows += [(plain(70), plain(n) + text(), 0.5, 1.0) for n in (0, 5, 6, 7, 12, 70)] + [(text() + "  ", "\n " + plain(80) + "a" + text(), 1.0, 1.0)]
    rows = [(a, b, a[: int(len(a) * x)], b[: int(len(b) * y)]) for a, b, x, y in rows]
    df = llm.createDataFrame(rows, "a string, b string, l string, r string").withColumn("whole", F.concat("l", "r"))
    for c in ("a", "b", "whole"):
        df = syncmers.with_anchors(df, c, f"{c}_anchors", f"{c}_marks")
    df = syncmers.with_joined_anchors(df, "l", "r", "joined", "a_marks", "b_marks")
    assert df.filter("joined != whole_anchors").collect() == []
    assert df.count() == len(rows)


def test_next_document_over_many_ranges(llm):
    rng = random.Random(4)
    ids = sorted(rng.sample(range(-(10**12), 10**12), 500) + [5, 5, 5])
    df = llm.createDataFrame([(i, f"{i}-{n}") for n, i in enumerate(ids)], "key long, t string").withColumn("tie", F.xxhash64("t")).repartition(5)
    bounds = syncmers.range_bounds(df, "key")
    assert len(bounds) > 20
    got = syncmers.with_next(df, "key", "tie", ["key", "t"], bounds).orderBy("key", "tie").collect()
    assert [r.next_t for r in got] == [r.t for r in got[1:]] + [got[0].t]


def test_fingerprints_of_few_documents(frame):
    assert syncmers.fingerprints(frame([])).count() == 0
    (only,) = syncmers.fingerprints(frame([(4, "just one text here")])).collect()
    assert only.near_next == 1 and only.edited_sha256 == hashlib.sha256(b"just one just one ").hexdigest()


@pytest.mark.parametrize("length", [32, 400])
def test_likeness_has_no_step(frame, length):
    """Two texts that differ by a few characters are as alike across 32 and 400 characters as on either side."""
    text = " ".join(f"{w}{i}" for i, w in enumerate("some plain words that go on and on over the hill".split() * 10))
    for shorter in (length - 5, length - 2, length + 1):
        got = {r.doc_id: r for r in syncmers.fingerprints(frame([(1, text[:shorter]), (2, text[: shorter + 3])])).collect()}
        assert got[1].near_next == got[2].near_next > (0.3 if length < 100 else 0.9)


def test_long_texts_keep_what_they_share(frame):
    """Two long texts that share about 1 % are a little alike, and their fingerprints grow with them."""
    rng = random.Random(6)
    own = [" ".join(f"{rng.choice('bcdfg')}{rng.randrange(10**6)}" for _ in range(8000)) for _ in range(2)]
    shared = " ".join(f"m{rng.randrange(10**6)}" for _ in range(80))
    rows = [(i, f"{text} {shared} {text[::-1]}") for i, text in enumerate(own)]
    for r in syncmers.fingerprints(frame(rows)).collect():
        assert 0.002 < r.all_near_next < 0.02 and abs(r.near_next - r.all_near_next) < 0.01
        assert len(r.fingerprint) > 16 * 500


def test_anchors_do_not_depend_on_what_is_around(frame):
    shared = [f"w{i * i % 677}" for i in range(60)]
    rows = [(1, " ".join(["x"] * 7 + shared)), (2, " ".join(shared + ["y"] * 9)), (3, " ".join(["z"] * 30))]
    found = {}
    for r in syncmers.anchors(frame(rows)).collect():
        found.setdefault(r.doc_id, {}).setdefault(r.hash, []).append(r.position)
    inside = {h for h, at in found[2].items() if all(p + 5 <= 60 for p in at)}
    assert inside and inside <= set(found[1])
    assert {found[1][h][0] - found[2][h][0] for h in inside if len(found[1][h]) == len(found[2][h]) == 1} == {7}
    positions = sorted(p for h in inside for p in found[2][h])
    assert max(b - a for a, b in zip(positions, positions[1:], strict=False)) <= 3  # k - s in a row hold an anchor


# -- secrets --------------------------------------------------------------------------------------------------------

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
HEX32, KEY = "0123456789abcdef" * 2, "AKIA" + "ABCDEFGH12345678"
LONG = "aB3" * 12


def base_spans(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def secret_rows(hard_rows):
    rng = random.Random(8)
    bits = [
        "Token : abc12", "token: token: longer_value", "PASSWORD='x.y=z-1'", "é secret = ", HEX32, KEY, "AKIASHORT AKIA", "api_key=", "apikey:\"Zz99/+\"",
        "deadbeef", "\n", "😀", LONG, "plain words", "ghp_" + "a1" * 20, "passwd=password=abc", "f" * 24, "f" * 23,
    ]
    rows = [(*r, "hard") for r in hard_rows]
    rows += [(100 + i, " ".join(rng.choices(bits, k=rng.randint(0, 12))), rng.choice(["a", "b", "c", None])) for i in range(80)]
    return rows + [(500, (HEX32 + " ") * 400, "a"), (501, HEX32 + "\n" + KEY, "b"), (501, HEX32 + "\n" + KEY, "b")]


def test_base_spans(frame, hard_rows):
    rows = secret_rows(hard_rows)
    got = secret_scan.secret_spans(frame(rows)).collect()
    want = []
    for doc_id, text, _ in rows:
        spans = base_spans(text or "")
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
        want.append((doc_id, *(sum(x[1] == k for x in spans) for k in range(3)), hashlib.sha256(joined.encode()).hexdigest()))
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == Counter(want)
    for r in got:
        spans = [x for x in r.spans.split(",") if x]
        base = ",".join(x for x in spans if not x.startswith("issued"))
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256
        assert len(spans) == r.n_assign + r.n_access + r.n_hex + r.n_issued == r.n_live + r.n_examples
    assert secret_scan.secret_spans(frame([])).count() == 0


def test_ownership_separates_examples(frame):
    """A value of many owners is an example; one of a single owner with many documents is not."""
    rows = [(i, f"token={HEX32}", f"owner{i % 5}") for i in range(20)] + [(100 + i, f"use {LONG} now", "one") for i in range(30)]
    rows += [(200 + i, "try ghp_" + "z2" * 20, f"owner{i}") for i in range(4)]
    got = {r.doc_id: r for r in secret_scan.secret_spans(frame(rows)).collect()}
    assert (got[0].n_live, got[0].n_examples, got[0].spans) == (0, 2, "assign:0:38,hex:6:38")
    assert (got[100].n_live, got[100].n_issued, got[100].spans) == (1, 1, "issued:4:40")
    assert (got[200].n_issued, got[200].n_issued_examples, got[200].spans) == (1, 1, "issued:4:48")


def test_redacted(frame, hard_rows):
    rows = secret_rows(hard_rows)
    docs = frame(rows)
    got = secret_scan.redacted(docs)
    assert got.schema.names == docs.schema.names
    spans = {(r.doc_id, r.base_sha256): r.spans for r in secret_scan.secret_spans(docs).collect()}
    want = Counter()
    for doc_id, text, source in rows:
        base = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in base_spans(text or ""))
        out, at = [], 0
        merged = []
        for name in filter(None, spans[doc_id, hashlib.sha256(base.encode()).hexdigest()].split(",")):
            start, end = map(int, name.split(":")[1:])
            if merged and start < merged[-1][1]:
                merged[-1][1] = max(end, merged[-1][1])
            else:
                merged.append([start, end])
        for start, end in merged:
            out.append(text[at:start])
            at = end
        want[doc_id, source, None if text is None else "[]".join([*out, text[at:]])] += 1
    marks = re.compile(r"\[(?:live|example) secret\]")
    found = [(r.doc_id, r.source, None if r.text is None else marks.sub("[]", r.text)) for r in got.collect()]
    assert Counter(found) == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())
    assert not any(HEX32 in (r.text or "") or KEY in (r.text or "") for r in got.collect())


def test_issued_examples_are_listed_and_marked(llm, frame):
    """A leaked token that several sources quote keeps its span; the class only changes the mark."""
    token = "ghp_" + "z2" * 20
    docs = frame([(i, f"try {token} now", f"owner{i}") for i in range(3)] + [(9, f"use {LONG}", "one")])
    got = {r.doc_id: r for r in secret_scan.secret_spans(docs).collect()}
    assert (got[0].n_issued_examples, got[0].spans, got[0].all_spans) == (1, "issued:4:48", "issued:4:48:example:3:3")
    assert (got[9].n_issued_examples, got[9].all_spans) == (0, "issued:4:40:live:1:1")
    texts = {r.doc_id: r.text for r in corpus_pipeline.secret_scan_stage(llm, docs, "").collect()}
    assert texts == {i: "try [example secret] now" for i in range(3)} | {9: "use [live secret]"}


def test_owners_against_a_plain_count(frame):
    """Classes by sets of owners and repositories, and columns of any name stay."""
    rng = random.Random(21)
    values = [f"{rng.getrandbits(128):032x}" for _ in range(12)]
    rows = [(i, f"x {rng.choice(values[: 1 + i % 12])} y", rng.choice("abcdef"), rng.choice(["r1", "r2", "r3"])) for i in range(150)]
    docs = frame([r[:3] for r in rows]).drop("lang")
    langs = docs.sparkSession.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, lang string")
    docs = docs.join(langs, "doc_id").withColumn("key", F.lit(1)).withColumn("runs", F.lit(2)).withColumn("Id", F.lit(3)).withColumn("from", F.lit(4))
    held = {}
    for _, text, owner, lang in rows:
        held.setdefault(text, set()).add((owner, lang))
    got = {r.doc_id: r for r in secret_scan.secret_spans(docs).collect()}
    for i, text, _, _ in rows:
        owners, pairs = len({o for o, _ in held[text]}), len(held[text])
        name = "live" if owners <= 2 and pairs <= 4 else "example"
        assert got[i].all_spans == f"hex:2:34:{name}:{owners}:{pairs}"
    marked = secret_scan.redacted(docs)
    assert marked.schema.names == docs.schema.names
    assert all((r.key, r.runs, r.Id, r["from"]) == (1, 2, 3, 4) and "secret]" in r.text for r in marked.collect())


def test_repositories_enter_the_verdict(frame):
    """Many repositories of one owner make an example too, many documents of one repository do not."""
    rows = [(i, f"token={HEX32}", "one") for i in range(10)] + [(100 + i, f"token={KEY}", "one") for i in range(10)]
    repository = F.when(F.col("doc_id") < 100, F.concat(F.lit("r"), F.col("doc_id"))).otherwise(F.lit("r"))
    got = {r.doc_id: r for r in secret_scan.secret_spans(frame(rows).withColumn("lang", repository)).collect()}
    assert got[0].all_spans == "assign:0:38:example:1:10,hex:6:38:example:1:10"
    assert got[100].all_spans == "assign:0:26:live:1:1,access:6:26:live:1:1"
