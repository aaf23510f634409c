"""The pipeline, stage by stage, against plain versions of its decisions."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from test_rules_and_join import plain_join, plain_rules
from test_tokens import ids

import corpus_pipeline
from relaylog.llm import quality_classifier as qc
from relaylog.llm import quality_rules, queries
from relaylog.llm.common import documents
from relaylog.session import shared_dir

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(llm):
    """What went into each stage and what came out."""
    docs, out = documents(llm, SF_DIR), []
    for name, stage in corpus_pipeline.STAGES:
        path = shared_dir(llm, "test-stage")
        stage(llm, docs, SF_DIR).write.parquet(path)
        result = llm.read.parquet(path)
        out.append((name, docs, result))
        docs = result
    return out


def test_stages_in_order(stages):
    assert [s[0] for s in stages] == ["quality rules", "quality classifier", "n-gram Jaccard join", "secret scans", "best-fit packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and 0 < after.count() <= before.count()


def test_quality_rules_stage(stages):
    _, before, after = stages[0]
    rows = before.collect()
    want, gone = plain_rules([(r.doc_id, r.text, r.source) for r in rows], quality_rules.Limits())
    assert Counter(r.doc_id for r in after.collect()) == Counter(w[0] for w in want if w[-1])


def test_quality_classifier_stage(llm, stages):
    _, before, after = stages[1]
    network = qc.train(before, llm.read.parquet(f"{SF_DIR}/labels.parquet"))
    x = [(r, network.probability(qc.pooled(r.text, network.table)[None])[0]) for r in before.collect()]
    kept = Counter(after.collect())
    for row, p in x:
        if abs(p - queries.ACCEPTED) > 0.02:  # sums of floats differ in their last digits
            assert (row in kept) == (p >= queries.ACCEPTED)


def test_join_stage(stages):
    _, before, after = stages[2]
    want, links = plain_join([(r.doc_id, r.text) for r in before.collect()])
    assert links
    assert Counter(r.doc_id for r in after.collect()) == Counter(w[0] for w in want if w[0] == w[2])


def test_secret_stage(stages):
    _, before, after = stages[3]
    assert before.count() == after.count()
    texts = {r.doc_id: r.text for r in before.collect()}
    changed = 0
    for r in after.collect():
        clean = re.sub(r"\[(live|example) secret\]", "", r.text)
        changed += r.text != texts[r.doc_id]
        assert not re.search(r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", clean)
        assert r.n_chars == len(r.text)
    assert changed


def test_packing_stage(stages):
    _, before, after = stages[4]
    pieces, rooms = {}, {}
    for r in after.collect():
        pieces.setdefault(r.doc_id, []).append(r)
        rooms.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for row in before.collect():
        own = np.array([*ids(row.text), queries.END_ID], "<u4")
        for r in pieces[row.doc_id]:
            assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        assert sum(r.length for r in pieces[row.doc_id]) == len(own)
    for parts in rooms.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= queries.SEQUENCE_TOKENS


def test_run_gives_the_last_stage(llm, stages):
    got = corpus_pipeline.run(llm, SF_DIR)
    names = ["doc_id", "piece", "start", "length"]
    # Scores of single documents next to the threshold may differ between two fits.
    own, other = ({tuple(r) for r in df.select(*names).collect()} for df in (got, stages[-1][2]))
    assert len(own ^ other) <= 0.02 * len(other)
