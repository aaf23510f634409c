import random

import pytest

from relaylog.llm.common import prepared

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, label string, part int"


@pytest.fixture(scope="session")
def llm(spark):
    return prepared(spark)


@pytest.fixture(scope="session")
def frame(llm):
    """A documents table from (doc_id, text) or (doc_id, text, source), with columns whose names operators use inside."""

    def make(rows, partitions=3):
        full = []
        for row in rows:
            doc_id, text, source = (*row, "s0")[:3]
            full.append((doc_id, text, None, source, None if text is None else len(text), "r", None, "l", 1))
        df = llm.createDataFrame(full, SCHEMA)
        return df.repartition(partitions) if full else df

    return make


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls, empty and very long texts, repeated rows, ties of doc_id, marks, and several scripts."""
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "d", "état", "ñandú", "über", "一二三", "x1y2", "tail."]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    same = text(40)
    return [
        (7, text(30)), (3, same), (3, same), (3, text(12)), (None, text(25)), (11, None), (12, ""), (13, " \n\t "),
        (14, "one"), (15, text(30_000)), (16, "a" * 60_000), (17, same), (18, "  two  spaces \n end "), (19, "line\nline\nline"),
        (20, "\x1c\x85 odd spaces here"), (21, "😀 emoji 👍🏽 text"), (22, same + " more words at the end of it"),
    ]
