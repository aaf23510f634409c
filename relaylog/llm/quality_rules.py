"""Quality rules: figures of each text, and lines that stand on too many documents of a host.

A normalised line (lower case, single spaces) that more than ``min_documents`` different texts of a host carry is a
candidate. It is removed from the host's documents if more than ``min_documents`` different documents carry it. The limit
is absolute: it does not rise with the host. Texts that agree in what they hold besides candidates are one
document, so a page that is copied a thousand times with small edits does not make its own lines look like
boilerplate, while a notice on a thousand pages goes however long it is and whatever else they share with it.

Copies are told by four anchors of that rest: the five-word windows whose hashes are least, greatest, and least and greatest read
backwards. A document takes the anchor that most texts of its host have, so copies with unlike edits still meet. A rest of
fewer than five words tells no documents apart (the date of a copy, say): all such texts are one document.

A document is depleted if it keeps fewer than ``min_words`` words or less than ``min_share`` of its words.

The hot host and the hot line are counted in two steps, (host, line, document) and then (host, line), both with
aggregation before the shuffle; repeated texts are counted once. Texts are read once for the figures; only hashes are shuffled.

Words are runs of other than ASCII white space. A null or empty text has no words and fails the base rules. A null host
is a host of its own together with the empty one. Rows that repeat get the same verdict each. Other columns are
ignored, and kept by ``clean`` whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaylog.llm.common import _SPACE, map_batches, row_numbers, stored, text_column, window_hashes, word_hashes

_WINDOW, _SHINGLE = 8, 5
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """The production limits of the cross-document rule."""

    min_documents: int = 20
    min_words: int = 20
    min_share: float = 0.2


def text_figures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    data = text.encode()
    b = np.frombuffer(data, np.uint8)
    words = word_hashes(data)
    word_chars = np.count_nonzero(((b & 0xC0) != 0x80) & ~_SPACE[b])
    lines = [line for line in data.split(b"\n") if line.strip()]
    windows = window_hashes(words, _WINDOW)
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    repeated = 0
    if len(twice):
        starts = np.flatnonzero(np.isin(windows, twice))
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, starts, 1)
        np.add.at(depth, starts + _WINDOW, -1)
        repeated = np.count_nonzero(np.cumsum(depth)[:-1])
    return len(words), int(word_chars), int(np.count_nonzero(_SYMBOLS[b])), len(lines) - len(set(lines)), int(repeated)


def fails_base(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 20 or 100 * n_repeat_words > 30 * n_words


def normalised(line: str) -> bytes:
    return b" ".join(line.lower().encode().split())


def line_hash(line: bytes) -> int:
    """A signed 64-bit hash of a normalised line."""
    return xxhash.xxh3_64_intdigest(line) - (1 << 63)


def line_anchors(line: bytes) -> tuple[int, int, int, int]:
    """Least and greatest hash of the windows of a normalised line, then both of the hashes read backwards."""
    words = line.split(b" ")
    found = [hashlib.md5(b" ".join(words[i : i + _SHINGLE])).hexdigest()[:16] for i in range(max(1, len(words) - _SHINGLE + 1))]
    back = [h[::-1] for h in found]
    return tuple(int(h, 16) - (1 << 63) for h in (min(found), max(found), min(back), max(back)))


def text_lines(text: str) -> dict[bytes, int]:
    """Words of each distinct normalised line that has any, as often as it stands in the text."""
    counts: dict[bytes, int] = {}
    for line in text.split("\n"):
        if own := normalised(line):
            counts[own] = counts.get(own, 0) + own.count(b" ") + 1
    return counts


_LINE = "line long, words int, least long, most long, back_least long, back_most long"
_SCHEMA = (
    "row long, doc_id long, host string, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, lines array<struct<" + _LINE.replace(" ", ":").replace(",:", ",") + ">>"
)


def figures(docs: DataFrame, host: str = "source") -> DataFrame:
    """A stored row for each document with its figures and the hashes of its lines, but not its text."""

    numbers = {"next": 0}

    def rows(batch: pa.RecordBatch) -> dict:
        texts = batch.column(3).to_pylist()
        own = np.array([text_figures(t) for t in texts], np.int64).reshape(-1, 5)
        lines = [[(line_hash(x), n, *line_anchors(x)) for x, n in text_lines(t).items()] for t in texts]
        names = [f.split()[0] for f in _LINE.split(", ")]
        first, numbers["next"] = numbers["next"], numbers["next"] + len(texts)
        return {
            "row": row_numbers(first, len(texts)),
            "doc_id": batch.column(0),
            "host": batch.column(1),
            "text_key": batch.column(2),
            "n_words": own[:, 0],
            "word_chars": own[:, 1],
            "n_symbols": own[:, 2],
            "n_dup_lines": own[:, 3],
            "n_repeat_words": own[:, 4],
            "base_failed": [fails_base(int(f[0]), int(f[4])) for f in own],
            "lines": [[dict(zip(names, x, strict=True)) for x in own] for own in lines],
        }

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(text_column()).alias("text_key"),
        text_column().alias("text"),
    )
    return stored(map_batches(source, rows, _SCHEMA), "figures")


_TEXT = ["host", "text_key"]


def _above(carried: DataFrame, document: str, limits: Limits) -> DataFrame:
    """host and line of the lines that more documents than the limit carry."""
    each = carried.groupBy("host", "line", document).agg(F.lit(1).alias("one"))
    return each.groupBy("host", "line").agg(F.count("one").alias("n")).filter(F.col("n") > limits.min_documents).select("host", "line")


def _classes(rest: DataFrame) -> DataFrame:
    """host, text_key and document of each text: the anchor of its own that most texts of the host have."""
    slots = F.array(*[F.struct(F.lit(i).alias("slot"), F.col(c).alias("value")) for i, c in enumerate(_ANCHORS)])
    anchors = rest.select(*_TEXT, F.inline(slots))
    votes = stored(anchors.groupBy("host", "slot", "value").agg(F.count(F.lit(1)).alias("n")), "votes")
    voted = anchors.join(votes, ["host", "slot", "value"])
    # Most votes, then the first slot, then the least value.
    best = F.min(F.struct((-F.col("n")).alias("n"), "slot", "value"))
    return voted.groupBy(*_TEXT).agg(best.alias("best")).select(*_TEXT, F.xxhash64("best.slot", "best.value").alias("document"))


_ANCHORS = ["least", "most", "back_least", "back_most"]


def frequent_lines(rows: DataFrame, limits: Limits) -> DataFrame:
    """host and line of the lines above the limit."""
    texts = rows.groupBy(*_TEXT).agg(F.first("lines").alias("lines")).select(*_TEXT, F.inline("lines"))
    texts = stored(texts, "lines")
    candidates = stored(_above(texts, "text_key", limits), "candidates").withColumn("candidate", F.lit(True))
    marked = stored(texts.join(candidates, ["host", "line"], "left"), "marked")
    own = F.col("candidate").isNull()
    extremes = [(F.max if "most" in c else F.min)(F.when(own, F.col(c))).alias(c) for c in _ANCHORS]
    rest = marked.groupBy(*_TEXT).agg(F.max("candidate").alias("any"), F.sum(F.when(own, F.col("words"))).alias("rest"), *extremes)
    rest = rest.filter(F.col("any") & (F.col("rest") >= _SHINGLE))
    classes = stored(_classes(stored(rest, "rest")), "classes")
    carried = marked.filter("candidate").select(*_TEXT, "line").join(classes, _TEXT, "left")
    return _above(carried.withColumn("document", F.coalesce("document", F.lit(0))), "document", limits)


def _verdicts(rows: DataFrame, limits: Limits) -> DataFrame:
    """``rows`` with the words and the lines that are removed, and the verdict."""
    lines = rows.select("row", "host", F.inline("lines")).select("row", "host", "line", "words")
    removed = lines.join(stored(frequent_lines(rows, limits), "frequent"), ["host", "line"]).groupBy("row")
    removed = removed.agg(F.sum("words").alias("removed_words"), F.collect_list("line").alias("removed_lines"))
    joined = rows.join(removed, "row", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (left < limits.min_words) | (left < limits.min_share * F.col("n_words"))
    return joined.withColumn("kept", ~F.col("base_failed") & ~depleted)


def quality_rules(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """A row for each document with its figures, the words on removed lines, and whether it is kept."""
    return _verdicts(figures(docs, host), limits).drop("row", "host", "text_key", "lines", "removed_lines")


def clean(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """The kept documents in their own columns, without the lines above the limits."""
    verdicts = _verdicts(figures(docs, host), limits).groupBy("doc_id", "text_key", "host")
    # Rows with equal keys have the same text and host, so the same verdict.
    verdicts = verdicts.agg(F.min("kept").alias("kept"), F.first("removed_lines").alias("gone")).filter("kept")
    # The documents are one struct meanwhile, so no name of theirs can clash.
    whole = docs.select(
        F.col("doc_id").cast("long").alias("key_id"),
        F.xxhash64(text_column()).alias("key_text"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("key_host"),
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"),
    )
    on = F.col("key_id").eqNullSafe(F.col("doc_id")) & (F.col("key_text") == F.col("text_key")) & (F.col("key_host") == F.col("host"))
    joined = whole.join(verdicts, on).select("doc", "gone")
    names = docs.columns
    at = names.index("text")

    def strip(batch: pa.RecordBatch) -> dict:
        fields = batch.column(0).flatten()
        texts = []
        for text, lines in zip(fields[at].to_pylist(), batch.column(1).to_pylist(), strict=True):
            if lines:
                gone = set(lines)
                text = "\n".join(x for x in text.split("\n") if not ((own := normalised(x)) and line_hash(own) in gone))
            texts.append(text)
        out = dict(zip(names, fields, strict=True))
        out["text"] = texts
        if "n_chars" in out:
            out["n_chars"] = [None if t is None else len(t) for t in texts]
        return out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(joined, strip, schema)
