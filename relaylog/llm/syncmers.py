"""Fingerprints of documents from closed syncmers, with DataFrame functions only.

A k-mer of units is chosen if the least hash of its inner runs of s units lies at its first or its last run. That
depends on the k-mer alone and not on what stands around it, so an unchanged passage keeps its anchors, and two
texts can be matched position by position wherever they agree. Any ``k - s`` k-mers in a row hold an anchor.

Units of fingerprints are the same for every length of text: up to five other signs and then a vowel, a sign beyond
ASCII or white space, whose runs count as one space. They are about two characters long, so short texts have
enough of them, and an edit shifts no units but its own. K-mers are of 10 units with inner runs of 7; ends are filled up,
so every text but the empty one has anchors. The empty one has the hash of the whole text as its only one.
The fingerprint has the distinct anchor hashes in the lowest quarter of their range, or the 128 smallest if those are fewer, so it grows with the
text. ``near_edited`` and ``near_next`` are likenesses of fingerprints: twice the hashes they share over the sum of their numbers, both cut
at the range that the narrower one covers, so they can be computed again from the columns. ``all_near_edited`` and ``all_near_next`` are the
same on all distinct anchors: not estimated, so a passage shared by two long texts counts however small its part of
them is. Equal texts have equal fingerprints.

The document after a document is found without a global sort: doc ids are cut into ranges at quantiles, and the first
rows of a range are also dealt to the range before it (those of the first to the last). Texts are shuffled once, and anchors are made after that, in the range's own task.

A null text is empty. Null doc ids come first; rows with the same doc_id follow each other by the hash of their text.
With a single row the next document is that row itself. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaylog.llm.common import text_column

WORD_UNITS = (r"\S{1,12}", 5, 2)
_ENDS = r"aeiouAEIOU\x{80}-\x{10FFFF}"
UNITS = (rf"[^\s{_ENDS}]{{0,5}}[\s{_ENDS}]|[^\s{_ENDS}]{{1,6}}", 10, 7)
SKETCH, SHARE = 128, 4

_LEAST = -(1 << 63)

Made = Callable[[DataFrame], DataFrame]


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that later expressions read without computing it again."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def with_units(df: DataFrame, text: str, out: str, units: tuple[str, int, int], filled: bool = False) -> DataFrame:
    """``df`` with an array ``out`` of the hashes of the text's units.

    ``filled``: k - 1 empty units stand before and after those of the text, if it has any.
    """
    pattern, k, _ = units
    hashes = F.transform(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)), lambda x: F.xxhash64(x))
    if not filled:
        return _once(df, out, hashes)
    df = _once(df, "__u", hashes)
    ends = F.array_repeat(F.xxhash64(F.lit("")), k - 1)
    return _once(df, out, F.when(F.size("__u") > 0, F.concat(ends, "__u", ends)).otherwise(F.col("__u"))).drop("__u")


def with_window_marks(df: DataFrame, hashes: str, out: str, units: tuple[str, int, int]) -> DataFrame:
    """``df`` with an array ``out``: for each k-mer of the array ``hashes`` its hash if it is a closed syncmer, else null."""
    _, k, s = units
    runs = k - s + 1
    df = _once(df, "__m", F.transform(hashes, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + j) for j in range(1, s)])))
    # The runs at 0, s, 2s, ... and the last one cover the k-mer.
    cover = sorted({*range(0, runs, s), runs - 1} - {0})

    def mark(first: Column, i: Column) -> Column:
        others = [F.get("__m", i + j) for j in range(1, runs)]
        last = others[-1]
        at_first = F.lit(True)
        at_last = last <= first
        for inner in others:
            at_first = at_first & (first <= inner)
        for inner in others[:-1]:
            at_last = at_last & (last <= inner)
        return F.when(at_first | at_last, F.xxhash64(first, *[F.get("__m", i + j) for j in cover]))

    count = F.greatest(F.size(hashes) - k + 1, F.lit(0))
    return _once(df, out, F.transform(F.slice("__m", F.lit(1), count), mark)).drop("__m")


def with_marks(df: DataFrame, text: str, out: str, units: tuple[str, int, int], filled: bool = False) -> DataFrame:
    """The marks of the k-mers of a text's units (see ``with_units`` and ``with_window_marks``)."""
    return with_window_marks(with_units(df, text, "__units", units, filled), "__units", out, units).drop("__units")


def _spaced(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, r"\s{2,}|[^\S ]", " ")


def _with_distinct(df: DataFrame, marks: Column, text: str, out: str) -> DataFrame:
    """``df`` with the distinct anchor hashes among ``marks`` in ascending order; a text without any has a hash of its own."""
    df = _once(df, "__anchors", F.sort_array(F.array_distinct(F.array_compact(marks))))
    whole = F.when(F.size("__anchors") > 0, F.col("__anchors")).otherwise(F.array(F.xxhash64(F.col(text), F.lit(0))))
    return _once(df, out, whole).drop("__anchors")


def with_anchors(df: DataFrame, text: str, out: str, marks: str) -> DataFrame:
    """``df`` with the distinct anchor hashes of ``text`` in ascending order, and the marks of its filled units."""
    df = with_marks(df.withColumn("__spaced", _spaced(F.col(text))), "__spaced", marks, UNITS, filled=True)
    return _with_distinct(df, F.col(marks), text, out).drop("__spaced")


def with_joined_anchors(df: DataFrame, left: str, right: str, out: str, left_marks: str, right_marks: str) -> DataFrame:
    """``df`` with the anchors ``out`` of ``left`` and ``right`` put together, two texts that longer ones begin with.

    ``left_marks`` and ``right_marks`` are the marks of the longer texts. K-mers that lie in ``left`` are marked alike there. So
    are those in ``right`` once a unit has ended with one of the signs that always end a unit. Only the k-mers over the
    joint, and those at the end, are marked anew.
    """
    pattern, k, _ = UNITS
    df = df.withColumn("__text", F.concat(left, right)).withColumn("__spaced", _spaced(F.col("__text")))
    df = with_units(df, "__spaced", "__f", UNITS, filled=True)

    def count(text: Column) -> Column:
        return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))

    n = F.size("__f") - 2 * (k - 1)
    spaced = _spaced(F.col(right))
    head = F.regexp_extract(spaced, rf"\A[^\s{_ENDS}]*[\s{_ENDS}]", 0)
    # The last unit of a text that goes on may be another one there.
    df = _once(df, "__l", F.greatest(count(_spaced(F.col(left))) - 1, F.lit(0)))
    df = _once(df, "__r", F.struct(count(spaced).alias("all"), count(head).alias("head")))
    alike = F.when(F.col("__r.head") > 0, F.greatest(F.col("__r.all") - F.col("__r.head") - k, F.lit(0))).otherwise(F.lit(0))
    df = _once(df, "__w", alike)
    to_joint = F.when(F.col("__w") > 0, 2 * (k - 1) + n - F.col("__r.all") + F.col("__r.head")).otherwise(F.size("__f"))
    df = _once(df, "__joint", F.slice("__f", F.col("__l") + 1, to_joint - F.col("__l")))
    df = _once(df, "__end", F.when(F.col("__w") > 0, F.slice("__f", n, F.lit(2 * k - 1))).otherwise(F.array().cast("array<bigint>")))
    df = with_window_marks(df, "__joint", "__joint_marks", UNITS)
    df = with_window_marks(df, "__end", "__end_marks", UNITS)
    from_left = F.slice(left_marks, F.lit(1), F.col("__l"))
    from_right = F.slice(right_marks, F.when(F.col("__w") > 0, F.col("__r.head") + k).otherwise(F.lit(1)), F.col("__w"))
    df = _with_distinct(df, F.concat(from_left, "__joint_marks", from_right, "__end_marks"), "__text", out)
    return df.drop("__text", "__spaced", "__f", "__l", "__r", "__w", "__joint", "__end", "__joint_marks", "__end_marks")


def sketch(hashes: str) -> Column:
    """Of ascending hashes those in the lowest part of their range, and ``SKETCH`` at least."""
    low = F.size(F.filter(hashes, lambda x: x < _LEAST + (1 << 64) // SHARE))
    return F.slice(hashes, F.lit(1), F.greatest(low, F.lit(SKETCH)))


def anchors(docs: DataFrame, units: tuple[str, int, int] = WORD_UNITS) -> DataFrame:
    """A row for each anchor: doc_id, position of its first unit, hash. Join two documents' rows on hash to align them."""
    rows = with_marks(docs.select("doc_id", text_column().alias("text")), "text", "__marks", units)
    return rows.select("doc_id", F.posexplode("__marks").alias("position", "hash")).filter("hash is not null")


def likeness(a: str, b: str) -> Column:
    """Of two sets of anchors, from 0 to 1."""
    return 2 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))


def sketch_likeness(a: str, b: str) -> Column:
    """Of two fingerprints, from 0 to 1. One of fewer than ``SKETCH`` hashes is whole; others cover the range up to their last."""

    def reach(x: str) -> Column:
        return F.when(F.size(x) >= SKETCH, F.element_at(x, -1)).otherwise(F.lit((1 << 63) - 1))

    # Bound once for all elements that the filters compare with it.
    cut = F.array(F.least(reach(a), reach(b)))

    def likeness_below(cut: Column) -> Column:
        both, of_a, of_b = [F.size(F.filter(x, lambda h: h <= cut)) for x in (F.array_intersect(a, b), F.col(a), F.col(b))]
        return F.coalesce(2 * both / F.nullif(of_a + of_b, F.lit(0)), F.lit(0.0))

    return F.get(F.transform(cut, likeness_below), F.lit(0))


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are at most ``key``, in about the square root of their number of steps."""
    step = max(1, math.isqrt(len(bounds)))
    tops = F.lit(bounds[step - 1 :: step]).cast("array<bigint>")
    whole = F.size(F.filter(tops, lambda x: x <= key)) * step
    rest = F.slice(F.lit(bounds).cast("array<bigint>"), whole + 1, F.lit(step))
    return whole + F.size(F.filter(rest, lambda x: x <= key))


def range_bounds(df: DataFrame, key: str) -> list[int]:
    """The smallest keys of the ranges that ``with_next`` deals rows to, in ascending order. Not more than their number."""
    ranges = 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / ranges for i in range(1, ranges)]
    least, found = df.agg(F.min(key), F.percentile_approx(key, cuts, max(10_000, 10 * ranges))).first()
    return [] if least is None else sorted({least, *found})


def with_next(df: DataFrame, key: str, tie: str, columns: list[str], bounds: list[int], made: Made | None = None) -> DataFrame:
    """``df`` with ``next_<column>`` of the next row in the order of ``key`` (not null) and ``tie``; the first follows the last.

    ``made`` adds columns to rows that are already dealt to their range, so that those are not shuffled.
    """
    at = F.greatest(_range_of(F.col(key), bounds) - 1, F.lit(0)) if bounds else F.lit(0)
    ranged = _once(df, "__range", at)
    last = F.lit(max(0, len(bounds) - 1))
    own = F.struct(F.col("__range").alias("__at"), F.lit(0).alias("__carry"))
    before = F.struct(F.when(F.col("__range") == 0, last).otherwise(F.col("__range") - 1).alias("__at"), F.lit(1).alias("__carry"))
    head = F.col(key) == F.get(F.lit(bounds or [0]).cast("array<bigint>"), F.col("__range"))
    dealt = ranged.select("*", F.inline(F.when(head, F.array(own, before)).otherwise(F.array(own))))
    if made is not None:
        dealt = made(dealt.repartition("__at"))
    window = Window.partitionBy("__at").orderBy("__carry", key, tie)
    after = [F.lead(c).over(window).alias(f"next_{c}") for c in columns]
    return dealt.select("*", *after).filter("__carry = 0").drop("__range", "__at", "__carry")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of the text with its second half from the next document, and their likeness."""
    text = text_column()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("key"),
        text.alias("text"),
        F.xxhash64(text).alias("tie"),
    )
    bounds = range_bounds(rows.select("key"), "key")
    made = ["text", "anchors", "marks"]
    rows = with_next(rows, "key", "tie", made, bounds, lambda df: with_anchors(df, "text", "anchors", "marks"))
    rows = _once(rows, "n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept, following = F.left(F.col("text"), F.col("n_chars").cast("int") - half), F.left(F.col("next_text"), half)
    rows = _once(_once(rows, "kept", kept), "following", following)
    rows = with_joined_anchors(rows, "kept", "following", "edited_anchors", "marks", "next_marks").drop("marks", "next_marks")
    for name in ("anchors", "edited_anchors", "next_anchors"):
        rows = _once(rows, f"{name}_low", sketch(name))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.concat("kept", "following"), 256).alias("edited_sha256"),
        as_text(F.col("anchors_low")).alias("fingerprint"),
        as_text(F.col("edited_anchors_low")).alias("edited_fingerprint"),
        sketch_likeness("anchors_low", "edited_anchors_low").alias("near_edited"),
        sketch_likeness("anchors_low", "next_anchors_low").alias("near_next"),
        likeness("anchors", "edited_anchors").alias("all_near_edited"),
        likeness("anchors", "next_anchors").alias("all_near_next"),
    )
