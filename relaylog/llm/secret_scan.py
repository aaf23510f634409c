r"""Secrets in texts, with DataFrame functions only, and how widely each candidate is owned over the whole corpus.

Each text is read once and stays in its task. Base kinds are ``assign`` (a value given to a password, secret, token or API key), ``access``
(an access key id) and ``hex`` (a long run of hex digits); ``issued`` is added by this operator: tokens in the formats of
issuers and long values of mixed letters and digits. Candidate values are hashed, and hashes are counted by distinct
repository and by distinct owner. A value that more than ``max_owners`` owners or more than ``max_repositories``
repositories have is an example that people copy; one that few have looks like a live credential of theirs. The class
never drops a span: base spans and issued ones that touch no base span are all in ``spans``, and in ``all_spans`` with
their class and counts.

Places come from the lengths of matches and of the text between them, summed up per document in a window over its own
matches, so no task holds more than the matches of one document. Counts are aggregated before each shuffle: first by
(value, owner, repository), then by (value, owner), then by value. Only rows of matches are shuffled, never texts.

Offsets are in code points, the end exclusive. A null or empty text has no spans. Rows that repeat get the same spans
each and count as one owner. A null owner or repository counts as an empty one. An empty table gives no rows. Other
columns are ignored, and kept by ``redacted``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaylog.llm.common import stored, text_column

_NOT_HEX_BEFORE = "(?<![0-9a-f])"
_RUN = "[A-Za-z0-9+/_-]"


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that holds the value, and the least length of the value."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0


#: In the order in which spans that begin together are listed. The access and hex patterns take in their least lengths,
#: which drops the same matches, as runs are whole. Case is ignored for A to Z only.
BASE = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Kind("access", r"AKIA[A-Z0-9]{16,}"),
    Kind("hex", _NOT_HEX_BEFORE + r"[0-9a-f]{24,}"),
)
ISSUED = Kind(
    "issued",
    r"gh[pousr]_[A-Za-z0-9]{36,}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"
    rf"|(?<!{_RUN})(?={_RUN}{{32}})(?={_RUN}*[0-9])(?={_RUN}*[a-z])(?={_RUN}*[A-Z]){_RUN}+={{0,2}}",
)
KINDS = (*BASE, ISSUED)


@dataclass(frozen=True)
class Ownership:
    """Which columns tell the owner and, within an owner, the repository; above how many of either a value is an example."""

    owner: str = "source"
    repository: str = "lang"
    max_owners: int = 2
    max_repositories: int = 4


def _matches(number: int, kind: Kind) -> Column:
    """Of each match of a kind: the length of the text since the match before, its own, and its value."""
    text, pattern = F.col("text"), F.lit(kind.pattern)
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda x: F.char_length(x))
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(kind.group)) if kind.group else hits
    rows = F.transform(
        F.arrays_zip(F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"), values.alias("value")),
        lambda x, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("number"),
            x["gap"].alias("gap"),
            F.char_length(x["hit"]).alias("length"),
            F.when(F.char_length(x["value"]) >= kind.least, F.sha2(x["value"], 256)).alias("value"),
        ),
    )
    return F.when(F.rlike(text, pattern), rows)


#: A document's id as text, empty for none, and a hash of its id and text: equal only for equal ids, so a hash that two ids share does no harm.
_KEY = ["id", "key"]


def _keys() -> list[Column]:
    doc_id = F.col("doc_id").cast("long")
    return [F.coalesce(doc_id.cast("string"), F.lit("")).alias("id"), F.xxhash64(doc_id, text_column()).alias("key")]


def _scanned(docs: DataFrame, owns: Ownership) -> DataFrame:
    """A stored row for each document: doc_id, key, owner, repository and its matches, but not its text."""
    text = text_column()
    name = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (owns.owner, owns.repository)}
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *_keys(),
        name[owns.owner].alias("owner"),
        name[owns.repository].alias("repository"),
        text.alias("text"),
    )
    found = [F.coalesce(_matches(i, k), F.array().cast("array<struct<kind:int,number:int,gap:int,length:int,value:string>>")) for i, k in enumerate(KINDS)]
    return stored(rows.select("doc_id", *_KEY, "owner", "repository", F.concat(*found).alias("matches")), "matches")


def ownership(scanned: DataFrame) -> DataFrame:
    """owners and repositories of each candidate value."""
    candidates = scanned.select("owner", "repository", F.explode("matches.value").alias("value")).filter("value is not null")
    held = candidates.distinct().groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return held.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def _spans(scanned: DataFrame, owns: Ownership) -> DataFrame:
    """A row for each span, whatever its class: id, key, kind, start, end, live, owners, repositories."""
    with_any = scanned.filter(F.size("matches") > 0).groupBy(*_KEY).agg(F.first("matches").alias("matches"))
    rows = with_any.select(*_KEY, F.inline("matches"))
    in_kind = Window.partitionBy(*_KEY, "kind").orderBy("number")
    gaps = F.sum("gap").over(in_kind.rowsBetween(Window.unboundedPreceding, 0))
    lengths = F.sum("length").over(in_kind.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.select(*_KEY, "kind", "value", (gaps + lengths - F.col("length")).alias("start"), (gaps + lengths).alias("end"))
    # Stored first, so that the join can split a value that many documents have.
    owned = stored(ownership(scanned), "ownership")
    valued = placed.filter("value is not null").join(owned, "value")
    live = valued.withColumn("live", (F.col("owners") <= owns.max_owners) & (F.col("repositories") <= owns.max_repositories))
    # An issued span counts if no base span ends after its start, or begins before its end.
    by_start = Window.partitionBy(*_KEY).orderBy("start", "end")
    base = F.col("kind") < len(BASE)
    before = F.max(F.when(base, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(base, F.col("start"))).over(by_start.rowsBetween(0, Window.unboundedFollowing))
    touched = (F.coalesce(before, F.lit(-1)) > F.col("start")) | (F.coalesce(after, F.col("end")) < F.col("end"))
    return live.withColumn("touched", touched).filter(base | ~F.col("touched")).drop("touched", "value")


def _joined(kinds: int, classes: bool = False) -> Column:
    """kind:start:end of the spans of the first ``kinds`` in order, as one text; with ``classes`` also :class:owners:repositories."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    spans = F.filter("spans", lambda s: s["kind"] < kinds)

    def text(s: Column) -> Column:
        more = [F.when(s["live"], "live").otherwise("example"), s["owners"], s["repositories"]] if classes else []
        return F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"], *more)

    return F.array_join(F.transform(spans, text), ",")


def secret_spans(docs: DataFrame, owns: Ownership = Ownership()) -> DataFrame:  # noqa: B008
    """Per document: counts of kinds, the digest of base spans, the spans, and how many look live or like examples.

    Every span counts in its kind and in ``n_live`` or ``n_examples``; ``n_issued_examples`` are the issued ones among the latter.
    """
    scanned = _scanned(docs, owns)
    counts = [F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k.name}") for i, k in enumerate(KINDS)]
    counts += [F.count(F.when(F.col("live"), 1)).alias("n_live"), F.count(F.when(~F.col("live"), 1)).alias("n_examples")]
    counts += [F.count(F.when((F.col("kind") >= len(BASE)) & ~F.col("live"), 1)).alias("n_issued_examples")]
    spans = F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live", "owners", "repositories"))).alias("spans")
    per_key = _spans(scanned, owns).groupBy(*_KEY).agg(spans, *counts)
    rows = scanned.select("doc_id", *_KEY).join(per_key, _KEY, "left")
    names = [f"n_{k.name}" for k in KINDS] + ["n_live", "n_examples", "n_issued_examples"]
    return rows.select(
        "doc_id",
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names],
        F.sha2(F.coalesce(_joined(len(BASE)), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_joined(len(KINDS)), F.lit("")).alias("spans"),
        F.coalesce(_joined(len(KINDS), classes=True), F.lit("")).alias("all_spans"),
    )


LIVE_MARK, EXAMPLE_MARK = "[live secret]", "[example secret]"


def redacted(docs: DataFrame, owns: Ownership = Ownership()) -> DataFrame:  # noqa: B008
    """The documents in their own columns, with a mark in place of each run of overlapping spans, whatever their class."""
    spans = _spans(_scanned(docs, owns), owns)
    by_start = Window.partitionBy(*_KEY).orderBy("start", "end", "kind")
    reached = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reached > F.col("start"), 0).otherwise(1)
    runs = spans.withColumn("new", new).withColumn("run", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*_KEY, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("live").alias("live"))
    runs = runs.withColumn("from", F.coalesce(F.lag("end").over(Window.partitionBy(*_KEY).orderBy("start")), F.lit(0)))
    per_key = runs.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("start", "end", "from", "live"))).alias("runs"))
    per_key = per_key.withColumnRenamed("id", "run_id").withColumnRenamed("key", "run_key")
    text = F.col("doc.text")

    def piece(run: Column) -> Column:
        between = F.substring(text, run["from"].cast("int") + 1, (run["start"] - run["from"]).cast("int"))
        return F.concat(between, F.when(run["live"], LIVE_MARK).otherwise(EXAMPLE_MARK))

    rest = F.substring(text, F.element_at("runs", -1)["end"].cast("int") + 1, F.char_length(text))
    new_text = F.when(F.col("runs").isNull(), text).otherwise(F.concat(F.array_join(F.transform("runs", piece), ""), rest))
    # The documents are one struct meanwhile, so no name of theirs can clash.
    whole = docs.select(*_keys(), F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"))
    joined = whole.join(per_key, (F.col("id") == F.col("run_id")) & (F.col("key") == F.col("run_key")), "left")
    made = {"text": new_text}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.char_length(new_text).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[made.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
