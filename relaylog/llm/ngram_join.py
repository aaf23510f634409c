"""Jaccard self-join of documents on word shingles through parity sketches, and the components of its links.

A document's shingles are dealt to the words of a sketch by hash, and each word is the XOR of its shingles' hashes:
the parity of every bit. A shingle that only one of two documents has changes one word, so the number
of words in which two sketches differ is at most the size of the symmetric difference. Linked documents, with
Jaccard similarity of at least t, differ in at most d = (|A| + |B|) (1 - t) / (1 + t) shingles; so of any d + 1 words in
which one of them has shingles, they share one. Documents of a band (sizes from L to 2L, and smaller ones that a
document of the band can be linked with) have sketches of the same width, and each gives as keys the first d + 1 of its
words that have shingles, in one order for the whole band. Documents that share no key can't be linked; the rest
is verified on whole shingle sets. Narrow bands, and documents whose sketch has too few words with shingles, take a
word for each shingle, where that can't happen.

The order puts words last that hold nothing but frequent shingles, so a passage that many documents share rarely makes
a key. Which shingles count as frequent only changes the work, not the result.

Skew: documents with equal sets stand as one node. Keys are sorted in ranges of (key, document), so a hot key is spread
over tasks. Members of a key are first held against one centre, the member with most shared keys; keys whose members
then are in one component are done. Of all others the members in different components are compared pair by pair in
groups of bounded size by small bit sketches, one bit flipped for each shingle, whose Hamming distance is a lower bound
of the symmetric difference too; only pairs that these leave become rows and are verified. So no link between
different components is lost, and groups of copies are never expanded into pairs.

Words are runs of other than ASCII white space, A-Z lower-cased. With fewer words than a shingle has, all of them are
the one shingle. A document without words, or with a null text, has no shingles and is linked with nothing: its
component is its own. Rows with the same doc_id count as documents of their own with that id. A null doc_id takes
part, but is never the component's name unless all are null. An empty table gives no rows.
"""

from __future__ import annotations

import gc
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylog.llm.common import forget, map_batches, mix, row_numbers, stored, text_column, window_hashes, word_hashes

_FREQUENT_CELLS = 1 << 18
_BLOOM_BITS = 1 << 22


@dataclass(frozen=True)
class Similarity:
    """Documents link when ``den`` * intersection >= ``num`` * union of shingles of ``words`` words."""

    words: int = 5
    num: int = 80
    den: int = 100

    def most_apart(self, a: int, b: int) -> int:
        """The largest symmetric difference that linked documents of these sizes can have."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def largest(self, size: int) -> int:
        """The largest document that one of this size can be linked with."""
        return size * self.den // self.num


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    own = word_hashes(text.encode().lower())
    if not len(own):
        return np.zeros(0, np.uint64)
    size = min(words, len(own))
    return np.unique(window_hashes(own, size) + np.uint64(size))


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - (_FREQUENT_CELLS.bit_length() - 1))).astype(np.int64)


def _width(band: int) -> int:
    """Words of a band's sketch: three for every four shingles of its smallest document; 0: one for each shingle."""
    return 3 << (band - 2) if band >= 6 else 0


def sketch(shingles: np.ndarray, width: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the words that have shingles, their parities, and whether all their shingles are frequent."""
    common = frequent[_cells(shingles)]
    if not width:
        return shingles, mix(shingles), common
    word = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(width)
    order = np.argsort(word, kind="stable")
    ordered = word[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], np.bitwise_xor.reduceat(mix(shingles)[order], first), np.logical_and.reduceat(common[order], first)


def keys(shingles: np.ndarray, rule: Similarity, frequent: np.ndarray, fine: bool) -> np.ndarray | None:
    """The keys of a document in its band, and in the next one if a larger document there can be linked with it.

    None if a sketch has too few words with shingles. ``fine``: a word for each shingle in every band.
    """
    n = len(shingles)
    own, out = n.bit_length() - 1, [np.zeros(0, np.uint64)]
    for band in (own, own + 1) if n else ():
        partner = min(rule.largest(n), (2 << band) - 1)
        if partner < 1 << band:
            continue
        need = rule.most_apart(n, partner) + 1
        number, parity, common = sketch(shingles, 0 if fine else _width(band), frequent)
        if len(number) < need:
            return None
        chosen = np.lexsort((number, common))[:need]
        salt = np.uint64(band * 0x9E3779B97F4A7C15 % (1 << 64))
        out.append(mix(parity[chosen] ^ mix(number[chosen] + salt)))
    return np.concatenate(out)


_MOST_BITS = 1 << 14


def parity_bits(shingles: np.ndarray) -> bytes:
    """A bit sketch: each shingle flips one bit. About as many bits as shingles, a power of two."""
    size = min(_MOST_BITS, max(64, 1 << max(0, len(shingles) - 1).bit_length()))
    at = (mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(size)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(bits: int, size: int, to: int) -> int:
    """The same sketch with fewer bits."""
    while size > to:
        size //= 2
        bits = (bits >> size) ^ (bits & ((1 << size) - 1))
    return bits


def may_link(a: bytes, size_a: int, b: bytes, size_b: int, rule: Similarity) -> bool:
    """False only if the sketches differ in more bits than sets of these sizes may differ in shingles."""
    to = 8 * min(len(a), len(b))
    x, y = (_folded(int.from_bytes(s, "little"), 8 * len(s), to) for s in (a, b))
    return (x ^ y).bit_count() <= rule.most_apart(size_a, size_b) and rule.den * min(size_a, size_b) >= rule.num * max(size_a, size_b)


# -- passes over the texts ------------------------------------------------------------------------------------------


def _source(docs: DataFrame) -> DataFrame:
    text = text_column()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("text_key"), text.alias("text"))


def _frequent_cells(docs: DataFrame, rule: Similarity, share: float = 0.001, least: int = 64) -> np.ndarray:
    """A fixed table of cells of shingles, true where a shingle stands in more than ``share`` of all documents.

    Each task counts its own documents and passes on the cells that stand out in it.
    """

    def count(batches):
        table, documents = np.zeros(_FREQUENT_CELLS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(table, _cells(shingle_set(text, rule.words)), 1)
                documents += 1
        usual = table.mean()
        out = np.flatnonzero(table > usual + 6 * np.sqrt(usual) + share / 2 * documents)
        columns = [pa.array(np.append(out, -1)), pa.array(np.append(table[out] - int(usual), documents))]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "n"])

    counted = docs.select(text_column().alias("text")).mapInArrow(count, "cell long, n long")
    rows = counted.groupBy("cell").agg(F.sum("n").alias("n")).collect()  # a fixed number of cells at most
    documents = next((r["n"] for r in rows if r["cell"] < 0), 0)
    frequent = np.zeros(_FREQUENT_CELLS, bool)
    frequent[[r["cell"] for r in rows if r["cell"] >= 0 and r["n"] > max(least, share * documents)]] = True
    return frequent


def _class_of(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    sums = (np.bitwise_xor.reduce(mix(shingles)), np.add.reduce(mix(shingles ^ np.uint64(0xA0761D6478BD642F))))
    return tuple(int(x) for x in np.array(sums, np.uint64).view(np.int64))


def _sketched(docs: DataFrame, rule: Similarity, frequent: np.ndarray, fine: bool) -> DataFrame:
    numbers = {"next": 0}

    def rows(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(t, rule.words) for t in batch.column(2).to_pylist()]
        own = [keys(s, rule, frequent, fine) for s in sets]
        classes = [_class_of(s) for s in sets]
        first, numbers["next"] = numbers["next"], numbers["next"] + len(sets)
        return {
            "row": row_numbers(first, len(sets)),
            "doc_id": batch.column(0),
            "text_key": batch.column(1),
            "size": [len(s) for s in sets],
            "bits": [parity_bits(s) for s in sets],
            "class1": [c[0] for c in classes],
            "class2": [c[1] for c in classes],
            "keys": [None if k is None else k.view(np.int64) for k in own],
        }

    schema = "row long, doc_id long, text_key long, size long, bits binary, class1 long, class2 long, keys array<long>"
    return stored(map_batches(_source(docs), rows, schema), "sketches")


def _shared_keys(sketched: DataFrame) -> DataFrame:
    """Rows (key, row) of keys that more than one row has, and at most a few others."""

    def runs(batches):
        held = None  # (key, row, whether its key is known to be kept): the last row so far
        for batch in batches:
            k, r = (batch.column(i).to_numpy() for i in (0, 1))
            if not len(k):
                continue
            keep = np.zeros(len(k), bool)
            same = k[1:] == k[:-1]
            keep[1:] |= same
            keep[:-1] |= same
            if held is None or held[0] == k[0]:
                keep[0] = True  # the first run may have begun in the range before
            if held is not None and (held[2] or held[0] == k[0]):
                yield _pairs(np.array([held[0]]), np.array([held[1]]))
            held = (k[-1], r[-1], bool(keep[-1]))
            keep[-1] = False
            yield _pairs(k[keep], r[keep])
        if held is not None:
            yield _pairs(np.array([held[0]]), np.array([held[1]]))

    exploded = sketched.select(F.explode("keys").alias("key"), "row")
    ordered = exploded.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    spark = sketched.sparkSession
    small = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "65536")  # rows of two numbers
    try:
        return stored(ordered.mapInArrow(runs, "key long, row long"), "keys")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", small)


def _pairs(keys: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(rows, pa.int64())], names=["key", "row"])


# -- verification ---------------------------------------------------------------------------------------------------


def _shingles_of(docs: DataFrame, wanted: DataFrame, rule: Similarity) -> DataFrame:
    """text_key and packed shingles of the documents whose text_key is in ``wanted``, and of a few others.

    A bit table of fixed size lets most others go by without hashing them.
    """
    cell = F.pmod(F.col("text_key"), F.lit(_BLOOM_BITS))
    bits = wanted.select((cell / 32).cast("int").alias("at"), (cell % 32).cast("int").alias("bit"))
    bits = bits.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    table = np.zeros(_BLOOM_BITS // 32, np.int64)
    for at, own in bits.collect():  # a fixed number of rows at most
        table[at] = own

    def rows(batch: pa.RecordBatch) -> dict:
        text_keys = batch.column(1).to_numpy()
        cells = text_keys % _BLOOM_BITS
        hit = np.flatnonzero((table[cells // 32] >> (cells % 32)) & 1)
        texts = batch.column(2).take(pa.array(hit)).to_pylist()
        return {"text_key": text_keys[hit], "shingles": [shingle_set(t, rule.words).tobytes() for t in texts]}

    found = map_batches(_source(docs), rows, "text_key long, shingles binary")
    exact = found.join(wanted.select("text_key").distinct(), "text_key", "left_semi")
    # Only rows that repeat whole have equal text_keys, and their sets are equal.
    return exact.dropDuplicates(["text_key"])


def _plausible(pairs: DataFrame, nodes: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs (a, b) whose bit sketches don't rule a link out."""
    a, b = (nodes.select(F.col("node").alias(x), F.col("bits").alias(f"bits_{x}"), F.col("size").alias(f"size_{x}")) for x in "ab")
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "bits_a", "size_a", "bits_b", "size_b")

    def rows(batch: pa.RecordBatch) -> dict:
        columns = [batch.column(k).to_pylist() for k in range(6)]
        out = [(i, j) for i, j, *sketches in zip(*columns, strict=True) if may_link(*sketches, rule)]
        return {"a": [x[0] for x in out], "b": [x[1] for x in out]}

    return map_batches(joined, rows, "a long, b long")


#: Members of a key that are compared in one group; a larger key is dealt to groups of two blocks each.
_BLOCK = 1024


def _close_pairs(members: DataFrame, nodes: DataFrame, rule: Similarity) -> DataFrame:
    """Pairs (a, b) of nodes that share a key, have different labels, and whose bit sketches don't rule a link out.

    Compared in groups of bounded size: pairs that are ruled out never become rows.
    """
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    blocked = members.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / _BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int")
    dealt = blocked.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = dealt.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "label")
    sketches = nodes.select("node", "size", "bits")
    together = grouped.join(sketches, "node").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "size")

    def compare(group: list[tuple], split: bool) -> list[tuple]:
        """``split``: the group is two blocks of a large key; pairs within one are compared in its own group."""
        found = []
        numbers = [(own, node, label, size, 8 * len(bits), int.from_bytes(bits, "little")) for own, node, label, size, bits in group]
        for i, (own, a, label, size, width, x) in enumerate(numbers):
            for other_own, b, other_label, other_size, other_width, y in numbers[i + 1 :]:
                if rule.den * size < rule.num * other_size:
                    break  # sizes ascend
                if label == other_label or split and own == other_own:
                    continue
                if width != other_width:
                    apart = x ^ _folded(y, other_width, width)
                else:
                    apart = x ^ y
                if apart.bit_count() <= rule.most_apart(size, other_size):
                    found.append((min(a, b), max(a, b)))
        return found

    def rows(batches):
        place, group = None, []
        for batch in batches:
            out = []
            for key, low, high, own, node, label, size, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, low, high) != place:
                    out += compare(group, bool(place) and place[1] != place[2])
                    place, group = (key, low, high), []
                group.append((own, node, label, size, bits))
            yield _pairs_of(out)
        yield _pairs_of(compare(group, bool(place) and place[1] != place[2]))

    columns = together.select("key", "low", "high", "own", "node", "label", "size", "bits")
    return columns.mapInArrow(rows, "a long, b long").distinct()


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs (a, b) of nodes that link, by their whole sets."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = stored(nodes.join(ends, "node").select("node", "text_key"), "wanted")
    sets = wanted.join(_shingles_of(docs, wanted, rule), "text_key").select("node", "shingles")
    sets = stored(sets, "shingles")
    a, b = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")

    def rows(batch: pa.RecordBatch) -> dict:
        out, last = [], (None, None)
        for i, j, x, y in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if last[0] != i:
                last = (i, np.frombuffer(x, np.uint64))
            p, q = last[1], np.frombuffer(y, np.uint64)
            both = len(p) + len(q)
            shared = both - len(np.union1d(p, q))
            if rule.den * shared >= rule.num * (both - shared):
                out.append((i, j))
        return {"a": [x[0] for x in out], "b": [x[1] for x in out]}

    joined = pairs.join(b, "b").join(a, "a").select("a", "b", "set_a", "set_b")
    links = stored(map_batches(joined, rows, "a long, b long"), "links")
    forget(sets)
    return links


def _pairs_of(found: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


# -- components -----------------------------------------------------------------------------------------------------


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """node and label: the smallest node that can be reached over ``links`` (a, b).

    Labels spread over links and then follow themselves, so long chains close in a few rounds. Every round is a
    stored table.
    """
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    ends = both.select(F.col("a").alias("node")).distinct()
    labels = stored(ends.join(both.groupBy("a").agg(F.min("b").alias("m")), F.col("node") == F.col("a")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        spread = both.join(labels, F.col("a") == F.col("node")).groupBy("b").agg(F.min("label").alias("m"))
        near = labels.join(spread, F.col("node") == F.col("b")).select("node", F.least("label", "m").alias("near"), "label")
        of = labels.select(F.col("node").alias("at"), F.col("label").alias("far"))
        jumped = near.join(of, F.col("near") == F.col("at")).select("node", F.least("near", "far").alias("new"), "label")
        new = stored(jumped, "labels")
        changed = new.filter("new <> label").limit(1).count()
        forget(labels)
        labels = new.select("node", F.col("new").alias("label"))
        if not changed:
            break
        labels = stored(labels, "labels")
        forget(new)
    return nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def _release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of frames that are no longer used."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _labelled(docs: DataFrame, rule: Similarity, star_rounds: int) -> DataFrame:
    """row, doc_id, text_key, size and label, the same for the rows of a component, of every document."""
    spark = docs.sparkSession
    frequent = _frequent_cells(docs, rule)
    sketched = _sketched(docs, rule, frequent, fine=False)
    if sketched.filter("keys is null").limit(1).count():
        sketched = _sketched(docs, rule, frequent, fine=True)
    shared = _shared_keys(sketched)
    _release(spark)
    light = sketched.drop("keys")
    # Sums are stored before they are joined with what they sum up: a join of two plain shuffles can split a hot key.
    classes = stored(light.filter("size > 0").groupBy("class1", "class2", "size").agg(F.min("row").alias("node")), "classes")
    placed = stored(light.join(classes, ["class1", "class2", "size"], "left").withColumn("node", F.coalesce("node", "row")), "nodes")
    forget(sketched)
    nodes = placed.filter("row = node").select("node", "text_key", "size", "bits")

    members = shared.join(placed.select("row", "node"), "row").select("key", "node").distinct()
    crowded = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(members.join(crowded.select("key"), "key", "left_semi").withColumn("label", F.col("node")), "members")
    forget(shared)
    links = None
    for turn in range(star_rounds + 1):
        if not members.limit(1).count():
            break
        if turn < star_rounds:
            # A centre for each key: the member with most keys, then others by a hash that differs by turn.
            weight = members.groupBy("node").agg(F.count(F.lit(1)).alias("weight"))
            first = F.col("weight") if turn == 0 else F.xxhash64("node", F.lit(turn))
            ordered = members.join(weight, "node").select("key", F.struct(first.alias("first"), "node", "label").alias("c"))
            centres = ordered.groupBy("key").agg(F.max("c").alias("c")).select("key", F.col("c.node").alias("x"), F.col("c.label").alias("x_label"))
            met = members.join(centres, "key").filter("x_label <> label")
            pairs = met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
            pairs = _plausible(pairs, nodes, rule)
        else:
            pairs = _close_pairs(members, nodes, rule)
        found = _verified(stored(pairs, "pairs"), nodes, docs, rule)
        links = found if links is None else links.unionByName(found)
        labels = components(nodes, links)
        if turn < star_rounds:
            relabelled = members.drop("label").join(labels, "node").select("key", "node", "label")
            several = relabelled.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h")
            now = stored(relabelled.join(several.select("key"), "key", "left_semi"), "members")
            forget(members)
            members = now
        _release(spark)
    return placed.withColumn("label", F.col("node")) if links is None else placed.join(stored(labels, "labels"), "node")


def ngram_components(docs: DataFrame, rule: Similarity = Similarity(), star_rounds: int = 1) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles and component_id, the smallest doc_id that is reachable by links, of every document."""
    named = _labelled(docs, rule, star_rounds)
    smallest = stored(named.filter("size > 0").groupBy("label").agg(F.min("doc_id").alias("smallest")), "smallest")
    component = F.when(F.col("size") > 0, F.col("smallest")).otherwise(F.col("doc_id"))
    return named.join(smallest, "label", "left").select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))


def keep_first(docs: DataFrame, rule: Similarity = Similarity(), star_rounds: int = 1) -> DataFrame:  # noqa: B008
    """One document of each component stays: the one with its smallest doc_id. Documents without shingles all stay."""
    named = stored(_labelled(docs, rule, star_rounds).filter("size > 0").select("doc_id", "text_key", "label"), "labelled")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    first = named.groupBy("label").agg(F.min(order).alias("m")).select(F.col("m.text_key").alias("text_key"))
    per_key = named.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"))
    gone = stored(per_key.join(first, "text_key", "left_anti"), "gone")
    again = stored(per_key.filter("n > 1").join(first, "text_key", "left_semi"), "again")
    key = F.xxhash64(F.col("doc_id").cast("long"), text_column())
    kept = docs.join(gone.select(F.col("text_key").alias("__gone")), key == F.col("__gone"), "left_anti")
    if again.limit(1).count():  # rows that repeat whole: one of them
        repeated = again.select(F.col("text_key").alias("__again"))
        once = kept.join(repeated, key == F.col("__again"), "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(repeated, key == F.col("__again"), "left_anti").unionByName(once)
    return kept
