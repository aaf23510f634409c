"""Groups of spelling variants by composition of finite-state machines.

All pairs of words with exactly one edit between them are the accepted pairs of A o E o A: the acceptor A of the vocabulary, a
transducer E that copies code points and makes one insertion, deletion or replacement, and the acceptor again. The
composition is never built as a whole. It is cut into partitions by its initial states, each composed by one task:

- Two words that are one edit apart share everything before the edit and everything after it. With m the length of the
  shorter one and h = m // 2, either the edit comes after the first h code points, then the machines go through these without
  a choice, and what they can do from there on hangs on that shared beginning alone; or it comes before the last m - h,
  and the same holds for the machines of the reversed language. So a partition is (direction, m, shared part): words of
  length m and m + 1 that share it. Every pair is found in one partition only.
- In a partition the rests of its words become a minimised acceptor, and states (p, edited or not, q) are enumerated: before the
  edit both sides stand in the same state, so there is one path; an edit leads to a pair of states (p, q), and from there both
  must accept the same rest. Whether two states share any rest is remembered, so no branch is walked in vain.
- Of the places where an insertion into a run of equal code points could go, the last counts, so a pair has one path.

A partition with more than ``PARTITION_WORDS`` words is split exactly, again by initial states: by the next code point, for edits
after it, and by the rest after the next code point, for an edit right there. So no task holds more than that many
words, whatever the vocabulary.

Words come from whole texts, a null text has none, a null doc_id counts as an empty text in the hash. Counts are over
all documents, repeated rows count each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaylog.llm.common import stored

# The runs that count as words, and how words are changed.
_RUN = "a-zÀ-ÿ"
MODULUS = 199
SHORTEST = 6
#: Occurrences that make a word, and how many times as often its form has to occur.
OCCURRENCES = 5
MARGIN = 5
#: Words that one task composes at once.
PARTITION_WORDS = 50_000
#: Distinct words that a task counts before it hands them on.
COUNTED = 200_000


def word_counts(docs: DataFrame, least: int = OCCURRENCES, shortest: int = SHORTEST) -> DataFrame:
    """word and n of every word of ``docs`` (doc_id, text), counted in tasks first."""
    runs = re.compile(f"[{_RUN}]{{{shortest},}}")

    def handed_on(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # bytes.lower changes A-Z only
                found = runs.findall(text.encode().lower().decode())
                prefix = zlib.crc32(f"{doc_id}:".encode())
                for run, n in Counter(found).items():
                    h = zlib.crc32(run.encode(), prefix)
                    if h % MODULUS == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < shortest:
                            continue
                    counts[run] += n
                if len(counts) >= COUNTED:
                    yield handed_on(counts)
                    counts.clear()
        yield handed_on(counts)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").alias("text"))
    parts = rows.filter(F.col("text").isNotNull()).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def partitions(words: DataFrame) -> DataFrame:
    """The partitions that each word takes part in: backward, m, shared, rest (reversed if backward), at = false.

    A word of length L can be the shorter or an equal one (m = L), or the longer one (m = L - 1).
    """
    length = F.length("word")

    def rows(m: Column) -> list[Column]:
        h = F.floor(m / 2).cast("int")
        tail = m - h  # code points after the middle
        forward = (F.lit(False), F.substring("word", F.lit(1), h), F.substring("word", h + 1, length))
        backward = (F.lit(True), F.substring("word", length - tail + 1, tail), F.reverse(F.substring("word", F.lit(1), length - tail)))
        return [
            F.struct(b.alias("backward"), m.cast("int").alias("m"), shared.alias("shared"), rest.alias("rest")) for b, shared, rest in (forward, backward)
        ]

    dealt = words.select("word", "n", F.explode(F.array(*rows(length), *rows(length - 1))).alias("p"))
    return dealt.select("p.*", F.lit(False).alias("at"), F.lit("").alias("walked"), "word", "n")


_KEY = ["backward", "m", "shared", "at", "walked"]


def _split(rows: DataFrame) -> DataFrame:
    """Partitions one step further: ``walked`` is what of the rest lies behind. Edits right here get partitions of their own (``at``).

    A word without a rest has no way on; as the shorter word of an insertion at the end it stays in an ``at`` partition.
    """
    after = F.substring("rest", F.lit(2), F.length("rest"))
    first = F.substring("rest", F.lit(1), F.lit(1))
    onward = F.struct(F.lit(False).alias("at"), F.concat("walked", first).alias("walked"), after.alias("rest"))
    # At this very place: a replacement or the longer word of an insertion leaves ``after``, the shorter word its whole rest.
    edited = F.struct(F.lit(True).alias("at"), F.concat("walked", F.lit("\n"), after).alias("walked"), F.col("rest").alias("rest"))
    shorter = F.struct(F.lit(True).alias("at"), F.concat("walked", F.lit("\n"), F.col("rest")).alias("walked"), F.col("rest").alias("rest"))
    own = F.when(F.length("word") > F.col("m"), F.array(onward, edited)).otherwise(F.array(onward, edited, shorter))
    steps = F.when(F.col("rest") == "", F.array(shorter)).otherwise(own)
    return rows.select("backward", "m", "shared", "word", "n", F.explode(steps).alias("s")).select(
        "backward", "m", "shared", "s.rest", "s.at", "s.walked", "word", "n"
    )


class Acceptor:
    """A minimised acyclic acceptor of distinct words, given in code-point order."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = []
        self.final: list[bool] = []
        registered: dict[tuple, int] = {}

        def state(final: bool, arcs: dict[str, int]) -> int:
            """The state with these arcs; equal ones are one."""
            key = (final, *arcs.items())
            if (known := registered.get(key)) is None:
                known = registered[key] = len(self.next)
                self.next.append(arcs)
                self.final.append(final)
            return known

        # The open path of the last word: a word that follows in order can't change what branched off before it.
        path: list[tuple[bool, dict[str, int]]] = [(False, {})]
        last = ""
        for word in [*words, None]:
            common = 0
            if word is not None:
                limit = min(len(word), len(last))
                while common < limit and word[common] == last[common]:
                    common += 1
            for i in range(len(last), common, -1):
                final, arcs = path.pop()
                path[-1][1][last[i - 1]] = state(final, arcs)
            if word is not None:
                path.extend((False, {}) for _ in word[common:])
                path[-1] = (True, path[-1][1])
                last = word
        self.start = state(*path[0])


class Composition:
    """The pairs (u, v) of an acceptor's words with u one edit from v: v is u with one code point inserted, or replaced by a larger one."""

    def __init__(self, acceptor: Acceptor):
        self.a = acceptor
        self.shared: dict[tuple[int, int], bool] = {}

    def _meet(self, p: int, q: int) -> bool:
        """Do the two states accept any common rest?"""
        todo = [(p, q)]
        while todo:
            pair = todo[-1]
            if pair in self.shared:
                todo.pop()
                continue
            p_, q_ = pair
            if p_ == q_ or (self.a.final[p_] and self.a.final[q_]):
                self.shared[pair] = True
                continue
            few, many = sorted((self.a.next[p_], self.a.next[q_]), key=len)
            ways = [(self.a.next[p_][c], self.a.next[q_][c]) for c in few if c in many]
            if any(self.shared.get(w) for w in ways):
                self.shared[pair] = True
            elif unknown := [w for w in ways if w not in self.shared]:
                todo.append(unknown[0])
            else:
                self.shared[pair] = False
        return self.shared[p, q]

    def _rests(self, p: int, q: int) -> Iterator[str]:
        """What both states accept."""
        if not self._meet(p, q):
            return
        todo = [(p, q, "")]
        while todo:
            p, q, walked = todo.pop()
            if self.a.final[p] and self.a.final[q]:
                yield walked
            theirs = self.a.next[q]
            for c, to in self.a.next[p].items():
                if c in theirs and self._meet(to, theirs[c]):
                    todo.append((to, theirs[c], walked + c))

    def pairs(self) -> Iterator[tuple[str, str]]:
        todo = [(self.a.start, "")]
        while todo:  # before the edit: both sides in one state
            p, walked = todo.pop()
            arcs = self.a.next[p]
            todo.extend((to, walked + c) for c, to in arcs.items())
            for c, q in arcs.items():
                # an insertion of c: u goes on from p, v from q; u must not go on with c itself
                if self.a.final[p] and self.a.final[q]:
                    yield walked, walked + c
                theirs = self.a.next[q]
                for d, to in arcs.items():
                    if d != c and d in theirs:
                        for rest in self._rests(to, theirs[d]):
                            yield walked + d + rest, walked + c + d + rest
                # a replacement of a smaller code point by c
                for d, to in arcs.items():
                    if d < c:
                        for rest in self._rests(to, q):
                            yield walked + d + rest, walked + c + rest


def _near_in(key: tuple, rests: list[str], words: list[str]) -> Iterator[tuple[int, int]]:
    """The near pairs of one partition as places in ``words``."""
    backward, m, _, at, walked = key
    if at:  # all differ at one place only: the rest after it is the same
        by_length = defaultdict(list)
        for i, word in enumerate(words):
            by_length[len(word)].append(i)
        after = walked.rpartition("\n")[2]
        for i in by_length[m]:
            if rests[i] == after:  # the shorter word of insertions, if the place is the last of its run
                yield from ((i, j) for j in by_length[m + 1] if rests[j][1:] == after and rests[j][:1] != after[:1])
        replaced = [i for i in by_length[m] if rests[i] and rests[i][1:] == after]
        yield from ((i, j) for x, i in enumerate(replaced) for j in replaced[:x] if rests[i][0] != rests[j][0])
        return
    place: dict[str, list[int]] = defaultdict(list)
    for i, rest in enumerate(rests):
        place[rest].append(i)
    for u, v in Composition(Acceptor(sorted(place))).pairs():
        for i in place[u]:
            for j in place[v]:
                if (len(words[i]), len(words[j])) in ((m, m), (m, m + 1)):
                    yield i, j


def _before_the_middle(key: tuple, u: str, v: str) -> bool:
    """A pair of a backward partition that a forward one has too."""
    h = key[1] // 2
    return key[0] and u[:h] == v[:h]


def near_words(words: DataFrame, partition_words: int = PARTITION_WORDS) -> DataFrame:
    """Per word of ``words`` (word, n; stored) that has any: n_near, and the near word of largest n as form and form_n."""

    def sizes(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("size"))

    open_rows, done = partitions(words), []
    while True:
        large = stored(sizes(open_rows).filter(~F.col("at") & (F.col("size") > partition_words)).select(*_KEY), "large")
        if large.isEmpty():
            done.append(open_rows)
            break
        # Keys of large partitions are few: fewer than a ``partition_words``-th of the rows.
        done.append(open_rows.join(large, _KEY, "left_anti"))
        open_rows = stored(_split(open_rows.join(large, _KEY, "left_semi")), "split")
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, list] = {}
        key, rests, words, counts = None, [], [], []

        def closed() -> None:
            if len(words) < 2:
                return
            for i, j in _near_in(key, rests, words):
                if _before_the_middle(key, words[i], words[j]):
                    continue
                for own, other in ((i, j), (j, i)):
                    place = (-counts[other], words[other])
                    found = best.setdefault(words[own], [0, place])
                    found[0] += 1
                    if place < found[1]:
                        found[1] = place

        def handed_on() -> pa.RecordBatch:
            columns = [list(best), [f[0] for f in best.values()], [f[1][1] for f in best.values()], [-f[1][0] for f in best.values()]]
            types = (pa.string(), pa.int64(), pa.string(), pa.int64())
            best.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["word", "n_near", "form", "form_n"])

        for batch in batches:
            for *own, rest, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != key:
                    closed()
                    key, rests, words, counts = own, [], [], []
                    if len(best) >= COUNTED:
                        yield handed_on()
                rests.append(rest)
                words.append(word)
                counts.append(n)
        closed()
        yield handed_on()

    # A number of its own: by the bytes of the words there would be too few tasks for what is done with them.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*_KEY, "rest", "word", "n").repartition(tasks, *_KEY).sortWithinPartitions(*_KEY)
    found = dealt.mapInArrow(compose, "word string, n_near long, form string, form_n long")
    # The largest n and among equals the smallest word, by code points as by UTF-8 bytes.
    first = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("form")))
    grouped = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    return grouped.select("word", "n_near", F.col("first.form").alias("form"), (-F.col("first.n")).alias("form_n"))


def variants(docs: DataFrame, partition_words: int = PARTITION_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs`` (doc_id, text)."""
    words = stored(word_counts(docs), "words")
    near = near_words(words, partition_words)
    joined = words.join(near, "word", "left")
    enough = F.col("form_n") >= MARGIN * F.col("n")
    table = stored(
        joined.select(
            "word",
            F.when(enough, F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("form_n")).alias("form_n"),
        ),
        "variants",
    )
    # A form occurs MARGIN times as often, so chains are short; each round doubles the steps taken.
    roots = table.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        roots = stored(roots, "roots")
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(further, "root", "left_semi").isEmpty():
            break
        roots = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
