"""Periodic runs of words: stretches that repeat themselves at least twice.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart
are identical) and at least ``max(shortest, 2 * q)`` words that no neighbouring word
extends keeping that period. Two occurrences of the same ``l`` words at distance
``q <= l`` overlap or touch, so together they are a stretch of period ``q`` and
``l + q`` words; where neither the words before nor the words after them agree (a
maximal pair) nothing extends it. Runs are therefore the maximal pairs whose distance
is at most their length, and of pairs over one stretch the one with the least
distance has the smallest period.

Maximal pairs come from the tree of LCP intervals of a text's suffix array, bottom up:
suffixes that meet in an interval without sharing a child have exactly its LCP in
common, and each set of suffixes is kept as lists by left word, so pairs with the same
left word are stepped over, not looked at. The smaller set is always entered into the
larger. Only intervals that can hold the shortest run are built.

Each text is one row, worked on alone: memory is a few numbers a word and level of the
suffix sort. There is no shuffle.

Defined cases: null, empty and blank texts have no words and no runs, their collapsed
text is empty. Runs that end together and begin together are one run, so there are no
ties between runs of a stretch; runs are listed by start, then period. Rows are
independent: repeated rows, null and repeated doc_ids stay as they are. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasweave.llm.catalog import query, table

SHORTEST = 12
#: Words that are looked at together when texts without any repeated window are set aside.
PORTION = 250_000

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``ids`` in order, and how many ids each shares with the one before it.

    Ranks by the first 1, 2, 4, ... ids; only suffixes that still share their rank are
    sorted again. A rank is the number of suffixes before its group.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    first = np.concatenate([[True], ids[order][1:] != ids[order][:-1]])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    alone = first & np.concatenate([first[1:], [True]])
    active, levels, width = order[~alone], [rank], 1
    while len(active):
        after = np.full(len(active), -1, np.int32)
        inside = active + width < n
        after[inside] = rank[active[inside] + width]
        order = np.lexsort((after, rank[active]))
        active, after = active[order], after[order]
        old = rank[active]
        group = np.concatenate([[True], old[1:] != old[:-1]])
        first = group | np.concatenate([[True], after[1:] != after[:-1]])
        at = np.arange(len(active))
        start = np.maximum.accumulate(np.where(group, at, 0))
        rank = rank.copy()
        rank[active] = old + np.maximum.accumulate(np.where(first, at, 0)) - start
        levels.append(rank)
        width *= 2
        alone = first & np.concatenate([first[1:], [True]])
        active = active[~alone]
    suffixes = np.argsort(rank, kind="stable")
    shared = np.zeros(n, np.int64)
    one, two = suffixes[:-1].copy(), suffixes[1:].copy()
    for level in range(len(levels) - 1, -1, -1):
        within = np.flatnonzero((one < n) & (two < n))
        equal = within[levels[level][one[within]] == levels[level][two[within]]]
        shared[1:][equal] += 1 << level
        one[equal] += 1 << level
        two[equal] += 1 << level
    return suffixes, shared


class Places:
    """Places of one substring, by left word, with the places at which the left word changes."""

    __slots__ = ("size", "by_left", "heads", "lefts")

    def __init__(self, place: int, left: int):
        self.size, self.by_left, self.heads, self.lefts = 1, {left: [place]}, [place], [left]

    def add(self, place: int, left: int) -> None:
        self.size += 1
        heads, lefts = self.heads, self.lefts
        k = bisect_right(heads, place) - 1
        if k < 0:
            if lefts[0] == left:
                heads[0] = place
            else:
                heads.insert(0, place)
                lefts.insert(0, left)
        elif lefts[k] != left:
            same = self.by_left[lefts[k]]
            after = bisect_right(same, place)
            if after < len(same) and (k + 1 == len(heads) or same[after] < heads[k + 1]):
                heads[k + 1 : k + 1] = [place, same[after]]
                lefts[k + 1 : k + 1] = [left, lefts[k]]
            elif k + 1 < len(heads) and lefts[k + 1] == left:
                heads[k + 1] = place
            else:
                heads.insert(k + 1, place)
                lefts.insert(k + 1, left)
        if left in self.by_left:
            insort(self.by_left[left], place)
        else:
            self.by_left[left] = [place]

    def others(self, place: int, left: int, reach: int) -> Iterator[int]:
        """Places with another left word at most ``reach`` away."""
        heads, lefts = self.heads, self.lefts
        k = max(bisect_right(heads, place - reach) - 1, 0)
        while k < len(heads) and heads[k] <= place + reach:
            if lefts[k] != left:
                same = self.by_left[lefts[k]]
                end = heads[k + 1] if k + 1 < len(heads) else place + reach + 1
                for other in same[bisect_left(same, max(heads[k], place - reach)) : bisect_left(same, min(end, place + reach + 1))]:
                    yield other
            k += 1


def runs(ids: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``ids``, by start, then period."""
    least = -(-shortest // 2)  # a run of q and l >= q words past it has l + q >= shortest
    if len(ids) <= least:
        return []
    suffixes, shared = suffix_array(ids)
    order, lcp = suffixes.tolist(), shared.tolist()
    lefts = np.concatenate([[-1], ids[:-1]])[suffixes].tolist()
    found: dict[tuple[int, int], int] = {}

    def joined(a: Places, b: Places, length: int) -> Places:
        if a.size < b.size:
            a, b = b, a
        for left, places in b.by_left.items():
            for place in places:
                for other in a.others(place, left, length):
                    period = abs(place - other)
                    if period + length >= shortest:
                        key = min(place, other), period + length
                        found[key] = min(found.get(key, period), period)
        for left, places in b.by_left.items():
            for place in places:
                a.add(place, left)
        return a

    ends = np.flatnonzero(shared < least).tolist() + [len(order)]
    for begin, end in zip(ends, ends[1:]):
        if end - begin < 2:
            continue
        open_intervals: list[tuple[int, Places]] = []
        current = Places(order[begin], lefts[begin])
        for k in range(begin + 1, end + 1):
            length = lcp[k] if k < end else 0
            while open_intervals and open_intervals[-1][0] > length:
                depth, places = open_intervals.pop()
                current = joined(places, current, depth)
            if k == end:
                break
            if open_intervals and open_intervals[-1][0] == length:
                current = joined(open_intervals.pop()[1], current, length)
            open_intervals.append((length, current))
            current = Places(order[k], lefts[k])
    return sorted((start, length, period) for (start, length), period in found.items())


def _repeating(ids: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    """Owners that have some window of ``width`` ids twice; no window reaches into the next owner."""
    n = len(ids)

    def ranked(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1].reshape(-1)

    window, have = ids, 1
    spans = {1: ids}
    while have * 2 <= width:
        window = ranked(window[: len(window) - have], window[have:]) if len(window) > have else window[:0]
        have *= 2
        spans[have] = window
        if not len(window):
            return owner[:0]
    for part in sorted(spans, reverse=True)[1:]:
        if have + part <= width:
            tail = spans[part][have:]
            m = min(len(window), len(tail))
            if not m:
                return owner[:0]
            window, have = ranked(window[:m], tail[:m]), have + part
    window = window[: n - width + 1]
    inside = owner[: len(window)] == owner[width - 1 : width - 1 + len(window)]
    key = owner[: len(window)][inside].astype(np.int64) * (int(window.max()) + 1) + window[inside]
    values, counts = np.unique(key, return_counts=True)
    return np.unique(values[counts > 1] // (int(window.max()) + 1))


def _of_texts(texts: list[list[bytes]], shortest: int) -> Iterator[tuple[list[tuple[int, int, int]], list[bytes]]]:
    """Runs of each text and the words that stay."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in texts]
    sizes = [len(i) for i in ids]
    repeating = set()
    if sum(sizes):
        repeating = set(_repeating(np.concatenate(ids), np.repeat(np.arange(len(ids)), sizes), -(-shortest // 2)).tolist())
    for at, words in enumerate(texts):
        found = runs(np.unique(ids[at], return_inverse=True)[1].reshape(-1), shortest) if at in repeating else []
        if found:
            change = np.zeros(len(words) + 1, np.int64)
            for start, length, period in found:
                change[start + period] += 1
                change[start + length] -= 1
            stay = np.cumsum(change[:-1]) == 0
            words = [w for w, s in zip(words, stay.tolist()) if s]
        yield found, words


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period), collapsed.

    ``collapsed`` has the words that no run repeats, joined by one space: of each run
    its first period stays, unless another run drops part of it.
    """
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")])

        def done(owners: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
            results = list(_of_texts(texts, shortest))
            lengths = [len(found) for found, _ in results]
            flat = np.array([r for found, _ in results for r in found], np.int64).reshape(-1, 3)
            spans = pa.StructArray.from_arrays([pa.array(flat[:, i].copy()) for i in range(3)], fields=list(run_type))
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [owners, pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(offsets, spans),
                 pa.array([b" ".join(words) for _, words in results], pa.binary())],
                ["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            begin, texts, held = 0, [], 0
            for at, text in enumerate(batch.column("text")):
                texts.append((text.as_py() or b"").split())
                held += len(texts[-1])
                if held >= PORTION:
                    yield done(batch.column("doc_id").slice(begin, len(texts)), texts)
                    begin, texts, held = at + 1, [], 0
            if texts:
                yield done(batch.column("doc_id").slice(begin, len(texts)), texts)

    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN, True)), T.StructField("collapsed", T.BinaryType())])
    found = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """The text, of one document in ten with its tail replaced by repetitions of the tail's beginning.

    ``h``, ``a``, ``p`` as the query's contract has them; texts of other documents are untouched.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1)).cast("long")
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    tail = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), F.lit(1), n.cast("int")), " ")
    return F.when(h % 10 == 0, planted).otherwise(text)


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, its longest run and the digest of the text without the repetitions."""
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", with_planted_runs(F.col("doc_id"), F.col("text")).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
