"""License scans by patience alignment.

A template and a stretch of a document are aligned like two versions of a text: words
that occur exactly once in both are anchors; the longest run of anchors that keeps
the order of both is taken; gaps between anchors are aligned in the same way, after
words that agree at either end of a gap, and a gap without anchors by its longest
common subsequence. Coverage is the share of the template's words that are aligned.

Stretches are chosen so that none is missed: where coverage is at least ``coverage``
(for short templates, 1), at least that share of the template's words is aligned, so among any of its words
that make up the rest and one more, one is. The rarest such words in the document are
taken, and around each place of theirs a stretch of the template's length to either
side, and a quarter more, is aligned.

Texts stay where they are; there is no shuffle. Whole texts are scanned.

Defined cases: null, empty and short texts have no license and coverage 0; of equal
coverages the longer template, then the first id counts; repeated rows stay rows;
other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasweave.llm.catalog import query, table
from atlasweave.llm.decontaminate import words
from atlasweave.llm.license_texts import TEMPLATES

COVERAGE = 0.8
#: Of templates with fewer words every word must be aligned, with none between: one word tells such notices apart.
SHORT = 12
#: Gaps without anchors of up to so many pairs of words are aligned in one table; larger ones are halved until they fit.
TABLE = 40_000


def rising(values: list[int]) -> list[int]:
    """Indices of a longest strictly rising subsequence, by patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    before = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        before.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _lengths(a: list[int], b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of ``a`` and every beginning of ``b``, one row held at a time."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], np.where(b == x, row[:-1] + 1, 0)))
    return row


def _common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of a longest common subsequence, in memory that grows with the lengths, not with their product.

    Beyond a small table the halves of ``a`` are aligned with the two parts of ``b`` that suit them best.
    """
    if len(a) > 1 and len(a) * len(b) > TABLE:
        half, other = len(a) // 2, np.array(b)
        upper = _lengths(a[:half], other)
        lower = _lengths(a[half:][::-1], other[::-1])[::-1]
        cut = int(np.argmax(upper + lower))
        return _common(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in _common(a[half:], b[cut:])]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if a[i] == b[j] else max(below[j], row[j + 1])
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs (i, j), rising in both, of equal words a[i] and b[j], by patience alignment."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, low, high = todo.pop()
        while lo < hi and low < high and a[lo] == b[low]:
            pairs.append((lo, low))
            lo, low = lo + 1, low + 1
        while lo < hi and low < high and a[hi - 1] == b[high - 1]:
            hi, high = hi - 1, high - 1
            pairs.append((hi, high))
        if lo >= hi or low >= high:
            continue
        places: dict[int, list[int]] = defaultdict(list)
        for j in range(low, high):
            places[b[j]].append(j)
        count: dict[int, int] = defaultdict(int)
        for i in range(lo, hi):
            count[a[i]] += 1
        anchors = [(i, places[a[i]][0]) for i in range(lo, hi) if count[a[i]] == 1 and len(places.get(a[i], ())) == 1]
        anchors = [anchors[k] for k in rising([j for _, j in anchors])]
        if not anchors:
            pairs += [(i + lo, j + low) for i, j in _common(a[lo:hi], b[low:high])]
            continue
        pairs += anchors
        edges = [(lo - 1, low - 1), *anchors, (hi, high)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(pairs)


class Scanner:
    """Templates ready to be looked for."""

    def __init__(self, templates: list[tuple[str, str]], coverage: float):
        self.coverage = coverage
        self.numbers: dict[bytes, int] = {}
        self.templates = []
        for name, text in templates:
            ids = [self.numbers.setdefault(w, len(self.numbers)) for w in words(text.encode())]
            count: dict[int, int] = defaultdict(int)
            for i in ids:
                count[i] += 1
            self.templates.append((name, ids, dict(count)))

    def __call__(self, text: bytes | None) -> list[tuple[str, float, int, int, int]]:
        """(license, coverage, template words, first word, end) of the best stretch of each license found."""
        places: dict[int, list[int]] = {}
        ids, at = [], []
        number = self.numbers
        for k, word in enumerate(words(text)):
            if word in number:
                i = number[word]
                ids.append(i)
                at.append(k)
                places.setdefault(i, []).append(len(ids) - 1)
        found: dict[str, tuple[str, float, int, int, int]] = {}
        for name, template, count in self.templates:
            size = len(template)
            least = self.coverage * size if size >= SHORT else size
            if sum(n for i, n in count.items() if i in places) < least:
                continue
            slack = size - least
            rare, made_up = [], 0
            for i, n in sorted(count.items(), key=lambda x: len(places.get(x[0], ()))):
                rare.append(i)
                made_up += n
                if made_up > slack:
                    break
            reach = size + size // 4 + 5
            done = -1
            for middle in sorted(k for i in rare for k in places.get(i, ())):
                if middle < done:
                    continue  # inside the stretch that was just matched
                if size < SHORT:  # a notice stands word by word
                    low = next((middle - k for k in range(min(size, middle + 1)) if ids[middle - k : middle - k + size] == template), middle)
                    high = low + size
                    if high > len(ids) or at[high - 1] - at[low] != size - 1:
                        continue
                else:
                    low = bisect_left(at, at[middle] - reach)
                    high = bisect_left(at, at[middle] + reach + 1)
                if high - low < least:
                    continue
                pairs = aligned(template, ids[low:high])
                share = len(pairs) / size
                if len(pairs) >= least:
                    first, end = at[low + pairs[0][1]], at[low + pairs[-1][1]] + 1
                    done = low + pairs[-1][1] + 1
                    hit = (name, share, size, first, end)
                    old = found.get(name)
                    if old is None or (share, size, -first) > (old[1], old[2], -old[3]):
                        found[name] = hit
        return sorted(found.values(), key=lambda x: (-x[1], -x[2], x[0]))


def scanned(docs: DataFrame, keep: list[str], templates: list[tuple[str, str]] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """The columns ``keep`` of every row, with license, coverage, first_word, end_word, licenses."""
    width = len(keep)
    names = [*keep, "license", "coverage", "first_word", "end_word", "licenses"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(templates, coverage)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                hits = [scan(t.as_py()) for t in part.column(width)]
                best = [h[0] if h else (None, 0.0, 0, None, None) for h in hits]
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:width], pa.array([b[0] for b in best], pa.string()), pa.array([b[1] for b in best], pa.float64()),
                    pa.array([b[3] for b in best], pa.int64()), pa.array([b[4] for b in best], pa.int64()),
                    pa.array([sorted(x[0] for x in h) for h in hits], pa.list_(pa.string()))], names)

    schema = T.StructType([
        *(docs.schema[c] for c in keep), T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()),
        T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType()),
        T.StructField("licenses", T.ArrayType(T.StringType()))])
    return docs.select(*keep, F.col("text").cast("binary").alias("__text")).mapInArrow(run, schema)


@query("op10_licenses")
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document, with the words that carry it."""
    return scanned(table(spark, sf_dir, "documents"), ["doc_id"])
