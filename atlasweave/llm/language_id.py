"""Language identification by prediction by partial matching over bytes.

For each language, counts of the byte after each context of up to three bytes form a
context tree. A byte costs its code length under the longest context known: seen
there, log2((n + d) / count) for n occurrences and d different bytes after the
context; else an escape of log2((n + d) / d) and its cost under the next shorter
context, in which the bytes already ruled out no longer count (full exclusion); below
the root, bytes never seen share what is left evenly. Under every context the
probabilities of all bytes thus add up to one, so totals are exact code lengths.

The statistics are frozen: the costs of every byte under every known context are
worked out once, for all languages side by side, and a text is scored by two look-ups
a byte. The language with the shortest code wins, of equal ones the first by name.

The model is learned from a bounded sample of labelled rows (``sample_rows`` a
language, about, picked by a hash of doc_id), and contexts of fewer than
``min_context`` occurrences count as unknown. Scoring reads every whole text.

Texts are lower-cased, and each run of ASCII characters other than letters becomes
one space.

Defined cases: null text, or text without a letter, is ``und`` with score 0, and so is
every text where nothing could be learned; a null doc_id is not held out and not
learned from; repeated rows stay rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasweave.llm.catalog import query, table
from atlasweave.session import sized_broadcast

ORDER = 3
_LETTERS_ONLY = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Bytes of text scored at once.
STEP = 1 << 20


def prepared(text: str) -> bytes:
    """The bytes that are modelled, after ORDER spaces as a beginning."""
    return b" " * ORDER + b" ".join(text.lower().encode().translate(_LETTERS_ONLY).split()) + b" "


def remainder(key: Column, divisor: int) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(divisor))


def sampled(rows: DataFrame, group: str, most: int, seed: int) -> DataFrame:
    """About ``most`` rows of each value of ``group``, picked by a hash of doc_id."""
    sizes = rows.groupBy(F.col(group).alias("__group")).agg(F.count(F.lit(1)).alias("__size"))
    share = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # A row per value of the group; beyond a checked number of them both sides are shuffled.
    return rows.join(sized_broadcast(sizes, 10_000), F.col(group) == F.col("__group")).where(share * F.col("__size") < most).drop("__group", "__size")


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): counts of ORDER + 1 bytes, first byte highest, in a task's texts."""
    held: dict[str, list[np.ndarray]] = defaultdict(list)
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def settle(lang: str) -> None:
        grams, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
        if lang in total:
            grams, back = np.unique(np.concatenate([total[lang][0], grams]), return_inverse=True)
            n = np.bincount(back, np.concatenate([total[lang][1], n])).astype(np.int64)
        total[lang] = grams, n

    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x = np.frombuffer(prepared(text.decode("utf-8", "replace")), np.uint8).astype(np.int64)
            held[lang].append(((x[:-3] << 8 | x[1:-2]) << 8 | x[2:-1]) << 8 | x[3:])
            size += len(x)
            if size >= STEP:
                for name in list(held):
                    settle(name)
                size = 0
    for name in list(held):
        settle(name)
    for lang, (grams, n) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), pa.array(grams), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


@dataclass
class Model:
    """languages; classes: class of each byte; row_of: context -> row; costs: (row, class) -> bits by language."""

    languages: list[str]
    classes: bytes
    width: int
    row_of: np.ndarray
    costs: np.ndarray

    def bits(self, text: str) -> np.ndarray:
        """Code length of ``text`` in each language."""
        x = np.frombuffer(prepared(text).translate(self.classes), np.uint8)
        total = np.zeros(len(self.languages))
        for at in range(ORDER, len(x), STEP):
            y = x[at - ORDER : at + STEP].astype(np.int32)
            context = (y[:-3] * self.width + y[1:-2]) * self.width + y[2:-1]
            total += self.costs[self.row_of[context] * self.width + y[3:]].sum(axis=0, dtype=np.float64)
        return total


def _excluded(levels: list[np.ndarray], spare: np.ndarray) -> np.ndarray:
    """Costs of all classes for rows of contexts; ``levels``: counts (row, class), longest context first.

    ``spare`` is the number of bytes that a class stands for. Counts of a shorter
    context include those of the longer one.
    """
    cost = np.zeros(levels[0].shape)
    open_ = np.ones(levels[0].shape, bool)  # not yet coded, hence not yet ruled out
    for counts in levels:
        left = counts * open_
        n, d = left.sum(axis=1, keepdims=True), (left > 0).sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore"):
            whole = np.log2(np.maximum(n + d, 1))
            seen = left > 0
            cost += np.where(seen, whole - np.log2(np.maximum(left, 1)), np.where(open_ & (d > 0), whole - np.log2(np.maximum(d, 1)), 0))
        open_ &= ~seen
    rest = (open_ * spare).sum(axis=1, keepdims=True)
    return cost + np.where(open_, np.log2(np.maximum(rest, 1)), 0)


def build(grams: list[tuple[str, int, int]], min_context: int) -> Model:
    """Costs from (lang, gram, n) rows."""
    languages = sorted({g[0] for g in grams})
    alphabet = sorted({(g[1] >> shift) & 255 for g in grams for shift in (0, 8, 16, 24)})
    width = len(alphabet) + 1  # the last class: bytes that were never seen
    classes = bytearray([width - 1] * 256)
    for k, b in enumerate(alphabet):
        classes[b] = k
    spare = np.ones(width)
    spare[-1] = 256 - len(alphabet)
    code = np.array(list(classes), np.int64)
    known: dict[str, list[dict[int, np.ndarray]]] = {}
    contexts: list[set[int]] = [set() for _ in range(ORDER + 1)]
    for lang in languages:
        rows = np.array([(g, n) for name, g, n in grams if name == lang], np.int64)
        levels = []
        for order in range(ORDER + 1):
            context = np.zeros(len(rows), np.int64)
            for back in range(order, 0, -1):
                context = context * width + code[(rows[:, 0] >> (8 * back)) & 255]
            names, at = np.unique(context, return_inverse=True)
            counts = np.zeros((len(names), width))
            np.add.at(counts, (at, code[rows[:, 0] & 255]), rows[:, 1])
            enough = counts.sum(axis=1) >= (min_context if order else 0)
            levels.append(dict(zip(names[enough].tolist(), counts[enough])))
            contexts[order].update(levels[-1])
        known[lang] = levels
    # One row per context known to any language, shorter ones first; the longest known one of a context is its row.
    numbers = [(order, c) for order in range(ORDER + 1) for c in sorted(contexts[order])] or [(0, 0)]
    costs = np.zeros((len(numbers), width, len(languages)), np.float32)
    for which, lang in enumerate(languages):
        for start in range(0, len(numbers), 4096):
            part = numbers[start : start + 4096]
            levels = [np.zeros((len(part), width)) for _ in range(ORDER + 1)]
            for row, (order, context) in enumerate(part):
                for shorter in range(order, -1, -1):
                    counts = known[lang][shorter].get(context % width**shorter)
                    if counts is not None:
                        levels[ORDER - shorter][row] = counts
            costs[start : start + 4096, :, which] = _excluded(levels, spare)
    row_of = np.zeros(width**ORDER, np.int32)
    every = np.arange(width**ORDER)
    at = {key: row for row, key in enumerate(numbers)}
    for order in range(1, ORDER + 1):
        shorter = np.full(width**order, -1, np.int32)
        for c in contexts[order]:
            shorter[c] = at[order, c]
        found = shorter[every % width**order]
        row_of = np.where(found >= 0, found, row_of)
    return Model(languages, bytes(classes), width, row_of, costs.reshape(len(numbers) * width, len(languages)))


def learn(labelled: DataFrame, sample_rows: int = 3000, min_context: int = 12) -> Model:
    """A model from rows (doc_id, text, lang); see the module for what is sampled."""
    rows = sampled(labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang"), "lang", sample_rows, 1)
    counts = rows.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(_grams, "lang string, gram long, n long")
    grams = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # bounded by the sample
    return build(list(zip(*(grams.column(c).to_pylist() for c in ("lang", "gram", "n")))), min_context)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row of ``docs``, with lang_pred and score."""
    shipped = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.classes, model.width, model.row_of, model.costs))  # its classes travel with the function
    fields = [docs.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shipped.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                names, scores = [], []
                for text, letters in zip(part.column(len(keep)), part.column(len(keep) + 1)):
                    if not letters.as_py() or not model.languages:
                        names.append("und")
                        scores.append(0.0)
                        continue
                    bits = model.bits(text.as_py().decode("utf-8", "replace"))
                    best = int(bits.argmin())
                    names.append(model.languages[best])
                    scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], pa.array(names), pa.array(scores)], [*keep, "lang_pred", "score"])

    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select(*keep, F.col("text").cast("binary").alias("__text"), has_letter.alias("__letters")).mapInArrow(run, schema)


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    model = learn(docs.where(remainder(F.col("doc_id"), 4) != 2))
    return predict(docs, model, ["doc_id"]).select("doc_id", out.alias("held_out"), "lang_pred", "score")
