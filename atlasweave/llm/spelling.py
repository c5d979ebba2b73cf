"""Spelling variants: words one edit apart, grouped under their commonest form.

Words of a corpus are counted in one pass. Two words are near if exactly one inserted,
deleted or replaced code point makes one the other. To find all near pairs, letters
are hashed to a few symbols (six or seven for a vocabulary of 300,000): words one edit apart have reduced words that are equal or
one edit apart. Of each distinct reduced word the whole one-edit neighbourhood over
the few symbols is generated (its size grows with the word's length and the number of
symbols only, not with the alphabet) and joined with the reduced words themselves; each
pair of reduced words meets once, and the words behind it are verified on their
original letters.

A word's form is its near word of largest count, where that is at least twice the
word's own; counts double along forms, so following them ends, and pointer jumping
takes a logarithm of that many joins.

Counting emits each task's words with their counts; all else is DataFrame operations.
A word with very many near words, or a reduced word with very many words behind it, is
a hot key of an equality join, which adaptive execution splits; nothing is collected.

Defined cases: null, empty and blank texts have no words. Words of a row without
doc_id are counted as they are. Of near words with equal counts the smallest in
code-point order is the form. Repeated rows count each time. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasweave.llm.catalog import query, table
from atlasweave.llm.stored import stored

MIN_LETTERS = 5
MIN_COUNT = 3
RATIO = 2
#: Distinct words a counting task holds before it passes their counts on.
HELD = 500_000
#: Reduced words whose neighbourhoods one task generates, about.
SHARE = 20_000

# Runs of a-z and U+00C0 to U+00FF in UTF-8, and bytes that no such run contains as blanks, A-Z lower-cased.
WORD = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
INSIDE = bytes(b if chr(b).islower() and b < 128 or b == 0xC3 or 0x80 <= b < 0xC0 else b | 0x20 if chr(b).isupper() and b < 128 else 0x20
               for b in range(256))
LETTERS = [chr(c) for c in range(ord("a"), ord("z") + 1)] + [chr(c) for c in range(0xC0, 0x100)]


def letter_runs(text: bytes) -> list[bytes]:
    """Lower-cased letter runs of a text. Pieces that are ASCII are runs; others are looked at byte by byte."""
    pieces = text.translate(INSIDE).split()
    if text.isascii():
        return pieces
    return [w for p in pieces for w in ((p,) if p.isascii() else WORD.findall(p))]


def altered(doc_id, words: list[bytes]) -> list[bytes]:
    """The words of one document, each whose hash with the doc_id 97 divides without one of its letters."""
    seed = zlib.crc32(b"%d:" % doc_id)
    crc = zlib.crc32
    for at in [i for i, w in enumerate(words) if not crc(w, seed) % 97]:
        word = words[at].decode()
        drop = crc(words[at], seed) % len(word)
        words[at] = (word[:drop] + word[drop + 1 :]).encode()
    return words


def word_counts(docs: DataFrame, alter: Callable | None = None) -> DataFrame:
    """(word, n) of the lower-cased letter runs of all texts; ``alter(doc_id, words)`` may change a document's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                words = letter_runs(text.as_py() or b"")
                if alter is not None and doc_id.is_valid:
                    words = alter(doc_id.as_py(), words)
                held.update(words)
                if len(held) > HELD:
                    yield passed_on()
                    held.clear()
        yield passed_on()

    schema = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])
    counted = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).select(F.col("word").cast("string").alias("word"), "n")


def symbols_for(words: int) -> int:
    """Symbols for a vocabulary: with as many, strings of seven symbols are about as many as words.

    Any number gives the same pairs; few make large buckets, many large neighbourhoods.
    """
    return next(s for s in range(4, len(LETTERS) + 1) if s**7 >= words or s == len(LETTERS))


def symbol(s: int) -> str:
    """One of the symbols: a character that needs no escape in SQL."""
    return chr(ord("0") + s if s < 43 else 0x100 + s)


def reduced(word, symbols: int):
    """``word`` with each letter replaced by one of ``symbols`` symbols."""
    return F.translate(word, "".join(LETTERS), "".join(symbol(ord(c) % symbols) for c in LETTERS))


def neighbourhood(symbols: int) -> str:
    """All strings one edit from ``short``, itself included, that are not greater than it, as SQL."""
    alphabet = ", ".join(f"'{symbol(s)}'" for s in range(symbols))
    return f"""filter(array_distinct(concat(
        array(short),
        transform(sequence(1, length(short)), i -> concat(left(short, i - 1), substr(short, i + 1))),
        flatten(transform(array({alphabet}), c -> concat(
            transform(sequence(1, length(short)), i -> concat(left(short, i - 1), c, substr(short, i + 1))),
            transform(sequence(1, length(short) + 1), i -> concat(left(short, i - 1), c, substr(short, i))))))
    )), x -> x <= short)"""


def near_pairs(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """(word, n, near, near_n), both ways round, of all words (word, n) one edit apart."""
    size = words.count()
    symbols = symbols or symbols_for(size)
    tasks = -(-size // SHARE) or 1
    vocabulary = stored(words.select("word", "n", reduced(F.col("word"), symbols).alias("short")), "vocabulary")
    shorts = stored(vocabulary.select("short").distinct().repartition(tasks, "short"), "reduced-words")
    met = shorts.repartition(tasks).select("short", F.explode(F.expr(neighbourhood(symbols))).alias("edited")).join(
        shorts.select(F.col("short").alias("other")), F.col("edited") == F.col("other")).select("short", "other")
    one = stored(met.join(vocabulary, "short"), "met").repartition(tasks, "other")
    two = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("short").alias("near_short"))
    close = (F.abs(F.length("word") - F.length("near")) <= 1) & (F.levenshtein("word", "near", 1) == 1)
    once = one.join(two, (F.col("other") == F.col("near_short")) & ((F.col("short") != F.col("other")) | (F.col("word") < F.col("near"))) & close)
    return once.select(F.explode(F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of ``forms`` (word, form), by jumping from form to form's form."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        jumped = stored(now.join(step, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if jumped.where("moved").isEmpty():
            return now
        now = jumped.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, symbols: int | None = None) -> DataFrame:
    """One row per word of ``words`` (word, n): word, form, root, n, n_near, form_n."""
    words = stored(words, "words")
    near = near_pairs(words, symbols).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    near = stored(near.select(
        F.col("word").alias("w"), "n_near", F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n")), "near")
    ends = roots(near.where("form IS NOT NULL").select(F.col("w").alias("word"), "form")).select(F.col("word").alias("r"), "root")
    return words.join(near, F.col("word") == F.col("w"), "left").join(ends, F.col("word") == F.col("r"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n")


@query("op13_spelling")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least five letters and three occurrences, with their commonest near word."""
    words = word_counts(table(spark, sf_dir, "documents"), altered)
    return variants(words.where((F.length("word") >= MIN_LETTERS) & (F.col("n") >= MIN_COUNT)))
