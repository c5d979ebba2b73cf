"""Benchmark decontamination with an FM-index per shard of training text.

Test items give windows of ten words (an item of fewer words is one window). A shard
of documents is mapped to the words of the items; all other words separate. What lies
between separators and is long enough for a window is indexed, all windows are
searched backwards at once, occurrences are located, and their spans merged per
document. Documents need no shuffle.

Items are taken in blocks of a bounded number of words, one after another: a block is
collected and broadcast, the documents with hits are stored, and it is given up before
the next one is read. One block needs neither the stored table nor the join that follows.

Defined cases: null or empty texts have no words; an item without words has no
window; a null item_id is the empty string; rows that repeat an item_id count once;
repeated documents stay rows. Empty tables are fine on either side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from atlasweave.llm.catalog import query, table
from atlasweave.llm.fm_index import FMIndex
from atlasweave.llm.stored import stored

WINDOW = 10
#: Words of items in a block, and words of documents that are indexed together, about.
BLOCK_WORDS, SHARD_WORDS = 1_000_000, 3_000_000
FOUND = "array<struct<start:long,end:long>>"

# Word characters: digits, letters, and all bytes beyond ASCII; capitals as small ones, the rest as blanks.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


class Windows:
    """Windows of a block of items (item_id, text)."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple, set] = {}
        self.items = sorted({i for i, _ in items})
        name = {i: k for k, i in enumerate(self.items)}
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)]
            for at in range(max(len(ids) - window, 0) + 1 if ids else 0):
                found.setdefault(tuple(ids[at : at + window]), set()).add(name[item])
        self.sizes = np.array([len(w) for w in found], np.int64)
        self.shortest = int(self.sizes.min()) if found else 0
        self.patterns = np.zeros((len(found), window), np.int64)
        for row, w in enumerate(found):
            self.patterns[row, window - len(w) :] = w
        owners = [sorted(o) for o in found.values()]
        self.owner_ends = np.cumsum([len(o) for o in owners])
        self.owners = np.array([i for o in owners for i in o], np.int64)

    def occurrences(self, texts: list[bytes | None]) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
        """Per text: its number of words, merged spans of words hit, items that occur."""
        counts, docs, starts, parts = [], [], [], []
        for doc, text in enumerate(texts):
            own = words(text)
            counts.append(len(own))
            if len(own) < self.shortest or not self.shortest:
                continue
            ids = np.fromiter(map(self.numbers.get, own, repeat(0)), np.int64, len(own))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], ids != 0, [0]])))
            begin, end = edge[::2], edge[1::2]
            for b, e in zip(begin[end - begin >= self.shortest].tolist(), end[end - begin >= self.shortest].tolist()):
                docs.append(doc)
                starts.append(b)
                parts.append(ids[b:e])
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[list[str]] = [[] for _ in texts]
        if not parts:
            return counts, spans, items
        gap = np.zeros(1, np.int64)
        index = FMIndex(np.concatenate([x for p in parts for x in (p, gap)]))
        first, end = index.search(self.patterns, self.sizes)
        hit = np.flatnonzero(end > first)
        if not len(hit):
            return counts, spans, items
        times = end[hit] - first[hit]
        window = np.repeat(hit, times)
        rows = np.arange(times.sum()) + np.repeat(first[hit] - np.cumsum(times) + times, times)
        at = index.locate(rows)
        part_start = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])[:-1]])
        part = np.searchsorted(part_start, at, side="right") - 1
        doc = np.array(docs)[part]
        depth = np.zeros(index.n + 1, np.int64)
        np.add.at(depth, at, 1)
        np.add.at(depth, at + self.sizes[window], -1)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(depth) > 0, [0]])))
        for b, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            k = int(np.searchsorted(part_start, b, side="right")) - 1
            shift = starts[k] - int(part_start[k])
            spans[docs[k]].append((b + shift, e + shift))
        pairs = np.unique(doc * len(self.sizes) + window)
        doc, window = pairs // len(self.sizes), pairs % len(self.sizes)
        size = np.diff(self.owner_ends, prepend=0)[window]
        owner = self.owners[np.arange(size.sum()) + np.repeat(self.owner_ends[window] - np.cumsum(size), size)]
        pairs = np.unique(np.repeat(doc, size) * len(self.items) + owner)
        for d, i in zip((pairs // len(self.items)).tolist(), (pairs % len(self.items)).tolist()):
            items[d].append(self.items[i])
        return counts, spans, items


def merged(one: list[tuple[int, int]], two: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of two lists of spans."""
    out: list[tuple[int, int]] = []
    for b, e in sorted(one + two):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def _pass(rows: DataFrame, shipped, window: int) -> DataFrame:
    """``rows`` (row, text, n_words, spans, items) with what the block of items that is ``shipped``, a broadcast, adds."""
    kinds, names = [to_arrow_type(f.dataType) for f in rows.schema.fields], rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(shipped.value, window)

        def finish(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts = [t.as_py() for b in held for t in b.column(1)]
            counts, spans, items = windows.occurrences(texts)
            at = 0
            for b in held:
                end = at + b.num_rows
                old_spans = [[(s["start"], s["end"]) for s in x] for x in b.column(3).to_pylist()]
                old_items = b.column(4).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1), pa.array(counts[at:end], kinds[2]),
                    pa.array([[{"start": s, "end": e} for s, e in merged(x, y)] for x, y in zip(old_spans, spans[at:end])], kinds[3]),
                    pa.array([sorted({*x, *y}) for x, y in zip(old_items, items[at:end])], kinds[4])], names=names)
                at = end

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                held.append(part := batch.slice(start, 128))
                size += sum(len(t.as_buffer()) for t in part.column(1) if t.is_valid) // 6
                if size >= SHARD_WORDS:
                    yield from finish(held)
                    held, size = [], 0
        if held:
            yield from finish(held)

    return rows.mapInArrow(run, rows.schema)


def occurrences(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per row of ``docs``: row (a struct of the columns in ``keep``), n_words, spans, items."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / 6 / block_words))
    placed = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    rows = docs.select(
        F.struct(*[docs[c] for c in keep]).alias("row"), F.col("text").cast("binary").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.expr(f"cast(array() as {FOUND})").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"))

    def of_block(block: int):
        own = placed.where(F.col("block") == block).select("item", "text").collect()  # about ``block_words`` words
        return docs.sparkSession.sparkContext.broadcast([(r["item"], bytes(r["text"])) for r in own])

    if blocks == 1:
        return _pass(rows, of_block(0), window).drop("text")
    # One block is held at a time: what it finds, rows with a hit only, is stored before the next one is read.
    same = F.sha2(F.concat_ws("|", F.to_json("row", {"ignoreNullFields": "false"}), F.hex(F.coalesce("text", F.lit(b"")))), 256).alias("same")
    hits = None
    for block in range(blocks):
        shipped = of_block(block)
        found = stored(_pass(rows, shipped, window).where(F.size("spans") > 0).select(same, "spans", "items"), "block-hits")
        shipped.unpersist()
        hits = found if hits is None else hits.unionByName(found)
    joined = stored(hits.groupBy(F.col("same").alias("hit")).agg(
        F.flatten(F.collect_set("spans")).alias("all_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("all_items")), "hits")
    # Intervals in order, each put to the one before where they meet.
    together = F.aggregate(
        F.array_sort("all_spans"), F.expr(f"cast(array() as {FOUND})"),
        lambda x, s: F.when((F.size(x) > 0) & (s["start"] <= F.element_at(x, -1)["end"]), F.concat(
            F.slice(x, F.lit(1), F.size(x) - 1),
            F.array(F.named_struct(F.lit("start"), F.element_at(x, -1)["start"], F.lit("end"), F.greatest(F.element_at(x, -1)["end"], s["end"])))),
        ).otherwise(F.concat(x, F.array(s))))
    counted = _pass(rows, docs.sparkSession.sparkContext.broadcast([]), window).select("row", same, "n_words")
    return counted.join(joined, F.col("same") == F.col("hit"), "left").select(
        "row", "n_words", F.when(F.col("hit").isNull(), F.expr(f"cast(array() as {FOUND})")).otherwise(together).alias("spans"),
        F.coalesce("all_items", F.expr("cast(array() as array<string>)")).alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window of ``benchmark`` occurs, all columns kept."""
    return occurrences(docs, benchmark, docs.columns).where(F.size("spans") == 0).select("row.*")


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the words in ``spans``, from the beginning of a span's first word to its last one's end."""
    if not text or not spans:
        return text
    raw = text.encode()
    plain = raw.translate(_TO_WORDS)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(plain, np.uint8) != 32, [0]])))
    out, at = [], 0
    for first, end in spans:
        out.append(raw[at : edge[2 * first]])
        at = int(edge[2 * end - 1])
    return b"".join([*out, raw[at:]]).decode("utf-8", "replace")


def cut(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with every occurrence cut out of ``text``, all columns kept."""
    found = occurrences(docs, benchmark, docs.columns)

    @F.pandas_udf(T.StringType())
    def shorten(text, spans):
        import pandas as pd

        return pd.Series([without_spans(t, [(s["start"], s["end"]) for s in x]) for t, x in zip(text, spans)])

    text = F.when(F.size("spans") > 0, shorten("row.text", "spans")).otherwise(F.col("row.text"))
    return found.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


@query("op6_decontamination")
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark in every document."""
    found = occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "spans")
