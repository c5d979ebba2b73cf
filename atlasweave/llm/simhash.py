"""SimHash fingerprints and near-duplicates by multi-index hashing.

A fingerprint has 64 bits. Two that differ in at most three bits agree in one of
their two 32-bit segments but for at most one bit. Each distinct fingerprint is
therefore entered under both of its segments and under every segment value that one
bit turned on would give; of two segments one bit apart the one with the bit off
reaches the other, so turning bits off is not needed. Entries that share a key are
compared on all 64 bits.

Keys under which very many different fingerprints meet are split into pairs of
blocks of bounded size, so that no task holds a whole bucket. Within a bucket only a
spanning forest of the links found goes on, never all pairs.

Defined cases: null, empty and blank texts have fingerprint zero and are linked like
any other. Repeated rows and ids are kept as rows; a component's id is the smallest
non-null doc_id in it. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_digest

from atlasweave.llm.catalog import query, table
from atlasweave.llm.components import components
from atlasweave.llm.stored import stored

#: Fingerprints that are compared with each other in one go at most, about.
BLOCK = 2048
MAX_BITS = 3
#: Shared keys with at most this many entries are compared entry by entry over a whole batch at once.
SHORT_RUN = 24


def fingerprint(text: bytes | None) -> int:
    """SimHash of a text's 3-word shingles, as a signed 64-bit number."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < 3:
        hashes, n = xxh64_digest(b" ".join(words), 42), 1
    else:
        joined = b" ".join(words)
        ends = list(accumulate(map(len, words), lambda at, n: at + n + 1))
        starts = [0] + [e + 1 for e in ends]
        hashes, n = b"".join([xxh64_digest(joined[a:b], 42) for a, b in zip(starts, ends[2:])]), len(words) - 2
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(n, 8), axis=1)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array((fingerprint(t) for t in batch.column("text").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], ["doc_id", "fp"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fp", T.LongType())])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, fp) of each segment and of each segment with one more bit on."""
    for batch in batches:
        prints = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(prints), 4096):
            part = prints[at : at + 4096]
            keys, owners = [], []
            for segment in (0, 1):
                value = (part >> np.uint64(32 * segment)) & np.uint64(0xFFFFFFFF)
                tag = np.uint64(segment << 32)
                keys.append(value | tag)
                owners.append(part)
                for bit in range(32):
                    off = (value >> np.uint64(bit)) & np.uint64(1) == 0
                    keys.append(value[off] | np.uint64(1 << bit) | tag)
                    owners.append(part[off])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners).view(np.int64))], ["key", "fp"])


def _hang_on_least(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a long run: every print with the least of those it is linked to, in one or more steps."""
    prints = np.unique(prints)
    left, roots = prints, np.empty_like(prints)
    where = np.arange(len(prints))
    while len(where):
        root, queue = prints[where[0]], [prints[where[0]]]
        roots[where[0]] = root
        left, where = left[1:], where[1:]
        while queue and len(where):
            near = np.bitwise_count(left ^ queue.pop()) <= MAX_BITS
            if near.any():
                queue.extend(left[near])
                roots[where[near]] = root
                left, where = left[~near], where[~near]
    linked = roots != prints
    return roots[linked], prints[linked]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) among rows (key, part, fp) that come sorted by key and part."""
    rest: np.ndarray | None = None

    def found(rows: np.ndarray) -> pa.RecordBatch:
        change = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
        starts = np.concatenate([[0], change])
        sizes = np.diff(np.concatenate([starts, [len(rows)]]))
        prints = rows[:, 2].view(np.uint64) if rows.flags.c_contiguous else np.ascontiguousarray(rows[:, 2]).view(np.uint64)
        a, b = [], []
        run_end = np.repeat(starts + sizes, sizes)
        short = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SHORT_RUN), sizes))
        for shift in range(1, SHORT_RUN):
            short = short[short + shift < run_end[short]]
            if not len(short):
                break
            one, two = prints[short], prints[short + shift]
            near = (np.bitwise_count(one ^ two) <= MAX_BITS) & (one != two)
            a.append(one[near])
            b.append(two[near])
        for start, size in zip(starts[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN]):
            one, two = _hang_on_least(prints[start : start + size])
            a.append(one)
            b.append(two)
        pairs = np.stack([np.concatenate(a), np.concatenate(b)], axis=1) if a else np.empty((0, 2), np.uint64)
        pairs = np.unique(pairs.view(np.int64), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "part", "fp")], axis=1)
        if rest is not None:
            rows = np.concatenate([rest, rows])
        last = np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))
        cut = last[-1] + 1 if len(last) else 0  # the last run may go on in the next batch
        if cut:
            yield found(rows[:cut])
        rest = rows[cut:]
    if rest is not None:
        yield found(rest)


def linked(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect the distinct ``prints`` (fp) as all pairs within three bits would."""
    entries = prints.mapInArrow(_entries, "key long, fp long")
    own = prints.select(F.explode(F.array(
        F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)),
        F.shiftrightunsigned("fp", 32).bitwiseOR(F.lit(1 << 32)))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # What meets under a key: its own prints and those one bit below. Keys with few prints add little.
    reach = own.where(F.col("n") >= max(block // 64, 1)).select("n", F.explode(F.expr(
        "concat(array(key), transform(filter(sequence(0, 31), i -> (shiftright(key, i) & 1) = 0), i -> key | shiftleft(1L, i)))")).alias("key"))
    hot = stored(reach.groupBy("key").agg(F.sum("n").alias("load")).where(F.col("load") > block // 2).select(
        F.col("key").alias("hot"), F.ceil(F.col("load") / block).alias("blocks")), "hot-keys")
    placed = entries.join(hot, F.col("key") == F.col("hot"), "left").withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1)))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1))).select(
        "key", (F.least("own", "other") * F.coalesce("blocks", F.lit(1)) + F.greatest("own", "other")).alias("part"), "fp")
    met = placed.repartition("key", "part").sortWithinPartitions("key", "part")
    return met.mapInArrow(_links, "a long, b long")


def near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id."""
    prints = stored(fingerprints(docs), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-prints")
    roots = components(linked(distinct.select("fp"), block))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = stored(rooted.select("fp", "root").join(least, "root").select(F.col("fp").alias("label_fp"), "component_id"), "labels")
    return prints.join(labels, F.col("fp") == F.col("label_fp")).select("doc_id", "fp", "component_id")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` without near-duplicates: of each component the rows of its smallest doc_id stay."""
    kept = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept_id"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept_id"]), "left_semi")


@query("op3_simhash")
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
