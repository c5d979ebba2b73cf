"""N-gram Jaccard join: documents whose shingle sets overlap by 85 % or more, with their components.

Documents with equal sets are one set from the start. The n-grams of a set are put in
one global order, rare ones first; two sets that are similar enough share an n-gram
among the first ``n - ceil(0.85 n) + 1`` of both, their prefixes. Prefix n-grams are
shuffled with the set's size and the n-gram's place, and sets meet where they share one:

* length and positional filter: what follows the first shared n-gram must still allow
  the overlap asked for,
* suffix filter: sets are cut into 512 parts by hash; parts of which one set has an odd
  and the other an even number of n-grams bound from below what the sets do not share,
* what passes is verified once per pair, on the shingles themselves.

Under an n-gram that very many sets share, pairs are not listed. In a first round each
set is paired with the least set under the n-gram only; what that links are clusters. In a
second round the clusters under an n-gram that many sets share are connected by a least
spanning forest of the pairs that pass the filters, the closest first, which joins what
belongs together. In a third round only sets of *different* clusters are left to pair:
under each n-gram those outside its largest cluster with all others. So every pair that
passes the filters is either verified or inside a cluster already, no link is lost, and
a cluster of copies costs what it has members, not pairs. N-grams with more than
``CROWD`` sets are compared in blocks inside tasks, from which only pairs that pass leave.

Rare first needs counts of n-grams over all documents. They are taken in a table of
2^20 buckets by hash, the same at every size; n-grams of one bucket are told apart by
their hash, so the order is one order whatever the counts are, and results do not
depend on them. N-grams are put last once their own count stands out from the others of
their bucket. N-grams are keyed by 64-bit hashes, and a set by a hash of those;
hashes choose candidates, and shingles decide. Only *equality* of two sets (the first
step) rests on a 64-bit hash of all of their n-grams' hashes.

Defined cases: null, empty and blank texts have no set and are linked with nothing; a
text of fewer than ``width`` words has its whole sequence as one n-gram. Repeated rows
and doc_ids stay rows; a component's id is its smallest doc_id that is not null. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest, xxh64_digest

from atlasweave.llm.catalog import query, table
from atlasweave.llm.components import components
from atlasweave.llm.stored import stored
from atlasweave.session import sized_broadcast

WIDTH = 4
PERCENT = 85
#: Buckets in which n-grams are counted: 4 MB in each task, at every size of the input.
BUCKETS = 1 << 20
CHUNK = 1 << 16
PARTS = 512
#: Sets under one n-gram that are joined row by row; more are compared in blocks of ``BLOCK``.
CROWD = 64
BLOCK = 2048
#: An n-gram with more sets than this, about, is dealt to several tasks.
HOT = 200_000
#: Partners of one set that are verified in one go.
SPREAD = 256
#: Texts whose prefixes leave a task together.
PORTION = 512
#: Texts to verify are found by a broadcast of their ids up to so many, of 16 bytes each; by a shuffle beyond.
IDS = 250_000


def shingles(text: bytes | None, width: int = WIDTH) -> list[bytes]:
    """Shingles of a text, repeats included."""
    words = text.lower().split() if text else []
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [joined]
    ends = list(accumulate(map(len, words), lambda at, n: at + n + 1))
    starts = [0] + [e + 1 for e in ends]
    return [joined[a:b] for a, b in zip(starts, ends[width - 1 :])]


def hashes(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Hashes of the distinct shingles, ascending."""
    return np.unique(np.frombuffer(b"".join([xxh64_digest(s) for s in shingles(text, width)]), ">u8").astype(np.uint64))


def set_id(grams: np.ndarray) -> int:
    value = xxh3_64_intdigest(grams.tobytes())
    return value - (value >> 63 << 64)


def parities(grams: np.ndarray) -> list[int]:
    """Of each part whether it has an odd number of the n-grams, as bits of eight numbers."""
    counts = np.bincount((grams >> np.uint64(55)).astype(np.int64), minlength=PARTS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64).tolist()


def enough(shared, total, percent: int = PERCENT):
    """Whether ``shared`` of two sets with ``total`` n-grams together is the similarity asked for."""
    return (100 + percent) * shared >= percent * total


def _scan(docs: DataFrame, width: int) -> DataFrame:
    """Rows (doc_id, set, n, bits) of documents and (chunk, counts) of n-gram counts, by task."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("set", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("bits", T.ArrayType(T.LongType())), T.StructField("chunk", T.IntegerType()), T.StructField("counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int32)
        names = ["doc_id", "set", "n", "bits", "chunk", "counts"]
        ids = None
        for batch in batches:
            ids, sets, sizes, odd, held, waiting = batch.column("doc_id"), [], [], [], [], 0
            for text in batch.column("text"):
                grams = hashes(text.as_py(), width)
                sets.append(set_id(grams) if len(grams) else None)
                sizes.append(len(grams))
                odd.append(parities(grams))
                held.append((grams & np.uint64(BUCKETS - 1)).astype(np.int64))
                waiting += len(grams)
                if waiting > BUCKETS:
                    counts += np.bincount(np.concatenate(held), minlength=BUCKETS).astype(np.int32)
                    held, waiting = [], 0
            if held:
                counts += np.bincount(np.concatenate(held), minlength=BUCKETS).astype(np.int32)
            m = len(sets)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(odd, pa.list_(pa.int64())),
                 pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
        if ids is not None:
            m = BUCKETS // CHUNK
            packed = [zlib.compress(counts[i * CHUNK : (i + 1) * CHUNK].astype(np.int64).tobytes(), 1) for i in range(m)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, ids.type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int64())),
                 pa.array(range(m), pa.int32()), pa.array(packed, pa.binary())], names)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of counts of rows that come sorted by chunk."""
    at, total = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["chunk", "counts"])

    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts")):
            if chunk != at:
                if total is not None:
                    yield row()
                at, total = chunk, np.zeros(CHUNK, np.int64)
            total += np.frombuffer(zlib.decompress(counts.as_py()), np.int64)
    if total is not None:
        yield row()


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Counts of all buckets, of rows (chunk, counts): one table of fixed size."""
    some = rows.select("chunk", "counts", F.pmod(F.spark_partition_id(), F.lit(64)).alias("salt")).repartition("chunk", "salt")
    some = some.select("chunk", "counts").sortWithinPartitions("chunk").mapInArrow(_added, "chunk int, counts binary")
    total = np.zeros(BUCKETS, np.int64)
    for row in some.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_added, "chunk int, counts binary").collect():
        total[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return np.minimum(total, 2**31 - 1).astype(np.int32)


def _prefixes(docs: DataFrame, counts: np.ndarray, width: int, percent: int, hot: int) -> DataFrame:
    """(key, set, n, pos, salts) of the prefix n-grams of every set, each set once a task."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in (b.slice(at, PORTION) for b in batches for at in range(0, b.num_rows, PORTION)):
            keys, sets, sizes, places, loads = [], [], [], [], []
            for text in batch.column("text"):
                grams = hashes(text.as_py(), width)
                n = len(grams)
                if not n or (mine := set_id(grams)) in seen:
                    continue
                seen.add(mine)
                load = shared.value[(grams & np.uint64(BUCKETS - 1)).astype(np.int64)]
                first = np.lexsort((grams, load))[: n - -(-percent * n // 100) + 1]
                keys.append(grams[first].view(np.int64))
                loads.append(load[first])
                sets.append(np.full(len(first), mine, np.int64))
                sizes.append(np.full(len(first), n, np.int32))
                places.append(np.arange(len(first), dtype=np.int32))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in (keys, sets, sizes, places)] + [pa.array(np.concatenate(loads) // hot + 1)],
                    ["key", "set", "n", "pos", "salts"])

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "key long, set long, n int, pos int, salts int")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, salt and set: those of keys with several sets, with the first set under the key.

    Only the first row of the run that is being read is held. Keys dealt to several salts are kept in any case.
    """
    names = ["key", "set", "n", "pos", "salts", "head", "head_n", "head_pos"]
    state = None  # key, salt, salts, set, n and pos of the open run's first row, whether it was given out, last set
    for batch in batches:
        if not batch.num_rows:
            continue
        key, salt, sets, n, pos, salts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "salt", "set", "n", "pos", "salts"))
        goes_on = state is not None and state[0] == key[0] and state[1] == salt[0]
        new = np.concatenate([[not goes_on], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])])
        again = ~new & np.concatenate([[goes_on and state[7] == sets[0]], sets[1:] == sets[:-1]])
        run = np.cumsum(new)
        opened = state if goes_on else (0,) * 8
        head, head_n, head_pos = (np.concatenate([np.array([opened[3 + i]], c.dtype), c[new]]) for i, c in enumerate((sets, n, pos)))
        others = ~new & ~again
        several = np.bincount(run[others], minlength=run[-1] + 1) > 0
        show = others | (new & (several[run] | (salts > 1)))
        out = [c[show] for c in (key, sets, n, pos, salts)] + [h[run[show]] for h in (head, head_n, head_pos)]
        if goes_on and several[0] and not opened[6]:
            late = [opened[0], opened[3], opened[4], opened[5], opened[2], opened[3], opened[4], opened[5]]
            out = [np.concatenate([[v], c]).astype(c.dtype) for v, c in zip(late, out)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names)
        r = run[-1]
        if r:
            at = np.flatnonzero(new)[-1]
            state = (key[at], salt[at], salts[at], sets[at], n[at], pos[at], bool(several[r] or salts[at] > 1), sets[-1])
        else:
            state = (*opened[:6], bool(opened[6] or several[0]), sets[-1])


def _passes(n: Column, pos: Column, other_n: Column, other_pos: Column, percent: int) -> Column:
    """Length and positional filter: the n-grams from the shared one on could still be the overlap."""
    return F.lit(100 + percent) * F.least(n - pos, other_n - other_pos) >= F.lit(percent) * (n + other_n)


def _crowds(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(set, n, pos, label, bits) of each run of rows with one key and part, of which a block is at most twice."""
    rest: list[np.ndarray] | None = None

    def cut(rows: list[np.ndarray], to: int) -> Iterator[tuple[np.ndarray, ...]]:
        key, part = rows[0][:to], rows[1][:to]
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (part[1:] != part[:-1])])) if to else []
        for a, b in zip(starts, [*starts[1:], to]):
            yield tuple(c[a:b] for c in rows[2:])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "part", "set", "n", "pos", "label")]
        rows.append(batch.column("bits").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(batch.num_rows, -1))
        if rest is not None:
            rows = [np.concatenate([a, b]) for a, b in zip(rest, rows)]
        last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
        at = last[-1] + 1 if len(last) else 0
        yield from cut(rows, at)
        rest = [c[at:] for c in rows]
    if rest is not None:
        yield from cut(rest, len(rest[0]))


def _near(i: int, others: np.ndarray, n: np.ndarray, pos: np.ndarray, bits: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``others`` pass all filters with row ``i``, and how far they are at least, as a share of both."""
    total = n[others] + n[i]
    apart = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64)
    ahead = np.minimum(n[others] - pos[others], n[i] - pos[i])
    return enough(ahead, total, percent) & enough(total - apart, 2 * total, percent), apart / total


def _closest(crowd: tuple[np.ndarray, ...], percent: int) -> tuple[list[int], list[int]]:
    """A least spanning forest of the pairs that pass, sets of one label being connected already."""
    sets, n, pos, label, bits = crowd
    one, two = [], []
    left = np.arange(len(sets))
    cost, via = np.full(len(sets), np.inf), np.zeros(len(sets), np.int64)
    while len(left):
        k = int(np.argmin(cost[left]))
        i = left[k]
        if 0 <= cost[i] < np.inf:
            one.append(int(sets[via[i]]))
            two.append(int(sets[i]))
        left = np.delete(left, k)
        passes, far = _near(i, left, n, pos, bits, percent)
        reach = np.where(label[left] == label[i], -1.0, np.where(passes, far, np.inf))
        better = left[reach < cost[left]]
        cost[better], via[better] = reach[reach < cost[left]], i
    return one, two


def _remaining(crowd: tuple[np.ndarray, ...], percent: int) -> tuple[list[int], list[int]]:
    """All pairs of different labels that pass."""
    sets, n, pos, label, bits = crowd
    one, two = [], []
    for i in range(len(sets) - 1):
        others = np.arange(i + 1, len(sets))
        others = others[label[others] != label[i]]
        others = others[_near(i, others, n, pos, bits, percent)[0]]
        one.extend([int(sets[i])] * len(others))
        two.extend(sets[others].tolist())
    return one, two


def _compared(crowds: DataFrame, how, percent: int) -> DataFrame:
    """Pairs (a, b) that ``how`` picks of the rows (key, n_sets, set, n, pos, label, bits) under each key, in pairs of blocks."""
    blocks = F.ceil(F.col("n_sets") / BLOCK)
    placed = crowds.withColumn("own", F.pmod(F.xxhash64("set"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    placed = placed.select("key", (F.least("own", "other") * blocks + F.greatest("own", "other")).alias("part"), "set", "n", "pos", "label", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for crowd in _crowds(batches):
            one, two = how(crowd, percent)
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], ["one", "two"])

    pairs = placed.repartition("key", "part").sortWithinPartitions("key", "part", "set").mapInArrow(run, "one long, two long")
    return pairs.select(*_ordered("one", "two")).distinct()


def _ordered(one: str, two: str) -> list[Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Of pairs (a, b) of sets, each once, those similar enough; ``sets`` is (set, least_id, n, bits)."""
    size = [sets.select(F.col("set").alias(k), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}")) for k in "ab"]
    apart = F.expr("aggregate(zip_with(bits_a, bits_b, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)")
    total = F.col("n_a") + F.col("n_b")
    chosen = stored(pairs.join(size[0], "a").join(size[1], "b").where(enough((total - apart) / 2, total, percent)).select("a", "b"), "candidates")
    needed = chosen.select(F.col("a").alias("set")).union(chosen.select("b")).distinct().join(sets, "set").select(
        F.col("set").alias("wanted"), F.col("least_id").alias("wanted_id"))
    needed = stored(needed, "needed")
    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    fetched = source.join(sized_broadcast(needed, IDS), F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("wanted", "text")

    def of_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # rows may repeat a doc_id, with this text or another
        for batch in batches:
            keep = []
            for at, (wanted, text) in enumerate(zip(batch.column("wanted").to_pylist(), batch.column("text"))):
                if wanted not in seen and set_id(hashes(text.as_py(), width)) == wanted:
                    seen.add(wanted)
                    keep.append(at)
            yield batch.take(pa.array(keep, pa.int64()))

    texts = stored(fetched.mapInArrow(of_set, "wanted long, text binary"), "texts")
    spread = chosen.groupBy("a").agg((F.floor(F.count(F.lit(1)) / SPREAD) + 1).alias("salts"))
    spread = stored(spread, "spread")
    firsts = spread.join(texts, F.col("a") == F.col("wanted")).select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "text")
    seconds = chosen.join(spread, "a").join(texts, F.col("b") == F.col("wanted")).select(
        "a", F.pmod(F.xxhash64("b"), "salts").alias("salt"), "b", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine, last = None, set(), None
        for batch in batches:
            one, two = [], []
            for a, b, text in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("text")):
                if b is None:
                    if a != at:
                        at, mine, last = a, set(shingles(text.as_py(), width)), None
                elif b != last:
                    last, other = b, set(shingles(text.as_py(), width))
                    if enough(len(mine & other), len(mine) + len(other), percent):
                        one.append(a)
                        two.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], ["a", "b"])

    met = firsts.unionByName(seconds).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return stored(met.select("a", "b", "text").mapInArrow(compare, "a long, b long"), "links")


def similar_documents(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    scan = stored(_scan(docs, width), "sets")
    rows = scan.where("chunk IS NULL").select("doc_id", "set", "n", "bits")
    sets = stored(rows.where("set IS NOT NULL").groupBy("set").agg(
        F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("bits").alias("bits")), "distinct-sets")
    counts = bucket_counts(scan.where("chunk IS NOT NULL"))
    placed = _prefixes(docs, counts, width, percent, hot).withColumn("salt", F.pmod("set", "salts").cast("int"))
    met = stored(placed.repartition("key", "salt").sortWithinPartitions("key", "salt", "set").mapInArrow(
        _met, "key long, set long, n int, pos int, salts int, head long, head_n int, head_pos int"), "met")

    # Each set with the first one under each of its n-grams; the firsts of salts with the first of all.
    firsts = met.where("salts > 1").select("key", F.col("head").alias("set"), F.col("head_n").alias("n"), F.col("head_pos").alias("pos")).distinct()
    of_all = firsts.groupBy("key").agg(F.min(F.struct("set", "n", "pos")).alias("f")).select(
        F.col("key").alias("k"), F.col("f.set").alias("head"), F.col("f.n").alias("head_n"), F.col("f.pos").alias("head_pos"))
    stars = met.select("set", "n", "pos", "head", "head_n", "head_pos").unionByName(
        firsts.join(of_all, F.col("key") == F.col("k")).select("set", "n", "pos", "head", "head_n", "head_pos"))
    tried = stored(stars.where((F.col("set") != F.col("head")) & _passes(
        F.col("n"), F.col("pos"), F.col("head_n"), F.col("head_pos"), percent)).select(*_ordered("set", "head")).distinct(), "stars")
    links = verified(tried, docs, sets, width, percent)

    # Sets of different clusters that share a prefix n-gram.
    owned = met.select("key", "set", "n", "pos").distinct()

    def mixed(found: DataFrame) -> DataFrame:
        """Rows under n-grams with several clusters: ``main`` is the largest, ``n_sets`` counts the rows."""
        clusters = components(found).select(F.col("node").alias("member"), "root")
        labelled = stored(owned.join(clusters, F.col("set") == F.col("member"), "left").select(
            "key", "set", "n", "pos", F.coalesce("root", "set").alias("label")), "labelled")
        several = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(
            F.max(F.struct("c", "label")).alias("largest"), F.count(F.lit(1)).alias("labels"), F.sum("c").alias("n_sets")).where("labels > 1").select(
            F.col("key").alias("k"), F.col("largest.label").alias("main"), "n_sets")
        return stored(labelled.join(several, F.col("key") == F.col("k")).drop("k"), "mixed")

    def crowded(within: DataFrame) -> DataFrame:
        return within.where(F.col("n_sets") > CROWD).join(sets.select(F.col("set").alias("of"), "bits"), F.col("set") == F.col("of")).drop("of")

    closest = stored(_compared(crowded(mixed(links)), _closest, percent).join(tried, ["a", "b"], "left_anti"), "closest")
    links = links.unionByName(verified(closest, docs, sets, width, percent))
    tried = tried.unionByName(closest)

    within = mixed(links)
    few = within.where(F.col("n_sets") <= CROWD)
    small = few.where("label <> main").select("key", *(F.col(c).alias(f"x_{c}") for c in ("set", "n", "pos", "label")))
    crossing = small.join(few, "key").where(
        (F.col("label") != F.col("x_label")) & ((F.col("label") == F.col("main")) | (F.col("x_set") < F.col("set")))
        & _passes(F.col("n"), F.col("pos"), F.col("x_n"), F.col("x_pos"), percent)).select(*_ordered("set", "x_set"))
    crossing = crossing.unionByName(_compared(crowded(within), _remaining, percent)).distinct()
    crossing = stored(crossing.join(tried, ["a", "b"], "left_anti"), "crossing")
    links = links.unionByName(verified(crossing, docs, sets, width, percent))

    roots = components(links).select(F.col("node").alias("member"), "root")
    rooted = sets.select("set", "least_id").join(roots, F.col("set") == F.col("member"), "left").select(
        "set", "least_id", F.coalesce("root", "set").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = stored(rooted.join(least, "root").select(F.col("set").alias("of"), "component_id"), "labels")
    return rows.join(labels, F.col("set") == F.col("of"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


@query("op12_ngram_jaccard")
def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by 4-word shingles that overlap by 85 % or more."""
    return similar_documents(table(spark, sf_dir, "documents"))
