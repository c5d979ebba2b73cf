"""Quality classification by the perplexity of a Kneser-Ney model of trusted text.

1. Every text becomes a sequence of words (between white space), each as 64 bits of hash.
   The vocabulary is every word of trusted text, however rare; what that leaves to
   words without a count is shared evenly by the vocabulary and ``UNKNOWN_WORDS`` others.
2. Trigrams of trusted documents (labelled quality 1, in four of five folds) are
   counted, and the tables of an interpolated modified Kneser-Ney model derived from
   them: continuation counts, contexts, discounts from counts of counts. N-grams of all
   orders are in one table, keyed by their hashes and bucketed by ranges of them.
   Counting goes in waves (``WAVES``) by ranges of the hash of a bigram: one wave has all
   trigrams that begin with its bigrams and all that end with them.
3. Documents, in waves too, lie in shards of a bounded number of words, in the order
   they are read. The distinct n-grams of each shard are looked up range by range, and
   the answers go back to the shard, in which each document adds up its bits. The numbers
   of shards and ranges follow the text, not the settings of the session.
   Keys are sent and kept as sorted differences, in blocks; what a wave has written
   besides its results goes before the next one begins.
4. Thresholds: per language, a quantile of the bits per word of the trusted documents
   in the fifth fold, which were not counted. Few words say little, so a document's
   mean is drawn to the language's by ``steady`` words; few documents carry no quantile,
   so the threshold is drawn to the language's mean plus the quantile over all languages
   of how far documents are above theirs, by as many as have ``BEYOND`` beyond it.

All statistics cover all documents and grow with them.

Defined cases: null, empty and blank texts have no words and get their language's
mean, which is accepted; a null language is a language; a language without trusted
text gets the threshold over all languages, and without any trusted text every
document is accepted; rows that repeat a doc_id are scored each; a null doc_id has no
label. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from xxhash import xxh64_intdigest

from atlasweave.llm.catalog import query, table
from atlasweave.llm.language_id import remainder
from atlasweave.llm.stored import appended, stored
from atlasweave.session import scratch_path

BUCKETS = 1 << 16
UNKNOWN_WORDS = 1 << 20
#: Words of a shard, and bytes of text that a task of a wave has at least, if there are as many.
SHARD_WORDS, TASK_BYTES = 800_000, 1_500_000
#: Counting (a power of two) and asking are cut into so many jobs at most, each of so many bytes of text at least.
WAVES, ASKING_WAVES, WAVE_BYTES = 8, 10, 4_000_000
#: Words of trusted text in a block, and for each range of keys.
BLOCK_WORDS, RANGE_WORDS = 1_000_000, 1_000_000
#: Joins of labels with texts are cut into so many jobs.
TEXT_WAVES = 4
FOLDS = 5
QUANTILE = 0.99
BEYOND = 5
STEADY = 20
BINS = 256  # of a bit
_FIELD = 20  # bits of a small word number in a packed n-gram


def word_id(word: str) -> int:
    """64 bits of a word, never 0."""
    return xxh64_intdigest(word) or 1


#: Stands before the first word of a text; no word has white space.
BEGIN = word_id(" ")


def _bucket(word: str) -> int:
    return xxh64_intdigest(word) % BUCKETS


def _counted(batches: Iterator[pa.RecordBatch], most: int = 500_000) -> Iterator[Counter]:
    """Word counts of portions of a task's texts."""
    held: Counter = Counter()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            for text in batch.slice(start, 256).column(0):
                if text.is_valid:
                    held.update(text.as_py().decode("utf-8", "replace").split())
            if len(held) > most:
                yield held
                held = Counter()
    yield held


def vocabulary(docs: DataFrame, share: float) -> tuple[list[str], int]:
    """(words that make up at least ``share`` of all words, number of all words)."""
    texts = docs.select(F.col("text").cast("binary").alias("text"))

    def buckets(batches):
        total = np.zeros(BUCKETS, np.int64)
        for counts in _counted(batches):
            if counts:
                at = np.fromiter(map(_bucket, counts), np.int64, len(counts))
                total += np.bincount(at, np.fromiter(counts.values(), np.int64, len(counts)), BUCKETS).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    sums = texts.mapInArrow(buckets, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows
    number = sum(sums.column("n").to_pylist())
    least = share * number
    heavy = {b for b, n in zip(sums.column("bucket").to_pylist(), sums.column("n").to_pylist()) if n >= least}

    def words(batches):
        for counts in _counted(batches):
            own = [(w, n) for w, n in counts.items() if _bucket(w) in heavy]
            if own:
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in own]), pa.array([n for _, n in own], pa.int64())], ["word", "n"])

    found = texts.mapInArrow(words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return sorted(r["word"] for r in found.select("word").collect()), number  # 1 / share words at most


class _Numbers(dict):
    """Numbers of the words of a block by first occurrence; ``ids`` has their 64-bit hashes, 0 for what is not in ``only``, if given."""

    def __init__(self, only: set[str] | None):
        self.ids, self.only = {BEGIN: 0}, only

    def __missing__(self, word):
        name = word_id(word) if self.only is None or word in self.only else 0
        self[word] = number = self.ids.setdefault(name, len(self.ids))
        return number


def blocks(docs: DataFrame, words: list[str] | None, most: int) -> DataFrame:
    """(shard, docs, n, names, at): documents in blocks of about ``most`` words, in the order in which tasks read them.

    ``docs`` has their doc_id, lang and n_words, ``names`` the different words as hashes and ``at``
    the number of each word among them, with two BEGIN (number 0) before each document.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(words)
    kind = docs.schema["doc_id"].dataType
    arrow_id = to_arrow_type(kind)
    row = T.StructType([T.StructField("doc_id", kind), T.StructField("lang", T.StringType()), T.StructField("n_words", T.LongType())])
    fields = ["doc_id", "lang", "n_words"]

    def run(batches):
        only = None if shipped.value is None else set(shipped.value)
        first = TaskContext.get().partitionId() << 32
        made = 0
        numbers, size, parts, ats = _Numbers(only), 0, [], []
        edge = np.zeros(2, np.int64)

        def block():
            own = pa.StructArray.from_arrays([pa.concat_arrays(c) for c in zip(*parts)], fields)
            names = np.fromiter(numbers.ids, np.uint64, len(numbers.ids))
            cols = [pa.array([first + made]), pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                    pa.array([size]), pa.array([_dense(names)]), pa.array([_dense(np.concatenate(ats))])]
            return pa.RecordBatch.from_arrays(cols, ["shard", "docs", "n", "names", "at"])

        for batch in batches:
            ids, langs = batch.column(0).cast(arrow_id), batch.column(1)
            for start in range(0, batch.num_rows, 64):
                sizes = []
                for text in batch.column(2).slice(start, 64):
                    own = text.as_py().decode("utf-8", "replace").split() if text.is_valid else []
                    ats += [edge, np.fromiter(map(numbers.__getitem__, own), np.int64, len(own))]
                    sizes.append(len(own))
                parts.append((ids.slice(start, 64), langs.slice(start, 64), pa.array(sizes, pa.int64())))
                size += sum(sizes) + 2 * len(sizes)
                if size >= most:
                    yield block()
                    made += 1
                    numbers, size, parts, ats = _Numbers(only), 0, [], []
        if parts:
            yield block()

    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("docs", T.ArrayType(row)), T.StructField("n", T.LongType()),
                           T.StructField("names", T.BinaryType()), T.StructField("at", T.BinaryType())])
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")
    return docs.select("doc_id", lang, F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def trigrams(ids: np.ndarray, begin: int) -> np.ndarray:
    """Trigrams of small word numbers, packed, that end at each word; ``begin`` goes twice before the first."""
    x = np.concatenate([[begin, begin], ids.astype(np.int64)])
    return (x[:-2] << 2 * _FIELD) | (x[1:-1] << _FIELD) | x[2:]


def chained(x: np.ndarray, seed) -> np.ndarray:
    """Spark's xxhash64 of a long: that of two columns is chained(second, chained(first, 42))."""
    one, two, three, four, five = (np.uint64(k) for k in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5 + 8))

    def roll(v, k):
        high = v << np.uint64(k)
        v >>= np.uint64(64 - k)
        v |= high

    seeds = np.broadcast_to(np.asarray(seed, np.uint64), len(x))
    out = np.empty(len(x), np.uint64)
    for start in range(0, len(x), 1 << 14):  # what stays in a processor's cache
        h = seeds[start : start + (1 << 14)] + five
        v = x[start : start + (1 << 14)] * two
        roll(v, 31)
        v *= one
        h ^= v
        roll(h, 27)
        h *= one
        h += four
        h ^= h >> np.uint64(33)
        h *= two
        h ^= h >> np.uint64(29)
        h *= three
        h ^= h >> np.uint64(32)
        out[start : start + (1 << 14)] = h
    return out


#: A trigram's key has these bits of its context's key, so that both are in one range of keys.
_HIGH = 0xFFFF << 48


def _ending(w: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Keys of the trigrams of contexts, by their keys, and words."""
    return (before & np.uint64(_HIGH)) | (chained(w, before) & np.uint64(~_HIGH & 0xFFFFFFFFFFFFFFFF))


def grams(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, ...]:
    """Keys of the context (a, b), the trigram and the bigram (b, w); words are their own keys."""
    seed = np.uint64(42)
    before = chained(b, chained(a, seed))
    return before, _ending(w, before), chained(w, chained(b, seed))


def _laid(names: bytes, at: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: different words, the number of each word, and the keys of the bigrams.

    There are two BEGIN in the end too, so that what is asked does not depend on the order of documents.
    """
    x, number = _numbers(names), np.concatenate([_numbers(at).astype(np.int64), np.zeros(2, np.int64)])
    return x, number, chained(x[number[1:]], chained(x, np.uint64(42))[number[:-1]])


def _dense(x: np.ndarray) -> bytes:
    """64-bit numbers, compressed byte place by byte place."""
    places = np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(places.tobytes())


def _numbers(packed: bytes) -> np.ndarray:
    places = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(places.T).view(np.uint64).ravel()


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct values, the place of one in ``x`` for each, the number of its value for each of ``x``)."""
    order = np.argsort(x)
    x = x[order]
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    number = np.empty(len(x), np.int64)
    number[order] = np.cumsum(new) - 1
    return x[new], order[new], number


def _sorted(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def _steps(keys: np.ndarray) -> bytes:
    """Sorted keys."""
    return _dense(np.diff(keys, prepend=np.uint64(0)))


def _keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_numbers(packed), dtype=np.uint64)


def _ranges(keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(number, first, end) of each range of keys, of ``parts`` (a power of two) in all, that sorted ``keys`` have."""
    which = keys >> np.uint64(65 - parts.bit_length())
    cuts = [0, *(np.flatnonzero(which[1:] != which[:-1]) + 1).tolist(), len(which)]
    for first, end in zip(cuts, cuts[1:]):
        if first < end:
            yield int(which[first]), first, end


def _sent(rows: DataFrame, wave: int, waves: int, parts: int) -> DataFrame:
    """(part, kind, x, y, z) per block and range: of trigrams that begin with a bigram of the wave (kind 0) its key, theirs
    and their counts; of those that end with one (kind 1) their keys, the second and the third word."""

    def mine(keys):
        return (keys >> np.uint64(48)) >> np.uint64(17 - waves.bit_length()) == np.uint64(wave)

    def run(batches):
        for batch in batches:
            for names, at in zip(batch.column(0), batch.column(1)):
                x, number, pair = _laid(names.as_py(), at.as_py())
                x = x[number]
                real = number[2:] != 0
                out = []
                on = np.flatnonzero(real & mine(pair[:-1]))
                key, first, number = _distinct(_ending(x[on + 2], pair[on]))
                begin, n = pair[on[first]], np.bincount(number)
                order = np.argsort(begin, kind="stable")
                begin, key, n = begin[order], key[order], n[order]
                out += [(p, 0, _steps(begin[s:e]), _dense(key[s:e]), _dense(n[s:e])) for p, s, e in _ranges(begin, parts)]
                on = np.flatnonzero(real & mine(pair[1:]))
                key, first, _ = _distinct(_ending(x[on + 2], pair[on]))
                on = on[first]
                order = np.argsort(pair[on + 1], kind="stable")
                key, on = key[order], on[order]
                out += [(p, 1, _dense(key[s:e]), _dense(x[on[s:e] + 1]), _dense(x[on[s:e] + 2])) for p, s, e in _ranges(pair[on + 1], parts)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _SENT)], ["part", "kind", "x", "y", "z"])

    return rows.select("names", "at").mapInArrow(run, "part int, kind int, x binary, y binary, z binary")


_SENT = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
#: Blocks of the model: keys of n-grams of an order (0: words, from one range of bigrams); their counts and, as contexts,
#: their totals and how many counts of 1, 2 and more they have.
MODEL = "part int, kind int, keys binary, counts binary"


def _modelled(rows: list[tuple]) -> pa.Table:
    """Rows (part, kind, sorted keys, counts) of the model."""
    cols = list(zip(*[(p, k, _steps(keys), _dense(counts.ravel())) for p, k, keys, counts in rows if len(keys)])) or [()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(cols, _SENT[:4])], ["part", "kind", "keys", "counts"])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and the sums of their counts (a row for each kind of count)."""
    names, _, at = _distinct(keys)
    return names, np.stack([np.bincount(at, own, len(names)).astype(np.int64) for own in counts])  # exact below 2 ** 53


def _as_contexts(keys: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of contexts, and (0, total, number of counts of 1, 2, more) from the counts ``c`` in them."""
    return _summed(keys, np.stack([np.zeros(len(c), np.int64), c, c == 1, c == 2, c > 2]))


def _together(*some: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return _summed(np.concatenate([keys for keys, _ in some]), np.concatenate([counts for _, counts in some], axis=1))


def _single(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and (how often each is there, 0, 0, 0, 0)."""
    names, _, at = _distinct(keys)
    return names, np.stack([n := np.bincount(at, minlength=len(names)), *np.zeros((4, len(n)), np.int64)])


def _reduced(key, table):
    """Blocks of bigrams and trigrams of a range, and of what they say of words."""
    part, kinds = key[0].as_py(), table.column("kind").to_numpy()
    x, y, z = (table.column(c).to_pylist() for c in "xyz")

    def joined(kind, column, read=_numbers):
        return np.concatenate([np.empty(0, np.uint64), *[read(column[i]) for i in np.flatnonzero(kinds == kind)]])

    begin, tri, n = joined(0, x, _keys), joined(0, y), joined(0, z)
    tri, first, at = _distinct(tri)
    c = np.bincount(at, n, len(tri)).astype(np.int64)
    _, once, _ = _distinct(joined(1, x))
    b, w = joined(1, y)[once], joined(1, z)[once]
    two, once, at = _distinct(chained(w, chained(b, np.uint64(42))))
    b, w, before = b[once], w[once], np.bincount(at, minlength=len(two))
    bigrams = _together(_as_contexts(begin[first], c), (two, np.stack([before, *np.zeros((4, len(two)), np.int64)])))
    return _modelled([(part, 3, tri, c), (part, 2, *bigrams), (part, 0, *_together(_as_contexts(b, before), _single(w)))])


def _counts(packed: bytes, kind: int) -> np.ndarray:
    return _numbers(packed).astype(np.int64).reshape(1 if kind == 3 else 5, -1)


def _words_by_range(rows: DataFrame, parts: int) -> DataFrame:
    """What ``rows`` of the model say of words, added up, a block per range of words."""

    def run(batches):
        for batch in batches:
            got = [(_keys(k.as_py()), _counts(c.as_py(), 0)) for k, c in zip(batch.column(0), batch.column(1))]
            if got:
                keys, counts = _together(*got)
                yield from _modelled([(p, 0, keys[s:e], counts[:, s:e]) for p, s, e in _ranges(keys, parts)]).to_batches()

    def merged(key, table):
        got = [(_keys(k), _counts(c, 0)) for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist())]
        return _modelled([(key[0].as_py(), 1, *_together(*got))])

    return rows.select("keys", "counts").mapInArrow(run, MODEL).groupBy("part").applyInArrow(merged, MODEL)


@contextmanager
def _tables(spark: SparkSession):
    """A function that makes an empty table, of columns and perhaps bucketed; all go in the end."""
    made = []

    def make(columns: str, buckets: str = "") -> str:
        made.append(f"quality_{uuid.uuid4().hex}")
        spark.sql(f"CREATE TABLE {made[-1]} ({columns}) USING parquet {buckets}")
        return made[-1]

    try:
        yield make
    finally:
        for name in made:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _trusted_blocks(docs: DataFrame, ids: DataFrame, make, words: list[str] | None) -> DataFrame:
    name = make("n bigint, names binary, at binary")
    for wave in range(TEXT_WAVES):
        part = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(TEXT_WAVES)) == wave)
        trusted = part.join(ids, F.col("doc_id") == F.col("__id"), "left_semi")
        appended(blocks(trusted, words, BLOCK_WORDS).select("n", "names", "at"), name)
    return docs.sparkSession.table(name)


def counted_model(docs: DataFrame, ids: DataFrame, make, words: list[str] | None, waves: int) -> tuple[DataFrame, int]:
    """The model of those ``docs`` whose doc_id is in ``ids`` (__id), and its number of ranges."""
    spark = docs.sparkSession
    with _tables(spark) as passing:
        trusted = _trusted_blocks(docs, ids, passing, words)
        size = trusted.agg(F.sum("n").alias("n")).first()["n"] or 0
        # As many as the text asks for, each within one wave.
        parts = 1 << min(max(size // RANGE_WORDS, 2 * waves) - 1, (1 << 15) - 1).bit_length()
        name, of_words = make(MODEL, f"CLUSTERED BY (part) INTO {parts} BUCKETS"), passing(MODEL)
        for wave in range(waves):
            reduced = _sent(trusted, wave, waves, parts).groupBy("part").applyInArrow(_reduced, MODEL).persist(StorageLevel.DISK_ONLY)
            appended(reduced.where("kind > 0"), name)
            appended(_words_by_range(reduced.where("kind = 0"), parts), of_words)
            reduced.unpersist(blocking=True)
        appended(_words_by_range(spark.table(of_words), parts), name)
    return spark.table(name), parts


def _counts_of_counts(known: DataFrame) -> dict[int, np.ndarray]:
    """Per order: how many n-grams have a count of 1, 2, 3, 4 and 5 or more, the sum of all, and how many are word 0."""

    def run(batches):
        for batch in batches:
            for kind, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                c = _counts(counts, kind)[0]
                low = np.bincount(np.minimum(c, 5), minlength=6)[1:].tolist()
                zero = int((_keys(keys[:])[c > 0] == 0).sum()) if kind == 1 else 0
                yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "n": pa.array([[*low, int(c.sum()), zero]], pa.list_(pa.int64()))})

    sums = known.select("kind", "keys", "counts").mapInArrow(run, "kind int, n array<long>").groupBy("kind").agg(
        *[F.sum(F.col("n")[i]).alias(f"n{i}") for i in range(7)])
    return {r["kind"]: np.array(r[1:]) for r in sums.collect()}


def _discounts_of(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts of counts 1, 2, and 3 or more, from the numbers of counts 1 to 4."""
    if not n1:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    raw = [k - (k + 1) * y * high / low if low else 0.5 * k for k, low, high in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return [float(min(max(d, 0.05), k - 0.05)) for k, d in enumerate(raw, 1)]


def _discounts(counts: DataFrame, c: str) -> list[float]:
    n = {r[c]: r["n"] for r in counts.where(F.col(c) <= 4).groupBy(c).agg(F.count(F.lit(1)).alias("n")).collect()}
    return _discounts_of(*(n.get(k, 0) for k in (1, 2, 3, 4)))


def model(counts: DataFrame, words: int | None = None) -> tuple[DataFrame, float, float]:
    """Tables of the model of ``counts`` (a, b, w, c): (key, own, total, left), count of words in contexts, share of an unknown word.

    A row per n-gram: ``own`` is its count less its discount, ``total`` what it has as a
    context, and ``left`` what discounts leave of that to the next shorter context.
    """
    c2 = stored(counts.groupBy("b", "w").agg(F.count(F.lit(1)).alias("c")), "kn-2")
    c1 = stored(c2.groupBy("w").agg(F.count(F.lit(1)).alias("c")), "kn-1")

    def parts(table, key, context=None):
        d = _discounts(table, "c")
        off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        zero = F.lit(0.0)
        own = table.select(key.alias("key"), (F.col("c") - off).alias("own"), zero.alias("total"), zero.alias("left"))
        if context is None:
            return own, table.agg(F.sum("c").alias("total"), F.sum(off).alias("left")).first()
        return own, table.groupBy(context.alias("key")).agg(F.sum("c").cast("double").alias("total"), F.sum(off).alias("left")).select(
            "key", zero.alias("own"), "total", "left")

    high = F.lit(_HIGH - (1 << 64))
    own3, of3 = parts(counts, F.xxhash64("a", "b").bitwiseAND(high).bitwiseOR(F.xxhash64("a", "b", "w").bitwiseAND(F.bitwise_not(high))), F.xxhash64("a", "b"))
    own2, of2 = parts(c2, F.xxhash64("b", "w"), F.col("b"))
    own1, whole = parts(c1, F.col("w"))
    if words is None:
        words = c1.where("w <> 0").count()
    total, left = float(whole["total"] or 0), float(whole["left"] or 0)
    short = own1.unionByName(own2).unionByName(of2).unionByName(of3).groupBy("key").agg(*[F.sum(x).alias(x) for x in ("own", "total", "left")])
    rows = short.unionByName(own3).select("key", *[F.col(x).cast("float").alias(x) for x in ("own", "total", "left")])
    return rows, total or 1.0, (left / total if total else 1.0) / (words + UNKNOWN_WORDS)


def code_lengths(a: np.ndarray, b: np.ndarray, w: np.ndarray, answers: pa.Table, total: float, even: float) -> np.ndarray:
    """Bits of each word w after a and b; ``answers`` are the rows of the model that they have."""
    keys = answers.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys = np.concatenate([keys[order], np.zeros(1, np.uint64)])
    held = {x: np.concatenate([answers.column(x).to_numpy()[order], np.zeros(1, np.float32)]) for x in ("own", "total", "left")}

    def place(asked):  # the last place stands for what the model does not have
        at = np.searchsorted(keys[:-1], asked)
        return np.where(keys[at] == asked, at, len(keys) - 1)

    def step(of, context, shorter):
        all_of = held["total"][context].astype(np.float64)
        seen = all_of > 0
        all_of[~seen] = 1
        return held["own"][of] / all_of + np.where(seen, held["left"][context] / all_of, 1.0) * shorter

    before, whole, end = (place(x) for x in grams(a, b, w))
    p = held["own"][place(w)] / total + even * np.where(w == 0, UNKNOWN_WORDS, 1)
    p = step(whole, before, step(end, place(b), p))
    return np.where(w == 0, np.log2(UNKNOWN_WORDS), 0.0) - np.log2(p)


def with_bits(keys: DataFrame, counts: DataFrame, words: int) -> DataFrame:
    """``keys`` (packed trigrams of small word numbers) with ``bits``, for a model of ``counts`` (key, c) that one process holds."""
    low = F.lit((1 << _FIELD) - 1)
    split = [F.shiftright("key", k * _FIELD).bitwiseAND(low).alias(x) for k, x in ((2, "a"), (1, "b"), (0, "w"))]
    rows, total, even = model(stored(counts.select(*split, "c"), "trigrams"), words)
    answers = rows.toArrow()

    def run(batches):
        for batch in batches:
            a, b, w = (batch.column(k).to_numpy().astype(np.uint64) for k in (1, 2, 3))
            bits = code_lengths(a, b, w, answers, total, even)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.astype(np.float32))], ["key", "bits"])

    return keys.select("key", *split).mapInArrow(run, "key long, bits float")


def scored(docs: DataFrame, labels: DataFrame, share: float | None = None, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, lang, n_words, total_bits, trusted, held) of every row of ``docs``.

    With ``share``, words that are not that common are one word, 0; without, every word of trusted text counts.
    """
    spark = docs.sparkSession
    good = labels.groupBy(F.col("doc_id").alias("__id")).agg((F.max("quality") == 1).alias("trusted"))
    words = None if share is None else vocabulary(docs, share)[0]
    path = scratch_path(spark, "quality-shards")
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("binary")))).first()[0] or 0
    waves = min(WAVES, 1 << max(0, (size // WAVE_BYTES).bit_length() - 1))
    with _tables(spark) as make:
        known, parts = counted_model(docs, good.where(F.col("trusted") & (remainder(F.col("__id"), FOLDS) != FOLDS - 1)), make, words, waves)
        n = _counts_of_counts(known)
        low = {order: n.get(order, np.zeros(7, np.int64)) for order in (1, 2, 3)}
        off = {order: np.array([0.0, *_discounts_of(*low[order][:4].tolist())]) for order in low}
        whole, left = float(low[1][5]), float(low[1][:2] @ off[1][1:3] + low[1][2:5].sum() * off[1][3])
        even = (left / whole if whole else 1.0) / (int(low[1][:5].sum() - low[1][6]) + UNKNOWN_WORDS)
        asking = min(ASKING_WAVES, max(1, size // WAVE_BYTES))
        tasks = max(1, size // (asking * TASK_BYTES))
        for wave in range(asking):
            part = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(asking)) == wave)
            _answered(blocks(part.coalesce(tasks), words, shard_words), known, parts, off, whole or 1.0, even, path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = spark.read.schema(f"doc_id {kind}, lang string, n_words long, total_bits double").parquet(path)
    return rows.join(good, F.col("doc_id") == F.col("__id"), "left").select(
        "doc_id", "lang", "n_words", F.coalesce("trusted", F.lit(False)).alias("trusted"),
        F.coalesce(remainder(F.col("doc_id"), FOLDS) == FOLDS - 1, F.lit(False)).alias("held"), "total_bits")


def _answered(shards: DataFrame, known: DataFrame, parts: int, off: dict[int, np.ndarray], whole: float, even: float, path: str) -> None:
    """Appends (doc_id, lang, n_words, total_bits) of the documents of ``shards`` to the files in ``path``."""

    def thirds(x, number, pair):
        """Where trigrams begin, and their keys."""
        real = np.flatnonzero(number[2:])
        return real, _ending(x[number[real + 2]], pair[real])

    def wanted(batches):
        for batch in batches:
            for shard, names, at in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                x, number, pair = _laid(names.as_py(), at.as_py())
                asked = np.sort(x), _sorted(pair), _sorted(thirds(x, number, pair)[1])
                out = [(p, kind, shard, _steps(keys[s:e])) for kind, keys in enumerate(asked, 1) for p, s, e in _ranges(keys, parts)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (*_SENT[:2], pa.int64(), pa.binary()))],
                                                 ["part", "kind", "shard", "keys"])

    def looked_up(key, asked, model):
        part, out, packer = key[0].as_py(), [], zstandard.ZstdCompressor(level=1)
        blocks = list(zip(*(model.column(c).to_pylist() for c in ("kind", "keys", "counts"))))
        for kind in (1, 2, 3):
            held = [(_keys(keys), _counts(counts, kind)) for own, keys, counts in blocks if own == kind]
            if not held:
                continue
            names, counts = held[0] if len(held) == 1 else _together(*held)
            mine = np.flatnonzero(asked.column("kind").to_numpy() == kind).tolist()
            for shard, packed in zip(asked.column("shard").take(mine).to_pylist(), asked.column("keys").take(mine).to_pylist()):
                keys = _keys(packed)
                at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
                there = names[at] == keys
                if there.any():
                    found = counts[:, at[there]]
                    # Counts are small, and take less than what they come to.
                    found = np.ascontiguousarray(found, np.min_scalar_type(found.max()))
                    places = np.ascontiguousarray(found.view(np.uint8).reshape(-1, found.itemsize).T)
                    out.append((part, kind, shard, np.packbits(there).tobytes(), packer.compress(places.tobytes())))
        cols = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, (*_SENT[:2], pa.int64(), pa.binary(), pa.binary()))], ["part", "kind", "shard", "there", "rows"])

    def total(key, shard, answers):
        unpack = zstandard.ZstdDecompressor().decompress
        x, at_word, pair = _laid(shard.column("names")[0].as_py(), shard.column("at")[0].as_py())
        real, triple = thirds(x, at_word, pair)
        names, _, number = _distinct(x)
        asked = [(names, number[at_word])]
        asked += [(keys, number) for keys, _, number in map(_distinct, (pair, triple))]
        got = {(p, k): (there, rows) for p, k, there, rows in zip(*(answers.column(c).to_pylist() for c in ("part", "kind", "there", "rows")))}
        held = []  # own, total and left of each word, bigram and trigram
        for kind, (keys, number) in enumerate(asked, 1):
            counts = np.zeros((1 if kind == 3 else 5, len(keys)), np.int64)
            for p, s, e in _ranges(keys, parts):
                if (p, kind) in got:
                    there, values = got[p, kind]
                    at = s + np.flatnonzero(np.unpackbits(np.frombuffer(there, np.uint8), count=e - s))
                    places = np.frombuffer(unpack(values), np.uint8).reshape(-1, len(counts) * len(at))
                    counts[:, at] = np.ascontiguousarray(places.T).view(f"u{len(places)}").reshape(len(counts), -1)
            rows = [counts[0] - off[kind][np.minimum(counts[0], 3)]]
            if kind < 3:
                rows += [counts[1], off[kind + 1][1:] @ counts[2:]]
            held.append(np.stack(rows)[:, number])
        words, pairs, triples = held
        w = x[at_word[real + 2]]
        p = words[0, real + 2] / whole + even * np.where(w == 0, UNKNOWN_WORDS, 1)
        for own, context, at in ((pairs[0, real + 1], words, real + 1), (triples[0], pairs, real)):
            all_of, left = context[1, at], context[2, at]
            seen = all_of > 0
            all_of = np.where(seen, all_of, 1.0)
            p = own / all_of + np.where(seen, left / all_of, 1.0) * p
        bits = np.where(w == 0, np.log2(UNKNOWN_WORDS), 0.0) - np.log2(p)
        docs = shard.column("docs").combine_chunks().flatten()
        sizes = docs.field("n_words").to_numpy()
        ends = np.cumsum(sizes)
        sums = np.concatenate([[0.0], np.cumsum(bits)])
        return pa.table([*docs.flatten(), pa.array(sums[ends] - sums[ends - sizes], pa.float64())], ["doc_id", "lang", "n_words", "total_bits"])

    kind = shards.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    with _tables(shards.sparkSession) as make:
        name = make(f"shard bigint, docs {shards.schema['docs'].dataType.simpleString()}, names binary, at binary")
        appended(shards.select("shard", "docs", "names", "at"), name)
        rows = shards.sparkSession.table(name)
        asked = rows.select("shard", "names", "at").mapInArrow(wanted, "part int, kind int, shard long, keys binary")
        answers = asked.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(
            looked_up, "part int, kind int, shard long, there binary, rows binary")
        appended(rows.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(
            total, f"doc_id {kind}, lang string, n_words long, total_bits double"), path=path)


def assessed(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, steady: int = STEADY, **how) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, n_words, bits (per word), threshold, accepted."""
    rows = stored(scored(docs, labels, **how), "quality-bits")
    trusted = rows.where("trusted AND held")
    if trusted.isEmpty():
        trusted = rows.where("trusted")
    mean = trusted.groupBy(F.col("lang").alias("m_lang")).agg((F.sum("total_bits") / F.greatest(F.sum("n_words"), F.lit(1))).alias("mean"))
    mean = stored(mean, "quality-means")  # of a known size, so the optimizer need not deal documents by language
    overall = trusted.agg((F.sum("total_bits") / F.greatest(F.sum("n_words"), F.lit(1))).alias("mean")).first()["mean"] or 0.0

    def per_word(part: DataFrame) -> DataFrame:
        middle = F.coalesce("mean", F.lit(float(overall)))
        return part.join(mean, F.col("lang") == F.col("m_lang"), "left").withColumn(
            "bits", (F.col("total_bits") + steady * middle) / (F.col("n_words") + steady)).drop("m_lang", "mean")

    # Bits as counts in bins, of which there are few however many documents there are.
    bins = per_word(trusted).groupBy("lang", F.ceil(F.col("bits") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins = stored(bins, "quality-bins")

    def reached(part: DataFrame, by: list[str]) -> DataFrame:
        up_to = Window.partitionBy(*by).orderBy("bin")
        every = Window.partitionBy(*by)
        return part.withColumn("below", F.sum("n").over(up_to)).withColumn("all", F.sum("n").over(every)).where(
            F.col("below") >= quantile * F.col("all")).groupBy(*by).agg((F.min("bin") / BINS).alias("threshold"))

    total = bins.groupBy("bin").agg(F.sum("n").alias("n")).withColumn("one", F.lit(1))
    top = reached(total, ["one"]).first()
    above = bins.join(mean, F.col("lang") == F.col("m_lang")).withColumn("one", F.lit(1))
    above = above.groupBy("one", F.ceil(F.col("bin") - F.col("mean") * BINS).alias("bin")).agg(F.sum("n").alias("n"))
    spread = reached(above, ["one"]).first()
    spread = float(spread["threshold"]) if spread else 0.0
    sizes = bins.groupBy(F.col("lang").alias("s_lang")).agg(F.sum("n").alias("size"))
    own = reached(bins, ["lang"]).join(sizes, F.col("lang") == F.col("s_lang")).join(mean, F.col("lang") == F.col("m_lang"))
    carried = F.col("size") / (F.col("size") + F.lit(BEYOND / max(1 - quantile, 1e-9)))
    limits = stored(own.select(F.col("lang").alias("t_lang"), (carried * F.col("threshold") + (1 - carried) * (F.col("mean") + spread)).alias("threshold")),
                    "quality-limits")
    rows = per_word(rows).join(limits, F.col("lang") == F.col("t_lang"), "left")
    limit = F.coalesce("threshold", F.lit(float(top["threshold"]) if top else float("inf")))
    return rows.select("doc_id", F.nullif("lang", F.lit("")).alias("lang"), "n_words", "bits", limit.alias("threshold"),
                       ((F.col("n_words") == 0) | (F.col("bits") <= limit)).alias("accepted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that are rejected, all columns kept.

    Rows without doc_id stay; of rows that repeat a doc_id all go if one is rejected.
    """
    out = assessed(docs, labels).where("NOT accepted").select(F.col("doc_id").alias("__rejected"))
    return docs.join(out, docs["doc_id"] == out["__rejected"], "left_anti")


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document, and whether its language's threshold accepts it."""
    return assessed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "lang", "n_words", F.pow(F.lit(2.0), F.col("bits")).alias("perplexity"),
        F.pow(F.lit(2.0), F.col("threshold")).alias("threshold"), "accepted")
