"""Byte-level BPE by corpus-level merge replay, and decoding.

The pieces that the split pattern finds in a shard of texts are numbered, so that
each distinct piece is encoded once. All distinct pieces of the shard lie in one flat
array of tokens; an inverted index holds, for every merge rank that occurs, the
positions of the adjacent pairs it would join. Ranks are replayed in ascending order,
each over all of its positions at once, and only the pairs beside a merge are looked
up again. A piece in which a merge brings up a pair of lower rank while more merges
of the current rank are due is encoded on its own, pair by pair.

Encoding needs no shuffle: a shard is what a task reads, in portions of bounded size.

Defined cases: null text counts as empty and has no ids; bytes that are not UTF-8
become U+FFFD; repeated rows stay rows; an empty table gives an empty result; other
columns are ignored. The strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasweave.llm.catalog import query, table

#: A portion ends at so many tokens of text or distinct pieces.
PORTION_TOKENS, PORTION_PIECES = 4_000_000, 700_000
#: The same for units, which hold white space and are encoded by way of their pieces.
UNIT_TOKENS, PORTION_UNITS = 500_000, 80_000
NONE = np.iinfo(np.int64).max


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The pairs of tokens that a rank file joins, as sorted keys."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.pairs = pairs

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it is not joined."""
        if not len(self.keys):
            return np.full(len(left), NONE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def one(self, piece: bytes) -> list[int]:
        """Ids of one piece: the lowest rank first, of equal ranks the leftmost."""
        token = [int(self.single[b]) for b in piece]
        after = [*range(1, len(token)), -1]
        before = [*range(-1, len(token) - 1)]
        pairs = self.pairs
        due = [(r, i) for i in range(len(token) - 1) if (r := pairs.get(token[i] << 32 | token[i + 1])) is not None]
        heapq.heapify(due)
        while due:
            rank, i = heapq.heappop(due)
            j = after[i]
            if token[i] < 0 or j < 0 or pairs.get(token[i] << 32 | token[j]) != rank:
                continue
            token[i], token[j] = rank, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := pairs.get(rank << 32 | token[k])) is not None:
                    heapq.heappush(due, (r, i))
            h = before[i]
            if h >= 0 and (r := pairs.get(token[h] << 32 | rank)) is not None:
                heapq.heappush(due, (r, h))
        return [t for t in token if t >= 0]


def replay(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends): the ids of all ``pieces`` in a row, and where each one's end."""
    whole = [merges.ranks.get(p, -1) for p in pieces]
    long = [p for p, w in zip(pieces, whole) if w < 0]
    sizes = np.array([len(p) for p in long], np.int64)
    token = merges.single[np.frombuffer(b"".join(long), np.uint8)]
    n = len(token)
    owner = np.repeat(np.arange(len(long)), sizes)
    first = np.cumsum(sizes) - sizes
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[first[sizes > 0] + sizes[sizes > 0] - 1] = n  # n and -1: no neighbour
    before[first[sizes > 0]] = -1
    alive = np.ones(n, bool)
    alone: dict[int, list[int]] = {}

    pair = np.full(n, NONE)  # rank of the pair that begins at each position

    index: dict[int, list[np.ndarray]] = {}
    due: list[int] = []

    def enter(at: np.ndarray) -> None:
        """Look up the pairs that begin ``at`` and enter them in the index; a position may come twice."""
        has = after[at] < n
        pair[at[~has]] = NONE
        at = at[has]
        ranks = merges.of(token[at], token[after[at]])
        pair[at] = ranks
        at, ranks = at[ranks != NONE], ranks[ranks != NONE]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(at)]
        for rank, start, end in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:]):
            if rank not in index:
                index[rank] = []
                heapq.heappush(due, rank)
            index[rank].append(at[start:end])

    if n:
        enter(np.arange(n))
    while due:
        rank = heapq.heappop(due)
        parts = index.pop(rank)
        at = np.concatenate(parts) if len(parts) > 1 else parts[0]
        at = np.sort(at[alive[at] & (pair[at] == rank)])
        if len(at) > 1:
            at = at[np.concatenate([[True], at[1:] != at[:-1]])]
            # Where pairs overlap, every other one is joined, from the left.
            joint = np.concatenate([[False], after[at[:-1]] == at[1:]])
            if joint.any():
                run = np.flatnonzero(~joint)
                at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.concatenate([run, [len(at)]])))) % 2 == 0]
            same = owner[at[1:]] == owner[at[:-1]]
            if same.any():
                several = np.concatenate([[False], same]) | np.concatenate([same, [False]])
                some = at[several]
                right, left = after[after[some]], before[some]
                new = np.full(len(some), rank)
                lower = merges.of(new, new) < rank
                r, l = right < n, left >= 0
                lower[r] |= merges.of(new[r], token[right[r]]) < rank
                lower[l] |= merges.of(token[left[l]], new[l]) < rank
                if lower.any():
                    out = np.unique(owner[some[lower]])
                    for w in out.tolist():
                        alone[w] = merges.one(long[w])
                        alive[first[w] : first[w] + sizes[w]] = False
                    at = at[~np.isin(owner[at], out)]
        if not len(at):
            continue
        second = after[at]
        third = after[second]
        token[at] = rank
        alive[second] = False
        after[at] = third
        has = third < n
        before[third[has]] = at[has]
        left = before[at]
        enter(np.concatenate([at, left[left >= 0]]))

    count = np.ones(len(pieces), np.int64)
    slots = np.flatnonzero(np.array(whole, np.int64) < 0)
    count[slots] = np.bincount(owner[alive], minlength=len(long)) if len(long) else 0
    for w, ids in alone.items():
        count[slots[w]] = len(ids)
    ends = np.cumsum(count)
    ids = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    begins = ends - count
    single = np.flatnonzero(np.array(whole, np.int64) >= 0)
    ids[begins[single]] = np.array(whole, np.int64)[single]
    kept = np.flatnonzero(alive)
    if len(kept):
        mine = owner[kept]
        within = np.arange(len(kept)) - np.searchsorted(mine, mine)
        ids[begins[slots[mine]] + within] = token[kept]
    for w, own in alone.items():
        ids[begins[slots[w]] : ends[slots[w]]] = own
    return ids, ends


class Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def units(pieces_of):
    """(split, pieces): a text's units, and the pieces of a unit.

    A space between two characters that are no white space begins a new unit, since no
    piece reaches over it from either side. Units recur, so the pattern is run over
    distinct ones only. A unit is a string if a space goes before it, and the first of
    a text is a tuple of that string.
    """
    between = re.compile(r"(?<=\S) (?=\S)").split

    def split(text: str) -> list:
        words = text.split()
        single = len("".join(words)) + len(words) - 1 == len(text)  # white space stands alone, and not at the ends
        found: list = text.split(" ") if single else between(text) if text else []
        if found:
            found[0] = (found[0],)
        return found

    return split, lambda unit: pieces_of(" " + unit if isinstance(unit, str) else unit[0])


def encode_units(fresh: list, pieces_of, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends) of ``fresh`` units: their distinct pieces are encoded together."""
    numbers, count = Numbered(), np.zeros(len(fresh), np.int64)
    # Units without white space are split in one text: their own spaces are the only ones, and only their first pieces begin with one.
    plain = np.fromiter((isinstance(unit, str) and unit.split() == [unit] for unit in fresh), bool, len(fresh))
    found = pieces_of(tuple([" " + " ".join(itertools.compress(fresh, plain))])) if plain.any() else []
    first = np.flatnonzero(np.fromiter((p[0] == " " for p in found), bool, len(found)))
    count[plain] = np.diff(first, append=len(found))
    rest = [pieces_of(fresh[k]) for k in np.flatnonzero(~plain).tolist()]
    count[~plain] = [len(own) for own in rest]
    pieces = itertools.chain(found, *rest)
    which = np.fromiter(map(numbers.__getitem__, pieces), np.int64, len(found) + sum(map(len, rest)))
    # The pieces of each unit, in the order of the units.
    order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
    begin = np.empty(len(fresh), np.int64)
    begin[order] = np.cumsum(count[order]) - count[order]
    stops = np.cumsum(count)
    which = which[np.arange(len(which)) + np.repeat(begin - stops + count, count)]
    ids, ends = replay([p.encode() for p in numbers], merges)
    size = np.diff(ends, prepend=0)[which]
    stops = np.cumsum(size)
    total = int(stops[-1]) if len(stops) else 0
    flat = ids[np.arange(total) + np.repeat(ends[which] - stops, size)]
    return flat, np.concatenate([[0], stops])[np.cumsum(count)]


class Portions:
    """Turns texts into ids, portion by portion; known pieces stay until there are too many.

    ``encode`` gives (ids, ends) of new pieces; ``split`` the pieces of a text.
    """

    def __init__(self, split, encode, tokens: int = PORTION_TOKENS, pieces: int = PORTION_PIECES):
        self.split, self.encode, self.tokens, self.pieces = split, encode, tokens, pieces
        self.forget()

    def forget(self) -> None:
        self.numbers, self.done = Numbered(), 0
        self.ids, self.begin, self.size = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def learn(self) -> None:
        fresh = list(self.numbers)[self.done :] if self.done else list(self.numbers)
        if fresh:
            ids, ends = self.encode(fresh)
            size = np.diff(ends, prepend=0)
            self.begin = np.concatenate([self.begin, len(self.ids) + ends - size])
            self.size = np.concatenate([self.size, size])
            self.ids = np.concatenate([self.ids, ids])
            self.done = len(self.numbers)

    def look_up(self, numbers: np.ndarray) -> np.ndarray:
        size = self.size[numbers]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.arange(total) + np.repeat(self.begin[numbers] - ends + size, size)]

    def over(self, rows: Iterator[tuple[object, str]]) -> Iterator[tuple[object, np.ndarray]]:
        """(key, ids) of each (key, text), in order."""
        waiting, tokens = [], 0
        for key, text in rows:
            numbers = np.fromiter(map(self.numbers.__getitem__, self.split(text)), np.uint32)
            waiting.append((key, numbers))
            tokens += len(numbers)
            if tokens >= self.tokens or len(self.numbers) >= self.pieces:
                yield from self.flush(waiting)
                waiting, tokens = [], 0
        yield from self.flush(waiting)

    def flush(self, waiting):
        self.learn()
        for key, numbers in waiting:
            yield key, self.look_up(numbers)
        if len(self.numbers) >= self.pieces:
            self.forget()


def packed(rows: Iterator[tuple[object, object]], types: list[pa.DataType], names: list[str], most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about ``most`` bytes of their last column, which is binary."""
    held: list[tuple] = []
    size = 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    for row in rows:
        held.append(row)
        size += len(row[-1]) + 16
        if size >= most:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def texts(batches: Iterator[pa.RecordBatch], ids: list) -> Iterator[tuple[object, str]]:
    """(doc_id, text) of each row of (doc_id, binary text); null text as empty."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for key, text in zip(part.column(0), part.column(1)):
                yield key.as_py(), (text.as_py() or b"").decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, ids) of every row; ids as little-endian unsigned 32-bit integers.

    ``path`` names the rank file; the driver reads it (its size is fixed) and ships it.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges(ranks.value)
        split, pieces_of = units(regex.compile(pattern).findall)
        portions = Portions(split, lambda fresh: encode_units(fresh, pieces_of, merges), UNIT_TOKENS, PORTION_UNITS)
        rows = ((key, ids.astype("<u4").tobytes()) for key, ids in portions.over(texts(batches, [])))
        yield from packed(rows, [arrow_id, pa.binary()], ["doc_id", "ids"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(kind)
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("ids", T.BinaryType())])
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids of :func:`encode` stand for."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: piece for piece, rank in ranks.value.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                out = [b"".join(map(token.__getitem__, np.frombuffer(x.as_buffer(), "<u4").tolist())) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])

    schema = T.StructType([*encoded.select("doc_id", "ids").schema.fields, T.StructField("decoded", T.BinaryType())])
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    return decode(encode(docs, path), path).select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text they decode to, as digests."""
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
