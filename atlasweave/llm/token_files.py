"""Token-id files: flat unsigned integers, 64-bit document offsets, memory-mapped reading.

One shard per task, in ascending doc_id order over all shards:

* ``NAME.ids``: the ids of the shard's documents in a row, little-endian, unsigned, 16
  bits wide where the vocabulary fits, else 32;
* ``NAME.off``: n + 1 unsigned 64-bit offsets into it, the first 0;
* ``NAME.doc``: the n doc_ids, signed 64-bit, without the null ones, which come first.

The manifest, a table with one row per shard, names the files; a shard's base (the ids
before it) is the prefix sum over the manifest. A task writes under a name of its own,
so what a lost or repeated task leaves behind is named by no manifest row.

Each distinct piece is encoded once per portion. Texts of ASCII and Latin letters are
lower-cased and cut into the tokenizer's pieces here, and the tokenizer's model
encodes the pieces. Any other text is cut at spaces, tabs and line ends, which the
tokenizer drops, and the chunks with other characters go through the whole tokenizer.

Defined cases: null text counts as empty and has the end id only; null doc_ids come
first; repeated ids are ordered by text; an empty table has no shard. doc_id must be an
integer. Other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasweave.llm.bpe import Portions, texts
from atlasweave.llm.catalog import query, table
from atlasweave.llm.stored import stored
from atlasweave.session import scratch_path

END_ID = 1
MANIFEST = "shard long, name string, width int, n_docs long, n_null long, n_ids long"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a URI or as a plain path."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + folder)


def mapped(files: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file's numbers: memory-mapped where the store is a local or mounted one, else read."""
    if files.get_file_info(path).size == 0:
        return np.empty(0, kind)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with files.open_input_file(path) as source:
        return np.frombuffer(source.read_buffer(), kind)


# Fixed: the split pattern of the vocabulary file, for text of the characters in _PLAIN, which its
# normaliser only lower-cases, each into one character.
_LETTERS = "a-z\xdf-\xf6\xf8-\u012f\u0131-\u017f"
_PIECES = re.compile(rf"[{_LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s0-9{_LETTERS}]+").findall
_OTHER = re.compile("[^\t\n\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f]").search


def pieces(text: str) -> list:
    """Pieces of a text; a chunk that needs the whole tokenizer comes as a tuple."""
    if _OTHER(text) is None and "<|" not in text:
        return _PIECES(text.lower())
    found: list = []
    for chunk in re.split("[ \t\n\r]+", text):
        if _OTHER(chunk) is None and "<|" not in chunk:
            found += _PIECES(chunk.lower())
        else:
            found.append((chunk,))
    return found


def byte_characters() -> list[str]:
    """The character by which byte-level vocabularies write each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Write the files of ``docs`` (doc_id, text) below ``folder``; the manifest.

    ``tokenizer`` is a JSON file of the tokenizers library, read by the driver.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as source:
        model = spark.sparkContext.broadcast(source.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tool = Tokenizer.from_str(model.value)
        kind = "<u2" if max(tool.get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else "<u4"

        tokenize, characters = tool.model.tokenize, byte_characters()

        def encode(fresh: list) -> tuple[np.ndarray, np.ndarray]:
            ids, ends = array("I"), []
            for piece in fresh:
                if isinstance(piece, tuple):
                    ids.extend(tool.encode(piece[0], add_special_tokens=False).ids)
                else:
                    ids.extend([t.id for t in tokenize("".join([characters[b] for b in piece.encode()]))])
                ends.append(len(ids))
            return np.array(ids, np.uint32), np.array(ends, np.int64)

        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        files, root = opened(folder)
        sink = None
        offsets, keys, nulls = [0], [], 0
        for key, ids in Portions(pieces, encode).over(texts(batches, [])):
            if sink is None:
                files.create_dir(root, recursive=True)
                sink = files.open_output_stream(f"{root}/{name}.ids")
            sink.write(np.append(ids, end_id).astype(kind).tobytes())
            offsets.append(offsets[-1] + len(ids) + 1)
            if key is None:
                nulls += 1
            else:
                keys.append(key)
        if sink is not None:
            sink.close()
            for suffix, numbers in (("off", np.array(offsets, "<u8")), ("doc", np.array(keys, "<i8"))):
                with files.open_output_stream(f"{root}/{name}.{suffix}") as out:
                    out.write(numbers.tobytes())
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([TaskContext.get().partitionId()], pa.int64()), "name": [name],
                "width": pa.array([int(kind[2])], pa.int32()), "n_docs": [len(offsets) - 1], "n_null": [nulls], "n_ids": [offsets[-1]]})

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    # Ranges of doc_id, not of hashes: the shards follow one another.
    ordered = ordered.repartitionByRange(F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    return stored(ordered.mapInArrow(run, MANIFEST), "shards")


def read_shards(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document in the files; ids as little-endian unsigned 32-bit integers.

    ``start`` is the number of ids before the document over all shards.
    """
    width = manifest.count()  # one row per shard
    based = manifest.withColumn(
        "base", F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = opened(folder)
        for shard in (row for batch in batches for row in batch.to_pylist()):
            ids = mapped(files, f"{root}/{shard['name']}.ids", f"<u{shard['width']}")
            offsets = mapped(files, f"{root}/{shard['name']}.off", "<u8").astype(np.int64)
            keys = [None] * shard["n_null"] + mapped(files, f"{root}/{shard['name']}.doc", "<i8").tolist()
            step = 256
            for at in range(0, len(keys), step):
                cuts = offsets[at : at + step + 1].tolist()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(keys[at : at + step], pa.int64()), "start": pa.array([shard["base"] + c for c in cuts[:-1]], pa.int64()),
                    "ids": pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})

    spread = based.repartition(max(width, 1), "name")
    return spread.mapInArrow(run, "doc_id long, start long, ids binary")


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document, from the files."""
    folder = scratch_path(spark, "token-files")
    manifest = write_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return read_shards(manifest, folder).select(
        "doc_id", "start", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
