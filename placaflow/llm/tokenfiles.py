"""Token ids in files: range coding in independent blocks, with checkpoints for parallel decoding.

A file holds whole documents in ascending key order:

    magic | frequency table | blocks | index | places of table and index, checksum

The table is shared by all blocks of the file. A block is a run of whole documents, about
`BLOCK_IDS` ids. The index is the list of checkpoints, one per block: its place and length in
the file, its first document and first id in the file, its number of documents and ids, and
the checksums of the stored bytes and of the ids; keys and lengths of the documents follow.
Any block can be decoded from the table and its checkpoint alone.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from placaflow.llm.chunks import ChunkEncoder
from placaflow.llm.common import durable, new_folder
from placaflow.llm.rans import Coder, Corrupt, checksum, frequencies
from placaflow.llm.warc import open_folder

MAGIC = b"TOKRANS1"
_TAIL = struct.Struct("<QQQQI")
BLOCK_IDS = 1 << 18
#: Ids of one file, and of one run of blocks that a reading task decodes.
FILE_IDS = 4 << 20
RUN_BLOCKS = 16
#: The id that ends every document.
END = 0
#: Fixed value: the sign for a space in the vocabulary of byte-level tokenizers.
BYTE_LEVEL_SPACE = "\u0120"


@lru_cache(maxsize=2)
def tokenizer(definition: str) -> ChunkEncoder:
    """An encoder of one tokenizer definition, with its cache, per worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel ones
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(definition)
    marks = [t.content for t in own.get_added_tokens_decoder().values()]
    return ChunkEncoder(
        lambda texts: [e.ids for e in own.encode_batch_fast(texts, add_special_tokens=False)],
        marks=marks,
        leads=_space_led(json.loads(definition)),
    )


def _space_led(definition: dict) -> np.ndarray | None:
    """Which ids are tokens that begin with a space; none unless tokens are the bytes of the text."""
    before = definition.get("pre_tokenizer") or {}
    if definition.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        return None
    vocabulary = definition["model"]["vocab"]
    leads = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    leads[[i for token, i in vocabulary.items() if token.startswith(BYTE_LEVEL_SPACE)]] = True
    return leads


def pack(keys: list[int | None], docs: list[np.ndarray], symbols: int) -> bytes:
    """The bytes of one file."""
    table = frequencies(np.bincount(np.concatenate(docs), minlength=symbols))
    coder = Coder(table)
    used = np.flatnonzero(table)
    packed = zlib.compress(used.astype("<u4").tobytes() + table[used].astype("<u4").tobytes())
    parts = [MAGIC, packed]
    place = len(MAGIC) + len(packed)
    index: list[list[int]] = []
    block: list[np.ndarray] = []
    size = first = start = 0

    def close(upto: int) -> None:
        nonlocal place, first, start, size
        ids = np.concatenate(block)
        data = coder.encode(ids)
        index.append([place, len(data), first, upto - first, start, len(ids), checksum(data), checksum(ids.astype("<u4").tobytes())])
        parts.append(data)
        place, first, start, size = place + len(data), upto, start + len(ids), 0
        block.clear()

    for i, ids in enumerate(docs):
        block.append(ids)
        size += len(ids)
        if size >= BLOCK_IDS:
            close(i + 1)
    if block:
        close(len(docs))
    head = json.dumps({"symbols": symbols, "blocks": index, "keys": keys, "lengths": [len(d) for d in docs]}).encode()
    listed = zlib.compress(head)
    tail = _TAIL.pack(len(MAGIC), len(packed), place, len(listed), checksum(packed + listed))
    return b"".join([*parts, listed, tail])


def write_tokens(
    df: DataFrame, key: str, text: str, definition: str, symbols: int, files: int, folder: str | None = None
) -> DataFrame:
    """Tokenise texts and write their ids in ascending key order; the manifest of the files.

    `definition` is the tokenizer as JSON, `files` the number of tasks that write (each starts a
    new file after `FILE_IDS` ids). The manifest has path, bytes, blocks, `part`, `run` (their
    order is the order of the documents), docs and ids. Null or empty texts have only the end id.
    Null keys come first; rows of one key follow one another in the order of a hash of their text,
    in more than one task where they are many. An empty table gives no files.
    Each task attempt writes files of its own, so that a repeated task does no harm.
    """
    folder = folder or new_folder(df.sparkSession, "tokens")
    tie = F.xxhash64(F.col(text))
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), tie.alias("tie"))
    ordered = rows.repartitionByRange(files, "key", "tie").sortWithinPartitions("key", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(definition).joined
        system, base = open_folder(folder)
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        done: list[tuple] = []
        keys: list[int | None] = []
        docs: list[np.ndarray] = []
        size = 0
        end = np.array([END], dtype="<u4")

        def flush() -> None:
            nonlocal size
            name = f"{base}/part-{part:06d}-{len(done):05d}-{attempt}.rans"
            data = pack(keys, docs, symbols)
            head = json.loads(zlib.decompress(data[_index_at(data)[0] : _index_at(data)[1]]))
            with system.open_output_stream(name, compression=None) as out:
                out.write(data)
            done.append((f"{folder}/{name.rpartition('/')[2]}", len(data), len(head["blocks"]), part, len(done), len(keys), size))
            keys.clear()
            docs.clear()
            size = 0

        for batch in batches:
            found = encode([t or "" for t in batch.column("text").to_pylist()])
            for k, ids in zip(batch.column("key").to_pylist(), found):
                keys.append(k)
                docs.append(np.concatenate([ids, end]))
                size += len(ids) + 1
                if size >= FILE_IDS:
                    flush()
        if keys:
            flush()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*done)], names=["path", "bytes", "blocks", "part", "run", "docs", "ids"]
            )

    schema = "path string, bytes long, blocks long, part long, run long, docs long, ids long"
    return durable(ordered.mapInArrow(write, schema))


def _index_at(data: bytes) -> tuple[int, int]:
    _, _, place, length, _ = _TAIL.unpack(data[-_TAIL.size :])
    return place, place + length


class TokenFile:
    """A file opened by its tail, table and index; blocks are read when asked for."""

    def __init__(self, path: str) -> None:
        system, name = open_folder(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        tail = _TAIL.unpack(self.file.read_at(_TAIL.size, size - _TAIL.size))
        packed = self.file.read_at(tail[1], tail[0])
        listed = self.file.read_at(tail[3], tail[2])
        if self.file.read_at(len(MAGIC), 0) != MAGIC or checksum(packed + listed) != tail[4]:
            raise Corrupt(f"{path}: table or index do not match their checksum")
        self.index = json.loads(zlib.decompress(listed))
        both = np.frombuffer(zlib.decompress(packed), "<u4").reshape(2, -1)
        table = np.zeros(self.index["symbols"], dtype=np.int64)
        table[both[0]] = both[1]
        self.coder = Coder(table)

    def block(self, number: int) -> tuple[int, list[tuple[int | None, np.ndarray]]]:
        """First id's place in the file, and (key, ids) of the block's documents."""
        place, length, first, n, start, ids, stored, plain = self.index["blocks"][number]
        data = self.file.read_at(length, place)
        if checksum(data) != stored:
            raise Corrupt(f"block {number} does not match its checksum")
        found = self.coder.decode(data, ids)
        if checksum(found.astype("<u4").tobytes()) != plain:
            raise Corrupt(f"the ids of block {number} do not match their checksum")
        cuts = np.cumsum(self.index["lengths"][first : first + n])[:-1]
        return start, list(zip(self.index["keys"][first : first + n], np.split(found, cuts)))


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Documents of the files: `doc_id`, `start` (ids of all documents before it), `ids`.

    `ids` are little-endian unsigned 32-bit integers, the end id included. Tasks decode runs of
    blocks of a file independently of each other.
    """
    before = Window.orderBy("part", "run").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    runs = placed.select(
        "path", "start", "blocks",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1, F.lit(RUN_BLOCKS))).alias("first"),
    )
    tasks = max(1, runs.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, blocks, first in zip(*(c.to_pylist() for c in batch.columns)):
                file = TokenFile(path)
                for number in range(first, min(blocks, first + RUN_BLOCKS)):
                    at, docs = file.block(number)
                    lengths = np.array([len(ids) for _, ids in docs], dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([k for k, _ in docs], pa.int64()),
                            pa.array(start + at + np.cumsum(lengths) - lengths),
                            pa.array([ids.astype("<u4").tobytes() for _, ids in docs], pa.binary()),
                        ],
                        names=["doc_id", "start", "ids"],
                    )

    return runs.repartition(tasks).mapInArrow(read, "doc_id long, start long, ids binary")


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def token_count(definition: str) -> int:
    """One more than the largest id of a tokenizer."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_str(definition).get_vocab(with_added_tokens=True).values()) + 1
