"""Byte-level BPE encoding and decoding through a sentencepiece model made from a rank file.

The model is written out directly: every byte string of the vocabulary is a piece, its bytes
mapped to letters, scored by its negative rank; the normaliser is the identity. Merging the
pair with the best score is then merging the pair with the lowest rank. Texts are split into
pre-tokens by a pattern, each is encoded by itself, and ids are decoded by the inverse mapping.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from placaflow.llm.chunks import ChunkEncoder
from placaflow.llm.common import give_back, in_small_batches, keep_clear, kept

#: Bytes of a generation of the chunks whose ids a worker keeps.
CACHE_BYTES = 48 << 20
#: Pre-tokens encoded in one call, and the letter between them, which no piece has.
ROW, BETWEEN = 256, "\ufffc"
#: Bytes become the letters from here on, none of which has a meaning in sentencepiece.
FIRST_LETTER = 0x100
_SHIFT = {b: FIRST_LETTER + b for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file (base64 and rank per line) in rank order."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in pairs)
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks must be gapless from 0")
    return [token for _, token in ranked]


def _varint(number: int) -> bytes:
    out = bytearray()
    while number > 0x7F:
        out.append(number & 0x7F | 0x80)
        number >>= 7
    return bytes(out) + bytes([number])


def _field(number: int, value: int | float | bytes) -> bytes:
    """A protobuf field: whole numbers as varints, floats as 32 bits, bytes with a length."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def letters(data: bytes) -> str:
    return data.decode("latin-1").translate(_SHIFT)


def model_proto(ranks: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks; the unknown piece comes last."""
    pieces = [
        _field(1, _field(1, letters(token).encode()) + _field(2, -float(rank)) + _field(3, 1))
        for rank, token in enumerate(ranks)
    ]
    unknown = _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = b"".join([
        _field(3, 2),  # BPE
        _field(4, len(ranks) + 1),
        _field(40, len(ranks)), _field(41, -1), _field(42, -1), _field(43, -1),
    ])
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + unknown + _field(2, trainer) + _field(3, normaliser)


class ByteBpe:
    """Encoder and decoder of one model and pattern."""

    def __init__(self, proto: bytes, pattern: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.pattern = regex.compile(pattern)
        self.encode = ChunkEncoder(self._encode, CACHE_BYTES)
        size = self.model.get_piece_size() - 1
        self.bytes = inverse([self.model.id_to_piece(i) for i in range(size)])

    def _encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text. Pre-tokens go to the model in rows, a letter outside the vocabulary between them."""
        split = [self.pattern.findall(t) for t in texts]
        flat = [letters(p.encode()) for p in dict.fromkeys(p for parts in split for p in parts)]
        found: list[list[int]] = []
        for at in range(0, len(flat), ROW):
            ids = np.array(self.model.encode(BETWEEN.join(flat[at : at + ROW])), dtype=np.int64)
            ends = np.flatnonzero(ids == len(self.bytes)).tolist()
            listed = ids.tolist()
            found += [listed[a:b] for a, b in zip([0, *[e + 1 for e in ends]], [*ends, len(listed)])]
        known = dict(zip(flat, found, strict=True))
        return [[i for p in parts for i in known[letters(p.encode())]] for parts in split]

    def decode(self, ids: np.ndarray) -> bytes:
        return joined(self.bytes, ids)


def inverse(pieces: list[str]) -> list[bytes]:
    """The bytes of pieces by the inverse mapping of their letters."""
    return [bytes(ord(x) - FIRST_LETTER for x in piece) for piece in pieces]


def joined(table: list[bytes], ids: np.ndarray) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Shorter batches: a batch's ids are in memory several times."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Workers keep the coder of this name between the tasks of these operators.
CODER = "byte-bpe"


def coder(proto: bytes, pattern: str) -> ByteBpe:
    """One coder, with its cache, per worker process."""
    return kept(CODER, (proto, pattern), lambda: ByteBpe(proto, pattern))


def _ids(bpe: ByteBpe, texts: pa.Array) -> pa.ListArray:
    found = bpe.encode([t or "" for t in texts.to_pylist()])
    ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
    flat = np.concatenate([*found, np.zeros(0, "<u4")]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _decoded(table: list[bytes], lists: pa.ListArray) -> pa.Array:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    out, at = [], 0
    for end, there in zip(ends.tolist(), lists.is_valid().to_pylist()):
        out.append(joined(table, flat[at:end]) if there else None)
        at = end
    return pa.array(out, pa.binary())


def encode(df: DataFrame, text: str, ranks_path: str, pattern: str) -> DataFrame:
    """Adds `ids` (array of int): the ranks of a text's tokens, as the rank file's own library gives.

    A null or empty text has no ids. An input column `ids` becomes `ids_in`. The vocabulary is
    read where the job is started and sent along; its size is that of the file.
    """
    df = keep_clear(in_small_batches(df), ["ids"])
    proto = model_proto(read_ranks(ranks_path))
    schema = df.selectExpr("*", "array(0) AS ids").schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(proto, pattern)
        for batch in sliced(batches):
            yield batch.append_column("ids", _ids(bpe, batch.column(text)))
        give_back(CODER)

    return df.mapInArrow(add, schema)


def decode(df: DataFrame, ids: str, ranks_path: str) -> DataFrame:
    """Adds `decoded` (binary): the bytes of the ids; null ids give null. `decoded` may clash as `ids`."""
    df = keep_clear(in_small_batches(df), ["decoded"])
    pieces = [letters(token) for token in read_ranks(ranks_path)]
    schema = df.selectExpr("*", "CAST('' AS BINARY) AS decoded").schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = inverse(pieces)
        for batch in sliced(batches):
            yield batch.append_column("decoded", _decoded(own, batch.column(ids)))
        give_back(CODER)

    return df.mapInArrow(add, schema)


def round_trip(df: DataFrame, text: str, ranks_path: str, pattern: str) -> DataFrame:
    """Puts `ids` (see `encode`) and `decoded`, their bytes (see `decode`), in place of the text.

    One worker makes both, so that a task has one worker and not two that each come to hold a coder.
    """
    df = keep_clear(in_small_batches(df), ["ids", "decoded"])
    proto = model_proto(read_ranks(ranks_path))
    schema = df.drop(text).selectExpr("*", "array(0) AS ids", "CAST('' AS BINARY) AS decoded").schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(proto, pattern)
        for batch in sliced(batches):
            ids = _ids(bpe, batch.column(text))
            rest = batch.drop_columns([text])
            yield rest.append_column("ids", ids).append_column("decoded", _decoded(bpe.bytes, ids))
        give_back(CODER)

    return df.mapInArrow(add, schema)
