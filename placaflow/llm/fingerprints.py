"""Document fingerprints: a homomorphic hash of the multiset of a document's paragraphs.

Every paragraph is hashed to a wide vector; a document's fingerprint is the sum of its
paragraphs' vectors. It does not depend on their order, and inserting or deleting a paragraph
adds or subtracts its vector. The vector has two parts:

* 16 lanes modulo 2**64, filled by SHAKE-128 of the whole paragraph: equality;
* 128 lanes modulo 2**32, each the sum of a sign per sentence of the paragraph, the signs being
  the bits of the sentence's hash: likeness. The difference of two such sums is small when the
  documents share most sentences, and their cosine estimates that of the sentence counts.

Paragraphs are lines; empty lines do not count. Sentences longer than 200 characters are cut.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placaflow.llm.common import durable, keep_clear, small

WIDE, SIGNS = 16, 128
BYTES = 8 * WIDE + 4 * SIGNS
#: Texts hashed together.
GROUP = 128
_SENTENCE = re.compile(r"[^.!?\n]{1,200}[.!?]*")
#: Ids of one stretch of the order, at least; more if there are over `STRETCHES` of them.
STRETCH_IDS = 512
STRETCHES = 500_000


def _sums(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of consecutive groups of rows; groups may be empty."""
    out = np.zeros((len(counts), rows.shape[1]), dtype=rows.dtype)
    full = np.flatnonzero(counts)
    if len(full):
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        out[full] = np.add.reduceat(rows, starts[full], axis=0)
    return out


def fingerprints(texts: Sequence[str]) -> np.ndarray:
    """Fingerprints of texts, a row of `BYTES` bytes for each; some texts at a time."""
    parts = [_fingerprints(texts[at : at + GROUP]) for at in range(0, len(texts), GROUP)]
    return np.concatenate([*parts, np.empty((0, BYTES), dtype=np.uint8)])


def _fingerprints(texts: Sequence[str]) -> np.ndarray:
    lines = [[p.encode() for p in t.split("\n") if p] for t in texts]
    wide = b"".join(hashlib.shake_128(p).digest(8 * WIDE) for ps in lines for p in ps)
    exact = _sums(
        np.frombuffer(wide, dtype="<u8").reshape(-1, WIDE), np.array([len(p) for p in lines], dtype=np.int64)
    )
    parts = [_SENTENCE.findall(t) for t in texts]
    signs = b"".join(xxhash.xxh3_128_digest(s.strip()) for ps in parts for s in ps)
    counts = np.array([len(p) for p in parts], dtype=np.int64)
    bits = np.unpackbits(np.frombuffer(signs, dtype=np.uint8).reshape(-1, SIGNS // 8), axis=1)
    ones = _sums(bits.astype(np.int32), counts)
    likes = (2 * ones.astype(np.int64) - counts[:, None]) & 0xFFFFFFFF
    out = np.empty((len(texts), BYTES), dtype=np.uint8)
    out[:, : 8 * WIDE] = np.ascontiguousarray(exact.astype("<u8")).view(np.uint8)
    out[:, 8 * WIDE :] = np.ascontiguousarray(likes.astype("<u4")).view(np.uint8)
    return out


def added(first: np.ndarray, second: np.ndarray, sign: int = 1) -> np.ndarray:
    """Lane by lane sum (or difference) of fingerprints, modulo the lanes' powers of two."""
    out = np.empty_like(first)
    for part, kind in ((slice(0, 8 * WIDE), "<u8"), (slice(8 * WIDE, BYTES), "<u4")):
        a = np.ascontiguousarray(first[:, part]).view(kind)
        b = np.ascontiguousarray(second[:, part]).view(kind)
        out[:, part] = np.ascontiguousarray(a + b if sign > 0 else a - b).view(np.uint8)
    return out


def likeness(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Cosine of the sign lanes, from 0 to 1; equal fingerprints have 1, empty ones else 0."""
    a, b = (
        np.ascontiguousarray(x[:, 8 * WIDE :]).view("<i4").astype(np.float64) for x in (first, second)
    )
    norm = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    cosine = np.divide((a * b).sum(axis=1), norm, out=np.zeros(len(a)), where=norm > 0)
    equal = (first == second).all(axis=1)
    return np.where(equal, 1.0, np.clip(cosine, 0.0, 1.0))


def _hex(prints: np.ndarray) -> list[str]:
    return [bytes(p).hex() for p in prints]


def _unhex(prints: Sequence[str]) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(prints)), dtype=np.uint8).reshape(-1, BYTES)


def fingerprint(df: DataFrame, text: str) -> DataFrame:
    """Adds `fingerprint` (lower-case hex); a null or empty text has the sum of nothing."""
    df = keep_clear(df, ["fingerprint"])
    schema = df.select("*", F.lit("").alias("fingerprint")).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            yield batch.append_column("fingerprint", pa.array(_hex(fingerprints(texts))))

    return df.mapInArrow(add, schema)


def edit_fingerprints(df: DataFrame, prints: str, inserted: str, removed: str) -> DataFrame:
    """Adds `edited`: fingerprints after inserting and removing paragraphs, without the text.

    `inserted` and `removed` are text columns, one or more paragraphs each; null is nothing.
    """
    df = keep_clear(df, ["edited"])
    schema = df.select("*", F.lit("").alias("edited")).schema

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            now = _unhex(batch.column(prints).to_pylist())
            for column, sign in ((inserted, 1), (removed, -1)):
                texts = [t or "" for t in batch.column(column).to_pylist()]
                now = added(now, fingerprints(texts), sign)
            yield batch.append_column("edited", pa.array(_hex(now)))

    return df.mapInArrow(edit, schema)


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every row with `next_text`: the text after it in descending key order, the first after the last.

    Null keys come last; rows of one key are ordered by a hash of their text. A null text is
    empty. The order is cut into stretches of keys; the first row of each stretch also goes to
    the one before it, so that a single shuffle of the texts and a window in each stretch do.
    """
    df = keep_clear(df, ["_at", "_tie", "_guest", "_home", "_first", "_before", "next_text"])
    width = max(STRETCH_IDS, -(-df.select(key).count() // STRETCHES))
    body = F.coalesce(F.col(text), F.lit(""))
    home = F.coalesce(F.floor(F.col(key) / width), F.lit(-(1 << 62))).cast("long")
    rows = df.withColumns({text: body, "_home": home, "_tie": F.xxhash64(body)})
    # Keys are whole numbers; the window below needs them with their ties in one order.
    first = F.struct(F.col(key).alias("k"), F.col("_tie").alias("t"))
    stretches = durable(rows.groupBy("_home").agg(F.max(first).alias("_first")))
    n = stretches.count()
    order = Window.orderBy(F.col("_home").desc())
    before = F.coalesce(F.lag("_home").over(order), F.min("_home").over(Window.partitionBy()))
    known = stretches.select("_home", "_first", before.alias("_before"))
    places = F.array(F.struct(F.col("_home").alias("at"), F.lit(False).alias("guest")))
    guest = F.array(F.struct(F.col("_before").alias("at"), F.lit(True).alias("guest")))
    both = F.when(first.eqNullSafe(F.col("_first")), F.concat(places, guest)).otherwise(places)
    dealt = rows.join(small(known, n, 64), "_home").select(*rows.columns, F.explode(both).alias("place"))
    inside = Window.partitionBy("place.at").orderBy(
        F.col("place.guest"), F.col(key).desc_nulls_last(), F.col("_tie").desc()
    )
    return dealt.withColumn("next_text", F.lead(text).over(inside)).where("NOT place.guest").drop(
        "place", "_home", "_tie"
    )


def compare_edits(df: DataFrame, key: str, text: str) -> DataFrame:
    """Fingerprints of texts and of their edited forms, and how alike they are.

    The edited text has its last floor(n/2) code points replaced by the first as many (or all)
    of the next document's. Returns the key, `n_chars`, `edited_sha256`, `fingerprint`,
    `edited_fingerprint`, `near_edited`, `near_next`. Null texts are empty; the only row of a
    table is its own next one; repeated rows are rows of their own; an empty frame stays empty.
    """
    rows = with_next(df.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "text")
    length = F.char_length("text")
    cut = F.floor(length / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), length - cut), F.substr("next_text", F.lit(1), cut))
    ready = rows.select("key", length.cast("long").alias("n_chars"), "text", edited.alias("edited"), "next_text").select(
        "key", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "text", "edited", "next_text"
    )
    out = (
        "edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    kind = dict(ready.dtypes)["key"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, GROUP) for b in batches for at in range(0, b.num_rows, GROUP)):
            columns = [batch.column(c).to_pylist() for c in ("text", "edited", "next_text")]
            # Most next texts are the texts of other rows here: each text is hashed once.
            places = {t: i for i, t in enumerate(dict.fromkeys(t for c in columns for t in c))}
            prints = fingerprints(list(places))
            own, changed, following = (prints[[places[t] for t in c]] for c in columns)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"), batch.column("n_chars"), batch.column("edited_sha256"),
                    pa.array(_hex(own)), pa.array(_hex(changed)),
                    pa.array(likeness(own, changed)), pa.array(likeness(own, following)),
                ],
                names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    done = ready.mapInArrow(compare, f"key {kind}, n_chars long, {out}")
    return done.withColumnRenamed("key", key)
