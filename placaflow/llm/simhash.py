"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees.

Fingerprints within `radius` bits agree in all of some k of `radius + k` bit ranges, so every
choice of k ranges deals the distinct fingerprints to shards by their bits there, and each link
lies inside a shard. A shard is cut into BK-trees of bounded size: a child hangs below its
parent under their Hamming distance, and a search follows only edges within the radius of its
own distance to the node.

1. Every tree is searched with its own members; what it links is told as a forest.
2. In shards of several trees, members outside the shard's largest component so far search
   the trees of the others: a crowd of copies costs its outsiders, not its square.

Trees meet their searches by a shuffle, and by a broadcast only below a checked size: their
number grows with the table. Links and components stay in Spark tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placaflow.llm.common import drop_folder, durable, give_back, in_small_batches, keep_clear, small, stored
from placaflow.llm.components import components

SEED, RADIUS, SHINGLE_WORDS = 42, 4, 4
#: Fingerprints of a shard as aimed at, of a tree at most (about), and of one block of searches.
SHARD, TREE, BLOCK = 256, 1024, 1024
#: Shards by one choice of ranges may hold this many before more ranges are chosen.
CROWDED = 1024
#: Searches of one descent; bounds its frontier.
_TOGETHER = 256
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# Fingerprints ------------------------------------------------------------------------


def fingerprint(text: str | None, n: int = SHINGLE_WORDS) -> int:
    """64 bits, each set where over half of the shingles' hashes have it; 0 without words.

    A-Z are lower-cased, words are `[^\\x20\\x09-\\x0D]+`, shingles are n words with repeats,
    joined by a space; a text of fewer words is one shingle.
    """
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < n:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist()
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), 1 << 14):
        part = zip(starts[at : at + (1 << 14)], ends[at : at + (1 << 14)])
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in part], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def with_fingerprints(df: DataFrame, text: str, n: int = SHINGLE_WORDS) -> DataFrame:
    """The frame with the text replaced by its fingerprint `fp`, as a signed 64-bit number."""
    others = [c for c in df.columns if c != text]
    schema = df.select(*others, F.lit(0).cast("long").alias("fp")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, n) for t in batch.column(text).to_pylist()]
            fps = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(fps)], names=[*others, "fp"])
        give_back()

    return in_small_batches(df).mapInArrow(work, schema)


# BK-trees ----------------------------------------------------------------------------


class BKTree:
    """Distinct fingerprints; each child hangs below its parent under their distance."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        parents, edges, kids = [], [], []
        head = np.zeros(len(values), dtype=np.int64)  # the node below which a value still sinks
        left = np.arange(1, len(values))
        while len(left):
            edge = np.bitwise_count(values[left] ^ values[head[left]]).astype(np.int64)
            _, first, slot = np.unique(head[left] * 65 + edge, return_index=True, return_inverse=True)
            parents.append(head[left][first])
            edges.append(edge[first])
            kids.append(left[first])
            head[left] = left[first][slot]
            stay = np.ones(len(left), dtype=bool)
            stay[first] = False
            left = left[stay]
        none = np.zeros(0, dtype=np.int64)
        key = np.concatenate([none, *parents]) * 65 + np.concatenate([none, *edges])
        by = np.argsort(key)
        self.key, self.kid = key[by], np.concatenate([none, *kids])[by]

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of queries and of the values within the radius of them."""
        found_q, found_v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        q = np.arange(len(queries)) if len(self.values) else np.zeros(0, np.int64)
        node = np.zeros(len(q), dtype=np.int64)
        while len(q):
            away = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            hit = away <= radius
            found_q.append(q[hit])
            found_v.append(node[hit])
            low = np.searchsorted(self.key, node * 65 + np.maximum(away - radius, 0))
            high = np.searchsorted(self.key, node * 65 + np.minimum(away + radius, 64), "right")
            many = high - low
            q = np.repeat(q, many)
            node = self.kid[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)]
        return np.concatenate(found_q), np.concatenate(found_v)


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels of a forest over 0..n-1 after links a-b: each member has its component's least number."""
    while True:
        low = np.minimum(labels[a], labels[b])
        new = labels.copy()
        np.minimum.at(new, labels[a], low)
        np.minimum.at(new, labels[b], low)
        new = new[new]
        if np.array_equal(new, labels):
            return labels
        labels = new


def tree_links(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of a tree that have links, and the first member of their component."""
    tree = BKTree(values)
    labels = np.arange(len(values))
    for at in range(0, len(values), _TOGETHER):
        q, v = tree.search(values[at : at + _TOGETHER], radius)
        labels = _joined(labels, q + at, v)
    moved = np.nonzero(labels != np.arange(len(values)))[0]
    return values[moved], values[labels[moved]]


def cross_links(
    queries: np.ndarray, query_roots: np.ndarray, values: np.ndarray, roots: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of roots that a link between a query and a value joins, each once."""
    tree = BKTree(values)
    pairs = [np.zeros((0, 2), dtype=roots.dtype)]
    for at in range(0, len(queries), _TOGETHER):
        q, v = tree.search(queries[at : at + _TOGETHER], radius)
        both = np.stack([query_roots[q + at], roots[v]], axis=1)
        pairs.append(np.unique(both[both[:, 0] != both[:, 1]], axis=0))
    found = np.unique(np.concatenate(pairs), axis=0)
    return found[:, 0], found[:, 1]


# Links over all fingerprints ----------------------------------------------------------


def range_masks(count: int, radius: int) -> list[int]:
    """Masks of the chosen bit ranges: more ranges, and with them more masks, as the table grows."""
    chosen = next((k for k in range(1, 5) if count >> (64 * k // (radius + k)) <= CROWDED), 4)
    cuts = [64 * i // (radius + chosen) for i in range(radius + chosen + 1)]
    ranges = [(1 << high) - (1 << low) for low, high in zip(cuts, cuts[1:])]
    return [sum(some) for some in combinations(ranges, chosen)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _deal(nodes: DataFrame, count: int, radius: int) -> DataFrame:
    """Rows (t, key, fp): each fingerprint in one shard for every mask."""
    shards = max(1, count // SHARD)
    places = []
    for t, mask in enumerate(range_masks(count, radius)):
        key = F.pmod(F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(_signed(mask)))), F.lit(shards))
        places.append(F.struct(F.lit(t).alias("t"), key.alias("key")))
    return nodes.select("fp", F.explode(F.array(*places)).alias("at")).select("at.t", "at.key", "fp")


def _longs(column: pa.Array) -> list[np.ndarray]:
    """Arrays of longs of a list column, one for each row."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1]) if len(ends) else []


def _pairs(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    none = np.zeros(0, dtype=np.int64)
    both = [np.concatenate([none, *[x.view(np.int64) for x in side]]) for side in (a, b)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in both], names=["a", "b"])


def links(nodes: DataFrame, count: int, radius: int = RADIUS) -> DataFrame:
    """Rows (a, b) whose components are those of all links within the radius.

    `nodes` has distinct fingerprints `fp`, `count` of them. a and b are fingerprints; not all
    links are returned, but enough of them to reach everything that links reach.
    """
    dealt = _deal(nodes, count, radius)
    crowded = durable(dealt.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TREE))
    several = crowded.count()
    trees = F.ceil(F.col("n") * 1.25 / TREE)
    placed = dealt.join(small(crowded, several, 128), ["t", "key"], "left").withColumn(
        "tree", F.coalesce(F.pmod(F.xxhash64(F.lit(SEED), "fp"), trees), F.lit(0)).cast("int")
    )

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tree_links(values.view(np.uint64), radius) for values in _longs(batch.column(0))]
            yield _pairs([a for a, _ in found], [b for _, b in found])
        give_back()

    grown = placed.groupBy("t", "key", "tree").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    inside = components(in_small_batches(grown.select("fps")).mapInArrow(within, "a long, b long"))
    if not several:
        return inside

    rooted = placed.where("n IS NOT NULL").join(inside, F.col("fp") == F.col("a"), "left")
    rooted, folder = stored(rooted.select("t", "key", "tree", "fp", F.coalesce("b", "fp").alias("root")), "simhash-trees")
    parts = rooted.groupBy("t", "key", "root").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("t", "key").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), (F.sum("n") - F.max("n")).alias("outside")
    )
    main = durable(main.where("outside > 0"))
    outside = rooted.join(small(main, several, 128), ["t", "key"])
    member = F.collect_list(F.struct("fp", "root")).alias("members")
    block = F.pmod(F.xxhash64(F.lit(SEED + 1), "fp"), F.ceil(F.col("outside") * 1.25 / BLOCK))
    searches = outside.where("root <> main").groupBy("t", "key", block.alias("block")).agg(member)
    searches = durable(searches.select("t", "key", F.col("members").alias("asked")))
    there = durable(outside.groupBy("t", "key", "tree").agg(member).drop("tree"))
    together = searches.join(there, ["t", "key"]).select("asked.fp", "asked.root", "members.fp", "members.root")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*[_longs(batch.column(i)) for i in range(4)]):
                a, b = cross_links(*[x.view(np.uint64) for x in row], radius)
                yield _pairs([a], [b])
        give_back()

    more = in_small_batches(together.toDF("q", "qr", "v", "vr")).mapInArrow(across, "a long, b long")
    result = components(inside.select("a", "b").unionByName(more))
    drop_folder(rooted.sparkSession, folder)
    return result


def near_copies(
    df: DataFrame, key: str, text: str, n: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """The frame without the text, with `fingerprint` (16 hexadecimal digits) and `component_id`.

    `component_id` is the smallest key that links reach from the row, its own included; a null
    key counts only where there is no other. Texts without words, null or empty, have
    fingerprint zero and are linked like any others. Repeated rows and keys stay; rows of equal
    fingerprints are linked, whatever their keys. Input columns named like an own one get `_in`.
    An empty table gives none. Texts of any length are read whole.
    """
    df = keep_clear(df, ["fp", "a", "b", "root", "least", "fingerprint", "component_id"])
    docs, _ = stored(with_fingerprints(df, text, n), "simhash-fingerprints")
    nodes, _ = stored(docs.groupBy("fp").agg(F.min(key).alias("least")), "simhash-nodes")
    linked = links(nodes.select("fp"), nodes.count(), radius)
    rooted = nodes.join(linked, F.col("fp") == F.col("a"), "left")
    rooted, _ = stored(rooted.select("fp", "least", F.coalesce("b", "fp").alias("root")), "simhash-roots")
    least = durable(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    found = durable(rooted.select("fp", "root").join(least, "root").select("fp", "component_id"))
    return docs.join(found, "fp").select(*[c for c in df.columns if c != text], hex_digits("fp"), "component_id")


def hex_digits(column: str) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0").alias("fingerprint")
