"""Ranked lexical search: exact top documents by posting lists in geometric blocks.

Documents are read once into forward rows: number of terms, and which of the items' terms they
hold how often. Tasks take the rows in shards of bounded size. In a shard each term has a
posting list, clustered by the likeness of its documents and cut into blocks; a block's summary
is the largest score part over its documents, for each term that some item asks together with
the list's term (no other is ever looked up). The sum of an item's terms in a summary bounds every document of the block from above, so a block whose sum is below the lowest
score that still counts is skipped, and all others are scored in full: nothing is lost.

All items start with the score of their k-th document among one in `SAMPLE` documents, a lower
bound of the final one, whichever documents they are.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placaflow.llm.common import drop_folder, give_back, in_small_batches, stored

SEED = 23
#: Bytes of item texts that are searched for together; more items take more rounds.
ITEM_BYTES = 128 << 10
#: One in so many documents sets the score from which blocks are skipped.
SAMPLE = 64
#: Documents of a shard, and the sum of squares of their numbers of terms.
SHARD_DOCS, SHARD_CELLS = 2048, 8 << 20
#: Documents of a block, blocks scored together, numbers of a document's sketch.
BLOCK, TOGETHER, SKETCH = 8, 64, 32
#: Cells of a dense part of the summaries while they are made.
_DENSE = 4 << 20
#: A-Z in lower case, other ASCII characters but letters and digits as spaces.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and non-ASCII characters, only A-Z lower-cased, in UTF-8."""
    return (text or "").encode().translate(_TERMS).split()


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def length_marks(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """50 + (50 n N) div L of each document."""
    if len(n) and 50 * int(n.max()) * documents >= 1 << 63:
        return np.array([50 + 50 * x * documents // terms for x in n.tolist()], dtype=np.int64)
    return 50 + 50 * n * documents // max(terms, 1)


class Shard:
    """Forward rows of some documents, and blocked posting lists over them."""

    def __init__(self, ends: np.ndarray, term: np.ndarray, part: np.ndarray, together: np.ndarray) -> None:
        """`term` and `part`: the documents' terms and their score parts, one document after another.

        `together` marks the pairs of terms that some item asks.
        """
        terms = len(together)
        docs = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        some = part > 0
        self.term, self.part, doc, self.terms = term[some], part[some], docs[some], terms
        self.ends = np.searchsorted(doc, np.arange(len(ends)), "right")
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self._block(doc)
        self._summarise(together)

    def _sketches(self, doc: np.ndarray) -> np.ndarray:
        """Short vectors whose products stand for the likeness of documents."""
        axes = np.random.default_rng(SEED).standard_normal((self.terms, SKETCH), dtype=np.float32)
        out = np.zeros((len(self.ends), SKETCH), dtype=np.float32)
        for at in range(0, len(doc), 1 << 16):
            here = slice(at, at + (1 << 16))
            rows = axes[self.term[here]] * self.part[here, None].astype(np.float32)
            first = np.flatnonzero(np.diff(doc[here], prepend=-1))
            out[doc[here][first]] += np.add.reduceat(rows, first)
        return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-30)

    def _block(self, doc: np.ndarray) -> None:
        by = np.argsort(self.term, kind="stable")
        listed = doc[by]
        ends = np.cumsum(np.bincount(self.term, minlength=self.terms))
        sketches = self._sketches(doc) if len(doc) else None
        blocks, owners = [], []
        for t, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
            members = listed[start:end]
            if len(members) > BLOCK:
                pivots = members[BLOCK // 2 :: BLOCK]
                nearest = np.argmax(sketches[members] @ sketches[pivots].T, axis=1)
                order = np.argsort(nearest, kind="stable")
                members = members[order]
                cuts = np.flatnonzero(np.diff(nearest[order], prepend=-1))
                sizes = np.diff(cuts, append=len(members))
                cuts = np.concatenate([np.arange(c, c + s, BLOCK) for c, s in zip(cuts, sizes)])
                blocks += np.split(members, cuts[1:])
                owners += [t] * len(cuts)
            elif len(members):
                blocks.append(members)
                owners.append(t)
        self.blocks, self.owners = blocks, np.array(owners, dtype=np.int64)
        self.of_term = np.searchsorted(self.owners, np.arange(self.terms + 1))

    def _cells(self, docs: np.ndarray) -> np.ndarray:
        """Positions of the documents' terms, one document after another."""
        many = self.ends[docs] - self.starts[docs]
        return np.arange(many.sum()) + np.repeat(self.starts[docs] - (np.cumsum(many) - many), many)

    def _summarise(self, together: np.ndarray) -> None:
        """By term, the blocks where it can be asked for, and its largest part there."""
        step = max(1, _DENSE // self.terms)
        keys, tops = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(self.blocks), step):
            some = self.blocks[at : at + step]
            docs = np.concatenate(some)
            cells = self._cells(docs)
            held = np.repeat(np.arange(len(some)), [len(b) for b in some])
            held = np.repeat(held, self.ends[docs] - self.starts[docs])
            asked = together[self.owners[at + held], self.term[cells]]
            held, cells = held[asked], cells[asked]
            dense = np.zeros(len(some) * self.terms, dtype=np.int64)
            np.maximum.at(dense, held * self.terms + self.term[cells], self.part[cells])
            there = np.flatnonzero(dense)
            keys.append(there % self.terms * len(self.blocks) + there // self.terms + at)
            tops.append(dense[there])
        key, top = np.concatenate(keys), np.concatenate(tops)
        by = np.argsort(key)
        key = key[by]
        self.summary_block, self.summary_top = key % max(1, len(self.blocks)), top[by]
        self.summary_of = np.searchsorted(key, np.arange(self.terms + 1) * len(self.blocks))

    def bounds(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of the asked terms' lists, and the most that a document there can score."""
        most = np.zeros(len(self.blocks), dtype=np.int64)
        for start, end in zip(self.summary_of[asked].tolist(), self.summary_of[asked + 1].tolist()):
            most[self.summary_block[start:end]] += self.summary_top[start:end]
        lists = [np.arange(s, e) for s, e in zip(self.of_term[asked].tolist(), self.of_term[asked + 1].tolist())]
        blocks = np.concatenate([np.zeros(0, np.int64), *lists])
        return blocks, most[blocks]

    def scores(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Whole scores of documents; `wanted` marks the asked terms."""
        cells = self._cells(docs)
        parts = np.where(wanted[self.term[cells]], self.part[cells], 0)
        many = self.ends[docs] - self.starts[docs]  # every listed document has a term
        return np.add.reduceat(parts, np.cumsum(many) - many)

    def search(self, asked: np.ndarray, k: int, least: int, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best documents of at least that score, their scores, and the blocks scored.

        `order` is the documents' place where scores are equal.
        """
        blocks, most = self.bounds(asked)
        best_first = np.argsort(-most, kind="stable")
        blocks, most = blocks[best_first], most[best_first]
        wanted = np.zeros(self.terms, dtype=bool)
        wanted[asked] = True
        seen = np.zeros(len(self.ends), dtype=bool)
        found, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        done = 0
        while done < len(blocks) and most[done] >= least:
            upto = min(done + TOGETHER, int(np.searchsorted(-most, -least, "right")))
            docs = np.unique(np.concatenate([self.blocks[b] for b in blocks[done:upto].tolist()]))
            docs = docs[~seen[docs]]
            seen[docs] = True
            done = upto
            if len(docs):
                new = self.scores(docs, wanted)
                found, score = np.concatenate([found, docs]), np.concatenate([score, new])
                keep = np.lexsort((order[found], -score))[:k]
                found, score = found[keep], score[keep]
                if len(found) == k:
                    least = max(least, int(score[-1]))
        good = score >= least
        return found[good], score[good], done


def _forward(docs: DataFrame, vocabulary) -> DataFrame:
    """Rows (id, n, terms, counts) of the documents with terms: which of the vocabulary, how often."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            ids, ns, terms, counts = [], [], [], []
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                words = terms_of(text)
                if words:
                    held = sorted((known[w], c) for w, c in Counter(words).items() if w in known)
                    ids.append(key)
                    ns.append(len(words))
                    terms.append([t for t, _ in held])
                    counts.append([c for _, c in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                names=["id", "n", "terms", "counts"],
            )
        give_back()

    return in_small_batches(docs).mapInArrow(work, "id long, n long, terms array<int>, counts array<int>")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Ids, null marks, n, ends, terms and counts of shards of bounded size."""
    none = np.zeros(0, dtype=np.int64)
    rest: list[tuple[np.ndarray, ...]] = []
    docs = cells = 0

    def whole() -> tuple[np.ndarray, ...]:
        ids, nulls, n, many, terms, counts = (np.concatenate([none, *c]).astype(np.int64) for c in zip(*rest))
        return ids, nulls.astype(bool), n, np.cumsum(many), terms, counts

    for batch in batches:
        many = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(many)
        terms, counts = (batch.column(c).flatten().to_numpy() for c in ("terms", "counts"))
        nulls = batch.column("id").is_null().to_numpy(zero_copy_only=False)
        ids, n = batch.column("id").fill_null(0).to_numpy(), batch.column("n").to_numpy()
        at = 0
        while at < batch.num_rows:
            grown = cells + np.cumsum(many[at:] ** 2)
            upto = at + min(SHARD_DOCS - docs, int(np.searchsorted(grown, SHARD_CELLS, "right")))
            if upto == at and not docs:
                upto = at + 1  # a document with very many terms is a shard of its own
            if upto > at:
                first = ends[at] - many[at]
                span = slice(first, ends[upto - 1])
                rest.append((ids[at:upto], nulls[at:upto], n[at:upto], many[at:upto], terms[span], counts[span]))
                docs, cells, at = docs + upto - at, int(grown[upto - at - 1]), upto
            if at < batch.num_rows:
                yield whole()
                rest, docs, cells = [], 0, 0
    if rest:
        yield whole()


def _ranked(forward: DataFrame, sent, k: int) -> DataFrame:
    """Rows (item, rank, id, score): the k best of all documents for each item.

    `sent`: the items' terms and least scores, the terms' weights, numbers of documents and terms.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, least, weight, documents, total = sent.value
        least = list(least)
        none = np.zeros(0, dtype=np.int64)
        best = [(none, none, none)] * len(asked)  # ids, null marks, scores
        together = np.zeros((len(weight), len(weight)), dtype=bool)
        for own in asked:
            together[np.ix_(own, own)] = True
        for ids, nulls, n, ends, terms, counts in _shards(batches):
            marks = np.repeat(length_marks(n, documents, total), np.diff(ends, prepend=0))
            parts = weight[terms] * (1_000_000_000 * counts // (1000 * counts + 20 * marks))
            shard = Shard(ends, terms, parts, together)
            order = np.empty(len(ids), dtype=np.int64)
            order[np.lexsort((ids, nulls))] = np.arange(len(ids))
            for item, own in enumerate(asked):
                found, score, _ = shard.search(own, k, least[item], order)
                if len(found):
                    before = best[item]
                    rows = [np.concatenate([a, b]) for a, b in zip(before, (ids[found], nulls[found].astype(np.int64), score))]
                    keep = np.lexsort((rows[0], rows[1], -rows[2]))[:k]
                    best[item] = tuple(r[keep] for r in rows)
                    if len(keep) == k:
                        least[item] = max(least[item], int(best[item][2][-1]))
        many = [len(b[0]) for b in best]
        ids, nulls, scores = (np.concatenate([none, *c]) for c in zip(*best)) if best else (none, none, none)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best), dtype=np.int32), many)), pa.array(ids, mask=nulls.astype(bool)), pa.array(scores)],
            names=["item", "id", "score"],
        )
        give_back()

    rows = forward.mapInArrow(work, "item int, id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, k: int = 50) -> DataFrame:
    """Each item's k documents of the highest score above 0: `item_id`, `rank`, `doc_id`, `score`.

    The score is that of the module's formulas in whole numbers; equal scores go by ascending
    key, a null key last. A document is a row: repeated rows are ranked one by one. Null and
    empty texts have no terms; items without terms have no rows, nor has an empty table. Of
    items that repeat a key (null is one) the smallest text counts. Only keys and texts are
    read, so other columns may have any name. Items are taken `ITEM_BYTES` at a time.
    """
    spark = docs.sparkSession
    own = items.groupBy(F.col(item_key).alias("item_id")).agg(F.min(item_text).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-size // ITEM_BYTES))
    block = F.pmod(F.xxhash64("item_id"), F.lit(rounds))
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    found = []
    for number in range(rounds):
        rows = own.where(block == number).collect()
        part = _round(spark, texts, [(r["item_id"], sorted(set(terms_of(r["text"])))) for r in rows], k)
        if part is not None:
            names = spark.createDataFrame(
                [(n, r["item_id"]) for n, r in enumerate(rows)], f"item int, item_id {own.schema['item_id'].dataType.simpleString()}"
            )
            found.append(part.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score"))
    if not found:
        kind = own.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def _round(spark, texts: DataFrame, items: list[tuple], k: int) -> DataFrame | None:
    numbers: dict[bytes, int] = {}
    asked = [np.array([numbers.setdefault(t, len(numbers)) for t in terms], dtype=np.int64) for _, terms in items]
    if not numbers:
        return None
    forward, folder = stored(_forward(texts, spark.sparkContext.broadcast(numbers)), "lexical-forward")
    documents, total = forward.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents:
        return None
    df = np.zeros(len(numbers), dtype=np.int64)
    for row in forward.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[row["t"]] = row["count"]
    weight = weights(df, documents)
    least = [1] * len(items)
    sample = forward.where(F.pmod(F.xxhash64(F.lit(SEED), "id", "n", "terms"), F.lit(SAMPLE)) == 0)
    sent = (asked, least, weight, documents, total)
    for row in _ranked(sample, spark.sparkContext.broadcast(sent), k).where(F.col("rank") == k).collect():
        least[row["item"]] = row["score"]
    tasks = max(spark.sparkContext.defaultParallelism, -(-documents // (4 * SHARD_DOCS)))
    result, _ = stored(_ranked(forward.repartition(tasks), spark.sparkContext.broadcast(sent), k), "lexical-ranked")
    drop_folder(spark, folder)
    return result
