"""Ranked lexical search against its SQL twin and brute force, and its edge cases."""

from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from placaflow.llm import lexical, oracle, queries

DATA = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_terms(text: str | None) -> list[str]:
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_ranking(docs: list[tuple], item: str | None, k: int) -> list[tuple]:
    """(doc_id, score) of the k best; documents are (doc_id, text)."""
    counted = [(key, Counter(brute_terms(text))) for key, text in docs if brute_terms(text)]
    total, tokens = len(counted), sum(sum(c.values()) for _, c in counted)
    found = []
    for key, own in counted:
        mark = 50 + (50 * sum(own.values()) * total) // tokens
        score = 0
        for term in set(brute_terms(item)) & set(own):
            df = sum(term in c for _, c in counted)
            weight = math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))
            score += weight * ((1_000_000_000 * own[term]) // (1000 * own[term] + 20 * mark))
        if score > 0:
            found.append((key, score))
    return sorted(found, key=lambda r: (-r[1], r[0] is None, r[0] or 0))[:k]


def test_query_matches_sql(spark):
    found = sorted(tuple(r) for r in queries.op11_lexical(spark, DATA).select("item_id", "rank", "doc_id", "score").collect())
    with duckdb.connect() as base:
        for name in ("documents", "benchmark"):
            base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
        assert found == sorted(base.execute(oracle.OP11).fetchall())


@pytest.mark.parametrize("block", [1, 4, 64])
def test_shard_skips_nothing_that_counts(block, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "TOGETHER", 3)
    rng = np.random.default_rng(block)
    terms, docs = 60, 300
    held = [np.unique(rng.integers(0, terms, rng.integers(1, 30))) for _ in range(docs)]
    ends = np.cumsum([len(h) for h in held])
    term = np.concatenate(held)
    part = rng.integers(0, 5, len(term)) ** 6
    asked = [np.unique(rng.integers(0, terms, 8)) for _ in range(20)]
    together = np.zeros((terms, terms), dtype=bool)
    for own in asked:
        together[np.ix_(own, own)] = True
    shard = lexical.Shard(ends, term, part, together)
    order = rng.permutation(docs)
    doc = np.repeat(np.arange(docs), np.diff(ends, prepend=0))
    skipped = 0
    for own in asked:
        score = np.bincount(doc, np.where(np.isin(term, own), part, 0), docs).astype(int)
        best = np.lexsort((order, -score))
        for least in (1, int(score[best[4]]), int(score.max()) + 1):
            want = [d for d in best[:10].tolist() if score[d] >= least]
            found, scores, done = shard.search(own, 10, least, order)
            assert found.tolist() == want and scores.tolist() == score[want].tolist()
            skipped += len(shard.bounds(own)[0]) - done
    assert skipped > 0 or block > 4


def test_summaries_bound_every_document():
    rng = np.random.default_rng(3)
    held = [np.unique(rng.integers(0, 40, 12)) for _ in range(200)]
    term = np.concatenate(held)
    part = rng.integers(1, 1 << 40, len(term))
    own = np.arange(0, 40, 5)
    together = np.zeros((40, 40), dtype=bool)
    together[np.ix_(own, own)] = True
    shard = lexical.Shard(np.cumsum([len(h) for h in held]), term, part, together)
    wanted = np.isin(np.arange(40), own)
    blocks, most = shard.bounds(own)
    for block, bound in zip(blocks.tolist(), most.tolist()):
        assert shard.scores(shard.blocks[block], wanted).max() <= bound
    assert {d for b in blocks for d in shard.blocks[b].tolist()} == {d for d, h in enumerate(held) if np.isin(h, own).any()}


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SHARD_DOCS", 4)
    monkeypatch.setattr(lexical, "ITEM_BYTES", 30)
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000)) + " cat"
    docs = [
        (9, "The cat sat", 1), (3, "the CAT, sat!", 1), (3, "the CAT, sat!", 1), (None, "the cat sat", 1), (5, None, 1),
        (6, "", 1), (7, " .,;\x00 ", 1), (8, long, 1), (1, "Ärger über die Katze_katze", 1), (2, "dog " * 500 + "cat", 1),
    ]
    items = [(1, "Cat SAT cat"), (2, "ÄRGER Ärger katze"), (3, None), (4, "?!"), (5, "unknown"), (1, "dog"), (None, "w5x5 dog")]
    texts = spark.createDataFrame(docs, "doc_id long, text string, score int").repartition(2)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found: dict = {}
    for r in lexical.search(texts, "doc_id", "text", asked, "item_id", "text", 4).orderBy("rank").collect():
        found.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert len(found[r.item_id]) == r["rank"]
    plain = [(k, t) for k, t, _ in docs]
    want = {i: brute_ranking(plain, t, 4) for i, t in items if (i, t) != (1, "dog")}
    assert found == {i: rows for i, rows in want.items() if rows}
    for a, b in ((texts.limit(0), asked), (texts, asked.limit(0))):
        assert lexical.search(a, "doc_id", "text", b, "item_id", "text").count() == 0
