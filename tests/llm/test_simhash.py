"""SimHash near-duplicates against brute force, and their edge cases."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash

from placaflow.llm import queries, simhash

DATA = "/root/testdata/sf0.01"


def brute_fingerprint(text: str | None, n: int = 4) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(fps: list[int], radius: int) -> list[int]:
    """For each position the first position that links reach."""
    values = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        if np.array_equal(new, label):
            return label.tolist()
        label = new


def test_query_matches_brute_force(spark):
    rows = {r.doc_id: r for r in queries.op12_simhash(spark, DATA).collect()}
    docs = sorted(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    fps = [brute_fingerprint(r.text) for r in docs]
    ids = [r.doc_id for r in docs]
    assert [rows[i].fingerprint for i in ids] == [f"{f:016x}" for f in fps]
    assert [rows[i].component_id for i in ids] == [ids[j] for j in brute_components(fps, 4)]
    assert len(set(ids)) > len({r.component_id for r in rows.values()})


@pytest.mark.parametrize("count", [1, 300, 3000])
def test_trees_find_what_brute_force_finds(count):
    rng = np.random.default_rng(count)
    seeds = rng.integers(0, 1 << 63, max(1, count // 3)).astype(np.uint64)
    spread = seeds[rng.integers(0, len(seeds), count)] ^ (np.uint64(1) << rng.integers(0, 64, count).astype(np.uint64))
    values = rng.permutation(np.unique(spread ^ (np.uint64(1) << rng.integers(0, 64, count).astype(np.uint64))))
    q, v = simhash.BKTree(values).search(values[:200], 4)
    near = np.bitwise_count(values[:200, None] ^ values[None, :]) <= 4
    assert sorted(zip(q.tolist(), v.tolist())) == list(zip(*[x.tolist() for x in np.nonzero(near)]))


@pytest.mark.parametrize("count", [100, 1 << 22, 1 << 28, 1 << 40])
def test_close_fingerprints_agree_in_some_mask(count):
    rng = np.random.default_rng(5)
    masks = simhash.range_masks(count, 4)
    for _ in range(300):
        away = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(away & mask == 0 for mask in masks)


def test_crowded_shards(spark, monkeypatch):
    """Many trees in a shard: a chain of single bits, a crowd, outsiders near and far."""
    monkeypatch.setattr(simhash, "TREE", 8)
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(simhash, "SHARD", 1 << 20)  # one shard for each mask
    rng = np.random.default_rng(1)
    crowd = {0xABCDEF << 30 ^ int(sum(1 << int(b) for b in rng.choice(30, 2, replace=False))) for _ in range(120)}
    chain = {(1 << i) - 1 for i in range(0, 60, 3)}
    values = sorted(crowd | chain | {int(x) for x in rng.integers(0, 1 << 63, 40)})
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {r.a: r.b for r in simhash.links(nodes, len(values)).collect()}
    label = brute_components(values, 4)
    least = {}
    for v, at in zip(values, label):
        least.setdefault(found.get(v, v), set()).add(at)
    assert all(len(s) == 1 for s in least.values())
    assert len(least) == len(set(label))


def test_edges(spark):
    schema = "doc_id long, text string, fp string, root long, component_id int"
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (5, "The cat sat on the mat", "x", 1, 1), (9, "the CAT sat\ton the  mat", None, None, None),
        (3, None, "x", 1, 1), (4, " \n ", "x", 1, 1), (4, "", "x", 1, 1), (None, "the cat sat on the mat", "x", 1, 1),
        (7, "one two", "x", 1, 1), (7, long, "x", 1, 1), (8, long + " end", "x", 1, 1), (None, "alone here", "x", 1, 1),
    ]
    out = simhash.near_copies(spark.createDataFrame(rows, schema).repartition(3), "doc_id", "text")
    assert out.columns == ["doc_id", "fp_in", "root_in", "component_id_in", "fingerprint", "component_id"]
    found = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in out.collect())
    hexed = [f"{brute_fingerprint(r[1]):016x}" for r in rows]
    component = ["5", "5", "3", "3", "3", "5", "7", "7", "7", "None"]
    assert found == sorted((str(r[0]), h, c) for r, h, c in zip(rows, hexed, component))
    assert simhash.near_copies(spark.createDataFrame([], schema), "doc_id", "text").count() == 0
