"""Range counts go only with sets that may have a partner, in as few bytes as hold them."""

from __future__ import annotations

import numpy as np

from placaflow.llm import jaccard


def test_sets_without_partner_get_no_ranges(spark, monkeypatch):
    """Parts of a text share n-grams of its prefix, but are too short; two near copies are linked by then."""
    sent = []
    plain = jaccard._open_pairs

    def spy(rows, t):
        sent.append({r.k for r in rows.select("k").distinct().collect()})
        return plain(rows, t)

    monkeypatch.setattr(jaccard, "_open_pairs", spy)
    rng = np.random.default_rng(5)

    def text(n: int) -> str:
        return " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, n))

    parts = [text(40) for _ in range(10)]
    base = text(200).split()
    texts = [*parts, " ".join(parts), " ".join(base), " ".join([*base[:100], "changed", *base[101:]])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in jaccard.similar_texts(df, "doc_id", "text").collect()}
    assert found == {n: min(n, 11) for n in range(13)}
    assert sent == [set()]


def test_ranges_in_few_bytes():
    rng = np.random.default_rng(6)
    sets = [np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64)) for n in (0, 1, 300, 60_000, 100_000)]
    sets.append(np.arange(70_000, dtype=np.uint64))  # all of them in one range
    data = [jaccard._range_counts(s) for s in sets]
    assert [len(d) // jaccard.RANGES for d in data] == [1, 1, 1, 2, 2, 4]
    want = [np.bincount((s >> np.uint64(56)).astype(int), minlength=jaccard.RANGES) for s in sets]
    assert (jaccard._range_matrix(data) == np.array(want)).all()
    assert (jaccard._range_matrix(data[:3]) == np.array(want[:3])).all()
