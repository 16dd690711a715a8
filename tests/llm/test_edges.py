"""Nulls, empty and odd texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import numpy as np
import public_tokenizers as vocabularies
import pytest
from pyspark.sql import functions as F

from placaflow.llm import bytebpe, fingerprints, jaccard, langid, lm, mixing, neighbours, rans, sharding, tokenfiles, warc
from placaflow.llm.chunks import chunks
from placaflow.llm.common import words
from placaflow.llm.queries import RANKS, TOKENIZER

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, ids string, score double"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ROWS = [
    (1, "the cat sat on the mat", "en", "a", 1, 5, "x", 0.5), (1, "the cat sat on the mat", "en", "a", 1, 5, "x", 0.5),
    (2, None, None, None, None, None, None, None), (3, "", "en", "a", 0, 1, "", 0.0), (4, "   \n\t ", "de", "b", 0, 1, "", 0.0),
    (5, LONG, "de", "b", 0, 1, "", 0.0), (6, "die Katze saß auf der Matte\n\nund  schlief", "de", "b", 0, 1, "", 0.0),
    (None, "1 2 3 !!", "en", None, 0, 1, "", 0.0), (7, "THE cat sat on the mat", "en", "a", 0, 1, "", 0.0), (8, "x", None, "c", 0, 1, "", 0.0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sharding(odd, none):
    out = sharding.shuffle_into_shards(odd, sharding.record_bytes("text"), 4, bucket_bytes=100)
    assert "shard_in" in out.columns
    rows = out.collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s, n in enumerate((3, 3, 2, 2)) for i in range(n)]
    assert sorted(str(r.text) for r in rows) == sorted(str(r[1]) for r in ROWS)
    assert sharding.shuffle_into_shards(none, sharding.record_bytes("text")).count() == 0


def test_warc(spark):
    big = "é" * 600
    rows = [(1, "u", big), (2, None, big), (3, "u", big + "x"), (4, "a\nb", "small"), (5, "u", "small"), (6, "u", None), (6, "u", None), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    manifest = warc.write_warc(pages, "page_id", "url", "html")
    for split in (64, 1 << 20):
        found = warc.read_warc(spark, manifest, split).collect()
        kinds = sorted((str(r.record_id), r.record_type, r.refers_to, r.payload_bytes) for r in found)
        assert kinds == [
            ("1", "revisit", "2", 1200), ("2", "response", None, 1200), ("3", "response", None, 1201),
            ("4", "response", None, 5), ("5", "response", None, 5), ("6", "response", None, 0),
            ("6", "response", None, 0), ("None", "revisit", "2", 1200),
        ]
        assert {r.target_uri for r in found if r.record_id == "4"} == {"a b"}
    empty = warc.write_warc(pages.limit(0), "page_id", "url", "html")
    assert warc.read_warc(spark, empty).count() == 0


def test_mixing(odd, none):
    plan = mixing.mix_plan(odd, "doc_id", "source", words(F.col("text")), shards=4)
    rows = plan.collect()
    assert len(rows) == len(ROWS) and "size" in plan.columns
    assert all(len(r.placements) <= mixing.MOST and (r["size"] or not r.placements) for r in rows)
    total = sum(r["size"] for r in rows)
    targets = {r.source: (r.target, r.source_size) for r in rows}
    assert sum(t for t, _ in targets.values()) == pytest.approx(total)
    assert all(t <= 3 * s for t, s in targets.values())
    copies = mixing.mix(plan).collect()
    assert len(copies) == sum(len(r.placements) for r in rows)
    empty = mixing.mix_plan(none, "doc_id", "source", words(F.col("text")))
    assert empty.count() == 0 and mixing.mix(empty).count() == 0


def test_quotas_add_up(spark):
    quotas = spark.createDataFrame([(0, 40), (1, 0), (2, 7), (3, 81)], "rank int, quota long")
    rows = mixing.split_quotas(quotas, 5).collect()
    for rank, quota in ((0, 40), (1, 0), (2, 7), (3, 81)):
        assert sum(r.n for r in rows if r.rank == rank) == quota
    sums = [sum(r.n for r in rows if r.shard == s) for s in range(5)]
    assert max(sums) - min(sums) <= 2 and sum(sums) == 128


def test_fingerprints(odd, none):
    rows = fingerprints.compare_edits(odd, "doc_id", "text").collect()
    assert len(rows) == len(ROWS)
    assert len({r.fingerprint for r in rows if r.n_chars == 0}) == 1
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    assert fingerprints.compare_edits(none, "doc_id", "text").count() == 0
    (only,) = fingerprints.compare_edits(odd.where("doc_id = 6"), "doc_id", "text").collect()
    assert only.near_next == 1.0


def test_fingerprints_add_up(spark):
    rows = [("a\nb\nc", "d\nb", "a"), ("", "x", None)]
    df = spark.createDataFrame(rows, "text string, more string, less string")
    edited = fingerprints.edit_fingerprints(fingerprints.fingerprint(df, "text"), "fingerprint", "more", "less").collect()
    want = fingerprints.fingerprints(["c\nb\nd\nb", "x"])
    assert [r.edited for r in edited] == [bytes(w).hex() for w in want]


def test_jaccard(odd, none):
    rows = jaccard.similar_texts(odd, "doc_id", "text").collect()
    assert len(rows) == len(ROWS)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)
    assert found == sorted(
        [(1, 4, 1), (1, 4, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 29998, 5), (6, 6, 6), (None, 2, None), (7, 4, 1), (8, 1, 8)], key=str
    )
    assert jaccard.similar_texts(none, "doc_id", "text").count() == 0
    kept = jaccard.one_of_each(odd, "doc_id", "text")
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, (1, 2, 3, 4, 5, 6, None, 8)))


def test_near_copies_of_a_hot_text(spark, monkeypatch):
    """Links of many edited copies, in blocks far smaller than the group, against all pairs."""
    monkeypatch.setattr(jaccard, "LIST_BLOCK", 16)
    monkeypatch.setattr(jaccard, "HUB_BLOCK", 8)
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for n in range(90):
        own = list(base)
        for at in rng.choice(120, rng.integers(0, 6), replace=False):
            own[at] = f"n{n}p{at}"
        texts.append(" ".join(own))
    rows = jaccard.similar_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text").collect()
    sets = [{tuple(t.split()[i : i + 3]) for i in range(118)} for t in texts]
    parent = list(range(90))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(90):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert {r.doc_id: r.component_id for r in rows} == {i: root(i) for i in range(90)}
    assert len({root(i) for i in range(90)}) > 1


def test_token_files(spark, odd, none):
    definition = tokenfiles.read_definition(vocabularies.path(TOKENIZER))
    size = tokenfiles.token_count(definition)
    manifest = tokenfiles.write_tokens(odd, "doc_id", "text", definition, size, 3)
    rows = sorted(tokenfiles.read_tokens(spark, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    assert all(a.start + len(a.ids) // 4 == b.start for a, b in zip(rows, rows[1:]))
    assert {bytes(r.ids) for r in rows if r.doc_id in (2, 3)} == {bytes(4)}
    empty = tokenfiles.write_tokens(none, "doc_id", "text", definition, size, 2)
    assert tokenfiles.read_tokens(spark, empty).count() == 0


def test_damaged_blocks_are_noticed(tmp_path):
    docs = [np.arange(500, dtype=np.uint32) % 7, np.zeros(1, np.uint32)]
    data = bytearray(tokenfiles.pack([1, 2], docs, 10))
    path = tmp_path / "t.rans"
    path.write_bytes(data)
    start, found = tokenfiles.TokenFile(str(path)).block(0)
    assert start == 0 and all((a == b).all() for (_, a), b in zip(found, docs))
    place = tokenfiles.TokenFile(str(path)).index["blocks"][0][0]
    data[place + 3] ^= 1
    path.write_bytes(data)
    with pytest.raises(rans.Corrupt):
        tokenfiles.TokenFile(str(path)).block(0)


@pytest.mark.parametrize("n", [0, 1, 2047, 2048, 2049, 70_000])
def test_range_coding(n):
    ids = np.random.default_rng(n).geometric(0.05, n).astype(np.uint32) if n else np.zeros(0, np.uint32)
    coder = rans.Coder(rans.frequencies(np.bincount(ids, minlength=400)))
    assert (coder.decode(coder.encode(ids), n) == ids).all()


def test_byte_bpe(odd, none):
    path = vocabularies.path(RANKS)
    coded = bytebpe.encode(odd, "text", path, vocabularies.PATTERN)
    assert "ids_in" in coded.columns
    for r in bytebpe.decode(coded, "ids", path).collect():
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bytebpe.encode(none, "text", path, vocabularies.PATTERN).count() == 0


def test_chunks_are_the_text():
    for text in ("", " a", "a  b", "a\tb c", "a \n b", "a b.\nC d ", "x　y z"):
        assert "".join(chunks(text)) == text


def test_language_model_edges(odd, none):
    model, counts = lm.train(odd, "text", "doc_id")
    rows = lm.score(odd, "text", model, counts).collect()
    assert len(rows) == len(ROWS) and "score_in" in rows[0]
    assert all(r.n_known == r.n_tokens for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert lm.score(none, "text", model, counts).count() == 0
    blank, no_counts = lm.train(none, "text", "doc_id")
    assert {r.n_known for r in lm.score(odd, "text", blank, no_counts).collect()} == {0}


def test_language_edges(odd):
    model = langid.train(["the cat sat on the mat", "die katze auf der matte"] * 20, ["en", "de"] * 20)
    rows = langid.identify(odd, "text", model).collect()
    none_found = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert none_found == {None, 2, 3, 4} and all(r.rejected and r.score == 0 for r in rows if r.lang_pred == "und")
    assert langid.identify(odd.limit(0), "text", model).count() == 0
    with pytest.raises(ValueError):
        langid.train_on(odd.where("lang IS NULL"), "text", "lang", F.col("doc_id"))


def test_neighbours(spark):
    same = [(n, [1.0, 2.0, 3.0], 0) for n in range(40)]
    odd = [(100, None, 0), (101, [0.0, 0.0, 0.0], 0), (102, [1.0, None, 2.0], 0), (103, [float("nan"), 1.0, 1.0], 0),
           (104, [1.0], 0), (None, [1.0, 1.0, 1.0], 0), (50, [3.0, 2.0, 1.0], 0), (50, [3.0, 2.0, 1.0], 0)]
    df = spark.createDataFrame([*same, *odd], "vec_id long, v array<double>, rank int")
    rows = neighbours.search(df, "vec_id", "v", F.col("vec_id") % 50 == 0, vector_block=7, query_block=1).collect()
    by = {q: [r.vec_id for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == q] for q in {r.query_id for r in rows}}
    assert by == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4]}
    assert neighbours.search(df.limit(0), "vec_id", "v", F.lit(True)).count() == 0
