"""Whole jobs: what a result must hold beyond the digests of the other tests."""

from __future__ import annotations

import public_tokenizers as vocabularies
from pyspark.sql import functions as F

from placaflow.llm import fingerprints, jaccard, mixing, queries, tokenfiles
from placaflow.llm.common import stored

DATA = "/root/testdata/sf0.001"


def test_taken_words_are_those_of_the_mix(spark, monkeypatch):
    whole = queries.op3_mix(spark, DATA).agg(F.sum("taken")).first()[0]
    mix = mixing.mix
    monkeypatch.setattr(mixing, "mix", lambda plan: mix(plan).where("shard < 8"))
    half = queries.op3_mix(spark, DATA).agg(F.sum("taken")).first()[0]
    assert 0.3 < half / whole < 0.7


def test_stored_mixture_is_mixed(spark, monkeypatch):
    import corpus_pipeline as pipeline

    monkeypatch.setattr(mixing, "STRETCH_ROWS", 10)
    mixed, folder = stored(pipeline.mixture(spark, spark.read.parquet(f"{DATA}/documents.parquet"), DATA), "mixture")
    rows = mixed.withColumn("part", F.spark_partition_id()).collect()
    by_shard = {s: sorted((r for r in rows if r.shard == s), key=lambda r: r.slot) for s in range(mixing.SHARDS)}
    for own in by_shard.values():
        assert [r.slot for r in own] == list(range(len(own))) and len({r.source for r in own}) > 1
    runs = [(a, b) for a, b in zip(rows, rows[1:]) if a.shard == b.shard and a.part == b.part]
    assert sum(b.slot == a.slot + 1 for a, b in runs) > 0.7 * len(runs) > 0
    mixed_places = sum(a.source != b.source for a, b in runs)
    assert mixed_places > 0.3 * len(runs)


def test_long_documents_leave_no_gap(spark):
    """Short documents behind one that is too long fill a source up to its target."""
    docs = [(n, "abc"[n % 3], 5 + n % 17) for n in range(900)] + [(1000 + n, c, 1500) for n, c in enumerate("abc")]
    df = spark.createDataFrame(docs, "doc_id long, source string, n long")
    for seed in range(4):
        plan = mixing.mix_plan(df, "doc_id", "source", F.col("n"), seed=seed)
        taken = F.sum(F.col("size") * F.size("placements")).alias("taken")
        rows = plan.groupBy("source", "target").agg(taken).collect()
        assert max(abs(r.taken - r.target) for r in rows) <= 10
        shards = mixing.mix(plan).groupBy("shard").agg(F.sum("size").alias("n")).collect()
        assert len(shards) == mixing.SHARDS


def test_unlike_texts_of_one_key_all_stay(spark):
    texts = [" ".join(f"{a}{i}" for i in range(12)) for a in "abc"]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (1, texts[2]), (2, texts[2]), (3, ""), (3, " "), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = jaccard.one_of_each(df, "doc_id", "text", 5, 80).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([*((1, t) for t in texts), (3, ""), (3, " ")])


def test_added_tokens_are_the_librarys():
    from tokenizers import Tokenizer

    path = vocabularies.path(queries.TOKENIZER)
    own = Tokenizer.from_file(path)
    texts = ["hello <|endoftext|> world", "a  <|endoftext|>\n  b  c", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "no mark  here", ""]
    found = tokenfiles.tokenizer(tokenfiles.read_definition(path))(texts)
    assert [ids.tolist() for ids in found] == [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in found[0]


def test_very_often_repeated_sentences_do_not_wrap():
    text = "a. " * 40_000
    own, edited, other = (fingerprints.fingerprints([t]) for t in (text, text[: len(text) // 2] + "Another end.", "Unlike."))
    assert fingerprints.likeness(own, edited)[0] > 0.99
    assert fingerprints.likeness(own, other)[0] < 0.5
    assert (fingerprints.added(own, own) == fingerprints.fingerprints([text + "\n" + text])).all()
