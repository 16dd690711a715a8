"""What Python workers hold: one coder a task, and none once another operator's task ends."""

from __future__ import annotations

import public_tokenizers as vocabularies

import corpus_pipeline
from placaflow.llm import bytebpe, common
from placaflow.llm.queries import RANKS


def test_token_ids_need_one_worker_a_task(spark):
    rows = [(1, "a", "Two  words\n", 0, 0), (2, None, None, 0, 1), (3, "a", "", 1, 0), (3, "a", "naïve \U0001f600 café\r\n\tx", 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, shard int, slot long").repartition(2)
    found = corpus_pipeline.token_ids(spark, docs, "")
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    path = vocabularies.path(RANKS)
    want = {(r.shard, r.slot): r.ids for r in bytebpe.encode(docs, "text", path, vocabularies.PATTERN).collect()}
    assert {(r.shard, r.slot): r.ids for r in found.collect()} == want
    assert all(r.decodes and r.n_tokens == len(r.ids) for r in found.collect())


def test_round_trip_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([("a b", 1, 2)], "text string, ids int, Decoded int")
    (row,) = bytebpe.round_trip(docs, "text", vocabularies.path(RANKS), vocabularies.PATTERN).collect()
    assert (row.ids_in, row.Decoded_in, bytes(row.decoded)) == (1, 2, b"a b")


def test_coders_go_with_another_operators_task():
    made: list[int] = []

    def make():
        made.append(1)
        return object()

    first = common.kept("one", (1,), make)
    common.give_back("one")
    assert common.kept("one", (1,), make) is first and len(made) == 1
    assert common.kept("one", (2,), make) is not first
    common.give_back()
    common.kept("one", (2,), make)
    assert len(made) == 3
    common.give_back()
