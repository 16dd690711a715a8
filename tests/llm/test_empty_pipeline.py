"""The pipeline and its language stage where there is nothing to learn from."""

from __future__ import annotations

import corpus_pipeline
from placaflow.llm import langid, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rejected int"


def test_no_labelled_text(spark):
    docs = spark.createDataFrame([(1, "the cat", None, "a", 7, 1), (2, None, "en", "a", 0, 1), (None, "12", "en", None, 2, 1)], SCHEMA)
    rows = langid.identify(docs, "text", None).collect()
    assert [(r.lang_pred, r.score, r.rejected, r.rejected_in) for r in rows] == [("und", 0.0, True, 1)] * 3
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS and kept.count() == 0


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op9_language(spark, str(tmp_path)).count() == 0
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() == 0 and "ids" in found.columns
