"""A training corpus from raw documents: language, near copies, mixture, token ids.

Each stage reads the Parquet table that the one before wrote; `run` puts them together.
"""

from __future__ import annotations

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placaflow.llm import bytebpe, jaccard, langid, mixing
from placaflow.llm.common import remainder, stored, table, words
from placaflow.llm.queries import RANKS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A row's place in the mix.
PLACE = ["shard", "slot"]
#: Near copies share 0.8 of their five-word shingles.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier does not reject; it learns from the labelled part.

    Null and empty texts and those without a letter go; repeated rows stay; without any labelled
    text nothing can be told, and all go. Other columns than those of documents are left out.
    """
    learn = docs.where(F.coalesce(remainder("doc_id", 4) != 2, F.lit(True)))
    model = langid.train_if_labelled(learn, "text", "lang", F.col("doc_id"))
    return langid.identify(docs.select(*COLUMNS), "text", model).where("NOT rejected").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group of near copies.

    Of equal rows one stays, of null and empty texts too. An empty table gives none.
    """
    return jaccard.one_of_each(docs.select(*COLUMNS), "doc_id", "text", SHINGLE_WORDS, SIMILAR_PERCENT)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them, in the order of the shuffled shards.

    A null source is a source; texts without words, null and empty ones too, are not taken.
    Repeated rows are taken one by one. An empty table gives none.
    """
    plan = mixing.mix_plan(docs.select(*COLUMNS), "doc_id", "source", words(F.col("text")))
    return mixing.mix(plan).select(*COLUMNS, *PLACE)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every row of the mix, and whether they decode to its text.

    A null text counts as an empty one, which has no ids. An empty table gives no rows.
    """
    path, pattern = vocabularies.path(RANKS), vocabularies.PATTERN
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    own = ["doc_id", "source", *(c for c in PLACE if c in docs.columns)]
    decoded = bytebpe.round_trip(docs.select(*own, digest.alias("digest"), "text"), "text", path, pattern)
    same = F.sha2("decoded", 256) == F.col("digest")
    return decoded.select(*own, F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("decodes"))


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("token_ids", token_ids),
]

#: The classifier, the mix's order and the ids have no SQL form; tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
