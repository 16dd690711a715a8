"""The numbered queries: each operator over its whole table, with its digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placaflow.llm import (
    bytebpe,
    fingerprints,
    hardneg,
    jaccard,
    langid,
    lexical,
    lm,
    mixing,
    neighbours,
    sharding,
    simhash,
    tokenfiles,
    warc,
)
from placaflow.llm.common import remainder, stored, table, words

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
#: Documents of one task that writes token files.
DOCS_PER_WRITER = 5000


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shards = sharding.shuffle_into_shards(docs, sharding.record_bytes("text"))
    return shards.select(
        "doc_id", sharding.record_bytes("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = warc.read_warc(spark, warc.write_warc(pages, "page_id", "url", "html"))
    whole = F.col("record_type") == "response"
    return records.select(
        F.col("record_id").cast("long").alias("page_id"),
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", F.col("refers_to").cast("long").alias("refers_to"),
    )


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source"), words(F.col("text")).alias("words")
    )
    plan = mixing.mix_plan(docs, "doc_id", "source", F.col("words"))
    plan, _ = stored(plan.withColumn("row", F.monotonically_increasing_id()), "mix-plan")
    mixed, _ = stored(mixing.mix(plan), "mix")  # the shards' rows in their shuffled order
    drawn = mixed.groupBy("row").agg(F.sum("size").alias("taken"))
    taken = F.coalesce("taken", F.lit(0)).cast("long")
    return plan.join(drawn, "row", "left").select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(table(spark, sf_dir, "documents"), "doc_id", "text")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.similar_texts(docs, "doc_id", "text", n=3, percent=90).drop("tag")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    definition = tokenfiles.read_definition(vocabularies.path(TOKENIZER))
    writers = max(1, -(-docs.count() // DOCS_PER_WRITER))
    manifest = tokenfiles.write_tokens(
        docs, "doc_id", "text", definition, tokenfiles.token_count(definition), writers
    )
    return tokenfiles.read_tokens(spark, manifest).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path, pattern = vocabularies.path(RANKS), vocabularies.PATTERN
    decoded = bytebpe.decode(bytebpe.encode(docs, "text", path, pattern).drop("text"), "ids", path)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder("doc_id", 7) == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    model, counts = lm.train(docs.where("NOT held_out"), "text", "doc_id")
    return lm.score(docs, "text", model, counts)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    model = langid.train_if_labelled(docs.where("NOT held_out"), "text", "lang", F.col("doc_id"))
    found = langid.identify(docs.select("doc_id", "held_out", "text"), "text", model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    is_query = F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False))
    return neighbours.search(vectors, "vec_id", "embedding", is_query)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical.search(docs, "doc_id", "text", items, "item_id", "text")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hardneg.mine(vectors, "vec_id", "label", "embedding", F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_shard, op2_warc, op3_mix, op4_fingerprint, op5_jaccard,
        op6_token_files, op7_byte_bpe, op8_lm_score, op9_language, op10_neighbours,
        op11_lexical, op12_simhash, op13_hard_negatives,
    )
}
