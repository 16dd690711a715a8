"""The numbered queries against brute force, the libraries they stand for, and SQL."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as vocabularies
import pyarrow.parquet as pq
import pytest

from placaflow.llm import oracle, queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{DATA}/documents.parquet").to_pandas().sort_values("doc_id").reset_index(drop=True)


def run(spark, name):
    return queries.QUERIES[name](spark, DATA).toPandas()


@pytest.mark.parametrize("name", list(oracle.ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    result = connection.execute(oracle.ORACLES[name])
    columns = [d[0] for d in result.description]
    df = queries.QUERIES[name](spark, DATA)
    assert set(df.columns) == set(columns)
    assert sorted(map(str, result.fetchall())) == sorted(str(tuple(r)) for r in df.select(*columns).collect())


def test_shards_take_every_row_once(spark, docs):
    rows = run(spark, "op1_shard")
    assert sorted(rows.doc_id) == docs.doc_id.tolist()
    counts = rows.groupby("shard").size()
    assert len(counts) == 16 and counts.max() - counts.min() <= 1
    for _, shard in rows.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    crc = rows.set_index("doc_id").text_crc32
    assert [crc[i] for i in docs.doc_id] == [zlib.crc32(t.encode()) for t in docs.text]
    assert run(spark, "op1_shard").equals(rows)


def test_edited_texts(spark, docs):
    rows = run(spark, "op4_fingerprint").set_index("doc_id")
    down = docs.iloc[::-1].reset_index(drop=True)
    following = [*down.text[1:], down.text[0]]
    for i, text, after in zip(down.doc_id, down.text, following):
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert rows.edited_sha256[i] == hashlib.sha256(edited.encode()).hexdigest()
    assert docs.assign(f=docs.doc_id.map(rows.fingerprint)).groupby("text").f.nunique().max() == 1
    assert rows.fingerprint.nunique() == docs.text.nunique()
    assert (rows.near_edited > rows.near_next).mean() > 0.9


def test_token_files_give_the_tokenizers_ids(spark, docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabularies.path(queries.TOKENIZER))
    ids = [own.encode(t, add_special_tokens=False).ids + [0] for t in docs.text]
    rows = run(spark, "op6_token_files").sort_values("doc_id")
    lengths = np.array([len(x) for x in ids])
    assert rows.n_tokens.tolist() == lengths.tolist()
    assert rows.start.tolist() == (np.cumsum(lengths) - lengths).tolist()
    assert rows.ids_crc32.tolist() == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]


def test_byte_bpe_gives_the_rank_files_ids(spark, docs):
    import tiktoken

    from placaflow.llm.bytebpe import read_ranks

    ranks = {t: i for i, t in enumerate(read_ranks(vocabularies.path(queries.RANKS)))}
    own = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [own.encode_ordinary(t) for t in docs.text]
    rows = run(spark, "op7_byte_bpe").sort_values("doc_id")
    assert rows.ids_sha256.tolist() == [hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest() for x in ids]
    assert rows.decoded_sha256.tolist() == [hashlib.sha256(t.encode()).hexdigest() for t in docs.text]


def test_language_model(spark, docs):
    rows = run(spark, "op8_lm_score").set_index("doc_id")
    tokens = {i: [*t.encode().lower().split(), None] for i, t in zip(docs.doc_id, docs.text)}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(w for i, line in tokens.items() if not held[i] for w in line)
    n, v = sum(counts.values()), len(counts)
    for i, line in tokens.items():
        base = sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in line)
        assert rows.base_score[i] == pytest.approx(base)
        assert rows.n_known[i] == sum(counts[w] > 0 for w in line) and rows.held_out[i] == held[i]
    assert (rows.train_tokens == n).all()
    out = rows[rows.held_out]
    assert out.score.sum() > out.base_score.sum()


def test_languages_are_told_apart(spark, docs):
    rows = run(spark, "op9_language").merge(docs, on="doc_id")
    assert (rows.lang_pred == rows.lang)[rows.held_out].mean() > 0.95
    assert rows.rejected.mean() < 0.02 and rows.score.between(0, 1).all()


def test_neighbours_are_found(spark):
    table = pq.read_table(f"{DATA}/embeddings.parquet").to_pandas()
    x = np.array(table.embedding.tolist(), dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = run(spark, "op10_neighbours")
    hits = 0
    for q in np.flatnonzero(table.vec_id % 50 == 0):
        score = x @ x[q]
        score[q] = -2
        best = set(table.vec_id.to_numpy()[np.argsort(-score, kind="stable")[:5]])
        hits += len(best & set(rows.vec_id[rows.query_id == table.vec_id[q]]))
    assert hits / len(rows) >= 0.9


def test_pipeline_stages(spark, docs):
    import corpus_pipeline as pipeline

    frame = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = pipeline.language(spark, frame, DATA)
    assert kept.columns == pipeline.COLUMNS and kept.count() > 0.98 * len(docs)
    alone = {r.doc_id: r.text for r in pipeline.near_copies(spark, frame, DATA).collect()}

    def shingles(text):
        w = text.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = {i: shingles(t) for i, t in zip(docs.doc_id, docs.text)}
    groups = {i: i for i in sets}

    def root(i):
        while groups[i] != i:
            i = groups[i]
        return i

    ids = list(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                groups[max(x, y)] = min(x, y)
    assert set(alone) == {i for i in ids if root(i) == i}
    last = pipeline.run(spark, DATA)
    assert last.where("NOT decodes").count() == 0 and last.count() > 0


def test_words_are_those_of_the_pattern():
    texts = ["a b c", "\x1cx\x85y", " a\tb\x0bc\x0cd\r\ne "]
    for text in texts:
        assert [w.decode() for w in text.encode().split()] == re.findall(r"[^\x20\x09-\x0D]+", text)
