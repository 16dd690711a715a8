"""Within a class of several words, the words before decide too."""

import numpy as np
import pyarrow as pa
import pytest

from placaflow.llm import lm


def word_in(bucket: int, n: int) -> list[str]:
    """Words of one suffix whose hashes are dealt to the bucket."""
    names = [f"w{i}qq" for i in range(2000)]
    words, _, _ = lm.words_of(pa.array(names))
    return [w for w, b in zip(names, lm.buckets_of(words)) if b == bucket][:n]


def test_the_word_before_counts_within_a_class(spark):
    ones, twos = word_in(1, 8), word_in(2, 8)
    common = [f"c{i}" for i in range(lm.WORD_CLASSES)]
    texts = [f"{' '.join(common)} {f'c0 {ones[i % 8]}' if i % 2 else f'c1 {twos[i % 8]}'} c2" for i in range(4000)]
    asked = {"as learned": f"{' '.join(common)} c0 {ones[1]} c2", "swapped": f"{' '.join(common)} c0 {twos[0]} c2"}
    schema = "key string, text string"
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], schema).coalesce(1)
    model, counts = lm.train(docs, "text", "key")
    rows = lm.score(spark.createDataFrame(list(asked.items()), schema), "text", model, counts).collect()
    found = {r.key: r for r in rows}
    assert found["as learned"].base_score == pytest.approx(found["swapped"].base_score)
    assert found["as learned"].score > found["swapped"].score + 0.3
    # At the word itself the class is as likely in both texts: all the gain there is inside the class.
    for text, likely in ((asked["as learned"], True), (asked["swapped"], False)):
        words, tails, lengths = lm.words_of(pa.array([text]))
        _, classes, symbols = model.describe(words, tails)
        at = slice(-2, -1)  # the word before c2
        history = lm.features(symbols, lengths)[:, -3:-2]
        log_p = lm._log_inner(model, model.log_shares(), history, classes[at], lm.buckets_of(words[at]))
        assert (log_p[0] > np.log(0.8)) if likely else (log_p[0] < np.log(0.2))
    # every word of the class and one never seen in each bucket
    parts = model.parts[model.suffix_class[int.from_bytes(b"qq")]]
    assert parts[1] == parts[2] == 2000 + 4 + 1 and parts[3] == 1


def test_buckets_add_up_to_their_class():
    random = np.random.default_rng(2)
    inner = random.standard_normal((lm.ROWS, lm.BUCKETS)).astype(np.float32)
    parts = random.integers(1, 100, (4, lm.BUCKETS)).astype(float)
    model = lm.Model(0, 0, *[np.zeros(0, np.int64)] * 3, np.zeros(1 << 16, int), np.ones(4), np.zeros(4, np.float32), inner, parts, inner)
    rows, classes = random.integers(0, lm.ROWS, (4, 50)).astype(np.uint16), random.integers(0, 4, 50)
    logs = [lm._log_inner(model, model.log_shares(), rows, classes, np.full(50, b)) for b in range(lm.BUCKETS)]
    assert np.allclose(np.exp(np.array(logs, np.float64)).sum(axis=0), 1, atol=1e-4)
