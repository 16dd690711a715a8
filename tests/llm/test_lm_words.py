"""The language model's words, read many at a time, against Python's own split."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from placaflow.llm import lm

LONG = "x" * lm.SHORT
TEXTS = [
    "One two\tTWO\n\x0bthree\x0cfour\rfive", None, "", " ", "a", "B a", " lead and trail ", "joined", "text",
    "no-break space   wide \x1c \x85 Ää", "ab ba aab aba baa \x00 \x00a a\x00",
    "eightlet eightlets eightleT sixteenletters-- sixteenletters--s", LONG, LONG + "y", LONG + "z " + LONG.upper() + "Z",
    "".join(f"w{i} " for i in range(3000)), "日本語" * 500,
]


def split(text):
    return (text or "").encode().lower().split()


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("start", [0, 1, 3, len(TEXTS)])
def test_words_are_those_of_a_split(kind, start):
    """Equal words have equal hashes, others have others, wherever they are in a slice."""
    words, tails, lengths = lm.words_of(pa.array(TEXTS, kind).slice(start))
    found = [w for t in TEXTS[start:] for w in split(t)]
    assert lengths.tolist() == [len(split(t)) for t in TEXTS[start:]]
    assert tails.tolist() == [int.from_bytes(w[-2:]) for w in found]
    assert len(words) == len(found) and lm.END_HASH not in words
    assert len(set(zip(found, words.tolist()))) == len(set(found)) == len(set(words.tolist()))


def test_words_without_texts():
    for texts in (pa.array([], pa.string()), pa.array([None, ""], pa.string())):
        words, tails, lengths = lm.words_of(texts)
        assert len(words) == len(tails) == 0 and lengths.tolist() == [0] * len(texts)


def test_words_are_counted_over_groups():
    words, tails, _ = lm.words_of(pa.array(TEXTS))
    once = lm._counted(words, tails, np.ones(len(words), np.int64))
    again = lm._counted(*np.concatenate([once, once], axis=1))
    own = Counter(words.tolist())
    assert dict(zip(again[0].tolist(), again[2].tolist())) == {w: 2 * c for w, c in own.items()}


@pytest.mark.parametrize("classes", [1, 6, 7])
def test_gradients_are_summed_by_row(classes):
    random = np.random.default_rng(classes)
    rows = np.append(random.integers(0, 50, 900), np.arange(100, 200)).astype(np.uint16)
    values = random.standard_normal((1000, classes), dtype=np.float32)
    which, sums = lm._by_row(values, rows)
    whole = np.zeros((200, classes))
    np.add.at(whole, rows, values)
    assert which.tolist() == sorted(set(rows.tolist()))
    assert np.allclose(sums, whole[which], atol=1e-4)


def test_probabilities_add_up_beyond_reach():
    """Logits that 32 bits cannot hold after exp are moved first."""
    random = np.random.default_rng(5)
    weights = (random.standard_normal((lm.ROWS, 4)) * 100).astype(np.float32)
    model = lm.Model(0, 0, *[np.zeros(0, np.int64)] * 3, np.zeros(1 << 16, int), np.ones(4), np.zeros(4, np.float32), weights)
    rows = random.integers(0, lm.ROWS, (4, 100))
    parts = [np.exp(lm._log_p(model, rows, np.full(100, k)).astype(np.float64)) for k in range(4)]
    assert np.allclose(sum(parts), 1, atol=1e-4)
