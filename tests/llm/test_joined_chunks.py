"""Token ids of many texts at once: each different piece is looked up once, ids are those of the library."""

import numpy as np
import public_tokenizers as vocabularies
import pytest
from tokenizers import Tokenizer

from placaflow.llm import chunks, queries, tokenfiles

WORDS = ["the", "Tzheit", "naïve", "Ĳssel", "ɏa", "ɐb", "a×b", "÷", "word,", "end.\nNext", "x\n\ny", "don't", "3.14", "日本語。", "w.x,", "...",
         ",\nq", "q?!\n-", "ß.", "×.", "a\x00b", "l" * 70, "l" * 70 + ".", "eightlet", "eightlets", "\U0001f600!", "ı:\nı:"]
ODD = ["", " ", "\n", "\na.", "a.\n", " a", "a ", "a  b", "a\tb c.", "a \nb", "x　y z", "<|endoftext|> a.", ",", "a"]


@pytest.fixture(scope="module")
def definition():
    return tokenfiles.read_definition(vocabularies.path(queries.TOKENIZER))


@pytest.fixture(scope="module")
def texts():
    random = np.random.default_rng(3)
    made = [random.choice([" ", " ", " ", "\n"]).join(random.choice(WORDS, random.integers(1, 60))) for _ in range(300)]
    return [*ODD, *made, *ODD, *made[:50]]


def own_ids(definition, texts):
    return [e.ids for e in Tokenizer.from_str(definition).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("group", [1, 7, 512])
def test_ids_are_the_librarys(definition, texts, group, monkeypatch):
    monkeypatch.setattr(chunks, "JOINED", group)
    tokenfiles.tokenizer.cache_clear()
    found = tokenfiles.tokenizer(definition).joined(texts)
    assert [ids.tolist() for ids in found] == own_ids(definition, texts)
    assert tokenfiles.tokenizer(definition).joined([]) == []


def test_equal_hashes_of_different_chunks_do_no_harm(definition, texts, monkeypatch):
    monkeypatch.setattr(chunks, "hashes", lambda data, starts, sizes: sizes % 2)
    tokenfiles.tokenizer.cache_clear()
    found = tokenfiles.tokenizer(definition).joined(texts)
    tokenfiles.tokenizer.cache_clear()
    assert [ids.tolist() for ids in found] == own_ids(definition, texts)


def test_cuts_are_those_of_pieces(texts):
    """The vectorised cuts and the pieces of every chunk are the same."""
    for text in filter(chunks.plain, filter(None, texts)):
        data = text.encode() + b" "
        for by_pieces in (False, True):
            starts = chunks.cuts(np.frombuffer(data, np.uint8), by_pieces).tolist()
            own = [p for c in text.split(" ") for p in (chunks.pieces(c) if by_pieces else [c])]
            parts = [data[a:b].decode() for a, b in zip(starts, [*starts[1:], len(data)])]
            assert [p.removesuffix(" ") for p in parts] == own


def test_a_piece_is_learned_once(definition):
    """Words with other stops and line feeds around them cost the library no second look."""
    encoder = tokenfiles.tokenizer(definition)
    encoder.joined(["one two three, four. x\ny"])
    known = len(encoder.spaced.young)
    encoder.joined(["one three two? four! three: four.\nx two, two. three? x"])
    assert len(encoder.spaced.young) == known
