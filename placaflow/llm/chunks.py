"""Encoding texts by their chunks: words that subword tokenizers treat on their own.

The split patterns of byte-level BPE begin a new pre-token at every single space between two
characters that are no white space, so the chunks between such places can be encoded one by
one, or many together. Equal chunks are encoded once per worker and kept in a bounded cache.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterable, Sequence
from itertools import compress, repeat
from operator import is_

import numpy as np

from placaflow.llm.lm import SHORT, first_bytes, hashes

#: Bytes of one of the two generations of chunks that a worker process keeps, and those of an entry
#: beside its chunk and ids.
KEPT_BYTES, ENTRY_BYTES = 112 << 20, 150
#: Texts encoded together, and chunks put together into one string for the library.
GROUP, ROW = 256, 256
#: Texts whose equal chunks are found at once, and letters after which no more are taken.
JOINED, JOINED_LETTERS = 512, 2 << 20
_CUT = re.compile(r"(?<=\S)(?= \S)")
#: A word of letters and the stops after it, which byte-level patterns take as two pre-tokens.
_TAILED = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([.,;:!?]+)")
#: A line feed that these patterns take as a pre-token of its own.
_LINE = re.compile(r"(?<=\S)\n(?=\S)")


def plain(text: str) -> bool:
    """Whether the only white space is single spaces and line feeds between other characters.

    All other white space counts as not printable.
    """
    return not (
        "  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " "
    ) and text.replace("\n", "").isprintable()


def chunks(text: str) -> list[str]:
    """The chunks of a text, in order; put together they are the text."""
    if not plain(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + w for w in rest]]


def pieces(chunk: str) -> list[str]:
    """Parts of a chunk that byte-level patterns never put into one pre-token, in order."""
    out: list[str] = []
    for line in _LINE.split(chunk) if "\n" in chunk else (chunk,):
        if out:
            out.append("\n")
        tailed = _TAILED.fullmatch(line)
        out += tailed.groups() if tailed else (line,)
    return out


class Generations:
    """Ids of chunks in two generations, so that what is not met again goes and nothing else does.

    When the young one is full it becomes the old one, whose chunks are taken over when met.
    """

    def __init__(self, kept: int) -> None:
        self.kept, self.bytes = kept, 0
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def put(self, chunks: Sequence[str], ids: Sequence[bytes]) -> None:
        """Keep new chunks, each once, with their ids."""
        self.young.update(zip(chunks, ids))
        self.bytes += sum(map(len, chunks)) + sum(map(len, ids)) + ENTRY_BYTES * len(chunks)

    def missing(self, chunks: Iterable[str]) -> list[str]:
        """Take over those of the chunks, none of them young, that are old; the rest."""
        if not self.old:
            return list(chunks)
        found = {c: self.old.pop(c, None) for c in chunks}
        left = [c for c, ids in found.items() if ids is None]
        for c in left:
            del found[c]
        self.put(list(found), list(found.values()))
        return left

    def age(self) -> None:
        if self.bytes > self.kept:
            self.old, self.young, self.bytes = self.young, {}, 0


class ChunkEncoder:
    """Encodes texts through a function that encodes a list of strings.

    Texts that hold one of the `marks` (a tokenizer's added tokens, at which it cuts a text first)
    are encoded whole. `leads` says of each id of a byte-level tokenizer whether its token begins
    with a space. Where it is given, and no mark holds a space, new chunks are put together from
    their pieces, and new pieces without white space are encoded many in a row: after a space each,
    their ids cut before the tokens that begin with one, or with line feeds between them.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], Iterable[Sequence[int]]],
        kept: int = KEPT_BYTES,
        marks: Sequence[str] = (),
        leads: np.ndarray | None = None,
    ) -> None:
        self.encode, self.marks = encode, marks
        self.leads = None if any(" " in mark for mark in marks) else leads
        #: Chunks with their leading space left out, and chunks as they are.
        self.spaced, self.whole = Generations(kept), Generations(kept)

    def _one_by_one(self, known: Generations, new: list[str], lead: str) -> None:
        if new:
            known.put(new, [array("I", ids).tobytes() for ids in self.encode([lead + c for c in new])])

    def _in_rows(self, known: Generations, new: list[str], lead: str) -> None:
        """Ids of new pieces, each after a space (`lead`) or after a line feed."""
        # After a space come chunks of plain texts, whose only white space is the line feed.
        own = [c for c in new if "\n" in c] if lead else [c for c in new if "\n" in c or " " in c or not plain(c)]
        if own:
            new = list(set(new).difference(own))
        if not lead and new:
            ((feed, *more),) = self.encode(["\n"])
            if more:
                own, new = own + new, []
        rows = [new[at : at + ROW] for at in range(0, len(new), ROW)]
        between = " " if lead else "\n"
        for row, ids in zip(rows, self.encode([lead + between.join(r) for r in rows]) if rows else ()):
            both = np.array(ids, dtype=np.uint32)
            if lead:
                starts = 4 * np.flatnonzero(self.leads[both])
                ends = [*starts[1:].tolist(), 4 * len(both)]
            else:
                feeds = 4 * np.flatnonzero(both == feed)
                starts, ends = np.append(0, feeds + 4), [*feeds.tolist(), 4 * len(both)]
            if len(starts) != len(row):
                own += row
                continue
            data = both.tobytes()
            known.put(row, [data[start:end] for start, end in zip(starts.tolist(), ends)])
        self._one_by_one(known, own, lead)

    def _learn(self, new_whole: set[str], new_spaced: set[str]) -> None:
        """Ids of chunks that are not young, as they are and after a space."""
        both = ((self.whole, self.whole.missing(new_whole), ""), (self.spaced, self.spaced.missing(new_spaced), " "))
        if self.leads is None:
            for known, new, lead in both:
                self._one_by_one(known, new, lead)
            return
        made = [{c: p for c in new if not c.isalpha() and len(p := pieces(c)) > 1} for _, new, _ in both]
        inner = {piece for parts in made for p in parts.values() for piece in p[1:]}
        for (known, new, lead), parts, more in zip(both, made, (inner, ())):
            wanted = {c for c in new if c not in parts} if parts else set(new)
            old = {p[0] for p in parts.values()}.union(more).difference(known.young, wanted)
            self._in_rows(known, [*wanted, *known.missing(old)], lead)
        tail = self.whole.young
        for (known, _, _), parts in zip(both, made):
            head = known.young
            left = [c for c in parts if c not in head]
            known.put(left, [head[parts[c][0]] + b"".join([tail[piece] for piece in parts[c][1:]]) for c in left])

    def __call__(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        return [ids for at in range(0, len(texts), GROUP) for ids in self._group(texts[at : at + GROUP])]

    def _group(self, texts: Sequence[str]) -> list[np.ndarray]:
        self.spaced.age()
        self.whole.age()
        out: list[bytes | None] = []
        open_texts: list[tuple[int, list[bytes | None], list[int], int, list[str]]] = []
        new_whole: set[str] = set()
        new_spaced: set[str] = set()
        young_whole, young_spaced = self.whole.young, self.spaced.young
        for text in texts:
            if any(mark in text for mark in self.marks):
                (ids,) = self.encode([text])
                out.append(array("I", ids).tobytes())
                continue
            if plain(text):
                rest = text.split(" ")
                whole = [rest.pop(0)]
            else:
                whole, rest = (_CUT.split(text), []) if text else ([], [])
            # A text is its whole chunks, then its chunks after a space.
            found = [*map(young_whole.get, whole), *map(young_spaced.get, rest)]
            if None in found:
                places = list(compress(range(len(found)), map(is_, found, repeat(None))))
                first = bisect_left(places, len(whole))  # of those after a space
                names = [whole[i] for i in places[:first]] + [rest[i - len(whole)] for i in places[first:]]
                new_whole.update(names[:first])
                new_spaced.update(names[first:])
                open_texts.append((len(out), found, places, first, names))
                out.append(None)
            else:
                out.append(b"".join(found))
        self._learn(new_whole, new_spaced)
        for at, found, places, first, names in open_texts:
            ids = [*map(young_whole.__getitem__, names[:first]), *map(young_spaced.__getitem__, names[first:])]
            for i, own in zip(places, ids):
                found[i] = own
            out[at] = b"".join(found)
        return [np.frombuffer(ids, dtype=np.uint32) for ids in out]

    def joined(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The same ids; each different chunk of many plain texts, or piece of one, is looked up once."""
        out: list[np.ndarray | None] = [None] * len(texts)
        places: list[int] = []
        letters = 0
        others: list[int] = []
        for i, text in enumerate(texts):
            if not text or any(mark in text for mark in self.marks) or not plain(text):
                others.append(i)
                continue
            places.append(i)
            letters += len(text)
            if len(places) == JOINED or letters >= JOINED_LETTERS:
                self._joined(texts, places, out)
                places, letters = [], 0
        if places:
            self._joined(texts, places, out)
        for i, ids in zip(others, self([texts[i] for i in others])):
            out[i] = ids
        return out

    def _joined(self, texts: Sequence[str], places: list[int], out: list[np.ndarray | None]) -> None:
        own = [texts[i].encode() for i in places]
        data = b" ".join(own)
        letters = np.frombuffer(data + b" " + bytes(8), np.uint8)
        starts = cuts(letters[: len(data) + 1], self.leads is not None)
        ends = np.append(starts[1:], len(data) + 1)
        ends -= letters[ends - 1] == _SPACE
        sizes = np.array([len(text) + 1 for text in own])
        firsts = np.searchsorted(starts, np.cumsum(sizes) - sizes)
        spaced = letters[starts - 1] == _SPACE
        spaced[firsts] = False
        self.spaced.age()
        self.whole.age()
        row = np.empty(len(starts), np.int64)
        named: list[list[str]] = []
        found: list[list[bytes | None]] = []
        for known, here in ((self.whole, ~spaced), (self.spaced, spaced)):
            begin, size = starts[here], (ends - starts)[here]
            which, number = alike(letters, begin, size)
            row[here] = number + sum(map(len, named))
            named.append([data[a:b].decode() for a, b in zip(begin[which].tolist(), (begin + size)[which].tolist())])
            found.append([*map(known.young.get, named[-1])])
        lost = [list(compress(range(len(f)), map(is_, f, repeat(None)))) for f in found]
        self._learn(*({names[i] for i in at} for names, at in zip(named, lost)))
        for known, names, ids, at in zip((self.whole, self.spaced), named, found, lost):
            for i in at:
                ids[i] = known.young[names[i]]
        # Rows of ids, one for each different piece, and the row of each place of the texts.
        rows = found[0] + found[1]
        flat = np.frombuffer(b"".join(rows), np.uint32)
        lengths = np.fromiter(map(len, rows), np.int64, len(rows)) // 4
        n = lengths[row]
        upto = np.cumsum(n)
        source = np.repeat((np.cumsum(lengths) - lengths)[row] - (upto - n), n)
        source += np.arange(len(source))
        for i, ids in zip(places, np.split(flat[source], upto[firsts[1:] - 1])):
            out[i] = ids


_SPACE, _FEED = 0x20, 0x0A
_ASCII = np.array([bytes([b]).isalpha() for b in range(256)])
_STOP = np.array([b in b".,;:!?" for b in range(256)])


def cuts(letters: np.ndarray, by_pieces: bool) -> np.ndarray:
    """Where the chunks, or their `pieces`, begin in the UTF-8 of plain texts that has a space after each text."""
    space = letters == _SPACE
    begins = np.append(True, space[:-1])
    if not by_pieces:
        return np.flatnonzero(begins)
    white = space | (letters == _FEED)
    feeds = np.flatnonzero(letters[1:-1] == _FEED) + 1
    feeds = feeds[~(white[feeds - 1] | white[feeds + 1])]
    begins[feeds + 1] = True
    lines = np.flatnonzero(begins)
    begins[feeds] = True
    # The letters of a word with stops after it; those of two bytes are U+00C0 to U+024F but for two signs.
    word, stop = _ASCII[letters], _STOP[letters]
    two = np.flatnonzero((letters >= 0xC3) & (letters <= 0xC9))
    second = letters[two + 1]
    sign = (letters[two] == 0xC3) & ((second == 0x97) | (second == 0xB7)) | (letters[two] == 0xC9) & (second > 0x8F)
    two = two[~sign]
    word[two] = word[two + 1] = True
    other = ~(word | stop)
    other[:-1] |= stop[:-1] & word[1:]
    other[space] = other[feeds] = False
    tailed = word[lines] & ~np.logical_or.reduceat(other, lines)
    turns = np.flatnonzero(word[:-1] & stop[1:]) + 1
    begins[turns[tailed[np.searchsorted(lines, turns, "right") - 1]]] = True
    return np.flatnonzero(begins)


def alike(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different chunk, and for every chunk the number of its place.

    Chunks are found by their hashes and then compared; long ones, and all whose hash another
    chunk has, stay places of their own.
    """
    h = hashes(data, starts, sizes)
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    which = order[new]
    number = np.empty(len(h), np.int64)
    number[order] = np.cumsum(new) - 1
    same = which[number]
    differ = (sizes != sizes[same]) | (sizes > SHORT)
    at, done = np.flatnonzero(~differ & (same != np.arange(len(h)))), 0
    while len(at):
        left = sizes[at] - done
        differ[at] |= first_bytes(data, starts[at] + done, left) != first_bytes(data, starts[same[at]] + done, left)
        at, done = at[left > 8], done + 8
    alone = np.flatnonzero(differ)
    number[alone] = len(which) + np.arange(len(alone))
    return np.append(which, alone), number
