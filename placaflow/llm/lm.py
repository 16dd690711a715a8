"""Language model scoring: a hashed maximum-entropy model with a class-factored softmax.

The probability of a token is that of its class given the words before it, times that of the
token within its class. Classes are the end of a text, the most frequent words, one each, and
groups of all other words by their last two bytes. The class softmax has hashed features of the
history: the word before, the second and third before (skips), and the pair before. Its weights
are trained in rounds: every task takes gradient steps over its texts from common weights, and
the tasks' changes are averaged. The words of a class of several are dealt by their hash to
`BUCKETS`, over which a second softmax has features of the class with the word before and with
the one before that, trained in the same steps. Within a bucket the softmax has one bias per
word, whose best value is known from counts: (count + 1) / (all counts + distinct words + 1),
the last one being for words never seen.

Counts of words cover all training texts. The most frequent words (a bounded table) are looked
up in the tasks; all others are joined with the counts, of which none can be a hot key then.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placaflow.llm.common import durable, in_small_batches, keep_clear
from placaflow.session import shuffles_dropped

#: Words looked up in the tasks, and those that are features under their own name.
TABLE_WORDS, OWN_FEATURES = 1 << 16, 4096
#: Classes: the end, `WORD_CLASSES` words, `SUFFIX_CLASSES` groups of words, and the rest.
WORD_CLASSES, SUFFIX_CLASSES = 19, 19
#: Rows of weights that features are hashed to, and of those the suffix symbols.
ROWS, SUFFIX_SYMBOLS = 1 << 15, 256
ROUNDS, RATE, BATCH = 2, 0.15, 8192
#: Parts of every class of several words (by the first bits of a word's hash), and their features.
BUCKET_BITS, BUCKET_FEATURES = 4, 2
BUCKETS = 1 << BUCKET_BITS
#: Texts read together, and different words that a worker counts at a time.
GROUP, KEPT_WORDS = 512, 700_000
#: Words up to so many bytes are hashed together, eight bytes of each at a time; longer ones by XXH3.
SHORT = 64
END_HASH, END_SUFFIX = 0, -1
#: Logits between this and its negative go to `exp` as they are: 32 bits hold the sums of their classes.
REACH = 80
#: Rows of weights that are summed together, and how many partial sums there are of each.
SUM_ROWS, PARTIAL_SUMS = 1024, 16


_MIX = np.uint64(0xC6A4A7935BD1E995)
_SHIFT = np.uint64(47)
#: What is left of eight bytes of which a word has the first 0 to 8.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
#: Bytes with A-Z lower-cased, and which of them belong to words.
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_INNER = np.array([not bytes([b]).isspace() for b in range(256)])


def first_bytes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The first eight bytes, or fewer, of parts of the data, as one number each."""
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    return eights[starts] & _MASKS[np.minimum(sizes, 8)]


def hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of some words of the data, behind whose last word lie eight bytes more.

    Short words are mixed as by MurmurHash64A, whose last block is filled with zeros here.
    """
    found = sizes.astype(np.uint64) * _MIX
    at, done = np.flatnonzero(sizes <= SHORT), 0
    while len(at):
        left = sizes[at] - done
        block = first_bytes(data, starts[at] + done, left)
        block *= _MIX
        block ^= block >> _SHIFT
        block *= _MIX
        found[at] = (found[at] ^ block) * _MIX
        at, done = at[left > 8], done + 8
    found ^= found >> _SHIFT
    found *= _MIX
    found ^= found >> _SHIFT
    for i in np.flatnonzero(sizes > SHORT).tolist():
        found[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + sizes[i]].tobytes())
    found[found == END_HASH] = 1
    return found.view(np.int64)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and last two bytes of all words of the texts (ends left out), and how many each text has."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, held = texts.buffers()
    if not len(texts) or held is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    n = int(bounds[-1] - bounds[0])
    data = np.zeros(n + 8, np.uint8)
    data[:n] = _LOWER[np.frombuffer(held, np.uint8)[bounds[0] : bounds[-1]]]
    bounds = bounds - bounds[0]
    inner = _INNER[data[:n]]
    cut = np.zeros(n + 1, bool)  # where a text begins or all end
    cut[bounds] = True
    first, last = inner.copy(), inner.copy()
    first[1:] &= cut[1:n] | ~inner[:-1]
    last[:-1] &= cut[1:n] | ~inner[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sizes = ends - starts
    tails = data[ends - 1] + np.where(sizes > 1, data[ends - 2].astype(np.int64) << 8, 0)
    return hashes(data, starts, sizes), tails, np.diff(np.searchsorted(starts, bounds))


def _counted(words: np.ndarray, tails: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each word's hash once, with its last two bytes and the sum of its counts."""
    order = np.argsort(words)
    line = words[order]
    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else order
    sums = np.add.reduceat(counts[order], starts) if len(line) else counts
    return np.stack([line[starts], tails[order[starts]], sums])


class Words(dict):
    """Numbers of the words of some texts, and by number their hashes and last two bytes.

    For joins that keep words between texts; the model reads its words by `words_of`.
    """

    def __init__(self) -> None:
        self.names: list[bytes] = []
        self.hashes = np.zeros(0, np.int64)
        self.suffixes = np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        return number

    def numbers(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of the texts (ends left out), and how many each text has."""
        split = [(t or "").encode().lower().split() for t in texts]
        lengths = np.array([len(s) for s in split], dtype=np.int64)
        look = self.__getitem__
        numbers = np.fromiter((look(w) for s in split for w in s), np.int64, int(lengths.sum()))
        new = self.names[len(self.hashes) :]
        if new:
            fresh = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new)).view(np.int64)
            tails = np.fromiter((int.from_bytes(w[-2:]) for w in new), np.int64, len(new))
            self.hashes = np.concatenate([self.hashes, np.where(fresh == END_HASH, 1, fresh)])
            self.suffixes = np.concatenate([self.suffixes, tails])
        return numbers, lengths


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """Rows (h, suffix, c): hash, last two bytes and count of every word; one row for the ends."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        ends = 0

        def flush() -> pa.RecordBatch:
            both = zip(parts[0], (END_HASH, END_SUFFIX, ends))
            return pa.RecordBatch.from_arrays([pa.array(np.append(a, b)) for a, b in both], names=["h", "suffix", "c"])

        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                words, tails, lengths = words_of(batch.column(0).slice(at, GROUP))
                parts.append(_counted(words, tails, np.ones(len(words), np.int64)))
                ends += len(lengths)
                if sum(p.shape[1] for p in parts) > 2 * KEPT_WORDS:
                    parts = [_counted(*np.concatenate(parts, axis=1))]
                    if parts[0].shape[1] > KEPT_WORDS:
                        yield flush()
                        parts, ends = [], 0
        if ends:
            parts = [_counted(*np.concatenate(parts, axis=1))]
            yield flush()

    parts = df.select(text).mapInArrow(count, "h long, suffix long, c long")
    return parts.groupBy("h", "suffix").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """What tasks need: the table of frequent words, the classes, and the weights."""

    n: int
    v: int
    hashes: np.ndarray  # of the table's words, ascending
    counts: np.ndarray
    ranks: np.ndarray  # by frequency
    suffix_class: np.ndarray  # by last two bytes
    sizes: np.ndarray  # counts + distinct words + 1 of each class; 1 for classes of one word
    prior: np.ndarray
    weights: np.ndarray
    parts: np.ndarray | None = None  # as `sizes`, of each class and bucket
    inner: np.ndarray | None = None  # weights of the buckets

    def log_shares(self) -> np.ndarray:
        """Logarithms of the buckets' shares of their classes, where nothing is known of the history."""
        return np.log(self.parts / self.parts.sum(axis=1, keepdims=True)).astype(np.float32)

    def describe(self, words: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count in the table (0: not there), class and history symbol of words."""
        counts, ranks = np.zeros(len(words), np.int64), np.full(len(words), TABLE_WORDS)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
            there = self.hashes[at] == words
            counts, ranks = np.where(there, self.counts[at], 0), np.where(there, self.ranks[at], TABLE_WORDS)
        # The most frequent words are the classes after that of the ends.
        classes = np.where(ranks < WORD_CLASSES, ranks + 1, self.suffix_class[tails])
        symbols = np.where(ranks < OWN_FEATURES, ranks, OWN_FEATURES + tails * 40503 % SUFFIX_SYMBOLS)
        return counts, classes, symbols


START = OWN_FEATURES + SUFFIX_SYMBOLS


def _hashed(kind: int, keys: np.ndarray) -> np.ndarray:
    """Rows of weights of keys of one kind; in as few bytes as hold them, which sort fastest."""
    mixed = (keys + np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(40)) & np.uint64(ROWS - 1)).astype(np.min_scalar_type(ROWS - 1))


#: Rows of weights of every symbol as the first, second and third word before.
_SINGLE = [_hashed(kind, np.arange(START + 1, dtype=np.uint64)) for kind in range(3)]


def features(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of weights of every token's history; each text is its words and then its end."""
    n = int(lengths.sum()) + len(lengths)
    ends = np.cumsum(lengths + 1) - 1
    line = np.full(n, START, dtype=np.uint64)
    inner = np.ones(n, bool)
    inner[ends] = False
    line[inner] = symbols
    place = np.arange(n) - np.repeat(ends - lengths, lengths + 1)
    before = []
    for back in (1, 2, 3):
        own = np.full(n, START, dtype=np.uint64)
        own[back:] = line[:-back] if n > back else line[:0]
        own[place < back] = START
        before.append(own)
    singles = [table.take(own.view(np.int64)) for table, own in zip(_SINGLE, before)]
    return np.stack([*singles, _hashed(3, before[0] * np.uint64(1 << 13) + before[1] + np.uint64(1 << 20))])


def buckets_of(words: np.ndarray) -> np.ndarray:
    """Buckets of words by their hashes."""
    return (words.view(np.uint64) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def inner_features(rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Rows of the buckets' weights: the class with each of the words before."""
    own = classes.astype(np.uint64)
    return np.stack([_hashed(4 + i, rows[i].astype(np.uint64) * np.uint64(1 << 8) + own) for i in range(BUCKET_FEATURES)])


def _logits(prior: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Logits for some tokens' feature rows, up to one number a token."""
    logits = weights.take(rows[0], axis=0)
    logits += prior
    for row in rows[1:]:
        logits += weights.take(row, axis=0)
    if logits.max() > REACH or logits.min() < -REACH:
        logits -= logits.max(axis=1, keepdims=True)
    return logits


def _sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], values.dtype)


def _log_p(model: Model, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Logarithms (natural) of the probabilities of some tokens' classes."""
    return _log_softmax(_logits(model.prior, model.weights, rows), classes)


def _log_softmax(logits: np.ndarray, targets: np.ndarray) -> np.ndarray:
    own = logits[np.arange(len(targets)), targets]
    return own - np.log(_sums(np.exp(logits, out=logits)))


def _log_inner(model: Model, shares: np.ndarray, rows: np.ndarray, classes: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Logarithms (natural) of the probabilities of some tokens' buckets within their classes."""
    logits = _logits(shares.take(classes, axis=0), model.inner, inner_features(rows, classes))
    return _log_softmax(logits, buckets)


def _with_ends(classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Classes of the texts' words and, after each text, of its end."""
    out = np.zeros(len(classes) + len(lengths), np.int64)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(lengths + 1) - 1] = False
    out[inner] = classes
    return out


def _by_row(values: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the tokens' values by their row of weights; the rows and their sums."""
    order = np.argsort(own, kind="stable")
    line = own[order]
    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    sizes = np.diff(starts, append=len(line))
    sums = values.take(order[starts], axis=0)
    many = sizes > 1
    if many.any():
        both = values.take(order[np.repeat(many, sizes)], axis=0)
        if both.shape[1] % 2 == 0:
            both = both.view(np.complex64)  # two classes in one addition
        ends = np.cumsum(sizes[many])
        sums[many] = np.add.reduceat(both, ends - sizes[many], axis=0).view(np.float32)
    return line[starts], sums


def _steps(prior: np.ndarray, weights: np.ndarray, squares: np.ndarray, targets: np.ndarray, rows: np.ndarray) -> None:
    """Gradient steps over some tokens; the rate of each row falls with its past gradients.

    `prior` is one row for all tokens or one for each.
    """
    for at in range(0, len(targets), BATCH):
        part = rows[:, at : at + BATCH]
        error = _logits(prior if prior.ndim == 1 else prior[at : at + BATCH], weights, part)
        np.exp(error, out=error)
        error /= _sums(error)[:, None]
        error[np.arange(part.shape[1]), targets[at : at + BATCH]] -= 1
        for own in part:
            which, step = _by_row(error, own)
            squares[which] += np.einsum("ij,ij->i", step, step) / np.float32(step.shape[1])
            step *= (np.float32(RATE) / np.sqrt(squares[which] + np.float32(1e-8)))[:, None]
            weights[which] -= step


def _summed(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of (tasks, values) by keys, reading one row after the other."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for part, n, values in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "values"))):
                own = sums.setdefault(part, [0, 0.0])
                own[0] += n
                own[1] = own[1] + np.frombuffer(values, np.float32)
        for part, (n, values) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([n]), pa.array([values.astype(np.float32).tobytes()], pa.binary())],
                names=["part", "n", "values"],
            )

    return changes.repartition(*keys).mapInArrow(add, "part long, n long, values binary")


def train_round(df: DataFrame, text: str, model: Model) -> np.ndarray:
    """New weights of classes and, beside them, buckets: the old ones plus the tasks' average change,
    weighted by their tokens."""
    k = len(model.prior)
    old = np.concatenate([model.weights, model.inner], axis=1)
    shares, several = model.log_shares(), model.sizes != 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, inner = model.weights.copy(), model.inner.copy()
        squares, inner_squares = np.zeros(ROWS, dtype=np.float32), np.zeros(ROWS, dtype=np.float32)
        n = 0
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                words, tails, lengths = words_of(batch.column(0).slice(at, GROUP))
                _, classes, symbols = model.describe(words, tails)
                inside, rows = _with_ends(classes, lengths), features(symbols, lengths)
                _steps(model.prior, weights, squares, inside, rows)
                at_word = several[inside]  # ends are a class of their own
                own = inside[at_word]
                buckets = buckets_of(words)[several[classes]]
                _steps(shares.take(own, axis=0), inner, inner_squares, buckets, inner_features(rows[:, at_word], own))
                n += len(words) + len(lengths)
        if n:
            change = (np.concatenate([weights, inner], axis=1) - old).astype(np.float32) * np.float32(n / 1e6)
            parts = range(ROWS // SUM_ROWS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(parts)), pa.array([n] * len(parts)),
                    pa.array([change[p * SUM_ROWS : (p + 1) * SUM_ROWS].tobytes() for p in parts], pa.binary()),
                    pa.array([TaskContext.get().partitionId() % PARTIAL_SUMS] * len(parts), pa.int32()),
                ],
                names=["part", "n", "values", "salt"],
            )

    changes = df.select(text).mapInArrow(work, "part long, n long, values binary, salt int")
    with shuffles_dropped(df.sparkSession):  # before the next round writes its own
        sums = _summed(_summed(changes, ["part", "salt"]), ["part"]).collect()
    weights = old.copy()
    for row in sums:
        values = np.frombuffer(row["values"], np.float32).reshape(-1, k + BUCKETS)
        weights[row["part"] * SUM_ROWS : (row["part"] + 1) * SUM_ROWS] += values * np.float32(1e6 / row["n"])
    return weights


def _classes(counts: DataFrame) -> Model:
    """The model before training. Collects a bounded table of words and the counts by suffix."""
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    words = counts.where(F.col("suffix") >= 0)
    # Written first: cut to the table inside Spark, so that the driver does not get a table from each task.
    top = durable(words.orderBy(F.col("c").desc(), "h").limit(TABLE_WORDS)).toPandas()
    suffixes = counts.groupBy("suffix").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toPandas()
    mass = {s: [c, v] for s, c, v in suffixes.itertuples(index=False)}
    ends = mass.pop(END_SUFFIX, [0, 0])[0]
    weight = [ends]
    for _, suffix, c in top.head(WORD_CLASSES).itertuples(index=False):
        weight.append(c)
        mass[suffix][0] -= c
        mass[suffix][1] -= 1
    sizes = [1.0] * len(weight)
    groups = sorted(mass.items(), key=lambda m: (-m[1][0], m[0]))
    suffix_class = np.full(1 << 16, len(weight) + len(groups[:SUFFIX_CLASSES]))
    for suffix, (c, v) in groups[:SUFFIX_CLASSES]:
        suffix_class[suffix] = len(weight)
        weight.append(c)
        sizes.append(c + v + 1.0)
    rest = groups[SUFFIX_CLASSES:]
    weight.append(sum(c for _, (c, _) in rest))
    sizes.append(weight[-1] + sum(v for _, (_, v) in rest) + 1.0)
    # The same sums by class and bucket, without the words that are classes.
    by_class = F.lit(len(weight) - 1)
    for suffix, _ in groups[:SUFFIX_CLASSES]:
        by_class = F.when(F.col("suffix") == int(suffix), int(suffix_class[suffix])).otherwise(by_class)
    bucket = F.shiftrightunsigned("h", 64 - BUCKET_BITS)
    sums = words.groupBy(by_class.alias("k"), bucket.alias("b")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v"))
    parts = np.ones((len(weight), BUCKETS))
    for row in sums.collect():  # at most one for each class and bucket
        parts[row["k"], row["b"]] += row["c"] + row["v"]
    own = top.head(WORD_CLASSES)
    for h, suffix, c in zip(own["h"].to_numpy(np.int64), own["suffix"], own["c"]):
        parts[suffix_class[suffix], buckets_of(np.array([h]))[0]] -= c + 1
    by_hash = np.argsort(top["h"].to_numpy(np.int64), kind="stable")
    share = np.array(weight, dtype=np.float64) + 1
    return Model(
        total["n"] or 0, total["v"], top["h"].to_numpy(np.int64)[by_hash], top["c"].to_numpy(np.int64)[by_hash],
        by_hash.astype(np.int64), suffix_class, np.array(sizes),
        np.log(share / share.sum()).astype(np.float32), np.zeros((ROWS, len(weight)), np.float32),
        parts, np.zeros((ROWS, BUCKETS), np.float32),
    )


def train(df: DataFrame, text: str, key: str) -> tuple[Model, DataFrame]:
    """The model of all texts of a frame, and its word counts.

    Every text is learned from once; the rounds share them out by a hash of their key.
    """
    counts = durable(word_counts(in_small_batches(df), text))
    model = _classes(counts)
    for number in range(ROUNDS):
        own = df.where(F.pmod(F.xxhash64(F.lit(5), F.col(key)), F.lit(ROUNDS)) == number)
        both = train_round(own, text, model)
        model.weights, model.inner = (np.ascontiguousarray(w) for w in np.split(both, [len(model.prior)], axis=1))
    return model, counts


def score(df: DataFrame, text: str, model: Model, counts: DataFrame) -> DataFrame:
    """Adds `n_tokens`, `n_known`, `train_tokens`, `base_score` and `score` (log10) to every row.

    The text itself is left out of the result.

    Tokens are the words (A-Z lower-cased) and one end. Null and empty texts are just the end.
    The base is the unigram model with one added to every count. Rows that repeat are scored each
    by itself. A model of no texts gives every token the same probability.
    """
    df = keep_clear(in_small_batches(df), ["n_tokens", "n_known", "train_tokens", "base_score", "score"])
    kept = [c for c in df.columns if c != text]
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"),
        *[F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(kept)],
    )
    shares, several, log_parts = model.log_shares(), model.sizes != 1, np.log10(model.parts)
    ends = float(np.log10(1 + _end_count(counts)))
    names = ["row", "h", "tf", "n_tokens", "n_known", "base", "score", *rows.columns[2:]]
    out_schema = "row long, h long, tf long, n_tokens long, n_known long, base double, score double" + "".join(
        f", {name} {kind}" for name, kind in rows.dtypes[2:]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, GROUP):
                part = batch.slice(begin, GROUP)
                words, tails, lengths = words_of(part.column(1))
                c, inside_of, symbols = model.describe(words, tails)
                classes, rows = _with_ends(inside_of, lengths), features(symbols, lengths)
                size = lengths + 1
                chosen = np.empty(len(classes))
                for at in range(0, len(classes), BATCH):
                    chosen[at : at + BATCH] = _log_p(model, rows[:, at : at + BATCH], classes[at : at + BATCH])
                starts = np.cumsum(size) - size
                at_word = np.flatnonzero(several[classes])
                inside, buckets = classes[at_word], buckets_of(words)[several[inside_of]]
                for at in range(0, len(at_word), BATCH):
                    some = slice(at, at + BATCH)
                    chosen[at_word[some]] += _log_inner(model, shares, rows[:, at_word[some]], inside[some], buckets[some])
                chosen /= np.log(10)
                chosen[at_word] -= log_parts[inside, buckets]
                class_log = np.add.reduceat(chosen, starts)
                # Words of the table: their counts are known here.
                doc = np.repeat(np.arange(len(lengths)), lengths)
                log_c = np.where(c > 0, np.log10(c + 1.0), 0.0)
                single = model.sizes[inside_of] == 1
                n = len(lengths)
                base = np.bincount(doc, log_c, n) + ends
                inside = np.bincount(doc, np.where(single, 0.0, log_c), n)
                known = np.bincount(doc, c > 0, n).astype(np.int64) + (1 if ends > 0 else 0)
                rest = c == 0
                others, numbers = np.unique(words[rest], return_inverse=True)
                pairs, tf = np.unique(doc[rest] * len(others) + numbers, return_counts=True)
                ids = part.column(0).to_numpy()
                m = len(pairs)
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), *[f.type for f in part.schema][2:]]
                if m:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[pairs // len(others)]), pa.array(others[pairs % len(others)]), pa.array(tf.astype(np.int64)), *[pa.nulls(m, t) for t in kinds]],
                        names=names,
                    )
                # The text's own row joins no word: its key is spread, and its count is none.
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(0), pa.array(np.zeros(n, np.int64)), pa.array(size),
                     pa.array(known), pa.array(base), pa.array(class_log + inside), *part.columns[2:]],
                    names=names,
                )

    found = rows.mapInArrow(work, out_schema).join(counts.select("h", "c"), "h", "left")
    log_c = F.when(F.col("tf") > 0, F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(1.0))).otherwise(0.0)
    known = F.when((F.col("tf") > 0) & F.col("c").isNotNull(), F.col("tf")).otherwise(0)
    by_row = found.groupBy("row").agg(
        F.sum(log_c).alias("log_c"), F.sum(known).alias("known"), F.max("n_tokens").alias("n_tokens"),
        F.max("n_known").alias("n_known"), F.max("base").alias("base"), F.max("score").alias("score"),
        *[F.first(c, ignorenulls=True).alias(c) for c in rows.columns[2:]],
    )
    return by_row.select(
        *[F.col(f"kept{i}").alias(c) for i, c in enumerate(kept)],
        "n_tokens", (F.col("n_known") + F.col("known")).cast("long").alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("log_c") - F.col("n_tokens") * float(np.log10(model.n + model.v + 1))).alias("base_score"),
        (F.col("score") + F.col("log_c")).alias("score"),
    )


def _end_count(counts: DataFrame) -> int:
    return counts.where(F.col("suffix") == END_SUFFIX).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c")).first()["c"]
