"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its hashed letter n-grams; a linear softmax on the mean
gives the languages. Both are trained by stochastic gradient descent in numpy on a bounded
sample, of which a part is kept back to calibrate confidences and the limits for rejection.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placaflow.llm.common import give_back, in_small_batches, keep_clear

BUCKETS, WIDTH = 1 << 16, 16
GRAMS = (3, 4)
#: Labelled texts of each language that training may use.
SAMPLE_PER_LANGUAGE = 1000
EPOCHS, RATE, SEED = 8, 0.5, 7
#: Every fifth sampled text calibrates; rejection limits keep all but this share of those.
CALIBRATION, LOST = 5, 0.001
UNKNOWN = "und"
_GAP = 4
_PART_BYTES = 1 << 18
_KEPT = bytes(c if chr(c).isalpha() or c >= 0x80 else 0x20 for c in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _grams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams at every byte of the texts joined by blanks, and the texts' places."""
    raw = [t.lower().encode().translate(_KEPT) for t in texts]
    data = np.frombuffer((b" " * _GAP).join([b"", *raw, b""]), dtype=np.uint8).astype(np.uint32)
    lengths = np.array([len(r) for r in raw], dtype=np.int64)
    starts = np.cumsum(lengths + _GAP) - lengths
    n = len(data) - max(GRAMS) + 1
    hashed = np.empty((len(GRAMS), n), dtype=np.uint32)
    for row, size in enumerate(GRAMS):
        code = np.full(n, size, dtype=np.uint32)
        for i in range(size):
            code *= np.uint32(0x01000193)
            code ^= data[i : i + n]
        code *= np.uint32(0x9E3779B1)
        hashed[row] = code >> np.uint32(16)
    return hashed, starts, lengths


class Model:
    """Scores of n-grams, the embedding already multiplied with the softmax weights."""

    def __init__(self, labels: list[str], scores: np.ndarray, seen: np.ndarray, scale: float, least: float, known: float) -> None:
        self.labels, self.scores, self.seen = labels, scores.astype(np.float32), seen
        self.scale, self.least, self.known = scale, least, known
        self._table = np.hstack([self.scores, seen[:, None].astype(np.float32)])

    def save(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(
            out, labels=np.array(self.labels), scores=self.scores, seen=self.seen,
            limits=np.array([self.scale, self.least, self.known]),
        )
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as f:
            return Model(f["labels"].tolist(), f["scores"], f["seen"], *f["limits"].tolist())

    def logits(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean n-gram scores of texts, and the share of their n-grams that training has seen."""
        out = np.zeros((len(texts), len(self.labels) + 1))
        at = 0
        while at < len(texts):  # a few texts at a time: the scores of all n-grams are in memory
            size, end = 0, at
            while end < len(texts) and (end == at or size < _PART_BYTES):
                size += len(texts[end])
                end += 1
            hashed, starts, lengths = _grams(texts[at:end])
            full = np.flatnonzero(lengths)
            if len(full):
                cuts = np.column_stack([starts[full], starts[full] + lengths[full]]).ravel()
                for row in hashed:
                    padded = np.append(row, np.zeros(max(GRAMS), np.uint32))
                    out[at + full] += np.add.reduceat(self._table[padded], cuts, axis=0, dtype=np.float64)[::2]
                out[at + full] /= len(GRAMS) * lengths[full][:, None]
            at = end
        return out[:, :-1], out[:, -1]

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Labels, calibrated probabilities, and whether to reject.

        Texts that are null or have no letter are `und` with probability 0 and rejected.
        """
        ok = np.array([has_letter(t) for t in texts], dtype=bool)
        logits, known = self.logits([t if o else "" for t, o in zip(texts, ok)])
        p = _softmax(logits * self.scale)
        best, top = p.argmax(axis=1), p.max(axis=1)
        names = [self.labels[b] if o else UNKNOWN for b, o in zip(best, ok)]
        return names, np.where(ok, top, 0.0), ~ok | (top < self.least) | (known < self.known)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: Sequence[str], langs: Sequence[str], seed: int = SEED) -> Model:
    """Fit on labelled texts in the order given; the result depends on nothing else."""
    labels = sorted(set(langs))
    y = np.array([labels.index(x) for x in langs])
    rng = np.random.default_rng(seed)
    bags = []
    for text in texts:
        hashed, starts, lengths = _grams([text])
        own = hashed[:, starts[0] : starts[0] + lengths[0]].ravel()
        ids, n = np.unique(own, return_counts=True)
        bags.append((ids, (n / max(1, n.sum())).astype(np.float32)))
    held = np.arange(len(y)) % CALIBRATION == CALIBRATION - 1
    if held.sum() < 2 * len(labels):
        held[:] = False
    fit = np.flatnonzero(~held)
    embedding = (rng.random((BUCKETS, WIDTH), dtype=np.float32) - 0.5) / WIDTH
    weights = np.zeros((WIDTH, len(labels)), dtype=np.float32)
    seen = np.zeros(BUCKETS, dtype=bool)
    for i in fit:
        seen[bags[i][0]] = True
    weigh = 1 / np.maximum(1, np.bincount(y[fit], minlength=len(labels)))
    weigh = (weigh / weigh[y[fit]].mean()).astype(np.float32)  # each language counts alike
    steps, step = EPOCHS * len(fit), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            ids, share = bags[i]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = share @ embedding[ids]
            p = mean @ weights
            p = np.exp(p - p.max())
            error = (p / p.sum()).astype(np.float32)
            error[y[i]] -= 1
            error *= np.float32(rate) * weigh[y[i]]
            back = weights @ error
            weights -= np.outer(mean, error)
            # Each n-gram's step follows its share; the mean's own step is that of the whole text.
            embedding[ids] -= np.outer(share, back) * np.float32(min(len(ids), 200))
    model = Model(labels, embedding @ weights, seen, 1.0, 0.0, 0.0)
    check = np.flatnonzero(held) if held.any() else fit
    logits, known = model.logits([texts[i] for i in check])
    loss = [
        (-np.log(np.maximum(1e-12, _softmax(logits * s)[np.arange(len(check)), y[check]])).mean(), s)
        for s in np.geomspace(0.05, 100, 67)
    ]
    model.scale = float(min(loss)[1])
    top = _softmax(logits * model.scale).max(axis=1)
    model.least = min(0.5, 0.5 * float(np.quantile(top, LOST)))
    model.known = 0.5 * float(np.quantile(known, LOST))
    return model


class NothingLabelled(ValueError):
    """There is no labelled text to learn from."""


def train_on(df: DataFrame, text: str, lang: str, key: Column, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Train on a sample of the rows whose text has letters and whose label is not null.

    The sample has `per_language` texts of each label at most, those with the smallest hash of
    `key`; one of rows with equal keys. It is drawn in parallel and fitted in one task. Without
    any labelled row there is no model, which is an error.
    """
    place = F.xxhash64(F.lit(SEED), key)
    rows = in_small_batches(df).where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        place.alias("place"), F.col(text).alias("text"), F.col(lang).alias("lang")
    )
    # Half as many again as needed on average: hashes are uniform, the limit below is exact.
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        raise NothingLabelled("no labelled text to learn from")
    near = F.lit(False)
    for name, n in counts.items():
        share = min(1.0, 1.5 * per_language / n + 50 / n)
        near = near | ((F.col("lang") == name) & (F.pmod("place", F.lit(1 << 40)) < int(share * (1 << 40))))
    sample = rows.where(near).groupBy("place").agg(F.min(F.struct("lang", "text")).alias("row"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((p, r["lang"], r["text"]) for b in batches for p, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        rows.sort(key=lambda r: (r[0] % (1 << 40), r[0]))
        taken: dict[str, int] = {}
        texts, langs = [], []
        for _, name, body in rows:
            taken[name] = taken.get(name, 0) + 1
            if taken[name] <= per_language:
                texts.append(body)
                langs.append(name)
        saved = train(texts, langs).save()
        del rows, texts, langs
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([saved], pa.binary())], names=["model"])

    return Model.load(bytes(sample.repartition(1).mapInArrow(fit, "model binary").first()["model"]))


def train_if_labelled(df: DataFrame, text: str, lang: str, key: Column) -> Model | None:
    """As `train_on`; None where there is no labelled row, as in an empty table."""
    try:
        return train_on(df, text, lang, key)
    except NothingLabelled:
        return None


def identify(df: DataFrame, text: str, model: Model | None) -> DataFrame:
    """Adds `lang_pred`, `score` (its calibrated probability) and `rejected`.

    Whole texts are read, nothing else. Null texts and texts without a letter are `und`, 0, true;
    a text whose confidence or share of known n-grams is below the calibrated limits is rejected
    too, but keeps its label. Without a model every text is `und`. Repeated rows stay, an empty
    table gives none. Input columns of these names get the suffix `_in`.
    """
    df = keep_clear(in_small_batches(df), ["lang_pred", "score", "rejected"])
    if model is None:
        return df.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    saved = model.save()
    schema = df.selectExpr("*", "'' AS lang_pred", "0D AS score", "true AS rejected").schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.load(saved)
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, b.num_rows, 1024)):
            names, scores, rejected = own.predict(batch.column(text).to_pylist())
            out = batch.append_column("lang_pred", pa.array(names, pa.string()))
            yield out.append_column("score", pa.array(scores, pa.float64())).append_column("rejected", pa.array(rejected, pa.bool_()))
        give_back()

    return df.mapInArrow(add, schema)
