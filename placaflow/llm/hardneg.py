"""Hard-negative mining with cover trees over norm-augmented vectors.

A candidate x of a tree gets one more component sqrt(M - |x|^2), M being the tree's largest
squared norm; an anchor a gets 0 there. All candidates then have the same norm, and
2 a.x = |a|^2 + M - dist(a, x)^2: inner products follow from distances. A node's points lie
within its covering radius of its centre, and the radius halves from level to level, so the
distance to the centre bounds the inner products of all points below from both sides.

Rows are dealt by a hash to forests of bounded size, with a tree for each label in them. An
anchor descends a forest best bound first, leaves out nodes that no longer matter (below its
k-th best score, or outside all windows that are still open), and computes the products of the
points it reaches in whole numbers. Anchors descend together, so that those that reach the same
node share one product of matrices. They go to the forests in blocks of bounded size.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placaflow.llm.common import give_back, in_small_batches, stored

SEED = 41
#: Vectors of a forest (about), points of a leaf.
FOREST, LEAF = 4096, 16
#: Bytes of anchor vectors that are sent to the forests at once.
ANCHOR_BYTES = 16 << 20
#: Tasks that build forests, at most; a task builds one after another.
_TASKS = 4096
#: Squared norms below have products that doubles hold exactly; up to the other, 64-bit numbers.
_EXACT, _MOST = float(1 << 52), 9.2e18
SCALE = 256
#: Below all scores. Anchors that go through a forest together.
_NONE, TOGETHER = np.iinfo(np.int64).min + 1, 1024


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component, and of a scaled squared norm
    within 64 bits, so that all scores are."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    norm = F.aggregate(vector, F.lit(0.0), lambda total, x: total + F.pow(F.floor(x * SCALE).cast("double"), F.lit(2.0)))
    return F.coalesce(finite & (norm < _MOST), F.lit(False))


class Forest:
    """Cover trees of the labels of some rows, in arrays.

    Node 0 is above all trees; singles hang at their parent directly.
    """

    PARTS = ("ids", "labels", "centre", "radius", "low", "high", "kids", "span", "points")
    KINDS = dict(zip(PARTS, "<i8 <i8 <i8 <f8 <i8 <i8 <i8 <i8 <i8".split()))

    def __init__(self, vectors: np.ndarray, **parts: np.ndarray) -> None:
        self.vectors = vectors
        for name in self.PARTS:
            setattr(self, name, parts[name])
        self.kids, self.span = self.kids.reshape(-1, 2), self.span.reshape(-1, 2)
        self.most = float((vectors * vectors).sum(axis=1).max(initial=0))

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Forest:
        """`vectors` hold whole numbers as doubles."""
        norms = (vectors * vectors).sum(axis=1)
        most = norms.max(initial=0)
        raised = np.column_stack([vectors, np.sqrt(np.maximum(most - norms, 0))])
        centre, radius, low, high, kids, span, points = [0], [np.inf], [], [], [], [], []
        by = np.argsort(labels, kind="stable")
        cuts = np.flatnonzero(np.diff(labels[by])) + 1
        todo = deque([(by, np.split(by, cuts) if len(by) else [])])
        placed = 0
        while todo:
            members, groups = todo.popleft()
            if groups is None:
                groups = cls._net(raised, most, members, radius[len(kids)] / 2) if len(members) > LEAF and radius[len(kids)] else []
            low.append(labels[members].min(initial=np.iinfo(np.int64).max))
            high.append(labels[members].max(initial=np.iinfo(np.int64).min))
            here = [g for g in groups if len(g) == 1] if groups else [members]
            first = len(centre)
            for group in groups:
                if len(group) > 1:
                    apart = raised[group] - raised[group[0]]
                    centre.append(group[0])
                    radius.append(float(np.sqrt((apart * apart).sum(axis=1).max())))
                    todo.append((group, None))
            kids.append((first, len(centre)))
            points += here
            span.append((placed, placed + sum(map(len, here))))
            placed = span[-1][1]
        return cls(
            vectors, ids=ids, labels=labels, centre=np.array(centre), radius=np.array(radius), low=np.array(low),
            high=np.array(high), kids=np.array(kids), span=np.array(span), points=np.concatenate([np.zeros(0, np.int64), *points]),
        )

    @staticmethod
    def _net(raised: np.ndarray, most: float, members: np.ndarray, within: float) -> list[np.ndarray]:
        """Groups around centres (their first members, the node's own first) that are over `within` apart."""
        own = raised[members]
        left = np.ones(len(members), dtype=bool)
        groups = []
        at = 0
        while at < len(members):
            near = left & (2 * most - 2 * (own @ own[at]) <= within * within)
            near[at] = False
            left &= ~near
            left[at] = False
            groups.append(np.concatenate([members[at : at + 1], members[near]]))
            rest = np.argmax(left[at:])
            at = at + int(rest) if left[at + rest] else len(members)
        return groups

    def products(self, anchors: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Inner products in whole numbers, a row for each anchor."""
        if max(float((anchors * anchors).sum(axis=1).max(initial=0)), self.most) < _EXACT:
            return (anchors @ self.vectors[points].T).astype(np.int64)
        return anchors.astype(np.int64) @ self.vectors[points].astype(np.int64).T

    def bounds(self, anchor: np.ndarray, square: float | np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that points below the nodes can have.

        Of one anchor, or of several in rows, their squares in a column.
        """
        total = square + self.most
        away = np.sqrt(np.maximum(total - 2 * (anchor @ self.vectors[self.centre[nodes]].T), 0))
        radius = self.radius[nodes]
        slack = 1 + 1e-6 * total
        return (total - (away + radius) ** 2) / 2 - slack, (total - np.maximum(away - radius, 0) ** 2) / 2 + slack

    def descend(self, anchors: np.ndarray, wanted, needed, verify) -> int:
        """Visit points best bound first; the number of points verified, of all anchors.

        In each round every anchor takes its best node; anchors that take the same one go on together.

        `wanted(who, low, high)`: whether nodes with labels between these can matter to the anchors `who`.
        `needed(who, least, greatest)`: whether nodes whose products lie between these still matter.
        `verify(who, points)`: takes numbers of points that these anchors reached.
        """
        squares = (anchors * anchors).sum(axis=1)
        who, node = np.arange(len(anchors)), np.zeros(len(anchors), dtype=np.int64)
        least, most = np.full(len(anchors), -np.inf), np.full(len(anchors), np.inf)
        reached = 0
        while len(who):
            keep = (node == 0) | needed(who, least, most)
            who, node, least, most = who[keep], node[keep], least[keep], most[keep]
            by = np.lexsort((node, least, -most, who))
            best = np.diff(who[by], prepend=-1) != 0
            now, later = by[best], by[~best]
            now = now[np.argsort(node[now], kind="stable")]
            open_ = [(who[later], node[later], least[later], most[later])]
            for group in np.split(now, np.flatnonzero(np.diff(node[now])) + 1) if len(now) else ():
                own, at = who[group], node[group[0]]
                start, end = self.span[at]
                if end > start:
                    verify(own, self.points[start:end])
                    reached += int(end - start) * len(own)
                below = np.arange(*self.kids[at])
                if len(below):
                    low, high = self.bounds(anchors[own], squares[own][:, None], below)
                    ok = wanted(own[:, None], self.low[below], self.high[below]) & needed(own[:, None], low, high)
                    row, kid = np.nonzero(ok)
                    open_.append((own[row], below[kid], low[row, kid], high[row, kid]))
            who, node, least, most = (np.concatenate(parts) for parts in zip(*open_))
        return reached


class Best:
    """An anchor's best rows so far: (-score, id), the best first."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, []


class Tops:
    """The k best rows of many searches, by falling score, then id, none below `floor`."""

    def __init__(self, k: int, floor: np.ndarray) -> None:
        self.k, self.least = k, floor.astype(np.int64)
        self.found = np.zeros(len(floor), dtype=np.int64)
        self.scores = np.zeros((len(floor), k), dtype=np.int64)
        self.ids = np.zeros((len(floor), k), dtype=np.int64)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of searches, scores and ids, the best first."""
        there = np.arange(self.k) < self.found[:, None]
        return np.nonzero(there)[0], self.scores[there], self.ids[there]

    def offer(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray, fits: np.ndarray) -> None:
        """Rows `ids` for the searches `which`, each once: their scores there, and which of them count."""
        fits = fits & (scores >= self.least[which][:, None])
        if scores.shape[1] > self.k and np.count_nonzero(fits) > 2 * self.k * len(which):
            # What is below a search's k best of these is not sorted.
            place = scores.shape[1] - self.k
            fits &= scores >= np.partition(np.where(fits, scores, _NONE), place, axis=1)[:, place, None]
        row, column = np.nonzero(fits)
        if len(row):
            self.add(which[row], scores[row, column], ids[column])

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(which)
        there = np.arange(self.k) < self.found[touched][:, None]
        which = np.concatenate([touched[np.nonzero(there)[0]], which])
        scores = np.concatenate([self.scores[touched][there], scores])
        ids = np.concatenate([self.ids[touched][there], ids])
        by = np.lexsort((ids, -scores, which))
        which, scores, ids = which[by], scores[by], ids[by]
        first = np.searchsorted(which, touched)
        rank = np.arange(len(which)) - np.repeat(first, np.diff(np.append(first, len(which))))
        kept = rank < self.k
        self.scores[which[kept], rank[kept]] = scores[kept]
        self.ids[which[kept], rank[kept]] = ids[kept]
        self.found[touched] = np.minimum(self.k, np.bincount(np.searchsorted(touched, which), minlength=len(touched)))
        full = touched[self.found[touched] == self.k]
        if self.k:
            self.least[full] = np.maximum(self.least[full], self.scores[full, -1])


def search_positives(forest: Forest, own: np.ndarray, labels: np.ndarray, anchors: np.ndarray, tops: Tops) -> int:
    """Rows of the anchors' labels but themselves; a search for each anchor."""

    def verify(who: np.ndarray, points: np.ndarray) -> None:
        fits = (forest.labels[points] == labels[who][:, None]) & (forest.ids[points] != own[who][:, None])
        tops.offer(who, forest.products(anchors[who], points), forest.ids[points], fits)

    return forest.descend(
        anchors, lambda who, low, high: (low <= labels[who]) & (labels[who] <= high),
        lambda who, _, most: most >= tops.least[who], verify,
    )


def search_negatives(forest: Forest, labels: np.ndarray, anchors: np.ndarray, high: np.ndarray, tops: Tops) -> int:
    """Rows of other labels, for each anchor's windows of scores: `high` has their upper ends, a row
    for each anchor, and `tops` a search for each window, whose floor is the lower end (both included).
    """
    windows = high.shape[1]

    def needed(who: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        found = np.zeros(least.shape, dtype=bool)
        for w in range(windows):
            found |= (most >= tops.least[who * windows + w]) & (least <= high[who, w])
        return found

    def verify(who: np.ndarray, points: np.ndarray) -> None:
        scores = forest.products(anchors[who], points)
        other = forest.labels[points] != labels[who][:, None]
        for w in range(windows):
            tops.offer(who * windows + w, scores, forest.ids[points], other & (scores <= high[who, w][:, None]))

    return forest.descend(anchors, lambda who, low, high: (low != labels[who]) | (high != labels[who]), needed, verify)


def _ends(windows: list[list[tuple[int, int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of windows, a row for each anchor; windows that hold no score are never open."""
    width = max(map(len, windows), default=0)
    shut = (-_NONE, _NONE)
    rows = [[w if w[0] <= w[1] else shut for w in own] + [shut] * (width - len(own)) for own in windows]
    ends = np.array([[(max(a, _NONE), min(b, -_NONE)) for a, b in own] for own in rows], dtype=np.int64)
    ends = ends.reshape(len(windows), width, 2)
    return ends[:, :, 0], ends[:, :, 1]


def _give(tops: Tops, best: list[Best]) -> None:
    which, scores, ids = tops.rows()
    for n, found in enumerate(best):
        found.rows = [(-s, i) for s, i in zip(scores[which == n].tolist(), ids[which == n].tolist())]


def _taken(best: list[Best], floor: np.ndarray) -> Tops:
    tops = Tops(best[0].k, floor)
    rows = [(n, -s, i) for n, found in enumerate(best) for s, i in found.rows]
    if rows:
        tops.add(*np.array(rows, dtype=np.int64).T)
    return tops


def add_positives(forest: Forest, own: int, label: int, anchor: np.ndarray, best: Best) -> int:
    """As `search_positives`, for one anchor."""
    tops = _taken([best], np.array([_NONE]))
    reached = search_positives(forest, np.array([own]), np.array([label]), anchor[None, :], tops)
    _give(tops, [best])
    return reached


def add_negatives(forest: Forest, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], best: list[Best]) -> int:
    """As `search_negatives`, for one anchor."""
    low, high = _ends([windows])
    tops = _taken(best, low.ravel())
    reached = search_negatives(forest, np.array([label]), anchor[None, :], high, tops)
    _give(tops, best)
    return reached


# Spark -------------------------------------------------------------------------------


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Scaled whole numbers of a column of vectors of one length."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = np.concatenate([np.zeros(0), *[c.flatten().to_numpy() for c in chunks]])
    return np.floor(SCALE * flat).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


_FOREST_SCHEMA = "width int, kind string, vectors binary, " + ", ".join(f"{p} binary" for p in Forest.PARTS)


def _built(table: pa.Table) -> pa.Table:
    vectors = _matrix(table.column("v"))
    forest = Forest.build(table.column("id").to_numpy(), table.column("label").to_numpy(), vectors)
    largest = np.abs(vectors).max(initial=0)
    kind = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<f8"
    parts = {p: getattr(forest, p).astype(Forest.KINDS[p]).tobytes() for p in Forest.PARTS}
    row = {"width": vectors.shape[1], "kind": kind, "vectors": vectors.astype(kind).tobytes(), **parts}
    return pa.Table.from_pylist([row], schema=pa.schema([("width", pa.int32()), ("kind", pa.string()), *[(p, pa.binary()) for p in ("vectors", *Forest.PARTS)]]))


def _forests(batches: Iterable[pa.RecordBatch]) -> Iterator[Forest]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
            parts = {p: np.frombuffer(row[p], Forest.KINDS[p]) for p in Forest.PARTS}
            flat = np.frombuffer(row["vectors"], row["kind"]).astype(np.float64)
            yield Forest(flat.reshape(len(parts["ids"]), row["width"]), **parts)


def _positives(forests: DataFrame, sent, k: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = sent.value
        parts = [slice(at, at + TOGETHER) for at in range(0, len(ids), TOGETHER)]
        tops = [Tops(k, np.full(len(ids[part]), _NONE)) for part in parts]
        for forest in _forests(batches):
            for part, found in zip(parts, tops):
                search_positives(forest, ids[part], labels[part], vectors[part], found)
        for part, found in zip(parts, tops):
            which, scores, near = found.rows()
            columns = [pa.array((which + part.start).astype(np.int32)), pa.array(near), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "id", "score"])
        give_back()

    rows = forests.mapInArrow(work, "anchor int, id long, score long")
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _negatives(forests: DataFrame, sent, k: int, low: int, high: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (ids, labels, vectors), positives = sent.value
        # Whole scores from low to high per cent of the positive's.
        windows = [[(-(-low * s // 100), high * s // 100) for _, s in own] for own in positives]
        open_ = np.array([n for n, own in enumerate(windows) if any(a <= b for a, b in own)], dtype=np.int64)
        parts = [open_[at : at + TOGETHER] for at in range(0, len(open_), TOGETHER)]
        ends = [_ends([windows[n] for n in part.tolist()]) for part in parts]
        tops = [Tops(k, least.ravel()) for least, _ in ends]
        for forest in _forests(batches):
            for part, (_, most), found in zip(parts, ends, tops):
                search_negatives(forest, labels[part], vectors[part], most, found)
        for part, (least, _), found in zip(parts, ends, tops):
            which, scores, negatives = found.rows()
            anchor, place = part[which // least.shape[1]], which % least.shape[1]
            near = [positives[n][w] for n, w in zip(anchor.tolist(), place.tolist())]
            columns = [
                pa.array(ids[anchor]), pa.array([i for i, _ in near], pa.int64()), pa.array([s for _, s in near], pa.int64()),
                pa.array(negatives), pa.array(scores),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
        give_back()

    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    rows = forests.mapInArrow(work, schema).withColumn("rank", F.row_number().over(order))
    return rows.where(F.col("rank") <= k).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def mine(
    df: DataFrame, key: str, label: str, vector: str, is_anchor: Column,
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """For each anchor and each of its positives, the hardest rows of other labels.

    Components become floor(256 x); scores are inner products of these with the anchor. An
    anchor's positives are its best other rows of its label; a positive's negatives are the best
    rows of other labels whose score lies from `low` to `high` per cent of the positive's (none
    where that is negative). Equal scores go by smaller key.

    Rows with a null key or label, or an unusable vector (see `usable`; zero vectors take part)
    are left out, and so are vectors of another length than most have. Of rows that repeat a
    key, the smallest label and vector count. Without anchors, positives or candidates there
    are no rows. Other columns are not read.
    """
    spark = df.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = df.where(F.col(key).isNotNull() & F.col(label).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.col("n").desc(), "d").first()
    if top is None:
        return spark.createDataFrame([], schema)
    width = top["d"]
    row = F.min(F.struct("label", "v"))
    single = rows.where(F.size("v") == width).groupBy("id").agg(row.alias("row"), F.max("anchor").alias("anchor"))
    single, _ = stored(single.select("id", "row.label", "row.v", "anchor"), "hard-negatives-rows")
    size = single.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors")).first()
    forests = max(1, -(-size["n"] // FOREST))
    tree = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(forests)).cast("int").alias("tree")
    dealt = single.select("id", "label", "v", tree).repartition(min(forests, _TASKS), "tree")
    grown, _ = stored(dealt.groupBy("tree").applyInArrow(_built, _FOREST_SCHEMA), "hard-negatives-forests")
    grown = in_small_batches(grown)

    blocks = max(1, -(-size["anchors"] * max(width, 1) * 8 // ANCHOR_BYTES))
    block = F.pmod(F.xxhash64(F.lit(SEED + 1), "id"), F.lit(blocks))
    found = spark.createDataFrame([], schema)
    for number in range(blocks):
        part = single.where("anchor").where(block == number).select("id", "label", "v").toArrow()
        if not part.num_rows:
            continue
        anchors = (part.column("id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("v")))
        near = _positives(grown, spark.sparkContext.broadcast(anchors), positives)
        best: list[list[tuple[int, int]]] = [[] for _ in range(part.num_rows)]
        for r in near.orderBy("anchor", "rank").collect():
            best[r["anchor"]].append((r["id"], r["score"]))
        found = found.unionByName(_negatives(grown, spark.sparkContext.broadcast((anchors, best)), negatives, low, high))
    return found
