"""Similarity join of texts on word n-grams: exact Jaccard similarity, prefix filtering.

Texts with equal sets of n-grams are one class. The n-grams of a set are ordered from rare to
frequent; sets at a similarity of t or more share one of their first n - ceil(t n) + 1 n-grams.
The order uses counts of all n-grams by hashed counters (any one order is right, a good one
keeps lists short). Lists of sets by prefix n-gram are then joined in two steps:

* every set is compared with one set of each of its lists, the one with the fewest n-grams that
  no other list holds, which links most copies of a text without comparing them all;
* pairs that share a list but are not connected yet pass length, positional and suffix filters
  (the last compares how many n-grams two sets have in each of 256 ranges of hashes; it gets only
  the sets that have a partner by the others).

Each remaining pair is verified once, on the whole sets. Long lists are cut into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placaflow.llm.common import drop_folder, durable, give_back, in_small_batches, keep_clear, small, stored
from placaflow.llm.components import components
from placaflow.llm.lm import Words

#: Counters of the order of n-grams; fixed, so that the table sent to tasks is bounded.
COUNTERS = 1 << 20
_COUNT_PART = 1 << 14
RANGES = 256
#: Sets of one list compared in one group; longer lists are cut into blocks of this size.
LIST_BLOCK = 2048
#: Sets compared with one common set in one group.
HUB_BLOCK = 512
#: Bytes of sets that a task sends on together.
SENT_BYTES = 2 << 20
#: Groups that one row of a set's targets names.
TARGETS = 256
#: Pairs whose ranges are compared at once.
_TOGETHER = 1 << 14
CACHE_WORDS = 250_000
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class Sets:
    """Sets of hashed n-grams of texts, the words' hashes kept in between."""

    def __init__(self, n: int) -> None:
        self.n, self.words = n, Words()

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text the ascending hashes of its distinct n-grams.

        A-Z is lower-cased, words are split at ASCII white space. A text of fewer words is one
        n-gram as a whole; without words or text the set is empty.
        """
        if len(self.words.names) > CACHE_WORDS:
            self.words = Words()
        numbers, lengths = self.words.numbers(texts)
        h = self.words.hashes[numbers].view(np.uint64)
        n = self.n
        grams = np.zeros(max(0, len(h) - n + 1), dtype=np.uint64)
        for i in range(n):
            grams += h[i : i + len(grams)] * _MIX[i % len(_MIX)] * np.uint64(2 * (i // len(_MIX)) + 1)
        grams = _mixed(grams)
        out, at = [], 0
        for length in lengths.tolist():
            if length >= n:
                own = np.sort(grams[at : at + length - n + 1])
                out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            elif length:
                short = h[at : at + length] * np.array([_MIX[-1 - i] for i in range(length)])
                out.append(_mixed(short.sum(keepdims=True) + np.uint64(length)))
            else:
                out.append(np.zeros(0, np.uint64))
            at += length
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _key(own: np.ndarray) -> int:
    """Identity of a set: 64 bits of hash. (Of 10**9 sets, two get the same with odds of 1 in 40.)"""
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def _range_counts(own: np.ndarray) -> bytes:
    """How many n-grams of a set lie in each range of hashes, in as few bytes a number as hold them."""
    counts = np.bincount((own >> np.uint64(56)).astype(np.int64), minlength=RANGES)
    return counts.astype("<u" + str(next(w for w in (1, 2, 4, 8) if counts.max() < 1 << 8 * w))).tobytes()


def _range_matrix(column: list[bytes]) -> np.ndarray:
    """The numbers of `_range_counts`, a row for each set."""
    widths = [len(data) // RANGES for data in column]
    out = np.zeros((len(column), RANGES), dtype=f"<u{max(widths)}")
    for width in set(widths):
        which = [n for n, w in enumerate(widths) if w == width]
        out[which] = np.frombuffer(b"".join([column[n] for n in which]), f"<u{width}").reshape(-1, RANGES)
    return out


def least_overlap(a: np.ndarray, b: np.ndarray, t: int) -> np.ndarray:
    """The least intersection of sets of given sizes at a similarity of t hundredths."""
    return -(-t * (a + b) // (100 + t))


def _describe(df: DataFrame, n: int) -> DataFrame:
    """Rows of two kinds: (id, tag, n_shingles, k, ranges) of texts, (part, counts) of counters."""
    kind = dict(df.dtypes)["id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, counts, any_rows = Sets(n), np.zeros(COUNTERS, np.int64), False
        names = ["id", "tag", "n_shingles", "k", "ranges", "part", "counts"]
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("id").type
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                own = sets.of(part.column("text").to_pylist())
                counts += np.bincount(
                    (np.concatenate(own) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS
                )
                any_rows = True
                ranges = [_range_counts(s) for s in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), part.column("tag"), pa.array([len(s) for s in own], pa.int64()),
                        pa.array([_key(s) if len(s) else None for s in own], pa.int64()), pa.array(ranges, pa.binary()),
                        pa.nulls(len(own), pa.int32()), pa.nulls(len(own), pa.binary()),
                    ],
                    names=names,
                )
        if any_rows:
            parts = COUNTERS // _COUNT_PART
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(parts, id_type), pa.nulls(parts, pa.int64()), pa.nulls(parts, pa.int64()),
                    pa.nulls(parts, pa.int64()), pa.nulls(parts, pa.binary()), pa.array(list(range(parts)), pa.int32()),
                    pa.array([c.astype("<u4").tobytes() for c in np.split(counts, parts)], pa.binary()),
                ],
                names=names,
            )
        del sets, counts
        give_back()

    return df.mapInArrow(
        work, f"id {kind}, tag long, n_shingles long, k long, ranges binary, part int, counts binary"
    )


def _frequency_ranks(parts: DataFrame) -> np.ndarray:
    """By counter, the logarithm of its count over all texts, as 16 bits."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                width = "<u4" if len(values) == 4 * _COUNT_PART else "<u8"
                sums[part] = sums.get(part, 0) + np.frombuffer(values, width).astype(np.uint64)
        for part, values in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([values.astype("<u8").tobytes()], pa.binary())], names=["part", "counts"]
            )

    schema = "part int, counts binary"
    rows = COUNTERS // _COUNT_PART
    # Summed within each task first, then by part: no task reads all of them.
    summed = parts.select("part", "counts").coalesce(256).mapInArrow(add, schema).repartition(rows, "part").mapInArrow(add, schema)
    out = np.zeros(COUNTERS, dtype=np.uint64)
    for row in summed.collect():
        out[row["part"] * _COUNT_PART : (row["part"] + 1) * _COUNT_PART] = np.frombuffer(row["counts"], "<u8")
    return np.minimum(65535, np.round(1400 * np.log2(out + 1.0))).astype(np.uint16)


def _postings(df: DataFrame, n: int, t: int, ranks: np.ndarray) -> DataFrame:
    """Rows (token, k, pos, size): the prefix of every text's set, from rare to frequent."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                own = [s for s in sets.of(batch.column(0).slice(at, 512).to_pylist()) if len(s)]
                if not own:
                    continue
                sizes = np.array([len(s) for s in own], dtype=np.int64)
                lengths = sizes - (t * sizes + 99) // 100 + 1
                tokens = []
                for s, p in zip(own, lengths.tolist()):
                    order = ranks[(s & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(48) | s >> np.uint64(16)
                    first = np.partition(order, p - 1)[:p] if p < len(order) else order
                    tokens.append(np.sort(first))
                keys = np.array([_key(s) for s in own], dtype=np.int64)
                starts = np.cumsum(lengths) - lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(keys, lengths)),
                        pa.array((np.arange(lengths.sum()) - np.repeat(starts, lengths)).astype(np.int32)),
                        pa.array(np.repeat(sizes, lengths).astype(np.int32)),
                    ],
                    names=["token", "k", "pos", "size"],
                )
        del sets
        give_back()

    return df.select("text").mapInArrow(work, "token long, k long, pos int, size int")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups, rows of a group following one another; a group may be cut by batches."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        rest = table
        if table.num_rows < 2:
            continue
        last = np.ones(table.num_rows, dtype=bool)
        for i in range(keys):
            column = table.column(i).to_numpy()
            last &= column == column[-1]
        cut = table.num_rows - int(last.sum())
        if cut:
            yield table.slice(0, cut)
            rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def _starts(table: pa.Table, keys: int) -> np.ndarray:
    """Where groups start in a table, and its end."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for i in range(keys):
        column = table.column(i).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def _ahead(starts: np.ndarray, ca: np.ndarray, cb: np.ndarray, crowd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the first row and the number of rows that it is compared with.

    In a cell of two blocks of outsiders these are the rows behind it. Where a block of outsiders
    meets one of the crowd (`cb` below 0, outsiders first), an outsider's are the crowd's, in the first
    block of the crowd (-1) the outsiders behind it too; those of the crowd have none.
    """
    sizes = np.diff(starts)
    end = np.repeat(starts[1:], sizes)
    meets = cb < 0
    members = np.add.reduceat(crowd.astype(np.int64), starts[:-1])
    first = np.where(cb < -1, end - np.repeat(members, sizes), np.arange(len(ca)) + 1)
    return first, np.where(meets & crowd, 0, end - first)


def _expanded(first: np.ndarray, count: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (row, compared row), some `limit` at a time."""
    rows = np.flatnonzero(count)
    total = np.cumsum(count[rows])
    at = 0
    while at < len(rows):
        before = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
        own = rows[at:upto]
        i = np.repeat(own, count[own])
        place = np.arange(len(i)) - np.repeat(total[at:upto] - count[own] - before, count[own])
        yield i, first[i] + place
        at = upto


def _near_pairs(table: pa.Table, t: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of whole groups, not yet connected, that pass the length and positional filters,
    and the overlap that each needs.

    The positional filter is right for the first n-gram that two sets share, and every pair meets in
    that one's list.
    """
    ca, cb, block, pos, size, comp = (table.column(c).to_numpy().astype(np.int64) for c in ("ca", "cb", "block", "pos", "size", "comp"))
    crowd = table.column("crowd").to_numpy().astype(bool)
    for i, j in _expanded(*_ahead(_starts(table, 3), ca, cb, crowd), 1 << 16):
        need = least_overlap(size[i], size[j], t)
        ok = (comp[i] != comp[j]) & ((cb[i] < 0) | (block[i] != block[j]))
        ok &= np.minimum(size[i], size[j]) >= need
        ok &= np.minimum(size[i] - pos[i], size[j] - pos[j]) >= need
        if ok.any():
            yield i[ok], j[ok], need[ok]


def _paired(rows: DataFrame, t: int) -> DataFrame:
    """Those of the rows (see `_open_pairs`, without ranges) that are in one of the `_near_pairs`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 3):
            met = np.zeros(table.num_rows, dtype=bool)
            for a, b, _ in _near_pairs(table, t):
                met[a] = met[b] = True
            if met.any():
                yield from table.filter(pa.array(met)).to_batches()
        give_back()

    return rows.mapInArrow(work, rows.schema)


def _open_pairs(rows: DataFrame, t: int) -> DataFrame:
    """Pairs (a, b) of sets in one list, not yet connected, that pass all filters.

    `rows` has token, ca, cb (the blocks of its list that a group compares), crowd, block, k, pos,
    size, comp and ranges, ordered by the first four.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, 3):
            k, ranges = table.column("k").to_numpy(), _range_matrix(table.column("ranges").to_pylist())
            for i, j, need in _near_pairs(table, t):
                for at in range(0, len(i), _TOGETHER):
                    a, b = i[at : at + _TOGETHER], j[at : at + _TOGETHER]
                    close = np.minimum(ranges[a], ranges[b]).sum(axis=1, dtype=np.int64) >= need[at : at + _TOGETHER]
                    if close.any():
                        x, y = k[a[close]], k[b[close]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"]
                        )
        give_back()

    return rows.mapInArrow(work, "a long, b long")


def _open_cells(marked: DataFrame) -> DataFrame:
    """Rows of lists that hold several components, once for each cell of blocks that compares them.

    The largest component of a list is its crowd, whose sets are not compared with each other: all
    others, the outsiders, meet each other and the crowd. A list with few outsiders costs as many
    comparisons as it has sets for each of them.
    """
    sizes = marked.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("n"))
    lists = sizes.groupBy("token").agg(
        F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("comps")
    )

    def blocks(n: Column) -> Column:
        return F.ceil(n / LIST_BLOCK).cast("int")

    # Written, so that the join below is one of two plain shuffles and a long list can be split.
    open_lists = durable(
        lists.where("comps > 1").select(
            "token", F.col("top.comp").alias("main"), blocks(F.col("top.n")).alias("inside"), blocks(F.col("n") - F.col("top.n")).alias("outside")
        )
    )
    crowd = F.col("comp") == F.col("main")
    block = F.pmod(F.xxhash64("k"), F.when(crowd, F.col("inside")).otherwise(F.col("outside"))).cast("int")
    placed = marked.join(open_lists, "token").withColumn("crowd", crowd.cast("int")).withColumn("block", block)

    def numbers(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    def cell(ca: Column, cb: Column) -> Column:
        return F.struct(ca.cast("int").alias("ca"), cb.cast("int").alias("cb"))

    own = F.col("block")
    of_crowd = F.transform(numbers("outside"), lambda o: cell(o, -1 - own))
    of_others = F.concat(
        F.transform(numbers("inside"), lambda i: cell(own, -1 - i)),
        F.transform(F.filter(numbers("outside"), lambda o: o != own), lambda o: cell(F.least(own, o), F.greatest(own, o))),
    )
    cells = placed.withColumn("cell", F.explode(F.when(F.col("crowd") == 1, of_crowd).otherwise(of_others)))
    return cells.select("token", "cell.ca", "cell.cb", "crowd", "block", "k", "pos", "size", "comp")


def _in_cells(rows: DataFrame) -> DataFrame:
    """The rows of each cell together, its crowd last."""
    return rows.repartition("token", "ca", "cb").sortWithinPartitions("token", "ca", "cb", "crowd")


def _verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, n: int, t: int) -> DataFrame:
    """Those of the pairs (x, hub), all different, whose sets are similar enough.

    Whole sets of the texts in question are made again; each goes once to every group that needs
    it. A hub with many pairs is sent to several groups.
    """
    pairs = durable(pairs)
    loads = durable(pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / HUB_BLOCK).cast("int").alias("groups")))
    member = pairs.join(loads, "hub").select(
        F.col("x").alias("k"), "hub", F.pmod(F.xxhash64("x"), F.col("groups")).cast("int").alias("salt"), F.lit(1).alias("member")
    )
    head = loads.select(F.col("hub").alias("k"), "hub", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"), F.lit(0).alias("member"))
    # Each set's targets, in lists of some `TARGETS`.
    sends = durable(member.union(head))
    lists = durable(sends.groupBy("k").agg(F.ceil(F.count(F.lit(1)) / TARGETS).cast("int").alias("lists")))
    part = F.pmod(F.xxhash64("hub", "salt"), F.col("lists")).cast("int")
    targets = sends.join(lists, "k").groupBy("k", part.alias("part")).agg(F.collect_list(F.struct("hub", "salt", "member")).alias("to"))
    wanted = durable(targets.join(reps, "k").select("tag", "k", "part", "to"))
    data = wanted.agg(F.coalesce(F.sum(40 + 32 * F.size("to")), F.lit(0))).first()[0]
    rows = docs.select("tag", "text").join(small(wanted, 1, data + 60 * wanted.count()), "tag").dropDuplicates(["tag", "part"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = sets.of(part.column("text").to_pylist())
                out: list[tuple] = []
                size = 0
                for s, k, to in zip(own, part.column("k").to_pylist(), part.column("to").to_pylist()):
                    data = s.tobytes()
                    for x in to:
                        out.append((x["hub"], x["salt"], x["member"], k, data))
                        size += len(data)
                        if size > SENT_BYTES:
                            yield _sent(out)
                            out, size = [], 0
                if out:
                    yield _sent(out)
        del sets
        give_back()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: tuple[int, int] | None = None
        own = np.zeros(0, np.uint64)
        for batch in batches:
            out: list[tuple[int, int]] = []
            for hub, salt, member, k, data in zip(*(c.to_pylist() for c in batch.columns)):
                one = np.frombuffer(data, np.uint64)
                if not member:
                    head, own = (hub, salt), one
                    continue
                assert head == (hub, salt)
                at = np.minimum(np.searchsorted(own, one), len(own) - 1)
                both = int((own[at] == one).sum())
                if 100 * both >= t * (len(own) + len(one) - both):
                    out.append((k, hub))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])
        give_back()

    sent = rows.mapInArrow(send, "hub long, salt int, member int, k long, data binary")
    grouped = sent.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "member")
    return durable(grouped.mapInArrow(check, "a long, b long"))


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["hub", "salt", "member", "k", "data"]
    )


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    tag = F.xxhash64(F.col(key), F.col(text))
    return in_small_batches(df).select(F.col(key).alias("id"), tag.alias("tag"), F.col(text).alias("text"))


def near_classes(df: DataFrame, key: str, text: str, n: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """Rows (id, tag, n_shingles, k) of all texts, and (k, root) of sets that have links."""
    docs = _rows(df, key, text)
    described, folder = stored(_describe(docs, n), "sets")
    spark = df.sparkSession
    ranks = _frequency_ranks(described.where("part IS NOT NULL"))
    postings, posted = stored(_postings(docs, n, percent, ranks), "prefixes")
    # Lists of two sets and more. Copies of a text have one set, so they are not counted twice.
    lists = postings.groupBy("token").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    multi = durable(lists.where("lo < hi").select("token"))
    shared = durable(postings.join(small(multi, multi.count(), 24), "token").distinct())
    drop_folder(spark, posted)
    rows = described.where("part IS NULL").select("id", "tag", "n_shingles", "k", "ranges")
    reps = rows.where("k IS NOT NULL").groupBy("k").agg(F.min("tag").alias("tag"))

    # Written, so that the join below is one of two plain shuffles and a long list can be split.
    hubs = durable(shared.groupBy("token").agg(F.min(F.struct("pos", "size", "k")).alias("hub")))
    both = F.col("size") + F.col("hub.size")
    need = F.ceil(F.lit(percent) * both / (100 + percent))
    fits = (F.least("size", "hub.size") >= need) & (
        F.least(F.col("size") - F.col("pos"), F.col("hub.size") - F.col("hub.pos")) >= need
    )
    near = shared.join(hubs, "token").where(F.col("k") != F.col("hub.k")).where(fits)
    # Either set of a pair may be the other's hub; the pair is verified once.
    ordered = near.groupBy(F.least("k", "hub.k").alias("lo"), F.greatest("k", "hub.k").alias("hi")).agg(F.max("hub.k").alias("hub"))
    star = ordered.select(F.when(F.col("hub") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("x"), "hub")
    first = _verified(docs, reps, star, n, percent)
    known = components(first)

    roots = known.select(F.col("a").alias("k"), F.col("b").alias("root"))
    marked = shared.join(small(roots, roots.count(), 48), "k", "left").withColumn("comp", F.coalesce("root", "k")).drop("root")
    # Most rows of short lists have no partner of like length and position: ranges are sent with the others.
    paired = durable(_paired(_in_cells(_open_cells(marked)), percent))
    used = durable(paired.select("k").distinct())
    ranges = rows.where("k IS NOT NULL").join(small(used, used.count(), 24), "k", "left_semi").groupBy("k").agg(F.min("ranges").alias("ranges"))
    open_pairs = _open_pairs(_in_cells(paired.join(ranges, "k").select(*paired.columns, "ranges")), percent).distinct().select(F.col("a").alias("x"), F.col("b").alias("hub"))
    second = _verified(docs, reps, open_pairs, n, percent)
    linked = components(known.union(second))
    kept = durable(rows.drop("ranges"))
    drop_folder(spark, folder)
    return kept, linked.select(F.col("a").alias("k"), F.col("b").alias("root"))


def similar_texts(df: DataFrame, key: str, text: str, n: int = 3, percent: int = 90) -> DataFrame:
    """One row per input row: the key, `n_shingles`, `component_id`, and `tag` (of key and text).

    Texts link when their sets of n-grams have a Jaccard similarity of `percent` hundredths or
    more; `component_id` is the smallest key that links reach. Null and empty texts and those
    without words have an empty set, link with nothing and are a component by themselves. Equal
    texts and repeated rows are one class and always in one component. Null keys are left out of
    the smallest key. Other columns are not looked at. An empty frame gives an empty frame.
    """
    rows, linked = near_classes(df, key, text, n, percent)
    classes = rows.where("k IS NOT NULL").groupBy("k").agg(F.min("id").alias("least"))
    rooted = durable(classes.join(linked, "k", "left").select("k", "least", F.coalesce("root", "k").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = durable(rooted.join(least, "root").select("k", "component_id"))
    found = rows.join(named, "k", "left")
    own = F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(F.col("id").alias(key), "n_shingles", own.alias("component_id"), "tag")


def one_of_each(df: DataFrame, key: str, text: str, n: int = 3, percent: int = 90) -> DataFrame:
    """The input without near copies: of each component the row with the smallest key stays.

    Columns are those of the input. Unlike texts of one key are components of their own. Of rows
    that repeat that key and text one stays; of rows with empty sets all stay, but for those that
    repeat a key and text.
    """
    rows, linked = near_classes(df, key, text, n, percent)
    rooted = rows.join(linked, "k", "left")
    found = durable(rooted.select("id", "tag", F.col("k").isNull().alias("empty"), F.coalesce("root", "k", "tag").alias("c")))
    winners = found.groupBy("c", "empty").agg(F.min(F.struct("id", "tag")).alias("first"))
    stay = durable(winners.select(F.col("first.tag").alias("_tag")).distinct())
    leave = durable(found.select(F.col("tag").alias("_tag")).distinct().join(stay, "_tag", "left_anti"))
    repeated = durable(found.groupBy(F.col("tag").alias("_tag")).count().where("count > 1").select("_tag"))
    tagged = keep_clear(df, ["_tag"]).withColumn("_tag", F.xxhash64(F.col(key), F.col(text)))
    kept = tagged.join(small(leave, leave.count(), 24), "_tag", "left_anti")
    n_repeated = repeated.count()
    if n_repeated:
        hint = small(repeated, n_repeated, 24)
        kept = kept.join(hint, "_tag", "left_anti").union(kept.join(hint, "_tag", "left_semi").dropDuplicates(["_tag"]))
    return kept.drop("_tag")
