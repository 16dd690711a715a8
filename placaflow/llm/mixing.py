"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents of a source are put into a seeded order and cut into blocks; a target is a number
of blocks of equal length. A binary tree over the output shards splits the block quotas of
all sources: each node deals its blocks to its two halves without replacement, so that the
quotas of every shard add up exactly. Each shard then takes its own stretch of a source's
permuted blocks, and its rows are shuffled locally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placaflow.llm.common import durable, keep_clear, small, stored

SEED = 4_099
SHARDS = 16
BLOCKS_PER_SHARD = 64
#: No document is taken more often than this, and no target exceeds this many times its source.
MOST = 3
#: Rows of one stretch of a source's order; a source has as many stretches as it needs.
STRETCH_ROWS = 20_000
OWN = ["source_size", "target", "size", "copies", "placements"]
_MIX = ["_salt", "_rows", "_stretch", "_before"]


def source_targets(docs: DataFrame, source: str, size: str) -> DataFrame:
    """One row per source: `rank`, `source_size`, `rows`, `weight`, `target`.

    Sources in code point order, null last, weigh 1, 2, 3 and so on. They share all words by
    weight; a target stops at `MOST` times its source's size, and what it leaves is shared
    again by weight. That is min(MOST * size, weight * level) for the one level at which the
    targets add up, found by going through the sources in order of the level that fills them.
    """
    by = Window.orderBy(F.col(source).asc_nulls_last())
    sums = docs.groupBy(source).agg(
        F.sum(size).alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    ranked = sums.withColumn("rank", F.row_number().over(by) - 1).withColumn(
        "weight", F.col("rank") % 3 + 1
    )
    fill = Window.orderBy(MOST * F.col("source_size") / F.col("weight"), "rank")
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    levels = ranked.withColumn(
        "level",
        (F.sum("source_size").over(Window.partitionBy())
         - F.coalesce(F.sum(MOST * F.col("source_size")).over(earlier), F.lit(0)))
        / F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)),
    )
    full = MOST * F.col("source_size") / F.col("weight") < F.col("level")
    level = F.min(F.when(~full, F.struct(MOST * F.col("source_size") / F.col("weight"), "rank", "level")))
    leveled = levels.withColumn("at", level.over(Window.partitionBy())["level"])
    return leveled.select(
        source, "rank", "source_size", "rows", "weight",
        F.least((MOST * F.col("source_size")).cast("double"), F.col("weight") * F.col("at")).alias("target"),
    )


def uniform(*parts: Column) -> Column:
    """A number from 0 to below 1 that a seed and names decide."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _draw(counts: Column, need: Column, node: Column, seed: int) -> Column:
    """How many blocks of each source the left half takes: selection without replacement.

    Going through all blocks, each is taken with the probability (blocks still needed) /
    (blocks still to come), which draws from the multivariate hypergeometric distribution.
    """
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, q: a + q)
    start = F.struct(
        need.cast("long").alias("need"), total.alias("rest"), F.lit(0).alias("j"),
        F.array().cast("array<bigint>").alias("got"),
    )

    def source(state: Column, quota: Column) -> Column:
        begin = F.struct(state["need"].alias("need"), state["rest"].alias("rest"), F.lit(0).cast("long").alias("got"))

        def block(s: Column, i: Column) -> Column:
            chance = uniform(F.lit(seed), node, state["j"], i)
            hit = F.when(chance * s["rest"] < s["need"], F.lit(1)).otherwise(F.lit(0)).cast("long")
            return F.struct(
                (s["need"] - hit).alias("need"), (s["rest"] - 1).alias("rest"), (s["got"] + hit).alias("got")
            )

        numbers = F.when(quota > 0, F.sequence(F.lit(1).cast("long"), quota)).otherwise(
            F.array().cast("array<bigint>")
        )
        after = F.aggregate(numbers, begin, block)
        return F.struct(
            after["need"].alias("need"), after["rest"].alias("rest"), (state["j"] + 1).alias("j"),
            F.concat(state["got"], F.array(after["got"])).alias("got"),
        )

    return F.aggregate(counts, start, source)["got"]


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """Rows (shard, rank, n): the blocks of each source that each shard takes.

    `quotas` has a rank (gapless from 0) and a quota per source. One level of the tree after
    the other halves the shards of a node; totals of shards differ by one block at most.
    """
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "quota"))), lambda q: q["quota"])
    nodes = quotas.agg(listed.alias("counts")).select(
        F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "counts"
    )
    for level in range((shards - 1).bit_length()):
        inner = F.col("hi") - F.col("lo") > 1
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, q: a + q)
        need = F.floor(total * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo")))
        taken = _draw(F.col("counts"), need, F.col("lo") * 64 + level, seed)
        halves = nodes.withColumn("mid", middle).withColumn("left", F.when(inner, taken))
        rest = F.zip_with("counts", "left", lambda q, g: q - g)
        nodes = halves.select(
            F.explode(
                F.when(inner, F.array(
                    F.struct(F.col("lo").alias("lo"), F.col("mid").alias("hi"), F.col("left").alias("counts")),
                    F.struct(F.col("mid").alias("lo"), F.col("hi").alias("hi"), rest.alias("counts")),
                )).otherwise(F.array(F.struct("lo", "hi", "counts")))
            ).alias("node")
        ).select("node.*")
    return nodes.select(F.col("lo").alias("shard"), F.posexplode("counts").alias("rank", "n"))


def _block_shards(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Rows (rank, block, shard): each shard takes a stretch of a source's permuted blocks."""
    dealt = split_quotas(quotas, shards, seed).where("n > 0")
    end = F.sum("n").over(Window.partitionBy("rank").orderBy("shard"))
    places = dealt.withColumn("end", end).select(
        "rank", "shard", F.explode(F.sequence(F.col("end") - F.col("n"), F.col("end") - 1)).alias("place")
    )
    blocks = quotas.where("quota > 0").select(
        "rank", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1)).alias("block")
    )
    order = Window.partitionBy("rank").orderBy(F.xxhash64(F.lit(seed + 1), "rank", "block"), "block")
    permuted = blocks.withColumn("place", (F.row_number().over(order) - 1).cast("long"))
    return permuted.join(places, ["rank", "place"]).select("rank", "block", "shard")


def _filled(narrow: DataFrame, gaps: DataFrame, sources: int) -> tuple[DataFrame, DataFrame]:
    """What is taken past the first document too long for a source's gap, and the gaps left then.

    Rows (rank, end, at), `at` being where the document's middle lies in its source's last round,
    and rows (rank, need, gap). Each round takes, in the seeded order, the documents no longer
    than the gap until one does not fit what is left of it; rounds go on while any document fits,
    which in the end takes every document, in order, that fits what is left when its turn comes.
    """
    gaps = durable(gaps.select("rank", "need", (F.col("need") - F.col("full")).alias("gap")))
    taken = narrow.where("false").select("rank", "end", F.col("need").alias("at"))
    rest = narrow.where("end > need AND size > 0").select("rank", "stretch", "size", "end")
    inside = Window.partitionBy("rank", "stretch").orderBy("end").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("rank").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        fit = rest.join(small(gaps, sources, 40), "rank").where("size <= gap")
        summed = durable(fit.withColumn("upto", F.sum("size").over(inside)))
        sums = summed.groupBy("rank", "stretch").agg(F.max("upto").alias("words"))
        offsets = durable(sums.select("rank", "stretch", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before")))
        stretches = offsets.count()
        if not stretches:
            break
        placed = summed.join(small(offsets, stretches, 40), ["rank", "stretch"]).withColumn(
            "upto", F.col("before") + F.col("upto")
        )
        new = placed.where("upto <= gap")
        at = F.col("need") - F.col("gap") + F.col("upto") - F.col("size") / 2
        taken = durable(taken.union(new.select("rank", "end", at)))
        got = new.groupBy("rank").agg(F.max("upto").alias("got"))
        gaps = durable(
            gaps.join(small(got, sources, 24), "rank", "left").select(
                "rank", "need", (F.col("gap") - F.coalesce("got", F.lit(0))).alias("gap")
            )
        )
        rest = placed.where("upto > gap").select("rank", "stretch", "size", "end")
    return taken, gaps


def mix_plan(
    df: DataFrame,
    key: str,
    source: str,
    size: Column,
    shards: int = SHARDS,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
    seed: int = SEED,
) -> DataFrame:
    """Every row with its source's size and target and the places its copies take in the mix.

    Adds `size`, `source_size`, `target` and `placements`: an array of (copy, shard), empty for
    a row that the mix leaves out, `MOST` entries at most. A source is taken whole as often as
    its target allows; the rest of the target is filled in a seeded order up to the first
    document too long for it, then with every later document that still fits, and the gap that is left goes to the document nearest in size.
    Input columns of the added names get the suffix `_in`. Null sources are a source of their
    own, the last; rows with no words are never taken; rows that repeat a key are rows in their
    own right. An empty frame gives an empty frame. Reruns agree: order depends on the keys.
    """
    df = keep_clear(df, [*OWN, "shard", "slot", "copy", *_MIX])
    spark = df.sparkSession
    rows = df.select(
        F.struct("*").alias("record"), F.col(source).alias("source"), size.cast("long").alias("size"),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")).alias("perm"),
    )
    sources, _ = stored(source_targets(rows.select("source", "size"), "source", "size"), "sources")
    known = sources.agg(F.count(F.lit(1)).alias("n"), F.sum("source_size").alias("words")).first()
    blocks, total = shards * blocks_per_shard, known["words"] or 0
    quota = F.when(F.col("target") > 0, F.greatest(F.lit(1), F.round(F.col("target") * blocks / max(1, total))))
    quotas = sources.select("rank", F.coalesce(quota, F.lit(0)).cast("long").alias("quota"))
    sources = small(sources, known["n"], 200)

    # A source's seeded order, in stretches small enough for a task each: the first digits of
    # the order key say which stretch, so that stretches follow one another.
    digits = F.conv(F.substring("perm", 1, 6), 16, 10).cast("long")
    stretches = F.ceil(F.col("rows") / STRETCH_ROWS)
    spread = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).select(
        "record", "size", "perm", "rank", "source_size", "target",
        F.floor(digits * stretches / (1 << 24)).cast("int").alias("stretch"),
    )
    inside = Window.partitionBy("rank", "stretch").orderBy("perm", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed, _ = stored(spread.withColumn("upto", F.sum("size").over(inside)), "mix-order")
    sums = summed.groupBy("rank", "stretch").agg(F.max("upto").alias("words"))
    before = Window.partitionBy("rank").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("rank", "stretch", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    n_stretches = summed.select("rank", "stretch").distinct().count()
    placed = summed.join(small(offsets, n_stretches, 40), ["rank", "stretch"]).withColumn(
        "end", F.col("before") + F.col("upto")
    )

    # Whole rounds, the start of another one, what still fits, and the document that best fills the gap.
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    need = F.col("target") - rounds * F.col("source_size")
    fits = (F.col("end") <= need) & (F.col("size") > 0)
    narrow = placed.select("rank", "stretch", "size", "end", need.alias("need"))
    full = F.max(F.when((F.col("end") <= F.col("need")) & (F.col("size") > 0), F.col("end")))
    gaps = narrow.groupBy("rank", "need").agg(F.coalesce(full, F.lit(0)).alias("full"))
    taken, gaps = _filled(narrow, gaps, known["n"])
    n_taken = taken.count()
    off = F.abs(F.col("size") - F.col("gap"))
    fillers = (
        narrow.select("rank", "size", "end").join(small(gaps, known["n"], 40), "rank")
        .where((F.col("end") > F.col("need")) & (F.col("size") > 0) & (off < F.col("gap")))
        .join(small(taken, n_taken, 40), ["rank", "end"], "left_anti")
        .groupBy("rank").agg(F.min(F.struct(off.alias("off"), "end", "need")).alias("best"))
        .select("rank", F.col("best.end").alias("end"), F.col("best.need").alias("at"))
    )
    extra = durable(taken.union(fillers))
    chosen = placed.join(small(extra, n_taken + known["n"], 40), ["rank", "end"], "left").select(
        "record", "size", "rank", "source_size", "target", "end", rounds.cast("int").alias("rounds"), "at",
        F.when(F.col("size") == 0, F.lit("none")).when(fits, F.lit("prefix"))
        .when(F.col("at").isNotNull(), F.lit("extra")).otherwise(F.lit("none")).alias("last"),
    )

    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(
        F.col("rounds") + F.when(F.col("last") == "none", F.lit(0)).otherwise(F.lit(1))
    )
    shard_of, _ = stored(_block_shards(quotas, shards, seed), "block-shards")
    by_rank = shard_of.groupBy("rank").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("block", "shard"))), lambda b: b["shard"]).alias("shards")
    )
    middle = F.col("end") - F.col("size") / 2

    def shard(copy: Column) -> Column:
        """The shard of the block that a copy's middle falls into; the last filler ends its source."""
        at = copy * F.col("source_size") + F.when(
            (copy == F.col("rounds")) & (F.col("last") == "extra"), F.col("at")
        ).otherwise(middle)
        block = F.floor(at * F.size("shards") / F.col("target"))
        return F.element_at("shards", F.least(block, F.size("shards") - 1).cast("int") + 1)

    numbers = F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>"))
    places = F.transform(numbers, lambda c: F.struct(c.alias("copy"), shard(c).alias("shard")))
    return chosen.join(small(by_rank, known["n"], 8 * blocks // max(1, known["n"]) + 64), "rank", "left").select(
        "record.*", "size", "source_size", "target", places.alias("placements")
    )


def mix(plan: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: one row per copy with `copy`, `shard` and its `slot` after a local shuffle.

    Copies of a shard are ordered by a seeded hash of their row and copy number, in stretches
    small enough for a task each; rows of a stretch come out together and in that order.
    """
    kept = [c for c in plan.columns if c != "placements"]
    copies = plan.select(*kept, F.explode("placements").alias("place")).select(*kept, "place.copy", "place.shard")
    loads = durable(
        plan.select(F.explode("placements.shard").alias("shard")).groupBy("shard").agg(F.count(F.lit(1)).alias("_rows"))
    )
    stretches = F.ceil(F.col("_rows") / STRETCH_ROWS)
    spread = (
        copies.withColumn("_salt", F.xxhash64(F.lit(seed + 2), "copy", F.struct(*kept)))
        .join(small(loads, loads.count(), 24), "shard")
        .withColumn("_stretch", F.floor(F.shiftrightunsigned("_salt", 40) * stretches / (1 << 24)).cast("int"))
    )
    sums = spread.groupBy("shard", "_stretch").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = durable(sums.select("shard", "_stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before")))
    order = Window.partitionBy("shard", "_stretch").orderBy("_salt", "copy")
    placed = spread.join(small(offsets, offsets.count(), 32), ["shard", "_stretch"])
    slot = (F.col("_before") + F.row_number().over(order) - 1).cast("long")
    return placed.select(*kept, "copy", "shard", slot.alias("slot"))
