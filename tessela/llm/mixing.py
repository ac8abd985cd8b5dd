r"""Mixes sources to target weights, with SQL functions alone.

1. Targets: the weights share ``total_share`` of all sizes; a source's target stops at ``max_repeat`` times its
   size and the excess is shared again by weight. Sources sorted by cap over weight fill up one after another, so
   the common level is a prefix sum.
2. Blocks: a seeded hash deals each source's documents to ``BLOCKS`` blocks; the hash is the permutation, so
   block 0, 1, ... is the order of drawing. Each source's blocks are drawn in whole passes and a part of one, which
   takes the blocks in their order and leaves out those that would exceed the target; the blocks it takes come first
   in the order of drawing. What is missing then is filled up from the documents of the blocks left out, in an order
   by another hash, again without those that would exceed, and at last with the one that comes nearest, if any helps.
3. Splitting tree: at each node the draws of all sources are divided between two halves of the output shards,
   source after source by a hypergeometric draw, so all together multivariate hypergeometric and exact to the
   block. A leaf is a shard: its share of a source's draws is the next range of that source's permuted blocks,
   so no two shards hold the same draw.
4. Each draw gets a seeded key; the order by key within a shard is the local shuffle.

Everything random is a hash of (seed, node, source) or (seed, document), so reruns and lost tasks agree.

Defined results: a null text has size 0; the null source is a source, after all others; a source without words
gets target 0 and nothing is taken; documents with equal doc_id and source lie in the same block and are taken
together, which ties in the order of drawing are as well; texts of any length count whole; other columns pass
through, but those named as one that is added or used in between (two underscores in front) give way; an empty table
gives an empty table. Sources are few (thousands): a node of the tree holds a number for each of them in one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessela.llm.columns import words
from tessela.llm.shared import written

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_REPEAT = 2
BLOCKS = 1024
#: Words of the lots that a round of filling up looks at, over what a source lacks; whatever it is, the same lots are taken.
SPARE = 16
#: Lots that the documents of blocks left out are dealt to, for each source.
LOTS = 1 << 20
#: Lots to take that are broadcast, some 60 bytes each.
BROADCAST_ROWS = 500_000
TREE_DEPTH = 3
PARTS = 4096
SEED = 7


ADDED = ("__size", "__block", "__lot", "__s", "__b", "__source_size", "__target", "__shards", "__spare", "__top_source", "__top_lot", "__draws", "__draw", "__nth", "__shard", "__key", "__part", "__from", "__rank", "__place")


def _uniform(*cols: Column) -> Column:
    """From 0 to below 1, by 53 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) to (source, source_size, target); one row for each source, so the windows are small."""
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1)
    each = sizes.withColumn("w", w.cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    by_level = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(every) * F.lit(total_share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / F.sum("w").over(after)
    each = each.withColumn("level", F.when(level <= F.col("cap") / F.col("w"), level))
    level = F.max("level").over(every)  # later ones, with caps counted that do not bind, lie below
    return each.select("source", "source_size", F.least("cap", F.coalesce(level * F.col("w"), F.col("cap"))).alias("target"))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` from ``total`` are ``marked``, by inversion of ``u``.

    Counts are listed from the mode outwards with weights by the ratio of neighbours, as far as 12 standard
    deviations: what lies beyond has less mass than a double resolves.
    """
    low, high = F.greatest(F.lit(0), drawn - (total - marked)).cast("bigint"), F.least(drawn, marked).cast("bigint")
    mode = F.least(F.greatest(F.floor((drawn + 1) * (marked + 1) / (total + 2)), low), high).cast("bigint")
    share = marked / F.greatest(total, F.lit(1))
    reach = (F.sqrt(drawn * share * (F.lit(1) - share)) * 12 + 4).cast("bigint")

    def step(acc: Column, k: Column) -> Column:
        up = acc["w"] * (marked - k + 1) * (drawn - k + 1) / (k * (total - marked - drawn + k))
        down_from = F.when(k == acc["mode"] - 1, F.lit(1.0)).otherwise(acc["w"])
        down = down_from * (k + 1) * (total - marked - drawn + k + 1) / ((marked - k) * (drawn - k))
        return _let(
            F.when(k == acc["mode"], F.lit(1.0)).when(k > acc["mode"], up).otherwise(down),
            lambda w: F.struct(
                w.alias("w"),
                (acc["cum"] + w).alias("cum"),
                F.when(acc["pick"].isNull() & (acc["cum"] + w > acc["goal"]), k).otherwise(acc["pick"]).alias("pick"),
                acc["mode"].alias("mode"),
                acc["goal"].alias("goal"),
            ),
        )

    def start(mode: Column, goal: Column) -> Column:
        return F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("cum"), F.lit(None).cast("bigint").alias("pick"), mode.alias("mode"), goal.alias("goal"))

    def draw(x: Column) -> Column:
        mode = x["mode"]
        downward = F.when(mode > x["low"], F.sequence(mode - 1, F.greatest(x["low"], mode - x["reach"]), F.lit(-1).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
        ks = F.concat(F.sequence(mode, F.least(x["high"], mode + x["reach"])), downward)
        mass = F.aggregate(ks, start(mode, F.lit(1e300)), step, lambda acc: acc["cum"])
        return F.coalesce(F.aggregate(ks, start(mode, u * mass), step, lambda acc: acc["pick"]), mode)

    return _let(F.struct(low.alias("low"), high.alias("high"), mode.alias("mode"), reach.alias("reach")), draw)


def split(quotas: DataFrame, depth: int = TREE_DEPTH, seed: int = SEED) -> DataFrame:
    """(source_no, quota) to (source_no, shard, quota): the splitting tree, a level at a time.

    A level has a row for each node and source; a node's draws are halved, the sources taking their part of the
    left half in turn, each from what earlier ones have left.
    """
    nodes = quotas.select(F.lit(1).cast("bigint").alias("node"), "source_no", "quota")
    for _ in range(depth):
        held = nodes.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("source_no", "quota"))).alias("held"))
        all_draws = F.aggregate("held", F.lit(0).cast("bigint"), lambda a, x: a + x["quota"])
        held = held.withColumn("n", all_draws)
        start = F.struct(F.col("n").alias("total"), F.floor(F.col("n") / 2).cast("bigint").alias("left"), F.array().cast("array<struct<source_no:int,quota:bigint,part:bigint>>").alias("out"))

        def take(acc: Column, x: Column) -> Column:
            part = hypergeometric(acc["total"], x["quota"], acc["left"], _uniform(F.lit(seed), F.col("node"), x["source_no"])).cast("bigint")
            row = lambda p: F.struct(x["source_no"].alias("source_no"), x["quota"].alias("quota"), p.alias("part"))
            return _let(part, lambda p: F.struct((acc["total"] - x["quota"]).alias("total"), (acc["left"] - p).alias("left"), F.concat(acc["out"], F.array(row(p))).alias("out")))

        parts = written(held.select("node", F.explode(F.aggregate("held", start, take, lambda acc: acc["out"])).alias("x")).select("node", "x.*"))
        nodes = parts.select(F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), "source_no", F.col("part").alias("quota")), F.struct((F.col("node") * 2 + 1).alias("node"), "source_no", (F.col("quota") - F.col("part")).alias("quota")))).alias("x")).select("x.*")
    return nodes.select("source_no", (F.col("node") - (1 << depth)).alias("shard"), "quota")


def _fitting(items: str | Column, room: Column, size: str, name: str, kind: str) -> Column:
    """Of the items in their order those that still fit in ``room``: (cum, took), their sum and their names."""
    start = F.struct(F.lit(0).cast("bigint").alias("cum"), F.array().cast(f"array<{kind}>").alias("took"))

    def step(acc: Column, x: Column) -> Column:
        more = F.struct((acc["cum"] + x[size]).alias("cum"), F.concat(acc["took"], F.array(x[name].cast(kind))).alias("took"))
        return F.when(acc["cum"] + x[size] <= room, more).otherwise(acc)

    return F.aggregate(items, start, step)


def _top_up(spare: DataFrame, spare_words: int = SPARE) -> DataFrame:
    """(source, lot, size, lacks) to (source, lot): the lots of each source that fill up what it lacks.

    Lots are gone through in their order, and each that still fits is taken; at last comes the one that leaves the
    least gap, if any makes it smaller. A round looks at the next lots of all sources, those that hold about
    ``spare_words`` times what is lacking, and rounds go on until no lot that fits is left: one that didn't fit before
    never will, as what is lacking only shrinks. So no row gets all lots of a source and none is passed over.
    """
    items = spare.select("source", "lot", "size")
    state = written(spare.groupBy("source").agg(F.first("lacks").cast("double").alias("lacks"), F.lit(0).cast("bigint").alias("seen")))
    took = items.select("source", "lot").limit(0)
    while True:
        now = state.select(F.col("source").alias("s"), "lacks", "seen")
        left = items.join(now, F.col("source").eqNullSafe(F.col("s"))).filter((F.col("lot") >= F.col("seen")) & (F.col("size") <= F.col("lacks"))).drop("s")
        reach = F.first("seen") + F.ceil(F.first("lacks") * spare_words * (LOTS - F.first("seen")) / F.sum("size"))
        reach = left.groupBy("source").agg(F.least(F.lit(LOTS), reach).cast("bigint").alias("reach")).withColumnRenamed("source", "s")
        look = left.join(reach, F.col("source").eqNullSafe(F.col("s"))).groupBy("source")
        look = look.agg(F.first("lacks").alias("lacks"), F.first("reach").alias("seen"), F.array_sort(F.collect_list(F.when(F.col("lot") < F.col("reach"), F.struct("lot", "size")))).alias("lots"))
        look = look.withColumn("fill", _fitting("lots", F.col("lacks"), "size", "lot", "bigint"))
        look = written(look.select("source", (F.col("lacks") - F.col("fill.cum")).alias("lacks"), "seen", F.col("fill.took").alias("took")))
        if look.isEmpty():
            break
        took = took.unionByName(look.select("source", F.explode("took").alias("lot")))
        others = state.join(look.select(F.col("source").alias("s")), F.col("source").eqNullSafe(F.col("s")), "left_anti")
        state = written(others.unionByName(look.select("source", "lacks", "seen")))
    now = state.select(F.col("source").alias("s"), "lacks")
    taken = took.select(F.col("source").alias("s"), F.col("lot").alias("l"))
    gap = F.abs(F.col("lacks") - F.col("size"))
    rest = items.join(now, F.col("source").eqNullSafe(F.col("s"))).drop("s").filter(gap < F.col("lacks"))
    rest = rest.join(taken, F.col("source").eqNullSafe(F.col("s")) & (F.col("lot") == F.col("l")), "left_anti")
    return took.unionByName(rest.groupBy("source").agg(F.min_by("lot", F.struct(gap, "lot")).alias("lot")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, depth: int = TREE_DEPTH, seed: int = SEED) -> DataFrame:
    """``docs`` with ``__size``, ``__source_size``, ``__target`` and ``__draws``: the (shard, key) of each time the mix takes the document."""
    docs = docs.drop(*ADDED)
    own = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"))
    sized = docs.withColumn("__size", F.size(words(F.col("text"))).cast("long")).withColumn("__block", F.pmod(own, F.lit(BLOCKS)).cast("int"))
    slim = written(sized.select("doc_id", F.col("source"), F.col("__size").alias("size"), F.col("__block").alias("block")))
    blocks = slim.groupBy("source", "block").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs"))
    blocks = written(blocks.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("block", "words"))).alias("blocks"), F.sum("words").alias("source_size")))
    sources = targets(blocks.select("source", "source_size")).withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("int"))
    plan = blocks.drop("source_size").join(sources, blocks["source"].eqNullSafe(sources["source"])).drop(blocks["source"])
    # whole passes, and of the last pass the blocks that fit, which come first: ``cut`` is the first block left out of it
    plan = plan.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
    plan = plan.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    fill = _fitting("blocks", F.col("rest"), "words", "block", "int")
    plan = plan.withColumn("fill", F.when(F.col("rest") > 0, fill).otherwise(_fitting(F.slice("blocks", 1, 0), F.lit(0.0), "words", "block", "int")))
    taken = lambda x: F.array_contains("fill.took", x["block"])
    plan = plan.withColumn("blocks", F.concat(F.filter("blocks", taken), F.filter("blocks", lambda x: ~taken(x))))
    plan = plan.withColumn("blocks", F.transform("blocks", lambda x, i: F.struct(i.alias("place"), x["words"].alias("words"), x["block"].alias("hash"))))
    plan = plan.withColumn("quota", F.col("passes") * F.size("blocks") + F.size("fill.took")).withColumn("lacks", F.col("rest") - F.col("fill.cum"))
    plan = written(plan.withColumn("cut", F.size("fill.took")).drop("fill"))
    shards = split(plan.select("source_no", "quota"), depth, seed)
    ranges = shards.groupBy("source_no").agg(F.array_sort(F.collect_list(F.struct("shard", "quota"))).alias("shards"))
    ends = F.transform("shards", lambda x, i: F.struct(x["shard"].alias("shard"), F.aggregate(F.slice("shards", 1, i + 1), F.lit(0).cast("bigint"), lambda a, y: a + y["quota"]).alias("end")))
    plan = plan.join(ranges.select("source_no", ends.alias("ends")), "source_no")
    # one row for each block: its draws are j = place + pass * blocks, below the quota
    each = plan.select("source", "source_size", "target", "lacks", "cut", "ends", "quota", F.size("blocks").alias("n"), F.explode("blocks").alias("b")).withColumn("place", F.col("b.place"))
    draws = F.filter(F.transform(F.sequence(F.lit(0), F.lit(MAX_REPEAT)), lambda p: F.col("place") + p * F.col("n")), lambda j: j < F.col("quota"))
    shard_of = lambda j: F.filter("ends", lambda e: j < e["end"])[0]["shard"]
    each = each.select("source", "source_size", "target", F.col("b.hash").alias("block"), (F.col("place") >= F.col("cut")).alias("spare"), F.transform(draws, shard_of).alias("shards"), "lacks")
    each = written(each)
    # documents of the blocks left out, in ``LOTS`` lots by another hash: of each source's, those that fill up what it lacks
    lot = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.col("source")), 44)
    left_out = each.filter("spare").select(F.col("source").alias("s"), F.col("block").alias("b"), "lacks")
    spare = slim.filter("size > 0").join(left_out, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    spare = spare.groupBy("source", lot.alias("lot")).agg(F.sum("size").alias("size"), F.first("lacks").alias("lacks")).filter("size < 2 * lacks")
    spare = written(spare)
    best = written(_top_up(spare).select(F.col("source").alias("__top_source"), F.col("lot").alias("__top_lot")))
    if best.count() <= BROADCAST_ROWS:
        best = F.broadcast(best)
    each = each.select(F.col("source").alias("__s"), F.col("block").alias("__b"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.col("shards").alias("__shards"), "spare")
    each = each.withColumn("__spare", F.col("spare")).drop("spare")
    out = sized.withColumn("__lot", lot).join(each, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b")), "left")
    out = out.join(best, F.col("source").eqNullSafe(F.col("__top_source")) & (F.col("__lot") == F.col("__top_lot")) & F.col("__spare") & (F.col("__size") > 0), "left")
    topped = F.when(F.col("__top_lot").isNotNull(), F.array(F.pmod(F.xxhash64(F.lit(seed + 2), F.col("doc_id")), F.lit(1 << depth)))).otherwise(F.array().cast("array<bigint>"))
    shards = F.concat(F.coalesce("__shards", F.array().cast("array<bigint>")), topped)
    draws = F.transform(shards, lambda s, i: F.struct(s.alias("shard"), F.xxhash64(F.lit(seed + 3), F.col("doc_id"), i).alias("key")))
    return out.withColumn("__draws", draws).select(*docs.columns, "__size", "__source_size", "__target", "__draws")


def placed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, depth: int = TREE_DEPTH, seed: int = SEED) -> DataFrame:
    """The mixture with ``__place``, from 0, in each shard's shuffled order, and ``__nth``, from 0, among its document's
    draws, beside the columns of ``mix``.

    Places are counted in ``PARTS`` ranges of keys for each shard, so that no task gets a whole shard.
    """
    docs = docs.drop(*ADDED)
    own = [*docs.columns, "__size", "__source_size", "__target", "__draws"]
    draws = mix(docs, weights, depth, seed).select("*", F.posexplode("__draws").alias("__nth", "__draw"))
    draws = draws.select(*own, "__nth", F.col("__draw.shard").alias("__shard"), F.col("__draw.key").alias("__key"))
    draws = written(draws.withColumn("__part", F.floor(F.col("__key") / F.lit((1 << 64) // PARTS)).cast("int")))
    before = Window.partitionBy("__shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = draws.groupBy("__shard", "__part").agg(F.count(F.lit(1)).alias("k")).select("__shard", "__part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("__from"))
    order = Window.partitionBy("__shard", "__part").orderBy("__key", F.xxhash64(*docs.columns))
    draws = draws.withColumn("__rank", F.row_number().over(order))
    return draws.join(F.broadcast(parts), ["__shard", "__part"]).select(*own, "__nth", "__shard", (F.col("__from") + F.col("__rank") - 1).alias("__place"))


def shards(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, depth: int = TREE_DEPTH, seed: int = SEED) -> DataFrame:
    """The mixture itself: a row for each draw, in shuffled order; files of a shard follow each other, none holds two."""
    draws = placed(docs, weights, depth, seed).select(*[c for c in docs.columns if c not in ADDED], "__shard", "__place")
    return draws.repartitionByRange("__shard", "__place").sortWithinPartitions("__shard", "__place")


def digest() -> tuple[Column, ...]:
    return (
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__size") * F.size("__draws")).alias("taken"),
        F.array_join(F.transform("__draws", lambda x: x["shard"].cast("string")), ",").alias("shards"),
        F.array_join(F.transform("__draws", lambda x: x["key"].cast("string")), ",").alias("keys"),
    )


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: the shard of each draw, and the key that orders it there."""
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return mixed.select("doc_id", *digest())
