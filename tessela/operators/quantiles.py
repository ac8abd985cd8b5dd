"""Exact quantiles of groups of any size, by selection in narrowing ranges of values.

A first pass counts each group's values by ranges of about 1.6 % of their size (a row for each group, range and task is
shuffled), and every rank that is asked for finds the range that holds it. Ranges with more than ``GATHER`` values are
counted again in ``PARTS`` parts between their least and greatest value, all at once, until none is left that holds
more and isn't a single value. What lies in the ranges then is counted by value and read off. No task holds a group's
values: only a group's ranges, or the values of one small range.

Values are read several times, so the group's columns and the values are kept once as a narrow table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessela.sources.kept import kept

#: Ranges of the first pass in each factor of e.
STEPS = 64
#: Parts that a range is cut into, and values that are read off a range at most.
PARTS = 4096
GATHER = 100_000


def _same(keys: list[str], others: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(keys, others, strict=True)])


def _by_size(v: Column) -> Column:
    """The number of a value's range: rises with the value, NaN above all; null for null."""
    size = F.signum(v) * F.log1p(F.abs(v)) * STEPS
    return F.when(F.isnan(v), F.lit(1 << 40)).when(v.isNotNull(), F.floor(F.greatest(F.least(size, F.lit(1e9)), F.lit(-1e9))))


def _part(v: Column, low: Column, high: Column) -> Column:
    """The part of a range: rises with the value; halves, so that no difference overflows."""
    inner = F.floor(F.nanvl((v / 2 - low / 2) / (high / 2 - low / 2) * PARTS, F.lit(1.0)))
    return F.when(v <= low, 0).when(v >= high, PARTS - 1).otherwise(F.greatest(F.least(inner, F.lit(PARTS - 1)), F.lit(0)))


def _counted(rows: DataFrame, keys: list[str], part: Column) -> DataFrame:
    return rows.groupBy(*keys, part.alias("__part")).agg(F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))


def _holding(counts: DataFrame, within: list[str], order: str, ranks: Column) -> DataFrame:
    """Of counts in an order those that hold one of the ranks, with ``__at``, the ranks within; the first has rank 0."""
    w = Window.partitionBy(*within).orderBy(order)
    before = F.coalesce(F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("__before", before).withColumn("__ranks", ranks)
    here = F.filter("__ranks", lambda k: (k["at"] >= F.col("__before")) & (k["at"] < F.col("__before") + F.col("__c")))
    moved = F.transform(here, lambda k: F.struct(k["rank"].alias("rank"), (k["at"] - F.col("__before")).alias("at")))
    return counts.withColumn("__at", moved).filter(F.size("__at") > 0).drop("__before", "__ranks")


def quantiles(df: DataFrame, by: list[str], value: str, shares: tuple[float, ...], gather: int = GATHER, spread: tuple[str, Callable[[Column], Column]] | None = None, keep: bool = True) -> DataFrame:
    """(group columns, ``q``: the quantiles, ``n``: values, ``rows``), a row for each group, null groups too.

    Quantiles are those of ``percentile``: between two values they are on the line. Nulls are rows but no values; a
    group without values has a null ``q``; an empty table has no groups (one with n = 0 if ``by`` is empty).

    ``spread`` (name, function) makes groups of panes, such as months: ``name`` is one of ``by``, and of a pane the
    function gives an array, of that column's kind, with the groups that it belongs to. With ``keep`` false, ``df`` is
    read in each pass: where it is a kept table itself. Panes are counted once; their counts add up to those of the
    groups, and only values in a range that is looked at are taken once for each group.
    """
    keys = [f"__k{i}" for i in range(len(by))] or ["__k0"]
    own = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)] if by else [F.lit(0).alias("__k0")]
    pane = keys[by.index(spread[0])] if spread else None
    rows = df.select(*own, F.col(value).cast("double").alias("__v"))
    rows = kept(rows) if keep else rows
    grouped = lambda t: t
    if spread:
        targets = kept(rows.select(F.col(pane).alias("__pane")).distinct().select("__pane", F.explode(spread[1](F.col("__pane"))).alias("__group")))
        grouped = lambda t: t.join(targets, F.col(pane).eqNullSafe(F.col("__pane"))).withColumn(pane, F.col("__group")).drop("__pane", "__group")
    first = grouped(_counted(rows, keys, _by_size(F.col("__v"))))
    if spread:
        first = first.groupBy(*keys, "__part").agg(F.sum("__c").alias("__c"), F.min("__low").alias("__low"), F.max("__high").alias("__high"))
    some = Window.partitionBy(*keys)
    first = first.withColumns({"__n": F.sum(F.when(F.col("__part").isNotNull(), F.col("__c")).otherwise(0)).over(some), "__rows": F.sum("__c").over(some)})
    first = kept(first)
    place = [F.lit(p) * (F.col("__n") - 1) for p in shares]
    asked = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(x), F.ceil(x)) for x in place])))
    state = _holding(first.filter("__part is not null"), keys, "__part", F.transform(asked, lambda k: F.struct(k.alias("rank"), k.alias("at"))))
    state = kept(state.select(*keys, "__c", "__low", "__high", "__at"))

    def within(ranges: DataFrame) -> DataFrame:
        """The values that lie in one of the ranges (keys, __from, __to)."""
        named = ranges.select(*[F.col(k).alias(f"{k}_") for k in keys], "__from", "__to")
        if spread:  # a group's range is looked up in all its panes
            named = named.join(targets, F.col(f"{pane}_").eqNullSafe(F.col("__group")))
        on = [("__pane" if k == pane else f"{k}_") for k in keys]
        met = rows.join(named, _same(keys, on) & F.col("__v").between(F.col("__from"), F.col("__to")))
        return met.withColumn(pane, F.col(f"{pane}_")) if spread else met

    def ranked(counts: DataFrame, ranges: DataFrame, order: str) -> DataFrame:
        """Counts within ranges with the ranks that are looked for there."""
        span = [*keys, "__from", "__to"]
        named = ranges.select(*[F.col(k).alias(f"{k}_") for k in span], F.col("__at").alias("__was"))
        return _holding(counts.join(named, _same(span, [f"{k}_" for k in span])), span, order, F.col("__was"))

    def as_ranges(rows_of: DataFrame) -> DataFrame:
        return rows_of.select(*keys, F.col("__low").alias("__from"), F.col("__high").alias("__to"), "__at")

    while not (wide := state.filter((F.col("__c") > gather) & (F.col("__low") < F.col("__high")))).isEmpty():
        ranges = as_ranges(wide)
        finer = ranked(_counted(within(ranges), [*keys, "__from", "__to"], _part(F.col("__v"), F.col("__from"), F.col("__to"))), ranges, "__part")
        rest = state.filter((F.col("__c") <= gather) | (F.col("__low") == F.col("__high")))
        state = kept(rest.unionByName(finer.select(*keys, "__c", "__low", "__high", "__at")))
    single = state.filter("__low = __high").select(*keys, F.explode("__at").alias("x"), F.col("__low").alias("__v")).select(*keys, "x.rank", "__v")
    ranges = as_ranges(state.filter("__low < __high"))
    values = within(ranges).groupBy(*keys, "__from", "__to", "__v").agg(F.count(F.lit(1)).alias("__c"))
    read = ranked(values, ranges, "__v").select(*keys, F.explode("__at").alias("x"), "__v").select(*keys, "x.rank", "__v")
    # at most two ranks for each share
    found = single.unionByName(read).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "__v"))).alias("__of"))
    found = found.select(*[F.col(k).alias(f"{k}_") for k in keys], "__of")
    groups = first.groupBy(*keys).agg(F.max("__n").alias("__n"), F.max("__rows").alias("__rows")).join(found, _same(keys, [f"{k}_" for k in keys]), "left")
    if not by:  # one group in any case
        groups = groups.agg(F.max("__n").alias("__n"), F.max("__rows").alias("__rows"), F.first("__of").alias("__of")).na.fill(0, ["__n", "__rows"])

    def between(x: Column) -> Column:
        a, b = F.try_element_at("__of", F.floor(x)), F.try_element_at("__of", F.ceil(x))
        return F.when(F.floor(x) == F.ceil(x), a).otherwise((F.ceil(x) - x) * a + (x - F.floor(x)) * b)

    q = F.when(F.col("__n") > 0, F.array(*[between(x) for x in place]))
    # kept, so that whoever joins it sees how small it is: a join by group would put each group in one task
    return kept(groups.select(*[F.col(k).alias(c) for c, k in zip(by, keys, strict=False)], q.alias("q"), F.col("__n").alias("n"), F.col("__rows").alias("rows")))
