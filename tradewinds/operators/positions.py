"""Rows at given ranks, and what follows from them: exact percentiles and ntiles.

A window over a whole table sorts it in one task. Here rows are selected by counting, and never sorted or
moved as a whole:

1. A quantile sketch per group, merged map-side, gives brackets of values around the wanted ranks. Its error
   is bounded, so a bracket is sure to hold its rank, and it holds a few thousandths of the rows.
2. One pass counts the rows below, between and above the brackets, and the rows per value inside them. That
   gives the value at each rank, and its place among equal values.
3. Where a row is wanted and not only its value, the ids of the rows with a boundary value are ranked. Where
   very many share one, their ids are counted by prefixes first, until few are left to rank.

Only tables of a few rows per group are written in between, which tells Spark their size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewinds.sources.staging import stage

#: Steps of the grid of quantiles, and the sketch's accuracy: its error (1 / ACCURACY) must stay below a step.
GRID = 1_000
ACCURACY = 20_000
#: Rows that may share a boundary value before their ids are counted by prefixes.
RANKED_ROWS = 1_000_000
_PREFIX = 4


def _sortable(value: Column) -> Column:
    """Doubles in the order of `value` without null (which comes first) and NaN (last); may join neighbours."""
    return F.when(value.isNull(), F.lit(float("-inf"))).when(F.isnan(value), F.lit(float("inf"))).otherwise(value)


def _brackets(rows: DataFrame, ranks: Callable[[Column], Column]) -> DataFrame:
    """Per group: its rows, the wanted ranks, and an interval of `key` for each that is sure to hold it."""
    # One literal, cast: as many literals would each be a call and a node of the plan.
    shares = F.split(F.lit(",".join(str(i / GRID) for i in range(GRID + 1))), F.lit(",")).cast("array<double>")
    total = F.col("total")

    def around(rank: Column) -> Column:
        low = F.floor((rank - 1) * GRID / total).cast("int") - 1
        high = F.ceil(rank * GRID / total).cast("int") + 1
        return F.struct(
            F.when(low < 0, F.lit(float("-inf"))).otherwise(F.get("grid", F.greatest(low, F.lit(0)))).alias("low"),
            F.when(high > GRID, F.lit(float("inf"))).otherwise(F.get("grid", F.least(high, F.lit(GRID)))).alias("high"),
        )

    found = rows.groupBy("grp").agg(
        F.count(F.lit(1)).alias("total"), F.percentile_approx("key", shares, ACCURACY).alias("grid")
    )
    found = found.withColumn("wanted", ranks(total)).where(F.size("wanted") > 0)
    held = found.withColumn("held", F.transform("wanted", around))
    edges = F.array_distinct(F.flatten(F.transform("held", lambda h: F.array(h["low"], h["high"]))))
    return held.select("grp", "total", "wanted", "held", F.array_sort(edges).alias("edges"))


def values_at(df: DataFrame, ranks: Callable[[Column], Column]) -> DataFrame:
    """The `value` (double) of the rows of each `grp` at the 1-based `ranks(group size)`, ascending, nulls first.

    Returns a written table `grp, total, rank, value, place, copies`: the rank's row is the `place`-th of
    `copies` rows with this value.
    """
    rows = df.select("grp", "value", _sortable(F.col("value")).alias("key"))
    brackets = stage(_brackets(rows, ranks), "brackets")
    key = F.col("key")
    # Zones by the edges of brackets: an even one lies between two edges, an odd one is an edge itself. A zone
    # is inside of a bracket or outside as a whole.
    below = F.size(F.filter("edges", lambda e: e < key))
    zone = 2 * below + F.array_contains("edges", key).cast("int")
    inside = F.exists("held", lambda h: (h["low"] <= key) & (key <= h["high"]))
    counts = (
        rows.join(brackets.select("grp", "held", "edges"), "grp")
        .select("grp", zone.alias("zone"), inside.alias("inside"), F.when(inside, F.col("value")).alias("value"))
        .groupBy("grp", "zone", "inside", "value").agg(F.count(F.lit(1)).alias("copies"))
    )
    ahead = Window.partitionBy("grp").orderBy("zone")
    zones = counts.groupBy("grp", "zone").agg(F.sum("copies").alias("n"))
    zones = zones.select("grp", "zone", (F.sum("n").over(ahead) - F.col("n")).alias("before"))
    # A window per bracket, over its distinct values.
    in_zone = Window.partitionBy("grp", "zone").orderBy("value")
    upto = F.col("before") + F.sum("copies").over(in_zone)
    ranked = counts.where("inside").join(zones, ["grp", "zone"]).withColumn("upto", upto)
    held = F.filter("wanted", lambda r: (r > F.col("upto") - F.col("copies")) & (r <= F.col("upto")))
    return stage(
        ranked.join(brackets.select("grp", "total", "wanted"), "grp")
        .withColumn("rank", F.explode(held))
        .select("grp", "total", "rank", "value", (F.col("rank") - F.col("upto") + F.col("copies")).alias("place"), "copies"),
        "values",
    )


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition &= a[c].eqNullSafe(b[c])
    return condition


def rows_at(df: DataFrame, ranks: Callable[[Column], Column]) -> DataFrame:
    """The rows (`grp, total, rank, value, id`) of each `grp` at the 1-based ranks in the order of value, id.

    `df` has a non-null `grp`, a double `value` and a text `id`.
    """
    found = values_at(df, ranks).withColumn("prefix", F.lit(""))
    while (found.agg(F.max("copies")).first()[0] or 0) > RANKED_ROWS:
        narrowed = _by_prefix(df, found)
        if narrowed is None:
            break
        found = narrowed
    wanted = found.groupBy("grp", "value", "prefix").agg(
        F.collect_set(F.struct("place", "rank")).alias("wanted"), F.max("total").alias("total")
    )
    near = df.join(wanted.alias("w"), _same(df, wanted, ["grp", "value"]) & F.startswith(df["id"], F.col("w.prefix")))
    alike = Window.partitionBy(df["grp"], df["value"], F.col("w.prefix")).orderBy(df["id"])
    return (
        near.select(df["grp"], "w.total", df["value"], df["id"], "w.wanted", F.row_number().over(alike).alias("at"))
        .withColumn("hit", F.explode(F.filter("wanted", lambda x: x["place"] == F.col("at"))))
        .select("grp", "total", "hit.rank", "value", "id")
    )


def _by_prefix(df: DataFrame, found: DataFrame) -> DataFrame | None:
    """`found` with longer prefixes of the ids at its places, the places counted within them; None if none is left to try.

    A pass finds how far all ids of a place agree, another counts them by the characters after that.
    """
    keys = ["grp", "value", "prefix"]
    spans = found.select(*keys).distinct()

    def near(spans: DataFrame) -> DataFrame:
        held = F.startswith(df["id"], F.col("s.prefix"))
        return df.join(spans.alias("s"), _same(df, spans, ["grp", "value"]) & held)

    ends = near(spans).groupBy(df["grp"], df["value"], F.col("s.prefix")).agg(
        F.min(df["id"]).alias("first"), F.max(df["id"]).alias("last")
    )
    agree = F.size(F.filter(
        F.sequence(F.lit(1), F.greatest(F.length("first"), F.lit(1))),
        lambda n: (n <= F.length("first")) & (F.substr("first", F.lit(1), n) == F.substr("last", F.lit(1), n)),
    ))
    ends = stage(ends.withColumn("agree", agree), "ends")
    if not ends.where("first <> last").limit(1).count():
        return None
    longer = near(ends).select(
        df["grp"], df["value"], "s.prefix", F.substr(df["id"], F.lit(1), F.col("s.agree") + _PREFIX).alias("longer")
    )
    counts = longer.groupBy(*keys, "longer").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*keys).orderBy("longer")
    counts = counts.withColumn("upto", F.sum("n").over(order))
    places = found.join(counts.withColumnsRenamed({k: f"c_{k}" for k in keys}), (
        F.col("grp").eqNullSafe(F.col("c_grp")) & F.col("value").eqNullSafe(F.col("c_value"))
        & F.col("prefix").eqNullSafe(F.col("c_prefix"))
        & (F.col("place") > F.col("upto") - F.col("n")) & (F.col("place") <= F.col("upto"))
    ))
    return stage(places.select(
        "grp", "total", "rank", "value", (F.col("place") - F.col("upto") + F.col("n")).alias("place"),
        F.col("n").alias("copies"), F.col("longer").alias("prefix"),
    ), "places")


def percentiles(df: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Exact percentiles of `value` per `grp`, linear between neighbours.

    One row per group with a column for each entry of `shares` (name -> 0..1).
    """
    numbers = df.where(F.col("value").isNotNull()).select("grp", F.col("value").cast("double").alias("value"))

    def at(total: Column, share: float) -> Column:
        return (total - 1) * F.lit(float(share))

    def ranks(total: Column) -> Column:
        ends = [f(at(total, s)) + 1 for s in shares.values() for f in (F.floor, F.ceil)]
        return F.array_distinct(F.array(*[e.cast("bigint") for e in ends]))

    picks = values_at(numbers, ranks)

    def value_at(share: float) -> Column:
        place = at(F.col("total"), share)
        low = F.max(F.when(F.col("rank") == F.floor(place) + 1, F.col("value")))
        high = F.max(F.when(F.col("rank") == F.ceil(place) + 1, F.col("value")))
        part = F.max(place - F.floor(place))
        return low + (high - low) * part

    return picks.groupBy("grp").agg(*[value_at(s).alias(name) for name, s in shares.items()])


def ntile_cuts(df: DataFrame, tiles: int | Column) -> DataFrame:
    """Per `grp`, the sorted first rows (`value`, `id`) of tiles 2..`tiles`, as `cuts`.

    A group has fewer than `tiles` cuts, however large it is. `tiles` may depend on `grp`.
    """
    last = F.lit(tiles) - 1 if isinstance(tiles, int) else tiles - 1

    def starts(total: Column) -> Column:
        small, extra = F.floor(total / (last + 1)), total % (last + 1)
        firsts = F.transform(
            F.sequence(F.lit(1), last), lambda t: (t * small + F.least(t, extra) + 1).cast("bigint")
        )
        return F.filter(firsts, lambda start: start <= total)

    return rows_at(df, starts).groupBy("grp").agg(
        F.sort_array(F.collect_list(F.struct("value", "id"))).alias("cuts")
    )


def tile_of(value: Column, id_: Column, cuts: Column) -> Column:
    """The tile of a row, given the `cuts` of its group (null: one tile only)."""
    key = F.struct(value.cast("double").alias("value"), id_.alias("id"))
    return F.coalesce(F.size(F.filter(cuts, lambda cut: cut <= key)), F.lit(0)) + 1
