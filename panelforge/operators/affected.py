"""Which cells a correction changes through a chain of transforms, and the replay of these alone.

Cells are ranges (place, first, last): so many months of a place, a row for each place. A transform's output at a month depends on its
input some months before and after, of the place itself or of others; so a change spreads by that reach, and what a cell needs
lies within the same reach the other way. The outputs that change are computed from the cells that they need, and from nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.transforms import replay

#: Beyond all months.
EVER = 1_000_000


@dataclass(frozen=True)
class Reach:
    """A change of a cell is felt so many months earlier and later, at its own place and at those that spread gives.

    spread takes (place, first, last) and the panel's places (place, row, col), and gives the same columns; back is that from places to what they need, if it isn't the same.
    """

    earlier: int = 0
    later: int = 0
    spread: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    back: Callable[[DataFrame, DataFrame], DataFrame] | None = None


def hull(ranges: DataFrame) -> DataFrame:
    """One range for each place, from its first month to its last."""
    return ranges.groupBy("place").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def within(reach: int) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """To all places at most so many rows and columns away."""
    away = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1))))

    def spread(ranges: DataFrame, places: DataFrame) -> DataFrame:
        at = ranges.join(places, "place").withColumn("__d", away).select((F.col("row") + F.col("__d.i")).alias("row"), (F.col("col") + F.col("__d.j")).alias("col"), "first", "last")
        at = at.groupBy("row", "col").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        return at.join(places, ["row", "col"]).select("place", "first", "last")

    return spread


def in_block(levels: int) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """To all places of the same block of 2 ** levels cells a side."""
    block = [F.floor(F.col(c) / (1 << levels)).alias(f"__{c}") for c in ("row", "col")]

    def spread(ranges: DataFrame, places: DataFrame) -> DataFrame:
        blocks = ranges.join(places, "place").select(*block, "first", "last").groupBy("__row", "__col").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        return places.select("place", *block).join(blocks, ["__row", "__col"]).select("place", "first", "last")

    return spread


def beside(adjacency: DataFrame, source: str, target: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """From the places of one column of adjacency to those of the other, and to themselves."""
    pairs = adjacency.select(F.col(source).alias("place"), F.col(target).alias("__to"))

    def spread(ranges: DataFrame, places: DataFrame) -> DataFrame:
        return hull(ranges.join(pairs, "place").select(F.col("__to").alias("place"), "first", "last").unionByName(ranges))

    return spread


#: By registry name, from the transform's arguments. What isn't here is felt everywhere.
REACHES: dict[str, Callable[..., Reach]] = {
    "ops.ln": lambda: Reach(),
    "bool.gte": lambda threshold: Reach(),
    "missing.replace_na": lambda value=0: Reach(),
    "missing.fill": lambda: Reach(EVER, EVER),
    "temporal.tlag": lambda k=1: Reach(max(0, -int(k)), max(0, int(k))),
    "temporal.time_since": lambda: Reach(0, EVER),
    "temporal.decay": lambda half_life=12: Reach(0, EVER),
    "temporal.moving_sum": lambda w: Reach(0, int(w) - 1),
    "temporal.moving_average": lambda w: Reach(0, int(w) - 1),
    "spatial.lag": lambda reach=1, *names: Reach(0, 0, within(reach)),
    "spatial.countrylag": lambda adjacency: Reach(0, EVER, beside(adjacency, "neighbour", "place"), beside(adjacency, "place", "neighbour")),
    "spatial.treelag": lambda levels=3, *names: Reach(0, 0, in_block(levels)),
    "spatial.sptime_dist": lambda reach=3, months=12, *names: Reach(0, months, within(reach)),
}


def everywhere(ranges: DataFrame, places: DataFrame) -> DataFrame:
    """All places at all times, if there is a range at all."""
    return places.join(F.broadcast(ranges.limit(1).select(F.lit(True).alias("__any")))).select("place", F.lit(-EVER).alias("first"), F.lit(EVER).alias("last"))


def reach_of(name: str, arguments: Sequence) -> Reach:
    return REACHES[name](*arguments) if name in REACHES else Reach(EVER, EVER, everywhere)


def spread(ranges: DataFrame, places: DataFrame, steps: Sequence[tuple[str, list]]) -> DataFrame:
    """The cells at which the outputs of a chain change, if its input changes in ranges."""
    for name, arguments in steps:
        r = reach_of(name, arguments)
        wider = ranges.select("place", (F.col("first") - r.earlier).alias("first"), (F.col("last") + r.later).alias("last"))
        ranges = r.spread(wider, places) if r.spread else wider
    return ranges


def needed(ranges: DataFrame, places: DataFrame, steps: Sequence[tuple[str, list]]) -> DataFrame:
    """The cells from which a chain's outputs in ranges are computed; with each step, the cells of the step before stay in it."""
    for name, arguments in reversed(steps):
        r = reach_of(name, arguments)
        wider = ranges.select("place", (F.col("first") - r.later).alias("first"), (F.col("last") + r.earlier).alias("last"))
        other = r.back or r.spread
        ranges = hull(other(wider, places).unionByName(wider)) if other else wider
    return ranges


def places_of(panel: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """(place, row, col) of a panel; row and column are null if it has none."""
    own = [F.col(c) if c in panel.columns else F.lit(None).cast("int") for c in ("row", "col")]
    return panel.select(F.col(keys[1]).alias("place"), own[0].alias("row"), own[1].alias("col")).distinct()


def changed_ranges(cells: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """The ranges of cells."""
    return hull(cells.select(F.col(keys[1]).alias("place"), F.col(keys[0]).alias("first"), F.col(keys[0]).alias("last")))


def in_ranges(df: DataFrame, ranges: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """The rows of df in ranges, which have one row a place."""
    own = ranges.select(F.col("place").alias("__place"), F.col("first").alias("__first"), F.col("last").alias("__last"))
    inside: Column = (F.col(keys[1]) == F.col("__place")) & F.col(keys[0]).between(F.col("__first"), F.col("__last"))
    return df.join(own, inside, "left_semi")


def replayed_cells(panel: DataFrame, ranges: DataFrame, keys: tuple[str, str], columns: Sequence[tuple[str, list, str]], extra: dict[str, Callable] | None = None) -> tuple[DataFrame, DataFrame]:
    """(the cells of replay(panel) that a change of raw values in ranges touches, the cells that they were computed from).

    panel is the corrected one, dense as for replay. Windows and joins see the second table alone; it and the first grow with the ranges and the reach of
    the transforms, not with the panel.
    """
    places = places_of(panel, keys)
    chains = [steps for _, steps, out in columns if not out.startswith("raw_")]
    touched = ranges
    for steps in chains:
        touched = touched.unionByName(spread(ranges, places, steps))
    touched = hull(touched)
    wanted = touched
    for steps in chains:
        wanted = wanted.unionByName(needed(touched, places, steps))
    own = in_ranges(panel, hull(wanted), keys)
    return in_ranges(replay(own, keys, list(columns), extra), touched, keys), own
