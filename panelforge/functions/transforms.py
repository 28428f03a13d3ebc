"""Named feature transforms, replayed per output column.

Each is (column name, arguments) -> DataFrame step or Column. Temporal ones share one window, by place and month, so a chain of
them sorts once. They expect a dense panel. The formulas are stated here; the names are the registry's.
"""

from __future__ import annotations

import ast
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import PanelError


def by_entity(keys: tuple[str, str]):
    return Window.partitionBy(keys[1]).orderBy(keys[0])


def up_to_now(keys: tuple[str, str]):
    return by_entity(keys).rowsBetween(Window.unboundedPreceding, 0)


def last_months(keys: tuple[str, str], w: int):
    return by_entity(keys).rangeBetween(-(w - 1), 0)


def ln(x: Column, keys) -> Column:
    """ln(1 + x)"""
    return F.log1p(x)


def gte(x: Column, keys, threshold: float) -> Column:
    """1 where x >= threshold, else 0; null stays null"""
    return (x >= F.lit(threshold)).cast("double")


def fill(x: Column, keys) -> Column:
    """the last value before, else the first after, within the place"""
    after = by_entity(keys).rowsBetween(0, Window.unboundedFollowing)
    return F.coalesce(F.last(x, ignorenulls=True).over(up_to_now(keys)), F.first(x, ignorenulls=True).over(after))


def replace_na(x: Column, keys, value: float = 0) -> Column:
    return F.coalesce(F.nanvl(x.cast("double"), F.lit(None).cast("double")), F.lit(float(value)))


def tlag(x: Column, keys, k: int = 1) -> Column:
    return F.lag(x, int(k)).over(by_entity(keys))


def time_since(x: Column, keys) -> Column:
    """months since x was last above 0; null before the first time"""
    event = F.max(F.when(x > 0, F.col(keys[0]))).over(up_to_now(keys))
    return (F.col(keys[0]) - event).cast("double")


def decay(x: Column, keys, half_life: float = 12) -> Column:
    """0.5 ** (months since an event / half_life); 0 before the first"""
    return F.coalesce(F.pow(F.lit(0.5), time_since(x, keys) / F.lit(float(half_life))), F.lit(0.0))


def moving_sum(x: Column, keys, w: int) -> Column:
    return F.sum(x).over(last_months(keys, int(w)))


def moving_average(x: Column, keys, w: int) -> Column:
    return F.avg(x).over(last_months(keys, int(w)))


#: Column transforms by registry name.
COLUMN_TRANSFORMS: dict[str, Callable[..., Column]] = {
    "ops.ln": ln,
    "bool.gte": gte,
    "missing.fill": fill,
    "missing.replace_na": replace_na,
    "temporal.tlag": tlag,
    "temporal.time_since": time_since,
    "temporal.decay": decay,
    "temporal.moving_sum": moving_sum,
    "temporal.moving_average": moving_average,
}


#: Rows and columns of a tile: a month's cells of a tile are worked on together, with those just beyond its border.
TILE = 16


def tiles(low: Column, high: Column, side: int) -> Column:
    """The numbers of the tiles that the range from low to high touches."""
    return F.sequence(F.floor(low / side), F.floor(high / side))


def spatial_lag(df: DataFrame, keys: tuple[str, str], column: str, out: str, reach: int = 1, row: str = "row", col: str = "col") -> DataFrame:
    """out: the sum of column over the cells at most reach rows and columns away, the cell itself left out; 0 without neighbours.

    Cells go to their tile and, for their value alone, to those tiles whose border they are near: with reach 1 the panel moves 1.27 times, once.
    What cells give to their neighbours is summed within the tile.
    """
    side = max(TILE, 4 * reach)
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)))
    dealt = df.select(F.col(keys[0]).alias("__time"), F.col(row).alias("__row"), F.col(col).alias("__col"), F.col(column).alias("__v"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("__all"))
    dealt = dealt.select("*", F.explode(tiles(F.col("__row") - reach, F.col("__row") + reach, side)).alias("__tr")).select("*", F.explode(tiles(F.col("__col") - reach, F.col("__col") + reach, side)).alias("__tc"))
    own = (F.floor(F.col("__row") / side) == F.col("__tr")) & (F.floor(F.col("__col") / side) == F.col("__tc"))
    tile = ["__time", "__tr", "__tc"]
    moved = dealt.withColumn("__all", F.when(own, F.col("__all"))).repartition(*tile).withColumn("__s", F.explode(steps))
    still = (F.col("__s.i") == 0) & (F.col("__s.j") == 0)
    # groups lie within a tile, so nothing moves again; a cell that stands there twice is two rows
    near = moved.groupBy(*tile, (F.col("__row") + F.col("__s.i")).alias("__r"), (F.col("__col") + F.col("__s.j")).alias("__c")).agg(
        F.sum(F.when(~still, F.col("__v"))).alias("__sum"), F.collect_list(F.when(still, F.col("__all"))).alias("__cells")
    )
    return near.select(F.explode("__cells").alias("__all"), F.coalesce("__sum", F.lit(0.0)).alias("__sum")).select("__all.*", F.col("__sum").alias(out))


def adjacency_lag(df: DataFrame, keys: tuple[str, str], column: str, out: str, adjacency: DataFrame) -> DataFrame:
    """out: the mean of column over the neighbours that adjacency (place, neighbour) names, filled forward within the place; null before any."""
    other = df.select(keys[0], F.col(keys[1]).alias("neighbour"), F.col(column).alias("__v"))
    near = adjacency.withColumnRenamed("place", keys[1]).join(other, "neighbour").groupBy(*keys).agg(F.avg("__v").alias(out))
    return df.join(near, list(keys), "left").withColumn(out, F.last(out, ignorenulls=True).over(up_to_now(keys)))


def tree_lag(df: DataFrame, keys: tuple[str, str], column: str, out: str, levels: int = 3, row: str = "row", col: str = "col") -> DataFrame:
    """out: sums over blocks of 2, 4, ... cells a side around the cell, each less the block within it, weighted by 1 over the side."""
    found, inner = df.withColumn(out, F.lit(0.0)).withColumn("__inner", F.coalesce(F.col(column), F.lit(0.0))), None
    for k in range(1, levels + 1):
        block = [F.floor(F.col(c) / (1 << k)).alias(f"__{c}") for c in (row, col)]
        sums = df.groupBy(keys[0], *block).agg(F.sum(column).alias("__block"))
        found = found.withColumns({f"__{c}": F.floor(F.col(c) / (1 << k)) for c in (row, col)}).join(sums, [keys[0], f"__{row}", f"__{col}"])
        found = found.withColumn(out, F.col(out) + (F.coalesce("__block", F.lit(0.0)) - F.col("__inner")) / (1 << k)).withColumn("__inner", F.coalesce("__block", F.lit(0.0)))
        found = found.drop("__block", f"__{row}", f"__{col}")
    return found.drop("__inner")


def spacetime_distance(df: DataFrame, keys: tuple[str, str], column: str, out: str, reach: int = 3, months: int = 12, row: str = "row", col: str = "col") -> DataFrame:
    """out: the least sqrt(rows^2 + columns^2 + (months back / months)^2) to a cell whose column is above 0, at most reach rows and
    columns away and at most months back; null without one.

    Cells go to their tile of 2 * reach rows and columns and `months` months, once; events, which are few, go to the tiles that they reach. The least
    distance is found within the tile.
    """
    side, span = max(1, 2 * reach), max(1, months)
    here = [F.floor(F.col(c) / n).alias(f"__b{k}") for k, (c, n) in enumerate(((row, side), (col, side), (keys[0], span)))]
    tile = ["__b0", "__b1", "__b2"]
    cells = df.select(*here, F.monotonically_increasing_id().alias("__id"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("__all"))
    events = df.where(F.col(column) > 0).select(F.col(keys[0]).alias("__t"), F.col(row).alias("__r"), F.col(col).alias("__c"))
    for k, (c, before, after, n) in enumerate((("__r", reach, reach, side), ("__c", reach, reach, side), ("__t", 0, months, span))):
        events = events.select("*", F.explode(tiles(F.col(c) - before, F.col(c) + after, n)).alias(f"__e{k}"))
    back, dr, dc = F.col(f"__all.{keys[0]}") - F.col("__t"), F.col(f"__all.{row}") - F.col("__r"), F.col(f"__all.{col}") - F.col("__c")
    inside = (back >= 0) & (back <= months) & (F.abs(dr) <= reach) & (F.abs(dc) <= reach)
    same = [F.col(f"__b{k}") == F.col(f"__e{k}") for k in range(3)]
    near = cells.join(events, [*same, inside], "left")
    distance = F.sqrt((dr * dr + dc * dc + (back / months) * (back / months)).cast("double"))
    least = near.groupBy(*tile, "__id").agg(F.min(distance).alias("__least"), F.first("__all").alias("__all"))
    return least.select("__all.*", F.col("__least").alias(out))


def literal(text: str):
    """A number, list or the like from its text, or the text itself."""
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def parse_queryset(operations: list[list[dict]]) -> list[tuple[str, list[tuple[str, list]], str]]:
    """(base, [(transform, arguments)], output) for each column; operations are stored last first."""
    found = []
    for chain in operations:
        base, steps, out = None, [], None
        for op in reversed(chain):
            arguments = [literal(a) if isinstance(a, str) else a for a in op.get("arguments") or []]
            if op["namespace"] == "base":
                base = op["name"]
            elif (op["namespace"], op["name"]) == ("util", "rename") or op["name"] == "util.rename":
                out = str(arguments[0])
            else:
                name = op["name"] if "." in op["name"] else f"{op['namespace']}.{op['name']}"
                steps.append((name, arguments))
        if base is None:
            raise PanelError("a column has no base")
        found.append((base, steps, out or base.rsplit(".", 1)[-1]))
    return found


#: Transforms of tables by registry name: (df, keys, column, out, *arguments) -> df.
TABLE_TRANSFORMS: dict[str, Callable[..., DataFrame]] = {"spatial.lag": spatial_lag, "spatial.countrylag": adjacency_lag, "spatial.treelag": tree_lag, "spatial.sptime_dist": spacetime_distance}


def apply_chain(df: DataFrame, keys: tuple[str, str], base: str, steps: list[tuple[str, list]], out: str, extra: dict[str, Callable] | None = None) -> DataFrame:
    """df with out, made from base by the steps. extra holds further transforms of tables; arguments of one may be tables, as the adjacency of `spatial.countrylag`."""
    extra = TABLE_TRANSFORMS | (extra or {})
    df = df.withColumn(out, F.col(base))
    for name, arguments in steps:
        if name in COLUMN_TRANSFORMS:
            df = df.withColumn(out, COLUMN_TRANSFORMS[name](F.col(out), keys, *arguments))
        elif name in extra:
            df = extra[name](df, keys, out, "__made", *arguments).drop(out).withColumnRenamed("__made", out)
        else:
            raise PanelError(f"unknown transform {name}")
    return df


def replay(df: DataFrame, keys: tuple[str, str], columns: list[tuple[str, list, str]], extra: dict[str, Callable] | None = None) -> DataFrame:
    """Outputs whose name has `ged` or `acled` and doesn't start with `raw_` are made anew from raw_<base>; raw columns go at the end."""
    raw = [c for c in df.columns if c.startswith("raw_")]
    if not raw:
        raise PanelError("no raw_ column to replay from")
    for base, steps, out in columns:
        if out.startswith("raw_") or not any(word in out for word in ("ged", "acled")):
            continue
        source = f"raw_{base.rsplit('.', 1)[-1]}"
        if source not in raw:
            raise PanelError(f"{out} needs {source}")
        df = apply_chain(df, keys, source, steps, out, extra)
    return df.drop(*raw)
