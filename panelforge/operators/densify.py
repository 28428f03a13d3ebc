"""Complete panels, and cells in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.draws import resize


def densify(df: DataFrame, keys: tuple[str, str], samples: int = 1) -> DataFrame:
    """Every month of the panel for every place that the last month has; missing numbers 0, missing arrays samples zeros. Keys must not repeat.

    The months, a few hundred, and the last one among them are one small aggregate. Then the panel moves once, by place: a place's rows are its months, which are
    filled where they are, and places that lack the last month go.
    """
    time, place = keys
    months = df.agg(F.array_sort(F.collect_set(time)).alias("__months"))
    rest = [f for f in df.schema.fields if f.name not in keys]
    own = df.where(F.col(time).isNotNull()).groupBy(place).agg(F.map_from_entries(F.collect_list(F.struct(F.col(time), F.struct(*(F.col(f"`{f.name}`") for f in rest))))).alias("__rows"))
    kept = own.join(F.broadcast(months)).where(F.map_contains_key("__rows", F.element_at("__months", -1)))
    cells = kept.select(place, "__rows", F.explode("__months").alias(time)).select(time, place, F.element_at("__rows", F.col(time)).alias("__row"))
    filled = {}
    for f in rest:
        value = F.col("__row")[f.name]
        if isinstance(f.dataType, T.ArrayType):
            value = F.coalesce(value, F.array_repeat(F.lit(0.0), samples).cast(f.dataType))
        elif isinstance(f.dataType, T.NumericType):
            value = F.coalesce(value, F.lit(0).cast(f.dataType))
        filled[f.name] = value
    return cells.select(*(filled[c].alias(c) if c in filled else F.col(c) for c in df.columns))


def widen(df: DataFrame, columns: Sequence[str], samples: int) -> DataFrame:
    """Arrays shorter than samples repeated in turn up to that length."""
    return df.withColumns({c: resize(F.col(c), samples) for c in columns})


def missing_cells(cells: DataFrame) -> DataFrame:
    """(variable, n): null or NaN values of long cells; must be empty before a tensor is made."""
    bad = F.col("value").isNull() | F.isnan("value")
    return cells.where(bad).groupBy("variable").agg(F.count(F.lit(1)).alias("n"))


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, repeated ones included; must be empty after a round trip. Both tables are grouped once, together."""
    names = left.columns
    rows = left.withColumn("__n", F.lit(1)).unionByName(right.select(*names).withColumn("__n", F.lit(-1)))
    uneven = rows.groupBy(*names).agg(F.sum("__n").alias("__n")).where("__n <> 0")
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.abs("__n")))
    return uneven.select(*names, F.when(F.col("__n") > 0, "left").otherwise("right").alias("side"), times.alias("__n")).drop("__n")


def sizes(df: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """(n_times, n_places, n_features)"""
    return df.agg(F.countDistinct(keys[0]).alias("n_times"), F.countDistinct(keys[1]).alias("n_places")).withColumn("n_features", F.lit(len(df.columns) - 2).cast("long"))
