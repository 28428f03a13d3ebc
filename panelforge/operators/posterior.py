"""Summaries of each cell's draws."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import draws


def collapse(df: DataFrame, columns: Sequence[str], reducer: Callable[[Column], Column] = draws.mean) -> DataFrame:
    return df.withColumns({c: reducer(F.col(c)) for c in columns})


def analysed(df: DataFrame, keys: Sequence[str], column: str, masses: Sequence[float] = (0.5, 0.95, 0.99), zero_mass: float = 0.3, bins: int = 100) -> DataFrame:
    """(keys, map, zero_share, least, greatest, hdi array<struct<low, high>>) of finite draws; a cell without any fails the job (without_draws finds it)."""
    own = df.select(*keys, draws.some_finite(F.col(column).cast("array<double>")).alias("__x"))
    found = own.withColumn("map", draws.mode(F.col("__x"), zero_mass, bins))
    return found.select(
        *keys, "map", draws.zero_share(F.col("__x")).alias("zero_share"), F.array_min("__x").alias("least"), F.array_max("__x").alias("greatest"), draws.nested_hdi(F.col("__x"), masses, F.col("map")).alias("hdi")
    )


def without_draws(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Keys of cells without a finite draw; must be empty."""
    return df.where(F.coalesce(F.size(draws.finite(F.col(column))), F.lit(0)) <= 0).select(*keys)


def statistics(df: DataFrame, keys: Sequence[str], columns: Sequence[str], quantiles: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """(keys, variable, mean, sd, q05, q50, ...) of finite draws: a row for each cell and variable; a cell without any fails the job (without_draws finds it)."""
    tall = df.unpivot(list(keys), list(columns), "variable", "__x").withColumn("__x", F.array_sort(draws.some_finite(F.col("__x").cast("array<double>"))))
    return tall.select(*keys, "variable", draws.mean(F.col("__x")).alias("mean"), draws.deviation(F.col("__x")).alias("sd"), *(draws.quantile_sorted(F.col("__x"), q).alias(f"q{round(q * 100):02d}") for q in quantiles))


def sampled(df: DataFrame, keys: Sequence[str], column: str, k: int = 5, seed: int = 42) -> DataFrame:
    return df.select(*keys, draws.drawn(F.col(column), k, seed, *(F.col(c) for c in keys)).alias(column))
