"""Ensemble pooling: several models' forecasts, one row for each model and cell, become one.

Forecasts are long: (model, keys, forecast), forecast a number or an array of draws. One shuffle on the keys brings a cell's
models together; each model has one row for a cell, so groups are as large as the ensemble.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import digest, let, number, zip_sum
from ..schema import PanelError


def normalised_weights(models: Sequence[str], given: dict[str, float] | None) -> dict[str, float]:
    """Weights that sum to 1. None given: equal. What the given ones leave goes to the others in equal parts; if all are given, they are rescaled."""
    given = {m: w for m, w in (given or {}).items() if w is not None}
    unknown = set(given) - set(models)
    if unknown:
        raise PanelError(f"weights for unknown models {sorted(unknown)}")
    if not given:
        return dict.fromkeys(models, 1 / len(models))
    if any(w < 0 or w >= 1 for w in given.values()) and len(models) > 1:
        raise PanelError("each weight must be from 0 to below 1")
    rest, total = [m for m in models if m not in given], sum(given.values())
    if total > 1 + 1e-9:
        raise PanelError(f"weights sum to {total}")
    if rest and total >= 1 - 1e-9:
        raise PanelError(f"nothing is left for {rest}")
    if rest:
        return {m: given.get(m, (1 - total) / len(rest)) for m in models}
    if total <= 0:
        raise PanelError("weights sum to 0")
    return {m: given[m] / total for m in models}


def weight_of(weights: dict[str, float]) -> Column:
    pairs = [x for m, w in weights.items() for x in (F.lit(m), F.lit(float(w)))]
    return F.element_at(F.create_map(*pairs), F.col("model"))


def complete(forecasts: DataFrame, keys: Sequence[str], models: int) -> DataFrame:
    """Cells that all models have: the inner join of the models."""
    full = forecasts.groupBy(*keys).agg(F.countDistinct("model").alias("__n")).where(F.col("__n") == models).select(*keys)
    return forecasts.join(full, list(keys), "left_semi")


def models_there(models: Sequence[str]) -> Column:
    """How many of the models a group has, from one bit for each. A distinct count would group the rows by model as well, and move them twice."""
    parts = [list(models[i : i + 62]) for i in range(0, len(models), 62)]
    bits = [F.coalesce(*(F.when(F.col("model") == m, F.lit(1 << i).cast("long")) for i, m in enumerate(part))) for part in parts]
    return reduce(lambda a, b: a + b, (F.coalesce(F.bit_count(F.bit_or(b)), F.lit(0)) for b in bits), F.lit(0))


def pool_points(forecasts: DataFrame, keys: Sequence[str], models: Sequence[str], method: str = "mean", weights: dict[str, float] | None = None, use_weights: bool = False) -> DataFrame:
    """(keys, forecast) of the cells that all models have.

    mean leaves nulls out; a weighted mean counts them as 0; median is the mean of the middle two; min and max leave nulls out. Weights go with the mean only.
    """
    if use_weights and method != "mean":
        raise PanelError(f"weights can't be used with {method}")
    x = F.col("forecast")
    if method not in ("mean", "median", "min", "max"):
        raise PanelError(f"unknown method {method}")
    pooled = F.sum(weight_of(normalised_weights(models, weights)) * F.coalesce(x, F.lit(0.0))) if use_weights else {"mean": F.avg, "median": F.median, "min": F.min, "max": F.max}[method](x)
    cells = forecasts.where(F.col("model").isin(list(models))).groupBy(*keys).agg(pooled.alias("forecast"), models_there(models).alias("__n"))
    return cells.where(F.col("__n") == len(models)).drop("__n")


def side_by_side(forecasts: DataFrame, keys: Sequence[str], models: Sequence[str]) -> DataFrame:
    """(keys, m0, m1, ...): the arrays of each model; cells that a model lacks are left out."""
    wide = forecasts.where(F.col("model").isin(list(models))).groupBy(*keys).agg(*(F.max(F.when(F.col("model") == m, F.struct("forecast"))).alias(f"m{i}") for i, m in enumerate(models)))
    present = wide.where(" and ".join(f"m{i} is not null" for i in range(len(models))))
    return present.select(*keys, *(F.col(f"m{i}.forecast").alias(f"m{i}") for i in range(len(models))))


def pool_draws(forecasts: DataFrame, keys: Sequence[str], models: Sequence[str], method: str, weights: dict[str, float] | None = None, seed: int = 42) -> DataFrame:
    """(keys, forecast array) of the cells that all models have.

    - resample: each of S draws comes from a model picked by weight and one of its draws, by a hash of seed, keys and place.
    - vincent: the weighted mean of the models' quantile functions, which are their sorted draws.
    - concat: all models' draws, in order of models.
    - aligned: the mean of the models draw by draw.

    vincent and aligned need as many draws from each model; a cell without fails the job that computes it (pool_conflicts finds such cells).
    """
    shares = normalised_weights(models, weights)
    own = [F.col(f"m{i}") for i in range(len(models))]
    wide = side_by_side(forecasts, keys, models)
    if method in ("vincent", "aligned"):
        sizes = [F.size(a) for a in own]
        # null where a model lacks the cell: the optimizer may test this before such cells are left out
        uneven = reduce(lambda a, b: a | b, (sizes[0] != n for n in sizes[1:]), F.lit(False))
        own[0] = F.when(uneven, F.raise_error(F.lit("models have different numbers of draws for a cell")).cast(wide.schema["m0"].dataType)).otherwise(own[0])
    if method == "vincent":
        pooled = zip_sum([F.array_sort(a) for a in own], [shares[m] for m in models])
    elif method == "concat":
        pooled = F.concat(*own)
    elif method == "aligned":
        pooled = F.transform(zip_sum(own, [1.0] * len(own)), lambda v: v / len(own))
    elif method == "resample":
        edges, total = [], 0.0
        for m in models:
            total += shares[m]
            edges.append(total)

        def drawn(j: Column) -> Column:
            # a lambda's expressions are computed wherever they stand, so the hash and what it picks are bound once for a draw
            def of(unit: Column) -> Column:
                which = own[-1]
                for i in reversed(range(len(models) - 1)):
                    which = F.when(unit < edges[i], own[i]).otherwise(which)
                return which

            def picked(h: Column) -> Column:
                chosen = let(number(0, h) / float(1 << 32), of)
                return let(chosen, lambda x: F.get(x, F.pmod(number(1, h), F.size(x)).cast("int")))

            return let(digest(seed, *(F.col(k) for k in keys), j), picked)

        pooled = F.transform(F.sequence(F.lit(0), F.size(own[0]) - 1), drawn)
    else:
        raise PanelError(f"unknown method {method}")
    return wide.select(*keys, pooled.alias("forecast"))


def pool_conflicts(forecasts: DataFrame, keys: Sequence[str], models: Sequence[str]) -> DataFrame:
    """(problem, n): cells that some model lacks (`missing`), that a model has twice (`repeated`), or for which models have different numbers of draws (`draws`).

    Must be empty before draws are concatenated or averaged.
    """
    cells = forecasts.where(F.col("model").isin(list(models))).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("model").alias("models"), F.min(F.size("forecast")).alias("least"), F.max(F.size("forecast")).alias("most"))
    checks = (("missing", F.col("models") < len(models)), ("repeated", F.col("rows") > F.col("models")), ("draws", F.col("least") != F.col("most")))
    counts = cells.agg(*(F.count(F.when(bad, 1)).alias(name) for name, bad in checks))
    return counts.unpivot([], [name for name, _ in checks], "problem", "n").where("n > 0")


def pool_origins(forecasts: DataFrame, keys: Sequence[str], models: Sequence[str], method: str = "mean", **options) -> DataFrame:
    """Pools of all targets and rolling origins at once: target and origin are further keys. An origin that a model lacks fails the job (origin_gaps finds it).

    Which models an origin has is one small aggregate beside the pooling. Its part of the result has no rows, and no cell is moved to meet it.
    """
    own = forecasts.where(F.col("model").isin(list(models)))
    pooled = pool_points(forecasts, ["target", "origin", *keys], models, method, **options)
    there = own.groupBy("target", "origin").agg(models_there(models).alias("__models"))
    # the message names the count too: of the keys alone, the optimizer may test it before rows are grouped
    error = F.raise_error(F.format_string("a model lacks origin %s of %s, which has %s", F.col("origin").cast("string"), F.col("target"), F.col("__models").cast("string")))
    gaps = there.where(F.when(F.col("__models") < len(models), error.cast("boolean")).otherwise(F.lit(False)))
    rest = [F.lit(None).cast(pooled.schema[c].dataType).alias(c) for c in (*keys, "forecast")]
    return gaps.select("target", "origin", *rest).unionByName(pooled.select("target", "origin", *keys, "forecast"))


def origin_gaps(forecasts: DataFrame, models: int) -> DataFrame:
    """(target, origin, n_models) of the origins that a model lacks; must be empty before origins are pooled."""
    return forecasts.groupBy("target", "origin").agg(F.countDistinct("model").alias("n_models")).where(F.col("n_models") < models)
