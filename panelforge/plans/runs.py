"""Whole runs, each one lazy plan: an audited panel, an evaluation, an ensemble forecast."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.transforms import apply_chain
from ..operators import align, audits, evaluate, pool, reconcile
from ..operators.densify import densify
from ..operators.select import months
from ..schema import PanelError, normalise_grid_key, null_for_nan
from .partitions import Step, prepared_actuals


def audited_panel(raw: DataFrame, keys: tuple[str, str], first: int, last: int, columns: Sequence[tuple[str, list, str]] = ()) -> DataFrame:
    """Range, names, missing values, gaps and derived columns, in this order; the months must all be there."""
    panel = densify(null_for_nan(months(normalise_grid_key(raw), first, last, keys[0])), keys)
    for base, steps, out in columns:
        panel = apply_chain(panel, keys, base, steps, out)
    audits.require_empty(audits.month_coverage(panel, first, last, keys[0]), "months")
    return panel


def evaluation(forecasts: DataFrame, actuals: DataFrame, base: int, metrics: Sequence[str], steps: int = 36, shifts: int = 12, prepare: Sequence[Step] = ()) -> DataFrame:
    """Scores by step, month and origin with their means, of forecasts (origin, time, unit, y_pred) whose months must lie in their origin's window.

    prepare holds hooks that change the actuals before they are scored.
    """
    actuals = prepared_actuals(actuals, prepare)
    table = align.step_table(forecasts.sparkSession, base, steps, shifts)
    audits.require_empty(align.outside_window(forecasts, table), "months outside their origin's window")
    aligned = align.align(forecasts, actuals)
    audits.require_rows(aligned, "forecasts and actuals share no cell")
    return evaluate.with_means(evaluate.scored(align.with_steps(aligned, table), metrics))


#: A reconciler takes cells (month_id, grid_id, country_id, value) and countries (month_id, country_id, total) and gives cells of the same columns.
Reconciler = Callable[[DataFrame, DataFrame], DataFrame]


def unchanged(cells: DataFrame, countries: DataFrame) -> DataFrame:
    """Cells as they are."""
    return cells.select("month_id", "grid_id", "country_id", "value")


def aligned_draws(samples: int) -> Reconciler:
    """Scales so many draws, each to the total of the same draw."""
    return lambda cells, countries: reconcile.reconcile_draws(cells, countries, samples)


#: Reconcilers by the name that the mode column gives.
RECONCILERS: dict[str, Reconciler] = {"proportional": reconcile.reconcile_points, "none": unchanged}


def reconciled(cells: DataFrame, countries: DataFrame, reconciler: str | tuple[str, Reconciler] = "proportional") -> DataFrame:
    """What a reconciler, one of RECONCILERS or a name and a function, makes of the cells, with its name as mode."""
    if isinstance(reconciler, str):
        if reconciler not in RECONCILERS:
            raise PanelError(f"unknown reconciler {reconciler}")
        reconciler = reconciler, RECONCILERS[reconciler]
    mode, scale = reconciler
    return scale(cells, countries).withColumn("mode", F.lit(mode))


def ensemble_forecast(
    forecasts: DataFrame,
    keys: Sequence[str],
    models: Sequence[str],
    hierarchy: DataFrame | None = None,
    countries: DataFrame | None = None,
    method: str = "mean",
    weights: dict[str, float] | None = None,
    reconciler: str | tuple[str, Reconciler] = "proportional",
    save: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Models pooled, scaled to country totals if a hierarchy is given, and saved: (keys, value) or (month_id, grid_id, country_id, value).

    Forecasts are numbers, or arrays of draws with a method of pool_draws; country totals of draws are arrays then, and the reconciler
    is by default that of draws. save gives the saved table back.
    """
    if forecasts.schema["forecast"].dataType.typeName() == "array":
        pooled = pool.pool_draws(forecasts, keys, models, method, weights)
    else:
        pooled = pool.pool_points(forecasts, keys, models, method, weights, use_weights=weights is not None)
    pooled = pooled.withColumnRenamed("forecast", "value")
    if hierarchy is None:
        return save(pooled)
    if countries is None:
        raise PanelError("a hierarchy needs country totals")
    return save(reconciled(reconcile.with_country(pooled, hierarchy), countries, reconciler).drop("mode"))


def common_targets(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns of both tables that aren't keys, in the order of the first."""
    keys = {"month_id", "year_id", "grid_id", "priogrid_id", "country_id"}
    return [c for c in left.columns if c in right.columns and c not in keys]


def draws_for_all(cells: DataFrame, samples: int) -> DataFrame:
    """Numbers as arrays of one, arrays of one as so many equal draws."""
    return cells.withColumn("value", F.when(F.size("value") == 1, F.array_repeat(F.get("value", F.lit(0)), samples)).otherwise(F.col("value")))
