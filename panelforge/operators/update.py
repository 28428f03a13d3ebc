"""Corrections of a panel, and the features that follow from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.transforms import replay
from ..schema import PanelError


def overwrite(panel: DataFrame, new: DataFrame, keys: tuple[str, str], months: Sequence[int] | None = None) -> DataFrame:
    """panel with the values that new has for the same cells, in these months (all if None); nulls and new cells change nothing."""
    shared = [c for c in new.columns if c not in keys and c in panel.columns]
    if not shared:
        raise PanelError("the update shares no column with the panel")
    chosen = new if months is None else new.where(F.col(keys[0]).isin(list(months)))
    renamed = chosen.select(*keys, *(F.col(c).alias(f"__{c}") for c in shared))
    return panel.join(renamed, list(keys), "left").withColumns({c: F.coalesce(f"__{c}", c) for c in shared}).select(*panel.columns)


def require_fresh(panel: DataFrame, new: DataFrame, key: str = "month_id") -> None:
    """The update must not end before the panel does."""
    a, b = panel.agg(F.max(key)).first()[0], new.agg(F.max(key)).first()[0]
    if a is not None and (b is None or b < a):
        raise PanelError(f"the update ends at {b}, the panel at {a}")


def unfit(panel: DataFrame, new: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """(problem, at) of an update: the panel has no raw_ column to replay from, they share no column, or the update ends before the panel does (at its last month); must be empty."""
    last = panel.agg(F.max(keys[0]).alias("__panel")).join(F.broadcast(new.agg(F.max(keys[0]).alias("__new"))))
    early = F.when(F.col("__panel").isNotNull() & (F.col("__new").isNull() | (F.col("__new") < F.col("__panel"))), F.struct(F.lit("ends before the panel").alias("problem"), F.col("__new").alias("at")))
    none = F.lit(None).cast(new.schema[keys[0]].dataType).alias("at")
    known = [early]
    if not any(c.startswith("raw_") for c in panel.columns):
        known.append(F.struct(F.lit("no raw column").alias("problem"), none))
    if not any(c in panel.columns for c in new.columns if c not in keys):
        known.append(F.struct(F.lit("no shared column").alias("problem"), none))
    return last.select(F.explode(F.array_compact(F.array(*known))).alias("x")).select("x.*")


def update_and_replay(panel: DataFrame, new: DataFrame, keys: tuple[str, str], columns, months: Sequence[int] | None = None, extra=None) -> DataFrame:
    """Raw columns overwritten, then derived columns made anew from them."""
    require_fresh(panel, new, keys[0])
    return replay(overwrite(panel, new, keys, months), keys, columns, extra)
