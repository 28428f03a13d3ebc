"""Subsets of panels: months, places, columns, draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import cleaned, pick
from ..schema import PanelError, prediction_columns


def months(df: DataFrame, first: int, last: int, key: str = "month_id") -> DataFrame:
    """Rows of the months first to last, both included; the filter reaches the scan."""
    return df.where(F.col(key).between(first, last))


def split(df: DataFrame, train: tuple[int, int], test: tuple[int, int], key: str = "month_id") -> tuple[DataFrame, DataFrame]:
    """(train, test); overlapping ranges are an error."""
    if train[0] <= test[1] and test[0] <= train[1]:
        raise PanelError(f"train {train} and test {test} overlap")
    return months(df, *train, key), months(df, *test, key)


def rows_of(df: DataFrame, column: str, ids: Sequence[int] | DataFrame) -> DataFrame:
    """Rows whose column is among ids; a DataFrame of ids (one column) is semi-joined."""
    if isinstance(ids, DataFrame):
        return df.join(ids.toDF(column), column, "left_semi")
    return df.where(F.col(column).isin(list(ids)))


def columns_of(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise PanelError(f"unknown columns {unknown}")
    return df.select(*keys, *names)


def draws_of(df: DataFrame, at: Sequence[int], samples: int) -> DataFrame:
    """Each prediction's draws at these places; a place outside 0 to samples - 1 is an error."""
    beyond = [i for i in at if not 0 <= i < samples]
    if beyond:
        raise PanelError(f"no draws {beyond} among {samples}")
    return df.withColumns({c: pick(F.col(c), at) for c in prediction_columns(df)})


def features_and_targets(df: DataFrame, keys: Sequence[str], targets: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(X, y), both with the keys."""
    features = [c for c in df.columns if c not in keys and c not in targets]
    return columns_of(df, keys, features), columns_of(df, keys, targets)


def replace_missing(x: Column, value: float, array: bool = False) -> Column:
    """A missing number replaced by value, then negatives by 0; in arrays each draw."""
    if array:
        return cleaned(x, value)
    return F.greatest(F.coalesce(F.nanvl(x, F.lit(None).cast("double")), F.lit(float(value))), F.lit(0.0))


def long_cells(df: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """(keys, variable, sample, value): a row for each draw of each variable; samples count from 0."""
    tall = df.unpivot(list(keys), list(variables), "variable", "cell")
    return tall.select(*keys, "variable", F.posexplode("cell").alias("sample", "value"))


def wide_cells(cells: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """The panel of long cells, draws in order of sample."""
    ordered = lambda v: F.transform(F.array_sort(F.collect_list(F.when(F.col("variable") == v, F.struct("sample", "value")))), lambda x: x["value"])
    return cells.groupBy(*keys).agg(*(ordered(v).alias(v) for v in variables))


def subset_cells(cells: DataFrame, keys: Sequence[str], times=None, places=None, samples=None, variables=None) -> DataFrame:
    """Long cells of these times, places, samples and variables; None keeps all."""
    for column, wanted in ((keys[0], times), (keys[1], places), ("sample", samples), ("variable", variables)):
        if wanted is not None:
            cells = cells.where(F.col(column).isin(list(wanted)))
    return cells


def metric_listing(metrics: DataFrame) -> DataFrame:
    """(name, value) of the metrics that can be read as numbers, without names that begin with _, by name."""
    value = F.expr("try_cast(value AS double)")
    return metrics.where(~F.col("name").startswith("_") & value.isNotNull()).select("name", value.alias("value")).orderBy("name")
