"""Drift of inputs: missing and zero rates, changes between recent and earlier months, extremes; one alert row for each offender."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rates above which an alert is given.
THRESHOLDS = {"missing": 0.01, "missing_month": 0.05, "missing_entity": 0.05, "missing_feature": 0.05, "zero": 0.99, "zero_month": 0.95, "zero_feature": 0.95, "delta_missing": 0.01, "delta_zero": 0.01, "extreme": 5.0}


def tall(df: DataFrame, keys: tuple[str, str], features: Sequence[str]) -> DataFrame:
    return df.select(*keys, *(F.col(f).cast("double").alias(f) for f in features)).unpivot(list(keys), list(features), "feature", "value")


def absent() -> Column:
    return (F.col("value").isNull() | F.isnan("value")).cast("double")


def nothing() -> Column:
    return (F.col("value") == 0).cast("double")


def rates(df: DataFrame, keys: tuple[str, str], features: Sequence[str], kind: str) -> DataFrame:
    """(check, item, rate) of missing or zero values: of the whole table, each month, each feature, and (missing) each place, in one pass."""
    value = absent() if kind == "missing" else F.coalesce(nothing(), F.lit(0.0))
    sets = [[], [F.col(keys[0])], [F.col("feature")]] + ([[F.col(keys[1])]] if kind == "missing" else [])
    found = tall(df, keys, features).groupingSets(sets, keys[0], keys[1], "feature").agg(F.grouping_id().alias("__id"), F.avg(value).alias("rate"))
    check = F.when(F.col("__id") == 7, kind).when(F.col("__id") == 3, f"{kind}_month").when(F.col("__id") == 5, f"{kind}_entity").otherwise(f"{kind}_feature")
    item = F.when(F.col("__id") == 7, "all").when(F.col("__id") == 3, F.col(keys[0]).cast("string")).when(F.col("__id") == 5, F.col(keys[1]).cast("string")).otherwise(F.col("feature"))
    return found.select(check.alias("check"), item.alias("item"), "rate")


def newest_month(df: DataFrame, keys: tuple[str, str]) -> int:
    """The last month that the table has; 0 for an empty one."""
    return df.agg(F.max(keys[0])).first()[0] or 0


def deltas(df: DataFrame, keys: tuple[str, str], features: Sequence[str], last_month: int | None = None, recent: int = 1, before: int = 30) -> DataFrame:
    """(check, item, rate): how missing and zero rates of the last months differ from those of the months before them. last_month: of the data, if not given."""
    last_month = newest_month(df, keys) if last_month is None else last_month
    new = F.col(keys[0]) > last_month - recent
    old = (F.col(keys[0]) <= last_month - recent) & (F.col(keys[0]) > last_month - recent - before)
    change = lambda x: F.abs(F.avg(F.when(new, x)) - F.avg(F.when(old, x)))
    found = tall(df, keys, features).groupBy("feature").agg(change(absent()).alias("delta_missing"), change(F.coalesce(nothing(), F.lit(0.0))).alias("delta_zero"))
    return found.unpivot(["feature"], ["delta_missing", "delta_zero"], "check", "rate").select("check", F.col("feature").alias("item"), "rate")


def extremes(df: DataFrame, keys: tuple[str, str], features: Sequence[str], last_month: int | None = None, recent: int = 1) -> DataFrame:
    """(check, item, rate): how many standard deviations of the earlier months the recent value farthest from their mean, above or below, lies from it. last_month: of the data, if not given."""
    last_month = newest_month(df, keys) if last_month is None else last_month
    new = F.col(keys[0]) > last_month - recent
    value = F.nanvl("value", F.lit(None).cast("double"))
    found = tall(df, keys, features).groupBy("feature").agg(F.max(F.when(new, value)).alias("top"), F.min(F.when(new, value)).alias("low"), F.avg(F.when(~new, value)).alias("mean"), F.stddev(F.when(~new, value)).alias("sd"))
    return found.select(F.lit("extreme").alias("check"), F.col("feature").alias("item"), F.when(F.col("sd") > 0, F.greatest(F.col("top") - F.col("mean"), F.col("mean") - F.col("low")) / F.col("sd")).alias("rate"))


def checks(df: DataFrame, keys: tuple[str, str], features: Sequence[str], recent: int = 1) -> DataFrame:
    """(check, item, rate) of all checks, the last month being the data's."""
    last = newest_month(df, keys)
    found = [rates(df, keys, features, "missing"), rates(df, keys, features, "zero"), deltas(df, keys, features, last, recent), extremes(df, keys, features, last, recent)]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


def alerts(checks: DataFrame, model: str, thresholds: dict[str, float] | None = None) -> DataFrame:
    """(model, check, item, rate, threshold, severity) of the rates above their thresholds; severe from twice the threshold on."""
    limits = THRESHOLDS | (thresholds or {})
    limit = F.element_at(F.create_map(*(x for k, v in limits.items() for x in (F.lit(k), F.lit(float(v))))), F.col("check"))
    severity = F.when(F.col("rate") >= F.col("threshold") * 2, "severe").otherwise("warning")
    return checks.withColumn("threshold", limit).where(F.col("rate") > F.col("threshold")).select(F.lit(model).alias("model"), "check", "item", "rate", "threshold", severity.alias("severity"))
