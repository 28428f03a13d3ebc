"""Forecasts of rolling origins joined to what happened, with their lead times."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import PanelError
from .audits import require_empty


def step_table(spark: SparkSession, base: int, steps: int = 36, shifts: int = 12) -> DataFrame:
    """(origin, time, step): origin i's step s is month base + i + s, for steps 1 to steps and origins 0 to shifts."""
    return spark.range(shifts + 1).select(F.col("id").cast("int").alias("origin"), F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")).select("origin", (F.lit(base) + F.col("origin") + F.col("step")).alias("time"), "step")


def align(forecasts: DataFrame, actuals: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """(extra, origin, time, unit, y_true, y_pred) of the cells that are in both; the join repeats actuals for each origin."""
    return forecasts.join(actuals, ["time", "unit"]).select(*extra, "origin", "time", "unit", "y_true", "y_pred")


def with_steps(aligned: DataFrame, steps: DataFrame) -> DataFrame:
    """aligned with step; rows outside their origin's window are left out (outside_window finds them). The step table is origins x steps, a few hundred rows."""
    return aligned.join(F.broadcast(steps), ["origin", "time"])


def outside_window(forecasts: DataFrame, steps: DataFrame) -> DataFrame:
    """(origin, time) that the step table doesn't have; must be empty."""
    return forecasts.select("origin", "time").distinct().join(F.broadcast(steps), ["origin", "time"], "left_anti")


def positional_steps(aligned: DataFrame) -> DataFrame:
    """aligned with step: the place of its month among the origin's months that are there, from 1. Only distinct months are ranked."""
    ranked = aligned.select("origin", "time").distinct().withColumn("step", F.dense_rank().over(Window.partitionBy("origin").orderBy("time")))
    return aligned.join(ranked, ["origin", "time"])


def empty_origins(forecasts: DataFrame, aligned: DataFrame) -> DataFrame:
    """(origin) of origins without any aligned cell: a warning each, an error if all are."""
    return forecasts.select("origin").distinct().join(aligned.select("origin").distinct(), "origin", "left_anti")


def key_differences(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(side, n): how many keys only one of two tables has; no row for a side without any."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    found = a.join(b, list(keys), "left_anti").select(F.lit("missing").alias("side")).unionByName(b.join(a, list(keys), "left_anti").select(F.lit("extra").alias("side")))
    return found.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


def misaligned(result: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(problem, n): wanted keys that the result lacks (`missing`), and keys that either table repeats (`repeated`); must be empty before a result is realigned."""
    missing = wanted.select(*keys).join(result.select(*keys), list(keys), "left_anti").select(F.lit("missing").alias("problem"))
    repeated = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("repeated").alias("problem")) for df in (result, wanted)]
    return missing.union(repeated[0]).union(repeated[1]).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def realign(result: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """result's rows for wanted's keys; a missing or repeated key is an error."""
    require_empty(misaligned(result, wanted, keys), "the result doesn't fit the keys")
    return wanted.select(*keys).join(result, list(keys))


def on_keys(keyed: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """keyed's rows with the columns of tables, each of which has one row for a key: the inner join on the keys, done as one shuffle of all tables.

    Columns must have names of their own; a key that a table repeats is an error in the job.
    """
    names = [[c for c in df.columns if c not in keys] for df in tables]
    if len(set(sum(names, []))) < len(sum(names, [])):
        raise PanelError(f"columns of the same name: {names}")
    parts = [df.select(*keys, F.lit(k).alias("__table"), *(F.struct(*own).alias(f"__{j}") if j == k else F.lit(None).cast(tables[j].select(*names[j]).schema).alias(f"__{j}") for j in range(len(tables)))) for k, (df, own) in enumerate(zip(tables, names, strict=True))]
    rows = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.countDistinct("__table").alias("__tables"), *(F.first(f"__{j}", ignorenulls=True).alias(f"__{j}") for j in range(len(tables))))
    error = F.raise_error(F.lit("a table has a key twice")).cast("boolean")
    whole = rows.where(F.when(F.col("__n") > F.col("__tables"), error).otherwise(F.col("__tables") == len(tables)))
    return keyed.join(whole.select(*keys, *(f"__{j}.{c}" for j, own in enumerate(names) for c in own)), list(keys))


def key_prints(tables: Sequence[tuple[str, DataFrame]], keys: Sequence[str]) -> dict[str, tuple]:
    """By name: the number of distinct keys of each table, and two hashes of the set that don't depend on its order. One job, one scan of the keys of each table."""
    rows = reduce(DataFrame.unionByName, (df.select(F.lit(k).alias("table"), *(F.col(c).cast("string").alias(c) for c in keys)) for k, (_, df) in enumerate(tables))).distinct()
    hashes = [F.sum(F.xxhash64(F.lit(salt), *keys).cast("decimal(38,0)")).alias(f"h{salt}") for salt in (1, 2)]
    found = {r.table: (r.n, r.h1, r.h2) for r in rows.groupBy("table").agg(F.count(F.lit(1)).alias("n"), *hashes).collect()}
    return {name: found.get(k, (0, None, None)) for k, (name, _) in enumerate(tables)}


def history(reference: DataFrame, sources: Sequence[tuple[str, DataFrame]], targets: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """reference's keys with each target from the first source that has it and whose key set is the reference's; a target that no such source has is left out.

    Key sets are compared by key_prints, in one job for all sources (key_differences tells how two differ). Targets of one source come with one join.
    """
    prints = key_prints([("", reference), *((f"{k}", df) for k, (_, df) in enumerate(sources))], keys)
    taken: dict[int, list[str]] = {}
    for target in targets:
        fitting = [k for k, (_, df) in enumerate(sources) if target in df.columns and prints[f"{k}"] == prints[""]]
        if fitting:
            taken.setdefault(fitting[0], []).append(target)
    out = reference.select(*keys)
    for k, own in taken.items():
        out = out.join(sources[k][1].select(*keys, *own), list(keys))
    return out.select(*keys, *(t for t in targets if t in out.columns))
