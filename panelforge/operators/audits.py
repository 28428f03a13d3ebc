"""Checks that give the offending rows, and must give none."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import LEVELS, PREFIX, PanelError


def require_empty(offenders: DataFrame, message: str) -> None:
    """An error with five of the rows, if there are any."""
    found = offenders.take(5)
    if found:
        raise PanelError(f"{message}: {[r.asDict() for r in found]}")


def require_rows(df: DataFrame, message: str = "the table is empty") -> DataFrame:
    if df.isEmpty():
        raise PanelError(message)
    return df


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def draw_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, least, most): draws of all these columns together."""
    sizes = [F.size(c) for c in columns]
    low, high = (sizes[0], sizes[0]) if len(sizes) == 1 else (F.least(*sizes), F.greatest(*sizes))
    return df.groupBy(*by).agg(F.min(low).alias("least"), F.max(high).alias("most"))


def uneven_draws(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The least and most draws, if they differ."""
    return draw_counts(df, columns).where("least <> most")


def inconsistent_models(forecasts: DataFrame, column: str = "forecast") -> DataFrame:
    """(model, least, most) of models whose draws differ from the first model's, or among themselves."""
    per_model = draw_counts(forecasts, [column], ["model"])
    first = per_model.agg(F.min_by("least", "model").alias("__first"))
    return per_model.crossJoin(F.broadcast(first)).where("least <> most or least <> __first").drop("__first")


def unexpected_draws(forecasts: DataFrame, expected: int, column: str = "forecast") -> DataFrame:
    """(model, least, most) of models that don't have so many draws."""
    return draw_counts(forecasts, [column], ["model"]).where((F.col("least") != expected) | (F.col("most") != expected))


def reusable(saved: DataFrame, column: str, expected: int) -> bool:
    """Whether all rows of a saved forecast have as many draws as are wanted."""
    row = draw_counts(saved, [column]).first()
    return row.least == row.most == expected


def empty_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """(name) of the tables without a row."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).where("n = 0").select("name")


def missing_keys(df: DataFrame, level: str) -> list[str]:
    """Key columns of the level that the table lacks."""
    return [k for k in LEVELS[level] if k not in df.columns]


def check_level(df: DataFrame, level: str) -> DataFrame:
    if missing := missing_keys(df, level):
        raise PanelError(f"{level} needs {missing}")
    return df


def missing_predictions(df: DataFrame, targets: Sequence[str]) -> list[str]:
    """Targets without a prediction column."""
    return [t for t in targets if PREFIX + t not in df.columns]


def check_predictions(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    if missing := missing_predictions(df, targets):
        raise PanelError(f"no predictions of {missing}")
    return df


def month_coverage(df: DataFrame, first: int, last: int, key: str = "month_id") -> DataFrame:
    """(month_id, problem): months of the range that are missing, and months outside it."""
    there = df.select(F.col(key).alias("month_id")).distinct()
    wanted = df.sparkSession.range(first, last + 1).select(F.col("id").cast(df.schema[key].dataType).alias("month_id"))
    missing = wanted.join(there, "month_id", "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(there.where(~F.col("month_id").between(first, last)).withColumn("problem", F.lit("outside")))


def bad_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are null, NaN or not whole."""
    bad = F.lit(False)
    for k in keys:
        x = F.col(k).cast("double")
        bad = bad | x.isNull() | F.isnan(x) | (x != F.floor(x))
    return df.where(bad).select(*keys)


def origin_windows(forecasts: DataFrame, base: int, steps: int = 36, shifts: int = 12) -> DataFrame:
    """(origin, first, last, n_months, hint) of origins whose months aren't base + origin + 1 to base + origin + steps, and of missing origins."""
    per = forecasts.groupBy("origin").agg(F.min("time").alias("first"), F.max("time").alias("last"), F.countDistinct("time").alias("n_months"))
    wanted = forecasts.sparkSession.range(shifts + 1).select(F.col("id").cast("int").alias("origin"))
    found = wanted.join(per, "origin", "full")
    start = F.col("origin") + base + 1
    good = (F.col("first") == start) & (F.col("last") == start + steps - 1) & (F.col("n_months") == steps) & F.col("origin").between(0, shifts)
    hint: Column = (
        F.when(F.col("first").isNull(), "origin is missing")
        .when(~F.col("origin").between(0, shifts), "unknown origin")
        .when(F.col("first") != start, "origin is shifted")
        .when(F.col("last") > start + steps - 1, "extra step")
        .otherwise("months are missing")
    )
    return found.where(~F.coalesce(good, F.lit(False))).withColumn("hint", hint)


def cells_by_month(df: DataFrame, key: str = "month_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_cells"))


def uneven_months(df: DataFrame, key: str = "month_id") -> DataFrame:
    """(least, most) cells of a month, if they differ."""
    return cells_by_month(df, key).agg(F.min("n_cells").alias("least"), F.max("n_cells").alias("most")).where("least <> most")


def manifest(df: DataFrame, run: str, target: str, key: str = "month_id") -> DataFrame:
    """(run, target, months array<struct<month_id, n_cells, print>>, cell_count): what a publication holds, with a fingerprint of each month's rows."""
    per = df.groupBy(key).agg(*content(df.columns))
    months = F.array_sort(F.collect_list(F.struct(F.col(key).alias("month_id"), F.col("n").alias("n_cells"), "print")))
    return per.agg(months.alias("months"), F.max("n").alias("cell_count")).select(F.lit(run).alias("run"), F.lit(target).alias("target"), "months", "cell_count")


def content(columns: Sequence[str]) -> tuple[Column, Column]:
    """Aggregates n and print: rows and a hash of their content that doesn't depend on order."""
    return F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("print")


def fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, n, print) of the rows' content."""
    return df.groupBy(*by).agg(*content([c for c in df.columns if c not in by]))


def same_content(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables have equal rows, by count and hash."""
    return fingerprint(left).first() == fingerprint(right.select(*left.columns)).first()


def different_inputs(raw: DataFrame) -> DataFrame:
    """(model, n, print) of models whose raw data (model, ...) differ from the first model's."""
    per = fingerprint(raw, ["model"])
    first = per.agg(F.min_by(F.struct("n", "print"), "model").alias("__first"))
    return per.crossJoin(F.broadcast(first)).where("n <> __first.n or print <> __first.print").select("model", "n", "print")


def parity(left: DataFrame, right: DataFrame, relative: float = 1e-5, absolute: float = 1e-8) -> DataFrame:
    """(origin, time, unit, left, right) of values that two evaluation tables (.., value) don't share within tolerance."""
    keys = ["origin", "time", "unit"]
    both = left.select(*keys, F.col("value").alias("left")).join(right.select(*keys, F.col("value").alias("right")), keys, "full")
    close = F.abs(F.col("left") - F.col("right")) <= absolute + relative * F.abs(F.col("right"))
    return both.where(~F.coalesce(close, F.lit(False)))


def scale_conflicts(models: DataFrame) -> DataFrame:
    """(problem, n): more than one declared output scale is an error, some without one a warning."""
    per = models.agg(F.countDistinct("scale").alias("scales"), F.count("scale").alias("declared"), F.count(F.lit(1)).alias("n"))
    problem = F.when(F.col("scales") > 1, "error").when((F.col("declared") > 0) & (F.col("declared") < F.col("n")), "warning")
    return per.select(problem.alias("problem"), (F.col("n") - F.col("declared")).alias("undeclared")).where("problem is not null")


def structure_changes(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(problem, item, n): columns that are lost (`column`), and by how many rows the tables differ (`rows`)."""
    n = before.agg(F.count(F.lit(1)).alias("__n")).crossJoin(F.broadcast(after.agg(F.count(F.lit(1)).alias("__m"))))
    lost = F.array(*(F.lit(c) for c in columns if c not in after.columns)).cast("array<string>")
    rows = n.select(F.lit("rows").alias("problem"), F.lit("all").alias("item"), (F.col("__m") - F.col("__n")).alias("n")).where("n <> 0")
    return n.select(F.lit("column").alias("problem"), F.explode(lost).alias("item"), F.lit(1).cast("long").alias("n")).unionByName(rows)


def check_structure(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """after, if it has these columns and as many rows as before."""
    require_empty(structure_changes(before, after, columns), "the table changed")
    return after


def bad_actuals(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """(target, problem) of targets that are missing, or hold arrays of more or fewer than one draw."""
    arrays = [t for t in targets if t in df.columns and df.schema[t].dataType.typeName() == "array"]
    wide = df.agg(*(F.max((F.size(t) != 1).cast("int")).alias(t) for t in arrays)) if arrays else df.agg(F.lit(0).alias("__none"))
    problem = [F.struct(F.lit(t).alias("target"), F.lit("missing").alias("problem")) for t in targets if t not in df.columns]
    problem += [F.when(F.col(t) == 1, F.struct(F.lit(t).alias("target"), F.lit("draws").alias("problem"))) for t in arrays]
    found = F.explode(F.array_compact(F.array(*problem))) if problem else F.explode(F.array().cast("array<struct<target: string, problem: string>>"))
    return wide.select(found.alias("x")).select("x.target", "x.problem")


def check_actuals(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """df, if it has all targets, each a number or arrays of one draw."""
    require_empty(bad_actuals(df, targets), "actuals")
    return df
