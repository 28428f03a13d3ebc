"""Grid-cell forecasts scaled so that each country and month sums to the country's own forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import PanelError

MONTH, GRID, COUNTRY = "month_id", "grid_id", "country_id"


def with_country(cells: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """cells with their country; hierarchy is (grid_id, country_id), with month_id if countries change. Unmapped cells have a null country."""
    return cells.join(hierarchy, [k for k in (MONTH, GRID) if k in hierarchy.columns], "left")


def with_totals(cells: DataFrame, countries: DataFrame) -> DataFrame:
    """cells with their country's total in their month. A cell without a country, or whose country has no total, fails the job (unmapped finds them)."""
    return on_cells(cells, countries.select(MONTH, COUNTRY, "total"), ["total"])


def on_cells(cells: DataFrame, totals: DataFrame, columns: list[str]) -> DataFrame:
    """cells with columns of totals (month_id, country_id, ..), in which none is null; a cell without them fails the job that computes the first of them, so no cell is lost."""
    joined = cells.join(totals.withColumn("__found", F.lit(True)), [MONTH, COUNTRY], "left")
    place = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in (MONTH, GRID, COUNTRY)]
    error = F.raise_error(F.format_string("no country total: month %s, cell %s, country %s", *place))
    found = {c: F.when(F.col("__found").isNull() | F.col(c).isNull(), error.cast(totals.schema[c].dataType)).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(found).drop("__found")


def unmapped(cells: DataFrame, countries: DataFrame) -> DataFrame:
    """(month_id, country_id, n): cells without a country (null) or whose country has no forecast; must be empty."""
    there = countries.where("total is not null") if "total" in countries.columns else countries
    missing = cells.join(there.select(MONTH, COUNTRY), [MONTH, COUNTRY], "left_anti")
    return missing.groupBy(MONTH, COUNTRY).agg(F.count(F.lit(1)).alias("n"))


def scale(value: Column, total: Column, own: Column) -> Column:
    """Negatives count as 0; where the cells sum to 0 they stay 0."""
    x = F.greatest(value, F.lit(0.0))
    return F.when(own > 0, x * total / own).otherwise(F.lit(0.0))


def reconcile_points(cells: DataFrame, countries: DataFrame) -> DataFrame:
    """(month_id, grid_id, country_id, value) from cells (.., value) and countries (month_id, country_id, total).

    Totals are aggregated before they are joined back, so a country with very many cells moves one row for each task. A cell without a
    country or total fails the job; unmapped() finds such cells.
    """
    sums = cells.groupBy(MONTH, COUNTRY).agg(F.coalesce(F.sum(F.greatest("value", F.lit(0.0))), F.lit(0.0)).alias("__own"))
    totals = sums.join(countries.select(MONTH, COUNTRY, "total"), [MONTH, COUNTRY])
    joined = on_cells(cells, totals, ["total", "__own"])
    return joined.select(MONTH, GRID, COUNTRY, scale(F.col("value"), F.col("total"), F.col("__own")).alias("value"))


def reconcile_draws(cells: DataFrame, countries: DataFrame, samples: int) -> DataFrame:
    """As reconcile_points for arrays of draws: country totals of one draw apply to each, those of S draws to the same draw.

    cells has value array, countries total array. The sums of all draws are one aggregate of S columns, without exploding. Cells that
    don't have S draws, totals of neither 1 nor S, and cells without a country or total fail the job that computes them (draw_conflicts
    and unmapped find them).
    """
    fitting = F.col("value").isNull() | (F.size("value") == samples)
    cells = cells.withColumn("value", F.when(fitting, F.col("value")).otherwise(F.raise_error(F.lit(f"a cell without {samples} draws")).cast(cells.schema["value"].dataType)))
    fitting = F.col("total").isNull() | F.size("total").isin(1, samples)
    countries = countries.withColumn("total", F.when(fitting, F.col("total")).otherwise(F.raise_error(F.lit(f"a country total of neither 1 nor {samples} draws")).cast(countries.schema["total"].dataType)))
    own = [F.coalesce(F.sum(F.greatest(F.get("value", F.lit(i)), F.lit(0.0))), F.lit(0.0)).alias(f"__{i}") for i in range(samples)]
    sums = cells.groupBy(MONTH, COUNTRY).agg(*own).select(MONTH, COUNTRY, F.array(*(f"__{i}" for i in range(samples))).alias("__own"))
    totals = sums.join(countries.select(MONTH, COUNTRY, "total"), [MONTH, COUNTRY])
    total = lambda i: F.get("total", F.when(F.size("total") == 1, F.lit(0)).otherwise(i))
    scaled = F.transform("value", lambda x, i: scale(x, total(i), F.get("__own", i)))
    return on_cells(cells, totals, ["total", "__own"]).select(MONTH, GRID, COUNTRY, scaled.alias("value"))


def check_samples(country: int, grid: int) -> None:
    if country not in (1, grid):
        raise PanelError(f"country totals have {country} draws, cells {grid}")


def draw_conflicts(cells: DataFrame, countries: DataFrame) -> DataFrame:
    """(month_id, country_id, least, most, total): countries whose cells differ in their number of draws, or whose total has neither 1 nor as many; must be empty."""
    counts = cells.groupBy(MONTH, COUNTRY).agg(F.min(F.size("value")).alias("least"), F.max(F.size("value")).alias("most"))
    both = counts.join(countries.select(MONTH, COUNTRY, F.size("total").alias("total")), [MONTH, COUNTRY])
    return both.where((F.col("least") != F.col("most")) | ~F.col("total").isin(1) & (F.col("total") != F.col("most")))


def reconcile_targets(cells: DataFrame, countries: DataFrame, targets: list[str]) -> DataFrame:
    """All targets (columns of both tables) in one pass; as reconcile_points for each."""
    sums = cells.groupBy(MONTH, COUNTRY).agg(*(F.coalesce(F.sum(F.greatest(t, F.lit(0.0))), F.lit(0.0)).alias(f"__own_{t}") for t in targets))
    totals = sums.join(countries.select(MONTH, COUNTRY, *(F.col(t).alias(f"__total_{t}") for t in targets)), [MONTH, COUNTRY])
    return on_cells(cells, totals, [f"__{x}_{t}" for x in ("own", "total") for t in targets]).select(MONTH, GRID, COUNTRY, *(scale(F.col(t), F.col(f"__total_{t}"), F.col(f"__own_{t}")).alias(t) for t in targets))


def broken_invariants(before: DataFrame, after: DataFrame, countries: DataFrame, sums: float = 1e-2, zeros: float = 1e-8) -> DataFrame:
    """(rule, month_id, id): countries whose cells don't sum to their total, zeros that moved, negative cells; must be empty."""
    added = after.groupBy(MONTH, COUNTRY).agg(F.sum("value").alias("__sum")).join(countries, [MONTH, COUNTRY])
    off = added.where((F.abs(F.col("__sum") - F.col("total")) > sums) & (F.col("__sum") != 0)).select(F.lit("sum").alias("rule"), MONTH, F.col(COUNTRY).alias("id"))
    moved = before.select(MONTH, GRID, F.col("value").alias("__before")).join(after, [MONTH, GRID]).where((F.col("__before") == 0) & (F.abs("value") > zeros)).select(F.lit("zero").alias("rule"), MONTH, F.col(GRID).alias("id"))
    negative = after.where("value < 0").select(F.lit("negative").alias("rule"), MONTH, F.col(GRID).alias("id"))
    return off.unionByName(moved).unionByName(negative)


def alerts(cells: DataFrame, countries: DataFrame, ratio: float = 1.0) -> DataFrame:
    """(kind, month_id, country_id, log_ratio): totals far from the cells' sum (|ln| above ratio), and totals that no cell can carry."""
    sums = cells.groupBy(MONTH, COUNTRY).agg(F.sum(F.greatest("value", F.lit(0.0))).alias("__own")).join(countries, [MONTH, COUNTRY])
    far = F.when((F.col("__own") > 0) & (F.col("total") > 0), F.log(F.col("total") / F.col("__own")))
    kind = F.when((F.col("__own") == 0) & (F.col("total") > 0), "no cell").when(F.abs(far) > ratio, "large ratio")
    return sums.select(kind.alias("kind"), MONTH, COUNTRY, far.alias("log_ratio")).where("kind is not null")


def packed(mapping: DataFrame) -> DataFrame:
    """(grid_id, country_id, first, last) of mapping (month_id, grid_id, country_id): the runs of months in which a cell has one country.

    A cell's months are as many as the panel has, so a window over them is small. Repeated rows count once; a null country is one of its own.
    """
    runs = Window.partitionBy(GRID, COUNTRY).orderBy(MONTH)
    rows = mapping.select(MONTH, GRID, COUNTRY).distinct().withColumn("__run", F.col(MONTH) - F.row_number().over(runs))
    return rows.groupBy(GRID, COUNTRY, "__run").agg(F.min(MONTH).alias("first"), F.max(MONTH).alias("last")).select(GRID, COUNTRY, "first", "last")


def mapping_faults(intervals: DataFrame) -> DataFrame:
    """(grid_id, problem, first, last) of a packed mapping: months of a cell that two of its intervals share (`overlap`), and months between two that none has (`gap`); must be empty."""
    own = Window.partitionBy(GRID).orderBy("first", "last", COUNTRY)
    before = F.max("last").over(own.rowsBetween(Window.unboundedPreceding, -1))
    rows = intervals.withColumn("__before", before)
    overlap = F.when(F.col("first") <= F.col("__before"), F.struct(F.lit("overlap").alias("problem"), F.col("first"), F.least("last", "__before").alias("last")))
    gap = F.when(F.col("first") > F.col("__before") + 1, F.struct(F.lit("gap").alias("problem"), (F.col("__before") + 1).alias("first"), (F.col("first") - 1).alias("last")))
    return rows.select(GRID, F.coalesce(overlap, gap).alias("x")).where("x is not null").select(GRID, "x.*")


def country_as_of(cells: DataFrame, intervals: DataFrame, bin_months: int = 24) -> DataFrame:
    """cells with the country that a packed mapping gives them in their month; null where it gives none, one row for each where intervals overlap.

    Intervals are put into the bins of so many months that they touch, and meet cells of the same place and bin, so a cell is compared
    with the few intervals of its bin; a mapping row for each cell and month is never made.
    """
    bins = F.explode(F.sequence(F.floor(F.col("first") / bin_months), F.floor(F.col("last") / bin_months)))
    dealt = intervals.select(F.col(GRID).alias("__grid"), COUNTRY, "first", "last", bins.alias("__bin"))
    at = (F.col(GRID) == F.col("__grid")) & (F.floor(F.col(MONTH) / bin_months) == F.col("__bin")) & F.col(MONTH).between(F.col("first"), F.col("last"))
    return cells.join(dealt, at, "left").drop("__grid", "__bin", "first", "last")


def cells_of_country(intervals: DataFrame, country: int, month: int) -> DataFrame:
    """(grid_id) of the cells that a country has in a month."""
    return intervals.where((F.col(COUNTRY) == country) & F.lit(month).between(F.col("first"), F.col("last"))).select(GRID).distinct()


def country_changes(mapping: DataFrame) -> DataFrame:
    """(month_id, grid_id, was, country_id): months in which a cell's country isn't that of its month before."""
    was = F.lag(COUNTRY).over(Window.partitionBy(GRID).orderBy(MONTH))
    return mapping.withColumn("was", was).where(F.col("was") != F.col(COUNTRY)).select(MONTH, GRID, "was", COUNTRY)
