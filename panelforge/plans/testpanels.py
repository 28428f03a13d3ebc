"""Panels made from the order tables: grid cells are suppliers, countries their nations, months those of shipping or ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.align import step_table
from ..schema import month_id

GRID_KEYS, COUNTRY_KEYS = ("month_id", "grid_id"), ("month_id", "country_id")
#: Models and what they multiply a cell's value by.
MODELS = {"low": 0.8, "mid": 1.0, "high": 1.3}
DRAWS, BASE, FIRST_TEST, LAST_TEST = 8, 212, 213, 260


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grid_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month_id, grid_id, n, v): lines and quantity by month of shipping and supplier."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(month_id(F.col("l_shipdate")).alias("month_id"), F.col("l_suppkey").alias("grid_id")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("v"))


def country_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month_id, country_id, n): orders by month and the customer's nation."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return joined.groupBy(month_id(F.col("o_orderdate")).alias("month_id"), F.col("c_nationkey").alias("country_id")).agg(F.count(F.lit(1)).alias("n"))


def country_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month_id, country_id, total): a forecast for every country and month with a cell, that of its orders, 0 without any."""
    places = grid_panel(spark, sf_dir).join(hierarchy(spark, sf_dir), "grid_id").select("month_id", "country_id").distinct()
    return places.join(country_panel(spark, sf_dir), ["month_id", "country_id"], "left").select("month_id", "country_id", F.coalesce("n", F.lit(0)).cast("double").alias("total"))


def hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grid_id, country_id)"""
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("grid_id"), F.col("s_nationkey").alias("country_id"))


def drawn(value: Column, shift: Column | int = 0) -> Column:
    """Eight draws around a value, a rule of its keys."""
    turn = lambda j: (31 * F.col("grid_id") + 17 * F.col("month_id") + 13 * j + shift) % 21 - 10
    return F.transform(F.sequence(F.lit(0), F.lit(DRAWS - 1)), lambda j: value * (1 + turn(j) / F.lit(100.0)))


def model_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, month_id, grid_id, forecast) for three models; the highest lacks every seventh grid cell."""
    rows = grid_panel(spark, sf_dir).withColumn("model", F.explode(F.array(*(F.lit(m) for m in MODELS))))
    factor = F.element_at(F.create_map(*(F.lit(x) for m, w in MODELS.items() for x in (m, w))), F.col("model"))
    rows = rows.where(~((F.col("model") == "high") & (F.col("grid_id") % 7 == 0)))
    return rows.select("model", "month_id", "grid_id", (F.col("v") * factor).alias("forecast"))


def model_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As model_points, with eight draws for each forecast."""
    return model_points(spark, sf_dir).withColumn("forecast", drawn(F.col("forecast")))


def origin_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(origin, time, unit, y_pred array) of 13 origins, 36 months each."""
    cells = grid_panel(spark, sf_dir).where(F.col("month_id").between(FIRST_TEST, LAST_TEST))
    steps = step_table(spark, BASE).select("origin", F.col("time").alias("month_id"))
    joined = cells.join(F.broadcast(steps), "month_id")
    return joined.select("origin", F.col("month_id").alias("time"), F.col("grid_id").alias("unit"), drawn(F.col("v"), F.col("origin")).alias("y_pred"))


def actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(time, unit, y_true); every eleventh grid cell has none."""
    return grid_panel(spark, sf_dir).where("grid_id % 11 <> 0").select(F.col("month_id").alias("time"), F.col("grid_id").alias("unit"), F.col("v").alias("y_true"))


#: The same panels as DuckDB SQL: names of a WITH clause.
GRID_SQL = "grid AS (SELECT ((year(l_shipdate) - 1980) * 12 + month(l_shipdate))::INT AS month_id, l_suppkey AS grid_id, count(*) AS n, sum(l_quantity) AS v FROM lineitem GROUP BY ALL)"
COUNTRY_SQL = "country AS (SELECT ((year(o_orderdate) - 1980) * 12 + month(o_orderdate))::INT AS month_id, c_nationkey AS country_id, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"
HIERARCHY_SQL = "hierarchy AS (SELECT s_suppkey AS grid_id, s_nationkey AS country_id FROM supplier)"
TOTALS_SQL = f"{HIERARCHY_SQL}, {COUNTRY_SQL}, totals AS (SELECT month_id, country_id, coalesce(n, 0)::DOUBLE AS total FROM (SELECT DISTINCT month_id, country_id FROM grid JOIN hierarchy USING (grid_id)) LEFT JOIN country USING (month_id, country_id))"
MODELS_SQL = f"{GRID_SQL}, points AS (SELECT model, month_id, grid_id, v * factor AS forecast FROM grid, (VALUES ('low', 0.8::DOUBLE), ('mid', 1.0::DOUBLE), ('high', 1.3::DOUBLE)) m(model, factor) WHERE NOT (model = 'high' AND grid_id % 7 = 0))"


def draws_sql(value: str, shift: str = "0") -> str:
    return f"list_transform(range(8), lambda j: {value} * (1 + ((31 * grid_id + 17 * month_id + 13 * j + {shift}) % 21 - 10) / 100.0::DOUBLE))"


DRAWS_SQL = f"{MODELS_SQL}, draws AS (SELECT model, month_id, grid_id, {draws_sql('forecast')} AS forecast FROM points)"
STEPS_SQL = "steps AS (SELECT o.i::INT AS origin, (212 + o.i + s.i)::INT AS time, s.i::INT AS step FROM range(13) o(i), range(1, 37) s(i))"
ALIGNED_SQL = f"""{GRID_SQL}, {STEPS_SQL}, forecasts AS (
    SELECT origin, month_id AS time, grid_id AS unit, {draws_sql('v', 'origin')} AS y_pred FROM grid JOIN steps ON time = month_id
), actuals AS (
    SELECT month_id AS time, grid_id AS unit, v AS y_true FROM grid WHERE grid_id % 11 <> 0
), aligned AS (
    SELECT origin, time, unit, y_true, y_pred, step FROM forecasts JOIN actuals USING (time, unit) JOIN steps USING (origin, time)
)"""
