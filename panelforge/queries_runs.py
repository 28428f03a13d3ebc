"""Queries of sources, sinks, guards, strategies and run skeletons over the order tables, each with DuckDB SQL where SQL can express it.

Guards are queries of offenders, or of what a guard says about each case of the given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import transforms
from .operators import align, audits, catalogue, drift, evaluate, pool, reconcile, select
from .plans import partitions, runs
from .plans import testpanels as tp
from .queries import (
    CATALOGUE_SQL,
    CELLS_SQL,
    DELTAS_SQL,
    DRIFT_SQL,
    EXTREMES_SQL,
    KEYS,
    ORACLE_SQL,
    PANEL_SQL,
    ROW_SQL,
    UNEVEN_SQL,
    WIDE_SQL,
    aligned_rows,
    cells_and_totals,
    dense,
    descriptions,
    drifting,
    exploded,
    files,
    query,
    rounded,
    saved,
    scratch,
    settled,
    settled_sql,
    uneven,
)
from .schema import PanelError, classify_columns, combined_targets
from .sources import tables


def refused(attempt: Callable[[], object]) -> bool:
    """Whether a guard raises its error."""
    try:
        attempt()
    except PanelError:
        return True
    return False


def totals_of(df: DataFrame, label: str, column: str) -> DataFrame:
    """(label, n, total) of one column."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(column).cast("double").alias("total")).select(F.lit(label).alias("label"), "n", "total")


def totals_sql(label: str, column: str, source: str) -> str:
    return f"SELECT '{label}' AS label, count(*) AS n, sum({column})::DOUBLE AS total FROM {source}"


# Sources and sinks


@query(
    f"""WITH {tp.DRAWS_SQL}, mid AS (SELECT month_id, grid_id AS priogrid_id, list_transform(forecast, lambda x: x::FLOAT) AS a, list_transform(forecast, lambda x: (x * 2)::FLOAT) AS b FROM draws WHERE model = 'mid')
    SELECT month_id, priogrid_id, d::INT AS draw, round(a[d + 1]::DOUBLE, 3) AS a, round(b[d + 1]::DOUBLE, 3) AS b FROM mid, range(8) r(d)"""
)
def s5_several_targets(spark, sf):
    path = scratch(spark)
    mid = tp.model_draws(spark, sf).where("model = 'mid'")
    both = mid.select("month_id", F.col("grid_id").alias("priogrid_id"), F.col("forecast").alias("pred_a"), F.transform("forecast", lambda x: x * 2).alias("pred_b"))
    tables.write_predictions(both, "pgm", ["a", "b"], path)
    found = tables.read_predictions(spark, path, "pgm", ["a", "b"]).select("month_id", "priogrid_id", F.posexplode(F.arrays_zip("pred_a", "pred_b")).alias("draw", "x"))
    return rounded(found.select("month_id", "priogrid_id", "draw", F.col("x.pred_a").cast("double").alias("a"), F.col("x.pred_b").cast("double").alias("b")), "a", "b", places=3)


@query(
    f"""WITH {tp.GRID_SQL}, made AS (SELECT ((k - 1) % 20 % 10)::DOUBLE AS x FROM range(1, (SELECT count(*) FROM supplier) + 1) t(k), range(200, 211)) {totals_sql('region', 'v', 'grid WHERE month_id BETWEEN 200 AND 210')}
    UNION ALL {totals_sql('queryset', 'v', 'grid WHERE month_id BETWEEN 200 AND 210')} UNION ALL {totals_sql('synthetic', 'x', 'made')} UNION ALL SELECT 'unknown', 0, NULL"""
)
def s7_dispatch(spark, sf):
    """What each kind of descriptor fetches; one that no source is for is refused."""
    path = scratch(spark)
    tp.grid_panel(spark, sf).withColumnRenamed("grid_id", "priogrid_id").write.parquet(path)
    places = tp.table(spark, sf, "supplier").count()
    given = ({"features": ["v"], "path": path}, {"operations": [], "path": path}, {"pattern": "column", "n_entities": places, "columns": 20, "features": ["v"]})
    found = None
    for descriptor in given:
        own = totals_of(tables.fetch(spark, descriptor, 200, 210), tables.detect_source(descriptor), "v")
        found = own if found is None else found.unionByName(own)
    if refused(lambda: tables.fetch(spark, {"path": path}, 200, 210)):
        found = found.unionByName(totals_of(found.where("false"), "unknown", "total"))
    return found


@query(
    f"""WITH {tp.GRID_SQL.replace('GROUP BY ALL', "WHERE l_shipdate < '1997-01-01' GROUP BY ALL")}, {DRIFT_SQL[len(tp.GRID_SQL) + 2 :]}, checks AS (
    SELECT 'missing' AS "check", 'all' AS item, avg((value IS NULL)::INT) AS rate FROM tall UNION ALL SELECT 'missing_month', month_id::VARCHAR, avg((value IS NULL)::INT) FROM tall GROUP BY month_id
    UNION ALL SELECT 'missing_feature', feature, avg((value IS NULL)::INT) FROM tall GROUP BY feature UNION ALL SELECT 'missing_entity', grid_id::VARCHAR, avg((value IS NULL)::INT) FROM tall GROUP BY grid_id
    UNION ALL SELECT 'zero', 'all', avg(coalesce(value = 0, false)::INT) FROM tall UNION ALL SELECT 'zero_month', month_id::VARCHAR, avg(coalesce(value = 0, false)::INT) FROM tall GROUP BY month_id
    UNION ALL SELECT 'zero_feature', feature, avg(coalesce(value = 0, false)::INT) FROM tall GROUP BY feature UNION ALL {DELTAS_SQL} UNION ALL {EXTREMES_SQL}
    ), limits AS (SELECT * FROM (VALUES ('missing', 0.01::DOUBLE), ('missing_month', 0.05), ('missing_entity', 0.05), ('missing_feature', 0.05), ('zero', 0.99), ('zero_month', 0.95), ('zero_feature', 0.95), ('delta_missing', 0.01), ('delta_zero', 0.01), ('extreme', 5.0)) t("check", threshold))
    SELECT 'm' AS model, "check", item, round(rate, 6) AS rate, threshold, CASE WHEN rate >= 2 * threshold THEN 'severe' ELSE 'warning' END AS severity FROM checks JOIN limits USING ("check") WHERE rate > threshold"""
)
def s9_fetch_with_alerts(spark, sf):
    """The drift alerts of what is fetched: the months before 1997."""
    path = scratch(spark)
    drifting(spark, sf).withColumnRenamed("grid_id", "priogrid_id").write.parquet(path)
    found = tables.fetch_checked(spark, {"operations": [], "path": path}, 1, 204, "m", recent=3)[1]
    return rounded(found, "rate")


@query(f"WITH {tp.MODELS_SQL} SELECT sink, model, count(*) AS n, round(sum(forecast), 4) AS total FROM points, (VALUES ('first'), ('second')) s(sink) GROUP BY ALL")
def s13_x7_sinks(spark, sf):
    """Two sinks that get the same table, read back."""
    at = scratch(spark)

    def sink(name: str) -> tables.Sink:
        return lambda df, about: df.withColumn("sink", F.lit(name)).write.partitionBy("model").parquet(f"{at}/{about['run']}/{name}")

    tables.to_sinks(tp.model_points(spark, sf), [sink("first"), sink("second")], {"run": "r"})
    found = spark.read.parquet(f"{at}/r/first").unionByName(spark.read.parquet(f"{at}/r/second"))
    return rounded(found.groupBy("sink", "model").agg(F.count(F.lit(1)).alias("n"), F.sum("forecast").alias("total")), "total", places=4)


@query(
    f"""WITH {tp.MODELS_SQL}, {tp.STEPS_SQL} SELECT 'predictions_test_20240102_030405_' || model || '_' || lpad(origin::VARCHAR, 2, '0') AS name, 'eval_test_' || model || '_step_20240102_030405' AS evaluation, count(*) AS n
    FROM points JOIN steps ON time = month_id GROUP BY ALL UNION ALL SELECT 'predictions_forecast_20240102_030405', NULL, count(*) FROM points"""
)
def s19_output_names(spark, sf):
    """Forecasts of rolling origins and of a forecast run, counted by the names of their outputs."""
    ts = F.lit("20240102_030405")
    points = tp.model_points(spark, sf)
    rolling = points.join(F.broadcast(align.step_table(spark, tp.BASE).withColumnRenamed("time", "month_id")), "month_id")
    names = tables.prediction_name(F.lit("test"), ts, F.col("model"), F.col("origin")), tables.evaluation_name(F.lit("test"), F.col("model"), F.lit("step"), ts)
    found = rolling.groupBy(names[0].alias("name"), names[1].alias("evaluation")).agg(F.count(F.lit(1)).alias("n"))
    plain = tables.output_names(points.drop("model"), "forecast", "20240102_030405")
    own = tables.prediction_name(F.col("run_type"), F.col("ts"), F.col("target"), F.col("origin"))
    return found.unionByName(plain.groupBy(own.alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("evaluation", F.lit(None).cast("string")))


@query(f"WITH {tp.GRID_SQL} SELECT month_id, grid_id AS priogrid_id, n::DOUBLE AS n, coalesce(CASE WHEN n % 5 <> 0 THEN v END, 0) AS v FROM grid")
def s20_extract(spark, sf):
    """Download, preprocess, save."""
    path = f"{scratch(spark)}.parquet"

    def save(df: DataFrame) -> DataFrame:
        tables.write_table(df, path)
        return spark.read.parquet(path)

    download = lambda: tp.grid_panel(spark, sf).select("month_id", F.col("grid_id").alias("priogrid_id"), F.col("n").cast("double").alias("n"), F.when(F.col("n") % 5 != 0, F.col("v")).alias("v"))
    return partitions.extracted(download, lambda df: df.fillna(0.0, ["v"]), save)


@query(f"WITH {tp.MODELS_SQL} SELECT month_id, grid_id, round(least(forecast, 200), 6) AS forecast, false AS refused FROM points WHERE model = 'mid'")
def s21_postprocess(spark, sf):
    """Read, transform, validate, save; a table that isn't valid is refused, and the last column says that this one isn't."""
    at = scratch(spark)

    def save(df: DataFrame) -> DataFrame:
        df.write.parquet(f"{at}/out")
        return spark.read.parquet(f"{at}/out")

    def validate(df: DataFrame) -> DataFrame:
        audits.require_empty(audits.repeated_keys(df, KEYS), "keys")
        return audits.require_rows(df)

    read = lambda: tp.model_points(spark, sf).where("model = 'mid'").drop("model")
    twice = lambda: read().unionByName(read())
    clip = lambda df: df.withColumn("forecast", F.least("forecast", F.lit(200.0)))
    wrong = refused(lambda: partitions.postprocessed(twice, clip, validate, lambda df: df))
    return rounded(partitions.postprocessed(read, clip, validate, save), "forecast").withColumn("refused", F.lit(not wrong))


@query(f"WITH {tp.DRAWS_SQL} SELECT 'fresh' AS what, count(*) AS n, 8::INT AS draws FROM draws WHERE model = 'mid' UNION ALL SELECT 'kept', count(*), 8 FROM draws WHERE model = 'mid'")
def v6_stale_cache(spark, sf):
    """A saved forecast of four draws is made anew when eight are wanted, and the one of eight is kept."""
    path = scratch(spark)
    mid = tp.model_draws(spark, sf).where("model = 'mid'").drop("model")
    current = lambda df: audits.reusable(df, "forecast", tp.DRAWS)
    tables.cached(spark, path, lambda: mid.withColumn("forecast", F.slice("forecast", 1, 4)))
    found = None
    for what, compute in (("fresh", lambda: mid), ("kept", lambda: mid.limit(0))):
        saved = tables.cached(spark, path, compute, current=current)
        own = saved.groupBy(F.size("forecast").alias("draws")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n", "draws")
        found = own if found is None else found.unionByName(own)
    return found


# Ranges, columns and levels


@query(
    f"""WITH {tp.GRID_SQL}, last AS (SELECT max(month_id) AS m FROM grid), ranges AS (SELECT * FROM (VALUES ('calibration', 'train', 121, 396), ('calibration', 'test', 397, 444), ('validation', 'train', 121, 444), ('validation', 'test', 445, 492)) t(partition, part, first, last)
    UNION ALL SELECT 'forecasting', 'train', 121, m FROM last UNION ALL SELECT 'forecasting', 'test', m + 1, m + 36 FROM last)
    SELECT partition, part, first::INT AS first, ranges.last::INT AS last, count(grid_id) AS cells FROM ranges LEFT JOIN grid ON month_id BETWEEN first AND ranges.last GROUP BY ALL"""
)
def p2_default_ranges(spark, sf):
    """The default ranges, the last month being the panel's, and the panel's cells in each."""
    panel = tp.grid_panel(spark, sf)
    last = drift.newest_month(panel, KEYS)
    rows = [(p, part, *months) for p in ("calibration", "validation", "forecasting") for part, months in partitions.default_ranges(p, 36, last).items()]
    ranges = spark.createDataFrame(rows, "partition string, part string, first int, last int")
    cells = audits.cells_by_month(panel)
    found = ranges.join(cells, cells.month_id.between(F.col("first"), F.col("last")), "left").groupBy("partition", "part", "first", "last")
    return found.agg(F.coalesce(F.sum("n_cells"), F.lit(0)).alias("cells"))


@query(
    f"""WITH {tp.GRID_SQL} SELECT 'features' AS kind, 'n' AS name, sum(n)::DOUBLE AS total FROM grid UNION ALL SELECT 'features', 'v', sum(v) FROM grid
    UNION ALL SELECT 'predictions', 'pred_v', sum(v) FROM grid UNION ALL SELECT 'refused', 'pred_v and n', sum(v) FROM grid"""
)
def p9_classified(spark, sf):
    """What a panel's columns are, with their sums; both kinds in one panel are refused."""
    panel = tp.grid_panel(spark, sf)
    made = panel.select(*KEYS, F.col("v").alias("pred_v"))
    rows = []
    for df in (panel, made):
        kind, names = classify_columns(df, KEYS)
        rows += [df.agg(F.sum(c).cast("double").alias("total")).select(F.lit(kind).alias("kind"), F.lit(c).alias("name"), "total") for c in names]
    both = made.withColumn("n", F.lit(1))
    if refused(lambda: classify_columns(both, KEYS)):
        rows.append(both.agg(F.sum("pred_v").alias("total")).select(F.lit("refused").alias("kind"), F.lit("pred_v and n").alias("name"), "total"))
    found = rows[0]
    for df in rows[1:]:
        found = found.unionByName(df)
    return found


@query(f"WITH {tp.GRID_SQL} SELECT 0::INT AS place, 'v' AS target, sum(v)::DOUBLE AS total FROM grid UNION ALL SELECT 1, 'n', sum(n)::DOUBLE FROM grid")
def p16_all_targets(spark, sf):
    """Regression targets, then classification targets, of the panel; retired keys are refused (else there is a row more)."""
    panel = tp.grid_panel(spark, sf)
    targets = combined_targets({"regression_targets": ["v"], "classification_targets": "n"})
    if not refused(lambda: combined_targets({"depvar": "v"})):
        targets.append("v")
    tall = select.columns_of(panel, KEYS, targets).agg(*(F.sum(t).cast("double").alias(t) for t in targets)).unpivot([], targets, "target", "total")
    return tall.select(F.element_at(F.create_map(*(F.lit(x) for k, t in enumerate(targets) for x in (t, k))), F.col("target")).alias("place"), "target", "total")


@query(f"WITH {tp.GRID_SQL}, {tp.COUNTRY_SQL} SELECT 'n' AS target, (SELECT sum(n) FROM grid)::DOUBLE AS cells, (SELECT sum(n) FROM country)::DOUBLE AS countries")
def j14_common_targets(spark, sf):
    """The targets that cells and countries share, with both sums."""
    cells, countries = tp.grid_panel(spark, sf), tp.country_panel(spark, sf)
    shared = runs.common_targets(cells, countries)
    sums = lambda df, name: df.agg(*(F.sum(t).cast("double").alias(t) for t in shared)).unpivot([], shared, "target", name)
    return sums(cells, "cells").join(sums(countries, "countries"), "target")


@query(f"WITH {tp.GRID_SQL} SELECT level, fits, CASE WHEN fits THEN (SELECT count(*) FROM grid) ELSE 0 END AS n FROM (VALUES ('pgm', true), ('cm', false), ('pgy', false), ('cy', false)) t(level, fits)")
def v7_levels(spark, sf):
    """The levels whose key columns the panel has, with its rows."""
    panel = tp.grid_panel(spark, sf).withColumnRenamed("grid_id", "priogrid_id")
    n = panel.agg(F.count(F.lit(1)).alias("rows"))
    fits = F.create_map(*(F.lit(x) for level in ("pgm", "cm", "pgy", "cy") for x in (level, not audits.missing_keys(panel, level))))
    return n.select(F.explode(fits).alias("level", "fits"), "rows").select("level", "fits", F.when(F.col("fits"), F.col("rows")).otherwise(0).alias("n"))


@query(f"WITH {tp.MODELS_SQL} SELECT target, there, CASE WHEN there THEN (SELECT count(*) FROM points WHERE model = 'mid') ELSE 0 END AS n FROM (VALUES ('v', true), ('w', false)) t(target, there)")
def v9_prediction_columns(spark, sf):
    """Which targets a forecast has, with its rows."""
    mid = tp.model_points(spark, sf).where("model = 'mid'").select(*KEYS, F.col("forecast").alias("pred_v"))
    there = F.create_map(*(F.lit(x) for t in ("v", "w") for x in (t, t not in audits.missing_predictions(mid, ["v", "w"]))))
    return mid.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(there).alias("target", "there"), "rows").select("target", "there", F.when(F.col("there"), F.col("rows")).otherwise(0).alias("n"))


# Guards


@query(f"WITH {tp.MODELS_SQL}, whole AS (SELECT month_id, grid_id FROM points GROUP BY ALL HAVING count(*) = 3) SELECT method, method <> 'mean' AS refused, CASE WHEN method = 'mean' THEN (SELECT count(*) FROM whole) ELSE 0 END AS n FROM (VALUES ('mean'), ('median'), ('min'), ('max')) t(method)")
def e5_weights_only_with_mean(spark, sf):
    points, found = tp.model_points(spark, sf), None
    for method in ("mean", "median", "min", "max"):
        pooled = lambda m=method: pool.pool_points(points, KEYS, list(tp.MODELS), m, {"low": 0.5}, use_weights=True)
        wrong = refused(pooled)
        rows = points.where("false") if wrong else pooled()
        own = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(method).alias("method"), F.lit(wrong).alias("refused"), "n")
        found = own if found is None else found.unionByName(own)
    return found


@query(
    f"""WITH {UNEVEN_SQL.replace('SELECT model, CASE', 'SELECT model, month_id, grid_id, CASE')}, cells AS (SELECT month_id, grid_id, count(*) AS models, min(len(forecast)) AS least, max(len(forecast)) AS most FROM uneven GROUP BY ALL)
    SELECT 'missing' AS problem, count(*) AS n FROM cells WHERE models < 3 UNION ALL SELECT 'draws', count(*) FROM cells WHERE least <> most"""
)
def e11_pool_conflicts(spark, sf):
    return pool.pool_conflicts(uneven(spark, sf), KEYS, list(tp.MODELS))


@query(
    f"""WITH {CELLS_SQL}, counts AS (SELECT month_id, country_id, min(CASE WHEN grid_id % 10 = 0 THEN 4 ELSE 8 END) AS least, max(CASE WHEN grid_id % 10 = 0 THEN 4 ELSE 8 END) AS most FROM cells GROUP BY ALL)
    SELECT month_id, country_id, least::INT AS least, most::INT AS most, (CASE country_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 8 ELSE 5 END)::INT AS total FROM counts JOIN totals USING (month_id, country_id)
    WHERE least <> most OR country_id % 3 <> 0 AND most <> CASE country_id % 3 WHEN 1 THEN 8 ELSE 5 END"""
)
def r4_draw_conflicts(spark, sf):
    cells, totals = cells_and_totals(spark, sf)
    cells = cells.withColumn("value", F.when(F.col("grid_id") % 10 == 0, F.array_repeat("value", 4)).otherwise(F.array_repeat("value", 8)))
    n = F.when(F.col("country_id") % 3 == 0, 1).when(F.col("country_id") % 3 == 1, 8).otherwise(5)
    return reconcile.draw_conflicts(cells, totals.withColumn("total", F.array_repeat(F.col("total"), n)))


@query(f"WITH {tp.MODELS_SQL}, cells AS (SELECT month_id, grid_id, model FROM points WHERE model = 'high') SELECT 'missing' AS problem, count(*) AS n FROM (SELECT month_id, grid_id FROM grid ANTI JOIN cells USING (month_id, grid_id)) UNION ALL SELECT 'repeated', count(*) FROM cells")
def j11_misaligned(spark, sf):
    """Keys that a result lacks, and keys that it has twice."""
    high = tp.model_points(spark, sf).where("model = 'high'").drop("model")
    return align.misaligned(high.unionByName(high), tp.grid_panel(spark, sf), KEYS)


@query(f"WITH {tp.ALIGNED_SQL} SELECT kind, 13::INT AS expected, (SELECT count(DISTINCT origin) FROM forecasts) AS there FROM (VALUES ('live'), ('standard')) t(kind)")
def v0c_origin_counts(spark, sf):
    """Origins that each kind of evaluation has, and those that are there; other kinds are refused (else there is a row more)."""
    there = tp.origin_forecasts(spark, sf).agg(F.countDistinct("origin").alias("there"))
    kinds = {k: partitions.origins_of(k) for k in ("live", "standard")}
    if not refused(lambda: partitions.origins_of("long")):
        kinds["long"] = 0
    return there.select(F.explode(F.create_map(*(F.lit(x) for p in kinds.items() for x in p))).alias("kind", "expected"), "there")


@query(f"WITH {tp.GRID_SQL} SELECT 'late' AS name WHERE (SELECT count(*) FROM grid WHERE month_id > 400) = 0 UNION ALL SELECT 'panel' WHERE (SELECT count(*) FROM grid) = 0")
def v1_empty_tables(spark, sf):
    panel = tp.grid_panel(spark, sf)
    return audits.empty_tables({"panel": panel, "late": select.months(panel, 401, 500)})


@query(f"WITH {tp.GRID_SQL} SELECT 'column' AS problem, 'n' AS item, 1::BIGINT AS n UNION ALL SELECT 'rows', 'all', -count(*) FROM grid WHERE n % 6 = 0 HAVING count(*) > 0")
def v15_structure_changes(spark, sf):
    """A conversion that drops null cells and a column."""
    before = drifting(spark, sf).withColumnRenamed("b", "n")
    return audits.structure_changes(before, before.dropna(subset=["a"]).drop("n"), ["a", "n"])


@query(
    f"""WITH {tp.GRID_SQL}, {tp.COUNTRY_SQL}, last AS (SELECT max(month_id) AS m FROM country) SELECT name, name <> 'whole' AS refused, m::INT AS last, (SELECT count(*) FROM grid WHERE month_id BETWEEN m - 47 AND m) AS cells
    FROM last, (VALUES ('whole'), ('short'), ('overlapping')) t(name)"""
)
def v18_windows(spark, sf):
    """Which test windows, all ending in the last month with orders, fit a horizon of 36 steps and 12 shifts."""
    last = tp.country_panel(spark, sf).agg(F.max("month_id")).first()[0]
    cases = {"whole": {"train": (121, last - 48), "test": (last - 47, last)}, "short": {"train": (121, last - 47), "test": (last - 46, last)}, "overlapping": {"train": (121, last - 47), "test": (last - 47, last)}}
    wrong = F.create_map(*(F.lit(x) for name, ranges in cases.items() for x in (name, refused(lambda r=ranges: partitions.check_ranges(r, partitions.Horizon())))))
    cells = select.months(tp.grid_panel(spark, sf), last - 47, last).agg(F.count(F.lit(1)).alias("cells"))
    return cells.select(F.explode(wrong).alias("name", "refused"), F.lit(last).alias("last"), "cells")


@query(f"WITH {tp.GRID_SQL} SELECT 'u' AS target, 'missing' AS problem UNION ALL SELECT 'w', 'draws' FROM grid HAVING count(*) > 0")
def v19_bad_actuals(spark, sf):
    panel = tp.grid_panel(spark, sf).select(*KEYS, "v", F.array("v").alias("x"), F.array("v", "v").alias("w"))
    return audits.bad_actuals(panel, ["u", "v", "w", "x"])


# Tasks and strategies

TASKS = {"regression_targets": ["y", "z"], "classification_targets": ["c"], "regression_sample_metrics": ["CRPS"], "regression_point_metrics": ["MAE", "MSE"], "classification_point_metrics": ["Brier", "AP"]}


def grouped_sql(target: str, task: str, metric: str, row: str) -> str:
    """Scores of the aligned rows r (y, x) by step, month and origin."""
    groups = (("step", "format('step{:02d}', step)", "step"), ("month", "format('month{:d}', time)", "time"), ("time_series", "format('ts{:02d}', origin)", "origin"))
    return " UNION ALL ".join(f"SELECT '{task}' AS task, '{target}' AS target, '{kind}' AS eval_type, {label} AS group_id, '{metric}' AS metric, {settled_sql(f'avg({row})')} AS value FROM {target}_rows GROUP BY {by}" for kind, label, by in groups)


_LEVELS = " UNION ALL ".join(f"SELECT '{kind}' AS eval_type, {label} AS group_id, x[1] AS score, y FROM c_rows" for kind, label in (("step", "format('step{:02d}', step)"), ("month", "format('month{:d}', time)"), ("time_series", "format('ts{:02d}', origin)")))
_PRECISION = f"""SELECT 'classification_point', 'c', eval_type, group_id, 'AP', {settled_sql('sum(pos * tp / k) / nullif(sum(pos), 0)')} FROM (
    SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS k FROM (SELECT eval_type, group_id, score, sum(y)::DOUBLE AS pos, count(*) AS n FROM ({_LEVELS}) GROUP BY ALL) WINDOW w AS (PARTITION BY eval_type, group_id ORDER BY score DESC)
) GROUP BY eval_type, group_id"""


@query(
    f"""WITH {tp.ALIGNED_SQL}, y_rows AS (SELECT origin, time, step, y_true AS y, y_pred AS x FROM aligned), z_rows AS (SELECT origin, time, step, y_true AS y, [list_avg(y_pred)] AS x FROM aligned),
    c_rows AS (SELECT origin, time, step, (y_true > 150)::INT AS y, [(list_avg(y_pred) > 150)::INT * 0.8::DOUBLE + 0.1::DOUBLE] AS x FROM aligned)
    {grouped_sql('y', 'regression_sample', 'CRPS', ROW_SQL['CRPS'])} UNION ALL {grouped_sql('z', 'regression_point', 'MAE', 'abs(y - x[1])')} UNION ALL {grouped_sql('z', 'regression_point', 'MSE', '(y - x[1]) * (y - x[1])')}
    UNION ALL {grouped_sql('c', 'classification_point', 'Brier', '(y - x[1]) * (y - x[1])')} UNION ALL {_PRECISION}"""
)
def g6_task_scores(spark, sf):
    """Three targets, each scored by the metrics of its task: draws, points, and the chance of exceeding 150. Rows are aligned and written once for all."""
    rows = saved(aligned_rows(spark, sf))
    point = evaluate.collapsed(rows)
    chance = F.array(F.when(F.get("y_pred", F.lit(0)) > 150, 1).otherwise(0) * F.lit(0.8) + F.lit(0.1))
    binary = point.withColumns({"y_pred": chance, "y_true": (F.col("y_true") > 150).cast("int")})
    return settled(evaluate.task_scores({"y": rows, "z": point, "c": binary}, TASKS))


@query(f"WITH {UNEVEN_SQL.replace('forecast[1:4]', 'forecast[1:1]')} SELECT model, CASE WHEN least <> most THEN 'mixed' WHEN most = 1 THEN 'point' ELSE 'sample' END AS kind FROM per")
def g7_kinds(spark, sf):
    """Whether each model's forecasts are points, draws, or neither throughout."""
    cut = uneven(spark, sf).withColumn("forecast", F.when(F.col("model") == "high", F.slice("forecast", 1, 1)).otherwise(F.col("forecast")))
    return evaluate.kinds(cut, ["model"], "forecast")


POOLED_SQL = f"""{tp.MODELS_SQL}, {tp.TOTALS_SQL}, pooled AS (SELECT month_id, grid_id, avg(forecast) AS x FROM points GROUP BY ALL HAVING count(*) = 3),
    cells AS (SELECT month_id, grid_id, country_id, x, sum(x) OVER (PARTITION BY month_id, country_id) AS own FROM pooled JOIN hierarchy USING (grid_id))"""


@query(
    f"""WITH {POOLED_SQL} SELECT month_id, grid_id, country_id, {settled_sql('CASE WHEN own > 0 THEN x * total / own ELSE 0 END')} AS value, 'proportional' AS mode FROM cells JOIN totals USING (month_id, country_id)
    UNION ALL SELECT month_id, grid_id, country_id, {settled_sql('x')}, 'none' FROM cells UNION ALL SELECT month_id, grid_id, country_id, {settled_sql('x + 1')}, 'shifted' FROM cells"""
)
def x6_reconcilers(spark, sf):
    """The same cells by two reconcilers of the library and one of the caller's; they are pooled and written once for all."""
    points = tp.model_points(spark, sf)
    pooled = pool.pool_points(points, KEYS, list(tp.MODELS)).withColumnRenamed("forecast", "value")
    cells, totals = saved(reconcile.with_country(pooled, tp.hierarchy(spark, sf))), cells_and_totals(spark, sf)[1]
    shifted = "shifted", lambda c, t: runs.unchanged(c, t).withColumn("value", F.col("value") + 1)
    found = runs.reconciled(cells, totals, "proportional")
    for strategy in ("none", shifted):
        found = found.unionByName(runs.reconciled(cells, totals, strategy))
    return settled(found)


@query(
    f"""WITH {WIDE_SQL}, {tp.TOTALS_SQL}, pooled AS (SELECT month_id, grid_id, d, (a[d + 1] + b[d + 1] + c[d + 1]) / 3 AS x FROM wide, range(8) r(d)),
    cells AS (SELECT month_id, grid_id, country_id, d, x, sum(x) OVER (PARTITION BY month_id, country_id, d) AS own FROM pooled JOIN hierarchy USING (grid_id))
    SELECT month_id, grid_id, country_id, d::INT AS draw, {settled_sql('CASE WHEN own > 0 THEN x * (total * (1 + d / 10.0::DOUBLE)) / own ELSE 0 END', 4)} AS value FROM cells JOIN totals USING (month_id, country_id)"""
)
def e13_draw_ensemble(spark, sf):
    """Draws averaged over models, scaled to draws of country totals, and saved."""
    path = scratch(spark)

    def save(df: DataFrame) -> DataFrame:
        df.write.parquet(path)
        return spark.read.parquet(path)

    draws = tp.model_draws(spark, sf)
    totals = cells_and_totals(spark, sf)[1].withColumn("total", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda d: F.col("total") * (1 + d / F.lit(10.0))))
    found = runs.ensemble_forecast(draws, KEYS, list(tp.MODELS), tp.hierarchy(spark, sf), totals, "aligned", reconciler=("draws", runs.aligned_draws(tp.DRAWS)), save=save)
    return exploded(found, "value", 4, settle=True)


@query(
    f"""WITH {tp.ALIGNED_SQL}, rows AS (SELECT origin, time, step, least(y_true, 200) AS y, y_pred AS x FROM aligned), grouped AS (
    SELECT 'step' AS eval_type, format('step{{:02d}}', step) AS group_id, avg({ROW_SQL['MAE']}) AS value FROM rows GROUP BY step UNION ALL SELECT 'month', format('month{{:d}}', time), avg({ROW_SQL['MAE']}) FROM rows GROUP BY time
    UNION ALL SELECT 'time_series', format('ts{{:02d}}', origin), avg({ROW_SQL['MAE']}) FROM rows GROUP BY origin)
    SELECT eval_type, group_id, 'MAE' AS metric, {settled_sql()} AS value FROM grouped UNION ALL SELECT eval_type, 'mean', 'MAE', {settled_sql('avg(value)')} FROM grouped GROUP BY eval_type"""
)
def x8_prepared_actuals(spark, sf):
    """An evaluation whose actuals a hook cuts at 200 first."""
    cut = lambda df: df.withColumn("y_true", F.least("y_true", F.lit(200.0)))
    return settled(runs.evaluation(tp.origin_forecasts(spark, sf), tp.actuals(spark, sf), tp.BASE, ["MAE"], prepare=[cut]))


# Transforms by name

NAMED = {
    "t1": ("v", [("ops.ln", [])]),
    "t2": ("v", [("bool.gte", [150])]),
    "t3": ("holed", [("missing.fill", [])]),
    "t4": ("holed", [("missing.replace_na", [])]),
    "t5": ("v", [("temporal.tlag", [2])]),
    "t6": ("event", [("temporal.time_since", [])]),
    "t7": ("event", [("temporal.decay", [6])]),
    "t8": ("v", [("temporal.moving_sum", [3])]),
    "t9": ("v", [("temporal.moving_average", [6])]),
}


@query(ORACLE_SQL["t1_t9_temporal"])
def x4_registry(spark, sf):
    """The temporal transforms by their names in the registry; an unknown name is refused (else there is a column more)."""
    df = dense(spark, sf).withColumn("event", F.when(F.col("n") > 9, 1).otherwise(0))
    for out, (base, steps) in NAMED.items():
        df = transforms.apply_chain(df, KEYS, base, steps, out)
    names = list(NAMED)
    if not refused(lambda: transforms.apply_chain(df, KEYS, "v", [("temporal.unheard", [])], "x")):
        names.append("v")
    return rounded(df.select(*KEYS, *names), "t1", "t7", "t9")


@query(ORACLE_SQL["t11_adjacency_lag"])
def t11_countrylag_by_name(spark, sf):
    near = tp.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("place"), F.explode(F.array(F.col("s_suppkey") + 1, F.col("s_suppkey") + 3)).alias("neighbour"))
    return rounded(transforms.apply_chain(dense(spark, sf), KEYS, "holed", [("spatial.countrylag", [near])], "lagged").select(*KEYS, "lagged"), "lagged")


#: Operations as they are stored, last first, with their arguments as text.
OPERATIONS = [
    [{"namespace": "util", "name": "rename", "arguments": ["ln_v_lag"]}, {"namespace": "trf", "name": "temporal.tlag", "arguments": ["1"]}, {"namespace": "trf", "name": "ops.ln", "arguments": []}, {"namespace": "base", "name": "grid.v", "arguments": []}],
    [{"namespace": "trf", "name": "bool.gte", "arguments": ["2.5"]}, {"namespace": "base", "name": "grid.n", "arguments": []}],
]


@query(f"WITH {PANEL_SQL} SELECT month_id, grid_id, round(lag(ln(1 + v), 1) OVER (PARTITION BY grid_id ORDER BY month_id), 6) AS ln_v_lag, (n >= 2.5)::INT::DOUBLE AS n FROM dense")
def t14_t15_queryset(spark, sf):
    """Columns derived as stored operations say."""
    panel = dense(spark, sf).select(*KEYS, "v", F.col("n").alias("lines"))
    made = panel
    for base, steps, out in transforms.parse_queryset(OPERATIONS):
        made = transforms.apply_chain(made, KEYS, {"v": "v", "n": "lines"}[base.rsplit(".", 1)[-1]], steps, out)
    return rounded(made.select(*KEYS, "ln_v_lag", "n"), "ln_v_lag")


# Catalogue


@query(f"WITH {CATALOGUE_SQL} SELECT category, count(*) AS n, count(*) FILTER (file_id IN (SELECT file_id FROM docs WHERE file_id IS NOT NULL)) AS indexed FROM files GROUP BY category")
def k11_category_counts(spark, sf):
    return catalogue.category_counts(files(spark, sf), descriptions(spark, sf))
