import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelforge import schema
from panelforge.functions import transforms
from panelforge.operators import audits, catalogue, densify, drift, select, update
from panelforge.plans import partitions
from panelforge.schema import PanelError
from panelforge.sources import tables
from panelforge.streaming import increments

KEYS = ("month_id", "priogrid_id")


def panel(spark, rows):
    return spark.createDataFrame(rows, "month_id int, priogrid_id int, raw_ged double, other double")


def test_month_ids(spark):
    df = spark.createDataFrame([(dt.date(1990, 1, 5),), (dt.date(1980, 12, 1),)], "d date")
    found = df.select(schema.month_id(F.col("d")).alias("m")).select("m", schema.month_start(F.col("m")).alias("s")).collect()
    assert [(r.m, r.s) for r in found] == [(121, dt.date(1990, 1, 1)), (12, dt.date(1980, 12, 1))]


def test_schema_audits(spark):
    df = spark.createDataFrame([(1, 2, [1.0])], "month_id int, priogrid_gid int, pred_y array<double>")
    assert schema.as_panel(df, "pgm").columns == ["month_id", "priogrid_id", "pred_y"]
    for bad in (df.withColumn("priogrid_id", F.lit(1)), df.withColumn("month_id", F.lit(1.5)), df.drop("month_id")):
        with pytest.raises(PanelError):
            schema.as_panel(bad, "pgm")
    with pytest.raises(PanelError):
        schema.audit_schema(df.withColumn("pred_y", F.lit(1.0)), "pgm", ["pred_y"])
    with pytest.raises(PanelError):
        schema.classify_columns(df.withColumn("x", F.lit(1)), ("month_id", "priogrid_gid"))
    with pytest.raises(PanelError):
        schema.rename_features(df, {"pred_y": "month_id"})
    assert schema.combined_targets({"regression_targets": ["a"], "classification_targets": "b"}) == ["a", "b"]
    with pytest.raises(PanelError):
        schema.combined_targets({"targets": ["a"]})


def test_queryset_parsing_and_replay(spark):
    operations = [[{"namespace": "util", "name": "rename", "arguments": ["ged_lag"]}, {"namespace": "trf", "name": "temporal.tlag", "arguments": ["1"]}, {"namespace": "trf", "name": "ops.ln", "arguments": []}, {"namespace": "base", "name": "pgm.ged", "arguments": []}]]
    columns = transforms.parse_queryset(operations)
    assert columns == [("pgm.ged", [("ops.ln", []), ("temporal.tlag", [1])], "ged_lag")]
    df = panel(spark, [(m, g, float(m * g), 1.0) for m in range(1, 5) for g in (1, 2)])
    out = transforms.replay(df, KEYS, columns)
    assert "raw_ged" not in out.columns
    got = {(r.month_id, r.priogrid_id): r.ged_lag for r in out.collect()}
    import math

    assert got[1, 1] is None and got[3, 2] == pytest.approx(math.log1p(4))
    with pytest.raises(PanelError):
        transforms.replay(df.drop("raw_ged"), KEYS, columns)
    with pytest.raises(PanelError):
        transforms.apply_chain(df, KEYS, "raw_ged", [("no.such", [])], "x")


def test_update_keeps_new_rows_out_and_needs_fresh_data(spark):
    df = panel(spark, [(1, 1, 1.0, 5.0), (2, 1, 2.0, 6.0)])
    new = panel(spark, [(1, 1, 9.0, None), (2, 1, 8.0, 7.0), (3, 1, 1.0, 1.0)])
    assert {(r.month_id, r.raw_ged, r.other) for r in update.overwrite(df, new, KEYS, [1]).collect()} == {(1, 9.0, 5.0), (2, 2.0, 6.0)}
    with pytest.raises(PanelError):
        update.require_fresh(new, df)


def test_densify_drops_places_that_the_last_month_lacks(spark):
    df = spark.createDataFrame([(1, 1, 5.0, [1.0, 2.0]), (2, 1, 6.0, [3.0, 4.0]), (1, 2, 7.0, [0.0, 1.0]), (2, 3, 8.0, [5.0, 5.0])], "month_id int, priogrid_id int, v double, d array<double>")
    got = {(r.month_id, r.priogrid_id): (r.v, r.d) for r in densify.densify(df, KEYS, 2).collect()}
    assert set(got) == {(1, 1), (2, 1), (1, 3), (2, 3)} and got[1, 3] == (0.0, [0.0, 0.0])


def test_cells_round_trip_and_subset(spark):
    df = spark.createDataFrame([(1, 1, [1.0, 2.0], [3.0, 4.0]), (1, 2, [5.0, 6.0], [7.0, 8.0])], "month_id int, priogrid_id int, a array<double>, b array<double>")
    cells = select.long_cells(df, KEYS, ["a", "b"])
    assert cells.count() == 8 and densify.differences(df, select.wide_cells(cells, KEYS, ["a", "b"])).isEmpty()
    assert select.subset_cells(cells, KEYS, places=[2], samples=[1], variables=["b"]).first().value == 8.0
    with pytest.raises(PanelError):
        select.draws_of(df, [2], 2)
    with pytest.raises(PanelError):
        select.columns_of(df, KEYS, ["zz"])


def test_replace_missing_raises_negative_fill(spark):
    df = spark.createDataFrame([(float("nan"),), (-3.0,), (None,), (2.0,)], "x double")
    assert [r[0] for r in df.select(select.replace_missing(F.col("x"), -1)).collect()] == [0.0, 0.0, 0.0, 2.0]


def test_partitions():
    horizon = partitions.Horizon()
    assert horizon.origins == 13 and horizon.months == 48
    assert partitions.default_ranges("forecasting", 36, 500)["test"] == (501, 536)
    partitions.check_ranges(partitions.default_ranges("calibration"), horizon)
    assert partitions.month_range("calibration", partitions.default_ranges("calibration"), 400) == (121, 444)
    assert partitions.month_range("forecasting", partitions.default_ranges("forecasting", 36, 500), 490) == (121, 490)
    with pytest.raises(PanelError):
        partitions.origins_of("other")


def test_audits(spark):
    df = panel(spark, [(1, 1, 1.0, 1.0), (1, 1, 2.0, 1.0), (3, 1, 1.0, 1.0)])
    assert audits.repeated_keys(df, KEYS).first().n == 2
    assert {(r.month_id, r.problem) for r in audits.month_coverage(df, 1, 2).collect()} == {(2, "missing"), (3, "outside")}
    with pytest.raises(PanelError, match="twice"):
        audits.require_empty(audits.repeated_keys(df, KEYS), "twice")
    with pytest.raises(PanelError):
        audits.require_rows(df.where("false"))
    assert audits.same_content(df, df.repartition(3)) and not audits.same_content(df, df.limit(2))


def test_keys_and_predictions_of_a_level(spark):
    df = spark.createDataFrame([(1, 2, [1.0])], "month_id int, priogrid_id int, pred_y array<double>")
    assert audits.check_level(df, "pgm") is df and audits.check_predictions(df, ["y"]) is df
    with pytest.raises(PanelError, match="country_id"):
        audits.check_level(df, "cm")
    with pytest.raises(PanelError, match="z"):
        audits.check_predictions(df, ["y", "z"])
    assert audits.reusable(df, "pred_y", 1) and not audits.reusable(df.unionByName(df.withColumn("pred_y", F.array(F.lit(1.0), F.lit(2.0)))), "pred_y", 1)


def test_structure_and_actuals(spark):
    df = spark.createDataFrame([(1, 1, 1.0, [1.0]), (2, 1, 2.0, [1.0])], "month_id int, priogrid_id int, y double, z array<double>")
    assert audits.check_structure(df, df.select("y"), ["y"]).count() == 2
    assert audits.check_actuals(df, ["y", "z"]) is df
    for bad in (lambda: audits.check_structure(df, df.limit(1), ["y"]), lambda: audits.check_structure(df, df, ["q"]), lambda: audits.check_actuals(df, ["q"])):
        with pytest.raises(PanelError):
            bad()
    with pytest.raises(PanelError):
        audits.check_actuals(df.withColumn("z", F.array(F.lit(1.0), F.lit(2.0))), ["z"])


def test_runs(spark):
    from panelforge.plans import runs

    rows = [(m, g, float(m + g), None if g == 1 else 1.0) for m in (1, 2, 3) for g in (1, 2) if (m, g) != (2, 2)]
    out = runs.audited_panel(panel(spark, rows), KEYS, 1, 3, [("raw_ged", [("temporal.tlag", [1])], "lagged")])
    assert {(r.month_id, r.priogrid_id): r.lagged for r in out.collect()}[3, 2] == 0.0
    with pytest.raises(PanelError):
        runs.audited_panel(panel(spark, rows), KEYS, 0, 3)
    late = spark.createDataFrame([(0, 99, 1, [1.0])], "origin int, time int, unit int, y_pred array<double>")
    with pytest.raises(PanelError):
        runs.evaluation(late, late.select("time", "unit", F.lit(1.0).alias("y_true")), 9, ["MAE"], 2, 0)
    good = late.withColumn("time", F.lit(10))
    assert {r.value for r in runs.evaluation(good, good.select("time", "unit", F.lit(3.0).alias("y_true")), 9, ["MAE"], 2, 0).collect()} == {2.0}
    assert runs.common_targets(panel(spark, rows), panel(spark, rows).drop("other")) == ["raw_ged"]


def test_drift_alerts(spark):
    rows = [(m, g, None if m == 3 else 1.0, 100.0 if m == 40 else float(m % 5)) for m in range(1, 41) for g in (1, 2)]
    df = panel(spark, rows)
    found = drift.alerts(drift.rates(df, KEYS, ["raw_ged", "other"], "missing").unionByName(drift.extremes(df, KEYS, ["other"], 40)), "m")
    assert {("missing_month", "3", "severe"), ("extreme", "other", "severe")} <= {(r.check, r.item, r.severity) for r in found.collect()}


def test_sources(spark, tmp_path):
    df = panel(spark, [(m, 721, float(m), None) for m in (1, 2, 3)])
    for suffix in ("parquet", "csv"):
        path = f"{tmp_path}/x.{suffix}"
        tables.write_table(df, path)
        assert tables.read_table(spark, path, df.schema).count() == 3
    with pytest.raises(PanelError):
        tables.read_table(spark, "x.pkl")
    got = tables.fetch(spark, {"features": {"other": "o"}, "path": f"{tmp_path}/x.parquet"}, 2, 3)
    assert {(r.month_id, r.row, r.col, r.o) for r in got.collect()} == {(2, 2, 1, 0.0), (3, 2, 1, 0.0)}
    raw = tables.fetch(spark, {"features": ["other"], "path": f"{tmp_path}/x.parquet"}, 2, 3, fill=False)
    assert raw.first().other is None and raw.columns == ["month_id", "priogrid_id", "other"]
    made = tables.fetch(spark, {"pattern": "both", "n_entities": 5, "columns": 3}, 10, 11)
    assert {(r.priogrid_id, r.value) for r in made.collect()} == {(1, 0.0), (2, 1.0), (3, 2.0), (4, 1.0), (5, 2.0)} and made.count() == 10
    with pytest.raises(PanelError):
        tables.fetch(spark, {"nothing": 1}, 1, 2)


def test_cache_is_used_once_written_and_never_empty(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return panel(spark, [(1, 1, 1.0, 1.0)])

    for _ in range(2):
        assert tables.cached(spark, f"{tmp_path}/c", compute).count() == 1
    assert len(calls) == 1
    panel(spark, []).write.parquet(f"{tmp_path}/empty")
    with pytest.raises(PanelError):
        tables.cached(spark, f"{tmp_path}/empty", compute)


def test_publish_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(543, k, [float(k)] * 4) for k in range(6)], "month_id int, priogrid_id int, pred_y array<double>")
    manifest = tables.publish(df, f"{tmp_path}/p", "run", "y", {"source": "test"}).first()
    assert manifest.cell_count == 6 and [m.month_id for m in manifest.months] == [543]
    with pytest.raises(PanelError):
        tables.publish(df.unionByName(df.limit(1).withColumn("month_id", F.lit(544))), f"{tmp_path}/q", "run", "y", {})
    seen = []
    tables.to_sinks(df, [lambda d, m: seen.append((d.count(), m["k"]))] * 2, {"k": 1})
    assert seen == [(6, 1), (6, 1)]
    tables.write_predictions(df, "pgm", ["y"], f"{tmp_path}/w")
    assert tables.read_predictions(spark, f"{tmp_path}/w", "pgm", ["y"]).count() == 6


def test_catalogue_records(spark, tmp_path):
    rows = [("pgm", "a", "t", ["x"], "forecast", None, None, "1", dt.datetime(2024, 1, 1))]
    records = spark.createDataFrame(rows, catalogue.RECORD)
    catalogue.append(records, f"{tmp_path}/r")
    assert catalogue.record(spark.read.parquet(f"{tmp_path}/r"), "1").count() == 1
    with pytest.raises(PanelError):
        catalogue.append(records.withColumn("category", F.lit("other")), f"{tmp_path}/r")
    assert catalogue.newest(records, ["name"]).first().file_id == "1"


def test_corrections_arrive_as_files(spark, tmp_path):
    panel(spark, [(m, 1, float(m), 0.0) for m in (1, 2, 3)]).write.parquet(f"{tmp_path}/panel")
    schema_text = "month_id int, priogrid_id int, raw_ged double, arrived int"
    for k, (month, value) in enumerate(((2, 20.0), (3, 30.0), (2, 21.0))):
        spark.createDataFrame([(month, 1, value, k)], schema_text).coalesce(1).write.mode("append").parquet(f"{tmp_path}/new")
    arguments = (spark, f"{tmp_path}/new", schema_text, f"{tmp_path}/check", f"{tmp_path}/panel", f"{tmp_path}/versions", KEYS)
    columns = [("x.ged", [("temporal.tlag", [1])], "ged_lag")]
    for files in (10, 1):  # the second call finds nothing new
        found = increments.apply_corrections(*arguments, columns, files=files)
        assert {(r.month_id, r.ged_lag) for r in found.collect()} == {(1, None), (2, 1.0), (3, 21.0)}
    spark.createDataFrame([(2, 1, 5.0, 0)], schema_text).coalesce(1).write.mode("append").parquet(f"{tmp_path}/new")
    assert {(r.month_id, r.raw_ged) for r in increments.apply_corrections(*arguments).collect()} == {(1, 1.0), (2, 5.0), (3, 30.0)}
    none = increments.apply_corrections(spark, f"{tmp_path}/none", schema_text, f"{tmp_path}/check2", f"{tmp_path}/panel", f"{tmp_path}/versions2", KEYS) if spark.createDataFrame([], schema_text).write.parquet(f"{tmp_path}/none") is None else None
    assert none.count() == 3


def test_origins_one_at_a_time(spark, tmp_path):
    df = spark.createDataFrame([(o, t, 1.0) for o in range(3) for t in range(4)], "origin int, time int, value double")
    df.repartition(1).write.partitionBy("origin").parquet(f"{tmp_path}/in")
    increments.score_origins(spark, f"{tmp_path}/in", "time int, value double, origin int", f"{tmp_path}/check", increments.per_origin(f"{tmp_path}/out"))
    assert spark.read.parquet(f"{tmp_path}/out").count() == 12


def test_origins_of_several_files_lose_no_batch(spark, tmp_path):
    df = spark.createDataFrame([(o, t, 1.0) for o in range(2) for t in range(6)], "origin int, time int, value double")
    df.repartition(3, "time").write.partitionBy("origin").parquet(f"{tmp_path}/in")
    sink = increments.per_origin(f"{tmp_path}/out")
    taken = []

    def twice(rows, number):
        taken.append(number)
        sink(rows, number)
        sink(rows, number)

    increments.score_origins(spark, f"{tmp_path}/in", "time int, value double, origin int", f"{tmp_path}/check", twice)
    assert len(taken) > 2
    found = increments.origin_rows(spark, f"{tmp_path}/out")
    assert sorted((r.origin, r.time) for r in found.collect()) == [(o, t) for o in range(2) for t in range(6)]
