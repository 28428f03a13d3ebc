import numpy as np
import pytest

from panelforge.operators import reconcile
from panelforge.schema import PanelError

GRID = {11: 1, 12: 1, 21: 2, 22: 2, 23: 2}


def tables(spark, samples, country_samples, months=(1, 2, 3), seed=0):
    rng = np.random.default_rng(seed)
    cells = [(m, g, c, [float(x) for x in rng.uniform(0, 10, samples)]) for m in months for g, c in GRID.items()]
    cells[0] = (*cells[0][:3], [0.0] * samples)
    totals = [(m, c, [float(x) for x in rng.uniform(40, 120, country_samples)]) for m in months for c in (1, 2)]
    return (
        spark.createDataFrame(cells, "month_id int, grid_id int, country_id int, value array<double>"),
        spark.createDataFrame(totals, "month_id int, country_id int, total array<double>"),
        cells,
        {(m, c): t for m, c, t in totals},
    )


@pytest.mark.parametrize("samples, country_samples", [(4, 1), (8, 8), (16, 1)])
def test_sums_zeros_and_signs(spark, samples, country_samples):
    cells, countries, raw, totals = tables(spark, samples, country_samples)
    found = {(r.month_id, r.grid_id): r for r in reconcile.reconcile_draws(cells, countries, samples).collect()}
    assert len(found) == len(raw)
    for (month, country), total in totals.items():
        own = np.array([found[month, g].value for g, c in GRID.items() if c == country])
        assert (own >= 0).all()
        assert own.sum(0) == pytest.approx(np.broadcast_to(total, samples))
    assert found[1, 11].value == [0.0] * samples


def test_zero_sum_keeps_zeros_and_warns(spark):
    cells = spark.createDataFrame([(1, 11, 1, 0.0), (1, 12, 1, -2.0)], "month_id int, grid_id int, country_id int, value double")
    countries = spark.createDataFrame([(1, 1, 5.0)], "month_id int, country_id int, total double")
    assert {r.value for r in reconcile.reconcile_points(cells, countries).collect()} == {0.0}
    assert [r.kind for r in reconcile.alerts(cells, countries).collect()] == ["no cell"]


def test_unmapped_cells_and_missing_countries(spark):
    cells = spark.createDataFrame([(1, 11), (1, 99), (1, 21)], "month_id int, grid_id int")
    mapped = reconcile.with_country(cells, spark.createDataFrame([(11, 1), (21, 2)], "grid_id int, country_id int"))
    missing = reconcile.unmapped(mapped, spark.createDataFrame([(1, 1)], "month_id int, country_id int"))
    assert {(r.country_id, r.n) for r in missing.collect()} == {(None, 1), (2, 1)}


def test_sample_counts():
    reconcile.check_samples(1, 8)
    with pytest.raises(PanelError):
        reconcile.check_samples(4, 8)


def test_invariants_find_nothing_after_reconciling(spark):
    cells = spark.createDataFrame([(1, 11, 1, 2.0), (1, 12, 1, 0.0)], "month_id int, grid_id int, country_id int, value double")
    countries = spark.createDataFrame([(1, 1, 5.0)], "month_id int, country_id int, total double")
    after = reconcile.reconcile_points(cells, countries)
    assert reconcile.broken_invariants(cells, after, countries).isEmpty()
    assert not reconcile.broken_invariants(cells, cells, countries).isEmpty()


def test_totals_of_a_wrong_number_of_draws_are_refused(spark):
    cells = spark.createDataFrame([(1, 1, 1, [1.0, 2.0])], "month_id int, grid_id int, country_id int, value array<double>")
    for total, good in (([5.0], True), ([5.0, 6.0], True), ([1.0, 2.0, 3.0], False)):
        countries = spark.createDataFrame([(1, 1, total)], "month_id int, country_id int, total array<double>")
        assert reconcile.draw_conflicts(cells, countries).isEmpty() == good
        if good:
            assert reconcile.reconcile_draws(cells, countries, 2).count() == 1
        else:
            with pytest.raises(Exception, match="neither 1 nor 2 draws"):
                reconcile.reconcile_draws(cells, countries, 2).collect()


def failing(df):
    with pytest.raises(Exception, match="no country total|lacks origin|no finite draw") as found:
        df.write.format("noop").mode("overwrite").save()
    return str(found.value)


def test_cells_without_country_or_total_fail_the_job(spark):
    cells = spark.createDataFrame([(1, 11, 1, 2.0), (1, 12, 2, 3.0), (1, 13, None, 4.0), (2, 11, 1, 5.0)], "month_id int, grid_id int, country_id int, value double")
    countries = spark.createDataFrame([(1, 1, 5.0), (1, 2, None), (2, 9, 1.0)], "month_id int, country_id int, total double")
    assert {(r.month_id, r.country_id, r.n) for r in reconcile.unmapped(cells, countries).collect()} == {(1, 2, 1), (1, None, 1), (2, 1, 1)}
    for where in ("country_id = 2", "country_id is null", "month_id = 2"):
        assert "no country total" in failing(reconcile.reconcile_points(cells.where(where), countries))
        assert "no country total" in failing(reconcile.with_totals(cells.where(where), countries))
        arrays = cells.where(where).selectExpr("month_id", "grid_id", "country_id", "array(value) as value")
        assert "no country total" in failing(reconcile.reconcile_draws(arrays, countries.selectExpr("month_id", "country_id", "case when total is not null then array(total) end as total"), 1))
    assert "no country total" in failing(reconcile.reconcile_targets(cells, countries.withColumnRenamed("total", "value"), ["value"]))
    assert [tuple(r) for r in reconcile.reconcile_points(cells.where("grid_id = 11 and month_id = 1"), countries).collect()] == [(1, 11, 1, 5.0)]


def test_cells_without_a_value_stay_zero(spark):
    cells = spark.createDataFrame([(1, 11, 1, None)], "month_id int, grid_id int, country_id int, value double")
    countries = spark.createDataFrame([(1, 1, 5.0)], "month_id int, country_id int, total double")
    assert reconcile.reconcile_points(cells, countries).first().value == 0.0


def test_an_origin_that_a_model_lacks_fails_the_job(spark):
    from panelforge.operators import pool

    rows = [(m, "t", o, 1, 7, float(o)) for m in ("a", "b") for o in (0, 1)]
    schema = "model string, target string, origin int, month_id int, grid_id int, forecast double"
    whole = pool.pool_origins(spark.createDataFrame(rows, schema), ["month_id", "grid_id"], ["a", "b"])
    assert {(r.origin, r.forecast) for r in whole.collect()} == {(0, 0.0), (1, 1.0)}
    assert "lacks origin 1 of t" in failing(pool.pool_origins(spark.createDataFrame(rows[:3], schema), ["month_id", "grid_id"], ["a", "b"]))


def test_a_cell_without_a_finite_draw_fails_the_job(spark):
    from panelforge.operators import posterior

    rows = [(1, [1.0, float("nan"), 3.0]), (2, [float("inf"), None]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    assert {r.id for r in posterior.without_draws(df, ["id"], "x").collect()} == {2, 3, 4}
    for k in (2, 3, 4):
        assert "no finite draw" in failing(posterior.analysed(df.where(f"id = {k}"), ["id"], "x"))
        assert "no finite draw" in failing(posterior.statistics(df.where(f"id = {k}"), ["id"], ["x"]))
    assert posterior.statistics(df.where("id = 1"), ["id"], ["x"]).first()["mean"] == 2.0
