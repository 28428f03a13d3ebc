import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.operators import pool
from panelforge.schema import PanelError

KEYS = ["month_id", "country_id"]


def draws(spark, **models):
    rows = [(m, k, 1, [float(x) for x in values]) for m, cells in models.items() for k, values in cells.items()]
    return spark.createDataFrame(rows, "model string, month_id int, country_id int, forecast array<double>")


@pytest.mark.parametrize(
    "given, wanted",
    [
        (None, {"a": 0.5, "b": 0.5}),
        ({"a": 0.8}, {"a": 0.8, "b": 0.2}),
        ({"a": 0.2, "b": 0.2}, {"a": 0.5, "b": 0.5}),
    ],
)
def test_weights(given, wanted):
    assert pool.normalised_weights(["a", "b"], given) == pytest.approx(wanted)


@pytest.mark.parametrize("given", [{"a": 0.7, "b": 0.6}, {"a": 1.0}, {"c": 0.1}, {"a": 0.999999999999, "d": 0.1}])
def test_bad_weights(given):
    with pytest.raises(PanelError):
        pool.normalised_weights(["a", "b"], given)


def test_weights_only_with_mean(spark):
    with pytest.raises(PanelError):
        pool.pool_points(spark.createDataFrame([], "model string, month_id int, country_id int, forecast double"), KEYS, ["a"], "median", use_weights=True)


def test_points_leave_nulls_out_or_count_them_as_zero(spark):
    df = spark.createDataFrame([("a", 1, 1, 2.0), ("b", 1, 1, None), ("a", 2, 1, 5.0)], "model string, month_id int, country_id int, forecast double")
    assert [tuple(r) for r in pool.pool_points(df, KEYS, ["a", "b"]).collect()] == [(1, 1, 2.0)]
    assert [tuple(r) for r in pool.pool_points(df, KEYS, ["a", "b"], "mean", {"a": 0.25}, True).collect()] == [(1, 1, 0.5)]


def test_vincent_is_the_mean_of_quantile_functions(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=16), rng.normal(3, 2, size=16)
    (row,) = pool.pool_draws(draws(spark, a={1: a}, b={1: b}), KEYS, ["a", "b"], "vincent", {"a": 0.3}).collect()
    q = np.linspace(0, 1, 16)
    assert row.forecast == pytest.approx(0.3 * np.quantile(a, q) + 0.7 * np.quantile(b, q))


def test_concat_and_aligned_keep_draw_order(spark):
    df = draws(spark, a={1: [1, 2, 3]}, b={1: [30, 20, 10]})
    assert pool.pool_draws(df, KEYS, ["a", "b"], "concat").first().forecast == [1, 2, 3, 30, 20, 10]
    assert pool.pool_draws(df, KEYS, ["a", "b"], "aligned").first().forecast == [15.5, 11, 6.5]


def test_resample_keeps_the_mixture_and_does_not_depend_on_partitions(spark):
    cells = {k: [0.0] * 40 for k in range(100)}
    df = draws(spark, a=cells, b={k: [1.0] * 40 for k in cells})
    results = [{r.month_id: tuple(r.forecast) for r in pool.pool_draws(df.repartition(n), KEYS, ["a", "b"], "resample", {"a": 0.8}).collect()} for n in (1, 4, 20)]
    assert results[0] == results[1] == results[2]
    share = np.mean([x for v in results[0].values() for x in v])
    assert abs(share - 0.2) < 0.03


def test_cells_that_a_model_lacks_are_left_out(spark):
    df = draws(spark, a={1: [1], 2: [1]}, b={1: [2]})
    assert [r.month_id for r in pool.pool_draws(df, KEYS, ["a", "b"], "concat").collect()] == [1]
    assert pool.complete(df, KEYS, 2).count() == 2


def test_origins_that_a_model_lacks(spark):
    df = spark.createDataFrame([("a", "t", 0), ("a", "t", 1), ("b", "t", 0)], "model string, target string, origin int")
    assert [tuple(r) for r in pool.origin_gaps(df, 2).collect()] == [("t", 1, 1)]
    assert df.select(F.count(F.lit(1))).first()[0] == 3


def test_draws_of_different_numbers_are_refused(spark):
    df = spark.createDataFrame([("a", 1, 1, [1.0, 2.0]), ("b", 1, 1, [1.0]), ("a", 1, 2, [1.0]), ("b", 1, 3, [1.0, 2.0])], "model string, month_id int, grid_id int, forecast array<double>")
    keys = ["month_id", "grid_id"]
    for method in ("vincent", "aligned"):
        with pytest.raises(Exception, match="different numbers of draws"):
            pool.pool_draws(df, keys, ["a", "b"], method).collect()
        assert pool.pool_draws(df.where("grid_id > 1"), keys, ["a", "b"], method).count() == 0
    assert {(r.problem, r.n) for r in pool.pool_conflicts(df, keys, ["a", "b"]).collect()} == {("missing", 2), ("draws", 1)}
