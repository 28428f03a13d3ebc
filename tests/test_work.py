"""How often rows are made, grouped and moved, read off the plans."""

import re

from pyspark.sql import functions as F

from panelforge import queries, queries_runs
from panelforge.operators import catalogue, densify, pool
from panelforge.plans import testpanels as tp

SF = "/root/testdata/sf0.001"
KEYS = tp.GRID_KEYS


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def written(monkeypatch, module):
    """What a query saves on its way."""
    found, save = [], queries.saved
    monkeypatch.setattr(module, "saved", lambda df: found.append(df) or save(df))
    return found


def test_larger_tables_arrive_as_more_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "scratch", lambda spark, n=iter(range(99)): str(tmp_path / str(next(n))))
    monkeypatch.setattr(queries, "FILE_ROWS", 40)
    found = {tuple(r) for r in queries.x2_ranked_streamed(spark, SF).collect()}
    assert spark.read.parquet(str(tmp_path / "0" / "in")).select(F.input_file_name()).distinct().count() > 39
    monkeypatch.setattr(queries, "FILE_ROWS", 500_000)
    assert found == {tuple(r) for r in queries.x2_ranked_streamed(spark, SF).collect()}


def test_task_scores_read_written_rows(spark, monkeypatch):
    found = written(monkeypatch, queries_runs)
    assert "l_suppkey" not in optimized(queries_runs.g6_task_scores(spark, SF)) and len(found) == 1


def test_origins_are_pooled_where_they_lie(spark):
    rows = spark.createDataFrame([(m, "t", 1, k, 2, float(k)) for m in "ab" for k in range(3)], "model string, target string, origin int, month_id int, grid_id int, forecast double")
    pooled = pool.pool_origins(rows, ["month_id", "grid_id"], ["a", "b"])
    assert "Join" not in optimized(pooled)
    assert {tuple(r) for r in pooled.collect()} == {("t", 1, k, 2, float(k)) for k in range(3)}


def test_models_are_counted_without_moving_rows_twice(spark):
    rows = spark.createDataFrame([(m, 1, k, 1.0) for m in "abc" for k in range(4) if (m, k) != ("b", 3)] + [("d", 1, 3, 1.0), ("a", 1, 3, 5.0), (None, 1, 3, 1.0)], "model string, month_id int, grid_id int, forecast double")
    pooled = pool.pool_points(rows, KEYS, list("abc"))
    assert len(re.findall(r"Exchange hashpartitioning", executed(pooled))) == 1
    assert {r.grid_id for r in pooled.collect()} == {0, 1, 2}
    many = [f"m{i}" for i in range(130)]
    cells = spark.createDataFrame([(m, 1, k, 1.0) for k in (1, 2, 3) for m in many[: 130 - (k == 2) - 100 * (k == 3)]], rows.schema)
    assert [r.grid_id for r in pool.pool_points(cells, KEYS, many).collect()] == [1]


def test_differences_group_both_tables_once(spark):
    left = spark.createDataFrame([(1, [1.0]), (1, [1.0]), (1, [1.0]), (2, [2.0]), (3, None)], "k int, x array<double>")
    right = spark.createDataFrame([(1, [1.0]), (2, [2.0]), (2, [2.0]), (3, None), (4, [])], "k int, x array<double>")
    found = densify.differences(left, right)
    assert optimized(found).count("Aggregate [") == 1
    assert sorted((r.k, r.x, r.side) for r in found.collect()) == [(1, [1.0], "left"), (1, [1.0], "left"), (2, [2.0], "right"), (4, [], "right")]


def test_a_draw_is_hashed_once(spark):
    pooled = pool.pool_draws(tp.model_draws(spark, SF), KEYS, list(tp.MODELS), "resample", {"low": 0.2})
    assert optimized(pooled).count("md5(") == 1


def test_cells_are_pooled_once_for_all_reconcilers(spark, monkeypatch):
    found = written(monkeypatch, queries_runs)
    plan = optimized(queries_runs.x6_reconcilers(spark, SF))
    assert len(found) == 1 and "explode" not in plan


def test_contents_are_hashed_as_files_and_once(spark, monkeypatch, tmp_path):
    texts = {"a": "one\n", "b": "one\n", "c": "zwei \u00e4\n", "d": "\n"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    rows = spark.createDataFrame([(f"x/{n}", 0, bytearray(t.encode())) for n, t in texts.items()], "path string, modified int, content binary")
    files = {(r.name, r.size, r.hash) for r in catalogue.files_of(spark, str(tmp_path)).collect()}
    assert files == {(r.name, r.size, r.hash) for r in catalogue.hashed(rows).collect()} and len(files) == 4
    found = written(monkeypatch, queries)
    plan = optimized(queries.k4_files_by_content(spark, SF))
    assert len(found) == 1 and "sha2" not in plan and "binaryFile" not in plan
