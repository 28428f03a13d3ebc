"""Mappings as of a month, key sets compared in one job, tiles with a border, files by content."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.functions import transforms
from panelforge.operators import align, catalogue, densify, reconcile, update
from panelforge.schema import PanelError

KEYS = ("month_id", "priogrid_id")


def shifting(spark):
    rng = np.random.default_rng(3)
    rows, now = [], {}
    for g in range(30):
        for m in range(100, 180):
            now[g] = int(rng.integers(0, 4)) if rng.random() < 0.1 or g not in now else now[g]
            if rng.random() > 0.05:
                rows.append((m, g, None if now[g] == 3 else now[g]))
    return spark.createDataFrame(rows, "month_id int, grid_id int, country_id int"), rows


@pytest.mark.parametrize("bins", [1, 7, 24, 500])
def test_country_as_of_a_month_is_the_mapping_of_that_month(spark, bins):
    mapping, rows = shifting(spark)
    intervals = reconcile.packed(mapping)
    assert intervals.count() < len(rows) / 3
    cells = spark.createDataFrame([(m, g, 1.0) for m in range(95, 185) for g in range(32)], "month_id int, grid_id int, value double")
    found = {(r.month_id, r.grid_id): r.country_id for r in reconcile.country_as_of(cells, intervals, bins).collect()}
    want = {(m, g): c for m, g, c in rows}
    assert len(found) == 90 * 32 and all(found[k] == want.get(k) for k in found)
    assert {r.grid_id for r in reconcile.cells_of_country(intervals, 1, 140).collect()} == {g for m, g, c in rows if m == 140 and c == 1}


def test_gaps_and_overlaps_of_a_mapping(spark):
    rows = [(m, 1, 5) for m in (1, 2, 5, 6)] + [(m, 2, 5) for m in (1, 2, 3)] + [(m, 2, 6) for m in (3, 4)] + [(1, 3, 5), (1, 3, 5)]
    found = reconcile.mapping_faults(reconcile.packed(spark.createDataFrame(rows, "month_id int, grid_id int, country_id int")))
    assert {tuple(r) for r in found.collect()} == {(1, "gap", 3, 4), (2, "overlap", 3, 3)}


def test_history_takes_the_first_source_with_the_same_keys(spark):
    reference = spark.createDataFrame([(m, k) for m in (1, 2) for k in (1, 2)], "month_id int, priogrid_id int")
    whole = reference.withColumns({"a": F.lit(1.0), "b": F.lit(2.0)})
    other = whole.withColumn("priogrid_id", F.col("priogrid_id") + 1)  # as many keys, but others
    sources = [("short", whole.limit(3)), ("other", other), ("whole", whole.withColumn("a", F.lit(7.0))), ("late", whole.withColumn("c", F.lit(3.0)))]
    found = align.history(reference, sources, ["a", "b", "c", "nowhere"], KEYS)
    assert found.columns == ["month_id", "priogrid_id", "a", "b", "c"] and {tuple(r[2:]) for r in found.collect()} == {(7.0, 2.0, 3.0)}
    prints = align.key_prints([("x", whole), ("y", whole.union(whole)), ("z", other), ("none", whole.limit(0))], KEYS)
    assert prints["x"] == prints["y"] != prints["z"] and prints["none"][0] == 0


def test_targets_meet_on_their_keys(spark):
    keyed = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "month_id int, priogrid_id int")
    a = spark.createDataFrame([(1, 1, 5.0), (1, 2, None)], "month_id int, priogrid_id int, a double")
    b = spark.createDataFrame([(1, 2, 7.0), (1, 1, 8.0), (1, 9, 1.0)], "month_id int, priogrid_id int, b double")
    assert {tuple(r) for r in align.on_keys(keyed, [a, b], KEYS).collect()} == {(1, 1, 5.0, 8.0), (1, 2, None, 7.0)}
    with pytest.raises(PanelError):
        align.on_keys(keyed, [a, a], KEYS)
    with pytest.raises(Exception, match="key twice"):
        align.on_keys(keyed, [a, b.union(b)], KEYS).collect()


def placed(spark, side=40, months=(1, 2, 13)):
    rng = np.random.default_rng(9)
    rows = [(m, r * side + c, r - 20, c, None if rng.random() < 0.1 else float(rng.integers(0, 5)), "x") for m in months for r in range(side) for c in range(side) if rng.random() < 0.8]
    return spark.createDataFrame([*rows, rows[0]], "month_id int, priogrid_id int, row int, col int, v double, `odd.name` string"), [*rows, rows[0]]


@pytest.mark.parametrize("reach", [1, 3])
def test_spatial_lag_across_tiles(spark, reach):
    df, rows = placed(spark)
    found = transforms.spatial_lag(df, KEYS, "v", "out", reach)
    assert found.columns == [*df.columns, "out"]
    at = {}
    for m, _, r, c, v, _ in rows:
        at.setdefault((m, r, c), []).append(v or 0.0)
    near = [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1) if i or j]
    for r in found.where("month_id = 1").collect():
        assert r.out == sum(sum(at.get((r.month_id, r.row + i, r.col + j), [])) for i, j in near)
    assert found.count() == len(rows)


def test_the_panel_moves_little_more_than_once(spark):
    df, rows = placed(spark)
    own = df.select(F.size(transforms.tiles(F.col("row") - 1, F.col("row") + 1, transforms.TILE)).alias("a"), F.size(transforms.tiles(F.col("col") - 1, F.col("col") + 1, transforms.TILE)).alias("b"))
    assert own.agg(F.sum(F.col("a") * F.col("b"))).first()[0] < 1.5 * len(rows)
    plan = transforms.spatial_lag(df, KEYS, "v", "out")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_spacetime_distance_across_tiles(spark):
    df, rows = placed(spark, 20, (1, 2, 9, 13))
    events = df.withColumn("e", (F.col("v") == 4).cast("int"))
    found = transforms.spacetime_distance(events, KEYS, "e", "d", reach=3, months=7)
    there = [(m, r, c) for m, _, r, c, v, _ in rows if v == 4]
    got = found.collect()
    assert len(got) == len(rows)
    for x in got[:300]:
        own = [((x.row - r) ** 2 + (x.col - c) ** 2 + ((x.month_id - m) / 7) ** 2) ** 0.5 for m, r, c in there if 0 <= x.month_id - m <= 7 and abs(x.row - r) <= 3 and abs(x.col - c) <= 3]
        assert x.d == (pytest.approx(min(own)) if own else None)


def test_densify_keeps_types_and_drops_places_without_the_last_month(spark):
    rows = [(1, 1, 2.0, [1.0], "a"), (3, 1, None, None, None), (3, 2, 4.0, [2.0], "b"), (1, 9, 5.0, [3.0], "c"), (None, 1, 1.0, [1.0], "d")]
    df = spark.createDataFrame(rows, "month_id int, priogrid_id int, v double, x array<double>, s string")
    found = densify.densify(df, KEYS, 2)
    assert found.dtypes == df.dtypes
    assert {(r.month_id, r.priogrid_id): (r.v, r.x, r.s) for r in found.collect()} == {(1, 1): (2.0, [1.0], "a"), (3, 1): (0.0, [0.0, 0.0], None), (1, 2): (0.0, [0.0, 0.0], None), (3, 2): (4.0, [2.0], "b")}
    assert densify.densify(df.limit(0), KEYS).isEmpty()


def test_files_are_known_by_their_bytes(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    for name, data in {"a.bin": b"one", "b.bin": b"two", "deep/c.bin": b"one", "deep/b.bin": b"new", "big.bin": b"z" * 5000, "empty.bin": b"", "other.txt": b"one"}.items():
        (tmp_path / "in" / name).write_bytes(data)
    files = catalogue.files_of(spark, f"{tmp_path}/in", "*.bin", largest=1000).withColumn("modified", F.lit(0)).persist()
    known = {r.path.rpartition("/in/")[2]: r.hash for r in files.collect()}
    assert known == {n: hashlib.sha256(d).hexdigest() for n, d in (("a.bin", b"one"), ("b.bin", b"two"), ("deep/c.bin", b"one"), ("deep/b.bin", b"new"))} | {"big.bin": None}
    assert [r.path.rpartition("/")[2] for r in catalogue.unhashed(files).collect()] == ["big.bin"]
    assert {(r.path.rpartition("/in/")[2], r["first"].rpartition("/in/")[2], r.by) for r in catalogue.copies(files).collect()} == {("deep/c.bin", "a.bin", "hash"), ("deep/b.bin", "b.bin", "name")}


def test_unfit_updates(spark):
    panel = spark.createDataFrame([(5, 1, 1.0)], "month_id int, priogrid_id int, raw_ged double")
    assert update.unfit(panel, panel, KEYS).isEmpty()
    assert [tuple(r) for r in update.unfit(panel, panel.withColumn("month_id", F.lit(4)), KEYS).collect()] == [("ends before the panel", 4)]
    assert [tuple(r) for r in update.unfit(panel.drop("raw_ged").withColumn("v", F.lit(1)), panel, KEYS).collect()] == [("no raw column", None), ("no shared column", None)]
    assert [r.problem for r in update.unfit(panel, panel.limit(0), KEYS).collect()] == ["ends before the panel"]
