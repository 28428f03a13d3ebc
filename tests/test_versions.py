"""Versions that commit once, publications that go on where they stopped, corrections that are merged, and replay of what they touch."""

import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.functions import transforms
from panelforge.operators import affected, audits, update
from panelforge.schema import PanelError
from panelforge.sources import tables
from panelforge.sources.versions import Folder
from panelforge.streaming import increments

KEYS = ("month_id", "priogrid_id")


def numbers(spark, n):
    return spark.range(n).select(F.col("id").alias("k"))


def test_a_cache_that_stops_between_writing_and_commit_keeps_the_old_table(spark, tmp_path, monkeypatch):
    from panelforge.sources import versions

    path = f"{tmp_path}/c"
    assert tables.cached(spark, path, lambda: numbers(spark, 3)).count() == 3

    def stop(self, **facts):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions.Writer, "commit", stop)
    with pytest.raises(KeyboardInterrupt):
        tables.cached(spark, path, lambda: numbers(spark, 5), use_saved=False)
    assert tables.cached(spark, path, lambda: numbers(spark, 9)).count() == 3
    assert len(Folder(spark, path).names("versions")) == 2
    monkeypatch.undo()
    assert tables.cached(spark, path, lambda: numbers(spark, 5), use_saved=False).count() == 5
    assert len(Folder(spark, path).names("versions")) == 2  # the one before stays, what stopped is gone


def test_a_pointer_left_half_written_is_not_read(spark, tmp_path):
    path = f"{tmp_path}/c"
    tables.cached(spark, path, lambda: numbers(spark, 3))
    folder = Folder(spark, path)
    assert folder.write("", "pointers", f"{2:09d}")
    assert folder.current().number == 1 and tables.cached(spark, path, lambda: numbers(spark, 9)).count() == 3
    assert tables.cached(spark, path, lambda: numbers(spark, 4), use_saved=False).count() == 4
    assert folder.current().number == 3


def test_a_second_writer_is_refused_until_the_mark_is_stale(spark, tmp_path):
    path = f"{tmp_path}/c"
    folder = Folder(spark, path)

    def compute():
        with pytest.raises(PanelError, match="somebody else"):
            tables.cached(spark, path, lambda: numbers(spark, 7), use_saved=False)
        return numbers(spark, 2)

    assert tables.cached(spark, path, compute).count() == 2 and "WRITER" not in folder.names("")
    folder.write(json.dumps({"writer": "dead", "since": time.time() - 100}), "WRITER")
    with pytest.raises(PanelError, match="somebody else"):
        tables.cached(spark, path, lambda: numbers(spark, 7), use_saved=False)
    assert tables.cached(spark, path, lambda: numbers(spark, 7), use_saved=False, stale=50).count() == 7


def test_two_writers_with_one_number(spark, tmp_path):
    folder = Folder(spark, f"{tmp_path}/c")
    with folder.writing() as own:
        numbers(spark, 1).write.parquet(own.path)
        folder.write(json.dumps({"version": "other"}), "pointers", f"{own.number:09d}")
        with pytest.raises(PanelError, match="meanwhile"):
            own.commit()
    assert folder.current().facts["version"] == "other"


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_path):
    path = f"{tmp_path}/c"
    old = tables.cached(spark, path, lambda: numbers(spark, 3))
    tables.cached(spark, path, lambda: numbers(spark, 4), use_saved=False)
    assert old.count() == 3


def cells(spark, months=(543, 544, 545), n=6, add=0.0):
    return spark.createDataFrame([(m, k, [float(k) + add] * 4) for m in months for k in range(n)], "month_id int, priogrid_id int, pred_y array<double>")


def test_a_publication_goes_on_where_it_stopped(spark, tmp_path):
    path, df = f"{tmp_path}/p", cells(spark)
    schema = df.withColumn("source", F.lit("t")).schema
    first = tables.publish(df, path, "run", "y", {"source": "t"}).first()
    assert [m.month_id for m in first.months] == [543, 544, 545] and len({m.print for m in first.months}) == 3
    files = lambda: set(tables.shards(spark, path, schema).inputFiles())
    before = files()
    assert tables.publish(df, path, "run", "y", {"source": "t"}).first() == first and files() == before
    newer = cells(spark, (543, 545)).unionByName(cells(spark, (544,), add=1.0))
    second = tables.publish(newer, path, "run", "y", {"source": "t"}).first()
    assert {f.partition("month_id=")[2][:3] for f in files() - before} == {"544"}
    assert [a.print == b.print for a, b in zip(first.months, second.months, strict=True)] == [True, False, True]
    assert tables.stale_shards(spark, path, schema).isEmpty()
    with pytest.raises(PanelError, match="months that aren't given"):
        tables.publish(cells(spark, (543,)), path, "run", "y", {"source": "t"})


def test_damaged_shards_are_named(spark, tmp_path):
    path, df = f"{tmp_path}/p", cells(spark)
    schema = df.withColumn("source", F.lit("t")).schema
    tables.publish(df, path, "run", "y", {"source": "t"})
    cells(spark, (544,), add=2.0).drop("month_id").withColumn("source", F.lit("t")).write.mode("overwrite").parquet(f"{path}/shards/month_id=544")
    cells(spark, (599,)).drop("month_id").withColumn("source", F.lit("t")).write.parquet(f"{path}/shards/month_id=599")
    assert {tuple(r) for r in tables.stale_shards(spark, path, schema).collect()} == {(544, "changed"), (599, "extra")}


def test_a_month_of_other_size_gets_no_manifest(spark, tmp_path):
    df = cells(spark).unionByName(cells(spark, (546,), 5))
    with pytest.raises(PanelError, match="different numbers"):
        tables.publish(df, f"{tmp_path}/q", "run", "y", {})
    assert "manifest" not in Folder(spark, f"{tmp_path}/q").names("")


def grid(spark, side=6, months=14):
    rng = np.random.default_rng(1)
    rows = [(m, r * side + c + 1, r, c, None if rng.random() < 0.1 else float(rng.integers(0, 3))) for m in range(1, months + 1) for r in range(side) for c in range(side)]
    return spark.createDataFrame(rows, "month_id int, priogrid_id int, row int, col int, raw_ged double")


def chains(spark, side=6):
    pairs = [(k, k % (side * side) + 1) for k in range(1, side * side + 1)] + [(3, 30)]
    near = spark.createDataFrame(pairs, "place int, neighbour int")
    arguments = {"bool.gte": [1], "missing.replace_na": [0], "temporal.tlag": [2], "temporal.decay": [3], "temporal.moving_sum": [3], "temporal.moving_average": [2], "spatial.countrylag": [near], "spatial.treelag": [1], "spatial.sptime_dist": [1, 2]}
    return {name: arguments.get(name, []) for name in (*transforms.COLUMN_TRANSFORMS, *transforms.TABLE_TRANSFORMS)}


def rounded(df):
    return sorted((r.month_id, r.priogrid_id, *(None if v is None else round(v, 9) for v in r[4:])) for r in df.collect())


def test_replay_of_touched_cells_equals_a_full_replay(spark):
    panel, own = grid(spark).persist(), chains(spark)
    fixes = spark.createDataFrame([(5, 8, 9.0), (6, 8, 0.0), (3, 29, 4.0)], "month_id int, priogrid_id int, raw_ged double")
    now = update.overwrite(panel, fixes, KEYS).persist()
    ranges = affected.changed_ranges(fixes, KEYS)
    sets = [[(name, own[name])] for name in own] + [[("missing.replace_na", [0]), ("spatial.lag", []), ("temporal.moving_sum", [2]), ("temporal.tlag", [1])], [("temporal.tlag", [-1]), ("spatial.treelag", [1])]]
    for steps in sets:
        columns = [("x.ged", steps, "ged_out")]
        was, full = transforms.replay(panel, KEYS, columns), transforms.replay(now, KEYS, columns)
        touched, read = affected.replayed_cells(now, ranges, KEYS, columns)
        old = {r[:2]: r for r in rounded(was)}
        old |= {r[:2]: r for r in rounded(touched)}
        assert sorted(old.values()) == rounded(full), steps
        if not any(name in ("missing.fill",) for name, _ in steps):
            assert touched.count() < panel.count()


def test_the_cells_computed_go_with_the_corrections(spark):
    panel, columns = grid(spark, 12, 24), [("x.ged", [("missing.replace_na", [0]), ("temporal.moving_sum", [3]), ("temporal.tlag", [1])], "ged_out")]
    counts = []
    for k in (1, 4):
        fixes = spark.createDataFrame([(10, p, 5.0) for p in range(1, k + 1)], "month_id int, priogrid_id int, raw_ged double")
        touched, read = affected.replayed_cells(panel, affected.changed_ranges(fixes, KEYS), KEYS, columns)
        counts.append((touched.count(), read.count()))
    # months 10 to 13 are touched, and 7 to 13 are read
    assert counts == [(4, 7), (16, 28)]


def test_a_transform_without_a_reach_is_felt_everywhere(spark):
    panel = grid(spark, 3, 4)
    extra = {"own.mean": lambda df, keys, column, out: df.withColumn(out, F.lit(1.0))}
    fixes = spark.createDataFrame([(2, 1, 5.0)], "month_id int, priogrid_id int, raw_ged double")
    touched, _ = affected.replayed_cells(panel, affected.changed_ranges(fixes, KEYS), KEYS, [("x.ged", [("own.mean", [])], "ged_out")], extra)
    assert touched.count() == panel.count()
    none, _ = affected.replayed_cells(panel, affected.changed_ranges(fixes.limit(0), KEYS), KEYS, [("x.ged", [("own.mean", [])], "ged_out")], extra)
    assert none.isEmpty()


def arrive(spark, at, rows):
    schema = "month_id int, priogrid_id int, raw_ged double, arrived int"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{at}/new")
    increments.arrived(spark, f"{at}/new", schema, f"{at}/state", f"{at}/panel", f"{at}/versions", KEYS)


def test_batches_merge_into_a_base(spark, tmp_path, monkeypatch):
    from panelforge.sources import versions

    at = str(tmp_path)
    grid(spark, 2, 4).write.parquet(f"{at}/panel")
    found = lambda: {(r.month_id, r.priogrid_id): r.raw_ged for r in increments.corrections(spark, f"{at}/panel", f"{at}/versions", KEYS)[0].collect()}
    compact = lambda: increments.compact(spark, f"{at}/panel", f"{at}/versions", KEYS)
    folder = Folder(spark, f"{at}/versions")
    assert found() == {} and compact() is None
    for k in range(4):
        arrive(spark, at, [(1, 1, float(k), k), (2, 1 + k % 2, 10.0 + k, k)])
    want = {(1, 1): 3.0, (2, 1): 12.0, (2, 2): 13.0}
    assert found() == want and len(folder.names("batches")) > 3

    def stop(self, **facts):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions.Writer, "commit", stop)
    with pytest.raises(KeyboardInterrupt):
        compact()
    monkeypatch.undo()
    assert found() == want and folder.current() is None
    reader, _ = increments.corrections(spark, f"{at}/panel", f"{at}/versions", KEYS)
    base = compact()
    assert base.facts["upto"] == 3 and found() == want and compact() is None
    assert spark.read.parquet(base.path).count() == 3 and reader.count() == 3  # a reader from before still reads
    # reading now takes the base and nothing else
    files = increments.corrections(spark, f"{at}/panel", f"{at}/versions", KEYS)[0].inputFiles()
    assert [f for f in files if "/versions/versions/" in f]
    arrive(spark, at, [(1, 1, 50.0, 9)])
    want[1, 1] = 50.0
    assert found() == want
    assert compact().facts["upto"] == 4 and found() == want
    assert [n for n in folder.names("batches") if n.startswith("batch=")] == ["batch=4"]


def test_refreshed_equals_a_full_replay_with_compactions_between(spark, tmp_path):
    at, columns = str(tmp_path), [("x.ged", [("missing.replace_na", [0]), ("spatial.lag", []), ("temporal.moving_sum", [2])], "ged_near"), ("x.ged", [("temporal.decay", [4])], "ged_decay")]
    grid(spark).write.parquet(f"{at}/panel")
    places = f"{at}/panel", f"{at}/versions"

    def full():
        now = update.overwrite(spark.read.parquet(places[0]), increments.corrections(spark, *places, KEYS)[0], KEYS)
        return rounded(transforms.replay(now, KEYS, columns))

    refreshed = lambda: increments.refreshed(spark, *places, f"{at}/derived", KEYS, columns)
    first, counts = refreshed()
    assert rounded(first) == full() and counts["touched"] == first.count()
    for k, rows in enumerate(([(4, 8, 7.0, 0)], [(13, 1, 2.0, 1), (14, 36, 5.0, 1)], [(4, 8, 0.0, 2)], [(9, 20, 3.0, 3)])):
        arrive(spark, at, rows)
        if k in (1, 2):
            increments.compact(spark, *places, KEYS)
        if k != 1:
            found, counts = refreshed()
            assert rounded(found) == full() and 0 < counts["touched"] <= counts["needed"] < first.count()
    found, counts = refreshed()
    assert rounded(found) == full() and counts == {"touched": 0, "needed": 0}


def test_manifest_prints_do_not_depend_on_order(spark):
    df = cells(spark)
    one, other = (audits.manifest(x, "r", "t").first() for x in (df, df.repartition(5).orderBy(F.desc("priogrid_id"))))
    assert one == other
