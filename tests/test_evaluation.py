from functools import reduce

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.functions import draws
from panelforge.operators import align, audits, evaluate
from panelforge.schema import PanelError


def golden(spark):
    actuals = spark.createDataFrame([(t, u, float(10 * t + u)) for t in (10, 11, 12) for u in (1, 2)], "time int, unit int, y_true double")
    rows = [(o, t, u, [float(t + u), float(t - u)]) for o in (0, 1) for t in (10 + o, 11 + o) for u in (1, 2)]
    return actuals, spark.createDataFrame(rows, "origin int, time int, unit int, y_pred array<double>")


def test_two_origins_align(spark):
    actuals, forecasts = golden(spark)
    found = align.with_steps(align.align(forecasts, actuals), align.step_table(spark, 9, 2, 1)).collect()
    assert len(found) == 8
    assert {(r.origin, r.time, r.step) for r in found} == {(0, 10, 1), (0, 11, 2), (1, 11, 1), (1, 12, 2)}
    assert all(r.y_true == 10 * r.time + r.unit and r.y_pred == [r.time + r.unit, r.time - r.unit] for r in found)


def test_holes_in_forecasts_and_origins_without_overlap(spark):
    actuals, forecasts = golden(spark)
    holed = forecasts.where("not (time = 11 and unit = 2)").unionByName(forecasts.limit(1).withColumns({"origin": F.lit(7), "time": F.lit(99)}))
    aligned = align.align(holed, actuals)
    assert aligned.count() == 6
    assert [r.origin for r in align.empty_origins(holed, aligned).collect()] == [7]


def test_window_faults(spark):
    rows = [(o, 9 + o + s, 1) for o in range(3) for s in range(1, 3)] + [(1, 13, 1)]
    forecasts = spark.createDataFrame(rows, "origin int, time int, unit int")
    found = {r.origin: r.hint for r in audits.origin_windows(forecasts.where("origin <> 2"), 9, 2, 2).collect()}
    assert found == {1: "extra step", 2: "origin is missing"}
    assert {tuple(r) for r in align.outside_window(forecasts, align.step_table(spark, 9, 2, 2)).collect()} == {(1, 13)}
    shifted = forecasts.where("origin = 0").withColumn("time", F.col("time") + 1)
    assert audits.origin_windows(shifted, 9, 2, 0).first().hint == "origin is shifted"


def test_truncation_to_the_shortest_origin_keeps_other_groupings(spark):
    rows = [(o, 10 + o + s, 1, s, 1.0, [2.0]) for o, last in ((0, 3), (1, 2)) for s in range(1, last + 1)]
    aligned = spark.createDataFrame(rows, "origin int, time int, unit int, step int, y_true double, y_pred array<double>")
    groups = lambda df: {(r.eval_type, r.group_id) for r in df.collect()}
    cut = groups(evaluate.scored(aligned, ["MAE"]))
    assert ("step", "step03") not in cut and ("month", "month13") in cut and ("time_series", "ts00") in cut
    assert ("step", "step03") in groups(evaluate.scored(aligned, ["MAE"], cut_to_shortest=False))


def test_means_over_groups(spark):
    rows = [("month", "g1", "MSE", 2.0), ("month", "g1", "MAE", 1.0), ("month", "g2", "MSE", 4.0), ("month", "g2", "MAE", 3.0), ("month", "g3", "MAE", float("nan"))]
    scores = spark.createDataFrame(rows, "eval_type string, group_id string, metric string, value double")
    assert {r.metric: r.value for r in evaluate.with_means(scores).where("group_id = 'mean'").collect()} == {"MSE": 3.0, "MAE": 2.0}


def test_crps_equals_its_pairwise_form(spark):
    rng = np.random.default_rng(1)
    rows = [([float(v) for v in rng.normal(size=n)], float(rng.normal())) for n in (1, 2, 7, 30)]
    df = spark.createDataFrame(rows, "x array<double>, y double").select("x", "y", draws.crps(F.col("x"), F.col("y")).alias("s"), draws.twcrps(F.col("x"), F.col("y"), 0.2).alias("t"))
    for r in df.collect():
        for got, x, y in ((r.s, np.array(r.x), r.y), (r.t, np.maximum(r.x, 0.2), max(r.y, 0.2))):
            assert got == pytest.approx(np.abs(x - y).mean() - np.abs(x[:, None] - x).mean() / 2)


def test_ranking_shares_ties(spark):
    rows = [(1, [0.9]), (0, [0.9]), (1, [0.4]), (0, [0.1])]
    found = evaluate.ranking(spark.createDataFrame(rows, "y_true int, y_pred array<double>").withColumn("g", F.lit(1)), ["g"]).first()
    assert found.AUC == pytest.approx((0.5 + 1 + 0 + 1) / 4) and found.AP == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3)


def test_unknown_metric(spark):
    with pytest.raises(PanelError):
        evaluate.scored(golden(spark)[1], ["nothing"])


def test_hdi_and_mode(spark):
    rng = np.random.default_rng(2)
    x = np.sort(rng.gamma(2, 2, 60))
    df = spark.createDataFrame([([float(v) for v in rng.permutation(x)],)], "x array<double>")
    r = df.select(draws.nested_hdi(F.col("x"), (0.5, 0.9)).alias("h"), draws.mode(F.col("x")).alias("m"), draws.quantile(F.col("x"), 0.3).alias("q")).first()
    k = int(np.ceil(0.9 * 60))
    widths = x[k - 1 :] - x[: 60 - k + 1]
    at = widths.argmin()
    assert r.h[1].low <= x[at] + 1e-12 and r.h[1].high >= x[at + k - 1] - 1e-12
    assert r.h[0].low <= r.m <= r.h[0].high and r.h[1].low <= r.h[0].low and r.h[1].high >= r.h[0].high
    counts, edges = np.histogram(x, 100)
    assert r.m == pytest.approx((edges[counts.argmax()] + edges[counts.argmax() + 1]) / 2)
    assert r.q == pytest.approx(np.quantile(x, 0.3))
    assert spark.createDataFrame([([0.0, 0.0, 5.0],)], "x array<double>").select(draws.mode(F.col("x"))).first()[0] == 0.0


def test_crps_of_rows_of_any_length(spark):
    from panelforge.functions import draws

    rows = [(1.0, [0.0, 2.0, 4.0]), (2.0, [2.0]), (None, [1.0]), (1.0, []), (1.0, None), (1.0, [1.0, None]), (3.0, [5.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "y double, x array<double>").coalesce(1)
    found = [r.s for r in df.select(draws.crps(F.col("x"), F.col("y")).alias("s")).collect()]
    for (y, x), s in zip(rows, found, strict=True):
        if y is None or not x or None in x:
            assert s is None
        else:
            n = len(x)
            assert s == pytest.approx(sum(abs(v - y) for v in x) / n - sum(abs(a - b) for a in x for b in x) / (2 * n * n))


def rolling(spark):
    """Rows of three origins with ties, missing forecasts and missing outcomes; the last months of one origin have no forecast."""
    rng = np.random.default_rng(7)
    rows = []
    for o in range(3):
        for s in range(1, 5 if o else 4):
            for u in range(12):
                draw = [round(float(v), 1) for v in rng.gamma(2, 1, 4)]
                rows.append((o, 20 + o + s, u, s, None if (u + s) % 7 == 0 else float(rng.integers(0, 4)), None if u == 3 else [] if u == 4 and s > 2 else draw))
    return spark.createDataFrame(rows, "origin int, time int, unit int, step int, y_true double, y_pred array<double>")


def by_name(df):
    return {(r.eval_type, r.group_id, r.metric): r.value for r in df.collect()}


def test_streamed_scores_are_the_batch_scores(spark, tmp_path):
    from panelforge.streaming import increments

    rows, names = rolling(spark), [*evaluate.METRICS, *evaluate.RANKED]
    options = {"twCRPS": {"threshold": 0.7}, "MIS": {"alpha": 0.3}}
    want = by_name(evaluate.scored(rows, names, options=options))
    actuals = rows.select("time", "unit", "origin", "y_true")
    steps = align.step_table(spark, 20, 4, 2)
    for split in (1, 2, 5):
        out = f"{tmp_path}/{split}"
        # what happened differs by origin here, so each origin's is joined as its own units
        apart = lambda df: df.withColumn("unit", F.col("unit") + 100 * F.col("origin"))
        sink = increments.kept_states(out, apart(actuals).drop("origin"), steps, names, options)
        for k in range(split):
            batch = apart(rows).where(F.pmod(F.xxhash64("unit", "time"), F.lit(split)) == k).select("origin", "time", "unit", "y_pred")
            sink(batch, k)
            sink(batch, k)
        sink(apart(rows).where("unit < 0").select("origin", "time", "unit", "y_pred"), split)
        got = by_name(increments.streamed_scores(spark, out, names, options=options))
        assert got.keys() == want.keys()
        for key, value in want.items():
            assert got[key] == (None if value is None else pytest.approx(value, abs=1e-9)), key


def test_ranked_scores_by_group_equal_all_pairs(spark):
    rows = rolling(spark)
    scores = by_name(evaluate.scored(rows, ["AP", "AUC", "MAE"], cut_to_shortest=False))
    groups = {}
    for r in rows.collect():
        if r.y_true is not None and r.y_pred:
            for key in (("step", f"step{r.step:02d}"), ("month", f"month{r.time}"), ("time_series", f"ts{r.origin:02d}")):
                groups.setdefault(key, []).append((reduce(lambda a, b: a + b, r.y_pred, 0.0) / len(r.y_pred), r.y_true > 0))
    for key, own in groups.items():
        hits, misses = [s for s, t in own if t], [s for s, t in own if not t]
        auc = np.mean([(a > b) + (a == b) / 2 for a in hits for b in misses]) if hits and misses else None
        ap = sum(sum(t for s, t in own if s >= h) / sum(s >= h for s, _ in own) for h in hits) / len(hits)
        assert scores[(*key, "AUC")] == (None if auc is None else pytest.approx(auc)) and scores[(*key, "AP")] == pytest.approx(ap)


def test_slices_keep_the_order(spark):
    values = sorted([*np.random.default_rng(3).normal(size=400) * 10.0 ** np.arange(-200, 200), 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, np.nextafter(1, 2)])
    found = [r.s for r in spark.createDataFrame([(float(v),) for v in values], "v double").coalesce(1).select(evaluate.slice_of(F.col("v")).alias("s")).collect()]
    assert found == sorted(found)


def test_tasks_take_average_precision(spark):
    rows = rolling(spark).where("y_true is not null and size(y_pred) > 0").withColumn("y_pred", F.slice("y_pred", 1, 1))
    found = evaluate.task_scores({"c": rows}, {"classification_targets": ["c"], "classification_point_metrics": ["AP"]})
    assert {r.metric for r in found.collect()} == {"AP"} and {r.task for r in found.collect()} == {"classification_point"}
