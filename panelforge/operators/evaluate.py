"""Scores of aligned forecasts by lead time, month and origin."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import draws
from ..schema import PanelError
from .audits import draw_counts


def per_draw(score: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Column:
    """The mean of a score over a row's draws; a batch of rows is one call, and nothing is exploded."""
    return draws.mean_score(score)(F.col("y_pred"), F.col("y_true"))


def squared(y, p):
    """Of columns or arrays."""
    return (y - p) * (y - p)


def log_squared(y: np.ndarray, p: np.ndarray) -> np.ndarray:
    return squared(np.log1p(y), np.log1p(p))


def absolute(y: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.abs(y - p)


def tweedie(y: np.ndarray, p: np.ndarray, power: float = 1.5) -> np.ndarray:
    """Deviance of power between 1 and 2; forecasts below 1e-9 count as that."""
    q = np.maximum(p, 1e-9)
    return 2 * (y ** (2 - power) / ((1 - power) * (2 - power)) - y * q ** (1 - power) / (1 - power) + q ** (2 - power) / (2 - power))


@dataclass(frozen=True)
class Metric:
    """A score as a state that grows with rows and merges: a number for each row (y_true, y_pred array), sums of a group's rows, and the value of such sums.

    sums takes the name of the row's column and gives aggregates by field; value takes the fields, merged over any number of states.
    Fields in `moments` are means and central moments, which merge by the parallel formula; all others add up.
    """

    row: Column
    sums: Callable[[str], dict[str, Column]]
    value: Callable[[dict[str, Column]], Column]
    moments: bool = False

    def of_group(self, name: str) -> Column:
        """The value over a group in one aggregate."""
        return self.value(self.sums(name))


def mean_of(row: Column, turn: Callable[[Column], Column] = lambda c: c) -> Metric:
    """The mean of the row's number over the rows that have one."""
    return Metric(row, lambda c: {"n": F.count(c), "sum": F.sum(c)}, lambda f: turn(F.when(f["n"] > 0, f["sum"] / f["n"])))


def mean_draw() -> Column:
    return draws.mean(F.col("y_pred"))


def ratio_of_means() -> Metric:
    """The mean forecast over the mean of what happened; null where that is 0."""
    sums = lambda c: {"n": F.count(c), "sum": F.sum(c), "n_true": F.count("y_true"), "sum_true": F.sum("y_true")}
    return Metric(mean_draw(), sums, lambda f: F.when((f["n"] > 0) & (f["sum_true"] != 0), f["sum"] / f["n"] / (f["sum_true"] / f["n_true"])))


def correlation() -> Metric:
    """Of the mean forecast and what happened; null where either doesn't vary. Central moments keep it exact where sums of squares would cancel."""

    def sums(c: str) -> dict[str, Column]:
        both = F.col(c).isNotNull() & F.col("y_true").isNotNull()
        x, y = F.when(both, F.col(c)), F.when(both, F.col("y_true"))
        n = F.count(x)
        return {"n": n, "x": F.avg(x), "y": F.avg(y), "xx": F.var_pop(x) * n, "yy": F.var_pop(y) * n, "xy": F.covar_pop(x, y) * n}

    return Metric(mean_draw(), sums, lambda f: F.when((f["xx"] > 0) & (f["yy"] > 0), f["xy"] / F.sqrt(f["xx"] * f["yy"])), True)


#: By metric name. The row's number is computed once, before rows are dealt to the three groupings.
METRICS: dict[str, Callable[..., Metric]] = {
    "MSE": lambda: mean_of(per_draw(squared)),
    "MSLE": lambda: mean_of(per_draw(log_squared)),
    "RMSLE": lambda: mean_of(per_draw(log_squared), F.sqrt),
    "MAE": lambda: mean_of(per_draw(absolute)),
    "y_hat_bar": lambda: mean_of(mean_draw()),
    "Brier": lambda: mean_of(squared(F.col("y_true"), mean_draw())),
    "CRPS": lambda: mean_of(draws.crps(F.col("y_pred"), F.col("y_true"))),
    "twCRPS": lambda threshold=1.0: mean_of(draws.twcrps(F.col("y_pred"), F.col("y_true"), threshold)),
    "QIS": lambda low=0.05, high=0.95: mean_of((draws.pinball(F.col("y_pred"), F.col("y_true"), low) + draws.pinball(F.col("y_pred"), F.col("y_true"), high)) / 2),
    "MIS": lambda alpha=0.1: mean_of(draws.interval_score(F.col("y_pred"), F.col("y_true"), alpha)),
    "Coverage": lambda alpha=0.1: mean_of(draws.covered(F.col("y_pred"), F.col("y_true"), alpha)),
    "MCR_sample": ratio_of_means,
    "EMD": lambda: mean_of(per_draw(absolute)),
    "Pearson": correlation,
    "MTD": lambda: mean_of(per_draw(tweedie)),
}
#: Metrics of the order of the mean forecasts, whose state is how often each of them came true.
RANKED = ("AP", "AUC")
#: The three groupings by grouping_id over (step, time, origin), a set bit saying that the column isn't in the set.
STEP, MONTH, SERIES = 3, 5, 6


def label(by: str, value: Column) -> Column:
    return F.format_string({"step": "step%02d", "month": "month%d", "time_series": "ts%02d"}[by], value)


def chosen(metrics: Sequence[str], options: dict[str, dict] | None = None) -> dict[str, Metric]:
    """The metrics of these names that aren't ranked, with their arguments; an unknown name is an error."""
    unknown = [m for m in metrics if m not in METRICS and m not in RANKED]
    if unknown:
        raise PanelError(f"unknown metrics {unknown}")
    return {m: METRICS[m](**(options or {}).get(m, {})) for m in metrics if m not in RANKED}


def groupings(rows: DataFrame, *also: str):
    """rows by step, by time and by origin, each with further columns."""
    sets = [[F.col(c), *(F.col(x) for x in also)] for c in ("step", "time", "origin")]
    return rows.groupingSets(sets, "step", "time", "origin", *also)


def states(aligned: DataFrame, metrics: Sequence[str], options: dict[str, dict] | None = None) -> DataFrame:
    """(kind, step, time, origin, last, <metric>__<field>...): the state of each group, in one pass of grouping sets; last is its last step.

    States of several batches of rows are merged by merged(), and values() gives their scores. Ranked metrics have curve_states().
    """
    own = chosen(metrics, options)
    rows = aligned.select("step", "time", "origin", F.col("y_true").cast("double").alias("y_true"), F.col("step").alias("__step"), *(m.row.alias(name) for name, m in own.items()))
    fields = [column.alias(f"{name}__{field}") for name, m in own.items() for field, column in m.sums(name).items()]
    return groupings(rows).agg(F.grouping_id().alias("kind"), F.max("__step").alias("last"), *fields).select("kind", "step", "time", "origin", "last", *(f"{name}__{field}" for name, m in own.items() for field in m.sums(name)))


def merged(batches: DataFrame, metrics: Sequence[str], options: dict[str, dict] | None = None) -> DataFrame:
    """The states of groups (kind, step, time, origin) that have several, merged to one each."""
    group, own = ["kind", "step", "time", "origin"], chosen(metrics, options)
    out, over = [F.max("last").alias("last")], Window.partitionBy(*group)
    for name, m in own.items():
        column = lambda field, name=name: F.col(f"{name}__{field}")
        if not m.moments:
            out += [F.sum(column(f)).alias(f"{name}__{f}") for f in m.sums(name)]
            continue
        n = column("n")
        batches = batches.withColumns({f"__{name}_{f}": F.when(F.sum(n).over(over) > 0, F.sum(n * column(f)).over(over) / F.sum(n).over(over)) for f in ("x", "y")})
        dx, dy = column("x") - F.col(f"__{name}_x"), column("y") - F.col(f"__{name}_y")
        out += [F.sum(n).alias(f"{name}__n"), *(F.max(f"__{name}_{f}").alias(f"{name}__{f}") for f in ("x", "y"))]
        out += [F.sum(column(f) + n * by).alias(f"{name}__{f}") for f, by in (("xx", dx * dx), ("yy", dy * dy), ("xy", dx * dy))]
    return batches.groupBy(*group).agg(*out)


def curve_states(aligned: DataFrame) -> DataFrame:
    """(kind, step, time, origin, last, score, pos, neg): how often each mean forecast of a group came true (y_true > 0) and how often it didn't.

    Rows without a forecast or an outcome count neither way; they have a null score, if any. States of several batches are merged by merged_curve().
    """
    score = F.nanvl(mean_draw(), F.lit(None).cast("double"))
    rows = aligned.select("step", "time", "origin", F.col("step").alias("__step"), F.when(F.col("y_true").isNotNull(), score).alias("score"), "y_true")
    counts = groupings(rows, "score").agg(F.grouping_id().alias("__id"), F.max("__step").alias("last"), *outcomes())
    # score is in every set, so its bit, the last, is never set
    return counts.select(F.shiftright("__id", 1).alias("kind"), "step", "time", "origin", "last", "score", "pos", "neg")


def outcomes() -> list[Column]:
    """pos and neg: rows with a score whose outcome is above 0, or isn't."""
    there = F.col("score").isNotNull()
    return [F.count(F.when(there & (F.col("y_true") > 0), 1)).alias("pos"), F.count(F.when(there & (F.col("y_true") <= 0), 1)).alias("neg")]


def merged_curve(batches: DataFrame) -> DataFrame:
    """Curve states of several batches, one row for each group and score."""
    return batches.groupBy("kind", "step", "time", "origin", "score").agg(F.max("last").alias("last"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def group_names(found: DataFrame, cut_to_shortest: bool) -> DataFrame:
    """found (kind, step, time, origin, last, ..) of the groups that count, with their eval_type and group_id in place of these columns.

    With cut_to_shortest, steps beyond the last step of the shortest origin are left out. The groups of origins know their last steps, so
    rows aren't read again for it.
    """
    kind = F.when(F.col("kind") == STEP, "step").when(F.col("kind") == MONTH, "month").otherwise("time_series")
    group = F.when(F.col("kind") == STEP, label("step", F.col("step"))).when(F.col("kind") == MONTH, label("month", F.col("time"))).otherwise(label("time_series", F.col("origin")))
    if cut_to_shortest:
        # a few hundred groups, one row each
        found = found.withColumn("__cut", F.min(F.when(F.col("kind") == SERIES, F.col("last"))).over(Window.partitionBy())).where(f"kind <> {STEP} or step <= __cut")
    rest = [c for c in found.columns if c not in ("kind", "step", "time", "origin", "last", "__cut")]
    return found.where(f"not (kind = {STEP} and step is null)").select(kind.alias("eval_type"), group.alias("group_id"), *rest)


def values(groups: DataFrame, metrics: Sequence[str], cut_to_shortest: bool = True, options: dict[str, dict] | None = None) -> DataFrame:
    """(eval_type, group_id, metric, value) of states, one for each group."""
    own = chosen(metrics, options)
    scores = [m.value({f: F.col(f"{name}__{f}") for f in m.sums(name)}).alias(name) for name, m in own.items()]
    found = group_names(groups, cut_to_shortest).select("eval_type", "group_id", *scores)
    return found.unpivot(["eval_type", "group_id"], list(own), "metric", "value")


def ranked_values(curve: DataFrame, metrics: Sequence[str], cut_to_shortest: bool = True) -> DataFrame:
    """(eval_type, group_id, metric, value) of AP and AUC from curve states, one row for each group and score."""
    own = [m for m in metrics if m in RANKED]
    named = group_names(areas(curve, ["kind", "step", "time", "origin"], "last"), cut_to_shortest)
    return named.select("eval_type", "group_id", *own).unpivot(["eval_type", "group_id"], own, "metric", "value")


def scored(aligned: DataFrame, metrics: Sequence[str], cut_to_shortest: bool = True, options: dict[str, dict] | None = None) -> DataFrame:
    """(eval_type, group_id, metric, value): every metric by step, month and origin, in one pass of grouping sets, and one more if AP or AUC are among them.

    With cut_to_shortest, steps beyond the last step of the shortest origin have no group of their own; their rows count by month and
    origin. options holds a metric's arguments: {"twCRPS": {"threshold": 25.0}}.
    """
    own, found = chosen(metrics, options), []
    if own:
        found.append(values(states(aligned, metrics, options), metrics, cut_to_shortest, options))
    if len(own) < len(metrics):
        found.append(ranked_values(curve_states(aligned), metrics, cut_to_shortest))
    return reduce(DataFrame.unionByName, found)


def with_means(scores: DataFrame) -> DataFrame:
    """scores and a row `mean` for each metric: over its groups, missing values left out."""
    keys = [c for c in scores.columns if c not in ("group_id", "value")]
    value = F.nanvl("value", F.lit(None).cast("double"))
    means = scores.groupBy(*keys).agg(F.avg(value).alias("value")).withColumn("group_id", F.lit("mean"))
    return scores.unionByName(means.select(*scores.columns))


def group_number(group_id: Column) -> Column:
    """The number in step01, month445 or ts00; null in others."""
    return F.when(group_id.rlike(r"\d"), F.regexp_extract(group_id, r"\d+", 0).cast("int"))


def metric_names(scores: DataFrame) -> DataFrame:
    """scores with the group's number, and the metric's name with its target and kind of group."""
    return scores.select("*", group_number(F.col("group_id")).alias("group_number"), F.format_string("%s/%s", F.col("eval_type"), F.col("metric")).alias("full_name"))


def slice_of(score: Column, per_octave: int = 256) -> Column:
    """A number that never falls as the score rises, equal for scores of the same sign within about 0.3 % of each other."""
    octave = lambda x: F.floor(F.log2(x) * per_octave)
    return F.when(score > 0, octave(score) + 1_000_000).when(score < 0, -octave(-score) - 1_000_000).otherwise(0).cast("long")


def areas(counts: DataFrame, by: Sequence[str], *also: str) -> DataFrame:
    """(by, AP, AUC) of counts (by, score, pos, neg), one row for each group and distinct score: average precision and area under the curve, ties shared; null where a class is missing.

    Scores are put into slices by their size. What lies in higher slices is summed over slices, of which a group has a bounded number,
    and what lies above a score in its slice within the slice; so no task sorts a whole group. The greatest value of further columns goes along.
    """
    rows = counts.withColumn("__slice", slice_of(F.col("score")))
    # both uses of rows take the same columns, so that Spark makes them once
    totals = rows.groupBy(*by, "__slice").agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"), *(F.max(c).alias(f"__max_{c}") for c in also))
    higher = Window.partitionBy(*by).orderBy(F.desc("__slice")).rowsBetween(Window.unboundedPreceding, -1)
    above = [F.coalesce(F.sum(f"__{x}").over(higher), F.lit(0)).alias(f"__above_{x}") for x in "pn"]
    above = totals.select(*(F.col(c).alias(f"__{c}") for c in by), F.col("__slice").alias("__own"), *(f"__max_{c}" for c in also), *above)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    within = Window.partitionBy(*by, "__slice").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    carried = [F.greatest(c, f"__max_{c}").alias(c) for c in also]
    running = rows.join(above, [*same, F.col("__slice") == F.col("__own")]).select(*by, *carried, "pos", "neg", (F.sum("pos").over(within) + F.col("__above_p")).alias("tp"), (F.sum("neg").over(within) + F.col("__above_n")).alias("fp"))
    found = running.groupBy(*by).agg(
        F.sum(F.when(F.col("pos") > 0, F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))).alias("__ap"),
        F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)).alias("__u"),
        F.sum("pos").alias("__p"),
        F.sum("neg").alias("__n"),
        *(F.max(c).alias(c) for c in also),
    )
    return found.select(*by, *also, F.when(F.col("__p") > 0, F.col("__ap") / F.col("__p")).alias("AP"), F.when((F.col("__p") > 0) & (F.col("__n") > 0), F.col("__u") / F.col("__p") / F.col("__n")).alias("AUC"))


def ranking(aligned: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, AP, AUC) of the mean forecasts of each group; rows without a forecast or an outcome count neither way."""
    score = F.nanvl(mean_draw(), F.lit(None).cast("double"))
    rows = aligned.select(*by, "y_true", F.when(F.col("y_true").isNotNull(), score).alias("score"))
    return areas(rows.groupBy(*by, "score").agg(*outcomes()), by)


def collapsed(aligned: DataFrame) -> DataFrame:
    """Draws reduced to their mean, as arrays of one."""
    return aligned.withColumn("y_pred", F.array(draws.mean(F.col("y_pred"))))


def kinds(forecasts: DataFrame, by: Sequence[str] = (), column: str = "y_pred") -> DataFrame:
    """(by, kind): `point` where every cell has one draw, `sample` where all have the same number above one, else `mixed`."""
    counts = draw_counts(forecasts, [column], by)
    kind = F.when(F.col("least") != F.col("most"), "mixed").when(F.col("most") == 1, "point").otherwise("sample")
    return counts.select(*by, kind.alias("kind"))


def kinds_of(aligned: dict[str, DataFrame]) -> dict[str, str]:
    """Of each table by name `point` or `sample`, in one job; cells of both kinds, or of several numbers of draws, are an error."""
    if not aligned:
        return {}
    found = {r.name: r.kind for r in reduce(DataFrame.unionByName, (kinds(df).select(F.lit(name).alias("name"), "kind") for name, df in aligned.items())).collect()}
    if "mixed" in found.values():
        raise PanelError("forecasts have different numbers of draws")
    return found


def kind_of(aligned: DataFrame) -> str:
    """kinds_of one table."""
    return kinds_of({"": aligned})[""]


def task_scores(aligned: dict[str, DataFrame], config: dict, options: dict[str, dict] | None = None) -> DataFrame:
    """(task, target, eval_type, group_id, metric, value) of every declared target (aligned by its name) by the metrics of its task.

    A target's task is regression or classification as the configuration declares it, point or sample as its forecasts are. A
    configuration that gives a target's task no metrics is an error, and so is a declared target without forecasts. Each target's rows are
    read once for its kind and once or twice for its scores, so rows that are costly to make should be written before.
    """
    lists, found = task_metrics(config), []
    declared = [t for task in ("regression", "classification") for t in config.get(f"{task}_targets") or []]
    own_kinds = kinds_of({t: aligned[t] for t in declared if t in aligned})
    for task in ("regression", "classification"):
        for target in config.get(f"{task}_targets") or []:
            if target not in aligned:
                raise PanelError(f"no forecasts of {target}")
            name = f"{task}_{own_kinds[target]}"
            if name not in lists:
                raise PanelError(f"no metrics for {name}")
            scores = scored(aligned[target], lists[name], options=options)
            found.append(scores.select(F.lit(name).alias("task"), F.lit(target).alias("target"), *scores.columns))
    if not found:
        raise PanelError("no targets are declared")
    return reduce(DataFrame.unionByName, found)


def task_metrics(config: dict) -> dict[str, list[str]]:
    """Metrics by task (regression or classification, point or sample) of a configuration that declares targets for it."""
    found = {}
    for task in ("regression", "classification"):
        for kind in ("point", "sample"):
            names = config.get(f"{task}_{kind}_metrics") or []
            if config.get(f"{task}_targets") and names:
                found[f"{task}_{kind}"] = list(names)
    return found


def records(scores: DataFrame, **provenance: str) -> DataFrame:
    """scores with where they come from: model, run type, partition, level, run and data version."""
    return scores.withColumns({k: F.lit(v) for k, v in provenance.items()})
