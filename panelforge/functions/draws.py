"""Arrays of posterior draws: element-wise arithmetic, summaries and scores, as column expressions; CRPS works on batches of rows, all else is built-in.

Draws are array<double> (or float). Empty or null arrays give null summaries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def mean(x: Column) -> Column:
    return F.when(F.size(x) > 0, total(x) / F.size(x))


def deviation(x: Column) -> Column:
    """Population standard deviation."""
    return let(mean(x), lambda m: F.sqrt(total(F.transform(x, lambda v: (v - m) * (v - m))) / F.size(x)))


def quantile_sorted(s: Column, q: float) -> Column:
    """Linear interpolation between the order statistics of a sorted array."""
    at = (F.size(s) - 1) * F.lit(q)
    low = F.floor(at).cast("int")
    high = F.least(low + 1, F.size(s) - 1)
    return F.when(F.size(s) > 0, F.get(s, low) + (F.get(s, high) - F.get(s, low)) * (at - low))


def quantile(x: Column, q: float) -> Column:
    return let(F.array_sort(x), lambda s: quantile_sorted(s, q))


def finite(x: Column) -> Column:
    """Without null, NaN and infinite draws."""
    return F.filter(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def some_finite(x: Column) -> Column:
    """finite(x), of which a row without any fails the job."""
    error = F.raise_error(F.lit("a cell has no finite draw"))
    return let(finite(x), lambda own: F.when(F.coalesce(F.size(own), F.lit(0)) > 0, own).otherwise(F.from_json(error.cast("string"), "array<double>")))


def zero_share(x: Column, tolerance: float = 1e-8) -> Column:
    return F.when(F.size(x) > 0, F.size(F.filter(x, lambda v: F.abs(v) <= tolerance)) / F.size(x))


def mode(x: Column, zero_mass: float = 0.3, bins: int = 100) -> Column:
    """0 if the share of zeros is zero_mass or more, else the centre of the fullest of equal bins from least to greatest draw (the lowest of ties)."""

    def fullest(s: Column) -> Column:
        low, width = F.get(s, F.lit(0)), (F.get(s, F.size(s) - 1) - F.get(s, F.lit(0))) / bins
        placed = F.transform(s, lambda v: F.least(F.floor((v - low) / width), F.lit(bins - 1)).cast("int"))

        # bins of a sorted array come in runs: (bin, run length so far, best length, best bin)
        def run(state: Column, b: Column) -> Column:
            n = F.when(b == state["bin"], state["n"] + 1).otherwise(1)
            better = n > state["best"]
            return F.struct(b.alias("bin"), n.alias("n"), F.when(better, n).otherwise(state["best"]).alias("best"), F.when(better, b).otherwise(state["at"]).alias("at"))

        start = F.struct(F.lit(-1).alias("bin"), F.lit(0).alias("n"), F.lit(0).alias("best"), F.lit(0).alias("at"))
        centre = let(placed, lambda p: low + (F.aggregate(p, start, run)["at"] + 0.5) * width)
        return F.when(width == 0, low).otherwise(centre)

    return F.when(F.size(x) > 0, F.when(zero_share(x) >= zero_mass, F.lit(0.0)).otherwise(let(F.array_sort(x), fullest)))


def hdi_sorted(s: Column, mass: float) -> Column:
    """(low, high) of the shortest interval that holds ceil(mass * n) draws, the lowest of ties; with one such draw, a single point."""
    k = F.greatest(F.ceil(F.size(s) * F.lit(mass)).cast("int"), F.lit(1)) - 1
    spans = F.transform(
        F.sequence(F.lit(0), F.size(s) - 1 - k),
        lambda i: F.struct((F.get(s, i + k) - F.get(s, i)).alias("width"), F.get(s, i).alias("low"), F.get(s, i + k).alias("high")),
    )
    return let(F.array_min(spans), lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high")))


def nested_hdi(x: Column, masses: Sequence[float] = (0.5, 0.95, 0.99), centre: Column | None = None) -> Column:
    """Intervals for ascending masses: the narrowest is shifted to hold the centre, wider ones are stretched to hold the ones before."""

    def all_of(s: Column) -> Column:
        point = mode(x) if centre is None else centre
        out: list[Column] = []
        for m in masses:
            own = hdi_sorted(s, m)
            if not out:
                shift = F.when(point < own["low"], point - own["low"]).when(point > own["high"], point - own["high"]).otherwise(0.0)
                low, high = own["low"] + shift, own["high"] + shift
            else:
                low, high = F.least(own["low"], out[-1]["low"]), F.greatest(own["high"], out[-1]["high"])
            out.append(F.struct(low.alias("low"), high.alias("high")))
        return F.array(*out)

    return let(F.array_sort(x), all_of)


def zip_sum(arrays: Sequence[Column], weights: Sequence[float | Column]) -> Column:
    """Element-wise weighted sum."""

    def times(weight: float | Column) -> Callable[[Column], Column]:
        return lambda v: v * weight

    scaled = [F.transform(a, times(w)) for a, w in zip(arrays, weights, strict=True)]
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), scaled)


def resize(x: Column, size: int) -> Column:
    """A shorter array repeated in turn up to size."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.get(x, i % F.size(x)))


def pick(x: Column, at: Sequence[int]) -> Column:
    """The draws of these places, from 0; a place beyond the array is null."""
    return F.transform(F.array(*(F.lit(i) for i in at)), lambda i: F.get(x, i))


def digest(seed: int, *of: Column) -> Column:
    """The md5 of seed and values, colons between."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(c.cast("string") for c in of)))


def number(part: int, of: Column) -> Column:
    """A whole number from 0 to 2^32 - 1: 8 hexadecimal digits of a digest, from the part-th (0 to 3) on."""
    return F.conv(F.substring(of, 8 * part + 1, 8), 16, 10).cast("long")


def chance(part: int, seed: int, *of: Column) -> Column:
    """A whole number from 0 to 2^32 - 1, fixed by seed and values."""
    return number(part, digest(seed, *of))


def drawn(x: Column, k: int, seed: int, *keys: Column) -> Column:
    """k draws with replacement, fixed by seed and keys, whatever the partitioning and engine."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: F.get(x, F.pmod(chance(0, seed, *keys, j), F.size(x)).cast("int")))


def cleaned(x: Column, value: float) -> Column:
    """Missing draws replaced, then negatives raised to 0 (so a negative replacement is 0 too)."""
    return F.transform(x, lambda v: F.greatest(F.coalesce(F.nanvl(v, F.lit(None).cast("double")), F.lit(float(value))), F.lit(0.0)))


def rows_of_draws(x: pa.Array, y: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(draws of all rows, where each row's begin, how many it has, what happened, rows that have no score: without draws, with a null one, or with nothing that happened)."""
    n, values = pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64), x.flatten()
    draws, truth = values.to_numpy(zero_copy_only=False).astype(float), y.to_numpy(zero_copy_only=False).astype(float)
    start, missing = np.cumsum(n) - n, (n == 0) | y.is_null().to_numpy(zero_copy_only=False)
    if values.null_count:
        gone = np.append(0, np.cumsum(values.is_null().to_numpy(zero_copy_only=False)))
        missing |= gone[start + n] > gone[start]
    return draws, start, n, truth, missing


@arrow_udf(T.DoubleType())
def _crps(x: pa.Array, y: pa.Array) -> pa.Array:
    """Rows of equal numbers of draws are scored together, as one matrix."""
    draws, start, n, truth, missing = rows_of_draws(x, y)
    out = np.zeros(len(n))
    for size in np.unique(n[~missing]):
        rows = np.flatnonzero(~missing & (n == size))
        own = np.sort(draws[start[rows][:, None] + np.arange(size)], 1)
        out[rows] = np.abs(own - truth[rows][:, None]).mean(1) - own @ (2.0 * np.arange(size) + 1 - size) / size**2
    return pa.array(out, mask=missing)


def mean_score(score: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Callable[[Column, Column], Column]:
    """(draws, what happened) -> the mean of a score over a row's draws; score takes what happened and the draw of many rows at once.

    Null as crps is, and where the mean isn't a number. On 200,000 rows of 100 draws it takes half the time of the same sums as higher-order functions, and no more on rows of 8.
    """

    @arrow_udf(T.DoubleType())
    def means(x: pa.Array, y: pa.Array) -> pa.Array:
        draws, start, n, truth, missing = rows_of_draws(x, y)
        out = np.zeros(len(n))
        some = np.flatnonzero(n)
        if len(some):
            with np.errstate(invalid="ignore", divide="ignore"):
                out[some] = np.add.reduceat(score(np.repeat(truth, n), draws), start[some]) / n[some]
        return pa.array(out, mask=missing | np.isnan(out))

    return lambda x, y: means(x.cast("array<double>"), y.cast("double"))


def crps(x: Column, y: Column) -> Column:
    """Continuous ranked probability score of draws for one observation: mean |x - y| less half the mean |x - x'|.

    A batch of rows is one numpy call: on 200,000 rows of 100 draws that takes a quarter of the time of the same sums as higher-order
    functions, which work draw by draw. Null for no draws, a null draw or a null observation.
    """
    return _crps(x.cast("array<double>"), y.cast("double"))


def twcrps(x: Column, y: Column, threshold: float) -> Column:
    """CRPS of values raised to the threshold."""
    t = F.lit(float(threshold))
    return crps(F.transform(x, lambda v: F.greatest(v, t)), F.greatest(y, t))


def pinball(x: Column, y: Column, q: float) -> Column:
    return let(quantile(x, q), lambda p: F.when(y >= p, (y - p) * q).otherwise((p - y) * (1 - q)))


def interval_score(x: Column, y: Column, alpha: float) -> Column:
    def of(s: Column) -> Column:
        low, high = quantile_sorted(s, alpha / 2), quantile_sorted(s, 1 - alpha / 2)
        return (high - low) + F.greatest(low - y, F.lit(0.0)) * (2 / alpha) + F.greatest(y - high, F.lit(0.0)) * (2 / alpha)

    return let(F.array_sort(x), of)


def covered(x: Column, y: Column, alpha: float) -> Column:
    return let(F.array_sort(x), lambda s: ((y >= quantile_sorted(s, alpha / 2)) & (y <= quantile_sorted(s, 1 - alpha / 2))).cast("double"))
