"""Quality rules as a short-circuit cascade, with built-in functions only.

A rule is a test on one text and computes what it needs from the text itself, or from the base measures where these are there. It states
what it costs a character, in nanoseconds as timed_costs() measures them once. Before the cascade runs, each rule's cost for the texts of a sample is
estimated from this, and what all rules reject there is counted, in one job. The order is then built from the front: next comes the
rule that rejects most of the sample's texts that the rules before it leave, a second of its own cost. The first rule that rejects a
text ends its cascade, so what later rules would need isn't computed. The order decides how fast a text is rejected, never whether: the
verdict is the conjunction of all rules. No clock runs, so the same table always gives the same order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, unused, words_of

WINDOW = 8
#: What rules cost a character beyond splitting the text into words, in nanoseconds.
COSTS = {"few_words": 0.2, "repeats": 200.0, "symbols": 17.0, "word_length": 6.0, "repeated_lines": 5.0, "shouting": 30.0, "exclamation": 3.0}


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of so many words found twice or more in the text.

    Windows are compared by a 64-bit hash. A text whose windows all differ ends after one distinct count.
    """
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, window)))

    def covered(positions: Column) -> Column:
        steps = F.transform(
            positions,
            lambda p, k: F.least(F.lit(window), F.coalesce(F.get(positions, k + 1) - p, F.lit(window))),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def twice(ordered: Column) -> Column:
        same = lambda k, x: F.coalesce(F.get(ordered, k)["h"] == x["h"], F.lit(False))
        found = F.filter(ordered, lambda x, k: same(k + 1, x) | ((k > 0) & same(F.greatest(k - 1, F.lit(0)), x)))
        return let(F.array_sort(F.transform(found, lambda x: x["i"])), covered)

    def count(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(ordered, twice))

    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(let(hashes, count))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def base_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all long).

    A null or empty text has 0 everywhere. The columns of docs stay, but for those of these names, which are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))

    def measures(words: Column) -> Column:
        lines = let(lines_with_words(whole), lambda x: F.size(x) - F.size(F.array_distinct(x)))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(F.regexp_replace(whole, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
            lines.cast("long").alias("n_dup_lines"),
            repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    own = unused("measures", docs.columns)
    found = docs.select(*kept, let(words_of(whole), measures).alias(own))
    return found.select(*kept, *(F.col(own)[c].alias(c) for c in names))


@dataclass(frozen=True)
class Rule:
    """rejects(text, its words) is true for a text that the rule rejects, and costs so many nanoseconds a character; by_measures() is the same
    from the columns of base_measures and costs next to nothing."""

    name: str
    rejects: Callable[[Column, Column], Column]
    cost: float = 10.0
    by_measures: Callable[[], Column] | None = None


def found_in(text: Column, pattern: str) -> Column:
    """Characters of this class."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def measure(name: str) -> Column:
    return F.col(name)


#: What base_failed means, as rules. Thresholds are in whole numbers, so that every engine decides alike.
BASE = (
    Rule("few_words", lambda t, w: F.size(w) < 20, COSTS["few_words"], lambda: measure("n_words") < 20),
    Rule("repeats", lambda t, w: repeat_words(w) * 100 > F.size(w) * 30, COSTS["repeats"], lambda: measure("n_repeat_words") * 100 > measure("n_words") * 30),
)
#: The rules beyond the base.
RULES = (
    Rule("symbols", lambda t, w: found_in(t, r"[#*$%&|<>]") * 100 > F.size(w) * 25, COSTS["symbols"], lambda: measure("n_symbols") * 100 > measure("n_words") * 25),
    Rule(
        "word_length",
        lambda t, w: let(F.length(F.array_join(w, "")), lambda c: (c > F.size(w) * 25) | (c * 2 < F.size(w) * 3)),
        COSTS["word_length"],
        lambda: (measure("word_chars") > measure("n_words") * 25) | (measure("word_chars") * 2 < measure("n_words") * 3),
    ),
    Rule(
        "repeated_lines",
        lambda t, w: let(lines_with_words(t), lambda x: F.size(x) - F.size(F.array_distinct(x))) * 10 > F.size(w),
        COSTS["repeated_lines"],
        lambda: measure("n_dup_lines") * 10 > measure("n_words"),
    ),
    Rule("shouting", lambda t, w: found_in(t, "[A-Z]") * 100 > F.length(F.array_join(w, "")) * 60, COSTS["shouting"]),
    Rule("exclamation", lambda t, w: (F.length(t) - F.length(F.replace(t, F.lit("!!"), F.lit("")))) * 100 > F.size(w) * 60, COSTS["exclamation"]),
)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def whole(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`"), F.lit(""))


def tested(text: str, verdict: Callable[[Column, Column], Column]) -> Column:
    """verdict(text, words), with the text split into words once."""
    return let(words_of(whole(text)), lambda words: verdict(whole(text), words))


@dataclass(frozen=True)
class Measured:
    """A rule's own seconds for the sample, and how often it rejects a sampled text that the rules before it leave."""

    rule: Rule
    seconds: float
    rejected: float


def ordered(cost: dict[str, float], patterns: Sequence[tuple[frozenset[str], int]]) -> list[tuple[str, float]]:
    """(rule, rejections among what is left), most rejections a second first; patterns count the texts that the same rules reject.

    Costs count by powers of two, and ties go to the cheaper rule by that measure, then to the first name, so that noise in the clock
    doesn't change the order.
    """
    level = {name: 2.0 ** round(log2(seconds)) for name, seconds in cost.items()}
    left, out = list(patterns), []
    while len(out) < len(cost):
        n = max(1, sum(k for _, k in left))
        gain = {name: sum(k for names, k in left if name in names) / n for name in cost if name not in dict(out)}
        best = min(gain, key=lambda name: (-gain[name] / level[name], level[name], name))
        out.append((best, gain[best]))
        left = [(names, k) for names, k in left if best not in names]
    return out


def sampled(docs: DataFrame, text: str, rows: int) -> DataFrame:
    """A random share of the texts, so many on average, in one partition; which ones is fixed by the table's files."""
    return docs.select(F.col(f"`{text}`").alias("text")).sample(min(1.0, rows / max(1, docs.count())), seed=17).repartition(1)


def rule_order(docs: DataFrame, rules: Sequence[Rule] = (*BASE, *RULES), text: str = "text", sample_rows: int = 1000) -> list[Measured]:
    """The rules in the order in which they reject most a second.

    The sample is a random share of the rows, sized to sample_rows on average. On an empty table the given order stays.
    """
    verdicts = F.struct(*(F.coalesce(tested("text", r.rejects), F.lit(False)).alias(r.name) for r in rules))
    found = sampled(docs, text, sample_rows).select(verdicts.alias("v"), F.length(whole("text")).alias("n")).groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("chars")).collect()
    if not found:
        return [Measured(r, 0.0, 0.0) for r in rules]
    chars = max(1, sum(row.chars for row in found))
    cost = {r.name: r.cost * chars * 1e-9 for r in rules}
    patterns = [(frozenset(name for name, hit in row.v.asDict().items() if hit), row.n) for row in found]
    by_name = {r.name: r for r in rules}
    return [Measured(by_name[name], cost[name], rejected) for name, rejected in ordered(cost, patterns)]


def timed_costs(docs: DataFrame, rules: Sequence[Rule] = (*BASE, *RULES), text: str = "text", sample_rows: int = 1000, repeats: int = 5) -> dict[str, float]:
    """Nanoseconds a character of each rule on a sample of a table that isn't empty: the shortest of several jobs, less that of a job without a rule.

    For choosing the cost that a rule states; no query runs it.
    """
    sample = sampled(docs, text, sample_rows).persist()
    try:
        chars = sample.agg(F.sum(F.length(whole("text")))).first()[0] or 1

        def timed(test: Callable[[Column, Column], Column]) -> float:
            spent = []
            for _ in range(repeats):
                began = time.perf_counter()
                sample.agg(F.sum(tested("text", test).cast("long"))).collect()
                spent.append(time.perf_counter() - began)
            return min(spent) * 1e9 / chars

        idle = timed(lambda t, w: F.size(w) < 0)
        return {r.name: max(timed(r.rejects) - idle, 0.1) for r in rules}
    finally:
        sample.unpersist()


def rejected_by(order: Sequence[Rule], text: str = "text", measured: bool = False) -> Column:
    """The first rule in this order that rejects the text, or null. Later rules aren't evaluated for it. measured: the base measures are columns beside it."""

    def verdict(rule: Rule, words: Column | None) -> Column:
        if words is not None:
            return rule.rejects(whole(text), words)
        return rule.by_measures() if rule.by_measures else tested(text, rule.rejects)

    def chain(words: Column | None) -> Column:
        out = F.lit(None).cast("string")
        for rule in reversed(order):
            out = F.when(F.coalesce(verdict(rule, words), F.lit(False)), rule.name).otherwise(out)
        return out

    return chain(None) if measured else let(words_of(whole(text)), chain)


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = 1000, measures: bool = True) -> DataFrame:
    """docs with rejected_by (the rule that ended the text's cascade, null if none) and kept.

    With measures also the base measures and base_failed are added; since they are there for every text, the base is tested first,
    and rejected_by is `base` for what it fails. Without, the base's rules take their places in the cascade like the others, and a text
    is worked on no longer than until it is rejected. kept is the same either way.

    A null or empty text has no words and fails the base. A very long text is one row like any other. Repeated rows are judged one by
    one. Columns of docs named like an added one are replaced. An empty table gives an empty table.
    """
    tried = rules if measures else (*BASE, *rules)
    if measures:
        # what a rule reads off the measures costs next to nothing, so such rules come first
        tried = [replace(r, cost=0.1) if r.by_measures else r for r in tried]
    order = [m.rule for m in rule_order(docs, tried, text, sample_rows)]
    if measures:
        found = base_measures(docs, text).withColumn("base_failed", base_failed())
        verdict = F.when(F.col("base_failed"), "base").otherwise(rejected_by(order, text, True))
    else:
        found, verdict = docs, rejected_by(order, text)
    return found.withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull())
