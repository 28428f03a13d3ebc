"""Toxicity: a convolutional text classifier over hashed words.

A text's words (runs of letters and digits, lower case in ASCII) are hashed. A word's embedding is the sum of three rows of
one table: that of the word, of its first 4 bytes and of its first 6, so that unseen forms of a stem share what is known of
it. Filters of widths 1, 2 and 3 slide over the words, each filter's maximum over the whole text passes a rectifier, and a logistic unit scores
the maxima. The weights are trained in numpy on the driver from a bounded sample of labelled texts. Because a filter is
linear in the embeddings, scoring looks up each word's share of each filter in a table instead of multiplying.

The language of a text is guessed from its own function words. All labelled texts that the weights weren't trained on are scored and
counted by language, logit and label; for each language the threshold that divides them best is found, and scores are shifted so
that it lies at 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .labelled import labelled_sample, sampled
from .quality_model import sigmoid
from .textbytes import row_runs, text_bytes, word_hashes, word_spans

#: Bits of the buckets for words, for beginnings of PREFIXES[0] bytes and for those of PREFIXES[1].
BITS, PREFIXES = (16, 14, 14), (4, 6)
BUCKETS = sum(1 << b for b in BITS)
SIZE, FILTERS, WIDTHS = 12, 8, (1, 2, 3)
#: Bytes of text whose words are looked up at once.
AT_ONCE = 1 << 20
#: Labelled texts that the weights are fitted on, at most about, and their bytes.
SAMPLE, SAMPLE_BYTES = 6000, 16 << 20
#: Texts of all languages together that a language's own labelled texts are counted with for its threshold.
PRIOR = 100
#: What a labelled text that the weights were trained on counts for thresholds; others count 1.
SEEN = 0.001
#: Logits are counted in steps of 1 / STEPS.
STEPS, FARTHEST = 16, 40

#: Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in is that for was with are this by from",
    "de": "der die und den das von zu mit sich des auf ist im dem nicht ein eine für",
    "fr": "le la les des et est une du en que qui dans pour pas au sur",
    "es": "el los las que y una del se por con para como en de",
}
LANGUAGES = (*FUNCTION_WORDS, "other")


def byte_table() -> np.ndarray:
    """Lower-case bytes of words; 0 for what separates words."""
    t = np.zeros(256, np.uint8)
    for low, high in (("0", "9"), ("a", "z")):
        t[ord(low) : ord(high) + 1] = np.arange(ord(low), ord(high) + 1)
    t[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    t[0x80:] = np.arange(0x80, 0x100)
    return t


LOWERED = byte_table()


def buckets(hashes: np.ndarray) -> np.ndarray:
    """Rows of the embedding table, three for each word; hashes has a column for each."""
    first = np.cumsum((0, *(1 << b for b in BITS[:-1])))
    return np.stack([(hashes[:, k] >> np.uint64(64 - b)).astype(np.int32) + np.int32(first[k]) for k, b in enumerate(BITS)], 1)


def forms(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of each word and of its beginnings."""
    return np.stack([word_hashes(data, starts, ends), *(word_hashes(data, starts, np.minimum(ends, starts + k)) for k in PREFIXES)], 1)


def hashed(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return word_hashes(data, np.array([0]), np.array([len(data)]))[0]


def language_hashes() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the function words in order, and a row of languages for each."""
    found: dict[int, np.ndarray] = {}
    for k, words in enumerate(FUNCTION_WORDS.values()):
        for w in words.split():
            found.setdefault(int(hashed(w)), np.zeros(len(FUNCTION_WORDS), np.int32))[k] = 1
    keys = np.array(sorted(found), np.uint64)
    return keys, np.array([found[int(k)] for k in keys])


def worded(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, words of each of these rows, hashes). A text of over AT_ONCE bytes comes in pieces of one row,
    which overlap by the longest filter less one word; its maxima are those of the pieces."""
    data, offsets = text_bytes(column)
    for first, last in row_runs(offsets, AT_ONCE):
        at, end = int(offsets[first]), int(offsets[last])
        if last - first > 1 or end - at <= AT_ONCE:
            low = LOWERED[data[at:end]]
            # a separator stands between texts, so that no word spans two of them
            gaps = np.zeros(end - at + last - first, np.uint8)
            lengths = np.diff(offsets[first : last + 1])
            gaps[np.arange(end - at) + np.repeat(np.arange(last - first), lengths)] = low
            starts, ends = word_spans(gaps > 0)
            begin = np.cumsum(lengths + 1) - (lengths + 1)
            of = np.searchsorted(begin, starts, "right") - 1
            yield first, last, np.bincount(of, minlength=last - first), forms(gaps, starts, ends)
            continue
        while at < end:
            stop = min(end, at + AT_ONCE)
            low = LOWERED[data[at:stop]]
            starts, ends = word_spans(low > 0)
            if stop < end and len(starts) > 2 * max(WIDTHS):
                starts, ends = starts[:-1], ends[:-1]
                step = int(starts[-(max(WIDTHS) - 1)])
            else:
                step = stop - at
            yield first, last, np.array([len(starts)]), forms(low, starts, ends)
            at += step


def spoken(keys: np.ndarray, of_language: np.ndarray, hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Counts of each language's function words in each text."""
    whole = hashes[:, 0]
    at = np.searchsorted(keys, whole).clip(0, len(keys) - 1)
    hit = np.flatnonzero(keys[at] == whole)
    of = np.repeat(np.arange(len(n)), n)[hit]
    return np.stack([np.bincount(of, of_language[at[hit], k], len(n)) for k in range(len(FUNCTION_WORDS))], 1)


class Convolution:
    """Embeddings, filters and output weights, and a threshold (a logit) for each language."""

    def __init__(self, embedding: np.ndarray, filters: dict[int, np.ndarray], out: np.ndarray, out0: float):
        self.embedding, self.filters, self.out, self.out0 = embedding, filters, out, out0
        self.thresholds, self.share = np.zeros(len(LANGUAGES)), 0

    def tables(self) -> None:
        """For scoring: what a word in a filter's k-th place adds, for all widths and places."""
        self.shares = {w: [self.embedding @ f[k] for k in range(w)] for w, f in self.filters.items()}
        self.keys, self.of_language = language_hashes()

    def maxima(self, words: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The filters' maxima for each text; a window that a text is too short for counts as 0, and so does any negative maximum."""
        out = np.zeros((len(n), FILTERS * len(WIDTHS)), np.float32)
        of, ends = np.repeat(np.arange(len(n)), n), np.repeat(np.cumsum(n), n)
        for j, w in enumerate(WIDTHS):
            at = np.flatnonzero(np.arange(len(words)) + w <= ends)
            if not len(at):
                continue
            total = np.zeros((len(at), FILTERS), np.float32)
            for k in range(w):
                for own in words[at + k].T:
                    total += self.shares[w][k][own]
            fresh = np.flatnonzero(np.concatenate(([True], of[at][1:] != of[at][:-1])))
            out[of[at][fresh], j * FILTERS : (j + 1) * FILTERS] = np.maximum(np.maximum.reduceat(total, fresh), 0)
        return out

    def logits(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(logit, language) of each text, before its language's threshold."""
        top, heard = np.zeros((len(column), FILTERS * len(WIDTHS)), np.float32), np.zeros((len(column), len(FUNCTION_WORDS)))
        for first, last, n, hashes in worded(column):
            top[first:last] = np.maximum(top[first:last], self.maxima(buckets(hashes), n))
            heard[first:last] += spoken(self.keys, self.of_language, hashes, n)
        return top @ self.out + self.out0, np.where(heard.any(1), heard.argmax(1), len(FUNCTION_WORDS))

    @classmethod
    def fit(cls, words: list[np.ndarray], y: np.ndarray, epochs: int = 12, batch: int = 32, seed: int = 3) -> Convolution:
        """Trained with Adam on the cross entropy; only the windows that hold a filter's maximum get a gradient.

        A word's first number starts at the smoothed log odds of a toxic text holding it; words of fewer than two texts stay 0.
        """
        rng = np.random.default_rng(seed)
        there, yes = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for w, label in zip(words, y, strict=True):
            own = np.unique(w)
            there[own] += 1
            yes[own] += label
        odds = np.log((yes + 0.5) / (y.sum() + 1)) - np.log((there - yes + 0.5) / (len(y) - y.sum() + 1))
        e = np.zeros((BUCKETS, SIZE), np.float32)
        seen = there >= 2
        e[seen] = rng.normal(0, 0.05, (int(seen.sum()), SIZE))
        e[:, 0] = np.where(seen, odds * there / (there + 4), 0) / 2
        w = {width: rng.normal(0, 0.1, (width, SIZE, FILTERS)).astype(np.float32) for width in WIDTHS}
        for f in w.values():
            f[:, 0, : FILTERS // 2] += 0.5
        out = np.full(FILTERS * len(WIDTHS), 0.1, np.float32)
        params = [e, *w.values(), out, np.array([-1.0], np.float32)]
        m1, m2, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        weight = np.where(y == 1, np.sqrt(max(1.0, (len(y) - y.sum()) / max(1.0, y.sum()))), 1).astype(np.float32)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                step += 1
                touched, *grads = cls.gradient(params, [words[r] for r in rows], y[rows], weight[rows])
                for k, g in enumerate(grads):
                    own = touched if k == 0 else slice(None)
                    g = g + 1e-5 * params[k][own]
                    m1[k][own] += 0.1 * (g - m1[k][own])
                    m2[k][own] += 0.01 * (g * g - m2[k][own])
                    params[k][own] -= 0.005 * (m1[k][own] / (1 - 0.9**step)) / (np.sqrt(m2[k][own] / (1 - 0.99**step)) + 1e-7)
        return cls(e, w, params[-2], float(params[-1][0]))

    @staticmethod
    def gradient(params: list[np.ndarray], texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """(rows of the embeddings that these texts have, their gradient, those of the filters, of the output weights and of the last one)."""
        e, *filters, out, out0 = params
        n = np.array([len(t) for t in texts])
        words, end = np.concatenate(texts), np.cumsum(n)
        x = e[words].sum(1)
        top, where = np.zeros((len(texts), FILTERS * len(WIDTHS)), np.float32), []
        for j, (w, f) in enumerate(zip(WIDTHS, filters, strict=True)):
            have = np.flatnonzero(n >= w)
            at = np.concatenate([np.arange(end[i] - n[i], end[i] - w + 1) for i in have]) if len(have) else np.empty(0, int)
            best = np.full((len(texts), FILTERS), -1)
            if len(at):
                total = sum(x[at + k] @ f[k] for k in range(w))
                first = np.cumsum(n[have] - w + 1) - (n[have] - w + 1)
                most = np.maximum.reduceat(total, first)
                # the first window that has the maximum
                place = np.where(total == np.repeat(most, n[have] - w + 1, 0), np.arange(len(at))[:, None], len(at))
                best[have] = np.where(most > 0, at[np.minimum.reduceat(place, first)], -1)
                top[have, j * FILTERS : (j + 1) * FILTERS] = np.maximum(most, 0)
            where.append(best)
        d = (sigmoid(top @ out + out0[0]) - y) * weight / weight.sum()
        dtop = d[:, None] * out
        rows, parts, df = [], [], []
        for j, (w, f) in enumerate(zip(WIDTHS, filters, strict=True)):
            i, c = np.nonzero(where[j] >= 0)
            own, at, g = dtop[i, j * FILTERS + c], where[j][i, c], np.zeros_like(f)
            for k in range(w):
                np.add.at(g[k].T, c, own[:, None] * x[at + k])
                rows.append(words[at + k].ravel())
                parts.append(np.repeat(own[:, None] * f[k][:, c].T, words.shape[1], 0))
            df.append(g)
        touched = np.unique(words)
        de = np.zeros((len(touched), SIZE), np.float32)
        np.add.at(de, np.searchsorted(touched, np.concatenate(rows)), np.concatenate(parts))
        return [touched, de, *df, top.T @ d, np.array([d.sum()], np.float32)]


def best_threshold(counts: np.ndarray) -> float:
    """The logit from which on to call texts toxic, for the best F1, in the middle of the empty steps around it; counts is (steps, label)."""
    hits, called = counts[::-1, 1].cumsum()[::-1], counts.sum(1)[::-1].cumsum()[::-1]
    f1 = 2 * hits / np.maximum(called + counts[:, 1].sum(), 1)
    # of equal ones the highest step, which has texts itself; below it come empty steps, then texts that aren't called
    k = int(len(f1) - 1 - f1[::-1].argmax())
    below = np.flatnonzero(counts[:k].sum(1))
    low = below[-1] + 1 if len(below) else k - 2 * STEPS
    return (low + k) / 2 / STEPS - FARTHEST


def calibrated(model, logits: DataFrame, labels: DataFrame):
    """model with a threshold for each language, from all labelled rows of logits (doc_id, logit, language) that aren't held out.

    Rows that the weights were trained on hardly count (SEEN), unless there are no others of a class. A language's own rows are counted with PRIOR
    rows spread as those of all languages are, so the fewer it has, the nearer its threshold is to the common one. One rule holds at every size. Only counts by
    language, step of the logit and label come to the driver. Without rows of both labels thresholds stay at 0.
    """
    if not isinstance(model, Convolution):
        return model
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("toxic").cast("int").alias("label"))
    place = F.greatest(F.lit(0), F.least(F.lit(2 * FARTHEST * STEPS - 1), F.floor((F.col("logit") + FARTHEST) * STEPS))).cast("int")
    seen = trained_on(F.col("doc_id"), F.col("label"), model.shares_taken)
    rows = logits.join(known, "doc_id").groupBy("language", place.alias("step"), "label", seen.alias("seen")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros((len(LANGUAGES), 2 * FARTHEST * STEPS, 2))
    for r in rows:
        counts[r.language, r.step, r.label] += r.n * (SEEN if r.seen else 1)
    common = counts.sum(0)
    if common.sum(0).min() > 0:
        for k in range(len(LANGUAGES)):
            model.thresholds[k] = best_threshold(counts[k] + PRIOR * common / common.sum())
    return model


def trained_on(doc_id: Column, label: Column, shares: tuple[int, int]) -> Column:
    """Whether the weights are trained on a labelled document: by two hashes of its id, a share (in millionths, by label) of all, less a third for the thresholds."""
    return sampled(doc_id, label, shares) & (F.pmod(F.xxhash64(F.lit(71), doc_id), F.lit(3)) != 0)


class Constant:
    """Stands in where the labels have one class or none."""

    def __init__(self, value: float):
        self.value = value
        self.thresholds = np.zeros(len(LANGUAGES))

    def logits(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        x = {0.0: -np.inf, 0.5: 0.0, 1.0: np.inf}[self.value]
        return np.full(len(column), x), np.full(len(column), len(FUNCTION_WORDS))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES):
    """A model of labels.toxic, its weights trained on about so many labelled documents, or bytes of them, that aren't held out; see calibrated
    for its thresholds.

    Without labels every score is 0.5; with one class only, that class.
    """

    def hashes(batches):
        for b in batches:
            rows: list[list[np.ndarray]] = [[] for _ in range(b.num_rows)]
            for first, _, n, h in worded(b.column("text")):
                for i, (end, k) in enumerate(zip(np.cumsum(n), n, strict=True)):
                    rows[first + i].append(buckets(h[end - k : end]))
            packed = [np.concatenate([*own, np.empty((0, len(BITS)), np.int32)]).tobytes() for own in rows]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.string()), b.column("label").cast(pa.int32()), pa.array(packed, pa.binary())], ["doc_id", "label", "words"])

    found, shares = labelled_sample(docs, labels, "toxic", sample, sample_bytes, balanced=True)
    found = found.where(trained_on(F.col("doc_id"), F.col("label"), shares))
    rows = sorted(found.mapInArrow(hashes, "doc_id string, label int, words binary").collect(), key=lambda r: r.doc_id)
    y = np.array([r.label for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return Constant(float(y[0]) if len(y) else 0.5)
    words = [np.frombuffer(r.words, np.int32).reshape(-1, len(BITS)) for r in rows]
    del rows
    model = Convolution.fit(words, y)
    model.shares_taken = shares
    return model


def toxicity_logits(docs: DataFrame, model) -> DataFrame:
    """(doc_id, logit, language) for each row of docs (doc_id, text), repeated rows included; language is a place in LANGUAGES.

    Both depend on the text alone; a null text counts as an empty one, which has no words. A very long text is looked up piece by piece.
    An empty table gives an empty table. The model goes to the tasks as a broadcast of a few MB, whatever the input.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        m = shared.value
        if isinstance(m, Convolution) and not hasattr(m, "shares"):
            m.tables()
        for b in batches:
            z, language = m.logits(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(z.astype(np.float64), pa.float64()), pa.array(language.astype(np.int32))], ["doc_id", "logit", "language"])

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, logit double, language int")


def toxicity_scores(logits: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of logits: the logistic function of the logit less its language's threshold. A null id isn't held out."""
    edges = F.array(*(F.lit(float(t)) for t in model.thresholds))
    z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("logit") - F.get(edges, F.col("language"))))
    scored = logits.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), (1 / (1 + F.exp(-z))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
