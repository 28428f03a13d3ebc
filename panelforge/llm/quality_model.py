"""Quality classifier: attention-based multiple-instance learning over the passages of a text.

A text is a bag of passages of nearly equal length (BLOCK bytes at most). Each passage is described by counts of byte
classes, by how its words repeat, and by the mean of the embeddings of its words and of its pairs of neighbouring words, which are hashed
into the rows of one table; a tanh layer encodes it. Gated attention, a(h) = w . (tanh(V h) * sigmoid(U h)),
softmax over the passages of a text, weights the encodings, and a logistic unit scores their weighted mean. All weights
are learnt from document labels alone, with Adam, in numpy on the driver, from a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out
from .labelled import labelled_sample
from .textbytes import MULTIPLIER, mixed, row_runs, text_bytes, word_hashes

BLOCK = 1024
#: Bytes of text that are described at once.
AT_ONCE = 1 << 20
#: Labelled texts that a model is fitted on, at most about, and their bytes.
SAMPLE, SAMPLE_BYTES = 4000, 16 << 20

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASSES = len(PUNCTUATION) + 8
LOWER, UPPER, DIGIT, SPACE, NEWLINE, CONTROL, LEAD, CONTINUED = range(len(PUNCTUATION), CLASSES)


def class_table() -> np.ndarray:
    t = np.full(256, CONTROL, np.uint8)
    t[list(PUNCTUATION)] = np.arange(len(PUNCTUATION))
    t[ord("a") : ord("z") + 1], t[ord("A") : ord("Z") + 1], t[ord("0") : ord("9") + 1] = LOWER, UPPER, DIGIT
    t[[9, 11, 12, 13, 32]], t[10], t[0x80:0xC0], t[0xC0:] = SPACE, NEWLINE, CONTINUED, LEAD
    return t


TABLE = class_table()
#: Columns: byte classes a byte; words, upper-case pairs and punctuation pairs a byte; of words: repeated next to each other, not distinct; log of the length.
FEATURES = CLASSES + 6
#: Bits of the buckets for words and for pairs of words, and the size of their embeddings.
BITS, EMBEDDED = (14, 15), 8
BUCKETS = sum(1 << b for b in BITS)


def block_counts(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passages of each text, bytes in each but the last); an empty text has one."""
    n = np.maximum(1, -(-lengths // BLOCK))
    return n, np.maximum(1, -(-lengths // n))


def describe(data: np.ndarray, block: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, buckets, buckets of each passage) of n passages; block holds the passage of each byte, in order."""
    kind = TABLE[data]
    out = np.zeros((n, FEATURES), np.float32)
    sizes = np.bincount(block, minlength=n).astype(np.float32)
    out[:, :CLASSES] = np.bincount(block * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
    pair = block[1:] == block[:-1]
    for at, side in ((1, kind == UPPER), (2, kind < LOWER)):
        out[:, CLASSES + at] = np.bincount(block[1:][side[1:] & side[:-1] & pair], minlength=n)
    fresh = np.concatenate(([True], ~pair)) if len(block) else np.empty(0, bool)
    letters = (kind != SPACE) & (kind != NEWLINE)
    # a word ends where its passage ends
    starts = np.flatnonzero(letters & (fresh | np.concatenate(([True], ~letters[:-1])))) if len(block) else np.empty(0, int)
    stop = np.concatenate((fresh[1:], [True])) if len(block) else np.empty(0, bool)
    ends = np.flatnonzero(letters & (stop | np.concatenate((~letters[1:], [True])))) + 1 if len(block) else np.empty(0, int)
    words, of = word_hashes(data, starts, ends), block[starts] if len(starts) else np.empty(0, np.int64)
    n_words = np.bincount(of, minlength=n).astype(np.float32)
    out[:, CLASSES] = n_words
    out /= np.maximum(sizes, 1)[:, None]
    if len(words):
        again = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
        out[:, CLASSES + 3] = np.bincount(of[1:][again], minlength=n) / np.maximum(n_words, 1)
        by = np.lexsort((words, of))
        same = (words[by][1:] == words[by][:-1]) & (of[by][1:] == of[by][:-1])
        out[:, CLASSES + 4] = np.bincount(of[by][1:][same], minlength=n) / np.maximum(n_words, 1)
    out[:, CLASSES + 5] = np.log1p(sizes) / 8
    if not len(words):
        return out, np.empty(0, np.int32), np.zeros(n, np.int64)
    # each word, then its pair with the next word of its passage
    joined = mixed((words + np.append(words[1:], np.uint64(0)) * MULTIPLIER) * MULTIPLIER)
    found = np.stack([words >> np.uint64(64 - BITS[0]), (joined >> np.uint64(64 - BITS[1])) + np.uint64(1 << BITS[0])], 1).astype(np.int32)
    there = np.stack([np.ones(len(of), bool), np.append(of[1:] == of[:-1], False)], 1)
    return out, found[there], np.bincount(np.repeat(of, 2)[there.ravel()], minlength=n)


def passages(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, passages of each of these rows, features, buckets, buckets of each passage); a very long text is described piece by piece."""
    data, offsets = text_bytes(column)
    for first, last in row_runs(offsets, AT_ONCE):
        lengths = np.diff(offsets[first : last + 1])
        n, size = block_counts(lengths)
        if last - first == 1 and lengths[0] > AT_ONCE:
            step = int(size[0]) * (AT_ONCE // int(size[0]))
            parts = []
            for at in range(0, int(lengths[0]), step):
                piece = data[offsets[first] + at : offsets[first] + min(at + step, int(lengths[0]))]
                parts.append(describe(piece, np.arange(len(piece)) // int(size[0]), -(-len(piece) // int(size[0]))))
            found = [np.concatenate(own) for own in zip(*parts, strict=True)]
            yield first, last, np.array([len(found[0])]), *found
            continue
        begin = np.cumsum(n) - n
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        block = np.repeat(begin, lengths) + place // np.repeat(size, lengths)
        yield first, last, n, *describe(data[offsets[first] : offsets[last]], block, int(n.sum()))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def means(table: np.ndarray, buckets: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The mean row of each passage, of m buckets each; 0 for one without any."""
    out = np.zeros((len(m), table.shape[1]), np.float32)
    have = np.flatnonzero(m)
    if len(have):
        out[have] = np.add.reduceat(table[buckets], (np.cumsum(m) - m)[have]) / m[have, None]
    return out


class AttentionBag:
    """Weights of the network; score() pools the passages of each text by gated attention."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, weights: dict[str, np.ndarray], table: np.ndarray):
        self.mean, self.deviation, self.weights, self.table = mean, deviation, weights, table

    @staticmethod
    def forward(w: dict[str, np.ndarray], x: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        first, of = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
        h = np.tanh(x @ w["encode"] + w["encode0"])
        t, g = np.tanh(h @ w["v"]), sigmoid(h @ w["u"])
        e = (t * g) @ w["w"]
        a = np.exp(e - np.maximum.reduceat(e, first)[of])
        a /= np.add.reduceat(a, first)[of]
        z = np.add.reduceat(h * a[:, None], first)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "of": of, "first": first, "p": sigmoid(z @ w["out"] + w["out0"][0])}

    def score(self, n: np.ndarray, x: np.ndarray, buckets: np.ndarray, m: np.ndarray) -> np.ndarray:
        return self.forward(self.weights, np.concatenate((np.clip((x - self.mean) / self.deviation, -6, 6), means(self.table, buckets, m)), 1), n)["p"]

    @classmethod
    def fit(cls, n: np.ndarray, x: np.ndarray, buckets: np.ndarray, m: np.ndarray, y: np.ndarray, hidden: int = 24, gates: int = 12, epochs: int = 40, batch: int = 64, seed: int = 7) -> AttentionBag:
        """Weights by Adam, embeddings, which start at 0, by Adagrad; texts stay in one batch, and batches come in another order each time."""
        rng = np.random.default_rng(seed)
        mean, deviation = x.mean(0), x.std(0) + 1e-3
        x = np.clip((x - mean) / deviation, -6, 6).astype(np.float32)
        draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
        w = {"encode": draw(x.shape[1] + EMBEDDED, hidden), "encode0": np.zeros(hidden, np.float32), "v": draw(hidden, gates), "u": draw(hidden, gates), "w": draw(gates), "out": draw(hidden), "out0": np.array([np.log((y.sum() + 1) / (len(y) - y.sum() + 1))], np.float32)}
        m1, m2, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
        table, spread = np.zeros((BUCKETS, EMBEDDED), np.float32), np.zeros((BUCKETS, EMBEDDED), np.float32)
        first, start = np.cumsum(n) - n, np.cumsum(m) - m
        order, batches = rng.permutation(len(n)), []
        for at in range(0, len(n), batch):
            rows = order[at : at + batch]
            own = np.concatenate([np.arange(first[r], first[r] + n[r]) for r in rows])
            words = np.concatenate([buckets[start[i] : start[i] + m[i]] for i in own])
            by = np.argsort(words, kind="stable")
            batches.append((rows, own, words, by, np.flatnonzero(np.diff(words[by], prepend=-1))))
        for _ in range(epochs):
            for k in rng.permutation(len(batches)):
                rows, own, words, by, edge = batches[k]
                step += 1
                grads, dx = cls.gradient(w, np.concatenate((x[own], means(table, words, m[own])), 1), n[rows], y[rows])
                for name, g in grads.items():
                    g = g + 1e-4 * w[name]
                    m1[name] += 0.1 * (g - m1[name])
                    m2[name] += 0.001 * (g * g - m2[name])
                    w[name] -= 0.004 * (m1[name] / (1 - 0.9**step)) / (np.sqrt(m2[name] / (1 - 0.999**step)) + 1e-8)
                if len(words):
                    of = np.repeat(np.arange(len(own)), m[own])
                    g = np.add.reduceat((dx[:, -EMBEDDED:] / np.maximum(m[own], 1)[:, None])[of[by]], edge)
                    there = words[by[edge]]
                    spread[there] += g * g
                    table[there] -= 0.02 * g / (np.sqrt(spread[there]) + 1e-8) + 1e-4 * table[there]
        return cls(mean, deviation, w, table)

    @classmethod
    def gradient(cls, w: dict[str, np.ndarray], x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean cross entropy, by the weights and by x."""
        f = cls.forward(w, x, n)
        d = ((f["p"] - y) / len(y)).astype(np.float32)
        dz = d[:, None] * w["out"]
        dza = dz[f["of"]]
        da = (dza * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["first"])[f["of"]])
        dtg = de[:, None] * w["w"]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = (dza * f["a"][:, None] + dt @ w["v"].T + dg @ w["u"].T) * (1 - f["h"] ** 2)
        grads = {"encode": x.T @ dh, "encode0": dh.sum(0), "v": f["h"].T @ dt, "u": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de, "out": f["z"].T @ d, "out0": np.array([d.sum()], np.float32)}
        return grads, dh @ w["encode"].T


class Constant:
    """Stands in where the labels have one class or none."""

    def __init__(self, value: float):
        self.value = value

    def score(self, n: np.ndarray, *described: np.ndarray) -> np.ndarray:
        return np.full(len(n), self.value)


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES):
    """A model of labels.quality, from about so many labelled documents, or bytes of them, that aren't held out.

    Without labels every score is 0.5; with one class only, every score is that class.
    """

    def bags(batches):
        for b in batches:
            for first, last, n, x, buckets, m in passages(b.column("text")):
                ends, stops = np.cumsum(n), np.cumsum(m)
                rows = []
                for e, k in zip(ends, n, strict=True):
                    own = slice(stops[e - k] - m[e - k], stops[e - 1])
                    rows.append((x[e - k : e].astype(np.float32).tobytes(), m[e - k : e].astype(np.int32).tobytes(), buckets[own].tobytes()))
                columns = [pa.array(c, pa.binary()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(first, last - first), b.column("label").slice(first, last - first).cast(pa.int32()), *columns], ["doc_id", "label", "x", "m", "buckets"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, label int, x binary, m binary, buckets binary"
    found = labelled_sample(docs, labels, "quality", sample, sample_bytes)[0].mapInArrow(bags, schema)
    rows = sorted(found.collect(), key=lambda r: str(r.doc_id))
    y = np.array([r.label for r in rows], np.float32)
    if len(set(y.tolist())) < 2:
        return Constant(float(y[0]) if len(y) else 0.5)
    x, m, buckets = (b"".join(r[c] for r in rows) for c in ("x", "m", "buckets"))
    n = np.array([len(r.m) // 4 for r in rows])
    return AttentionBag.fit(n, np.frombuffer(x, np.float32).reshape(-1, FEATURES), np.frombuffer(buckets, np.int32), np.frombuffer(m, np.int32).astype(np.int64), y)


def quality_scores(docs: DataFrame, model, threshold: float = 0.3, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, score, predicted, *keep) for each row of docs, repeated rows included.

    The score depends on the text alone; a null text counts as an empty one, whose bag is one passage of nothing. A very long text is
    described piece by piece. A null id isn't held out. Other columns of docs, whatever their names, are ignored but for those in keep.
    An empty table gives an empty table. The model goes to the tasks as a broadcast of a few MB, whatever the input.
    """
    names = ["doc_id", *keep]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for b in batches:
            p = [shared.value.score(*described) for _, _, *described in passages(b.column("text"))]
            scores = pa.array(np.concatenate(p).astype(np.float64) if p else np.empty(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), scores], [*names, "score"])

    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField("score", T.DoubleType())])
    scored = docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(score, schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *(F.col(c) for c in keep))
