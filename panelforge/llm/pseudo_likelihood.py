"""Language-model scoring by masked pseudo-likelihood.

Every word of a text is predicted from the SIDE words on its left and on its right, never from itself, by a small network: the
neighbours' embeddings, joined, pass a tanh layer, which turns left or right at each node of a binary tree whose leaves are the
words. A word's probability is the product of its DEPTH turns, so each depends on both sides at every node, and all words together have
probability 1. A text's score is the sum of the conditional log-probabilities of all its words.

Words are hashed into WORDS buckets, whose leaves lie in order of frequency; a node begins with the turn that the counts of all texts give.
The network is trained in numpy inside the tasks: in each round every training shard starts from the common weights and takes
a gradient step for each batch of its own positions (each STRIDE-th of all its texts, others in each round, so that the rounds together
take every position once); then the shards' weights are averaged, each row by how often a shard met it. Shards are made by a hash of text and
id and read in its order, and there is one for each SHARD_WORDS words. A task trains those that it gets one after the other and hands on one
average of them: neither the input's partitions nor its order nor the number of tasks make a difference, and what tasks hand on doesn't grow with it.

Texts are turned into buckets once; counting, training and scoring read these (2 bytes a word) from the shared folder.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written
from .near_duplicates import words_in
from .textbytes import row_runs, text_bytes

DEPTH = 14
WORDS = 1 << DEPTH
#: The bucket that stands beyond both ends of a text.
EDGE = WORDS
SIDE, SIZE, HIDDEN = 2, 8, 7
#: Levels at the root whose nodes are computed all at once for each position, being few; below them each position has nodes of its own.
TOP = 7
ABOVE = (1 << TOP) - 1
ROUNDS, BATCH = 3, 2048
STRIDE = ROUNDS
#: Words of a training shard, on average.
SHARD_WORDS = 2_000_000
AT_ONCE = 1 << 20
#: Positions that are scored at once.
BLOCK = 1 << 12
OFFSETS = np.array([k for k in range(-SIDE, SIDE + 1) if k])
LEVELS = np.arange(DEPTH, dtype=np.int32)


def bucketed(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, words of each of these rows, their buckets)."""
    data, offsets = text_bytes(column)
    for first, last in row_runs(offsets, AT_ONCE):
        n, words = words_in(data, offsets[first : last + 1])
        yield first, last, n, (words >> np.uint64(64 - DEPTH)).astype(np.uint16)


def texts_in_buckets(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, print, n_words, buckets binary) for each row of docs; print is a hash of text and id, buckets are unsigned 16-bit numbers."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, n, buckets in bucketed(b.column("text")):
                ends = np.concatenate(([0], np.cumsum(n) * 2)).astype(np.int32)
                raw = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(ends), pa.py_buffer(buckets.tobytes())])
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(first, last - first) for c in ("doc_id", "print")), pa.array(n.astype(np.int64)), raw], ["doc_id", "print", "n_words", "buckets"])

    own = docs.select("doc_id", F.xxhash64(text, "doc_id").alias("print"), F.col(text).alias("text"))
    return own.mapInArrow(turn, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long, n_words long, buckets binary")


def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, words of each of these rows, their buckets) of a batch of texts_in_buckets, a bounded number at once."""
    column, n = batch.column("buckets"), batch.column("n_words").to_numpy()
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    for first, last in row_runs(ends, AT_ONCE):
        yield first, last, n[first:last], data[ends[first] : ends[last]].view("<u2").astype(np.int32)


def neighbours(n: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts side by side with edges between them, and the place of each word there."""
    row = np.full(len(buckets) + SIDE * (len(n) + 1), EDGE, np.int32)
    at = np.arange(len(buckets)) + SIDE * (1 + np.repeat(np.arange(len(n)), n))
    row[at] = buckets
    return row, at


def summed_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, the sum of each one's rows of values)."""
    by = np.argsort(keys.astype(np.uint16), kind="stable")  # a radix sort
    ordered = keys[by]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return ordered[first], np.add.reduceat(values.take(by, 0), first)


def flat(nodes: np.ndarray) -> np.ndarray:
    """The places of each row's nodes down to TOP in a table of ABOVE columns."""
    return np.arange(len(nodes))[:, None] * ABOVE + nodes[:, :TOP]


class Network:
    """Embeddings, the hidden layer, and for each inner node of the tree what turns right there; the last number of a node goes with a constant 1."""

    def __init__(self, counts: np.ndarray, seed: int = 23):
        by = np.argsort(-counts, kind="stable")
        self.leaf = np.empty(WORDS, np.int32)
        self.leaf[by] = np.arange(WORDS)
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.3, (WORDS + 1, SIZE)).astype(np.float32)
        self.hidden = rng.normal(0, (2 * SIDE * SIZE) ** -0.5, (2 * SIDE * SIZE, HIDDEN)).astype(np.float32)
        self.node = np.zeros((WORDS, HIDDEN + 1), np.float32)
        mass = counts[by] + 1.0
        for level in reversed(range(DEPTH)):
            # node k of a level of 2^level nodes is row 2^level - 1 + k
            left, right = mass[0::2], mass[1::2]
            self.node[(1 << level) - 1 : (2 << level) - 1, -1] = np.log(right / left)
            mass = left + right

    def path(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the nodes on the way to each word, whether each turns right there as 0 or 1)."""
        leaf = self.leaf[words][:, None]
        return (1 << LEVELS) - 1 + (leaf >> (DEPTH - LEVELS)), leaf >> (DEPTH - 1 - LEVELS) & 1

    def forward(self, context: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(joined embeddings, hidden layer with a 1 behind, numbers of the nodes below TOP, log odds of turning right at each node) for rows of neighbours."""
        x = self.embedding.take(context, 0).reshape(len(context), -1)
        h = np.ones((len(context), HIDDEN + 1), np.float32)
        np.tanh(x @ self.hidden, out=h[:, :-1])
        v = self.node.take(nodes[:, TOP:], 0)
        odds = np.empty(nodes.shape, np.float32)
        odds[:, :TOP] = (h @ self.node[:ABOVE].T).ravel().take(flat(nodes))
        odds[:, TOP:] = np.einsum("ijk,ik->ij", v, h)
        return x, h, v, odds

    def log_probabilities(self, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of each word at these places, given its neighbours."""
        out = np.empty(len(at), np.float32)
        for k in range(0, len(at), BLOCK):
            own = at[k : k + BLOCK]
            nodes, right = self.path(row[own])
            odds = self.forward(row[own[:, None] + OFFSETS], nodes)[3]
            away = np.where(right, -odds, odds)  # the log odds of turning the other way
            out[k : k + BLOCK] = -(np.maximum(away, 0) + np.log1p(np.exp(-np.abs(away)))).sum(1)
        return out

    def step(self, context: np.ndarray, word: np.ndarray, state: dict[str, np.ndarray], rate: float = 0.1) -> None:
        """One gradient step (Adagrad) on the mean cross entropy."""
        nodes, right = self.path(word)
        x, h, v, odds = self.forward(context, nodes)
        d = (1 / (1 + np.exp(-odds)) - right).astype(np.float32) * np.float32(1 / len(word))
        above = np.zeros((len(word), ABOVE), np.float32)
        above.ravel()[flat(nodes)] = d[:, :TOP]
        dh = (above @ self.node[:ABOVE] + np.einsum("ij,ijk->ik", d[:, TOP:], v))[:, :-1] * (1 - h[:, :-1] * h[:, :-1])
        at_node, of_node = summed_by(nodes[:, TOP:].ravel(), (d[:, TOP:, None] * h[:, None, :]).reshape(-1, HIDDEN + 1))
        at_word, of_word = summed_by(context.ravel(), (dh @ self.hidden.T).reshape(-1, SIZE))
        for name, own, g in (("hidden", slice(None), x.T @ dh), ("node", slice(0, ABOVE), above.T @ h), ("node", at_node, of_node), ("embedding", at_word, of_word)):
            state[name][own] += g * g
            getattr(self, name)[own] -= np.float32(rate) * g / np.sqrt(state[name][own] + np.float32(1e-8))

    def rows(self) -> np.ndarray:
        """All weights as rows of SIZE numbers."""
        return np.concatenate([self.embedding, self.node.reshape(-1, SIZE), self.hidden.reshape(-1, SIZE)])

    def take(self, rows: np.ndarray) -> None:
        a, b = len(self.embedding), len(self.embedding) + self.node.size // SIZE
        self.embedding, self.node, self.hidden = rows[:a].copy(), rows[a:b].reshape(self.node.shape).copy(), rows[b:].reshape(self.hidden.shape).copy()


def word_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all texts of texts_in_buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WORDS, np.int64)
        for b in batches:
            for _, _, _, buckets in runs(b):
                total += np.bincount(buckets, minlength=WORDS)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], ["bucket", "n"])

    found = texts.select("n_words", "buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(WORDS)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[pa.RecordBatch]]:
    """The batches of each shard of rows (shard, ...) in order of shard; each shard's are to be read before the next."""

    def parts() -> Iterator[tuple[int, pa.RecordBatch]]:
        for b in batches:
            shard = b.column("shard").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1), len(shard)]
            for first, last in zip(edges[:-1], edges[1:], strict=True):
                if first < last:
                    yield int(shard[first]), b.slice(first, last - first)

    for _, own in groupby(parts(), key=itemgetter(0)):
        yield (b for _, b in own)


def trained_shard(network: Network, batches: Iterator[pa.RecordBatch], turn: int, rounds: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(all weights as rows after one round on a shard, how often it met each row)."""
    own = copy.copy(network)
    own.take(own.rows())
    state = {name: np.zeros_like(getattr(own, name)) for name in ("embedding", "hidden", "node")}
    met, used, steps = np.zeros(WORDS + 1), np.zeros(WORDS), 0
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def learn(all_of_it: bool) -> None:
        # batches of equal size whatever the Arrow batches' borders
        nonlocal waiting, held, steps
        context, word = (np.concatenate(x) for x in zip(*waiting, strict=True))
        whole = len(word) if all_of_it else len(word) // BATCH * BATCH
        for k in range(0, whole, BATCH):
            part = slice(k, min(k + BATCH, whole))
            own.step(context[part], word[part], state)
            met[:] += np.bincount(context[part].ravel(), minlength=WORDS + 1)
            used[:] += np.bincount(own.path(word[part])[0].ravel(), minlength=WORDS)
        steps += whole
        waiting, held = [(context[whole:], word[whole:])], len(word) - whole

    for b in batches:
        for _, _, n, buckets in runs(b):
            row, at = neighbours(n, buckets)
            # by place in the text, so that it doesn't matter which texts come together
            at = at[(np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)) % stride == turn * stride // rounds]
            waiting.append((row[at[:, None] + OFFSETS], row[at]))
            held += len(at)
            if held >= 8 * BATCH:
                learn(False)
    if held:
        learn(True)
    return own.rows(), np.concatenate((met, np.repeat(used, own.node.shape[1] // SIZE), np.full(own.hidden.size // SIZE, float(steps))))


def trained(texts: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE, shard_words: int = SHARD_WORDS) -> Network:
    """A network trained on all texts of texts_in_buckets, null and empty ones having no word, very long ones being read piece by piece.

    The same rows give the same network (but for the order in which sums of floats are added) however they are partitioned and into however many
    tasks the shards are dealt. Copies of a text are taken as
    often as they stand there; they are spread over shards by their ids. Without any word, as for an empty table, it stays at its start.
    """
    counts = word_counts(texts)
    network = Network(counts)
    shards = max(1, -(-int(counts.sum()) // shard_words))
    dealt = texts.select(F.pmod("print", F.lit(shards)).cast("int").alias("shard"), "print", "n_words", "buckets").repartition(shards, "shard").sortWithinPartitions("shard", "print")
    values = [f"v{k}" for k in range(SIZE)]
    for turn in range(rounds):
        shared = texts.sparkSession.sparkContext.broadcast(network)

        def train(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            sums = weights = None
            for rows, weight in (trained_shard(shared.value, shard, turn, rounds, stride) for shard in by_shard(batches)):
                if sums is None:
                    sums, weights = np.zeros(rows.shape), np.zeros(len(rows))
                sums += rows * weight[:, None]
                weights += weight
            if weights is not None:
                there = np.flatnonzero(weights)
                means = (sums[there] / weights[there, None]).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(weights[there]), *(pa.array(means[:, k]) for k in range(SIZE))], ["row", "weight", *values])

        found = dealt.mapInArrow(train, "row int, weight double, " + ", ".join(f"{v} float" for v in values))
        means = found.groupBy("row").agg(*((F.sum(F.col("weight") * F.col(v)) / F.sum("weight")).alias(v) for v in values)).toPandas()
        rows = network.rows()
        rows[means["row"].to_numpy()] = means[values].to_numpy(np.float32)
        network.take(rows)
        shared.unpersist()
    return network


def scored(texts: DataFrame, network: Network) -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_likelihood) for each row of texts_in_buckets."""
    shared = texts.sparkSession.sparkContext.broadcast(network)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last, n, buckets in runs(b):
                row, at = neighbours(n, buckets)
                p = shared.value.log_probabilities(row, at).astype(np.float64)
                total = np.bincount(np.repeat(np.arange(len(n)), n), p, len(n))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(first, last - first), pa.array(n), pa.array(total)], ["doc_id", "n_words", "log_likelihood"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    found = texts.select("doc_id", "n_words", "buckets").mapInArrow(score, f"doc_id {kind}, n_words long, log_likelihood double")
    return found.withColumn("mean_log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def pseudo_log_likelihood(docs: DataFrame, network: Network) -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_likelihood) for each row of docs (doc_id, text), repeated rows included.

    A null text, or one without words, has 0 words, log-likelihood 0 and a null mean. Very long texts are read piece by piece. Other columns
    of docs, whatever their names, are ignored. An empty table gives an empty table.
    """
    return scored(texts_in_buckets(docs), network)


def trained_and_scored(docs: DataFrame) -> DataFrame:
    """pseudo_log_likelihood of docs by a network trained on docs; its cases are those of trained and pseudo_log_likelihood. Jobs run when this is called."""
    texts = written(texts_in_buckets(docs))
    found = written(scored(texts, trained(texts)))
    dropped(texts)
    return found
