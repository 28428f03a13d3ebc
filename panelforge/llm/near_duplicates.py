"""Near-duplicate documents: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates.

1. Each text's set of five-word shingles is hashed once. The hashes, in order, fall into BINS bins; the least of each bin
   is the signature. An empty bin takes the value of another, found by a hash of the bin and an attempt number that is the
   same for all texts. Four neighbouring bins make a band. Texts of equal sets are one node from here on.
2. Nodes with the same band fall into one bucket. A bucket of m nodes gives m - 1 candidate edges: a star around a centre.
   The centre is the node with the most company over its bands: it has the fewest shingles of its own, so a group of copies
   joins around it. The edges are confirmed on the full sets, and confirmed ones joined into components.
3. A star leaves pairs without the centre untested. In buckets that still hold more than one component, pairs of different
   components are tested too, less those that can't be links. What two sets share is at most the shingles that both have in
   common with many nodes, and the rare ones (those of fewer than RARE nodes) that they share. So a pair is tested only if it
   shares a rare shingle, which few do, or if either has enough shingles besides its rare ones. No link between different
   components is lost, and a pair is only tested while it can change the result.

Two sets of similarity 0.85 share none of the 20 bands with a probability of 4e-7, the chance to lose a link.

Every step writes a Parquet table to the checkpoint folder and later steps read the columns they need; tables that are no longer
needed are deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written
from .textbytes import MULTIPLIER, mixed, row_runs, text_bytes, word_hashes, word_spans

SHINGLE = 5
BANDS, ROWS = 20, 4
BINS = BANDS * ROWS
#: Links have 100 * intersection >= SIMILAR * union.
SIMILAR = 85
#: Nodes below which a shingle is rare.
RARE = 16
AT_ONCE = 1 << 20


def byte_table() -> np.ndarray:
    """A-Z as a-z; white space as 0 (a zero byte in a text is moved to 0xFF, which UTF-8 doesn't use)."""
    t = np.arange(256, dtype=np.uint8)
    t[ord("A") : ord("Z") + 1] += 32
    t[0] = 0xFF
    t[[0x20, *range(0x09, 0x0E)]] = 0
    return t


LOWERED = byte_table()


def words_in(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words of each text, their hashes), for texts that lie one after the other."""
    lengths = np.diff(offsets)
    if len(lengths) == 1:  # perhaps very long: piece by piece, each ending before white space
        at, end, parts = int(offsets[0]), int(offsets[1]), []
        while at < end:
            low = LOWERED[data[at : min(end, at + AT_ONCE)]]
            if at + len(low) < end:
                space = np.flatnonzero(low == 0)
                if not len(space):
                    low = LOWERED[data[at:end]]
                    space = np.flatnonzero(low == 0)
                low = low[: space[-1] + 1] if len(space) else low
            parts.append(word_hashes(low, *word_spans(low > 0)))
            at += len(low)
        found = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        return np.array([len(found)]), found
    spaced = np.zeros(int(lengths.sum()) + len(lengths), np.uint8)
    spaced[np.arange(lengths.sum()) + np.repeat(np.arange(len(lengths)), lengths)] = LOWERED[data[offsets[0] : offsets[-1]]]
    starts, ends = word_spans(spaced > 0)
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    return np.bincount(np.searchsorted(begin, starts, "right") - 1, minlength=len(lengths)), word_hashes(spaced, starts, ends)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, size of each row's set, hashes in order within each row)."""
    data, offsets = text_bytes(column)
    for first, last in row_runs(offsets, AT_ONCE):
        n, words = words_in(data, offsets[first : last + 1])
        size = np.minimum(n, SHINGLE)
        count = np.where(n > 0, n - size + 1, 0)
        of = np.repeat(np.arange(len(n)), count)
        at = np.arange(count.sum()) + np.repeat(np.cumsum(n) - n - np.cumsum(count) + count, count)
        total = np.repeat(size, count).astype(np.uint64)
        for k in range(SHINGLE):
            there = np.repeat(size > k, count)
            total[there] = (total[there] + words[at[there] + k]) * MULTIPLIER
        h = mixed(total)
        by = np.lexsort((h, of))
        of, h = of[by], h[by]
        new = np.concatenate(([True], (of[1:] != of[:-1]) | (h[1:] != h[:-1]))) if len(h) else np.empty(0, bool)
        yield first, last, np.bincount(of[new], minlength=len(n)), h[new]


def signatures(n: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A row of BINS values for each set; an empty set has zeros."""
    of = np.repeat(np.arange(len(n)), n)
    bins = (((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    place = of * BINS + bins
    new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))) if len(h) else np.empty(0, int)
    least, filled = np.zeros(len(n) * BINS, np.uint64), np.zeros(len(n) * BINS, bool)
    least[place[new]], filled[place[new]] = h[new], True
    empty = np.flatnonzero(~filled & np.repeat(n > 0, BINS))
    attempt = 0
    while len(empty):
        attempt += 1
        own = (empty % BINS).astype(np.uint64)
        other = empty - empty % BINS + (mixed((own + np.uint64(BINS * attempt)) * MULTIPLIER) % np.uint64(BINS)).astype(np.int64)
        found = filled[other]
        least[empty[found]] = least[other[found]]
        empty = empty[~found]
    return least.reshape(-1, BINS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    total = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * MULTIPLIER
    for k in range(ROWS):
        total = (total + signature[:, k::ROWS]) * MULTIPLIER
    return mixed(total)


def fixed_lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel(), kind))


def prints(n: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set, which stand for the whole set."""
    edge = np.cumsum(n) - n
    return [(np.add.reduceat(np.append(mixed(h * np.uint64(k)), np.uint64(0)), edge) * (n > 0)).view(np.int64) for k in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)]


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, text_print, n_shingles, print1, print2, bands) for each row; text_print is a hash of its text."""

    def sketch(batches):
        for b in batches:
            for first, last, n, h in shingle_sets(b.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(first, last - first) for c in ("doc_id", "text_print")), pa.array(n, pa.int64()), *map(pa.array, prints(n, h)), fixed_lists(band_keys(signatures(n, h)).view(np.int64), pa.int64())],
                    ["doc_id", "text_print", "n_shingles", "print1", "print2", "bands"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("text_print"), "text").mapInArrow(sketch, f"doc_id {id_type}, text_print long, n_shingles long, print1 long, print2 long, bands array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles binary): the sets of nodes (node, least, text_print, n_shingles, print1, print2), each found in a document of that id and hash of text whose prints are the node's.

    The hash is in the join, so that many texts under one id don't meet each other.
    """

    def sets(batches):
        for b in batches:
            for first, last, n, h in shingle_sets(b.column("text")):
                ends = np.cumsum(n)
                own = b.slice(first, last - first)
                wanted = [own.column(c).to_numpy() for c in ("n_shingles", "print1", "print2")]
                same = np.logical_and.reduce([x == y for x, y in zip((n, *prints(n, h)), wanted, strict=True)])
                found = [h[e - k : e].tobytes() if keep else None for e, k, keep in zip(ends, n, same, strict=True)]
                yield pa.RecordBatch.from_arrays([own.column("node"), pa.array(found, pa.binary())], ["node", "shingles"]).filter(pa.array(same))

    wanted = docs.select(F.col("doc_id").alias("least"), F.xxhash64("text").alias("text_print"), "text").join(nodes, ["least", "text_print"])
    return wanted.select("node", "n_shingles", "print1", "print2", "text").mapInArrow(sets, "node long, shingles binary").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """(a, b): the components of the pairs (one, other, a, b) that are links by their full sets."""
    both = pairs.join(sets.select(F.col("node").alias("one"), F.col("shingles").alias("s")), "one").join(sets.select(F.col("node").alias("other"), F.col("shingles").alias("t")), "other")

    def compare(batches):
        for b in batches:
            found = []
            for x, y in zip(b.column("s"), b.column("t"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(p, q)
                shared = int((p[np.minimum(at, len(p) - 1)] == q).sum()) if len(p) else 0
                found.append(100 * shared >= similar * (len(p) + len(q) - shared))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(found, pa.bool_()))

    return both.select("a", "b", "s", "t").mapInArrow(compare, "a long, b long").distinct()


def hinted(df: DataFrame, hint: str | None) -> DataFrame:
    return df.hint(hint) if hint else df


def components(links: DataFrame, hint: str | None = None) -> DataFrame:
    """(node, component), written: the least node reachable over links (a, b). Labels spread and then jump to their label's label.

    hint is a join hint: `merge` keeps what many small joins would broadcast out of the driver's memory.
    """
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        heard = edges.join(hinted(labels.withColumnRenamed("node", "b"), hint), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        spread = labels.join(hinted(heard, hint), "node", "left").select("node", F.col("component").alias("was"), F.least("component", "heard").alias("now"))
        ahead = labels.select(F.col("node").alias("now"), F.col("component").alias("then"))
        found = written(spread.join(hinted(ahead, hint), "now", "left").select("node", "was", F.least("now", "then").alias("component")))
        dropped(labels)
        labels = found.select("node", "component")
        if found.where("was <> component").isEmpty():
            dropped(edges)
            return labels


def buckets(classes: DataFrame) -> DataFrame:
    """(key, node, company, component) of the buckets with more than one node; company: the nodes of all its buckets. Each node is a component."""
    rows = classes.select(F.explode("bands").alias("key"), "node")
    several = rows.groupBy("key").agg(F.count(F.lit(1)).alias("company")).where("company > 1")
    # a node has BANDS keys at most
    own = rows.join(several, "key").groupBy("node").agg(F.sum("company").alias("company"), F.collect_list("key").alias("keys"))
    return own.select(F.explode("keys").alias("key"), "node", "company", F.col("node").alias("component"))


def star(members: DataFrame, hint: str | None = None) -> DataFrame:
    """Candidate pairs (one, other, a, b) of buckets (key, node, company, component) of more than one component: a centre with each node of another component, and their components."""
    best = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max(F.struct("company", (-F.col("node")).alias("least"), "node", "component")).alias("centre"))
    best = best.where("low < high").select("key", F.col("centre.node").alias("other"), F.col("centre.component").alias("b"))
    pairs = members.join(hinted(best, hint), "key").where("component <> b")
    return pairs.select(F.col("node").alias("one"), "other", F.col("component").alias("a"), "b").distinct()


def relabelled(members: DataFrame, labels: DataFrame, hint: str | None = None) -> DataFrame:
    """members (component, ...) with the components that labels (node, component) give to theirs; those without one keep it."""
    new = labels.select(F.col("node").alias("component"), F.col("component").alias("__new"))
    return members.join(hinted(new, hint), "component", "left").withColumn("component", F.coalesce("__new", "component")).drop("__new")


def unsettled(members: DataFrame, hint: str | None = None) -> DataFrame:
    """The rows of buckets that hold more than one component."""
    mixed_keys = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    return members.join(hinted(mixed_keys, hint), "key", "left_semi")


def shingle_rows(sets: DataFrame) -> DataFrame:
    """(node, shingle)"""

    def single(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                found = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("shingles")]
                lengths = np.array([len(x) for x in found])
                yield pa.RecordBatch.from_arrays([part.column("node").take(pa.array(np.repeat(np.arange(len(found)), lengths))), pa.array(np.concatenate(found))], ["node", "shingle"])

    return sets.mapInArrow(single, "node long, shingle long")


def rest(members: DataFrame, sizes: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Pairs (one, other, a, b), written, of different components of these buckets that may be links, by their sizes and shingles.

    sizes is (node, n_shingles, bands). What two sets share is at most what either has besides its rare shingles, and their shared rare
    ones. A pair that shares several buckets comes from the first of them.
    """
    nodes = members.select("node", "component").distinct()
    rows = shingle_rows(sets.join(nodes, "node", "left_semi"))
    few = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < RARE)
    rare = written(rows.join(few, "shingle").select("node", "shingle", F.col("n").cast("int").alias("n")))
    n_rare = rare.groupBy("node").agg(F.count(F.lit(1)).alias("n_rare"))
    facts = nodes.join(sizes, "node").join(n_rare, "node", "left")
    facts = written(facts.select("node", "component", "n_shingles", "bands", (F.col("n_shingles") - F.coalesce("n_rare", F.lit(0))).alias("common")))
    fits = lambda shared: shared * (100 + similar) >= (F.col("n_shingles_one") + F.col("n_shingles_other")) * similar
    either = F.least("common_one", "common_other")

    def pairs(on: str, df: DataFrame) -> DataFrame:
        one, other = (df.select(on, *(F.col(c).alias(f"{c}_{side}") for c in df.columns if c != on)) for side in ("one", "other"))
        return one.join(other, on).where("node_one < node_other and component_one <> component_other")

    sharing = pairs("shingle", rare.where("n > 1").select("node", "shingle").join(facts.drop("bands"), "node"))
    sharing = sharing.groupBy(*(c for c in sharing.columns if c != "shingle")).agg(F.count(F.lit(1)).alias("shared")).where(fits(either + F.col("shared")))
    # of a bucket, only nodes that could be linked with one of the least size and no rare shingle
    crowd = members.select("key", "node").join(facts, "node")
    least = crowd.groupBy("key").agg(F.min("n_shingles").alias("least"))
    crowd = crowd.join(least, "key").where(F.col("common") * (100 + similar) >= (F.col("n_shingles") + F.col("least")) * similar)
    alike = pairs("key", crowd.select("key", *facts.columns)).where(fits(either) & (F.col("key") == F.get(F.array_intersect("bands_one", "bands_other"), F.lit(0))))
    names = ["node_one", "node_other", "component_one", "component_other"]
    found = written(sharing.select(*names).union(alike.select(*names)).distinct().toDF("one", "other", "a", "b"))
    dropped(rare, facts)
    return found


def near_duplicates(docs: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text; other columns are ignored).

    component_id is the least doc_id reachable over links, and kept says that it is the row's own. A null text, or one without
    words, has an empty set and is linked with nothing. Very long texts are read piece by piece. Rows are compared by their texts
    alone: repeated rows share one component, and texts that share a doc_id are documents of their own, each with the component of
    its text. A null doc_id takes no part in links; it gets the component of its equals, if they have an id, else null, and isn't
    kept. An empty table gives an empty table.
    """
    rows = written(sketched(docs))
    by = ["n_shingles", "print1", "print2"]
    named = rows.where("n_shingles > 0 and doc_id is not null").groupBy(*by).agg(F.min(F.struct("doc_id", "text_print")).alias("__first"), F.first("bands").alias("bands"))
    named = named.select(*by, F.col("__first.doc_id").alias("least"), F.col("__first.text_print").alias("text_print"), "bands")
    classes = written(named.withColumn("node", F.monotonically_increasing_id()))
    members = written(buckets(classes))
    labels = None
    if not members.isEmpty():
        nodes = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "least", "text_print", *by)
        sets = written(full_sets(docs, nodes))
        labels = linked(members, classes.select("node", "n_shingles", "bands"), sets, similar)
        dropped(members, sets)
    of_class = classes.select(*by, "least", F.col("node").alias("component"))
    if labels is not None:
        of_class = relabelled(of_class, labels)
        first = of_class.groupBy("component").agg(F.min("least").alias("first"))
        of_class = of_class.join(first, "component").select(*by, F.col("first").alias("least"))
    found = rows.select("doc_id", *by).join(of_class.select(*by, "least"), by, "left")
    component = F.coalesce("least", "doc_id")
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def linked(members: DataFrame, sizes: DataFrame, sets: DataFrame, similar: int) -> DataFrame | None:
    """(node, component) of the nodes that are linked with another; None if none is."""
    pairs = written(star(members))
    links = written(confirmed(pairs, sets, similar))
    first = None if links.isEmpty() else components(links)
    if first is not None:
        members = relabelled(members, first)
    left = written(unsettled(members.select("key", "node", "component")))
    dropped(pairs, links)
    if left.isEmpty():
        return first
    pairs = rest(left, sizes, sets, similar)
    links = written(confirmed(pairs, sets, similar))
    second = None if links.isEmpty() else components(links)
    dropped(left, pairs, links)
    if first is None or second is None:
        return first if second is None else second
    # components of the second round are nodes or components of the first
    later = relabelled(first, second)
    return written(later.select("node", "component").union(second.join(first.select("node"), "node", "left_anti").select("node", "component")))
