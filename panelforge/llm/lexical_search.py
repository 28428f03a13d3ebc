"""Ranked lexical search of a set of items over all documents, exact, with blocks that are skipped by bounds.

Documents are split on flat bytes once; what is kept of each is its length and, of the terms that items ask for, how often it has
them. Counts over all documents give the weights. Then each task indexes its documents, a bounded number at once: a
document is the row of what each of its terms adds to a score. A term's posting list is cut into blocks of documents that
look alike (each goes to the most alike of some documents of the list), and a block keeps, for each term, the most that any of its
documents has. The sum of these over an item's terms is a bound for each document of the block. A block is left out only if its bound
is below the item's tenth best score so far, and a whole list only if it and the lists after it can't add up to that, so nothing
is lost. The best of all tasks are merged.

Lists are cut when an item first needs them, and a block keeps only terms that items ask for together with the list's own.
Items go in blocks of a bounded number of terms, each against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, written
from .textbytes import row_runs, text_bytes, word_spans

#: Bytes of text that are split at once; one longer text stands alone.
AT_ONCE = 8 << 20
#: Distinct pairs of item and term that are searched for at once.
ITEM_TERMS = 500_000
#: Documents and postings that are indexed at once.
DOCUMENTS, POSTINGS = 1 << 15, 1 << 21
#: Documents of a block, on average, and the numbers by which documents are compared.
BLOCK, SKETCH = 48, 24
#: Letters and digits of ASCII and all bytes above it, A-Z as a-z; 0 for what lies between terms.
FOLDED = np.array([b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() and b < 128 or b > 127 else 0 for b in range(256)], np.uint8)


def text_terms(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the terms of all texts in order, the number of terms of each text)."""
    raw, offsets = text_bytes(column)
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return pa.array([], pa.large_string()), np.zeros(len(column), np.int64)
    data = FOLDED[raw[offsets[0] : offsets[-1]]]
    edges = offsets - offsets[0]
    # a line between texts, so that no term runs over it
    place = np.arange(len(data)) + np.repeat(np.arange(len(column)), np.diff(edges))
    spaced = np.zeros(len(data) + len(column), np.uint8)
    spaced[place] = data
    starts, ends = word_spans(spaced != 0)
    ends_at = np.concatenate(([0], np.cumsum(ends - starts)))
    terms = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends_at), pa.py_buffer(spaced[spaced != 0])])
    return terms, np.diff(np.searchsorted(starts, edges + np.arange(len(edges))))


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), once each, of items (item_id, text)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms, counts = text_terms(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("item_id").take(pa.array(np.repeat(np.arange(b.num_rows), counts))), terms.cast(pa.string())], ["item_id", "term"])

    return items.select("item_id", "text").mapInArrow(split, f"item_id {items.schema['item_id'].dataType.simpleString()}, term string").distinct()


def lengths_and_counts(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, terms, tf) of each row of docs with at least one term: its number of terms, and those of the vocabulary by their
    place in it, in ascending order, with how often it has them."""
    wanted = pa.array(vocabulary, pa.large_string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, offsets = text_bytes(b.column("text"))
            for first, last in row_runs(offsets, AT_ONCE):
                words, n = text_terms(b.column("text").slice(first, last - first))
                coded = words.dictionary_encode()
                known = pc.index_in(coded.dictionary, value_set=wanted).fill_null(-1).to_numpy()
                term = known[coded.indices.to_numpy()] if len(words) else np.empty(0, np.int64)
                row = np.repeat(np.arange(len(n)), n)
                pair, tf = np.unique(row[term >= 0] * np.int64(len(wanted)) + term[term >= 0], return_counts=True)
                there = np.flatnonzero(n)
                ends = pa.array(np.concatenate(([0], np.searchsorted(pair, (there + 1) * np.int64(len(wanted))))).astype(np.int32))
                # documents without terms have no postings, so those of the others follow one another
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in ((pair % max(1, len(wanted))).astype(np.int32), tf)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(first, last - first).take(pa.array(there)), pa.array(n[there]), *lists], ["doc_id", "n", "terms", "tf"])

    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, terms array<int>, tf array<long>")


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, .. of each range, one after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def summed(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each run of so many values."""
    total = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


class Index:
    """Postings of some documents, with what each adds to a score; lists are cut into blocks when they are first asked for."""

    def __init__(self, first: np.ndarray, count: np.ndarray, term: np.ndarray, value: np.ndarray, asked: dict[int, np.ndarray], terms: int):
        self.first, self.count, self.term, self.value, self.asked, self.terms = first, count, term, value, asked, terms
        doc = np.repeat(np.arange(len(count)), count)
        by = np.argsort(term, kind="stable")
        self.holders, self.held = doc[by], np.searchsorted(term[by], np.arange(terms + 1))
        self.most = np.zeros(terms, np.int64)
        np.maximum.at(self.most, term, value)
        signs = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (terms, SKETCH))
        self.looks = np.zeros((len(count), SKETCH), np.float32)
        some = np.flatnonzero(count)
        for k in range(0, SKETCH, 4):  # a few columns at once, so that memory stays a few numbers a posting
            if len(some):
                self.looks[some, k : k + 4] = np.add.reduceat(signs[term, k : k + 4] * value[:, None].astype(np.float32), first[some], axis=0)
        self.looks /= np.maximum(np.linalg.norm(self.looks, axis=1, keepdims=True), 1e-9)
        self.lists: dict[int, tuple] = {}

    def blocks(self, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(documents of the list by block, how many each block has; terms and most values of each block's summary, how many it has)."""
        if t not in self.lists:
            docs = self.holders[self.held[t] : self.held[t + 1]]
            k = -(-len(docs) // BLOCK)
            centres = self.looks[docs[:: max(1, len(docs) // k)][:k]]
            own = np.concatenate([np.argmax(self.looks[docs[i : i + 4096]] @ centres.T, axis=1) for i in range(0, len(docs), 4096)])
            by = np.argsort(own, kind="stable")
            docs, own = docs[by], own[by]
            keys, most = np.empty(0, np.int64), np.empty(0, np.int64)
            together = np.zeros(self.terms, bool)
            together[self.asked[t]] = True
            # the list in runs of about as many postings, so that one with very long documents needs no more memory
            edges = np.searchsorted(np.cumsum(self.count[docs]), np.arange(POSTINGS, self.count[docs].sum() + POSTINGS, POSTINGS))
            for a, b in zip([0, *(edges + 1)], [*(edges + 1)], strict=False):
                at = ranges(self.first[docs[a:b]], self.count[docs[a:b]])
                block = np.repeat(own[a:b], self.count[docs[a:b]])
                use = together[self.term[at]]
                key = np.concatenate((keys, block[use] * np.int64(self.terms) + self.term[at[use]]))
                values = np.concatenate((most, self.value[at[use]]))
                order = np.argsort(key, kind="stable")
                keys, starts = np.unique(key[order], return_index=True)
                most = np.maximum.reduceat(values[order], starts) if len(keys) else most
            self.lists[t] = docs, np.bincount(own, minlength=k), (keys % self.terms).astype(np.int32), most, np.bincount(keys // self.terms, minlength=k)
        return self.lists[t]

    def search(self, terms: np.ndarray, best: list[int], k: int) -> list[tuple[int, int]]:
        """(score, document) of all that could be among an item's k best, of which best holds scores found elsewhere so far, in descending order."""
        terms = terms[self.held[terms + 1] > self.held[terms]]
        terms = terms[np.argsort(-self.most[terms], kind="stable")]
        after = np.cumsum(self.most[terms][::-1])[::-1]
        asked, seen, out = np.zeros(self.terms, bool), np.zeros(len(self.count), bool), []
        asked[terms] = True
        best = list(best)
        for t, rest in zip(terms, after, strict=True):
            least = best[k - 1] if len(best) >= k else 1
            if rest < least:  # what is in no list so far can't get there
                break
            docs, sizes, summary, most, widths = self.blocks(int(t))
            bound = summed(np.where(asked[summary], most, 0), widths)
            order, begin = np.argsort(-bound, kind="stable"), np.cumsum(sizes) - sizes
            step = 4
            while len(order):
                order = order[bound[order] >= least]
                now, order, step = order[:step], order[step:], 2 * step
                found = docs[ranges(begin[now], sizes[now])]
                found = found[~seen[found]]
                seen[found] = True
                if not len(found):
                    continue
                at = ranges(self.first[found], self.count[found])
                score = summed(np.where(asked[self.term[at]], self.value[at], 0), self.count[found])
                good = score >= least
                out += zip(score[good].tolist(), found[good].tolist(), strict=True)
                best = sorted(best + score[good].tolist(), reverse=True)[:k]
                least = best[k - 1] if len(best) >= k else 1
        return [(s, d) for s, d in out if s >= least]


def best_of_tasks(counted: DataFrame, items: list[tuple], weights: np.ndarray, n: int, total: int, k: int, documents: int, postings: int) -> DataFrame:
    """(item, doc_id, score): of each task and item (its place in items, which hold places of terms) the k best documents and those that share the last place's score."""
    kind = counted.schema["doc_id"].dataType.simpleString()
    gathered: dict[int, list[np.ndarray]] = {}
    for terms in items:
        for t in terms:
            gathered.setdefault(int(t), []).append(terms)
    asked = {t: np.unique(np.concatenate(x)) for t, x in gathered.items()}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items]
        waiting, rows, held, id_type = [], 0, 0, None

        def index_and_search() -> None:
            doc_ids, lengths, count, term, tf = (np.concatenate([w[i] for w in waiting]) for i in range(5))
            # exact whatever the size: Python's numbers where 64 bits might not hold the product
            lengths = lengths if not len(lengths) or int(lengths.max()) * n * 90 < 1 << 63 else lengths.astype(object)
            m = (10 + 90 * lengths * n // max(1, total)).astype(np.int64)
            value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, count)))
            index = Index(np.cumsum(count) - count, count, term, value, asked, len(weights))
            for i, terms in enumerate(items):
                found = index.search(terms, [s for s, _ in best[i]], k)
                if found:
                    both = sorted(best[i] + [(s, doc_ids[d]) for s, d in found], key=lambda x: -x[0])
                    best[i] = [x for x in both if len(both) < k or x[0] >= both[k - 1][0]]
                    if len(best[i]) > 4 * k:  # many of one score: those that come first by id
                        best[i] = sorted(best[i], key=lambda x: (-x[0], x[1] is None, x[1]))[:k]

        for b in batches:
            id_type = b.column("doc_id").type
            ends = b.column("terms").offsets.to_numpy()
            ids = np.empty(b.num_rows, object)
            ids[:] = b.column("doc_id").to_pylist()
            done = 0
            while done < b.num_rows:
                last = max(done + 1, min(b.num_rows, done + documents, int(np.searchsorted(ends, ends[done] + postings, "right")) - 1))
                own = slice(ends[done], ends[last])
                waiting.append((ids[done:last], b.column("n").to_numpy()[done:last], np.diff(ends[done : last + 1]).astype(np.int64), b.column("terms").values.to_numpy()[own], b.column("tf").values.to_numpy()[own]))
                rows, held, done = rows + last - done, held + int(ends[last] - ends[done]), last
                if rows >= documents or held >= postings:
                    index_and_search()
                    waiting, rows, held = [], 0, 0
        if waiting:
            index_and_search()
        found = [(i, d, s) for i, rows_of in enumerate(best) for s, d in rows_of]
        if found:
            i, d, s = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(d, id_type), pa.array(s, pa.int64())], ["item", "doc_id", "score"])

    return counted.mapInArrow(search, f"item int, doc_id {kind}, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, pairs_at_once: int = ITEM_TERMS, documents: int = DOCUMENTS, postings: int = POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best rows of docs (doc_id, text) for each of items (item_id, text), those above 0; equal scores by ascending doc_id, a null one last.

    Rows of items that share an id, a null one included, are one item. Rows of docs are documents of their own even if they repeat an id or a text. Null and empty texts, and texts without
    terms, are found by nothing and count for nothing; items without terms find nothing. Texts of any length are read whole. Other
    columns of either table, whatever their names, are ignored. An empty table of either kind gives an empty table. Jobs run when this is called: counts
    of documents are written to the shared folder. The result doesn't depend on how many pairs of item and term are searched for, and how
    many documents and postings are indexed, at once.
    """
    spark = docs.sparkSession
    id_type = items.schema["item_id"].dataType.simpleString()
    pairs = written(item_terms(items))
    schema = f"item_id {id_type}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long"
    # items are dealt by hash into blocks of about pairs_at_once pairs; each is searched for in turn
    blocks = -(-pairs.count() // pairs_at_once)
    out = None
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        if not own.num_rows:
            continue
        coded, of_item = (own.column(c).combine_chunks().dictionary_encode(null_encoding="encode") for c in ("term", "item_id"))
        vocabulary = coded.dictionary.to_pylist()
        item, term = of_item.indices.to_numpy(), coded.indices.to_numpy()
        by = np.argsort(item, kind="stable")
        items_of_block = np.split(term[by].astype(np.int64), np.cumsum(np.bincount(item))[:-1])
        counted = written(lengths_and_counts(docs, vocabulary))
        n, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = {r.term: r.n for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
        weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
        best = written(best_of_tasks(counted, items_of_block, weights, n, total, k, documents, postings))
        dropped(counted)
        key = spark.createDataFrame(pa.table({"item": pa.array(range(len(of_item.dictionary)), pa.int32()), "item_id": of_item.dictionary}))
        first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
        found = ranked.join(key, "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.union(found)
    dropped(pairs)
    return out if out is not None else spark.createDataFrame([], schema)
