"""Phrases whose words occur together more often than apart, counted over prefix-free parsed texts.

A text is a row of words; some are followed by a break (the end of a piece). It is cut into chunks wherever three consecutive words
hash to a trigger: a chunk begins with such a window and ends with the next one, so neighbours share three words, and equal passages
give equal chunks wherever they stand. All chunks of a language are a dictionary with how often each occurs in the parse. Every run
of up to four words lies whole in the chunk in which it starts if it starts before the last three words, which belong to the
next chunk; so runs are counted inside distinct chunks, weighted by the chunks' frequencies, each once. The last chunk of a text ends with a break.

Counting goes by length: a phrase can only be frequent if its parts are. What is frequent is set in a bitmap of fixed size, by hash,
which the next pass over the dictionary reads; a false hit costs a row, never a result, and a full bitmap only saves nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, written
from .textbytes import mixed, row_runs, text_bytes, word_hashes, word_spans

#: Words that neighbouring chunks share: those of the longest phrase but one.
SHARED = 3
LONGEST = SHARED + 1
#: One of so many windows is a trigger.
TRIGGER = 32
#: Bytes of text or chunks that are worked on at once; one longer text stands alone.
AT_ONCE = 2 << 20
#: Bits of the map of frequent phrases: 8 MB, whatever the corpus.
BITS = 1 << 26
#: Parts into which a language's phrases are dealt before their first ones are merged.
PARTS = 32
#: Lower case, with a blank between words and a line feed between pieces.
SHOWN = np.array([b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?" or 10 <= b <= 13 else b for b in range(256)], np.uint8)
BLANK, BREAK = 32, 10
FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Strings of these spans of UTF-8 bytes."""
    ends = np.concatenate(([0], np.cumsum(lengths)))
    own = data[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(own)])


def words_and_breaks(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shown bytes, starts and ends of words, whether a break follows each, its row) of rows of bytes, whose edges these are; a break ends a row."""
    rows = len(edges) - 1
    spaced = np.full(len(raw) + rows, BREAK, np.uint8)
    spaced[np.arange(len(raw)) + np.repeat(np.arange(rows), np.diff(edges))] = SHOWN[raw]
    starts, ends = word_spans((spaced != BLANK) & (spaced != BREAK))
    broken = np.flatnonzero(spaced == BREAK)
    last = np.append(starts[1:], len(spaced))
    # a break between a word's end and the start of the next word
    follows = np.searchsorted(broken, ends) < np.searchsorted(broken, last)
    row = np.searchsorted(edges[1:] + np.arange(1, rows + 1), starts, "right")
    return spaced, starts, ends, follows, row


def chunks_of(raw: np.ndarray, edges: np.ndarray, trigger: int = TRIGGER) -> tuple[pa.Array, np.ndarray]:
    """(chunks of all texts in order, the row of each)."""
    spaced, starts, ends, follows, row = words_and_breaks(raw, edges)
    n = len(starts)
    if not n:
        return pa.array([], pa.large_string()), np.empty(0, np.int64)
    own = word_hashes(spaced, starts, ends)
    window = np.zeros(n, np.uint64)
    for k in range(SHARED):
        window[: n - k] += own[k:] * FACTORS[k]
    begins = np.concatenate(([True], row[1:] != row[:-1]))
    last = np.concatenate((begins[1:], [True]))
    whole = np.zeros(n, bool)  # the window lies in one text and doesn't end it, so that something is left for its chunk
    whole[: max(0, n - SHARED)] = row[: max(0, n - SHARED)] == row[SHARED:]
    first = np.flatnonzero(begins | whole & (mixed(window) % np.uint64(trigger) == 0))
    after = np.append(first[1:], n)
    closing = last[after - 1]
    # words one after the other, a blank or a line feed behind each
    lengths = ends - starts
    place = np.cumsum(lengths + 1) - (lengths + 1)
    flat = np.where(np.repeat(follows, lengths + 1), np.uint8(BREAK), np.uint8(BLANK))
    flat[np.repeat(place - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())] = spaced[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]
    final = np.where(closing, after, np.minimum(after + SHARED, n)) - 1
    size = place[final] + lengths[final] + closing - place[first]
    return gathered(flat, place[first], size), row[first]


def dictionary(docs: DataFrame, trigger: int = TRIGGER) -> DataFrame:
    """(lang, chunk, freq) of docs (lang, text)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, offsets = text_bytes(b.column("text"))
            for a, e in row_runs(offsets, AT_ONCE):
                chunks, row = chunks_of(raw[offsets[a] : offsets[e]], offsets[a : e + 1] - offsets[a], trigger)
                yield pa.RecordBatch.from_arrays([b.column("lang").slice(a, e - a).take(pa.array(row)), chunks.cast(pa.string())], ["lang", "chunk"])

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    return docs.select(lang, "text").mapInArrow(parse, "lang string, chunk string").groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("freq"))


def phrase_hashes(own: list[np.ndarray], lang: np.ndarray) -> np.ndarray:
    """A hash of phrases, from those of their words and of their language."""
    total = lang * FACTORS[3]
    for k, h in enumerate(own):
        total = mixed(total + h * FACTORS[k % 3])
    return total


def hashes_of(column: pa.Array) -> np.ndarray:
    """A hash of each string, which isn't empty."""
    data, offsets = text_bytes(column)
    return word_hashes(data, offsets[:-1], offsets[1:])


def lang_hashes(column: pa.Array) -> np.ndarray:
    """A hash of each language, an empty name too."""
    return hashes_of(pa.array([f"{x}." for x in column.to_pylist()], pa.large_string()))


class Bitmap:
    """Which hashes are set; others may seem to be."""

    def __init__(self, size: int, cells: np.ndarray, bits: np.ndarray):
        self.size, self.words = np.uint64(size), np.zeros(size // 64, np.uint64)
        self.words[cells] = bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes % self.size
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def bitmap(phrases: DataFrame, n: int, size: int = BITS) -> Bitmap:
    """The bitmap, of so many bits, of phrases (lang, phrase) of n words."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_bytes(b.column("phrase"))
            own = word_hashes(*words_and_breaks(data[offsets[0] : offsets[-1]], offsets - offsets[0])[:3])
            langs = b.column("lang").dictionary_encode()
            at = phrase_hashes([own[k::n] for k in range(n)], lang_hashes(langs.dictionary)[langs.indices.to_numpy()]) % np.uint64(size)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["cell", "bits"])

    rows = phrases.select("lang", "phrase").mapInArrow(mark, "cell int, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    found = rows.toArrow()  # size / 64 rows at most
    return Bitmap(size, found.column("cell").to_numpy(), found.column("bits").to_numpy().view(np.uint64))


def phrase_counts(chunks: DataFrame, sizes: tuple[int, ...], frequent: tuple[int, Bitmap] | None = None) -> DataFrame:
    """(lang, phrase, f) of the phrases of these numbers of words in the dictionary; with frequent, (m, a bitmap of phrases of m words), of those
    alone whose parts of m words it holds. With a size of 0 the empty phrase counts all words."""
    shared = chunks.sparkSession.sparkContext.broadcast(frequent) if frequent else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, offsets = text_bytes(b.column("chunk"))
            for a, e in row_runs(offsets, AT_ONCE):
                yield from count_run(b.slice(a, e - a))

    def count_run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, offsets = text_bytes(b.column("chunk"))
        raw, edges = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
        spaced, starts, ends, follows, row = words_and_breaks(raw, edges)
        if not len(starts):
            return
        closing = raw[edges[1:] - 1] == BREAK
        last = np.concatenate((row[1:] != row[:-1], [True]))
        ends_at = np.flatnonzero(follows | last)
        stop = ends_at[np.searchsorted(ends_at, np.arange(len(starts)))]
        #: Words from each one to the end of its piece or chunk, itself included; 0 for words that belong to the next chunk.
        room = stop - np.arange(len(starts)) + 1
        final = np.flatnonzero(last)[np.searchsorted(np.flatnonzero(last), np.arange(len(starts)))]
        own = (final - np.arange(len(starts)) >= SHARED) | closing[row]
        inside = spaced[np.repeat(starts - (np.cumsum(ends - starts) - (ends - starts)), ends - starts) + np.arange((ends - starts).sum())]
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.concatenate(([0], np.cumsum(ends - starts)))), pa.py_buffer(inside)]).dictionary_encode()
        langs = b.column("lang").dictionary_encode()
        lang, freq = langs.indices.to_numpy()[row].astype(np.int64), b.column("freq").to_numpy()[row]
        n_langs = len(langs.dictionary)
        # codes of runs of words, exact: those of one word shorter and the next word, made dense again
        code = words.indices.to_numpy().astype(np.int64) * n_langs + lang
        heads = {}
        codes, code = np.unique(code, return_inverse=True)
        word_code, n_words = code, len(codes)
        hashes = phrase_hashes([hashes_of(words.dictionary)[codes // n_langs]], lang_hashes(langs.dictionary)[codes % n_langs])
        holds = None
        if frequent and shared.value[0] == 1:
            holds = shared.value[1].holds(hashes)[code]
        for n in range(1, LONGEST + 1):
            if n > 1:
                there = room >= n
                if frequent and n > shared.value[0]:
                    m = shared.value[0]
                    for k in range(n - m + 1):
                        there[: len(there) - k] &= holds[k:]
                        there[len(there) - k :] = False
                at = np.flatnonzero(there)
                pair = code[at] * n_words + word_code[at + n - 1]
                codes, dense = np.unique(pair, return_inverse=True)
                code = np.zeros(len(starts), np.int64)
                code[at] = dense
                if frequent and shared.value[0] == n == 2:
                    words_of, lang_of = hashes_of(words.dictionary), lang_hashes(langs.dictionary)
                    some = np.zeros(len(codes), np.int64)
                    some[dense] = at
                    found = shared.value[1].holds(phrase_hashes([words_of[words.indices.to_numpy()[some]], words_of[words.indices.to_numpy()[some + 1]]], lang_of[lang[some]]))
                    holds = np.zeros(len(starts), bool)
                    holds[at] = found[dense]
            else:
                at = np.arange(len(starts))
            if n in sizes:
                heads[n] = at[own[at]], code[at[own[at]]], len(codes)
            if n == max(sizes):
                break
        for n, (at, dense, kinds) in heads.items():
            total = np.zeros(kinds, np.int64)
            np.add.at(total, dense, freq[at])
            some = np.zeros(kinds, np.int64)
            some[dense] = at
            some = some[total > 0]
            # what lies between the words of a phrase is blanks
            length = ends[some + n - 1] - starts[some]
            yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(lang[some])), gathered(spaced, starts[some], length).cast(pa.string()), pa.array(total[total > 0])], ["lang", "phrase", "f"])
        if 0 in sizes:
            total = np.zeros(n_langs, np.int64)
            np.add.at(total, lang[own], freq[own])
            yield pa.RecordBatch.from_arrays([langs.dictionary.cast(pa.string()), pa.array([""] * n_langs, pa.string()), pa.array(total)], ["lang", "phrase", "f"])

    rows = chunks.mapInArrow(count, "lang string, phrase string, f long")
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def part(first: Column | int, count: Column | int) -> Column:
    """Words of the array `words`, joined again."""
    return F.array_join(F.slice("words", first, count), " ")


def collocations(docs: DataFrame, least: int = 30, first: int = 2000, trigger: int = TRIGGER, bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's phrases of 2 to 4 words that hold together most, of docs (lang, text).

    a is how often the phrase occurs, least at fewest; n the number of the language's words; l and r how often the two parts occur of the
    cut at which 2,000,000 a / (l + r), rounded down, is least (the score). A phrase is left out if a longer candidate that has its words in a row occurs
    at least 0.8 times as often. Ranks go by score and a, the greatest first, then by phrase in byte order; the last is `first`. The
    result doesn't depend on trigger (one of so many windows begins a chunk) and bits (of the map of what is frequent, a multiple of 64).

    A null language is `und`, a null text an empty one. Repeated rows count as often as they stand there. Texts of any length are read whole.
    Other columns, whatever their names, are ignored. An empty table gives an empty table. Jobs run when this is called: the dictionary and
    the frequent phrases are written to the shared folder.
    """
    chunks = written(dictionary(docs, trigger))
    enough = F.col("f") >= least
    ones = written(phrase_counts(chunks, (0, 1)).where(enough | (F.col("phrase") == "")))
    single = ones.where("phrase <> ''")
    pairs = written(phrase_counts(chunks, (2,), (1, bitmap(single, 1, bits))).where(enough))
    longer = written(phrase_counts(chunks, (3, 4), (2, bitmap(pairs, 2, bits))).where(enough))
    dropped(chunks)
    found = single.union(pairs).union(longer)
    candidates = pairs.union(longer).withColumn("words", F.split("phrase", " "))
    # each cut with how often its parts occur, which is at least a
    cuts = candidates.select("lang", "phrase", "f", F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.struct(k.alias("k"), part(1, k).alias("left"), part(k + 1, F.size("words") - k).alias("right")))).alias("cut")).select("lang", "phrase", "f", "cut.*")
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("cast(cast(2000000 as decimal(18,0)) * cast(f as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as long)")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.max("f").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # parts of longer candidates, with the most frequent of these
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: part(i, n))))
    inside = longer.withColumn("words", F.split("phrase", " ")).select("lang", F.explode(spans).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("within"))
    own = scored.join(inside, ["lang", "phrase"], "left").where(F.col("within").isNull() | (F.col("within").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * 80))
    own = own.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    own = own.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    own = own.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= first).drop("part")
    own = own.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    totals = ones.where("phrase = ''").select("lang", F.col("f").alias("n"))
    return own.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
