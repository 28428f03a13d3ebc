"""Byte-level BPE with DuckDB inside each task.

A text is split by the tokenizer's pattern into words, each of which is encoded by itself; so a worker encodes each distinct
word once. The words' bytes are rows (word, place, id) of a recursive query: in each step neighbouring rows join the merge
table, the leftmost of a word's pairs of least rank is contracted, and words without a pair leave. Ordered aggregation strings
the ids of a word together. A text's ids are those of its words. Decoding knows ids only: ordered aggregation of rows
(text, place, id) gives each text's ids in order, which the vocabulary turns into bytes.

In a word of many bytes a step contracts every pair of least rank at once, the left one of two that overlap, so that it takes few
steps. Contracting them one by one gives the same unless a contraction makes a pair of still lower rank; in such a step only the
leftmost is contracted. Either query gives the same ids for any word; the first is quicker for short words.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .textbytes import row_runs, text_bytes

#: Bytes of text that are encoded at once; one longer text stands alone.
AT_ONCE = 6 << 20
#: Bytes up to which a word's steps contract one pair.
SHORT = 96
#: Words that a worker remembers at most before it starts anew.
KEPT = 900_000
MEMORY = "500MB"
#: Ids that are spelt or decoded at once; a longer row is decoded in parts.
BLOCK = 1 << 20

ENCODE = """
WITH RECURSIVE state(word, place, id, following, active) AS (
    SELECT word, place, id, lead(id) OVER (PARTITION BY word ORDER BY place), true FROM symbols
    UNION ALL
    (
        WITH paired AS MATERIALIZED (
            SELECT word, place, s.id, following, m.id::BIGINT * 65536 + place AS made
            FROM state s LEFT JOIN merges m ON m.pair = s.id::BIGINT * 65536 + following WHERE active
        ), best AS (
            SELECT word, min(made) AS made FROM paired GROUP BY word
        ), chosen AS (
            SELECT word, (best.made % 65536)::INT AS hit, (best.made // 65536)::INT AS merged, following AS after_both
            FROM best LEFT JOIN (SELECT word, place - 1 AS hit, following FROM paired) USING (word)
            WHERE best.made IS NULL AND hit = -1 OR hit = best.made % 65536
        )
        SELECT word, place - (hit IS NOT NULL AND place > hit)::INT, CASE WHEN place = hit THEN merged ELSE id END,
            CASE place - hit WHEN 0 THEN after_both WHEN -1 THEN merged ELSE following END, hit IS NOT NULL
        FROM paired JOIN chosen USING (word) WHERE hit IS NULL OR place <> hit + 1
    )
)
SELECT word, array_to_string(list(id ORDER BY place), ',') AS ids FROM state WHERE NOT active GROUP BY word
"""

ENCODE_LONG = """
WITH RECURSIVE state(word, place, id, active) AS (
    SELECT word, place, id, true FROM symbols
    UNION ALL
    (
        WITH paired AS (
            SELECT word, place, s.id, before, after_both, m.id AS made, min(m.id) OVER (PARTITION BY word) AS best FROM (
                SELECT word, row_number() OVER w AS place, id, lag(id) OVER w AS before, lead(id) OVER w AS following, lead(id, 2) OVER w AS after_both
                FROM state WHERE active WINDOW w AS (PARTITION BY word ORDER BY place)
            ) s LEFT JOIN merges m ON m.pair = s.id::BIGINT * 65536 + following
        ), counted AS (
            SELECT *, coalesce(made = best, false) AS fits, place - max(CASE WHEN made = best THEN 0 ELSE place END) OVER (PARTITION BY word ORDER BY place) AS nth FROM paired
        ), turned AS (
            SELECT word, place, id, before, after_both, best, fits AND nth % 2 = 1 AS apart, row_number() OVER (PARTITION BY word, fits ORDER BY place) AS turn FROM counted
        ), lower AS (
            SELECT DISTINCT word FROM turned JOIN merges m ON apart AND m.id < best AND m.pair IN (before::BIGINT * 65536 + best, best::BIGINT * 65536 + after_both, best::BIGINT * 65536 + best)
        ), hits AS (
            SELECT word, place, id, best, apart AND (turn = 1 OR word NOT IN (FROM lower)) AS hit FROM turned
        )
        SELECT word, place, CASE WHEN hit THEN best ELSE id END, best IS NOT NULL
        FROM (SELECT *, lag(hit, 1, false) OVER (PARTITION BY word ORDER BY place) AS gone FROM hits) WHERE NOT gone
    )
)
SELECT word, array_to_string(list(id ORDER BY place), ',') AS ids FROM state WHERE NOT active GROUP BY word
"""

#: Bytes are letters of Latin-1 here, one each, since strings are what DuckDB strings together.
DECODE = "SELECT part, array_to_string(list_select(letters, own), '') AS letters FROM (SELECT part, list(id + 1 ORDER BY place) AS own FROM ids GROUP BY part), vocabulary"


def ranks_of(path: str) -> dict[bytes, int]:
    """The id of each token of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class ByteTokenizer:
    def __init__(self, path: str, pattern: str):
        import duckdb

        self.split = regex.compile(pattern)
        self.ranks = ranks_of(path)
        pairs = [(self.ranks[t[:k]], self.ranks[t[k:]], r) for t, r in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        self.of_byte = np.array([self.ranks[bytes([k])] for k in range(256)], np.int32)
        self.base = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY})
        merges = np.array(pairs, np.int32)
        self.tables(merges=pa.table({"pair": merges[:, 0].astype(np.int64) * 65536 + merges[:, 1], "id": merges[:, 2]}))
        self.forget()

    def tables(self, **found: pa.Table) -> None:
        for name, rows in found.items():
            self.base.register("given", rows)
            self.base.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
            self.base.unregister("given")

    def forget(self) -> None:
        #: By word: its ids as text.
        self.ids: dict[str, str] = {}

    def learn(self, words: list[str]) -> None:
        """Encodes new words."""
        data = [w.encode() for w in words]
        for query, own in ((ENCODE, [k for k, d in enumerate(data) if len(d) <= SHORT]), (ENCODE_LONG, [k for k, d in enumerate(data) if len(d) > SHORT])):
            if own:
                self.contract(query, words, data, own)

    def contract(self, query: str, words: list[str], data: list[bytes], own: list[int]) -> None:
        """Runs the query over the bytes of these words."""
        lengths = np.array([len(data[k]) for k in own], np.int64)
        word = np.repeat(np.array(own, np.int32), lengths)
        place = (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        ids = self.of_byte[np.frombuffer(b"".join(data[k] for k in own), np.uint8)]
        self.base.register("symbols", pa.table({"word": word, "place": place, "id": ids}))
        found = self.base.sql(query).to_arrow_table()
        for k, text in zip(*(found.column(c).to_pylist() for c in ("word", "ids")), strict=True):
            self.ids[words[k]] = text
        self.base.unregister("symbols")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return [parsed(x) for x in self.spelt(texts)]

    def spelt(self, texts: list[str]) -> list[str]:
        """The ids of each text, commas between them."""
        if len(self.ids) > KEPT:
            self.forget()
        pieces = [self.split.findall(t) for t in texts]
        fresh = list({w for words in pieces for w in words if w not in self.ids})
        if fresh:
            self.learn(fresh)
        return [",".join(map(self.ids.__getitem__, words)) for words in pieces]


def parsed(ids: str) -> np.ndarray:
    """The numbers of ids with commas between them."""
    return np.fromstring(ids, np.int32, sep=",") if ids else np.empty(0, np.int32)


class Decoder:
    """The bytes of ids, by ordered aggregation of rows and a look into the vocabulary, one list of all tokens."""

    def __init__(self, path: str):
        import duckdb

        token = {r: t for t, r in ranks_of(path).items()}
        self.known = np.zeros(max(token) + 1, bool)
        self.known[list(token)] = True
        self.base = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY})
        self.base.register("given", pa.table({"id": pa.array(range(len(self.known)), pa.int32()), "letters": [token.get(i, b"").decode("latin-1") for i in range(len(self.known))]}))
        self.base.execute("CREATE TABLE vocabulary AS SELECT list(letters ORDER BY id) AS letters FROM given")
        self.base.unregister("given")

    def decode(self, rows: list[np.ndarray]) -> list[bytes]:
        """The bytes of each row of ids, about BLOCK ids at once."""
        lengths = np.array([len(x) for x in rows], np.int64)
        flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
        if len(flat) and (flat.min() < 0 or flat.max() >= len(self.known) or not self.known[flat].all()):
            raise ValueError("an id that isn't in the vocabulary")
        # parts begin with a row and at each BLOCK of it
        starts = np.cumsum(lengths) - lengths
        n_parts = -(-lengths // BLOCK)
        row = np.repeat(np.arange(len(rows)), n_parts)
        start = starts[row] + BLOCK * (np.arange(len(row)) - np.repeat(np.cumsum(n_parts) - n_parts, n_parts))
        edges = np.append(start, len(flat))
        out: list[list[bytes]] = [[] for _ in rows]
        first = 0
        while first < len(row):
            last = max(first + 1, int(np.searchsorted(edges, edges[first] + BLOCK, "right")) - 1)
            size = np.diff(edges[first : last + 1])
            part = np.repeat(np.arange(last - first, dtype=np.int32), size)
            place = (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
            self.base.register("ids", pa.table({"part": part, "place": place, "id": flat[edges[first] : edges[last]]}))
            found = self.base.sql(DECODE).to_arrow_table()
            self.base.unregister("ids")
            by_part = dict(zip(found.column("part").to_pylist(), found.column("letters").to_pylist(), strict=True))
            for k in range(last - first):
                out[row[first + k]].append(by_part[k].encode("latin-1"))
            first = last
        return [b"".join(x) for x in out]


class Spelling:
    """What each id stands for, as bytes that lie one after the other."""

    def __init__(self, of_id: dict[int, bytes]):
        parts = [of_id.get(i, b"") for i in range(max(of_id) + 1)]
        self.known = np.array([i in of_id for i in range(len(parts))])
        self.length = np.array([len(p) for p in parts], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of these ids in order."""
        out = []
        for k in range(0, len(ids), BLOCK):
            own = ids[k : k + BLOCK]
            if own.min() < 0 or own.max() >= len(self.known) or not self.known[own].all():
                raise ValueError("an id that isn't in the vocabulary")
            length = self.length[own]
            out.append(self.data[np.arange(length.sum()) + np.repeat(self.start[own] - (np.cumsum(length) - length), length)].tobytes())
        return b"".join(out)


_OPEN: dict[tuple[str, str], ByteTokenizer] = {}


def tokenizer(path: str, pattern: str) -> ByteTokenizer:
    """One for each worker process."""
    if (path, pattern) not in _OPEN:
        _OPEN[path, pattern] = ByteTokenizer(path, pattern)
    return _OPEN[path, pattern]


_READY: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    """One for each worker process."""
    if path not in _READY:
        _READY[path] = Decoder(path)
    return _READY[path]


def encoded_runs(batch: pa.RecordBatch, own: ByteTokenizer) -> Iterator[tuple[pa.Array, list[str]]]:
    """(doc_ids, ids of each with commas between them) of a batch (doc_id, text), a bounded number of bytes at once."""
    _, offsets = text_bytes(batch.column("text"))
    for first, last in row_runs(offsets, AT_ONCE):
        yield batch.column("doc_id").slice(first, last - first), own.spelt([t or "" for t in batch.column("text").slice(first, last - first).to_pylist()])


def token_ids(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) for each row of docs (doc_id, text), repeated rows included; decoded() is the way back.

    A null text counts as an empty one, without ids. A very long text is encoded by itself. Other columns of docs, whatever their names, are
    ignored. An empty table gives an empty table. The rank file is read by the workers.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(ranks_path, pattern)
        for b in batches:
            for doc_ids, spelt in encoded_runs(b, own):
                found = [parsed(x) for x in spelt]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([doc_ids, ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def rows_of_ids(column: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each row, none for a null."""
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    for there, a, e in zip(column.is_valid().to_pylist(), ends[:-1], ends[1:], strict=True):
        yield flat[a:e] if there else flat[:0]


def decoded(rows: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, bytes) for each row of rows (doc_id, ids), repeated rows included.

    Null ids decode to no bytes; an id that the vocabulary hasn't is an error. A row of very many ids is decoded in parts. Other columns of rows, whatever their
    names, are ignored. An empty table gives an empty table.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(ranks_path)
        for b in batches:
            found = own.decode([x.astype(np.int32) for x in rows_of_ids(b.column("ids"))])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "bytes"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, bytes binary")


def encoded(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row of docs (doc_id, text): digests of its ids, as token_ids gives them (its cases are those), and of what these ids decode to."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, back = tokenizer(ranks_path, pattern), decoder(ranks_path)
        for b in batches:
            for doc_ids, spelt in encoded_runs(b, own):
                found = [parsed(x) for x in spelt]
                columns = [
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([sha256(x.encode()).hexdigest() for x in spelt], pa.string()),
                    pa.array([sha256(x).hexdigest() for x in back.decode(found)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([doc_ids, *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(digest, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
