"""BPE encoding by dynamic programming over prefixes, and decoding.

A word is a row of symbols: its bytes, the last of which is a symbol of its own kind (a byte that ends a word). For every prefix
of a word the encoding has one last token, and what comes before that token is the encoding of the shorter prefix. So it suffices
to keep the last token of each prefix: among the tokens that end there (an automaton with suffix links over the vocabulary
gives them, the longest first), it is the one that fits behind the last token of the prefix that it leaves. Following the lengths
back from the end gives the ids. Time and memory go with the length of the word times the tokens that end at one place.

Two tokens fit if merging their symbols together never merges across the border. Along the right edge of the left token, and the
left edge of the right one, each part lives from the merge that made it to the merge that used it up; a merge of two parts that
live at the same time, of lower rank than those that use them up, is one across the border. This needs a vocabulary in which
the parts of a merge are older than what they make and each token has one merge, which is checked when the file is read.

Words come from a text as in word_tokens: on flat bytes, each distinct word once in a worker. Texts with other characters, or with
the file's special marks, are normalised and split by the library's own rules; their words are encoded here as well.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .byte_tokens import Spelling, rows_of_ids
from .textbytes import row_runs, text_bytes
from .word_tokens import KEPT, WordTokenizer

#: Bytes of text that are encoded at once; one longer text stands alone.
AT_ONCE = 1 << 20
#: Pairs of tokens whose fit a worker remembers.
PAIRS = 2_000_000
NEVER = 1 << 40


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 for itself, the others in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class PrefixTokenizer(WordTokenizer):
    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as lines:
            model = json.load(lines)["model"]
        end, ids = model["end_of_word_suffix"], model["vocab"]
        self.letters = byte_letters()
        spelt: dict[str, str] = {}
        for letter, byte in self.letters.items():
            spelt[letter], spelt[letter + end] = chr(byte), chr(256 + byte)
        #: By token: its two parts, and the tokens of the pairs that merge.
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        symbols = {ids[s] for s in spelt}
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            made = ids[a + b]
            if a not in spelt or b not in spelt or made in self.parts or made <= max(ids[a], ids[b]) or made in symbols:
                raise ValueError(f"{path}: a token must have one merge, of parts with smaller ids")
            spelt[a + b] = spelt[a] + spelt[b]
            self.parts[made], self.merged[ids[a], ids[b]] = (ids[a], ids[b]), made
        self.ends = ahocorasick.Automaton()
        for token, s in spelt.items():
            self.ends.add_word(s, (len(s), ids[token]))
        self.ends.make_automaton()
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.fit: dict[tuple[int, int], bool] = {}
        self.found: dict[int, bool] = {}
        self.apart = regex.compile("(" + "|".join(map(regex.escape, self.marks)) + ")") if self.marks else None

    def forget(self) -> None:
        super().forget()
        #: Ids of words of texts that aren't plain.
        self.odd: dict[str, list[int]] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(part, the token that uses it up) along the left (0) or right (1) edge of a token, without the token itself."""
        key = token, side
        if key not in self.edges:
            own, part = [], token
            while part in self.parts:
                own.append((self.parts[part][side], part))
                part = own[-1][0]
            self.edges[key] = own
        return self.edges[key]

    def crosses(self, left: int, right: int, until: int) -> bool:
        """Whether a merge across the border of two tokens comes before the one of rank until. Of equal merges that share a part the left comes first."""
        for a, used_a in [(left, until), *self.edge(left, 1)]:
            for b, used_b in [(right, until), *self.edge(right, 0)]:
                made = self.merged.get((a, b), NEVER)
                if made < used_a and (made < used_b or made == used_b != until):
                    return True
        return False

    def whole(self, token: int) -> bool:
        """Whether a token's own symbols are encoded as that token."""
        if token not in self.parts:
            return True
        if token not in self.found:
            a, b = self.parts[token]
            self.found[token] = self.whole(a) and self.whole(b) and not self.crosses(a, b, token)
        return self.found[token]

    def fits(self, left: int, right: int) -> bool:
        key = left, right
        known = self.fit.get(key)
        if known is None:
            if len(self.fit) > PAIRS:
                self.fit.clear()
            known = self.fit[key] = not self.crosses(left, right, NEVER)
        return known

    def word_ids(self, word: bytes) -> list[int]:
        """The ids of a word."""
        symbols = word[:-1].decode("latin-1") + chr(256 + word[-1])
        last, length = [-1] * len(symbols), [0] * len(symbols)
        for at, (n, token) in self.ends.iter(symbols):
            if last[at] >= 0:
                continue
            if self.whole(token) and (n > at or self.fits(last[at - n], token)):
                last[at], length[at] = token, n
        out, at = [], len(symbols) - 1
        while at >= 0:
            out.append(last[at])
            at -= length[at]
        return out[::-1]

    def library_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.word_ids(w.encode()) for w in words]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def odd_ids(self, text: str) -> list[int]:
        """The ids of any text: special marks are one id each, and what lies between is normalised and split by the library's rules."""
        out: list[int] = []
        for part in self.apart.split(text) if self.apart else [text]:
            if part in self.marks:
                out.append(self.library.token_to_id(part))
                continue
            for word, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part)):
                if word not in self.odd:
                    self.odd[word] = self.word_ids(bytes(self.letters[c] for c in word))
                out += self.odd[word]
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.odd) > KEPT:
            self.forget()
        plain = [self.is_plain(t) for t in texts]
        quick = iter(self.plain([t.lower().encode() for t, p in zip(texts, plain, strict=True) if p]))
        return [np.frombuffer(next(quick), "<u4").astype(np.int32) if p else np.array(self.odd_ids(t), np.int32) for t, p in zip(texts, plain, strict=True)]


_OPEN: dict[str, tuple[PrefixTokenizer, Spelling, Spelling]] = {}


def opened(path: str) -> tuple[PrefixTokenizer, Spelling, Spelling]:
    """(the tokenizer, each id's token and a blank, each id's number and a blank), once for each worker process and file."""
    if path not in _OPEN:
        own = PrefixTokenizer(path)
        tokens = own.library.get_vocab(with_added_tokens=True)
        _OPEN[path] = own, Spelling({i: f"{t} ".encode() for t, i in tokens.items()}), Spelling({i: b"%d " % i for i in tokens.values()})
    return _OPEN[path]


def encoded_runs(batch: pa.RecordBatch, path: str) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """(doc_ids, ids of each) of a batch (doc_id, text), a bounded number of bytes at once."""
    texts = batch.column("text")
    _, offsets = text_bytes(texts)
    for first, last in row_runs(offsets, AT_ONCE):
        yield batch.column("doc_id").slice(first, last - first), opened(path)[0].encode([t or "" for t in texts.slice(first, last - first).to_pylist()])


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) for each row of docs (doc_id, text), repeated rows included; decoded() is the way back.

    A null text counts as an empty one, without ids; a very long text is encoded by itself, and so is a long word, in time that goes with
    its length. Other columns of docs, whatever their names, are ignored. An empty table gives an empty table. The workers read the file.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_ids, found in encoded_runs(b, path):
                ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([doc_ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) for each row of rows (doc_id, ids), repeated rows included: its tokens with blanks between them, as a file without a decoder has it.

    Null or no ids give an empty text; an id that the vocabulary hasn't is an error. Other columns are ignored; an empty table gives an empty table.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelt = opened(path)[1]
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([spelt.joined(ids)[:-1].decode() for ids in rows_of_ids(b.column("ids"))], pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(decode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for each row of docs (doc_id, text): digests of its ids (token_ids, whose cases these are) and of what these ids decode to."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, spelt, numbers = opened(path)
        for b in batches:
            for doc_ids, found in encoded_runs(b, path):
                columns = [
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([sha256(numbers.joined(x)[:-1]).hexdigest() for x in found], pa.string()),
                    pa.array([sha256(spelt.joined(x)[:-1]).hexdigest() for x in found], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([doc_ids, *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(digest, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
