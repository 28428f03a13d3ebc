"""Ids of a public word tokenizer, with each distinct word encoded once in a worker.

The tokenizer's file splits a normalised text into words, and encodes each word by itself; so a word's ids can be kept. Most
texts are split on flat bytes in numpy, and their words looked up by a 64-bit hash. Texts with characters whose normal form,
lower case or class two libraries might see differently, and those with the file's special marks, are encoded whole by the library.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex

from .textbytes import word_hashes

#: Characters that are split on bytes: ASCII but for controls, and Latin letters for which normal form C changes nothing and
#: lower case goes one to one.
PLAIN = regex.compile("[\t-\r\x20-\x7eÀ-ÖØ-öø-įı-ňŊ-ž]*+")
#: Words that are kept at most; then the memory starts anew.
KEPT = 1_000_000
#: Words that the library encodes in one call.
TOGETHER = 2_000

SPACE, LETTER, DIGIT, OTHER = range(4)


def class_table() -> np.ndarray:
    t = np.full(256, OTHER, np.uint8)
    t[[0x20, *range(0x09, 0x0E)]] = SPACE
    t[ord("0") : ord("9") + 1] = DIGIT
    t[ord("A") : ord("Z") + 1] = t[ord("a") : ord("z") + 1] = t[0x80:] = LETTER
    return t


CLASS = class_table()


def split_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of plain lower-case bytes: runs of letters, single digits, runs of others; an apostrophe that
    begins a word takes a following s, t, m, d, re, ve or ll with it."""
    kind = CLASS[data]
    before = np.concatenate(([SPACE], kind[:-1])).astype(np.uint8)
    start = (kind != SPACE) & ((kind != before) | (kind == DIGIT))
    mark = np.flatnonzero((data == ord("'")) & (before != OTHER))
    if len(mark):
        after = np.concatenate((data, np.zeros(3, np.uint8)))
        a, b = after[mark + 1], after[mark + 2]
        two = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        three = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l")))
        length = np.where(two, 2, np.where(three, 3, 0))
        mark, length = mark[length > 0], length[length > 0]
        start[mark + 1] = False
        onward = (mark + length)[mark + length < len(data)]
        start[onward] |= kind[onward] == LETTER
    starts = np.flatnonzero(start)
    gap = np.flatnonzero((kind == SPACE) & (before != SPACE))
    ends = np.append(starts[1:], len(data))
    at = np.searchsorted(gap, starts)
    return starts, np.minimum(ends, np.append(gap, len(data))[at])


class WordTokenizer:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        #: What the library turns into one id wherever it occurs in a text.
        self.marks = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        #: Hashes of known words in order, the place of each in the lists of first ids and counts, and all ids.
        self.hashes, self.place = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.first, self.count, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def library_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each). Words are encoded together, apart by spaces, and told apart by the ids that end a word."""
        found = np.array(self.library.encode(" ".join(words), add_special_tokens=False).ids, np.uint32)
        ends = np.flatnonzero(self.closes[found])
        if len(ends) != len(words):
            each = [self.library.encode(w, add_special_tokens=False).ids for w in words]
            return np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each])
        return found, np.diff(ends, prepend=-1)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        parts = [self.library_ids(words[k : k + TOGETHER]) for k in range(0, len(words), TOGETHER)]
        counts = np.concatenate([c for _, c in parts])
        place = np.arange(len(words)) + len(self.first)
        self.first = np.concatenate((self.first, len(self.ids) + np.cumsum(counts) - counts))
        self.count = np.concatenate((self.count, counts))
        self.ids = np.concatenate((self.ids, *(i for i, _ in parts)))
        by = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[by])
        self.hashes, self.place = np.insert(self.hashes, at, hashes[by]), np.insert(self.place, at, place[by])

    def plain(self, texts: list[bytes]) -> list[bytes]:
        """Ids of plain lower-case texts."""
        if len(self.hashes) > KEPT:
            self.forget()
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        begin = np.cumsum([0] + [len(t) + 1 for t in texts])
        starts, ends = split_bytes(data)
        code, own = pd.factorize(word_hashes(data, starts, ends))
        at = np.searchsorted(self.hashes, own)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == own[known]
        if not known.all():
            fresh = np.flatnonzero(~known)
            seen = np.empty(len(own), np.int64)
            seen[code[::-1]] = np.arange(len(code))[::-1]
            raw = data.tobytes()
            self.learn(own[fresh], [raw[starts[k] : ends[k]].decode() for k in seen[fresh]])
            at = np.searchsorted(self.hashes, own)
        word = self.place[at][code] if len(code) else np.empty(0, np.int64)
        n = self.count[word]
        total = np.cumsum(n)
        ids = self.ids[np.repeat(self.first[word] - (total - n), n) + np.arange(total[-1] if len(n) else 0)].astype("<u4").tobytes()
        edge = np.concatenate(([0], total))[np.searchsorted(starts, begin)] * 4
        return [ids[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]

    def is_plain(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and not any(m in text for m in self.marks)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        plain = [self.is_plain(t) for t in texts]
        quick = iter(self.plain([t.lower().encode() for t, p in zip(texts, plain, strict=True) if p]))
        return [next(quick) if p else np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t, p in zip(texts, plain, strict=True)]


_OPEN: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One for each worker process and file."""
    if path not in _OPEN:
        _OPEN[path] = WordTokenizer(path)
    return _OPEN[path]
