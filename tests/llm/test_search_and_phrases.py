"""BPE by prefixes, lexical search and phrases, against the library and plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelforge.llm import collocations as c
from panelforge.llm import lexical_search as s

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def mixed_texts():
    rng = random.Random(11)
    texts = [None, "", "  \n", "a", "a" * 3000, "ab" * 500, "<|endoftext|>hi<|startoftext|>", "日本語 İstanbul ﬁ é", "</w> x</w>y", "don't we'll I'M 12a3", "ß ſ K\x00\x01", "!!! ..", "dup", "dup"]
    texts += ["".join(rng.choice("abcdefgh iethnors'!.é日 1<>/w") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    texts += ["".join(rng.choice("ethino") for _ in range(rng.randint(1, 90))) for _ in range(200)]
    return texts


def test_prefix_tokens_are_the_librarys(spark):
    from tokenizers import Tokenizer

    from panelforge.llm.prefix_tokens import decoded, encoded, token_ids

    library, texts = Tokenizer.from_file(path()), mixed_texts()
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "no id", "x", "y")], "doc_id long, text string, ids string, n_tokens string")
    ids = token_ids(docs, path())
    back = {r.doc_id: r.text for r in decoded(ids, path()).collect()}
    digests = {r.doc_id: r for r in encoded(docs, path()).collect()}
    found = {r.doc_id: r.ids for r in ids.collect()}
    assert len(found) == len(texts) + 1
    for i, t in [*enumerate(texts), (None, "no id")]:
        want = library.encode(t or "", add_special_tokens=False).ids
        shown = library.decode(want, skip_special_tokens=False)
        assert found[i] == want and back[i] == shown, t
        assert digests[i].n_tokens == len(want)
        assert digests[i].ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(shown.encode()).hexdigest()
    assert encoded(docs.limit(0), path()).isEmpty() and decoded(ids.limit(0), path()).isEmpty()
    assert decoded(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), path()).first().text == ""


def test_long_words_take_time_by_their_length():
    import time

    from panelforge.llm.prefix_tokens import opened

    own, rng = opened(path())[0], random.Random(3)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(400_000))
    began = time.process_time()
    ids = own.encode([word])[0]
    assert time.process_time() - began < 30
    assert list(ids) == own.library.encode(word, add_special_tokens=False).ids


def ranked_plainly(docs, items, k):
    tfs = [(d, Counter(TERM.findall(t.translate(ASCII_LOWER)))) for d, t in docs if t and TERM.search(t)]
    n, total, df = len(tfs), sum(sum(x.values()) for _, x in tfs), Counter(t for _, x in tfs for t in x)
    found = []
    for item, text in items.items():
        rows = []
        for d, tf in tfs:
            m = 10 + 90 * sum(tf.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in set(TERM.findall(text.translate(ASCII_LOWER))) if t in tf)
            if score > 0:
                rows.append((-score, d is None, d))
        found += [(item, i + 1, d, -x) for i, (x, _, d) in enumerate(sorted(rows)[:k])]
    return found


def searchable(rng, n, like):
    docs = [(i, " ".join(rng.choice(like) for _ in range(rng.randint(0, 50)))) for i in range(n)]
    docs += [(n + i, docs[5][1].upper()) for i in range(30)]  # many of one score
    docs += [(7, "w1 w2 w3"), (7, "w1 w2 w3"), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (n + 40, None), (n + 41, ""), (n + 42, " .,\x7f\n"), (n + 43, "É_é w1-w1 Ǆ" * 20), (n + 44, " ".join(f"w{i % 300}" for i in range(30_000)))]
    return docs


@pytest.mark.parametrize(("documents", "postings"), [(s.DOCUMENTS, s.POSTINGS), (64, 700)])
def test_search_is_exact(spark, documents, postings):
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.4)) % 300}" for _ in range(3000)]
    docs = searchable(rng, 600, words)
    items = {i: " ".join(rng.choice(words) for _ in range(rng.randint(1, 25))) for i in range(30)} | {50: "W1 w1 É_É", 51: docs[5][1]}
    rows = [*items.items(), (60, None), (61, ""), (62, "nowhere")]
    got = s.ranked_search(
        spark.createDataFrame([(d, t, "a", 1) for d, t in docs], "doc_id long, text string, item_id string, n int").repartition(3),
        spark.createDataFrame([(i, t, "z") for i, t in rows], "item_id int, text string, doc_id string"),
        documents=documents,
        postings=postings,
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == ranked_plainly(docs, items, 10)


def test_items_in_blocks_and_empty_tables(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(40)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(12))) for i in range(50)]
    items = {i: " ".join(rng.choice(words) for _ in range(5)) for i in range(20)}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame([*items.items(), (3, items[4])], "item_id int, text string")
    items[3] = f"{items[3]} {items[4]}"  # rows of one id are one item
    assert sorted(map(tuple, s.ranked_search(frame, asked, 3, pairs_at_once=20).collect())) == ranked_plainly(docs, items, 3)
    assert s.ranked_search(frame.limit(0), asked).isEmpty() and s.ranked_search(frame, asked.limit(0)).isEmpty()


def test_bounds_hold_for_every_document_of_a_block():
    rng = np.random.default_rng(2)
    count = rng.integers(0, 12, 500)
    term = np.concatenate([np.sort(rng.choice(60, k, replace=False)) for k in count]).astype(np.int64)
    value = rng.integers(1, 1000, len(term))
    items = [rng.choice(60, 6, replace=False) for _ in range(10)]
    asked = {}
    for x in items:
        for t in x:
            asked[int(t)] = np.union1d(asked.get(int(t), np.empty(0, np.int64)), x)
    index = s.Index(np.cumsum(count) - count, count, term, value, asked, 60)
    rows = [dict(zip(term[a : a + n].tolist(), value[a : a + n].tolist(), strict=True)) for a, n in zip(np.cumsum(count) - count, count, strict=True)]
    for x in items:
        for t in x.tolist():
            docs, sizes, summary, most, widths = index.blocks(t)
            assert sorted(docs.tolist()) == [d for d, r in enumerate(rows) if t in r]
            ends, wends = np.cumsum(sizes), np.cumsum(widths)
            for b in range(len(sizes)):
                kept = dict(zip(summary[wends[b] - widths[b] : wends[b]].tolist(), most[wends[b] - widths[b] : wends[b]].tolist(), strict=True))
                for d in docs[ends[b] - sizes[b] : ends[b]]:
                    assert sum(rows[d].get(u, 0) for u in x) <= sum(kept.get(u, 0) for u in x)


PIECE, WORD = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^\x20\x09]+")


def phrases_plainly(docs, least, first):
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in PIECE.split((text or "").translate(ASCII_LOWER)):
            w = WORD.findall(piece)
            totals[lang] += len(w)
            counts.update((lang, *w[i : i + n]) for n in range(1, 5) for i in range(len(w) - n + 1))
    candidates = {p: f for p, f in counts.items() if len(p) > 2 and f >= least}
    within = defaultdict(int)
    for (lang, *w), f in candidates.items():
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                within[lang, *w[i : i + n]] = max(within[lang, *w[i : i + n]], f)
    by_lang = defaultdict(list)
    for p, a in candidates.items():
        if 100 * within[p] >= 80 * a:
            continue
        lang, *w = p
        score, k = min((2_000_000 * a // (counts[lang, *w[:k]] + counts[lang, *w[k:]]), k) for k in range(1, len(w)))
        by_lang[lang].append((-score, -a, " ".join(w).encode(), counts[lang, *w[:k]], counts[lang, *w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, totals[lang], -x) for lang, rows in by_lang.items() for i, (x, a, p, left, right) in enumerate(sorted(rows)[:first]))


def texts_with_phrases(rng):
    words = [f"V{k}é" if k % 5 == 0 else f"v{k}" for k in range(30)]
    passages = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(4)]
    joint = [" ", "  ", "\t", ", ", ".", "\n", " ! ", "\x0b", "\x00"]
    docs = []
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choices(joint, [60, 5, 5, 5, 5, 5, 5, 2, 1])[0] for _ in range(rng.randint(0, 80)))
        docs.append((("en", "fr", None, "")[i % 4], text + (rng.choice(passages) if i % 3 == 0 else "")))
    return docs + [("en", None), ("en", ""), ("en", " .\n"), ("de", "one two"), ("en", "go go " * 3000), ("en", docs[0][1]), ("en", docs[0][1]), ("und", "v1 v2 v3 v4")]


@pytest.mark.parametrize(("trigger", "bits"), [(c.TRIGGER, c.BITS), (2, 64), (1, c.BITS)])
def test_phrases_equal_plain_counts(spark, trigger, bits):
    # a map of 64 bits is full: nothing is pruned, and nothing changes
    docs = texts_with_phrases(random.Random(8))
    frame = spark.createDataFrame([(x, t, 1, "p") for x, t in docs], "lang string, text string, freq int, phrase string").repartition(3)
    got = c.collocations(frame, 6, 40, trigger, bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases_plainly(docs, 6, 40)


def test_chunks_cover_each_text_and_share_three_words():
    docs = [t for _, t in texts_with_phrases(random.Random(9)) if t]
    raw = [t.encode() for t in docs]
    edges = np.cumsum([0] + [len(x) for x in raw])
    chunks, row = c.chunks_of(np.frombuffer(b"".join(raw), np.uint8), edges)
    for i, t in enumerate(docs):
        own = [x for x, r in zip(chunks.to_pylist(), row, strict=True) if r == i]
        words = [w for p in PIECE.split(t.translate(ASCII_LOWER)) for w in WORD.findall(p)]
        assert [w for x in own for w in (x.split() if x.endswith("\n") else x.split()[:-3])] == [w for p in words for w in p.split()]
        assert all(x.endswith("\n") == (k == len(own) - 1) for k, x in enumerate(own))


def test_no_phrases_in_an_empty_table(spark):
    assert c.collocations(spark.createDataFrame([], "lang string, text string")).isEmpty()
