"""The operators of the llm subpackage on small tables, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

SPACE = re.compile("[^\x20\x09-\x0d]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_texts():
    rng = random.Random(4)
    base = prose(rng, 60)
    words = base.split()
    near = words[:]
    near[30] = "changed"
    return [
        None,
        "",
        "   \n\t ",
        "one",
        "one two three",
        "One TWO three",
        base,
        base.upper(),
        " ".join(near),
        base,
        "word " * 30,
        "a\nb\na\nb\n\n",
        "É" * 5 + " ü ñ " + prose(rng, 25),
        "###" + " ### ".join(words[:25]),
        "SHOUTING WORDS!! " * 20,
        "x" * 300,
        "日本語 テキスト と 😀 emoji " * 6,
        "it's don't we'll\x00 they've 'tis 12345 6a7",
        prose(rng, 4000, 100000),
        "z" * 3000 + " " + prose(rng, 30),
        "hello <|endoftext|> world <|startoftext|>a<|ENDOFTEXT|>",
    ]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s" if i % 3 else None, 0) for i, t in enumerate(odd_texts())] + [(6, odd_texts()[6], None, "s", None), (None, odd_texts()[6], "en", "s", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """Columns named like those that operators add."""
    return df.withColumns({c: F.lit("mine") for c in ("score", "n_words", "kept", "component_id", "words", "node", "key", "shard", "measures", "row", "predicted")})


# Quality rules


def measures(text):
    text = text or ""
    words = SPACE.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(odd, empty):
    from panelforge.llm.quality_rules import quality_rules

    found = quality_rules(clashing(odd)).collect()
    assert len(found) == odd.count()
    for r in found:
        n, chars, symbols, lines, repeats = measures(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert r.kept == (r.rejected_by is None) and (r.kept is False or not r.base_failed)
    by_text = {r.text: r for r in found}
    assert by_text[odd_texts()[13]].rejected_by == "symbols" and by_text[odd_texts()[6]].kept
    assert quality_rules(empty).count() == 0


def test_rule_order_never_changes_the_verdict(spark, odd, empty):
    from panelforge.llm import quality_rules as q

    rules = (*q.BASE, *q.RULES)
    verdicts = [sorted((str(r.doc_id), str(r.text), r.by is None) for r in odd.withColumn("by", q.rejected_by(order)).collect()) for order in (rules, rules[::-1])]
    assert verdicts[0] == verdicts[1]
    measured = {(r.doc_id, r.text): r.kept for r in q.quality_rules(odd).collect()}
    lazy = q.quality_rules(clashing(odd), measures=False).collect()
    assert len(lazy) == odd.count() and all(measured[r.doc_id, r.text] == r.kept for r in lazy)
    assert q.quality_rules(empty, measures=False).count() == 0


def test_rules_are_ordered_by_what_they_still_reject():
    from panelforge.llm.quality_rules import ordered

    patterns = [(frozenset("ab"), 30), (frozenset("b"), 10), (frozenset("c"), 20), (frozenset(), 40)]
    # b rejects 40 of 100 for 1; of what it leaves a rejects nothing any more, and c a third
    assert [(name, round(share, 3)) for name, share in ordered({"a": 1.0, "b": 1.1, "c": 9.0}, patterns)] == [("b", 0.4), ("c", 0.333), ("a", 0.0)]
    assert [name for name, _ in ordered({"a": 1.0, "b": 8.0, "c": 1.0}, patterns)] == ["a", "c", "b"]


def test_a_rejected_text_costs_no_later_rule(spark):
    from panelforge.llm import quality_rules as q

    broken = q.Rule("broken", lambda t, w: F.raise_error("evaluated").isNull())
    docs = spark.createDataFrame([("one two",)] * 3, "text string")
    assert [r.by for r in docs.select(q.rejected_by([q.BASE[0], broken]).alias("by")).collect()] == ["few_words"] * 3


def test_rule_order_is_the_same_again(spark):
    from panelforge.llm import quality_rules as q

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    orders = [[m.rule.name for m in q.rule_order(docs)] for _ in range(3)]
    assert len({tuple(o) for o in orders[1:]}) == 1 and orders[1].index("repeats") > orders[1].index("symbols")


def test_repeats_by_brute_force(spark):
    from panelforge.llm.quality_rules import base_measures

    rng = random.Random(8)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (7, 8, 9, 20, 40, 80) for _ in range(5)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert [r.n_repeat_words for r in base_measures(df).orderBy("doc_id").collect()] == [measures(t)[4] for t in texts]


# Classifiers


def labelled(spark, bad, n=400):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        clean = prose(rng, rng.randrange(30, 200))
        wrong = i % 4 == 0
        rows.append((i, bad(rng, clean) if wrong else clean))
        labels.append((i, int(not wrong), int(wrong)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(scored, labels, column):
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 30
    return np.mean([r.predicted == r[column] for r in rows])


def test_quality_model_on_held_out_rows(spark, odd, empty):
    from panelforge.llm.quality_model import fit_quality, quality_scores

    docs, labels = labelled(spark, lambda rng, t: " ".join(w + "$$$" if rng.random() < 0.5 else w.upper() for w in t.split()))
    model = fit_quality(docs, labels)
    scored = quality_scores(docs, model)
    assert accuracy(scored, labels, "quality") > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored.collect())
    wild = quality_scores(clashing(odd), model).collect()
    assert len(wild) == odd.count() and all(0 <= r.score <= 1 for r in wild)
    assert len({r.score for r in wild if r.doc_id in (0, 1)}) == 1
    assert quality_scores(empty, model).count() == 0
    assert quality_scores(docs, fit_quality(docs, labels.limit(0))).select("score").distinct().collect()[0].score == 0.5
    assert quality_scores(docs, fit_quality(docs, labels.where("quality = 1"))).select("score").distinct().collect()[0].score == 1.0


def test_quality_model_tells_shuffled_words_from_prose(spark):
    from panelforge.llm.quality_model import fit_quality, quality_scores

    rng, follows = random.Random(17), {}
    for k in range(300):
        follows[f"w{k}"] = [f"w{rng.randrange(300)}" for _ in range(3)]

    def chain(n):
        words = [f"w{rng.randrange(300)}"]
        while len(words) < n:
            words.append(rng.choice(follows[words[-1]]))
        return words

    rows, labels = [], []
    for i in range(500):
        words = chain(rng.randrange(60, 120))
        if i % 2:
            rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1 - i % 2, 0))
    model = fit_quality(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    pairs = []
    for k in range(60):
        words = chain(90)
        pairs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(rng.sample(words, len(words))))]
    score = {r.doc_id: r.score for r in quality_scores(spark.createDataFrame(pairs, "doc_id long, text string"), model).collect()}
    assert sum(score[2 * k] > score[2 * k + 1] for k in range(60)) >= 57


def test_quality_scores_by_brute_force(spark):
    """Passages, attention and pooling in plain Python."""
    from panelforge.llm import quality_model as q
    from panelforge.llm.textbytes import word_hashes

    docs, labels = labelled(spark, lambda rng, t: t.upper(), 120)
    model = q.fit_quality(docs, labels)
    texts = [prose(random.Random(5), 500), "Short, plain text.", "", "ÀB 12 b b\n\nc"]
    w = model.weights
    for r in q.quality_scores(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect():
        data = texts[r.doc_id].encode()
        parts = max(1, -(-len(data) // q.BLOCK))
        size = max(1, -(-len(data) // parts))
        encoded = []
        for at in range(0, max(1, len(data)), size):
            piece = data[at : at + size]
            raw = np.frombuffer(piece, np.uint8)
            x = q.describe(raw, np.zeros(len(raw), int), 1)[0][0]
            words = re.findall(rb"[^\t\n\x0b\x0c\r ]+", piece)
            hashes = [int(word_hashes(np.frombuffer(v, np.uint8), np.array([0]), np.array([len(v)]))[0]) for v in words]
            rows = [model.table[h >> 50] for h in hashes]
            for a, b in zip(hashes, hashes[1:], strict=False):
                total = np.array([a], np.uint64) + np.array([b], np.uint64) * q.MULTIPLIER
                rows.append(model.table[(int(q.mixed(total * q.MULTIPLIER)[0]) >> 49) + (1 << 14)])
            embedded = np.mean(rows, 0) if rows else np.zeros(q.EMBEDDED)
            x = np.concatenate((np.clip((x - model.mean) / model.deviation, -6, 6), embedded))
            encoded.append(np.tanh(x @ w["encode"] + w["encode0"]))
        a = [float(np.tanh(h @ w["v"]) * q.sigmoid(h @ w["u"]) @ w["w"]) for h in encoded]
        a = np.exp(np.array(a) - max(a))
        z = sum(k * h for k, h in zip(a / a.sum(), encoded, strict=True))
        assert r.score == pytest.approx(float(q.sigmoid(z @ w["out"] + w["out0"][0])), abs=1e-4)


def test_passages_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    import pyarrow as pa

    from panelforge.llm import quality_model as q

    texts = pa.array([prose(random.Random(1), 900), "", None, "b c" * 700])
    together = lambda k: np.concatenate([found[k] for found in q.passages(texts)])
    whole = [together(k) for k in (3, 4, 5)]
    monkeypatch.setattr(q, "AT_ONCE", 2048)
    for k, x in zip((3, 4, 5), whole, strict=True):
        assert np.allclose(x, together(k))


def test_attention_gradient_by_differences():
    from panelforge.llm.quality_model import AttentionBag

    rng = np.random.default_rng(0)
    x, n, y = rng.normal(size=(9, 5)), np.array([2, 3, 4]), np.array([1.0, 0.0, 1.0])
    w = {"encode": rng.normal(size=(5, 4)), "encode0": rng.normal(size=4), "v": rng.normal(size=(4, 3)), "u": rng.normal(size=(4, 3)), "w": rng.normal(size=3), "out": rng.normal(size=4), "out0": rng.normal(size=1)}

    def loss():
        p = AttentionBag.forward(w, x, n)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grads, dx = AttentionBag.gradient(w, x, n, y)
    w["x"], grads["x"] = x, dx
    for name, g in grads.items():
        at = tuple(0 for _ in w[name].shape)
        w[name][at] += 1e-5
        up = loss()
        w[name][at] -= 2e-5
        down = loss()
        w[name][at] += 1e-5
        assert g[at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6)


def scored_for_toxicity(docs, labels, given=None):
    from panelforge.llm.toxicity import calibrated, fit_toxicity, toxicity_logits, toxicity_scores

    model = fit_toxicity(docs, labels)
    return toxicity_scores(toxicity_logits(docs if given is None else given, model), calibrated(model, toxicity_logits(docs, model), labels))


def test_toxicity_on_held_out_rows(spark, odd, empty):
    docs, labels = labelled(spark, lambda rng, t: t + " " + " ".join(rng.choice(["vilestem", "vilework", "viler", "grimble", "grimbly"]) for _ in range(3)) + " " + prose(rng, 5))
    assert accuracy(scored_for_toxicity(docs, labels), labels, "toxic") > 0.95
    wild = scored_for_toxicity(docs, labels, clashing(odd)).collect()
    assert len(wild) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in wild)
    assert scored_for_toxicity(docs, labels, empty).count() == 0
    assert scored_for_toxicity(docs, labels.limit(0)).select("score").distinct().collect()[0].score == 0.5
    assert scored_for_toxicity(docs, labels.where("toxic = 0")).select("predicted").distinct().collect()[0].predicted == 0


def test_toxicity_scores_by_brute_force(spark):
    """Filters word by word in plain Python."""
    from panelforge.llm import toxicity as t

    docs, labels = labelled(spark, lambda rng, text: text + " vilestem vilework", 200)
    model = t.fit_toxicity(docs, labels)
    texts = ["w1 w2 vilestem, vilework w3", "", "W1", "der die und w5 w6 w7 viles", "the of w1 w9"]
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model.thresholds[:] = [0.5, -0.5, 0.25, 0.0, 1.0]
    for r in t.toxicity_scores(t.toxicity_logits(given, model), model).collect():
        words = re.findall("[0-9a-z]+", texts[r.doc_id].lower())
        x = []
        for w in words:
            forms = [t.hashed(w), t.hashed(w[:4]), t.hashed(w[:6])]
            starts = np.cumsum((0, *(1 << b for b in t.BITS)))
            x.append(sum(model.embedding[int(h >> np.uint64(64 - b)) + s] for h, b, s in zip(forms, t.BITS, starts, strict=False)))
        top = [max([0.0] + [float(sum(x[i + k] @ f[k][:, c] for k in range(w))) for i in range(len(x) - w + 1)]) for w, f in model.filters.items() for c in range(t.FILTERS)]
        heard = [sum(w in own.split() for w in words) for own in t.FUNCTION_WORDS.values()]
        language = heard.index(max(heard)) if max(heard) else 4
        z = float(np.dot(top, model.out)) + model.out0 - model.thresholds[language]
        assert r.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-4)


def test_toxicity_gradient_by_differences():
    from panelforge.llm import toxicity as t

    rng = np.random.default_rng(0)
    params = [rng.normal(size=(t.BUCKETS, t.SIZE)), *(rng.normal(size=(w, t.SIZE, t.FILTERS)) for w in t.WIDTHS), rng.normal(size=t.FILTERS * 3), np.array([0.3])]
    texts = [rng.integers(0, t.BUCKETS, (n, 3)).astype(np.int32) for n in (6, 1, 0, 4)]
    y, weight = np.array([1.0, 0.0, 1.0, 0.0]), np.array([2.0, 1.0, 1.0, 1.0])

    def loss():
        top = []
        for words in texts:
            x = params[0][words].sum(1)
            top.append([max([0.0] + [sum(x[i + k] @ f[k][:, c] for k in range(w)) for i in range(len(x) - w + 1)]) for w, f in zip(t.WIDTHS, params[1:4], strict=True) for c in range(t.FILTERS)])
        p = 1 / (1 + np.exp(-(np.array(top) @ params[4] + params[5][0])))
        return float((-(y * np.log(p) + (1 - y) * np.log(1 - p)) * weight).sum() / weight.sum())

    touched, *grads = t.Convolution.gradient(params, texts, y, weight)
    for k, g in enumerate(grads):
        for at in [np.unravel_index(i, g.shape) for i in np.argsort(-np.abs(g).ravel())[:3]]:
            real = (touched[at[0]], *at[1:]) if k == 0 else at
            params[k][real] += 1e-5
            up = loss()
            params[k][real] -= 2e-5
            down = loss()
            params[k][real] += 1e-5
            assert g[at] == pytest.approx((up - down) / 2e-5, rel=2e-2, abs=1e-4), (k, at)


def test_threshold_lies_between_the_classes():
    from panelforge.llm import toxicity as t

    counts = np.zeros((2 * t.FARTHEST * t.STEPS, 2))
    at = lambda z: int((z + t.FARTHEST) * t.STEPS)
    counts[at(-3.0), 0], counts[at(-1.0), 0], counts[at(2.0), 1], counts[at(3.0), 1] = 50, 10, 5, 5
    assert t.best_threshold(counts) == pytest.approx(0.5, abs=0.1)
    counts[at(2.5), 0] = 1
    assert t.best_threshold(counts) == pytest.approx(0.5, abs=0.1)


def test_long_texts_are_looked_up_in_pieces(monkeypatch):
    import pyarrow as pa

    from panelforge.llm import toxicity as t

    rng = np.random.default_rng(5)
    model = t.Convolution(rng.normal(size=(t.BUCKETS, t.SIZE)).astype(np.float32), {w: rng.normal(size=(w, t.SIZE, t.FILTERS)).astype(np.float32) for w in t.WIDTHS}, rng.normal(size=t.FILTERS * 3).astype(np.float32), 0.1)
    model.tables()
    texts = pa.array([prose(random.Random(3), 500), None, "", "one two"])
    whole = model.logits(texts)[0]
    monkeypatch.setattr(t, "AT_ONCE", 200)
    assert np.allclose(whole, model.logits(texts)[0], atol=1e-4)


# Near-duplicates


def shingle_set(text):
    words = SPACE.findall((text or "").translate(ASCII_LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def components_by_brute_force(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= 85 * (len(sets[a]) + len(sets[b]) - k):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates_equal_brute_force(spark):
    from panelforge.llm import near_duplicates as nd

    rng, texts = random.Random(11), []
    for _ in range(12):
        base = prose(rng, rng.randrange(3, 160), 5000).split()
        for _ in range(rng.randrange(1, 14)):
            own = base[:]
            for _ in range(rng.randrange(0, max(1, len(own) // 12))):
                own[rng.randrange(len(own))] = f"e{rng.randrange(30)}"
            texts.append(" ".join(own))
    shared = prose(rng, 55, 5000)
    texts += [f"{prose(rng, 40, 9000)} {shared} {prose(rng, 20, 9000)}" for _ in range(20)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = components_by_brute_force(rows)
    for rare in (16, 3):
        nd.RARE, kept = rare, nd.RARE
        try:
            found = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        finally:
            nd.RARE = kept
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_odd_rows(odd, empty):
    from panelforge.llm.near_duplicates import near_duplicates

    found = near_duplicates(clashing(odd)).collect()
    assert len(found) == odd.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(by_id[6]) == 2 and {r.component_id for r in by_id[6]} == {6}
    assert {r.component_id for r in by_id[9] + by_id[7] + by_id[8]} <= {6, 8}
    assert by_id[5][0].component_id == 4
    for i in (0, 1, 2):
        assert by_id[i][0].n_shingles == 0 and by_id[i][0].kept
    assert by_id[None][0].component_id == 6 and not by_id[None][0].kept
    assert near_duplicates(empty).count() == 0


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    from panelforge.llm.near_duplicates import near_duplicates

    rng = random.Random(21)
    a, b, c = (prose(rng, 50, 5000) for _ in range(3))
    rows = [(5, a), (7, a), (7, b), (9, b), (9, b), (None, b), (None, c), (3, None), (3, c + " one more")]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(5, 5, True), (7, 5, False), (7, 7, True), (9, 7, False), (9, 7, False), (None, 7, False), (None, None, False), (3, 3, True), (3, 3, True)]
    assert Counter((r.doc_id, r.component_id, r.kept) for r in found) == Counter(want)


def test_a_large_group_below_the_limit_loses_no_link(spark):
    from panelforge.llm import near_duplicates as nd

    rng, base = random.Random(31), prose(random.Random(30), 90, 5000).split()
    texts = []
    for i in range(160):
        own = base[:]
        for k in rng.sample(range(90), rng.randrange(1, 4)):
            own[k] = f"x{rng.randrange(6)}" if i % 2 else f"y{i}"
        texts.append(" ".join(own))
    rows = list(enumerate(texts))
    found = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == components_by_brute_force(rows)


def test_words_in_pieces(monkeypatch):
    from panelforge.llm import near_duplicates as nd
    from panelforge.llm.textbytes import text_bytes
    import pyarrow as pa

    text = prose(random.Random(2), 700) + " " + "q" * 900 + "\x00 end"
    data, offsets = text_bytes(pa.array([text]))
    whole = nd.words_in(data, offsets)[1]
    monkeypatch.setattr(nd, "AT_ONCE", 64)
    assert (whole == nd.words_in(data, offsets)[1]).all() and len(whole) == len(SPACE.findall(text))


# Tokens and packing


@pytest.fixture(scope="module")
def files():
    import public_tokenizers

    return public_tokenizers


def test_byte_tokens_equal_the_library(odd, empty, files):
    import tiktoken

    from panelforge.llm.byte_tokens import encoded, tokenizer

    path = files.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=files.PATTERN, mergeable_ranks=tokenizer(path, files.PATTERN).ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    found = encoded(clashing(odd), path, files.PATTERN).collect()
    assert len(found) == odd.count()
    for r in found:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert encoded(empty, path, files.PATTERN).count() == 0


def test_byte_tokens_there_and_back(spark, odd, empty, files):
    import tiktoken

    from panelforge.llm.byte_tokens import decoded, ranks_of, token_ids

    path = files.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=files.PATTERN, mergeable_ranks=ranks_of(path), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    found = token_ids(clashing(odd), path, files.PATTERN)
    assert found.count() == odd.count() and all(r.ids == library.encode_ordinary(texts[r.doc_id]) for r in found.collect())
    given = spark.createDataFrame([(i, library.encode_ordinary(t)[::-1]) for i, t in texts.items()] + [(99, None), (99, [])], "doc_id long, ids array<int>")
    back = {r.doc_id: bytes(r.bytes) for r in decoded(given, path).collect()}
    assert back == {i: library.decode_bytes(library.encode_ordinary(t)[::-1]) for i, t in texts.items()} | {99: b""}
    assert decoded(token_ids(empty, path, files.PATTERN), path).count() == 0


def test_both_queries_equal_the_library_on_any_word(files):
    import tiktoken

    from panelforge.llm import byte_tokens as b

    path, rng = files.path("byte_bpe_multi_50k.tiktoken"), random.Random(6)
    own = b.ByteTokenizer(path, files.PATTERN)
    library = tiktoken.Encoding("own", pat_str=files.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    words = ["".join(rng.choice("abcdeghinorst") for _ in range(rng.randrange(1, 60))) for _ in range(200)] + ["aaaaaaa", "ababab", "日本語", "ab" * 90, "a" * 400, "the" * 60, "日本語のテキスト" * 30]
    words += ["".join(rng.choice(["in", "g", "er", "ab", "cd", "ion", "s", "t"]) for _ in range(rng.randrange(40, 300))) for _ in range(40)]
    want = {w: ",".join(map(str, library.encode_ordinary(w))) for w in words}
    for query in (b.ENCODE, b.ENCODE_LONG):
        own.forget()
        own.contract(query, words, [w.encode() for w in words], list(range(len(words))))
        assert own.ids == want


def test_packing(odd, empty, files):
    from tokenizers import Tokenizer

    from panelforge.llm.packing import packed

    path = files.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    found = packed(clashing(odd), path).collect()
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, rows in by_doc.items():
        ids = np.array(library.encode(texts[i], add_special_tokens=False).ids + [1], "<u4")
        copies = 2 if i == 6 else 1
        assert sum(r.length for r in rows) == copies * len(ids) and all(r.doc_tokens == len(ids) for r in rows)
        covered = Counter(k for r in rows for k in range(r.start, r.start + r.length))
        assert set(covered.values()) == {copies} and len(covered) == len(ids)
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in rows)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert packed(empty, path).count() == 0
    assert all(len(r.ids) == r.length for r in packed(odd, path, with_ids=True).collect())


def test_padding_does_not_grow_with_partitions(spark, files):
    from panelforge.llm.packing import packed

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    for n in (1, 64):
        found = packed(docs.repartition(n), files.path("word_bpe_49k.json"))
        used, sequences = found.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
        assert used > 0.98 * 2048 * sequences, n


def test_differencing_fills_windows():
    from panelforge.llm.packing import cut_ids, windows

    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 513, 1500)
    parts = windows(sizes)
    assert sorted(i for p in parts for i in p) == list(range(1500))
    sums = [sizes[p].sum() for p in parts]
    assert max(sums) <= 2048 and len(parts) * 2048 < 1.02 * sizes.sum()
    assert windows(np.array([5])) == [[0]]
    assert len(windows(np.array([2000, 2000, 100]))) == 3
    assert cut_ids(0) == [] and sum(n for _, n in cut_ids(5001)) == 5001


def test_word_tokens_equal_the_library(files):
    from panelforge.llm.word_tokens import WordTokenizer

    own, rng = WordTokenizer(files.path("word_bpe_49k.json")), random.Random(9)
    texts = odd_texts()[1:] + ["".join(rng.choice("ab'sretvmld 12.,!éÉß×\n") for _ in range(50)) for _ in range(400)]
    for got, t in zip(own.encode(texts), texts, strict=True):
        assert got == np.array(own.library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


# Sharding


def test_shards_match_the_mixture(spark, odd, empty, tmp_path):
    from panelforge.llm.sharding import interleaved_shards, write_shards

    rows = [(i, f"t{i}", None, "hot" if i % 3 else f"s{i % 5}", 0) for i in range(1000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    sharded = interleaved_shards(docs)
    found = sharded.collect()
    assert sharded.columns == [*docs.columns, "shard", "slot"] and {r.doc_id: tuple(r)[:5] for r in found} == {r[0]: r for r in rows}
    source = {r[0]: r[3] for r in rows}
    shards = {}
    for r in found:
        shards.setdefault(r.shard, []).append(r)
    assert sorted(shards) == list(range(16)) and {len(s) for s in shards.values()} == {62, 63}
    share = Counter(source.values())
    for s in shards.values():
        assert sorted(r.slot for r in s) == list(range(len(s)))
        for name, n in Counter(source[r.doc_id] for r in s).items():
            assert abs(n - share[name] / 16) <= 2
    write_shards(sharded, f"{tmp_path}/shards")
    assert {(r.doc_id, r.text, r.shard, r.slot) for r in spark.read.parquet(f"{tmp_path}/shards").collect()} == {(r.doc_id, r.text, r.shard, r.slot) for r in found}
    wild = interleaved_shards(clashing(odd)).collect()
    counts = Counter(r.shard for r in wild)
    assert len(wild) == odd.count() and max(counts.values()) - min(counts.get(k, 0) for k in range(16)) <= 1
    assert Counter((r.doc_id, r.text) for r in wild) == Counter((r.doc_id, r.text) for r in odd.collect())
    assert interleaved_shards(empty).count() == 0


def test_slices_do_not_change_shards(spark, monkeypatch):
    from panelforge.llm import sharding

    df = spark.createDataFrame([(i, f"t{i}", None, f"s{i % 3}", 0) for i in range(500)], SCHEMA)
    one = {r.doc_id: (r.shard, r.slot) for r in sharding.interleaved_shards(df).collect()}
    monkeypatch.setattr(sharding, "SLICE", 7)
    assert one == {r.doc_id: (r.shard, r.slot) for r in sharding.interleaved_shards(df).collect()}


# Chat


def test_perspectives(spark):
    from panelforge.llm.chat import rotated

    rows = [(1, 0, "system", "be kind", "x"), (1, 1, "ann", "hi <|im_end|>", "x"), (1, 2, "bob", None, "x"), (1, 3, "ann", "bye", "x"), (2, 0, "system", "alone", "x"), (3, None, None, "é", "x"), (None, 0, "ann", "hm", "x"), (1, 300, "cy", "late", "x"), (1, 3, "ann", "bye", "x"), (1, 301, "d\ne", "line", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, speaker string")
    found = {(r.conv_id, r.speaker): r for r in rotated(df).collect()}
    assert set(found) == {(1, s) for s in ("ann", "bob", "cy", "d e")} | {(3, "unknown"), (None, "ann")}
    ann, cy = found[1, "ann"], found[1, "cy"]
    head = "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n" + "<|im_start|>assistant\nbye<|im_end|>\n" * 2
    assert ann.text == head + "<|im_start|>user name=cy\nlate<|im_end|>\n<|im_start|>user name=d e\nline<|im_end|>\n"
    assert [ann.text[s.start : s.end] for s in ann.spans] == ["hi < |im_end|><|im_end|>", "bye<|im_end|>", "bye<|im_end|>"] and (ann.n_turns, ann.n_own) == (7, 3)
    assert [cy.text[s.start : s.end] for s in cy.spans] == ["late<|im_end|>"] and [found[3, "unknown"].text[s.start : s.end] for s in found[3, "unknown"].spans] == ["é<|im_end|>"]
    parts = {(r.conv_id, r.part, r.speaker): r for r in rotated(df, 256).collect()}
    assert parts[1, 0, "ann"].text == head and parts[1, 0, "cy"].spans == [] and parts[1, 0, "ann"].text + parts[1, 1, "ann"].text == ann.text
    assert rotated(df.limit(0)).count() == 0


# Pseudo-likelihood


def test_pseudo_likelihood(spark, odd, empty):
    from panelforge.llm import pseudo_likelihood as p

    rng = random.Random(3)
    texts = [" ".join(x for _ in range(40) for x in rng.choice([["red", "fox", "ran"], ["old", "dog", "sat"]])) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = p.texts_in_buckets(docs).persist()
    network, start = p.trained(rows, stride=2), p.Network(p.word_counts(rows))
    mean = lambda n: p.pseudo_log_likelihood(docs, n).agg(F.avg("mean_log_likelihood")).first()[0]
    assert mean(network) > mean(start) + 0.2
    for r in p.pseudo_log_likelihood(docs, network).limit(3).collect():
        words = [int(next(iter(p.bucketed(__import__("pyarrow").array([w]))))[3][0]) for w in texts[r.doc_id].split()]
        row = [p.EDGE] * p.SIDE + words + [p.EDGE] * p.SIDE
        total = 0.0
        for i in range(len(words)):
            x = np.concatenate([network.embedding[row[i + p.SIDE + k]] for k in p.OFFSETS])
            h = np.append(np.tanh(x @ network.hidden), 1)
            node, leaf = 0, int(network.leaf[words[i]])
            for level in range(p.DEPTH):
                right = leaf >> (p.DEPTH - 1 - level) & 1
                odds = float(network.node[node] @ h)
                total -= np.log1p(np.exp(-odds if right else odds))
                node = 2 * node + 1 + right
        assert r.n_words == len(words) and r.log_likelihood == pytest.approx(total, rel=1e-4, abs=1e-3)
    wild = p.pseudo_log_likelihood(clashing(odd), network).collect()
    assert len(wild) == odd.count() and all((r.mean_log_likelihood is None) == (r.n_words == 0) for r in wild)
    assert p.pseudo_log_likelihood(empty, p.trained(p.texts_in_buckets(empty))).count() == 0
    assert p.trained_and_scored(empty).count() == 0 and p.trained_and_scored(clashing(odd)).count() == odd.count()


def test_probabilities_of_all_words_sum_to_one():
    from panelforge.llm import pseudo_likelihood as p

    rng = np.random.default_rng(4)
    network = p.Network(rng.integers(0, 50, p.WORDS).astype(float))
    network.node[:, :-1] = rng.normal(0, 0.5, (p.WORDS, p.HIDDEN))
    row = np.concatenate([np.array([5, 9, w, 77, p.EDGE], np.int32) for w in range(p.WORDS)])
    assert np.exp(network.log_probabilities(row, np.arange(p.WORDS) * 5 + 2).astype(float)).sum() == pytest.approx(1, rel=1e-3)


def test_a_fitting_word_scores_above_a_strange_one_of_equal_count(spark):
    from panelforge.llm import pseudo_likelihood as p

    rng = random.Random(5)
    sides = [("red", "fox", "ran"), ("old", "dog", "sat")]
    texts = [" ".join(x for _ in range(40) for x in rng.choice(sides)) for _ in range(400)]
    texts += [" ".join(x for _ in range(20) for pair in sides for x in pair)]  # so that counts of fox and dog are near
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    network = p.trained(p.texts_in_buckets(docs))

    def term(text: str, at: int) -> float:
        ((_, _, n, buckets),) = p.bucketed(__import__("pyarrow").array([text]))
        row, places = p.neighbours(n, buckets.astype(np.int32))
        return float(network.log_probabilities(row, places)[at])

    assert term("ran red fox ran red", 2) > term("ran red dog ran red", 2) + 1
    assert term("sat old dog sat old", 2) > term("sat old fox sat old", 2) + 1


def test_scores_do_not_depend_on_partitions(spark):
    from panelforge.llm import pseudo_likelihood as p

    rng = random.Random(6)
    docs = spark.createDataFrame([(i, prose(rng, rng.randrange(0, 300), 800)) for i in range(300)] + [(4, None), (None, "no id"), (7, "twice it is"), (7, "twice it is")], "doc_id long, text string")
    found = []
    for parts in (1, 8):
        rows = p.texts_in_buckets(docs.repartition(parts, F.rand(parts))).persist()
        network = p.trained(rows, shard_words=9000)
        found.append({(r.doc_id, r.n_words): r.log_likelihood for r in p.scored(rows, network).collect()})
    assert found[0].keys() == found[1].keys() and len(found[0]) > 290
    assert all(found[1][k] == pytest.approx(v, rel=1e-5, abs=1e-3) for k, v in found[0].items())


def test_training_shards_do_not_depend_on_the_number_of_tasks(spark, monkeypatch):
    from panelforge.llm import pseudo_likelihood as p

    rng = random.Random(8)
    docs = spark.createDataFrame([(i, prose(rng, 60, 800)) for i in range(200)], "doc_id long, text string")
    rows = p.texts_in_buckets(docs).persist()
    kind, trained_rows, networks = type(docs), [], []
    dealt, mapped = kind.repartition, kind.mapInArrow
    counted = lambda df, f, schema: trained_rows.append(mapped(df, f, schema).persist()) or trained_rows[-1]
    for least in (1, 2, 16):
        monkeypatch.setattr(kind, "repartition", lambda df, n, *by, least=least: dealt(df, least if least == 1 else max(n, least), *by))
        monkeypatch.setattr(kind, "mapInArrow", counted)
        networks.append(p.trained(rows, rounds=1, shard_words=6000))
    assert all(np.allclose(n.rows(), networks[0].rows(), rtol=1e-4, atol=1e-6) for n in networks)
    handed = [df.count() for df in trained_rows[1::2]]  # after the counts of words
    shards = -(-docs.select(F.sum(F.size(F.split("text", " ")))).first()[0] // 6000)
    assert shards >= 2 and handed[2] <= shards * handed[0]


def test_training_takes_every_position(spark):
    import pyarrow as pa

    from panelforge.llm import pseudo_likelihood as p

    text = " ".join(f"word{i}" for i in range(600))
    rows = p.texts_in_buckets(spark.createDataFrame([(0, text)], "doc_id long, text string"))
    start, network = p.Network(p.word_counts(rows)), p.trained(rows)
    ((_, _, _, buckets),) = p.bucketed(pa.array([text]))
    assert (network.embedding[buckets] != start.embedding[buckets]).any(1).all()
    leaf = network.leaf[buckets]
    assert (network.node[p.WORDS // 2 - 1 + (leaf >> 1)] != start.node[p.WORDS // 2 - 1 + (leaf >> 1)]).any(1).all()


# Audio


def test_recordings_align_at_their_offset():
    from panelforge.llm import audio_prints as a

    rng = np.random.default_rng(2)
    samples, rate = a.sound_of(a.played(list(rng.normal(size=80))))
    hop = int(a.HOP * rate)
    whole, part = a.codes(a.chroma(samples, rate)), a.codes(a.chroma(samples[20 * hop : 90 * hop], rate))
    offset, wrong, overlap = a.aligned(whole.view(np.int32), part.view(np.int32))
    assert offset == 20 and wrong < 0.05 and overlap == len(part)
    other = a.codes(a.chroma(*a.sound_of(a.played(list(rng.normal(size=80))))))
    assert a.aligned(whole.view(np.int32), other.view(np.int32))[1] > a.WRONG
    assert len(a.codes(a.chroma(np.zeros(10), 4000))) == 0 and len(a.sound_of(b"no wave")[0]) == 0
    image = a.chroma(samples, rate)[:30]
    (r, c) = (4, 3)
    one, two = a.FILTERS[5]
    total = lambda areas: sum(image[c + t0 : c + t1, p0:p1].sum() for t0, t1, p0, p1 in areas)
    level = np.searchsorted(a.BORDERS, np.log((0.1 + total(one)) / (0.1 + total(two))), "right")
    assert (a.codes(image)[c] >> np.uint32(10)) & 3 == a.GRAY[level] and r == 4


def test_recording_classes_against_all_pairs(spark):
    from panelforge.llm import audio_prints as a

    rng, vectors = np.random.default_rng(4), []
    for _ in range(8):
        base = rng.normal(size=64)
        vectors += [base + rng.normal(0, 0.04, 64) for _ in range(rng.integers(1, 6))]
    vectors += [vectors[0]]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(100, None), (101, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.media_id: r for r in a.recording_classes(a.fingerprints(df, "vec_id", "embedding", lambda v: a.sound_of(a.played(v)))).collect()}
    codes = [a.codes(a.chroma(*a.sound_of(a.played(list(v))))).view(np.int32) for v in vectors]
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            _, wrong, overlap = a.aligned(codes[i], codes[j])
            if wrong <= a.WRONG and overlap >= a.OVERLAP:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    assert [found[i].class_id for i in range(len(codes))] == [find(i) for i in range(len(codes))]
    for i in range(len(codes)):
        if found[i].link_id is not None:
            offset, wrong, _ = a.aligned(codes[min(found[i].print_id, found[i].link_id)], codes[max(found[i].print_id, found[i].link_id)])
            assert found[i].link_wrong == pytest.approx(wrong) and found[i].link_offset == (offset if found[i].print_id < found[i].link_id else -offset)
        assert (found[i].n_links > 0) == (found[i].link_id is not None)
    assert found[len(vectors) - 1].print_id == 0 and found[100].class_id == 100 and found[100].n_codes == 0
    assert a.recording_classes(a.fingerprints(df.limit(0), "vec_id", "embedding")).count() == 0


# Pipeline


def test_pipeline_stages_against_their_operators(spark):
    import corpus_pipeline as c

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = docs
    for name, stage in c.STAGES[:-1]:
        found = stage(spark, left, sf)
        assert found.columns == docs.columns, name
        rows = found.collect()
        assert 0 < len(rows) <= left.count()
        left = spark.createDataFrame(rows, docs.schema)
    ids = {r.doc_id for r in left.collect()}
    pieces = c.STAGES[-1][1](spark, left, sf).collect()
    assert {r.doc_id for r in pieces} == ids
    texts = [(r.doc_id, r.text) for r in left.collect()]
    assert all(i == component for i, (_, component) in components_by_brute_force(texts).items())


def test_pipeline_keeps_columns_with_clashing_names(spark, odd):
    import corpus_pipeline as c

    docs = clashing(odd.where("doc_id is not null"))
    sf = "/root/testdata/sf0.001"
    for _, stage in c.STAGES[:-1]:
        found = stage(spark, docs, sf)
        assert found.columns == docs.columns and {r.score for r in found.collect()} <= {"mine"}


def test_pipeline_keeps_one_row_of_repeated_ids(spark, odd, empty):
    import corpus_pipeline as c

    rows = c.one_of_each_group(spark, odd.where("doc_id is not null"), "").collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and 6 in ids and 9 not in ids
    for name, stage in c.STAGES:
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0, name


def test_pipeline_groups_rows_and_not_ids(spark):
    import corpus_pipeline as c

    rng = random.Random(12)
    copied, alone, other, nameless, null_copy = (prose(rng, 40, 5000) for _ in range(5))
    rows = [(3, copied), (7, copied), (7, alone), (8, other), (8, nameless[::-1]), (None, nameless), (None, null_copy), (9, null_copy), (None, None), (None, " "), (None, " "), (4, ""), (4, None), (5, alone + " x")]
    found = c.one_of_each_group(spark, spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA), "").collect()
    want = [(3, copied), (5, alone + " x"), (8, other), (8, nameless[::-1]), (None, nameless), (9, null_copy), (None, None), (None, " "), (None, " "), (4, ""), (4, None)]
    assert Counter((r.doc_id, r.text) for r in found) == Counter(want)


def test_pipeline_ends_in_ids(spark, odd, files):
    from tokenizers import Tokenizer

    import corpus_pipeline as c

    library = Tokenizer.from_file(files.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    for r in c.into_sequences(spark, odd, "").collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids + [1]
        assert r.ids == ids[r.start : r.start + r.length]


def test_pipeline_runs_its_stages_one_after_the_other(spark):
    import corpus_pipeline as c

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in c.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), stage(spark, docs, sf).schema)
    pieces = lambda df: Counter((r.doc_id, r.doc_tokens) for r in df.collect() if r.start == 0)
    found = c.run(spark, sf)
    assert pieces(found) == pieces(docs) and found.columns == docs.columns


# Queries against SQL


def test_query_results_against_the_libraries(spark, files):
    """The queries that SQL can't express, on whole tables: rows, contract columns, and what can be held against a library."""
    import tiktoken
    from tokenizers import Tokenizer

    from panelforge.llm import queries
    from panelforge.llm.byte_tokens import ranks_of

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {name: queries.QUERIES[name](spark, sf).collect() for name in ("op1_quality_model", "op5_pseudo_likelihood", "op6_byte_tokens", "op7_audio_prints", "op8_toxicity", "op10_packing")}
    for name in ("op1_quality_model", "op8_toxicity"):
        cut = 0.3 if name[:3] == "op1" else 0.5
        assert sorted(r.doc_id for r in found[name]) == sorted(texts)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in found[name])
    assert {r.doc_id: r.n_words for r in found["op5_pseudo_likelihood"]} == {i: len(SPACE.findall(t)) for i, t in texts.items()}
    assert all(r.log_likelihood < 0 for r in found["op5_pseudo_likelihood"] if r.n_words)
    byte_library = tiktoken.Encoding("own", pat_str=files.PATTERN, mergeable_ranks=ranks_of(files.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    for r in found["op6_byte_tokens"]:
        ids = byte_library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
    word_library = Tokenizer.from_file(files.path("word_bpe_49k.json"))
    pieces = {}
    for r in found["op10_packing"]:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(texts)
    for i, rows in pieces.items():
        ids = np.array(word_library.encode(texts[i], add_special_tokens=False).ids + [1], "<u4")
        assert sum(r.length for r in rows) == len(ids) and all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in rows)
    assert sorted(r.vec_id for r in found["op7_audio_prints"]) == sorted(r.vec_id for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id").collect())


def test_queries_equal_sql(spark):
    from panelforge.llm import queries

    from twins import compare, connection

    sf = "/root/testdata/sf0.001"
    con = connection(sf)
    for name, sql in queries.ORACLE_SQL.items():
        compare(queries.QUERIES[name](spark, sf), con, sql)


# Cases that an earlier round missed


def test_the_cost_of_rules_is_stated_not_timed(spark):
    from panelforge.llm import quality_rules as q

    docs = spark.createDataFrame([(" ".join(["word"] * 30),)] * 5 + [("few",)] * 5, "text string")
    cheap, dear = q.Rule("cheap", lambda t, w: F.size(w) < 20, 1.0), q.Rule("dear", lambda t, w: F.size(w) > 0, 64.0)
    assert [m.rule.name for m in q.rule_order(docs, (dear, cheap))] == ["cheap", "dear"]
    assert [m.rule.name for m in q.rule_order(docs, (q.Rule("dear", dear.rejects, 0.5), cheap))] == ["dear", "cheap"]
    assert set(q.timed_costs(docs, (cheap, dear), repeats=1)) == {"cheap", "dear"}


def test_rules_by_measures_are_the_rules_by_text(spark, odd):
    from panelforge.llm import quality_rules as q

    rules = [r for r in (*q.BASE, *q.RULES) if r.by_measures]
    found = q.base_measures(odd).select(*(F.coalesce(q.tested("text", r.rejects), F.lit(False)).alias(f"a{k}") for k, r in enumerate(rules)), *(r.by_measures().alias(f"b{k}") for k, r in enumerate(rules)))
    assert len(rules) == 5 and all(r[f"a{k}"] == r[f"b{k}"] for r in found.collect() for k in range(len(rules)))


def test_many_texts_under_one_id(spark):
    from panelforge.llm.near_duplicates import full_sets, near_duplicates, sketched

    rng = random.Random(31)
    rows = []
    for k in range(300):
        base = prose(rng, 60, 5000).split()
        rows += [(7, " ".join(base)), (7, " ".join([*base[:-1], f"end{k}"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates(docs).collect()
    assert len(found) == 600 and {r.component_id for r in found} == {7} and all(r.kept for r in found)
    # a text meets its own node alone, not those of all texts under the id
    own = sketched(docs).withColumn("node", F.monotonically_increasing_id()).withColumnRenamed("doc_id", "least")
    nodes = own.select("node", "least", "text_print", "n_shingles", "print1", "print2")
    assert docs.select(F.col("doc_id").alias("least"), F.xxhash64("text").alias("text_print")).join(nodes, ["least", "text_print"]).count() == 600
    assert full_sets(docs, nodes).count() == 600


def test_speakers_whose_names_look_alike_stay_apart(spark):
    from panelforge.llm.chat import rotated

    turns = [(1, 0, None, "a"), (1, 1, "unknown", "b"), (1, 2, "x\ny", "c"), (1, 3, "x y", "d"), (1, 4, "system", "e"), (1, 5, None, "f")]
    found = rotated(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")).collect()
    assert sorted((r.speaker, r.n_own) for r in found) == [("unknown", 1), ("unknown", 2), ("x y", 1), ("x y", 1)]
    shown = {"".join(r.text[s.start : s.end] for s in r.spans).replace("<|im_end|>", "") for r in found}
    assert shown == {"af", "b", "c", "d"} and all("<|im_start|>system\ne" in r.text for r in found)


def test_decoding_in_parts(spark, files):
    from panelforge.llm import byte_tokens as b

    path = files.path("byte_bpe_multi_50k.tiktoken")
    of_id = {r: t for t, r in b.ranks_of(path).items()}
    own, rng = b.Decoder(path), np.random.default_rng(5)
    rows = [rng.integers(0, 50000, n).astype(np.int32) for n in (0, 3, b.BLOCK + 5, 1, 2 * b.BLOCK, 0, b.BLOCK)]
    assert own.decode(rows) == [b"".join(of_id[i] for i in r.tolist()) for r in rows]
    assert own.decode([]) == [] and own.decode([rows[0]]) == [b""]
    for wrong in (-1, 50256, 1 << 30):
        with pytest.raises(ValueError):
            own.decode([np.array([wrong], np.int32)])


def test_a_word_of_thousands_of_bytes(spark, files):
    import tiktoken

    from panelforge.llm.byte_tokens import encoded, ranks_of

    path = files.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=files.PATTERN, mergeable_ranks=ranks_of(path), special_tokens={})
    rng = random.Random(12)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in (96, 97, 1500)] + ["a" * 2000, "ab" * 700]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in encoded(docs, path, files.PATTERN).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_a_rare_label_is_not_lost_in_the_sample(spark):
    from panelforge.llm.common import held_out
    from panelforge.llm.labelled import labelled_sample

    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 500 == 3).cast("int").alias("toxic"))
    there = {r.toxic: r["count"] for r in labels.where(~held_out(F.col("doc_id"))).groupBy("toxic").count().collect()}
    found, shares = labelled_sample(docs, labels, "toxic", 300, 1 << 20, balanced=True)
    taken = {r.label: r["count"] for r in found.groupBy("label").count().collect()}
    assert taken[1] == there[1] and shares[1] == 1_000_000 and 230 < taken[0] < 350
    plain, shares = labelled_sample(docs, labels, "toxic", 300, 1 << 20)
    assert shares[0] == shares[1] and 230 < plain.count() < 370
    few, _ = labelled_sample(docs, labels, "toxic", 300, 900, balanced=True)
    assert few.count() < 150


def test_thresholds_move_from_the_common_one_with_a_languages_own_texts(spark):
    from panelforge.llm import toxicity as t

    steps = 2 * t.FARTHEST * t.STEPS
    common = np.zeros((steps, 2))
    common[700, 0], common[760, 1] = 900, 100

    def threshold(n):
        own = np.zeros((steps, 2))
        own[640, 0], own[680, 1] = n, n
        return t.best_threshold(own + t.PRIOR * common / common.sum())

    found = [threshold(n) for n in (0, 1, 10, 100, 1000)]
    assert found[0] == t.best_threshold(common) and found == sorted(found, reverse=True) and found[-1] < found[0]


def test_short_recordings_are_linked_by_all_of_their_codes(spark):
    from panelforge.llm.audio_prints import recording_classes

    rng = np.random.default_rng(3)
    whole = rng.integers(-(1 << 31), 1 << 31, 40).astype(np.int32)
    near = whole[5:15].copy()
    near[8] ^= 3
    rows = [(1, whole.tolist()), (2, near.tolist()), (3, rng.integers(-(1 << 31), 1 << 31, 10).tolist()), (4, whole[:3].tolist()), (5, whole[:3].tolist())]
    found = {r.media_id: (r.class_id, r.n_links) for r in recording_classes(spark.createDataFrame(rows, "media_id long, codes array<int>")).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (3, 0), 4: (4, 0), 5: (4, 0)}


def test_recordings_that_are_in_one_class_are_not_aligned_any_more(spark, monkeypatch):
    from panelforge.llm import audio_prints as a

    rng, n = np.random.default_rng(7), 40
    sound = rng.integers(-(1 << 31), 1 << 31, 64 * (n + 5) + 20).astype(np.int32)
    passage = rng.integers(-(1 << 31), 1 << 31, 5).astype(np.int32)
    rows = []
    for i in range(n + 5):
        at = 64 * i + int(rng.integers(30, 50))
        sound[at : at + 5] = passage  # one anchor that all have in common
    for i in range(n + 5):
        own = sound[64 * i : 64 * i + 84].copy()
        if i >= n:  # these are linked with nothing
            own[:20], own[64:] = rng.integers(-(1 << 31), 1 << 31, (2, 20))
        rows.append((i, own.tolist()))
    tried, aligned_by = [], a.align_pairs

    def counted(pairs, nodes):
        tried.extend((r.a, r.b) for r in pairs.collect())
        return aligned_by(pairs, nodes)

    monkeypatch.setattr(a, "align_pairs", counted)
    found = {r.media_id: r.class_id for r in a.recording_classes(spark.createDataFrame(rows, "media_id long, codes array<int>")).collect()}
    assert found == {i: 0 if i < n else i for i in range(n + 5)}
    # the links of the chain, and all pairs of different classes
    assert len(tried) == len(set(tried)) == n - 1 + 5 * n + 10
