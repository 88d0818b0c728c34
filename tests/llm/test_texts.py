"""Language, repetition, toxicity and language-model scores."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import hyperdim
from plumbline.llm.brown import class_scores, classify, exchange, group_of, train
from plumbline.llm.crf import Crf, forward_backward
from plumbline.llm.hyperdim import Profiles, identify
from plumbline.llm.queries import op1_language, op6_toxicity, op10_class_lm
from plumbline.llm.repetition import LENGTHS, measure, repetition
from plumbline.llm.toxicity import toxicity
from plumbline.llm.words import id_remainder
from plumbline.sources.staging import Staging


def remainder(i, n):
    return zlib.crc32(b"" if i is None else str(i).encode()) % n


# language


def test_held_out_languages(spark, sf_dir, sample):
    found = {r.doc_id: r for r in op1_language(spark, sf_dir).collect()}
    assert all(found[i].held_out == (remainder(i, 5) == 0) for i, *_ in sample)
    held = [(found[i].lang_pred, lang) for i, _, lang, _ in sample if found[i].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_bundles_are_sums_of_bound_letter_vectors():
    texts = ["Ab, ça!", "", "b  ab", "日本 Éa"]
    profiles = Profiles(128, 3)
    bundles, some = profiles.bundle(texts, np.arange(len(texts)), len(texts))
    assert some.tolist() == [True, False, True, True]

    def letter(c):
        from plumbline.llm.hyperdim import letter_vectors

        return letter_vectors(np.array([0 if c == " " else ord(c)]), 128)[0].astype(int)

    for k, text in enumerate(texts):
        symbols = " " + re.sub(r"[^a-zéç日本]+", " ", text.lower()).strip() + " " if some[k] else ""
        want = Counter(symbols[i : i + 3] for i in range(len(symbols) - 2) if symbols[i + 1] != " ")
        total = sum((n * np.roll(letter(g[0]), 2) * np.roll(letter(g[1]), 1) * letter(g[2]) for g, n in want.items()), np.zeros(128, int))
        assert (bundles[k] == total).all()
    together, _ = profiles.bundle(texts, np.array([1, 0, 1, 0]), 2)
    assert (together == [bundles[1] + bundles[3], bundles[0] + bundles[2]]).all()


def test_many_distinct_letters_need_little_memory(monkeypatch):
    """2 MB of text with some 600,000 distinct trigrams; blocks of n-grams and rows give the same sums."""
    rnd = np.random.default_rng(1)
    text = "".join(map(chr, rnd.integers(0x4E00, 0x4E00 + 6000, 700_000).tolist()))
    profiles = Profiles()
    tracemalloc.start()
    whole, _ = profiles.bundle([text], np.zeros(1, np.int64), 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
    texts = [text[:900], "abc", text[900:2000], text[:50] * 3]
    want, _ = profiles.bundle(texts, np.arange(4), 4)
    monkeypatch.setattr(hyperdim, "_BLOCK", 64)
    monkeypatch.setattr(hyperdim, "_MATRIX_CELLS", 128)
    assert (profiles.bundle(texts, np.arange(4), 4)[0] == want).all() and abs(whole).sum() > 0


def test_odd_languages(spark, odd_documents, no_documents):
    found = identify(odd_documents, F.col("doc_id") >= 0, carry=("doc_id", "score", "text"))
    rows = found.collect()
    assert len(rows) == odd_documents.count() and found.columns == ["doc_id", "text", "held_out", "lang_pred", "score"]
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) for r in rows)
    assert identify(no_documents, F.lit(True)).collect() == []
    nothing_learnt = identify(odd_documents, F.lit(False)).collect()
    assert {r.lang_pred for r in nothing_learnt} == {"und"}


# repetition


def test_shares_equal_brute_force(sample):
    texts = [t for _, t, _, _ in sample][:80] + ["a b c a b c a b c d", "x\nx\n\nx y\nx\n", "", "é é é é é é é"]
    found = measure([t.encode() for t in texts])
    for k, text in enumerate(texts):
        w = re.findall("[^\\x20\\x09-\\x0D]+", text)
        for column, n in enumerate(LENGTHS):
            seen, covered = set(), set()
            for i in range(len(w) - n + 1):
                gram = tuple(w[i : i + n])
                if gram in seen:
                    covered |= set(range(i, i + n))
                seen.add(gram)
            assert found["ngram_chars"][k][column] == sum(len(w[i]) for i in covered)
        times = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        assert found["n_repeat_words"][k] == len({j for i in range(len(w) - 2) if times[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)})
        lines = [x for x in text.split("\n") if re.search("[^\\x20\\x09-\\x0D]", x)]
        assert found["n_dup_lines"][k] == len(lines) - len(set(lines))


def test_odd_repetition(spark, odd_documents, no_documents):
    rows = repetition(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in rows if r.doc_id in (0, 1, 2))
    assert [r.kept for r in rows if r.doc_id == 9] == [False]
    assert repetition(no_documents).collect() == []


# toxicity


def brute_marginals(emission, start, step):
    n = len(emission)
    total, out = 0.0, np.zeros(n)
    for code in range(2**n):
        tags = [(code >> k) & 1 for k in range(n)]
        p = math.exp(start[tags[0]] + sum(emission[k][t] for k, t in enumerate(tags)) + sum(step[a][b] for a, b in zip(tags, tags[1:])))
        total += p
        out += p * np.array(tags)
    return out / total, math.log(total)


def test_forward_backward_equals_enumeration():
    rnd = np.random.default_rng(4)
    emission, start, step = rnd.normal(size=(11, 2)), rnd.normal(size=2), rnd.normal(size=(2, 2))
    first = np.array([0, 4, 5, 5, 11])
    p, _, logs = forward_backward(emission, start, step, first)
    parts = [brute_marginals(emission[a:b], start, step) for a, b in zip(first[:-1], first[1:]) if a < b]
    assert np.allclose(p[:, 1], np.concatenate([x for x, _ in parts])) and math.isclose(logs, sum(x for _, x in parts))
    assert isinstance(Crf(np.zeros((3, 2)), start, step).marginals(np.array([[1, 2]]), np.array([0, 1])), np.ndarray)


def test_toxic_words_are_found_with_offsets(spark):
    rnd = np.random.default_rng(5)
    rows, labels = [], []
    for k in range(400):
        words = [f"wort{x}" for x in rnd.integers(0, 300, 40)]
        toxic = k % 4 == 0
        if toxic:
            words[int(rnd.integers(0, 40))] = "Schüft,"
        rows.append((k, "é " + " ".join(words)))
        labels.append((k, 1, int(toxic)))
    df, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity(df, marks, id_remainder(F.col("doc_id"), 5) != 0).collect()}
    held = [k for k in found if found[k].held_out]
    assert len(held) > 40 and all(found[k].predicted == (k % 4 == 0) for k in held)
    assert all([rows[k][1][s.start : s.end] for s in found[k].spans] == ["Schüft,"] for k in held if k % 4 == 0)


def test_toxic_words_late_in_long_texts_are_learnt(spark):
    """Toxic words only behind the first 1,000, and long clean texts: both are judged by all of their words."""
    rnd = np.random.default_rng(8)
    rows, labels = [], []
    for k in range(300):
        words = [f"wort{x}" for x in rnd.integers(0, 300, 1200 if k % 3 else 4000)]
        toxic = k % 4 == 0
        for _ in range(3 if toxic else 0):
            words[int(rnd.integers(1000, 1200))] = "schuft"
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    df, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    found = [r for r in toxicity(df, marks, id_remainder(F.col("doc_id"), 5) != 0).collect() if r.held_out]
    assert len(found) > 30 and all(r.predicted == (r.doc_id % 4 == 0) for r in found)


def test_held_out_toxicity(spark, sf_dir):
    rows = op6_toxicity(spark, sf_dir).collect()
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_odd_toxicity(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (6, None), (7, 0)], "doc_id long, toxic int")
    rows = toxicity(odd_documents, labels, F.lit(True)).collect()
    assert len(rows) == odd_documents.count() and len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert toxicity(no_documents, labels, F.lit(True)).collect() == []


# language model


def test_base_scores_equal_brute_force(spark, sf_dir, sample):
    found = {r.doc_id: r for r in op10_class_lm(spark, sf_dir).collect()}
    docs = {i: [*t.encode().lower().split(), b"\n"] for i, t, _, _ in sample}
    counts = Counter(w for i, words in docs.items() if remainder(i, 7) != 2 for w in words)
    n, v = sum(counts.values()), len(counts)
    for i, words in docs.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(i, 7) == 2, len(words), sum(counts[w] > 0 for w in words), n)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
    held = [found[i] for i in docs if found[i].held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_class_model_is_a_distribution(spark):
    """Classes after a class, and words with one unknown word within a class, have probabilities that sum to 1."""
    texts = ["a b c", "a b d", "b a c e", "f f", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    groups = 3
    model, counts = train(df, Staging(spark), vocabulary=3, groups=groups, classes=4, frequent=2)
    rare = {bytes(r.word): r.c for r in counts.collect() if bytes(r.word) not in model.unit}
    used = sorted(set(model.unit_class))
    assert np.allclose((10**model.transition)[:, used].sum(axis=1), 1)
    for k in used:
        mass = sum(10 ** model.emission[u] for u in model.unit.values() if model.unit_class[u] == k)
        for g in range(groups):
            if model.unit_class[len(model.unit) + g] == k:
                size = sum(c + 1 for w, c in rare.items() if group_of(w, groups) == g) + 1
                mass += size * 10 ** model.emission[len(model.unit) + g]
        assert math.isclose(mass, 1, rel_tol=1e-9)
    assert model.tokens == 17 and model.types == 7


def test_exchange_finds_alternating_classes():
    pairs = np.zeros((8, 8))
    pairs[:4, 4:] = pairs[4:, :4] = 10 + np.arange(16).reshape(4, 4)
    label = exchange(pairs, 2, 10)
    assert len(set(label[:4])) == len(set(label[4:])) == 1 and label[0] != label[4]


def test_rare_words_have_their_own_classes(spark):
    """Words outside the vocabulary fall into classes by what is around them, whatever their ends; scores equal a plain sum."""
    rnd = np.random.default_rng(3)
    first, second = [f"n{k}xyz" for k in range(20)], [f"v{k}xyz" for k in range(20)]  # one group: equal ends
    frames = [("the", "a", "my"), first, ("will", "can", "may"), second, ("today", "now", "here")]
    texts = [" ".join(frame[rnd.integers(len(frame))] for _ in range(12) for frame in frames) for _ in range(60)]
    texts += [f"the {first[0]} {second[3]} {second[4]} unseenxyz will", f"{first[1]} {first[2]}", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    options = dict(groups=2, classes=16)
    learnt = df.where("doc_id < 60 or doc_id = 61")
    seed, counts = train(learnt, Staging(spark), vocabulary=10, frequent=16, **options)
    model, table = classify(learnt, seed, counts, Staging(spark), **options)
    kinds = {bytes(r.word): (r.c, r.kind) for r in table.collect()}
    assert len(kinds) == 40 - len(set(seed.unit) & {w.encode() for w in first + second})
    assert {kinds[w.encode()][1] for w in first if w.encode() in kinds}.isdisjoint({kinds[w.encode()][1] for w in second if w.encode() in kinds})

    known = kinds | model.frequent
    for k in range(16):
        inside = [c for c, kind in known.values() if kind == k]
        assert math.isclose(10 ** model.mass[k], max(1, sum(inside) + len(inside) + (model.unknown == k).sum()), rel_tol=1e-9)
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    between = np.zeros((16, 16))
    for i, text in enumerate(texts):
        if i < 60 or i == 61:
            path = [known[w][1] for w in [b"\n", *text.encode().split(), b"\n"]]
            for a, b in zip(path, path[1:]):
                between[a, b] += 1
    prior = 10**model.mass / (10**model.mass).sum()
    assert np.allclose(10**model.transition, (between + 20 * prior) / (between.sum(axis=1, keepdims=True) + 20))

    found = {r.doc_id: r.score for r in class_scores(df, (F.col("doc_id") < 60) | (F.col("doc_id") == 61), vocabulary=10, frequent=16, **options).collect()}
    for i, text in enumerate(texts):
        path = [known.get(w, (0, model.unknown[group_of(w, 2)])) for w in [b"\n", *(text or "").encode().split(), b"\n"]]
        want = sum(model.transition[a, b] + math.log10(c + 1) - model.mass[b] for (_, a), (c, b) in zip(path, path[1:]))
        assert math.isclose(found[i], want, rel_tol=1e-9)


def test_odd_scores(spark, odd_documents, no_documents):
    rows = class_scores(odd_documents, F.col("doc_id") != 9).collect()
    assert len(rows) == odd_documents.count()
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (0, 1, 2))
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert class_scores(no_documents, F.lit(True)).collect() == []
    untrained = class_scores(odd_documents, F.lit(False)).collect()
    assert {r.n_known for r in untrained} == {0} and {r.train_tokens for r in untrained} == {0}
