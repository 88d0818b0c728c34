"""Mixing, fingerprints, personal data, URL rules, and the pipeline."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.llm.mixing import lead_topics, measured, mix_to_targets, rake, tempered
from plumbline.llm.personal_data import MARKED, base_spans, find_personal_data, redact, spelled
from plumbline.llm.queries import op3_mixing, op5_simhash, op7_personal_data
from plumbline.llm.simhash import fingerprint_documents, within_radius
from plumbline.llm.urls import ALLOW, BLOCK, Trie, judge_urls, split_url
from plumbline.llm.words import Words, word_hashes
from plumbline.sources.staging import Staging

# mixing


def test_expected_mix_has_target_shares(spark, sf_dir):
    rows = op3_mixing(spark, sf_dir).toPandas()
    assert ((0 <= rows.probability) & (rows.probability <= 1)).all()
    for name in ("source", "lang"):
        share = rows.groupby(name).n_tokens.sum() ** 0.7
        expected = (rows.n_tokens * rows.probability).groupby(rows[name]).sum()
        assert np.allclose(expected / expected.sum(), share / share.sum(), atol=5e-3)
    kept = rows[rows.selected].n_tokens.sum() / rows.n_tokens.sum()
    assert abs(kept - 0.7) < 0.1


def test_raking_locally_and_on_tables_is_the_same(spark):
    cells = spark.createDataFrame([("a", "x", 10), ("a", "y", 30), ("b", "x", 5), (None, "y", 20), ("b", "y", 1)], "source string, lang string, mass long")
    staging = Staging(spark)
    goals = {name: tempered(cells, name, 0.3) for name in ("source", "lang")}
    near = {(r.source, r.lang): r.weight for r in rake(cells, goals, staging, 2.5, sweeps=6).collect()}
    far = {(r.source, r.lang): r.weight for r in rake(cells, goals, staging, 2.5, sweeps=6, local_cells=0).collect()}
    assert near.keys() == far.keys() and all(abs(near[k] - far[k]) < 1e-12 for k in near)
    free = {(r.source, r.lang): r.weight * r.mass for r in rake(cells, goals, staging).collect()}
    wanted = {r.value: r.share for r in goals["lang"].collect()}
    assert abs(sum(m for (_, lang), m in free.items() if lang == "x") / 66 - wanted["x"]) < 1e-5


def test_topics_do_not_depend_on_neighbours():
    texts = [b"longest words longest of all", b"none at all", b"", b"words1 words2", b"words2 words1"]
    hashes = word_hashes()
    together = lead_topics(Words(texts), hashes, 8)
    alone = [lead_topics(Words([t]), hashes, 8)[0] for t in texts]
    assert together.tolist() == alone and alone[1] == alone[2] == -1 and alone[3] == alone[4]


def test_odd_mixing(spark, odd_documents, no_documents):
    mixed = mix_to_targets(odd_documents, budget=1.0, power=1.0)
    rows = mixed.collect()
    assert len(rows) == odd_documents.count()
    assert all(r.selected == (r.n_tokens > 0) for r in rows)  # the corpus as it is
    assert len({r.selected for r in mix_to_targets(odd_documents).collect() if r.doc_id == 5}) == 1
    assert mix_to_targets(no_documents).collect() == [] and measured(no_documents).columns[-2:] == ["n_tokens", "topic"]


# fingerprints


def test_edited_texts_and_neighbours(spark, sf_dir, sample):
    found = {r.doc_id: r for r in op5_simhash(spark, sf_dir).collect()}
    texts = [t for _, t, _, _ in sorted(sample)]
    prints = {i: np.frombuffer(bytes.fromhex(r.fingerprint), np.uint8) for i, r in found.items()}
    for k, (i, *_) in enumerate(sorted(sample)):
        half = len(texts[k]) // 2
        edited = texts[k][: len(texts[k]) - half] + texts[(k + 1) % len(texts)][:half]
        assert found[i].n_chars == len(texts[k]) and found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if i % 20 == 0:
            assert found[i].n_near == sum(np.bitwise_count(prints[i] ^ p).sum() <= 7 for j, p in prints.items() if j != i)
    assert np.mean([r.near_edited > r.near_next for r in found.values()]) > 0.95


def test_radius_search_equals_brute_force(spark):
    rnd = random.Random(6)
    base = [rnd.getrandbits(256) for _ in range(5)]
    prints = []
    for b in base:
        for _ in range(20):
            for bit in rnd.sample(range(256), rnd.randint(0, 12)):
                prints.append(f"{b ^ (1 << bit):064x}")
            b ^= 1 << rnd.randrange(256)
            prints.append(f"{b:064x}")
    prints = sorted(set(prints))
    df = spark.createDataFrame([(p,) for p in prints] + [(None,), (prints[0],)], "fingerprint string")
    found = {(r.query, r.found, r.distance) for r in within_radius(df, df).collect()}
    apart = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    assert found == {(a, b, apart(a, b)) for a in prints for b in prints if apart(a, b) <= 7}
    with pytest.raises(ValueError):
        within_radius(df, df, radius=8)


def test_wide_radius_equals_brute_force_and_gives_neighbours(spark, sf_dir):
    found = op5_simhash(spark, sf_dir).collect()
    prints = {r.fingerprint for r in found}
    rnd = random.Random(9)
    planted = [f"{int(p, 16) ^ sum(1 << b for b in rnd.sample(range(256), rnd.randint(8, 18))):064x}" for p in sorted(prints)[:40]]
    df = spark.createDataFrame([(p,) for p in [*prints, *planted]], "fingerprint string")
    near = {(r.query, r.found) for r in within_radius(df.where(F.col("fingerprint").isin(planted)), df, radius=15, flips=1).collect()}
    apart = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    assert near == {(a, b) for a in planted for b in [*prints, *planted] if apart(a, b) <= 15} and len(near) > 60
    with pytest.raises(ValueError):
        within_radius(df, df, radius=16, flips=1)
    counts = Counter(r.fingerprint for r in found)
    for r in found:
        if r.doc_id % 20:
            assert r.n_wide is r.nearest is r.nearest_distance is None
        else:
            around = sorted((apart(r.fingerprint, p), p) for p in counts if apart(r.fingerprint, p) <= 15)
            assert r.n_wide == sum(counts[p] for _, p in around) - 1
            others = [pair for pair in around if pair[1] != r.fingerprint]
            assert (r.nearest_distance, r.nearest) == (others[0] if others else (None, None))


def test_odd_fingerprints(spark, odd_documents, no_documents):
    rows = fingerprint_documents(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    same = {r.fingerprint for r in rows if r.doc_id in (11, 12)}
    assert len(same) == 1 and {r.fingerprint for r in rows if r.doc_id in (0, 1, 2)} == {"0" * 64}
    one = fingerprint_documents(odd_documents.where("doc_id = 4")).collect()
    assert [(r.near_next, r.n_chars) for r in one] == [(1.0, 1)]
    assert fingerprint_documents(no_documents).collect() == []


# personal data


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def plain_base(text):
    found = []
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    for place, (kind, pattern, good) in enumerate(rules):
        found += [(m.start(), place, m.end(), kind) for m in re.finditer(pattern, text) if good(m)]
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


def test_formats_equal_plain_patterns(sample):
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("a1.@+- 2(") for _ in range(rnd.randint(0, 40))) for _ in range(20_000)]
    texts += [t for _, t, _, _ in sample] + ["a" * 50_000, "1" * 50_000, "1." * 20_000, "+1" * 20_000, "@" * 20_000, "4111 1111-1111 1111 x@y.z 1.2.3.256"]
    for text in texts[:-6]:
        assert base_spans(text) == plain_base(text), text
    assert [base_spans(t) for t in texts[-6:-1]] == [[]] * 2 + [base_spans(texts[-4])] + [[]] * 2
    assert [k for *_, k in base_spans(texts[-1])] == ["card", "email"]


def test_query_keeps_base(spark, sf_dir, sample):
    found = {r.doc_id: r for r in op7_personal_data(spark, sf_dir).collect()}
    for i, text, _, _ in sample:
        base = plain_base(text)
        spelled_out = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert found[i].base_sha256 == hashlib.sha256(spelled_out.encode()).hexdigest()
        assert found[i].n_card == sum(k == "card" for *_, k in base)
        assert {x for x in spelled_out.split(",") if x} <= set(found[i].spans.split(","))


def test_patterns_find_unseen_identifiers(spark):
    """Phones after "call me at" teach the pattern, which finds one in another format; numbers elsewhere are left alone."""
    rows = [(k, f"please call me at +1 (555) 010-{k:04d} or not") for k in range(8)]
    rows += [(20, "you may call me at 555-0199 today"), (21, "the year 2024-2025 had 365.25 days at 12345678"), (22, "password=hunter22")]
    rows += [(30 + k, f"password={k}f9e8d7c6b5a4{k}3f2e1d0") for k in range(6)]
    rows += [(50 + k, "one walks at home and at noon, at last") for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in find_personal_data(df).collect()}
    marked = {i: [(s.kind, dict(rows)[i][s.start : s.end]) for s in spans] for i, spans in found.items()}
    assert marked[20] == [("phone", "555-0199")] and marked[21] == [] and marked[22] == [("secret", "hunter22")]
    assert all(len(marked[k]) == 1 for k in (0, 3, 30, 35)) and marked[50] == []


def marked_in(spark, texts):
    """The added spans of each text, as text."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.base, r.spans) for r in find_personal_data(df).collect()}
    return [sorted(texts[k][s.start : s.end] for s in found[k][1] if s not in found[k][0]) for k in range(len(texts))]


def test_any_token_behind_a_learnt_pattern(spark):
    """Whatever its length and characters; taught by phones and by tokens that look random."""
    digits = [f"{k}{(k * 37) % 90 + 10}" for k in range(2, 10)]
    taught = [f"please call me at +1555{d}{d}77 soon" for d in digits]
    taught += [f"set password=aB3{d}xYz{d}QrS9tUv now" for d in digits]
    long = "q" * 150 + "7" * 173
    asked = [
        "you can call me at 9911, or not", "so call me at (johnny) today", f"use password={long} here", "use password=correcthorse here", 'use password: "x9" here',
        "call me at née@", "they call me at\n\n日本語😀 x", "please call me at +155512345678 soon", "call me at",
    ]
    clean = ["we met at noon and talked", "nothing to see here: move on", "the call was at nine", "", "a passwords list = none"]
    found = marked_in(spark, taught + asked + clean)
    assert found[len(taught) : len(taught) + len(asked)] == [["9911"], ["johnny"], [long], ["correcthorse"], ["x9"], ["née@"], ["日本語😀"], [], []]
    assert found[-len(clean) :] == [[]] * len(clean)


def test_unseen_identifiers_are_found_and_clean_texts_left_alone(spark, sample):
    """Identifiers of shapes that no format has, planted behind contexts of which seeds teach a part."""
    rng = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    filler = [text[:300] for _, text, _, _ in sample if text and not re.search(MARKED, text)][:120]
    contexts = ["my private line is", "reach the owner on", "badge number issued:", "session_token=", "api-key: "]
    texts, planted = [], []
    for k, context in enumerate(contexts * 40):
        gap = "" if context[-1] in "= " else " "
        if k % 4 < 2:
            value = f"+31{rng.integers(10**8, 10**9)}" if k % 5 < 3 else "".join(rng.permutation(letters)[:14]) + str(rng.integers(10**7, 10**8))
        else:
            value = "".join(rng.permutation(letters)[: rng.integers(3, 12)]) + str(rng.integers(10))
            planted.append((k, value))
        texts.append(f"{filler[k % len(filler)]} {context}{gap}{value} {filler[(k + 7) % len(filler)]}")
    found = marked_in(spark, texts + filler)
    caught = sum(value in found[k] for k, value in planted)
    assert caught >= 0.9 * len(planted) and len(planted) == 100
    assert sum(map(bool, found[len(texts) :])) == 0


def test_odd_personal_data(spark, odd_documents, no_documents):
    rows = find_personal_data(odd_documents).select("doc_id", spelled("spans").alias("s")).collect()
    assert len(rows) == odd_documents.count() and {r.s for r in rows} == {""}
    assert find_personal_data(no_documents).collect() == []


def test_redaction_merges_overlaps():
    assert redact("call +1 555 now", [(5, 11, "phone"), (8, 13, "card")]) == "call <PHONE>ow"


# URL rules


def plain_match(rules, host, path):
    best = None
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            order = (h.count("."), len(h), len(slash + p), verdict == BLOCK)
            if best is None or order > best[0]:
                best = (order, (rule, verdict))
    return best and best[1]


def test_trie_equals_plain_search():
    rnd = random.Random(7)
    name = lambda n: ".".join(rnd.choice(["a", "b", "com"]) for _ in range(rnd.randint(1, n)))
    path = lambda: "/" + "/".join(rnd.choice(["", "x", "xy", "y"]) for _ in range(rnd.randint(0, 3)))
    rules = [(rnd.choice([ALLOW, BLOCK]), name(3) + rnd.choice(["", path()])) for _ in range(60)]
    trie = Trie(rules)
    for _ in range(4000):
        host, where = name(4), rnd.choice(["", path()])
        assert trie.match(host, where) == plain_match(rules, host, where), (host, where)


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Net", "x://Example.NET/en/?q", "x://a.org#/fr/", "x://a.org/fr/://b", "x://net/", "x://b.net/" + "y" * 50_000]
    df = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)] + [(None, None, None)], "page_id long, url string, verdict string")
    rules = [(BLOCK, "net/"), (ALLOW, "example.net/en/"), (ALLOW, "org/fr/")]
    found = {r.page_id: (r.host, r.rule, r.verdict) for r in judge_urls(df, rules).collect()}
    assert found[None] == found[0] == found[2] == ("", None, ALLOW)
    assert found[4] == ("a.net", None, ALLOW) and found[5] == ("example.net", "example.net/en/", ALLOW)
    assert found[6][1] is None and found[7][1] == "org/fr/" and found[8][2] == found[9][2] == BLOCK
    assert split_url("a://B/c?d#e") == ("b", "/c") and judge_urls(df.where("false"), rules).count() == 0


# pipeline


def test_stages_take_effect(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(900_000, "12 34 !!", "en", "s", 8), (900_001, None, None, None, None)], docs.schema)
    docs, seen = docs.union(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in seen.items()}
    assert not {900_000, 900_001} & ids["language"]
    from test_near_dup import brute

    groups = brute([(r.doc_id, r.text) for r in seen["language"].collect()])
    assert ids["near_dedup"] == {i for i, (_, least) in groups.items() if i == least}
    assert ids["personal_data"] == ids["near_dedup"]
    assert not any(base_spans(r.text) for r in seen["personal_data"].collect())
    assert ids["mixing"] <= ids["personal_data"] and ids["tokens"] == ids["mixing"]
    assert {r.doc_id: r.decoded for r in seen["tokens"].collect()} == {r.doc_id: r.text for r in seen["mixing"].collect()}


def test_stages_on_odd_rows(spark, odd_documents, no_documents, sf_dir):
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            count = stage(spark, docs, sf_dir).count()
            assert count <= docs.count()
            if name in ("personal_data", "tokens"):
                assert count == docs.count()
    kept = corpus_pipeline.near_dedup(spark, odd_documents, sf_dir).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None and r.doc_id in (5, 11, 12, 13)) == [5, 11]


def test_of_rows_with_one_id_the_same_stays_whatever_their_order(spark):
    """Equal id and text, other source or language: the order of hashes decides; rows equal throughout are one; null ids come last."""
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text, lang, source, 5) for lang in ("en", "de", None) for source in ("a", "b", None)] * 2
    rows += [(0, "another text of seven words for once", "en", "a", 1)] * 3 + [(None, text + " end", "en", "a", 1), (None, "alone here", None, None, None), (None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    answers = set()
    for seed in range(3):
        order = np.random.default_rng(seed).permutation(len(rows))
        df = spark.createDataFrame([rows[k] for k in order], schema).repartition(seed + 1)
        kept = sorted(map(tuple, corpus_pipeline.near_dedup(spark, df, "").collect()), key=str)
        assert [row[0] for row in kept].count(1) == 1 and sorted(str(row[1])[:7] for row in kept) == ["None", "alone h", "another", "w0 w1 w"]
        answers.add(tuple(kept))
    assert len(answers) == 1
