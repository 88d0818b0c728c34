from collections import defaultdict
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from plumbline.llm import near_dup
from plumbline.llm.components import components
from plumbline.llm.near_dup import links_within, near_duplicates
from plumbline.llm.superminhash import signatures
from plumbline.llm.words import mix
from plumbline.sources.staging import Staging


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """id -> (set size, smallest id reachable); ids are distinct."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where, shared = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for ids in where.values():
        for a, b in combinations(sorted(ids), 2):
            shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def chains(groups=6, size=30, words=120, seed=3):
    """Near copies of near copies: similarity falls along each chain."""
    rnd = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        text = [f"w{x}" for x in rnd.integers(0, 5000, words)]
        for _ in range(size):
            text = list(text)
            for k in rnd.integers(0, words, rnd.integers(0, 6)):
                text[k] = f"z{rnd.integers(0, 5000)}"
            rows.append((len(rows), " ".join(text)))
    return rows


def answers(found):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}


def test_equals_brute_force_on_documents(spark, sample):
    rows = [(i, t) for i, t, _, _ in sample]
    assert answers(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_chains_of_copies_in_small_blocks(spark, monkeypatch):
    """Also with buckets that are cut into many blocks, and without the star rounds that spare most of the comparing."""
    rows = chains()
    df, want = spark.createDataFrame(rows, "doc_id long, text string"), brute(rows)
    assert answers(near_duplicates(df)) == want
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 4000)
    assert answers(near_duplicates(df)) == want


def test_odd_rows(spark, odd_documents):
    found = near_duplicates(odd_documents).collect()
    by_id = defaultdict(list)
    for r in found:
        by_id[r.doc_id].append(r)
    assert len(found) == odd_documents.count()
    assert by_id[13][0].component_id == by_id[12][0].component_id == 11 and not by_id[13][0].kept  # copies but for case
    assert by_id[1][0].n_shingles == 0 and by_id[1][0].component_id == 1 and by_id[1][0].kept
    assert by_id[8][0].n_shingles == 1 and by_id[9][0].n_shingles == 1
    assert len(by_id[5]) == 3 and len({(r.component_id, r.kept) for r in by_id[5]}) == 1  # repeated rows


def test_no_rows(spark, no_documents):
    assert near_duplicates(no_documents).collect() == []


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(1)
    base = mix(rnd.integers(0, 2**62, 600).astype(np.uint64))
    sets = [base[:500], base[100:], base[:3], base[:0]]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    a, b, small, empty = signatures(np.concatenate(sets), first, 512)
    assert abs((a == b).mean() - 400 / 600) < 0.08
    assert (empty == np.uint64(2**64 - 1)).all() and (small != empty).all()
    again = signatures(np.concatenate([base[:500][::-1], base[:500]]), np.array([0, 500, 1000]), 512)
    assert (again[0] == a).all() and (again[1] == a).all()  # no matter the order


def test_links_within_joins_groups_only():
    sets = [np.arange(lo, lo + 100) for lo in (0, 5, 10, 300)]
    found = links_within(sets, np.array([0, 0, 2, 3]), 75)
    assert len(found) == 1 and set(found[0]) <= {0, 1, 2}


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1001), (1001, 1002), (5000, 5001), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    found = {r.node: r.component for r in components(df, Staging(spark)).collect()}
    assert found == {**{k: 0 for k in range(1, 301)}, 1001: 1000, 1002: 1000, 5001: 5000}
    assert components(df.where("a < 0"), Staging(spark)).count() == 0
