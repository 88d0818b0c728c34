import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm.hard_negatives import Mining, _Best, _scores, mine_hard_negatives
from plumbline.llm.queries import op13_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, anchor_id string"


def plain(rows, every, positives=5, negatives=5):
    """Every pair of rows (id, whole vector, label), sorted."""
    rows = list(dict.fromkeys((i, tuple(v), l) for i, v, l in rows if i is not None and l is not None))
    out = []
    for a in [row for row in rows if row[0] % every == 0]:
        scored = sorted((-sum(x * y for x, y in zip(a[1], b[1])), b[0], b[2] == a[2]) for b in rows if b != a)
        for p in [s for s in scored if s[2]][:positives]:
            inside = [s for s in scored if not s[2] and -5 * s[0] >= -4 * p[0] and s[0] >= p[0]]
            out += [(a[0], p[1], k + 1, n[1], -p[0], -n[0]) for k, n in enumerate(inside[:negatives])]
    return sorted(out)


def mined(df, every, **options):
    return sorted(map(tuple, mine_hard_negatives(df, F.col("vec_id") % every == 0, **options).collect()))


def test_query_equals_all_pairs(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    whole = [(r["vec_id"], [int(np.floor(256 * float(v))) for v in r["embedding"]], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in rows]
    got = sorted(map(tuple, op13_hard_negatives(spark, sf_dir).collect()))
    assert got and got == plain(whole, 100)


@pytest.mark.parametrize("seed", range(4))
def test_ties_hot_vectors_and_chunks(spark, seed):
    """Few different vectors, so most scores tie; more anchors than a chunk; several tasks."""
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-2, 4, (5, 3))
    rows = [(int(k), [float(v) for v in vectors[0 if k % 3 else rng.integers(5)]], int(rng.integers(3)), "x", "y") for k in rng.permutation(150)]
    df = spark.createDataFrame(rows + rows[:20], SCHEMA).repartition(5)
    whole = [(k, [int(v) for v in vector], label) for k, vector, label, _, _ in rows]
    assert mined(df, 6, mining=Mining(scale=1.0, chunk=10)) == plain(whole, 6)
    assert mined(df, 50, mining=Mining(positives=2, negatives=3, scale=1.0)) == plain(whole, 50, 2, 3)


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    rows = [(0, [2.0], 1, "", ""), (0, [3.0], 1, "", ""), (0, [3.0], 1, "", ""), (0, [3.0], 2, "", ""), (1, [2.0], 2, "", ""), (2, [2.5], 1, "", "")]
    assert mined(spark.createDataFrame(rows, SCHEMA), 10, mining=Mining(scale=2.0)) == plain([(i, [int(2 * x) for x in v], l) for i, v, l, _, _ in rows], 10)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 0.9], 2), (3, [1.0, -5.0], 1), (4, [1.0, -4.0], 2)]
    odd = [(None, [1.0, 1.0], 1), (5, None, 1), (6, [1.0, 1.0], None), (7, [1.0, None], 2), (8, [nan, 1.0], 2), (9, [inf, 1.0], 2)]
    df = spark.createDataFrame([(*row, "x", "y") for row in good + odd], SCHEMA).repartition(3)
    assert mined(df, 100) == [(0, 1, 1, 2, 131072, 256 * 256 + 230 * 256)]
    longer = spark.createDataFrame([(*row, "x", "y") for row in [*good, (10, [1.0, 0.95, 9.0], 2), (11, [], 2)]], SCHEMA)
    assert [row[3] for row in mined(longer, 100)] == [10, 2]
    assert mined(spark.createDataFrame([], SCHEMA), 100) == []
    assert mined(spark.createDataFrame([(*good[0], "", "")], SCHEMA), 100) == []


def test_scores_beyond_doubles_are_exact():
    x = np.array([[2.0**30, 1.0], [2.0**40, 3.0]])
    assert _scores(x, x).tolist() == [[2**60 + 1, 2**63 - 1], [2**63 - 1, 2**63 - 1]]
    assert _scores(np.array([[2.0**27 + 1]]), np.array([[2.0**27 + 1]])).tolist() == [[(2**27 + 1) ** 2]]
    mining = Mining()
    for positive in (0, 1, 4, 5, 6, 10**18 + 1, 2**63 - 1):
        low = -(-4 * positive // 5)
        assert mining.inside(positive, low) and not mining.inside(positive, low - 1)
        assert mining._low(np.array([positive])).tolist() == [low]


def test_best_keeps_the_first_of_each_slot():
    rng = np.random.default_rng(0)
    best, seen = _Best(4, 3), []
    for _ in range(30):
        slot, score, ids, mark = rng.integers(0, 4, 20), rng.integers(0, 6, 20), rng.integers(0, 99, 20), rng.integers(0, 2, 20)
        keep = best.beats(slot, score, ids)
        best.add(slot[keep], score[keep], ids[keep], mark[keep])
        seen += zip(slot.tolist(), score.tolist(), ids.tolist(), mark.tolist())
    expected = []
    for k in range(4):
        expected += sorted({s for s in seen if s[0] == k}, key=lambda s: (-s[1], s[2], s[3]))[:3]
    assert list(zip(*(a.tolist() for a in (best.slot, best.score, best.id, best.mark)))) == expected
