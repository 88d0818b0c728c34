"""How the class model reads its texts, and how words move."""

import numpy as np
from plumbline.llm.brown import best_classes, class_scores
from pyspark.sql import functions as F


def test_texts_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        read.add(1)
        return text

    rows = [(k, f"the n{k % 7} will v{k % 5} w{k}", k % 3 == 0) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held boolean").withColumn("text", seen.asNondeterministic()("text"))
    found = class_scores(df, ~F.col("held"), vocabulary=5, frequent=8, groups=3, classes=4).collect()
    assert len(found) == 60 and read.value == 60
    assert {(r.doc_id, r.held_out, r.n_tokens, r.n_known) for r in found} == {(k, k % 3 == 0, 6, 5 if k % 3 == 0 else 6) for k in range(60)}


def plain_gains(owner, code, n, label, between):
    """For each word and class, by how much the likelihood grows when the word is counted there."""
    classes, entropy = len(between), lambda x: x * np.log(np.maximum(x, 1))
    gains = np.zeros((len(label), classes))
    for word, old in enumerate(label):
        for after in (True, False):
            counts = between if after else between.T
            some = [(c % classes, m) for w, c, m in zip(owner, code, n) if w == word and (c // classes == 2) == after]
            total = sum(m for _, m in some)
            for k in range(classes):
                for other, m in some:
                    rest = counts[k, other] - (m if k == old else 0)
                    gains[word, k] += entropy(rest + m) - entropy(rest)
                rest = counts[k].sum() - (total if k == old else 0)
                gains[word, k] -= entropy(rest + total) - entropy(rest)
    return gains


def test_words_move_to_the_class_of_most_gain():
    rnd, classes, words = np.random.default_rng(5), 6, 40
    found = {(int(w), int(c)): int(m) for w, c, m in zip(rnd.integers(0, words, 200), rnd.integers(0, 3 * classes, 200), rnd.integers(1, 12, 200))}
    found |= {(w, 2 * classes): 1 for w in range(words)}  # each word has a neighbour
    owner, code = (np.array(x) for x in zip(*sorted(found)))
    n, label = np.array([found[key] for key in sorted(found)]), rnd.integers(0, classes, words)
    between = rnd.integers(500_000, 900_000, (classes, classes)).astype(float)  # all words together are less than a thousandth
    gains = plain_gains(owner, code, n, label, between)
    best = gains.argmax(axis=1)
    want = np.where(gains[np.arange(words), best] > gains[np.arange(words), label] + 1e-6, best, label)
    assert (best_classes(owner, code, n, label, between.copy()) == want).all() and (want != label).any()
