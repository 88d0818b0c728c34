import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from plumbline.llm.words import Words, grams, id_remainder, pieces, word_hashes


def test_words_are_runs_of_other_than_six_white_spaces():
    texts = ["", " a\x0bb ", "x\x1fy\x85z\xa0w v", "É\ta\r\nb", "\n"]
    words = Words([t.encode() for t in texts])
    want = [re.findall("[^\\x20\\x09-\\x0D]+", t) for t in texts]
    assert [w.decode() for w in words.words] == sum(want, [])
    assert words.counts.tolist() == [len(w) for w in want]
    assert [bytes(words.raw[a:b]) for a, b in zip(words.start, words.end)] == words.words
    assert words.doc.tolist() == [k for k, w in enumerate(want) for _ in w]


def test_pieces_are_bounded_and_whole():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (3, 4, 50, 0, 2)] + [None]})
    found = list(pieces(iter([batch]), "text", 8))
    assert [b.column("text").to_pylist() for b in found] == [["aaa", "aaaa"], ["a" * 50], ["", "aa", None]]


def test_grams_tell_order_and_length():
    codes = word_hashes().of([b"a", b"b", b"a", b"b", b"c"])
    two = grams(codes, 2)
    assert two[0] == two[2] and len(np.unique(two)) == 3 and len(grams(codes, 6)) == 0


def test_remainder_is_crc32_of_the_id_as_text(spark):
    rows = spark.createDataFrame([(k,) for k in range(50)] + [(None,)], "id long").select("id", id_remainder(F.col("id"), 7).alias("r"))
    assert all(r.r == zlib.crc32(b"" if r.id is None else str(r.id).encode()) % 7 for r in rows.collect())
