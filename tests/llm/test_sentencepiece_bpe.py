import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from plumbline.llm.queries import op4_sentencepiece
from plumbline.llm.sentencepiece_bpe import Decoder, Encoder, Vocabulary, decode, encode, read_model

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.from_bytes(read_model(PATH))


def same(library, vocabulary, texts):
    flat, first = Encoder(vocabulary).encode(texts)
    decoded = Decoder(vocabulary).decode(flat.astype(np.int64), first)
    for k, text in enumerate(texts):
        ids = library.encode(text)
        assert flat[first[k] : first[k + 1]].tolist() == ids, text[:80]
        assert decoded[k] == library.decode(ids), text[:80]


def test_odd_texts(library, vocabulary):
    same(library, vocabulary, [
        "", "a", " ", "  a", "\n", "a\n b", "▁x", "日本語 😀", "a" * 24, "the" + " " * 20 + "end", "<s></s><0x0A>", "\x00a\x00", "é" * 50, "ab" * 1000,
    ])


def test_long_words(library, vocabulary):
    """On both sides of the length from which a queue merges them; words that need as many rounds as letters end in seconds."""
    rnd = random.Random(4)
    letters = lambda n, of="abcdefghijklmnopqrstuvwxyz": "".join(rnd.choices(of, k=n))
    texts = [letters(n) for n in (500, 511, 512, 513, 514, 600, 5_000)]
    texts += [letters(n, "ab") for n in (511, 513, 4_000)] + [letters(3_000, "aé日x😀1"), "na" * 700, "x" * 1_025, letters(900, "the an")]
    texts.append(base64.b64encode(rnd.randbytes(9_000)).decode())
    texts.append("".join(rnd.choices(["这是", "一个", "没有", "空格", "的", "文本", "。", "あ", "い"], k=4_000)))
    texts.append(f"before {letters(2_000)} between {letters(300)} after")
    same(library, vocabulary, texts)
    same(library, vocabulary, [letters(160_000)])


def test_random_texts(library, vocabulary):
    rnd = random.Random(1)
    letters, words = "abcdeinorst  .é\n▁日0123", vocabulary.pieces[259:]
    same(library, vocabulary, ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 200))) for _ in range(2000)])
    same(library, vocabulary, ["".join(rnd.choice("aeinrst") for _ in range(3000)) for _ in range(10)])  # merges that overlap and tie
    same(library, vocabulary, ["".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))).replace("▁", " ") for _ in range(2000)])


def test_decoding_any_ids(library, vocabulary):
    rnd, decoder = random.Random(2), Decoder(vocabulary)
    for _ in range(2000):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(259), rnd.randrange(131, 259)]) for _ in range(rnd.randint(0, 12))]
        assert decoder.decode(np.array(ids, np.int64), np.array([0, len(ids)]))[0] == library.decode(ids), ids


def test_query(spark, sample, library, sf_dir):
    found = {r.doc_id: r for r in op4_sentencepiece(spark, sf_dir).collect()}
    assert len(found) == len(sample)
    for i, text, _, _ in sample:
        ids = library.encode(text) + [2]
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(spark, odd_documents, no_documents, library):
    model = read_model(PATH)
    coded = decode(encode(odd_documents, model), model)
    rows = coded.collect()
    assert len(rows) == odd_documents.count() and set(coded.columns) == {*odd_documents.columns, "decoded"}
    for r in rows:
        assert r.ids == library.encode(r.text or "") + [2] and r.decoded == (r.text or "").replace("▁", " ")
    assert decode(encode(no_documents, model), model).collect() == []
