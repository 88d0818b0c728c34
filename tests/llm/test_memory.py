"""Memory of coding texts."""

import random
import tracemalloc

import public_tokenizers
from plumbline.llm.sentencepiece_bpe import Encoder, Vocabulary, read_model


def test_merging_many_new_segments_is_bounded():
    rnd = random.Random(1)
    text = " ".join("".join(rnd.choices("abcdefghij", k=8)) for _ in range(200_000))
    encoder = Encoder(Vocabulary.from_bytes(read_model(public_tokenizers.path("piece_bpe_32k.model"))))
    tracemalloc.start()
    encoder.encode([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20
