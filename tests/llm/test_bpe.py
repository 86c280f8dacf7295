import hashlib
import random

import numpy as np
import pytest

from pitchside.llm import bpe
from pitchside.llm.common import tokenizer_path
from tests.llm.util import documents, frame

ALPHABET = "aab =\n\t-.e'stéü\x1c\x85\u200b1239<|endoftext|>"


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    library.no_truncation()
    library.no_padding()
    with open(tokenizer_path(), encoding="utf-8") as f:
        return library, bpe.Codec(f.read())


def expected(library, texts):
    return [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]


def test_ids_and_round_trip_equal_the_library(both):
    library, codec = both
    rng = random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 200))) for _ in range(800)]
    texts += [t or "" for _, t, *_ in documents(30)] + ["a<|endoftext|> b<|endoftext|><|endoftext|>", " <|endoftext|>  x", "x" * 5000, " " * 3000, "ab" * 9000, "I'll we've '' 12 345"]
    ids = codec.encode(texts)
    assert ids == expected(library, texts)
    assert [codec.decode(i) for i in ids] == [library.decode(np.frombuffer(i, "<u4").tolist(), skip_special_tokens=False) for i in ids]


def test_verification_agrees_with_exact_merging(both):
    _, codec = both
    rng = random.Random(2)
    words = {"".join(rng.choice("thenigsro") for _ in range(rng.randint(1, 14))) for _ in range(4000)}
    codec.cache.clear()
    failed = codec.learn(sorted(words))
    assert 0 < failed < len(words)
    assert all(codec.cache[w] == np.array(codec.merged(w.encode()), "<u4").tobytes() for w in words)


def test_documents_query(spark, both):
    library, _ = both
    rows = documents(20) + [(3, "same", None, None, 4)] * 2
    df = bpe.encode_documents(frame(spark, rows, extra=True), tokenizer_path())
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.decoded) for r in df.collect())
    want = [(d, len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(s.encode()).hexdigest(), s)
            for (d, t, *_), i in zip(rows, expected(library, [t or "" for _, t, *_ in rows]))
            for s in [library.decode(np.frombuffer(i, "<u4").tolist(), skip_special_tokens=False)]]
    assert got == sorted(want)
    assert bpe.encode_documents(frame(spark, []), tokenizer_path()).collect() == []
