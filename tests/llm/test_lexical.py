import math
import random
import re
from collections import Counter

import numpy as np

from pitchside.llm import lexical as L
from tests.llm.util import EXTRA, documents, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, k=20):
    docs = [(r[0], Counter(t), len(t)) for r in rows if (t := terms(r[1]))]
    n_docs, length = len(docs), sum(d[2] for d in docs)
    df = Counter(t for d in docs for t in d[1])
    out = []
    for item_id, text in set(items):
        scores = []
        for doc_id, tf, n in docs:
            m = 75 + (25 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in terms(text) if t in tf)
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def asked(spark, items, extra=False):
    return spark.createDataFrame([(*i, 1.0, 2, "c", 3, "k", 4, "l") for i in items] if extra else items, "item_id string, text string" + (EXTRA if extra else ""))


ITEMS = [("b1", "w1 w2 w3 W2 w399"), ("b2", "W5 w5 w5 nothing"), ("b3", None), ("b4", "  "), ("b5", "unheard"), ("b1", "w7 another"), ("b2", "W5 w5 w5 nothing"),
         (None, "w1 w4"), ("b6", "straße İstanbul x80 nel"), ("b7", " ".join(f"w{i}" for i in range(300)))]


def test_equals_brute_force_with_ties_and_groups(spark, monkeypatch):
    rows = documents(120) + [(500 + k, "w1 w2 tie", "en", "s", 0) for k in range(40)] + [(None, "w1 w2 tie", None, None, None), (3, "w1 w4", None, None, None)]
    want = brute(rows, ITEMS)
    plain = L.rank(frame(spark, rows, extra=True), asked(spark, ITEMS, extra=True))
    assert plain.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, plain.collect()), key=repr) == want
    for name, value in (("GROUP_BYTES", 200), ("TILE_ITEMS", 2), ("TILE_DOCS", 7), ("TILE_ENTRIES", 50), ("LANES", 3), ("EXACT", 10 ** 10)):
        monkeypatch.setattr(L, name, value)
    assert sorted(map(tuple, L.rank(frame(spark, rows), asked(spark, ITEMS)).collect()), key=repr) == want


def test_products_are_exact_beyond_double_precision():
    rng = np.random.default_rng(1)
    impact = rng.integers(0, L.TOP_IMPACT, (5, 40))
    weights = rng.integers(0, 3 * 10 ** 9, (40, 6))
    weights[3, 2] = 10 ** 11  # a term that passes the bound by itself
    assert len(L.vocabulary_parts(weights)) > 10
    assert (L.multiply(impact, weights) == impact.astype(object) @ weights.astype(object)).all()


def test_impacts_beyond_64_bits():
    n = np.array([10 ** 9, 7])
    got = L.impacts(np.array([3, 1]), n, 10 ** 12, 10 ** 20)
    assert got.tolist() == [(10 ** 9 * t) // (1000 * t + 12 * (75 + (25 * int(k) * 10 ** 12) // 10 ** 20)) for t, k in zip((3, 1), n)]


def test_empty_tables(spark):
    some = documents(5)
    for rows, items in (([], ITEMS), (some, []), ([(1, None, None, None, None)], ITEMS), (some, [("b", None)]), (some, [("b", "unheard")])):
        assert L.rank(frame(spark, rows), asked(spark, items)).collect() == []


def test_more_documents_than_ranks(spark):
    rows = [(k, "same words " * (k % 3 + 1), "en", "s", 0) for k in range(100)]
    rows += [(k, "filler text", "en", "s", 0) for k in range(100, 400)]
    items = [("i", "same")]
    assert sorted(map(tuple, L.rank(frame(spark, rows), asked(spark, items)).collect()), key=repr) == brute(rows, items)


def test_random_corpora(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(40))), "en", "s", 0) for k in range(150)]
    items = [(f"i{k}", " ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 9)))) for k in range(25)]
    assert sorted(map(tuple, L.rank(frame(spark, rows), asked(spark, items)).collect()), key=repr) == brute(rows, items)
