import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchside.llm import toxicity
from tests.llm.util import frame

CLEAN = ["river", "garden", "window", "stone", "morning", "paper", "moving", "clover", "brownie", "idiom", "crown", "market", "letters", "cloud"]
BAD = ["zorgle", "blimfat", "snarvik"]


def text(rng, toxic):
    out = [" ".join(rng.choice(CLEAN) for _ in range(rng.randint(3, 9))) + "." for _ in range(rng.randint(1, 6))]
    if toxic:
        out.insert(rng.randrange(len(out) + 1), f"you {rng.choice(BAD)} {rng.choice(CLEAN)}!")
    return " ".join(out)


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(3)
    rows = [(k, text(rng, k % 4 == 0), "en", "s", 1) for k in range(400)]
    labels = [(k, 1, int(k % 4 == 0)) for k in range(300)] + [(4, 1, 0), (5, 1, None), (None, 1, 1)]
    docs = frame(spark, rows, extra=True)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return rows, docs, toxicity.train(docs, marks, F.lit(True))


def test_held_out_accuracy(model):
    rows, docs, m = model
    got = {r.doc_id: r for r in toxicity.score(docs, m).collect()}
    held = range(300, 400)
    assert np.mean([got[k].predicted == (k % 4 == 0) for k in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_gaps_and_inserted_letters_are_tolerated(model):
    _, _, m = model
    assert set(BAD) <= set(m.landmarks)
    reader = toxicity.Reader(toxicity.Kernel(m.landmarks))
    base = m.scores(["the river garden"], reader)[0]
    spoilt = m.scores(["zoorgle", "zor-gle", "z o r g l e", "blimmfat", "SNARVIK", "snarrvik"], reader)
    assert (spoilt > max(0.3, base)).all()


def test_odd_texts(spark, model):
    _, _, m = model
    odd = [(1, None), (2, ""), (3, " \n"), (4, "123 !!"), (5, "b" * 5000 + "zorgle" + "c" * 5000), (5, "zorgle"), (5, "zorgle"), (None, "ß é"), (6, "x " * 2000)]
    got = toxicity.score(frame(spark, [(*r, None, None, 1) for r in odd], extra=True), m).collect()
    assert len(got) == len(odd)
    plain = {r.doc_id: r.score for r in got}
    assert plain[1] == plain[2] == plain[3] == plain[4] < 0.3
    assert sum(r.predicted for r in got if r.doc_id == 5) >= 2


def test_without_labels_of_both_kinds(spark, model):
    _, docs, _ = model
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    m = toxicity.train(docs, none, F.lit(True))
    assert {r.score for r in toxicity.score(docs.limit(5), m).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, one, F.lit(True)).landmarks == []
    assert toxicity.score(frame(spark, []), m).collect() == []


def test_kernel_by_definition():
    from itertools import combinations

    def profile(w):
        w, out = "\x02" + w + "\x03", {}
        for a, b, c in combinations(range(len(w)), 3):
            if c - a <= toxicity.REACH:
                out[w[a], w[b], w[c]] = out.get((w[a], w[b], w[c]), 0) + toxicity.DECAY ** (c - a + 1)
        return out

    def k(s, t):
        p, q = profile(s), profile(t)
        dot = lambda x, y: sum(v * y.get(u, 0) for u, v in x.items())
        return dot(p, q) / (dot(p, p) * dot(q, q)) ** 0.5

    marks, tokens = ["idiot", "banana", "worthless"], ["idiot", "idxiot", "bananas", "worthles", "ban", "wortles", "nothing"]
    kernel = toxicity.Kernel(marks)
    place, values = kernel.values(tokens)
    found = dict(zip(place.tolist(), values))
    for n, t in enumerate(tokens):
        for j, mark in enumerate(marks):
            want = k(t, mark)
            want = want ** toxicity.POWER if want >= toxicity.FLOOR else 0
            assert found.get(n, np.zeros(3))[j] == pytest.approx(want, abs=1e-4)
