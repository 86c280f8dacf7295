import random

import numpy as np
import pytest

from pitchside.llm import cotraining
from pitchside.llm import cotraining as c
from tests.llm.util import frame


def text(rng, good):
    words = ["".join(rng.choice("abcdeio") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 90))]
    return " ".join(words) + "." if good else " ".join(w + rng.choice(["%%%", "!!", " |"]) for w in words)


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(4)
    good = [rng.random() < 0.75 for _ in range(500)]
    rows = [(k, t, "en" if g else rng.choice(["en", "xx"]), f"s{rng.randint(0, 5)}", len(t)) for k, g in enumerate(good) for t in [text(rng, g)]]
    labels = spark.createDataFrame([(k, int(good[k]), 0) for k in range(250)] + [(7, None, 0), (None, 1, 0), (8, int(good[8]), 0)],
                                   "doc_id long, quality int, toxic int")
    docs = frame(spark, rows, extra=True)
    return good, docs, cotraining.train(docs, labels), labels


def test_held_out_accuracy_and_columns(made):
    good, docs, model, _ = made
    got = {r.doc_id: r for r in cotraining.score(docs, model).collect()}
    assert np.mean([got[k].keep == good[k] for k in range(250, 500)]) >= 0.99
    kept = cotraining.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, r in got.items() if r.keep)


def local(x1, x2, y, held):
    """Co-training written out on arrays in memory: the sums are taken at once, over all rows."""
    views = [x1, x2]
    flat = [c.Logistic(x.mean(0), np.maximum(x.std(0), 1e-3), np.zeros(x.shape[1] * (2 if s else 1) + 1), s) for x, s in zip(views, (True, False))]
    fitted, rounds = c.co_train(lambda now, past: c.sums((x1, x2), y, held, now, past), tuple(flat))
    test = held & ~np.isnan(y)
    return c.calibrated(fitted, [f.margin(x[test]) for f, x in zip(fitted, views)], y[test], rounds)


def two_views(seed=0, n=3000, known=120):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n).astype(float)
    x1 = np.stack((2 * y + rng.normal(0, 0.7, n), rng.normal(size=n)), 1)
    x2 = np.stack((2 * y + rng.normal(0, 0.7, n), rng.normal(size=n)), 1)
    given = np.where(np.arange(n) < known, y, np.nan)
    return x1, x2, y, given, np.arange(n) % 5 == 0


def test_views_exchange_pseudo_labels_both_ways():
    x1, x2, y, given, held = two_views()
    model = local(x1, x2, given, held & ~np.isnan(given))
    assert len(model.rounds) >= 2 and all(sum(side) > 0 for side in model.rounds[0].handed)
    one, two, both = model.probabilities(x1[1500:], x2[1500:])
    right = [np.mean((p > 0.5) == y[1500:]) for p in (one, two, both)]
    assert right[2] >= max(right[:2]) and right[2] > 0.93


def test_rows_are_handed_over_as_written():
    """Every round: what a view is sure of joins the other's rows, once, and never a labelled or held-out row."""
    x1, x2, _, given, held = two_views(3)
    held &= ~np.isnan(given)
    rounds = local(x1, x2, given, held).rounds
    teach, free = [np.where(held, np.nan, given) for _ in (0, 1)], set(np.flatnonzero(np.isnan(given)))
    for r in rounds:
        sure = [{}, {}]
        for v, x in ((0, x1), (1, x2)):
            for i in free:
                p = 1 / (1 + np.exp(-r.views[v].margin(x[i:i + 1])[0]))
                if r.gives[v] and max(p, 1 - p) >= c.SURE:
                    sure[v][i] = float(p > 0.5)
        for v in (0, 1):
            for i, kind in sure[v].items():
                teach[1 - v][i] = kind
            assert r.handed[v] == [sum(k == 0 for k in sure[v].values()), sum(k == 1 for k in sure[v].values())]
        free -= set(sure[0]) | set(sure[1])
    own, _ = c.learned((x1, x2), given, held, rounds)
    assert all(np.array_equal(a, b, equal_nan=True) for a, b in zip(own, teach))


def test_a_view_that_knows_nothing_hands_over_nothing():
    x1, _, _, given, held = two_views(1)
    noise = np.random.default_rng(9).normal(size=x1.shape)
    model = local(x1, noise, given, held & ~np.isnan(given))
    assert all(not any(r.handed[1]) for r in model.rounds) and sum(model.rounds[0].handed[0]) > 0


def test_calibration_of_a_few_separable_rows_stays_finite():
    for m in (np.array([-9.0, -8.5, 30.0, 41.0]), np.array([1e3, 1.1e3, 4e3, 9e3])):
        a, b = c._newton(np.stack((m, np.ones(4)), 1), np.array([0.25, 0.25, 0.75, 0.75]), 1e-2)
        p = c._sigmoid(a * m + b)
        assert a > 0 and (p[:2] < 0.5).all() and (p[2:] > 0.5).all()


def test_on_spark_as_in_memory(made):
    good, docs, model, labels = made
    rows = c.features_of(docs, labels).collect()
    y = np.array([np.nan if r["quality"] is None else float(r["quality"] > 0) for r in rows])
    held = np.array([r["held"] for r in rows])
    assert held.sum() > 20 and not held[np.isnan(y)].any() and np.isnan(y).sum() == len(rows) - 250
    want = local(np.array([r["text"] for r in rows]), np.array([r["meta"] for r in rows]), y, held)
    assert [r.handed for r in model.rounds] == [r.handed for r in want.rounds] and sum(map(sum, model.rounds[0].handed)) > 200
    for a, b in ((model.text, want.text), (model.meta, want.meta)):
        assert np.allclose(a.weight, b.weight, atol=1e-5)
    assert np.allclose(model.calibration, want.calibration, atol=1e-4) and np.allclose(model.blend, want.blend, atol=1e-4)


def test_odd_rows_and_few_labels(spark, made):
    _, docs, model, _ = made
    odd = [(1, None, None, None, None), (2, "", "", "", 0), (3, "  \n", "q", "new", -5), (None, "x" * 9000, None, None, 9000), (4, "a a", "en", "s1", 3), (4, "a a", "en", "s1", 3)]
    got = cotraining.score(frame(spark, odd, extra=True), model).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    assert cotraining.score(frame(spark, []), model).collect() == []
    bare = cotraining.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert {round(r.score, 6) for r in cotraining.score(docs.limit(3), bare).collect()} == {0.75}
    # without metadata columns the second view sees nulls
    assert cotraining.score(frame(spark, odd).select("doc_id", "text"), model).count() == len(odd)
