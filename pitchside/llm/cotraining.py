"""Operator 6: quality classification by co-training of two views.

One logistic classifier reads the text (shares of character kinds, repeated words and lines,
lengths of words and lines), the other the page's metadata (language, source, length).  Each
round both score every unlabelled row, and all rows that one is sure of join the other's training rows
with its label; a view that does no better than the share of good labels on held-out labels hands
over nothing.  At the end each view is calibrated on the held-out rows, and a last logistic
step weighs the two calibrated views; every document is scored with both in one pass without a shuffle.

Plan.  The features of all rows are written once.  A fit is Newton's method whose sums over all training
rows are taken on Spark: a task adds its rows up, sixty-four lanes add the tasks up, and the driver gets
64 short arrays a step.  Which rows a view learns from follows, row by row, from the classifiers of the
rounds before, so no state is stored and no row passes the driver.  No pool or number of pseudo-labels
is limited.  Only the final calibration reads a bounded sample: at most ``CALIBRATION`` held-out labelled rows.

Defined cases: null, empty or blank texts have all shares zero; null metadata are a kind of
their own; an unlisted source shares a hash place; several label rows of a text count as bad if
one does, null labels are ignored; without labels of both kinds every text gets the smoothed share
of good labels; repeated rows get equal scores; empty tables give no rows.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.llm.common import materialize, text_rows

CALIBRATION = 20_000      # held-out labelled rows (those of the smallest id hash) that calibrate the views
ROUNDS, SURE = 4, 0.97
HELD_OUT = 5              # one labelled id in so many is held out
STEPS, CLOSE, LONGEST = 12, 1e-4, 2.0  # of Newton's method: how many at most, the step at which it ends, the longest one
RIDGE = 1.0
LANES = 64
SOURCES, LANGS = 64, 8
KEEP = 0.5
_UPPER, _DIGIT, _SPACE = (bytes(ord(c) for c in s) for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\n\x0b\x0c"))
_LOWER, _STOP = _UPPER.lower(), b".,;:?'\"()-"
_OTHER = bytes(b for b in range(128) if b not in _UPPER + _LOWER + _DIGIT + _SPACE + _STOP)
TEXT_FEATURES, META_FEATURES = 14, LANGS + SOURCES + 3


def text_view(text: str | None) -> list[float]:
    """Features of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words, lines = raw.split(), raw.split(b"\n")
    n, w = max(len(raw), 1), max(len(words), 1)
    share = [(len(raw) - len(raw.translate(None, kind))) / n for kind in (_UPPER, _DIGIT, _SPACE, _STOP, _OTHER)]
    plain = len(raw.translate(None, bytes(range(128)))) / n
    again = sum(map(operator.eq, words, words[1:])) / w
    marked = sum(x[-1:] in (b"!", b"%", b"#", b"&", b"*", b"$", b"|") for x in words) / w
    loud = sum(x.isupper() and len(x) > 1 for x in words) / w
    return [*share, plain, again, marked, loud, len(set(words)) / w, len(raw) / w, len(set(lines)) / len(lines),
            np.log1p(len(raw)), np.log1p(len(raw) / len(lines))]


def meta_view(lang, source, n_chars) -> list[float]:
    out = [0.0] * META_FEATURES
    out[zlib.crc32(f"{lang}".encode()) % LANGS] = 1.0
    out[LANGS + zlib.crc32(f"{source}".encode()) % SOURCES] = 1.0
    size = np.log1p(max(n_chars or 0, 0))
    out[-3:] = [size / 10, (size / 10) ** 2, float(n_chars is None)]
    return out


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    cols = [batch[c].to_pylist() if c in batch.schema.names else [None] * batch.num_rows for c in ("lang", "source", "n_chars")]
    text = np.array([text_view(t) for t in batch["text"].to_pylist()]).reshape(batch.num_rows, -1)
    return text, np.array([meta_view(*m) for m in zip(*cols)]).reshape(batch.num_rows, -1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Logistic:
    """Ridge logistic regression on standardised features, with their squares where ``squares``."""
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    squares: bool = True

    def wide(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack((z, z * z / 8, np.ones((len(z), 1))) if self.squares else (z, np.ones((len(z), 1))))

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.wide(x) @ self.weight


def _newton(z: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge logistic weights (the last one, of the offset, hardly held back); steps that raise the loss are halved."""
    penalty = ridge * np.eye(z.shape[1])
    penalty[-1, -1] = 1e-6

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, z @ w).sum() - y @ (z @ w) + w @ penalty @ w / 2)

    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = _sigmoid(z @ w)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (p - y) + penalty @ w)
        while loss(w - step) > loss(w) and abs(step).max() > 1e-8:
            step = step / 2
        w = w - step
        if abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    text: Logistic | None
    meta: Logistic | None
    calibration: np.ndarray      # slope and offset of each view
    blend: np.ndarray            # weights of the calibrated views and offset
    rounds: list                 # what the views exchanged

    def probabilities(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Share of good by text, by metadata and by both."""
        if self.text is None:
            p = np.full(len(text), _sigmoid(self.blend[-1:])[0])
            return p, p, p
        (a, b), (c, d) = self.calibration
        m1, m2 = a * self.text.margin(text) + b, c * self.meta.margin(meta) + d
        return _sigmoid(m1), _sigmoid(m2), _sigmoid(self.blend[0] * m1 + self.blend[1] * m2 + self.blend[2])


@dataclass
class Round:
    """The classifiers of a round, whether each hands over its labels, and how many of each kind (bad, good) it did."""
    views: tuple[Logistic, Logistic]
    gives: tuple[bool, bool]
    handed: list[list[int]] | None = None


def learned(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, held: np.ndarray, rounds: list[Round]) -> tuple[list[np.ndarray], np.ndarray]:
    """What each view learns about rows (nan: nothing) after the ``rounds``, and what the last round handed over, by giving view and kind.

    ``y`` is 1, 0 or, for unlabelled rows, nan.  Held-out rows teach nothing."""
    own = [np.where(held, np.nan, y) for _ in views]
    left, handed = np.isnan(y), np.zeros((2, 2))
    for r in rounds:
        handed, given = np.zeros((2, 2)), np.zeros(len(y), bool)
        for v in (0, 1):
            if r.gives[v]:
                p = _sigmoid(r.views[v].margin(views[v]))
                for kind, sure in ((0, 1 - p), (1, p)):
                    rows = left & (sure >= SURE)
                    own[1 - v] = np.where(rows, float(kind), own[1 - v])
                    given |= rows
                    handed[v, kind] = rows.sum()
        left = left & ~given
    return own, handed


def sums(views: tuple[np.ndarray, np.ndarray], y: np.ndarray, held: np.ndarray, now: tuple[Logistic, Logistic], rounds: list[Round]) -> list[np.ndarray]:
    """Sums over rows: gradient and curvature of each view, what the last round handed over, and the held-out losses and counts."""
    own, handed = learned(views, y, held, rounds)
    out = []
    for x, label, f in zip(views, own, now):
        rows = ~np.isnan(label)
        z = f.wide(x[rows])
        p = _sigmoid(z @ f.weight)
        out += [z.T @ (p - label[rows]), ((z * (p * (1 - p))[:, None]).T @ z).ravel()]
    test = held & ~np.isnan(y)
    losses = []
    for x, f in zip(views, now):
        p = np.clip(_sigmoid(f.margin(x[test])), 1e-9, 1 - 1e-9)
        losses.append(-(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)).sum())
    return [*out, handed.ravel(), np.array([*losses, test.sum(), y[test].sum()])]


def co_train(total, standard: tuple[Logistic, Logistic]) -> tuple[tuple[Logistic, Logistic], list[Round]]:
    """The fitted views and the rounds.  ``total(now, rounds)`` gives ``sums`` over all rows, wherever they are."""
    now, rounds = standard, []
    for k in range(ROUNDS + 1):
        for _ in range(STEPS):
            g1, h1, g2, h2, handed, test = total(now, rounds)
            step = 0.0
            fitted = []
            for f, g, h in ((now[0], g1, h1), (now[1], g2, h2)):
                penalty = RIDGE * np.eye(len(f.weight))
                penalty[-1, -1] = 1e-6
                move = np.linalg.solve(h.reshape(penalty.shape) + penalty, g + penalty @ f.weight)
                move *= min(1.0, LONGEST / abs(move).max(initial=1e-12))
                fitted.append(replace(f, weight=f.weight - move))
                step = max(step, abs(move).max())
            now = tuple(fitted)
            if rounds:
                rounds[-1].handed = handed.reshape(2, 2).astype(int).tolist()
            if step < CLOSE:
                break
        if k == ROUNDS or rounds and not handed.any():
            break
        n, good = test[2], test[3]
        share = np.clip(good / n, 1e-9, 1 - 1e-9) if n else 0.5
        chance = -(good * np.log(share) + (n - good) * np.log(1 - share))
        rounds.append(Round(now, tuple(bool(loss < chance) for loss in test[:2])))
    return now, rounds


def calibrated(views: tuple[Logistic, Logistic], m: list[np.ndarray], y: np.ndarray, rounds: list[Round]) -> Model:
    """The model of two fitted views, from their margins on held-out rows."""
    one = np.ones(len(y))
    good = y.sum()
    y = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))  # a few rows are no certainty
    calibration = np.array([_newton(np.stack((x, one), 1), y, 1e-2) for x in m])
    both = np.stack([s * x + o for (s, o), x in zip(calibration, m)] + [one], 1)
    return Model(*views, calibration, _newton(both, y, 1e-2), rounds)


def _constant(good: float, n: float) -> Model:
    share = (good + 0.5) / (n + 1)
    return Model(None, None, np.zeros((2, 2)), np.array([0.0, 0.0, np.log(share / (1 - share))]), [])


def _matrices(batch: pa.RecordBatch) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
    views = tuple(batch[c].flatten().to_numpy().reshape(batch.num_rows, -1) for c in ("text", "meta"))
    quality = batch["quality"].to_numpy(zero_copy_only=False).astype(float)
    return views, np.where(np.isnan(quality), np.nan, (quality > 0).astype(float)), batch["held"].to_numpy(zero_copy_only=False).astype(bool)


def _added(features: DataFrame, of_rows) -> list[np.ndarray]:
    """The arrays of ``of_rows(views, y, held)`` added up over all rows: by task, by lane, and sixty-four at last."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of_rows(*_matrices(batch))
                total = part if total is None else [a + b for a, b in zip(total, part)]
        if total is not None:
            at = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([at % LANES], pa.int32()), pa.array([at], pa.int32()), pa.array([[len(t) for t in total]], pa.list_(pa.int64())),
                                              pa.array([np.concatenate(total).tobytes()], pa.binary())], ["lane", "task", "sizes", "sums"])

    def lane(t: pa.Table) -> pa.Table:
        t = t.sort_by("task")  # the same order in every run
        whole = np.sum([np.frombuffer(x, np.float64) for x in t["sums"].to_pylist()], axis=0)
        return pa.table({"lane": t["lane"][:1], "sizes": t["sizes"][:1], "sums": pa.array([whole.tobytes()], pa.binary())})

    rows = (features.select("text", "meta", "quality", "held").mapInArrow(task, "lane int, task int, sizes array<long>, sums binary")
            .groupBy("lane").applyInArrow(lane, "lane int, sizes array<long>, sums binary").collect())
    if not rows:
        return []
    whole = np.sum([np.frombuffer(r["sums"], np.float64) for r in sorted(rows, key=lambda r: r["lane"])], axis=0)
    return np.split(whole, np.cumsum(rows[0]["sizes"])[:-1])


def _spread(views, y, held) -> list[np.ndarray]:
    known = y[~np.isnan(y)]
    return [np.array([float(len(y)), len(known), known.sum()]), *[m for x in views for m in (x.sum(0), (x * x).sum(0))]]


def features_of(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None) -> DataFrame:
    """The features of every row, its quality label where it has one, and whether that is held out; written once."""
    rows = text_rows(docs, *[c for c in ("lang", "source", "n_chars") if c in docs.columns])
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marks = (marks if may_learn is None else marks.where(may_learn)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").cast("int").alias("quality"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x1, x2 = _views(batch)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(list(x1), pa.list_(pa.float64())), pa.array(list(x2), pa.list_(pa.float64()))],
                                             ["doc_id", "text", "meta"])

    # features, not texts, meet the labels
    read = rows.mapInArrow(featured, "doc_id long, text array<double>, meta array<double>")
    held = F.col("quality").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0)
    return materialize(read.join(marks, "doc_id", "left").withColumn("held", held), "quality_features")


def train(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None) -> Model:
    """The model from ``docs(doc_id, text, lang, source, n_chars)`` and ``labels(doc_id, quality)``; its ``rounds`` say what was exchanged."""
    features = features_of(docs, labels, may_learn)
    first = _added(features, _spread)
    if not first:
        return _constant(0, 0)
    (n, known, good), *moments = first
    kinds = {(r["held"], r["quality"] > 0): r["count"] for r in features.where("quality IS NOT NULL").groupBy("held", "quality").count().collect()}
    if any(kinds.get((h, k), 0) < least for h, least in ((False, 4), (True, 1)) for k in (False, True)):
        return _constant(good, known)
    standard = []
    for (s, ss), squares in zip((moments[:2], moments[2:]), (True, False)):
        mean = s / n
        width = len(mean) * (2 if squares else 1) + 1
        standard.append(Logistic(mean, np.maximum(np.sqrt(np.maximum(ss / n - mean * mean, 0)), 1e-3), np.zeros(width), squares))
    views, rounds = co_train(lambda now, rounds: _added(features, lambda x, y, held: sums(x, y, held, now, rounds)), tuple(standard))

    test = (features.where("held").orderBy(F.xxhash64(F.lit("calibration"), "doc_id"), "doc_id").limit(CALIBRATION)
            .select("text", "meta", (F.col("quality") > 0).cast("double").alias("y")).toArrow())
    x = [np.array(test[c].to_pylist()) for c in ("text", "meta")]
    return calibrated(views, [f.margin(v) for f, v in zip(views, x)], test["y"].to_numpy(), rounds)


def score(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """doc_id, text_score, meta_score, score (share of good) and keep, for every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p1, p2, p = model.probabilities(*_views(batch))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(p1), pa.array(p2), pa.array(p), pa.array(p >= keep)],
                                             ["doc_id", "text_score", "meta_score", "score", "keep"])

    rows = text_rows(docs, *[c for c in ("lang", "source", "n_chars") if c in docs.columns])
    return rows.mapInArrow(run, "doc_id long, text_score double, meta_score double, score double, keep boolean")


def keep_good(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` that the model keeps, with all their columns; one pass, no join."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.probabilities(*_views(batch))[2] >= keep))

    return docs.mapInArrow(run, docs.schema)
