"""Operator 5: toxicity by a subsequence string kernel, Nystroem landmarks and a support vector machine.

The kernel of two words sums over all letter triples that both hold as a subsequence, each
occurrence weighted by decay ** span, gaps limited to ``REACH`` letters; it is normalised to 1
for equal words, so inserted, doubled or dropped letters cost little.  Letters are case- and
accent-folded, everything else inside a token is skipped, and a run of single letters counts
as one more word ("i d i o t").

Landmarks are words that labelled toxic texts use far more than clean ones, kept apart from
each other under the kernel.  A sentence's features are, per landmark, the largest kernel value
of its words (values under ``FLOOR`` count as zero, which lets an upper bound skip most
words unseen); the Nystroem map whitens them by the landmarks' own kernel.  A squared-hinge
machine is trained on sentences, which first all have their text's label; each round then keeps of
a toxic text the sentences that the machine finds toxic, its worst one at least.  A text's score is
the calibrated margin of its worst sentence.

Training uses at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled texts (those with the smallest id
hash) and their ``TOP`` strongest sentences; every text is scored whole, in one pass without a shuffle.

Defined cases: null, empty or letterless texts have no features and get the score of such a
text; several label rows of a text count as toxic if one does, null labels are ignored; with
no label, or one kind only, every text gets the smoothed share of toxic labels; repeated rows get
equal scores; tokens of any length are read whole, in overlapping pieces.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchside.llm.common import text_rows

MAX_TOXIC, MAX_CLEAN = 3000, 6000
LANDMARKS = 96
APART = 0.7          # largest kernel value between two landmarks
POWER = 3            # a power of a kernel is a kernel; it sets near words further apart
TOP = 8
DECAY, REACH, FLOOR = 0.6, 5, 0.35
COST = 10.0
HEAD, TAIL = "\x02", "\x03"   # a word's beginning and end take part in its triples
PIECE, OVERLAP = 48, 16       # a longer letter string is read in overlapping pieces
STEPS = [(a, b) for a in range(1, REACH) for b in range(1, REACH + 1 - a)]   # distances inside a triple
THRESHOLD = 0.3
REMEMBERED = 500_000          # tokens that a worker remembers before it starts afresh


@cache
def _letters() -> np.ndarray:
    """Class of each code point: a-z by folded letter 1-26, other letters 27-29, the marks that
    stand before and after a word 30 and 31, anything else 0."""
    out = np.zeros(1 << 16, np.int32)
    for cp in range(1 << 16):
        c = chr(cp)
        if c.isalpha():
            base = unicodedata.normalize("NFKD", c)[0].lower()
            out[cp] = ord(base) - 96 if "a" <= base <= "z" else 27 + cp % 3
    out[ord(HEAD)], out[ord(TAIL)] = 30, 31
    return out


@dataclass
class Words:
    """Letter classes of words, longer ones in pieces: codes padded with 0, owner of each row."""
    codes: np.ndarray
    owner: np.ndarray


def _spell(tokens: list[str]) -> list[Words]:
    """The tokens' letters, in groups of similar length so that padding stays small."""
    if not tokens:
        return []
    cp = np.frombuffer("\n".join(f"{HEAD}{w}{TAIL}" for w in tokens).encode("utf-32-le", "surrogatepass"), np.uint32)
    word = np.cumsum(cp == 10)
    cls = np.where(cp < 1 << 16, _letters()[np.minimum(cp, (1 << 16) - 1)], 0)
    word, cls = word[cls > 0], cls[cls > 0]
    size = np.bincount(word, minlength=len(tokens))
    start = np.cumsum(size) - size
    out, low = [], 4   # three letters and both marks
    for high in (7, 10, 14, 22, PIECE):
        own = np.flatnonzero((size > low) & (size <= high))
        low = high
        if len(own):
            at = start[own][:, None] + np.arange(high)
            inside = np.arange(high) < size[own][:, None]
            out.append(Words(np.where(inside, cls[np.minimum(at, len(cls) - 1)], 0), own))
    rows, own = [], []
    for w in np.flatnonzero(size > PIECE):
        for a in range(0, size[w] - OVERLAP, PIECE - OVERLAP):
            piece = cls[start[w] + a:start[w] + min(a + PIECE, size[w])]
            rows.append(np.pad(piece, (0, PIECE - len(piece))))
            own.append(w)
    if rows:
        out.append(Words(np.array(rows), np.array(own)))
    return out


def _triples(codes: np.ndarray):
    """For each gap pattern: the triple codes at every place (0 where it leaves the word) and their weight."""
    for a, b in STEPS:
        n = codes.shape[1] - a - b
        if n > 0:
            x, y, z = codes[:, :n], codes[:, a:a + n], codes[:, a + b:]
            yield np.where(z > 0, x * 1024 + y * 32 + z, 0), DECAY ** (a + b + 1)


def _profile(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse feature vectors of words: (row, triple, weight), summed over occurrences."""
    parts = [(np.repeat(np.arange(len(c)), c.shape[1]), c.ravel(), np.full(c.size, w)) for c, w in _triples(codes)]
    row, triple, weight = (np.concatenate(p) for p in zip(*parts))
    live = triple > 0
    key, back = np.unique(row[live] * 32768 + triple[live], return_inverse=True)
    return key // 32768, key % 32768, np.bincount(back, weight[live], len(key))


class Kernel:
    """Normalised kernel values of words against fixed landmark words."""

    def __init__(self, landmarks: list[str]):
        self.names = landmarks
        self.table = np.zeros((32768, len(landmarks)), np.float32)
        for group in _spell(landmarks):
            r, t, w = _profile(group.codes)
            np.add.at(self.table, (t, group.owner[r]), w)
        self.table /= np.maximum(np.sqrt((self.table.astype(float) ** 2).sum(0)), 1e-12)
        self.gate = self.table.max(1, initial=0)
        # the table's few entries by triple
        triple, self.landmark = np.nonzero(self.table)
        self.entry = self.table[triple, self.landmark].astype(float)
        self.first = np.searchsorted(triple, np.arange(32768))
        self.many = np.bincount(triple, minlength=32768)

    def values(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(place, values) of the tokens with any value of FLOOR or more; smaller values are zero."""
        place, found = [], []
        for group in _spell(tokens):
            # no landmark's kernel exceeds the sum of the triples' largest entries over the smallest own norm
            top, own = np.zeros(len(group.codes)), np.zeros(len(group.codes))
            for c, w in _triples(group.codes):
                top += w * self.gate[c].sum(1)
                own += w * w * (c > 0).sum(1)
            live = np.flatnonzero(top >= FLOOR * np.sqrt(own))
            for k in range(0, len(live), 4096):
                some = live[k:k + 4096]
                r, t, w = _profile(group.codes[some])
                norm = np.sqrt(np.bincount(r, w * w, len(some)))
                n = self.many[t]
                at = np.repeat(self.first[t] - np.cumsum(n) + n, n) + np.arange(n.sum())
                size = len(self.names)
                v = np.bincount(np.repeat(r, n) * size + self.landmark[at], np.repeat(w, n) * self.entry[at], len(some) * size)
                v = v.reshape(len(some), size).astype(np.float32)
                v /= np.maximum(norm, 1e-12)[:, None]
                v[v < FLOOR] = 0
                v **= POWER
                some_hit = v.any(1)
                place.append(group.owner[some[some_hit]])
                found.append(v[some_hit])
        if not place:
            return np.zeros(0, np.int64), np.zeros((0, len(self.names)), np.float32)
        return np.concatenate(place), np.concatenate(found)


class Numbers(dict):
    """Numbers new keys in the order in which they are asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Reader:
    """Kernel values of tokens, each worked out once while it is remembered."""

    def __init__(self, kernel: Kernel):
        self.kernel, self.width = kernel, len(kernel.names)
        self.forget()

    def forget(self) -> None:
        self.seen = Numbers()
        self.stop, self.single = np.zeros(0, bool), np.zeros(0, bool)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)   # value rows of each token
        self.values = np.zeros((0, self.width), np.float32)

    def learn(self) -> None:
        """Work out the tokens that ``seen`` has got since the last call."""
        old = len(self.stop)
        new = list(islice(self.seen, old, None))
        if not new:
            return
        place, values = self.kernel.values(new)
        order = np.argsort(place, kind="stable")
        self.first = np.concatenate((self.first, len(self.values) + np.searchsorted(place[order], np.arange(len(new)))))
        self.count = np.concatenate((self.count, np.bincount(place, minlength=len(new))))
        self.values = np.concatenate((self.values, values[order]))
        self.stop = np.concatenate((self.stop, np.fromiter((w[-1] in ".!?" for w in new), bool, len(new))))
        self.single = np.concatenate((self.single, np.fromiter((len(w) < 4 and sum(map(str.isalpha, w)) == 1 for w in new), bool, len(new))))

    def sentences(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, features) of every sentence with any feature."""
        if len(self.seen) > REMEMBERED:
            self.forget()
        number, ids, sizes = self.seen.__getitem__, [], []
        for t in texts:
            words = (t or "").lower().split()
            ids += map(number, words)
            sizes.append(len(words))
        self.learn()
        ids, owner = np.array(ids, np.int64), np.repeat(np.arange(len(texts)), sizes)
        if not len(ids):
            return np.zeros(0, np.int64), np.zeros((0, self.width), np.float32)
        new_text = np.concatenate(([False], owner[1:] != owner[:-1]))
        sentence = np.cumsum(np.concatenate(([False], self.stop[ids][:-1])) | new_text)

        # runs of three or more single letters are one more word
        edge = np.flatnonzero(np.diff(np.concatenate(([0], self.single[ids].astype(np.int8), [0]))))
        extra, where = [], []
        long = edge[1::2] - edge[::2] >= 3
        names = list(self.seen) if long.any() else []
        for a, b in zip(edge[::2][long], edge[1::2][long]):
            cuts = [a, *(np.flatnonzero(new_text[a + 1:b]) + a + 1), b]
            for x, y in zip(cuts, cuts[1:]):
                if y - x >= 3:
                    extra.append("".join(c for i in ids[x:y] for c in names[i] if c.isalpha()))
                    where.append(x)
        more = list(map(number, extra))
        self.learn()
        every, at = np.concatenate((ids, np.array(more, np.int64))), np.concatenate((np.arange(len(ids)), np.array(where, np.int64)))

        live = np.flatnonzero(self.count[every] > 0)
        every, at = every[live], at[live]
        if not len(live):
            return np.zeros(0, np.int64), np.zeros((0, self.width), np.float32)
        n = self.count[every]                         # a token read in pieces has several value rows
        rows = np.repeat(self.first[every] - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = np.repeat(at, n)
        order = np.lexsort((rows, sentence[at]))
        rows, at = rows[order], at[order]
        s = sentence[at]
        fresh = np.concatenate(([True], (s[1:] != s[:-1]) | (rows[1:] != rows[:-1])))   # a word's repeats change no maximum
        rows, at, s = rows[fresh], at[fresh], s[fresh]
        starts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        return owner[at[starts]], np.maximum.reduceat(self.values[rows], starts, axis=0)


# -- training ------------------------------------------------------------------------


def _sample(docs: DataFrame, labels: DataFrame, may_learn: Column) -> DataFrame:
    """Bounded labelled texts: (doc_id, text, toxic)."""
    marks = (labels.where(may_learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))
    first = [marks.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
             for kind, most in ((1, MAX_TOXIC), (0, MAX_CLEAN))]
    chosen = first[0].unionByName(first[1])   # at most MAX_TOXIC + MAX_CLEAN rows of two numbers
    return text_rows(docs).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def _landmarks(sample: DataFrame, toxic: int, clean: int, most: int) -> list[str]:
    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, marks = [], []
            for t, x in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                own = {"".join(filter(str.isalpha, w)) for w in t.lower().split()}
                own = [w for w in own if 4 <= len(w) <= 20]
                words += own
                marks += [x] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(marks, pa.int32())], ["word", "toxic"])

    odds = F.log((F.col("bad") + 0.5) / (toxic + 1)) - F.log((F.col("good") + 0.5) / (clean + 1))
    doubt = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    ranked = (sample.select("text", "toxic").mapInArrow(spelled, "word string, toxic int")
              .groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
              .where("bad >= 3").withColumn("weight", odds * F.sqrt("bad")).where(odds - 2 * doubt > 1.5)
              .orderBy(F.desc("weight"), "word").limit(20 * most).collect())
    words = [r["word"] for r in ranked]
    if not words:
        return []
    like = _gram(words)
    chosen: list[int] = []
    for k in range(len(words)):
        if len(chosen) < most and like[k, k] > 0.5 and (not chosen or like[k, chosen].max() < APART):
            chosen.append(k)
    return [words[k] for k in chosen]


def _gram(words: list[str]) -> np.ndarray:
    """Normalised kernel of all pairs of a short list."""
    t = Kernel(words).table
    return (t.T @ t).astype(float) ** POWER


def _fit_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine by Newton steps; the last weight is the bias."""
    x1 = np.hstack((x, np.ones((len(x), 1))))
    ridge = np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x1.shape[1])
    for _ in range(rounds):
        active = y * (x1 @ w) < 1
        xa = x1[active]
        new = np.linalg.solve(ridge + (xa * cost[active, None]).T @ xa, (xa * cost[active, None]).T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w[:-1], float(w[-1])


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic slope and offset with smoothed targets; the rarer kind weighs more, by the root of the odds."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack((margin, np.ones_like(margin)), 1)
    each = np.where(y > 0, max(n1, 1) ** -0.5, max(n0, 1) ** -0.5) * len(y) ** 0.5
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (each * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (each * (p - target)))
        w -= step
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


@dataclass
class Model:
    landmarks: list[str]
    weight: np.ndarray      # on the kernel values, the Nystroem map multiplied in
    bias: float
    slope: float
    offset: float

    def scores(self, texts: list[str], reader: Reader) -> np.ndarray:
        worst = np.full(len(texts), self.bias)     # a sentence without features
        if self.landmarks:
            owner, x = reader.sentences(texts)
            np.maximum.at(worst, owner, x @ self.weight + self.bias)
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.offset, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, landmarks: int = LANDMARKS) -> Model:
    sample = _sample(docs, labels, may_learn).persist()
    kinds = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = kinds.get(1, 0), kinds.get(0, 0)
    names = _landmarks(sample, toxic, clean, landmarks) if toxic and clean else []
    if not names:
        sample.unpersist()
        share = (toxic + 0.5) / (toxic + clean + 1)
        return Model([], np.zeros(0), 0.0, 1.0, float(np.log(share / (1 - share))))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Kernel(names))
        for batch in batches:
            owner, x = reader.sentences(batch["text"].to_pylist())
            out = []
            for k in range(batch.num_rows):
                own = x[owner == k]
                out.append(own[np.argsort(-own.sum(1), kind="stable")[:TOP]].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], pa.array(out, pa.binary())], ["doc_id", "toxic", "x"])

    rows = sorted(sample.mapInArrow(featured, "doc_id long, toxic int, x binary").collect(), key=lambda r: r["doc_id"])
    sample.unpersist()
    x = [np.frombuffer(r["x"], np.float16).reshape(-1, len(names)).astype(float) for r in rows]
    x = [a if len(a) else np.zeros((1, len(names))) for a in x]     # a text without features has one empty sentence
    y = np.array([1.0 if r["toxic"] else -1.0 for r in rows])
    return learn(names, x, y)


def _spoilt(word: str) -> list[str]:
    """The word with each inner letter doubled, and with a foreign letter put in at each inner place."""
    return [word[:k] + c + word[k:] for k in range(1, len(word)) for c in (word[k - 1], "x" if "x" not in word else "q")]


def learn(names: list[str], x: list[np.ndarray], y: np.ndarray) -> Model:
    """The machine from the sentence features of each text and the texts' signs.

    Landmarks that hardly any clean sentence holds also give virtual toxic sentences: their spoilt
    spellings, together as heavy as a third of the real ones."""
    kernel = Kernel(names)
    exact = np.concatenate([a for a, sign in zip(x, y) if sign < 0]) > 0.95
    pure = [w for w, n in zip(names, exact.sum(0)) if n <= 0.001 * (y < 0).sum()]
    virtual = kernel.values([v for w in pure for v in _spoilt(w)])[1].astype(float)
    value, vector = np.linalg.eigh(_gram(names))
    root = (vector / np.sqrt(np.maximum(value, 1e-3))) @ vector.T     # Nystroem map

    def machine(use: np.ndarray) -> tuple[np.ndarray, float]:
        clean_x = np.concatenate([x[k] for k in use if y[k] < 0])
        bags = [x[k] for k in use if y[k] > 0]
        guilty, w, b = bags, np.zeros(len(names)), 0.0
        for _ in range(5):
            toxic_x = np.concatenate(guilty)
            z = np.concatenate((toxic_x, virtual, clean_x)) @ root
            sizes = np.array([len(toxic_x), len(virtual), len(clean_x)])
            sign = np.repeat([1.0, 1.0, -1.0], sizes)
            cost = np.repeat(COST * len(z) * np.array([3 / 8, 1 / 8, 1 / 2]) / np.maximum(sizes, 1), sizes)
            w, b = _fit_svm(z, sign, cost)
            w = root @ w
            guilty = [bag[(m > 0) | (m == m.max())] for bag in bags for m in [bag @ w + b]]
        return w, b

    def margins(w: np.ndarray, b: float, use: np.ndarray) -> np.ndarray:
        return np.array([(x[k] @ w).max() + b for k in use])

    everyone, fold = np.arange(len(y)), np.arange(len(y)) % 3
    held = np.zeros(len(y))
    for f in range(3):
        rest, part = everyone[fold != f], everyone[fold == f]
        w, b = machine(rest) if (y[rest] > 0).any() and (y[rest] < 0).any() else machine(everyone)
        held[part] = margins(w, b, part)
    w, b = machine(everyone)
    return Model(names, w, b, *_calibrate(held, y))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs(doc_id, text)`` with score and predicted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Kernel(model.landmarks))
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                s = model.scores(some["text"].to_pylist(), reader)
                yield pa.RecordBatch.from_arrays([some["doc_id"], pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                                 ["doc_id", "score", "predicted"])

    return text_rows(docs).mapInArrow(run, "doc_id long, score double, predicted int")
