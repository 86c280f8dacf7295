"""Operator 1: language-model scoring with a probabilistic suffix tree over words.

The root is the unigram model of all training tokens with add-half smoothing.  A context of up
to ``DEPTH`` words is a state if its next-word distribution differs from that of its longest
kept suffix: count * KL >= ``divergence`` (in nats).  A state stores the next words that follow it
at least ``MIN_COUNT`` times (a context seen once cannot reach 20 nats); the rest of its mass, with
``prior`` added, goes to its suffix's distribution over the other words, so every state's
probabilities sum to one.  A token is scored by the longest suffix of its history that is a
state; the history starts with the end token of the text before.  Nothing in the model depends on
the size of the input but the counts.

Scale.  Texts become cells of some million token hashes, kept in a table bucketed by cell.  Level
by level, cells send the n-grams whose two parts are frequent enough to buckets by hash, once
each with their count, and get back a bit for each and the counts of the frequent ones; so the candidates and the states
are tables of their own, joined by key, however many there are.  What moves between cells and buckets is
sorted keys as differences and numbers as byte planes, which compress.  A cell then asks the buckets which of its
frequent n-grams are states, those of one word before the n-grams of three are judged, and gets the factors of the states for the
words they do not store; the probability of a stored word follows from counts that the cell has.  Nothing of the model is broadcast.  The n-grams of a
level are deleted when its states are written, and so are the exchanges behind them.  Words and
n-grams are compared by 64-bit hashes.

Defined cases: a null or empty text is the end token alone; a null id counts as the empty
text in the hold-out rule; repeated rows are counted and scored as often as they occur; with no
training rows every count is zero; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchside.llm.common import materialize, release, text_rows
from pitchside.session import scratch_path

DEPTH = 3             # words of a context
MIN_COUNT = 2         # of a stored next word
DIVERGENCE = 20.0     # nats
PRIOR = 1.0
CHUNK_TOKENS = 1 << 20
TEXTS_AT_ONCE = 512
TOKENS_A_BUCKET = 3 << 20   # of the text; fewer mean that cells and buckets send each other many small parts
BUCKET_TOKENS = 4 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
END = np.uint64(xxhash.xxh64_intdigest(b""))   # no word is empty
EMPTY = np.zeros(0, np.uint64)


def hashed(texts: pa.Array) -> list[np.ndarray]:
    """The token hashes of each text with an end token before (its history) and after it; a word is hashed once."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # A-Z and ASCII blanks only
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)   # bytes; ``to_pylist`` takes longer than the hashes
    at = coded.indices.to_numpy()
    doc = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())
    told = (words != b"").astype(bool)[at]    # blanks at an end of the text make empty words
    at, doc = at[told], doc[told]
    cuts = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(texts)) + 2)))
    out = np.full(cuts[-1], END, np.uint64)
    out[np.arange(len(at)) + 2 * doc + 1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))[at]
    return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def planes(x: np.ndarray) -> bytes:
    """Numbers by byte place, lowest bytes first, where the zeros of small numbers meet, and only the places that any number
    uses; compressed, as a shuffle does not give frequent bytes fewer bits.  The lower halves of long numbers have no order
    to show and stay together."""
    used = (int(np.bitwise_or.reduce(x.view(f"u{x.itemsize}"))).bit_length() + 7) // 8
    half, places, laid = 4 if used > 4 else 0, x.view(np.uint8).reshape(-1, x.itemsize), np.empty(used * len(x), np.uint8)
    laid[:half * len(x)].view(np.uint32)[:] = x.view(np.uint64) if half else 0
    for k in range(half, used):   # a place at a time: a copy of the transposed bytes goes number by number
        laid[k * len(x):(k + 1) * len(x)] = places[:, k]
    return len(x).to_bytes(7, "little") + bytes([used]) + (pa.compress(laid, codec="zstd", asbytes=True) if used else b"")


def from_planes(packed: bytes, dtype: type) -> np.ndarray:
    size, used = int.from_bytes(packed[:7], "little"), packed[7]
    out, half = np.zeros(size, dtype), 4 if used > 4 else 0
    if used:
        places = out.view(np.uint8).reshape(-1, out.itemsize)
        laid = np.frombuffer(pa.decompress(memoryview(packed)[8:], size * used, codec="zstd"), np.uint8)
        if half:
            out.view(np.uint64)[:] = laid[:half * size].view(np.uint32)
        for k in range(half, used):
            places[:, k] = laid[k * size:(k + 1) * size]
    return out


def steps(keys: np.ndarray) -> bytes:
    """Sorted unsigned keys as the first of them and planes of their differences."""
    apart = np.zeros(len(keys), np.uint64)
    np.subtract(keys[1:], keys[:-1], out=apart[1:])
    return (keys[0].tobytes() if len(keys) else bytes(8)) + planes(apart)


def from_steps(packed: bytes) -> np.ndarray:
    keys = from_planes(memoryview(packed)[8:], np.uint64)
    keys[:1] = np.frombuffer(packed, np.uint64, 1)
    return np.cumsum(keys, out=keys)


def in_order(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ascending places ``at`` by ``keys[at]``, and these keys: one sort of plain numbers, made of a key's leading bits and its
    place, is many times as fast as a sort of places."""
    low = np.uint64(len(keys).bit_length())
    mixed = keys[at]
    mixed >>= low
    mixed <<= low
    mixed |= at.view(np.uint64)
    mixed.sort()
    mixed &= (np.uint64(1) << low) - np.uint64(1)
    out = mixed.view(np.int64)
    ordered = np.take(keys, out, mode="clip")   # no place is beyond the end
    if (ordered[1:] < ordered[:-1]).any():   # keys that only differ in their last bits
        out = at[np.argsort(keys[at], kind="stable")]
        ordered = keys[out]
    return out, ordered


def firsts(ordered: np.ndarray) -> np.ndarray:
    """Whether a sorted key differs from the one before."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return new


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct keys, the first place of each and the number of each place's key, as ``np.unique`` has them."""
    at, ordered = in_order(keys, np.arange(len(keys)))
    new = firsts(ordered)
    back = np.empty(len(keys), np.int64)
    back[at] = np.cumsum(new) - 1
    return ordered[new], at[new], back


def by_count(often: np.ndarray) -> np.ndarray:
    """The numbers of words, frequent words first; of short numbers, which are sorted by their digits."""
    return np.argsort(~np.minimum(often, 0xFFFF).astype(np.uint16), kind="stable")


def _chunks(batches: Iterator[pa.RecordBatch]):
    """Token hashes of many texts at once, the row numbers' bounds, and the rows' other columns."""
    held, rows, size = [], [], 0
    for batch in batches:
        other = batch.drop_columns(["text"]).to_pylist()
        for k in range(0, batch.num_rows, TEXTS_AT_ONCE):
            for row, tokens in zip(other[k:k + TEXTS_AT_ONCE], hashed(batch["text"].slice(k, TEXTS_AT_ONCE))):
                held.append(tokens)
                rows.append(row)
                size += len(tokens)
                if size >= CHUNK_TOKENS:
                    yield held, rows
                    held, rows, size = [], [], 0
    if held:
        yield held, rows


@dataclass
class Table:
    """Values by sorted key; ``find`` gives places, -1 where a key is missing."""
    keys: np.ndarray
    n: np.ndarray

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        k = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[k] == keys, k, -1)


CELL = "cell long, tokens long, ids array<long>, words binary, often binary, at binary, size binary, train binary"
SENT = "cell long, bucket int, level int, ok binary, own binary, n binary"


def _cells(docs: DataFrame, train: Column) -> tuple[DataFrame, int]:
    """The table of cells (sorted token hashes of many texts, and the tokens as ranks by frequency) and the number of tokens."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, (held, rows) in enumerate(_chunks(batches)):
            words, _, at = distinct(np.concatenate(held))
            often = np.bincount(at)
            rank = np.empty(len(words), np.int32)
            rank[by_count(often)] = np.arange(len(words))
            yield pa.RecordBatch.from_arrays([
                pa.array([(TaskContext.get().partitionId() << 32) + k], pa.int64()), pa.array([len(at)], pa.int64()),
                pa.array([[r["doc_id"] for r in rows]], pa.list_(pa.int64())), pa.array([steps(words)], pa.binary()),
                pa.array([planes(often)], pa.binary()), pa.array([planes(rank[at])], pa.binary()), pa.array([planes(np.array([len(h) for h in held], np.int64))], pa.binary()),
                pa.array([np.array([r["train"] for r in rows], bool).tobytes()], pa.binary())],
                ["cell", "tokens", "ids", "words", "often", "at", "size", "train"])

    rows = text_rows(docs, F.coalesce(train, F.lit(False)).alias("train")).mapInArrow(run, CELL)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    path, table = scratch_path(spark, "llm", "lm_cells"), "lm_cells_" + hashlib.sha1(scratch_path(spark).encode()).hexdigest()[:16]
    (rows.write.format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(max(12, math.ceil(size / 6 / BUCKET_TOKENS)), "cell").saveAsTable(table))
    cells = spark.table(table)
    return cells, cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]


class Level:
    """The n-grams of one length in a cell: their sorted keys, the positions they end at in the order of the keys, the number of
    each position's key, and which keys are frequent.  For words, a cell has the key of each position instead."""

    def __init__(self, keys: np.ndarray, bits: int, at: np.ndarray | None = None, number: np.ndarray | None = None):
        self.keys, self.at, self.number = keys, at, number
        cuts = [0, *np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist(), len(keys)]
        self.parts = {b: slice(i, j) for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if i < j}

    @cached_property
    def first(self) -> np.ndarray:
        """A position of each n-gram."""
        return self.at[np.flatnonzero(firsts(self.number))]

    def chosen(self, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The positions that the chosen n-grams end at, in the order of the keys, and the values of these n-grams."""
        k = np.flatnonzero(keys[self.number])
        return self.at[k], values[self.number[k]]


class Cell:
    def __init__(self, t: pa.Table, sent: pa.Table, bits: int):
        self.row = {c: t[c][0].as_py() for c in t.column_names if c != "ids"}
        self.number, self.ids, self.bits = self.row["cell"], t["ids"][0].values, bits
        self.words = from_steps(self.row["words"])
        self.size = from_planes(self.row["size"], np.int64)
        self.starts = np.cumsum(self.size) - self.size
        self.sent = {}
        for row in sent.to_pylist() if sent.num_rows else []:
            self.sent.setdefault(row["level"], {})[row["bucket"]] = row

    @cached_property
    def at(self) -> np.ndarray:
        """The word of each position."""
        return by_count(from_planes(self.row["often"], np.int64))[from_planes(self.row["at"], np.int32)]

    @cached_property
    def hashes(self) -> list[np.ndarray]:
        return [self.words[self.at]]

    @cached_property
    def train(self) -> np.ndarray:
        """The positions to learn from; the first token of a text is history only."""
        out = np.repeat(np.frombuffer(self.row["train"], bool), self.size)
        out[self.starts] = False
        return out

    def hash(self, g: int) -> np.ndarray:
        """Hashes of the n-grams of g words by the position of their last word."""
        while len(self.hashes) < g:
            out = np.zeros(len(self.at), np.uint64)
            np.multiply(self.hashes[-1][:-1], BASE, out=out[1:])
            out += self.hashes[0]
            self.hashes.append(out)
        return self.hashes[g - 1]

    def learnt(self, level: Level) -> np.ndarray:
        """How often training texts have the n-grams of a level."""
        at, number = (slice(None), self.at) if level.at is None else (level.at, level.number)
        return np.bincount(number[np.flatnonzero(self.train[at])], minlength=len(level.keys))

    def counts(self, level: Level, at: np.ndarray) -> np.ndarray:
        """The counts of a level's n-grams that end at these positions; 0 where none is frequent."""
        if level.at is None:
            return level.n[self.at[at]]
        out = np.zeros(len(self.at))
        out[level.at] = level.n[level.number]
        return out[at]

    def rests(self, g: int, level: Level) -> np.ndarray:
        """What a state of g words adds to the log10 probability of a word it does not store, by key; no number: not a state."""
        out = np.full(len(level.keys), np.nan)
        for b, row in self.sent.get(-g, {}).items():
            s = level.parts[b]
            k = s.start + np.flatnonzero(level.frequent[s])
            out[k[np.unpackbits(np.frombuffer(row["ok"], np.uint8), count=len(k)).astype(bool)]] = from_planes(row["n"], np.float64)
        return out

    def levels(self, depth: int) -> Iterator[Level]:
        """Levels 1 to depth; each but the last needs the answer to it (``frequent``, ``own``, ``n``)."""
        for g in range(1, depth + 1):
            if g == 1:
                level = Level(self.words, self.bits)
            else:
                if g == 2:
                    frequent = level.frequent[self.at]
                else:
                    frequent = np.zeros(len(self.at), bool)
                    frequent[level.at] = level.frequent[level.number]
                both = frequent[1:] & frequent[:-1]
                if g == 2:   # the parts of longer n-grams tell by themselves that they are of one text
                    both[self.starts[1:] - 1] = False
                at, ordered = in_order(self.hash(g), np.flatnonzero(both) + 1)
                new = firsts(ordered)
                level = Level(ordered[np.flatnonzero(new)], self.bits, at, np.cumsum(new) - 1)
            if g in self.sent:
                level.frequent, level.own = np.zeros(len(level.keys), bool), np.zeros(len(level.keys), bool)
                level.n = np.zeros(len(level.keys))
                for b, s in level.parts.items():
                    row, size = self.sent[g][b], s.stop - s.start
                    for name in ("frequent", "own"):
                        packed = row["ok" if name == "frequent" else "own"]
                        getattr(level, name)[s] = np.unpackbits(np.frombuffer(packed, np.uint8), count=size).view(bool)
                    level.n[s if g == 1 else s.start + np.flatnonzero(level.frequent[s])] = from_planes(row["n"], np.int64)
            elif not len(level.keys):
                level.frequent = level.own = np.zeros(0, bool)
                level.n = np.zeros(0)
            yield level


def _told(cells: DataFrame, sent: DataFrame, g: int, bits: int) -> DataFrame:
    """Every cell tells each bucket its n-grams of g words, and how often training texts have them."""
    def run(t: pa.Table, sent: pa.Table) -> pa.Table:
        cell = Cell(t, sent, bits)
        *_, level = cell.levels(g)
        n = cell.learnt(level)
        return pa.table({"bucket": pa.array(list(level.parts), pa.int32()), "cell": pa.array([cell.number] * len(level.parts), pa.int64()),
                         "keys": pa.array([steps(level.keys[s]) for s in level.parts.values()], pa.binary()),
                         "n": pa.array([planes(n[s]) for s in level.parts.values()], pa.binary())})

    return cells.groupBy("cell").cogroup(sent.groupBy("cell")).applyInArrow(run, "bucket int, cell long, keys binary, n binary")


def _answered(told: DataFrame, g: int, min_count: int) -> DataFrame:
    """A bit for each n-gram that is frequent, and its count (of words, all counts); one cell owns it."""
    def run(t: pa.Table) -> pa.Table:
        keys = [from_steps(x) for x in t["keys"].to_pylist()]
        _, first, back = distinct(np.concatenate(keys))
        n = np.zeros(len(first), np.int64)
        np.add.at(n, back, np.concatenate([from_planes(x, np.int64) for x in t["n"].to_pylist()]))
        cuts = np.cumsum([0, *map(len, keys)])
        out = {"ok": [], "own": [], "n": []}
        for a, b in zip(cuts[:-1], cuts[1:]):
            mine = n[back[a:b]]
            own = (first[back[a:b]] == np.arange(a, b)) & (mine >= (1 if g == 1 else min_count))
            ok = mine >= min_count
            out["ok"].append(np.packbits(ok).tobytes())
            out["own"].append(np.packbits(own).tobytes())
            out["n"].append(planes(mine if g == 1 else mine[ok]))
        return pa.table({"cell": t["cell"], "bucket": t["bucket"], "level": pa.array([g] * len(keys), pa.int32())}
                        | {c: pa.array(v, pa.binary()) for c, v in out.items()})

    return told.groupBy("bucket").applyInArrow(run, SENT)


def _totals(sent: DataFrame) -> tuple[int, int]:
    """The number of training tokens and of distinct words in them, of the counts that the buckets told."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [from_planes(x, np.int64) for x in batch["n"].to_pylist()]
            own = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(m)) for x, m in zip(batch["own"].to_pylist(), n)]
            yield pa.RecordBatch.from_arrays([pa.array([int(m @ o) for m, o in zip(n, own)], pa.int64()), pa.array([int(o.sum()) for o in own], pa.int64())], ["n", "size"])

    row = sent.where("level = 1").select("own", "n").mapInArrow(run, "n long, size long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    return int(row[0]), int(row[1])


def _grams(cells: DataFrame, sent: DataFrame, g: int, bits: int, log_size: float, prior: float) -> DataFrame:
    """The frequent n-grams of g words, two or more: key, count, the keys without the last and without the first word, the
    count without the last word and, of up to three words, the probability of the last word after the words but the first; for those of
    three, ``sent`` has the states of one word."""
    def run(t: pa.Table, sent: pa.Table) -> pa.Table:
        cell = Cell(t, sent, bits)
        for k, level in enumerate(cell.levels(g), 1):
            if k == 1:
                words = level
            if k < g:
                before = level
        own = np.flatnonzero(level.own)
        at, none = level.first[own], np.zeros(len(own), np.int64)
        size, later = cell.counts(before, np.stack((at - 1, at)))
        q = (cell.counts(words, at) + 0.5) / 10.0 ** log_size if g <= 3 else none.astype(float)
        if g == 3:
            state = ~np.isnan(cell.rests(1, words))[cell.at[at - 1]]
            q = np.where(state, later / (cell.counts(words, at - 1) + prior), q)
        return pa.table([np.full(len(own), g), level.keys[own].view(np.int64), cell.hash(g - 1)[at - 1].view(np.int64), cell.hash(g - 1)[at].view(np.int64) if g > 3 else none,
                         level.n[own].astype(np.int64), size.astype(np.int64), q], kinds.names).cast(kinds)

    kinds = pa.schema([("level", pa.int32()), *((c, pa.int64()) for c in ("key", "ctx", "sfx", "n", "size")), ("q", pa.float64())])
    return cells.groupBy("cell").cogroup(sent.groupBy("cell")).applyInArrow(run, "level int, key long, ctx long, sfx long, n long, size long, q double")


def _states(grams: DataFrame, g: int, level: DataFrame | None, top: int, divergence: float, prior: float) -> tuple[DataFrame, DataFrame | None]:
    """The states that the n-grams of g words decide, as (key, value): what a state adds to the log10 probability of a word it does not store,
    in a folder named by g (``level``); and for the n-grams of the next length the last words' probabilities (``level``, here those of the
    length before).  What has been used is deleted."""
    whole, rest, other = F.col("size") + prior, F.col("rest"), F.col("other")
    own, used, following = grams.where(F.col("level") == g), grams, 3 <= g < top
    key = ["key"] if following else []
    if g > 3:    # the probabilities after shorter suffixes are in the level below; written, so that the join's exchanges go before the next
        own = own.select(*key, "ctx", "sfx", "n", "size").join(level.select(F.col("key").alias("sfx"), F.col("eff").alias("q")), "sfx")
        own = used = materialize(own.drop("sfx"), "lm_joined", compression="zstd")
        release(grams)
        release(level)
    # all stored next words of a context meet once: its sums and its test
    sums = {"stored": F.sum("n"), "met": F.sum("q"), "log": F.sum(F.col("n") * F.log(F.col("n") / F.col("q")))}
    if following:   # and its words' probabilities, for the next length
        of_context = Window.partitionBy("ctx")
        own = own.select("key", "ctx", "n", "size", "q").withColumns({c: x.over(of_context) for c, x in sums.items()} | {"first": F.min("key").over(of_context) == F.col("key")})
    else:
        own = own.groupBy("ctx", "size").agg(*(x.alias(c) for c, x in sums.items()))
    own = own.withColumns({"rest": 1 - F.col("stored") / whole, "other": F.greatest(1 - F.col("met"), F.lit(1e-12))})
    kl = (F.col("log") - F.col("stored") * F.log(whole)) / whole + rest * F.log(rest / other)
    own = own.withColumns({"kept": F.col("size") * kl >= divergence, "rest": F.log10(rest / other)})
    if following:
        level = materialize(own.select(
            "key", F.when(F.col("kept"), F.col("n") / whole).otherwise(F.col("q")).alias("eff"),
            *(F.when(F.col("kept") & F.col("first"), F.col(c)).alias(c) for c in ("ctx", "rest"))), "lm_level", compression="zstd")   # a state is told by one of its words
        release(used)
        own = level.where("rest IS NOT NULL")
    else:
        own = own.where("kept")
    states = materialize(own.select(F.col("ctx").alias("key"), F.col("rest").alias("value"), F.lit(g).alias("level")), "lm_values", "level", compression="zstd")
    release(*(() if following else (used,)))
    return states, level if following else None


def _asked(cells: DataFrame, sent: DataFrame, states: DataFrame, wanted: Sequence[int], bits: int) -> DataFrame:
    """For the frequent n-grams of each cell that have a wanted number of words: a bit for those that are states, and the states' values."""
    def ask(t: pa.Table, sent: pa.Table) -> pa.Table:
        cell = Cell(t, sent, bits)
        out = {"bucket": [], "cell": [], "level": [], "keys": []}
        for g, level in enumerate(cell.levels(max(wanted)), 1):
            for b, s in level.parts.items() if g in wanted else ():
                keys = level.keys[s][level.frequent[s]]
                if len(keys):
                    for c, v in zip(out, (b, cell.number, g, steps(keys))):
                        out[c].append(v)
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary())
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds)})

    def answer(asked: pa.Table, values: pa.Table) -> pa.Table:
        dealt = values.to_pylist() if values.num_rows else []
        keys, first, _ = distinct(np.concatenate([EMPTY, *[from_steps(row["keys"]) for row in dealt]]))
        table = Table(keys, np.concatenate([np.zeros(0), *[from_planes(row["values"], np.float64) for row in dealt]])[first])
        rows = {c: [] for c in ("cell", "bucket", "level", "ok", "own", "n")}
        for row in asked.to_pylist() if asked.num_rows else []:
            k = table.find(from_steps(row["keys"]))
            if (k >= 0).any():
                for c, v in zip(rows, (row["cell"], row["bucket"], -row["level"], np.packbits(k >= 0).tobytes(), b"", planes(table.n[k[k >= 0]]))):
                    rows[c].append(v)
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table({c: pa.array(v, k) for (c, v), k in zip(rows.items(), kinds)})

    asked = cells.groupBy("cell").cogroup(sent.where(F.col("level") <= max(wanted)).groupBy("cell")).applyInArrow(ask, "bucket int, cell long, level int, keys binary")
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= CHUNK_TOKENS:
                yield by_bucket(held)
                held, size = [], 0
        if held:
            yield by_bucket(held)

    def by_bucket(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        keys = t["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        value = t["value"].to_numpy()[order]
        level = Level(keys[order], bits)
        return pa.RecordBatch.from_arrays([
            pa.array(list(level.parts), pa.int32()), pa.array([steps(level.keys[s]) for s in level.parts.values()], pa.binary()),
            pa.array([planes(value[s]) for s in level.parts.values()], pa.binary())], ["bucket", "keys", "values"])

    dealt = states.select("key", "value").mapInArrow(deal, "bucket int, keys binary, values binary")
    return asked.groupBy("bucket").cogroup(dealt.groupBy("bucket")).applyInArrow(answer, SENT)


def score_corpus(docs: DataFrame, held_out: Column, depth: int = DEPTH, min_count: int = MIN_COUNT,
                 divergence: float = DIVERGENCE, prior: float = PRIOR) -> DataFrame:
    """Learn from the rows that are not held out, score all rows of ``docs(doc_id, text)``."""
    cells, tokens = _cells(docs, ~held_out)
    top, bits = depth + 1, max(6, math.ceil(math.log2(max(1, tokens / TOKENS_A_BUCKET))))
    sent = docs.sparkSession.createDataFrame([], SENT)
    for g in range(1, top + 1):
        sent = sent.unionByName(materialize(_answered(_told(cells, sent, g, bits), g, min_count), "lm_sent", compression="zstd"))
        release()
    def grams_of(g: int, sent: DataFrame) -> DataFrame:
        grams = _grams(cells, sent, g, bits, log_size, prior)
        written = materialize(grams if 3 <= g < top else grams.drop("key"), "lm_grams", "level", compression="zstd")
        release()
        return written

    def ask(states: dict[int, DataFrame]) -> DataFrame:
        told = materialize(_asked(cells, sent, reduce(DataFrame.unionByName, states.values()), list(states), bits), "lm_addends", compression="zstd")
        for table in states.values():
            release(table)
        return told

    total, known = _totals(sent)
    log_size = float(np.log10(total + 0.5 * (known + 1)))
    kept, level = _states(grams_of(2, sent), 2, None, top, divergence, prior)
    asked, states = ask({1: kept}), {}
    for g in range(3, top + 1):
        states[g - 1], level = _states(grams_of(g, sent.unionByName(asked) if g == 3 else sent), g, level, top, divergence, prior)
    if states:   # in two turns, also as what is asked takes much disk
        asked = asked.unionByName(ask(states))

    def run(t: pa.Table, sent: pa.Table) -> pa.Table:
        cell = Cell(t, sent, bits)
        for g, level in enumerate(cell.levels(top), 1):
            if g == 1:
                known, base = (level.n > 0)[cell.at], (np.log10(level.n + 0.5) - log_size)[cell.at]
                known[cell.starts], base[cell.starts] = False, 0.0   # the first token is history only
                log = np.append(base, 0.0)   # states also add to what follows the end of a text; that is struck off at last
                rest = cell.rests(1, level)[cell.at]
                after = np.flatnonzero(~np.isnan(rest)) + 1
                log[after] += rest[after - 1]
            else:
                state = np.zeros(len(log), bool)   # whether the g - 1 words before are one
                state[after] = True
                stored, value = level.frequent & state[level.first], np.zeros(len(level.keys))
                value[stored] = np.log10(level.n[stored] / (cell.counts(before, level.first[stored] - 1) + prior))
                at, value = level.chosen(stored, value)
                log[at] = value
                if g < top:
                    rest = cell.rests(g, level)
                    at, rest = level.chosen(~np.isnan(rest), rest)
                    after = at + 1
                    log[after] += rest
            before = level
        log = log[:-1]
        log[cell.starts] = 0.0
        sums = lambda x: np.add.reduceat(x, cell.starts)
        return pa.table({"doc_id": cell.ids, "n_tokens": pa.array(cell.size - 1), "n_known": pa.array(sums(known.astype(np.int64))),
                         "base_score": pa.array(sums(base)), "score": pa.array(sums(log))})

    return (cells.groupBy("cell").cogroup(sent.unionByName(asked).groupBy("cell"))
            .applyInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
            .withColumn("train_tokens", F.lit(total).cast("long")))
