"""Operator 9: removal of repeated passages by a hash-compared suffix sort.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts in a document with a
smaller id.  Strings are judged on the input, so removals do not depend on each other.

Which suffixes are sorted.  Sorting the suffixes at all positions would move the corpus many
times over.  Every window of 50 bytes therefore names the positions in it whose 24-byte gram has
the smallest hash (its anchors, about one position in thirteen); equal windows name the same
anchors at the same places, so a window can only repeat where its anchors do.  Anchors that
occur in one document are dropped after an exchange of 32-bit hash remainders.  For the others
the surrounding 76 bytes (every window with that anchor) are dealt out by the anchor's hash,
and there the suffixes at the window starts are sorted.

The sort.  Prefix polynomial hashes of the gathered bytes give the hash of any substring in one
step.  Two suffixes are compared by a binary search for their common extension, then by one
byte; a bottom-up mergesort places the elements of neighbouring runs by binary search with that
comparison, all groups at once.  Neighbours whose extension reaches 50 bytes are verified
byte by byte before they count as equal; the smallest id of each run of equal windows decides.

Scale.  Documents are laid out once as a table bucketed by small cells (by rows and by bytes), so their texts
are never shuffled; hashes, contexts and spans go to the cells instead, as packed arrays.
Exact copies are found by their digest first.  Close anchors of a text with equal contexts, as in a run of one
byte, are one record.  An anchor with more than ``HOT`` occurrences is not gathered in one task: each cell opens its
contexts into their windows and sends every different one once, with the smallest document that has it there, to the
bucket of the window's own hash, where the same sort and verification say whether another cell has it in an earlier
document; the cell applies the answer to its own occurrences.  So what meets in a task follows the cells, not the occurrences.

Defined cases: null and empty texts have no bytes; texts shorter than a window lose nothing; rows
that share an id never remove each other; a null id counts as larger than any other; an empty
table gives no rows; a cut inside a character leaves the digest's bytes as they are, while the
deduplicated text drops the broken character.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitchside.llm.common import materialize
from pitchside.session import scratch_path

WINDOW, GRAM = 50, 24
LEFT = WINDOW - GRAM                  # bytes before an anchor that a window can hold
WIDTH = LEFT + WINDOW
CELL_BITS = 11                        # rows of one cell: at most 2048
CELL_BYTES = 16 << 20                 # of one cell's texts, or a single longer text
PIECE = 1 << 22                       # bytes or anchors of a cell that are looked at once
ANCHORS_A_BUCKET = 1 << 17
ELEMENTS = 1 << 17                    # windows that are sorted at once
RECORDS = 1 << 14                     # contexts that are resolved at once, if no anchor has more
HOT = 20_000                          # occurrences of an anchor that are gathered as contexts (about 2 MB), not as windows by cell
COPIES, HITS, OPENED = -1, -2, -10    # what a payload is where its bucket says no bucket; anchors to open: OPENED - bucket
BUCKET_BYTES = 32 << 20
BASE = 0x9E3779B97F4A7C15             # odd, so it has an inverse modulo 2**64
NO_ID = (1 << 63) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads all bits (the low bits of a polynomial hash modulo 2**64 are weak)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, b in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            _POWERS[name] = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))))
    return _POWERS["up"], _POWERS["down"]


class Hashes:
    """Prefix polynomial hashes of a byte string: the hash of any substring in one step."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)])))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start])


def _slide(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over every run of w neighbours."""
    out, s = x, 1
    while 2 * s <= w:
        out = f(out[:-s], out[s:])
        s *= 2
    n = len(x) - w + 1
    return f(out[:n], out[w - s:w - s + n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions that some window names, and the hashes of their grams."""
    if len(data) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) > 2 * PIECE:   # by the windows that start in each piece
        found = [(k + at, h) for k in range(0, len(data) - WINDOW + 1, PIECE) for at, h in [anchors(data[k:k + PIECE + WINDOW - 1])]]
        at, h = (np.concatenate(x) for x in zip(*found))
        at, first = np.unique(at, return_index=True)
        return at, h[first]
    at = np.arange(len(data) - GRAM + 1)
    h = Hashes(data).of(at, at + GRAM)
    w = WINDOW - GRAM + 1
    least = _slide(h, w, np.minimum)
    edge = np.zeros(w - 1, np.uint64)
    named = np.flatnonzero(_slide(np.concatenate((edge, least, edge)), w, np.maximum) == h)
    return named, h[named]


# -- the suffix sort -------------------------------------------------------------------


class Suffixes:
    """Suffixes of a byte string, compared on their first ``WINDOW`` bytes."""

    def __init__(self, data: np.ndarray):
        self.data, self.hashes, self.comparisons = data, Hashes(data), 0

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning, at most WINDOW: binary search on prefix hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), WINDOW, np.int64)
        while (open_ := low < high).any():
            half = (low + high + 1) // 2
            same = self.hashes.of(a, a + half) == self.hashes.of(b, b + half)
            low, high = np.where(open_ & same, half, low), np.where(open_ & ~same, half - 1, high)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before b; for equal ones, ``or_equal``."""
        self.comparisons += len(a)
        n = self.extension(a, b)
        at = np.minimum(n, WINDOW - 1)
        return np.where(n == WINDOW, or_equal, self.data[a + at] < self.data[b + at])

    def sort(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of suffixes within their groups (``group`` ascending): a stable mergesort of all groups at once."""
        order = np.arange(len(start))
        first = np.searchsorted(group, group)
        last = np.searchsorted(group, group, side="right")
        size, run = int((last - first).max(initial=0)), 1
        place = np.arange(len(start))
        while run < size:
            block = (place - first) // run
            own_low = first + block * run
            other_low = np.where(block % 2 == 0, own_low + run, own_low - run)
            other_high = np.minimum(other_low + run, last)
            live = np.flatnonzero(other_low < last)          # a run without a partner stays
            low, high = other_low[live].copy(), other_high[live].copy()
            mine, is_right = start[order[live]], block[live] % 2 == 1
            while (todo := np.flatnonzero(low < high)).size:
                middle = (low[todo] + high[todo]) // 2
                # how many of the other run come first: ties keep the left run in front
                ahead = self.before(start[order[middle]], mine[todo], is_right[todo])
                low[todo] = np.where(ahead, middle + 1, low[todo])
                high[todo] = np.where(ahead, high[todo], middle)
            base = np.minimum(own_low[live], other_low[live])
            to = base + (place[live] - own_low[live]) + (low - other_low[live])
            new = order.copy()
            new[to] = order[live]
            order, run = new, 2 * run
        return order

    def equal_runs(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """A number for each suffix, the same for suffixes of a group with equal first WINDOW bytes."""
        order = self.sort(start, group)
        s, g = start[order], group[order]
        near = np.flatnonzero(g[1:] == g[:-1])
        near = near[self.extension(s[near], s[near + 1]) == WINDOW]
        same = np.zeros(len(s), bool)
        for k in range(0, len(near), 1 << 16):       # verification of what the hashes say
            part = near[k:k + (1 << 16)]
            step = np.arange(WINDOW)
            same[part + 1] = (self.data[s[part][:, None] + step] == self.data[s[part + 1][:, None] + step]).all(1)
        out = np.empty(len(s), np.int64)
        out[order] = np.cumsum(~same)
        return out


def _earlier(text: Suffixes, element: np.ndarray, offset: np.ndarray, kind: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Places of the windows (element, offset) that an element of a smaller document also has."""
    start = element * WIDTH + LEFT - offset
    group = kind[element] * (LEFT + 1) + offset
    # a window alone in its group by its hash cannot be equal to another
    key = mix(text.hashes.of(start, start + WINDOW) ^ mix(group.astype(np.uint64)))
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    live = np.flatnonzero(times[back] > 1)
    if not len(live):
        return live
    live = live[np.argsort(group[live], kind="stable")]
    run = text.equal_runs(start[live], group[live])
    first = np.full(int(run.max()) + 1, NO_ID, np.int64)
    np.minimum.at(first, run, least[element[live]])
    return live[first[run] < least[element[live]]]


def resolve(h: np.ndarray, doc: np.ndarray, left: np.ndarray, right: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered ranges (record, from, to) relative to each record's anchor.

    Records: anchor hash, document, bytes before and from the anchor (at most LEFT and WINDOW) and
    the context matrix, anchors at column LEFT, zero outside."""
    n = len(h)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    # equal contexts: one entry with the smallest document
    shape = np.concatenate((context, left[:, None].astype(np.uint8), right[:, None].astype(np.uint8)), 1)
    _, pick, ctx = np.unique(np.ascontiguousarray(shape).view(f"V{WIDTH + 2}").ravel(), return_index=True, return_inverse=True)
    least = np.full(len(pick), NO_ID, np.int64)
    np.minimum.at(least, ctx, doc)
    own_h = h[pick]
    whole = np.flatnonzero((doc > least[ctx]) & (left.astype(int) + right >= WINDOW))
    out = [(whole, -left[whole].astype(np.int64), right[whole].astype(np.int64))]

    # windows of anchors with several contexts
    _, kind, count = np.unique(own_h, return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[kind] > 1)
    l, r = left[pick].astype(np.int64), right[pick].astype(np.int64)
    low, high = np.maximum(0, WINDOW - r[several]), l[several]
    if len(several):
        text, found = Suffixes(np.ascontiguousarray(context[pick]).ravel()), []
        # windows at different offsets are different groups, so a few offsets at a time bound the memory
        step = max(1, ELEMENTS // len(several))
        for o in range(0, LEFT + 1, step):
            first_o, last_o = np.maximum(low, o), np.minimum(high, o + step - 1)
            size = np.maximum(last_o - first_o + 1, 0)
            element = np.repeat(several, size)
            offset = np.repeat(first_o, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            hit = _earlier(text, element, offset, kind, least)
            found.append((element[hit], offset[hit]))
        element, offset = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((offset, element))
        element, offset = element[order], offset[order]
        if len(element):
            turn = np.concatenate(([True], (element[1:] != element[:-1]) | (offset[1:] != offset[:-1] + 1)))
            at = np.flatnonzero(turn)
            end = np.concatenate((at[1:], [len(element)])) - 1
            owner, a, b = element[at], -offset[end], WINDOW - offset[at]
            # the ranges of a context hold for each of its records in its first document
            firsts = np.flatnonzero(doc == least[ctx])
            order = np.argsort(ctx[firsts], kind="stable")
            firsts = firsts[order]
            lo, hi = (np.searchsorted(ctx[firsts], owner, side=s) for s in ("left", "right"))
            times = hi - lo
            record = firsts[np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
            out.append((record, np.repeat(a, times), np.repeat(b, times)))
    return tuple(np.concatenate(x) for x in zip(*out))


# -- cells ------------------------------------------------------------------------------

RECORD = [("h", np.uint64), ("doc", np.int64), ("cell", np.int64), ("pos", np.int32), ("last", np.int32), ("row", np.uint16), ("left", np.uint8), ("right", np.uint8)]
SPAN = np.dtype([("start", np.int32), ("size", np.int32), ("row", np.uint16)])


def _packed(cols: dict[str, list], types: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({c: pa.array(v, types[c]) for c, v in cols.items()})


class Cell:
    """The rows of one cell and what was sent to it."""

    def __init__(self, docs: pa.Table, sent: pa.Table, text: str, row: str, key: str, skip_copies: bool = True):
        self.row = docs[row].to_numpy()
        self.doc = docs[key].to_numpy()
        self.text = [t or b"" for t in docs[text].cast(pa.large_binary()).to_pylist()]
        self.sent = list(zip(sent["bucket"].to_pylist(), sent["payload"].to_pylist())) if sent.num_rows else []
        self.flat, self.copies = None, set()
        for bucket, payload in self.sent:
            if bucket == COPIES:
                self.copies.update(np.frombuffer(payload, np.uint16).tolist())

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the row, position, hash) of all anchors of rows that are no copies."""
        found = [(np.full(len(p), k), p, h) for k, t in enumerate(self.text) if int(self.row[k]) not in self.copies
                 for p, h in [anchors(np.frombuffer(t, np.uint8))]]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(x) for x in zip(*found))

    def merged(self, k: np.ndarray, pos: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Anchors that stand for themselves and those after them, and the last position of each: the same
        text, hash and context, no more than a window apart, so what they cover is one stretch."""
        heads, lasts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a in range(0, len(k), PIECE):
            part = np.arange(a, min(a + PIECE, len(k)))
            part = part[np.lexsort((pos[part], h[part], k[part]))]
            one, two = part[:-1], part[1:]
            near = np.flatnonzero((k[one] == k[two]) & (h[one] == h[two]) & (pos[two] - pos[one] <= WINDOW))
            follows = np.zeros(len(part), bool)
            for b in range(0, len(near), RECORDS):
                some = near[b:b + RECORDS]
                x, y = (self.contexts(k[e[some]], pos[e[some]]) for e in (one, two))
                follows[some + 1] = (x[0] == y[0]) & (x[1] == y[1]) & (x[2] == y[2]).all(1)
            head = np.flatnonzero(~follows)
            heads.append(part[head])
            lasts.append(pos[part[np.concatenate((head[1:], [len(part)])) - 1]])
        return np.concatenate(heads), np.concatenate(lasts)

    def contexts(self, k: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(left, right, matrix) around anchors."""
        if self.flat is None:
            self.flat = np.frombuffer(b"\0" * LEFT + b"".join(self.text) + b"\0" * WINDOW, np.uint8)
        flat, size = self.flat, np.array([len(t) for t in self.text], np.int64)
        at = LEFT + (np.cumsum(size) - size)[k] + pos
        left, right = np.minimum(pos, LEFT), np.minimum(size[k] - pos, WINDOW)
        step = np.arange(-LEFT, WINDOW)
        matrix = flat[at[:, None] + step]
        matrix[(step < -left[:, None]) | (step >= right[:, None])] = 0
        return left.astype(np.uint8), right.astype(np.uint8), matrix


    def known(self, opened: bool) -> np.ndarray:
        """The leading hash bits of the shared anchors that are sent as contexts, or of those that are opened."""
        found = [np.zeros(0, np.uint64)]
        for b, p in self.sent:
            if (b <= OPENED) if opened else (b >= 0):
                found.append((np.uint64(OPENED - b if opened else b) << np.uint64(32)) | np.frombuffer(p, np.uint32).astype(np.uint64))
        return np.sort(np.concatenate(found))


def opened(doc: np.ndarray, left: np.ndarray, right: np.ndarray, context: np.ndarray):
    """For every offset of an anchor in its window: the records that have a window there, the number of each one's window among
    the different ones (in the order of their bytes), these windows, and the smallest document of each."""
    low, high = np.maximum(0, WINDOW - right.astype(np.int64)), left.astype(np.int64)
    for o in range(LEFT + 1):
        k = np.flatnonzero((low <= o) & (o <= high))
        if len(k):
            body = np.ascontiguousarray(context[k, LEFT - o:LEFT - o + WINDOW])
            _, pick, own = np.unique(body.view(f"V{WINDOW}").ravel(), return_index=True, return_inverse=True)
            least = np.full(len(pick), NO_ID, np.int64)
            np.minimum.at(least, own, doc[k])
            yield o, k, own, body[pick], least


def _split(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket (the leading bits) and the 32 bits that follow."""
    return (h >> np.uint64(64 - bits)).astype(np.int64), ((h << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _by_bucket(bucket: np.ndarray):
    """(bucket, slice) of ascending buckets."""
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, int)
    for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
        yield int(bucket[a]), slice(a, b)


def _span_rows(cell: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    """Spans packed by cell, equal ones once."""
    order = np.lexsort((end, start, row, cell))
    cell, row, start, end = cell[order], row[order], start[order], end[order]
    cells, payload = [], []
    for c, s in _by_bucket(cell):
        out = np.empty(s.stop - s.start, SPAN)
        out["start"], out["size"], out["row"] = start[s], end[s] - start[s], row[s]
        cells.append(c)
        payload.append(np.unique(out).tobytes())
    return pa.table({"cell": pa.array(cells, pa.int64()), "bucket": pa.array([0] * len(cells), pa.int32()), "payload": pa.array(payload, pa.binary())})


SENT = "cell long, bucket int, payload binary"


def covered_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """The cell table, the packed spans to remove (cell, bucket, payload) and the names of the added columns."""
    spark = docs.sparkSession
    name = {}
    for c in ("cell", "row", "key", "size"):
        name[c] = f"_{c}"
        while name[c] in {x.lower() for x in docs.columns}:
            name[c] = "_" + name[c]
    cell, row, key = name["cell"], name["row"], name["key"]
    columns = docs.columns

    def deal(batches):
        number, held, filled = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            cells, places = [], []
            for n in batch[name["size"]].to_pylist():
                if held == 1 << CELL_BITS or held and filled + n > CELL_BYTES:
                    number, held, filled = number + 1, 0, 0
                cells.append(number)
                places.append(held)
                held, filled = held + 1, filled + n
            cols = {c: batch[c] for c in columns} | {cell: pa.array(cells, pa.int64()), row: pa.array(places, pa.int32()), key: batch[key]}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    added = StructType().add(cell, "long").add(row, "integer").add(key, "long")
    rows = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                             name["size"]: F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0))}
                            ).mapInArrow(deal, StructType([*docs.schema.fields, *added.fields]))
    path, table = scratch_path(spark, "llm", "cells"), "cells_" + hashlib.sha1(scratch_path(spark).encode()).hexdigest()[:16]
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    buckets = max(64, math.ceil(size / BUCKET_BYTES))
    (rows.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, cell).saveAsTable(table))
    cells = spark.table(table)
    slim = cells.select(F.col(cell).alias("cell"), F.col(row).alias("row"), F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    bits = max(6, math.ceil(math.log2(max(1, size / 13 / ANCHORS_A_BUCKET))))

    # exact copies: all but the smallest id of each text go whole
    digest = materialize(slim.where(F.octet_length("text") >= WINDOW).select("cell", "row", "key", F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "digests")
    least = digest.groupBy("sha").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = digest.join(least, "sha").where("key > least").select("cell", "row")

    def pack_copies(t: pa.Table) -> pa.Table:
        return pa.table({"cell": t["cell"][:1], "bucket": pa.array([COPIES], pa.int32()),
                         "payload": pa.array([t["row"].to_numpy().astype(np.uint16).tobytes()], pa.binary())})

    copied = materialize(copies.groupBy("cell").applyInArrow(pack_copies, SENT), "copies")

    # every cell tells each bucket which anchors it has, how often, and in how many documents
    def tell(docs: pa.Table, sent: pa.Table) -> pa.Table:
        out = {"bucket": [], "cell": [], "hashes": [], "docs": [], "times": []}
        if docs.num_rows:
            k, _, h = Cell(docs, sent, "text", "row", "key").anchors()
            order = np.lexsort((k, h))
            k, h = k[order], h[order]
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (k[1:] != k[:-1]))) if len(h) else np.zeros(0, bool)
            h, start, times = np.unique(h, return_index=True, return_counts=True)
            in_docs = np.add.reduceat(new.astype(np.int64), start) if len(h) else times
            bucket, rest = _split(h, bits)
            for b, s in _by_bucket(bucket):
                out["bucket"].append(b)
                out["cell"].append(docs["cell"][0].as_py())
                out["hashes"].append(rest[s].tobytes())
                out["docs"].append(in_docs[s].astype(np.uint16).tobytes())
                out["times"].append(times[s].astype(np.uint32).tobytes())
        return _packed(out, {"bucket": pa.int32(), "cell": pa.int64(), "hashes": pa.binary(), "docs": pa.binary(), "times": pa.binary()})

    told = slim.groupBy("cell").cogroup(copied.groupBy("cell")).applyInArrow(tell, "bucket int, cell long, hashes binary, docs binary, times binary")

    def shared(t: pa.Table) -> pa.Table:
        out = {"cell": [], "bucket": [], "payload": [], "hot": []}
        hashes = [np.frombuffer(x, np.uint32) for x in t["hashes"].to_pylist()]
        flat = np.concatenate(hashes)
        value, back = np.unique(flat, return_inverse=True)
        total, times = (np.bincount(back, np.concatenate([np.frombuffer(x, kind) for x in t[c].to_pylist()]), len(value))
                        for c, kind in (("docs", np.uint16), ("times", np.uint32)))
        cuts = np.cumsum([0, *map(len, hashes)])
        for c, x, a, b in zip(t["cell"].to_pylist(), hashes, cuts[:-1], cuts[1:]):
            n, often = total[back[a:b]], times[back[a:b]] > HOT
            for hot in (False, True):
                own = x[(n > 1) & (often == hot)]
                if len(own):
                    out["cell"].append(c)
                    out["bucket"].append(t["bucket"][0].as_py())
                    out["payload"].append(own.tobytes())
                    out["hot"].append(hot)
        return _packed(out, {"cell": pa.int64(), "bucket": pa.int32(), "payload": pa.binary(), "hot": pa.bool_()})

    wanted = materialize(told.groupBy("bucket").applyInArrow(shared, SENT + ", hot boolean"), "shared_anchors")

    def records(cell_: Cell, number: int, found: tuple, opened_: bool) -> tuple[dict, np.ndarray]:
        """The cell's occurrences of shared anchors, of those that stay whole or of those that are opened."""
        k, pos, h = found
        known = cell_.known(opened_)
        lead = h >> np.uint64(64 - bits - 32)
        at = np.minimum(np.searchsorted(known, lead), max(len(known) - 1, 0))
        live = known[at] == lead if len(known) else np.zeros(len(h), bool)
        k, pos, h = k[live], pos[live], h[live]
        heads, last = cell_.merged(k, pos, h)
        k, pos, h = k[heads], pos[heads], h[heads]
        left, right, matrix = cell_.contexts(k, pos)
        return {"h": h, "doc": cell_.doc[k], "cell": np.full(len(k), number, np.int64), "pos": pos.astype(np.int32),
                "last": last.astype(np.int32), "row": cell_.row[k].astype(np.uint16), "left": left, "right": right}, matrix

    def window_records(r: dict, matrix: np.ndarray, number: int) -> tuple[dict, np.ndarray]:
        """Each different window of the opened records once: a record of its own, whose position is its number and which has no last one."""
        parts, bodies, base = [], [], 0
        for o, _, _, body, least in opened(r["doc"], r["left"], r["right"], matrix):
            n = len(body)
            start = np.arange(n) * WINDOW
            h = mix(Hashes(body.ravel()).of(start, start + WINDOW) ^ mix(np.full(n, o + 1, np.uint64)))
            context = np.zeros((n, WIDTH), np.uint8)
            context[:, LEFT - o:LEFT - o + WINDOW] = body
            parts.append({"h": h, "doc": least, "cell": np.full(n, number, np.int64), "pos": (base + np.arange(n)).astype(np.int32),
                          "last": np.full(n, -1, np.int32), "row": np.zeros(n, np.uint16), "left": np.full(n, o, np.uint8), "right": np.full(n, WINDOW - o, np.uint8)})
            bodies.append(context)
            base += n
        if not parts:
            return {n: np.zeros(0, t) for n, t in RECORD}, np.zeros((0, WIDTH), np.uint8)
        return {n: np.concatenate([x[n] for x in parts]) for n, _ in RECORD}, np.concatenate(bodies)

    names = [n for n, _ in RECORD]
    kinds = {"bucket": pa.int32()} | {n: pa.binary() for n in [*names, "context"]}

    def gather(docs: pa.Table, sent: pa.Table) -> pa.Table:
        out = {n: [] for n in kinds}
        if docs.num_rows and sent.num_rows:
            cell_, number = Cell(docs, sent, "text", "row", "key"), docs["cell"][0].as_py()
            found = cell_.anchors()
            for r, matrix in (f() for f in (lambda: records(cell_, number, found, False),       # one after the other: they are not held together
                                            lambda: window_records(*records(cell_, number, found, True), number))):
                order = np.argsort(r["h"], kind="stable")
                bucket = _split(r["h"][order], bits)[0]
                for b, s in _by_bucket(bucket):
                    out["bucket"].append(b)
                    for n in names:
                        out[n].append(r[n][order[s]].tobytes())
                    out["context"].append(matrix[order[s]].tobytes())
        return _packed(out, kinds)

    def ranges(t: pa.Table) -> pa.Table:
        joined = lambda n, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in t[n]])  # noqa: E731 - bytes are copied once
        r = {n: joined(n, kind) for n, kind in RECORD}
        context = joined("context", np.uint8).reshape(-1, WIDTH)
        order = np.argsort(r["h"], kind="stable")
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(r["h"][order]) != 0)))
        out = []
        for part in np.split(order, cuts[1:][np.flatnonzero(np.diff(cuts[1:] // RECORDS, prepend=0))]):   # whole anchors, some at a time
            k, a, b = resolve(*(r[n][part] for n in ("h", "doc", "left", "right")), context[part])
            k = part[k]
            out.append((r["cell"][k], r["row"][k], r["pos"][k], r["last"][k], a, b))
        cell_, row_, pos, last, a, b = (np.concatenate(x) for x in zip(*out))
        whole, window = last >= 0, last < 0
        spans = _span_rows(cell_[whole], row_[whole], pos[whole] + a[whole], last[whole] + b[whole])
        order = np.lexsort((pos[window], cell_[window]))
        cells_, hits = cell_[window][order], pos[window][order]
        told_ = [(c, hits[s].astype(np.int32).tobytes()) for c, s in _by_bucket(cells_)]
        return pa.concat_tables([spans, pa.table({"cell": pa.array([c for c, _ in told_], pa.int64()), "bucket": pa.array([HITS] * len(told_), pa.int32()),
                                                  "payload": pa.array([p for _, p in told_], pa.binary())})])

    def applied(docs: pa.Table, sent: pa.Table) -> pa.Table:
        """The cell's own occurrences of opened windows that an earlier document has, here or elsewhere."""
        out = [(np.zeros(0, np.int64),) * 4]
        if docs.num_rows and sent.num_rows:
            cell_, number = Cell(docs, sent, "text", "row", "key"), docs["cell"][0].as_py()
            r, matrix = records(cell_, number, cell_.anchors(), True)
            hits = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(p, np.int32) for b, p in cell_.sent if b == HITS)])
            base = 0
            for o, k, own, body, least in opened(r["doc"], r["left"], r["right"], matrix):
                elsewhere = np.zeros(len(body), bool)
                mine = hits[(hits >= base) & (hits < base + len(body))] - base
                elsewhere[mine] = True
                base += len(body)
                k = k[elsewhere[own] | (r["doc"][k] > least[own])]
                out.append((r["cell"][k], r["row"][k].astype(np.int64), r["pos"][k].astype(np.int64) - o, r["last"][k].astype(np.int64) - o + WINDOW))
        return _span_rows(*(np.concatenate(x) for x in zip(*out)))

    anchors_sent = copied.unionByName(wanted.select("cell", F.when(F.col("hot"), OPENED - F.col("bucket")).otherwise(F.col("bucket")).alias("bucket"), "payload"))
    found = materialize(slim.groupBy("cell").cogroup(anchors_sent.groupBy("cell"))
                        .applyInArrow(gather, "bucket int, " + ", ".join(f"{n} binary" for n in [*names, "context"]))
                        .groupBy("bucket").applyInArrow(ranges, SENT), "spans")
    spans = found.where(F.col("bucket") != HITS)
    if wanted.where("hot").take(1):
        opened_in = wanted.where("hot").select("cell").distinct()  # the other cells have nothing to apply
        sent = anchors_sent.where(F.col("bucket") < 0).unionByName(found.where(F.col("bucket") == HITS)).join(opened_in, "cell", "left_semi")
        spans = spans.unionByName(materialize(slim.groupBy("cell").cogroup(sent.groupBy("cell")).applyInArrow(applied, SENT), "opened_spans"))
    return cells, copied.unionByName(spans), name


def _cuts(t: pa.Table, sent: pa.Table, row: str) -> list[np.ndarray]:
    """For every row of a cell, which bytes go."""
    spans = [np.frombuffer(p, SPAN) for b, p in zip(sent["bucket"].to_pylist(), sent["payload"].to_pylist()) if b >= 0]
    spans = np.concatenate(spans) if spans else np.zeros(0, SPAN)
    copies = {x for b, p in zip(sent["bucket"].to_pylist(), sent["payload"].to_pylist()) if b == COPIES for x in np.frombuffer(p, np.uint16).tolist()}
    spans = spans[np.argsort(spans["row"], kind="stable")]
    out = []
    for r, text in zip(t[row].to_pylist(), t["text"].cast(pa.large_binary()).to_pylist()):
        n = len(text or b"")
        lo, hi = np.searchsorted(spans["row"], r), np.searchsorted(spans["row"], r, side="right")
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, spans["start"][lo:hi].astype(np.int64), 1)
        np.add.at(edge, spans["start"][lo:hi].astype(np.int64) + spans["size"][lo:hi], -1)
        out.append(np.ones(n, bool) if r in copies else np.cumsum(edge[:n]) > 0)
    return out


def removal_digest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    cells, sent, name = covered_spans(docs.select("doc_id", "text"))
    cells = cells.select(F.col(name["cell"]).alias("cell"), F.col(name["row"]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(t: pa.Table, sent: pa.Table) -> pa.Table:
        out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        texts = t["text"].cast(pa.large_binary()).to_pylist() if t.num_rows else []
        for text, cut in zip(texts, _cuts(t, sent, "row") if t.num_rows else []):
            out["n_bytes"].append(len(cut))
            out["n_removed"].append(int(cut.sum()))
            out["n_spans"].append(int((np.diff(np.concatenate(([0], cut.astype(np.int8)))) == 1).sum()))
            out["kept_sha256"].append(hashlib.sha256(np.frombuffer(text or b"", np.uint8)[~cut].tobytes()).hexdigest())
        types = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
        return pa.table({"doc_id": t["doc_id"] if t.num_rows else pa.array([], pa.int64())} | {c: pa.array(v, types[c]) for c, v in out.items()})

    return cells.groupBy("cell").cogroup(sent.groupBy("cell")).applyInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the repeated bytes taken out of ``text``, other columns as they are
    (``n_chars``, where present, follows a shortened text)."""
    cells, sent, name = covered_spans(docs)

    def run(t: pa.Table, sent: pa.Table) -> pa.Table:
        if not t.num_rows:
            return t.drop_columns([name["cell"], name["row"], name["key"]])
        texts, counts = [], t["n_chars"].to_pylist() if "n_chars" in t.column_names else None
        for k, (text, cut) in enumerate(zip(t["text"].to_pylist(), _cuts(t, sent, name["row"]))):
            if cut.any():
                text = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)[~cut].tobytes().decode("utf-8", "ignore")
                if counts is not None:
                    counts[k] = len(text)
            texts.append(text)
        for c, values in (("text", texts), ("n_chars", counts)):
            if values is not None:
                at = t.column_names.index(c)
                t = t.set_column(at, t.schema.field(at), pa.array(values, t.schema.field(at).type))
        return t.drop_columns([name["cell"], name["row"], name["key"]])

    return cells.groupBy(name["cell"]).cogroup(sent.withColumnRenamed("cell", name["cell"]).groupBy(name["cell"])).applyInArrow(run, docs.schema)


#: The digest over the registered tables, in DuckDB SQL (every 50-byte string is one row there).
ORACLE_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
p AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w FROM (SELECT doc_id, h, unnest(range(n - 49)) AS i FROM d WHERE n >= 50)),
f AS (SELECT w, min(doc_id) AS first FROM p GROUP BY w),
hit AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM p JOIN f USING (w) WHERE first < doc_id),
numbered AS (SELECT doc_id, i, sum(CASE WHEN gap IS NULL OR gap > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hit),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY doc_id, run),
pieces AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_byte FROM runs),
kept AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, list(struct_pack(f := from_byte, t := a) ORDER BY a) AS parts
         FROM pieces GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN parts IS NULL THEN h ELSE array_to_string(list_transform(parts, lambda x: substr(h, 2 * x.f + 1, 2 * (x.t - x.f))), '')
                         || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
