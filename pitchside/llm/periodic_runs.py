"""Operator 13: runs of words that repeat with a period, found in tiles by scale.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends, at least
``max(12, 2 q)`` words long.  In terms of matches: words ``i`` and ``i + q`` are equal on a stretch
``[s, e)`` of ``i`` that is as long as it can be, and the run is the words ``[s, e + q)``.

Tiles.  Periods are taken by octaves ``[lo, 2 lo)``; for each, a document is cut into overlapping
tiles whose length follows ``lo``.  A tile owns the boundaries in its middle part.  They lie so close
that each stretch long enough for a run of the octave holds one boundary and a full step after
it.  So a period can only be at a boundary if the words of one step there and one period later have
the same polynomial hash; where that is so, the Z-functions of the words after and before the
boundary give both extensions exactly, hash or not.  Stretches that leave the window are followed
through the tile.  Multiples of a smaller period are recognised by the same Z-function and left to
the smaller one.  What touches the end of a tile inside the document is a fragment.

Plan.  Documents of up to ``SHORT`` words are tiled and solved where they are read; the tiles of longer
ones are dealt out one by one.  Only fragments are shuffled, by document and period, where overlapping
ones are stitched and judged.  Texts travel only for documents with a fragment; for all others the
first pass has the result.

Defined cases: a null text has no words; a text without words has no run and the empty result; one word
repeated is a run of period 1; repeated rows and rows without an id are handled each by itself;
columns other than doc_id and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchside.llm.common import materialize
from pitchside.llm.quality_rules import let, words_of

LEAST = 12            # words of the shortest run
SHORT = 1 << 16       # words of the longest document whose tiles are solved in the task that reads it
TILE = 1 << 13        # boundaries of a tile lie in at least so many words
FRAGMENT = pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
FRAGMENTS = "array<struct<period:long,start:long,end:long>>"


# ---- one tile ------------------------------------------------------------------------------

def z_function(s: list[int]) -> list[int]:
    """Length of the longest common prefix of ``s`` and each of its suffixes."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def root_period(z: list[int], q: int) -> int:
    """Smallest divisor of ``q`` that is a period of the first ``q`` items of a sequence with Z-function ``z``."""
    for p in prime_factors(q):
        while q % p == 0 and (q // p) < q and z[q // p] >= q - q // p:
            q //= p
    return q


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    BASE = 0x9E3779B97F4A7C15  # any odd number

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int):
        if len(self.up) < n:
            self.up, self.down = (self._powers(b, 1 << (n - 1).bit_length()) for b in (self.BASE, pow(self.BASE, -1, 1 << 64)))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)


_POWERS = _Powers()


def _gram_hashes(codes: np.ndarray, step: int) -> np.ndarray:
    """A hash of the ``step`` items from each place on; equal items have equal hashes."""
    up, down = _POWERS.of(len(codes))
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * up, dtype=np.uint64)))
    return (sums[step:] - sums[:-step]) * down[:len(codes) - step + 1]


def _follow(codes: np.ndarray, at: int, q: int, step: int) -> int:
    """First place from ``at`` on (``step`` 1: upwards, -1: downwards) where ``codes[i] != codes[i + q]``, or the end."""
    length = 64
    while True:
        if step > 0:
            stop = min(at + length, len(codes) - q)
            differ = np.flatnonzero(codes[at:stop] != codes[at + q:stop + q])
            if len(differ) or stop >= len(codes) - q:
                return at + int(differ[0]) if len(differ) else max(stop, at)
        else:
            stop = max(at - length, -1)
            differ = np.flatnonzero(codes[stop + 1:at + 1] != codes[stop + 1 + q:at + 1 + q])
            if len(differ) or stop < 0:
                return stop + 1 + int(differ[-1]) if len(differ) else -1
        at, length = stop, 2 * length


def boundary_step(lo: int) -> int:
    """Half of the shortest stretch of matches that a run with a period in ``[lo, 2 lo)`` has."""
    return max(lo, LEAST - 2 * lo + 1) // 2


def solve_tile(codes: np.ndarray, lo: int, first: int, last: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the stretches of matches through boundaries in ``[first, last)``, periods in ``[lo, 2 lo)``.

    Places are relative to the tile; boundaries lie at the multiples of the step counted from ``first``."""
    size, step = len(codes), boundary_step(lo)
    if size < lo + step:
        return []
    grams = _gram_hashes(codes, step)
    bounds = np.arange(first, min(last, len(grams) - lo), step)
    if not len(bounds):
        return []
    later = np.lib.stride_tricks.sliding_window_view(np.concatenate((grams, np.zeros(lo, np.uint64))), lo)
    row, place = np.nonzero(later[first + lo::step][:len(bounds)] == grams[bounds][:, None])
    periods = place + lo
    valid = bounds[row] + periods + step <= size
    row, periods = row[valid], periods[valid]
    found, known, roots, listed = [], {}, {}, None
    starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else []
    for a, b in zip(starts, [*starts[1:], len(row)]):
        c, asked = int(bounds[row[a]]), periods[a:b]
        for root, end in list(roots.items()):
            if end <= c:
                del roots[root]
            else:  # inside a stretch of a smaller period: its multiples are no smallest periods
                asked = asked[(asked % root != 0) | (c + asked > end)]
        asked = [int(q) for q in asked if known.get(int(q), -1) <= c]
        if not asked:
            continue
        listed = codes.tolist() if listed is None else listed
        high, low = min(size, c + 4 * lo), max(0, c - 2 * lo)
        after = z_function(listed[c:high])
        top = min(size, c + 2 * lo)
        head = listed[low:c][::-1]
        before = z_function([*head, -1, *listed[low:top][::-1]])
        for q in asked:
            if any(q % root == 0 and c + q <= end for root, end in roots.items()):
                continue
            if not after[q]:
                continue  # equal hashes of different words
            root = root_period(after, q)
            start = end = None
            if root < q:
                roots[root] = _follow(codes, c, root, 1) + root
                continue
            back = min(before[len(head) + 1 + top - c - q], c - low) if c + q <= top else 0
            start, end = c - back, c + after[q]
            if start == low and low > 0:
                start = _follow(codes, low - 1, q, -1) + 1
            if end + q == high and high < size:
                end = _follow(codes, end, q, 1)
            known[q] = end
            found.append((q, start, end))
    return found


# ---- tiles of a document -------------------------------------------------------------------

def tiles(words: int):
    """(lo, first, last, from, to): octave, owned boundaries and words of every tile of a document."""
    lo = 1
    while 2 * lo <= words and words >= LEAST:
        step = boundary_step(lo)
        span, margin = max(TILE, 16 * lo) // step * step, max(lo, step)
        for first in range(0, words, span):
            yield lo, first, min(first + span, words), max(0, first - 2 * margin), min(words, first + span + 4 * margin)
        lo *= 2


def long_enough(period: int, start: int, end: int) -> bool:
    return end - start >= period and end - start + period >= LEAST


def fragments(codes: np.ndarray, tile: tuple, words: int) -> list[tuple[int, int, int]]:
    """What a tile (its words: ``codes``) says: whole stretches that make a run, and those it cannot judge."""
    lo, first, last, at, to = tile
    out = []
    for q, start, end in solve_tile(codes, lo, first - at, last - at):
        cut = (start == 0 and at > 0) or (end + q == len(codes) and to < words)
        if cut or long_enough(q, start, end):
            out.append((q, start + at, end + at))
    return out


def _codes(words: list[bytes]) -> np.ndarray:
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))


def _scan(texts: bool):
    """First pass: words, fragments of short documents, and the result of those without any."""
    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("doc_id", "n_words", "sha", "body", "collapsed", "fragments", "far")}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = text.as_py().split()  # ASCII blanks only, as these are bytes
                codes, found, far = _codes(words), [], len(words) > SHORT
                if not far:
                    for tile in tiles(len(words)):
                        found += fragments(codes[tile[3]:tile[4]], tile, len(words))
                kept = b" ".join(words)
                open_ = far or bool(found)
                for k, v in zip(out, (doc_id.as_py(), len(words), None if open_ else hashlib.sha256(kept).hexdigest(), kept if open_ else None,
                                      kept if texts and not open_ else None, [dict(zip(("period", "start", "end"), f)) for f in found], far)):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["n_words"], pa.int64()), pa.array(out["sha"], pa.string()),
                 pa.array(out["body"], pa.binary()), pa.array(out["collapsed"], pa.binary()), pa.array(out["fragments"], pa.list_(FRAGMENT)),
                 pa.array(out["far"], pa.bool_())], list(out))

    return run


def _cut_tiles(batches):
    """A record for every tile of the long documents."""
    for batch in batches:
        for row, body in zip(batch["row"].to_pylist(), batch["body"]):
            codes = _codes(body.as_py().split())
            for tile in tiles(len(codes)):
                yield pa.RecordBatch.from_pydict({"row": [row], "words": [len(codes)], "tile": [list(tile)],
                                                  "codes": [codes[tile[3]:tile[4]].tobytes()]})


def _solve_tiles(batches):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            out += [(r["row"], *f) for f in fragments(np.frombuffer(r["codes"], np.int32), tuple(r["tile"]), r["words"])]
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(4)], ["row", "period", "start", "end"])


def stitch(found: DataFrame) -> DataFrame:
    """Fragments (row, period, start, end) of a document and period that overlap or touch become one; those that make a run stay."""
    order = Window.partitionBy("row", "period").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    piece = found.withColumn("new", (F.col("start") > F.coalesce(reach, F.lit(-1))).cast("int"))
    piece = piece.withColumn("piece", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = piece.groupBy("row", "period", "piece").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start") + F.col("period")
    return (whole.where((F.col("end") - F.col("start") >= F.col("period")) & (length >= LEAST))
            .select("row", "start", length.alias("length"), "period"))


def _collapse(texts: bool):
    """Drop every word that a run contains after its first period."""
    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            shas, bodies = [], []
            for r in rows:
                words = r["body"].split()
                depth = np.zeros(len(words) + 1, np.int64)
                for x in r["runs"] or []:
                    depth[x["start"] + x["period"]] += 1
                    depth[x["start"] + x["length"]] -= 1
                kept = b" ".join([words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)])
                shas.append(hashlib.sha256(kept).hexdigest())
                bodies.append(kept if texts else None)
            out = batch.drop_columns(["body"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(shas, pa.string()), pa.array(bodies, pa.binary())],
                                             [*out.schema.names, "sha", "collapsed"])

    return run


RUNS = "array<struct<start:long,period:long,length:long>>"


def collapse_runs(docs: DataFrame, texts: bool = True) -> DataFrame:
    """``docs(doc_id, text)``: doc_id, n_words, ``runs`` by start and period, ``collapsed`` (the text without the
    repetitions, its words joined by one blank; null unless ``texts``) and ``collapsed_sha256``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    scanned = rows.mapInArrow(_scan(texts), f"doc_id long, n_words long, sha string, body binary, collapsed binary, fragments {FRAGMENTS}, far boolean")
    # numbered as written: the table is read from here on, so a row keeps its number
    scanned = materialize(scanned.withColumn("row", F.monotonically_increasing_id()), "periodic_scan")
    near = scanned.where(F.size("fragments") > 0).select("row", F.inline("fragments"))
    far = (scanned.where("far").select("row", "body").mapInArrow(_cut_tiles, "row long, words long, tile array<long>, codes binary")
           .repartition("row", F.xxhash64("tile")).mapInArrow(_solve_tiles, "row long, period long, start long, end long"))
    runs = stitch(near.unionByName(far)).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    opened = (scanned.where("body is not null").select("row", "doc_id", "n_words", "body").join(runs, "row", "left")
              .select("doc_id", "n_words", "runs", "body").mapInArrow(_collapse(texts), f"doc_id long, n_words long, runs {RUNS}, sha string, collapsed binary"))
    plain = scanned.where("body is null").select("doc_id", "n_words", F.array().cast(RUNS).alias("runs"), "sha", "collapsed")
    return plain.unionByName(opened).select(
        "doc_id", "n_words", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), F.col("collapsed").cast("string").alias("collapsed"),
        F.col("sha").alias("collapsed_sha256"))


def digest(collapsed: DataFrame) -> DataFrame:
    """The longest run of every document (ties: smallest start, then period), and checksums of all runs and of the kept words."""
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    out = collapsed.withColumn("best", F.when(F.size("runs") > 0, best))
    length = -F.col("best.less")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
        F.col("best.period").alias("period"), F.floor(F.lit(1000) * length / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The stated rewriting: with h the checksum of the id and g = h div 10, a text whose h ends in 0 repeats, from word
    a = g mod n on, its words a to a + p - 1, where p = 1 + (n - a) div (3 + g mod 8).  A null id counts as the empty text."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def rewritten(words: Column) -> Column:
        n, g = F.size(words).cast("long"), F.floor(h / 10).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        return F.when(n > 0, F.array_join(let(F.struct(a.alias("a"), p.alias("p")), lambda v: F.transform(
            words, lambda w, i: F.when(i < v["a"], w).otherwise(F.get(words, (v["a"] + (i - v["a"]) % v["p"]).cast("int"))))), " ")).otherwise("")

    return docs.withColumn("text", F.when(h % 10 == 0, let(words_of(text), rewritten)).otherwise(text))
