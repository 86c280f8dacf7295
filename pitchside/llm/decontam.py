"""Operator 4: benchmark decontamination with an Aho-Corasick automaton.

Normalising: A-Z lower-cased, words are runs of letters, digits and non-ASCII characters.
A window is ``window`` consecutive words of a test item (a shorter item is one window).  All
windows go into one automaton over the normalised word stream, and each text is scanned
once; a match's place gives the words it covers, and these map back to character offsets of
the original text.

The windows are few against the corpus, and their size is measured: up to ``block_bytes``
they are one broadcast and one automaton.  Beyond it they are dealt into several broadcasts
of about that size by a hash of the window, and a task holds one automaton at a time; the
results are the union, whatever the number of blocks.

Defined cases: a null or empty text, or one of separators alone, has no words and no hits;
an item without words has no windows; equal windows of several items count for each; an
item id repeated counts once, a null item id hits words but is not listed; empty tables
give no hits or no rows.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchside.llm.common import text_rows

WINDOW = 10
BLOCK_BYTES = 32 << 20
#: Every ASCII byte that is no letter or digit becomes a space, A-Z become a-z.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def windows_of(text: str | None, window: int = WINDOW) -> list[bytes]:
    words = words_of(text)
    if not words:
        return []
    return [b" ".join(words[i:i + window]) for i in range(max(1, len(words) - window + 1))]


def _windows_table(items: DataFrame, window: int) -> DataFrame:
    """Distinct (window, item_id) rows of ``items(item_id, text)``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = {(w, i) for i, t in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist())
                     for w in windows_of(t, window)}
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in pairs], pa.binary()),
                                              pa.array([i for _, i in pairs], pa.string())], ["pattern", "item_id"])

    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "pattern binary, item_id string").distinct()


def _broadcast_blocks(spark, table: DataFrame, block_bytes: int) -> list:
    table = table.persist()
    total = table.agg(F.coalesce(F.sum(F.octet_length("pattern") + 16), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_bytes))
    out = []
    for b in range(blocks):
        owners: dict[bytes, list[str]] = {}
        for pattern, item in table.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == b).toLocalIterator():
            owners.setdefault(bytes(pattern), []).append(item)
        out.append((uuid.uuid4().hex, spark.sparkContext.broadcast(sorted((p, tuple(i for i in ids if i is not None)) for p, ids in owners.items()))))
    table.unpersist()
    return out


class Scanner:
    """One automaton; ``scan`` gives the (first word, past last word, items) of every occurrence."""

    def __init__(self, patterns: list[tuple[bytes, tuple]]):
        self.items = [ids for _, ids in patterns]
        self.automaton = ahocorasick.Automaton()
        for k, (p, _) in enumerate(patterns):
            # bytes as characters one to one: equal bytes are equal characters
            self.automaton.add_word(f" {p.decode('latin-1')} ", (k, len(p) + 2, p.count(b" ") + 1))
        if patterns:
            self.automaton.make_automaton()

    def scan(self, stream: str) -> list[tuple[int, int, tuple]]:
        if not len(self.automaton):
            return []
        found = [(end - size + 1, k, n) for end, (k, size, n) in self.automaton.iter(stream)]
        if not found:
            return []
        spaces = np.flatnonzero(np.frombuffer(stream.encode("latin-1"), np.uint8) == 32)
        first = np.searchsorted(spaces, [s for s, _, _ in found])
        return [(int(a), int(a) + n, self.items[k]) for a, (_, k, n) in zip(first, found)]


_LOADED: dict = {}


def _scanner(block) -> Scanner:
    """The automaton of one broadcast; a worker keeps the last one only."""
    key, patterns = block
    if _LOADED.get("key") != key:
        _LOADED.clear()
        _LOADED.update(key=key, scanner=Scanner(patterns.value))
    return _LOADED["scanner"]


def _found(texts: list, blocks: list) -> tuple[list[int], list[list]]:
    """Word counts of texts and the occurrences in each."""
    streams, counts = [], []
    for t in texts:
        words = words_of(t)
        counts.append(len(words))
        streams.append(f" {b' '.join(words).decode('latin-1')} " if words else "")
    found: list[list] = [[] for _ in texts]
    for block in blocks:
        scanner = _scanner(block)
        for k, s in enumerate(streams):
            if s:
                found[k] += scanner.scan(s)
    return counts, found


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_words, n_hit, items (sorted list) and
    spans, the character offsets (start, end) in the original text of each maximal run of hit words."""
    blocks = _broadcast_blocks(docs.sparkSession, _windows_table(items, window), block_bytes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            counts, found = _found(texts, blocks)
            hits, names, spans = [], [], []
            for t, n, f in zip(texts, counts, found):
                edge = np.zeros(n + 1, np.int64)
                for a, b, _ in f:
                    edge[a] += 1
                    edge[b] -= 1
                hit = np.cumsum(edge[:n]) > 0
                hits.append(int(hit.sum()))
                names.append(sorted({i for _, _, ids in f for i in ids}))
                runs = []
                if f:
                    at = [m.span() for m in _WORD.finditer(t)]
                    turns = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                    runs = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(turns[::2], turns[1::2])]
                spans.append(runs)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), pa.array(names, pa.list_(pa.string())),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["doc_id", "n_words", "n_hit", "items", "spans"])

    return text_rows(docs).mapInArrow(
        scan, "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>")


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with all their columns; one pass, no join."""
    blocks = _broadcast_blocks(docs.sparkSession, _windows_table(items, window), block_bytes)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not f for f in _found(batch["text"].to_pylist(), blocks)[1]], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


#: The digest over the registered tables, in DuckDB SQL.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS pattern
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS pattern
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, dw.n AS n, item_id FROM dw JOIN bw USING (n, pattern)),
covered AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
