"""Operator 11: ranked lexical search by dense blocked multiplication.

Items are cut into tiles, documents into tiles of their own.  A document tile keeps, for the
items' terms only, how often each document holds them.  For a pair of tiles the terms that
both hold are their compact vocabulary: the documents' integer impacts and the items' integer
weights become two dense float64 matrices over it, and one BLAS product gives all scores.
The vocabulary is cut where the sum of weight times greatest impact could reach 2**53, so
every partial sum is an exact integer; the parts are added in 64 bits.  A tile keeps, for each
item, the documents that are not below the k-th best so far, ties included.

Plan.  One pass reads the texts, counts the terms and writes the document tiles; a pass over
these counts in how many documents each term occurs; a second one multiplies.  Items are sent
to the tasks in groups of about ``GROUP_BYTES`` of text, one after the other, and a group's
variables are released before the next: neither the driver nor a task holds all items.  The
best of the partitions are merged in two steps, so no task meets all partitions.

Defined cases: a null text has no term; a document without terms, an item without terms and an
item no document shares a term with give no rows; equal item rows are answered once, and rows
that share an id but not the text each get their own ranks; documents that repeat an id are ranked
one by one; rows without doc_id count and are ranked after equal scores with an id; empty
tables give no rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchside.llm.common import materialize

K = 20
#: A word of ASCII letters, ASCII digits and all bytes of characters beyond ASCII.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
GROUP_BYTES = 4 << 20     # item text sent to the tasks at once, on average
TILE_ITEMS = 256
TILE_DOCS = 512
TILE_ENTRIES = 1 << 18    # (document, term) pairs after which a document tile is closed
LANES = 64                # parts of an item's candidates that are merged by themselves first
TOP_IMPACT = 1_000_000    # (10**9 * tf) div (1000 * tf + 12 * m) is below this
EXACT = 1 << 53
I64 = np.iinfo(np.int64)

TILE_SCHEMA = "ids binary, known binary, n binary, ends binary, term binary, tf binary, docs long, terms long"


def terms_of(text: bytes | None) -> list[bytes]:
    return TERM.findall((text or b"").lower())


def _count_documents(column: dict[bytes, int]):
    """Tiles of documents: per document its id, length and (term, occurrences) of the items' terms."""
    def packed(docs, counted, total):
        ends = np.cumsum([len(d[2]) for d in docs], dtype=np.int64)
        return pa.RecordBatch.from_pydict({
            "ids": [np.array([d[0] or 0 for d in docs], np.int64).tobytes()],
            "known": [np.array([d[0] is not None for d in docs], np.bool_).tobytes()],
            "n": [np.array([d[1] for d in docs], np.int64).tobytes()], "ends": [ends.tobytes()],
            "term": [np.concatenate([d[2] for d in docs] or [np.zeros(0, np.int32)]).astype(np.int32).tobytes()],
            "tf": [np.concatenate([d[3] for d in docs] or [np.zeros(0, np.int64)]).astype(np.int64).tobytes()],
            "docs": [counted], "terms": [total]})

    def run(batches):
        docs, entries, counted, total = [], 0, 0, 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                words = terms_of(text.as_py())
                counted, total = counted + bool(words), total + len(words)
                held = [c for c in map(column.get, words) if c is not None]
                if held:
                    term, tf = np.unique(np.array(held, np.int32), return_counts=True)
                    docs.append((doc_id, len(words), term, tf))
                    entries += len(term)
                if len(docs) >= TILE_DOCS or entries >= TILE_ENTRIES:
                    yield packed(docs, counted, total)
                    docs, entries, counted, total = [], 0, 0, 0
        if docs or counted:
            yield packed(docs, counted, total)

    return run


def _count_terms(width: int):
    def run(batches):
        held = np.zeros(width, np.int64)
        for batch in batches:
            for term in batch["term"].to_pylist():
                held += np.bincount(np.frombuffer(term, np.int32), minlength=width)
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"term": term.astype(np.int64), "df": held[term]})

    return run


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """(10**9 * tf) div (1000 * tf + 12 * m) with m = 75 + (25 * n * documents) div length."""
    if int(n.max(initial=0)) * 25 * documents > I64.max:
        n = n.astype(object)  # beyond 64 bits the product is formed in Python integers
    m = (75 + (25 * n * documents) // length).astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def vocabulary_parts(weights: np.ndarray) -> list[slice]:
    """Cuts of the vocabulary (rows) within which no item's sum of weight times impact can reach 2**53."""
    most = weights.max(1, initial=0).astype(object) * TOP_IMPACT
    cuts, total = [0], 0
    for k, m in enumerate(most):
        if k > cuts[-1] and total + m >= EXACT:
            cuts.append(k)
            total = 0
        total += m
    return [slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(most)])]


def multiply(impact: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Exact integer product of (documents x terms) and (terms x items), by float64 BLAS in safe parts."""
    score = np.zeros((impact.shape[0], weights.shape[1]), np.int64)
    for part in vocabulary_parts(weights):
        a, b = impact[:, part], weights[part]
        if int(b.max(initial=0)) * TOP_IMPACT >= EXACT:  # a single term may pass the bound by itself
            score += a @ b
        else:
            score += (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return score


def best_rows(item, score, unknown, ids, k: int) -> np.ndarray:
    """Places of each item's k best: highest score, known ids first, then the smaller id."""
    order = np.lexsort((ids, unknown, -score, item))
    item = item[order]
    start = np.concatenate(([True], item[1:] != item[:-1]))[:len(item)]
    first = np.maximum.accumulate(np.where(start, np.arange(len(item)), 0))
    return order[np.arange(len(item)) - first < k]


def item_tiles(items: list[dict[int, int]], weight: np.ndarray) -> list[tuple]:
    """Per tile of items: its vocabulary, and (row in it, item, weight times occurrences) of all entries."""
    out = []
    for at in range(0, len(items), TILE_ITEMS):
        part = items[at:at + TILE_ITEMS]
        term = np.array([t for i in part for t in i], np.int64)
        times = np.array([q for i in part for q in i.values()], np.int64)
        who = np.repeat(np.arange(len(part)), [len(i) for i in part])
        vocabulary, row = np.unique(term, return_inverse=True)
        out.append((at, len(part), vocabulary, row, who, weight[term] * times))
    return out


def _search(tiles: list[tuple], ids_of: pa.Array, documents: int, length: int, k: int):
    names = ["item", "item_id", "doc_id", "score"]

    def run(batches):
        best = [tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.bool_, np.int64)) for _ in tiles]
        kth = [np.ones(t[1], np.int64) for t in tiles]  # scores above 0 only
        for batch in batches:
            for row in batch.to_pylist():
                ids, n = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["n"], np.int64)
                unknown = ~np.frombuffer(row["known"], np.bool_)
                ends = np.frombuffer(row["ends"], np.int64)
                term, tf = np.frombuffer(row["term"], np.int32), np.frombuffer(row["tf"], np.int64)
                doc = np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0))
                impact = impacts(tf, n[doc], documents, length)
                here, place = np.unique(term, return_inverse=True)
                for t, (_, width, vocabulary, item_row, who, weight) in enumerate(tiles):
                    shared, in_doc, in_item = np.intersect1d(here, vocabulary, assume_unique=True, return_indices=True)
                    if not len(shared):
                        continue
                    at = np.full(len(here), -1)
                    at[in_doc] = np.arange(len(shared))
                    a, keep = np.zeros((len(ids), len(shared)), np.int64), at[place] >= 0
                    a[doc[keep], at[place][keep]] = impact[keep]
                    at = np.full(len(vocabulary), -1)
                    at[in_item] = np.arange(len(shared))
                    b, keep = np.zeros((len(shared), width), np.int64), at[item_row] >= 0
                    b[at[item_row][keep], who[keep]] = weight[keep]
                    score = multiply(a, b)
                    d, i = np.nonzero(score >= kth[t][None, :])
                    if not len(d):
                        continue
                    found = [np.concatenate(x) for x in zip(best[t], (i, score[d, i], unknown[d], ids[d]))]
                    top = best_rows(*found, k)
                    best[t] = tuple(x[top] for x in found)
                    who_full, count = np.unique(best[t][0], return_counts=True)
                    last = np.cumsum(count) - 1
                    kth[t][who_full[count == k]] = best[t][1][last[count == k]]
        for t, (item, score, unknown, ids) in enumerate(best):
            if len(item):
                item = item + tiles[t][0]
                yield pa.RecordBatch.from_arrays([pa.array(item), ids_of.take(pa.array(item)), pa.array(ids, mask=unknown), pa.array(score)], names)

    return run


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item over all partitions, lane by lane and then over the lanes."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    lane = Window.partitionBy("item", "lane").orderBy(*order)
    kept = (found.withColumn("lane", F.pmod(F.xxhash64("doc_id"), F.lit(LANES)))
            .withColumn("rank", F.row_number().over(lane)).where(F.col("rank") <= k))
    return (kept.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def rank(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """``docs(doc_id, text)``, ``items(item_id, text)``: item_id, rank, doc_id, score of each item's k best documents."""
    spark = docs.sparkSession
    asked = items.select("item_id", F.col("text").cast("binary").alias("text")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, math.ceil(size / GROUP_BYTES))
    id_type = asked.schema["item_id"].dataType.simpleString()
    out = None
    for g in range(groups):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == g).toArrow()
        counted = [terms_of(t) for t in part["text"].to_pylist()]
        column = {t: c for c, t in enumerate(sorted({t for words in counted for t in words}))}
        held = [dict(zip(*np.unique([column[t] for t in words], return_counts=True))) if words else {} for words in counted]
        tiles = materialize(texts.mapInArrow(_count_documents(column), TILE_SCHEMA), "lexical_tiles")
        documents, length = tiles.agg(F.sum("docs"), F.sum("terms")).first()
        if not documents or not column:
            continue
        df = (tiles.select("term").mapInArrow(_count_terms(len(column)), "term long, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect())  # one row for a term of the group at most
        weight = np.zeros(len(column), np.int64)
        for r in df:
            weight[r["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r["df"] + 1)))
        search = _search(item_tiles(held, weight), part["item_id"].combine_chunks(), documents, length, k)
        found = tiles.select("ids", "known", "n", "ends", "term", "tf").mapInArrow(search, f"item long, item_id {id_type}, doc_id long, score long")
        best = _merged(found, k)
        if groups > 1:
            best = materialize(best, "lexical_best")
        out = best if out is None else out.unionByName(best)
    return out if out is not None else spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
#: The query over the registered tables, in DuckDB SQL.
ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
c AS (SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM c),
t AS (SELECT r, unnest(ts) AS term FROM d),
tf AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM t GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
i AS (SELECT item_id, text, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark) b),
q AS (SELECT item_id, text, term, CAST(count(*) AS BIGINT) AS q FROM i GROUP BY item_id, text, term),
w AS (SELECT q.item_id, q.text, q.term, q.q * CAST(floor(1000 * ln(CAST(2 * s.docs + 2 AS DOUBLE) / CAST(2 * df.df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM q JOIN df ON q.term = df.term CROSS JOIN s),
m AS (SELECT c.r, c.doc_id, 75 + (25 * c.n * s.docs) // s.terms AS m FROM c CROSS JOIN s),
x AS (SELECT w.item_id, w.text, m.r, m.doc_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * m.m))) AS BIGINT) AS score
      FROM w JOIN tf ON w.term = tf.term JOIN m ON tf.r = m.r GROUP BY w.item_id, w.text, m.r, m.doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS k FROM x WHERE score > 0)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM k WHERE k <= 20
"""
