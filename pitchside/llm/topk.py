"""Operator 2: exact top-k by inner product with block-at-a-time pruning.

Vectors are sorted by id and cut into blocks (ranges of ids).  A block keeps a forward index
(its integer matrix) and, for every component, the largest and smallest value.  For a query
the sum over components of the larger of ``q * max`` and ``q * min`` bounds every score in
the block.  Each query takes the blocks in the order of their bounds and scores them through
the forward index until the next bound falls below its k-th best score; a bound equal to
the k-th score is still opened, because a tie goes to the smaller id.

Queries are dealt into batches and blocks into groups; one task joins one batch with one
group and returns at most k rows a query, and a window merges the groups.  The number of
batches and groups follows the counted rows, so a task's memory does not.

Defined cases: vectors that are null or hold a null or non-finite component, and rows without
an id, take no part; shorter vectors are padded with zeros; an empty vector scores 0; values
beyond 64 bits are cut to that range; rows that repeat an id are separate candidates, except
for queries of that id; equal query rows are answered once; empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 5
SCALE = 256.0
BLOCK = 256              # vectors in a block
GROUP_ROWS = 8192        # vectors that meet a batch of queries in one task, on average
BATCH_ROWS = 2048        # queries in a batch, on average
EXACT = float(1 << 53)   # integers below this are exact in float64
I64 = np.iinfo(np.int64)


def quantised(vector: Column, scale: float = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def _usable(vector: Column) -> Column:
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~wrong


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


def _blocks(batches):
    """Blocks of a sorted partition: ids and matrix as bytes, extremes as lists."""
    def packed(ids, rows):
        m = _matrix(rows, max(map(len, rows)))
        return pa.RecordBatch.from_arrays(
            [pa.array([ids[0]], pa.int64()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
             pa.array([m.tobytes()], pa.binary()), pa.array([m.max(0).tolist()], pa.list_(pa.int64())),
             pa.array([m.min(0).tolist()], pa.list_(pa.int64()))], ["first", "ids", "matrix", "high", "low"])

    ids, rows = [], []
    for batch in batches:
        ids += batch["vec_id"].to_pylist()
        rows += batch["v"].to_pylist()
        while len(ids) >= BLOCK:
            yield packed(ids[:BLOCK], rows[:BLOCK])
            ids, rows = ids[BLOCK:], rows[BLOCK:]
    if ids:
        yield packed(ids, rows)


def _products(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Integer products of rows, exact whatever the size of the values."""
    width = max(q.shape[1], m.shape[1])
    q, m = (np.pad(a, ((0, 0), (0, width - a.shape[1]))) for a in (q, m))
    most = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(m.astype(float)).max(initial=0)) * max(width, 1)
    if most < EXACT:
        return (q.astype(float) @ m.astype(float).T).astype(np.int64)
    exact = q.astype(object) @ m.astype(object).T
    return np.clip(exact, int(I64.min), int(I64.max)).astype(np.int64)


def _best(at: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best (score, then smaller id) of each query."""
    order = np.lexsort((ids, -score.astype(float) if abs(score).max(initial=0) < EXACT else np.argsort(np.argsort(-score.astype(object))), at))
    at = at[order]
    start = np.concatenate(([True], at[1:] != at[:-1]))
    first = np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))
    return order[np.arange(len(at)) - first < k]


def search_blocks(q_ids: np.ndarray, q: np.ndarray, blocks: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query place, id, score) of the k best of every query, and how many (query, block) pairs were scored."""
    high = _matrix([b[2] for b in blocks], max(len(b[2]) for b in blocks))
    low = _matrix([b[3] for b in blocks], high.shape[1])
    bound = _products(np.maximum(q, 0), high).astype(float) + _products(np.minimum(q, 0), low).astype(float)
    order = np.argsort(-bound, axis=1, kind="stable")
    kth = np.full(len(q), -np.inf)
    at, ids, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    opened, live = 0, np.arange(len(q))
    for step in range(len(blocks)):
        turn = order[live, step]
        go = bound[live, turn] >= kth[live]  # bounds fall along the order: a query that stops is done
        live, turn = live[go], turn[go]
        if not len(live):
            break
        opened += len(live)
        for b in np.unique(turn):
            who = live[turn == b]
            s = _products(q[who], blocks[b][1])
            keep = (s >= kth[who][:, None]) & (blocks[b][0][None, :] != q_ids[who][:, None])
            r, c = np.nonzero(keep)
            at, ids, score = np.concatenate((at, who[r])), np.concatenate((ids, blocks[b][0][c])), np.concatenate((score, s[r, c]))
        best = _best(at, score, ids, k)
        at, ids, score = at[best], ids[best], score[best]
        full, n = np.unique(at, return_counts=True)
        last = np.cumsum(n) - 1
        kth[full[n == k]] = score[last[n == k]]
    return at, ids, score, opened


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: float = SCALE) -> DataFrame:
    """``vectors(vec_id, embedding)``: query_id, rank, vec_id, score of each query's k best other rows."""
    usable = (vectors.where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
              .select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("v")))
    queries = usable.where(is_query).select(F.col("vec_id").alias("query_id"), "v").distinct()
    groups = max(1, math.ceil(vectors.count() / GROUP_ROWS))
    batches = max(1, math.ceil(vectors.where(is_query).count() / BATCH_ROWS))

    blocks = (usable.repartitionByRange(groups, "vec_id", F.xxhash64("v")).sortWithinPartitions("vec_id")
              .mapInArrow(_blocks, "first long, ids binary, matrix binary, high array<long>, low array<long>")
              .withColumn("grp", F.pmod(F.xxhash64("first"), F.lit(groups)))
              .withColumn("batch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(batches - 1).cast("long")))))
    asked = (queries.withColumn("batch", F.pmod(F.xxhash64("query_id", "v"), F.lit(batches)))
             .withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))))

    schema = pa.schema([("query_id", pa.int64()), ("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        rows = left["v"].to_pylist()
        q = _matrix(rows, max(map(len, rows)))
        found = []
        for ids, m, high, low in zip(*(right[c].to_pylist() for c in ("ids", "matrix", "high", "low"))):
            ids = np.frombuffer(ids, np.int64)
            found.append((ids, np.frombuffer(m, np.int64).reshape(len(ids), -1) if high else np.zeros((len(ids), 0), np.int64), high, low))
        q_ids = left["query_id"].to_numpy()
        at, ids, score, _ = search_blocks(q_ids, q, found, k)
        mark = left["q"].to_numpy()
        return pa.table([q_ids[at], mark[at], ids, score], schema=schema)

    found = (asked.withColumn("q", F.xxhash64("v")).groupBy("batch", "grp").cogroup(blocks.groupBy("batch", "grp"))
             .applyInArrow(search, "query_id long, q long, vec_id long, score long"))
    rank = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


#: The query over the registered table, in DuckDB SQL.
ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5
"""
