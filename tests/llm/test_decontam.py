import hashlib
import re

from pitchside.llm import decontam
from tests.llm.util import documents, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, items):
    windows = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(i)
    out = []
    for d, t, *_ in rows:
        w = WORD.findall((t or "").translate(LOWER))
        hit, named = set(), set()
        for win, ids in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    named |= ids
        names = sorted(str(i) for i in named if i is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def cases():
    rows = documents(40)
    items = [(1, rows[3][1][-60:]), (2, "W1, w2! w3"), (3, None), (4, " ;; "), (5, rows[1][1]), (5, rows[1][1]), (6, rows[1][1]), (None, rows[2][1]),
             (7, "straße"), (8, "x" * 4000)]
    rows += [(100, "So:W1-W2.w3 w1 w2 w3; x", None, None, 0), (100, "w1 w2", None, None, 0)]
    return rows, items


def test_equals_brute_force_for_any_number_of_blocks(spark):
    rows, items = cases()
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 200):
        got = decontam.digest(decontam.contamination(frame(spark, rows, extra=True), table, block_bytes=block))
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, items)


def test_spans_point_into_the_original(spark):
    table = spark.createDataFrame([(1, "alpha Beta gamma")], "item_id long, text string")
    row = decontam.contamination(frame(spark, [(1, "É, ALPHA -- beta: (gamma) alpha beta", None, None, 0)]), table).first()
    assert [r"É, ALPHA -- beta: (gamma) alpha beta"[s.start:s.end] for s in row.spans] == ["ALPHA -- beta: (gamma"]


def test_drop_and_empty_tables(spark):
    rows, items = cases()
    df, table = frame(spark, rows, extra=True), spark.createDataFrame(items, "item_id long, text string")
    kept = decontam.drop_contaminated(df, table)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, *_, bad in brute(rows, items) if not bad)
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.n_hit for r in decontam.contamination(df, none).collect())
    assert decontam.contamination(frame(spark, []), table).collect() == []
