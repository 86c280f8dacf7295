import random

import numpy as np
import pytest

from pitchside.llm import suffix_dedup as sd
from tests.llm.util import documents, frame, sha


def brute(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            w = b[p:p + 50]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        cut = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < d:
                cut[p:p + 50] = True
        spans = int((np.diff(np.concatenate(([0], cut.astype(np.int8)))) == 1).sum())
        out.append((d, len(b), int(cut.sum()), spans, sha(np.frombuffer(b, np.uint8)[~cut].tobytes())))
    return sorted(out)


def cases(seed=1):
    rng = random.Random(seed)
    word = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))
    shared, base = [word(14) for _ in range(4)], word(60)
    rows = documents(30, seed)
    at = 200
    for k in range(40):
        parts = [word(rng.randint(0, 12)) for _ in range(3)]
        rows.append((at + k, parts[0] + rng.choice(shared)[rng.randint(0, 9):] + parts[1] + rng.choice(["", rng.choice(shared)]) + parts[2], None, None, 1))
    for k in range(10):
        cut = rng.randint(0, len(base))
        rows.append((300 + k, base[:cut] + "#" + base[cut:], None, None, 1))       # near copies
    rows += [(400, "ab" * 200, None, None, 1), (401, "ab" * 100, None, None, 1), (402, "z" * 49, None, None, 1), (403, "z" * 49, None, None, 1), (404, "z" * 50, None, None, 1),
             (405, "z" * 50, None, None, 1), (405, "z" * 50, None, None, 1), (406, "z" * 51, None, None, 1), (406, base, None, None, 1), (406, base + "x", None, None, 1)]
    return rows


@pytest.mark.parametrize("hot, seed", [(2000, 1), (3, 2)])
def test_equals_brute_force(spark, monkeypatch, hot, seed):
    monkeypatch.setattr(sd, "HOT", hot)
    monkeypatch.setattr(sd, "CELL_BITS", 4)
    rows = cases(seed)
    got = sorted(tuple(r) for r in sd.removal_digest(frame(spark, rows, extra=True)).collect())
    assert got == brute([(d, t) for d, t, *_ in rows])


def test_sort_is_the_order_of_the_suffixes():
    rng = np.random.default_rng(3)
    data = rng.choice(np.frombuffer(b"ab", np.uint8), 3000)
    data[500:700] = data[100:300]
    data[1500:1700] = data[100:300]
    start = rng.permutation(2900)[:1200]
    group = np.sort(rng.integers(0, 40, 1200))
    order = sd.Suffixes(data).sort(start, group)
    raw = data.tobytes()
    for g in range(40):
        own = order[group == g]
        assert sorted(own) == list(np.flatnonzero(group == g))
        keys = [raw[s:s + 50] for s in start[own]]
        assert keys == sorted(keys)
    runs = sd.Suffixes(data).equal_runs(start, group)
    assert len(set(zip(runs, group))) == len({(raw[s:s + 50], g) for s, g in zip(start, group)})


def test_every_window_names_the_same_anchors():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 256, 400).astype(np.uint8)
    b = np.concatenate((rng.integers(0, 256, 77).astype(np.uint8), a[100:160], rng.integers(0, 256, 31).astype(np.uint8)))
    pa, pb = (set(sd.anchors(x)[0].tolist()) for x in (a, b))
    for p in range(11):
        one = {x - 100 - p for x in pa if 100 + p <= x <= 100 + p + 26}
        two = {x - 77 - p for x in pb if 77 + p <= x <= 77 + p + 26}
        assert one & two


def test_removal_keeps_rows_and_columns(spark):
    rows = cases()
    df = frame(spark, rows, extra=True)
    got = sd.remove_repeats(df)
    assert got.columns == df.columns
    kept = {r.doc_id: r for r in got.collect()}
    assert len(kept) == len({d for d, *_ in rows}) and got.count() == len(rows)
    assert kept[405].text == "" and kept[405].n_chars == 0 and kept[404].text == "z" * 50
    assert sd.remove_repeats(frame(spark, [])).collect() == []
    assert sd.removal_digest(frame(spark, [])).collect() == []


def test_null_id_is_the_largest(spark):
    text = "passage " * 12
    got = {r.doc_id: r.n_removed for r in sd.removal_digest(frame(spark, [(5, text, None, None, 1), (None, text + "more", None, None, 1)])).collect()}
    assert got == {5: 0, None: len(text)}


def test_hot_anchors_are_told_by_their_occurrences(spark, monkeypatch):
    monkeypatch.setattr(sd, "HOT", 100)
    rows = [(1, "x" * 300, None, None, 0), (2, "a" + "x" * 400 + "b" + "y" * 60, None, None, 0)] + [(k, "q" * 9 + str(k) + "y" * 61, None, None, 0) for k in (3, 4)]
    got = sorted(tuple(r) for r in sd.removal_digest(frame(spark, rows)).collect())
    assert got == brute([(d, t) for d, t, *_ in rows])


@pytest.mark.parametrize("bits", [2, 11])
def test_an_anchor_in_a_third_of_all_rows(spark, monkeypatch, bits):
    monkeypatch.setattr(sd, "HOT", 20)
    monkeypatch.setattr(sd, "CELL_BITS", bits)       # 2: four rows a cell, so the windows of the line meet across many cells
    rng = random.Random(8)
    line = "this very line stands in a third of all the documents, with other words around it"
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(3, 7)))
    rows = []
    for k in range(240):
        words = [word() for _ in range(rng.randint(5, 25))]
        if k % 3 == 0:
            words.insert(rng.randrange(len(words)), line[rng.choice([0, 0, 7]):])
        rows.append((rng.choice([k, 1000 - k]), " ".join(words), None, None, 0))
    got = sorted(tuple(r) for r in sd.removal_digest(frame(spark, rows, parts=4)).collect())
    assert got == brute([(d, t) for d, t, *_ in rows])
    assert sum(r[2] > 0 for r in got) >= 70


def test_opened_windows_are_numbered_by_their_bytes():
    rng = np.random.default_rng(2)
    doc, left = rng.integers(0, 9, 40), rng.integers(0, sd.LEFT + 1, 40).astype(np.uint8)
    right = rng.integers(0, sd.WINDOW + 1, 40).astype(np.uint8)
    context = rng.integers(0, 2, (40, sd.WIDTH)).astype(np.uint8)
    context[20:] = context[:20]
    seen = set()
    for o, k, own, body, least in sd.opened(doc, left, right, context):
        windows = [bytes(context[i, sd.LEFT - o:sd.LEFT - o + sd.WINDOW]) for i in k]
        assert [bytes(body[w]) for w in own] == windows and [bytes(x) for x in body] == sorted(set(windows))
        assert least.tolist() == [min(d for d, w in zip(doc[k], windows) if w == bytes(b)) for b in body]
        seen |= {(i, o) for i in k}
    assert seen == {(i, o) for i in range(40) for o in range(sd.LEFT + 1) if sd.WINDOW - int(right[i]) <= o <= left[i]}


def test_cells_are_cut_by_bytes_and_runs_are_one_record(spark, monkeypatch):
    monkeypatch.setattr(sd, "CELL_BYTES", 1000)
    rows = [(k, f"{k} " + "xy" * 300, None, None, 0) for k in range(6)] + [(9, "z" * 5000, None, None, 0)]
    cells, _, name = sd.covered_spans(frame(spark, rows, parts=1))
    assert cells.select(name["cell"]).distinct().count() == 7
    t = cells.where("doc_id = 9").select("doc_id", "text", *(name[c] for c in ("row", "key"))).toArrow()
    cell = sd.Cell(t, t.slice(0, 0), "text", name["row"], name["key"])
    heads, last = cell.merged(*cell.anchors())
    assert len(heads) < 100 and last.max() == 5000 - sd.GRAM


def test_anchors_of_a_long_text_in_pieces(monkeypatch):
    data = np.random.default_rng(6).choice(np.frombuffer(b"ab", np.uint8), 3000)
    whole = sd.anchors(data)
    monkeypatch.setattr(sd, "PIECE", 100)
    assert all((x == y).all() for x, y in zip(whole, sd.anchors(data)))
