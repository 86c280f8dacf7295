import hashlib
import random
import zlib

import numpy as np
import pytest

from pitchside.llm import periodic_runs as P
from tests.llm.util import documents, frame


def brute_runs(words):
    """(start, length, period) of every run, by trying each period and keeping the smallest for a stretch."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            if length >= max(12, 2 * q):
                best.setdefault((s, length), q)
    return sorted((s, length, q) for (s, length), q in best.items())


def smallest(runs, words):
    def period(s, length):
        return next(q for q in range(1, length + 1) if all(words[i] == words[i + q] for i in range(s, s + length - q)))
    return [r for r in runs if period(r[0], r[1]) == r[2]]


def brute_digest(doc_id, text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4), sha(lines), sha(kept))


def local_runs(words, tile=None):
    """The operator's tiles solved and stitched in plain Python."""
    codes = P._codes([str(w).encode() for w in words])
    found = {}
    for t in P.tiles(len(codes)):
        for q, s, e in P.fragments(codes[t[3]:t[4]], t, len(codes)):
            found.setdefault(q, []).append((s, e))
    runs = []
    for q, spans in found.items():
        whole = []
        for s, e in sorted(spans):
            if whole and s <= whole[-1][1]:
                whole[-1][1] = max(whole[-1][1], e)
            else:
                whole.append([s, e])
        runs += [(s, e - s + q, q) for s, e in whole if P.long_enough(q, s, e)]
    return sorted(runs)


def texts(rng):
    kind = rng.randrange(6)
    n = rng.randrange(1, 160)
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:
        return [rng.randrange(3) for _ in range(n)]
    if kind == 2:  # Thue-Morse words deceive hashes modulo a power of two
        return [bin(i).count("1") % 2 for i in range(n)]
    if kind == 3:  # Fibonacci words have as many runs as any
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    out = []
    while len(out) < n:
        base = [rng.randrange(50) for _ in range(rng.randrange(1, 20))]
        out += base * rng.randrange(1, 6) + base[:rng.randrange(len(base) + 1)]
    return out[:n] if kind == 4 else out


@pytest.mark.parametrize("tile", [16, 64, 8192])
def test_tiles_find_every_run(monkeypatch, tile):
    monkeypatch.setattr(P, "TILE", tile)
    monkeypatch.setattr(P, "tiles", narrow_tiles if tile == 16 else P.tiles)
    rng = random.Random(tile)
    for _ in range(700):
        words = texts(rng)
        want = brute_runs(words)
        assert smallest(want, words) == want
        assert local_runs(words) == want, words


def narrow_tiles(words):
    """Tiles of the shortest possible middle part, so that nearly every run is cut."""
    lo = 1
    while 2 * lo <= words and words >= P.LEAST:
        step = P.boundary_step(lo)
        span, margin = max(4 * lo // step, 1) * step, max(lo, step)
        for first in range(0, words, span):
            yield lo, first, min(first + span, words), max(0, first - 2 * margin), min(words, first + span + 4 * margin)
        lo *= 2


def test_z_function_and_roots():
    rng = random.Random(3)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(1, 30))]
        z = P.z_function(s)
        assert z == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        q = rng.randrange(1, len(s) + 1)
        want = next(d for d in range(1, q + 1) if q % d == 0 and all(s[k] == s[k - d] for k in range(d, q)))
        assert P.root_period(z, q) == want


def test_equal_grams_and_only_those_have_equal_hashes():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 6, 20_000).astype(np.int32)
    for step in (2, 5, 64):
        grams = [codes[i:i + step].tobytes() for i in range(len(codes) - step + 1)]
        hashes = P._gram_hashes(codes, step)
        assert len(hashes) == len(grams) and len(set(grams)) == len(np.unique(hashes)) == len(set(zip(grams, hashes.tolist())))


def table(spark, rows, extra=False):
    return frame(spark, rows, extra)


def run_rows():
    rng = random.Random(11)
    rows = documents(40)
    base = len(rows)
    for k in range(60):
        rows.append((base + k, " ".join(map(str, texts(rng))), "en", "s1", 0))
    rows += [(base + 100, "ab " * 3000 + "tail " + "x y z " * 1500, "en", "s1", 0), (None, "a " * 13, None, None, None),
             (None, "b c " * 9, None, None, None), (7, "b c " * 9, None, None, None), (7, "b c " * 9, None, None, None)]
    return rows


@pytest.mark.parametrize("short", [1 << 16, 20])
def test_digest_equals_brute_force(spark, monkeypatch, short):
    monkeypatch.setattr(P, "SHORT", short)     # 20: the tiles of nearly all documents are dealt out and stitched
    monkeypatch.setattr(P, "TILE", 256)
    rows = [r for r in run_rows() if len(r[1] or "") < 7000]
    got = P.digest(P.collapse_runs(P.with_planted_runs(table(spark, rows, extra=True)), texts=False)).collect()
    want = [brute_digest(r[0], r[1]) for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert any(r[1] for r in want) and any(not r[1] for r in want)


def test_texts_and_spans(spark):
    rows = [(1, "one two " + "la " * 14 + "end", "en", "s", 0), (2, "nothing repeats here", "en", "s", 0), (3, None, None, None, None)]
    got = {r["doc_id"]: r for r in P.collapse_runs(table(spark, rows)).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(2, 1, 14)] and got[1]["collapsed"] == "one two la end"
    assert got[2]["runs"] == [] and got[2]["collapsed"] == "nothing repeats here"
    assert got[3]["n_words"] == 0 and got[3]["collapsed"] == ""


def test_one_word_repeated_for_long(spark):
    rows = [(1, "a " * 200_000, "en", "s", 0), (2, ("p q r s t u v " * 20_000), "en", "s", 0)]
    got = {r["doc_id"]: tuple(r)[1:6] for r in P.digest(P.collapse_runs(table(spark, rows), texts=False)).collect()}
    assert got[1] == (1, 0, 200_000, 1, 200_000_000) and got[2] == (1, 0, 140_000, 7, 20_000_000)


def test_empty_table(spark):
    out = P.digest(P.collapse_runs(P.with_planted_runs(table(spark, []))))
    assert out.collect() == [] and len(out.columns) == 8


def test_tile_count_follows_words():
    assert sum(1 for _ in P.tiles(11)) == 0
    spans = [t[4] - t[3] for t in P.tiles(100_000)]
    assert sum(spans) < 2 * 100_000 * 17 and np.max(spans) <= 100_000
