import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from pitchside.llm import queries, suffix_tree_lm as lm
from tests.llm.util import documents, frame


class Brute:
    """The suffix tree as written: counts of all n-grams, states by the divergence test, the longest state decides."""

    def __init__(self, rows, held_out, depth=lm.DEPTH, min_count=lm.MIN_COUNT, divergence=lm.DIVERGENCE, prior=lm.PRIOR):
        self.depth, self.least, self.prior = depth, min_count, prior
        self.n, self.states = collections.Counter(), {}
        for d, t in rows:
            if not held_out(d):
                seq = self.tokens(t)
                for i in range(1, len(seq)):
                    self.n.update(tuple(seq[i - k:i + 1]) for k in range(min(i, depth) + 1))
        self.words = [g[0] for g in self.n if len(g) == 1]
        self.total = sum(self.n[w,] for w in self.words)
        for k in range(1, depth + 1):
            follow = collections.defaultdict(dict)
            for g, n in self.n.items():
                if len(g) == k + 1 and n >= min_count:
                    follow[g[:-1]][g[-1]] = n
            found = {}
            for ctx, stored in follow.items():
                size = self.n[ctx]
                p = {w: n / (size + prior) for w, n in stored.items()}
                q = {w: self.p(w, ctx[1:], k - 1) for w in stored}
                rest, other = 1 - sum(p.values()), max(1 - sum(q.values()), 1e-12)
                kl = sum(p[w] * math.log(p[w] / q[w]) for w in p) + rest * math.log(rest / other)
                if size * kl >= divergence:
                    found[ctx] = (p, rest / other)
            self.states.update(found)

    @staticmethod
    def tokens(text):
        return [b"", *(text or "").encode().lower().split(), b""]

    def base(self, w):
        return (self.n[w,] + 0.5) / (self.total + 0.5 * (len(self.words) + 1))

    def p(self, w, history, depth):
        out = self.base(w)
        for k in range(1, min(depth, len(history)) + 1):
            state = self.states.get(tuple(history[-k:]))
            if state:
                out = state[0].get(w, out * state[1])
        return out

    def row(self, d, text):
        seq = self.tokens(text)
        logs = [math.log10(self.p(seq[i], seq[max(0, i - self.depth):i], self.depth)) for i in range(1, len(seq))]
        return (d, len(seq) - 1, sum(self.n[w,] > 0 for w in seq[1:]), self.total, round(sum(math.log10(self.base(w)) for w in seq[1:]), 5), round(sum(logs), 5))


def out(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1


def phrases(n):
    return [(1000 + k, f"the cat sat on the mat and the dog sat on the rug n{k % 7} the cat sat on the", None, None, 8) for k in range(n)]


@pytest.mark.parametrize("options", [{}, {"depth": 2, "min_count": 1, "divergence": 2.0}, {"divergence": 5.0, "prior": 0.5}])
def test_scores_equal_brute_force(spark, options):
    rows = documents(50) + phrases(25) + [(3, "w1 w2 w1", None, None, 8)] * 2 + [(None, "w1 new-word", None, None, 11)]
    brute = Brute([(r[0], r[1]) for r in rows], out, **options)
    assert {len(c) for c in brute.states} == set(range(1, options.get("depth", lm.DEPTH) + 1))
    got = lm.score_corpus(frame(spark, rows, extra=True), queries.crc_mod("doc_id", 5) == 1, **options).collect()
    want = sorted((brute.row(r[0], r[1]) for r in rows), key=repr)
    have = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in got), key=repr)
    assert [h[:4] for h in have] == [w[:4] for w in want]
    for h, w in zip(have, want):
        assert h[4:] == pytest.approx(w[4:], abs=2e-5)
    assert any(r[-1] != r[-2] for r in want)


def test_every_state_is_a_distribution():
    """Over all known words and one that is not known (what it gets at the root is the smoothing of one more word)."""
    rows = [(r[0], r[1]) for r in documents(50) + phrases(25)]
    brute = Brute(rows, out, divergence=3.0)
    assert len(brute.states) > 20
    for ctx in brute.states:
        assert sum(brute.p(w, ctx, len(ctx)) for w in [*brute.words, b"\0"]) == pytest.approx(1)


def test_contexts_help_on_held_out_text(spark):
    rows = [(k, "the cat sat on the mat and the dog sat on the rug " + " ".join(f"n{k}x{j}" for j in range(3)), None, None, 0) for k in range(100)]
    got = lm.score_corpus(frame(spark, rows), queries.crc_mod("doc_id", 5) == 1).where(queries.crc_mod("doc_id", 5) == 1).collect()
    assert got and all(r.score > r.base_score for r in got)


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert lm.score_corpus(empty, F.lit(False)).collect() == []
    untrained = lm.score_corpus(frame(spark, [(1, "a b", None, None, 3)]), F.lit(True)).first()
    assert (untrained.train_tokens, untrained.n_tokens, untrained.n_known) == (0, 3, 0)


def test_a_rare_phrase_is_modelled_whatever_the_size(spark):
    phrase = "a b c x1 a b d x2 q b c x3 q b d x4"       # only three words say what follows
    def gain(n):
        rows = [(k, phrase, None, None, 0) for k in range(30)] + [(1000 + k, " ".join(f"n{k}y{j}" for j in range(60)), None, None, 0) for k in range(n)]
        got = lm.score_corpus(frame(spark, rows), F.col("doc_id") == 7).where("doc_id = 7").first()
        return got.score - got.base_score
    small, large = gain(20), gain(2000)                  # 30 times are 2e-4 of the larger table's tokens
    assert large > small > 10
    rows = [(k, phrase, None, None, 0) for k in range(30)]
    two, three = (lm.score_corpus(frame(spark, rows), F.col("doc_id") == 7, depth=d, divergence=5.0).where("doc_id = 7").first().score for d in (2, 3))
    assert three > two


def test_keys_and_counts_travel_in_planes_that_compress():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 58, 5000, dtype=np.uint64)) + np.uint64(63 << 58)
    assert (lm.from_steps(lm.steps(keys)) == keys).all() and lm.from_steps(lm.steps(keys[:0])).size == 0
    for x in (rng.integers(0, 9, 5000), rng.normal(size=50), np.zeros(0, np.int64), np.arange(7, dtype=np.int32)):
        assert (lm.from_planes(lm.planes(x), x.dtype.type) == x).all()
    counts = rng.integers(1, 9, 5000)
    plain, packed = (len(zlib.compress(b, 1)) for b in (keys.tobytes() + counts.tobytes(), lm.steps(keys) + lm.planes(counts)))
    assert packed < 0.8 * plain


def test_tables_of_used_levels_are_deleted(spark, monkeypatch):
    from pathlib import Path
    from urllib.parse import urlparse
    seen, write = [], lm.materialize

    def watched(df, tag, *by, **options):
        out = write(df, tag, *by, **options)
        seen.append((tag, Path(urlparse(out._written_to).path)))
        return out

    monkeypatch.setattr(lm, "materialize", watched)
    assert lm.score_corpus(frame(spark, phrases(25)), F.col("doc_id") == 7).count() == 25
    left = {tag for tag, path in seen for f in path.rglob("*.parquet") if "level=1" not in f.parent.name}
    assert {t for t, _ in seen} >= {"lm_grams", "lm_level", "lm_values"} and left == {"lm_sent", "lm_addends"}


def test_distinct_is_unique_also_where_only_the_last_bits_differ():
    rng = np.random.default_rng(6)
    for keys in (rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2), rng.integers(0, 900, 5000, dtype=np.uint64), np.zeros(0, np.uint64),
                 np.array([5, 3, 5, 4, 3], np.uint64), np.uint64(63 << 58) + rng.integers(0, 60, 3000, dtype=np.uint64)):
        for a, b in zip(lm.distinct(keys), np.unique(keys, return_index=True, return_inverse=True)):
            assert (a == b).all() and len(a) == len(b)


def test_hashes_are_of_words_between_ascii_blanks():
    texts = ["", "   \n\t ", " Two  WORDS\x0bvt\x0cff\r", "ÀÉ Straße\x85nel x  y \x1cz", "a", "a" * 3000]
    for text, got in zip(texts, lm.hashed(pa.array(texts))):
        words = text.encode().lower().split()
        assert got.tolist() == [int(lm.END), *(xxhash.xxh64_intdigest(w) for w in words), int(lm.END)]
    assert lm.hashed(pa.array([], pa.string())) == []


def test_addends_are_asked_for_in_two_turns_when_all_else_is_deleted(spark, monkeypatch):
    from pathlib import Path
    from urllib.parse import urlparse
    seen, turns, write = [], [], lm.materialize

    def watched(df, tag, *by, **options):
        out = write(df, tag, *by, **options)
        if tag == "lm_addends":   # what is there while they are written
            turns.append({(t, f.parent.name if "level=" in f.parent.name else "") for t, path in seen for f in path.rglob("*.parquet")})
        seen.append((tag, Path(urlparse(out._written_to).path)))
        return out

    monkeypatch.setattr(lm, "materialize", watched)
    assert lm.score_corpus(frame(spark, phrases(25)), F.col("doc_id") == 7).count() == 25
    first, second = turns
    assert {t for t, _ in first} == {"lm_sent", "lm_values"} and {t for t, _ in second} == {"lm_sent", "lm_values", "lm_addends"}
    assert ("lm_values", "level=2") in first and {part for t, part in second if t == "lm_values"} <= {"level=3", "level=4"}


def test_cells_ask_for_states_only_and_one_join_is_written(spark, monkeypatch):
    """What a stored word adds follows from counts: only states are told, each once, and no key goes where none is needed."""
    seen, write = [], lm.materialize

    def watched(df, tag, *by, **options):
        out = write(df, tag, *by, **options)
        seen.append((tag, out.columns, out.select("key").collect() if tag == "lm_values" else [], out.count() if tag == "lm_level" else 0))
        return out

    monkeypatch.setattr(lm, "materialize", watched)
    rows = [(r[0], r[1]) for r in documents(50) + phrases(25)]
    got = lm.score_corpus(frame(spark, documents(50) + phrases(25)), queries.crc_mod("doc_id", 5) == 1, divergence=5.0).count()
    told = [row.key for tag, _, keys, _ in seen if tag == "lm_values" for row in keys]
    assert got == len(rows) and len(told) == len(set(told)) == len(Brute(rows, out, divergence=5.0).states)
    assert [tag for tag, *_ in seen].count("lm_joined") == 1
    assert ["key" in columns for tag, columns, *_ in seen if tag == "lm_grams"] == [False, True, False]


def test_numbers_travel_in_the_bytes_they_use(monkeypatch):
    sizes, compress = [], pa.compress
    monkeypatch.setattr(lm.pa, "compress", lambda x, **options: sizes.append(memoryview(x).nbytes) or compress(x, **options))
    rng = np.random.default_rng(8)
    for x, used in ((rng.integers(0, 200, 900), 1), (rng.integers(0, 1 << 31, 900), 4), (rng.integers(0, 1 << 47, 900), 6), (rng.normal(size=900), 8), (np.zeros(900, np.int64), 0)):
        sizes.clear()
        assert (lm.from_planes(lm.planes(x), x.dtype.type) == x).all() and sum(sizes) == used * len(x)
    keys = np.sort(rng.integers(0, 1 << 40, 900, dtype=np.uint64)) + np.uint64(63 << 58)
    sizes.clear()
    assert (lm.from_steps(lm.steps(keys)) == keys).all() and sum(sizes) <= 5 * len(keys)   # the first key is no difference


def test_a_pass_over_words_alone_places_none():
    words = np.sort(np.random.default_rng(9).integers(0, 1 << 63, 40, dtype=np.uint64))
    row = {"cell": 1, "tokens": 5, "ids": [7], "words": lm.steps(words), "often": lm.planes(np.ones(40, np.int64)), "at": b"not read",
           "size": lm.planes(np.array([5])), "train": b"\x01"}
    cell = lm.Cell(pa.table({c: [v] for c, v in row.items()}), pa.table({}), 6)
    (level,) = cell.levels(1)
    assert (level.keys == words).all() and sum(s.stop - s.start for s in level.parts.values()) == 40
