import math
import re
import random
from collections import Counter

from pyspark.sql import functions as F

from pitchside.llm import quality_rules as R
from tests.llm.util import SCHEMA, documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            n < 10 or 100 * len(covered) > 20 * n)


def brute_fit(rows, names, rounds=R.ROUNDS):
    """The same model from single documents instead of counted patterns."""
    share, acc = R.SHARE, {n: R.BELIEF for n in names}
    for _ in range(rounds):
        good = []
        for r in rows:
            odds = math.log(share / (1 - share)) + sum(r[n] * math.log(acc[n] / (1 - acc[n])) for n in names)
            good.append(1 / (1 + math.exp(-odds)))
        new = {}
        for n in names:
            voted = sum(r[n] != 0 for r in rows)
            right = sum(g if r[n] == 1 else 1 - g for r, g in zip(rows, good) if r[n])
            new[n] = R._inside((right / voted + R.BELIEF) / 2) if voted else R.BELIEF
        share_new = R._inside(sum(good) / len(rows))
        moved = max(abs(share_new - share), *(abs(new[n] - acc[n]) for n in names))
        share, acc = share_new, new
        if moved < R.TOLERANCE:
            break
    return share, acc, good


def junk(rng):
    rows = documents(60)
    for k in range(12):
        rows.append((200 + k, " ".join(f"w{rng.randrange(90)}%%%" for _ in range(40)), "en", "s1", 0))
        rows.append((300 + k, "same old line here now\n" * rng.randrange(2, 9) + " ".join(f"v{i}" for i in range(rng.randrange(60))), "en", "s1", 0))
        rows.append((400 + k, " ".join(f"SHOUT{rng.randrange(90)}!!" for _ in range(30)), "en", "s1", 0))
    return rows + [(None, "a b", None, None, None), (None, None, None, None, None), (7, "x y z", None, None, None), (7, "x y z", None, None, None)]


def test_measures_and_model_equal_brute_force(spark):
    rows = junk(random.Random(4))
    got = R.judge(frame(spark, rows, extra=True))
    assert {"score", "shard", "key"} <= set(got.columns)
    names = [r.name for r in R.rules()]
    found = [r.asDict() for r in got.collect()]
    base = sorted(((r["doc_id"], *[r[c] for c in R.MEASURES]) for r in found), key=repr)
    assert base == sorted(((r[0], *brute_base(r[1])) for r in rows), key=repr)
    share, acc, good = brute_fit([{n: r[f"vote_{n}"] for n in names} for r in found], names)
    model = R.fit(got, names)
    assert abs(model.share - share) < 1e-3 and all(abs(model.accuracy[n] - acc[n]) < 1e-3 for n in names)
    for r, g in zip(found, good):
        assert abs(r["posterior"] - g) < 2e-2 and r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)


def test_windows_whose_hashes_clash_are_told_apart_by_their_words(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(k, " ".join(f"w{rng.randrange(4)}" for _ in range(rng.randrange(1, 200))), "en", "s", 0) for k in range(40)]
    for bits in (24, 63, 6):  # 63: no bit of the hash is left, every window clashes; 6: texts of 63 words and more sort the words
        monkeypatch.setattr(R, "PLACE_BITS", bits)
        df = R.with_repeat_words(frame(spark, rows).withColumn("_words", R.words_of(F.col("text"))))
        assert sorted((r["doc_id"], r["n_repeat_words"]) for r in df.collect()) == [(r[0], brute_base(r[1])[4]) for r in rows]


def test_no_single_rule_decides_and_faults_add_up(spark):
    voted = R.VoteModel(0.85, {"a": 0.8, "b": 0.8})
    one, two = (spark.range(1).select(F.lit(-1).alias("vote_a"), F.lit(v).alias("vote_b")).select(voted.posterior()).first()[0] for v in (0, -1))
    assert one > 0.5 > two


def test_empty_table_and_keep_good(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert R.judge(empty).collect() == []
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.choice((2, 3, 6, 7, 8))))
    rows = [(k, " ".join(" ".join(word() for _ in range(9)) + "." for _ in range(6)), "en", "s", 0) for k in range(30)] + [(99, "short", "en", "s", 0)]
    kept = R.keep_good(frame(spark, rows, extra=True))
    assert kept.columns == frame(spark, rows, extra=True).columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(30))


def test_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").dropDuplicates(["doc_id"])
    judged = R.judge(docs, ["doc_id"]).join(labels, "doc_id").groupBy("quality", "base_failed", "kept").count().collect()
    n = {(r[0], r[1], r[2]): r[3] for r in judged}
    assert n[(1, False, True)] >= 0.99 * (n[(1, False, True)] + n.get((1, False, False), 0))
    assert n[(0, False, False)] >= 0.9 * (n[(0, False, False)] + n.get((0, False, True), 0))
