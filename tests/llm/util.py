"""Small tables and brute-force counterparts shared by the tests of the training-data operators."""

import hashlib
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names clash with those that the operators make.
EXTRA = ", score double, shard int, _cell string, row int, key string, fp long, label string"


def words(rng, n, pool=400):
    return " ".join(f"w{int(rng.paretovariate(0.7)) % pool}" for _ in range(n))


def documents(n=60, seed=5):
    """Rows with copies, near copies, shared passages, empty, null, blank and long texts and repeated rows."""
    rng = random.Random(seed)
    passage = words(rng, 40)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(n)]
    for k in range(0, n, 7):
        texts[k] = texts[1]
    for k in range(3, n, 9):
        texts[k] += " " + passage + " " + words(rng, 5)
    for k in range(5, n, 11):
        texts[k] = texts[2] + " tail" + str(k)
    texts += ["", None, "   \n\t ", "é" * 30 + "ß" * 25, "a " * 3000, "x" * 4000, "ÀÉ Straße İstanbul line\x0bvt\x85 nel \U0001f600 <|endoftext|> end"]
    rows = [(k, t, rng.choice(["en", None]), rng.choice(["s1", "s2", None]), None if t is None else len(t)) for k, t in enumerate(texts)]
    return rows


def frame(spark, rows, extra=False, parts=3):
    if extra:
        rows = [(*r, 1.0, 2, "c", 3, "k", 4, "l") for r in rows]
    return spark.createDataFrame(rows, SCHEMA + (EXTRA if extra else "")).repartition(parts)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
