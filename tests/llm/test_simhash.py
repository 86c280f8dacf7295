import itertools
import random

import numpy as np
import xxhash

from pitchside.llm import components, simhash
from tests.llm.util import documents, frame


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    parts = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, radius=3):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {f: find(f) for f in root}


def test_masks_cover_every_pair_within_the_radius():
    masks = [m % (1 << 64) for m in simhash.masks(3)]
    assert len(masks) == 15
    for bits in itertools.combinations(range(64), 3):
        diff = sum(1 << b for b in bits)
        assert any(m & diff == 0 for m in masks)


def test_near_duplicates_equal_brute_force(spark):
    rows = documents(80) + [(2, "w1 w2", None, None, 5), (None, "only null id here", None, None, 1)]
    fps = {}
    for d, t, *_ in rows:
        fps.setdefault(brute_fingerprint(t), []).append(d)
    root = groups(fps)
    members = {}
    for f, ids in fps.items():
        members.setdefault(root[f], []).extend(i for i in ids if i is not None)
    least = {r: min(ids, default=None) for r, ids in members.items()}
    expected = [(d, f"{brute_fingerprint(t):016x}", least[root[brute_fingerprint(t)]]) for d, t, *_ in rows]
    got = [tuple(r) for r in simhash.digest(simhash.near_duplicates(frame(spark, rows, extra=True))).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_links_of_dense_groups_in_chunks(spark):
    rng = random.Random(2)
    fps = set()
    for _ in range(6):
        seed = rng.getrandbits(64)
        for _ in range(120):
            x = seed
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    signed = {f: int(np.uint64(f).view(np.int64)) for f in fps}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    got = {r.node: r.root for r in components.connected_components(simhash.links(df, chunk=16)).collect()}
    parts, expected = {}, groups(fps)
    for f, r in expected.items():
        parts.setdefault(r, set()).add(signed[f])
    for members in parts.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 100)] + [(5, 5), (7, 6)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 201)} | {1000 + k: 1000 for k in range(1, 100)}


def test_one_of_each_group_stays(spark):
    rows = documents(40) + [(2, "w1 w2", None, None, 5)]
    df = frame(spark, rows, extra=True)
    kept = simhash.keep_one(df)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == df.columns and len(ids) == len(set(ids))
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    assert set(ids) == set(found.values())
    assert simhash.keep_one(frame(spark, [])).collect() == []


def test_rows_without_id_stay_for_each_group_that_has_none(spark):
    texts = [" ".join(f"t{k}x{j}" for j in range(30)) for k in range(8)]
    rows = [(1, texts[0], None, None, 0), (None, texts[0], None, None, 0)]                # group of id 1
    rows += [(None, t, None, None, 0) for t in texts[1:6]] + [(None, texts[1], None, None, 0)] * 2
    rows += [(7, texts[6], None, None, 0), (7, texts[0], None, None, 0)]                  # stands for one group only
    rows += [(8, texts[7], "en", None, 0), (8, texts[7], "de", None, 0)]
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(frame(spark, rows, extra=True)).collect()), key=repr)
    assert got == sorted([(1, texts[0]), *((None, t) for t in texts[1:6]), (7, texts[6]), (8, texts[7])], key=repr)


def test_the_text_of_a_repeated_id_does_not_depend_on_the_partitions(spark):
    rows = [(k % 10, " ".join(f"t{k}x{j}" for j in range(20)), None, None, 0) for k in range(40)]
    got = [sorted(tuple(r) for r in simhash.keep_one(frame(spark, rows, parts=n)).select("doc_id", "text").collect()) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 10
