import random

import numpy as np
from xxhash import xxh64_intdigest

from lakeloom.llm import simhash

SCHEMA = "doc_id long, text string, a string, b int, component_id string"


def brute_print(text, k=4, seed=42):
    import re

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxh64_intdigest(s.encode(), seed) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=4):
    ids = sorted(range(len(prints)))
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ids:
        for j in ids[:i]:
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in ids]


def documents():
    rng = random.Random(7)
    words = [f"Wörd{i}" for i in range(300)]
    out = [None, "", " \t\n", "one", "one two three", "A b C d", "a B c D"]
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append("\n".join(copy))
            base = copy if rng.random() < 0.5 else base
    out += [out[9]] * 6 + ["x" * 200_000, "long " * 50_000]
    return out


def test_matches_brute_force(spark):
    texts = documents()
    df = spark.createDataFrame([(i, t, "x", 1, "clash") for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(df).collect()}
    prints = [brute_print(t) for t in texts]
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i in range(len(texts))] == brute_components(prints)


def test_links_lose_nothing_in_dense_balls_split_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 50)
    monkeypatch.setattr(simhash, "WALK", 20)
    rng = random.Random(3)
    prints = set()
    for centre in (rng.getrandbits(64), rng.getrandbits(64)):
        for _ in range(400):
            x = centre
            for _ in range(rng.randint(0, 6)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(200)}
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    top = "file://" + str(tmp_path)
    nodes = spark.createDataFrame([(x,) for x in signed], "_fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, 4, top), top).collect()}
    mine = [roots.get(x, x) for x in signed]
    want = brute_components(prints)
    groups = lambda labels: sorted(tuple(i for i, y in enumerate(labels) if y == x) for x in set(labels))
    assert groups(mine) == groups(want)


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    rows = [(1, "a b c d e f", "x", 1, "p"), (1, "a b c d e f", "x", 1, "p"), (None, "q r s t u v w", None, None, None), (5, "A b c d e f", "y", 2, "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in simhash.near_duplicates(df).collect()) == [(-1, -1), (1, 1), (1, 1), (5, 1)]
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1]


def test_keep_first_keeps_unrelated_rows_of_null_or_repeated_ids(spark):
    far = {c: " ".join(f"{c}{i}" for i in range(40)) for c in "abcdef"}
    rows = [(None, far["a"], "x", 1, "p"), (None, far["b"], "x", 2, "p"), (None, far["b"], "x", 3, "p"), (7, far["c"], "x", 4, "p"), (7, far["d"], "x", 5, "p")]
    # Of two texts under id 9 one is a copy of id 8's.
    rows += [(8, far["e"], "x", 6, "p"), (9, far["e"].upper(), "x", 7, "p"), (9, far["f"], "x", 8, "p")]
    kept = simhash.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r["b"] for r in sorted(kept, key=lambda r: r["b"]) if r["b"] not in (2, 3)] == [1, 4, 5, 6, 8]
    assert sum(r["text"] == far["b"] for r in kept) == 1


def test_fingerprints_that_share_segments_link_in_no_long_time():
    import time

    rng = np.random.default_rng(5)
    for shared in (13, 26):
        fp = np.unique(rng.integers(0, 2**63, 50_000, dtype=np.uint64) >> np.uint64(shared) << np.uint64(shared))
        near = fp[:2000] ^ (np.uint64(1) << np.uint64(40)) ^ (np.uint64(1) << np.uint64(60)) ^ (np.uint64(1) << np.uint64(63))
        fp = np.unique(np.concatenate([fp, near]))
        began = time.time()
        labels = simhash.link_sorted(fp, np.zeros(len(fp), np.int64), np.zeros(len(fp), np.int64), 4)
        assert time.time() - began < 20
        at = np.searchsorted(fp, near)
        assert (labels[at] == labels[np.searchsorted(fp, near ^ (np.uint64(1) << np.uint64(40)) ^ (np.uint64(1) << np.uint64(60)) ^ (np.uint64(1) << np.uint64(63)))]).all()


def test_components_with_hot_centres(spark, tmp_path, monkeypatch):
    from lakeloom.llm import common

    monkeypatch.setattr(common, "HOT", 3)
    rng = random.Random(8)
    edges = {(i, 0) for i in range(1, 60)} | {(500, i) for i in range(100, 160)} | {(200 + i + 1, 200 + i) for i in range(50)} | {(a, b) for a, b in ((rng.randrange(600, 700), rng.randrange(600, 700)) for _ in range(60)) if a > b}
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = simhash.components(spark.createDataFrame(sorted(edges), "a long, b long"), "file://" + str(tmp_path)).collect()
    assert sorted((r["node"], r["root"]) for r in got) == sorted((x, find(x)) for x in root if find(x) != x)
