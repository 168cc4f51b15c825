import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import common, near_copies, simhash


def shingles(text, k=5):
    words = text.lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def similar(a, b):
    a, b = shingles(a or ""), shingles(b or "")
    return bool(a and b) and 5 * len(a & b) >= 4 * len(a | b)


def texts():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    common = " ".join(f"line{i}" for i in range(12))
    out = [None, "", "one", "ONE", "a b c d", "a b c d e"]
    for n in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        out.append(common + " " + " ".join(base))
        for _ in range(rng.randint(0, 4) if n else 60):
            copy = list(base)
            for _ in range(rng.randint(1, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(common + "\n" + " ".join(copy))
    # 8 of the 10 shingles of the union are shared.
    out += [" ".join(f"x{i}" for i in range(13)), " ".join(f"x{i}" for i in range(12)) + " y"]
    out += [" ".join(f"z{i}" for i in range(12)), " ".join(f"z{i}" for i in range(14))]
    return out


def drop_near_copies(df):
    """Only the second signature: no fingerprint is a group."""
    return simhash.keep_first(df, k=5, similarity=0.8)


@pytest.fixture(autouse=True)
def no_fingerprint_groups(monkeypatch, request):
    """For all but the pipeline's test, each document is a component of its own."""
    if "pipeline" not in request.node.name:
        monkeypatch.setattr(simhash, "near_duplicates", lambda df, *a: df.select("_place", F.col("_place").alias("component_id")))


def check(rows, kept):
    """No two that stay are near copies; each that goes has a near copy before it; columns and rows are whole."""
    place = lambda r: (r[0] is None, r[0] or 0)
    left = [r[1] for r in kept]
    assert not any(similar(left[i], left[j]) for i in range(len(left)) for j in range(i))
    for r in rows:
        if r not in kept:
            assert any(o is not r and similar(o[1], r[1]) and place(o) <= place(r) for o in rows), r[0]


def test_no_near_copies_stay_and_only_they_go(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    out = drop_near_copies(df)
    assert out.columns == df.columns
    kept = [tuple(r) for r in out.collect()]
    assert 0 < len(kept) < len(rows) and set(kept) <= set(rows)
    check(rows, kept)
    # Exactly 0.8 is near: of each of the last two couples one stays.
    assert sum(r[1].startswith(("x0 ", "z0 ")) for r in kept if r[1]) == 2


@pytest.mark.parametrize("held", [3, 1000])
def test_turns_over_large_groups_lose_nothing(spark, monkeypatch, held):
    for name, n in (("SHORT", 1), ("PAIRS", 5), ("LIST", 5), ("HELD", held)):
        monkeypatch.setattr(near_copies, name, n)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 3)
    rows = [(i, t, "x") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(rows, [tuple(r) for r in drop_near_copies(df).collect()])


def test_null_and_repeated_ids_keep_clean_documents(spark):
    far = [(None, " ".join(f"{c}{i}" for i in range(30)), "x") for c in "abc"]
    rows = [*far, (1, far[0][1] + " end", "x"), (7, "p q r s t u", "x"), (7, "k l m n o p", "x"), (None, None, "x")]
    kept = [tuple(r) for r in drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, rows[1:]))
    assert drop_near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pipeline_drops_near_copies_beyond_the_fingerprints_radius(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id in (1, 177)")
    assert simhash.keep_first(docs).count() == 2
    assert [r["doc_id"] for r in corpus_pipeline.STAGES[1][1](spark, docs, sf_dir).collect()] == [1]


def test_lists_that_do_not_shrink_are_paired_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(near_copies, "LIST", 5)
    rows = [(h, 1000 - i, i, 10 << 32) for h, n in ((1, 23), (2, 5), (3, 1)) for i in range(n)]
    lists = spark.createDataFrame(rows, "_h long, _ord long, _row long, _spot long")
    got = sorted((r["_x"], r["_y"]) for r in near_copies.all_pairs(lists, near_copies.Fraction("0.8"), "file://" + str(tmp_path)).collect())
    assert got == sorted((j, i) for n in (23, 5) for i in range(n) for j in range(i + 1, n))


def test_hot_lists_are_compared_with_their_first(spark):
    rows = [(7, 50 - i, i, (10 << 32) + 1) for i in range(20)] + [(8, 1, 3, (10 << 32)), (8, 2, 4, (40 << 32))]
    out = near_copies.hot_turn(spark.createDataFrame([(*r, True) for r in rows], "_h long, _ord long, _row long, _spot long, _hot boolean"), near_copies.Fraction("0.8")).collect()
    assert sorted((r["_x"], r["_y"]) for r in out if r["_x"] is not None) == [(19, i) for i in range(19)]
    assert sorted((r["_h"], r["_row"]) for r in out if r["_x"] is None) == [(7, i) for i in range(19)] + [(8, 4)]


def test_order_of_shingles_changes_no_result(spark, monkeypatch):
    """All shingles hot: every list is compared in the other way."""
    monkeypatch.setattr(near_copies.Order, "first", lambda self, h, n: (h[:n], np.ones(min(n, len(h)), bool)))
    rows = [(i, t, "x") for i, t in enumerate(texts())]
    check(rows, [tuple(r) for r in drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()])


def test_ids_that_are_no_numbers(spark):
    rows = [(f"id{i}", t) for i, t in enumerate(texts())]
    kept = {r["doc_id"] for r in drop_near_copies(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    left = [t for i, t in rows if i in kept]
    assert not any(similar(left[i], left[j]) for i in range(len(left)) for j in range(i))
    assert all(any(o != i and similar(t, u) for o, u in rows) for i, t in rows if i not in kept)


def test_sketches_never_tell_apart_more_than_sets_differ():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 63, 64, 65, 300, 5000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        for part in (0.0, 0.1, 0.5, 1.0):
            b = np.unique(np.concatenate([a[rng.random(len(a)) >= part], rng.integers(0, 2**63, int(n * part), dtype=np.uint64) * np.uint64(2)]))
            assert near_copies.bits_apart(near_copies.sketch(a), near_copies.sketch(b)) <= len(np.setxor1d(a, b))
        far = rng.integers(0, 2**63, max(n, 1), dtype=np.uint64) * np.uint64(2)
        assert n < 300 or near_copies.bits_apart(near_copies.sketch(a), near_copies.sketch(far)) > 1.2 * n
