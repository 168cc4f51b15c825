import random

import numpy as np
import pytest

from lakeloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, copies string, _size int"


def rows():
    rng = random.Random(1)
    out = []
    for i in range(600):
        source = rng.choice(["a"] * 8 + ["b", "c", "é", "Z", None])
        out.append((i, " ".join(["w"] * rng.choice([1, 5, 20, 20, 20, rng.randint(1, 400)])), source, "x", 1))
    out += [(1000, None, "a", None, None), (1001, " \n", "b", None, None), (1002, None, "empty", None, None), (7, *out[7][1:]), (None, "one two", "c", None, None), (1003, "w " * 20_000, "b", None, None)]
    return out


def test_targets_share_by_weight_and_stop():
    weights = mixing.cyclic(["b", None, "a", "é", "Z"])
    assert weights == {"Z": 3, "a": 1, "b": 2, "é": 3, None: 1}
    assert mixing.targets({"a": 100, "b": 1000, "c": 1000}, {"a": 3, "b": 1, "c": 2}, 1.5, 2) == {"a": 200, "b": 2950 / 3, "c": 2 * 2950 / 3}


@pytest.mark.parametrize(("part", "near"), [(1000, 0.002), (16, 0.06)])
def test_mix_meets_targets_and_repeats(spark, monkeypatch, part, near):
    monkeypatch.setattr(mixing, "PART", part)
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    got = mixing.mix_counts(df).collect()
    again = mixing.mix_counts(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(data)
    size = {i: len((t or "").split()) for i, t, *_ in data}
    source = {i: s for i, _, s, *_ in data}
    total = {}
    for i, _, s, *_ in data:
        total[s] = total.get(s, 0) + size[i]
    want = mixing.targets(total, mixing.cyclic(list(total)), 1.5, 2)
    taken = {}
    for r in got:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], total[s]) and abs(r["target"] - want[s]) < 1e-6
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[s] = taken.get(s, 0) + r["taken"]
    near = {s: 0.5 if s == "b" else near for s in total}  # one document is most of "b"
    assert all(abs(taken[s] - want[s]) <= max(3, near[s] * want[s]) for s in total), [(s, taken[s], want[s], total[s]) for s in total]


def test_rates_are_exponentially_tilted(spark):
    cells = spark.createDataFrame([(0, 10, 0.5, 100), (0, 30, 1.5, 100), (1, 7, 1.0, 10)], "_source int, _size long, _x double, _n long")
    dual = mixing.tilt(cells, np.array([5500.0, 35.0]), np.array([4000.0, 70.0]), 2.0)
    rate = lambda x, s: min(2.0, np.exp(dual[s] * x))
    assert abs(100 * 10 * rate(0.5, 0) + 100 * 30 * rate(1.5, 0) - 5500) < 0.01
    assert abs(10 * 7 * rate(1.0, 1) - 35) < 1e-3


def test_mixed_rows_keep_their_columns(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    mixed = mixing.mix(df)
    assert mixed.schema == df.schema
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_counts(df.where("doc_id <> 7")).collect()}
    n = {}
    for r in mixed.collect():
        n[r["doc_id"]] = n.get(r["doc_id"], 0) + 1
    same = sum(n.get(i, 0) == c for i, c in copies.items())
    assert same > 0.8 * len(copies) and set(n.values()) <= {1, 2, 4}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_counts(df).collect() == [] and mixing.mix(df).collect() == []


def plain_targets(total, weights):
    """Shares by weight of 1.5 times all words, a source at a time: the one furthest above twice its size stops first."""
    left, goal, open_ = 1.5 * sum(total.values()), {}, dict(total)
    while open_:
        unit = left / sum(weights[s] for s in open_)
        over = [s for s in open_ if weights[s] * unit > 2 * open_[s]]
        if not over:
            return goal | {s: weights[s] * unit for s in open_}
        worst = max(over, key=lambda s: weights[s] / max(open_[s], 1e-9))
        goal[worst] = 2 * open_[worst]
        left -= goal[worst]
        del open_[worst]
    return goal


def test_copies_are_those_of_the_optimum_found_by_bisection(spark):
    """The optimum of each source by bisection over plain lists: copies of a size are its documents' rates in sum, but for rounding and a few moved copies."""
    import math

    data = [r for r in rows() if r[0] is not None]
    got = {}
    for r in mixing.mix_counts(spark.createDataFrame(data, SCHEMA)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    by = {}
    for i, t, s, *_ in data:
        by.setdefault(s, []).append((i, len((t or "").split())))
    order = sorted(by, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    goal = plain_targets({s: sum(n for _, n in d) for s, d in by.items()}, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)})
    for s, docs in by.items():
        total = sum(n for _, n in docs)
        assert all(abs(r["target"] - goal[s]) < 1e-6 for i, _ in docs for r in got[i])
        if not total:
            assert all(r["copies"] == 1 for i, _ in docs for r in got[i])
            continue
        mean = total / len(docs)
        words = lambda d, docs=docs, mean=mean: sum(n * min(2, math.exp(min(50, d * n / mean))) for _, n in docs if n)
        low, high = -1e6, 1e6
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if words(mid) < goal[s] else (low, mid)
        want, have = {}, {}
        for i, n in docs:
            want[n] = want.get(n, 0) + (min(2, math.exp(min(50, low * n / mean))) if n else 1)
        for i, n in {(i, n) for i, n in docs}:
            have[n] = have.get(n, 0) + sum(r["copies"] for r in got[i] if r["size"] == n)
        off = [n for n in want if abs(have[n] - want[n]) > 1 + 1e-6]
        assert len(off) <= 3 or max(want) > 0.1 * total, (s, off)  # where one document is most of a source, others make up for its rounding
        miss = goal[s] - sum(n * k for n, k in have.items())
        assert abs(miss) <= max(n for _, n in docs) / 2 + 1
        count = {n: sum(m == n for _, m in docs) for n in want}
        sizes = [n for n in want if n and (have[n] < 2 * count[n] if miss > 0 else have[n] > 0)]
        assert all(abs(abs(miss) - n) >= abs(miss) - 1e-6 for n in sizes), (s, miss)
