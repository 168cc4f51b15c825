import numpy as np
import pytest

from lakeloom.llm import quality_model as m


def test_em_recovers_accuracies_of_overlapping_labellers():
    rng = np.random.default_rng(1)
    n, k = 40_000, len(m.LABELLERS)
    good = rng.random(n) < 0.8
    catch = np.linspace(0.3, 0.8, k)
    votes = np.full((n, k), m.NONE)
    for j in range(k):
        symptom = np.where(good, rng.random(n) < 0.02, rng.random(n) < catch[j])
        votes[symptom, j] = m.JUNK
        judge = m.LABELLERS[j] in ("ordinary_words", "sentence_ends")
        votes[~symptom & good & judge, j] = m.GOOD
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    classes, chances = m.fit_accuracies(patterns, counts.astype(float))
    assert abs(classes[m.GOOD] - 0.8) < 0.05
    assert all(abs(chances[j, m.JUNK, m.JUNK] - catch[j]) < 0.12 for j in range(k))
    sure = m.posterior(votes, classes, chances) > 0.5
    assert (sure == good).mean() > 0.97


def test_held_out_accuracy(spark):
    top = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{top}/documents.parquet"), spark.read.parquet(f"{top}/labels.parquet")
    scored = m.score_quality(docs)
    rows = scored.join(labels, "doc_id").select("kept", "posterior", "quality").collect()
    clean, junk = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    assert len(clean) > 200 and len(junk) > 30
    assert sum(r["kept"] for r in clean) >= 0.99 * len(clean)
    assert sum(not r["kept"] for r in junk) >= 0.9 * len(junk)
    again = {r["doc_id"]: r["kept"] for r in m.score_quality(docs.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["kept"] for r in scored.collect()}
    kept = m.drop_junk(docs)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, k in again.items() if k}


@pytest.mark.parametrize("text", ["", "a", " \n", "é" * 3, "x" * 100_000, "word " * 50_000])
def test_features_of_odd_texts(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    votes, steps = m.votes_of(raw, np.array([0, len(raw)]))
    assert votes.shape == (1, len(m.LABELLERS))
    x = m.features(raw, steps[0])
    assert np.isfinite(x).all() and (len(raw) < 4 or abs((x[: m.BYTE_BUCKETS] ** 2).sum() - 1) < 1e-3)


def test_nulls_repeats_clashes_and_empty(spark):
    prose = "This is an ordinary sentence, with words. " * 8
    rows = [(1, prose, "x"), (1, prose, "x"), (None, prose, None), (2, None, "y"), (3, "", "z"), (4, "WOW!! " * 60, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = m.score_quality(df).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert m.score_quality(df.limit(0)).collect() == [] and m.drop_junk(df.limit(0)).collect() == []
    every = spark.createDataFrame([(i, prose + str(i), "x") for i in range(50)], df.schema)
    assert m.drop_junk(every).count() == 50


def test_em_equals_a_plain_loop():
    import itertools
    import math
    import random

    rng = random.Random(4)
    k = 4
    patterns = [p for p in itertools.product((0, 1, 2), repeat=k) if rng.random() < 0.5]
    counts = [rng.randint(1, 400) for _ in patterns]
    prior, weight = m.PRIORS[:k].tolist(), m.PRIOR_WEIGHT * sum(counts)
    classes, chances = [0.2, 0.8], prior
    for _ in range(100):
        total, votes = [weight * 0.2, weight * 0.8], [[[weight * prior[j][c][v] for v in range(3)] for c in range(2)] for j in range(k)]
        for p, n in zip(patterns, counts, strict=True):
            like = [classes[c] * math.prod(chances[j][c][p[j]] for j in range(k)) for c in range(2)]
            for c in range(2):
                total[c] += n * like[c] / sum(like)
                for j in range(k):
                    votes[j][c][p[j]] += n * like[c] / sum(like)
        classes, chances = [t / sum(total) for t in total], [[[x / sum(votes[j][c]) for x in votes[j][c]] for c in range(2)] for j in range(k)]
    got_classes, got = m.fit_accuracies(np.array(patterns), np.array(counts, float))
    assert np.allclose(got_classes, classes, atol=1e-5) and np.allclose(got, chances, atol=1e-5)
    good = [x[1] / sum(x) for x in ([classes[c] * math.prod(chances[j][c][p[j]] for j in range(k)) for c in range(2)] for p in patterns)]
    assert np.allclose(m.posterior(np.array(patterns), got_classes, got), good, atol=1e-5)


def test_scores_equal_a_plain_computation(spark):
    """Votes, grams and steps of each text by loops; the fitted weights are the model's."""
    import math
    import re

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    model = m.fit(docs)
    rows = docs.limit(40).collect()
    got = {r["doc_id"]: r for r in m.score_quality(docs).collect()}

    def score(text):
        raw = text.encode()
        words = re.findall(rb"[^\x20\x09-\x0d]+", raw)
        mark = lambda w: [chr(b) for b in w if 32 < b < 127 and not chr(b).isalnum()]
        ended = [len(mark(w)) == 1 and w[-1:] in (b".", b",", b"!", b"?", b";", b":") for w in words]
        upper = lambda w: sum(65 <= b <= 90 for b in w)
        letters = sum(65 <= b <= 90 or 97 <= b <= 122 for b in raw)
        three = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        pairs = [
            (sum(b in b"#*$%&|<>" for b in raw), sum(map(len, words))), (upper(raw), letters), (sum(len(mark(w)) >= 2 for w in words), len(words)), (sum(len(w) == 1 == len(mark(w)) for w in words), len(words)),
            (sum(three.count(x) > 1 for x in three), len(words)), (len(set(words)), len(words)), (sum(a == b for a, b in zip(words, words[1:])), len(words)),
            (sum((not mark(w) or e) and upper(w) <= 1 and len(w) > len(mark(w)) for w, e in zip(words, ended)), len(words)), (sum(ended), len(words)),
        ]
        total = model.weights[-1]
        for j, (a, b) in enumerate(pairs):
            step = min(m.STEPS - 1, 1 + (m.STEPS - 2) * a // max(b, 1)) if a else 0
            total += 0.5 * model.weights[m.BYTE_BUCKETS + m.CLASS_BUCKETS + m.STEPS * j + step]
        kind = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in raw)
        for data, first, size in ((raw, 0, m.BYTE_BUCKETS), (kind, m.BYTE_BUCKETS, m.CLASS_BUCKETS)):
            held = {}
            for i in range(len(data) - 3):
                h = int.from_bytes(data[i : i + 4], "little") * 0x9E3779B1 % 2**32 >> 33 - size.bit_length()
                held[h] = held.get(h, 0) + 1
            total += sum(math.sqrt(n / (len(data) - 3)) * model.weights[first + h] for h, n in held.items())
        return 1 / (1 + math.exp(-total))

    for r in rows:
        if len(r["text"] or "") < 20_000:
            assert abs(got[r["doc_id"]]["score"] - score(r["text"])) < 1e-4, r["doc_id"]


def test_sample_is_bounded_whatever_the_repeats_and_the_size(spark, monkeypatch):
    monkeypatch.setattr(m, "TRAIN_DOCS", 30)
    prose = "This is an ordinary sentence, with words. " * 8
    rows = [(i, f"{prose} {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hot = df.unionByName(spark.range(3000).selectExpr("5L AS doc_id", f"'{prose} 5' AS text"))
    held = []
    monkeypatch.setattr(m, "train", lambda x, good: held.append((x, good)) or np.zeros(m.BUCKETS + 1))
    m.fit(df)
    m.fit(df.repartition(7))
    m.fit(hot)
    assert all(len(x) == 30 for x, _ in held)
    assert all((x == held[0][0]).all() for x, _ in held[1:]) and (held[0][1] == held[1][1]).all()
