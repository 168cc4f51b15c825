import random

from pyspark.sql import functions as F

from lakeloom.llm import decontaminate


def tables(spark):
    rng = random.Random(5)
    words = ["the", "of", "and", "Für", "x1", "42", "it's", "ÉTÉ", "end"] + [f"w{i}" for i in range(40)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, line(rng.choice([1, 2, 3, 5, 9, 10, 11, 30]) if i > 4 else 25)) for i in range(30)]
    items = [x for x in items if len(x[1].split()) > 3 or x[0] % 7 == 0] + [(3, items[3][1]), (90, None), (91, "-- !!"), (None, line(12)), (92, "the end the end the end the end the end the end")]
    docs = [(i, line(rng.randint(0, 80))) for i in range(60)]
    for i in range(60, 110):
        text = rng.choice([x[1] for x in items if x[1]]).split()
        a = rng.randrange(len(text))
        cut = text[a : a + rng.randint(5, 30)]
        docs.append((i, line(rng.randint(0, 20)) + ", " + "\n".join(cut).upper().lower() + ". " + line(3)))
    docs += [(200, None), (201, ""), (202, "... \n"), (203, "the end " * 3000), (203, "the end " * 3000), (None, items[0][1])]
    schema = "doc_id long, text string, n_hit string"
    return spark.createDataFrame([(*d, "clash") for d in docs], schema), spark.createDataFrame(items, "item_id long, text string"), docs, items


def result(df):
    rows = df.select("doc_id", "n_words", "n_hit", F.size("items"), decontaminate.digest(F.col("items")), "contaminated").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_matches_brute_force(spark):
    docs, items, d, b = tables(spark)
    want = sorted(((i, *decontaminate.brute_force(t, b)) for i, t in d), key=str)
    assert any(w[-1] for w in want) and not all(w[-1] for w in want)
    assert result(decontaminate.find_benchmark(docs, items)) == want


def test_many_blocks_and_small_pieces_agree(spark, monkeypatch):
    docs, items, d, b = tables(spark)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    every = list(decontaminate.blocks(items, 10, "item_id", "text"))
    assert len(every) > 3 and all(sum(len(t.text) for t in block) <= 60 for block in every)
    want = sorted(((i, *decontaminate.brute_force(t, b)) for i, t in d), key=str)
    assert result(decontaminate.find_benchmark(docs, items)) == want
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(w[0]) for w in want if not w[-1])


def test_empty_tables(spark):
    docs, items, d, _ = tables(spark)
    assert not any(r["contaminated"] for r in decontaminate.find_benchmark(docs, items.limit(0)).collect())
    assert decontaminate.find_benchmark(docs.limit(0), items).collect() == []
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == len(d)


def test_items_longer_than_a_block_are_cut(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 40)
    words = [f"w{i}" for i in range(300)]
    items = [(1, " ".join(words)), (2, "short one")]
    d = [(i, " ".join(words[max(0, i - 3) : i + 12])) for i in range(290)] + [(900, "a short one here"), (901, "none of it"), (902, None)]
    schema = "doc_id long, text string"
    got = result(decontaminate.find_benchmark(spark.createDataFrame(d, schema), spark.createDataFrame(items, "item_id long, text string")))
    assert got == sorted(((i, *decontaminate.brute_force(t, items)) for i, t in d), key=str)
    parts = list(decontaminate.parts_of([b"x%d" % i for i in range(500)], 10))
    whole = [tuple(p[i : i + 10]) for p in parts for i in range(len(p) - 9)]
    assert whole == [tuple(b"x%d" % (i + k) for k in range(10)) for i in range(491)] and max(map(len, parts)) <= 40
