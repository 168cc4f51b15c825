import random

from pyspark.sql import functions as F

from lakeloom.llm import chat_format as c

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(9)
    alphabet = ["<", "|", "\\", "<|end|>\n", "<|turn|>", "<|text|>", "[INST]", "[/INST]", "<s>", "</s>", "s>", "a", "\n", "é", "🎉", "[\\INST]", "<\\|", "$1"]
    rows, want = [], {}
    for conv in range(150):
        turns = []
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "system", "tool<|text|>", ""])
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
            turns.append((role, text))
            rows.append((conv, turn, role, text, "clash"))
        want[conv] = turns
    rng.shuffle(rows)
    df = c.format_chats(spark.createDataFrame(rows, SCHEMA))
    got = {r["conv_id"]: r for r in df.select("*", c.read_turns(F.col("formatted")).alias("turns"), c.loss_text(F.col("segments")).alias("loss")).collect()}
    for conv, turns in want.items():
        r = got[conv]
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"] and r["n_turns"] == len(turns)
        bodies = r["formatted"].replace("<|turn|>", "").replace("<|text|>", "").replace("<|end|>\n", "")
        assert not any(m in bodies for m in ("<|", "[INST]", "[/INST]", "<s>", "</s>"))


def test_state_machine(spark):
    orders = {1: "ua", 2: "suaua", 3: "su", 4: "uu", 5: "au", 6: "uaus", 7: "uat", 8: "sa"}
    name = {"u": "user", "a": "assistant", "s": "system", "t": "tool"}
    rows = [(k, i, name[x], "x", None) for k, v in orders.items() for i, x in enumerate(v)]
    got = {r["conv_id"]: (r["valid"], r["broken_at"]) for r in c.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, None), 4: (False, 1), 5: (False, 0), 6: (False, 3), 7: (False, 2), 8: (False, 1)}


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(1, 0, "user", None, None), (1, 0, "user", None, None), (1, None, None, "first", None), (None, 3, "assistant", "b", None), (None, 3, "assistant", "a", None), (2, 0, "assistant", "long " * 100_000, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in c.format_chats(df).select("conv_id", c.read_turns(F.col("formatted")).alias("t")).collect()}
    assert got == {1: [("", "first"), ("user", ""), ("user", "")], None: [("assistant", "a"), ("assistant", "b")], 2: [("assistant", "long " * 100_000)]}
    assert c.format_chats(df.limit(0)).collect() == []
