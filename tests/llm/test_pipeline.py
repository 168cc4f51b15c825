import zlib

import numpy as np
import public_tokenizers
from test_near_copies import similar
from test_simhash import brute_components, brute_print
from tokenizers import Tokenizer

import corpus_pipeline
from lakeloom.llm import decontaminate, mixing


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(docs.collect(), key=lambda r: r["doc_id"]) if "text" in docs.columns else []
        rows = stage(spark, docs, sf_dir).collect()
        held[name] = before, rows
        if name != "token_output":
            docs = spark.createDataFrame(rows, docs.schema)
            assert docs.columns == columns
    before, rows = held["quality"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in rows}
    assert gone and not any(labels.get(i) == 1 for i in gone)
    before, rows = held["near_duplicates"]
    heads = brute_components([brute_print(r["text"], 5) for r in before])
    first, kept = sorted(set(heads)), {r["doc_id"] for r in rows}
    assert kept <= {before[i]["doc_id"] for i in first}
    near = {i: [j for j in first if j < i and similar(before[i]["text"], before[j]["text"])] for i in first}
    for i in first:  # of these a row goes only if one before it is a near copy, and of no two near copies both stay
        assert near[i] if before[i]["doc_id"] not in kept else not any(before[j]["doc_id"] in kept for j in near[i])
    before, rows = held["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert sorted(r["doc_id"] for r in rows) == [r["doc_id"] for r in before if not decontaminate.brute_force(r["text"], items)[-1]]
    before, rows = held["mixture"]
    total, taken = {}, {}
    for r in before:
        total[r["source"]] = total.get(r["source"], 0) + len(r["text"].split())
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    want = mixing.targets(total, mixing.cyclic(list(total)), 1.5, 2)
    assert sum(abs(taken.get(s, 0) - t) for s, t in want.items()) < 0.1 * sum(want.values())
    before, rows = held["token_output"]
    model, start, expected = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for r in before:
        ids = np.array(model.encode(r["text"], add_special_tokens=False).ids + [0], "<u4")
        expected.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in rows) == sorted(expected)


def test_run_returns_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0


def test_stages_take_odd_documents(spark, sf_dir):
    prose = "This is an ordinary sentence, with some words. Another one follows it, and says a bit more. " * 3
    schema = "doc_id long, text string, lang string, source string, n_chars long, _kept string, _rows int, _copies int, `a.b` string, _id string, fingerprint string"
    tail = ("k", 1, 2, "dot", "id", "print")
    rows = [(i, f"{prose} Number {i} of these texts has {i * 7919} at its end. " + " ".join(f"w{i}x{j}" for j in range(40)), "en", f"s{i % 3}", 1, *tail) for i in range(40)]
    rows += [rows[3], rows[3], (100, *rows[5][1:]), (None, None, None, None, None, *[None] * 6), (101, "", "en", "s0", 0, *tail), (102, "word " * 60_000 + prose, None, None, 1, *tail)]
    docs = spark.createDataFrame(rows, schema)
    for empty in (False, True):
        at = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, at, sf_dir)
            assert out.schema.simpleString() == docs.schema.simpleString(), name
            held = out.collect()
            assert bool(held) != empty
            if name == "near_duplicates" and not empty:
                ids = [r["doc_id"] for r in held]
                assert ids.count(3) == 1 and 100 not in ids and len(set(ids)) == len(ids)
            at = spark.createDataFrame(held, docs.schema)
        last = corpus_pipeline.STAGES[-1][1](spark, at, sf_dir)
        assert last.count() == at.count()
