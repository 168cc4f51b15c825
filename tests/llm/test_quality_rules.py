import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm import quality_rules as q


def brute(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search("[^\x20\x09-\x0d]", x) and x in lines[:i])
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(repeated)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b#%é ", max_size=80))
def test_measures_match_brute_force(text):
    assert q.measure_text(text)[:5] == brute(text)


def together(texts):
    import numpy as np
    import pyarrow as pa

    from lakeloom.llm.common import buffer_of

    found = q.measure_texts(*buffer_of(pa.array(texts, pa.string())))
    assert found.shape == (len(q.MEASURES), len(texts)) and found.dtype == np.int64
    return [tuple(x) for x in found.T.tolist()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b#%éA漢", max_size=60) | st.none(), max_size=8))
def test_texts_measured_together_are_as_alone(texts):
    assert together(texts) == [q.measure_text(t or "") for t in texts]


def test_clashing_hashes_change_nothing(monkeypatch):
    import numpy as np

    monkeypatch.setattr(q, "span_hashes", lambda raw, starts, ends: ((ends - starts) % 2).astype(np.uint64))
    texts = ["a b c a b c", "x yy x yy x", "l\nm\nl\nnn", "", "a a a a", "ab cd ab cd ab cd"]
    assert together(texts) == [q.measure_text(t) for t in texts]


def test_ledger_policies_and_ablations(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    texts = [clean, clean.upper(), clean.replace(" ", "%%% "), "a b c " * 40, "too short", None, "", "line\n" * 200, clean + " x" * 20_000]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(0, clean, "z"), (None, clean, None)], "doc_id long, text string, n_words string")
    rows = q.ledger(df)
    got = {r["doc_id"]: r for r in rows.collect()}
    assert got[0]["failures"] == 0 and got[None]["failures"] == 0
    assert got[1]["failures"] == 1 << q.BIT["capitals"]
    assert got[2]["failures"] == 1 << q.BIT["many_symbols"]
    assert got[5]["failures"] == got[4]["failures"] | 0 == 1 << q.BIT["few_words"]
    kept = {v: {r["doc_id"] for r in rows.where(q.passes(v)).collect()} for v in q.POLICIES}
    assert kept["v2"] == {0, None} and kept["base"] >= kept["v1"] >= kept["v2"] and 1 in kept["v1"]
    every = rows.collect()
    for r in q.ablations(rows, "v2").collect():
        failing = [x["failures"] & q.mask("v2") for x in every if x["failures"] & r["bit"]]
        assert (r["n_failed"], r["n_only"]) == (len(failing), failing.count(r["bit"]))
    assert rows.where("doc_id = 0").count() == 2
    assert q.ledger(df.limit(0)).collect() == [] and q.ablations(rows.limit(0), "v2").collect() == []
