import hashlib

from lakeloom.llm import licences as li


def test_scan_matches_plain_python(spark):
    mit = "Copyright (c) 2020 Ann Author\n" + li._MIT
    texts = [
        None, "", "...\n--", mit, mit.upper(), mit.replace("sublicense", "sub-licence").replace("\n", "\r\n"), "# " + mit.replace("\n", "\n# "), mit + " extra",
        "All rights reserved.\n(c) me\n" + li._BSD_2 + li._DISCLAIMER, "Some prose.\nReleased under the MIT licence!\nmore\n  released UNDER the mit license\n",
        "Licensed under CC BY-NC 4.0.", "x\n* Licensed under the Apache License, Version 2.0.\nThis work is licensed under the GNU General Public License, version 3.", "prose " * 50_000, "Licenced under the MIT License",
    ]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(9, texts[9], "again"), (None, texts[10], None)]
    known = {hashlib.sha256(li.canonical_text(t).encode()).hexdigest(): n for n, t in reversed(li.KNOWN)} | {d: n for n, d in li.KNOWN_DIGESTS}
    digest = lambda x: known.get(hashlib.sha256(x.encode()).hexdigest())

    def want(text):
        lines = [li.canonical_text(x) for x in (text or "").split("\n")]
        found = [digest(x) for x in lines if x]
        whole = digest(li.canonical_text(text))
        return ",".join(sorted({x for x in [*found, whole] if x})), sum(x is not None for x in found), whole

    got = li.scan_licences(spark.createDataFrame(rows, "doc_id long, text string, licences string")).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((i, *want(t))) for i, t, _ in rows)
    whole = {r["doc_id"]: r["whole_licence"] for r in got}
    assert [whole[i] for i in (3, 4, 5, 6, 8)] == ["MIT"] * 4 + ["BSD-2-Clause"] and whole[7] is None and whole[13] == "MIT"


def test_empty_table(spark):
    assert li.scan_licences(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_whole_licences_are_found_wherever_they_are_wrapped(spark):
    import textwrap

    full = [(n, t) for n, t in li.KNOWN if len(t) > 500]
    rows, want = [], []
    for name, text in full:
        for width in range(40, 100):
            rows.append((len(rows), "Copyright (c) 2020 Ann Author\nCopyright 2021, Copyright Holders Ltd\n" + textwrap.fill(" ".join(text.split()), width, break_on_hyphens=False, break_long_words=False)))
            want.append(name)
    assert any("\ncopyright notice" in t for _, t in rows) and any("\nCOPYRIGHT HOLDER" in t for _, t in rows)
    got = {r["doc_id"]: r["whole_licence"] for r in li.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(rows))] == want


def test_long_licences_are_found_by_their_digests(spark):
    """Only where the system has the published texts."""
    import os

    import pytest

    top = "/usr/share/common-licenses"
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    if not all(os.path.exists(f"{top}/{n}") for n in names):
        pytest.skip("no published texts here")
    rows = []
    for i, n in enumerate(names):
        with open(f"{top}/{n}", encoding="utf-8") as f:
            text = f.read()
        rows += [(2 * i, text.upper().replace("\n", "\r\n")), (2 * i + 1, text.replace("copyright", "copyleft", 3))]
    got = {r["doc_id"]: r["whole_licence"] for r in li.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[2 * i] for i in range(len(names))] == list(names.values()) and not any(got[2 * i + 1] for i in range(len(names)))


def test_paragraphs_numbered_c_and_words_after_copyright_stay():
    keep = ["(c) You must retain, in the Source form of any Derivative Works", "copyright notice, this list", "Copyright Holder means", "copyright law: that is to say", "COPYRIGHT HOLDERS AND CONTRIBUTORS"]
    drop = ["Copyright (c) 2020 Ann", "  * Copyright 2020, Ann", "COPYRIGHT (C) 2020 ANN", "© Ann", "(c) Ann Author", "(C) 2020 by Ann, Ben and several others of the project", "Copyright Ann Author", "Copyright by Ann", "Copyright [yyyy] [name]", "All rights reserved."]
    assert all(li.canonical_text(x) for x in keep) and not any(li.canonical_text(x) for x in drop)
