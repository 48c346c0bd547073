import random

from pyspark.sql import types as T

from lociweave.llm import licenses as L

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("license", T.StringType())])


def test_query_against_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {(r.doc_id, r.license, r.start) for r in L.op8_license_scan(spark, sf_dir).collect() if r.differing == 0}
    want = set()
    for d in docs:
        for name, notice in L.TEMPLATES:
            at = d.text.find(notice)
            while at >= 0:
                want.add((d.doc_id, name, at))
                at = d.text.find(notice, at + 1)
    assert want and want == got


def test_wording_and_cases(spark):
    isc = next(t for n, t in L.TEMPLATES if n == "ISC")
    rows = [
        (1, None, None),
        (2, "", None),
        (3, "Intro.\nThis work is licensed under the GNU General Public License, version 2.\nMore text", "x"),
        (4, "Permission to use, copy, modify, and distribute this software\nfor any purpose with or without fee is hereby granted, provided that", None),
        (5, "You need a licence to drive. Permission was denied.", None),
        (6, "word " * 100_000 + "\nReleased under the MIT License.\n" + "word " * 100_000 + "All rights reserved. " + "x " * 1000, None),
        (7, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.", None),
        (7, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.", None),
        (8, isc, None),
    ]
    got = sorted((r.doc_id, r.license, r.differing) for r in L.find_licenses(spark.createDataFrame(rows, DOCS)).collect())
    assert got == sorted([(3, "GPL-2.0", 0), (4, "ISC", 1), (6, "MIT", 0), (6, "proprietary", 0), (8, "ISC", 0)] + [(7, "CC-BY-NC-4.0", 0), (7, "CC-BY-4.0", 0)] * 2)
    assert L.find_licenses(spark.createDataFrame([], DOCS)).count() == 0


def scanned(text):
    return [(name, text[a:b], differ) for name, a, b, _, differ in L.Scanner().scan(text)]


def test_all_notices_of_a_block():
    mit = next(t for _, t in L.TEMPLATES if t.startswith("Permission is hereby"))
    apache = next(t for _, t in L.TEMPLATES if "you may not use" in t)
    reserved = ("proprietary", "All rights reserved", 0)
    for gap in ("\n", " ", "\n" + "word " * 20 + "\n"):
        for name, notice in (("MIT", mit), ("Apache-2.0", apache)):
            whole = (name, notice.rstrip("."), 0)
            assert scanned("All rights reserved." + gap + notice) == [reserved, whole]
            assert scanned(notice + gap + "All rights reserved.") == [whole, reserved]
    assert scanned("All rights reserved. All rights reserved. " * 40) == [reserved] * 80
    # the cue's line is not the first of the notice
    assert scanned("This Source Code Form is subject to the terms\nof the Mozilla Public License, v. 2.0.") == [("MPL-2.0", "This Source Code Form is subject to the terms\nof the Mozilla Public License, v. 2.0", 0)]
    # the second one's first word is left out
    assert scanned("All rights reserved. work is licensed under the GNU General Public License, version 2.") == [reserved, ("GPL-2.0", "work is licensed under the GNU General Public License, version 2", 1)]
    # of overlapping ones the best
    assert scanned("This work is licensed under the GNU Lesser General Public License, version 3.") == [("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3", 0)]


def test_all_notices_of_a_block_as_rows(spark):
    text = "All rights reserved. Licensed under CC BY 4.0. Licensed under the MIT License."
    rows = L.find_licenses(spark.createDataFrame([(1, text, None)] * 2, DOCS)).collect()
    assert sorted((r.license, text[r.start : r.end]) for r in rows) == sorted([("proprietary", "All rights reserved"), ("CC-BY-4.0", "Licensed under CC BY 4.0"), ("MIT", "Licensed under the MIT License")] * 2)


def test_occurrences_across_runs(monkeypatch):
    monkeypatch.setattr(L, "RUN_WORDS", 7)
    for before in range(45):
        text = "word " * before + "All rights reserved. " + " ".join(t for _, t in L.TEMPLATES[2:5]) + " word" * before
        with_short = scanned(text)
        monkeypatch.setattr(L, "RUN_WORDS", 65_536)
        assert with_short == scanned(text) and len(with_short) == 4
        monkeypatch.setattr(L, "RUN_WORDS", 7)


def test_every_notice_within_a_long_line():
    rng = random.Random(5)
    for words in (0, 40, 300, 2000):
        for name, notice in L.TEMPLATES:
            before, after = (" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 11))) for _ in range(words)) for _ in range(2))
            got = L.Scanner().scan(f"{before} {notice} {after}")
            assert [(f[0], f[1], f[4]) for f in got] == [(name, len(before) + 1, 0)], (words, notice)


def test_all_notices_in_one_line():
    for order in (L.TEMPLATES, L.TEMPLATES[::-1]):
        assert [f[0] for f in L.Scanner().scan(" ".join(t for _, t in order))] == [n for n, _ in order]


def every_occurrence(text):
    """(template, start, end, differing) of all alignments within the budget, without candidates or ranking."""
    there = list(L.words_of(text))
    words = [w for w, _, _ in there]
    out = set()
    for k, (_, t) in enumerate(L.TEMPLATES):
        item = [w for w, _, _ in L.words_of(t)]
        most = int(L.EDITS * len(item))
        if len(set(item) - set(words)) > most:
            continue
        number = {}
        codes = L.np.array([number.setdefault(w, len(number)) for w in words])
        for d, a, b in L.occurrences(L.np.array([number.get(w, -1) for w in item]), codes, most):
            out.add((k, there[a][1], there[b - 1][2], d))
    return out


def held_against_all(text):
    """Each finding is an alignment with that many words differing, or what is left of it without such words at its ends, and each alignment overlaps a finding."""
    got, every = L.Scanner().scan(text), every_occurrence(text)
    names = {(L.TEMPLATES[k][0], a, b, d) for k, a, b, d in every}
    for name, a, b, _, d in got:
        assert any(n == name and x <= a and b <= y and e == d for n, x, y, e in names)
    assert all(any(a < y and x < b for _, x, y, _, _ in got) for _, a, b, _ in every)
    assert all(p[2] <= q[1] for p, q in zip(got, got[1:], strict=False))
    return got


def test_against_all_places(spark, sf_dir):
    found = sum(len(held_against_all(d.text)) for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if d.text)
    assert found >= 5


def test_changed_words_lose_nothing():
    rng = random.Random(8)
    for name, notice in L.TEMPLATES:
        words = notice.split()
        most = int(L.EDITS * len(list(L.words_of(notice))))
        for _ in range(6):
            changed = list(words)
            for at in rng.sample(range(len(words)), min(most, len(words) - 1)):
                changed[at] = rng.choice(["qq", changed[at] + " zz", ""]) if rng.random() < 0.6 else "ww"
            text = "Some words before it. " + " ".join(changed) + " and words after it"
            got = held_against_all(text)
            if every_occurrence(text):
                assert got
    for text in ("Distribution" + next(t for n, t in L.TEMPLATES if n == "BSD")[14:], "This is free and unencumbered software released into the publik domain."):
        assert [f[4] for f in L.Scanner().scan(text)] == [1]


def test_full_texts_before_parts():
    for name, notice in L.TEMPLATES:
        assert [(f[0], f[4]) for f in L.Scanner().scan("x " + notice + " y")] == [(name, 0)]
        first = L.Scanner().ranked(notice, set(range(len(L.TEMPLATES))))[0]
        assert L.TEMPLATES[first][0] == name or notice.rstrip(".") in L.TEMPLATES[first][1]
