"""Licence scans (operator 10) on notices, wrapped bodies and prose that grants nothing."""

import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.llm import license_scan
from quern.llm.license_texts import TEMPLATES


@pytest.fixture(scope="module")
def model(spark, sf):
    return license_scan.fit(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))


def found(spark, model, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.licenses for r in license_scan.license_scan(rows, model).collect()}
    return [got[i] for i in range(len(texts))]


def test_one_family_for_whole_texts(spark, model):
    t = TEMPLATES
    bodies = {
        "MIT": " ".join([t["MIT"][3] + ",", *t["MIT"][4:8]]), "GPL": " ".join([t["GPL"][1] + ",", *t["GPL"][2:4]]), "BSD": " ".join(t["BSD"][2:-1]),
        "ISC": " ".join(t["ISC"][:3]), "AGPL": t["AGPL"][1], "LGPL": t["LGPL"][0], "Apache-2.0": "\n\n".join(t["Apache-2.0"][3:-1]),
    }
    texts = [x for v in bodies.values() for x in (v, textwrap.fill(v, 78), "Some file\n\n" + textwrap.fill(v, 60) + "\n\nint main() { return 0; }")]
    assert found(spark, model, texts) == [k for k in bodies for _ in range(3)]


def test_prose_grants_nothing(spark, model):
    texts = [
        "This software is NOT released under the MIT License.", "The library was never licensed under the Apache License, Version 2.0.", "We compared the MIT License with the GNU General Public License, version 3.",
        "The GNU Affero General Public License is a license that many companies avoid.", "Unlike the MIT License, the Apache License, Version 2.0 has a patent clause.", "He renewed his driving licence before the summer.",
    ]
    assert found(spark, model, texts) == [None] * len(texts)


def test_licences_of_odd_tables(spark, model):
    notice = "Released under the MIT License."
    rows = [(1, notice, 1), (1, notice, 2), (None, notice, 3), (2, None, 4), (3, "", 5), (4, "word " * 60000 + "\n" + notice, 6)]
    d = spark.createDataFrame(rows, "doc_id long, text string, licenses int").withColumn("id", F.lit("x"))
    got = Counter((r.id, r.licenses, r.n_licenses) for r in license_scan.license_scan(d, model).collect())
    assert got == Counter([(1, "MIT", 1), (1, "MIT", 1), (None, "MIT", 1), (2, None, 0), (3, None, 0), (4, "MIT", 1)])
    assert license_scan.license_scan(d.limit(0), model).count() == 0
    assert license_scan.fit(d.limit(0)).keys() == model.keys()


def test_windows_follow_wrapped_lines():
    import numpy as np

    raw = b"one two\nthree.\nfour five\n\nsix"
    starts, ends, _, half, line = license_scan.windows(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert [raw[a:b].decode() for a, b in zip(starts, ends)] == ["one", "two", "three", "four", "five", "six"]
    assert line[half].tolist() == [0, 0, 0, 1, 1, 2]


def test_licences_of_one_line(spark, model):
    """op10: two families in one window, and a short notice inside a long paragraph."""
    plain = " ".join("the river runs past old stone houses and quiet gardens where people walk in the evening".split() * 3)
    lines = [
        ("Licensed under the Apache License, Version 2.0, or the MIT license.", "Apache-2.0,MIT"),
        ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", "Apache-2.0,MIT"),
        ("Licensed under the BSD 3-Clause License or the Mozilla Public License, version 2.0.", "BSD,MPL-2.0"),
        ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL"),
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA"),
        (f"{plain[:120]} Released under the MIT License. {plain[:120]}", "MIT"),
        (plain, None),
    ]
    rows = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(lines)], "doc_id long, text string")
    got = {r.id: r.licenses for r in license_scan.license_scan(rows, model).collect()}
    assert got == {i: want for i, (_, want) in enumerate(lines)}


@pytest.mark.parametrize("line", ["", "one two", " ".join(f"wörd{i}" for i in range(300))])
def test_licence_windows_hold_the_line(line):
    got = license_scan.cut(line)
    assert "".join(got) == line and all(len(x.split()) <= 32 for x in got)
