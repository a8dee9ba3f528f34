import re

import pytest

from tillmart.llm.licenses import BASE_PHRASES, evaluate, family, postfix, scan_licenses

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for p, label in BASE_PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


@pytest.mark.parametrize("expression, terms, value", [
    ("MIT", ["MIT"], ({"mit"}, 1.0)),
    ("MIT OR GPL-3.0-only AND Apache-2.0", ["MIT", "GPL-3.0-only", "Apache-2.0", "and", "or"], ({"mit", "gpl", "apache"}, 1.0)),
    ("(MIT OR GPL-2.0+) and Apache-2.0", ["MIT", "GPL-2.0+", "or", "Apache-2.0", "and"], ({"mit", "gpl", "apache"}, 1.0)),
    ("GPL-2.0 WITH Classpath-exception-2.0 AND MIT", ["GPL-2.0", "Classpath-exception-2.0", "with", "MIT", "and"], ({"gpl", "mit"}, 0.6)),
    ("MIT */ more", ["MIT"], ({"mit"}, 1.0)),
    ("LicenseRef-x AND AGPL-3.0", ["LicenseRef-x", "AGPL-3.0", "and"], ({"licenseref-x", "agpl"}, 0.2)),
])
def test_expressions(expression, terms, value):
    assert postfix(expression) == terms
    assert evaluate(terms) == value


@pytest.mark.parametrize("expression", ["", "OR MIT", "MIT OR", "(MIT", "MIT AND (", "AND"])
def test_expressions_without_sense(expression):
    assert postfix(expression) is None


def test_family():
    assert [family(x) for x in ("0BSD", "BSD-3-Clause", "CC-BY-NC-4.0", "CC-BY-4.0", "Zed")] == ["bsd", "bsd", "cc-by-nc", "cc-by", "zed"]


def test_scan_against_brute_force(spark):
    texts = [
        None, "", "...", "Released under the MIT License.", "mit\nlicense MIT-LICENSE, apache license", "amit license", "mit licenses",
        "GNU Lesser General Public License v3, general public", "Licensed under CC BY-NC 4.0.",
        "é mit license é " * 3000 + "Apache (License) end", "// SPDX-License-Identifier: MIT OR GPL-3.0-only\ncode",
        "SPDX-License-Identifier: (MIT", "general public license general public license",
    ]
    rows = [(i, t, "own") for i, t in enumerate(texts)] + [(None, texts[3], "own"), (3, texts[3], "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string").repartition(3)
    out = scan_licenses(docs).collect()
    got = sorted([tuple(r)[:6] for r in out], key=repr)
    assert got == sorted([(d, *brute(t)) for d, t, _ in rows], key=repr)
    by = {r["doc_id"]: r for r in out}
    assert by[7]["labels"] == "gpl,lgpl" and by[8]["labels"] == "cc-by-nc" and by[8]["score"] == 0.1
    assert by[10]["labels"] == "gpl,mit" and by[10]["score"] == 1.0 and by[10]["expressions"] == ["MIT GPL-3.0-only or"]
    assert by[11]["labels"] == "" and by[0]["score"] == 0.5


def test_empty(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []
