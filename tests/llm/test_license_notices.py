"""Licence notices against names written by hand, in every place a notice can stand."""

import duckdb
from skyherald.llm import licenses, queries

DOCS = "doc_id long, text string"
# every kind of licence line of the given documents, and notices in other places; names by hand
EXPECTED = [
    ("This work is licensed under the GNU General Public License, version 3.", {"GPL-3.0"}),
    ("All rights reserved.", {"Proprietary"}),
    ("Released under the MIT License.", {"MIT"}),
    ("Licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}),
    ("Licensed under the Apache License, Version 2.0.", {"Apache-2.0"}),
    ("licensed under cc by-nc-sa 4.0", {"CC-BY-NC-SA-4.0"}),
    ("Licensed under CC BY-ND 4.0", {"CC-BY-ND-4.0"}),
    ("Licensed under CC BY 4.0!", {"CC-BY-4.0"}),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", {"CC-BY-NC-4.0"}),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", {"CC-BY-4.0"}),
    # one sentence of a longer line
    ("Some words go before it and there are many of them. Licensed under CC BY-NC 4.0. Others follow, of no interest.", {"CC-BY-NC-4.0"}),
    ("Copyright 2020 A. Author and many others who wrote this. All rights reserved.", {"Proprietary"}),
    # wrapped in a comment that has other lines
    ("# tool.py: makes the things\n# This project is licensed\n# under the MIT License.\n# See the file for more.", {"MIT"}),
    ("/* Copyright the authors of this file.\n * Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use"
     " this file except in\n * compliance with the License. You may obtain\n * a copy of the License at\n"
     " * http://www.apache.org/licenses/LICENSE-2.0\n */", {"Apache-2.0"}),
    # two notices
    ("Licensed under CC BY 4.0.\n\nwords between\n\nReleased under the MIT License.", {"CC-BY-4.0", "MIT"}),
    # none
    ("The rights of all are reserved by the licence of the state. MIT is a school.", set()),
    ("|.|!|\n\n.\n", set()), ("", set()), (None, set()),
]


def test_every_licence_line(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(EXPECTED)], DOCS)
    got = {r.doc_id: {m.name for m in r.licenses} for r in licenses.license_scan(docs).collect()}
    assert got == {i: names for i, (_, names) in enumerate(EXPECTED)}
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    rows = con.sql(queries.SQL["op4_licenses"]).df()
    mine = {r.doc_id: r.licenses for r in queries.op4_licenses(spark, str(tmp_path)).collect()}
    assert dict(zip(rows.doc_id, rows.licenses, strict=True)) == mine


def test_every_template_is_its_own_best_match(spark):
    docs = spark.createDataFrame([(i, f"word " * 30 + "end.\n" + t) for i, (_, t) in enumerate(licenses.TEMPLATES)], DOCS)
    for r in licenses.license_scan(docs).collect():
        assert licenses.TEMPLATES[r.doc_id][0] in {m.name for m in r.licenses if m.dice == 1.0}, r


def test_required_bigrams_cannot_all_be_missed():
    for name, text in licenses.TEMPLATES:
        own = set(licenses.template_bigrams(text))
        asked = set(licenses.required([(name, text)], licenses.LEAST))
        rest = len(own - asked)
        # a unit of the rest alone, even with no other bigram, stays below the bound
        assert asked <= own and 2 * rest / (rest + len(own)) < licenses.LEAST
