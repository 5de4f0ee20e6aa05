import duckdb
from pyspark.sql import functions as F

import pathlib

import pytest

from tidemark.llm import licenses

ROWS = [
    (1, licenses._MIT),
    (2, "Copyright (c) 2020 Someone\n\n" + licenses._ISC.upper().replace(". ", ".\n")),
    (3, "Some text.\nreleased under the MIT LICENCE\nAll rights reserved.\nAll rights reserved."),
    (4, None),
    (5, ""),
    (6, "Licensed under CC BY-NC 4.0."),
    (6, "Licensed under CC BY-NC 4.0."),
    (None, "this work is licensed under the GNU GPL, version 3.0"),
    (7, "It says: Released under the MIT License. and goes on"),
]


def test_whole_texts_and_lines(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("license", F.lit("x")).withColumn("key", F.lit(1))
    got = sorted(((r.doc_id, r.license, r.notices, r.n_notice_lines) for r in licenses.scan(docs).collect()), key=str)
    want = [
        (1, "MIT", "MIT", 1),
        (2, "ISC", "", 0),
        (3, None, "MIT,all-rights-reserved", 3),
        (4, None, "", 0),
        (5, None, "", 0),
        (6, "CC-BY-NC-4.0", "CC-BY-NC-4.0", 1),
        (6, "CC-BY-NC-4.0", "CC-BY-NC-4.0", 1),
        (7, None, "", 0),
        (None, "GPL-3.0", "GPL-3.0", 1),
    ]
    assert got == sorted(want, key=str)


def test_equal_to_sql(spark, awkward, nothing):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").unionByName(awkward.select("doc_id", "text"))
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    own = licenses.scan(docs).select("doc_id", "license", "notices", "n_notice_lines").collect()
    assert sorted(map(tuple, own), key=str) == sorted(con.execute(licenses.oracle()).fetchall(), key=str)
    assert licenses.scan(nothing).count() == 0


SHELF = pathlib.Path("/usr/share/common-licenses")
NAMES = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0"}
NAMES |= {"LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}


@pytest.mark.skipif(not SHELF.is_dir(), reason="no licence files here")
def test_planted_whole_files(spark):
    """Licence files as published, in capitals with other line ends and a copyright line, and with a word changed."""
    rows = []
    for i, name in enumerate(sorted(NAMES)):
        text = (SHELF / name).read_text(errors="replace")
        changed = " thee ".join(text.rsplit(" the ", 1))
        rows += [(10 * i, text, NAMES[name]), (10 * i + 1, "Copyright (c) 2021 Somebody\r\n\r\n" + text.upper().replace("\n", " \r\n"), NAMES[name]), (10 * i + 2, changed, None)]
        if "END OF TERMS AND CONDITIONS" in text:
            rows.append((10 * i + 3, text[: text.index("END OF TERMS AND CONDITIONS") + 27], NAMES[name]))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r.license for r in licenses.scan(docs).collect()}
    assert got == {r[0]: r[2] for r in rows}


def test_a_table_of_the_callers_own(spark):
    own = licenses.of_texts(spark.createDataFrame([("own", "Do what you like, but tell us.")], "license string, text string"))
    docs = spark.createDataFrame([(1, "DO WHAT you like; but tell us"), (2, licenses._MIT)], "doc_id long, text string")
    assert {r.doc_id: r.license for r in licenses.scan(docs, own).collect()} == {1: "own", 2: None}
