"""op4_license_lines: licences of whole texts and of lines inside other texts."""
from pathlib import Path

import pytest

pytest.importorskip("public_tokenizers")

from dropcast.llm import licenses  # noqa: E402
from dropcast.llm.queries import QUERIES  # noqa: E402

ROWS = [(1, "text\nReleased under the MIT Licence.\nmore\n\n  # Licensed under CC BY-SA 4.0. "), (2, None), (3, ""),
        (4, "Released under the MIT License."), (5, "It is software, released under the MIT License."),
        (4, "SPDX-License-Identifier: GPL-3.0-only\nmore"), (None, "a\nLICENSED  under the Apache license, version 2.0"),
        (6, licenses._MIT.replace("\n", " ")), (7, licenses._MIT)]


def test_both_results_for_every_document(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op4_license_lines"](spark, str(tmp_path)).collect()
    key = lambda r: (r[0] or 0, str(r[1:]))
    lines = sorted([(r.doc_id, r.license_id, [tuple(x) for x in r.line_licenses]) for r in got], key=key)
    assert lines == sorted([
        (1, None, [(1, "MIT"), (4, "CC-BY-SA-4.0")]), (2, None, []), (3, None, []), (4, "MIT", [(0, "MIT")]), (5, None, []),
        (4, None, [(0, "GPL-3.0")]), (None, None, [(1, "Apache-2.0")]), (6, "MIT", [(0, "MIT")]), (7, "MIT", [])], key=key)
    whole = sorted((tuple(r) for r in licenses.scan(docs).collect()), key=key)
    assert sorted((tuple(r[:3]) for r in got), key=key) == whole
    flat = sorted(((r.doc_id, *x) for r in got for x in r.line_licenses), key=key)
    assert flat == sorted((tuple(r) for r in licenses.scan_lines(docs).collect()), key=key)


def test_every_known_text_has_a_mark(spark):
    known = spark.createDataFrame(licenses.KNOWN, "license_id string, body string").select(licenses.canonical("body")).collect()
    assert all(any(m in r[0] for m in licenses.MARKS) for r in known)
    assert not any(m in word and m not in variant for variant, word in licenses.EQUIVALENT for m in licenses.MARKS)


def test_full_texts_are_known(spark):
    files = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    folder = Path("/usr/share/common-licenses")
    if not all((folder / f).is_file() for f in files.values()):
        pytest.skip("no licence texts here")
    docs = spark.createDataFrame([(n, (folder / f).read_text("utf-8")) for n, f in files.items()], "doc_id string, text string")
    assert {r.doc_id: r.license_id for r in licenses.scan_both(docs).collect()} == {n: n for n in files}


def test_lines_edges(spark):
    docs = spark.createDataFrame([(1, "a\nb", "x"), (None, None, "y"), (2, "", "z")], "doc_id long, text string, _known string")
    known = spark.createDataFrame([("L", None)], "license_id string, digest string")
    rows = {r["doc_id"]: r for r in licenses.scan_both(docs, known).collect()}
    assert len(rows) == 3 and all(r["license_id"] is None and r["line_licenses"] == [] for r in rows.values())
    assert licenses.scan_both(docs.limit(0)).count() == 0
    twice = licenses.known_digests(spark).unionByName(licenses.known_digests(spark))
    assert licenses.scan_both(docs, twice).count() == 3
    assert "Join" not in licenses.scan_both(docs, twice)._jdf.queryExecution().executedPlan().toString()
