"""Licence texts in other dress."""

import hashlib
import os
import textwrap

from erascore.llm import licenses as L

from .frames import documents


def dressed(text):
    return "\r\n".join(line.upper() for line in text.replace("license", "licence").replace("<year>", "1999").split("\n")) + "\n\n(C) 2001 Someone else\n"


def test_known_texts(spark):
    rows = [(i, t) for i, (_, t) in enumerate(L.KNOWN)] + [(100 + i, dressed(t)) for i, (_, t) in enumerate(L.KNOWN)]
    rows += [(200, L.MIT.replace("without restriction", "with restriction")), (201, L.MIT + "\nand more"), (202, "a" + L.ISC)]
    got = {r["doc_id"]: r["license_id"] for r in L.license_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {n + i: name for i, (name, _) in enumerate(L.KNOWN) for n in (0, 100)}
    assert got == want | {200: None, 201: None, 202: None}


def test_canonical_form(spark):
    frame = spark.createDataFrame([(1, "Licence LICENCE--licence, Labelling\nCopyright 2020 X\nthe copyright holder"), (2, "© me"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.license_report(frame).collect()}
    assert got[1]["canonical_sha256"] == hashlib.sha256(b"license license license labeling the copyright holder").hexdigest()
    assert got[2]["canonical_chars"] == 0 == got[3]["canonical_chars"] and got[2]["license_id"] is None


def test_awkward_documents_and_plan(spark):
    frame = documents(spark)
    out = L.license_report(frame)
    assert out.count() == frame.count() and L.license_report(frame.limit(0)).collect() == []
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_known_texts_in_lines_of_any_width(spark):
    texts = {n: t for n, t in L.KNOWN if len(t) > 200}
    rows = [(n, "\n\n".join(p if p.startswith("Copyright") else textwrap.fill(p, width) for p in t.replace("<year>", "1999").split("\n\n"))) for n, t in texts.items() for width in range(20, 100)]
    rows += [("ISC", L.ISC.replace("Copyright (c) <year> <owner>", line)) for line in ("Copyright npm, Inc.", "(c) 2004 Someone", "Copyright The Authors", "Copyright [yyyy] X")]
    got = L.license_report(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert len(got) == len(rows) and all(r["license_id"] == r["doc_id"] for r in got)


def test_titles_may_differ_or_be_left_out(spark):
    body = L.MIT.split("\n\n", 2)[2]
    rows = [("MIT", body), ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2020 X\n\n" + body), ("ISC", L.ISC.split("\n\n", 1)[1]),
            ("BSD-2-Clause", L.BSD2.replace("BSD 2-Clause License", "Simplified BSD License").replace("1. ", "* ").replace("2. ", "* "))]
    got = L.license_report(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert len(got) == len(rows) and all(r["license_id"] == r["doc_id"] for r in got)


def test_shipped_digests(spark):
    shipped = {r["known_digest"]: r["license_id"] for r in L.shipped_digests(spark).collect()}
    assert {r["known_digest"]: r["license_id"] for r in L.known_digests(spark).collect()}.items() <= shipped.items()
    assert len(shipped) == len(L.DIGESTS) and len(set(shipped.values())) == 23
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    folder = "/usr/share/common-licenses/"  # there on Debian
    rows = [(i, open(folder + f, encoding="utf-8").read()) for f, i in files.items() if os.path.exists(folder + f)]
    got = L.license_report(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert all(r["license_id"] == r["doc_id"] for r in got)
