"""Licence scan: planted texts, and the SQL twin."""

import duckdb
from helpers import SCHEMA, frame

from pathlib import Path
from textwrap import fill

import pytest
from pyspark.sql import functions as F

from ridgeline.llm.licenses import DIGESTS, NOTICES, TEXTS, oracle_sql, scan_licenses, with_forms

TITLES = {"MIT": "The MIT License (MIT)", "ISC": "ISC License", "0BSD": "BSD Zero Clause License",
          "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": 'BSD 3-Clause "New" or "Revised" License',
          "Zlib": "zlib License", "Unlicense": "The Unlicense", "BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003"}


def whole_texts():
    """(text, licence): every whole text at many wrappings, with titles and statements, and near misses."""
    docs = []
    for name, text in TEXTS:
        for width in (20, *range(60, 101), 100_000):
            body = fill(" ".join(text.split()), width, break_long_words=False)
            docs += [(body, name), (f"{TITLES[name]}\n\nCopyright (c) 2020 Someone\nCopyright The Authors\n\n{body}\n", name)]
        one = " ".join(text.split())
        docs += [(f"{TITLES[name]} Copyright \u00a9 2019-2020, Some One <a@b.c>. All rights reserved. {one}", name)]
        docs += [(f"Copyright (c) 2020 Someone {one}", name), (f"Copyright 2020 Someone. {one}", name)]
        for marks in (("*",) * 3, ("-",) * 3, ("\u2022",) * 3, ("(a)", "(b)", "(c)"), ("a)", "b)", "c)"), ("i.", "ii.", "iii.")):
            other = text
            for k, mark in enumerate(marks, 1):
                other = other.replace(f"\n{k}. ", f"\n  {mark} ")
            docs += [(other, name)]
        docs += [(one + " Or not.", None), ("Some words. " + one, None)]
    return [*docs, ("MIT License", None), ("MIT License\n\nPermission denied.", None), (None, None), ("", None)]


def test_planted_licences(spark):
    mit = next(t for n, t in TEXTS if n == "MIT")
    texts = [None, "", "\n\n", "some words", "words\nReleased under the MIT licence!\nmore",
             "Copyright (c) 2020 Someone. All rights reserved.\n\n" + mit.upper().replace(",", " ,"), mit + " but not quite",
             "licensed under the apache license version 2 0\nLicensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0."]
    ids = list(range(len(texts)))
    out = {r.doc_id: tuple(r)[1:] for r in scan_licenses(frame(spark, texts, ids=ids)).collect()}
    empty = (None, "", 0)
    assert out == {0: empty, 1: empty, 2: empty, 3: empty, 4: (None, "MIT", 1), 5: ("MIT", "", 0), 6: empty,
                   7: (None, "Apache-2.0,CC-BY-NC-4.0", 2)}
    again = scan_licenses(frame(spark, [texts[4]] * 3 + ["x"], ids=[None, 5, 5, None])).collect()
    assert sorted((r.doc_id or 0, r.n_lines) for r in again) == [(0, 0), (0, 1), (5, 1), (5, 1)]
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = spark.createDataFrame([(None, "x"), ("a", None), ("b", "...")], "license string, text string")
    assert scan_licenses(frame(spark, ["x", "", None]), nothing).where("licenses != '' OR whole_license IS NOT NULL").count() == 0


def test_sql_twin(spark):
    docs = [t for _, t in NOTICES] + [f"a\n{t}\nb" for _, t in NOTICES[:5]] + ["(c) 2001\nX", "LICENCE\nlicence", None, "é Ü"]
    docs += [t for t, _ in whole_texts()[::3]]
    docs += ["Released under the MIT License. Copyright (c) 2020 X", "copyright\nnotice\n\u00a9 2020 me\nLicensed under CC BY 4.0.",
             "a (c) 2020 b\n(c) you must\nall rights reserved, x\ncopyright laws\n copyright: x"]
    out = sorted(scan_licenses(frame(spark, docs)).collect(), key=lambda r: r.doc_id)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(docs)))
    assert [tuple(r) for r in out] == sorted(con.execute(oracle_sql()).fetchall())


def test_whole_texts_at_any_wrapping(spark):
    docs = whole_texts()
    out = {r.doc_id: r.whole_license for r in scan_licenses(frame(spark, [t for t, _ in docs])).collect()}
    assert [(i, out[i]) for i in range(len(docs)) if out[i] != docs[i][1]] == []


def test_longer_texts(spark):
    """Digests of the longer licences, where the system has their texts."""
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1",
             "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "GFDL-1.3": "GFDL-1.3"}
    have = [(name, (folder / f).read_text("utf-8")) for f, name in names.items() if (folder / f).exists()]
    if not have:
        pytest.skip("no licence texts on this system")
    forms = with_forms(spark.createDataFrame(have, "license string, text string"), "text")
    assert {tuple(r) for r in forms.select("license", F.sha2("_form", 256)).collect()} <= set(DIGESTS)
    docs = [t for _, t in have] + ["\n".join(" ".join(p.split()) for p in t.upper().split("\n\n")) for n, t in have if n == "MPL-2.0"]
    out = sorted(scan_licenses(frame(spark, docs)).collect(), key=lambda r: r.doc_id)
    assert [r.whole_license for r in out] == [n for n, _ in have] + ["MPL-2.0"] * (len(docs) - len(have))
