import os
import textwrap

import duckdb
import pytest

from lexforge.llm import licenses as L


def scan(spark, texts):
    return {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}


def test_whole_texts_in_any_dress(spark):
    mit = L.TEXTS["MIT"]
    got = scan(spark, [mit, "Copyright (c) 2020 A. Body\nAll rights reserved.\n" + mit.upper(), mit.replace(" ", "  ").replace(",", ""), mit + " more", L.TEXTS["BSD-2-Clause"].replace("COPYRIGHT HOLDER ", "copyright owner "), None, ""])
    assert [got[i].license for i in range(7)] == ["MIT", "MIT", "MIT", None, "BSD-2-Clause", None, None]
    assert got[5].digest is None and got[6].digest is not None


def test_notices(spark):
    got = scan(spark, ["prose\nReleased under the MIT Licence!\nmore\nreleased under the mit license", "It was released under the MIT License.", "Licensed under CC BY-NC 4.0."])
    assert got[0].n_notices == 2 and got[0].notices == ["MIT"]
    assert got[1].n_notices == 0 and got[2].notices == ["CC-BY-NC-4.0"]


def test_edge_rows(docs, no_docs):
    rows = L.scan_licenses(docs).collect()
    assert len(rows) == 10 and not any(r.license or r.n_notices for r in rows)
    assert L.scan_licenses(no_docs).count() == 0


def test_standard_wrapped_files(spark):
    """Files as they are published: a title, a copyright line, and prose that the line breaks begin with 'copyright'."""
    isc = "ISC License\n\nCopyright (c) 2021, A. Body\n\n" + L.TEXTS["ISC"].replace("that the above copyright", "that the above\ncopyright")
    bsd = L.TEXTS["BSD-3-Clause"].replace("the above copyright", "the above\n   copyright").replace("the copyright holder", "the\n   copyright holder").replace("THE COPYRIGHT", "THE\nCOPYRIGHT")
    wrapped = ["\n".join(textwrap.fill(p, n) for p in L.TEXTS["MIT"].split("\n\n")) for n in range(40, 80)]
    texts = [isc, "BSD 3-Clause License\n\nCopyright 2020 The Body Project\nAll rights reserved.\n\n" + bsd, "The MIT License (MIT)\n\nCopyright: A. Body\n\n" + L.TEXTS["MIT"], "MIT License\n\n" + L.TEXTS["MIT-0"], *wrapped]
    got = scan(spark, texts)
    assert [got[i].license for i in range(4)] == ["ISC", "BSD-3-Clause", "MIT", None]
    assert all(got[i].license == "MIT" for i in range(4, len(texts)))
    kept = scan(spark, ["x\ncopyright holders\ny", "x\nCopyright Body Ltd\ny", "x\nCOPYRIGHT NOTICE\ny", "x y", "x copyright holders y"])
    assert kept[0].digest == kept[4].digest and kept[1].digest == kept[3].digest != kept[2].digest


FOLDER = "/usr/share/common-licenses"
FILES = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "GFDL-1.3": "GFDL-1.3", "Artistic": "Artistic-1.0-Perl"}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the system's licence files are not here")
def test_long_licences_as_published_and_wrapped(spark):
    texts, want = [], []
    for file, name in FILES.items():
        with open(f"{FOLDER}/{file}", encoding="utf-8") as f:
            text = f.read()
        paragraphs = text.split("\n\n")
        wrapped = "\n\n".join(p if any(line.strip().lower().startswith(("copyright", "(c)")) for line in p.split("\n")) else textwrap.fill(" ".join(p.split()), 50) for p in paragraphs)
        texts += [text, text.upper() if "copyright (c)" not in text.lower() else text.replace("  ", " "), wrapped, "see " + text, text.split("END OF TERMS AND CONDITIONS")[0] if name.startswith(("Apache", "GPL", "LGPL-2")) else text]
        want += [name, name, name, None, name]
    got = scan(spark, texts)
    assert [got[i].license for i in range(len(texts))] == want


def test_the_sql_says_the_same_of_lines_that_begin_with_copyright(spark):
    from lexforge.llm.oracles import oracle_sql

    heads = ["copyright notice, this list", "Copyright (c) 2020 A", "COPYRIGHT HOLDERS", "Copyright Body Ltd", "copyright 1999 x", "Copyright: Owner x", "  Copyright, by me", "(C) me", "© me", "All Rights Reserved", "copyright © me", "Copyright\tIn", "Copyright In", "copyrighted 1999", "Copyright [year] x", "Copyright  Zed"]
    texts = [f"x\n{h}\ny centre" for h in heads] + [L.TEXTS["MIT"], "MIT License\n\nCopyright (c) 2020 A\n\n" + L.TEXTS["MIT"], None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = {r[0]: r[1:3] for r in con.execute(f"SELECT doc_id, digest, license FROM ({oracle_sql()['op7_license_digests']})").fetchall()}
    got = {r.doc_id: (r.digest, r.license) for r in L.scan_licenses(frame).collect()}
    assert got == want and got[len(heads) + 1][1] == "MIT"
