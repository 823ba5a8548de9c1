import pytest

from forumlake.llm import licenses
from forumlake.llm.queries import ORACLE, QUERIES
from forumlake_checks.compare import database, differences


def found(spark, rows):
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, licences int")
    return sorted((r["doc_id"], r["licences"]) for r in licenses.licenses(df).collect())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_sql(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    df = QUERIES["op8_licenses"](spark, sf_dir)
    assert differences(df, database(sf_dir), ORACLE["op8_licenses"]) == [] and df.count() > 5


def test_every_notice_is_recognised_plain_and_wrapped(spark):
    rows, wanted = [], []
    for i, (licence, notice) in enumerate(licenses.NOTICES):
        words = notice.split(" ")
        wrapped = "\n".join(" * " + " ".join(words[k : k + 9]) for k in range(0, len(words), 9))
        rows += [(2 * i, f"intro text.\n{notice.upper()}\nand more"), (2 * i + 1, f"Intro.\n\n{wrapped}\n\nmore words.")]
        wanted += [(2 * i, licence), (2 * i + 1, licence)]
    assert found(spark, rows) == wanted


def test_longer_rules_go_first_and_order_matters(spark):
    three = next(n for l, n in licenses.NOTICES if l == "BSD-3-Clause")
    lines = three.strip().split("\n")
    rows = [(1, three), (2, "\n".join(lines[:3])), (3, "\n".join(lines[2::-1])), (4, three + "Released under the MIT License.")]
    assert found(spark, rows) == [(1, "BSD-3-Clause"), (2, "BSD-2-Clause"), (3, ""), (4, "BSD-3-Clause,MIT")]


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "no licence here"), (4, "x. " * 50000 + "Licensed under CC BY-NC 4.0."), (None, "All rights reserved.")]
    rows += [(5, "Released under the MIT License.")] * 2 + [(6, "not Released under the MIT License.")]
    df = spark.createDataFrame([(d, t) for d, t in rows], "doc_id long, text string")
    result = sorted(((r["doc_id"], r["licences"]) for r in licenses.licenses(df).collect()), key=str)
    assert result == [(4, "CC-BY-NC-4.0"), (5, "MIT"), (5, "MIT"), (None, "All-rights-reserved")]
    assert licenses.licenses(df.limit(0)).collect() == []


def test_headers_in_comments(spark):
    gnu = (
        "This {kind} is free software; you can redistribute it and/or\nmodify it under the terms of the GNU {name}\n"
        "General Public License as published by the Free Software\nFoundation; either version {version} of the License, or\n"
        "(at your option) any later version."
    )
    wanted = [
        ("program", "", 3, "GPL-3.0-or-later"), ("program", "", 2, "GPL-2.0-or-later"),
        ("library", "Lesser", 2.1, "LGPL-2.1-or-later"), ("program", "Affero", 3, "AGPL-3.0-or-later"),
    ]
    rows, licences = [], []
    for kind, name, version, licence in wanted:
        for lead, begin, end in ((" *", "/*\n", "\n */"), ("#", "#!/bin/sh\n", ""), ("//", "", "")):
            lines = f"Copyright (C) 2020 Foo\n\n{gnu.format(kind=kind, name=name, version=version)}\n\nIt comes without any warranty"
            text = begin + "\n".join(f"{lead} {line}".rstrip() for line in lines.split("\n")) + end + "\nint main;"
            licences.append((len(rows), licence))
            rows.append((len(rows), text))
    for text, licence in (("// SPDX-License-Identifier: LGPL-2.1-only\nint x;", "LGPL-2.1-only"), ("# SPDX-License-Identifier: MIT\n", "MIT")):
        licences.append((len(rows), licence))
        rows.append((len(rows), text))
    assert found(spark, rows) == licences
