"""Licences named or granted in texts: known sentences become identifiers, whose sequences are matched by ordered rules.

Only DataFrame functions are used, and no row leaves its task: a text's sentences are looked up in a fixed map.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices as their licences state or recommend them, and usual short forms. A notice is one rule.
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n"
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n"
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.\n"
)
_BSD_ENDORSEMENT = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n"
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published "
    "by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
_GNU_OLD = _GNU.replace("software: you", "software; you").replace("Foundation, either", "Foundation; either")
_LIBRARY_OLD = _GNU_OLD.replace("This program", "This library")
_SPDX = (
    "Apache-2.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0",
    "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0",
    *(f"{name}-{kind}" for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for kind in ("only", "or-later")),
)
NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   "compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            'documentation files (the "Software"), to deal in the Software without restriction, including without '
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:\nThe above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-3-Clause", _BSD_CONDITIONS + _BSD_ENDORSEMENT),
    ("BSD-2-Clause", _BSD_CONDITIONS),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("GPL-2.0-or-later", _GNU.format(name="GNU General Public License", version=2)),
    ("GPL-3.0-or-later", _GNU.format(name="GNU General Public License", version=3)),
    ("LGPL-2.1-or-later", _GNU.format(name="GNU Lesser General Public License", version=2.1)),
    ("LGPL-3.0-or-later", _GNU.format(name="GNU Lesser General Public License", version=3)),
    ("AGPL-3.0-or-later", _GNU.format(name="GNU Affero General Public License", version=3)),
    ("GPL-2.0-or-later", _GNU_OLD.format(name="GNU General Public License", version=2)),
    ("GPL-3.0-or-later", _GNU_OLD.format(name="GNU General Public License", version=3)),
    ("LGPL-2.1-or-later", _GNU_OLD.format(name="GNU Lesser General Public License", version=2.1)),
    ("LGPL-3.0-or-later", _GNU_OLD.format(name="GNU Lesser General Public License", version=3)),
    ("AGPL-3.0-or-later", _GNU_OLD.format(name="GNU Affero General Public License", version=3)),
    ("LGPL-2.1-or-later", _LIBRARY_OLD.format(name="GNU Lesser General Public License", version=2.1)),
    ("LGPL-3.0-or-later", _LIBRARY_OLD.format(name="GNU Lesser General Public License", version=3)),
    ("LGPL-2.0-or-later", _LIBRARY_OLD.format(name="GNU Library General Public License", version=2)),
    ("LGPL-2.1-or-later", _GNU.replace("This program", "This library").format(name="GNU Lesser General Public License", version=2.1)),
    ("LGPL-3.0-or-later", _GNU.replace("This program", "This library").format(name="GNU Lesser General Public License", version=3)),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("All-rights-reserved", "All rights reserved."),
    *((name, f"SPDX-License-Identifier: {name}") for name in _SPDX),
]

# Where sentences end: after stops, with lines either ends themselves or wrapped (then a blank line ends a sentence, also
# one that holds nothing but marks, such as those that begin the lines of a comment).
BY_LINE = "[.!?;:]+[ \\t]+|[\\r\\n]+"
WRAPPED = "[.!?;:]+[ \\t\\r\\n]+|[\\r\\n][^A-Za-z0-9\\r\\n]*[\\r\\n]+"
_END = "\x01"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sentences(text: str, ends: str = BY_LINE) -> list[str]:
    """Normalised sentences: ASCII letters in lower case and digits, anything else one space between them."""
    cut = re.sub("[^a-z0-9\x01]+", " ", re.sub(ends, _END, text).translate(str.maketrans(_UPPER, _LOWER)))
    return [s for s in (part.strip(" ") for part in cut.split(_END)) if s]


def knowledge() -> tuple[dict[str, str], list[tuple[str, list[str]]]]:
    """Identifier of each known sentence, and the rules (licence, identifiers in order) with the longest first."""
    known: dict[str, str] = {}
    rules = []
    for licence, notice in NOTICES:
        sequence = [known.setdefault(s, f"s{len(known):03d}") for s in sentences(notice)]
        rules.append((licence, sequence))
    return known, sorted(rules, key=lambda r: -len(r[1]))


def _sequence(text: Column, ends: str, known: dict[str, str]) -> Column:
    """The identifiers of a text's known sentences in order, each between spaces."""
    cut = F.translate(F.regexp_replace(text, ends, _END), _UPPER, _LOWER)
    parts = F.split(F.regexp_replace(cut, "[^a-z0-9\x01]+", " "), _END)
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    # A set is looked up by hash, a map of constants entry by entry.
    found = F.transform(F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s.isin(*known)), lambda s: table[s])
    return F.array_join(F.transform(found, lambda i: F.concat(F.lit(" "), i, F.lit(" "))), "")


def licenses(docs: DataFrame) -> DataFrame:
    """Licences of every document with a known sentence: doc_id, licences, sentence_ids.

    A text is cut into sentences twice, with line ends as ends and as wrapping; the cut that knows more sentences counts,
    the first if both know as many. Rules are tried in order, longer ones first: one whose identifiers
    stand next to each other in the sequence adds its licence and uses them up. licences is a comma-separated
    list in order of the rules, without repeats, empty if no rule matches; sentence_ids is the sequence. Null, empty and
    unknown texts give no row; repeated rows give repeated rows; other columns are not read.
    """
    known, rules = knowledge()
    text = F.col("text")
    rows = docs.select("doc_id", _sequence(text, BY_LINE, known).alias("a"), _sequence(text, WRAPPED, known).alias("b"))
    longer = F.when(F.length("b") > F.length("a"), F.col("b")).otherwise(F.col("a"))
    rows = rows.select("doc_id", longer.alias("sequence")).where("sequence <> ''")
    rest, found = F.col("sequence"), []
    for licence, sequence in rules:
        wanted = "".join(f" {i} " for i in sequence)
        found.append(F.when(F.contains(rest, F.lit(wanted)), F.lit(licence)))
        rest = F.replace(rest, F.lit(wanted), F.lit(" | "))
    names = F.array_join(F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull())), ",")
    return rows.select(
        "doc_id", names.alias("licences"), F.trim(F.replace("sequence", F.lit("  "), F.lit(" "))).alias("sentence_ids")
    )


def oracle() -> str:
    """The same as SQL for DuckDB, over documents."""
    known, rules = knowledge()
    values = ", ".join(f"('{s}', '{i}')" for s, i in known.items())

    def sequence(name: str, ends: str) -> str:
        ends = ends.replace("\\t", "' || chr(9) || '").replace("\\r", "' || chr(13) || '").replace("\\n", "' || chr(10) || '")
        cut = f"translate(regexp_replace(text, '{ends}', chr(1), 'g'), '{_UPPER}', '{_LOWER}')"
        clean = f"regexp_replace({cut}, '[^a-z0-9' || chr(1) || ']+', ' ', 'g')"
        return f"""{name}_parts AS (
            SELECT doc_id, unnest(string_split({clean}, chr(1))) AS s, generate_subscripts(string_split({clean}, chr(1)), 1) AS n
            FROM documents),
        {name} AS (
            SELECT doc_id, string_agg(' ' || id || ' ', '' ORDER BY n) AS seq
            FROM {name}_parts JOIN known ON trim(s) = sentence GROUP BY doc_id)"""

    steps, before = [], "picked"
    for k, (licence, ids) in enumerate(rules):
        wanted = "".join(f" {i} " for i in ids)
        steps.append(
            f"r{k} AS (SELECT doc_id, seq, replace(rest, '{wanted}', ' | ') AS rest, "
            f"CASE WHEN contains(rest, '{wanted}') AND NOT list_contains(found, '{licence}') "
            f"THEN list_append(found, '{licence}') ELSE found END AS found FROM {before})"
        )
        before = f"r{k}"
    return f"""WITH known(sentence, id) AS (VALUES {values}),
        {sequence("a", BY_LINE)},
        {sequence("b", WRAPPED)},
        cuts AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.seq, '') AS a, coalesce(b.seq, '') AS b
            FROM a FULL JOIN b ON a.doc_id = b.doc_id),
        picked AS (SELECT doc_id, CASE WHEN length(b) > length(a) THEN b ELSE a END AS seq,
            CASE WHEN length(b) > length(a) THEN b ELSE a END AS rest, []::VARCHAR[] AS found FROM cuts),
        {", ".join(steps)}
        SELECT doc_id, array_to_string(found, ',') AS licences, trim(replace(seq, '  ', ' ')) AS sentence_ids FROM {before}"""
