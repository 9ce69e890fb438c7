import re

from tollgate.llm import license_texts, licenses, queries


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    """The whole row of a text: base places by comparing words, rules by trying every one."""
    words = plain_words(text)
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    norm = " " + " ".join(words) + " "
    found = [(0, -1 - i, label, m.start(), m.end()) for i, (p, label) in enumerate(licenses.PHRASES.items()) for m in re.finditer(f"(?<= ){p}(?= )", norm)]
    found += [(p, o, label, m.start(), m.end()) for o, label, p, k, r in licenses.rules() if k in norm for m in re.finditer(f"(?<= ){r}(?= )", norm)]

    def beaten(x):
        inside = [y for y in found if y != x and y[3] <= x[3] and y[4] >= x[4]]
        return any(y[0] > x[0] or (y[0] == x[0] and ((y[3], y[4]) != x[3:5] or y[1] < x[1])) for y in inside)

    kept = [x for x in found if x[0] and not beaten(x)]
    base = sorted({label for _, label in places})
    score = max([0.5 * bool(places), *(0.5 + x[0] / 8 for x in kept)])
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted({*base, *(x[2] for x in kept)})), score, len(kept))


SAID = [
    "Licensed under CC BY-NC 4.0.\nand more",
    "This work is licensed under the GNU General Public License, version 3. All rights reserved. All rights reserved!",
    "Licensed under the Apache License, Version 2.0.",
    "cc by cc by CC-BY-SA 3.0 cc by",
    "released under the terms of the MIT license; SPDX-License-Identifier: GPL-2.0 or later",
    "the general public licence, the GENERAL public License general public license",
    "mozilla public license 2.0 or the eclipse public license v1.0 (all rights reserved)",
    "All rights Reserved",
    "unreserved, all rights reservedly, occ by",
]


def test_query_equals_brute_force(spark, sf_dir, corpus):
    rows = [*corpus, *((1000 + i, t) for i, t in enumerate(SAID)), (2000, "x, " * 3000 + ". ".join(SAID * 30))]
    got = queries.op4_licenses(spark, sf_dir(rows)).collect()
    cols = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections")
    assert {r["doc_id"]: tuple(r[c] for c in cols) for r in got} == {i: brute(t) for i, t in rows}
    assert len(got) == len(rows)


def test_labels_of_plain_cases(docs):
    got = {r["id"]: r["labels"] for r in licenses.scan(docs(list(enumerate(SAID)))).collect()}
    assert got[0] == "cc-by,cc-by-nc-4.0"
    assert got[2] == "apache-2.0"
    assert got[8] == ""


APART = ["CC (BY)", "cc - by 4.0", "see cc,\nby", "in the public\r\n  domain", "(public) -- (domain)", "all -- rights, reserved", "General \t Public: License"]


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so"""
MIT_END = """, subject to the following conditions: The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
AS_IS = """. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED"""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_END = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS"
GNU = """This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1}General Public License
as published by the Free Software Foundation; either version {2} of the License, or (at your option) any later version."""

TEXTS = [
    (MIT + MIT_END + AS_IS, {"mit", "disclaimer"}),
    (MIT + AS_IS, {"mit-0", "disclaimer"}),
    (BSD + BSD_END, {"bsd", "bsd-2"}),
    (BSD + " 3. Neither the name of the University of Somewhere nor the names of its contributors may be used to endorse or promote products derived from this software." + BSD_END, {"bsd", "bsd-3"}),
    (BSD + " 3. All advertising materials mentioning features or use of this software must display the following acknowledgement: x." + BSD_END, {"bsd", "bsd-4"}),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", {"isc"}),
    ('Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS"', {"0bsd"}),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', {"apache-2.0"}),
    ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", {"apache-2.0"}),
    (GNU.format("program", "", "3"), {"gpl", "gpl-3.0-or-later"}),
    (GNU.format("program", "", "2"), {"gpl", "gpl-2.0-or-later"}),
    (GNU.format("library", "Lesser ", "2.1"), {"lgpl", "lgpl-2.1-or-later"}),
    (GNU.format("thing", "Affero ", "3"), {"agpl", "agpl-3.0-or-later"}),
    ("under the terms of the GNU General Public License as published by the Free Software Foundation, version 2 of the License.", {"gpl-2.0"}),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"mpl-2.0"}),
    ("This is free and unencumbered software released into the public domain.", {"unlicense"}),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", {"boost-1.0"}),
    ("The origin of this software must not be misrepresented; you must not claim that you wrote the original software.", {"zlib"}),
    ("Copying and distribution of this file, with or without modification, are permitted in any medium without royalty provided the copyright notice and this notice are preserved.", {"all-permissive"}),
    ("<a href='https://creativecommons.org/licenses/by-sa/4.0/'>", {"cc-by-sa-4.0"}),
    ("Unauthorized copying of this file, via any medium is strictly prohibited", {"proprietary"}),
    ("// SPDX-License-Identifier: MIT", {"mit"}),
    ("# SPDX-License-Identifier: GPL-2.0-or-later", {"gpl-2.0-or-later"}),
    ("# SPDX-License-Identifier: BSD-3-Clause", {"bsd-3"}),
    ("/* SPDX-License-Identifier: LGPL-2.1-only */", {"lgpl-2.1"}),
    ("software is sold with a permission slip and copyright law", set()),
]


def test_license_texts_headers_and_identifiers(docs):
    got = {r["id"]: set(filter(None, r["labels"].split(","))) for r in licenses.scan(docs([(i, t) for i, (t, _) in enumerate(TEXTS)])).collect()}
    for i, (text, want) in enumerate(TEXTS):
        assert want - {"gpl", "lgpl"} <= got[i] and got[i] - want <= {"gpl", "lgpl", "bsd"}, (text, want, got[i])


def test_texts_equal_brute_force(docs):
    rows = [(i, t) for i, (t, _) in enumerate(TEXTS)] + [(100, ". ".join(t for t, _ in TEXTS))]
    cols = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections")
    got = {r["id"]: tuple(r[c] for c in cols) for r in licenses.scan(docs(rows)).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_every_identifier_and_every_keyword():
    """An SPDX line gets the label of its own identifier, and no regex matches without its keyword."""
    rules = licenses.rules()
    for spdx in license_texts.SPDX:
        norm = " " + " ".join(plain_words(f"SPDX-License-Identifier: {spdx}")) + " "
        best = max(((m.end() - m.start(), label) for _, label, p, k, r in rules if p == 4 and k in norm for m in re.finditer(f"(?<= ){r}(?= )", norm)), key=lambda x: x[0])
        assert best[1] == spdx.lower().removesuffix("-only").replace("-clause", ""), spdx
    for text, _ in TEXTS:
        norm = " " + " ".join(plain_words(text)) + " "
        assert all(k in norm for *_, k, r in rules if re.search(f"(?<= ){r}(?= )", norm))


def test_several_separators_inside_a_phrase(docs):
    cols = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections")
    got = {r["id"]: tuple(r[c] for c in cols) for r in licenses.scan(docs(list(enumerate(APART)))).collect()}
    assert got == {i: brute(t) for i, t in enumerate(APART)}
    assert [got[i][1] for i in range(3)] == [1, 1, 1] and all(x[5] for x in got.values())


def test_no_rule_lacks_its_stem():
    rules = licenses.rules()
    assert len(rules) > 300
    assert all(any(s in r.replace("licen[cs]e", "license") for s in licenses.STEMS) for *_, r in rules)


def test_repeated_rows_null_ids_and_empty_tables(docs):
    got = licenses.scan(docs([(1, "cc by"), (1, "cc by"), (None, "cc by"), (2, None)])).collect()
    assert sorted((r["id"], r["n_base"]) for r in got) == [(1, 1), (2, 0)]
    assert licenses.scan(docs([])).collect() == []
