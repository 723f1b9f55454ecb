"""Licence texts with known answers."""

import textwrap

from plumbline.llm import licenses

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
BSD = """Copyright 2008, Some Company. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:
{a}Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.
{b}Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the
distribution.
"""
ENDORSE = """{c}Neither the name of {who} nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
AGPL = LGPL.replace("library is free software;", "program is free software:").replace("library", "program").replace("Lesser General", "Affero General").replace("Foundation; either", "Foundation, either").replace("version 2.1", "version 3")
marked = lambda mark, text: textwrap.indent(text, mark, lambda _: True)
three = BSD.format(a="   * ", b="   * ") + ENDORSE.format(c="   * ", who="Google Inc.")
TEXTS = [
    (three, "BSD-3-Clause"),
    (BSD.format(a="1. ", b="2. ") + ENDORSE.format(c="3. ", who="the copyright holder"), "BSD-3-Clause"),
    (BSD.format(a="1. ", b="2. "), "BSD-2-Clause"),
    (marked("// ", BSD.format(a="(a) ", b="(b) ")), "BSD-2-Clause"),
    *[(marked(m, APACHE), "Apache-2.0") for m in ("// ", "# ", " * ", ";; ", "-- ", "")],
    ("/*\n" + marked(" * ", three) + " */\n", "BSD-3-Clause"),
    (LGPL, "LGPL-2.1-or-later"),
    (marked("# ", AGPL), "AGPL-3.0-or-later"),
    ("// SPDX-License-Identifier: MIT\nint x;", "MIT"),
    ("/* SPDX-License-Identifier: GPL-2.0-only */\n", "GPL-2.0-only"),
    ("Licensed under the BSD 3-Clause License.", "BSD-3-Clause"),
    ("This project is released under the GNU General Public License v3.0.", "GPL-3.0-only"),
    ("Intro line without an end\nThis work is licensed under the Mozilla Public License, version 2.0.\nnext line", "MPL-2.0"),
    ("Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("We have a license to do as we please. Licensed under nothing at all.", ""),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: no others.", ""),
]


def test_texts(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licenses.op2(df).collect()}
    assert got == {i: x for i, (_, x) in enumerate(TEXTS)}


def test_interleaved_rules_do_not_hold(spark):
    """Between two sentences of a rule stand GAP others at most."""
    part = [licenses.SENTENCES[k][0] for k in ("BSDGrant", "BSDSource", "BSDBinary")]
    far = part[0] + "\n\n" + "See the License for the specific language governing permissions and limitations under the License.\n\n" * 4 + part[1] + "\n\n" + part[2]
    df = spark.createDataFrame([(1, far), (2, "\n\n".join(part))], "doc_id long, text string")
    assert {r.doc_id: r.licences for r in licenses.op2(df).collect()} == {1: "", 2: "BSD-2-Clause"}


def test_enough_identifiers():
    assert len(set(licenses.KNOWN.values())) >= 100


def test_headers_of_every_day(spark):
    """SPDX expressions and old identifiers, choices, later versions, the openings of licence files."""
    later, body = "-or-later", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nPreamble\n\n  The GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.\n\n  The licenses for most software are designed otherwise."
    cases = {
        "// SPDX-License-Identifier: GPL-2.0": "GPL-2.0-only",
        "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0" + later,
        "# SPDX-License-Identifier: LGPL-2.1+": "LGPL-2.1" + later,
        "SPDX-License-Identifier: MIT OR Apache-2.0": "Apache-2.0,MIT",
        "SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause": "Apache-2.0,BSD-3-Clause,MIT",
        "SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception": "Apache-2.0",
        "SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note OR MIT\nint main() {}": "GPL-2.0-only,MIT",
        "Licensed under either of Apache License, Version 2.0 or MIT license at your option.": "Apache-2.0,MIT",
        "This project is dual-licensed under the MIT and Apache 2.0 licenses.": "Apache-2.0,MIT",
        "Licensed under the GNU General Public License v3.0 or later.": "GPL-3.0" + later,
        "This file is licensed under the GPLv2+": "GPL-2.0" + later,
        "This program is licensed under the GNU Affero General Public License, version 3 or any later version.": "AGPL-3.0" + later,
        "// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.": "BSD",
        body: "GPL-3.0-only",
        "Eclipse Public License - v 2.0\n\n    THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE\n    PUBLIC LICENSE (\"AGREEMENT\"). ANY USE OF THE PROGRAM IS ACCEPTANCE.": "EPL-2.0",
        "We licensed it or they did, at your option.": "",
        "SPDX-License-Identifier: Unknown-1.0 OR Other-2.0": "",
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in licenses.op2(df).collect()}
    assert got == dict(enumerate(cases.values()))
    import duckdb

    documents = df.toPandas()  # noqa: F841
    assert {r[0]: r[3] for r in duckdb.sql(licenses.ORACLE).fetchall()} == got
