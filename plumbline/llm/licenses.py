"""Licence recognition by sentence rules (operator 2, native).

A text is cut into normalised sentences. Each sentence that is a known licence
sentence becomes an identifier; the identifiers in text order are then matched
against ordered licence rules: a rule holds if its identifiers occur in its
order with at most GAP others between two of them, and a more specific rule
silences those it overrides. An identifier that names a licence by itself
("<licence>/ref", "<licence>/spdx", "<licence>/text") is a rule of one sentence.

SPDX expressions are taken apart into their terms (old identifiers too, up to
five terms), as are grants under either or both of two licences.

Comment marks at line starts (//, #, ;, --, *, /*, %, >) don't count, nor do a
holder's name where the licence leaves it open, and the words by which a text
says that it is licensed. A sentence ends at ``. ! ?`` before white space, at a
colon at a line's end, before a list number, or at a blank line. A single line
end may be a wrapped line or a boundary, so a sentence is tried whole first,
then as the longest known run of up to RUN lines from each of its lines.

Edge cases: a null or empty text has no sentences and no licence. Repeated rows
are treated row by row; empty input, empty output; other columns don't matter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import let, text_of

#: Lines of a sentence that are tried together, and identifiers that may stand between two of a rule.
RUN, GAP = 10, 3

#: SPDX identifier -> names, with "License" or without. A text refers to a licence by a name or by the identifier.
NAMES = {
    "0BSD": ["BSD Zero Clause"],
    "AFL-3.0": ["Academic Free License v. 3.0", "Academic Free License version 3.0"],
    "AGPL-3.0-only": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPL v3", "AGPLv3"],
    "Apache-1.1": ["Apache Software License, Version 1.1"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache Software License 2.0"],
    "Artistic-2.0": ["Artistic License 2.0", "Artistic 2.0"],
    "BSD-2-Clause": ["BSD 2-Clause", "Simplified BSD", "2-clause BSD"],
    "BSD-3-Clause": ["BSD 3-Clause", "New BSD", "Modified BSD", "3-clause BSD"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "BlueOak-1.0.0": ["Blue Oak Model License 1.0.0"],
    "CDDL-1.0": ["Common Development and Distribution License, Version 1.0", "CDDL 1.0"],
    "CECILL-2.1": ["CeCILL v2.1", "CeCILL 2.1"],
    "CPL-1.0": ["Common Public License Version 1.0"],
    "EPL-1.0": ["Eclipse Public License, Version 1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License v2.0", "Eclipse Public License 2.0"],
    "EUPL-1.2": ["European Union Public Licence, Version 1.2", "EUPL v1.2", "EUPL 1.2"],
    "GFDL-1.3-only": ["GNU Free Documentation License, Version 1.3"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2", "GPL v2"],
    "GPL-3.0-only": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3", "GPL v3"],
    "ISC": ["ISC"],
    "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL v2.1", "LGPLv2.1"],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "GNU LGPL v3", "LGPLv3"],
    "MIT": ["MIT", "MIT License (MIT)", "Expat"],
    "MIT-0": ["MIT No Attribution"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "Mozilla Public License 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "MS-PL": ["Microsoft Public License", "Ms-PL"],
    "MS-RL": ["Microsoft Reciprocal License"],
    "MulanPSL-2.0": ["Mulan PSL v2"],
    "NCSA": ["University of Illinois/NCSA Open Source"],
    "ODbL-1.0": ["Open Data Commons Open Database License", "Open Database License 1.0"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"],
    "OSL-3.0": ["Open Software License version 3.0", "Open Software License v. 3.0"],
    "PSF-2.0": ["Python Software Foundation License Version 2"],
    "PostgreSQL": ["PostgreSQL"],
    "UPL-1.0": ["Universal Permissive License, Version 1.0", "Universal Permissive License v 1.0"],
    "Unlicense": ["Unlicense"],
    "Vim": ["Vim"],
    "WTFPL": ["Do What The F*ck You Want To Public License", "WTFPL"],
    "X11": ["X11"],
    "Zlib": ["zlib", "zlib/libpng"],
    "BSD": ["BSD", "BSD-style"],
    "LicenseRef-MIT-style": ["MIT-style"],
}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
NAMES |= {f"CC-{short}-{v}": [f"CC {short} {v}", f"CC-{short} {v}", f"Creative Commons {long} {v}{region}"] for short, long in _CC.items() for v, region in (("2.0", " Generic"), ("2.5", " Generic"), ("3.0", " Unported"), ("4.0", " International"))}
NAMES |= {"CC0-1.0": ["CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"]}

#: Older SPDX identifiers and spellings -> those of today; every GNU licence has two, for this version and for later ones too.
OLD = {"CC-BY-SA-3.0-US": "CC-BY-SA-3.0", "BSD-2-Clause-FreeBSD": "BSD-2-Clause", "BSD-2-Clause-NetBSD": "BSD-2-Clause", "zlib": "Zlib", "MIT-Expat": "MIT"}
for _only in [k for k in NAMES if k.endswith("-only")]:
    _base = _only.removesuffix("-only")
    OLD |= {_base: _only, f"{_base}+": f"{_base}-or-later"}
    NAMES[f"{_base}-or-later"] = [f"{n}{later}" for n in NAMES[_only] for later in (" or later", ", or later", " or any later version", ", or (at your option) any later version", "+", " or newer")]

#: Identifier -> sentences, written as in the licences. Matching ignores case, punctuation and white space.
SENTENCES = {
    "ApacheGrant": ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "ApacheObtain": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "ApacheSee": ["See the License for the specific language governing permissions and limitations under the License."],
    "MIT/ref": ["MIT License", "The MIT License (MIT)", "The MIT License"],
    "ISC/ref": ["ISC License", "The ISC License"],
    "MITGrant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "MITNotice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "AsIsSoftware": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "ISCGrant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "0BSDGrant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
    "ZlibAsIs": ["This software is provided 'as-is', without any express or implied warranty."],
    "ZlibGrant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "BSDGrant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "BSDSource": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "BSDBinary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "BSDEndorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission."],
    "GPLWarranty": [f"This {x} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE." for x in ("program", "library", "software")],
    "MPL2Form": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Apache-2.0/text": ["\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document."],
    "GPL-3.0-only/text": ["The GNU General Public License is a free, copyleft license for software and other kinds of works."],
    "GPL-2.0-only/text": ["By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users."],
    "AGPL-3.0-only/text": ["The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."],
    "LGPL-3.0-only/text": ["This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."],
    "LGPL-2.1-only/text": ["This license, the Lesser General Public License, applies to some specially designated software packages--typically libraries--of the Free Software Foundation and other authors who decide to use it."],
    "MPL-2.0/text": ["You may distribute such Executable Form under the terms of this License, or sublicense it under different terms, provided that the license for the Executable Form does not attempt to limit or alter the recipients' rights in the Source Code Form under this License."],
    "EPL-2.0/text": ["THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\")."],
    "CC0Waiver": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "UnlicenseGrant": ["This is free and unencumbered software released into the public domain."],
    "BoostGrant": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"],
}
#: The grants of the GNU licences by name and version.
GNU = [("GPL", "General", "2"), ("GPL", "General", "3"), ("LGPL", "Lesser General", "2.1"), ("LGPL", "Lesser General", "3"), ("AGPL", "Affero General", "3")]
SENTENCES |= {
    f"{short}Free{v}": [f"This {x} is free software{a} you can redistribute it and/or modify it under the terms of the GNU {long} Public License as published by the Free Software Foundation{b} either version {v} of the License, or (at your option) any later version." for x in ("program", "library", "software") for a, b in ((":", ","), (";", ";"))]
    for short, long, v in GNU
}


@dataclass(frozen=True)
class LicenceRule:
    licence: str
    sequence: tuple[str, ...]
    overrides: tuple[str, ...] = ()


def _dotted(version: str) -> str:
    return version if "." in version else f"{version}.0"


#: In order; names are SPDX identifiers.
RULES = (
    LicenceRule("Apache-2.0", ("ApacheGrant", "ApacheObtain", "ApacheSee")),
    LicenceRule("Apache-2.0", ("ApacheGrant",)),
    LicenceRule("MIT", ("MITGrant", "MITNotice", "AsIsSoftware"), ("MIT-0",)),
    LicenceRule("MIT-0", ("MITGrant", "AsIsSoftware")),
    LicenceRule("BSD-3-Clause", ("BSDGrant", "BSDSource", "BSDBinary", "BSDEndorse"), ("BSD-2-Clause", "BSD")),
    LicenceRule("BSD-2-Clause", ("BSDGrant", "BSDSource", "BSDBinary"), ("BSD",)),
    LicenceRule("ISC", ("ISCGrant",)),
    LicenceRule("0BSD", ("0BSDGrant",)),
    LicenceRule("Zlib", ("ZlibAsIs", "ZlibGrant")),
    *[LicenceRule(f"{short}-{_dotted(v)}-or-later", (f"{short}Free{v}", "GPLWarranty"), (f"{short}-{_dotted(v)}-only",)) for short, _, v in GNU],
    LicenceRule("MPL-2.0", ("MPL2Form",)),
    LicenceRule("CC0-1.0", ("CC0Waiver",)),
    LicenceRule("Unlicense", ("UnlicenseGrant",)),
    LicenceRule("BSL-1.0", ("BoostGrant",)),
)

#: Every known sentence holds one of these words, so other texts need no further look.
TRIGGER = r"(?i)licen[cs]e|permission|redistribut|copyright|warrant|public domain"

#: Normalisation of "\n" + lower-case text as (pattern, replacement) in order; the patterns mean the same in Java, Python and RE2.
NORMAL = (
    (r"\r\n?", "\n"),
    # An SPDX expression becomes an identifier line for each of its terms; an exception belongs to its term.
    (r"(spdx-license-identifier:[ (]*[a-z0-9.+-]+) with [a-z0-9.-]+", r"\1"),
    *[(r"(spdx-license-identifier:[ (]*[a-z0-9.+-]+)[ )]+(?:and|or)[ (]+([a-z0-9.+-]+)(?: with [a-z0-9.-]+)?", r"\1 . spdx-license-identifier: \2")] * 4,
    # A choice of two licences becomes two grants.
    (r"(?:dual[ -])?(?:licensed|released|distributed|available) under (?:the terms of )?(?:either|both)(?: of)?(?: the)? ([^\n]{3,80}?)(?: licenses?)?,? (?:or|and)(?: the)? ([^\n]{3,60}?)(?: licenses?)?(,? at your option|[.](?: |\n|$))", r" . licensed under \1 . licensed under \2 . "),
    (r"dual[ -]licensed under (?:the terms of )?(?:the )?([^\n]{3,60}?)(?: licenses?)?,? (?:or|and)(?: the)? ([^\n]{3,60}?)(?: licenses?)?(,? at your option|[.](?: |\n|$))", r" . licensed under \1 . licensed under \2 . "),
    (r"[ \t]*(?:\*+/|-->)[ \t]*\n", "\n"),
    (r"\n[ \t]*(?:/\*+|\*+/|//+|[*#;%>]+|--+|<!--)[ \t]*", "\n"),
    (r"\n[ \t]*(?:\(?(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})[.)]|[\x{2022}-])[ \t]+", "\n . "),
    (r"\n[ \t]*\n", " . "),
    (r":[ \t]*\n", " . "),
    (r"\n", " / "),
    (r"[.!?]+([ \t]|$)", " . "),
    (r"[^a-z0-9./+-]+", " "),
    (r"neither the names? of [a-z0-9 ./+-]{1,200}? nor the names? of [a-z /]{1,40}?contributors(?: /)? may be used", "neither the name of the copyright holder nor the names of its contributors may be used"),
)
BOUNDARY, LINE = r"(?:^|\s)\.(?:\s+\.)*(?:\s|$)", r"(?:^|\s)/(?:\s|$)"
#: The words by which a sentence says that something is licensed.
REF = r"^(?:(?:this|the) [a-z]+(?: [a-z]+)? is |it is |is )?(?:dual )?(?:licensed|released|distributed|published|made available|available|provided) under (?:the terms of )?(?:the |an? )?"


def _key(sentence: str) -> str:
    s = "\n" + sentence.lower()
    for pattern, new in NORMAL:
        s = re.sub(pattern.replace("\\x{2022}", "\u2022"), new, s)
    return re.sub(REF, "licensed under ", " ".join(re.sub(r"(^| )[./](?= |$)", " ", s).split()))


def _known() -> dict[str, str]:
    """Key of each known sentence -> its identifier."""
    out = {_key(s): name for name, group in SENTENCES.items() for s in group}
    for licence, names in NAMES.items():
        out |= {_key(f"SPDX-License-Identifier: {x}"): f"{licence}/spdx" for x in (licence, *(k for k, v in OLD.items() if v == licence))}
        for n in (*names, licence):
            out |= {k: f"{licence}/ref" for k in (_key(f"Licensed under the {n}"), _key(f"Licensed under the {n} License"), _key(f"Licensed under the {n} Licence"), _key(f"Use of this source code is governed by the {n} license that can be found in the LICENSE file"), _key(f"Use of this source code is governed by a {n} license that can be found in the LICENSE file")) if k not in out}
    return out


KNOWN = _known()


def _lookup() -> Column:
    return F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])


def _identifiers(text: Column) -> Column:
    s = F.concat(F.lit("\n"), F.lower(text))
    for pattern, new in NORMAL:
        s = F.regexp_replace(s, pattern, re.sub(r"\\(\d)", r"$\1", new))  # groups as Java writes them
    tidy = lambda x: F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(x, LINE, " "), " +", " ")), REF, "licensed under ")
    # Only sentences with a trigger word can be known.
    name = lambda x: F.when(x.rlike(TRIGGER), F.try_element_at(_lookup(), tidy(x)))

    def runs(lines: Column) -> Column:
        """The longest known run of lines from each line on."""
        run = lambda i: F.array_compact(F.transform(F.sequence(F.least(F.lit(RUN), F.size(lines) - i), F.lit(1), F.lit(-1)), lambda r: name(F.array_join(F.slice(lines, i + 1, r), " "))))
        return F.array_compact(F.transform(lines, lambda x, i: F.get(run(i), F.lit(0))))

    some = lambda x: F.when(x.rlike(TRIGGER), runs(F.split(x, LINE))).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(F.split(s, BOUNDARY), lambda x: let(name(x), lambda y: F.when(y.isNotNull(), F.array(y)).otherwise(some(x)))))


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, sentence_ids (array, in text order) and licences (array, sorted)."""
    text = text_of(docs)
    none = F.array().cast("array<string>")
    df = docs.select(*[docs[c] for c in keep], F.when(text.rlike(TRIGGER), _identifiers(text)).otherwise(none).alias("sentence_ids"))
    ids = F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(","))
    between = f",([^,]+,){{0,{GAP}}}"

    def licences(x: Column) -> Column:
        holds = lambda rule: x.rlike("," + between.join(rule.sequence) + ",")
        found = F.array_compact(F.array(*[F.when(holds(r), F.lit(r.licence)) for r in RULES]))
        alone = F.transform(F.filter("sentence_ids", lambda i: i.contains("/")), lambda i: F.substring_index(i, "/", 1))
        silenced = F.flatten(F.array(*[F.when(holds(r), F.array(*[F.lit(y) for y in r.overrides])).otherwise(none) for r in RULES if r.overrides]))
        return F.array_sort(F.array_except(F.concat(found, alone), silenced))

    return df.withColumn("licences", F.when(F.size("sentence_ids") > 0, let(ids, licences)).otherwise(none))


def op2(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences (known ones), sentence_ids and licences (comma-joined), n_licences."""
    df = scan(docs)
    return df.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"), F.size("licences").cast("long").alias("n_licences"))


def _oracle() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    s = "concat(chr(10), lower(coalesce(text, '')))"
    for pattern, new in NORMAL:
        s = f"regexp_replace({s}, {quote(pattern)}, {quote(new)}, 'g')"
    tidy = lambda x: f"regexp_replace(trim(regexp_replace(regexp_replace({x}, {quote(LINE)}, ' ', 'g'), ' +', ' ', 'g')), {quote(REF)}, 'licensed under ')"
    known = "MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in KNOWN.items()) + "}"
    rules = [(r, quote("," + f",([^,]+,){{0,{GAP}}}".join(r.sequence) + ",")) for r in RULES]
    found = ", ".join(f"CASE WHEN regexp_matches(j, {p}) THEN {quote(r.licence)} END" for r, p in rules)
    bad = ", ".join(f"CASE WHEN regexp_matches(j, {p}) THEN {quote(x)} END" for r, p in rules for x in r.overrides)
    return f"""
WITH known AS (SELECT unnest(map_entries({known})) AS e), d AS (SELECT row_number() OVER () AS k, doc_id, {s} AS s, regexp_matches(coalesce(text, ''), {quote(TRIGGER)}) AS hot FROM documents),
s1 AS (SELECT k, i, u AS s FROM (SELECT k, unnest(regexp_split_to_array(s, {quote(BOUNDARY)})) AS u, generate_subscripts(regexp_split_to_array(s, {quote(BOUNDARY)}), 1) AS i FROM d WHERE hot) WHERE regexp_matches(u, {quote(TRIGGER)})),
n1 AS (SELECT k, i, s, e.value AS name FROM s1 LEFT JOIN known ON e.key = {tidy("s")}),
s2 AS (SELECT k, i, l, unnest(range(1, len(l) + 1)) AS i2 FROM (SELECT k, i, regexp_split_to_array(s, {quote(LINE)}) AS l FROM n1 WHERE name IS NULL)),
s3 AS (SELECT k, i, i2, r, array_to_string(l[i2 : i2 + r - 1], ' ') AS s FROM (SELECT k, i, i2, l, unnest(range(1, least({RUN}, len(l) - i2 + 1) + 1)) AS r FROM s2)),
n2 AS (SELECT k, i, i2, arg_max(e.value, r) AS name FROM s3 JOIN known ON e.key = {tidy("s")} GROUP BY k, i, i2),
a AS (SELECT k, i, 0 AS i2, name FROM n1 WHERE name IS NOT NULL UNION ALL SELECT k, i, i2, name FROM n2),
g AS (SELECT k, count(*) AS n, string_agg(name, ',' ORDER BY i, i2) AS ids FROM a GROUP BY k),
j AS (SELECT doc_id, coalesce(n, 0) AS n, coalesce(ids, '') AS ids, ',' || coalesce(ids, '') || ',' AS j FROM d LEFT JOIN g USING (k)),
f AS (SELECT doc_id, n, ids, list_concat([{found}], list_transform(list_filter(string_split(ids, ','), lambda x: contains(x, '/')), lambda x: split_part(x, '/', 1))) AS found, [{bad}] AS bad FROM j),
r AS (SELECT doc_id, n, ids, list_sort(list_distinct(list_filter(found, lambda x: x IS NOT NULL AND NOT coalesce(list_contains(bad, x), false)))) AS lic FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n_sentences, ids AS sentence_ids, array_to_string(lic, ',') AS licences, CAST(len(lic) AS BIGINT) AS n_licences FROM r
"""


ORACLE = _oracle()
