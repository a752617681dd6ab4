"""Licence scans by canonical digests.

A text is brought to a canonical form (lower case, copyright lines dropped, equivalent spellings unified,
every run of other characters than letters and digits made one space) and its SHA-256 digest is hash-joined
to the digests of known licences: a document is a licence if its whole text is one. Lines that mention a
licence are digested the same way and hash-joined to known one-line notices, which are all combinations of usual
phrases and licence names. All of it is DataFrame functions; the known tables are lists of a fixed
number of rows, independent of the data.

A copyright line names a holder: it begins with "copyright" and holds (c), a year or a place for one, or begins with (c) or
"all rights reserved". A wrapped line of a licence that begins with "copyright holders" is none.

Defined cases: a null text counts as empty; an empty text has the digest of the empty string and matches
nothing; a text of any length is digested whole; a null doc_id is kept; repeated rows are each reported; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

# The wording of licences and notices, as published.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_3_CLAUSE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ZERO_BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
WTFPL = """DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
Version 2, December 2004
Copyright (C) 2004 Sam Hocevar <sam@hocevar.net>
Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.
DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE
TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION
0. You just DO WHAT THE FUCK YOU WANT TO."""
MIT_0 = MIT.replace(", subject to the following conditions:", ".").replace("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n", "")
BSD_3 = BSD_2.replace("THIS SOFTWARE IS PROVIDED BY", BSD_3_CLAUSE + "\nTHIS SOFTWARE IS PROVIDED BY")
LICENCES = [
    ("MIT", MIT), ("MIT", "MIT License\n" + MIT), ("MIT", "The MIT License (MIT)\n" + MIT), ("ISC", ISC), ("ISC", "ISC License\n" + ISC),
    ("BSD-2-Clause", BSD_2), ("BSD-2-Clause", "BSD 2-Clause License\n" + BSD_2), ("BSD-3-Clause", BSD_3), ("BSD-3-Clause", "BSD 3-Clause License\n" + BSD_3),
    ("Zlib", ZLIB), ("Zlib", "zlib License\n" + ZLIB), ("Unlicense", UNLICENSE), ("0BSD", ZERO_BSD), ("0BSD", "BSD Zero Clause License\n" + ZERO_BSD), ("MIT-0", MIT_0),
    ("MIT-0", "MIT No Attribution\n" + MIT_0), ("BSL-1.0", BOOST), ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n" + BOOST), ("WTFPL", WTFPL),
]
# How licences are called in notices.
NAMES = {
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "the GNU Affero General Public License v3.0", "the AGPLv3 license"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 license", "the Apache-2.0 license"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "the Modified BSD License"],
    "BSL-1.0": ["the Boost Software License, Version 1.0", "the Boost Software License 1.0"],
    "CC-BY-4.0": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License", "the Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License", "the Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License", "the Creative Commons Attribution-ShareAlike 4.0 International License"],
    "EPL-2.0": ["the Eclipse Public License 2.0", "the Eclipse Public License, version 2.0", "the Eclipse Public License v2.0"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GPLv2 license"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GPLv3 license"],
    "ISC": ["the ISC License"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License v2.1"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License v3.0"],
    "MIT": ["the MIT License", "the MIT/Expat License", "the Expat License"],
    "MPL-2.0": ["the Mozilla Public License 2.0", "the Mozilla Public License, version 2.0", "the Mozilla Public License, v. 2.0"],
    "Unlicense": ["the Unlicense license"],
    "Zlib": ["the zlib License", "the zlib/libpng License"],
}
#: What is licensed, and what may be said of names that hold the word "license" themselves.
SUBJECTS = ["", "This work is ", "This software is ", "This program is ", "This project is ", "This document is ", "This file is ", "This text is ", "This article is ", "This page is ", "This content is "]
VERBS = ["Released under ", "Distributed under ", "Published under ", "Available under ", "Distributed under the terms of ", "Released under the terms of ", "Licensed under the terms of "]
NOTICES = [(key, f"{subject}licensed under {name}.") for key, names in NAMES.items() for name in names for subject in SUBJECTS]
NOTICES += [(key, f"{verb}{name}.") for key, names in NAMES.items() for name in names if "license" in name.lower() for verb in VERBS]
# Spellings that count as equal, as whole words of the lower-case text.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub-license", "sublicense"), ("sub license", "sublicense"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorised", "authorized"), ("favour", "favor"), ("initialise", "initialize"),
    ("merchantibility", "merchantability"), ("non-infringement", "noninfringement"), ("organisation", "organization"), ("recognise", "recognize"), ("utilisation", "utilization"), ("whilst", "while"),
]
#: Further ids of which a line "SPDX-License-Identifier: ID" is a notice.
SPDX_IDS = (
    "0BSD AGPL-3.0-only AGPL-3.0-or-later Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 EUPL-1.2 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0"
    " GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MPL-2.0 Unlicense WTFPL Zlib"
).split()
SPDX_NOTICES = [(x, f"SPDX-License-Identifier: {x}") for x in SPDX_IDS]
#: Digests of further whole licences, from the full texts in /usr/share/common-licenses.
DIGESTS = [
    ("Apache-2.0", "f92c423b6d6da66caa78abd6f49f73f5bc8715dca82e1a73f62d1e6eec41986c"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "fbe9a0b96f52e03cb474f9a7083781399c011279e85b548118563ec96e659354"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
]
_HOLDER = r"(?:copyright[^\n]*(?:\(c\)|©|[0-9]{4}|[\[<{](?:yyyy|year))|\(c\)|©|all rights reserved)[^\n]*"
COPYRIGHT_LINE = rf"(^|\n)[ \t]*{_HOLDER}"
#: A copyright line behind comment marks; such lines are dropped as well when whole texts are looked up.
COMMENTED_LINE = rf"(^|\n)[ \t]*(?:#+|\*+|/\*+|//+|;+|--+|%+|<!--)[ \t]*{_HOLDER}"
SEPARATORS = r"[^\p{L}\p{N}]+"
MENTION = r"(?i)licen[cs]e"


def _let(value: Column, then) -> Column:
    """then(value), with value computed once."""
    return F.transform(F.array(value), then)[0]


def canonical(text: Column) -> Column:
    """The form of a text that licences are compared in."""

    def without_copyright(t: Column) -> Column:
        marks = [t.contains(m) for m in ("copyright", "(c)", "©", "all rights reserved")]  # cheap tests first: few texts hold any
        return F.when(marks[0] | marks[1] | marks[2] | marks[3], F.regexp_replace(t, COPYRIGHT_LINE, "$1")).otherwise(t)

    def respelt(t: Column) -> Column:
        out = t
        for a, b in SPELLINGS:
            out = F.regexp_replace(out, rf"\b{a}\b", b)
        return F.when(t.rlike(r"\b(?:" + "|".join(a for a, _ in SPELLINGS) + r")\b"), out).otherwise(t)

    lower = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.btrim(F.regexp_replace(_let(_let(lower, without_copyright), respelt), SEPARATORS, " "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def uncommented(text: Column) -> Column:
    """The digest of a text without copyright lines in comments; null if it has none."""
    lower = F.lower(text.cast("string"))
    return F.when(lower.contains("copyright") | lower.contains("(c)") | lower.contains("©") | lower.contains("all rights reserved"), F.when(lower.rlike(COMMENTED_LINE), digest(F.regexp_replace(lower, COMMENTED_LINE, "$1"))))


def mention(notices: list[tuple[str, str]]) -> str:
    """A pattern of which each line that can be one of the notices has a match: MENTION, or the longest word of a notice without it."""
    same = dict(SPELLINGS)
    words = set()
    for _, text in notices:
        own = re.findall(r"[^\W_]+", text.lower())
        if own and not re.search(MENTION, text):
            word = max(own, key=len)
            word = same.get(word, word)
            words |= {word, *(a for a, b in SPELLINGS if b == word)}
    return "(?iu)" + "|".join([MENTION.removeprefix("(?i)"), *sorted(words)]) if words else MENTION


def known(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """license_id and digest of a list of known texts, one row per digest."""
    texts = spark.createDataFrame(rows, "license_id string, text string")
    return texts.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, licences: list[tuple[str, str]] = LICENCES, notices: list[tuple[str, str]] = NOTICES + SPDX_NOTICES, digests: list[tuple[str, str]] = DIGESTS) -> DataFrame:
    """doc_id, digest, license_id (null if the text is no known licence) and notice_ids (sorted, comma-separated)."""
    spark = docs.sparkSession
    whole = known(spark, licences).unionByName(spark.createDataFrame(digests, "license_id string, digest string")).groupBy("digest").agg(F.min("license_id").alias("license_id"))
    text, gate = F.coalesce(F.col("text").cast("string"), F.lit("")), mention(notices)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(gate))
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"), uncommented(F.col("text")).alias("_other"), F.transform(lines, digest).alias("_lines"), F.monotonically_increasing_id().alias("_row"))
    rows = materialize(rows, "digests")  # no texts; rows keep their number from here on
    said = F.broadcast(known(spark, notices).toDF("_line", "_notice"))  # a fixed number of rows
    hits = rows.select("_row", F.explode(F.array_distinct("_lines")).alias("_line")).join(said, "_line")
    hits = hits.groupBy("_row").agg(F.array_join(F.array_sort(F.collect_set("_notice")), ",").alias("notice_ids"))  # some of the fixed ids
    found = F.broadcast(whole.toDF("_key", "license_id"))
    joined = rows.join(found, F.coalesce("_other", "digest") == F.col("_key"), "left").join(hits, "_row", "left")
    return joined.select("doc_id", "digest", "license_id", F.coalesce("notice_ids", F.lit("")).alias("notice_ids"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql_canonical(text: str) -> str:
    out = f"regexp_replace(lower(coalesce({text}, '')), '{COPYRIGHT_LINE}', '\\1', 'g')"
    for a, b in SPELLINGS:
        out = f"regexp_replace({out}, '\\b{a}\\b', '{b}', 'g')"
    return f"trim(regexp_replace({out}, '{SEPARATORS}', ' ', 'g'))"


def _sql_known(rows: list[tuple[str, str]]) -> str:
    quoted = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in rows)
    return f"SELECT sha256({_sql_canonical('t')}) AS digest, min(id) AS license_id FROM (VALUES {quoted}) v(id, t) GROUP BY 1"


ORACLE = f"""
WITH whole AS ({_sql_known(LICENCES)}), short AS ({_sql_known(NOTICES + SPDX_NOTICES)}),
docs AS (SELECT doc_id, text, sha256({_sql_canonical('text')}) AS digest FROM documents),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
hits AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids
  FROM (SELECT doc_id, sha256({_sql_canonical('line')}) AS digest FROM lines WHERE regexp_matches(line, '{MENTION}')) JOIN short USING (digest) GROUP BY doc_id)
SELECT d.doc_id, d.digest, w.license_id, coalesce(h.ids, '') AS notice_ids
FROM docs d LEFT JOIN whole w ON w.digest = d.digest LEFT JOIN hits h ON h.doc_id = d.doc_id
"""
