"""Licence scan by canonical digests: whole texts and whole lines are looked up among known licence texts.

A text is made canonical in steps: lower case, copyright lines out (lines that begin with the word and a year, a mark or a
placeholder, or with a mark alone), every run of other characters than letters and digits to one space, the phrase that
reserves all rights out, equivalent spellings to one. Its SHA-256 is joined to the digests of the known texts, made canonical in the same way.
The lines of a text are looked up likewise, which finds licence notices inside other texts.

Null texts are empty; texts that are empty once canonical match nothing. If several licences have one canonical text, the
first id counts. Repeated rows give repeated rows; an empty table or an empty list of licences gives no matches. Other columns
than the text and the id are not read. Known are the texts and notices in KNOWN, written out, and the full texts in KNOWN_WHOLE,
of which only the digests are kept; a table of digest and license_id may be given instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alluvia.llm.storage import materialise

# Equivalent spellings, as stems after canonical spacing; each first form becomes the second.
SPELLINGS = (
    ("licenc", "licens"), ("sub licens", "sublicens"), ("acknowledgement", "acknowledgment"), ("analys", "analyz"), ("artefact", "artifact"),
    ("authoris", "authoriz"), ("cancelled", "canceled"), ("catalogue", "catalog"), ("centre", "center"), ("favour", "favor"),
    ("fulfilment", "fulfillment"), ("initialis", "initializ"), ("judgement", "judgment"), ("labour", "labor"), ("modelling", "modeling"),
    ("non commercial", "noncommercial"), ("offence", "offense"), ("organis", "organiz"), ("per cent", "percent"), ("programme", "program"),
    ("recognis", "recogniz"), ("utilis", "utiliz"), ("whilst", "while"), ("wilful", "willful"), ("copyright owner", "copyright holder"),
)
COPYRIGHT_LINE = r"(^|\n)[ \t/*#;.-]*(copyright[ \t:,]*(\(c\)|©|[0-9]{4}|[<\[{ (]*(year|yyyy)\b)|\(c\)|©)[^\n]*"
RESERVED = "all rights reserved"
SEPARATORS = r"[^\p{L}\p{N}\n]+"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

_MIT_0 = _MIT.replace(", subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", ".")
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""
_BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_GNU_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.

You should have received a copy of the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>."""
_MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
_ISC = _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_END

# Full texts with the identifier that they stand for and the titles that may stand above them.
_TITLED = (
    ("MIT", _MIT, ("The MIT License", "MIT License", "The MIT License (MIT)", "MIT")),
    ("MIT-0", _MIT_0, ("MIT No Attribution", "MIT No Attribution License")),
    ("ISC", _ISC, ("ISC License", "The ISC License")),
    ("0BSD", _ISC_GRANT + ".\n\n" + _ISC_END, ("BSD Zero Clause License", "Zero-Clause BSD")),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_END, ("BSD 2-Clause License", "The 2-Clause BSD License", "Simplified BSD License")),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_END, ("BSD 3-Clause License", "The 3-Clause BSD License", "New BSD License", "BSD License")),
    ("Zlib", _ZLIB, ("zlib License", "The zlib License")),
    ("Unlicense", _UNLICENSE, ("The Unlicense",)),
    ("BSL-1.0", _BOOST, ()),
)

# Known texts and one-line notices with the identifier that they stand for.
KNOWN = (
    *((name, f"{title}\n\n{text}" if title else text) for name, text, titles in _TITLED for title in ("", *titles)),
    ("Unlicense", _UNLICENSE.replace("https://unlicense.org", "http://unlicense.org/")),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    *((f"{k}-{version}-or-later", _GNU_NOTICE.format(name=name, version=version)) for k, name, versions in (("GPL", "General Public License", ("2", "3")), ("LGPL", "Lesser General Public License", ("2.1", "3")), ("AGPL", "Affero General Public License", ("3",))) for version in versions),
    ("MPL-2.0", _MPL_NOTICE),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    *((name, f"SPDX-License-Identifier: {name}") for name in ("MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-3.0-only", "MPL-2.0")),
)

# SHA-256 of the canonical forms of further whole texts.
KNOWN_WHOLE = (
    ("Apache-2.0", "4580e5390400d27df89edd0617548ac0e66eaa029f6e07cf98aac9cd100b3a37"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "1c057ea35084eb195331cec1a49fca335c176422a7726a9a23636906fd4e241f"),
    ("GFDL-1.3", "7e8edd3abe6258bb82bb853d91a0c24fcd9976894fd0592747354cffe1cb18e7"),
    ("GPL-1.0", "98db0b473e0a45a62b04a39b6b864b4e079a58d513e2196f94fe7252fa8574a6"),
    ("GPL-2.0", "e95eb1718f9f373d56cc586a5f7d1bfa11668867f6e85e982d2b6108b97d90a1"),
    ("GPL-3.0", "df71f3c423c11bc52456a9775329f1d9a3168a6f071654750b9eb155fb3ec0eb"),
    ("LGPL-2.0", "e4deecd0730802431ad09f00ae3793f3703c8e4dba639586545d9f958405614d"),
    ("LGPL-2.1", "d3826e4e563a04a354453ff139a32b19d6c3fe283f518eb566107c54e18cd01f"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1"),
    ("MPL-2.0", "9e79a7d513376f6fa1500e4df4f6276c6e7e61c5c3e28dcdb1acee24033acc56"),
    ("Apache-2.0", "0b8c1a9e0ec99ab3b27e123e667fe4843df4dd7e6c667ccdc634dd6878c5dd6c"),
)


def canonical_lines(text: Column) -> Column:
    """The canonical text with its line breaks."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "\n")
    out = F.replace(F.regexp_replace(out, SEPARATORS, " "), F.lit(RESERVED), F.lit(""))
    for other, one in SPELLINGS:
        out = F.replace(out, F.lit(other), F.lit(one))
    return out


def digest(canonical: Column) -> Column:
    """SHA-256 in hexadecimal of a canonical text with its white space made plain, and the spellings of several words that stood on two lines; null if nothing is left."""
    plain = F.trim(F.regexp_replace(canonical, r"[ \n]+", " "))
    for other, one in SPELLINGS:
        if " " in other:
            plain = F.replace(plain, F.lit(other), F.lit(one))
    return F.when(plain != "", F.sha2(plain, 256))


def known_digests(spark: SparkSession, known=KNOWN, whole=KNOWN_WHOLE) -> DataFrame:
    """digest and license_id of the known texts, one row for each digest; texts of one licence may be many."""
    rows = spark.createDataFrame(list(known), "license_id string, text string").select("license_id", digest(canonical_lines(F.col("text"))).alias("digest"))
    rows = rows.unionByName(spark.createDataFrame(list(whole), "license_id string, digest string"))
    return rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def license_scan(df: DataFrame, known: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, canonical_sha256, license_id of the whole text (null: none), and license_ids of its lines, sorted, distinct and comma-joined, with the number of such lines.

    known: digest and license_id. The digests of whole texts and of lines are joined to it by hash; Spark broadcasts it only
    while its measured size allows.
    """
    lines = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.split(canonical_lines(F.col(text)), "\n").alias("lines"))
    digests = lines.select("doc_id", digest(F.array_join("lines", " ")).alias("whole"), F.array_compact(F.transform("lines", digest)).alias("each"))
    digests = materialise(digests.select("doc_id", "whole", F.transform("each", F.unhex).alias("each")), "licence-digests")
    by_line = known.select(F.unhex("digest").alias("digest"), "license_id")
    counted = digests.where(F.size("each") > 0).select("doc_id", "whole", F.xxhash64("each").alias("key"), F.explode("each").alias("digest"))
    notices = counted.join(by_line, "digest").groupBy("doc_id", "whole", "key").agg(F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("line_license_ids"), F.count("*").alias("n"))
    rows = digests.select("doc_id", "whole", F.xxhash64("each").alias("key"))
    copies = rows.groupBy("doc_id", "whole", "key").agg(F.count("*").alias("copies"))
    notices = notices.join(copies, ["doc_id", "whole", "key"])
    same = rows.doc_id.eqNullSafe(notices.doc_id) & (rows.whole == notices.whole) & (rows.key == notices.key)
    joined = rows.join(notices.select("doc_id", "whole", "key", "line_license_ids", (F.col("n") / F.col("copies")).cast("long").alias("n_license_lines")), same, "left")
    joined = joined.select(rows.doc_id, rows.whole, "line_license_ids", "n_license_lines").join(known.withColumnRenamed("digest", "whole"), "whole", "left")
    return joined.select("doc_id", F.col("whole").alias("canonical_sha256"), "license_id", F.coalesce("line_license_ids", F.lit("")).alias("line_license_ids"), F.coalesce("n_license_lines", F.lit(0)).alias("n_license_lines"))


def oracle(table: str = "documents", known=KNOWN, whole=KNOWN_WHOLE) -> str:
    """The same in DuckDB SQL."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def canonical(column: str) -> str:
        out = f"regexp_replace(lower(coalesce({column}, '')), {quoted(COPYRIGHT_LINE)}, chr(10), 'g')"
        out = f"replace(regexp_replace({out}, {quoted(SEPARATORS)}, ' ', 'g'), {quoted(RESERVED)}, '')"
        for other, one in SPELLINGS:
            out = f"replace({out}, {quoted(other)}, {quoted(one)})"
        return out

    def hashed(x: str) -> str:
        out = f"trim(regexp_replace({x}, '[ \\n]+', ' ', 'g'))"
        for other, one in SPELLINGS:
            if " " in other:
                out = f"replace({out}, {quoted(other)}, {quoted(one)})"
        return f"sha256(nullif({out}, ''))"

    values = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in known)
    digests = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in whole)
    return f"""
WITH told AS (SELECT license_id, {hashed(canonical("t"))} AS digest FROM (VALUES {values}) v(license_id, t) UNION ALL SELECT * FROM (VALUES {digests}) w(license_id, digest)),
known AS (SELECT digest, min(license_id) AS license_id FROM told GROUP BY digest),
lines AS (SELECT row_number() OVER () AS r, doc_id, {canonical("text")} AS c FROM {table}),
whole AS (SELECT r, doc_id, {hashed("c")} AS digest FROM lines),
each AS (SELECT r, {hashed("line")} AS digest FROM (SELECT r, unnest(string_split(c, chr(10))) AS line FROM lines)),
notices AS (SELECT r, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids, count(*) AS n FROM each JOIN known USING (digest) GROUP BY r)
SELECT w.doc_id, w.digest AS canonical_sha256, k.license_id, coalesce(n.ids, '') AS line_license_ids, coalesce(n.n, 0) AS n_license_lines
FROM whole w LEFT JOIN known k ON w.digest = k.digest LEFT JOIN notices n ON w.r = n.r
"""
