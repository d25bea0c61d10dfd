"""License scans: canonical text, SHA-256, hash join with digests of known license texts and notices.

Two texts are the same license if they agree after: lower case; copyright notices dropped, which are lines that begin with
"copyright" and go on with (c), the sign, a year or a name (not with "notice", "holder" and the like, as wrapped lines of a license do);
equivalent spellings unified; every run of ASCII punctuation, control characters and white space made one space.  The whole text of a document
is looked up, and each of its lines that speaks of a license is looked up as a notice.

Only DataFrame functions are used.  Known texts are a table, of any size: ``digests`` makes its digests, and ``scan`` joins them by hash.  Spark
broadcasts them where they are below ``spark.sql.autoBroadcastJoinThreshold``, and then documents are not shuffled; the query's own table has
one row for each entry below, whatever the corpus.

Defined results: null and empty texts have the digest of the empty string and no license; null ids are kept; repeated rows repeat; of several known
texts with one digest the first license id holds; a text needs some ten times its size in a task; an empty table gives an empty table;
extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limes.llm.common import table, texts, written

# Well-known license texts and notices (SPDX id, kind, text).
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>"""
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003
Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:
The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GNU_HEADER = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.
You should have received a copy of the GNU {name} along with this program. If not, see <https://www.gnu.org/licenses/>."""
KNOWN: list[tuple[str, str, str]] = [
    ("Unlicense", "text", UNLICENSE),
    ("BSL-1.0", "text", BOOST),
    ("Apache-2.0", "text", APACHE_HEADER),
    ("GPL-3.0-or-later", "text", GNU_HEADER.format(name="General Public License")),
    ("LGPL-3.0-or-later", "text", GNU_HEADER.format(name="Lesser General Public License")),
    ("AGPL-3.0-or-later", "text", GNU_HEADER.format(name="Affero General Public License")),
    ("MIT", "text", MIT),
    ("MIT", "text", "MIT License\n" + MIT),
    ("MIT", "text", "The MIT License\n" + MIT),
    ("ISC", "text", f"{ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{ISC_TAIL}"),
    ("ISC", "text", f"ISC License\n{ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n{ISC_TAIL}"),
    ("0BSD", "text", f"{ISC_GRANT}.\n{ISC_TAIL}"),
    ("BSD-2-Clause", "text", f"{BSD_HEAD}\n{BSD_TAIL}"),
    ("BSD-3-Clause", "text", f"{BSD_HEAD}\n{BSD_NAMES}\n{BSD_TAIL}"),
    ("Zlib", "text", ZLIB),
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "This project is licensed under the MIT License."),
    ("MIT", "notice", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "notice", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "notice", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "notice", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "notice", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "notice", "SPDX-License-Identifier: CC0-1.0"),
    ("BSD-3-Clause", "notice", "SPDX-License-Identifier: BSD-3-Clause"),
]

# Spellings that count as equal, in canonical (lower, single-spaced) text.
SPELLINGS = [("licence", "license"), ("copyright owner", "copyright holder"), ("acknowledgement", "acknowledgment"), ("favour", "favor"), ("non infringement", "noninfringement"), ("per cent", "percent"), ("sub license", "sublicense"), ("merchantibility", "merchantability"), ("redistributions", "redistribution")]
GOES_ON = r"(?:notices?|holders?|owners?|laws?|licen[sc]es?|statements?|interests?|infringements?|protection|and|or|in)\b"
COPYRIGHT_NOTICE = r"(^|\n)[ \t#*/;-]*copyright(?![a-z])(?![ \t\r.,:;'*\x22-]*(?:" + GOES_ON + r"|\n|$))[^\n]*"
PUNCTUATION = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def canonical(text: Column) -> Column:
    low = F.lower(text)
    kept = F.when(F.contains(low, F.lit("copyright")), F.regexp_replace(low, COPYRIGHT_NOTICE, "\n")).otherwise(low)
    out = F.trim(F.regexp_replace(kept, PUNCTUATION, " "))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def digests(known: DataFrame) -> DataFrame:
    """``digest, kind, license_id`` of ``license_id, kind ('text' or 'notice'), text``, canonicalised by the same expression as documents."""
    return known.select("license_id", "kind", F.sha2(canonical(F.col("text")), 256).alias("digest")).groupBy("digest", "kind").agg(F.min("license_id").alias("license_id"))


def known_digests(spark, known: list[tuple[str, str, str]] = KNOWN) -> DataFrame:
    """Digests of the entries above; written, so that Spark knows how small they are."""
    return written(digests(spark.createDataFrame(known, "license_id string, kind string, text string")), "license-digests")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row for each whole text (``line_no`` 0; ``license_id`` null if unknown) and each line that is a known notice."""
    # The guard only spares the splitting of texts that have no such line; it drops none.
    lines = F.when(
        F.contains(F.lower("text"), F.lit("licen")),
        F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct((i + 1).cast("long").alias("line_no"), x.alias("part"))), lambda x: F.contains(F.lower(x["part"]), F.lit("licen"))),
    ).otherwise(F.array().cast("array<struct<line_no:bigint,part:string>>"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("line_no"), F.col("text").alias("part")))
    items = texts(docs).select("doc_id", F.explode(F.concat(whole, lines)).alias("item"))
    hashed = items.select("doc_id", "item.line_no", F.when(F.col("item.line_no") == 0, "text").otherwise("notice").alias("kind"), F.sha2(canonical(F.col("item.part")), 256).alias("digest"))
    return hashed.join(known, ["digest", "kind"], "left").filter("line_no = 0 OR license_id IS NOT NULL").select("doc_id", "line_no", "kind", "digest", "license_id")


def op6_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), known_digests(spark))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_canonical(x: str) -> str:
    """The statement's expressions have no look-ahead, so it judges line by line: what begins as a notice and does not go on as a text does."""
    begins = r"^[ \t#*/;-]*copyright"
    goes_on = _quoted(begins + r"[ \t\r.,:;'*\x22-]*(" + GOES_ON + "|$)")
    kept = f"array_to_string(list_filter(string_split(lower({x}), chr(10)), lambda l: NOT (regexp_matches(l, '{begins}([^a-z]|$)') AND NOT regexp_matches(l, {goes_on}))), chr(10))"
    out = f"trim(regexp_replace(CASE WHEN contains(lower({x}), 'copyright') THEN {kept} ELSE lower({x}) END, '{PUNCTUATION}', ' ', 'g'))"
    for a, b in SPELLINGS:
        out = f"replace({out}, '{a}', '{b}')"
    return out


ORACLE = f"""
WITH known AS (
  SELECT digest, kind, min(license_id) AS license_id
  FROM (SELECT license_id, kind, sha256({_sql_canonical('text')}) AS digest FROM (VALUES {', '.join(f"({_quoted(a)}, {_quoted(b)}, {_quoted(c)})" for a, b, c in KNOWN)}) v(license_id, kind, text))
  GROUP BY ALL),
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no, unnest(string_split(text, chr(10))) AS part FROM docs),
hashed AS (
  SELECT doc_id, 0::BIGINT AS line_no, 'text' AS kind, sha256({_sql_canonical('text')}) AS digest FROM docs
  UNION ALL SELECT doc_id, line_no, 'notice', sha256({_sql_canonical('part')}) FROM lines WHERE contains(lower(part), 'licen'))
SELECT h.doc_id, h.line_no, h.kind, h.digest, k.license_id FROM hashed h LEFT JOIN known k USING (digest, kind)
WHERE h.line_no = 0 OR k.license_id IS NOT NULL
"""
