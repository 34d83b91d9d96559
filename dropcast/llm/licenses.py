"""Licence scan by canonical digests: normalise entire texts, then hash-join them to known licence digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: equivalent spellings (word, canonical word) -------------------------------
EQUIVALENT = [
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"),
    ("favour", "favor"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("judgement", "judgment"),
    ("labour", "labor"), ("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"),
    ("merchantibility", "merchantability"), ("modelled", "modeled"), ("organisation", "organization"),
    ("per cent", "percent"), ("sub license", "sublicense"), ("sub licensing", "sublicensing"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"),
    ("noncommercial", "non commercial"), ("whilst", "while"), ("wilful", "willful"), ("https", "http"),
]
# --- fixed values: texts of known licences and of the notices that stand for them --------------
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted"""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION
OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""
KNOWN = [
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}"),
    ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_END}"),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_END), ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_END), ("Zlib", _ZLIB),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
]
#: Digests of the normal forms of whole licence texts (as printed in Debian's common-licenses) that are too long for KNOWN.
#: ``scan_both`` knows them; ``scan``, whose SQL is made from KNOWN, does not.
FULL_TEXTS = [
    ("Apache-2.0", "6074c3536c43b739207170b87d1681477d0f07374ed3d862ba461334cce848e3"),
    ("GPL-2.0", "331b500eb3c5ee796906547305df82fff4a35b3aa03c1d3ea84d32078292b2e6"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
]
#: A line that only says whose copyright it is: optional comment signs, then the mark, to the line's end.
COPYRIGHT_LINE = r"(?m)^[ \t#*/;:<>!-]*(copyright|\(c\)|©|all rights reserved)([ \t]*(\(c\)|©|[0-9])[^\n]*|[ \t.]*)$"
#: Every text in KNOWN has one of these in its normal form, and no normal form has one that its lower-cased text lacks.
MARKS = ("licen", "software")
NOT_WORD = r"[\x00-\x2f\x3a-\x60\x7b-\x7f‐-‟ ]+"


def canonical(text: Column) -> Column:
    """Normal form of a whole text: lower case, no copyright lines, words separated by one blank,
    equivalent spellings replaced. Null counts as empty."""
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    t = F.trim(F.regexp_replace(t, NOT_WORD, " "))
    # spellings occur in few texts: their patterns run only where one of them occurs at all
    found = t.rlike("|".join(rf"\b{a}\b" for a, _ in EQUIVALENT))
    fixed = t
    for variant, word in EQUIVALENT:
        fixed = F.regexp_replace(fixed, rf"\b{variant}\b", word)
    return F.when(found, fixed).otherwise(t)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license_id) of the known texts: a fixed table of a few dozen short rows."""
    rows = spark.createDataFrame(known or KNOWN, "license_id string, body string")
    return rows.select(F.sha2(canonical(F.col("body")), 256).alias("digest"), "license_id").dropDuplicates(["digest"])


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, license_id) of every row: digest of its entire normalised text and the known licence with
    that digest, else null. Null and empty texts have the digest of the empty text and no licence unless one
    is given for it; repeated rows come back as often as they came; other columns are ignored. One pass, no
    shuffle: the known digests (a few dozen rows) are the broadcast side of a hash join.
    """
    known = (known if known is not None else known_digests(docs.sparkSession)).select(F.col("digest").alias("_digest"), "license_id")
    digests = docs.select(F.col(id_col), F.sha2(canonical(F.col(text_col)), 256).alias("digest"))
    return digests.join(F.broadcast(known), F.col("digest") == F.col("_digest"), "left").select(id_col, "digest", "license_id")


def scan_lines(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line_no, license_id) of every line that is, as an entire text of its own, a known licence or notice
    (lines as separated by newlines, numbered from 0)."""
    lines = docs.select(F.col(id_col), F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))
    lines = lines.where(F.octet_length("line") > 0)
    found = scan(lines.select(F.struct(F.col(id_col).alias("id"), "line_no").alias("at"), "line"), known, "at", "line")
    return found.where("license_id is not null").select(F.col("at.id").alias(id_col), "at.line_no", "license_id")


def scan_both(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, license_id, line_licenses) of every row: the results of ``scan``, which here knows FULL_TEXTS too,
    and, as an array of (line_no, license_id) in the order of the lines, those of ``scan_lines``. Rows without such a
    line have an empty array; null and repeated ids stay apart. One pass, no shuffle: the known digests (a bounded list, held
    by the driver) are a constant map; of equal digests the last name counts; an empty list knows nothing. Unless
    ``known`` is given, lines without any of ``MARKS`` are not digested, as they cannot be known.
    """
    marks = MARKS if known is None else ()
    if known is None:
        full = docs.sparkSession.createDataFrame(FULL_TEXTS, "license_id string, digest string")
        known = known_digests(docs.sparkSession).unionByName(full)
    named_digests = dict(known.where("digest is not null").select("digest", "license_id").orderBy("digest", "license_id").collect())
    entries = [F.lit(x) for pair in named_digests.items() for x in pair]
    by_digest = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")

    def marked(text: Column) -> Column:
        low = F.lower(text)
        found = F.lit(not marks)
        for m in marks:
            found = found | F.contains(low, F.lit(m))
        return found

    text = F.col(text_col)
    lines = F.transform(F.split(text, "\n"), lambda line, k: F.struct(k.alias("line_no"), line.alias("line")))
    lines = F.filter(lines, lambda x: (F.octet_length(x["line"]) > 0) & marked(x["line"]))
    none = F.array().cast("array<struct<line_no:int,license_id:string>>")
    named = F.transform(lines, lambda x: F.struct(
        x["line_no"].alias("line_no"), F.try_element_at(by_digest, F.sha2(canonical(x["line"]), 256)).alias("license_id")))
    found = F.when(marked(text), F.filter(named, lambda x: x["license_id"].isNotNull()))
    scanned = docs.select(F.col(id_col), F.sha2(canonical(text), 256).alias("digest"), F.coalesce(found, none).alias("line_licenses"))
    return scanned.select(id_col, "digest", F.try_element_at(by_digest, F.col("digest")).alias("license_id"), "line_licenses")
