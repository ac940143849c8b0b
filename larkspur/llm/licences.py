"""Licence scans: canonical text, digest, join with the digests of known licences."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Spellings that count as the same, written after lower-casing, in this order.
SPELLINGS = (
    ("licence", "license"), ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("organisation", "organization"), ("favour", "favor"),
    ("behaviour", "behavior"), ("analogue", "analog"), ("acknowledgement", "acknowledgment"), ("merchantibility", "merchantability"),
    ("fulfilment", "fulfillment"), ("copyright owner", "copyright holder"), ("https:", "http:"), ("&", " and "), ("’", "'"), ("“", '"'), ("”", '"'),
    ("–", "-"), ("—", "-"), (" ", " "),
)
#: Fixed patterns, alike in Java and RE2 syntax.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/;]*(copyright[ \t]*(\(c\)|©)?[ \t]*([0-9<\[{]|by )|\(c\)[ \t]*[0-9]|©|all rights reserved)[^\n]*"
PUNCTUATION = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"

#: Notices and short licences as they are published.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("0BSD", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

_CONDITIONS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_ENDORSEMENT = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Titles that stand before the bodies of short licences.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT"), "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD"), "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License"),
    "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License"), "Unlicense": ("The Unlicense", "Unlicense"),
}


def _whole() -> tuple[tuple[str, str], ...]:
    """Whole licences: the files of ``known_licences``, also up to their terms' end, BSD texts, and short bodies below a title."""
    found = [("BSD-2-Clause", _CONDITIONS + _DISCLAIMER), ("BSD-3-Clause", _CONDITIONS + _ENDORSEMENT + _DISCLAIMER)]
    # Lists of conditions are also set with bullets, which the canonical form drops.
    found += [(n, "\n".join(line[3:] if line[:3] in ("1. ", "2. ", "3. ") else line for line in t.split("\n"))) for n, t in found]
    for file in sorted((Path(__file__).parent / "known_licences").glob("*.txt")):
        text, end = file.read_text(encoding="utf-8"), "END OF TERMS AND CONDITIONS"
        found += [(file.stem, text)] + [(file.stem, text[: text.index(end)] + tail) for tail in ("", end) if end in text]
    bodies = [(n, t) for n, t in (*KNOWN, *found) if n in TITLES and len(t) > 300]
    return (*found, *((n, title + "\n\n" + t) for n, t in bodies for title in TITLES[n]))


KNOWN += _whole()


def canonical(text):
    """Lower case, one spelling, no copyright lines, runs of ASCII punctuation and white space as one space."""
    out = F.lower(text)
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, COPYRIGHT_LINE, "\n")
    return F.trim(F.regexp_replace(out, PUNCTUATION, " "))


def canonical_sql(text: str) -> str:
    """The same in DuckDB's SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    out = f"lower({text})"
    for old, new in SPELLINGS:
        out = f"replace({out}, {quote(old)}, {quote(new)})"
    return f"trim(regexp_replace(regexp_replace({out}, {quote(COPYRIGHT_LINE)}, chr(10), 'g'), {quote(PUNCTUATION)}, ' ', 'g'))"


def licence_matches(docs: DataFrame, known: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Entire texts, and entire lines of texts, that equal a known licence after normalising.

    ``known`` has ``licence`` and ``text``.  Returns doc_id, line (from 0;
    null for the whole text), licence and digest, a row per match.  The join
    is on the digest of the canonical text, so its size does not depend on
    the lengths of texts; Spark broadcasts the known digests if they are
    small.  Null and empty texts, and units without a letter or digit, match
    nothing.  Repeated rows give repeated matches; other columns are ignored.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("unit_text")).where("unit_text is not null")
    lines = slim.select("doc_id", F.posexplode(F.split("unit_text", "\n")).alias("line", "unit_text"))
    # A text of one line is found as a whole and as its line.
    units = slim.select("doc_id", F.lit(None).cast("int").alias("line"), "unit_text").unionByName(lines)
    digests = known.select("licence", canonical(F.col("text")).alias("c")).where("c <> ''").select("licence", F.md5("c").alias("digest")).distinct()
    return units.select("doc_id", "line", F.md5(canonical(F.col("unit_text"))).alias("digest")).join(digests, "digest").select("doc_id", "line", "licence", "digest")
