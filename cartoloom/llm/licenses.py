"""Licence scans by canonical digests, in DataFrame functions only.

A text is brought to a canonical form: lower case, copyright lines out, equivalent spellings made one, everything but
letters and digits a single space. The digest of the whole canonical text is looked up among the digests of known licences
by a hash join; single lines are looked up among known notices in the same way. Both lists are fixed and short, so the
join sends them to the tasks; a user's own list may be given as a frame and is joined by Spark's choice. Short licences are
known by their texts, long ones by the digests in ``license_digests``.

A line is a copyright statement if "copyright" or "(c)" is followed by a sign, a year or a word that no sentence goes on
with, a holder's name; a holder named by such a word needs the sign or the year. Other lines stay however they are wrapped.

Cases: a null or blank text matches nothing and has a null digest; repeated notices count each time; repeated rows give
repeated rows; other columns play no part.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .license_digests import DIGESTS

# Patterns of the canonical form, in an order that matters, for both Java's and RE2's syntax.
# Words that a sentence goes on with after "copyright", and after "(c)" as the number of an item.
_BODY_WORDS = (
    "notice notices holder holders owner owners owned ownership law laws license licenses licence licences licensed licensing statement statements interest interests "
    "permission permissions protection protections protected act acts treaty treaties right rights status disclaimer disclaimers information claim claims claimed "
    "attribution infringement infringements term terms line lines header headers file files policy condition conditions restriction restrictions exception exceptions "
    "limitation limitations material materials work works assignment assignments patent patents trademark trademarks on in of and or nor is are was were be been as to for "
    "from under over that this these those which who whose with within without may shall will can must should would could does do has have had not no any all if when where "
    "unless it its an at into such applicable other subject also whether either only than then but upon herein hereby thereof therein thereto like similar"
).split()
_ITEM_WORDS = "a the you your we our each every some one both he she they their them there by use using making including provided".split()


def _other_word(words: list[str]) -> str:
    """A pattern of the start of any word but these, without lookahead, which RE2 lacks."""

    def after(prefix: str) -> str:
        ends = sorted({w[len(prefix)] for w in words if w.startswith(prefix) and len(w) > len(prefix)})
        ways = [f"[^\\x00-\\x60{{-\\x7f{''.join(ends)}]", *(c + after(prefix + c) for c in ends)]
        if prefix and prefix not in words:
            ways += ["[\\x00-\\x09\\x0b-\\x60{-\\x7f]", "$"]
        return f"(?:{'|'.join(ways)})"

    return after("")


COPYRIGHT_LINE = (
    "(?m)^[^0-9a-z\\n]*(?:©|\\(c\\)[^0-9a-z\\n]*[12][0-9]{3}|copyrights?[^0-9a-z\\n]*(?:\\(c\\)|©|[12][0-9]{3})"
    f"|copyright[ \\t:*<\\[{{(-]+{_other_word(_BODY_WORDS)}|\\(c\\)[ \\t]+{_other_word(_BODY_WORDS + _ITEM_WORDS)})[^\\n]*$"
)
RESERVED_LINE = "(?m)^[^0-9a-z\\n]*all rights reserved[^0-9a-z\\n]*$"
NOT_TEXT = "[^0-9a-z\\x{80}-\\x{10FFFF}]+"
SPELLINGS = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("behaviour", "behavior"),
    ("cancelled", "canceled"),
    ("centre", "center"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("merchantibility", "merchantability"),
    ("modelling", "modeling"),
    ("organisation", "organization"),
    ("percent", "per cent"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("non commercial", "noncommercial"),
    ("sub license", "sublicense"),
    ("https", "http"),
]

# Whole licence texts (without their copyright lines) and one-line notices.
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
    "THE SOFTWARE."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY '
    "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
    "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
    "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
    "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal '
    "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
    "notice and this permission notice appear in all copies. " + _ISC_AS_IS
)
_ZERO_BSD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + _ISC_AS_IS
_BSD_3 = (
    _BSD_HEAD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. " + _BSD_AS_IS
)
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of '
    "the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License "
    'is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language '
    "governing permissions and limitations under the License."
)
LICENSES = [
    ("MIT", _MIT),
    ("MIT", "MIT License " + _MIT),
    ("MIT", "The MIT License (MIT) " + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License " + _ISC),
    ("0BSD", _ZERO_BSD),
    ("0BSD", "BSD Zero Clause License " + _ZERO_BSD),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_AS_IS),
    ("BSD-2-Clause", "BSD 2-Clause License " + _BSD_HEAD + _BSD_AS_IS),
    ("BSD-3-Clause", _BSD_3),
    ("BSD-3-Clause", "BSD 3-Clause License " + _BSD_3),
    ("Apache-2.0", _APACHE_NOTICE),
    *((name, f"sha256:{digest}") for name, digest in DIGESTS),
]
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1-only", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
]


def _lines_out(low: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(low, COPYRIGHT_LINE, " "), RESERVED_LINE, " ")


def canonical(text: Column, lines_out: bool = True) -> Column:
    """The canonical form; copyright lines go unless the text is a single line."""
    low = F.lower(text)
    out = F.concat(F.lit(" "), F.regexp_replace(_lines_out(low) if lines_out else low, NOT_TEXT, "  "), F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(f" {old.replace(' ', '  ')} "), F.lit(f" {new.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def canonical_text(text: str, lines_out: bool = True) -> str:
    """The same on the driver, for the fixed lists."""
    low = text.lower()
    if lines_out:
        low = re.sub(RESERVED_LINE, " ", re.sub(COPYRIGHT_LINE, " ", low))
    out = f" {re.sub('[^0-9a-z\x80-\U0010ffff]+', '  ', low)} "
    for old, new in SPELLINGS:
        out = out.replace(f" {old.replace(' ', '  ')} ", f" {new.replace(' ', '  ')} ")
    return re.sub(" +", " ", out).strip(" ")


def digests(entries: list[tuple[str, str]], lines_out: bool = True) -> dict[str, str]:
    """Digest of the canonical form -> licence; an entry may give its digest, after ``sha256:``, in place of a text."""
    return {t[7:] if t.startswith("sha256:") else hashlib.sha256(canonical_text(t, lines_out).encode()).hexdigest(): name for name, t in entries}


def digest_frame(entries: DataFrame, lines_out: bool = True) -> DataFrame:
    """``(digest, license)`` of a frame ``(name, text)``; of several names of one digest the least counts."""
    text = F.col("text")
    own = F.when(F.startswith(text, F.lit("sha256:")), F.substr(text, F.lit(8))).otherwise(F.sha2(canonical(text, lines_out), 256))
    return entries.where(text.isNotNull()).select(own.alias("digest"), F.col("name").alias("license")).groupBy("digest").agg(F.min("license").alias("license"))


def _lengths(entries: list[tuple[str, str]], lines_out: bool) -> tuple[int, int]:
    sizes = [len(canonical_text(t, lines_out)) for _, t in entries]
    return min(sizes), max(sizes)


def scan(docs: DataFrame, licenses=None, notices=None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, digest, license, n_notices, notice_licenses)`` for every row.

    ``digest`` is that of the whole canonical text, ``license`` the known licence it belongs to, ``notice_licenses`` the
    licences that its lines name. ``licenses`` and ``notices`` may be given as lists of (name, text) or as frames ``(name, text)``.
    """
    spark = docs.sparkSession
    if isinstance(licenses, DataFrame):
        known = digest_frame(licenses)
    else:
        known = F.broadcast(spark.createDataFrame([(d, n) for d, n in digests(licenses or LICENSES).items()], "digest string, license string"))  # as long as the list
    whole = canonical(F.col(text))
    digest = F.when(whole != "", F.sha2(whole, 256)).alias("digest")
    lines = F.split(F.col(text), "\n", -1)
    if isinstance(notices, DataFrame):
        marks = F.transform(lines, lambda x: F.sha2(canonical(x, False), 256))
        rows = docs.select(F.col(doc_id).alias("doc_id"), digest, marks.alias("marks"), F.monotonically_increasing_id().alias("row_id"))  # fixed once written
        rows = common.materialise(rows, "license-lines")
        hits = rows.select("row_id", F.explode("marks").alias("mark")).join(digest_frame(notices, False).select(F.col("digest").alias("mark"), F.col("license").alias("name")), "mark")
        names = hits.groupBy("row_id").agg(F.collect_list("name").alias("names"))  # of one document
        rows = rows.drop("marks").join(names, "row_id", "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))
    else:
        # lines: only those of a notice's length have a digest to look up
        notices = notices or NOTICES
        low, high = _lengths(notices, False)
        table = F.create_map(*[F.lit(x) for pair in digests(notices, False).items() for x in pair])
        near = F.filter(lines, lambda x: (F.length(x) >= low) & (F.length(x) <= 4 * high))
        names = F.filter(F.transform(near, lambda x: F.get(F.transform(F.array(F.sha2(canonical(x, False), 256)), lambda d: table[d]), F.lit(0))), lambda x: x.isNotNull())
        rows = docs.select(F.col(doc_id).alias("doc_id"), digest, F.coalesce(names, F.array().cast("array<string>")).alias("names"))
    found = rows.join(known, "digest", "left")
    return found.select("doc_id", "digest", "license", F.size("names").cast("long").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("names")), ",").alias("notice_licenses"))


def query(spark, sf_dir):
    return scan(common.table(spark, sf_dir, "documents").select("doc_id", "text"))


def _sql_canonical(text: str, lines_out: bool) -> str:
    low = f"lower({text})"
    if lines_out:
        low = f"regexp_replace(regexp_replace({low}, '{COPYRIGHT_LINE}', ' ', 'g'), '{RESERVED_LINE}', ' ', 'g')"
    out = f"' ' || regexp_replace({low}, '{NOT_TEXT}', '  ', 'g') || ' '"
    for old, new in SPELLINGS:
        out = f"replace({out}, ' {old.replace(' ', '  ')} ', ' {new.replace(' ', '  ')} ')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def _sql_values(entries: dict[str, str]) -> str:
    return ", ".join(f"('{d}', '{n}')" for d, n in entries.items())


def sql() -> str:
    low, high = _lengths(NOTICES, False)
    return f"""
WITH known(digest, license) AS (VALUES {_sql_values(digests(LICENSES))}),
notice(d, name) AS (VALUES {_sql_values(digests(NOTICES, False))}),
docs AS (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents),
whole AS (SELECT row_id, doc_id, {_sql_canonical('text', True)} AS c FROM docs),
line AS (SELECT row_id, unnest(string_split(text, chr(10))) AS l FROM docs WHERE text IS NOT NULL),
hit AS (
  SELECT row_id, name FROM (SELECT row_id, sha256({_sql_canonical('l', False)}) AS d FROM line WHERE length(l) >= {low} AND length(l) <= {4 * high}) JOIN notice USING (d)
),
per AS (SELECT row_id, count(*) AS n, string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM hit GROUP BY row_id),
dig AS (SELECT row_id, doc_id, CASE WHEN c <> '' THEN sha256(c) END AS digest FROM whole)
SELECT doc_id, digest, license, coalesce(n, 0)::BIGINT AS n_notices, coalesce(names, '') AS notice_licenses
FROM dig LEFT JOIN known USING (digest) LEFT JOIN per USING (row_id)
"""


SQL = sql()
