"""License scans by canonical digests.

A text is put into a canonical form: lower case, without copyright lines, punctuation and spacing made
equal, equivalent spellings made one.  Its SHA-256 is then looked up, by a hash join, among the digests
of the known licence texts in the same form.  Two kinds of texts are looked up: a document as a whole,
and each of its lines, as most documents carry a licence as one statement.  A match is a match of an
entire text, never of a part.

The known texts are a parameter; ``KNOWN`` has short public licences and the usual one-line statements.

Defined cases: null text counts as empty and matches nothing; a document with several licences lists each
once, in order; repeated rows get a row each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Texts of licences and of the statements that name them.
KNOWN: dict[str, Sequence[str]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    "ISC": (
        "Licensed under the ISC License.",
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ),
    "0BSD": (
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Licensed under the GPLv3 license.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC0-1.0": ("Licensed under CC0 1.0.", "Released under the CC0 1.0 license."),
}

# Spellings that count as one, applied in this order to the spaced form.
SPELLINGS: tuple[tuple[str, str], ...] = (
    (" licence ", " license "),
    (" licences ", " licenses "),
    (" licenced ", " licensed "),
    (" sub license ", " sublicense "),
    (" sublicence ", " sublicense "),
    (" non commercial ", " noncommercial "),
    (" share alike ", " sharealike "),
    (" non infringement ", " noninfringement "),
    (" organisation ", " organization "),
    (" favour ", " favor "),
    (" and or ", " or "),
    (" https ", " http "),
    (" gpl v3 ", " gplv3 "),
)

_COMMON = re.compile("(?i)licen[cs]e|permission")
_COPYRIGHT = "(^|\\n)[ \\t*#/;]*(copyright[^\\n]*([0-9]{4}|\\(c\\)|©)|\\(c\\)|©)[^\\n]*"


def canonical(text: Column) -> Column:
    """The form in which texts are compared; blanks at both ends keep whole words apart in the replacements."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _COPYRIGHT, "\n")
    out = F.concat(F.lit(" "), F.regexp_replace(out, "[^\\p{L}\\p{N}]+", " "), F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.trim(out)


def known_digests(spark, known: Mapping[str, Sequence[str]] = KNOWN) -> DataFrame:
    """One row per known text: digest and license; as small as the list given."""
    texts = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(t).alias("text")) for k, ts in known.items() for t in ts])
    rows = spark.range(1).select(F.explode(texts).alias("x")).select("x.license", F.sha2(canonical(F.col("x.text")), 256).alias("digest"))
    return rows.groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", known: Mapping[str, Sequence[str]] = KNOWN) -> DataFrame:
    """Per row: ``text_digest`` and ``license`` of the whole text (null: unknown), ``statements`` (licences of lines, by comma).

    A line can only match a known text, so where all known texts share a word, lines without it are not digested.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(value, "\n")
    if all(_COMMON.search(t) for ts in known.values() for t in ts):
        lines = F.filter(lines, lambda line: line.rlike(_COMMON.pattern))
    units = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("_row"), F.concat(F.array(value), lines).alias("_units"))
    units = units.select("doc_id", "_row", F.posexplode("_units").alias("_at", "_unit"))
    units = units.select("doc_id", "_row", "_at", F.sha2(canonical(F.col("_unit")), 256).alias("digest"))
    found = units.join(F.broadcast(known_digests(docs.sparkSession, known)), "digest", "left")
    whole = F.col("_at") == 0
    return found.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max(F.when(whole, F.col("digest"))).alias("text_digest"),
        F.max(F.when(whole, F.col("license"))).alias("license"),
        F.array_join(F.sort_array(F.collect_set(F.when(~whole, F.col("license")))), ",").alias("statements"),
    ).drop("_row")
