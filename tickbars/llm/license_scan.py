"""License scan by canonical digest look-up; built-in functions only.

A text is put into canonical form: lower case, http and https alike, equivalent
spellings as one, copyright lines and white space and punctuation gone.  The
SHA-256 digest of what is left is hash-joined to the digests of known licence
texts.  Two kinds of units are looked up: the entire text, and every line
of it, since a document usually states its licence on a line of its own.

The known table is small and fixed (it is given, not gathered from the corpus),
so Spark may broadcast it; the join is an equi-join on the digest either way.

Defined results: a null or empty text has no licence; a unit that is empty in
canonical form (only copyright lines, say) matches nothing; repeated rows are
reported row by row; an empty table gives no rows; only the id and text columns
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings (fixed values): each word on the left is read as the one
# on the right.
SPELLINGS = {
    "licence": "license", "licenced": "licensed", "licences": "licenses", "sublicence": "sublicense",
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact",
    "authorisation": "authorization", "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled",
    "catalogue": "catalog", "centre": "center", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite",
    "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment",
    "labelling": "labeling", "labour": "labor", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling",
    "offence": "offense", "optimise": "optimize", "organisation": "organization", "organise": "organize",
    "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize",
    "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful",
    "noncommercial": "non-commercial", "sub-license": "sublicense", "per cent": "percent",
    "copyright owner": "copyright holder",
}

# Known licence texts and notices (fixed values).
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT License.",
        "This work is licensed under the MIT License.", "This project is licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies "
        'or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "GPL-2.0": [
        "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "BSD-2-Clause": [
        "Licensed under the BSD 2-Clause License.", "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "ISC": [
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
        "ISC License Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        'copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0.",
                  "SPDX-License-Identifier: CC-BY-4.0",
                  "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0.",
                     "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.",
                     "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC0-1.0": ["Released under CC0 1.0.", "Licensed under CC0 1.0.", "SPDX-License-Identifier: CC0-1.0"],
    "Unlicense": ["SPDX-License-Identifier: Unlicense", "Released under the Unlicense."],
}

#: A copyright line: it starts with the word or the sign and runs to the line's end.
COPYRIGHT_LINE = (r"^[^\p{L}\p{N}\n]*(?:copyright[ \t]+(?:\(c\)|©|[0-9]{4}|by[ \t])|\(c\)[ \t]*[0-9]{4}|©)"
                  r"[^\n]*$")
#: Everything that is neither letter nor digit becomes two spaces, so that every
#: word has a space of its own on both sides and plain replacement sees words.
NOT_WORD = r"[^\p{L}\p{N}]+"
DROPPED = ["all rights reserved"]


def _wide(words: str) -> str:
    return " " + words.replace("-", " ").replace(" ", "  ") + " "


def replacements() -> list[tuple[str, str]]:
    """(from, to) in canonical spacing, in the order they are applied."""
    return [(_wide(w), "") for w in DROPPED] + [(_wide(a), _wide(b)) for a, b in SPELLINGS.items()]


def without_copyright_lines(text: Column) -> Column:
    """A text without its copyright lines; most texts are only looked through."""
    marked = text.rlike(r"(?i)copyright|©|\(c\)")
    return F.when(marked, F.regexp_replace(text, "(?imd)" + COPYRIGHT_LINE, " ")).otherwise(text)


def first_word(text: Column) -> Column:
    return F.lower(F.regexp_extract(text, r"[\p{L}\p{N}]+", 0))


def with_digest(df: DataFrame, unit: str) -> DataFrame:
    """``df`` with ``digest`` of the canonical form of a string column without
    copyright lines (empty for a null text and when nothing is left, which no
    licence text is).  Each step is a column of its own, so no step is evaluated
    twice."""
    x = F.col("__x")
    y = F.concat(F.lit("  "), F.regexp_replace(F.replace(F.lower(unit), F.lit("https://"), F.lit("http://")), NOT_WORD, "  "),
                 F.lit("  "))
    for old, new in replacements():
        y = F.replace(y, F.lit(old), F.lit(new))
    df = df.withColumn("__x", F.trim(y))
    # never null: a join would push "is not null" down and evaluate every step again
    return df.withColumn("digest", F.coalesce(F.when(x != "", F.sha2(x, 256)), F.lit(""))).drop("__x")


def opening_words(notices: dict[str, list[str]]) -> list[str]:
    """Words that a text may open with to be canonically one of the notices: the
    notices' own, and those that a spelling or a dropped phrase puts before them."""
    import re

    first = lambda t: re.findall(r"[^\W_]+", t.lower())[0]
    same: dict[str, set[str]] = {}
    for a, b in SPELLINGS.items():
        same.setdefault(first(b), set()).add(first(a))
        same.setdefault(first(a), set()).add(first(b))
    words = {first(t) for texts in notices.values() for t in texts}
    return sorted(words | {x for w in words for x in same.get(w, ())} | {first(w) for w in DROPPED})


def known_digests(spark: SparkSession, notices: dict[str, list[str]] = NOTICES) -> DataFrame:
    """(digest, license) of the known texts, made by the same steps."""
    rows = [(name, text) for name, texts in notices.items() for text in texts]
    return with_digest(spark.createDataFrame(rows, "license string, text string").withColumn(
        "text", without_copyright_lines(F.col("text"))), "text").select("digest", "license").distinct()


def license_scan(docs: DataFrame, notices: dict[str, list[str]] = NOTICES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, license, whole_text, n_lines) of the rows whose entire text, or a
    line of it, is a known licence text: one row per licence found, with the
    number of lines that state it.

    Equal canonical forms open with the same word, so only units that open with
    a notice's word are put into canonical form and digested."""
    units = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                        F.col(text_col).alias("text"))
    whole = F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("unit")))
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("unit")))
    units = units.filter(F.col("text").isNotNull()).select("rid", "doc_id", F.explode(F.concat(whole, lines)).alias("u"))
    units = units.select("rid", "doc_id", "u.whole", without_copyright_lines(F.col("u.unit")).alias("unit")) \
        .filter(first_word(F.col("unit")).isin(*opening_words(notices)))
    known = known_digests(docs.sparkSession, notices)  # as many rows as notices
    found = with_digest(units, "unit").drop("unit").join(F.broadcast(known), "digest")
    return found.groupBy("rid", "doc_id", "license").agg(
        F.bool_or("whole").alias("whole_text"), F.sum((~F.col("whole")).cast("long")).alias("n_lines")).drop("rid")
