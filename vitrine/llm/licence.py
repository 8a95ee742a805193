"""License scan by canonical digest lookup, in DataFrame and SQL functions only.

A text is normalised (case, copyright lines, punctuation, equivalent spellings) and digested; whole texts, and every
line that may be a notice, are hash-joined to the digests of known licences.  The rules are written once as Spark
columns and once as SQL text for the oracle, which still deletes every line that starts with "copyright".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that count as equal, the first as the second.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "behaviour": "behavior", "cancelled": "canceled", "catalogue": "catalog", "centre": "center",
    "colour": "color", "customise": "customize", "favour": "favor", "fulfil": "fulfill", "fulfilment": "fulfillment",
    "honour": "honor", "initialise": "initialize", "judgement": "judgment", "labelled": "labeled", "licence": "license",
    "licenced": "licensed", "licences": "licenses", "maximise": "maximize", "merchantibility": "merchantability",
    "noncommercial": "non commercial", "optimise": "optimize", "organisation": "organization", "owner": "holder", "owners": "holders",
    "practise": "practice", "programme": "program", "recognise": "recognize", "sublicence": "sublicense", "utilisation": "utilization",
    "utilise": "utilize", "whilst": "while", "wilful": "willful",
}

_PERMIT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = '''THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'''
_BSD_START = '''Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.'''
_BSD_THIRD = '''
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.'''
_BSD_END = '''
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'''
_MIT = '''Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'''

#: Whole licence texts (without copyright lines).
LICENCES = [
    ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT), ("MIT", _MIT),
    ("ISC", "ISC License\n" + _PERMIT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_END),
    ("ISC", _PERMIT + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_END),
    ("0BSD", "BSD Zero Clause License\n" + _PERMIT + ".\n" + _ISC_END), ("0BSD", _PERMIT + ".\n" + _ISC_END),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_START + _BSD_END), ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_START + _BSD_THIRD + _BSD_END), ("BSD-3-Clause", _BSD_START + _BSD_THIRD + _BSD_END),
]
#: One-line notices.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
]
#: Every notice holds this word in one of its spellings, so a line without it needs no digest.
NOTICE_WORD = "licen"

#: Words after "copyright" that go on with a sentence, which may be wrapped there, and are no holder's name.
_SENTENCE = (r"(?:notices?|holders?|owners?|licen[sc]es?|laws?|acts?|statements?|disclaimers?|interests?|protection|infringements?|treat(?:y|ies)"
             r"|rights?|and|or|in|of|on|is|are|to|for|as|that|which|with|under|applies|may|shall|must|will|can)\b")
_COPYRIGHT = (r"\n[^a-z0-9\n(©]*(?:copyright(?=[^a-z\n]*(?:\(c\)|©|[0-9]{4}))|copyright\b(?=[^\n]*\w)(?![^a-z0-9\n]*" + _SENTENCE
              + r")|\(c\)(?=[^a-z\n]*[0-9]{4}|[ \t]*copyright)|©)[^\n]*")
#: The oracle's rule, as it was.
_SQL_COPYRIGHT = r"\n[^a-z0-9\n(©]*(?:copyright|\(c\)|©)[^\n]*"
_RESERVED = r"\n[^a-z0-9\n]*all rights reserved[^\n]*"
_OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Normalised text: words apart by two spaces, so that each has its own borders for the spellings."""
    t = F.concat(F.lit("\n"), F.lower(text))
    t = F.regexp_replace(F.regexp_replace(t, _COPYRIGHT, ""), _RESERVED, "")
    t = F.regexp_replace(F.concat(F.lit(" "), t, F.lit(" ")), _OTHER, "  ")
    for written, counted in SPELLINGS.items():
        t = F.replace(t, F.lit(f" {written} "), F.lit(f" {counted} "))
    return F.trim(t)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def _known(spark: SparkSession, rows: list[tuple[str, str]], name: str) -> DataFrame:
    """(name, digest) of known texts: a table bounded by the lists above."""
    listed = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(t).alias("t")) for i, t in rows])
    return spark.range(1).select(F.explode(listed).alias("k")).select(
        F.col("k.id").alias(name), digest(F.col("k.t")).alias("digest")).groupBy("digest").agg(F.min(name).alias(name))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest, license_id, notices, n_notice_lines: one row per row of ``docs``.

    digest: of the whole normalised text (null for a null text); license_id: the known licence that the whole text is,
    else null; notices: licences named by whole lines, sorted and joined by commas (empty: none), and how many lines
    name one.  Rows with one doc_id share their notices and lines; a row without an id has none.  Other columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    whole = rows.select("doc_id", digest(F.col("text")).alias("digest")).join(
        F.broadcast(_known(spark, LICENCES, "license_id")), "digest", "left")
    likely = F.filter(F.split(F.lower("text"), "\n"), lambda line: F.contains(line, F.lit(NOTICE_WORD)))
    lines = rows.where(F.col("doc_id").isNotNull()).select("doc_id", F.explode(likely).alias("line"))
    named = lines.select("doc_id", digest(F.col("line")).alias("digest")).join(F.broadcast(_known(spark, NOTICES, "notice")), "digest")
    notices = named.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("notice")), ",").alias("notices"),
                                          F.count("*").alias("n_notice_lines"))
    return whole.join(notices, "doc_id", "left").select(
        "doc_id", "digest", "license_id", F.coalesce("notices", F.lit("")).alias("notices"),
        F.coalesce("n_notice_lines", F.lit(0)).cast("long").alias("n_notice_lines"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_digest(expression: str) -> str:
    t = f"regexp_replace(regexp_replace(chr(10) || lower({expression}), '{_SQL_COPYRIGHT}', '', 'g'), '{_RESERVED}', '', 'g')"
    t = f"regexp_replace(' ' || {t} || ' ', '{_OTHER}', '  ', 'g')"
    for written, counted in SPELLINGS.items():
        t = f"replace({t}, ' {written} ', ' {counted} ')"
    return f"sha256(trim({t}))"


def scan_sql(table: str = "documents") -> str:
    """DuckDB SQL for the rows of ``scan`` over ``table``."""
    def known(rows, name):
        values = ", ".join(f"({_sql_text(i)}, {_sql_text(t)})" for i, t in rows)
        return f"SELECT digest, min(id) AS {name} FROM (SELECT id, {_sql_digest('t')} AS digest FROM (VALUES {values}) v(id, t)) GROUP BY digest"

    return f"""
WITH whole_known AS ({known(LICENCES, 'license_id')}), line_known AS ({known(NOTICES, 'notice')}),
lines AS (SELECT doc_id, unnest(string_split(lower(text), chr(10))) AS line FROM {table} WHERE doc_id IS NOT NULL),
named AS (SELECT l.doc_id, k.notice FROM (SELECT doc_id, {_sql_digest('line')} AS digest FROM lines WHERE contains(line, '{NOTICE_WORD}')) l
  JOIN line_known k ON k.digest = l.digest),
notices AS (SELECT doc_id, string_agg(DISTINCT notice, ',' ORDER BY notice) AS notices, count(*) AS n_notice_lines FROM named GROUP BY doc_id)
SELECT d.doc_id, d.digest, w.license_id, coalesce(n.notices, '') AS notices, coalesce(n.n_notice_lines, 0) AS n_notice_lines
FROM (SELECT doc_id, {_sql_digest('text')} AS digest FROM {table}) d
LEFT JOIN whole_known w ON w.digest = d.digest LEFT JOIN notices n ON n.doc_id = d.doc_id"""
