"""Licence scan: canonical digests of whole texts and lines, hash-joined to known licences.

Canonical form: A-Z in lower case, copyright statements dropped, everything but a-z and 0-9 one
space, equivalent spellings unified, titles and list marks of known licences dropped.  Two texts
with one form have one SHA-256 digest.  A document is looked up as a whole and line by line (a
notice is one line).

A copyright statement is a line that begins with one.  One that stands inside a line, as where a
whole licence is one line, counts from ``copyright`` with a year on, up to the words with which a
licence begins.  A statement without a year inside a line is not seen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = "[^a-z0-9]+"


def _phrase(text: str) -> str:
    return text.replace(" ", _GAP)


#: Only texts with one of these can hold a copyright statement.
STATEMENT_WORDS = ("copyright", "(c)", "\u00a9", "all rights reserved")
#: Replacements on the lower-cased text, in order; \\1 is the first group.
STATEMENTS = (
    # wording of licences, which may begin a line wherever a text is wrapped
    (_phrase("copyright( (?:holders?|owners?|notices?|laws?|licenses?|licences?|interests?|ownership|disclaimers?|statements?"
             "|rights?|treaty|protection|infringement|resulting|or|and|to|of|in|on|is|as|the software|the program|the library)"
             "(?:[^a-z0-9]|$))"), r"copyrighted\1"),
    # a statement inside a line, and a licence that begins behind it
    (r"(copyright[^a-z0-9\n]*(?:c\)[^a-z0-9\n]*)?[0-9]{4})", "\n\\1"),
    ("(" + _phrase("permission is hereby granted|permission to use copy|redistribution and use in|this software is provided"
                   "|this is free and unencumbered")
     + ")", "\n\\1"),
    ("(^|\n)[^a-z0-9\n]*(?:copyright[^a-z\n]|\\(c\\)[^a-z0-9\n]*(?:[0-9]{4}|copyright)|\u00a9[^a-z0-9\n]*[0-9]{4}|all rights reserved)[^\n]*",
     "\\1"),
)
#: On the form: titles before a whole text, and marks of list items.
HEADS_AND_MARKS = (
    (r"^(?:the )?(?:mit license(?: mit)?|isc license(?: isc)?|(?:bsd zero clause|zero clause bsd) license(?: 0bsd)?|0bsd license"
     r"|(?:bsd 2 clause|2 clause bsd)(?: simplified)? license|(?:bsd 3 clause|3 clause bsd)(?: new or revised| new| revised)? license"
     r"|bsd license|zlib license|unlicense|boost software license version 1 0(?: august 17th 2003)?)"
     r" (permission |redistribution |this )", r"\1"),
    (r" (?:[1-4]|[a-d]|i{1,3}|iv) (redistributions |neither the name |the origin of this |altered source versions |this notice may not )",
     r" \1"),
)

#: Equivalent spellings, on the form with single spaces, whole words.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"),
    ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
    ("favour", "favor"), ("organisation", "organization"), ("https", "http"), ("acknowledgement", "acknowledgment"),
)

#: Licence notices, one line each.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

#: Short whole licences.
TEXTS = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""),
    ("BSL-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the
Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works
of the Software, unless such copies or derivative works are solely in the form of machine-executable object code
generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
)

#: Canonical digests of longer public licences, whole and, where they have that line, up to and with
#: ``END OF TERMS AND CONDITIONS`` (``tests/llm`` computes them anew from the texts where a system has them).
DIGESTS: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "6931249bc38d9a534ff59e9647c43372694548a8770deb2e239c2b2cba198344"),
    ("Apache-2.0", "6285d8f41f523c1e9173e3c97717e49b14ea32ea08984a4c20a9af549d19fa1b"),
    ("Artistic-1.0-Perl", "3f8291c7a7fe693c6f17eb0997a2bbf2e6b25df6a279aa5822548775ee2ce7c2"),
    ("CC0-1.0", "3838a960276d9d86993ef414b795e3f3f8da6afda6f0b4fc28131bd79dc00b56"),
    ("GFDL-1.2", "a72c539f69b9adb42759d38afed39c0a202b98c7e406260613facddfbec9b018"),
    ("GFDL-1.3", "e5e025691285891013971d4f40d041eaecb5464c4da160d09d9ec5036bda39bc"),
    ("GPL-1.0", "ebfd59936e6946081a0a5e0cb513d318c5eaf1c0958d1da9df84cbf92e134636"),
    ("GPL-1.0", "d7cec04f8c73ef8f84ded8a9192498e0e24f592f652057bf37fce81ab2b3fa23"),
    ("GPL-2.0", "515865d32db18b643520de746a2aa0800b442f388fa3bff56dc5eac22c8f1436"),
    ("GPL-2.0", "b3f568f2f1e2b3c912b96f07360948b6d9383ee4e42e58481c175a173ea74352"),
    ("GPL-3.0", "9251b8080f75a3d31c8d9b6a1450b1700deebf38f6d85d6b60a140738c47807c"),
    ("GPL-3.0", "9e07d7153b4ecc7016b2c7acff09cca9ca0c6de02b101afbf59a7b5e05899765"),
    ("LGPL-2.0", "5264189e15d1028792fe11d9d1689284ea9bc5ed8ab17034ea1da9835f73e158"),
    ("LGPL-2.0", "e9bb00741f9f819676d42203b9c3463f9dddc359c764a6fb135ff4d4ab8f181f"),
    ("LGPL-2.1", "96f4733856ba0da25a14f2b3463b9a766da9c19dbf885a6cdd89654673008064"),
    ("LGPL-2.1", "7429ad0fab62451a50eacf893fe57a74f160d3688623043a0508117775810613"),
    ("LGPL-3.0", "a6408a3285bb655e81134663fe274b8ac1ac31c053ac1308690709a1a34d1f5d"),
    ("MPL-1.1", "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6"),
    ("MPL-2.0", "50bf4ce73f10740526a8d80ede4df228720323feb3cd46fee96806129da4b811"),
)


def _has_any(column: str, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(F.col(column), F.lit(p)) for p in parts))


def _replaced(column: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda c, rule: F.regexp_replace(c, rule[0], rule[1].replace("\\1", "$1")), rules, column)


def _words(pairs: tuple[tuple[str, str], ...]) -> tuple[tuple[str, str], ...]:
    return tuple((f"\\b{word}\\b", same) for word, same in pairs)


def _spelled(column: str) -> Column:
    """One spelling for equivalent ones; texts without any of them are not searched by pattern."""
    return F.when(_has_any(column, tuple(w for w, _ in SPELLINGS)), _replaced(F.col(column), _words(SPELLINGS))).otherwise(F.col(column))


def with_forms(df: DataFrame, text: str) -> DataFrame:
    """Add ``_form``, the canonical form of ``text`` (null is empty), and ``_lines``, those of its lines.

    The text is brought to its form once, line breaks kept; lines and whole text derive from
    that.  The steps are projections of their own because each reads its input more than once.
    """
    names = df.columns
    df = df.withColumn("_low", F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER))
    stated = F.when(_has_any("_low", STATEMENT_WORDS), _replaced(F.col("_low"), STATEMENTS)).otherwise(F.col("_low"))
    df = df.withColumn("_plain", F.regexp_replace(stated, "[^a-z0-9\n]+", " "))
    df = df.withColumn("_plain", _spelled("_plain"))
    df = df.withColumn("_form", F.regexp_replace("_plain", "[ \n]+", " "))
    df = df.withColumn("_form", F.trim(_spelled("_form")))
    df = df.withColumn("_form", F.when(_has_any("_form", ("permission ", "redistribution ", "this ")), _replaced(F.col("_form"), HEADS_AND_MARKS))
                       .otherwise(F.col("_form")))
    return df.select(*names, "_form", F.transform(F.split("_plain", "\n"), lambda x: F.trim(x)).alias("_lines"))


def known_licenses(spark: SparkSession) -> DataFrame:
    """``license, text`` of the licences and notices above that are known by their texts."""
    return spark.createDataFrame([*NOTICES, *TEXTS], "license string, text string")


def known_digests(spark: SparkSession) -> DataFrame:
    """``digest, license`` of all licences and notices above."""
    longer = spark.createDataFrame([(digest, name) for name, digest in DIGESTS], "digest string, license string")
    return digests(known_licenses(spark)).union(longer)


def digests(known: DataFrame) -> DataFrame:
    """``digest, license``; of several names of one canonical text the first in order.

    Digest and length are aggregates, because a filter on a column of the form (also one that a join
    implies) would be pushed below the form's steps and copy all of them for each of their uses."""
    return (with_forms(known.select("license", "text"), "text").groupBy("_form")
            .agg(F.max(F.sha2("_form", 256)).alias("digest"), F.min("license").alias("license"), F.max(F.length("_form")).alias("_n"))
            .where("_n > 0").select("digest", "license"))


def scan_licenses(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``doc_id, whole_license, licenses, n_lines`` of every row of ``docs``.

    ``whole_license`` is the licence that the whole text is (null if none), ``licenses`` the
    licences of its matching lines (sorted, comma-joined; empty if none) and ``n_lines`` the number
    of their different canonical forms.  ``known`` has ``license`` and ``text``; nulls and texts with an empty form match nothing.  Null and empty
    documents match nothing; null ids and repeated rows are rows like others; an empty table
    gives no rows; other columns are not read.
    """
    table = known_digests(docs.sparkSession) if known is None else digests(known)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    forms = with_forms(rows, "text").select(
        "doc_id", F.xxhash64("text").alias("_text"),
        # never empty; the outer form has no filter on its array inferred and pushed below the steps
        F.posexplode_outer(F.concat(F.array("_form"), "_lines")).alias("_place", "_part"))
    whole = F.col("_place") == 0
    parts = (forms.where(whole | (F.col("_part") != ""))
             .select("doc_id", "_text", whole.alias("_is_whole"), F.sha2("_part", 256).alias("digest"))
             .join(table, "digest", "left").where(F.col("_is_whole") | F.col("license").isNotNull()))
    line = ~F.col("_is_whole")
    found = parts.groupBy("doc_id", "_text").agg(
        F.count_if(F.col("_is_whole")).alias("_rows"), F.min(F.when(F.col("_is_whole"), F.col("license"))).alias("whole_license"),
        F.array_join(F.array_sort(F.collect_set(F.when(line, F.col("license")))), ",").alias("licenses"),
        F.count_distinct(F.when(line, F.col("digest"))).alias("n_lines"))
    # a row for each that repeats the document
    return found.select("doc_id", "whole_license", "licenses", "n_lines", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))).alias("_row")).drop("_row")


def _replaced_sql(value: str, rules: tuple[tuple[str, str], ...]) -> str:
    for pattern, new in rules:
        value = f"regexp_replace({value}, '{pattern}', '{new}', 'g')"
    return value


def oracle_sql() -> str:
    """The same scan of ``documents``, rule for rule, in DuckDB SQL (ids must be unique)."""
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def forms(rows: str) -> str:
        """``plain`` and ``form`` of the ``text`` of ``rows``."""
        holds = " OR ".join(f"contains(low, {quoted(w)})" for w in STATEMENT_WORDS)
        plain = _replaced_sql(f"regexp_replace(CASE WHEN {holds} THEN {_replaced_sql('low', STATEMENTS)} ELSE low END, "
                              "'[^a-z0-9\n]+', ' ', 'g')", _words(SPELLINGS))
        form = _replaced_sql("regexp_replace(plain, '[ \n]+', ' ', 'g')", _words(SPELLINGS))
        return f"""SELECT *, {_replaced_sql(f"trim({form})", HEADS_AND_MARKS)} AS form
FROM (SELECT *, {plain} AS plain FROM (SELECT *, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS low FROM {rows}))"""

    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in (*NOTICES, *TEXTS))
    longer = ", ".join(f"({quoted(digest)}, {quoted(name)})" for name, digest in DIGESTS)
    return f"""
WITH known AS (SELECT sha256(form) AS digest, min(license) AS license FROM ({forms(f"(VALUES {values}) AS t(license, text)")})
               WHERE form <> '' GROUP BY 1 UNION ALL SELECT * FROM (VALUES {longer})),
docs AS MATERIALIZED (SELECT doc_id, plain, sha256(form) AS digest FROM ({forms("documents")})),
lines AS (SELECT doc_id, sha256(trim(line)) AS digest
          FROM (SELECT doc_id, unnest(string_split(plain, chr(10))) AS line FROM docs)),
found AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(DISTINCT digest) AS n_lines
          FROM lines JOIN known USING (digest) GROUP BY doc_id)
SELECT d.doc_id, k.license AS whole_license, coalesce(f.licenses, '') AS licenses, coalesce(f.n_lines, 0) AS n_lines
FROM docs d LEFT JOIN known k USING (digest) LEFT JOIN found f ON f.doc_id = d.doc_id
"""
