"""Licence scan by canonical digests (native).

A text's canonical form is lower case, without copyright lines, with every run of other than
letters and digits as one blank, and with equivalent spellings made equal.  Its SHA-256 is
hash-joined to the digests of known licence texts: a document is a licence when its entire
text is.  In the same way each line that speaks of a licence is looked up among the digests of
known one-line notices.

The registry is a parameter, a dict or a table (name, text), canonicalised and hashed in Spark;
only its digests reach the driver, and its side of the join is broadcast.  The default holds the
short texts below, the full texts in ``license_texts`` and, as notices, SPDX identifiers and
sentences that begin by ``OPENING`` and go on with one of ``NAMED`` or a Creative Commons name.

Defined results: NULL text counts as empty; the empty canonical form matches nothing; NULL ids
and repeated rows are scanned like any other; if two registry texts share a canonical form the
first name in order counts; an empty registry or table gives no matches or no rows.
"""

from __future__ import annotations

from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetmill.llm.common import quoted, text_of

#: Lines that only state who holds the copyright (tested on lower case), and the beginnings of
#: wrapped lines of a licence's own sentences, which stay wherever the text is wrapped.
COPYRIGHT = r"^[\s*#/;-]*(copyright|\(c\)|©|all rights reserved)"
SENTENCE = r"^[\s*#/;-]*copyright (and|disclaimer|holder|interest|law|licen[cs]e|notice|owner|statement)"
#: Equivalent spellings, applied in this order to the blank-separated form.
SPELLINGS = (("licence", "license"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("organis", "organiz"), ("authoris", "authoriz"), ("whilst", "while"))

# Licence texts as published.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

#: Entire licence texts by name.
LICENSES: dict[str, tuple[str, ...]] = {
    "MIT": (_MIT, "MIT License\n\n" + _MIT, "The MIT License\n\n" + _MIT, "The MIT License (MIT)\n\n" + _MIT),
    "ISC": (_ISC, "ISC License\n\n" + _ISC),
    "BSD-2-Clause": (_BSD_HEAD + _BSD_TAIL, "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    "BSD-3-Clause": (_BSD_HEAD + _BSD_NAMES + _BSD_TAIL, "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
    "Zlib": (_ZLIB, "zlib License\n\n" + _ZLIB),
}
#: One-line notices by name; each speaks of a licence.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.",),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License."),
}


#: Names by which sentences speak of a licence.
NAMED: dict[str, tuple[str, ...]] = {
    "0BSD": ("BSD Zero Clause License",),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPL v3", "AGPLv3 License", "AGPL-3.0 License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"),
    "Artistic-2.0": ("Artistic License 2.0",),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal License", "Creative Commons CC0 1.0 Universal License", "Creative Commons Zero v1.0 Universal License"),
    "EPL-1.0": ("Eclipse Public License, Version 1.0", "Eclipse Public License 1.0", "Eclipse Public License v1.0"),
    "EPL-2.0": ("Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0"),
    "EUPL-1.2": ("European Union Public Licence, Version 1.2", "European Union Public Licence v1.2", "EUPL 1.2"),
    "GFDL-1.2": ("GNU Free Documentation License, Version 1.2",),
    "GFDL-1.3": ("GNU Free Documentation License, Version 1.3",),
    "GPL-1.0": ("GNU General Public License, version 1",),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2 License", "GPL-2.0 License"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3 License", "GPL-3.0 License"),
    "ISC": ("ISC License",),
    "LGPL-2.0": ("GNU Library General Public License, version 2",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL v2.1", "LGPL-2.1 License"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "GNU LGPL v3", "LGPLv3 License", "LGPL-3.0 License"),
    "MIT": ("MIT License", "MIT license (MIT)", "Expat License"),
    "MPL-1.1": ("Mozilla Public License, Version 1.1", "Mozilla Public License 1.1"),
    "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "Unlicense": ("Unlicense",),
    "WTFPL": ("WTFPL License",),
    "Zlib": ("zlib License",),
}
#: How a sentence begins that names its licence next, and how it may end (canonical form).
OPENING = r"^(?:(?:(?:this|the|all) (?:work|software|project|program|file|code|source code|document|text|content|package|library|repository) |content )(?:is |are )?)?(?:dual )?(?:licensed|released|distributed|published|available|provided|covered) (?:to you )?under (?:the terms of )?(?:the |a |an )?"
ENDING = r"(?: or(?: at your option)?(?: any)? later(?: version)?| only)$"


def _commons() -> dict[str, tuple[str, ...]]:
    """Names of the Creative Commons licences."""
    parts = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
    out = {}
    for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
        full = "-".join(parts[x] for x in kind.split("-"))
        for version, scope in (("1.0", "Generic"), ("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
            short = (f"CC {kind} {version}", f"Creative Commons {full} {version}", f"Creative Commons {full} {version} {scope}")
            out[f"CC-{kind}-{version}"] = tuple(f"{n}{end}" for n in short for end in ("", " License"))
    return out


@cache
def default_licenses() -> dict[str, tuple[str, ...]]:
    """``LICENSES`` and the texts of the folder ``license_texts``."""
    out = dict(LICENSES)
    for path in sorted(Path(__file__).with_name("license_texts").glob("*.txt")):
        out[path.stem] = (*out.get(path.stem, ()), path.read_text(encoding="utf-8"))
    return out


@cache
def default_notices() -> dict[str, tuple[str, ...]]:
    """``NOTICES``, and the SPDX line of every known licence.  "Only" and "or later" go by the
    licence's version."""
    out = {name: list(lines) for name, lines in NOTICES.items()}
    for name in sorted({*NAMED, *_commons(), *default_licenses()}):
        out.setdefault(name, []).extend(f"SPDX-License-Identifier: {name}{end}" for end in ("", "-only", "-or-later"))
    out["MPL-2.0"].append("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.")
    return {name: tuple(lines) for name, lines in out.items()}


def canonical(text: Column) -> Column:
    lines = F.filter(F.split(F.lower(text), "\n"), lambda line: ~line.rlike(COPYRIGHT) | line.rlike(SENTENCE))
    plain = F.trim(F.regexp_replace(F.array_join(lines, "\n"), r"[^\p{L}\p{N}]+", " "))
    for variant, usual in SPELLINGS:
        plain = F.replace(plain, F.lit(variant), F.lit(usual))
    return plain


def registry(spark, texts: dict[str, tuple[str, ...]] | DataFrame) -> DataFrame:
    """(digest, name) of each canonical form; the canonical forms come from the same expressions
    as the documents'."""
    if isinstance(texts, dict):
        flat = [(name, text) for name, variants in sorted(texts.items()) for text in variants]
        names = pa.array([n for n, _ in flat], pa.string()), pa.array([t for _, t in flat], pa.string())
        texts = spark.createDataFrame(pa.table(names, names=["name", "text"]))
    rows = texts.select("name", canonical(F.col("text")).alias("c")).filter("c <> ''")
    return rows.select(F.sha2("c", 256).alias("digest"), "name").groupBy("digest").agg(F.min("name").alias("name"))


Texts = dict[str, tuple[str, ...]] | DataFrame


def _digest_map(spark, texts: dict[str, tuple[str, ...]]) -> Column:
    """Literal map from digest to name, of a fixed list of texts."""
    rows = registry(spark, texts).orderBy("digest").collect()
    return F.str_to_map(F.lit("\x02".join(f"{r['digest']}\x01{r['name']}" for r in rows)), F.lit("\x02"), F.lit("\x01")) if rows else F.create_map().cast("map<string,string>")


def _title(line: Column) -> Column:
    """Digest of what follows an opening in a canonical line (NULL without one)."""
    return F.when(line.rlike(OPENING), F.sha2(F.regexp_replace(F.regexp_replace(line, OPENING, ""), ENDING, ""), 256))


def _joined_notices(df: DataFrame, lines: DataFrame, titles: DataFrame) -> DataFrame:
    """``df`` with the names found on its lines, by joins with registries of any size: one row
    per line, two joins by digest, and the lines of a row gathered again."""
    rows = df.withColumn("rid", F.monotonically_increasing_id())
    spread = rows.select("rid", "doc_id", "digest", "license", F.explode_outer("about").alias("line"))
    # rows without a line, and lines without an opening, get keys of their own that match nothing: no hot NULL key
    spread = spread.select("rid", "doc_id", "digest", "license", F.coalesce(F.sha2("line", 256), F.concat(F.lit("-"), F.col("rid"))).alias("at_line"), _title(F.col("line")).alias("title"))
    spread = spread.select("rid", "doc_id", "digest", "license", "at_line", F.coalesce("title", F.concat(F.lit("-"), F.col("at_line"))).alias("at_title"))
    found = spread.join(lines.select(F.col("digest").alias("at_line"), F.col("name").alias("by_line")), "at_line", "left")
    found = found.join(titles.select(F.col("digest").alias("at_title"), F.col("name").alias("by_title")), "at_title", "left")
    names = F.collect_set(F.coalesce("by_line", "by_title"))  # at most the names on a row's lines
    first = lambda c: F.first(c, ignorenulls=True).alias(c)
    return found.groupBy("rid").agg(first("doc_id"), first("digest"), first("license"), names.alias("found"))


def scan_licenses(docs: DataFrame, licenses: Texts | None = None, notices: Texts | None = None, named: Texts | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, license, notices): the digest of the canonical form, the licence that
    the entire text is (NULL if none), and the notices on its lines (sorted, comma-joined).
    Registries are dicts or tables (name, text): entire licences, entire lines, and what follows
    ``OPENING`` in a line; by default the known ones (no names beside other notices).  Dicts are
    fixed lists and travel as literals or by broadcast; tables may be of any size and are joined
    by digest, without a hint, in tasks."""
    spark = docs.sparkSession
    known = registry(spark, default_licenses() if licenses is None else licenses).select(F.col("digest").alias("known"), F.col("name").alias("license"))
    if not isinstance(licenses, DataFrame):
        known = F.broadcast(known)  # as many rows as the list has texts
    named = named if named is not None else {**NAMED, **_commons()} if notices is None else {}
    notices = default_notices() if notices is None else notices
    t = text_of(text_col)
    about = F.filter(F.split(t, "\n"), lambda line: line.rlike("(?i)licen[sc]e"))
    df = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.sha2(canonical(t), 256).alias("digest"), F.array_distinct(F.transform(about, canonical)).alias("about"))
    df = df.join(known, F.col("digest") == F.col("known"), "left")
    if isinstance(notices, DataFrame) or isinstance(named, DataFrame):
        df = _joined_notices(df, registry(spark, notices), registry(spark, named))
    else:
        lines, titles = _digest_map(spark, notices), _digest_map(spark, named)
        looked_up = lambda c: F.coalesce(F.element_at(lines, F.sha2(c, 256)), F.element_at(titles, _title(c)))
        df = df.select("doc_id", "digest", "license", F.filter(F.transform("about", looked_up), lambda n: n.isNotNull()).alias("found"))
    return df.select("doc_id", "digest", "license", F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notices"))


def license_sql() -> str:
    """DuckDB SQL of the scan with the registries ``LICENSES`` and ``NOTICES``."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def canon(column: str) -> str:
        lines = f"array_to_string([x FOR x IN string_split(lower({column}), chr(10)) IF NOT regexp_matches(x, {quote(COPYRIGHT)}) OR regexp_matches(x, {quote(SENTENCE)})], chr(10))"
        out = f"trim(regexp_replace({lines}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
        for variant, usual in SPELLINGS:
            out = f"replace({out}, {quote(variant)}, {quote(usual)})"
        return out

    def known(texts: dict[str, tuple[str, ...]]) -> str:
        rows = ", ".join(f"({quote(name)}, {quote(text)})" for name, variants in texts.items() for text in variants)
        return f"SELECT sha256(c) AS digest, min(name) AS name FROM (SELECT name, {canon('text')} AS c FROM (VALUES {rows}) v(name, text)) WHERE c <> '' GROUP BY 1"

    return f"""WITH licenses AS ({known(LICENSES)}), notices AS ({known(NOTICES)}),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
n AS (SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS notices FROM (SELECT doc_id, sha256({canon('line')}) AS digest FROM l WHERE regexp_matches(line, '(?i)licen[sc]e')) JOIN notices USING (digest) GROUP BY doc_id)
SELECT d.doc_id, sha256({canon('t')}) AS digest, name AS license, coalesce(n.notices, '') AS notices
FROM d LEFT JOIN licenses ON licenses.digest = sha256({canon('t')}) LEFT JOIN n ON n.doc_id = d.doc_id"""
