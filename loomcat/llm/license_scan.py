"""Licence scan by canonical digests. Native: DataFrame and SQL functions only.

A text is made canonical: lower case; copyright notices (lines that begin with copyright or (c), but not
with words that follow it within a known text, as in "copyright notice") and lines that only reserve all rights
go; hyphens and apostrophes go, other punctuation and white space become one space;
equivalent spellings become one. The SHA-256 of the whole canonical text is hash-joined to the digests of
the known licences. So is that of each line of a text, which finds licence notices that are a line of their own.
Only texts that hold one of the STEMS, of which each known text has one, are made canonical, and only texts and
lines with as many words as a known text are hashed; spellings replace word by word, so this loses nothing. The known digests are a table of fixed size, which is broadcast;
documents are not shuffled, only what was found.

Defined results: null and empty texts, and texts that are empty once canonical, match nothing.
A document that matches in both ways has a row for each, told apart by scope. Repeated ids are one document. Very long
texts are read whole. Columns other than id and text aren't looked at.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Equivalent spellings, word by word after punctuation went.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "calibre": "caliber", "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog", "categorise": "categorize", "centre": "center", "emphasised": "emphasized",
    "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor",
    "licence": "license", "licenced": "licensed", "licences": "licenses", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense", "optimise": "optimize",
    "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program", "programmes": "programs", "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "utilisation": "utilization", "whilst": "while", "wilful": "willful", "http": "https",
}

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n"
_BSD_1 = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
_BSD_2 = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
    "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
    "THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_BODY = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
    "furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n" + _AS_IS
)
_ISC_BODY = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_AS_IS
_ZERO_BODY = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _ISC_AS_IS
# Licence ids and their texts or notices.
LICENSES = [
    ("MIT", _MIT_BODY),
    ("MIT", "MIT License\n" + _MIT_BODY),
    ("MIT", "The MIT License (MIT)\n" + _MIT_BODY),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC_BODY),
    ("ISC", "ISC License\n" + _ISC_BODY),
    ("0BSD", _ZERO_BODY),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_1 + _BSD_2 + _BSD_AS_IS),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_1 + _BSD_2 + _BSD_AS_IS),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_1 + _BSD_2 + _BSD_3 + _BSD_AS_IS),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_1 + _BSD_2 + _BSD_3 + _BSD_AS_IS),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]

TEXTS = Path(__file__).with_name("license_texts")  # full texts, a file for each licence id
END = "END OF TERMS AND CONDITIONS"

RESERVED = r"(?m)^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"
JOINED = r"['’‘`\-‐‑–—]+"
OTHER = r"[^\p{L}\p{N}\n]+"
STEMS = ("licen", "permis", "redistr")


@cache
def full_texts() -> list[tuple[str, str]]:
    """Licence ids and texts of the files, also without what follows their terms."""
    out = []
    for f in sorted(TEXTS.glob("*.txt")):
        text = f.read_text(encoding="utf-8")
        out.append((f.stem, text))
        if END in text:
            out.append((f.stem, text[: text.index(END) + len(END)]))
    return out


@cache
def body_words() -> dict[str, list[str]]:
    """The words that follow copyright and (c) within known texts."""
    after: dict[str, set[str]] = {"copyright": set(), "(c)": set()}
    for _, text in [*LICENSES, *full_texts()]:
        for start, word in re.findall(r"(copyright|\(c\))[,;.]?\s+([a-z]+)", text.lower()):
            after[start] |= {word, *(x for x, y in SPELLINGS.items() if y == word)}
    return {k: sorted(v) for k, v in after.items()}


@cache
def notice(mark: str = r"[^\p{L}\p{N}\n]") -> str:
    """The pattern of lines that are a copyright notice: what follows copyright or (c) within known texts is none. mark: what may stand before."""
    after = body_words()
    body = lambda x: r"(?![,;.]?[ \t]*(?:$|[ \t](?:" + "|".join(after[x]) + r")\b))"
    return r"(?m)^" + mark + r"*(?:copyright\b" + body("copyright") + r"|\(c\)" + body("(c)") + r"|©)[^\n]*$"


def canonical(text: str) -> str:
    """The canonical form of a known text, in Python; documents get theirs from the columns below."""
    text = re.sub(notice(r"(?:(?!\n)[\W_])") + r"|^[\W_]*all rights reserved[\W_]*$", "", text.lower())
    words = re.sub(r"[\W_]+", " ", re.sub(JOINED, "", text)).split()
    return " ".join(SPELLINGS.get(w, w) for w in words)


def known(texts: list[tuple[str, str]] | None = None) -> list[tuple[str, str, int]]:
    """(license_id, digest, words) of each known text, by default of all, once for each digest."""
    found = {}
    for name, text in [*LICENSES, *full_texts()] if texts is None else texts:
        c = canonical(text)
        found[hashlib.sha256(c.encode()).hexdigest()] = (name, c.count(" ") + 1)
    return [(n, d, k) for d, (n, k) in sorted(found.items())]


def bared(text: Column) -> Column:
    """Canonical but for spellings, with its lines."""
    text = F.lower(text)
    for pattern, to in ((notice(), ""), (RESERVED, ""), (JOINED, ""), (OTHER, " ")):
        text = F.regexp_replace(text, pattern, to)
    return text


def digest(line: Column) -> Column:
    words = F.split(line, " ")
    spelt = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    return F.sha2(F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(spelt, w), w)), " "), 256)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, scope (document or line), license_id, digest of what matches."""
    rows = known()
    table = docs.sparkSession.createDataFrame(rows, "license_id string, digest string, words int").select("license_id", "digest")
    counts = sorted({r[2] for r in rows})
    size = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1
    some = "|".join(JOINED.replace("+", "*").join(stem) for stem in STEMS)  # what canonical texts leave out may stand between the letters
    bare = docs.filter(F.lower(F.col(text_col).cast("string")).rlike(some)).select(F.col(id_col).alias("id"), bared(F.col(text_col).cast("string")).alias("bare"))
    whole = F.trim(F.regexp_replace("bare", " *\n[ \n]*", " "))
    units = bare.select("id", F.explode(F.concat(F.array(F.struct(F.lit("document").alias("scope"), whole.alias("unit"))), F.transform(F.array_distinct(F.split("bare", "\n")), lambda x: F.struct(F.lit("line").alias("scope"), F.trim(x).alias("unit"))))).alias("u"))
    units = units.select("id", "u.*").filter((F.col("unit") != "") & size(F.col("unit")).isin(counts))
    found = units.select("id", "scope", digest(F.col("unit")).alias("digest")).join(F.broadcast(table), "digest")
    return found.groupBy("id", "scope", "license_id", "digest").agg(F.count("*").alias("n")).drop("n")


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def oracle() -> str:
    """The scan in DuckDB, line by line, since its patterns can't look ahead."""
    rows = ", ".join(f"('{n}', '{d}', {k})" for n, d, k in known())
    quoted = lambda p: p.replace("'", "''")
    mark = r"^[^\p{L}\p{N}]*"
    after = {k: "|".join(v) for k, v in body_words().items()}
    within = lambda x, start: rf"{mark}{start}[,;.]?[ \t]*(?:$|[ \t](?:{after[x]})\b)"
    has = lambda p: f"regexp_matches(l, '{quoted(p)}')"
    notice_ = f"({has(mark + r'copyright' + chr(92) + 'b')} and not {has(within('copyright', 'copyright'))} or {has(mark + r'[(]c[)]')} and not {has(within('(c)', '[(]c[)]'))} or {has(mark + '©')})"
    reserved = has(mark + r"all rights reserved[^\p{L}\p{N}]*$")
    return f"""
        with known(license_id, digest, words) as (values {rows}),
        lines as (
            select doc_id, list_transform(list_filter(string_split(lower(text), chr(10)), lambda l: not ({notice_} or {reserved})), lambda l: trim(regexp_replace(regexp_replace(l, '{quoted(JOINED)}', '', 'g'), '{quoted(OTHER)}', ' ', 'g'))) as ls
            from documents where text is not null
        ), units as (
            select doc_id, 'document' as scope, array_to_string(list_filter(ls, lambda l: l <> ''), ' ') as unit from lines
            union all
            select doc_id, 'line', unnest(ls) from lines
        ), spelt as (
            select doc_id, scope, string_split(unit, ' ') as ws,
                   map({_sql_list(list(SPELLINGS))}, {_sql_list(list(SPELLINGS.values()))}) as m
            from units where unit <> ''
        ), hashed as (
            select doc_id, scope, sha256(array_to_string(list_transform(ws, lambda w: coalesce(list_extract(map_extract(m, w), 1), w)), ' ')) as digest
            from spelt where len(ws) in (select words from known)
        )
        select distinct doc_id, scope, license_id, digest from hashed join known using (digest)
    """
