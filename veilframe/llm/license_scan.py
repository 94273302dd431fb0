"""License scans by canonical digest lookup.

``canonical`` normalises case, punctuation, copyright lines and equivalent spellings; the digest of
the whole result is hash-joined with the digests of known licence texts. The same is done for each
line by itself against known one-line notices, so that a document that carries a notice is found
though it isn't a licence text as a whole.

A second digest, of the text without title, version, address, copyright (with or without a year) and rights-reserved
lines at its head, is joined with those of ``MORE_TEXTS`` as well, known texts being treated alike; only texts with the
letters "licen" or "software" are looked at so. A line, or a paragraph over several lines, that says by a usual form and without
a negation that something is licensed under a named licence, and each licence of an SPDX-License-Identifier, is a notice too; so are
the standard headers of source files and the grants inside them (``HEADERS``, ``GRANTS``), whose paragraphs are digested like whole
texts. Comment marks are no letters, so they are in no digest; a line without letters and digits parts paragraphs.

One narrow pass; nothing is shuffled. Lines are taken apart only in texts, and digested only where the line itself, holds
all words of some notice that no spelling touches, which every line of that digest does. The digests of the known texts
are broadcast below ``MAX_BROADCAST_KNOWN`` rows; notices are a literal map of at most ``MAX_NOTICES``.

Defined results: null text is the empty text; an empty canonical form has a null digest and matches
nothing; repeated rows are looked up each; equal canonical texts of two licences give the name that
sorts first; empty tables give empty results.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import let
from .common import held, text_of

#: Equivalent spellings, each as (spelling, canonical), over lower-case words.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("organisation", "organization"),
    ("organisations", "organizations"), ("authorised", "authorized"), ("favour", "favor"), ("acknowledgement", "acknowledgment"),
    ("analyse", "analyze"), ("judgement", "judgment"), ("noninfringement", "non infringement"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("sub license", "sublicense"), ("whilst", "while"), ("wilful", "willful"),
)
MAX_BROADCAST_KNOWN = 5_000
MAX_NOTICES = 1_000
#: Beginnings of the words before "under" in a notice.
VERBS = ("licen", "released", "distributed", "published", "available")

_GRANT_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_1 = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"

#: Published licence texts and usual one-line notices.
LICENSE_TEXTS = (
    ("MIT", "MIT License\n\n" + _GRANT_MIT),
    ("MIT", _GRANT_MIT),
    ("ISC", f"ISC License\n\n{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_TAIL}"),
    ("0BSD", f"{_ISC_GRANT}.\n\n{_ISC_TAIL}"),
    ("BSD-2-Clause", f"{_BSD_HEAD}\n\n1. {_BSD_1}\n\n2. {_BSD_2}\n\n{_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD}\n\n1. {_BSD_1}\n\n2. {_BSD_2}\n\n3. {_BSD_3}\n\n{_BSD_TAIL}"),
)
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("all-rights-reserved", "All rights reserved."),
)
_END = "END OF TERMS AND CONDITIONS"


def _shipped_texts() -> list[tuple[str, str]]:
    """The shipped files, each also without what follows the end of its terms."""
    found = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]
    return found + [(name, t[: t.index(_END) + cut]) for name, t in found if _END in t for cut in (0, len(_END))]


#: Further published texts and variants, compared without the lines at their head.
MORE_TEXTS = (
    *_shipped_texts(),
    ("ISC", LICENSE_TEXTS[2][1].replace("and/or", "and")),
    ("BSD-2-Clause", f"{_BSD_HEAD}\n\n* {_BSD_1}\n\n* {_BSD_2}\n\n{_BSD_TAIL}"),
    ("BSD-3-Clause", f"{_BSD_HEAD}\n\n* {_BSD_1}\n\n* {_BSD_2}\n\n* {_BSD_3}\n\n{_BSD_TAIL}"),
)
_TITLE = r"(?:the )?\(?(?:mit|expat|x11|isc|0bsd|bsd|zero[- ]clause bsd|[0234][- ]clause bsd|(?:new|revised|modified|simplified|free) bsd|apache|gnu|mozilla|creative commons|cc0|the \"?artistic|artistic)\b[^\n]*"
_HEAD = rf"\A(?:[\s*#/;=-]*(?:{_TITLE}|version [0-9][^\n]*|https?://[^\s]*|(?:copyright\b|\(c\)|©)[^\n]*|all rights reserved\b[^\n]{{0,3}})[\x20\x09\x0d]*(?:\n|\z))+"
#: Names in canonical form in notices, as a pattern.
NOTICE_NAMES = (
    ("MIT", "mit|expat"), ("ISC", "isc"), ("0BSD", "0bsd"), ("BSD-2-Clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd)"), ("BSD-3-Clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)"),
    ("Apache-2.0", "apache(?: license)?(?: version| v)? ?2(?: 0)?"), ("CC0-1.0", "(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    *[(f"MPL-{a}", f"(?:mozilla public license|mpl)(?: version| v)? ?{a.replace('.', ' ')}") for a in ("1.1", "2.0")],
    *[(f"GPL-{a}.0", f"(?:gnu general public license|(?:gnu )?gpl)(?: version| v)? ?{a}(?: 0)?") for a in "123"],
    *[(f"LGPL-{a}", f"(?:gnu (?:lesser|library) general public license|(?:gnu )?lgpl)(?: version| v)? ?{b}") for a, b in (("2.0", "2(?: 0)?"), ("2.1", "2 1"), ("3.0", "3(?: 0)?"))],
    *[(f"AGPL-{a}.0", f"(?:gnu affero general public license|(?:gnu )?agpl)(?: version| v)? ?{a}(?: 0)?") for a in "3"],
    *[(f"CC-{a}-{v}", f"(?:cc|creative commons) {a.lower().replace('-', ' ')} {v.replace('.', ' ')}") for a in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0")],
)
#: A line that is dropped before digests are taken: a year, or the place for one.
COPYRIGHT_LINE = r"(?m)^[\x20\x09]*(?:copyright\b|\(c\)|©)[^\n]*(?:[0-9]{4}|<year>|\[year\]|\[yyyy\]|\{year\}|\{yyyy\})[^\n]*$"
_SUBJECT = "(?:(?:this|the|these|all|our|it|they)(?: (?!not |never |neither |nor )[a-z]+){0,3} (?:is|are)(?: hereby| now| also)? )?"
_SAYS = f"^{_SUBJECT}(?:licensed|released|distributed|published|available|made available) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
_GOES_ON = "(?: international| unported| generic| public license| license| only| or later| or newer| or any later version| or at your option any later version)*(?: see(?: [a-z0-9]+)+)?$"


def _gnu_headers() -> list[tuple[str, str]]:
    """The headers that the GNU licences ask for, by rule: what is free software, which licence, which version, and whether later ones are allowed."""
    kinds = [("GPL", "General", ("1", "2", "3")), ("AGPL", "Affero General", ("3",)), ("LGPL", "Lesser General", ("2.1", "3")), ("LGPL", "Library General", ("2",))]
    out = []
    for subject in ("program", "file", "library", "software", "code", "package"):
        for short, words, versions in kinds:
            for v in versions:
                start = f"This {subject} is free software; you can redistribute it and/or modify it under the terms of the GNU {words} Public License"
                name = f"{short}-{v if '.' in v else v + '.0'}"
                for later in ("or (at your option) any later version", "or any later version"):
                    out.append((name, f"{start} as published by the Free Software Foundation; either version {v} of the License, {later}."))
                out += [(name, f"{start} version {v} as published by the Free Software Foundation."), (name, f"{start} as published by the Free Software Foundation; version {v} of the License.")]
                out.append((name, f"{start} as published by the Free Software Foundation, version {v}."))
    return out


_APACHE = 'under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'
_APACHE_FOUNDATION = "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You"
_AT_APACHE = ["", *[f" {scheme}://www.apache.org/licenses/LICENSE-2.0{end}" for scheme in ("http", "https") for end in ("", ".txt", ".html")]]
#: Standard headers of source files, a paragraph each.
HEADERS = (
    *_gnu_headers(),
    *[("Apache-2.0", f"{who} {_APACHE}{at}") for who in ("Licensed", _APACHE_FOUNDATION) for at in _AT_APACHE],
    *[("MPL-2.0", f"This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at {scheme}://{www}mozilla.org/MPL/2.0/.") for scheme in ("http", "https") for www in ("", "www.")],
)
#: Grants inside files: the names of paragraphs, and for each licence those that it takes. The first that is there stands for those after it of its kind.
GRANT_PARTS = (
    *[(f"mit {k}", part) for k, part in enumerate(_GRANT_MIT.split("\n\n"))],
    ("isc", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.".replace("and/or", "and")),
    ("0bsd", f"{_ISC_GRANT}."), ("isc tail", _ISC_TAIL), ("bsd", _BSD_HEAD), ("bsd tail", _BSD_TAIL), ("bsd 1", _BSD_1), ("bsd 2", _BSD_2), ("bsd 3", _BSD_3),
    *[(name, mark.join(["", *parts]).strip()) for name, parts in (("bsd 1", [_BSD_1]), ("bsd 2", [_BSD_2]), ("bsd 3", [_BSD_3]), ("bsd 12", [_BSD_1, _BSD_2]), ("bsd 123", [_BSD_1, _BSD_2, _BSD_3])) for mark in (" * ", " - ")],
    *[(name, " ".join(f"{k} {p}" for k, p in zip(numbers, parts, strict=True))) for name, numbers, parts in (("bsd 1", "1", [_BSD_1]), ("bsd 2", "2", [_BSD_2]), ("bsd 3", "3", [_BSD_3]), ("bsd 12", "12", [_BSD_1, _BSD_2]), ("bsd 123", "123", [_BSD_1, _BSD_2, _BSD_3]))],
)
GRANTS = (
    (("MIT", ("mit 0", "mit 1", "mit 2")),),
    (("ISC", ("isc", "isc tail")), ("0BSD", ("0bsd", "isc tail"))),
    (("BSD-3-Clause", ("bsd", "bsd 123", "bsd tail")), ("BSD-3-Clause", ("bsd", "bsd 1", "bsd 2", "bsd 3", "bsd tail")), ("BSD-2-Clause", ("bsd", "bsd 12", "bsd tail")), ("BSD-2-Clause", ("bsd", "bsd 1", "bsd 2", "bsd tail"))),
)
#: A line without letters and digits, or none, between two paragraphs.
PARAGRAPH = r"\n[^\p{L}\p{N}\n]*\n"
#: What every paragraph of a header or grant holds, one or the other.
_IN_HEADERS = ("free software", "the license at", "apache.org", "source code form", "permission", "redistribut", "disclaim", "as is", "neither the name")


def canonical(text: Column, drop_copyright: bool = True) -> Column:
    """Lower case, without copyright lines, only letters and digits, one spelling, one space between. Words stand
    between two spaces of their own while spellings are replaced, so neighbouring ones are all found."""
    out = F.lower(text)
    if drop_copyright:
        out = F.regexp_replace(out, COPYRIGHT_LINE, " ")
    out = F.concat(F.lit(" "), F.regexp_replace(out, r"[^\p{L}\p{N}]+", "  "), F.lit(" "))
    for spelling, same in SPELLINGS:
        out = F.replace(out, F.lit(_apart(spelling)), F.lit(_apart(same)))
    return F.btrim(F.replace(out, F.lit("  "), F.lit(" ")))


def _apart(words: str) -> str:
    return f" {words.replace(' ', '  ')} "


def digest(text: Column, **options) -> Column:
    form = canonical(text, **options)
    return F.when(form != "", F.sha2(form, 256))


def known_digests(spark, texts) -> DataFrame:
    rows = spark.createDataFrame([(str(a), str(b)) for a, b in texts], "license string, text string")
    return rows.select("license", digest(F.col("text")).alias("known")).filter("known is not null").groupBy("known").agg(F.min("license").alias("license"))


def headless(low: Column) -> Column:
    """A lower-case text without title, version, address, copyright and rights-reserved lines at the head."""
    return F.regexp_replace(low, _HEAD, "")


def needed_words(notices) -> list[list[str]]:
    """For each notice the words that its lines hold whatever their spelling, case and punctuation."""
    written = {w for pair in SPELLINGS for side in pair for w in side.split()}
    return [[w for w in dict.fromkeys(re.findall(r"[^\W_]+", text.lower())) if w not in written and len(w) > 2] for _, text in notices]


def holds_all(text: Column, words: list[str]) -> Column:
    out = F.lit(True)
    for w in sorted(words, key=len, reverse=True):
        out = out & text.contains(w)
    return out


def any_of(tests: list[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def said(low: Column) -> Column:
    """Names of the licences in lines, or paragraphs, of a usual form. low: lower-case text."""
    may = lambda unit: unit.contains("under") & any_of([unit.contains(w) for w in VERBS])
    whole = F.filter(F.split(low, PARAGRAPH), lambda p: p.contains("\n") & may(p))
    units = F.concat(F.filter(F.split(low, "\n"), may), whole)
    forms = F.filter(F.transform(units, lambda unit: canonical(unit, drop_copyright=False)), lambda f: f.rlike(_SAYS))
    rules = [(name, f"{_SAYS}(?:{pattern}){_GOES_ON}") for name, pattern in NOTICE_NAMES]
    return F.flatten(F.transform(forms, lambda f: F.array_compact(F.array(*[F.when(f.rlike(rule), F.lit(name)) for name, rule in rules]))))


def headers(low: Column, known: dict[str, str], grants=GRANTS) -> Column:
    """Names of the licences whose header, or all parts of whose grant, are paragraphs of a text. known: digest of a paragraph -> name or part."""
    lookup = F.create_map(*[F.lit(x) for pair in {**known, "": ""}.items() for x in pair])
    bare = lambda p: F.regexp_replace(p, r"(?m)^[^\p{L}\p{N}(©\n]+", "")  # noqa: E731  marks before a copyright line
    kept = F.filter(F.split(low, PARAGRAPH), lambda p: any_of([F.regexp_replace(p, r"[^\p{L}\p{N}.]+", " ").contains(w) for w in _IN_HEADERS]))
    marks = F.transform(kept, lambda p: F.get(F.array(lookup[digest(bare(p))]), F.lit(0)))

    def names(parts: Column) -> Column:
        out = [F.filter(parts, lambda x: x.isin(sorted({n for n, _ in HEADERS})))]
        for kind in grants:
            value = F.lit(None).cast("string")
            for name, needed in reversed(kind):
                has = F.lit(True)
                for n in needed:
                    has = has & F.array_contains(parts, n)
                value = F.when(has, F.lit(name)).otherwise(value)
            out.append(F.array_compact(F.array(value)))
        return F.concat(*out)

    return let(F.array_compact(marks), names)


def identifiers(body: Column) -> Column:
    """The licences of SPDX-License-Identifier lines."""
    marks = F.regexp_extract_all(body, F.lit(r"(?i)spdx-license-identifier:[\x20\x09]*([^\n]*)"), F.lit(1))
    parts = F.flatten(F.transform(marks, lambda m: F.split(F.regexp_replace(m, r"(?i)\bwith\s+[^\s)]+", " "), r"(?i)[\s()]+(?:(?:and|or)[\s()]+)?")))
    return F.filter(parts, lambda x: x.rlike(r"^[A-Za-z0-9][A-Za-z0-9.+-]*$"))


def scan(docs: DataFrame, texts=LICENSE_TEXTS, notices=NOTICES, more_texts=MORE_TEXTS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, text_digest, license (of the whole text, else null), notices
    (sorted distinct names of the notices, headers and grants in the text)."""
    if len(notices) > MAX_NOTICES:
        raise ValueError(f"notices are a literal map of at most {MAX_NOTICES} entries")
    spark = docs.sparkSession
    known = known_digests(spark, texts)
    if len(texts) <= MAX_BROADCAST_KNOWN:
        known = F.broadcast(known)
    none = F.array().cast("array<string>")
    rows = docs.select("doc_id", text_of().alias("body")).withColumn("low", held(F.lower("body")))
    # canonical forms are columns of their own: inside a condition they would be made twice
    rows = rows.withColumn("__form", held(canonical(F.col("low")))).withColumn("text_digest", held(F.when(F.col("__form") != "", F.sha2("__form", 256))))
    # a digest of a text without its head is taken only where there is a head, else it is that of the text
    may = any_of([F.col("low").contains(w) for w in ("licen", "software")])
    rows = rows.withColumn("__rest", held(F.when(may, headless(F.col("low")))))
    changed = F.length("__rest") < F.length("low")
    rows = rows.withColumn("__rest_form", held(F.when(changed, canonical(F.col("__rest")))))
    form = F.when(changed, F.when(F.col("__rest_form") != "", F.sha2("__rest_form", 256))).otherwise(F.col("text_digest"))
    rows = rows.withColumn("form", held(F.when(F.col("__rest").isNotNull(), form)))
    found = none
    if notices:
        marks = known_digests(spark, notices).collect()  # at most MAX_NOTICES
        lookup = F.create_map(*[F.lit(x) for m in [*marks, {"known": "", "license": ""}] for x in (m["known"], m["license"])])
        needed = needed_words(notices)
        fits = lambda text: any_of([holds_all(text, words) for words in needed])
        lines = F.transform(F.filter(F.split("low", "\n"), fits), lambda line: digest(line, drop_copyright=False))
        listed = F.filter(F.transform(lines, lambda d: F.get(F.array(lookup[d]), F.lit(0))), lambda x: x.isNotNull())
        found = F.when(fits(F.col("low")), listed).otherwise(none)
        says = F.col("low").contains("under") & any_of([F.col("low").contains(w) for w in VERBS])
        found = F.concat(found, F.when(says, said(F.col("low"))).otherwise(none))
        parts = {r["known"]: r["license"] for r in known_digests(spark, (*HEADERS, *GRANT_PARTS)).collect()}  # some hundred, as listed
        may = any_of([F.col("low").contains(w) for w in ("free software", "apache", "source code form", "permission", "redistribut")])
        inside = F.when(may, headers(F.col("low"), parts)).otherwise(none)
        rows = rows.withColumn("__inside", held(inside))
        found = F.concat(found, F.when(F.col("low").contains("spdx-license-identifier"), identifiers(F.col("body"))).otherwise(none))
    else:
        rows = rows.withColumn("__inside", none)
    rows = rows.withColumn("found", held(found))
    more = spark.createDataFrame([(str(a), str(b)) for a, b in (*texts, *more_texts)], "license string, text string")
    more = more.select("license", digest(headless(F.lower("text"))).alias("form_known")).filter("form_known is not null")
    more = more.groupBy("form_known").agg(F.min("license").alias("form_license"))
    if len(texts) + len(more_texts) <= MAX_BROADCAST_KNOWN:
        more = F.broadcast(more)
    rows = rows.join(known, rows["text_digest"] == known["known"], "left").join(more, F.col("form") == F.col("form_known"), "left")
    rows = rows.withColumn("license", F.coalesce("license", "form_license"))
    # a licence text isn't a file with a grant inside
    inside = F.when(F.col("license").isNull(), F.col("__inside")).otherwise(none)
    return rows.select("doc_id", "text_digest", "license", F.array_sort(F.array_distinct(F.concat("found", inside))).alias("notices"))


def document_licenses(documents: DataFrame) -> DataFrame:
    return scan(documents).select("doc_id", "text_digest", "license", F.array_join("notices", ",").alias("notices"))


def _canonical_sql(text: str, drop_copyright: bool = True) -> str:
    out = f"lower({text})"
    if drop_copyright:
        out = rf"regexp_replace({out}, '{COPYRIGHT_LINE}', ' ', 'g')"
    out = rf"(' ' || regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', '  ', 'g') || ' ')"
    for spelling, same in SPELLINGS:
        out = f"replace({out}, '{_apart(spelling)}', '{_apart(same)}')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def _known_sql(texts) -> str:
    rows = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in texts)
    return f"SELECT sha256({_canonical_sql('t')}) AS known, min(license) AS license FROM (VALUES {rows}) v(license, t) GROUP BY known"


ORACLE = f"""
WITH known AS ({_known_sql(LICENSE_TEXTS)}), marks AS ({_known_sql(NOTICES)}),
form AS (SELECT doc_id, {_canonical_sql("coalesce(text, '')")} AS f FROM documents),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
found AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
  FROM (SELECT doc_id, sha256({_canonical_sql("line", False)}) AS h FROM lines) l JOIN marks ON marks.known = l.h GROUP BY doc_id)
SELECT doc_id, CASE WHEN f <> '' THEN sha256(f) END AS text_digest, license, coalesce(notices, '') AS notices
FROM form LEFT JOIN known ON known.known = sha256(f) LEFT JOIN found USING (doc_id)
"""
