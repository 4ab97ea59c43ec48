"""Licence scan by canonical digests; DataFrame operations only.

A text is put into canonical form (lower case, punctuation and white space to single spaces,
copyright lines dropped, equivalent spellings unified word by word) and the SHA-256 of that
form is joined with the digests of known licence texts and notices. Four kinds of units are
looked up as entire texts: the whole document, each paragraph (lines between blank lines), each
run of two or more consecutive paragraphs short of the whole, and each line. Before hashing, a
unit is dropped if its first word starts no known text or it has a number of words that no known
text has: neither can match. A run has to begin and end with the words of a known text of its
length; its end is looked up among the ends of paragraphs, so runs are found however a text was
divided, at a cost of the paragraphs times the different lengths of known texts. The known digests are a table
of bounded size, broadcast when their measured size allows it.

Edge cases: a null or empty text, or one of punctuation only, has no unit; a unit repeated in a
document counts each time; a document of a single line is one whole-text unit, one paragraph
and one line; repeated rows get equal results; a null ``doc_id`` is kept; an empty table gives
an empty result; known texts with equal canonical forms are all named.
"""

from __future__ import annotations

from itertools import product
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .spans import let, running_sums

#: Equivalent words, unified to the right-hand one.
EQUIVALENT = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "https": "http",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licenced": "licensed",
    "licences": "licenses",
    "maximise": "maximize",
    "modelled": "modeled",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sublicence": "sublicense",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
"""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING
ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""

_MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at {}://mozilla.org/MPL/2.0/."""
_GNU_TERMS = """This {what} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by
the Free Software Foundation; {version}.
"""
_GNU_REST = """This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.
You should have received a copy of the {name} along with this {what}; if not, {end}"""
_GNU_ENDS = (
    "see <http://www.gnu.org/licenses/>.",
    "write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
    "write to the Free Software Foundation, Inc., 59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
)
_GNU = (
    ("GPL-2.0", "2", "GNU General Public License"),
    ("GPL-3.0", "3", "GNU General Public License"),
    ("LGPL-2.1", "2.1", "GNU Lesser General Public License"),
    ("LGPL-3.0", "3", "GNU Lesser General Public License"),
    ("AGPL-3.0", "3", "GNU Affero General Public License"),
)


def _gnu_notices() -> list[tuple[str, str]]:
    """The standard header notices, and their first sentence alone."""
    out = []
    for key, v, name in _GNU:
        forms = [("or-later", f"either version {v} of the License, or (at your option) any later version")]
        forms += [("only", f"version {v} of the License"), ("only", f"version {v}"), ("only", f"either version {v} of the License")]
        for (kind, version), what in product(forms, ("program", "library", "file", "software")):
            terms = _GNU_TERMS.format(what=what, name=name, version=version)
            out += [(f"{key}-{kind}", terms)]
            out += [(f"{key}-{kind}", terms + _GNU_REST.format(what=what, name=name, end=end)) for end in _GNU_ENDS]
    return out


#: Full texts shipped with the package.
FULL = {
    "Apache-2.0": "Apache-2.0",
    "GPL-2.0-only": "GPL-2",
    "GPL-3.0-only": "GPL-3",
    "LGPL-2.1-only": "LGPL-2.1",
    "LGPL-3.0-only": "LGPL-3",
    "MPL-2.0": "MPL-2.0",
    "CC0-1.0": "CC0-1.0",
    "CC-BY-SA-4.0": "CC-BY-SA-4.0",
    "Unlicense": "Unlicense",
}
_END = "END OF TERMS AND CONDITIONS"


def _full_texts() -> list[tuple[str, str]]:
    """Each full text, also without the advice behind its terms and without a copyright line to fill in."""
    out = []
    for key, name in FULL.items():
        text = (Path(__file__).parent / "license_texts" / f"{name}.txt").read_text(encoding="utf-8")
        filled = "\n".join(x for x in text.split("\n") if "Copyright [yyyy]" not in x)
        head = text.partition(_END)[0]
        out += [(key, x) for x in dict.fromkeys((text, filled, head + _END, head) if _END in text else (text, filled))]
    return out


#: Public licence texts and standard notices.
TEXTS = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("ISC", _ISC + _ISC_END),
    ("ISC", "ISC License\n" + _ISC + _ISC_END),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_END),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_END),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_THIRD + _BSD_END),
    ("Apache-2.0", _APACHE_NOTICE),
]
#: Names by which one-line notices call a licence, and the sentences they appear in.
NAMES = {
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "Apache License 2.0", "Apache 2.0"],
    "MIT": ["the MIT License", "the MIT license", "MIT"],
    "GPL-2.0-only": ["the GNU General Public License, version 2", "the GNU GPL v2", "GPL-2.0"],
    "GPL-3.0-only": ["the GNU General Public License, version 3", "the GNU GPL v3", "GPL-3.0", "GPLv3"],
    "LGPL-3.0-only": ["the GNU Lesser General Public License, version 3", "LGPL-3.0"],
    "AGPL-3.0-only": ["the GNU Affero General Public License, version 3", "AGPL-3.0"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "MPL-2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "BSD-2-Clause"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "BSD-3-Clause"],
    "ISC": ["the ISC License"],
    "Unlicense": ["the Unlicense"],
    "CC0-1.0": ["CC0 1.0"],
    **{f"CC-{k.replace(' ', '-')}-4.0": [f"CC {k} 4.0"] for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")},
}
SENTENCES = (
    "Licensed under {}.", "Released under {}.", "Distributed under {}.", "Available under {}.", "{}",
    "This work is licensed under {}.", "This project is licensed under {}.", "This file is licensed under {}.",
    "This software is released under {}.", "SPDX-License-Identifier: {}",
)
MAX_BROADCAST_BYTES = 16 << 20
#: A copyright line has marks and a year, or two marks, or reserves all rights.
_COPYRIGHT = r"^((copyright|c) |© ?)+[0-9]{4}\b|^(copyright (c|©)|© ?copyright|c copyright)( |$)|^all rights reserved"


def known_rows() -> list[tuple[str, str]]:
    """``(license_id, text)`` of the texts and notices and of every name in every sentence."""
    notices = [("MPL-2.0", _MPL_NOTICE.format("http")), *_gnu_notices()]
    return TEXTS + _full_texts() + notices + [(k, s.format(n)) for k, names in NAMES.items() for n in names for s in SENTENCES]


def known_licenses(spark: SparkSession) -> DataFrame:
    """The bundled catalogue as ``(license_id, text)``."""
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(f"({quote(k)}, {quote(t)})" for k, t in known_rows())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS v(license_id, text)")


def _plain_lines(text: Column) -> Column:
    """Lines in lower case, with each run of other characters a space, trimmed."""
    flat = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\n©]+", " ")
    return F.transform(F.split(flat, "\n"), lambda line: F.trim(line))


def _flat(lines: Column) -> Column:
    """Words of some lines, without copyright lines, between single spaces."""
    kept = F.array_join(F.filter(lines, lambda x: (x != "") & ~x.rlike(_COPYRIGHT)), " ")
    return F.trim(F.regexp_replace(F.translate(kept, "©", ""), " +", " "))


def _spelled(flat: Column) -> Column:
    """The words in equivalent spelling."""
    same = F.create_map(*(F.lit(x) for pair in EQUIVALENT.items() for x in pair))
    return F.array_join(F.transform(F.split(flat, " "), lambda w: F.coalesce(F.element_at(same, w), w)), " ")


def canonical(text: str | Column) -> Column:
    """Canonical form of an entire text."""
    return _spelled(_flat(_plain_lines(F.col(text) if isinstance(text, str) else text)))


def _words(flat: Column) -> Column:
    """Number of words of a text that is not empty."""
    return F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit(""))) + 1


def _runs(paras: Column, counts: Column, shapes: list[tuple[int, list[str], list[str]]]) -> Column:
    """``array<string>``: runs of at least two paragraphs, not all, that begin, end and count like a
    known text.

    ``shapes`` holds, for each number of words, the first two and the last words of known texts. A
    run's end is its start and its words further on: for each shape the ends asked for are
    intersected with those that there are, in time linear in the paragraphs.
    """
    if not shapes:
        return F.array().cast("array<string>")
    two = lambda i: F.substring_index(F.concat_ws(" ", F.get(paras, i - 1), F.get(paras, i)), " ", 2)
    begins = sorted({x for _, first, _ in shapes for x in first})
    first = F.filter(F.sequence(F.lit(1), F.greatest(F.size(paras) - 1, F.lit(1))), lambda i: (i < F.size(paras)) & two(i).isin(*begins))
    known = F.array(*(F.struct(F.lit(n).alias("n"), F.array(*map(F.lit, a)).alias("first"), F.array(*map(F.lit, z)).alias("last")) for n, a, z in shapes))

    def found(doc: Column) -> Column:
        at = lambda i: F.get(doc["ends"], i - 1) - F.get(counts, i - 1)
        starts = F.transform(doc["first"], lambda i: F.struct(at(i).alias("at"), F.get(counts, i - 1).alias("n"), two(i).alias("two")))

        def of(shape: Column, start: Column) -> Column:
            whole = lambda x: (x["at"] == 0) & (shape["n"] == F.element_at(doc["ends"], -1))
            fit = F.filter(start, lambda x: (x["n"] < shape["n"]) & F.array_contains(shape["first"], x["two"]) & ~whole(x))
            ends = F.array_intersect(F.transform(fit, lambda x: x["at"] + shape["n"]), doc["ends"])
            ends = F.filter(ends, lambda e: F.array_contains(shape["last"], F.get(doc["words"], e - 1)))
            return F.transform(ends, lambda e: F.array_join(F.slice(doc["words"], e - shape["n"] + 1, shape["n"]), " "))

        return let(starts, lambda s: F.flatten(F.transform(known, lambda shape: of(shape, s))))

    def searched(some: Column) -> Column:
        doc = F.struct(some.alias("first"), running_sums(counts).alias("ends"), F.split(F.array_join(paras, " "), " ").alias("words"))
        return F.when(F.size(some) > 0, let(doc, found)).otherwise(F.array().cast("array<string>"))

    return let(first, searched)


def find_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, unit, license_id, digest)``: one row per matching unit and licence."""
    digests = known.select("license_id", canonical("text").alias("form")).where("form != ''").distinct()
    digests = digests.select("license_id", F.sha2("form", 256).alias("digest"), F.split("form", " ").alias("w"))
    # Bounded by the catalogue: its first words, in every spelling, and its lengths.
    ends = F.collect_set(F.when(F.size("w") > 1, F.struct(F.size("w").alias("n"), F.slice("w", 1, 2).alias("two"), F.element_at("w", -1).alias("last"))))
    shape = digests.agg(F.collect_set(F.element_at("w", 1)).alias("first"), ends.alias("ends"), F.collect_set(F.size("w")).alias("sizes"), F.sum(F.lit(200)).alias("bytes")).first()
    spellings = lambda w: [w, *(a for a, b in EQUIVALENT.items() if b == w)]
    first = {x for w in shape["first"] for x in spellings(w)}
    shapes = []
    for n in sorted({e["n"] for e in shape["ends"]}):
        own = [e for e in shape["ends"] if e["n"] == n]
        begin = {f"{x} {y}" for e in own for x, y in product(*map(spellings, e["two"]))}
        shapes.append((n, sorted(begin), sorted({x for e in own for x in spellings(e["last"])})))
    sizes = sorted(shape["sizes"])
    rows = docs.select(F.col(id_col).alias("doc_id"), _plain_lines(F.col(text_col)).alias("lines"))
    paragraphs = F.split(F.array_join("lines", "\n"), "\n\n+")
    rows = rows.select("doc_id", "lines", F.filter(F.transform(paragraphs, lambda p: _flat(F.split(p, "\n"))), lambda p: p != "").alias("paras"))
    rows = rows.select("*", F.transform("paras", _words).alias("counts"))

    def possible(flat: Column) -> Column:
        return F.substring_index(flat, " ", 1).isin(*first) & _words(flat).isin(*sizes)

    def units(name: str, flats: Column) -> Column:
        return F.transform(F.filter(flats, possible), lambda x: F.struct(F.lit(name).alias("unit"), x.alias("flat")))

    paras = F.col("paras")
    kinds = F.concat(
        units("text", F.array(F.array_join(paras, " "))),
        units("paragraph", paras),
        units("run", _runs(paras, F.col("counts"), shapes)),
        units("line", F.transform(F.filter("lines", lambda x: x != ""), lambda x: _flat(F.array(x)))),
    )
    hits = rows.select("doc_id", F.explode_outer(kinds).alias("u")).where("u is not null")
    found = hits.select("doc_id", "u.unit", F.sha2(_spelled(F.col("u.flat")), 256).alias("digest"))
    side = digests.select("license_id", "digest")
    return found.join(F.broadcast(side) if (shape["bytes"] or 0) <= MAX_BROADCAST_BYTES else side, "digest").select("doc_id", "unit", "license_id", "digest")


def q_op8_licenses(spark, sf_dir) -> DataFrame:
    """Every unit of every document that is a known licence text or notice, with its count."""
    found = find_licenses(table(spark, sf_dir, "documents"), known_licenses(spark))
    return found.groupBy("doc_id", "unit", "license_id", "digest").agg(F.count("*").alias("n"))


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _oracle() -> str:
    def lines(text: str) -> str:
        flat = rf"regexp_replace(lower(coalesce({text}, '')), '[^\p{{L}}\p{{N}}\n©]+', ' ', 'g')"
        return f"list_transform(string_split({flat}, chr(10)), lambda x: trim(x))"

    def form(ls: str) -> str:
        kept = f"list_filter({ls}, lambda x: x <> '' AND NOT regexp_matches(x, '{_COPYRIGHT}'))"
        words = f"list_filter(string_split(replace(array_to_string({kept}, ' '), '©', ''), ' '), lambda w: w <> '')"
        cases = " ".join(f"WHEN {_sql_text(a)} THEN {_sql_text(b)}" for a, b in EQUIVALENT.items())
        return f"array_to_string(list_transform({words}, lambda w: CASE w {cases} ELSE w END), ' ')"

    known = ", ".join(f"({_sql_text(k)}, {_sql_text(t)})" for k, t in known_rows())
    return f"""
WITH known AS (SELECT DISTINCT license_id, sha256({form(lines('text'))}) AS digest FROM (VALUES {known}) AS v(license_id, text)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {lines('text')} AS ls FROM documents),
units AS (
  SELECT doc_id, 'text' AS unit, {form('ls')} AS form FROM docs
  UNION ALL
  SELECT doc_id, 'paragraph', {form('pl')} FROM (
    SELECT doc_id, string_split(unnest(regexp_split_to_array(array_to_string(ls, chr(10)), '\\n\\n+')), chr(10)) AS pl FROM docs)
  UNION ALL
  SELECT doc_id, 'line', {form('[l]')} FROM (SELECT doc_id, unnest(ls) AS l FROM docs) WHERE l <> '')
SELECT doc_id, unit, license_id, digest, count(*) AS n FROM units JOIN known ON sha256(form) = digest AND form <> ''
GROUP BY doc_id, unit, license_id, digest
"""


ORACLE_OP8 = _oracle()
