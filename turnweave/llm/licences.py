"""Licence scans by sentence rules.

A text is cut into pieces after marks and at line ends, pieces are normalised, and a run of pieces whose words are those of a
known sentence gets its licence-sentence identifier: known sentences hold such cuts themselves, and wrapped ones have more. Runs are
taken from the left, the longest first. A sentence's numbers are those of its first and last piece. The sequence of a document's
identifiers is then matched against ordered rules: a rule is a run of identifiers, in order, with nothing but unknown sentences between. At each place the longest rule counts; a match inside a longer one does not.
All of it is built-in array work within a row: no shuffle, no Python.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifiers and wordings of known licence sentences.
SENTENCES = {
    "apache2.short": "Licensed under the Apache License, Version 2.0.",
    "apache2.header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache2.use": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "apache2.copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache2.asis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache2.see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit.short": "Released under the MIT License.",
    "mit.licensed": "Licensed under the MIT License.",
    "mit.title": "The MIT License (MIT)",
    "mit.grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit.notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit.asis": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    "gpl3.short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3.free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl3.hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl3.see": "See the GNU General Public License for more details.",
    "ccbync4.short": "Licensed under CC BY-NC 4.0.",
    "ccby4.short": "Licensed under CC BY 4.0.",
    "bsd.grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "mpl2.form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2.copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "mit.liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd.endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd.asis": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc.asis": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    "gpl2.free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl2.only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl.copy": "You should have received a copy of the GNU General Public License along with this program.",
    "gpl.where": "If not, see <https://www.gnu.org/licenses/>.",
    "lgpl3.free": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl21.free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl.hope": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "lgpl.see": "See the GNU Lesser General Public License for more details.",
    "agpl3.free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl.see": "See the GNU Affero General Public License for more details.",
    "agpl.copy": "You should have received a copy of the GNU Affero General Public License along with this program.",
    "unlicense.free": "This is free and unencumbered software released into the public domain.",
    "unlicense.anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib.asis": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib.grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "bsl.grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "cc0.waived": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "ccby4.long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "ccbysa4.long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "ccbync4.long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
}
# Identifiers that a line names by itself.
NAMED = ["Apache-2.0", "MIT", "BSD-3-Clause", "GPL-2.0-or-later", "GPL-3.0-or-later", "MPL-2.0"]
SENTENCES |= {f"spdx.{name}": f"SPDX-License-Identifier: {name}" for name in NAMED}
# Ordered rules, name, licence and identifiers.
RULES = [
    ("apache-2.0-notice", "Apache-2.0", ["apache2.use", "apache2.copy", "apache2.asis", "apache2.see"]),
    ("apache-2.0-terms", "Apache-2.0", ["apache2.use", "apache2.copy"]),
    ("apache-2.0-short", "Apache-2.0", ["apache2.short"]),
    ("apache-2.0-header", "Apache-2.0", ["apache2.header"]),
    ("mit-text", "MIT", ["mit.grant", "mit.notice", "mit.asis"]),
    ("mit-titled", "MIT", ["mit.title", "mit.grant", "mit.notice", "mit.asis"]),
    ("mit-grant", "MIT", ["mit.grant", "mit.notice"]),
    ("mit-short", "MIT", ["mit.short"]),
    ("mit-licensed", "MIT", ["mit.licensed"]),
    ("gpl-3.0-notice", "GPL-3.0-or-later", ["gpl3.free", "gpl3.hope", "gpl3.see"]),
    ("gpl-3.0-free", "GPL-3.0-or-later", ["gpl3.free"]),
    ("gpl-3.0-short", "GPL-3.0-only", ["gpl3.short"]),
    ("cc-by-nc-4.0-short", "CC-BY-NC-4.0", ["ccbync4.short"]),
    ("cc-by-4.0-short", "CC-BY-4.0", ["ccby4.short"]),
    ("bsd-grant", "BSD", ["bsd.grant"]),
    ("mpl-2.0-form", "MPL-2.0", ["mpl2.form"]),
    ("mpl-2.0-notice", "MPL-2.0", ["mpl2.form", "mpl2.copy"]),
    ("mit-full", "MIT", ["mit.grant", "mit.notice", "mit.asis", "mit.liable"]),
    ("bsd-2-clause", "BSD-2-Clause", ["bsd.grant", "bsd.source", "bsd.binary", "bsd.asis"]),
    ("bsd-3-clause", "BSD-3-Clause", ["bsd.grant", "bsd.source", "bsd.binary", "bsd.endorse", "bsd.asis"]),
    ("isc-text", "ISC", ["isc.grant", "isc.asis"]),
    ("isc-grant", "ISC", ["isc.grant"]),
    ("gpl-2.0-notice", "GPL-2.0-or-later", ["gpl2.free", "gpl3.hope", "gpl3.see"]),
    ("gpl-2.0-free", "GPL-2.0-or-later", ["gpl2.free"]),
    ("gpl-2.0-only", "GPL-2.0-only", ["gpl2.only"]),
    ("gpl-2.0-full-notice", "GPL-2.0-or-later", ["gpl2.free", "gpl3.hope", "gpl3.see", "gpl.copy", "gpl.where"]),
    ("gpl-3.0-full-notice", "GPL-3.0-or-later", ["gpl3.free", "gpl3.hope", "gpl3.see", "gpl.copy", "gpl.where"]),
    ("lgpl-3.0-free", "LGPL-3.0-or-later", ["lgpl3.free"]),
    ("lgpl-3.0-notice", "LGPL-3.0-or-later", ["lgpl3.free", "lgpl.hope", "lgpl.see"]),
    ("lgpl-2.1-free", "LGPL-2.1-or-later", ["lgpl21.free"]),
    ("lgpl-2.1-notice", "LGPL-2.1-or-later", ["lgpl21.free", "lgpl.hope", "lgpl.see"]),
    ("agpl-3.0-free", "AGPL-3.0-or-later", ["agpl3.free"]),
    ("agpl-3.0-notice", "AGPL-3.0-or-later", ["agpl3.free", "gpl3.hope", "agpl.see", "agpl.copy", "gpl.where"]),
    ("unlicense", "Unlicense", ["unlicense.free", "unlicense.anyone"]),
    ("unlicense-short", "Unlicense", ["unlicense.free"]),
    ("zlib-text", "Zlib", ["zlib.asis", "zlib.grant"]),
    ("bsl-1.0-grant", "BSL-1.0", ["bsl.grant"]),
    ("cc0-1.0-waiver", "CC0-1.0", ["cc0.waived"]),
    ("cc-by-4.0", "CC-BY-4.0", ["ccby4.long"]),
    ("cc-by-sa-4.0", "CC-BY-SA-4.0", ["ccbysa4.long"]),
    ("cc-by-nc-4.0", "CC-BY-NC-4.0", ["ccbync4.long"]),
    *((f"spdx-{name.lower()}", name, [f"spdx.{name}"]) for name in NAMED),
]
# A text without any of these holds no known sentence.
TRIGGER = "licen|permi|redistrib|copyright|warrant|mozilla|unencumbered|compile"


def normalised(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


KNOWN = {normalised(text): name for name, text in SENTENCES.items()}
assert all(re.search(TRIGGER, text) for text in KNOWN)
_LONGEST = max(len(ids) for _, _, ids in RULES)
CUT = r"(?<=[.!?;:])[\x20\t\x0B\f\r]+|\n+"
# Runs of whole lines with the words of a known sentence, the longest first. One without an end mark (a title, an address) may
# have a known sentence behind it on its line.
_ORDER = sorted(KNOWN, key=lambda t: -len(t.split()))
_OPEN = {normalised(text) for text in SENTENCES.values() if text[-1] not in ".!?;:"}
_words = lambda text: text.replace(" ", "[ \\n]")
_NEXT = "(?=$| (?:" + "|".join(_words(text) for text in _ORDER if text not in _OPEN) + ")$)"
_RUN = r"(?m)(?:^|\G )(?:" + "|".join(_words(text) + (_NEXT if text in _OPEN else "$") for text in _ORDER) + ")"


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def _none() -> Column:
    return F.expr("array()").cast("array<struct<at:int,to:int,id:string>>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


_BLOCK = 256


def _sums_before(values: Column) -> Column:
    """Of each number the sum of those before it: block by block, and over the blocks, so that no array grows one by one over all of them."""

    def running(numbers: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(numbers, start, lambda acc, x: F.struct((acc["sum"] + x).alias("sum"), F.concat(acc["before"], F.array(acc["sum"])).alias("before")))

    def block(k: Column) -> Column:
        last = F.least((k + 1) * _BLOCK, F.size(values)) - 1
        return running(F.transform(F.sequence(k * _BLOCK, last), lambda i: F.get(values, i)))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int")), block)
    shifted = lambda all_: F.zip_with(all_, running(F.transform(all_, lambda b: b["sum"]))["before"], lambda b, s: F.transform(b["before"], lambda x: x + s))
    return F.when(F.size(values) > 0, F.flatten(_let(blocks, shifted))).otherwise(F.array().cast("array<int>"))


def _sequence(text: Column) -> Column:
    """The known sentences of a text: array of (first piece's number, last piece's number, identifier). Every array is bound once and read by place, so a text costs what its length is."""
    pieces = F.transform(F.split(text, CUT), lambda s, i: F.struct(i.alias("at"), F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")).alias("norm")))
    pieces = F.filter(pieces, lambda x: x["norm"] != "")  # one piece a line from here on
    known = _map(KNOWN)
    breaks = lambda x: F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))

    def of_pieces(held: Column) -> Column:
        lines = F.array_join(F.transform(held, lambda x: x["norm"]), "\n")
        parts = F.split(F.regexp_replace(lines, _RUN, "\x01$0\x02"), "\x01")  # all but the first begin with a known sentence
        return _let(parts, lambda some: of_parts(held, some))

    def of_parts(held: Column, parts: Column) -> Column:
        found = lambda line: F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: one(held, F.substring_index(F.get(parts, k), "\x02", 1), F.get(line, k)))
        return F.when(F.size(parts) > 1, _let(F.transform(parts, breaks), lambda n: _let(_sums_before(n), found))).otherwise(_none())

    def one(held: Column, said: Column, first: Column) -> Column:
        return F.struct(F.get(held, first)["at"].alias("at"), F.get(held, first + breaks(said))["at"].alias("to"), F.try_element_at(known, F.trim(F.translate(said, "\n", " "))).alias("id"))

    return _let(pieces, of_pieces)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_sentences (known licence sentences), licences (distinct, in order, comma-joined),
    matches (rule:first:last piece numbers, comma-joined).

    Null and empty texts, and texts without a known sentence, have 0 and empty strings; a known sentence that begins no
    rule is counted and matches nothing. Repeated rows and null ids are kept. Other columns are not carried.
    """
    rules = sorted(RULES, key=lambda r: -len(r[2]))
    table = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(licence).alias("licence"), F.array(*map(F.lit, ids)).alias("ids")) for name, licence, ids in rules))
    text = F.col(text_col).cast("string")
    seq = F.when(F.lower(text).rlike(TRIGGER), _sequence(text)).otherwise(_none())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(seq, _none()).alias("seq"))

    def at(x: Column, i: Column) -> Column:
        """The longest rule that begins with the i-th known sentence."""
        here = F.transform(F.sequence(i, F.least(i + _LONGEST, F.size("seq")) - 1), lambda k: F.get(F.col("seq"), k)["id"])
        first = lambda ids: F.get(F.filter(table, lambda r: F.slice(ids, F.lit(1), F.size(r["ids"])) == r["ids"]), F.lit(0))
        told = lambda best: F.struct(i.alias("i"), F.size(best["ids"]).alias("n"), best["rule"].alias("rule"), best["licence"].alias("licence"))
        return _let(_let(here, first), told)

    rows = rows.withColumn("hits", F.filter(F.transform("seq", at), lambda h: h["rule"].isNotNull()))
    # One hit a place at most, in order of places: what covers a hit begins no more than _LONGEST hits before it.
    covers = lambda g, h: (g["i"] + g["n"] >= h["i"] + h["n"]) & (g["n"] > h["n"])
    near = lambda h, k: F.exists(F.sequence(F.greatest(F.lit(0), k - _LONGEST), k), lambda m: covers(F.get(F.col("hits"), m), h))
    rows = rows.withColumn("hits", F.array_compact(F.transform("hits", lambda h, k: F.when(~near(h, k), h))))
    place = lambda k, end: F.get(F.col("seq"), k)[end].cast("string")
    spans = F.transform("hits", lambda h: F.concat_ws(":", h["rule"], place(h["i"], "at"), place(h["i"] + h["n"] - 1, "to")))
    return rows.select("doc_id", F.size("seq").cast("long").alias("n_sentences"), F.array_join(F.array_distinct(F.transform("hits", lambda h: h["licence"])), ",").alias("licences"), F.array_join(spans, ",").alias("matches"))


def oracle() -> str:
    """DuckDB: sentences by rank, rules by joining each rule's identifiers to consecutive known sentences."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(text)}, {quoted(name)})" for text, name in KNOWN.items())
    rules = ", ".join(f"({quoted(name)}, {quoted(licence)}, {k}, {len(ids)}, {quoted(x)})" for name, licence, ids in RULES for k, x in enumerate(ids))
    return f"""
WITH known(norm, id) AS (VALUES {known}), rules(rule, licence, k, n, id) AS (VALUES {rules}),
marked AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '([.!?;:])[ \\t\\x0B\\f\\r]+|\\n+', '\\1' || chr(1), 'g') AS m FROM documents),
cut AS (SELECT doc_id, string_split(m, chr(1)) AS s FROM marked),
sentences AS (SELECT doc_id, unnest(s) AS s, generate_subscripts(s, 1) - 1 AS pos FROM cut),
seq AS (SELECT doc_id, pos, id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS i
  FROM sentences JOIN known ON trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) = norm),
hits AS (SELECT a.doc_id, a.i AS i, r.rule, r.licence, any_value(r.n) AS n FROM seq a JOIN rules r ON true JOIN seq b ON b.doc_id = a.doc_id AND b.i = a.i + r.k AND b.id = r.id
  GROUP BY a.doc_id, a.i, r.rule, r.licence HAVING count(*) = any_value(r.n)),
best AS (SELECT * FROM hits h WHERE NOT EXISTS (SELECT 1 FROM hits g WHERE g.doc_id = h.doc_id AND g.i <= h.i AND g.i + g.n >= h.i + h.n AND g.n > h.n)),
spans AS (SELECT h.doc_id, h.i, h.licence, h.rule || ':' || a.pos || ':' || b.pos AS span FROM best h JOIN seq a ON a.doc_id = h.doc_id AND a.i = h.i JOIN seq b ON b.doc_id = h.doc_id AND b.i = h.i + h.n - 1),
firsts AS (SELECT doc_id, licence, min(i) AS i FROM spans GROUP BY ALL),
names AS (SELECT doc_id, string_agg(licence, ',' ORDER BY i) AS licences FROM firsts GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_sentences, coalesce(names.licences, '') AS licences, coalesce(m.matches, '') AS matches
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM seq GROUP BY doc_id) n USING (doc_id) LEFT JOIN names USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(span, ',' ORDER BY i) AS matches FROM spans GROUP BY doc_id) m USING (doc_id)
"""
