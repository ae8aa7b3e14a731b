"""License scans by patience alignment of texts with templates.

Words unique in both a stretch of text and the template are anchors; the
longest increasing run of them is kept and the gaps between are aligned in the
same way, after equal words at both ends.  Coverage is the share of the
template's words that are aligned.  A template is tried wherever the text has
enough of its words within one and a half template lengths, from every eighth
of its length on and with as many words more, so every place that could reach
``LEAST`` is in a stretch that is aligned, whatever the template's size.

Templates are the notices below, short forms too, and the full texts in
``license_texts`` (by file name, as Debian's common-licenses has them).  SPDX
tags need no template: every identifier of one is found as it stands.

Every row of the input gives one row.  ``found`` has every template of at least
``LEAST`` and every SPDX identifier, each at its best place; ``best`` is false
where a better one shares words of its place.  ``license`` and its columns are
the best of them (whole ones first, then the longer, the coverage, the name),
else null and coverage 0.  Null and empty texts have none; no rows give no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexfold.llm.common import held

LEAST = 0.8
STEPS = 8  #: a template is aligned from every eighth of its length on
WORD = re.compile(r"[a-z0-9]+")
SPDX = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.I)
IDENTIFIER = re.compile(r"[A-Za-z0-9][A-Za-z0-9.+:-]*")

# fixed values: public license notices
TEMPLATES = {
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "BSD": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
}

# the same notices with their disclaimers
DISCLAIMED = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
TEMPLATES["MIT-full"] = TEMPLATES["MIT"] + """ THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
TEMPLATES["ISC-full"] = TEMPLATES["ISC"] + """ THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
TEMPLATES["BSD-2-Clause-full"] = TEMPLATES["BSD"] + " " + DISCLAIMED
TEMPLATES["BSD-3-Clause-full"] = TEMPLATES["BSD"] + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + DISCLAIMED
TEMPLATES["GPL-2.0"] = TEMPLATES["GPL-3.0"].replace("version 3", "version 2")
TEMPLATES["AGPL-3.0"] = TEMPLATES["GPL-3.0"].replace("GNU General", "GNU Affero General")
TEMPLATES["LGPL-3.0"] = TEMPLATES["GPL-3.0"].replace("GNU General", "GNU Lesser General")
TEMPLATES["LGPL-2.1"] = TEMPLATES["LGPL-3.0"].replace("version 3", "version 2.1").replace("program", "library")
TEMPLATES["MPL-2.0"] = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
TEMPLATES["Unlicense"] = "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
TEMPLATES["Zlib"] = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"
TEMPLATES["CC0-1.0-line"] = "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
LINES = {"BSD": "BSD", "BSD-2-Clause": "BSD 2-Clause", "BSD-3-Clause": "BSD 3-Clause", "ISC": "ISC", "Zlib": "zlib", "MPL-2.0": "Mozilla Public License 2.0", "LGPL-2.1": "GNU Lesser General Public License version 2.1", "LGPL-3.0": "GNU Lesser General Public License version 3", "AGPL-3.0": "GNU Affero General Public License version 3", "GPL-2.0": "GNU General Public License version 2"}
for _k, _v in LINES.items():
    TEMPLATES[f"{_k}-line"] = f"Licensed under the {_v}" + " License" * ("License" not in _v)
for _k, _v in {"BY": "", "BY-SA": "-ShareAlike", "BY-ND": "-NoDerivatives", "BY-NC": "-NonCommercial", "BY-NC-SA": "-NonCommercial-ShareAlike", "BY-NC-ND": "-NonCommercial-NoDerivatives"}.items():
    for _n in ("2.0", "2.5", "3.0", "4.0"):
        TEMPLATES[f"CC-{_k}-{_n}-short"] = f"Licensed under CC {_k} {_n}."
    TEMPLATES[f"CC-{_k}-4.0-line"] = f"This work is licensed under a Creative Commons Attribution{_v} 4.0 International License."


def full_texts() -> dict[str, str]:
    return {f"{p.name[:-4]}-text": p.read_text() for p in sorted(Path(__file__).with_name("license_texts").glob("*.txt"))}


def aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places that patience alignment matches, in order."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        ca, cb = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if cb[w] == 1}
        pairs = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if w in place and ca[w] == 1]
        if not pairs:
            continue
        tops, piles, back = [], [], {}
        for k, (_, j) in enumerate(pairs):  # longest increasing run by patience sorting
            at = bisect_left(tops, j)
            tops[at : at + 1], piles[at : at + 1] = [j], [k]
            back[k] = piles[at - 1] if at else None
        k, run = piles[-1], []
        while k is not None:
            run.append(pairs[k])
            k = back[k]
        edges = [(a0 - 1, b0 - 1), *run[::-1], (a1, b1)]
        out += run
        todo += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def best_match(words: list[str], template: list[str], least: float = LEAST) -> tuple[float, int, int] | None:
    """Best coverage of the template in the text, with the first and last word of the match."""
    need = -int(-least * len(template) // 1)
    vocabulary, heads = set(template), set(template[: len(template) - need + 1])
    step = len(template) // STEPS
    hits = [i for i, w in enumerate(words) if w in vocabulary]
    if len(hits) < need:
        return None
    span, best, done, last = len(template) * 3 // 2 + step, None, -1, None
    for k, start in enumerate(hits[: len(hits) - need + 1]):
        # the need-th hit lies within the span: a match may begin here
        if hits[k + need - 1] - start >= span:
            continue
        if step:
            if last is not None and start < last + step and words[start : start + 3] != template[:3]:
                continue
            last = start
        elif words[start] not in heads:
            continue
        pairs = aligned(words[start : start + span], template)
        if len(pairs) >= need and (best is None or len(pairs) > best[0]):
            best = (len(pairs), start + pairs[0][0], start + pairs[-1][0])
            done = best[2]
        if best and best[0] == len(template) and start > done:
            break
    return best and (best[0] / len(template), best[1], best[2])


def prepared(templates: dict[str, str]) -> list[tuple]:
    """Name, words, distinct words, and how many distinct ones ``LEAST`` needs at least."""
    out = []
    for name, text in sorted(templates.items()):
        words = WORD.findall(text.lower())
        need, distinct = LEAST * len(words), 0
        for _, n in Counter(words).most_common():
            if need <= 1e-9:
                break
            need, distinct = need - n, distinct + 1
        out.append((name, words, frozenset(words), distinct))
    return out


def scan(text: str | None, templates: list[tuple], least: float = LEAST) -> list[tuple]:
    """All that is found, best first: coverage, words of the template, name, first and last word, best at its place."""
    words = WORD.findall((text or "").lower())
    present = set(words)
    found = []
    for name, template, vocabulary, distinct in templates:
        # no alignment covers more than the words that occur at all
        common = present & vocabulary
        if len(common) >= distinct and sum(w in common for w in template) >= least * len(template) and (match := best_match(words, template, least)):
            found.append((match[0], len(template), name, match[1], match[2]))
    text = text or ""
    lower = text.lower()
    starts = [m.start() for m in WORD.finditer(lower)]
    # places of the text in lower case, where letters may be two
    place = None if len(lower) == len(text) else [0, *accumulate(len(c.lower()) for c in text)]
    tags = {}
    for m in SPDX.finditer(text):
        for x in IDENTIFIER.finditer(m[1]):
            if x[0] in tags or x[0].upper() in ("AND", "OR", "WITH"):
                continue
            size, at = len(WORD.findall(x[0].lower())), m.start(1) + x.start()
            at = bisect_left(starts, place[at] if place else at)
            tags[x[0]] = (1.0, size, f"SPDX:{x[0]}", at, at + size - 1)
    found = sorted([*found, *tags.values()], key=lambda f: (f[0] >= 1, f[1], f[0], f[2]), reverse=True)
    return [(*f, alone) for f, alone in zip(found, apart([(f[3], f[4]) for f in found]), strict=True)]


def apart(spans: list[tuple[int, int]]) -> list[bool]:
    """Whether each span meets none before it in the list; what they cover is kept as runs in order."""
    heads, tails, out = [], [], []
    for first, last in spans:
        low, high = bisect_left(tails, first), bisect_right(heads, last)  # the runs that it meets
        out.append(low >= high)
        if low < high:
            first, last = min(first, heads[low]), max(last, tails[high - 1])
        heads[low:high], tails[low:high] = [first], [last]
    return out


def license_scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), templates: dict[str, str] | None = None) -> DataFrame:
    """``keep``, license, coverage, first_word, last_word and found of every row."""
    wanted = prepared(templates or TEMPLATES | full_texts())
    made = [("license", T.StringType()), ("coverage", T.DoubleType()), ("first_word", T.LongType()), ("last_word", T.LongType())]
    each = T.StructType([T.StructField(*x) for x in [*made, ("best", T.BooleanType())]])
    made.append(("found", T.ArrayType(each)))
    kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("best", pa.bool_())]))
    source = docs.select(*held(docs, keep, [n for n, _ in made]), F.col(text).alias("_text"))
    schema = T.StructType([*source.schema.fields[:-1], *[T.StructField(*x) for x in made]])

    def run(batches):
        for batch in batches:
            found = [scan(x, wanted) for x in batch.column("_text").to_pylist()]
            rows = [f[0] if f else (0.0, None, None, None, None) for f in found]
            lists = [[{"license": f[2], "coverage": f[0], "first_word": f[3], "last_word": f[4], "best": f[5]} for f in x] for x in found]
            own = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns = [pa.array([r[c] for r in rows], of) for c, of in ((2, pa.string()), (0, pa.float64()), (3, pa.int64()), (4, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*own, *columns, pa.array(lists, kind)], names=schema.names)

    return source.mapInArrow(run, schema)
