"""License scans: template markup compiled into token automata.

A template is text with ``<<beginOptional>> .. <<endOptional>>`` around wording
that may be missing and ``<<var;name="..";words=0-20>>`` for wording that may be
replaced by so many words of any kind. Everything else is mandatory and has to
stand word for word, wherever in the text. All templates become one automaton
over words: states with a transition for a word, one for any word, and a label
where a template ends. A run starts at every word with which a template can
begin and dies at the first word that no state accepts, so a text is read once.

Words are maximal runs of letters, digits and non-ASCII characters after A-Z
are lower-cased; punctuation and line ends never matter.

Defined results: a null or empty text has no words, no labels and score 0. Every
place counts, overlapping ones too. A template must begin with mandatory wording.
A license whose wording was altered, cut or added to inside loses its label; text
around it does not matter. A sentence that only names a license gets a label of its own.
The score is m / (m + 4), where m is the largest number of words in any match.
Only the id and the text are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases that are labels by themselves.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
    WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name="who";words=1-20>>
    BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
    CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BULLET = '<<var;name="bullet";words=0-1>>'
_BSD_CONDITIONS = f"""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: {_BULLET} Redistributions of source code must retain the above copyright notice, this list of conditions
    and the following disclaimer. {_BULLET} Redistributions in binary form must reproduce the above copyright notice, this list of conditions
    and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = f"""{_BULLET} Neither the name of <<var;name="holder";words=1-20>> nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY <<var;name="who";words=1-20>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
    BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
    <<var;name="who";words=1-20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
    BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED
    AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
    OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GPL_NOTICE = """This <<var;name="kind";words=1-3>> is free software<<beginOptional>>:<<endOptional>> you can redistribute it and/or modify it
    under the terms of the GNU General Public License as published by the Free Software Foundation, either version {version} of the License,
    or (at your option) any later version. This <<var;name="kind";words=1-3>> is distributed in the hope that it will be useful, but WITHOUT
    ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
    License for more details."""
_CC_REFERENCE = """licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>>
    <<beginOptional>>Creative Commons<<endOptional>> CC BY{terms} 4.0"""

#: Whole licenses and standard notices; a label ending in "-reference" is a mention in a sentence.
TEMPLATES = {
    "mit": f"""Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name="what";words=2-12>>
        <<beginOptional>> (the "Software")<<endOptional>>, to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
        and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all
        copies or substantial portions of the Software. {_AS_IS}""",
    "isc": """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose
        with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in
        all copies. THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="who";words=1-20>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
        SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;name="who";words=1-20>> BE
        LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA
        OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-2-clause": f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}",
    "bsd-3-clause": f"{_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_DISCLAIMER}",
    "zlib": f"""This software is provided 'as-is', without any express or implied warranty. In no event will <<var;name="who";words=1-20>>
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for
        any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: {_BULLET} The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
        required. {_BULLET} Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
        software. {_BULLET} This notice may not be removed or altered from any source distribution.""",
    "unlicense": f"""This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial
        or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software
        dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the
        public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment
        in perpetuity of all present and future rights to this software under copyright law. {_AS_IS}""",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at <<var;name="address";words=0-12>> Unless required by applicable law or
        agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "gpl-2.0-or-later-notice": _GPL_NOTICE.format(version="2"),
    "gpl-3.0-or-later-notice": _GPL_NOTICE.format(version="3"),
    "mit-reference": "under the MIT License",
    "apache-2.0-reference": "under the Apache License<<beginOptional>>, Version<<endOptional>> 2.0",
    "gpl-reference": """licensed under the <<beginOptional>>terms of the<<endOptional>> <<beginOptional>>GNU<<endOptional>>
        <<beginOptional>>Lesser<<endOptional>> <<beginOptional>>Affero<<endOptional>> General Public License""",
    "cc-by-4.0-reference": _CC_REFERENCE.format(terms=""),
    "cc-by-sa-4.0-reference": _CC_REFERENCE.format(terms="-SA"),
    "cc-by-nc-4.0-reference": _CC_REFERENCE.format(terms="-NC"),
    "cc-by-nd-4.0-reference": _CC_REFERENCE.format(terms="-ND"),
    "cc-by-nc-sa-4.0-reference": _CC_REFERENCE.format(terms="-NC-SA"),
    "cc-by-nc-nd-4.0-reference": _CC_REFERENCE.format(terms="-NC-ND"),
}

_SEPARATORS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()  # bytes.lower: A-Z only
_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")
_SPAN = re.compile(r"words=(\d+)-(\d+)")


def words(text: bytes) -> list[bytes]:
    return text.translate(_SEPARATORS).split()


@dataclass
class Automaton:
    """``step[s]``: word to states; ``any_[s]``: states after any word; ``ends[s]``: labels."""

    step: list[dict[bytes, tuple[int, ...]]] = field(default_factory=list)
    any_: list[tuple[int, ...]] = field(default_factory=list)
    ends: list[tuple[str, ...]] = field(default_factory=list)
    first: dict[bytes, tuple[int, ...]] = field(default_factory=dict)

    def run(self, tokens: list[bytes], at: int) -> dict[str, int]:
        """Labels of the templates that match from ``at``, with the length of the longest match."""
        states, found, i = self.first.get(tokens[at], ()), {}, at + 1
        while states:
            for s in states:
                for label in self.ends[s]:
                    found[label] = i - at
            if i == len(tokens):
                break
            nearby: set[int] = set()
            for s in states:
                nearby.update(self.step[s].get(tokens[i], ()))
                nearby.update(self.any_[s])
            states, i = tuple(nearby), i + 1
        return found


def compile_templates(templates: dict[str, str]) -> Automaton:
    moves: list[dict[bytes, set[int]]] = []
    wild: list[set[int]] = []
    free: list[set[int]] = []  # moves without a word
    ends: dict[int, str] = {}

    def state() -> int:
        moves.append(defaultdict(set))
        wild.append(set())
        free.append(set())
        return len(moves) - 1

    begin = state()
    for label, template in templates.items():
        at, opened = state(), []
        free[begin].add(at)
        pieces = _MARK.split(template)
        for k, piece in enumerate(pieces):
            if k % 2 == 0:
                for word in words(piece.encode()):
                    moves[at][word].add(after := state())
                    at = after
            elif piece == "beginOptional":
                opened.append(at)
            elif piece == "endOptional":
                after = state()
                free[at].add(after)
                free[opened.pop()].add(after)
                at = after
            else:
                least, most = map(int, _SPAN.search(piece).groups())
                passed = [at]
                for _ in range(most):
                    wild[passed[-1]].add(after := state())
                    passed.append(after)
                at = state()
                for p in passed[least:]:
                    free[p].add(at)
        if opened:
            raise ValueError(f"an optional region of {label} does not end")
        ends[at] = label

    def closure(start: set[int]) -> set[int]:
        seen, todo = set(start), list(start)
        while todo:
            for s in free[todo.pop()] - seen:
                seen.add(s)
                todo.append(s)
        return seen

    out = Automaton()
    for s in range(len(moves)):
        around = closure({s})
        step: dict[bytes, set[int]] = defaultdict(set)
        for r in around:
            for word, to in moves[r].items():
                step[word] |= to
        out.step.append({word: tuple(sorted(to)) for word, to in step.items()})
        out.any_.append(tuple(sorted(set().union(*(wild[r] for r in around)))))
        out.ends.append(tuple(sorted(ends[r] for r in around if r in ends)))
    if out.any_[begin] or out.ends[begin]:
        raise ValueError("a template must begin with mandatory wording")
    out.first = out.step[begin]
    return out


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, base: dict[str, str] | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and ``SCHEMA``."""
    base = BASE if base is None else base
    machine = compile_templates(base | (TEMPLATES if templates is None else templates))
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))

    def one(text: bytes) -> tuple:
        tokens = words(text)
        places, labels, most = [], set(), 0
        for at in [i for i, word in enumerate(tokens) if word in machine.first]:
            for label, length in machine.run(tokens, at).items():
                labels.add(label)
                most = max(most, length)
                if label in base:
                    places.append(at)
        first, last = (places[0], places[-1]) if places else (None, None)
        return (len(tokens), len(places), first, last, ",".join(sorted(labels & base.keys())),
                ",".join(sorted(labels)), most / (most + 4))

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        for batch in batches:
            found = list(zip(*(one(t.as_py()) for t in batch.column(1)), strict=True)) or [()] * 7
            columns = [pa.array(c, t) for c, t in zip(found, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, *(x.split()[0] for x in SCHEMA.split(", "))])

    return rows.mapInArrow(scan_batches, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {SCHEMA}")
