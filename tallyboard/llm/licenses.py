"""License scan: base phrases, and license templates compiled into token automata.

A template is text with markup. ``<<beginOptional>>`` to ``<<endOptional>>`` may be left
out, ``<<var n>>`` stands for up to n words of any kind, every other word is mandatory.
Texts and templates are compared by words, so case, punctuation and layout do not
matter. A template is accepted where its automaton gets from its first word to its end
over consecutive words of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import utf8

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of common notices and licenses, with markup.
TEMPLATES = {
    "apache-2.0-notice": "licensed under the Apache License <<beginOptional>>, Version 2.0<<endOptional>> <<beginOptional>>(the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at<<endOptional>>",
    "cc-by-4.0-notice": "licensed under <<beginOptional>>a Creative Commons Attribution <<var 4>> license<<endOptional>> CC BY 4.0",
    "cc-by-nc-4.0-notice": "licensed under <<beginOptional>>the<<endOptional>> CC BY-NC 4.0",
    "cc-by-sa-4.0-notice": "licensed under <<beginOptional>>the<<endOptional>> CC BY-SA 4.0",
    "gpl-2.0-notice": "licensed under the GNU General Public License <<beginOptional>>as published by the Free Software Foundation<<endOptional>>, version 2",
    "gpl-3.0-notice": "licensed under the GNU General Public License <<beginOptional>>as published by the Free Software Foundation<<endOptional>>, version 3",
    "mit-notice": "<<beginOptional>>This work is<<endOptional>> released under the <<beginOptional>>terms of the<<endOptional>> MIT License",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at <<beginOptional>>http<<endOptional>> <<beginOptional>>https<<endOptional>> www.apache.org/licenses/LICENSE-2.0 <<beginOptional>>.html<<endOptional>> Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "apache-2.0-title": "Apache License Version 2.0, January 2004 <<beginOptional>>http://www.apache.org/licenses/<<endOptional>> <<beginOptional>>https://www.apache.org/licenses/<<endOptional>> TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "bsd-2-clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY <<var 12>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var 12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "bsd-3-clause-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. <<beginOptional>>3.<<endOptional>> Neither the name of <<var 12>> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY <<var 12>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var 12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "gpl-header": "This program is free software <<beginOptional>>: you can<<endOptional>> <<beginOptional>>; you can<<endOptional>> redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation <<beginOptional>>, either<<endOptional>> <<beginOptional>>; either<<endOptional>> version <<var 2>> of the License, or <<beginOptional>>(at your option)<<endOptional>> any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. <<beginOptional>>You should have received a copy of the GNU General Public License along with this program<<endOptional>>",
    "isc-text": "Permission to use, copy, modify, and <<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND <<var 12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var 12>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "lgpl-header": "This library is free software <<beginOptional>>: you can<<endOptional>> <<beginOptional>>; you can<<endOptional>> redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version <<var 2>> of the License, or <<beginOptional>>(at your option)<<endOptional>> any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var 6>> and associated documentation files (the <<var 2>>), to deal in the <<var 2>> without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the <<var 2>>, and to permit persons to whom the <<var 2>> is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the <<var 2>>. THE <<var 2>> IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var 12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE <<var 2>> OR THE USE OR OTHER DEALINGS IN THE <<var 2>>.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at <<beginOptional>>http<<endOptional>> <<beginOptional>>https<<endOptional>> mozilla.org/MPL/2.0/",
    "spdx-tag": "SPDX-License-Identifier: <<var 1>>",
}

SPDX_TAG = "spdx-tag"
"""The template whose label gives way to the identifiers that follow its words."""
_ID = rb"[A-Za-z0-9][A-Za-z0-9.+-]*"
_SPDX = re.compile(rb"(?i:SPDX-License-Identifier):[ \t]*(\(*" + _ID + rb"\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*" + _ID + rb"\)*)*)")

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes(c if c >= 0x80 or c in _KEEP else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_MARK = re.compile(r"<<(beginOptional|endOptional|var (\d+))>>")


def words_of(text: bytes) -> list[bytes]:
    """Words of letters, digits and non-ASCII bytes, A-Z lower-cased."""
    return text.translate(_TABLE).split()


@dataclass
class Automaton:
    """States with at most one word or any-word step each, and free steps; made deterministic as it runs."""

    word: dict[int, tuple[bytes, int]] = field(default_factory=dict)
    any: dict[int, int] = field(default_factory=dict)
    free: dict[int, list[int]] = field(default_factory=dict)
    size: int = 1
    anchor: list[bytes] = field(default_factory=list)
    known: dict[tuple[frozenset, bytes], frozenset] = field(default_factory=dict)

    def step(self) -> int:
        self.size += 1
        return self.size - 1

    def closed(self, states: set[int]) -> frozenset:
        todo = list(states)
        while todo:
            for t in self.free.get(todo.pop(), ()):
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return frozenset(states)

    def match(self, words: Sequence[bytes], at: int) -> int | None:
        """Where the longest match that starts at word ``at`` ends."""
        now, end, found = self.closed({0}), self.size - 1, None
        while now:
            if end in now:
                found = at
            if at >= len(words):
                break
            w = words[at]
            later = self.known.get((now, w))
            if later is None:
                reached = {self.word[s][1] for s in now if s in self.word and self.word[s][0] == w}
                reached |= {self.any[s] for s in now if s in self.any}
                later = self.closed(reached)
                if len(self.known) < 20_000:
                    self.known[now, w] = later
            now, at = later, at + 1
        return found


def compile_template(template: str) -> Automaton:
    """Regions before the first mandatory word are left out: they change nothing about where a text matches."""
    machine, last, opened, begun, place = Automaton(), 0, [], False, 0
    pieces = [(m.start(), m.end(), m.group(1), m.group(2)) for m in _MARK.finditer(template)]
    for start, end, mark, most in [*pieces, (len(template), len(template), "", None)]:
        for w in words_of(template[place:start].encode()):
            if not begun and opened:
                continue
            begun = True
            ahead = machine.step()
            machine.word[last], last = (w, ahead), ahead
            if not opened and len(machine.anchor) == machine.size - 2:
                machine.anchor.append(w)
        if mark == "beginOptional":
            opened.append(last)
        elif mark == "endOptional":
            back = opened.pop()
            if not begun:
                place = end
                continue
            ahead = machine.step()
            machine.free.setdefault(last, []).append(ahead)
            machine.free.setdefault(back, []).append(ahead)
            last = ahead
        elif most and begun:
            first = [last]
            for _ in range(int(most)):
                machine.any[last] = last = machine.step()
                first.append(last)
            ahead = machine.step()
            for s in first:
                machine.free.setdefault(s, []).append(ahead)
            last = ahead
        place = end
    if opened or not begun:
        raise ValueError(f"template without mandatory words or with an open region: {template[:60]}")
    return machine


def _places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Word positions of a phrase in words joined, led and followed by single spaces."""
    needle, at, seen, word = b" " + phrase + b" ", -1, 0, -1
    while (at := joined.find(needle, at + 1)) >= 0:
        word += joined.count(b" ", seen, at + 1)
        seen = at + 1
        yield word


def identifiers(text: bytes) -> set[str]:
    """Licenses and exceptions that the SPDX tags of a text name."""
    found = {i for e in _SPDX.findall(text) for i in re.findall(_ID, e)} - {b"AND", b"OR", b"WITH"}
    return {i.rstrip(b".").decode() for i in found}


class Scanner:
    """Base phrases and compiled templates over one text at a time."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [(b" ".join(words_of(p.encode())), label) for p, label in phrases.items()]
        self.machines = {label: compile_template(t) for label, t in templates.items()}

    def scan(self, text: bytes) -> tuple[int, int, int | None, int | None, list[str], list[str], list[tuple[str, int, int]]]:
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        found = [(at, label) for phrase, label in self.phrases for at in _places(joined, phrase)]
        spans = []
        for label, machine in self.machines.items():
            for at in _places(joined, b" ".join(machine.anchor)):
                if (end := machine.match(words, at)) is not None:
                    spans.append((label, at, end))
        base = sorted({label for _, label in found})
        named = {label for label, _, _ in spans}
        if SPDX_TAG in named and (tagged := identifiers(text)):
            named = named - {SPDX_TAG} | tagged
        starts = [at for at, _ in found]
        return len(words), len(found), min(starts, default=None), max(starts, default=None), base, sorted({*base, *named}), spans


_COLUMNS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first:long,end:long>>"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
     ("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())])))]
)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs`` with words, phrase places, labels, score and template spans.

    Null text counts as empty. Score: 1 where a template is accepted, 0.5 where only a
    phrase occurs, else 0. Labels are empty text where there are none; an SPDX tag's label is the
    identifiers it names. Rows are
    independent, so repeated rows repeat and an empty table gives an empty result.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, templates)
        for batch in batches:
            rows = []
            for i, body in zip(batch.column("id").to_pylist(), batch.column("body")):
                n, n_base, first, last, base, labels, spans = scanner.scan(body.as_py())
                rows.append((i, n, n_base, first, last, ",".join(base), ",".join(labels), 1.0 if spans else 0.5 if base else 0.0, [dict(zip(("label", "first", "end"), s)) for s in spans]))
            yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r)) for r in rows], schema=_ARROW)

    return docs.select(F.col(doc_id).cast("long").alias("id"), utf8(F.col(text)).alias("body")).mapInArrow(scan, _COLUMNS)
