"""License scan by template-markup matching.

A template is mandatory wording with marked regions: ``[[...]]`` is optional, ``{{name:lo-hi}}`` stands for any lo to hi words. It is
compiled to a token automaton; a text has the license if the automaton accepts some run of its words, so all mandatory wording stands
there exactly and in order. Automata run as sets of live positions from each place where a template's first word stands, so a text
costs its length plus its anchors. Base labels come from fixed phrases and always stay; the method adds the labels of accepted templates.

Each text is handled alone and as a whole, with no shuffle; memory follows the longest text. Null and empty texts have no words, no labels and score 0; repeated
rows are judged alike, each on its own; of several runs that a template accepts any will do; an empty table gives an empty result, and further columns of
any name don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_type, words

#: Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: The wording of well-known licenses and notices, as marked templates. Case and punctuation don't count.
_BSD_GRANT = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met [[1]] redistributions of source code "
    "must retain the above copyright notice this list of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
)
_BSD_NAMES = "[[3]] neither the name of {{holder:1-12}} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission "
_BSD_DISCLAIMER = (
    "this software is provided by {{who:1-10}} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular "
    "purpose are disclaimed in no event shall {{who:1-10}} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of "
    "substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including "
    "negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
)
_ISC_GRANT = "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
_ISC_DISCLAIMER = (
    "the software is provided as is and {{who:1-8}} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall "
    "{{who:1-8}} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract "
    "negligence or other tortious action arising out of or in connection with the use or performance of this software"
)
TEMPLATES = (
    ("mit", "[[this work is]] released under the [[terms of the]] mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of {{what:1-12}} to deal in the {{what:1-3}} without restriction"),
    (
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of {{what:1-12}} to deal in the {{what:1-3}} without restriction including without limitation the rights to "
        "use copy modify merge publish distribute sublicense and or sell copies of the {{what:1-3}} and to permit persons to whom the {{what:1-3}} is furnished to do so subject to the following "
        "conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the {{what:1-3}} the {{what:1-3}} "
        "is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in "
        "no event shall the {{holders:1-8}} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the "
        "{{what:1-3}} or the use or other dealings in the {{what:1-3}}",
    ),
    ("apache-2.0", "licensed under the apache license [[version]] 2 0 [[the license]]"),
    (
        "apache-2.0-notice",
        "licensed under the apache license version 2 0 the license you may not use {{what:1-4}} except in compliance with the license you may obtain a copy of the license at "
        "[[http]] [[https]] [[www apache org licenses license 2 0]] unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    ("gpl-3.0", "licensed under the gnu general public license [[as published by the free software foundation either]] version 3 [[of the license]]"),
    ("gpl-2.0", "licensed under the gnu general public license [[as published by the free software foundation either]] version 2 [[of the license]]"),
    (
        "gpl-notice",
        "{{what:1-3}} is free software you can redistribute it and or modify it under the terms of the gnu [[lesser]] [[affero]] general public license as published by the free software foundation "
        "[[either]] version {{number:1-2}} of the license [[or at your option any later version]] {{what:1-3}} is distributed in the hope that it will be useful but without any warranty without even "
        "the implied warranty of merchantability or fitness for a particular purpose see the gnu [[lesser]] [[affero]] general public license for more details",
    ),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-2-clause", _BSD_GRANT + _BSD_DISCLAIMER),
    ("bsd-3-clause", _BSD_GRANT + _BSD_NAMES + _BSD_DISCLAIMER),
    ("isc", _ISC_GRANT.strip()),
    ("isc-text", _ISC_GRANT + "provided that the above copyright notice and this permission notice appear in all copies " + _ISC_DISCLAIMER),
    ("0bsd", _ISC_GRANT + _ISC_DISCLAIMER),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the {{authors:1-4}} be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions "
        "[[1]] the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product "
        "documentation would be appreciated but is not required [[2]] altered source versions must be plainly marked as such and must not be misrepresented as being the original software [[3]] this "
        "notice may not be removed or altered from any source distribution",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a "
        "compiled binary for any purpose commercial or non commercial and by any means",
    ),
    ("cc-by-nc-4.0", "licensed under [[a]] [[the]] [[creative commons]] {{cc:0-1}} by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under [[a]] [[the]] [[creative commons]] {{cc:0-1}} by sa 4 0"),
    ("cc-by-4.0", "licensed under [[a]] [[the]] [[creative commons]] {{cc:0-1}} by 4 0"),
    ("proprietary", "all rights reserved [[do not]] {{what:0-4}} without [[prior]] [[written]] permission"),
    ("proprietary", "copyright {{holder:0-6}} all rights reserved"),
)

_PART = re.compile(r"\[\[(.*?)\]\]|\{\{\w+:(\d+)-(\d+)\}\}|([^\[{]+)")


class TokenAutomaton:
    """Positions 0 to end; step[p]: (word or None for any, next position); skip[p]: positions reached without a word."""

    def __init__(self, label: str, template: str):
        self.label = label
        self.step: list[list[tuple[bytes | None, int]]] = [[]]
        skip: list[list[int]] = [[]]

        def add(word: bytes | None) -> None:
            self.step[-1].append((word, len(self.step)))
            self.step.append([])
            skip.append([])

        self.mandatory = 0
        for optional, low, high, plain in _PART.findall(template):
            begin = len(self.step) - 1
            if low:
                for k in range(int(high)):
                    add(None)
                for k in range(int(low), int(high)):
                    skip[begin + k].append(begin + int(high))
            else:
                for w in words(optional or plain):
                    add(w)
                    self.mandatory += not optional
                if optional:
                    skip[begin].append(len(self.step) - 1)
        self.end = len(self.step) - 1
        self.closed = []
        for p in range(len(self.step)):
            seen, todo = {p}, [p]
            while todo:
                for q in skip[todo.pop()]:
                    if q not in seen:
                        seen.add(q)
                        todo.append(q)
            self.closed.append(frozenset(seen))
        self.first = {w for p in self.closed[0] for w, _ in self.step[p]}
        #: The first mandatory word, and how many words can stand before it.
        lead = next((p for p, s in enumerate(self.step) if s and s[0][0] is not None), 0)
        self.first_fixed, self.reach = {w for q in self.closed[lead] for w, _ in self.step[q]}, lead
        #: A mandatory word, the longest, that a text must hold.
        self.key = max(words(re.sub(r"\[\[.*?\]\]|\{\{.*?\}\}", " ", template)), key=len)

    def run(self, tokens: Sequence[bytes], at: int) -> tuple[bool, float]:
        """Whether a run of words from ``at`` on is accepted, and the furthest position reached as a share."""
        live, best = self.closed[0], 0
        for i in range(at, len(tokens) + 1):
            if self.end in live:
                return True, 1.0
            best = max(best, max(live))
            if i == len(tokens):
                break
            w = tokens[i]
            live = frozenset().union(*(self.closed[q] for p in live for x, q in self.step[p] if x is None or x == w))
            if not live:
                break
        return False, best / self.end


def scan(text: str | None, phrases, templates: Sequence[TokenAutomaton]) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    tokens = words(text)
    there = set(tokens)
    places, base = [], set()
    for phrase, label in phrases:
        own, at = words(phrase), -1
        if not own or not there.issuperset(own):
            continue
        for _ in range(tokens.count(own[0])):
            at = tokens.index(own[0], at + 1)
            if tokens[at : at + len(own)] == own:
                places.append(at)
                base.add(label)
    labels, score = set(base), 1.0 if base else 0.0
    for t in templates:
        if t.key not in there:
            continue
        if None in t.first:
            # Any word may begin it, so the run begins at most ``reach`` words before the first fixed word.
            anchors = sorted({j for i, w in enumerate(tokens) if w in t.first_fixed for j in range(max(0, i - t.reach), i + 1)})
        else:
            anchors = [i for i, w in enumerate(tokens) if w in t.first]
        for i in anchors:
            whole, share = t.run(tokens, i)
            score = max(score, share)
            if whole:
                labels.add(t.label)
                break
    return len(tokens), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 6)


SCHEMA = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def license_scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key`` and the columns of SCHEMA. Labels are distinct, sorted and comma-joined, empty if there are none.

    score: 1 with a base phrase or an accepted template, else the largest share of a template that a run of the text's words gets through.
    """
    kind = dict(docs.dtypes)[key]
    automata = [TokenAutomaton(label, t) for label, t in templates]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = [key, *(x.split()[0] for x in SCHEMA.split(", "))]

    def run(batches):
        for batch in batches:
            cols = list(zip(*(scan(v.as_py(), phrases, automata) for v in batch[1]), strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([batch[0].cast(batch_type(kind)), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, f"{key} {kind}, {SCHEMA}")
