"""License scans by template-markup matching.

A template is license wording with two kinds of markup: ``<<optional>> ... <</optional>>`` around words that may be
missing, and ``<<any N>>`` for a replaceable region of up to N words. It is compiled to an automaton over words. A text
is accepted from some place on if all wording outside the markup follows exactly, whatever the case and punctuation.
Besides templates, plain phrases are looked up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlane.llm import words as W
from silverlane.llm.common import small_batches

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Whole wording of short public licenses, the copyright grant of Apache 2.0, and the notices that
# licenses ask for or that stand for them, label first.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files <<any 3>> to deal in the software without restriction including without "
            "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the "
            "software and to permit persons to whom the software is furnished to do so subject to the following "
            "conditions <<any 1>> the above copyright notice and this permission notice <<optional>>including the "
            "next paragraph<</optional>> shall be included in all copies or substantial portions of the software "
            "the software is provided as is without warranty of any kind express or implied including but not limited "
            "to the warranties of merchantability fitness for a particular purpose and noninfringement in no event "
            "shall <<any 12>> be liable for any claim damages or other liability whether in an action of contract tort "
            "or otherwise arising from out of or in connection with the software or the use or other dealings in the "
            "software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met <<any 1>> redistributions of source code must retain the above "
            "copyright notice this list of conditions and the following disclaimer <<any 1>> redistributions in binary "
            "form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
            "documentation and or other materials provided with the distribution <<optional>><<any 1>> neither the name "
            "of <<any 12>> nor the names of <<any 2>> contributors may be used to endorse or promote products derived "
            "from this software without specific prior written permission<</optional>> this software is provided by "
            "<<any 12>> as is and any express or implied warranties including but not limited to the implied warranties "
            "of merchantability and fitness for a particular purpose are disclaimed in no event shall <<any 12>> be "
            "liable for any direct indirect incidental special exemplary or consequential damages including but not "
            "limited to procurement of substitute goods or services loss of use data or profits or business "
            "interruption however caused and on any theory of liability whether in contract strict liability or tort "
            "including negligence or otherwise arising in any way out of the use of this software even if advised of "
            "the possibility of such damage"),
    ("isc", "permission to use copy modify and <<optional>>or<</optional>> distribute this software for any purpose "
            "with or without fee is hereby granted provided that the above copyright notice and this permission notice "
            "appear in all copies the software is provided as is and <<any 6>> disclaims all warranties with regard to "
            "this software including all implied warranties of merchantability and fitness in no event shall <<any 6>> "
            "be liable for any special direct indirect or consequential damages or any damages whatsoever resulting "
            "from loss of use data or profits whether in an action of contract negligence or other tortious action "
            "arising out of or in connection with the use or performance of this software"),
    ("apache", "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual "
               "worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare "
               "derivative works of publicly display publicly perform sublicense and distribute the work and such "
               "derivative works in source or object form"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in "
               "compliance with the license you may obtain a copy of the license at <<any 1>> www apache org licenses "
               "license 2 0 unless required by applicable law or agreed to in writing <<optional>>software<</optional>> "
               "distributed under the license is distributed on an as is basis without warranties or conditions of any "
               "kind either express or implied see the license for the specific language governing permissions and "
               "limitations under the license"),
    ("gpl", "is free software you can redistribute it and or modify it under the terms of the gnu "
            "<<optional>>lesser<</optional>> <<optional>>affero<</optional>> general public license as published by "
            "the free software foundation either version <<any 2>> of the license <<optional>>or at your option any "
            "later version<</optional>> <<any 6>> is distributed in the hope that it will be useful but without any "
            "warranty without even the implied warranty of merchantability or fitness for a particular purpose see the "
            "gnu <<optional>>lesser<</optional>> <<optional>>affero<</optional>> general public license for more details"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("apache", "licensed under the apache license version 2 0 <<optional>>the license you may not use this file "
               "except in compliance with the license<</optional>>"),
    ("gpl", "is free software you can redistribute it and or modify it under the terms of the gnu "
            "<<optional>>lesser<</optional>> <<optional>>affero<</optional>> general public license as published by "
            "the free software foundation"),
    ("gpl", "licensed under the <<optional>>terms of the<</optional>> gnu <<optional>>lesser<</optional>> "
            "<<optional>>affero<</optional>> general public license <<optional>>version 3<</optional>>"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under <<optional>>a<</optional>> cc by nc <<optional>>4 0<</optional>>"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial <<any 3>> license"),
    ("cc-by", "licensed under a creative commons attribution <<any 2>> license"),
)
PARTIAL = 0.5

_MARK = re.compile(r"<<(/?optional|any \d+)>>|([0-9a-z\x80-\U0010ffff]+)")
MATCH = "struct<kind:string, label:string, start:bigint, n_words:bigint, share:double>"


class Automaton:
    """States are places in the wording; state i reads word i or passes by the markup found there."""

    def __init__(self, label: str, template: str):
        self.label = label
        self.steps: list[tuple[str, object]] = []
        open_at: list[int] = []
        for mark, word in _MARK.findall(template.lower()):
            if word:
                self.steps.append(("word", word.encode()))
            elif mark == "optional":
                open_at.append(len(self.steps))
                self.steps.append(("skip", None))
            elif mark == "/optional":
                begin = open_at.pop()
                self.steps[begin] = ("skip", len(self.steps))
            else:
                self.steps.extend([("any", None)] * int(mark.split()[1]))
        if open_at:
            raise ValueError(f"optional region left open in {template[:40]!r}")
        if [kind for kind, _ in self.steps[:2]] != ["word", "word"]:
            raise ValueError("a template starts with two fixed words")
        inside, self.must = 0, [0]
        ends = [to for kind, to in self.steps if kind == "skip"]
        for i, (kind, _) in enumerate(self.steps):
            inside += (kind == "skip") - ends.count(i)
            self.must.append(self.must[-1] + (kind == "word" and inside == 0))

    def vocabulary(self) -> list[bytes]:
        return [word for kind, word in self.steps if kind == "word"]

    def bind(self, ids: dict[bytes, int]) -> None:
        self.read = [ids[x] if kind == "word" else -1 for kind, x in self.steps]

    def _spread(self, states: set[int]) -> set[int]:
        pending, seen = list(states), set(states)
        while pending:
            at = pending.pop()
            if at < len(self.steps) and self.steps[at][0] != "word":
                for to in (at + 1,) if self.steps[at][0] == "any" else (at + 1, self.steps[at][1]):
                    if to not in seen:
                        seen.add(to)
                        pending.append(to)
        return seen

    def run(self, ids: np.ndarray, at: int, end: int) -> tuple[int, float]:
        """Words of the longest accepted run from ``at`` (0: none) and the share of fixed wording reached."""
        states, accepted, furthest, place = {0}, 0, 0, at
        while states:
            states = self._spread(states)
            furthest = max(furthest, *states)
            if len(self.steps) in states:
                accepted = place - at
            if place >= end:
                break
            word = int(ids[place])
            states = {
                s + 1 for s in states if s < len(self.steps)
                and (self.steps[s][0] == "any" or self.steps[s][0] == "word" and self.read[s] == word)
            }
            place += 1
        return accepted, self.must[furthest] / self.must[-1]


def scan_licenses(
    df: DataFrame, key: str, text: str, phrases: dict[str, str] | None = None, templates=None
) -> DataFrame:
    """(key, n_words, matches) for each row: every place of a phrase (kind ``phrase``), every accepted template
    (``template``), and the furthest template reached at least by half (``partial``, share below 1).

    Null and empty texts have no words and no matches. Rows are independent: repeated rows repeat their result, other
    columns are ignored, an empty table gives an empty result.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    key_type = df.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [Automaton(label, template) for label, template in templates]
        wordings = [(tuple(p.encode() for p in phrase.lower().split()), label) for phrase, label in phrases.items()]
        vocabulary = sorted({w for a in automata for w in a.vocabulary()} | {w for p, _ in wordings for w in p})
        hashes = np.array([W.hash_word(w) for w in vocabulary], dtype=np.uint64)
        order = np.argsort(hashes)
        sorted_hashes, ids = hashes[order], {w: i for i, w in enumerate(vocabulary)}
        for a in automata:
            a.bind(ids)
        for batch in batches:
            n_words, matches = np.zeros(batch.num_rows, dtype=np.int64), [[] for _ in range(batch.num_rows)]
            for texts in W.slices(batch.column(1)):
                found = W.split(texts, W.ALPHANUMERIC, W.LOWER)
                n_words[texts.first : texts.first + len(texts.begins) - 1] = np.diff(found.begins)
                near = np.minimum(np.searchsorted(sorted_hashes, found.hashes), len(order) - 1)
                codes = np.where(sorted_hashes[near] == found.hashes, order[near], -1)
                owner = found.text_of()

                def places(wording, codes=codes, owner=owner):
                    at = np.flatnonzero(codes == wording[0])
                    for k, code in enumerate(wording[1:], 1):
                        at = at[at + k < len(codes)]
                        at = at[(codes[at + k] == code) & (owner[at + k] == owner[at])]
                    return at

                for wording, label in wordings:
                    for at in places([ids[w] for w in wording]).tolist():
                        row = int(owner[at])
                        matches[texts.first + row].append(
                            ("phrase", label, at - int(found.begins[row]), len(wording), 1.0)
                        )
                partial: dict[int, tuple] = {}
                for a in automata:
                    for at in places(a.read[:2]).tolist():
                        row = int(owner[at])
                        length, share = a.run(codes, at, int(found.begins[row + 1]))
                        start = at - int(found.begins[row])
                        if length:
                            matches[texts.first + row].append(("template", a.label, start, length, 1.0))
                        elif PARTIAL <= share and share > partial.get(row, (0,) * 5)[4]:
                            partial[row] = ("partial", a.label, start, 0, min(share, 0.99))
                for row, match in partial.items():
                    matches[texts.first + row].append(match)
            names = ("kind", "label", "start", "n_words", "share")
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n_words),
                pa.array([[dict(zip(names, m)) for m in row] for row in matches], type=pa.list_(pa.struct([
                    ("kind", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("n_words", pa.int64()),
                    ("share", pa.float64())]))),
            ], names=[key, "n_words", "matches"])

    small_batches(df.sparkSession)
    return df.select(key, text).mapInArrow(scan, f"`{key}` {key_type}, n_words bigint, matches array<{MATCH}>")


def labels_of(matches, *kinds: str) -> F.Column:
    """Distinct labels of some kinds of match, sorted and joined by commas; empty without any."""
    chosen = F.filter(matches, lambda m: m["kind"].isin(*kinds))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(chosen, lambda m: m["label"]))), ",")
