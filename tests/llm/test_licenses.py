import re

import pytest

from silverlane.llm.licenses import PHRASES, TEMPLATES, Automaton, scan_licenses
from silverlane.llm.queries import QUERIES
from tests.llm.helpers import LOWER, documents, empty, odd_texts

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_places(text):
    w = WORD.findall((text or "").encode().translate(LOWER))
    out = []
    for phrase, label in PHRASES.items():
        p = phrase.encode().split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return len(w), out


def test_base_columns_on_the_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op5_licenses"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, places = plain_places(texts[r.doc_id])
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_markup(spark):
    template = [("t", "alpha beta <<optional>>gamma <<optional>>delta<</optional>><</optional>> omega <<any 2>> end")]
    texts = ["Alpha, BETA omega end", "alpha beta gamma omega x end", "alpha beta gamma delta omega x y end",
             "alpha beta delta omega end", "alpha beta omega x y z end", "so alpha beta alpha beta omega end x", *odd_texts()]
    rows = scan_licenses(documents(spark, texts), "doc_id", "text", {}, template).collect()
    whole = {r.doc_id: [(m.start, m.n_words) for m in r.matches if m.kind == "template"] for r in rows}
    assert {d: m for d, m in whole.items() if m} == {0: [(0, 4)], 1: [(0, 6)], 2: [(0, 8)], 5: [(3, 4)]}
    assert all(m.share < 1 for r in rows for m in r.matches if m.kind == "partial")


def test_bad_markup():
    for text in ("<<optional>>a<</optional>> b c", "a b <<optional>>c"):
        with pytest.raises(ValueError):
            Automaton("x", text)


def test_notices_and_odd_texts(spark):
    texts = ["Licensed under CC BY-NC 4.0.", "THE MIT-LICENSE mit license", "mit licenses", *odd_texts()]
    df = documents(spark, texts)
    rows = {r.doc_id: {(m.kind, m.label) for m in r.matches} for r in scan_licenses(df, "doc_id", "text").collect()}
    assert ("template", "cc-by-nc") in rows[0] and ("phrase", "mit") in rows[1] and not rows[2]
    assert not any(rows[d] for d in range(3, len(texts)))
    assert scan_licenses(empty(spark, df), "doc_id", "text").collect() == []


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS
IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. """
BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission. """
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""


def test_whole_licenses_match_to_their_end_only(spark):
    """Accepted as they stand and with other holders; an altered or shortened license is never accepted, and partial if
    the change comes past the middle."""
    good = {"mit": [MIT, "Copyright 2020 X\n" + MIT.replace("THE AUTHORS", "THE GOOD PEOPLE OF X")], "isc": [ISC],
            "bsd": [BSD_HEAD + BSD_TAIL, BSD_HEAD + BSD_NAMES + BSD_TAIL, BSD_HEAD.replace("1.", "*").replace("2.", "*") + BSD_TAIL]}
    late = {"mit": [MIT[:-10], MIT.replace("ANY KIND", "SOME KIND")], "isc": [ISC.replace("SPECIAL, ", "")],
            "bsd": [BSD_HEAD + BSD_TAIL.replace("ARE DISCLAIMED", "ARE GIVEN")]}
    early = {"mit": [MIT.replace("sublicense", "rent")],
             "bsd": [BSD_HEAD + BSD_NAMES, BSD_HEAD + BSD_NAMES.replace("may be", "must be") + BSD_TAIL]}
    texts, want = [], []
    for kind, cases in (("template", good), ("partial", late), (None, early)):
        for label, license_texts in cases.items():
            texts += license_texts
            want += [[(kind, label)] if kind else []] * len(license_texts)
    rows = {r.doc_id: r.matches for r in scan_licenses(documents(spark, texts), "doc_id", "text").collect()}
    assert [[(m.kind, m.label) for m in rows[i]] for i in range(len(texts))] == want
    assert all((m.share == 1) == (m.kind == "template") for i in rows for m in rows[i])
    assert rows[0][0].n_words == len(WORD.findall(MIT.lower().encode()))


def pattern_of(template):
    """The template as one regular expression over words that each end in a blank."""
    out = ""
    for mark, word in re.findall(r"<<(/?optional|any \d+)>>|([0-9a-z]+)", template):
        if word:
            out += word + " "
        elif mark.startswith("any"):
            out += r"(?:\S+ ){0,%s}" % mark.split()[1]
        else:
            out += "(?:" if mark == "optional" else ")?"
    return re.compile(r"(?<!\S)" + out)


def test_templates_against_regular_expressions(spark, sf_dir):
    """Every template at every place of the documents, whole licenses planted in some: equal to a plain search."""
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    planted = [MIT, BSD_HEAD + BSD_NAMES + BSD_TAIL, ISC]
    texts = [f"{t} {planted[i % 3]} {t}" if t and i % 20 == 0 else t for i, t in enumerate(texts)] + odd_texts()
    got = {r.doc_id: sorted({(m.label, m.start) for m in r.matches if m.kind == "template"})
           for r in scan_licenses(documents(spark, texts), "doc_id", "text").collect()}
    patterns = [(label, pattern_of(template)) for label, template in TEMPLATES]
    hits = 0
    for i, text in enumerate(texts):
        line = "".join(w.decode("utf-8", "replace") + " " for w in WORD.findall((text or "").encode().translate(LOWER)))
        want = sorted({(label, line[: m.start()].count(" ")) for label, p in patterns for m in p.finditer(line)})
        assert got[i] == want
        hits += len(want)
    assert hits >= len(texts) // 20
