"""License scans: templates with optional and replaceable regions, compiled to automata over words.

A template is license wording with markup: what stands between ``<<optional>>`` and ``<<end>>`` may be missing, and
``<<any:n>>`` stands for up to n words of any kind, ``<<one:a|b c>>`` for exactly one of some wordings. Everything
else is mandatory. All templates become one automaton; the sets of states that texts reach are remembered with the words
that lead on from them, so that a word is one look-up. A text is accepted by a template where the whole of its wording
stands word for word.

Words of a slice of texts become numbers of the templates' vocabulary at once, and only where two words stand that a
template may begin with is the automaton started; so texts without license wording cost one look-up of each word. A
text is worked on alone and whole, in one pass without a shuffle.

Phrases that name a license are counted besides, wherever they stand.

Results for odd input: a null, empty or blank text has no words, no labels and the score 0; upper and lower case of A to
Z are one, other scripts count as written; equal rows get equal results; wording that is cut off is not accepted; a
null id is kept; no documents give no rows; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shingles import Words, kept, sliced

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Fixed values below: phrases and templates of public licenses, as their publishers word them.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

_RELEASED = "<<optional>>this <<one:work|program|file|software|project|document|text|package|code>> is<<end>><<optional>>also<<end>><<one:licensed|released|distributed|available|published>>"
_AS_IS = 'IS PROVIDED <<optional>>BY <<any:20>><<end>>"AS IS"'
_NO_LIABILITY = (
    "IN NO EVENT SHALL <<any:20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
    "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<any:1>> Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. <<any:1>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_END = (
    f"THIS SOFTWARE {_AS_IS} AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. {_NO_LIABILITY}"
)
_GNU = (
    "This <<one:program|file|library|software|package>> is free software<<one::|;|,>> you can redistribute it and/or modify it under the terms of the GNU <<one:{name}>> as published by the Free Software Foundation<<one:,|;>> either version <<one:{version}>> "
    "<<optional>>of the License<<end>><<optional>>, or (at your option) any later version<<end>>"
)
#: (label, template, whether it is the whole of a license rather than a notice that names one).
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice <<optional>>(including the next paragraph)<<end>> shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
        "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<any:20>> BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
        True,
    ),
    (
        "isc",
        "Permission to use, copy, modify, and<<optional>>/or<<end>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
        "all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND <<any:20>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
        True,
    ),
    ("bsd-2-clause", f"{_BSD} {_BSD_END}", True),
    ("bsd-3-clause", f"{_BSD} <<any:1>> Neither the name of <<any:20>> nor the names of <<optional>>its<<end>><<optional>>any<<end>> contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_BSD_END}", True),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will <<any:10>> be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        True,
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", True),
    ("apache-2.0", f"{_RELEASED} under <<optional>>the terms of<<end>> the Apache License, Version 2.0", False),
    ("apache-1.1", f"{_RELEASED} under <<optional>>the terms of<<end>> the Apache <<optional>>Software<<end>> License, Version 1.1", False),
    ("mit", f"{_RELEASED} under <<optional>>the terms of<<end>> the MIT License", False),
    ("bsd", f"{_RELEASED} under <<optional>>the terms of<<end>> <<one:the|a>> <<optional>><<one:new|modified|simplified|2 clause|3 clause>><<end>> BSD <<optional>><<one:style|2 clause|3 clause>><<end>> License", False),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", False),
    *[(f"gpl-{v}", _GNU.format(name="General Public License", version=v), False) for v in (1, 2, 3)],
    *[(f"lgpl-{v}", _GNU.format(name="Lesser General Public License|Library General Public License", version=v), False) for v in ("2", "2.1", "3")],
    *[(f"agpl-{v}", _GNU.format(name="Affero General Public License", version=v), False) for v in (3,)],
    *[(f"gpl-{v}", f"{_RELEASED} under <<optional>>the terms of<<end>> the GNU General Public License, <<one:version|v>> {v}", False) for v in (1, 2, 3)],
    *[(f"gpl-{v}", f"{_RELEASED} under <<optional>>the terms of<<end>> the GNU General Public License v{v}", False) for v in (1, 2, 3)],
    *[
        (f"{'cc-' + short}-{v}", f"{_RELEASED} under <<optional>>the terms of<<end>> <<optional>><<one:a|the>><<end>> <<one:CC {short.upper()}|Creative Commons {name}>> {v} <<optional>>International<<end>><<optional>>Unported<<end>>", False)
        for short, name in (("by", "Attribution"), ("by-sa", "Attribution ShareAlike"), ("by-nd", "Attribution NoDerivatives"), ("by-nc", "Attribution NonCommercial"), ("by-nc-sa", "Attribution NonCommercial ShareAlike"), ("by-nc-nd", "Attribution NonCommercial NoDerivatives"))
        for v in ("2.0", "3.0", "4.0")
    ],
]

#: Scores of a whole license text, of a notice, and of a phrase alone.
WHOLE, NOTICE, NAMED = 1.0, 0.9, 0.5
MARK = re.compile(r"<<(optional|end|any:\d+|one:[^<>]*)>>")


def words_in(text: str) -> list[str]:
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


def parsed(template: str) -> list:
    """A template as a list of words, ("any", n), ("one", wordings) and ("optional", list)."""
    stack: list[list] = [[]]
    at = 0
    for m in [*MARK.finditer(template), None]:
        stack[-1] += words_in(template[at : m.start() if m else len(template)])
        if not m:
            break
        at = m.end()
        kind, _, rest = m[1].partition(":")
        if kind == "optional":
            stack.append([])
        elif kind == "end":
            region = stack.pop()
            stack[-1].append(("optional", region))
        elif kind == "any":
            stack[-1].append(("any", int(rest)))
        elif any(wordings := [words_in(x) for x in rest.split("|")]):  # punctuation alone is no word
            stack[-1].append(("one", wordings))
    if len(stack) != 1:
        raise ValueError("a region of the template is not closed")
    return stack[0]


def pattern(parts: list, any_word: str = "[^ ]+") -> str:
    """The same template as a regular expression over words with a space behind each."""
    out = ""
    for part in parts:
        if isinstance(part, str):
            out += re.escape(part) + " "
        elif part[0] == "any":
            out += f"(?:{any_word} ){{0,{part[1]}}}"
        elif part[0] == "one":
            out += "(?:" + "|".join("".join(re.escape(w) + " " for w in x) for x in part[1]) + ")"
        else:
            out += f"(?:{pattern(part[1], any_word)})?"
    return out


@dataclass
class Automaton:
    """States are numbers; ``steps`` lead from a state by a word's number (-1: any word), ``free`` without a word; ``accepts`` says which template ends in a state."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    steps: list[dict[int, list[int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    accepts: dict[int, int] = field(default_factory=dict)
    known: dict[tuple[frozenset[int], int], frozenset[int]] = field(default_factory=dict)

    def state(self) -> int:
        self.steps.append({})
        self.free.append([])
        return len(self.steps) - 1

    def add(self, parts: list, at: int) -> int:
        """Lead ``parts`` on from state ``at``; the state where they end."""
        for part in parts:
            if isinstance(part, str):
                end = self.state()
                self.steps[at].setdefault(self.vocabulary.setdefault(part, len(self.vocabulary)), []).append(end)
            elif part[0] == "any":
                end = self.state()
                self.free[at].append(end)
                for _ in range(part[1]):
                    after = self.state()
                    self.steps[at].setdefault(-1, []).append(after)
                    self.free[after].append(end)
                    at = after
            else:
                end = self.state()
                branches = part[1] if part[0] == "one" else [part[1], []]
                for branch in branches:
                    self.free[self.add(branch, at)].append(end)
            at = end
        return at

    def closed(self, states: list[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            new = [s for s in self.free[todo.pop()] if s not in seen]
            seen.update(new)
            todo += new
        return frozenset(seen)

    def after(self, states: frozenset[int], word: int) -> frozenset[int]:
        """The states that a word leads to; -1 is any word that no template has."""
        key = states, word
        if key not in self.known:
            if len(self.known) >= 50_000:
                self.known.clear()
            self.known[key] = self.closed([t for s in states for w in {word, -1} for t in self.steps[s].get(w, ())])
        return self.known[key]

    def begins(self) -> np.ndarray:
        """[a + 1, b + 1]: whether a template may begin with the words a and b (-1: any other)."""
        n = len(self.vocabulary) + 1
        start, out = self.closed([0]), np.zeros((n, n), bool)
        for a in range(-1, n - 1):
            if states := self.after(start, a):
                ends = any(s in self.accepts for s in states)
                out[a + 1] = [ends or bool(self.after(states, b)) for b in range(-1, n - 1)]
        return out


def compiled(templates: list[tuple[str, str, bool]]) -> Automaton:
    auto = Automaton()
    auto.state()
    for k, (_, text, _) in enumerate(templates):
        auto.accepts[auto.add(parsed(text), 0)] = k
    return auto


def matches(auto: Automaton, numbers: np.ndarray, begins: np.ndarray) -> list[tuple[int, int, int]]:
    """(template, start, end) of all accepted wordings of a text, by the numbers of its words; of one start and template the longest."""
    pair = begins[numbers + 1, np.append(numbers[1:], -1) + 1]
    found = []
    first = auto.closed([0])
    for start in np.flatnonzero(pair).tolist():
        states, at, ends = first, start, {}
        while states and at < len(numbers):
            states = auto.after(states, int(numbers[at]))
            at += 1
            for s in states:
                if s in auto.accepts:
                    ends[auto.accepts[s]] = at
        found += [(k, start, end) for k, end in sorted(ends.items())]
    return found


def hashes_of(words: list[str]) -> np.ndarray:
    """What ``Words`` has for single words."""
    return Words(pa.array([w.encode() for w in words], pa.binary()), "alphanumeric").hashes


def _scan(templates: list[tuple[str, str, bool]], phrases: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            auto = compiled(templates)
            names = sorted(auto.vocabulary, key=auto.vocabulary.get)
            hashed = hashes_of(names)
            by = np.argsort(hashed)
            return auto, auto.begins(), hashed[by], by, [(label, hashes_of(words_in(phrase))) for phrase, label in phrases.items()]

        auto, begins, vocabulary, number, named = kept(f"licenses {hash((str(templates), str(phrases)))}", made)
        for batch in sliced(batches):
            words = Words(batch.column("text"), "alphanumeric")
            h = words.hashes
            where = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
            numbers = np.where(vocabulary[where] == h, number[where], -1)
            text = np.repeat(np.arange(len(words)), np.diff(words.at))
            places: list[tuple[np.ndarray, str]] = []
            for label, phrase in named:
                at = np.flatnonzero(h[: max(0, len(h) - len(phrase) + 1)] == phrase[0])
                for k in range(1, len(phrase)):
                    at = at[h[at + k] == phrase[k]]
                places.append((at[text[at] == text[at + len(phrase) - 1]], label))
            counts, low, high = np.zeros(len(words), np.int64), np.full(len(words), np.iinfo(np.int64).max), np.full(len(words), -1)
            labels: list[set[str]] = [set() for _ in range(len(words))]
            for at, label in places:
                np.add.at(counts, text[at], 1)
                np.minimum.at(low, text[at], at - words.at[text[at]])
                np.maximum.at(high, text[at], at - words.at[text[at]])
                for t in np.unique(text[at]).tolist():
                    labels[t].add(label)
            # A template may begin at the last word of a text, so what follows in the next text does not matter here.
            some = set(text[np.flatnonzero(begins.any(1)[numbers + 1])].tolist()) if len(numbers) else set()
            spans = [matches(auto, numbers[words.at[t] : words.at[t + 1]], begins) if t in some else [] for t in range(len(words))]
            none = counts == 0
            kind = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array(np.diff(words.at)), pa.array(counts), pa.array(low, mask=none), pa.array(high, mask=none), pa.array([sorted(x) for x in labels], pa.list_(pa.string())),
                    pa.array([[{"label": templates[k][0], "template": k, "start": a, "end": b} for k, a, b in x] for x in spans], kind),
                ],
                names=["id", "n_words", "n_phrases", "first_word", "last_word", "phrase_labels", "matches"],
            )

    return run


MATCHES = "array<struct<label:string,template:bigint,start:bigint,end:bigint>>"


def license_scan(docs: DataFrame, templates: list[tuple[str, str, bool]] | None = None, phrases: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_phrases, first_word, last_word, phrase_labels, matches) for every row; places are in words, from 0."""
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    scan = _scan(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)
    return text.mapInArrow(scan, f"id long, n_words long, n_phrases long, first_word long, last_word long, phrase_labels array<string>, matches {MATCHES}")


def score(matches: Column, phrase_labels: Column, templates: list[tuple[str, str, bool]] | None = None) -> Column:
    """How much of a license a text has: the whole of one, a notice, its name alone, or nothing."""
    whole = F.array(*[F.lit(x[2]) for x in (TEMPLATES if templates is None else templates)])
    return F.when(F.exists(matches, lambda m: F.get(whole, m["template"].cast("int"))), WHOLE).when(F.size(matches) > 0, NOTICE).when(F.size(phrase_labels) > 0, NAMED).otherwise(0.0)


def op13_license_scan(spark, sf_dir: str) -> DataFrame:
    d = license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("id", "doc_id")
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    both = F.concat("phrase_labels", F.transform("matches", lambda m: m["label"]))
    return d.select("doc_id", "n_words", F.col("n_phrases").alias("n_base"), "first_word", "last_word", joined("phrase_labels").alias("base_labels"), joined(both).alias("labels"), score(F.col("matches"), F.col("phrase_labels")).alias("score"))


_NORMAL = "' ' || array_to_string(w, ' ') || ' '"
_LABELS = ", ".join(f"CASE WHEN regexp_matches(t, ' {pattern(parsed(text))}') THEN '{label}' END" for label, text, _ in TEMPLATES)
_OF = lambda whole: " OR ".join(f"regexp_matches(t, ' {pattern(parsed(text))}')" for _, text, is_whole in TEMPLATES if is_whole == whole)
_STARTS = " || ".join(
    f"list_transform(list_filter(range(1, len(w) + 1), lambda i: array_to_string(w[i:i + {len(phrase.split()) - 1}], ' ') = '{phrase}'), lambda i: {{'at': i - 1, 'label': '{label}'}})" for phrase, label in PHRASES.items()
)

SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), p AS (SELECT doc_id, w, {_NORMAL} AS t, {_STARTS} AS b FROM d),
l AS (SELECT *, list_distinct(list_transform(b, lambda x: x.label)) AS base, list_filter([{_LABELS}], lambda x: x IS NOT NULL) AS more FROM p)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(b) AS BIGINT) AS n_base, CAST(list_min(list_transform(b, lambda x: x.at)) AS BIGINT) AS first_word, CAST(list_max(list_transform(b, lambda x: x.at)) AS BIGINT) AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels, array_to_string(list_sort(list_distinct(base || more)), ',') AS labels,
       CASE WHEN {_OF(True)} THEN {WHOLE}::DOUBLE WHEN {_OF(False)} THEN {NOTICE}::DOUBLE WHEN len(b) > 0 THEN {NAMED}::DOUBLE ELSE 0.0::DOUBLE END AS score FROM l
"""
