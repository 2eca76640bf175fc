"""License scans by template matching.

A template is licence wording with mark-up: ``[[ ... ]]`` may be left out, ``{{n}}`` stands for up to ``n`` words
of any wording (names, years). It is compiled once into a token automaton: states are positions in the
template, a word moves along its mandatory wording, an optional region adds a jump over itself, a replaceable
region a counted loop. A ``-text`` template is the whole mandatory wording, a ``-notice`` one line. A document is accepted where a run of its words leads from start to end, so every
mandatory word must match exactly. Runs start only at words a template can start with, and the states alive
at a word are a set bounded by the template's size, so a document is read once, whatever it holds.

Short name phrases (``PHRASES``) are reported beside the templates, with all their places.

Words are runs of ASCII letters and digits and of everything beyond ASCII, A-Z lowered. Defined results:
NULL and empty texts have no words, no labels, NULL places, score 0. The score is the share of the document's
words that matched wording covers (at most 1): a licence file scores near 1, a mention near 0.
"""

from __future__ import annotations

import pkgutil
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
_WORDLIKE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDLIKE).split()


# Whole licence wordings (``-text``), which must match to their last word, and single notice lines
# (``-notice``), by SPDX-style label. Names, list numbers, addresses and titles may differ.
_LIABLE = "claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
_AS_IS = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall"
_BSD = "redistribution and use in source and binary forms with or without modification are permitted [[ {{8}} ]] provided that the following conditions are met {{1}} redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer {{1}} redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_BSD_ADVERTISING = "{{1}} all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software developed by {{20}}"
_BSD_NAMES = "{{1}} neither the name of {{12}} nor the names of {{4}} contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_END = "this software is provided by {{12}} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{12}} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"


def whole_text(name: str, end: str = "") -> str:
    """A licence of ``licence_texts`` as a template, up to the last ``end`` (its appendices aren't terms). The scheme
    of links and the FSF's postal address may differ."""
    words = " ".join(w.decode() for w in tokens(pkgutil.get_data("tidemark.llm", f"licence_texts/{name}.txt").decode()))
    if end:
        words = words[: words.rindex(end)].strip()
    words = re.sub(r"\b51 franklin street fifth floor boston ma 02110 1301 usa\b", "{{14}}", words)
    return re.sub(r"\bhttps?\b", "{{1}}", words)


TEMPLATES = {
    "mit-text": f"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the [[ {{{{4}}}} ]] software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice [[ including the next paragraph ]] shall be included in all copies or substantial portions of the software {_AS_IS} {{{{12}}}} be liable for any {_LIABLE}",
    "bsd-2-clause-text": f"{_BSD} {_BSD_END}",
    "bsd-3-clause-text": f"{_BSD} {_BSD_NAMES} {_BSD_END}",
    "bsd-4-clause-text": f"{_BSD} {_BSD_ADVERTISING} {_BSD_NAMES} {_BSD_END}",
    "isc-text": "permission to use copy modify and [[ or ]] distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and {{12}} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall {{12}} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "unlicense-text": f"this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law {_AS_IS} the authors be liable for any {_LIABLE}",
    "apache-2.0-text": whole_text("Apache-2.0", "end of terms and conditions"),
    "gpl-2.0-text": whole_text("GPL-2", "end of terms and conditions"),
    "gpl-3.0-text": whole_text("GPL-3", "end of terms and conditions"),
    "lgpl-2.1-text": whole_text("LGPL-2.1", "end of terms and conditions"),
    "lgpl-3.0-text": whole_text("LGPL-3"),
    "mpl-2.0-text": whole_text("MPL-2.0", "exhibit a source code form license notice"),
    "cc0-1.0-text": whole_text("CC0-1.0"),
    "apache-2.0-notice": "licensed under the apache license version 2 0 [[ the license ]]",
    "gpl-notice": "this [[ {{4}} ]] is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version {{3}} of the license or [[ at your option ]] any later version",
    "gpl-3.0-work-notice": "this {{4}} is licensed under the gnu general public license [[ gpl ]] version 3",
    "cc-by-nc-notice": "licensed under [[ a ]] [[ the ]] cc by nc [[ {{3}} ]] 4 0",
    "mit-notice": "released under the [[ terms of the ]] mit license",
    "copyright-notice": "copyright [[ c ]] {{12}} all rights reserved",
}
LABELS_OF_BASE = tuple(sorted(set(PHRASES.values())))


@dataclass
class Automaton:
    """States are numbered; ``step[s]`` maps a word to the next state, ``loop[s]`` is the state after one free word,
    ``skip[s]`` are states reached without a word."""

    label: str
    step: list[dict[bytes, int]] = field(default_factory=list)
    loop: list[int | None] = field(default_factory=list)
    skip: list[list[int]] = field(default_factory=list)
    final: int = 0
    starts: frozenset[bytes] = frozenset()
    reached: list[set[int]] = field(default_factory=list)

    def state(self) -> int:
        self.step.append({})
        self.loop.append(None)
        self.skip.append([])
        return len(self.step) - 1

    def closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return out


def compile_template(label: str, template: str) -> Automaton:
    """One chain of states; ``{{n}}`` unrolls to ``n`` free words, each of which may be the last."""
    out = Automaton(label)
    at, opened = out.state(), []
    for part in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|\S+", template):
        if part == "[[":
            opened.append(at)
        elif part == "]]":
            out.skip[opened.pop()].append(at)
        elif part.startswith("{{"):
            end_of = []
            for _ in range(int(part[2:-2])):
                end_of.append(at)
                nxt = out.state()
                out.loop[at] = nxt
                at = nxt
            # A state of its own after the region: free words end here, whichever was the last.
            after = out.state()
            for s in [*end_of, at]:
                out.skip[s].append(after)
            at = after
        else:
            nxt = out.state()
            out.step[at][part.encode()] = nxt
            at = nxt
    if opened:
        raise ValueError(f"{label}: an optional region isn't closed")
    out.final = at
    out.reached = [out.closed({s}) for s in range(len(out.step))]
    first = out.reached[0]
    if any(out.loop[s] is not None for s in first) or out.final in first:
        raise ValueError(f"{label}: a template starts with mandatory or optional words, not with a replaceable region")
    out.starts = frozenset(w for s in first for w in out.step[s])
    return out


def accept(automaton: Automaton, words: list[bytes]) -> list[tuple[int, int]]:
    """Leftmost, shortest, non-overlapping accepted stretches (first word, end).

    Alive are pairs state -> latest start; a later start of the same state matches a shorter stretch.
    """
    out: list[tuple[int, int]] = []
    alive: dict[int, int] = {}
    closed = automaton.reached
    initial = closed[0]
    for i, word in enumerate(words):
        if word in automaton.starts:
            for s in initial:
                alive[s] = i
        if not alive:
            continue
        moved: dict[int, int] = {}
        for s, start in alive.items():
            for t in (automaton.step[s].get(word), automaton.loop[s]):
                if t is not None:
                    for u in closed[t]:
                        if moved.get(u, -1) < start:
                            moved[u] = start
        alive = moved
        if automaton.final in alive:
            out.append((alive[automaton.final], i + 1))
            alive = {}
    return out


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, int, str]]:
    """(first word, words, label) of every place where a phrase's words stand consecutively."""
    line = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in phrases.items():
        sought = b" " + phrase.encode() + b" "
        at, counted, words_before = line.find(sought), 0, 0
        while at >= 0:
            words_before += line.count(b" ", counted, at)
            counted = at
            out.append((words_before, phrase.count(" ") + 1, label))
            at = line.find(sought, at + 1)
    return out


def scan_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES
) -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, matches, score) of every row."""

    automata: list[Automaton] = []  # compiled once in each worker

    def rows(batch: dict) -> Iterator[tuple]:
        if not automata:
            automata.extend(compile_template(label, t) for label, t in templates.items())
        for k, t in zip(batch["k"], batch["t"]):
            words = tokens(t)
            places = phrase_places(words, phrases)
            held = set(words)
            found = [(s, e - s, a.label) for a in automata if not held.isdisjoint(a.starts) for s, e in accept(a, words)]
            reach = covered = 0
            for s, n, _ in sorted([*places, *found]):
                covered += max(0, s + n - max(reach, s))
                reach = max(reach, s + n)
            base = {label for _, _, label in places}
            yield (
                k,
                len(words),
                len(places),
                min((s for s, _, _ in places), default=None),
                max((s for s, _, _ in places), default=None),
                ",".join(sorted(base)),
                ",".join(sorted(base | {label for _, _, label in found})),
                sorted(found),
                covered / len(words) if words else 0.0,
            )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, matches array<struct<first_word:long,words:long,label:string>>, score double"
    return map_rows(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), rows, schema)
