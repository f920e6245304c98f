"""License scans by template-markup matching.

A template is the wording of a license or notice with marked regions: `[words]` may be left out and
`{a-b}` stands for any a to b words; everything else is mandatory. A template is compiled into a token
automaton (a lazily built DFA over word sets), which accepts a run of words of a text only if the
mandatory wording is there exactly and in order. Fixed base phrases are counted besides.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ledgerloom.llm.common import alnum_words, map_texts

# Base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Wording of licenses and notices, as normalised words with markup.
TEMPLATES = (
    ("gpl-2.0", "[this {1-4} is] licensed under [the terms of] the gnu general public license [as published by the free software foundation] [either] version 2 [0] [of the license]"),
    ("gpl-3.0", "[this {1-4} is] licensed under [the terms of] the gnu general public license [as published by the free software foundation] [either] version 3 [0] [of the license]"),
    ("gpl-3.0", "{1-6} is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or [at your option] any later version"),
    ("apache-2.0", "[{1-4} is] licensed under the apache license version 2 [0] [the license]"),
    ("apache-2.0", "released under the apache license version 2 [0]"),
    ("cc-by-4.0", "licensed under [a] [creative commons] cc by 4 0 [international] [license]"),
    ("cc-by-nc-4.0", "licensed under [a] [creative commons] cc by nc 4 0 [international] [license]"),
    ("cc-by-sa-4.0", "licensed under [a] [creative commons] cc by sa 4 0 [international] [license]"),
    ("mit", "released under the [terms of the] mit license"),
    ("mit", "licensed under the [terms of the] mit license"),
    (
        "mit",
        "[the mit license [mit]] [copyright {1-12}] permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    ("isc", "[copyright {1-12}] permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "[copyright {1-12}] redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
)

TOKEN = re.compile(r"\[|\]|\{(\d+)-(\d+)\}|[^\s\[\]{}]+")


@dataclass
class Automaton:
    """A compiled template. `anchor` is its longest mandatory word: a text without it is never accepted."""

    label: str
    anchor: bytes
    arcs: list[list[tuple[bytes | None, int]]] = field(default_factory=list)
    skips: list[list[int]] = field(default_factory=list)
    final: int = 0
    cache: dict[frozenset, dict[bytes, frozenset]] = field(default_factory=dict)
    words: frozenset = frozenset()

    def closure(self, states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for nxt in self.skips[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)

    def step(self, states: frozenset, word: bytes) -> frozenset:
        token = word if word in self.words else b""
        known = self.cache.setdefault(states, {})
        if token not in known:
            known[token] = self.closure({to for s in states for want, to in self.arcs[s] if want is None or want == token})
        return known[token]

    def longest(self, words: list[bytes], start: int) -> int | None:
        """The end of the longest accepted run of words from `start`, or None."""
        states, best, at = self.closure({0}), None, start
        while states and at < len(words):
            states = self.step(states, words[at])
            at += 1
            if self.final in states:
                best = at
        return best


def compile_template(label: str, markup: str) -> Automaton:
    """The automaton of a template; unbalanced brackets or a template without mandatory words are errors."""
    made = Automaton(label, b"")
    mandatory: list[bytes] = []

    def state() -> int:
        made.arcs.append([])
        made.skips.append([])
        return len(made.arcs) - 1

    at, opened = state(), []
    for m in TOKEN.finditer(markup.lower()):
        if m[0] == "[":
            opened.append(at)
        elif m[0] == "]":
            begin = opened.pop()
            end = state()
            made.skips[at].append(end)
            made.skips[begin].append(end)
            at = end
        elif m[1] is not None:
            least, most = int(m[1]), int(m[2])
            gate = [at]
            for k in range(most):
                nxt = state()
                made.arcs[at].append((None, nxt))
                at = nxt
                if k + 1 >= least:
                    gate.append(at)
            end = state()
            for s in gate[0 if least == 0 else 1 :]:
                made.skips[s].append(end)
            at = end
        else:
            nxt = state()
            made.arcs[at].append((m[0].encode(), nxt))
            at = nxt
            if not opened:
                mandatory.append(m[0].encode())
    if opened or not mandatory:
        raise ValueError(f"bad template for {label}")
    made.final = at
    made.anchor = max(mandatory, key=len)
    made.words = frozenset(w for arcs in made.arcs for w, _ in arcs if w is not None)
    return made


def accepted(machines: list[Automaton], words: list[bytes], flat: bytes) -> list[tuple[str, int, int]]:
    """(label, first word, word behind the last) of every longest run that a template accepts, without overlaps of one template."""
    found = []
    for machine in machines:
        if b" " + machine.anchor + b" " not in flat:
            continue
        start = 0
        while start < len(words):
            end = machine.longest(words, start)
            if end is None:
                start += 1
            else:
                found.append((machine.label, start, end))
                start = end
    return found


def phrase_places(flat: bytes, phrases: tuple[tuple[bytes, str], ...]) -> list[tuple[int, str]]:
    """(first word's number, label) of each place of a base phrase in the words joined by and within single spaces."""
    places = []
    for phrase, label in phrases:
        at, seen, word = flat.find(phrase), 0, -1
        while at >= 0:
            # Spaces are counted on from the place before, so all places cost one pass.
            word += flat.count(b" ", seen, at + 1)
            seen = at + 1
            places.append((word, label))
            at = flat.find(phrase, at + 1)
    return places


def scan(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    Null and empty texts have no words, no places (first_word and last_word null), empty labels and
    score 0. Score: 1 if a template is accepted, 0.5 if only base phrases occur. `matches` are the
    template runs (label, start, stop) in words. Rows that repeat a doc_id are scanned row by row. Whole
    texts are scanned, however long; an empty table gives no rows; only doc_id and text are read, so other
    columns cannot clash.
    """

    def setup() -> Callable[[dict[str, list]], dict[str, list]]:
        machines = [compile_template(*t) for t in templates]
        wanted = tuple((b" " + p.encode() + b" ", label) for p, label in phrases)
        names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches")

        def work(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"doc_id": rows["doc_id"]} | {k: [] for k in names}
            for text in rows["text"]:
                words = alnum_words(text)
                flat = b" " + b" ".join(words) + b" "
                places = phrase_places(flat, wanted)
                runs = accepted(machines, words, flat)
                base = sorted({label for _, label in places})
                for name, value in zip(
                    names,
                    (
                        len(words),
                        len(places),
                        min((p for p, _ in places), default=None),
                        max((p for p, _ in places), default=None),
                        ",".join(base),
                        ",".join(sorted({*base, *(label for label, _, _ in runs)})),
                        1.0 if runs else 0.5 if places else 0.0,
                        [{"label": label, "start": a, "stop": b} for label, a, b in runs],
                    ),
                    strict=True,
                ):
                    out[name].append(value)
            return out

        return work

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, matches array<struct<label: string, start: long, stop: long>>"
    )
    return map_texts(docs, ["doc_id", "text"], "text", schema, work=dict, setup=setup)
