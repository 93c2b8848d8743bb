"""License notices by templates compiled to token automata.

A template is wording with marked regions: `<<optional>> ... <<end>>` may be
missing, `<<any LOW HIGH>>` stands for LOW to HIGH words of any kind.  It
compiles to an automaton over words; a text holds the license if the automaton
accepts a stretch of its words, that is, if all mandatory wording stands there
exactly.  Places of fixed base phrases are counted besides.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased.

Defined results: null or wordless texts have no words, places or labels and
score 0; a text with base phrases only scores 0.5, one with an accepted
template 1; repeated rows are judged alike; an empty table gives an empty frame.
Only `doc_id` and `text` are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import LOWER, text_slices, word_spans

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
_TO_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public wording of notices and license texts.
TEMPLATES = [
    ("mit", "<<optional>>released under<<end>> <<optional>>licensed under<<end>> <<optional>>the terms of<<end>> the mit license"),
    ("mit", """permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "software"), to deal in the software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        software, and to permit persons to whom the software is furnished to do so, subject to the following conditions:
        the above copyright notice and this permission notice <<optional>>(including the next paragraph)<<end>> shall be
        included in all copies or substantial portions of the software"""),
    ("isc", """permission to use, copy, modify, and<<optional>>/or<<end>> distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"""),
    ("bsd", """redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: <<optional>>1<<end>> redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer"""),
    ("bsd-3-clause", """neither the name of <<any 1 12>> nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission"""),
    ("apache-2.0", "licensed under the apache license, version 2.0 <<optional>>(the \"license\")<<end>>"),
    ("apache-2.0", """you may not use this file except in compliance with the license <<optional>>you may obtain a copy of
        the license at<<end>>"""),
    ("gpl-3.0", "licensed under the <<optional>>terms of the<<end>> gnu general public license, version 3"),
    ("gpl-2.0", "licensed under the <<optional>>terms of the<<end>> gnu general public license, version 2"),
    ("gpl", """<<any 1 6>> is free software<<optional>>:<<end>> you can redistribute it and/or modify it under the terms of
        the gnu <<optional>>lesser<<end>> <<optional>>affero<<end>> general public license as published by the free
        software foundation"""),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license, v. 2.0"),
    ("cc-by-nc-4.0", "licensed under <<optional>>the<<end>> <<optional>>creative commons<<end>> cc by nc 4.0"),
    ("cc-by-sa-4.0", "licensed under <<optional>>the<<end>> <<optional>>creative commons<<end>> cc by sa 4.0"),
    ("cc-by-4.0", "licensed under <<optional>>the<<end>> <<optional>>creative commons<<end>> cc by 4.0"),
]


class Automaton:
    """Non-deterministic automaton of a template over words."""

    def __init__(self, template: str):
        self.on: list[dict[str, int]] = [{}]
        self.free: list[list[int]] = [[]]      # ways that read nothing
        self.any: list[int | None] = [None]    # ways that read any word
        parts = re.split(r"(<<[^>]*>>)", template.translate(_TO_LOWER))
        at, open_ = 0, []
        for p in parts:
            if p == "<<optional>>":
                open_.append(at)
            elif p == "<<end>>":
                self.free[open_.pop()].append(at)
            elif p.startswith("<<any "):
                low, high = map(int, p[6:-2].split())
                ways = []
                for k in range(high):
                    if k >= low:
                        ways.append(at)
                    self.any[at] = nxt = self._state()
                    at = nxt
                for w in ways:
                    self.free[w].append(at)
            else:
                for w in WORD.findall(p):
                    nxt = self._state()
                    self.on[at][w] = nxt
                    at = nxt
        if open_:
            raise ValueError("a template's optional region has no end")
        self.accept = at
        self.begin = self._closure({0})
        self.first = None if any(self.any[s] is not None for s in self.begin) else {
            w for s in self.begin for w in self.on[s]}
        self.memo: dict[tuple[frozenset, str], frozenset] = {}
        # mandatory words: those without which no way leads from start to end
        every = {w for d in self.on for w in d}
        self.needs = {w for w in every if not self._reaches(without=w)}

    def _state(self) -> int:
        self.on.append({})
        self.free.append([])
        self.any.append(None)
        return len(self.on) - 1

    def _closure(self, states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for n in self.free[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return frozenset(seen)

    def _reaches(self, without: str) -> bool:
        todo, seen = [0], {0}
        while todo:
            s = todo.pop()
            for n in [*self.free[s], *([self.any[s]] if self.any[s] is not None else []),
                      *(n for w, n in self.on[s].items() if w != without)]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return self.accept in seen

    def step(self, states: frozenset, word: str) -> frozenset:
        key = states, word
        found = self.memo.get(key)
        if found is None:
            nxt = {self.on[s][word] for s in states if word in self.on[s]} | {
                self.any[s] for s in states if self.any[s] is not None}
            found = self._closure(nxt)
            if len(self.memo) < 100_000:
                self.memo[key] = found
        return found

    def finds(self, words: list[str], present: set[str]) -> list[tuple[int, int]]:
        """Accepted stretches [first word, end), the longest of each start."""
        if not self.needs <= present:
            return []
        out = []
        for i, w in enumerate(words):
            if self.first is not None and w not in self.first:
                continue
            states, end, j = self.begin, -1, i
            while states and j <= len(words):
                if self.accept in states:
                    end = j
                if j == len(words):
                    break
                states = self.step(states, words[j])
                j += 1
            if end > i:
                out.append((i, end))
        return out


def _scan(templates: list[tuple[str, str]], base: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = [(label, Automaton(t)) for label, t in templates]
        phrases = [(p.split(), label) for p, label in base.items()]
        # every phrase and template has a word that begins with one of these
        needles = {p[-1] for p, _ in phrases} | {max(a.needs, key=len) for _, a in machines if a.needs}
        needle = re.compile(b"|".join(re.escape(x.encode()) for x in sorted(needles)))
        anywhere = any(not a.needs for _, a in machines)
        for batch in batches:
            for a, b, data, offs in text_slices(batch):
                data = LOWER[data]
                _, _, row = word_spans(~IS_WORD[data], offs)
                n_words = np.bincount(row, minlength=b - a)
                raw = data.tobytes()
                hits = np.fromiter((m.start() for m in needle.finditer(raw)), np.int64)
                asked = set((np.searchsorted(offs, hits, "right") - 1).tolist()) if not anywhere else set(range(b - a))
                rows = []
                for i in range(b - a):
                    if i not in asked:
                        rows.append((0, None, None, "", "", 0.0, []))
                        continue
                    words = WORD.findall(raw[offs[i]:offs[i + 1]].decode())
                    present = set(words)
                    places, own = [], set()
                    for p, label in phrases:
                        if p[0] in present and p[-1] in present:
                            at = [k for k, w in enumerate(words) if w == p[0] and words[k:k + len(p)] == p]
                            if at:
                                own.add(label)
                                places += at
                    spans = [{"label": label, "first_word": s, "end_word": e}
                             for label, m in machines for s, e in m.finds(words, present)]
                    more = own | {x["label"] for x in spans}
                    rows.append((len(places), min(places, default=None), max(places, default=None), ",".join(sorted(own)),
                                 ",".join(sorted(more)), 1.0 if spans else 0.5 if own else 0.0, spans))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(),
                         pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())]))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n_words)] + [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
    return run


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, base: dict[str, str] = BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score and the accepted spans of words of every document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(_scan(templates, base), (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label: string, first_word: long, end_word: long>>"))
