"""Licence scans with a generalised suffix automaton of licence tokens (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm import words as w

# Phrases whose places are counted, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Public licence notices (SPDX-style labels); a document that covers enough of one gets its label.
TEMPLATES = {
    "gpl-notice": "This work is licensed under the GNU General Public License, version",
    "gpl-program": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-nd": "Licensed under CC BY-ND 4.0",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0",
    "cc-by-nc-nd": "Licensed under CC BY-NC-ND 4.0",
    "cc-by-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-nc-sa-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "lgpl-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation",
    "agpl-notice": "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit-notice": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to "
    "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
LONG = 2  # tokens from which a match counts as long
GAP = 6  # tokens that may lie between two matches of a chain, in the document and in the template
COVERED = 0.7  # share of a template's tokens that its chain must cover for the label

# what separates tokens: every ASCII byte that is no lower-case letter or digit once A-Z are lower case
SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = w.BYTE_VALUES[w.LOWER]


def _tokens(text: str) -> list[bytes]:
    data = np.frombuffer(text.encode(), np.uint8)
    words = w.split(data, np.array([0, len(data)]), SEPARATOR)
    return [bytes(w.LOWER[data[s:e]]) for s, e in zip(words.start, words.end, strict=True)]


@dataclass
class Automaton:
    """A generalised suffix automaton: every path from state 0 spells a run of tokens that stands in a template."""

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[dict[int, list[int]]] = field(default_factory=lambda: [{}])  # template: where the state's runs end in it

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append({})
        return len(self.step) - 1

    def _split(self, p: int, token: int, longer: int) -> int:
        """The state for the runs of `longer` that are one token longer than p's."""
        q = self._state(self.length[p] + 1, dict(self.step[longer]), self.link[longer])
        self.link[longer] = q
        while p >= 0 and self.step[p].get(token) == longer:
            self.step[p][token] = q
            p = self.link[p]
        return q

    def _extend(self, last: int, token: int) -> int:
        if token in self.step[last]:  # an earlier template spells this as well
            q = self.step[last][token]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, token, q)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and token not in self.step[p]:
            self.step[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
        return new

    def add(self, tokens: list[int]) -> None:
        last = 0
        for token in tokens:
            last = self._extend(last, token)

    def locate(self, template: int, tokens: list[int]) -> None:
        """Note for each state where its runs end in the template; all templates must have been added."""
        state = 0
        for i, token in enumerate(tokens):
            p = state = self.step[state][token]
            while p > 0:
                self.ends[p].setdefault(template, []).append(i + 1)
                p = self.link[p]

    def statistics(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """At each token, the state and the length of the longest run that ends there and stands in a template."""
        state = length = 0
        for token in tokens:
            while state and token not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.step[state]:
                state, length = self.step[state][token], length + 1
            yield state, length


@dataclass
class Scanner:
    """The automaton of phrases and templates with its vocabulary; built on the driver, sent to every task."""

    labels: list[str]
    sizes: list[int]
    n_phrases: int
    words: np.ndarray  # sorted hashes of the vocabulary; a token's number is its place here
    automaton: Automaton

    @staticmethod
    def build(phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> Scanner:
        lists = [_tokens(t) for t in [*phrases, *templates.values()]]
        flat = [w.split(np.frombuffer(t, np.uint8), np.array([0, len(t)])).hashes(_LOWER)[0] for x in lists for t in x]
        vocabulary = np.unique(np.array(flat, np.uint64))
        numbers = iter(np.searchsorted(vocabulary, np.array(flat, np.uint64)).tolist())
        coded = [[next(numbers) for _ in x] for x in lists]
        automaton = Automaton()
        for x in coded:
            automaton.add(x)
        for i, x in enumerate(coded):
            automaton.locate(i, x)
        return Scanner([*phrases.values(), *templates], list(map(len, lists)), len(phrases), vocabulary, automaton)

    def scan(self, runs: list[tuple[int, list[int]]]) -> tuple[list[tuple[int, int]], dict[int, list[tuple[int, int, int]]]]:
        """Places (start, phrase), and for each template its long matches (start, end, end in the template)."""
        places, matches = [], {}
        sizes, ends, length_of, link = self.sizes, self.automaton.ends, self.automaton.length, self.automaton.link
        for first, tokens in runs:
            held: dict[int, tuple[int, int]] = {}  # template: the longest run that ends at the last token, and its state
            for i, (state, length) in enumerate([*self.automaton.statistics(tokens), (0, 0)]):
                now: dict[int, tuple[int, int]] = {}
                p = state
                while p > 0:  # runs of the state, then the shorter ones that further templates hold
                    reach = min(length, length_of[p])
                    for t, found in ends[p].items():
                        if t >= self.n_phrases:
                            if reach >= LONG:
                                now.setdefault(t, (reach, p))
                        elif length_of[link[p]] < sizes[t] <= reach and sizes[t] in found:
                            places.append((first + i + 1 - sizes[t], t))
                    p = link[p]
                for t, (reach, p) in held.items():
                    if now.get(t, (0, 0))[0] <= reach:  # the template's run cannot be longer: it ends before this token
                        matches.setdefault(t, []).extend((first + i - reach, first + i, end) for end in ends[p][t])
                held = now
        return places, matches

    def best(self, matches: list[tuple[int, int, int]], size: int) -> tuple[float, int, int]:
        """Share of the template that the best chain covers, and the chain's first and last word.

        Matches of a chain follow one another in document and template, GAP tokens apart at most.
        """
        found = (0.0, 0, 0)
        chains: list[tuple[int, int, int, int]] = []  # covered, first word, end, end in the template
        for start, end, there in matches:
            covered, first = end - start, start
            chains = [c for c in chains if start - c[2] <= GAP]
            for c, c_first, c_end, c_there in chains:
                overlap = max(0, c_end - start, c_there - (there - (end - start)))
                if c_end < end and c_there < there and there - (end - start) - c_there <= GAP and c + end - start - overlap > covered:
                    covered, first = c + end - start - overlap, c_first
            chains.append((covered, first, end, there))
            found = max(found, (min(1.0, covered / size), first, end - 1), key=lambda x: x[0])
        return found


def _runs(known: np.ndarray, numbers: np.ndarray, low: int, high: int) -> list[tuple[int, list[int]]]:
    """Runs of at least LONG known tokens among words low..high-1, as (first word of the text, token numbers)."""
    at = np.flatnonzero(known[low:high])
    if len(at) < LONG:
        return []
    cut = np.flatnonzero(np.diff(at) > 1) + 1
    return [(int(r[0]), numbers[low + r].tolist()) for r in np.split(at, cut) if len(r) >= LONG]


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans for every row of docs.

    Tokens are runs of 0-9, a-z and non-ASCII characters once A-Z are lower case. A place of a phrase is where its tokens
    stand consecutively; places may overlap. spans lists (label, first_word, last_word, covered) of every template whose
    best chain of long matches covers enough of it, unless another one covers more tokens, or as many and a larger share, over some of the same words;
    their labels join those of the phrases. The score is the largest
    covered share of a template, 1 for a document with a phrase only. A null or empty text has no words and labels ''.
    Repeated rows are scanned alike; further columns are ignored; an empty table gives no rows.
    """
    if any(len(_tokens(p)) < LONG for p in phrases):
        raise ValueError(f"a phrase needs {LONG} tokens")
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner.build(phrases, templates))  # as large as the templates

    def one(scan: Scanner, runs: list[tuple[int, list[int]]]) -> tuple:
        places, matches = scan.scan(runs) if runs else ([], {})
        base = {scan.labels[t] for _, t in places}
        spans, score = [], 1.0 if base else 0.0
        for t, found in sorted(matches.items()):
            covered, first, last = scan.best(found, scan.sizes[t])
            if covered >= COVERED:
                spans.append({"label": scan.labels[t], "first_word": first, "last_word": last, "covered": covered, "most": (round(covered * scan.sizes[t]), covered)})
            if not base:
                score = max(score, covered)
        # of notices over the same words the one with most tokens stands, then the one with the largest share
        spans = [
            {k: v for k, v in s.items() if k != "most"} for s in spans
            if not any(o["most"] > s["most"] and o["first_word"] <= s["last_word"] and s["first_word"] <= o["last_word"] for o in spans)
        ]
        starts = [s for s, _ in places]
        labels = base | {s["label"] for s in spans}
        return len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, spans

    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.float64())])
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner.value
        for batch in batches:
            for first, data, offsets in w.pieces(batch.column("text")):
                words = w.split(data, offsets, SEPARATOR)
                hashes = words.hashes(_LOWER)
                numbers = np.minimum(np.searchsorted(scan.words, hashes), len(scan.words) - 1)
                known = scan.words[numbers] == hashes
                b = words.bounds.tolist()
                rows = [one(scan, _runs(known, numbers, b[i], b[i + 1])) for i in range(len(b) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(rows)), pa.array(words.counts())]
                    + [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label:string,first_word:long,last_word:long,covered:double>>",
    )
