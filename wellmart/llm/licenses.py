"""Licence scan: a generalised suffix automaton of template tokens, chained matches.

The automaton holds every phrase and template (a few hundred tokens). A text's
words are streamed through it; at each word it gives the longest match that
ends there and where in which template (matching statistics). Phrases are
places whose whole token sequence ends at a word. Maximal matches of
``MIN_MATCH`` words or more are chained in order through one template, and the
share of the template's words that a chain covers is its score.

Words that occur in no template reset the automaton, so only runs of template
words are streamed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import alnum_words, texts

# Phrases that mark a licence wherever they stand.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening passages of public licences and licence notices.
TEMPLATES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
           "documentation files the software to deal in the software without restriction including without limitation "
           "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    "apache-2": "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
                "with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
           "the following conditions are met",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
           "public license as published by the free software foundation",
    "cc-by": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-nc": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
}
MIN_MATCH = 4
MAX_GAP = 8
MIN_COVER = 0.5


class SuffixAutomaton:
    """Generalised suffix automaton of integer token sequences.

    ``ends[s]`` maps a template to the end positions of state s's strings in
    it; ``whole[s]`` lists the sequences of which state s's longest string has
    one as a suffix, with their lengths.
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        at: list[list[tuple[int, int]]] = [[]]
        last_of = []
        for k, seq in enumerate(sequences):
            last = 0
            for i, c in enumerate(seq):
                last = self._extend(last, c)
                while len(at) < len(self.next):
                    at.append([])
                at[last].append((k, i + 1))
            last_of.append(last)
        order = sorted(range(len(self.next)), key=lambda s: -self.length[s])
        self.ends: list[list[tuple[int, int]]] = at
        for s in order:
            if self.link[s] > 0:
                self.ends[self.link[s]] = sorted({*self.ends[self.link[s]], *self.ends[s]})
        own = defaultdict(list)
        for k, seq in enumerate(sequences):
            if seq:
                own[last_of[k]].append((len(seq), k))
        self.whole: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for s in reversed(order):
            if s:
                self.whole[s] = own[s] + self.whole[self.link[s]]

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[last] + 1 == length[q] else self._clone(last, q, c)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[p] + 1 == length[q] else self._clone(p, q, c)
        return cur

    def _clone(self, p: int, q: int, c: int) -> int:
        made = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = made
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = made
            p = self.link[p]
        return made

    def stream(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest match ending at each token."""
        s = n = 0
        for c in tokens:
            while s and c not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            if c in self.next[s]:
                s, n = self.next[s][c], n + 1
            yield s, n


class LicenseScanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES,
                 min_match: int = MIN_MATCH, max_gap: int = MAX_GAP, min_cover: float = MIN_COVER):
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        split = [(alnum_words(p.encode()), label, True) for p, label in phrases.items()]
        split += [(alnum_words(t.encode()), label, False) for label, t in templates.items()]
        self.ids = {w: i for i, w in enumerate(dict.fromkeys(w for words, _, _ in split for w in words))}
        self.label, self.phrase = [s[1] for s in split], [s[2] for s in split]
        self.size = [len(s[0]) for s in split]
        self.automaton = SuffixAutomaton([[self.ids[w] for w in words] for words, _, _ in split])
        self.least = min([self.min_match, *(n for n, p in zip(self.size, self.phrase) if p)])

    def scan(self, data: bytes | None) -> dict:
        """Words, phrase places (start, label) and chains (label, start, end, score)."""
        words = alnum_words(data)
        get = self.ids.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        places, matches = [], defaultdict(list)
        for a, b in self._runs(ids):
            before = (0, 0)
            states = list(self.automaton.stream(ids[a:b].tolist()))
            for i, (s, n) in enumerate(states):
                for size, k in self.automaton.whole[s]:
                    if size <= n and self.phrase[k]:
                        places.append((a + i + 1 - size, self.label[k]))
                goes_on = i + 1 < len(states) and states[i + 1][1] == n + 1
                if n >= self.min_match and not goes_on:
                    for k, end in self.automaton.ends[s]:
                        if not self.phrase[k]:
                            matches[k].append((a + i + 1 - n, a + i + 1, end - n, end))
        return {"n_words": len(words), "places": places, "chains": [c for k in sorted(matches) for c in self._chains(k, matches[k])]}

    def _runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        edge = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]]).astype(np.int8)))
        for a, b in edge.reshape(-1, 2).tolist():
            if b - a >= self.least:
                yield a, b

    def _chains(self, k: int, matches: list[tuple[int, int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Chains of matches that move on in both text and template, with at most ``max_gap`` words between in either."""
        open_: list[dict] = []
        done = []
        for s, e, ts, te in sorted(matches):
            done += [c for c in open_ if s - c["e"] > self.max_gap]
            open_ = [c for c in open_ if s - c["e"] <= self.max_gap]
            best, gain = None, 0
            for c in open_:
                twice = max(0, c["e"] - s, c["te"] - ts)  # words of this match that the chain has already
                if ts - c["te"] <= self.max_gap and te - ts > twice and (best is None or c["cover"] - twice > gain):
                    best, gain = c, c["cover"] - twice
            if best:
                best.update(e=e, te=te, cover=gain + te - ts)
            else:
                open_.append({"s": s, "e": e, "te": te, "cover": te - ts})
        return [(self.label[k], c["s"], c["e"], min(1.0, c["cover"] / self.size[k]))
                for c in done + open_ if c["cover"] >= self.min_cover * self.size[k]]


SCHEMA = ("n_words long, places array<struct<start:long,label:string>>, "
          "chains array<struct<label:string,start:long,end:long,score:double>>")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``doc_id, n_words, places, chains``: phrase places and covered template spans of every row.

    Null, empty and blank texts have no words and nothing else. The automaton
    is made from the settings in each task; nothing grows with the data and
    nothing is shuffled.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())])),
             pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(**settings)
        for b in batches:
            found = [scanner.scan(t) for t in texts(b)]
            cols = ([f["n_words"] for f in found],
                    [[{"start": s, "label": x} for s, x in f["places"]] for f in found],
                    [[dict(zip(("label", "start", "end", "score"), c)) for c in f["chains"]] for f in found])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=["doc_id", "n_words", "places", "chains"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def license_digest(docs: DataFrame, **settings) -> DataFrame:
    """The scan as one row of counts, labels and a score: 1 with a phrase, else the best chain's cover."""
    def labels(*cols):
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*cols))), ",")

    p = F.transform("places", lambda x: x["label"])
    c = F.transform("chains", lambda x: x["label"])
    starts = F.transform("places", lambda x: x["start"])
    best = F.coalesce(F.array_max(F.transform("chains", lambda x: x["score"])), F.lit(0.0))
    return license_scan(docs, **settings).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(p).alias("base_labels"), labels(p, c).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"))
