"""License scan: exact set-similarity join of text blocks with license templates.

A block is a line of a text with the ``BLOCK_LINES - 1`` lines after it, so a notice may be wrapped; its tokens are its distinct
words. A template matches a block that holds at least ``CONTAINMENT`` of the template's tokens. Blocks overlap: of a run of
blocks with the same match only the last is listed, which starts where the notice does. The join is exact:

* tokens are ordered by how many documents of the whole corpus hold them, rarest first;
* prefix filter: a match holds one of the template's first ``size - need + 1`` tokens, so only these are indexed;
* length filter: a block with fewer than ``need`` tokens cannot match;
* positional filter: if the rarest shared token stands at place ``p`` of the template, at most ``size - p`` can be shared;
* what is left is intersected.

The templates and their index are small and fixed by the caller, so every task holds them; documents are never shuffled.

Base labels come from phrases: places in the whole text where the phrase's words stand next to each other.
Words are stretches of ASCII letters (A-Z lower-cased), ASCII digits and all characters beyond ASCII. Null or empty
text: no words and no labels. Repeated rows are scanned one by one. Extra columns are ignored by ``license_scan`` unless
named in ``columns``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTAINMENT = 0.9
BLOCK_LINES = 4
#: Fixed values of the contract: phrase -> label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label -> a sentence by which that license is named in public notices.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "gpl-3": "this work is licensed under the gnu general public license version 3",
    "mit": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
#: Every byte to itself (A-Z to a-z) if it belongs to a word, else to a space.
WORD_BYTES = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words(data: bytes) -> list[bytes]:
    return data.translate(WORD_BYTES).split()


def token_frequency(df: DataFrame, vocabulary: set[bytes], text: str = "text") -> dict[bytes, int]:
    """In how many rows of ``df`` each token of the templates occurs (all rows are counted)."""
    vocabulary = frozenset(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(vocabulary, 0)
        for b in batches:
            for t in b.column(0):
                for w in vocabulary.intersection(words(t.as_py() or b"")):
                    total[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["token", "n"])

    rows = df.select(F.col(text).cast("binary")).mapInArrow(count, "token binary, n long")
    return {bytes(r["token"]): r["n"] for r in rows.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class TemplateIndex:
    """Templates as token lists in corpus order, and the inverted index over their prefixes."""

    def __init__(self, templates: dict[str, str], frequency: dict[bytes, int], containment: float = CONTAINMENT):
        self.templates = []
        self.index: dict[bytes, list[int]] = {}
        for label, sentence in sorted(templates.items()):
            tokens = sorted(set(words(sentence.encode())), key=lambda w: (frequency.get(w, 0), w))
            need = max(1, -(-int(round(containment * 1000)) * len(tokens) // 1000))
            for t in tokens[: len(tokens) - need + 1]:
                self.index.setdefault(t, []).append(len(self.templates))
            self.templates.append((label, tokens, need))
        self.prefix = frozenset(self.index)

    def match(self, block: list[bytes]) -> list[tuple[str, float]]:
        """``(label, containment)`` of every template the block matches."""
        held = set(block)
        found = []
        for k in sorted({k for t in self.prefix & held for k in self.index[t]}):
            label, tokens, need = self.templates[k]
            if len(held) < need:
                continue
            first = next(p for p, t in enumerate(tokens) if t in held)
            if len(tokens) - first < need:
                continue
            common = len(held.intersection(tokens))
            if common >= need:
                found.append((label, common / len(tokens)))
        return found


def places(spaced: bytes, phrase: bytes) -> list[int]:
    """Numbers of the words at which ``phrase`` starts; ``spaced`` is all words with one space before and after each."""
    needle, out, at, seen, n = b" " + phrase + b" ", [], -1, 0, 0
    while (at := spaced.find(needle, at + 1)) >= 0:
        n += spaced.count(b" ", seen, at)
        seen = at
        out.append(n)
    return out


def matches(index: TemplateIndex, lines: list[list[bytes]], block_lines: int) -> list[dict]:
    """Matches of all blocks; a block is looked at only if one of its lines holds a prefix token."""
    hot = {i for i, line in enumerate(lines) if not index.prefix.isdisjoint(line)}
    out: list[dict] = []
    after: dict[str, float] = {}  # matches of the block one line further down
    starts = sorted({k for i in hot for k in range(max(0, i - block_lines + 1), i + 1)}, reverse=True)
    for n, i in enumerate(starts):
        if n and starts[n - 1] != i + 1:
            after = {}
        here = dict(index.match([w for line in lines[i : i + block_lines] for w in line]))
        out += [{"line": i, "label": label, "share": share} for label, share in here.items() if share > after.get(label, 0)]
        after = here
    return sorted(out, key=lambda b: (b["line"], b["label"]))


def license_scan(df: DataFrame, text: str = "text", columns: tuple[str, ...] = ("doc_id",), templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, containment: float = CONTAINMENT, block_lines: int = BLOCK_LINES) -> DataFrame:
    """``columns`` plus ``_n_words``, ``_n_base``, ``_first_word``, ``_last_word``, ``_base_labels``, ``_blocks``.

    ``_blocks`` lists every match as (first line of the block, from 0, label, containment), by line and label.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    vocabulary = {w for s in templates.values() for w in words(s.encode())}
    index = TemplateIndex(templates, token_frequency(df, vocabulary, text), containment)
    needles = [(p.encode(), label) for p, label in sorted(phrases.items())]
    columns, n = tuple(columns), len(columns)
    block = "array<struct<line:int,label:string,share:double>>"
    added = {"_n_words": "long", "_n_base": "long", "_first_word": "long", "_last_word": "long", "_base_labels": "array<string>", "_blocks": block}
    schema = df.select(*columns, *[F.lit(None).cast(t).alias(k) for k, t in added.items()]).schema
    names = [*columns, *added]
    block_type = pa.list_(pa.struct([("line", pa.int32()), ("label", pa.string()), ("share", pa.float64())]))
    types = [pa.int64()] * 4 + [pa.list_(pa.string()), block_type]

    def scan(data: bytes) -> tuple:
        flat = words(data)
        spaced = b" " + b" ".join(flat) + b" "
        found = {p: places(spaced, p) for p, _ in needles}
        starts = [s for x in found.values() for s in x]
        labels = sorted({label for p, label in needles if found[p]})
        blocks = [] if index.prefix.isdisjoint(flat) else matches(index, [words(line) for line in data.split(b"\n")], block_lines)
        return len(flat), len(starts), min(starts, default=None), max(starts, default=None), labels, blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [scan(t.as_py() or b"") for t in b.column(n)]
            cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(n)] + cols, names=names)

    return df.select(*columns, F.col(text).cast("binary").alias("_scan_text")).mapInArrow(run, schema)
