import re

from vigie.llm import licenses

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(text, containment=licenses.CONTAINMENT):
    words = re.findall(WORD, lower(text or ""))
    hits = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    blocks = []
    lines = (text or "").split("\n")
    for label, s in licenses.TEMPLATES.items():
        t = set(s.split())
        held = [set(re.findall(WORD, lower("\n".join(lines[k : k + licenses.BLOCK_LINES])))) & t for k in range(len(lines))] + [set()]
        share = [len(h) / len(t) if 1000 * len(h) >= round(1000 * containment) * len(t) else 0 for h in held]
        blocks += [(k, label, share[k]) for k in range(len(lines)) if share[k] > share[k + 1]]
    return len(words), len(at), min(at, default=None), max(at, default=None), sorted({x for _, x in hits}), sorted(blocks)


def test_matches_brute_force(spark, docs, rows, empty):
    more = [
        (1, "cc by cc by cc-by CC  BY, ccby cc byx\nall rights reserved all rights reserved"),
        (2, "This source code form is subject to the terms of the Mozilla Public License, v. 2.0."),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and documentation files (the works)"),
        (4, "apache license version 2"),
        (5, "é general public license ünï"),
        (6, "Licensed under CC BY-SA 4.0"),
    ]
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(more, "doc_id long, text string")).collect()}
    for i, t in more:
        r = got[i]
        assert (r["_n_words"], r["_n_base"], r["_first_word"], r["_last_word"], r["_base_labels"], sorted(map(tuple, r["_blocks"]))) == brute(t), t
    assert [b["label"] for b in got[6]["_blocks"]] == ["cc-by-sa"]
    every = licenses.license_scan(docs, columns=("doc_id", "text")).collect()
    assert len(every) == len(rows)
    for r in every:
        assert (r["_n_words"], r["_n_base"], r["_first_word"], r["_last_word"], r["_base_labels"], sorted(map(tuple, r["_blocks"]))) == brute(r["text"])
    assert licenses.license_scan(empty).count() == 0


def test_filters_lose_nothing():
    """Every subset size of a template, with the index in any token order, gives what plain counting gives."""
    templates = {"a": "one two three four five six seven eight nine ten", "b": "one two red green", "c": "solo"}
    for frequency in ({}, {b"one": 9, b"ten": 5, b"red": 1}, {w.encode(): i for i, w in enumerate(templates["a"].split())}):
        index = licenses.TemplateIndex(templates, frequency, 0.7)
        for start in range(10):
            for n in range(11):
                block = (templates["a"].split() * 2)[start : start + n] + ["red", "solo"][: n % 3]
                held = set(block)
                want = sorted((k, len(held & set(s.split())) / len(s.split())) for k, s in templates.items() if 10 * len(held & set(s.split())) >= 7 * len(s.split()))
                assert sorted(index.match([w.encode() for w in block])) == want


def test_wrapped_notices(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software"
    gpl = "# This program is free software: you can redistribute it\n# and/or modify it under the terms of the GNU General Public\n# License as published by the Free Software\n# Foundation, either version 3"
    rows = [(1, "a b\n" + mit), (2, gpl), (3, mit.replace("\n", "\n\n\n\n\n")), (4, mit + "\nx\ny\nz\nw\n" + mit), (5, "Released under the\r\nMIT\r\nLicense."), (6, "the mit licensed it under a tree\n" * 5)]
    got = {r["doc_id"]: [(b["line"], b["label"]) for b in r["_blocks"]] for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [(1, "mit-text")], 2: [(0, "gpl-notice")], 3: [], 4: [(0, "mit-text"), (7, "mit-text")], 5: [(0, "mit")], 6: []}
    for _, t in rows:
        index = licenses.TemplateIndex(licenses.TEMPLATES, {})
        lines = [licenses.words(x.encode()) for x in t.split("\n")]
        assert [tuple(b.values()) for b in licenses.matches(index, lines, licenses.BLOCK_LINES)] == brute(t)[-1]
