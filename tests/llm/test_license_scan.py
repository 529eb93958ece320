"""Licence scans against naive matching over every stretch of every template."""

import random
import re
from collections import Counter

import pytest
from test_operators import ROWS, SCHEMA, prose

from clickweave.llm import license_scan
from clickweave.llm.license_scan import PHRASES, TEMPLATES, Automaton, Chains, scan, scan_licences, words_of
from clickweave.llm.queries import QUERIES


def words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def places(doc, phrases):
    return [(i, label) for p, label in phrases for i in range(len(doc) - len(p) + 1) if doc[i : i + len(p)] == p]


def statistics(doc, sequences):
    """Longest stretch ending at each word that some sequence has."""
    stretches = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    longest = [0]
    for end in range(1, len(doc) + 1):
        longest.append(next((n for n in range(end, 0, -1) if tuple(doc[end - n : end]) in stretches), 0))
    return longest


def brute(doc, templates, phrases, least_match, least_coverage, most_gap):
    longest = statistics(doc, [t for _, t in templates] + [p for p, _ in phrases])
    ends = [e for e in range(1, len(doc) + 1) if longest[e] >= least_match and (e == len(doc) or longest[e + 1] <= longest[e])]
    spans, best = [], 0.0
    for number, (_, template) in enumerate(templates):
        chains = []
        for e in ends:
            start, size = e - longest[e], longest[e]
            stretch, fresh = doc[start:e], []
            for end in range(size, len(template) + 1):
                if template[end - size : end] != stretch:
                    continue
                options = [(size, start)]
                for last, last_end, covered, first in chains:
                    new = size - max(0, last - start, last_end - (end - size))
                    if last + most_gap >= start and new > 0:
                        options.append((covered + new, first))
                covered, first = max(options)
                fresh.append((e, end, covered, first))
            chains += fresh
        pending = None
        for last, _, covered, first in chains:
            best = max(best, covered / len(template))
            if covered / len(template) < least_coverage:
                continue
            if pending and pending[1] > first:
                pending = (first, last, covered) if covered > pending[2] else pending
            else:
                spans += [(number, *pending)] if pending else []
                pending = (first, last, covered)
        spans += [(number, *pending)] if pending else []
    return sorted(spans, key=lambda s: (s[1], s[2], s[0])), best


@pytest.mark.parametrize("block", [1, 9, 1 << 20])
def test_statistics_places_and_chains(block, monkeypatch):
    monkeypatch.setattr(license_scan, "BLOCK", block)
    own = random.Random(block)
    for _ in range(60):
        letters = "abcd"[: own.randrange(1, 5)]
        draw = lambda n: [own.choice(letters) for _ in range(n)]
        templates = [(f"t{i}", draw(own.randrange(1, 14))) for i in range(own.randrange(1, 5))]
        phrases = {tuple(draw(own.randrange(1, 4))): f"p{i}" for i in range(own.randrange(1, 3))}
        coded = {tuple(w.encode() for w in p): label for p, label in phrases.items()}
        automaton = Automaton([[w.encode() for w in t] for _, t in templates], coded)
        for _ in range(8):
            doc = []
            while len(doc) < own.randrange(1, 60):
                copied = own.choice(templates)[1]
                a = own.randrange(len(copied))
                doc += copied[a : a + own.randrange(1, 9)] + ["zz"] * (own.random() < 0.3) + draw(own.randrange(3))
            least, share, gap = own.randrange(1, 4), own.choice([0.5, 0.8, 1.0]), own.randrange(6)
            chains = Chains([len(t) for _, t in templates], share, gap)
            n, found, first, last, labels = scan(" ".join(doc), automaton, chains, least)
            listed = [(list(p), label) for p, label in phrases.items()]
            expected = places(doc, listed)
            starts = [i for i, _ in expected]
            assert (n, found, labels) == (len(doc), len(expected), {label for _, label in expected})
            assert (first, last) == (min(starts, default=None), max(starts, default=None))
            spans, best = brute(doc, templates, listed, least, share, gap)
            assert chains.finish() == spans and chains.best == best


NOTICES = [
    "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0.",
    "Released under the MIT License.",
    "All rights reserved.",
    "ALL  rights\nreserved, cc-by; Cc/By cc by",
    "all rights_reserved ccby Éall rights reserved",
    "This program is free software: you can redistribute it and modify it under the terms of the GNU General Public License as"
    " published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    "Redistribution and use in source and binary forms are permitted",
]


def test_query(spark, tmp_path):
    """The registered query over nulls, empty and long texts, repeats, clashing names and every notice."""
    rows = ROWS + [(100 + i, f"{prose(20, i)} {n} {prose(20, i + 50)}", "r", 5, "b", "s", "en", 9) for i, n in enumerate(NOTICES)]
    rows += [(200, " ".join(NOTICES) + " x" * 50 + " ".join(NOTICES), "r", 5, "b", "s", "en", 9)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("row", "licences").withColumnRenamed("n_bytes", "raw")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    phrases = [(words(p), label) for p, label in PHRASES.items()]
    templates = [(label, words(t)) for label, texts in TEMPLATES.items() for t in texts]
    expected = Counter()
    for doc_id, text, *_ in rows:
        doc = words(text)
        found = places(doc, phrases)
        starts = [i for i, _ in found]
        base = {label for _, label in found}
        # Long prose without a template word of three in a row finds nothing.
        spans, best = brute(doc, templates, phrases, 3, 0.8, 20) if len(doc) < 1000 else ([], 0.0)
        labels = base | {templates[s[0]][0] for s in spans}
        score = 1.0 if found else best
        expected[doc_id, len(doc), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score] += 1
    found = QUERIES["op11_licences"](spark, str(tmp_path))
    assert Counter(map(tuple, found.collect())) == expected
    by_id = {r[0]: r[6] for r in expected}
    assert [by_id[100 + i] for i in range(len(NOTICES))] == ["cc-by,cc-by-nc", "gpl", "apache-2.0", "mit", "reserved", "cc-by,reserved", "reserved", "gpl", ""]
    kinds = dict(found.dtypes)
    assert all(kinds[c] == "bigint" for c in ("n_words", "n_base", "first_word", "last_word"))
    whole = scan_licences(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    row = whole.where("doc_id = 103").select("licences_.spans").first()[0]
    assert [(s.label, s.end - s.start, s.covered, s.template_words) for s in row] == [("mit", 5, 5, 5)]
    assert whole.count() == len(rows) and scan_licences(frame.limit(0)).count() == 0


def test_own_templates_and_their_limits(spark):
    frame = spark.createDataFrame([(1, "use of this file is free for all of us")], "doc_id bigint, text string")
    own = scan_licences(frame, templates={"own": ["this file is free for all"]}, phrases={"for all": "all"}).first()
    assert own.licences.labels == ["all", "own"] and own.licences.score == 1.0
    with pytest.raises(ValueError):
        scan_licences(frame, templates={"none": ["--"]})
    with pytest.raises(ValueError):
        scan_licences(frame, phrases={"a b": "x", "a-b": "y"})
    assert words_of("A1 é_b") == [b"a1", "é".encode(), b"b"]
