"""License scan and personal data against brute force."""

import hashlib
import math
import os
import re
from collections import Counter

import pytest

from ledgermill.llm import licenses, privacy

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_licenses(doc_id, text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    at = {label: [i for i in range(len(words)) if words[i : i + len(p.split())] == p.split()] for p, label in licenses.PHRASES.items()}
    base = {label for label, places in at.items() if places}
    places = [i for x in at.values() for i in x]
    more, share = set(), 0.0
    for first in range(0, len(words), licenses.BLOCK // 2):
        held = set(words[first : first + licenses.BLOCK])
        for label, wording, needs, bars in licenses.TEMPLATES:
            tokens = set(wording.split())
            told = set(needs.split()) <= held and not set(bars.split()) & held
            if told and len(held & tokens) >= math.ceil(licenses.THRESHOLD * len(tokens) - 1e-9):
                more.add(label)
                share = max(share, len(held & tokens) / len(tokens))
    ends = (min(places), max(places)) if places else (None, None)
    return (doc_id, len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if places else share)


LICENSED = [
    (1, "All Rights Reserved. ALL rights\nreserved"),
    (2, "x " * 100 + "licensed under the apache license, v. 2.0 " + "the " * 70),
    (3, "Licensed under CC BY-NC 4.0."),
    (4, "cc by cc by"),
    (5, "general public license " * 200),
    (6, None),
    (7, "ÀLL rights reserved cc by İ K"),
    (None, "released under the MIT license"),
    (8, "permission granted free of charge to any person obtaining a copy of software"),
    (9, "...\n\n"),
]


def test_licenses_as_by_brute_force(odd_rows):
    rows = [*LICENSED, LICENSED[0], LICENSED[4], (1, "other")]
    got = Counter(map(tuple, licenses.scan(odd_rows(rows)).collect()))
    assert got == Counter(brute_licenses(*r) for r in rows)
    assert licenses.scan(odd_rows([])).count() == 0


#: texts and their labels, set by hand
BY_HAND = [
    ("released under the Apache license", ""),
    ("released under the BSD license", "bsd"),
    ("Released under the MIT License.", "mit"),
    ("the license under which it was released is unknown", ""),
    ("licensed under CC BY-SA 4.0", "cc-by,cc-by-sa"),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("This file is licensed under CC BY-NC-SA 4.0.", "cc-by,cc-by-nc-sa"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("Licensed under the Apache License, Version 2.0 (the 'License'); you may not use this file except in compliance with the License.", "apache-2.0"),
    ("You may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache-2.0"),
    ("licensed under the terms of the GNU Lesser General Public License", "gpl,lgpl"),  # the phrase of three words stands here
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "gpl,lgpl"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("The committee released a statement under the license of the court", ""),
    ("Copyright 2020 X. All rights reserved.", "reserved"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
]


def test_labels_set_by_hand(odd_rows):
    got = {r.doc_id: r.labels for r in licenses.scan(odd_rows([(n, t) for n, (t, _) in enumerate(BY_HAND)])).collect()}
    assert {BY_HAND[n][0]: labels for n, labels in got.items()} == dict(BY_HAND)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_prefix_filter_loses_no_match(spark, threshold):
    """Every block against every template, where tokens are spread at random."""
    import random

    rng = random.Random(int(threshold * 10))
    templates = [(f"t{n}", " ".join(rng.sample("abcdefghijklmnop", rng.randint(1, 9)))) for n in range(12)]
    docs = [(n, -n, [rng.choice("aabcdefghijklmnopqrstuv") for _ in range(rng.randint(0, 60))]) for n in range(80)]
    want = set()
    for k1, _, words in docs:
        for first in range(0, len(words), 8):
            held = set(words[first : first + 16])
            want |= {(k1, first, label, len(held & set(w.split())) / len(set(w.split()))) for label, w in templates if len(held & set(w.split())) >= threshold * len(set(w.split())) - 1e-9}
    found = licenses.matches(spark.createDataFrame(docs, "k1 long, k2 long, words array<string>"), templates, threshold, block=16)
    assert {tuple(r) for r in found.select("k1", "first", "label", "share").collect()} == want


def test_templates_that_no_block_is_sure_to_hold_are_refused(odd_rows):
    long = " ".join(f"w{i}" for i in range(34))
    docs = odd_rows([(1, "x " * 31 + long)])
    with pytest.raises(ValueError):
        licenses.scan(docs, [("long", long)])
    assert licenses.scan(docs, [("long", long)], block=66).first().labels == "long"


def no_python(frame):
    plan = frame._jdf.queryExecution().toString()
    return not re.search("Python|Pandas|Arrow", plan)


def test_native_plans(odd_rows):
    docs = odd_rows([*LICENSED, (20, "a@b.cd met bob\n"), (21, "a@b.cd saw bob")])
    for frame in (licenses.scan(docs), privacy.report(docs), privacy.sanitised(docs)):
        assert no_python(frame)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def brute_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


PRIVATE = [
    (1, None),
    (2, ""),
    (3, "a@b.c-d_x@e.f 1.2.3.4.5.6.7.8 1.2.3.400 é🙂 4539 1488-0343 6467 x\n+1 (988) 555-2485\n\nq@w.e@r.t.y..z 00255.1.1.1"),
    (4, "9" * 3000 + " a" * 10 + "x" * 20000 + "@b.com"),
    (5, "+1+2+33333333 256.1.1.1.2 5500 0000 0000 0004 55000000000000045 +123456789012345 +1234567890123456"),
    (None, "1.1.1.1"),
    (6, "🙂" * 50 + "\n" * 30 + "4111-1111-1111-1111, ok"),
]


def test_base_spans_as_by_the_patterns(odd_rows):
    rows = [*PRIVATE, PRIVATE[2], PRIVATE[2]]
    got = Counter((r.doc_id, r.base_sha256, r.n_email + r.n_ip + r.n_card + r.n_phone) for r in privacy.report(odd_rows(rows)).collect())
    assert got == Counter((i, hashlib.sha256(",".join(brute_spans(t)).encode()).hexdigest(), len(brute_spans(t))) for i, t in rows)
    assert privacy.report(odd_rows([])).count() == 0


def test_addresses_with_parts_of_zeros(odd_rows):
    rows = [(1, "10.0.0.1 and 0.0.0.0"), (2, "000.1.2.3"), (3, "127.0.0.1\n192.168.0.1"), (4, "0.0.0.256 00.0.0.0000 " + "0" * 4000 + ".1.1.0"), (5, "0000.0.0.1000")]
    found = privacy.report(odd_rows(rows)).collect()
    assert {r.doc_id: r.n_ip for r in found} == {1: 2, 2: 1, 3: 2, 4: 2, 5: 0}
    assert all(r.base_sha256 == hashlib.sha256(",".join(brute_spans(dict(rows)[r.doc_id])).encode()).hexdigest() for r in found)
    assert privacy.sanitised(odd_rows(rows[:1])).first().text == "[ip] and [ip]"


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="given tables not present")
def test_base_spans_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = privacy.report(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(",".join(brute_spans(texts[r.doc_id])).encode()).hexdigest()


def brute_terms(rows):
    """(doc row, term) with its share of the entity's information content, by counting lines."""
    lines = [(n, body) for n, (_, t) in enumerate(rows) for body in (t or "").split("\n")]
    words = lambda s: {w.lower() for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", s)}
    cut = lambda s: re.sub("|".join(f"(?:{p})" for p in PATTERNS.values()), lambda m: "@" * len(m.group()) if any(passes(k, m.group()) and re.fullmatch(p, m.group()) for k, p in PATTERNS.items()) else m.group(), s)
    entity = [{f"{k}:{m.group().lower()}" for k, p in PATTERNS.items() for m in re.finditer(p, b) if passes(k, m.group())} for _, b in lines]
    out = {}
    for e in set().union(*entity):
        own = [i for i, x in enumerate(entity) if e in x]
        for t in set().union(*[words(cut(lines[i][1])) for i in own]):
            both = [i for i in own if t in words(cut(lines[i][1]))]
            if len({lines[i][1] for i in both}) < privacy.MIN_CONTEXTS:
                continue
            n_term, n = sum(t in words(b) for _, b in lines), len(lines)
            share = math.log(n * len(both) / (len(own) * n_term)) / math.log(n / len(own))
            if share >= privacy.GENERALISE:
                for i in both:
                    out[lines[i][0], t] = max(share, out.get((lines[i][0], t), 0))
    return out


def test_terms_that_disclose(odd_rows):
    filler = [(100 + i, f"common words here\nline number w{i}\nother words {i}") for i in range(60)]
    rows = [(1, "Zaphod wrote from z@b.com about common words"), (2, "here zaphod z@b.com again\nzaphod alone"), (3, "z@b.com only common"), (4, "trillian t@b.com"), *filler]
    want = brute_terms(rows)
    assert {(n, t) for n, t in want} == {(0, "zaphod"), (1, "zaphod")}
    got = {r.doc_id: r for r in privacy.report(odd_rows(rows)).collect()}
    assert {i: r.n_term for i, r in got.items() if r.n_term} == {1: 1, 2: 1}
    assert got[2].spans == "email:12:19,term:5:11"
    docs = odd_rows(rows)
    clean = privacy.sanitised(docs)
    assert clean.columns == docs.columns
    text = {r.doc_id: r.text for r in clean.collect()}
    shown = "" if want[0, "zaphod"] >= privacy.REMOVE else "[word]"
    assert text[1] == f"{shown} wrote from [email] about common words" and text[2] == f"here {shown} [email] again\nzaphod alone"
    assert all(text[i] == t for i, t in rows if i >= 4 and i != 4) and text[4] == "trillian [email]"


def test_lines_meet_only_the_strong_terms_they_hold(odd_rows):
    docs = odd_rows([(i, f"a@b.cd t{i // 2} {'x' if i % 2 else 'y'}") for i in range(12)])
    rows = privacy.keyed(docs).select("k1", "k2", "doc_id", "text")
    lines = privacy._lines(rows)
    plan = privacy.disclosing(rows, lines, privacy.base_spans(lines))._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join Inner, \(\(entity#\d+ = entity#\d+\) AND \(term#\d+ = term#\d+\)\)", plan)


def test_sanitised_leaves_clean_rows_alone(odd_rows):
    rows = [(1, None), (2, ""), (None, "no data é"), (3, "a@b.cd"), (3, "a@b.cd"), (4, "+1.2.3.4 a@b.cd!")]
    got = Counter((r.doc_id, r.text, r["a b"]) for r in privacy.sanitised(odd_rows(rows)).collect())
    assert got == Counter([(1, None, 7), (2, "", 7), (None, "no data é", 7), (3, "[email]", 7), (3, "[email]", 7), (4, "+[ip] [email]!", 7)])
    assert privacy.sanitised(odd_rows([])).count() == 0
