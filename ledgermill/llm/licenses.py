"""License scan: an exact containment join of text blocks with license templates, in DataFrame functions only.

Tokens of the templates are ordered by the number of documents of the whole corpus that hold them, rarest first. With
o = ceil(threshold * size) tokens needed, a block that meets the threshold holds one of the size - o + 1 first tokens of
the template (prefix filter), has o template tokens at least (length filter), and the tokens from a shared one on
must suffice on both sides (positional filter). Blocks that pass are compared token by token, so the join is exact.
The templates are a short list given by the caller, and all that is sent to the executors.

Licenses differ from each other by a word or two, which a share of tokens does not see. So a template may name tokens that
a block needs, whatever its share (`mit`), and tokens that bar it (`lesser` bars the notice without that word).

Every text is cut into words once. What the join needs of all documents, the template tokens each holds, is written
with the base columns; blocks are made only of texts that contain one of the first tokens.

A block is BLOCK consecutive words of one document, a new one every BLOCK / 2 words; the last may be shorter.

Rows: null text is empty (no words, no labels, score 0); repeated rows give a row each; null doc_id is allowed; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.store import keyed, written

THRESHOLD = 0.8
BLOCK = 64
#: phrases whose places are always reported, with their labels (fixed values)
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


class Template(NamedTuple):
    """Label and wording; words that a block must hold all of, and words of which it may hold none."""

    label: str
    wording: str
    needs: str = ""
    bars: str = ""


_NO_CC = "noncommercial sharealike noderivatives noderivs"
_NO_GPL = "lesser affero library"
#: sentences by which notices begin or refer to a license (fixed values)
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache 2"),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "compliance obtain copy"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution binary forms permitted"),
    Template("bsd", "released under the bsd license", "bsd"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution", _NO_CC),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc nc", "sa nd"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons noncommercial", "sharealike noderivatives noderivs"),
    Template("cc-by-nc-sa", "licensed under cc by nc sa 4 0", "cc nc sa"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc sa", "nc nd"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", "creative commons sharealike", "noncommercial"),
    Template("cc0", "this work has been dedicated to the public domain", "dedicated public domain"),
    Template("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public", _NO_GPL),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general redistribute", _NO_GPL),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission fee granted"),
    Template("lgpl", "licensed under the terms of the gnu lesser general public license", "gnu lesser"),
    Template("mit", "released under the mit license", "mit"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission granted charge obtaining"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    Template("reserved", "copyright all rights reserved", "rights reserved"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
)
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    spaced = F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), _NO_WORD, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _starts(found: Column, phrase: str) -> Column:
    """Word numbers at which a phrase starts; texts without all its words are not walked through."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        good = F.get(found, i) == parts[0]
        for n, part in enumerate(parts[1:], 1):
            good = good & (F.get(found, i + n) == part)
        return good

    some = F.array_contains(found, parts[0])
    for part in parts[1:]:
        some = some & F.array_contains(found, part)
    none = F.array().cast("array<int>")
    return F.when(some, F.filter(F.sequence(F.lit(0), F.size(found) - 1), here)).otherwise(none)


def _vocabulary(templates) -> list[str]:
    return sorted({w for t in map(_template, templates) for w in f"{t.wording} {t.needs} {t.bars}".split()})


def _template(given) -> Template:
    return Template(*given)


def _order(held: DataFrame, templates) -> dict[str, int]:
    """Place of each template token in the order from rare to frequent, ties by token: one count for each is fetched.
    held: for every document `tokens`, those of the templates that it holds, each once."""
    counts = {r.token: r.n for r in held.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()}
    return {t: n for n, t in enumerate(sorted(_vocabulary(templates), key=lambda t: (counts.get(t, 0), t)))}


def _held(found: Column, templates) -> Column:
    return F.array_intersect(found, F.array(*map(F.lit, _vocabulary(templates))))


def _first(templates, order: dict[str, int], threshold: float) -> list[tuple[Template, list[str], int]]:
    """Each template with its tokens in order, and how many are needed."""
    out = []
    for t in map(_template, templates):
        tokens = sorted(set(t.wording.split()), key=order.__getitem__)
        out.append((t, tokens, math.ceil(threshold * len(tokens) - 1e-9)))
    return out


def matches(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, block: int = BLOCK, order: dict[str, int] | None = None) -> DataFrame:
    """k1, k2, first (word number of the block), label, share for every block and template of which the block holds
    `threshold` of the tokens. docs: k1, k2, words. Longer templates than any block is sure to hold whole are refused."""
    if longest := [t[0] for t in templates if len(t[1].split()) > block - block // 2 + 1]:
        raise ValueError(f"templates of more than {block - block // 2 + 1} words need larger blocks than {block}: {longest}")
    order = order or _order(docs.select(_held(F.col("words"), templates).alias("tokens")), templates)
    ordered = _first(templates, order, threshold)
    index = [
        (order[w], i, len(tokens), needed, t.label, [order[x] for x in tokens], [order[x] for x in t.needs.split()], [order[x] for x in t.bars.split()])
        for t, tokens, needed in ordered
        for i, w in enumerate(tokens[: len(tokens) - needed + 1])
    ]
    spark = docs.sparkSession
    heads = spark.createDataFrame(index, "rank int, i int, size int, needed int, label string, tokens array<int>, needs array<int>, bars array<int>")
    ranks = F.create_map(*[x for t, rank in order.items() for x in (F.lit(t), F.lit(rank))])
    blocks = (
        docs.filter(F.arrays_overlap("words", F.array(*map(F.lit, _first_tokens(ordered)))))
        .select("k1", "k2", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1, F.lit(block // 2))).alias("first"))
        .select("k1", "k2", "first", _held(F.slice("words", F.col("first") + 1, block), templates).alias("held"))
        .filter(F.size("held") >= min(needed for _, _, needed in ordered))
        .select("k1", "k2", "first", F.array_sort(F.transform("held", lambda t: F.element_at(ranks, t))).alias("held"))
    )
    tokens = blocks.select("*", F.posexplode("held").alias("j", "rank"))
    pairs = tokens.join(F.broadcast(heads), "rank").filter(
        (F.size("held") >= F.col("needed")) & (F.least(F.col("size") - F.col("i"), F.size("held") - F.col("j")) >= F.col("needed"))
    )
    shared = F.size(F.array_intersect("held", "tokens"))
    told = (F.size(F.array_except("needs", "held")) == 0) & ~F.arrays_overlap("bars", "held")
    return pairs.filter((shared >= F.col("needed")) & told).select("k1", "k2", "first", "label", (shared / F.col("size")).alias("share"))


def _first_tokens(ordered: list[tuple[Template, list[str], int]]) -> list[str]:
    return sorted({w for _, tokens, needed in ordered for w in tokens[: len(tokens) - needed + 1]})


def _base(rows: DataFrame) -> DataFrame:
    """k1, k2, doc_id, tokens and the columns that the phrases decide."""
    starts = {label: _starts(F.col("words"), phrase) for phrase, label in PHRASES.items()}
    labels = F.array_compact(F.array(*[F.when(F.size(F.col(f"at_{n}")) > 0, F.lit(label)) for n, label in enumerate(starts)]))
    keys = ["k1", "k2", "doc_id", "tokens"]
    return (
        rows.select(*keys, F.size("words").cast("long").alias("n_words"), *[s.alias(f"at_{n}") for n, s in enumerate(starts.values())])
        .select(*keys, "n_words", F.flatten(F.array(*[f"at_{n}" for n in range(len(starts))])).alias("at"), labels.alias("base"))
        .select(
            *[*keys, "n_words", "base"],
            F.size("at").cast("long").alias("n_base"),
            F.array_min("at").cast("long").alias("first_word"),
            F.array_max("at").cast("long").alias("last_word"),
        )
    )


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the template matches of each row.

    score: 1 where a phrase stands, else the largest share of a template's tokens that a matching block holds, else 0."""
    texts = keyed(docs)
    cut = texts.select("k1", "k2", "doc_id", words(F.col("text")).alias("words"))
    base = written(_base(cut.withColumn("tokens", _held(F.col("words"), templates))))
    order = _order(base, templates)
    # lower() may change more than A-Z, but never loses one of these plain tokens
    low = F.lower("text")
    near = F.lit(False)
    for token in _first_tokens(_first(templates, order, threshold)):
        near = near | F.contains(low, F.lit(token))
    likely = texts.select("k1", "k2", "text").filter(near).select("k1", "k2", words(F.col("text")).alias("words"))
    found = (
        matches(likely, templates, threshold, block, order)
        .groupBy("k1", "k2")
        .agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    )
    both = F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>"))))
    return base.join(found, ["k1", "k2"], "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _sql() -> str:
    """DuckDB SQL for scan(): every block against every template."""
    listed = lambda words: f"{sorted(set(words.split()))}::VARCHAR[]"
    templates = ", ".join(f"('{t.label}', {listed(t.wording)}, {listed(t.needs)}, {listed(t.bars)})" for t in TEMPLATES)
    starts = []
    for phrase in PHRASES:
        tests = " AND ".join(f"ws[i + {n}] = '{part}'" for n, part in enumerate(phrase.split()))
        starts.append(f"list_filter(range(1, len(ws) + 1), lambda i: {tests})")
    labels = ", ".join(f"CASE WHEN len(a{n}) > 0 THEN '{label}' END" for n, label in enumerate(PHRASES.values()))
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
t(label, tokens, needs, bars) AS (VALUES {templates}),
b AS (SELECT doc_id, list_distinct(ws[s + 1:s + {BLOCK}]) AS held FROM (SELECT doc_id, ws, unnest(range(0, len(ws), {BLOCK // 2})) AS s FROM w)),
m AS (SELECT doc_id, label, len(list_intersect(held, tokens)) / len(tokens) AS share FROM b, t
    WHERE len(list_intersect(held, tokens)) >= ceil({THRESHOLD} * len(tokens) - 1e-9)
        AND list_has_all(held, needs) AND NOT list_has_any(held, bars)),
g AS (SELECT doc_id, list(DISTINCT label) AS more, max(share) AS share FROM m GROUP BY doc_id),
p AS (SELECT doc_id, ws, {", ".join(f"{s} AS a{n}" for n, s in enumerate(starts))} FROM w),
q AS (SELECT doc_id, len(ws) AS n, list_concat(a0, list_concat(a1, a2)) AS places, list_filter([{labels}], lambda x: x IS NOT NULL) AS base FROM p)
SELECT q.doc_id, n::BIGINT AS n_words, len(places)::BIGINT AS n_base, (list_min(places) - 1)::BIGINT AS first_word,
    (list_max(places) - 1)::BIGINT AS last_word, array_to_string(list_sort(base), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') AS labels,
    CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM q LEFT JOIN g USING (doc_id)"""


SQL = _sql()
