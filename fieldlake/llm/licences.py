"""Licence scan by a positional index of rare licence words.

A template is a passage by which a licence is told, with key phrases that must stand in it.
Document frequencies over all texts give each template its rarest words, and the index holds
their places in it. A text looks up those of its words that are in the index; a posting at the
same distance from several words puts the template at one relative position. Where the words
that agree have enough of the template's weight, the key phrases are verified in the text.

Everything is an expression on a row; only the frequencies, as many as the templates have
words, are shuffled and reach the driver.
"""

from __future__ import annotations

import functools
import json
import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.common import documents
from fieldlake.llm.registry import query

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rarest words of a template that the index holds.
RARE_WORDS = 4
#: Share of the weight of a template's indexed words that must agree on one position.
AGREEING = 0.6
#: Words around the aligned passage in which a key phrase may stand, after insertions.
SLACK = 12


def words_in(text: str) -> tuple[str, ...]:
    """Words of a short text of our own, by the same rule as in documents."""
    return tuple(re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER))))


@dataclass(frozen=True)
class Template:
    """A passage that tells a licence; ``keys`` must stand in or near it, word for word."""

    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False

    @property
    def words(self) -> tuple[str, ...]:
        return words_in(self.text)


def phrase(label: str, text: str) -> Template:
    """A phrase that counts wherever its words stand consecutively."""
    return Template(label, text, (text,), True)


#: Fixed values, as dealt: phrases and labels.
PHRASES = (
    phrase("gpl", "gnu general public license"),
    phrase("apache", "apache license"),
    phrase("cc-by", "cc by"),
    phrase("mit", "mit license"),
)

#: Passages of public licences and notices, with what must stand in them.
TEMPLATES = (
    Template("gpl", "licensed under the GNU General Public License, version 3", ("gnu general public license",)),
    Template("gpl-3", "licensed under the GNU General Public License, version 3", ("gnu general public license version 3",)),
    Template("gpl-2", "licensed under the GNU General Public License, version 2", ("gnu general public license version 2",)),
    Template("gpl", "redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", ("gnu general public license", "free software foundation")),
    Template("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ("gnu affero general public license",)),
    Template("gfdl", "copy, distribute and/or modify this document under the terms of the GNU Free Documentation License", ("gnu free documentation license",)),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template("apache-2.0", "you may not use this file except in compliance with the License", ("you may not use this file except in compliance with the license",)),
    Template("mit", "Released under the MIT License", ("mit license",)),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("for any purpose with or without fee is hereby granted",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", ("redistribution and use in source and binary forms",)),
    Template("bsd-3", "may be used to endorse or promote products derived from this software without specific prior written permission", ("endorse or promote products derived from this software",)),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license v 2 0",)),
    Template("epl", "made available under the terms of the Eclipse Public License", ("eclipse public license",)),
    Template("bsl-1.0", "Distributed under the Boost Software License, Version 1.0", ("boost software license version 1 0",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("cc0", "dedicated to the public domain under CC0 1.0 Universal", ("cc0 1 0",)),
    Template("cc-by", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0 international license",)),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", ("cc by sa",)),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ("creative commons attribution sharealike",)),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", ("creative commons attribution noncommercial",)),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0", ("cc by nd",)),
    Template("cc-by-nd", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", ("creative commons attribution noderivatives",)),
)


def words_of(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and ``words``, those of a whole text in order; none of a null one.

    Split at what is between words, which is linear in the text; the first and the last part
    are empty where a text starts or ends between words.
    """
    lower = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    parts = F.col("_parts")
    before = (F.get(parts, F.lit(0)) == "").cast("int")
    after = ((F.size(parts) > 1) & (F.get(parts, F.size(parts) - 1) == "")).cast("int")
    words = F.slice(parts, before + 1, F.size(parts) - before - after)
    return docs.select(*columns, F.split(lower, BETWEEN, -1).alias("_parts")).select(*columns, words.alias("words"))


def word_weights(docs: DataFrame, templates: tuple[Template, ...]) -> dict[str, float]:
    """Inverse document frequency of every word of the templates, over all documents."""
    vocabulary = sorted({word for template in templates for word in template.words})
    held = F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))
    # the empty word stands for the document itself
    each = words_of(docs).select(F.explode(F.concat(F.array(F.lit("")), held)).alias("word"))
    counts = {row["word"]: row["n"] for row in each.groupBy("word").agg(F.count("*").alias("n")).collect()}
    total = counts.get("", 0)
    return {word: math.log((total + 1) / (counts.get(word, 0) + 1)) + 1 for word in vocabulary}


@dataclass(frozen=True)
class Posting:
    """A place of an indexed word in a template, and its share of the indexed weight."""

    template: int
    at: int
    share: float


def rare_index(templates: tuple[Template, ...], weights: dict[str, float], rare: int = RARE_WORDS) -> dict[str, list[Posting]]:
    """Postings by word: all places in a template of its ``rare`` words of highest weight.

    Of a base phrase one word is enough, as its words are verified one by one.
    """
    index: dict[str, list[Posting]] = {}
    for number, template in enumerate(templates):
        words = template.words
        chosen = sorted(set(words), key=lambda w: (-weights[w], w))[: 1 if template.base else rare]
        places = [at for at, word in enumerate(words) if word in chosen]
        if template.base:
            places = places[:1]
        total = sum(weights[words[at]] for at in places)
        for at in places:
            index.setdefault(words[at], []).append(Posting(number, at, weights[words[at]] / total))
    return index


def _postings(word: Column, index: dict[str, list[Posting]]) -> Column:
    """Postings of a word as an array of (template, at, share)."""
    kind = "map<string,array<struct<t: int, at: int, share: double>>>"
    table = {w: [{"t": p.template, "at": p.at, "share": p.share} for p in found] for w, found in index.items()}
    return F.from_json(F.lit(json.dumps(table)), kind)[word]


def _standing(words: Column, shift: Column, template: Template) -> Column:
    """Whether the template's key phrases stand at (base) or near an aligned passage."""
    size = len(template.words)
    if template.base:
        exact = F.array_join(F.slice(words, shift + 1, F.lit(size)), " ") == " ".join(template.words)
        return F.when(shift >= 0, exact).otherwise(F.lit(False))
    first = F.greatest(shift - SLACK, F.lit(0))
    around = F.slice(words, first + 1, F.greatest(shift + size + SLACK - first, F.lit(0)))
    joined = F.concat(F.lit(" "), F.array_join(around, " "), F.lit(" "))
    return functools.reduce(Column.__and__, [joined.contains(f" {' '.join(words_in(key))} ") for key in template.keys])


def scan_licences(
    docs: DataFrame,
    phrases: tuple[Template, ...] = PHRASES,
    templates: tuple[Template, ...] = TEMPLATES,
) -> DataFrame:
    """doc_id, n_words, places, matches of every row of ``docs`` (doc_id, text).

    ``places`` are the first words (from 0, in order) of all places where a base phrase stands,
    each with its label; ``matches`` are the templates found: label, first word, and the share
    of the weight of its indexed words that agreed there. Null and empty texts have no words.
    Repeated rows are judged each, a null doc_id is kept, an empty table gives no row, equal
    weights are ordered by word, and columns other than the two are not read. A text's words
    must fit into one value of a row.
    """
    known = (*phrases, *templates)
    index = rare_index(known, word_weights(docs.select("text"), known))
    most = max((sum(p.template == n for found in index.values() for p in found) for n in range(len(known))), default=0)
    words = F.col("words")
    placed = F.transform(words, lambda word, at: F.when(word.isin(sorted(index)), at))
    looked = F.transform(
        F.array_compact(placed),
        lambda at: F.transform(
            _postings(F.get(words, at), index),
            lambda p: F.struct(p["t"].alias("t"), (at - p["at"]).alias("shift"), p["at"].alias("at"), p["share"].alias("share")),
        ),
    )
    found = F.col("found")
    same = lambda a, b: (a["t"] == b["t"]) & (a["shift"] == b["shift"])
    agreeing = F.transform(
        found,
        lambda one, i: F.when(
            (i == 0) | ~same(one, F.get(found, i - 1)),
            F.struct(
                one["t"].alias("t"),
                one["shift"].alias("shift"),
                F.aggregate(
                    F.slice(found, i + 1, F.lit(most)),
                    F.lit(0.0),
                    lambda total, other: total + F.when(same(one, other), other["share"]).otherwise(0.0),
                ).alias("share"),
            ),
        ),
    )
    enough = F.filter(F.array_compact(agreeing), lambda c: c["share"] >= AGREEING)
    standing = F.filter(
        F.col("aligned"),
        lambda c: functools.reduce(
            lambda rest, n: F.when(c["t"] == n, _standing(words, c["shift"], known[n])).otherwise(rest),
            range(len(known)),
            F.lit(False),
        ),
    )
    labels = F.array(*[F.lit(template.label) for template in known])
    named = lambda kept: F.transform(
        F.filter(F.col("standing"), kept),
        lambda c: F.struct(c["shift"].cast("long").alias("word"), F.get(labels, c["t"]).alias("label"), c["share"].alias("share")),
    )
    return (
        words_of(docs, "doc_id")
        .select("doc_id", "words", F.array_sort(F.flatten(looked)).alias("found"))
        .select("doc_id", "words", enough.alias("aligned"))
        .select("doc_id", F.size("words").cast("long").alias("n_words"), standing.alias("standing"))
        .select(
            "doc_id",
            "n_words",
            F.array_sort(named(lambda c: c["t"] < len(phrases))).alias("places"),
            F.array_sort(named(lambda c: c["t"] >= len(phrases))).alias("matches"),
        )
    )


def _label_list(*matches: str) -> Column:
    all_labels = F.concat(*[F.col(name)["label"] for name in matches])
    return F.array_join(F.array_sort(F.array_distinct(all_labels)), ",")


def _values(rows: list[tuple]) -> str:
    quoted = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(map(quoted, row)) + ")" for row in rows)


_KNOWN = (*PHRASES, *TEMPLATES)
_SPOTS = _values([(t, at, word) for t, one in enumerate(_KNOWN) for at, word in enumerate(one.words)])
_HEADS = _values([(t, one.label, len(one.words), one.base) for t, one in enumerate(_KNOWN)])
_KEYS = _values([(t, " ".join(words_in(key))) for t, one in enumerate(_KNOWN) for key in one.keys])


@query(
    rf"""WITH spots(t, "at", word) AS (VALUES {_SPOTS}), heads(t, label, size, base) AS (VALUES {_HEADS}),
    keys(t, phrase) AS (VALUES {_KEYS}),
    texts AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
    placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS p FROM texts),
    held AS (SELECT word, count(DISTINCT doc_id) AS n FROM placed WHERE word IN (SELECT word FROM spots) GROUP BY word),
    weights AS (SELECT word, ln(((SELECT count(*) FROM texts) + 1)::DOUBLE / (coalesce(n, 0) + 1)) + 1 AS w
                FROM (SELECT DISTINCT word FROM spots) LEFT JOIN held USING (word)),
    chosen AS (SELECT t, word, w FROM (SELECT t, word, w, base, row_number() OVER (PARTITION BY t ORDER BY w DESC, word) AS place
               FROM (SELECT DISTINCT t, word FROM spots) JOIN weights USING (word) JOIN heads USING (t))
               WHERE place <= CASE WHEN base THEN 1 ELSE {RARE_WORDS} END),
    postings AS (SELECT t, "at", word, w / sum(w) OVER (PARTITION BY t) AS share
                 FROM spots JOIN chosen USING (t, word) JOIN heads USING (t)
                 QUALIFY NOT base OR row_number() OVER (PARTITION BY t ORDER BY "at") = 1),
    aligned AS (SELECT doc_id, t, p - "at" AS shift, sum(share) AS share FROM placed JOIN postings USING (word)
                GROUP BY ALL HAVING sum(share) >= {AGREEING}),
    standing AS (SELECT a.*, label, base FROM aligned a JOIN heads h USING (t) JOIN texts USING (doc_id) JOIN keys k USING (t)
      GROUP BY ALL HAVING bool_and(CASE WHEN base
        THEN shift >= 0 AND array_to_string(words[shift + 1 : shift + size], ' ') = phrase
        ELSE contains(' ' || array_to_string(words[greatest(shift - {SLACK}, 0) + 1 : shift + size + {SLACK}], ' ') || ' ', ' ' || phrase || ' ') END))
    SELECT doc_id, len(any_value(words))::BIGINT AS n_words, count(t) FILTER (base) AS n_base,
      min(shift) FILTER (base)::BIGINT AS first_word, max(shift) FILTER (base)::BIGINT AS last_word,
      coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
      coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
      least(round(coalesce(max(share), 0), 9), 1.0)::DOUBLE AS score
    FROM texts LEFT JOIN standing USING (doc_id) GROUP BY doc_id"""
)
def op11_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents; the score is the best share, 1 where a base phrase stands."""
    found = scan_licences(documents(spark, sf_dir).select("doc_id", "text"))
    start = F.col("places")["word"]
    share = F.array_max(F.concat(F.col("places")["share"], F.col("matches")["share"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"),
        F.array_max(start).alias("last_word"),
        _label_list("places").alias("base_labels"),
        _label_list("places", "matches").alias("labels"),
        F.least(F.round(F.coalesce(share, F.lit(0.0)), 9), F.lit(1.0)).alias("score"),
    )
