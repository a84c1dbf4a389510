import math
import re
from collections import Counter

import pytest

from fieldlake.llm.licences import (
    AGREEING,
    PHRASES,
    RARE_WORDS,
    SLACK,
    TEMPLATES,
    Template,
    op11_licence_scan,
    scan_licences,
)
from fieldlake.llm.registry import ORACLES
from tests.oracle import connect, differences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, phrases=PHRASES, templates=TEMPLATES):
    """Every base phrase at every place; every template at every shift, with all weights spelled out."""
    texts = [(doc, words(text)) for doc, text in rows]
    df = Counter(w for _, t in texts for w in set(t))
    weight = lambda w: math.log((len(texts) + 1) / (df[w] + 1)) + 1
    out = []
    for doc, t in texts:
        places = [
            (at, one.label)
            for one in phrases
            for at in range(len(t) - len(one.words) + 1)
            if tuple(t[at : at + len(one.words)]) == one.words
        ]
        found = []
        for one in templates:
            rare = sorted(set(one.words), key=lambda w: (-weight(w), w))[:RARE_WORDS]
            total = sum(weight(w) for w in one.words if w in rare)
            for shift in range(-len(one.words), len(t)):
                got = sum(weight(w) for at, w in enumerate(one.words) if w in rare and 0 <= shift + at < len(t) and t[shift + at] == w)
                near = " ".join(["", *t[max(shift - SLACK, 0) : max(shift + len(one.words) + SLACK, 0)], ""])
                if got / total >= AGREEING and all(f" {' '.join(words(key))} " in near for key in one.keys):
                    found.append((shift, one.label, round(got / total, 9)))
        out.append((doc, len(t), sorted(places), sorted(found)))
    return sorted(out, key=str)


def got(found):
    return sorted(
        (
            (r.doc_id, r.n_words, [(p.word, p.label) for p in r.places], [(m.word, m.label, round(m.share, 9)) for m in r.matches])
            for r in found.collect()
        ),
        key=str,
    )


TEXTS = [
    "This work is licensed under the GNU General Public License, version 3.",
    "x\nLicensed under the Apache License, Version 2.0. apache LICENSE",
    "Apache License Apache-License; apachelicense Apache é License",
    "cc by cc by cc-by-nc. Licensed under CC BY-NC 4.0.",
    "MIT License",
    "license mit apache gnu general public",
    "GNU General Public License GNU General Public License",
    "Permission is hereby granted, free of charge, to any person, or to none, obtaining a copy of this software",
    "permission granted charge person obtaining software documentation",
    "Redistribution and use, in source and binary forms with or without modification are permitted",
    "This file may be distributed under the terms of the Mozilla Public License, v. 2.0; GNU Lesser General Public License",
    "general public license",
    "gnu general public",
]


def test_same_as_brute_force(spark, docs, prose):
    rows = list(enumerate([*TEXTS, *prose])) + [(200, None), (201, ""), (202, "..."), (203, TEXTS[0]), (203, TEXTS[0]), (None, TEXTS[1])]
    rows += [(204, "license " * 20_000 + "mit license"), (205, "ééé" * 50_000)]
    assert got(scan_licences(docs(rows).repartition(3))) == brute(rows)


def test_keys_and_insertions(spark, docs):
    mine = (Template("own", "red green blue grey black", ("green blue",)),)
    rows = [
        (1, "red green blue grey black"),
        (2, "red green x blue grey black"),  # the key phrase is broken
        (3, "red green blue x grey black"),  # two positions, neither with enough of the weight
        (4, "x y red green blue grey z"),
        (5, "green blue"),
    ]
    found = got(scan_licences(docs(rows), (), mine))
    assert found == brute(rows, (), mine)
    assert [len(r[3]) for r in found][0] == 1 and [len(r[3]) for r in found][4] == 0


def test_query_columns_and_empty_table(spark, docs, tmp_path):
    path = str(tmp_path / "documents.parquet")
    docs([(1, "a MIT license, mit License b"), (2, None)]).write.parquet(path)
    rows = {r.doc_id: r for r in op11_licence_scan(spark, str(tmp_path)).collect()}
    assert tuple(rows[1]) == (1, 6, 2, 1, 3, "mit", "mit", 1.0)
    assert tuple(rows[2]) == (2, 0, 0, None, None, "", "", 0.0)
    assert scan_licences(docs([])).count() == 0


def test_no_python_and_no_shuffle_of_documents(spark, sf_dir, plan_of):
    plan = plan_of(op11_licence_scan(spark, sf_dir))
    assert not re.search("Python|Pandas|InArrow|Exchange", plan)


def test_same_rows_as_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    whole = lambda frame: frame.assign(
        **{c: frame[c].fillna(-1).astype("int64") for c in ("first_word", "last_word")}
    )
    found = whole(op11_licence_scan(spark, sf_dir).toPandas())
    expected = whole(connect(sf_dir).execute(ORACLES["op11_licence_scan"]).df())
    assert len(found) == 1000 and differences(found, expected) == []


@pytest.mark.parametrize("template", TEMPLATES)
def test_every_template_finds_itself(template):
    assert len(set(template.words)) >= 3
    joined = f" {' '.join(template.words)} "
    assert all(f" {' '.join(words(key))} " in joined for key in template.keys)
