"""The corpus pipeline, stage by stage and whole, against plain Python."""

import re

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from fieldlake.llm.bpe import public_tokenizer
from fieldlake.llm.quality import score_quality
from tests.llm.test_simhash import brute_groups, brute_print

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def rows_of(df):
    return sorted(map(tuple, df.select(*corpus_pipeline.COLUMNS).collect()), key=str)


def made(rows):
    return [(i, t, "en", "web", None if t is None else len(t)) for i, t in rows]


def brute_quality(spark, docs, labels):
    """Decisions by text: the score depends on nothing else."""
    texts = sorted({t or "" for _, t, *_ in docs})
    one_each = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = [(texts.index(t or ""), label) for i, t, *_ in docs for j, label in labels if i == j and i is not None]
    fitted = spark.createDataFrame(known, "doc_id long, label int")
    scores = {texts[r.doc_id]: r.score for r in score_quality(one_each, fitted, F.lit(False)).collect()}
    return [d for d in docs if scores[d[1] or ""] >= 0.5]


def brute_near_copies(docs):
    group = brute_groups({n: brute_print(d[1]) for n, d in enumerate(docs)}, 2)
    best = {}
    for n, d in enumerate(docs):
        best.setdefault(group[n], []).append(d)
    return best.values()


def brute_repeats(docs, length=50):
    out = []
    order = lambda d: (d[0] is None, d[0] or 0)
    for d in docs:
        earlier, text = set(), (d[1] or "").encode()
        for e in docs:
            if order(e) < order(d):
                raw = (e[1] or "").encode()
                earlier |= {raw[k : k + length] for k in range(len(raw) - length + 1)}
        gone = set()
        for k in range(len(text) - length + 1):
            if text[k : k + length] in earlier:
                gone |= set(range(k, k + length))
        left = bytes(b for k, b in enumerate(text) if k not in gone).decode(errors="ignore")
        out.append((d[0], left, *d[2:4], len(left)))
    return out


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def brute_passages(docs, items):
    windows = set()
    for _, text in items:
        words = WORD.findall(lower(text or ""))
        windows |= {tuple(words[k : k + 10]) for k in range(max(1, len(words) - 9))} - {()}
    out = []
    for d in docs:
        if d[1] is None:
            out.append(d)
            continue
        found = list(WORD.finditer(lower(d[1])))
        words, hit = [m.group() for m in found], set()
        for window in windows:
            for k in range(len(words) - len(window) + 1):
                if tuple(words[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
        left, cut = "", 0
        for k in sorted(hit):
            start = found[k].start() if k - 1 not in hit else cut
            left, cut = left + d[1][cut:start], found[k].end()
        out.append((*d[:1], left + d[1][cut:], *d[2:4], len(left) + len(d[1]) - cut))
    return out


def brute_tokens(docs):
    ranks, pattern = public_tokenizer()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    ids = [(d[0], library.encode_ordinary(d[1] or "")) for d in docs]
    return sorted([(i, len(x), x, True) for i, x in ids], key=str)


def tokens_of(df):
    return sorted(map(tuple, df.select("doc_id", "n_tokens", "ids", "round_trip").collect()), key=str)


@pytest.fixture
def corpus(prose):
    rows = list(enumerate(prose[:24]))
    rows += [(30, None), (31, ""), (None, ""), (None, prose[2]), (None, "only here " * 20), (None, "ONLY here " * 20)]
    rows += [(40, "one id, one text " + prose[30]), (40, "one id, another " + prose[31]), (41, prose[32]), (41, prose[32])]
    rows += [(50, "é" * 90), (51, "x " + "é" * 70), (None, prose[5][:200] + " and then an end of its own")]
    return made(rows)


@pytest.fixture
def folder(spark, tmp_path, prose, corpus):
    items = [("a", " ".join(WORD.findall(prose[3])[:25])), (None, "only here only"), ("b", None), ("a", "Zz 9")]
    labels = [(n, n % 2) for n in range(12)] + [(None, 0), (40, 1), (99, 0), (13, None)]
    spark.createDataFrame(corpus, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), items, [(i, x) for i, x in labels if x is not None]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumn("mark", F.lit(1)).withColumn("component", F.lit("x"))


def test_quality_judges_every_row(spark, folder, corpus):
    kept = corpus_pipeline.quality(spark, frame(spark, corpus), folder[0])
    want = brute_quality(spark, corpus, folder[2])
    assert 0 < len(want) < len(corpus)
    assert rows_of(kept) == sorted(want, key=str)


def test_one_row_of_each_group_stays(spark, folder, corpus):
    kept = rows_of(corpus_pipeline.near_copies(spark, frame(spark, corpus), folder[0]))
    groups = list(brute_near_copies(corpus))
    assert len(kept) == len(groups)
    for group in groups:
        ids = [d[0] for d in group if d[0] is not None]
        least = min(ids) if ids else None
        assert len([d for d in kept if d in group and d[0] == least]) == 1


def test_equal_rows_of_one_id(spark, folder):
    rows = made([(1, "a b c d")] * 5 + [(None, "e f g h")] * 4)
    assert rows_of(corpus_pipeline.near_copies(spark, frame(spark, rows), folder[0])) == [rows[0], rows[-1]]


def test_repeats_are_cut(spark, folder, corpus):
    got = corpus_pipeline.repeats(spark, frame(spark, corpus), folder[0])
    assert rows_of(got) == sorted(brute_repeats(corpus), key=str)


def test_benchmark_passages_are_cut(spark, folder, corpus):
    got = corpus_pipeline.benchmark_passages(spark, frame(spark, corpus), folder[0])
    want = brute_passages(corpus, folder[1])
    assert want != corpus and rows_of(got) == sorted(want, key=str)


def test_run_is_its_stages_one_after_another(spark, folder, corpus):
    docs = brute_quality(spark, corpus, folder[2])
    first = lambda d: (d[0] is None, d[0] or 0, d[1] or "")
    docs = [min(group, key=first) for group in brute_near_copies(docs)]
    docs = brute_passages(brute_repeats(docs), folder[1])
    assert tokens_of(corpus_pipeline.run(spark, folder[0])) == brute_tokens(docs)


def test_empty_tables(spark, tmp_path):
    for name, kinds in [("documents", DOCS), ("benchmark", "item_id string, text string"), ("labels", "doc_id long, quality int")]:
        spark.createDataFrame([], kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_nothing_to_learn_from_rejects_nothing(spark, tmp_path, corpus):
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert rows_of(corpus_pipeline.quality(spark, frame(spark, corpus), str(tmp_path))) == sorted(corpus, key=str)
