import numpy as np
from pyspark.sql import functions as F

from fieldlake.llm.quality import STATISTICS, class_moments, document_statistics, fit, remainder, score_quality


def labelled(spark, docs, prose):
    good = [(n, text, 1) for n, text in enumerate(prose)]
    bad = [(100 + n, " | ".join(text.upper().split()) + "!!", 0) for n, text in enumerate(prose)]
    rows = [(n, text) for n, text, _ in good + bad]
    labels = spark.createDataFrame([(n, label) for n, _, label in good + bad], "doc_id long, label int")
    return docs(rows), labels


def test_separates_held_out_rows(spark, docs, prose):
    table, labels = labelled(spark, docs, prose)
    held = remainder("doc_id", 3) == 1
    scored = score_quality(table, labels, held).join(labels, "doc_id").filter(held).collect()
    assert len(scored) > 20
    assert np.mean([(r.score >= 0.5) == (r.label == 1) for r in scored]) >= 0.95


def test_log_density_difference(spark, docs, prose):
    """The score is that of two Gaussians written out with inverses and determinants."""
    table, labels = labelled(spark, docs, prose)
    measured = document_statistics(table).join(labels, "doc_id")
    model = fit(class_moments(measured))
    rows = measured.collect()
    values = np.array([r.statistics for r in rows])
    scaled, logs = values / model.scale, []
    for mean, factor, label in zip(model.means, model.factors, (0, 1)):
        covariance = np.linalg.inv(factor.T @ factor)
        gap = scaled - mean
        share = (sum(r.label == label for r in rows) + 1) / (len(rows) + 2)
        logs.append(np.log(share) - 0.5 * np.linalg.slogdet(covariance)[1] - 0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(covariance), gap))
    want = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
    assert np.allclose(model.score(values), want, atol=1e-6)


def test_odd_rows(spark, docs, prose):
    table, labels = labelled(spark, docs, prose)
    odd = docs([(900, None), (901, ""), (902, "\n\n"), (903, "w " * 200_000), (None, "th er"), (904, "a"), (904, "a")])
    labels = labels.union(spark.createDataFrame([(0, None), (None, 1), (5, 1)], "doc_id long, label int"))
    scores = score_quality(table.union(odd), labels, F.lit(None).cast("boolean")).collect()
    assert len(scores) == 127 and all(0 <= r.score <= 1 for r in scores)


def test_without_rows_or_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, label int")
    assert score_quality(docs([]), none, F.lit(False)).count() == 0
    assert [r.score for r in score_quality(docs([(1, "th")]), none, F.lit(False)).collect()] == [0.5]


def test_statistics_do_not_depend_on_neighbours(docs, prose):
    alone = {r.doc_id: r.statistics for n, t in enumerate(prose[:3]) for r in document_statistics(docs([(n, t)])).collect()}
    together = {r.doc_id: r.statistics for r in document_statistics(docs(list(enumerate(prose[:3])))).collect()}
    assert alone == together and all(len(s) == STATISTICS for s in alone.values())
