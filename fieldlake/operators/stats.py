"""Linear fits, feature importance, attributions, and the two-sample Kolmogorov-Smirnov test."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.numeric import to_double
from fieldlake.operators.mapping import first_present
from fieldlake.operators.ranges import running_totals

# Fixed value: names a yield column goes by, in order of preference.
TARGETS = ["yield", "crop_yield", "YIELD", "Yield"]


def linear_fit(
    df: DataFrame,
    x: str,
    y: str,
    by: list[str] | None = None,
    missing_target: str = "drop",
) -> DataFrame:
    """``coef, intercept, r2, n`` of y on x, overall or per group, in one aggregate.

    A constant x gives slope 0 and the mean of y. ``missing_target`` is ``drop`` or ``zero``.
    """
    target = to_double(F.col(y))
    if missing_target == "zero":
        target = F.coalesce(target, F.lit(0.0))
    elif missing_target != "drop":
        raise ValueError(f"unknown missing_target {missing_target!r}")
    keys = by or []
    points = df.select(*keys, to_double(F.col(x)).alias("_x"), target.alias("_y")).dropna(
        subset=["_x", "_y"]
    )
    sums = points.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("_y").alias("mean"),
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_intercept("_y", "_x").alias("start"),
        F.regr_r2("_y", "_x").alias("fit"),
        F.regr_syy("_y", "_x").alias("syy"),
    )
    return sums.select(
        *keys,
        F.coalesce("slope", F.lit(0.0)).alias("coef"),
        F.coalesce("start", "mean").alias("intercept"),
        F.when(F.col("syy") == 0, 1.0).otherwise(F.coalesce("fit", F.lit(0.0))).alias("r2"),
        "n",
    )


def fit_yield(df: DataFrame, x: str = "moisture") -> DataFrame | None:
    """Fit of the first yield-like column on ``x``, its gaps as 0; None without such a column."""
    target = first_present(df, TARGETS)
    return None if target is None else linear_fit(df, x, target, missing_target="zero")


def model_summary(fit: DataFrame | None, df: DataFrame) -> DataFrame:
    """One row ``status, coef, intercept, r2, n`` to be stored next to the data."""
    empty = F.lit(None).cast("double")
    if fit is None:
        one = df.sparkSession.range(1)
        return one.select(
            F.lit("target not found").alias("status"),
            empty.alias("coef"),
            empty.alias("intercept"),
            empty.alias("r2"),
            F.lit(0).cast("bigint").alias("n"),
        )
    status = F.when(F.col("n") > 0, "fitted").otherwise("no complete rows")
    return fit.select(status.alias("status"), "coef", "intercept", "r2", "n")


def _gram_kernel(means: np.ndarray):
    """Sums and products of a task's rows around ``means``, a number per place."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(means)
        sums, products, count = np.zeros(size), np.zeros((size, size)), 0
        for batch in batches:
            rows = np.stack([column.to_numpy() for column in batch.columns], axis=1) - means
            sums += rows.sum(axis=0)
            products += rows.T @ rows
            count += len(rows)
        if count:
            values = np.concatenate([[count], sums, products.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["place", "value"])

    return kernel


def _moments(df: DataFrame, features: list[str], target: str) -> tuple[np.ndarray, np.ndarray]:
    """Means and covariances of all features and the target, gaps as 0.

    One pass for the means, one that multiplies whole batches around them; each task sends
    (p+1)(p+2)+1 numbers, which are summed by place, however many rows there are.
    """
    names = [*features, target]
    numbers = df.select(
        *[F.coalesce(to_double(F.col(c)), F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(names)]
    )
    first = numbers.agg(*[F.avg(f"v{i}") for i in range(len(names))]).first()
    means = np.array([0.0 if mean is None else mean for mean in first])
    placed = numbers.mapInArrow(_gram_kernel(means), "place long, value double")
    total = placed.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    size = len(names)
    values = np.zeros(1 + size + size * size)
    values[total.column("place").to_numpy()] = total.column("value").to_numpy()
    count = max(1.0, values[0])
    left = values[1 : 1 + size] / count  # what rounding has left of the means
    return means, values[1 + size :].reshape(size, size) / count - np.outer(left, left)


def _correlations(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(correlations of the features, those with the target, units), so that units do not matter."""
    unit = np.sqrt(np.maximum(cov.diagonal(), 0.0))
    unit = np.where(unit > 0, unit, 1.0)
    corr = cov / np.outer(unit, unit)
    return corr[:-1, :-1], corr[:-1, -1], unit


def _factorised(inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pseudo-inverse of correlations, and per feature its share outside of their span."""
    values, vectors = np.linalg.eigh(inner)
    kept = values > 1e-10 * max(1.0, values.max(initial=0.0))
    spanned = vectors[:, kept]
    return (spanned / values[kept]) @ spanned.T, 1 - (spanned**2).sum(axis=1)


def _solve(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients and R-squared of the last variable; collinear features share the effect."""
    if cov[-1, -1] <= 0:
        return np.zeros(len(cov) - 1), 1.0
    inner, outer, unit = _correlations(cov)
    beta = _factorised(inner)[0] @ outer
    return beta * unit[-1] / unit[:-1], float(2 * beta @ outer - beta @ inner @ beta)


def _drops(cov: np.ndarray) -> np.ndarray:
    """What R-squared loses without each feature, all from one factorisation.

    Holding a coefficient at 0 costs its square over its place in the inverse; nothing where
    other features make up for it.
    """
    if cov[-1, -1] <= 0:
        return np.zeros(len(cov) - 1)
    inner, outer, _ = _correlations(cov)
    inverse, outside = _factorised(inner)
    place = inverse.diagonal()
    known = (outside < 1e-6) & (place > 0)
    return np.where(known, (inverse @ outer) ** 2 / np.where(known, place, 1.0), 0.0)


def numeric_columns(df: DataFrame, without: list[str] = []) -> list[str]:
    kinds = ("double", "float", "bigint", "int", "smallint", "tinyint", "decimal")
    return [c for c, kind in df.dtypes if kind.startswith(kinds) and c not in without]


def leave_one_out_importance(
    df: DataFrame, target: str, features: list[str] | None = None
) -> DataFrame:
    """``feature, importance``: how much R-squared drops without the feature, not below 0.

    All p+1 fits come from two passes over the data and one factorisation. Non-numeric features
    are ignored; a single feature is compared with the mean. Eager: p numbers come back.
    """
    numeric = numeric_columns(df, [target])
    features = [c for c in numeric if features is None or c in features]
    found = _drops(_moments(df, features, target)[1]).tolist() if features else []
    rows = df.sparkSession.createDataFrame(list(zip(features, found)), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature")


def linear_model(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """One row ``coefs, means, baseline, r2`` of the multiple regression. Eager."""
    means, cov = _moments(df, features, target)
    coefs, r2 = _solve(cov)
    return df.sparkSession.createDataFrame(
        [(coefs.tolist(), means[:-1].tolist(), float(means[-1]), r2)],
        "coefs array<double>, means array<double>, baseline double, r2 double",
    )


def attributions(
    df: DataFrame, features: list[str], target: str, model: DataFrame | None = None
) -> DataFrame:
    """Every row with ``attribution_<feature>``, the ``baseline`` and their sum ``prediction``.

    The one-row model reaches the scan as a constant.
    """
    fitted = linear_model(df, features, target) if model is None else model
    packed = fitted.select(F.struct("coefs", "means", "baseline").alias("model")).scalar()
    explained = df.withColumn("_model", packed)
    parts: dict[str, Column] = {}
    for i, name in enumerate(features):
        value = F.coalesce(to_double(F.col(name)), F.lit(0.0))
        shift = value - F.get(F.col("_model.means"), F.lit(i))
        parts[f"attribution_{name}"] = F.get(F.col("_model.coefs"), F.lit(i)) * shift
    explained = explained.withColumns({**parts, "baseline": F.col("_model.baseline")})
    total = F.col("baseline")
    for name in parts:
        total = total + F.col(name)
    return explained.withColumn("prediction", total).drop("_model")


def ks_test(first: DataFrame, second: DataFrame, column: str, other: str | None = None) -> DataFrame:
    """``d, p_value, n1, n2`` of the two-sample Kolmogorov-Smirnov test, two-sided.

    Values are counted first, so repeated ones cost nothing downstream. The distinct values get
    running counts of both sides over stored ranges. Eager up to those.

    The p-value is the asymptotic one at every size; for samples of a few dozen values it differs
    from an exact one in the second or third decimal. An empty side gives p = 0.
    """
    left = to_double(F.col(column))
    right = to_double(F.col(other or column))
    pooled = first.select(left.alias("x"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        second.select(right.alias("x"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    counts = pooled.dropna(subset=["x"]).groupBy("x").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b")
    )
    running = running_totals(counts, [], [F.col("x")], {"to_a": F.col("a"), "to_b": F.col("b")})
    sizes = running.agg(F.max("to_a").alias("n1"), F.max("to_b").alias("n2")).first()
    n1, n2 = sizes["n1"] or 0, sizes["n2"] or 0
    gap = F.abs(F.col("to_a") / F.lit(n1) - F.col("to_b") / F.lit(n2)) if n1 and n2 else F.lit(None).cast("double")
    found = running.agg(F.max(gap).alias("d")).withColumns(
        {"n1": F.lit(n1).cast("long"), "n2": F.lit(n2).cast("long")}
    )
    effective = F.col("n1") * F.col("n2") / (F.col("n1") + F.col("n2"))
    p_value = kolmogorov_tail(F.sqrt(effective) * F.col("d"))
    return found.select(
        F.coalesce("d", F.lit(0.0)).alias("d"),
        F.when(F.col("d").isNull(), 0.0).otherwise(p_value).alias("p_value"),
        "n1",
        "n2",
    )


def kolmogorov_tail(scaled: Column) -> Column:
    """P(K > scaled) of the Kolmogorov distribution; 1 below 0.2, where it differs by < 1e-12."""
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda acc, term: acc + term)
    return F.when(scaled < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))
