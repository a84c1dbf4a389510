"""URL filter: host rules, and a path-template tree judged by labelled purity.

Everything is a DataFrame expression. The tree is built over distinct (host, path shape)
pairs with their counts, which are added up before they are shuffled; the pages meet its
verdicts in one join.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldlake.llm.common import drop, stored
from fieldlake.llm.registry import query


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query, as dealt.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

#: A node with more children than this, half of them with at most this share of its rows,
#: has a variable segment where labels do not tell its children apart. Neither changes where every row comes several times.
MANY_CHILDREN = 20
RARE_SHARE = 0.02
#: Sibling branches nearer than this many standard errors are merged.
SAME_WITHIN = 1.96
#: Weight of the wider level's purity, in labelled rows.
PRIOR_ROWS = 4.0
REJECT_FROM = 0.5


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    before = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(before, r"(?s)^([^/]*)", 1)
    path = F.substring(before, F.length(host) + 1, F.length(before))
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def shape(path: Column) -> Column:
    """A path's segments with numbers, hashes and dates generalised, as an array."""
    return F.transform(
        F.filter(F.split(path, "/", -1), lambda s: s != ""),
        lambda s: F.when(
            s.rlike(r"^[0-9A-Fa-f]{8,}$") & s.rlike("[0-9]"), F.lit("{hex}")
        ).otherwise(F.regexp_replace(s, r"[0-9]+", "{n}")),
    )


def smoothed(wider: Column) -> Column:
    """Blocked share of the labelled rows, with ``PRIOR_ROWS`` rows of the wider level's share."""
    return (F.col("blocked") + PRIOR_ROWS * wider) / (F.col("labelled") + PRIOR_ROWS)


#: Counts of a path's rows, of those with a rule, and of those blocked by one.
SUMS = ("rows", "labelled", "blocked")


def _joined(segments: Column) -> Column:
    """Segments as a path, empty for none."""
    return F.when(F.size(segments) > 0, F.concat(F.lit("/"), F.array_join(segments, "/"))).otherwise("")


def _past_chains(tree: DataFrame) -> DataFrame:
    """``tree`` with the segments that all paths of a node begin with moved to its template.

    A node with one child has nothing to decide. The common beginning of some arrays is that
    of the least and the greatest of them.
    """
    node = ["host", "template"]
    ends = tree.groupBy(*node).agg(F.min("rest").alias("low"), F.max("rest").alias("high"))
    pairs = F.arrays_zip(F.col("low").alias("l"), F.col("high").alias("h"))
    differs = F.array_position(F.transform(pairs, lambda p: p["l"].eqNullSafe(p["h"])), False)
    common = F.when(differs == 0, F.size("low")).otherwise(differs - 1).cast("int")
    ends = ends.select(*node, common.alias("common"))
    return tree.join(ends, node).select(
        "host",
        "shape",
        "known",
        *SUMS,
        F.concat("template", _joined(F.slice("rest", F.lit(1), F.col("common")))).alias("template"),
        F.slice("rest", F.col("common") + 1, F.greatest(F.size("rest"), F.lit(1))).alias("rest"),
    )


def _with_known(paths: DataFrame) -> DataFrame:
    """``paths`` with ``known``, how many first segments a labelled path of any host shares.

    Beginnings meet by their length and hash; a collision could change a template's name only.
    """
    whole = F.xxhash64("shape")
    begun = F.transform(F.sequence(F.lit(1), F.size("shape")), lambda k: F.xxhash64(F.slice("shape", F.lit(1), k)))
    shapes = paths.filter(F.size("shape") > 0).groupBy("shape").agg(F.sum("labelled").alias("labelled"))
    begins = shapes.select(whole.alias("whole"), "labelled", F.posexplode(begun).alias("at", "begun"))
    labelled = begins.filter("labelled > 0").select("at", "begun").distinct()
    known = begins.join(labelled, ["at", "begun"]).groupBy("whole").agg((F.max("at") + 1).alias("known"))
    met = paths.withColumn("whole", whole).join(known, "whole", "left").drop("whole")
    return met.withColumn("known", F.coalesce("known", F.lit(0)))


def _branches(tree: DataFrame) -> DataFrame:
    """host, template, segment and what the segment adds to the template, of all branches.

    Labelled children are told apart, or merged, by their labels alone. Only children that no
    labelled path of any host goes through become ``*``: with it or without it they have no
    evidence of their own, so the number of their siblings cannot turn a verdict over.
    """
    node = ["host", "template"]
    depth = F.size("shape") - F.size("rest") + 1
    branches = tree.groupBy(*node, F.get("rest", F.lit(0)).alias("segment")).agg(
        *[F.sum(name).alias(name) for name in SUMS], F.bool_or(F.col("known") >= depth).alias("known")
    )
    wild = branches.groupBy(*node).agg(
        (
            (F.count("*") > MANY_CHILDREN) & (F.percentile("rows", F.lit(0.5)) <= RARE_SHARE * F.sum("rows"))
        ).alias("wild")
    )
    branches = branches.join(wild, node)
    # the labelled share of a branch, pulled to one half by one row of each verdict
    share = (F.col("blocked") + 1) / (F.col("labelled") + 2)
    error = share * (1 - share) / (F.col("labelled") + 2)
    seen = (F.col("labelled") > 0) & F.col("segment").isNotNull()
    # branches of equal counts are never apart, so the order is of distinct counts
    counts = ["labelled", "blocked"]
    levels = branches.filter(seen).groupBy(*node, *counts).agg(
        F.min("segment").alias("least"), F.count("*").alias("many"), F.bit_xor(F.xxhash64("segment")).alias("mark")
    )
    order = Window.partitionBy(*node).orderBy("share", "labelled")
    apart = (F.col("share") - F.lag("share").over(order)) >= SAME_WITHIN * F.sqrt(
        F.col("error") + F.lag("error").over(order)
    )
    levels = (
        levels.withColumns({"share": share, "error": error})
        .withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
        .withColumn("branch", F.sum("apart").over(order))
    )
    merged = Window.partitionBy(*node, "branch")
    least, many = F.min("least").over(merged), F.sum("many").over(merged)
    # a merged branch is named by its least segment, their number, and a hash of them all
    name = F.when(many == 1, least).otherwise(
        F.concat_ws("|", least, many.cast("string"), F.hex(F.bit_xor("mark").over(merged)))
    )
    levels = levels.select(*node, *counts, name.alias("name"))
    grown = (
        F.when(F.col("segment").isNull(), F.lit(""))
        .when(F.col("wild") & ~F.col("known"), F.lit("*"))
        .otherwise(F.concat(F.lit("/"), F.coalesce("name", "segment")))
    )
    return branches.join(levels, [*node, *counts], "left").select(*node, "segment", grown.alias("grown"))


def template_verdicts(paths: DataFrame) -> DataFrame:
    """host, shape, template, purity of every distinct (host, shape).

    ``paths`` has host, shape, rows, labelled, blocked. Level by level, until no path has a
    segment left, labelled siblings whose blocked shares do not differ by ``SAME_WITHIN`` standard
    errors are merged, and where a node has many rare children, a segment that no labelled path
    goes through becomes ``*``.
    A template's purity is its blocked share smoothed towards the same template's share over
    all hosts, which is smoothed towards the share of all labelled rows.
    """
    spark = paths.sparkSession
    start = _with_known(paths).select("host", "shape", "known", *SUMS, F.lit("").alias("template"), F.col("shape").alias("rest"))
    tree, path = stored(_past_chains(start), "url-tree")
    levels, whole = [path], []
    while True:
        whole.append(tree.filter(F.size("rest") == 0).drop("rest", "known"))
        # a path that ends at a node is one of its children, so nodes keep theirs until all end
        if tree.filter(F.size("rest") > 0).isEmpty():
            break
        branches = _branches(tree)
        b = branches.select(*[F.col(name).alias(f"b_{name}") for name in ("host", "template", "segment")], "grown")
        same = [
            F.col("host") == F.col("b_host"),
            F.col("template") == F.col("b_template"),
            F.get("rest", F.lit(0)).eqNullSafe(F.col("b_segment")),
        ]
        deeper = tree.filter(F.size("rest") > 0).join(b, same).select(
            "host",
            "shape",
            "known",
            *SUMS,
            F.concat("template", "grown").alias("template"),
            F.slice("rest", F.lit(2), F.size("rest")).alias("rest"),
        )
        tree, path = stored(_past_chains(deeper), "url-tree")
        levels.append(path)
    tree, path = stored(functools.reduce(DataFrame.union, whole), "url-templates")
    drop(spark, *levels)
    base = tree.agg((F.sum("blocked") + 1) / (F.sum("labelled") + 2)).scalar()
    sums = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    wide = tree.groupBy("template").agg(*sums).select("template", smoothed(F.coalesce(base, F.lit(0.5))).alias("wide"))
    judged = (
        tree.groupBy("host", "template")
        .agg(*sums)
        .join(wide, "template")
        .select("host", "template", smoothed(F.col("wide")).alias("purity"))
    )
    return tree.select("host", "shape", "template").join(judged, ["host", "template"])


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every row of ``pages``.

    The longest fitting rule decides. Pages without a rule are judged by their template;
    pages with a rule are the labelled ones it learns from. A null URL or one without
    ``://`` has an empty host and path and is judged as such. Repeated rows are kept, an
    empty table gives no row, and columns other than page_id and url are not read.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    text, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": text, "ruled": verdict, "shape": shape(F.col("path"))})
    paths = parts.groupBy("host", "shape").agg(
        F.count("*").alias("rows"),
        F.count("ruled").alias("labelled"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"),
    )
    judged = template_verdicts(paths)
    by_method = F.when(F.col("purity") >= REJECT_FROM, "block").otherwise("allow")
    return parts.join(judged, ["host", "shape"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", by_method).alias("verdict"),
        "template",
        F.round("purity", 9).alias("purity"),
    )


@query()
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL under the rules, else under the template tree."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "template", "purity")
