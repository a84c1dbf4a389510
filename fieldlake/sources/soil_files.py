"""Many soil files with differing headers and encodings as one table.

Files are described by the tasks that read them: a CSV file by its header, whether all of it is
valid UTF-8, and whether it holds any record; a Parquet file by the schema in its footer. CSV
files are then read in one scan whatever their headers: a line is split into fields by place,
and the description of its file says which field belongs to which column. Parquet files are
read in as many scans as there are conflicting types for a name.
"""

from __future__ import annotations

import contextlib
import csv
import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldlake.operators.rows import union_by_name
from fieldlake.session import materialise, use_utc

# Fixed value: naming of the curated main tables, as opposed to large grid exports.
CURATED_GLOB = "SoilHealthDB_V*.csv"

# What Spark reports when no file matches.
_NO_FILES = {"UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"}

#: Largest Parquet file that a task takes up for its footer.
FOOTER_BYTES = 256 << 20

_PARSING = {"mode": "PERMISSIVE", "escape": '"'}


@dataclass
class SoilFiles:
    """The united table, all columns as text, and the files that gave no rows."""

    table: DataFrame
    skipped: DataFrame


def _mark_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add whether a row is the first of its file: of the block at 0, as the task meets it."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        first = []
        for place in zip(batch.column("path").to_pylist(), batch.column("block").to_pylist()):
            first.append(place != last and place[1] == 0)
            last = place
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first)], [*batch.schema.names, "is_header"])


def _with_first(rows: DataFrame, value: str) -> DataFrame:
    return rows.mapInArrow(_mark_first, f"path string, block long, value {value}, is_header boolean")


def _lines(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """path, block, value, is_header of all lines that are not blank."""
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(root)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            "value",
        )
    )
    return _with_first(lines.filter(F.length(F.trim("value")) > 0), "string")


def describe_csv_files(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """One row per CSV file below ``root``: path, header, valid_utf8, lines, broken_lines.

    A file has one header at most. It is collected: a largest text is found by sorting the lines.
    """
    described = _lines(spark, root, glob).groupBy("path").agg(
        F.get(F.collect_list(F.when(F.col("is_header"), F.col("value"))), F.lit(0)).alias("raw_header"),
        F.bool_and(F.is_valid_utf8("value")).alias("valid_utf8"),
        F.count("*").alias("lines"),
        # a line with an odd number of quotes: a field goes on in the next line
        F.bool_or(F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1).alias("broken_lines"),
    )
    header = _decoded(F.col("raw_header"), F.col("valid_utf8"))
    return described.select("path", header.alias("header"), "valid_utf8", "lines", "broken_lines")


def _decoded(value: Column, valid_utf8: Column) -> Column:
    return F.when(valid_utf8, value).otherwise(F.decode(value.cast("binary"), "ISO-8859-1"))


def _list_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Paths from the file listing alone, which unlike a scan includes files of no bytes."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
    )
    return _paths(spark, files.inputFiles())


def _paths(spark: SparkSession, uris: list[str]) -> DataFrame:
    listed = spark.createDataFrame([(uri,) for uri in uris], "path string")
    return listed.select(_one_slash("path").alias("path"))


def _one_slash(uri: str) -> Column:
    """``file:///a`` and ``file:/a`` spelled one way; listings and metadata differ in it."""
    return F.regexp_replace(uri, "^([a-z0-9]+):/+", "$1:/")


def _header_names(header: str) -> list[str]:
    names = next(csv.reader([header.lstrip("﻿")]))
    seen: dict[str, int] = {}
    unique = []
    for position, raw in enumerate(names):
        name = raw.strip() or f"_c{position}"
        folded = name.lower()  # column names of a table must differ in more than case
        seen[folded] = seen.get(folded, 0) + 1
        unique.append(name if seen[folded] == 1 else f"{name}.{seen[folded] - 1}")
    return unique


def _name_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [_header_names(header) for header in batch.column("header").to_pylist()]
        columns = [batch.column(name) for name in ("path", "valid_utf8", "broken_lines")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(names, pa.list_(pa.string()))], ["path", "valid_utf8", "broken_lines", "names"]
        )


def _columns(files: DataFrame) -> list[str]:
    """Column names of all files, each spelled and placed as where it comes first.

    Names that differ in case only are one. As many rows as columns reach the driver.
    """
    each = files.select("path", F.posexplode("names").alias("place", "name"))
    firsts = each.groupBy(F.lower("name").alias("folded")).agg(F.min(F.struct("path", "place", "name")).alias("first"))
    return [row["first"]["name"] for row in sorted(firsts.collect(), key=lambda row: row["first"])]


def _positional(width: int) -> str:
    return ", ".join(f"_c{place} string" for place in range(width))


def _broken_rows(spark: SparkSession, paths: list[str], valid_utf8: bool, width: int) -> DataFrame:
    """Fields of files whose records go over several lines; each file is one task's."""
    rows = (
        spark.read.options(**_PARSING, multiLine=True, encoding="UTF-8" if valid_utf8 else "ISO-8859-1")
        .schema(_positional(width))
        .csv([_literal(path) for path in paths])
    )
    fields = F.array(*[F.col(f"_c{place}") for place in range(width)])
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.lit(0).cast("long").alias("block"), fields.alias("value"))
    return _with_first(rows, "array<string>").filter("NOT is_header").select("path", F.col("value").alias("fields"))


def read_csv_files(spark: SparkSession, root: str, glob: str = "*.csv") -> SoilFiles:
    """All CSV files below ``root``, every column as text.

    The plan grows with the columns, not with the files or their headers. Fields beyond a
    file's header are dropped, missing and empty ones are null.
    """
    use_utc(spark)
    usable = describe_csv_files(spark, root, glob).filter("lines > 1 AND header IS NOT NULL")
    files = materialise(
        usable.select("path", "header", "valid_utf8", "broken_lines").mapInArrow(
            _name_kernel, "path string, valid_utf8 boolean, broken_lines boolean, names array<string>"
        ),
        "csv-files",
    )
    columns = _columns(files)
    if not columns:
        raise FileNotFoundError(f"no usable {glob} file below {root}")
    width = files.agg(F.max(F.size("names"))).first()[0]
    folded = F.array(*[F.lit(name.lower()) for name in columns])
    places = F.transform(
        folded, lambda name: F.nullif(F.array_position(F.transform("names", F.lower), name), F.lit(0)) - 1
    )
    placed = materialise(files.select("path", "valid_utf8", "broken_lines", places.cast("array<int>").alias("places")), "csv-places")
    lines = _lines(spark, root, glob).filter("NOT is_header").join(placed.filter("NOT broken_lines"), "path")
    parsed = F.from_csv(_decoded(F.col("value"), F.col("valid_utf8")), F.lit(_positional(width)), _PARSING)
    rows = lines.select("places", parsed.alias("parsed")).select(
        "places", F.array(*[F.col(f"parsed._c{place}") for place in range(width)]).alias("fields")
    )
    for valid_utf8 in (True, False):
        kind = placed.filter("broken_lines").filter(F.col("valid_utf8") == valid_utf8)
        paths = [row["path"] for row in kind.select("path").orderBy("path").collect()]
        if paths:
            rows = rows.union(_broken_rows(spark, paths, valid_utf8, width).join(kind, "path").select("places", "fields"))
    table = rows.select(
        *[F.get("fields", F.get("places", F.lit(i))).alias(name) for i, name in enumerate(columns)]
    )
    used = files.select(_one_slash("path").alias("path"))
    skipped = (
        _list_files(spark, root, glob)
        .join(used, "path", "left_anti")
        .withColumn("reason", F.lit("no records"))
    )
    return SoilFiles(table, skipped)


def _literal(uri: str) -> str:
    """A path as the reader takes it: percent escapes resolved, glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _footer_kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path and the Parquet schema written in the footer, null where there is none."""
    for batch in batches:
        written = []
        for content in batch.column("content"):
            try:
                written.append(str(pq.ParquetFile(pa.BufferReader(content.as_buffer())).schema))
            except (pa.ArrowException, OSError):
                written.append(None)
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(written, pa.string())], ["path", "written"])


def describe_parquet_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """path, written: the schema in the footer of every Parquet file, read by tasks.

    A task holds a whole file, so one above ``FOOTER_BYTES`` is a kind of its own instead, for
    Spark to ask.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
    )
    small = files.filter(F.col("length") <= FOOTER_BYTES).select("path", "content")
    large = files.filter(F.col("length") > FOOTER_BYTES).select("path", F.concat(F.lit("large "), "path").alias("written"))
    return small.mapInArrow(_footer_kernel, "path string, written string").union(large)


def _together(schemas: list[StructType]) -> list[list[int]]:
    """Numbers of the schemas, in groups in which a name has one type."""
    groups: list[tuple[dict[str, str], list[int]]] = []
    for number, schema in enumerate(schemas):
        types = {field.name.lower(): field.dataType.json() for field in schema.fields}
        for known, members in groups:
            if all(known.get(name, kind) == kind for name, kind in types.items()):
                known.update(types)
                members.append(number)
                break
        else:
            groups.append((types, [number]))
    return [members for _, members in groups]


def _merged(schemas: list[StructType]) -> StructType:
    fields = {}
    for schema in schemas:
        for field in schema.fields:
            fields.setdefault(field.name.lower(), field)
    return StructType([*fields.values()])


def read_parquet_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> SoilFiles:
    """All Parquet files below ``root`` as one text table.

    Tasks read the footers; Spark is asked for the schema of one file of each kind. Files in
    which no name has two types are one scan. A file whose footer cannot be read is listed and
    gives no row; damage further in is an error when it is met, not a loss of rows.
    """
    use_utc(spark)
    described = materialise(describe_parquet_files(spark, root, glob), "parquet-files")
    kinds = described.dropna(subset=["written"]).groupBy("written").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    found = sorted((row["paths"] for row in kinds.collect()))
    kind_of = {}
    for paths in found:
        with contextlib.suppress(PySparkException, Py4JJavaError):  # a large file without a footer
            kind_of[paths[0]] = spark.read.parquet(_literal(paths[0])).schema
    bad_kinds = [path for paths in found if paths[0] not in kind_of for path in paths]
    found = [paths for paths in found if paths[0] in kind_of]
    if not found:
        raise FileNotFoundError(f"no usable {glob} file below {root}")
    schemas = [kind_of[paths[0]] for paths in found]
    frames = []
    for members in _together(schemas):
        schema = _merged([schemas[number] for number in members])
        paths = [_literal(path) for number in members for path in found[number]]
        frames.append(as_text(spark.read.schema(schema).parquet(*paths)))
    unread = F.col("written").isNull() | F.col("path").isin(bad_kinds)
    bad = described.filter(unread).select(_one_slash("path").alias("path"))
    return SoilFiles(
        functools.reduce(union_by_name, frames),
        bad.withColumn("reason", F.lit("unreadable or empty")),
    )


def as_text(df: DataFrame) -> DataFrame:
    """Every column as string, so that files with other types for a name can be united."""
    return df.select([F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])


def read_soil_files(spark: SparkSession, root: str) -> SoilFiles:
    """CSV and Parquet files below ``root`` united by column name."""
    found: list[SoilFiles] = []
    for reader in (read_csv_files, read_parquet_files):
        try:
            found.append(reader(spark, root))
        except FileNotFoundError:
            continue
        except AnalysisException as error:
            if error.getCondition() not in _NO_FILES:
                raise
    if not found:
        raise FileNotFoundError(f"no usable .csv or .parquet file below {root}")
    return SoilFiles(
        functools.reduce(union_by_name, [f.table for f in found]),
        functools.reduce(DataFrame.unionByName, [f.skipped for f in found]),
    )


def read_curated_soil_files(spark: SparkSession, root: str) -> SoilFiles:
    """Only the curated main tables, at any depth, each path once."""
    return read_csv_files(spark, root, CURATED_GLOB)
