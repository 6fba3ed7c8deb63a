"""CSV files of any column order, read by the names in their own headers.

Files are grouped by header. Each group is one read of Spark's CSV source with
a schema in the order of that header, so a large file is split over tasks and
values keep their quoted commas. Files in which some line holds an odd number of quotes,
as a quoted line break leaves it, are read whole, as one stretch per file.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_OPTIONS = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"}
_RECORD = "_record"
# Files whose first lines are looked at side by side.
_AT_ONCE = 16
REFUSED_SCHEMA = "path string, missing array<string>"


@dataclass(frozen=True)
class CsvStream:
    """A stream of the files below a path (``path``, ``length``), to be read under ``schema``."""

    files: DataFrame
    schema: StructType


@dataclass
class Catalogue:
    """Files by (header, whether a quoted value holds a line break), and files that lack columns."""

    groups: dict[tuple[tuple[str, ...], bool], list[str]]
    refused: list[tuple[str, list[str]]]


def csv_stream(spark: SparkSession, path: str, schema: StructType, **options) -> CsvStream:
    """New files below ``path``. Only their names are streamed; options such as ``maxFilesPerTrigger`` bound a batch."""
    listed = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(listed).options(**options).load(path)
    return CsvStream(files.select("path", "length"), schema)


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The cells of a file's first line."""
    first = spark.read.options(header="false", multiLine="true", **_OPTIONS).csv(path).first()
    cells = [c or "" for c in first] if first is not None else []
    return tuple(c.removeprefix("﻿").strip().strip('"') if i == 0 else c for i, c in enumerate(cells))


def _with_line_breaks(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """The files in which a line holds an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), (quotes % 2 == 1).alias("odd"))
    found = lines.groupBy("path").agg(F.bool_or("odd").alias("odd")).filter("odd").collect()
    return {_plain(r["path"]) for r in found}


def _plain(path: str) -> str:
    """A path as the file listing and the file metadata both can be compared by."""
    return path.replace("file:///", "file:/")


def catalogue(spark: SparkSession, paths: Sequence[str], schema: StructType) -> Catalogue:
    """Look at the first line of every file, and at the quotes in those that have all columns."""
    out = Catalogue(defaultdict(list), [])
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        headers = list(pool.map(lambda path: _header(spark, path), paths))
    names = schema.fieldNames()
    readable = []
    for path, header in zip(paths, headers, strict=True):
        # A name that comes twice says of no column which one it is.
        missing = [name for name in names if header.count(name) != 1]
        if missing:
            out.refused.append((path, missing))
        else:
            readable.append((path, header))
    broken = _with_line_breaks(spark, [path for path, _ in readable]) if readable else set()
    for path, header in readable:
        out.groups[header, _plain(path) in broken].append(path)
    return out


def _group_rows(spark: SparkSession, header: tuple[str, ...], breaks: bool, paths: list[str], schema: StructType) -> DataFrame:
    columns = [StructField(f"_c{i}", StringType()) for i in range(len(header))]
    reader = spark.read.schema(StructType([*columns, StructField(_RECORD, StringType())]))
    # Without column pruning every record is parsed in full, so that surplus values are noticed.
    reader = reader.options(
        header="true", multiLine=str(breaks).lower(), columnPruning="false", columnNameOfCorruptRecord=_RECORD, **_OPTIONS
    )
    found = reader.csv(paths)
    by_name = {f.name: F.col(f"_c{header.index(f.name)}").try_cast(f.dataType).alias(f.name) for f in schema.fields}
    # A record with too few values gives NULLs; one with too many is kept as a whole beside its row.
    longer = ", ".join(f"_c{i} string" for i in range(len(header) + 1))
    cells = F.from_csv(F.col(_RECORD), F.lit(longer), {"multiLine": "true", **_OPTIONS})
    surplus = F.when(cells[f"_c{len(header)}"].isNotNull(), F.col(_RECORD))
    return found.select(*by_name.values(), surplus.alias("surplus_record"), F.col("_metadata.file_path").alias("source_file"))


def read_csv(spark: SparkSession, paths: Sequence[str], schema: StructType) -> tuple[DataFrame, DataFrame]:
    """The rows of CSV files by the names in their headers, and the refused files.

    Rows have the columns of ``schema``, typed by a cast that turns what it
    cannot read into NULL, ``surplus_record`` (the whole record, where it has
    more values than its header) and ``source_file``. Columns may come in any
    order and number; others are left out. Files that lack a column, or name
    it twice, give no rows; they are listed (path, missing).
    """
    known = catalogue(spark, paths, schema)
    rows = [_group_rows(spark, header, breaks, own, schema) for (header, breaks), own in known.groups.items()]
    empty = StructType([*schema.fields, StructField("surplus_record", StringType()), StructField("source_file", StringType())])
    found = reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], empty)
    return found, spark.createDataFrame(known.refused, REFUSED_SCHEMA)
