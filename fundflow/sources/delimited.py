"""Bulk filing files: their lines, layout and manifest status.

Layout on disk: ``{root}/{cycle_year}/{file_type}/*.txt``, pipe-delimited, no
header.  Read plainly, a line is split at every pipe, with no quote character (a stray ``"``
stays in the text); an empty field is NULL, a blank line is no row, and a line with a
wrong field count is rejected and counted.  ``loader`` loads such files into raw tables.
"""

from __future__ import annotations

import re
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .layouts import FILE_TYPES, LINEAGE_COLUMNS, check_cycles

_CYCLE_FROM_PATH = r"/(\d{4})/[^/]+/[^/]+$"


def split_lines(lines: DataFrame, columns: list[str], sep: str = "|") -> DataFrame:
    """``lines`` (value, lineage) plus ``parts``: the fields, or NULL for a rejected line."""
    parts = F.split(F.col("value"), re.escape(sep), -1)
    return lines.filter(F.col("value") != "").withColumn(
        "parts", F.when(F.size(parts) == len(columns), parts))


def accepted(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the lines that have the right field count: text columns plus lineage."""
    fields = [F.nullif(F.col("parts")[i], F.lit("")).alias(c) for i, c in enumerate(columns)]
    return split_lines(lines, columns).filter(F.col("parts").isNotNull()) \
        .select(*fields, *LINEAGE_COLUMNS)


def line_counts(lines: DataFrame, columns: list[str]) -> DataFrame:
    """(cycle_year, source_file, rows, rejected) per file that has a line."""
    good = F.col("parts").isNotNull()
    return split_lines(lines, columns).groupBy(*LINEAGE_COLUMNS).agg(
        F.count_if(good).alias("rows"), F.count_if(~good).alias("rejected"))


def with_lineage(text: DataFrame, cycle_year: int | None = None) -> DataFrame:
    """Lines of a text source with the cycle (from the path unless given) and the file name."""
    year = (F.lit(cycle_year) if cycle_year is not None
            else F.regexp_extract("_metadata.file_path", _CYCLE_FROM_PATH, 1))
    return text.select("value", year.cast("int").alias("cycle_year"),
                       F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))
                       .alias("source_file"))     # the name is URL-encoded there


def read_lines(spark: SparkSession, paths: list[str] | str, cycle_year: int | None = None) -> DataFrame:
    return with_lineage(spark.read.text(paths), cycle_year)


def read_filing(spark: SparkSession, paths: list[str] | str, file_type: str,
                cycle_year: int | None = None) -> DataFrame:
    """Read filing files of one type as a raw table (text columns + lineage).

    ``cycle_year`` defaults to the ``{year}`` directory above the file type.
    """
    return accepted(read_lines(spark, paths, cycle_year), FILE_TYPES[file_type][1])


def _glob(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, size) of the files matching ``pattern``, empty ones too, on whichever file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted((s.getPath().toString(), s.getLen()) for s in found or [] if s.isFile())


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Name, path, size, cycle and type of every file matching ``pattern`` (names only are read)."""
    files = spark.createDataFrame(_glob(spark, pattern), "path string, file_size long")
    return files.select(
        "path", "file_size", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("file_type"),
        F.nullif(F.regexp_extract("path", _CYCLE_FROM_PATH, 1), F.lit("")).cast("int")
        .alias("cycle_year"))


def discover_inputs(spark: SparkSession, root: str, cycles: list[int],
                    file_types: list[str] | None = None) -> dict[str, list[tuple[int, str, str]]]:
    """Per file type, (cycle, name, path) of every file in the ``{root}/{year}/{type}`` folders.

    A missing folder or one without ``.txt`` files is skipped; empty files count.
    """
    cycles = check_cycles(cycles)
    out = {ftype: [(year, path.rpartition("/")[2], path) for year in cycles
                   for path, _ in _glob(spark, f"{root}/{year}/{ftype}/*.txt")]
           for ftype in file_types or FILE_TYPES}
    return {ftype: files for ftype, files in out.items() if files}


def write_filing(df: DataFrame, path: str, columns: list[str]) -> None:
    """Write rows in the bulk layout (pipe-delimited text, no header, no quotes)."""
    (df.select(*columns).write.mode("overwrite")
     .option("sep", "|").option("header", False).option("quote", "")
     .option("emptyValue", "").option("nullValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def export_csv(df: DataFrame, path: str) -> None:
    """Mart export: comma-separated with a header row."""
    df.write.mode("overwrite").option("header", True).csv(path)


def manifest_status(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``files`` (cycle_year, file_type, file_name, file_size, ...) with their status in a manifest.

    Names recur in every cycle, so a file is known by (cycle, type, name).
    ``skipped``: recorded with this size; ``changed``: recorded with other sizes only;
    ``new``: not recorded.  A size of 0 is unknown and never skipped; repeated
    manifest rows count once.
    """
    key = ["cycle_year", "file_type", "file_name"]
    recorded = manifest.groupBy(*key).agg(F.collect_set("file_size").alias("_sizes"))
    known = F.col("_sizes").isNotNull()
    same = F.coalesce(F.array_contains("_sizes", F.col("file_size")), F.lit(False))
    status = (F.when(~known, F.lit("new")).when(same & (F.col("file_size") > 0), F.lit("skipped"))
              .otherwise(F.lit("changed")))
    return files.join(recorded, key, "left").select(*files.columns, status.alias("status"))


def file_manifest_status(spark: SparkSession, pattern: str, manifest: DataFrame) -> DataFrame:
    return manifest_status(list_files(spark, pattern), manifest)


def manifest_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("files"))
