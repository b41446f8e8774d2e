"""Manifest-driven, atomic loads of bulk filing files.

A load writes into folders of its own and is seen only once it is committed:

    {warehouse}/filings/{table}/data/load={id}/cycle_year=/source_file=/   accepted rows
                               /quarantine/load={id}/                      rejected lines, with reason
                               /manifest/load={id}/                        one row per file read
                               /commits/{number}-{id}                      makes the load count

The commit file is the one pointer that readers follow, so they see a load whole or not at
all: a load that fails or is killed before it leaves only folders that no commit names, and
the next run loads the same files again.  Of two loads at once each gets a number of its own.
A file that is loaded again is replaced, as the newest committed load of a
(cycle, type, name) is the one that counts; older rows stay on disk until removed.

The manifest decides what to read: with ``only_new`` a file recorded with the same size is
skipped, new and changed ones are loaded.  Row counts are taken from what was written.

Lines are checked as bytes.  Without ``charset`` they must be UTF-8, else the line is set aside
(reason ``bytes``); with one they are decoded by it.  A line with a wrong field count is
set aside too (``fields``).  Blank lines are no rows.

Each file has its own quoting.  One pass counts, per file, what speaks for quoted
fields: fields wrapped in quotes, lines whose quotes don't pair up, and lines that have the
right field count under either reading.  A file is read as quoted if it has wrapped fields,
no line with stray quotes, and no fewer good lines that way; else quotes are plain text.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .delimited import read_lines
from .layouts import (FILE_TYPES, LINEAGE_COLUMNS, OPTIONAL_TABLES, RAW_TABLES, check_cycles, columns_of,
                      raw_schema)

MANIFEST = ("cycle_year int, file_type string, file_name string, file_size long, quoted boolean, "
            "rows long, rejected long, load string")
QUARANTINE = "cycle_year int, source_file string, reason string, line binary, load string"
_WRAPPED = '"(?:[^"]++|"")*+"'


# --- files ------------------------------------------------------------------

def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def discovered(spark: SparkSession, root: str, cycles: list[int], file_types: list[str] | None = None) -> DataFrame:
    """(cycle_year, file_type, file_name, file_size, path) of the ``{root}/{year}/{type}/*.txt`` files."""
    found = []
    for year in check_cycles(cycles):
        for ftype in file_types or FILE_TYPES:
            path, fs = _folder(spark, f"{root}/{year}/{ftype}/*.txt")
            found += [(year, ftype, s.getPath().getName(), s.getLen(), s.getPath().toString())
                      for s in fs.globStatus(path) or [] if s.isFile()]
    return spark.createDataFrame(sorted(found), "cycle_year int, file_type string, file_name string, "
                                                "file_size long, path string")


def file_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(line binary, cycle_year, source_file): the lines of files in the bulk layout, as bytes."""
    return read_lines(spark, paths).select(F.col("value").cast("binary").alias("line"), *LINEAGE_COLUMNS)


# --- lines -> fields ----------------------------------------------------------

def decoded(lines: DataFrame, charset: str | None = None) -> DataFrame:
    """``lines`` plus ``value``: the line's text, null where its bytes are no text; blank lines go."""
    text = (F.col("line").cast("string") if charset is None
            else F.decode("line", charset))
    value = F.when(F.is_valid_utf8(text), text) if charset is None else text
    return lines.filter(F.octet_length("line") > 0).withColumn("value", value)


def plain_fields(value: Column, sep: str = "|") -> Column:
    return F.split(value, re.escape(sep), -1)


def quoted_fields(value: Column, sep: str = "|") -> Column:
    """Fields as written, where a wrapped field may hold separators (and doubled quotes)."""
    s = re.escape(sep)
    return F.regexp_extract_all(F.concat(F.lit(sep), value),
                                F.lit(f"{s}({_WRAPPED}(?={s}|$)|[^{s}]*+)"), F.lit(1))


def unquoted(field: Column) -> Column:
    """The text of a field: a wrapped one loses its quotes, doubled ones become single."""
    inner = F.substring(field, F.lit(2), F.char_length(field) - 2)
    return F.when(field.startswith('"') & field.rlike(f"^{_WRAPPED}$"), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field)


def quote_evidence(lines: DataFrame, columns: list[str]) -> DataFrame:
    """(cycle_year, source_file, wrapped, stray, good_quoted, good_plain): sums over each file's lines."""
    # a select of its own for what is used more than once, so it is worked out once a line
    split = lines.filter(F.contains("value", F.lit('"'))).select(
        *LINEAGE_COLUMNS, quoted_fields(F.col("value")).alias("fields"),
        F.size(plain_fields(F.col("value"))).alias("n_plain"))
    starts = split.select(*LINEAGE_COLUMNS, F.filter("fields", lambda f: f.startswith('"')).alias("starts"),
                          F.size("fields").alias("n_quoted"), "n_plain")
    counted = starts.select(*LINEAGE_COLUMNS, "n_quoted", "n_plain", F.size("starts").alias("n_starts"), F.size(
        F.filter("starts", lambda f: f.rlike(f"^{_WRAPPED}$"))).alias("wrapped"))
    seen = counted.select(*LINEAGE_COLUMNS, "wrapped", (F.col("n_starts") > F.col("wrapped")).alias("stray"),
                          (F.col("n_quoted") == len(columns)).alias("good_quoted"),
                          (F.col("n_plain") == len(columns)).alias("good_plain"))
    return seen.groupBy(*LINEAGE_COLUMNS).agg(
        F.sum("wrapped").alias("wrapped"), F.count_if("stray").alias("stray"),
        F.count_if("good_quoted").alias("good_quoted"), F.count_if("good_plain").alias("good_plain"))


def quoted_files(lines: DataFrame, columns: list[str]) -> list[tuple[int, str]]:
    """(cycle, name) of the files to be read as quoted."""
    says = (F.col("wrapped") > 0) & (F.col("stray") == 0) & (F.col("good_quoted") >= F.col("good_plain"))
    return [tuple(r) for r in quote_evidence(lines, columns).filter(says).select(*LINEAGE_COLUMNS).collect()]


def parsed(lines: DataFrame, columns: list[str], quoted: list[tuple[int, str]] = ()) -> DataFrame:
    """``lines`` plus ``fields`` (null if set aside) and ``reason`` (null if accepted).

    The quoted files, one row per file, are broadcast: a join dealt by file would move every line,
    and put a file's lines in one task.
    """
    plain = plain_fields(F.col("value"))
    if quoted:
        known = lines.sparkSession.createDataFrame(list(quoted), "cycle_year int, source_file string") \
            .withColumn("quoted", F.lit(True))
        lines = lines.join(F.broadcast(known), LINEAGE_COLUMNS, "left")
        parts = F.when(F.col("quoted"), quoted_fields(F.col("value"))).otherwise(plain)
        text = F.when(F.col("quoted"), F.transform("_parts", unquoted)).otherwise(F.col("_parts"))
    else:
        parts, text = plain, F.col("_parts")
    # a generator of one row: filters on the outcome stay above it, so a line is split once
    lines = lines.select("*", F.explode(F.array(parts)).alias("_parts"))
    good = F.size("_parts") == len(columns)
    reason = F.when(F.col("value").isNull(), "bytes").when(~good, "fields")
    return lines.withColumn("fields", F.when(good, text)).withColumn("reason", reason).drop("_parts")


# --- loads ----------------------------------------------------------------------

def _root(warehouse: str, table: str) -> str:
    return f"{warehouse}/filings/{table}"


def commits(spark: SparkSession, warehouse: str, table: str) -> list[tuple[int, str]]:
    """(number, load) of the committed loads, oldest first."""
    path, fs = _folder(spark, f"{_root(warehouse, table)}/commits/*")
    names = [s.getPath().getName() for s in fs.globStatus(path) or []]
    return sorted((int(n.partition("-")[0]), n.partition("-")[2]) for n in names if not n.startswith((".", "_")))


def _commit(spark: SparkSession, warehouse: str, table: str, load: str) -> None:
    """Create the load's commit under the next free number; a number is claimed exclusively."""
    base = _root(warehouse, table)
    while True:
        path, fs = _folder(spark, f"{base}/claims/*")
        taken = [int(n) for s in fs.globStatus(path) or [] if (n := s.getPath().getName()).isdigit()]
        number = max(taken, default=0) + 1
        claim, fs = _folder(spark, f"{base}/claims/{number}")
        try:
            fs.create(claim, False).close()
            break
        except Exception as exc:              # the JVM's own exception, by name
            if "FileAlreadyExists" not in str(exc):
                raise
    path, fs = _folder(spark, f"{base}/commits/{number}-{load}")
    fs.create(path, False).close()


def manifest(spark: SparkSession, warehouse: str, table: str, history: bool = False) -> DataFrame:
    """The manifest's rows: per file its newest committed load, or all with ``history``."""
    known = commits(spark, warehouse, table)
    if not known:
        return spark.createDataFrame([], MANIFEST)
    base = f"{_root(warehouse, table)}/manifest"
    rows = spark.read.schema(MANIFEST).option("basePath", base) \
        .parquet(*[f"{base}/load={load}" for _, load in known])
    order = spark.createDataFrame(known, "number long, load string")
    rows = rows.join(order, "load")
    if not history:
        key = ["cycle_year", "file_type", "file_name"]
        newest = rows.groupBy(*key).agg(F.max("number").alias("number"))
        rows = rows.join(newest, [*key, "number"])
    return rows.select(*T.StructType.fromDDL(MANIFEST).names)


def file_status(files: DataFrame, recorded: DataFrame) -> DataFrame:
    """``files`` plus ``status``: new, changed (another size, or 0, which is unknown) or skipped."""
    key = ["cycle_year", "file_type", "file_name"]
    old = recorded.select(*key, F.col("file_size").alias("_size"))
    same = (F.col("_size") == F.col("file_size")) & (F.col("file_size") > 0)
    status = F.when(F.col("_size").isNull(), "new").when(same, "skipped").otherwise("changed")
    return files.join(old, key, "left").select(*files.columns, status.alias("status"))


def load_type(spark: SparkSession, files: DataFrame, file_type: str, warehouse: str,
              charset: str | None = None, only_new: bool = True, load: str | None = None) -> DataFrame:
    """Load the ``discovered`` files of one type; return them with status, rows and rejected lines.

    Skipped files have the counts of their earlier load.  ``load`` names the load (default: a fresh name);
    a name that is committed already loads nothing, so a repeated call is harmless.
    """
    table, columns = FILE_TYPES[file_type]
    base = _root(warehouse, table)
    known = commits(spark, warehouse, table)
    if load is not None and load in [name for _, name in known]:
        todo, listed = [], files.withColumn("status", F.lit("skipped"))
    else:
        listed = file_status(files.filter(F.col("file_type") == file_type), manifest(spark, warehouse, table))
        # the listing has one row per file, as the file system's own answer has
        todo = [r for r in listed.collect() if r.status != "skipped" or not only_new]
        listed = spark.createDataFrame(listed.collect(), listed.schema)
    if todo:
        load = load or uuid.uuid4().hex
        lines = decoded(file_lines(spark, [r.path for r in todo]), charset)
        quoted = quoted_files(lines, columns)
        rows = parsed(lines, columns, quoted)
        fields = [F.nullif(F.col("fields")[i], F.lit("")).alias(c) for i, c in enumerate(columns)]
        data, aside = f"{base}/data/load={load}", f"{base}/quarantine/load={load}"
        rows.filter("reason is null").select(*fields, *LINEAGE_COLUMNS) \
            .write.mode("overwrite").partitionBy(*LINEAGE_COLUMNS).parquet(data)
        rows.filter("reason is not null").select(*LINEAGE_COLUMNS, "reason", "line") \
            .write.mode("overwrite").parquet(aside)
        counted = _written_counts(spark, data, aside, columns)
        read = spark.createDataFrame(
            [(r.cycle_year, r.file_type, r.file_name, r.file_size, (r.cycle_year, r.file_name) in quoted)
             for r in todo], "cycle_year int, file_type string, file_name string, file_size long, quoted boolean")
        record = read.join(counted, [read.cycle_year == counted.c_year, read.file_name == counted.c_file], "left")
        record.select(*read.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "rejected")]) \
            .coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/load={load}")
        _commit(spark, warehouse, table, load)
    key = ["cycle_year", "file_type", "file_name"]
    now = manifest(spark, warehouse, table).select(*key, "quoted", "rows", "rejected")
    return listed.drop("path").join(now, key, "left").select(
        F.lit(table).alias("table_name"), *key, "file_size", "status", "quoted", "rows", "rejected")


def _written_counts(spark: SparkSession, data: str, aside: str, columns: list[str]) -> DataFrame:
    """(c_year, c_file, rows, rejected) of what a load wrote; rows come from the files' footers."""
    good = _read(spark, [data], raw_schema(columns)).groupBy(*LINEAGE_COLUMNS).agg(F.count(F.lit(1)).alias("rows"))
    bad = spark.read.parquet(aside).groupBy(*LINEAGE_COLUMNS).agg(F.count(F.lit(1)).alias("rejected"))
    both = good.join(bad, LINEAGE_COLUMNS, "full")
    return both.select(F.col("cycle_year").alias("c_year"), F.col("source_file").alias("c_file"), "rows", "rejected")


def _read(spark: SparkSession, paths: list[str], schema: T.StructType, base: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema)
    try:
        return (reader.option("basePath", base) if base else reader).parquet(*paths)
    except AnalysisException as exc:          # a load without any accepted row has no data folder
        if exc.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def load_filings(spark: SparkSession, root: str, warehouse: str, cycles: list[int],
                 file_types: list[str] | None = None, charset: str | None = None,
                 only_new: bool = True) -> DataFrame:
    """Load new and changed files of every type; one row per file found, with its status and counts."""
    files = discovered(spark, root, cycles, file_types)
    parts = [load_type(spark, files, ftype, warehouse, charset, only_new) for ftype in file_types or FILE_TYPES]
    return reduce(DataFrame.unionByName, parts)


def read_table(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """The table as of the newest commit: each file's rows from its newest committed load.

    A table that was never loaded is an error, but for an optional one, which is then empty.
    """
    columns = columns_of(table)
    if table not in OPTIONAL_TABLES and not commits(spark, warehouse, table):
        raise FileNotFoundError(f"no committed load of {table} below {warehouse}")
    live = manifest(spark, warehouse, table).filter("rows > 0")
    loads = sorted(r.load for r in live.select("load").distinct().collect())
    schema = raw_schema(columns)
    if not loads:
        return spark.createDataFrame([], schema)
    base = f"{_root(warehouse, table)}/data"
    with_load = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    rows = _read(spark, [f"{base}/load={x}" for x in loads], with_load, base)
    # partition columns only: the join prunes folders, a file's superseded rows are not read; one row
    # per file is sent to the rows, which are not dealt by file
    names = live.select("load", "cycle_year", F.col("file_name").alias("source_file"))
    return rows.join(F.broadcast(names), ["load", *LINEAGE_COLUMNS], "left_semi").select(*schema.names)


def load_raw(spark: SparkSession, root: str, warehouse: str, cycles: list[int],
             file_types: list[str] | None = None, charset: str | None = None) -> DataFrame:
    """Load every file again, whatever the manifest has: (table_name, cycle_year, source_file, rows, rejected)."""
    return load_filings(spark, root, warehouse, cycles, file_types, charset, only_new=False).select(
        "table_name", "cycle_year", F.col("file_name").alias("source_file"), "rows", "rejected")


def read_raw_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """All raw tables; an optional one that was never loaded is empty."""
    return {name: read_table(spark, warehouse, name) for name in RAW_TABLES}


def read_quarantine(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """(cycle_year, source_file, reason, line, load): the lines set aside of the files as they are now."""
    live = manifest(spark, warehouse, table).filter("rejected > 0")
    loads = sorted(r.load for r in live.select("load").distinct().collect())
    if not loads:
        return spark.createDataFrame([], QUARANTINE)
    base = f"{_root(warehouse, table)}/quarantine"
    rows = spark.read.schema(QUARANTINE).option("basePath", base).parquet(*[f"{base}/load={x}" for x in loads])
    names = live.select("load", "cycle_year", F.col("file_name").alias("source_file"))
    return rows.join(F.broadcast(names), ["load", *LINEAGE_COLUMNS], "left_semi") \
               .select(*T.StructType.fromDDL(QUARANTINE).names)


def write_filing_files(lines: DataFrame, root: str, file_type: str) -> None:
    """Write (line binary or value string, cycle_year, source_file) as ``{root}/{year}/{type}/{name}.{n}.txt``."""
    spark = lines.sparkSession
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    value = F.col("line").cast("string") if "line" in lines.columns else F.col("value")
    lines.select(value.alias("value"), *LINEAGE_COLUMNS).write.partitionBy(*LINEAGE_COLUMNS).text(staging)
    found, fs = _folder(spark, f"{staging}/cycle_year=*/source_file=*/part-*")
    numbers: dict[str, int] = {}
    for status in sorted(fs.globStatus(found) or [], key=lambda s: s.getPath().toString()):
        part = status.getPath()
        name = part.getParent().getName().partition("=")[2]
        year = part.getParent().getParent().getName().partition("=")[2]
        folder, _ = _folder(spark, f"{root}/{year}/{file_type}")
        fs.mkdirs(folder)
        at = numbers[f"{year}/{name}"] = numbers.get(f"{year}/{name}", -1) + 1
        target, _ = _folder(spark, f"{root}/{year}/{file_type}/{name}.{at}.txt")
        if not fs.rename(part, target):
            raise OSError(f"could not place {target.toString()}")
    staged, fs = _folder(spark, staging)
    fs.delete(staged, True)
