"""Filing loads over real files: raw rows are written out as bulk text files, loaded, and read back.

The files hold what bulk files hold: lines with a field too few or too many, a file whose
text fields are quoted (with separators and quotes inside), and lines that are not UTF-8.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import lens, loader
from ..sources.layouts import ALL_CYCLES, LINEAGE_COLUMNS, columns_of

PAC, LINK = "pac_contributions", "candidate_committee_linkage"


def _source_name(file: str):
    """The name a written file was asked to have, without its part number."""
    return F.regexp_replace(file, r"\.\d+\.txt$", "")


def pac_lines(raw: DataFrame) -> DataFrame:
    """(line binary, cycle_year, source_file): the rows of the PAC table as bulk lines."""
    text = raw.sparkSession.sql(lens.filing_lines_sql(columns_of(PAC)), raw=raw)
    return text.select(F.concat(F.col("value").cast("binary"), F.when(F.col("bad_bytes"), F.lit(b"\xe9"))
                                .otherwise(F.lit(b""))).alias("line"), *LINEAGE_COLUMNS)


def loaded_pac(spark: SparkSession, raw: DataFrame, folder: str) -> str:
    """A warehouse below ``folder`` with the PAC files loaded, built on the first call."""
    warehouse = f"{folder}/filing-loads"
    if not loader.commits(spark, warehouse, PAC):
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/filings-{uuid.uuid4().hex}"
        loader.write_filing_files(pac_lines(raw), root, "pas2")
        loader.load_filings(spark, root, warehouse, ALL_CYCLES, ["pas2"])
    return warehouse


def round_trip(spark: SparkSession, warehouse: str) -> DataFrame:
    """The loaded PAC table, its file names without part numbers."""
    rows = loader.read_table(spark, warehouse, PAC)
    return rows.withColumn("source_file", _source_name("source_file"))


def set_aside(spark: SparkSession, warehouse: str) -> DataFrame:
    """(cycle_year, source_file, reason, n_lines) of the lines set aside."""
    return loader.read_quarantine(spark, warehouse, PAC).groupBy(
        "cycle_year", _source_name("source_file").alias("source_file"), "reason") \
        .agg(F.count(F.lit(1)).alias("n_lines"))


def load_record(spark: SparkSession, warehouse: str) -> DataFrame:
    """(cycle_year, source_file, quoted, rows, rejected) of the manifest, summed over a file's parts."""
    return loader.manifest(spark, warehouse, PAC).groupBy(
        "cycle_year", _source_name("file_name").alias("source_file"), "quoted") \
        .agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"))


def incremental_runs(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Three loads of the link files: (run, cycle_year, file_name, status, rows, table_rows).

    Run 1 finds files f0 to f3 without their late rows, run 2 the same but for f2, which is issued again
    with them, and a new file f4; run 3 finds nothing new.  ``table_rows`` counts a file's
    rows in the table as it stood after the run.
    """
    named = spark.sql(lens.link_files_sql(), raw=links)
    lines = named.withColumn("value", F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns_of(LINK)]))
    states = [lines.filter("source_file <> 'f4' and not late"),
              lines.filter("source_file in ('f2', 'f4') or not late")]
    home = f"{ensure_checkpoint_dir(spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"
    for i, state in enumerate(states):
        one_part = state.repartition("cycle_year", "source_file")       # a file keeps its name and size
        loader.write_filing_files(one_part, f"{home}/state{i}", "ccl")
    out = []
    for run, state in enumerate((0, 1, 1), 1):
        report = loader.load_filings(spark, f"{home}/state{state}", f"{home}/warehouse", ALL_CYCLES, ["ccl"])
        held = loader.read_table(spark, f"{home}/warehouse", LINK).groupBy(
            "cycle_year", F.col("source_file").alias("file_name")).agg(F.count(F.lit(1)).alias("table_rows"))
        out.append(report.join(held, ["cycle_year", "file_name"], "left").select(
            F.lit(run).alias("run"), "cycle_year", _source_name("file_name").alias("file_name"), "status", "rows",
            F.coalesce("table_rows", F.lit(0)).alias("table_rows")))
    return reduce(DataFrame.unionByName, out)
