"""Incremental filing loads with Structured Streaming.

A file-source stream over ``{root}/*/{file_type}/*.txt`` wakes up when files arrive; the load
itself is the manifest-driven one.  Each micro-batch loads the files that the manifest
does not have, or has with another size, so a file issued again under its old path is
replaced with the next batch too, and rejected lines are set aside and counted as in a batch
load.  A batch replayed after a failure finds its load committed, or loads it anew; rows
are never doubled.  Run it with ``trigger(availableNow=True)`` as a scheduled job, or
continuously.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.delimited import accepted, with_lineage
from ..sources.layouts import ALL_CYCLES, FILE_TYPES
from ..sources.loader import discovered, load_type


def filing_stream(spark: SparkSession, root: str, file_type: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming raw table of one file type (text columns + lineage), split plainly."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return accepted(with_lineage(reader.text(f"{root}/*/{file_type}/*.txt")),
                    FILE_TYPES[file_type][1])


def start_filing_load(spark: SparkSession, root: str, file_type: str, warehouse: str,
                      checkpoint: str, available_now: bool = True,
                      max_files_per_trigger: int | None = None, charset: str | None = None) -> StreamingQuery:
    """Start the incremental load of one file type into the table that ``loader.read_table`` reads."""
    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        load_type(session, discovered(session, root, ALL_CYCLES, [file_type]), file_type, warehouse, charset)

    writer = (filing_stream(spark, root, file_type, max_files_per_trigger).writeStream
              .foreachBatch(load_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
