"""Continuous ingest: new VCF files in a folder -> appended tables.

The batch ingest runs once per input; here a Structured Streaming file
source picks up files as they land and every micro-batch goes through
the same table builders (``plans.ingest.build_tables``).

* The file source never splits a file across micro-batches, so each
  batch holds whole files, header lines included.
* Each micro-batch is stored as one batch of the store
  (``plans.ingest.store_tables``), as the batch ingest stores an input: it
  counts from its marker on, a retried micro-batch that is marked already
  stores nothing, and sites that several have are merged by key when read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import build_tables, store_tables
from ..plans.query import TABLE_NAMES, load_table
from ..session import scratch_path
from ..sources.vcf import source_of_lines


def write_batch(batch: DataFrame, batch_id: int, root: str, profile: str = "full", stream: str = "stream", on_duplicate: str = "merge") -> None:
    """Ingest one micro-batch of VCF lines (``value``, ``file_path``) of the
    stream named ``stream``."""
    src = source_of_lines(batch)
    if src is None:
        return
    src = src.stage(scratch_path(batch.sparkSession, "vcf-stage"))
    source = f"{profile} {stream} {batch_id}"
    store_tables(batch.sparkSession, build_tables(src, profile), root, profile, source, source, src.sample_ids, on_duplicate=on_duplicate)


def start_ingest_stream(
    spark: SparkSession,
    input_dir: str,
    root: str,
    checkpoint: str,
    *,
    profile: str = "full",
    max_files_per_trigger: int = 1_000,
    on_duplicate: str = "merge",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream; returns the running query.

    ``checkpoint`` must be on shared storage (for instance under the
    session's ``spark.checkpoint.dir``); it also names the stream in the
    store.  ``max_files_per_trigger`` bounds the headers of a micro-batch.
    ``on_duplicate``: as for ``ingest``.  ``trigger`` is passed to
    ``DataStreamWriter.trigger`` (e.g. ``{"availableNow": True}``).
    """
    reader = spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(input_dir).select(
        "value", F.col("_metadata.file_path").alias("file_path")
    )
    w = lines.writeStream.foreachBatch(lambda df, bid: write_batch(df, bid, root, profile, checkpoint, on_duplicate)).option(
        "checkpointLocation", checkpoint
    )
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def stream_tables(spark: SparkSession, root: str, profile: str = "full", names: Sequence[str] = ("main", "info", "csq", "genotypes")) -> dict[str, DataFrame]:
    """The tables of a store, by name."""
    return {n: load_table(spark, root, n, profile) for n in names if n in TABLE_NAMES[profile]}
