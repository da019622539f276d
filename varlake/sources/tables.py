"""Stored tables: Parquet folders partitioned by chromosome.

Layout: ``<root>/<table>/chrom=<contig>/part-*.parquet``, rows sorted by
position within each file.  A chrom predicate then prunes folders and a
pos predicate prunes row groups by their min/max statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COL = "chrom"
BATCH_COL = "batch"
SORT_COLS = ("chrom", "pos")


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return False


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    *,
    mode: str = "append",
    cluster: bool = False,
    num_partitions: int | None = None,
    max_records_per_file: int = 5_000_000,
    partition_by: tuple[str, ...] = (PARTITION_COL,),
    bloom_columns: tuple[str, ...] = (),
) -> str:
    """Write (default: append) ``df`` as table ``name`` under ``root``.

    Rows are sorted by (chrom, pos) within each task, so files written
    from position-ordered input (a VCF is sorted) have tight pos ranges
    and no shuffle is needed.  ``cluster=True`` range-partitions on
    (chrom, pos) first: one shuffle, for input in no useful order, after
    which every file covers one narrow pos range.  ``bloom_columns``: text
    columns that get Parquet bloom filters, for equality on many values.
    """
    if cluster:
        n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # a deterministic row hash breaks ties, so one hot (chrom, pos)
        # with many rows still spreads over several range partitions
        hashable = [
            F.col(f.name) for f in df.schema.fields if not _has_map(f.dataType)
        ]
        df = df.repartitionByRange(n, *SORT_COLS, F.xxhash64(*hashable))
    path = table_path(root, name)
    w = df.sortWithinPartitions(*SORT_COLS).write.mode(mode).partitionBy(*partition_by)
    for c in bloom_columns:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.option("maxRecordsPerFile", max_records_per_file).parquet(path)
    return path


def scan_table(spark: SparkSession, root: str, name: str, *, merge_schema: bool = False) -> DataFrame:
    """Load table ``name``; chrom stays text (partition type inference
    would turn contigs like '1' into numbers).  This is the plain scan of
    one folder; tables that ``ingest`` stored in batches are read by
    ``plans.query.load_table``."""
    path = table_path(root, name)
    reader = spark.read.option("mergeSchema", "true") if merge_schema else spark.read
    df = reader.parquet(path)
    if not isinstance(df.schema[PARTITION_COL].dataType, T.StringType):
        # numeric-looking contigs ('1', '01') were typed by inference: read
        # again with chrom declared as text so names stay as written
        fields = [
            T.StructField(PARTITION_COL, T.StringType(), True) if f.name == PARTITION_COL else f
            for f in df.schema.fields
        ]
        df = reader.schema(T.StructType(fields)).parquet(path)
    # partition columns come last from the reader; put chrom back in front
    return df.select(PARTITION_COL, *[c for c in df.columns if c != PARTITION_COL])
