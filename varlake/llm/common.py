"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import varlake
from varlake.session import scratch_path


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names, and nothing else: ``pick(df,
    key="doc_id")``.  Names are matched exactly, so further columns, also ones
    that differ in case only or are called like an operator's own, don't
    matter."""
    names = df.columns
    for name in columns.values():
        if name not in names:
            raise ValueError(f"no column {name}; there are {', '.join(names)}")
    plain = df.toDF(*(f"c{i}" for i in range(len(names))))
    return plain.select(*(plain[f"c{names.index(old)}"].alias(new) for new, old in columns.items()))


def shared_folder(spark: SparkSession) -> str:
    """A new folder for an intermediate table, on the storage that all
    executors share (``spark.checkpoint.dir``)."""
    return scratch_path(spark, "llm")


def stored(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read again: its
    lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _importable(spark: SparkSession) -> None:
    """Lets the Python workers of a local session import this package from
    where the driver did, whatever the working folder.  On a cluster it is
    installed, or passed with --py-files."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        own = str(Path(varlake.__file__).resolve().parent.parent)
        paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if own not in paths:
            sc.environment["PYTHONPATH"] = os.pathsep.join([own, *paths])


def arrow_map(df: DataFrame, fn: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` that passes over empty batches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(b for b in batches if b.num_rows)

    _importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def strings(column: pa.Array, rows: int = 256) -> Iterator[str]:
    """The values of a text column, a few rows at a time, so that a batch is
    never held twice as a whole."""
    for a in range(0, len(column), rows):
        yield from column.slice(a, rows).to_pylist()


def ddl(df: DataFrame, name: str) -> str:
    """The type of a column, for a schema string."""
    return df.schema[name].dataType.simpleString()

