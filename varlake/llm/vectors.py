"""Vectors in blocks: the layout that both searches share.

Candidates are packed into blocks of about ``BLOCK`` rows, and queries, which
are a stated part of the rows, into blocks of about ``QUERY_BLOCK``.  A query
block goes to every candidate block that it has to be held against, by a join on
the block's number, and each such pair of blocks is one matrix operation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varlake.llm.common import pick

BLOCK = 4_096
QUERY_BLOCK = 512


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec array<double>, row): the rows that take part, each with a number
    of its own.  Null vectors, vectors with a null, infinite or not-a-number
    component and null ids don't.  Rows may share an id: each is a candidate, but
    not for queries of that id, and queries of one id are answered together.
    Write the rows before ``row`` is used twice."""
    rows = pick(df, id=id_col, vec=vector_col)
    rows = rows.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("row", F.monotonically_increasing_id())


def packed(rows: DataFrame, *keys: str, columns: tuple[str, ...] = ("id", "vec")) -> DataFrame:
    """(*keys, rows): all rows with equal keys as one list of ``columns``."""
    return rows.groupBy(*keys).agg(F.collect_list(F.struct(*columns)).alias("rows"))


def block_of(row: Column, blocks: Column | int) -> Column:
    """A number below ``blocks``, evenly by the hash of the row's number."""
    return F.pmod(F.xxhash64(row), F.lit(blocks) if isinstance(blocks, int) else blocks).cast("int")


def matrix(cell: pa.ListScalar, column: str = "vec") -> tuple[np.ndarray, np.ndarray]:
    """The ids and the vectors (as rows) of a packed block."""
    rows = cell.values
    ids = rows.field("id").to_numpy()
    values = rows.field(column).flatten().to_numpy(zero_copy_only=False)
    return ids, values.reshape(len(ids), -1) if len(values) else np.zeros((len(ids), 0))


def best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of each query, ties
    to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
