"""Key merges, schema evolution, previews and counts on stored tables.

A wide-column store upserts by primary key: writing a row whose key
exists replaces the written columns and leaves the others alone.  On
immutable Parquet files that becomes :func:`upsert_merge`, a full outer
join on the key whose result is written to a new folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import KEY


class SchemaConflictError(ValueError):
    """A column exists already with a different type."""


def upsert_merge(old: DataFrame, new: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Merge ``new`` into ``old`` by ``key`` (both key-unique).

    For keys in ``new``, the columns ``new`` carries take its values
    (null included, as an upsert of that column would); columns only in
    ``old`` keep their values; keys only in ``old`` are unchanged.
    Merging the same batch twice gives the same table.
    """
    key = list(key)
    _check_types(old, new)
    old_cols = [c for c in old.columns if c not in key]
    new_cols = [c for c in new.columns if c not in key]
    o = old.select(*key, *[F.col(c).alias(f"_o_{c}") for c in old_cols])
    n = new.select(*key, F.lit(True).alias("_in_new"), *[F.col(c).alias(f"_n_{c}") for c in new_cols])
    j = o.join(n, key, "full_outer")
    hit = F.col("_in_new").isNotNull()
    out = [F.col(k) for k in key]
    for c in old_cols:
        if c in new_cols:
            out.append(F.when(hit, F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c))
        else:
            out.append(F.col(f"_o_{c}").alias(c))
    out += [F.col(f"_n_{c}").alias(c) for c in new_cols if c not in old_cols]
    return j.select(*out)


def _check_types(a: DataFrame, b: DataFrame) -> None:
    bt = {f.name: f.dataType for f in b.schema.fields}
    for f in a.schema.fields:
        if f.name in bt and bt[f.name] != f.dataType:
            raise SchemaConflictError(
                f"column {f.name!r} is {f.dataType.simpleString()} on one side and "
                f"{bt[f.name].simpleString()} on the other"
            )


def schema_evolve(df: DataFrame, columns: Mapping[str, T.DataType | str]) -> DataFrame:
    """Add each missing column as a typed null; a column that exists with
    the same type is left alone, one with another type is an error."""
    have = {f.name: f.dataType for f in df.schema.fields}
    adds = {}
    for name, dtype in columns.items():
        dt = T.DataType.fromDDL(dtype) if isinstance(dtype, str) else dtype
        if name in have:
            if have[name] != dt:
                raise SchemaConflictError(
                    f"column {name!r} exists as {have[name].simpleString()}, not {dt.simpleString()}"
                )
            continue
        adds[name] = F.lit(None).cast(dt)
    return df.withColumns(adds) if adds else df


def union_evolve(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both frames by column name; a column missing on one side is
    null there (types must agree where both have it)."""
    _check_types(a, b)
    return a.unionByName(b, allowMissingColumns=True)


def preview(df: DataFrame, n: int = 20, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in ``order`` (default: all columns), a top-k that
    keeps at most ``n`` rows per task."""
    cols = list(order) if order else list(df.columns)
    return df.orderBy(*cols).limit(n)


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Number of rows, as a one-row frame (partial counts per task)."""
    return df.agg(F.count(F.lit(1)).alias(name))
