"""Joins on the site key (chrom, pos) and the positional zip.

``annotate_join`` is the answer shape of every variant query: each
annotation row, left-joined to its site and INFO row.  Key columns come
once, from the annotation side; annotation columns that share a name
with a site or INFO column are prefixed ``csq_``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

KEY = ("chrom", "pos")

# Low bits of monotonically_increasing_id hold the row's place in its
# partition, the high bits the partition index.
_ROW_BITS = 33


def main_info_join(main: DataFrame, info: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Inner equi-join of site and INFO rows on the composite key; the key
    appears once.  Catalyst chooses broadcast or sort-merge; AQE can
    switch to broadcast at run time from measured sizes."""
    clash = (set(main.columns) & set(info.columns)) - set(key)
    if clash:
        raise ValueError(f"site and INFO tables share non-key columns {sorted(clash)}")
    return main.join(info, list(key), "inner")


def _prefix_clashes(csq: DataFrame, others: Sequence[str], key: Sequence[str]) -> DataFrame:
    clash = [c for c in csq.columns if c in set(others) and c not in key]
    if not clash:
        return csq
    return csq.withColumnsRenamed({c: f"csq_{c}" for c in clash})


def semi_reduce(table: DataFrame, keys: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Rows of ``table`` whose key occurs in ``keys`` (left semi join).

    No broadcast hint: the key set of a filter has no size bound known in
    advance, so AQE picks broadcast only when the measured side is small,
    and Spark's runtime bloom filter can trim the big side's scan."""
    return table.join(keys, list(key), "left_semi")


# Annotation rows of one site that one task joins; a site with more (in the
# stored list of hot sites) is split over as many tasks as that takes.
ROWS_PER_TASK = 250_000


def _hashable(df: DataFrame) -> list:
    return [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def hot_sites(csq: DataFrame, key: Sequence[str] = KEY, rows: int = ROWS_PER_TASK) -> DataFrame:
    """(key, n): sites with more than ``rows`` annotation rows.  The count
    combines map-side, so a hot site collapses in each task."""
    return csq.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows)


def _salted_left_join(csq: DataFrame, mi: DataFrame, hot: DataFrame, key: Sequence[str], rows: int) -> DataFrame:
    """csq LEFT JOIN mi on ``key`` where the ``hot`` sites are split: their
    annotation rows are spread over ceil(n / rows) salts by a row hash and
    their one site row is repeated for each salt; all other rows keep salt
    0.  Same rows as the plain join."""
    key = list(key)
    salts = hot.select(*key, F.ceil(F.col("n") / rows).cast("int").alias("_salts"))
    of = F.coalesce("_salts", F.lit(1))
    c = csq.join(salts, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*_hashable(csq)), of).cast("int"))
    m = mi.join(salts, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), of - 1)))
    return c.drop("_salts").join(m.drop("_salts"), [*key, "_salt"], "left").drop("_salt")


def annotate_join(
    csq: DataFrame,
    main: DataFrame,
    info: DataFrame,
    *,
    key: Sequence[str] = KEY,
    reduce_sites: bool = False,
    hot: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """csq LEFT JOIN (main JOIN info) on (chrom, pos).

    Every annotation row is kept (many per site); site and INFO columns
    are null where the site is missing from either table.
    ``reduce_sites``: first cut site and INFO rows to the keys present in
    ``csq`` (semi-join reduction).  Same rows either way; it pays when
    ``csq`` is filtered and the site tables are not, since then the full
    site tables would otherwise be shuffled for the inner join.
    ``hot``: the sites to split, as ``hot_sites`` gives them; ingest
    stores them, so a query reads the annotation table once.
    """
    csq = _prefix_clashes(csq, list(main.columns) + list(info.columns), key)
    if reduce_sites:
        keys = csq.select(*key).distinct()
        main = semi_reduce(main, keys, key)
        info = semi_reduce(info, keys, key)
    mi = main_info_join(main, info, key)
    if hot is None:
        return csq.join(mi, list(key), "left")
    return _salted_left_join(csq, mi, hot, key, rows_per_task)


def with_row_index(
    df: DataFrame,
    order: Sequence[str],
    name: str = "row_index",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add a 1-based row number in ``order`` without a single-partition
    window.

    The frame is range-partitioned, sorted and written once to the shared
    scratch folder with each row's partition and place in it; the offset
    of each partition comes from counts over that same table.  (Range
    bounds are sampled anew in every job, so counts from a second job over
    ``df`` would belong to other partitions.)  The offsets have one row
    per partition.  ``order`` must be unique for the numbering to be
    deterministic.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = ranged.withColumn("_mid", F.monotonically_increasing_id()).select(
        *df.columns,
        F.shiftright(F.col("_mid"), _ROW_BITS).alias("_part"),
        (F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).alias("_local"),
    )
    path = scratch_path(spark, "row-index")
    tagged.write.parquet(path)
    stored = spark.read.schema(tagged.schema).parquet(path)
    counts = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        stored.join(offsets, "_part", "inner")
        .withColumn(name, F.col("_offset") + F.col("_local") + F.lit(1))
        .select(*df.columns, name)
    )


def positional_join(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[str],
    right_order: Sequence[str],
    name: str = "row_index",
) -> DataFrame:
    """Zip two frames by row number (inner): the i-th row of ``left`` in
    ``left_order`` meets the i-th row of ``right`` in ``right_order``.

    Both orders must be unique keys; a constant order (no order at all)
    is refused, since it could pair rows arbitrarily."""
    if not left_order or not right_order:
        raise ValueError("positional_join needs an explicit unique order on both sides")
    clash = (set(left.columns) & set(right.columns)) - {name}
    if clash:
        raise ValueError(f"positional_join inputs share columns {sorted(clash)}")
    li = with_row_index(left, left_order, name)
    ri = with_row_index(right, right_order, name)
    return li.join(ri, name, "inner")
