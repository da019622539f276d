"""Variant queries over stored tables: filter A..F, then annotate.

``query_variants`` is the non-interactive form of a query menu: a kind
letter and its parameters in, the joined DataFrame out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import AF_NUMBERS, VariantFilter, make_filter
from ..operators.genotypes import stored_wide
from ..operators.joins import KEY, annotate_join, semi_reduce
from ..sources.batches import Batch, in_batches, read_batches, scan_batches, shared_ranges
from ..sources.tables import BATCH_COL, scan_table, table_path

# Stored table names per profile (full and slim/demo).
TABLE_NAMES = {
    "full": {"main": "main", "info": "info", "csq": "csq", "genotypes": "genotypes", "hot": "csq_hot", "variations": "csq_by_variation"},
    "slim": {"main": "main_query", "info": "info_query", "csq": "csq_query", "genotypes": "genotypes_query", "hot": "csq_query_hot", "variations": "csq_query_by_variation"},
}

# What identifies a row of each table.
TABLE_KEYS = {
    "main": ("chrom", "pos"),
    "info": ("chrom", "pos"),
    "csq": ("chrom", "pos", "csq_no"),
    "genotypes": ("chrom", "pos", "sampleId"),
    "hot": ("chrom", "pos"),
    "variations": ("variation", "chrom", "pos"),
}


def load_table(spark: SparkSession, root: str, table: str, profile: str = "full", batches: Sequence[Batch] | None = None) -> DataFrame:
    """One stored table ('main', 'info', 'csq', 'genotypes'): its batches,
    merged by key where they overlap, or, of a store without batches, the
    plain folder.  A table of batches none of which is marked has no rows."""
    if profile not in TABLE_NAMES:
        raise ValueError(f"unknown profile {profile!r}")
    name = TABLE_NAMES[profile][table]
    own = [b for b in (read_batches(spark, root) if batches is None else batches) if b.table == name]
    if own:
        return scan_batches(spark, root, own, TABLE_KEYS[table])
    df = scan_table(spark, root, name)
    return df.drop(BATCH_COL).where(F.lit(False)) if BATCH_COL in df.columns else df


def stored_rows(spark: SparkSession, root: str, table: str, profile: str = "full") -> int:
    """The number of rows of a stored table: from the markers where no two
    batches cover a position, else counted."""
    own = [b for b in read_batches(spark, root) if b.table == TABLE_NAMES[profile][table]]
    return load_table(spark, root, table, profile).count() if shared_ranges(own) or not own else sum(b.rows for b in own)


def stored_extents(spark: SparkSession, root: str, table: str = "main", profile: str = "full") -> dict[str, tuple[int, int]]:
    """The first and last position of each contig, from the markers."""
    out: dict[str, tuple[int, int]] = {}
    for b in read_batches(spark, root):
        if b.table == TABLE_NAMES[profile][table]:
            for chrom, (low, high) in b.contigs.items():
                if low is not None:
                    first, last = out.get(chrom, (low, high))
                    out[chrom] = (min(first, low), max(last, high))
    return out


def load_tables(spark: SparkSession, root: str, profile: str = "full") -> tuple[DataFrame, DataFrame, DataFrame]:
    batches = read_batches(spark, root)
    main, info, csq = (load_table(spark, root, t, profile, batches) for t in ("main", "info", "csq"))
    return main, info, csq


def stored_samples(spark: SparkSession, root: str, profile: str = "full", batches: Sequence[Batch] | None = None) -> list[str]:
    """Sample ids of a store in header order, from the batch markers (no
    genotype is read)."""
    name = TABLE_NAMES[profile]["genotypes"]
    batches = read_batches(spark, root) if batches is None else batches
    return list(dict.fromkeys(s for b in batches if b.table == name for s in b.samples))


def variation_sites(spark: SparkSession, root: str, profile: str, batches: Sequence[Batch], variant_id: str) -> DataFrame | None:
    """(chrom, pos) of the sites whose annotations may have the variation,
    from the table that ingest keeps sorted by variation (a few row groups
    are read); None for a store without it."""
    names = TABLE_NAMES[profile]
    own = [b for b in batches if b.table == names["variations"]]
    if not own or {b.batch for b in own} != {b.batch for b in batches if b.table == names["csq"]}:
        return None
    rows = spark.read.schema(f"variation string, {KEY[0]} string, {KEY[1]} int, {BATCH_COL} string").parquet(table_path(root, names["variations"]))
    return in_batches(rows.where(F.col("variation") == F.lit(str(variant_id))), own).select(*KEY).distinct()


def apply_filter(
    flt: VariantFilter, main: DataFrame, info: DataFrame, csq: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Region filters restrict all three tables, annotation filters only
    the annotation table (as the query kinds are defined)."""
    if flt.region:
        return main.where(flt.predicate), info.where(flt.predicate), csq.where(flt.predicate)
    numbers = flt.stored is not None and set(AF_NUMBERS.values()) <= set(csq.columns)
    return main, info, csq.where(flt.stored if numbers else flt.predicate)


def run_query(
    flt: VariantFilter,
    main: DataFrame,
    info: DataFrame,
    csq: DataFrame,
    *,
    reduce_sites: bool | None = None,
    csq_columns: Sequence[str] | None = None,
    genotypes: DataFrame | None = None,
    samples: Sequence[str] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Filter, then csq LEFT JOIN (main JOIN info).

    ``reduce_sites`` (semi-join reduction of site and INFO rows to the
    filtered annotation keys) defaults to on for the annotation filters
    D, E, F, where the site tables are otherwise read and shuffled whole.
    ``csq_columns`` restricts the annotation columns returned.
    ``genotypes`` + ``samples``: add the wide map columns of those samples
    to the site columns, as the stored site table of a wide-column store
    carries them; the genotype rows are cut to the answer's region or
    keys before they are grouped; wide columns are for named samples, and
    ``genotype_maps_view`` is the long form for whole cohorts.
    ``hot``: stored sites with very many annotation rows, to be split.
    """
    m, i, c = apply_filter(flt, main, info, csq)
    c = c.drop(*AF_NUMBERS.values())
    if csq_columns is not None:
        c = c.select(*KEY, *[x for x in csq_columns if x not in KEY])
    reduce = (not flt.region) if reduce_sites is None else reduce_sites
    if samples:
        if genotypes is None:
            raise ValueError("samples need the genotype table")
        g = genotypes.where(flt.predicate) if flt.region else semi_reduce(genotypes, c.select(*KEY).distinct())
        m = m.join(stored_wide(g, samples), list(KEY), "left")
    return annotate_join(c, m, i, reduce_sites=reduce, hot=hot)


def query_variants(
    spark: SparkSession,
    root: str,
    kind: str,
    *,
    profile: str = "full",
    reduce_sites: bool | None = None,
    csq_columns: Sequence[str] | None = None,
    samples: Sequence[str] | str | None = None,
    **params,
) -> DataFrame:
    """Query kind A..F with its parameters over the tables under ``root``.

    A: chrom; B: chrom, pos; C: chrom, pos_start, pos_end;
    D: existing_variation; E: gnomad_exomes_af, gnomad_genomes_af;
    F: symbol, consequence.  Unknown kinds raise ``ValueError``.
    ``samples``: sample ids whose genotype maps join the site columns, or
    ``"all"`` for every stored sample (the reference's site table carries
    them all).
    """
    flt = make_filter(kind, **params)
    batches = read_batches(spark, root)
    main, info, csq = (load_table(spark, root, t, profile, batches) for t in ("main", "info", "csq"))
    if flt.kind == "D":
        sites = variation_sites(spark, root, profile, batches, params["existing_variation"])
        if sites is not None:  # the annotation scan is cut to the contigs and sites found; the predicate still applies
            csq = semi_reduce(csq, sites)
    if samples == "all":
        samples = stored_samples(spark, root, profile, batches)
    genotypes = load_table(spark, root, "genotypes", profile, batches) if samples else None
    with_hot = [b for b in batches if b.table == TABLE_NAMES[profile]["hot"] and b.rows]
    hot = None
    if with_hot:  # a site's rows in all batches, at most: the merged count is not larger
        hot = in_batches(scan_table(spark, root, TABLE_NAMES[profile]["hot"]), with_hot)
        hot = hot.groupBy(*KEY).agg(F.sum("n").alias("n"))
    return run_query(
        flt, main, info, csq,
        reduce_sites=reduce_sites, csq_columns=csq_columns, genotypes=genotypes, samples=samples, hot=hot,
    )
