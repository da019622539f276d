"""The six variant predicates, A to F.

A, B and C select a region and apply to the site, INFO and annotation
tables alike; D, E and F test annotation fields and apply to the
annotation table only.  All are plain column predicates: chrom equality
becomes a partition filter on the stored tables and pos bounds become
Parquet row-group filters, so Catalyst pushes them into the scans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class VariantFilter:
    """A predicate and the tables it restricts."""

    kind: str
    predicate: Column
    region: bool  # True: restricts site, INFO and csq; False: csq only
    stored: Column | None = None  # the same on a table with AF_NUMBERS columns


def by_chrom(chrom: str) -> VariantFilter:
    """A: chrom = x."""
    return VariantFilter("A", F.col("chrom") == F.lit(str(chrom)), True)


def by_position(chrom: str, pos: int) -> VariantFilter:
    """B: chrom = x and pos = p."""
    return VariantFilter(
        "B", (F.col("chrom") == F.lit(str(chrom))) & (F.col("pos") == F.lit(int(pos))), True
    )


def by_range(chrom: str, pos_start: int, pos_end: int) -> VariantFilter:
    """C: chrom = x and pos_start <= pos <= pos_end (both ends kept)."""
    return VariantFilter(
        "C",
        (F.col("chrom") == F.lit(str(chrom)))
        & (F.col("pos") >= F.lit(int(pos_start)))
        & (F.col("pos") <= F.lit(int(pos_end))),
        True,
    )


def by_existing_variation(variant_id: str) -> VariantFilter:
    """D: existing_variation contains x."""
    return VariantFilter(
        "D", F.array_contains(F.col("existing_variation"), F.lit(str(variant_id))), False
    )


# Allele frequency text column -> the number stored beside it.
AF_NUMBERS = {"gnomad_exomes_af": "gnomad_exomes_af_number", "gnomad_genomes_af": "gnomad_genomes_af_number"}


def as_number(c: Column) -> Column:
    """Allele frequency text -> double; '.', '', lists ('0.1&0.2') and
    other non-numbers become null, so they never pass a comparison."""
    return c.try_cast("double")


def by_allele_frequency(max_exomes_af: float, max_genomes_af: float) -> VariantFilter:
    """E: gnomad_exomes_af < x and gnomad_genomes_af < y, compared as
    numbers (text order would put '1.2e-05' above '0.01').  On a stored
    table the comparison uses the numbers kept beside the text, so it
    reaches the Parquet row groups."""
    x, y = F.lit(float(max_exomes_af)), F.lit(float(max_genomes_af))
    text = [as_number(F.col(c)) for c in AF_NUMBERS]
    numbers = [F.col(c) for c in AF_NUMBERS.values()]
    return VariantFilter("E", (text[0] < x) & (text[1] < y), False, (numbers[0] < x) & (numbers[1] < y))


def by_gene_consequence(symbol: str, consequence: str) -> VariantFilter:
    """F: symbol = x and consequence contains y."""
    return VariantFilter(
        "F",
        (F.col("symbol") == F.lit(str(symbol)))
        & F.array_contains(F.col("consequence"), F.lit(str(consequence))),
        False,
    )


# Query kind -> (builder, parameter names in order).
QUERY_KINDS = {
    "A": (by_chrom, ("chrom",)),
    "B": (by_position, ("chrom", "pos")),
    "C": (by_range, ("chrom", "pos_start", "pos_end")),
    "D": (by_existing_variation, ("existing_variation",)),
    "E": (by_allele_frequency, ("gnomad_exomes_af", "gnomad_genomes_af")),
    "F": (by_gene_consequence, ("symbol", "consequence")),
}


def make_filter(kind: str, **params) -> VariantFilter:
    """Build the filter of ``kind`` (A..F) from named parameters; an
    unknown kind or a missing parameter raises ``ValueError``."""
    key = str(kind).upper()
    if key not in QUERY_KINDS:
        raise ValueError(f"unknown query kind {kind!r}; expected one of A-F")
    builder, names = QUERY_KINDS[key]
    missing = [n for n in names if n not in params]
    if missing:
        raise ValueError(f"query {key} needs parameters {names}, missing {missing}")
    return builder(*[params[n] for n in names])
