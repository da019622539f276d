"""Site, INFO and annotation projections of scanned VCF rows.

Each function maps a scanned frame (see :mod:`varlake.sources.vcf`) to a
stored table shape by selecting and renaming columns; nothing here
shuffles.  The scanned frame is expected to have had
:func:`varlake.sources.vcf.pos_one_based` applied, as the stored ``pos``
is 1-based.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import (
    SLIM_CSQ_FIELDS,
    csq_column_names,
    csq_reserved_names,
)

# Scanned column -> stored column of the site table.
MAIN_RENAMES = {
    "contigName": "chrom",
    "start": "pos",
    "names": "id",
    "referenceAllele": "ref",
    "alternateAlleles": "alt",
    "qual": "qual",
    "filters": "filter",
}

# Scanned column -> stored column of the INFO table.
INFO_RENAMES = {
    "contigName": "chrom",
    "start": "pos",
    "INFO_AC": "ac",
    "INFO_AN": "an",
    "INFO_BaseQRankSum": "baseqranksum",
    "INFO_DB": "db",
    "INFO_RAW_MQ": "raw_mq",
}

CSQ_STRUCT = "INFO_CSQ"


def _stored(src: str, dst: str) -> Column:
    # positions are stored as int (chromosomes are far below 2**31)
    c = F.col(src)
    return (c.cast("int") if dst == "pos" else c).alias(dst)


def rename_select(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Select the keys of ``renames`` in order, each under its new name.

    A source missing from ``df`` is an error (Spark reports it)."""
    return df.select(*[_stored(src, dst) for src, dst in renames.items()])


def main_project(scanned: DataFrame) -> DataFrame:
    """chrom, pos, id, ref, alt, qual, filter."""
    return rename_select(scanned, MAIN_RENAMES)


def info_project(scanned: DataFrame, renames: Mapping[str, str] = INFO_RENAMES) -> DataFrame:
    """chrom, pos and the INFO fields of ``renames``; a field missing from
    the VCF header fails loudly rather than coming out as nulls."""
    return rename_select(scanned, renames)


def csq_explode(scanned: DataFrame, keep_index: bool = False) -> DataFrame:
    """One row per annotation of each site; sites whose CSQ is null or
    empty produce no row.  ``keep_index`` adds ``csq_no`` (0-based
    position in the site's CSQ list), the key that makes rows unique."""
    if keep_index:
        return scanned.select(
            "*", F.posexplode(CSQ_STRUCT).alias("csq_no", "_csq")
        )
    return scanned.select("*", F.explode(CSQ_STRUCT).alias("_csq"))


def _csq_field(name: str) -> Column:
    # getField takes the raw header name, so '+', '-', '(' need no quoting
    return F.col("_csq").getField(name)


def csq_project(
    exploded: DataFrame,
    fields: Sequence[str],
    names: Sequence[str] | None = None,
    keep_index: bool = False,
) -> DataFrame:
    """chrom, pos, [csq_no,] then each annotation field under its stored
    name (by default the naming rule of :func:`csq_column_names`)."""
    if names is None:
        names = csq_column_names(fields, csq_reserved_names())
    cols = [_stored("contigName", "chrom"), _stored("start", "pos")]
    if keep_index:
        cols.append(F.col("csq_no"))
    cols += [_csq_field(f).alias(n) for f, n in zip(fields, names)]
    return exploded.select(*cols)


def csq_project_full(exploded: DataFrame, csq_fields: Sequence[str], keep_index: bool = False) -> DataFrame:
    """All annotation fields of the CSQ header, renamed by rule."""
    return csq_project(exploded, csq_fields, keep_index=keep_index)


def csq_project_slim(exploded: DataFrame, keep_index: bool = False) -> DataFrame:
    """chrom, pos, allele, consequence, existing_variation,
    gnomad_exomes_af, gnomad_genomes_af, symbol."""
    return csq_project(exploded, SLIM_CSQ_FIELDS, keep_index=keep_index)


def csq_table(scanned: DataFrame, csq_fields: Sequence[str], profile: str = "full", keep_index: bool = True) -> DataFrame:
    """Explode and project in one step for ``profile`` 'full' or 'slim'."""
    ex = csq_explode(scanned, keep_index=keep_index)
    if profile == "full":
        return csq_project_full(ex, csq_fields, keep_index=keep_index)
    if profile == "slim":
        return csq_project_slim(ex, keep_index=keep_index)
    raise ValueError(f"unknown csq profile {profile!r}; use 'full' or 'slim'")
