"""One callable per operator id, over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built from
the given tables (through the stand-in views of
:mod:`varlake.plans.standin`), so its work grows with them.  Arrays and
maps are rendered as text at the end (``flat``) so results compare
across engines; the DuckDB forms are in :mod:`varlake.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import SLIM_CSQ_FIELDS
from ..operators import filters as flt
from ..operators.genotypes import (
    genotype_maps_view,
    genotypes_long,
    genotypes_long_flat,
    genotypes_wide,
    list_map_text,
    map_text,
    sample_slice,
)
from ..operators.joins import annotate_join, main_info_join, positional_join
from ..operators.project import (
    csq_explode,
    csq_project_full,
    csq_project_slim,
    info_project,
    main_project,
)
from ..operators.store import preview, row_count, schema_evolve, union_evolve, upsert_merge
from ..session import scratch_path
from ..sources.tables import scan_table, write_table
from ..sources.vcf import exploded, open_vcf, pos_one_based, read_vcf
from . import standin
from .compact import compact
from .ingest import ingest
from .query import load_table, load_tables, query_variants, run_query

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered A..F queries.
PARAMS = {
    "A": {"chrom": "chr7"},
    "B": {"chrom": "chr7", "pos": 28},
    "C": {"chrom": "chr7", "pos_start": 100, "pos_end": 2000},
    "D": {"existing_variation": "rs77"},
    "E": {"gnomad_exomes_af": 0.02, "gnomad_genomes_af": 0.02},
    "F": {"symbol": "Brand#4", "consequence": "ring"},
}

# Samples of the registered wide-genotype query and of query_variants.
WIDE_SAMPLES = ("NA-00", "NA-05", "NA-11")
QUERY_SAMPLES = ("NA-00", "NA-05")


def _text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"no text form for {dtype.simpleString()}")
        return F.array_join(c.cast("array<string>"), ",")
    if isinstance(dtype, T.MapType):
        if isinstance(dtype.valueType, T.ArrayType):
            return list_map_text(c)
        return map_text(c)
    return c


def flat(df: DataFrame) -> DataFrame:
    """Arrays -> 'a,b'; maps -> 'k=v;k=v' (keys sorted)."""
    return df.select(*[_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def _vcf_source(spark: SparkSession, sf: str):
    """The stand-in written as VCF files (one per chromosome) and opened
    as any VCF input is."""
    return open_vcf(spark, _write_vcf(spark, sf))


def _scanned(spark: SparkSession, sf: str) -> DataFrame:
    return _vcf_source(spark, sf).sites()


def _tables(spark: SparkSession, sf: str):
    return standin.v_main(spark, sf), standin.v_info(spark, sf), standin.v_csq(spark, sf)


# ----------------------------------------------------------------- sources


def q_vcf_scan(spark, sf):
    s = _scanned(spark, sf)
    return flat(s.select("contigName", "start", "names", "referenceAllele", "alternateAlleles", "qual", "filters"))


def q_vcf_flatten_info(spark, sf):
    s = _scanned(spark, sf)
    return flat(s.select("contigName", "start", "INFO_AC", "INFO_AN", "INFO_BaseQRankSum", "INFO_DB", "INFO_RAW_MQ"))


def q_vcf_sample_ids(spark, sf):
    s = _scanned(spark, sf)
    return exploded(s, ["contigName", "start"], F.col("genotypes.sampleId"), "sample_index", "sampleId")


def q_vcf_csq_struct(spark, sf):
    s = _scanned(spark, sf)
    e = s.select("contigName", "start", F.posexplode("INFO_CSQ").alias("csq_no", "e"))
    return flat(
        e.select(
            "contigName",
            "start",
            "csq_no",
            *[F.col("e").getField(f).alias(f) for f in SLIM_CSQ_FIELDS],
        )
    )


def _write_vcf(spark: SparkSession, sf: str, compression: str | None = None) -> str:
    """Render the stand-in as VCF files (one per chromosome and block of positions) in scratch."""
    return standin.write_vcf_files(spark, sf, scratch_path(spark, "vcf"), compression)


def q_vcf_bgzf(spark, sf):
    """Block-gzip files of many members read back through read_vcf, in ranges."""
    path = standin.write_bgzf_files(spark, sf, scratch_path(spark, "vcf"))
    s, _ = read_vcf(spark, path, range_bytes=1 << 18)
    return flat(s.select("contigName", "start", "names", "referenceAllele", "alternateAlleles", "qual", "filters"))


def q_table_scan(spark, sf):
    root = scratch_path(spark, "tables")
    write_table(standin.v_csq(spark, sf), root, "csq", cluster=True)
    return flat(scan_table(spark, root, "csq"))


# ------------------------------------------------------------------- sinks


def q_table_append(spark, sf):
    root = scratch_path(spark, "tables")
    m = standin.v_main(spark, sf)
    # two appends into one table: finished orders, then the rest
    write_table(m.where(F.col("ref") == "F"), root, "main")
    write_table(m.where(F.col("ref") != "F"), root, "main")
    return flat(scan_table(spark, root, "main"))


def _merge_inputs(spark, sf):
    m = standin.v_main(spark, sf)
    old = m.where(F.col("ref").isin("F", "O")).select("chrom", "pos", "id", "ref", "qual")
    new = m.where(F.col("ref").isin("O", "P")).select(
        "chrom", "pos", F.lower("ref").alias("ref"), "alt", "filter"
    )
    return old, new


def q_upsert_merge(spark, sf):
    old, new = _merge_inputs(spark, sf)
    return flat(upsert_merge(old, new))


def q_schema_evolve(spark, sf):
    m = standin.v_main(spark, sf)
    a = schema_evolve(m.where(F.col("ref") == "F").select("chrom", "pos", "id"), {"id": "array<string>"})
    b = m.where(F.col("ref") != "F").select("chrom", "pos", "id", "qual")
    return flat(union_evolve(a, b))


def q_preview(spark, sf):
    main, info, csq = _tables(spark, sf)
    joined = flat(annotate_join(csq, main, info))
    order = [
        "chrom", "pos", "allele", "consequence", "symbol",
        "existing_variation", "gnomad_exomes_af", "gnomad_genomes_af",
    ]
    return preview(joined, 20, order)


# ------------------------------------------------------------- projections


def q_pos_one_based(spark, sf):
    return pos_one_based(_scanned(spark, sf)).select("contigName", "start")


def q_main_project(spark, sf):
    return flat(main_project(pos_one_based(_scanned(spark, sf))))


def q_info_project(spark, sf):
    return flat(info_project(pos_one_based(_scanned(spark, sf))))


def q_csq_explode(spark, sf):
    ex = csq_explode(pos_one_based(_scanned(spark, sf)), keep_index=True)
    return ex.select(
        F.col("contigName").alias("chrom"),
        F.col("start").cast("int").alias("pos"),
        "csq_no",
        F.col("_csq.Allele").alias("allele"),
    )


def q_csq_project_slim(spark, sf):
    ex = csq_explode(pos_one_based(_scanned(spark, sf)))
    return flat(csq_project_slim(ex))


def q_csq_project_full(spark, sf):
    ex = csq_explode(pos_one_based(_scanned(spark, sf)), keep_index=True)
    return flat(csq_project_full(ex, standin.VCF_HEADER.csq_fields, keep_index=True))


# --------------------------------------------------------------- genotypes


def q_sample_list(spark, sf):
    return _vcf_source(spark, sf).sample_list()


def q_sample_normalize(spark, sf):
    g = genotypes_long(pos_one_based(_scanned(spark, sf)))
    return g.select("chrom", "pos", "sample_index", "sample")


def q_sample_slice(spark, sf):
    s = sample_slice(_scanned(spark, sf), 10, 12)
    return exploded(s, ["contigName", "start"], F.col("genotypes"), "slot", "g").select("contigName", "start", "slot", F.col("g.sampleId").alias("sampleId"), F.col("g.depth").alias("depth"))


def q_genotype_maps(spark, sf):
    return flat(genotypes_long(pos_one_based(_scanned(spark, sf))))


def q_genotypes_long(spark, sf):
    # the ingest path: sample fields exploded from the text, then mapped
    fields = _vcf_source(spark, sf).genotypes()
    g = genotypes_long_flat(fields)
    # one row per (site, sample, map kind); a map without entries is empty text
    kinds = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.col(k + "_t").alias("entries")) for k in ("int", "text", "list_int")]
    )
    t = flat(g).withColumnsRenamed({"int": "int_t", "text": "text_t", "list_int": "list_int_t"})
    return t.select("chrom", "pos", "sample", F.inline(kinds))


def q_genotypes_wide(spark, sf):
    s = pos_one_based(_scanned(spark, sf))
    sites = s.withColumnsRenamed({"contigName": "chrom"}).withColumn("pos", F.col("start").cast("int"))
    return flat(genotypes_wide(sites, WIDE_SAMPLES, standin.SAMPLES, keep=("chrom", "pos")))


def q_positional_join(spark, sf):
    """Orders by key beside orders by price: both sides are as long."""
    o = standin.load(spark, sf, "orders")
    by_price = o.select(F.col("o_orderkey").alias("p_orderkey"), F.col("o_totalprice").alias("p_totalprice"))
    return positional_join(o.select("o_orderkey", "o_totalprice"), by_price, ["o_orderkey"], ["p_totalprice", "p_orderkey"])


# -------------------------------------------------------- filters and joins


def q_main_info_join(spark, sf):
    main, info, _ = _tables(spark, sf)
    return flat(main_info_join(main, info))


def q_annotate_join(spark, sf):
    main, info, csq = _tables(spark, sf)
    return flat(annotate_join(csq, main, info))


def _kind(kind: str) -> Query:
    def q(spark, sf):
        main, info, csq = _tables(spark, sf)
        f = flt.make_filter(kind, **PARAMS[kind])
        return flat(run_query(f, main, info, csq))

    q.__name__ = f"q_query_{kind.lower()}"
    return q


def q_query_e_text(spark, sf):
    """Kind E over stored annotations, whose frequencies are text."""
    root = _ingested(spark, sf)
    df = query_variants(spark, root, "E", gnomad_exomes_af=0.02, gnomad_genomes_af=0.05)
    return flat(df.select("chrom", "pos", "csq_no", "gnomad_exomes_af", "gnomad_genomes_af", "id", "an"))


def q_row_count(spark, sf):
    return row_count(standin.v_main(spark, sf))


# ---------------------------------------------------------------- composite


# Files that are ingested stay beside the store; they are packed, as cohort files are.
PACKED = "deflate"


def _ingested(spark, sf, profile: str = "full") -> str:
    path = _write_vcf(spark, sf, PACKED)
    root = scratch_path(spark, "store")
    ingest(spark, path, root, profile=profile)
    return root


def _ingested_table(table: str, profile: str = "full") -> Query:
    def q(spark, sf):
        df = load_table(spark, _ingested(spark, sf, profile), table, profile)
        if table == "genotypes":
            df = genotype_maps_view(df)
        return flat(df.drop(*flt.AF_NUMBERS.values()))

    return q


def _two_batches(spark, sf) -> str:
    """A store of two inputs that share the finished orders' sites."""
    root = scratch_path(spark, "store")
    for where in ("o_orderstatus in ('F', 'O')", "o_orderstatus in ('F', 'P')"):
        ingest(spark, standin.write_vcf_files(spark, sf, scratch_path(spark, "vcf"), PACKED, where=where), root)
    return root


def q_ingest_two_batches(spark, sf):
    """Each site counts once, whichever batch it comes from."""
    root = _two_batches(spark, sf)
    return flat(run_query(flt.make_filter("F", symbol="GENE4", consequence="missense_variant"), *load_tables(spark, root)))


def _two_batches_table(table: str, compacted: bool) -> Query:
    """All rows of a table of that store, merged as it is read or before."""

    def q(spark, sf):
        root = _two_batches(spark, sf)
        if compacted:
            compact(spark, root)
        df = load_table(spark, root, table)
        if table == "genotypes":
            df = genotype_maps_view(df)
        return flat(df.drop(*flt.AF_NUMBERS.values()))

    return q


def q_query_variants(spark, sf):
    root = _ingested(spark, sf)
    # with the map columns of two samples, as the reference's site table has them
    return flat(
        query_variants(
            spark, root, "F", symbol="GENE4", consequence="missense_variant", samples=list(QUERY_SAMPLES)
        )
    )


def registry() -> dict[str, Query]:
    return {
        "vcf_scan": q_vcf_scan,
        "vcf_flatten_info": q_vcf_flatten_info,
        "vcf_sample_ids": q_vcf_sample_ids,
        "vcf_csq_struct": q_vcf_csq_struct,
        "vcf_bgzf": q_vcf_bgzf,
        "table_scan": q_table_scan,
        "table_append": q_table_append,
        "upsert_merge": q_upsert_merge,
        "schema_evolve": q_schema_evolve,
        "preview": q_preview,
        "pos_one_based": q_pos_one_based,
        "main_project": q_main_project,
        "info_project": q_info_project,
        "csq_explode": q_csq_explode,
        "csq_project_slim": q_csq_project_slim,
        "csq_project_full": q_csq_project_full,
        "sample_list": q_sample_list,
        "sample_normalize": q_sample_normalize,
        "sample_slice": q_sample_slice,
        "genotype_maps": q_genotype_maps,
        "genotypes_long": q_genotypes_long,
        "genotypes_wide": q_genotypes_wide,
        "positional_join": q_positional_join,
        "main_info_join": q_main_info_join,
        "annotate_join": q_annotate_join,
        **{f"query_{k.lower()}": _kind(k) for k in "ABCDEF"},
        "query_e_text": q_query_e_text,
        "row_count": q_row_count,
        "ingest": _ingested_table("csq"),
        "ingest_main": _ingested_table("main"),
        "ingest_info": _ingested_table("info"),
        "ingest_genotypes": _ingested_table("genotypes"),
        "ingest_slim": _ingested_table("csq", "slim"),
        "ingest_slim_genotypes": _ingested_table("genotypes", "slim"),
        "ingest_two_batches": q_ingest_two_batches,
        **{f"merged_{t}": _two_batches_table(t, False) for t in ("info", "csq")},
        **{f"compacted_{t}": _two_batches_table(t, True) for t in ("main", "csq", "genotypes")},
        "query_variants": q_query_variants,
    }


__all__ = ["registry", "flat", "PARAMS"]
