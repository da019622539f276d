"""Stand-in variant tables derived from the TPC-H-style driver tables.

The driver's data has no genomes, so tests and benches map it onto the
variant data model (one order = one site, its line items = its
annotations).  Everything is derived by Spark from the given tables, so
the work grows with them:

* ``v_main`` / ``v_info`` / ``v_csq``: the stored table shapes.
* ``vcf_lines``: each order rendered as a VCF data line, with INFO, a
  VEP CSQ field and twelve samples, for the parser.  ``VCF_HEADER`` is
  its header.

The DuckDB forms of the same views live in ``varlake.plans.oracle``.
"""

from __future__ import annotations

import struct
import zlib

import pandas as pd
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.vcf import VcfHeader, parse_header


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def chrom_of(key: str) -> str:
    return f"concat('chr', cast({key} % 22 + 1 as string))"


def v_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site table: one row per order."""
    o = load(spark, sf_dir, "orders")
    return o.select(
        F.expr(chrom_of("o_orderkey")).alias("chrom"),
        F.col("o_orderkey").cast("int").alias("pos"),
        F.array(F.concat(F.lit("rs"), F.col("o_orderkey").cast("string"))).alias("id"),
        F.col("o_orderstatus").alias("ref"),
        F.array(F.substring("o_orderpriority", 1, 1)).alias("alt"),
        F.col("o_totalprice").alias("qual"),
        F.array(F.when(F.col("o_orderstatus") == "F", "PASS").otherwise("LowQual")).alias("filter"),
    )


def v_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INFO table: orders not pending ('P') have INFO, so the site-INFO
    inner join has sites to drop."""
    o = load(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return o.select(
        F.expr(chrom_of("o_orderkey")).alias("chrom"),
        F.col("o_orderkey").cast("int").alias("pos"),
        F.array((F.col("o_custkey") % 5).cast("int")).alias("ac"),
        F.lit(10).cast("int").alias("an"),
        (F.col("o_totalprice") / F.lit(1000.0)).alias("baseqranksum"),
        (F.col("o_orderstatus") == "F").alias("db"),
        F.col("o_custkey").cast("double").alias("raw_mq"),
    )


def v_csq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation table: one row per line item, its part giving gene and
    consequence words."""
    li = load(spark, sf_dir, "lineitem")
    p = load(spark, sf_dir, "part")
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    return j.select(
        F.expr(chrom_of("l_orderkey")).alias("chrom"),
        F.col("l_orderkey").cast("int").alias("pos"),
        F.col("l_returnflag").alias("allele"),
        F.split("p_name", " ").alias("consequence"),
        F.array(
            F.concat(F.lit("rs"), F.col("l_partkey").cast("string")),
            F.concat(F.lit("COSV"), F.col("l_suppkey").cast("string")),
        ).alias("existing_variation"),
        F.when(F.col("l_quantity") < 5, F.lit(None).cast("double"))
        .otherwise(F.col("l_discount"))
        .alias("gnomad_exomes_af"),
        F.col("l_tax").alias("gnomad_genomes_af"),
        F.col("p_brand").alias("symbol"),
    )


# ------------------------------------------------------------ VCF rendering

N_SAMPLES = 12
SAMPLES = tuple(f"NA-{i:02d}" for i in range(N_SAMPLES))

# Annotation fields of the rendered CSQ, including names that exercise the
# column naming rule ('++', '(', '-', a leading digit, clashes with site
# columns).
CSQ_FIELDS = (
    "Allele",
    "Consequence",
    "IMPACT",
    "SYMBOL",
    "Existing_variation",
    "gnomAD_exomes_AF",
    "gnomAD_genomes_AF",
    "GERP++_NR",
    "hg18_pos(1-based)",
    "Eigen-PC-raw_coding",
    "1000Gp3_AC",
    "ref",
    "alt",
)

_HEADER_LINES = [
    "##fileformat=VCFv4.2",
    '##INFO=<ID=AC,Number=A,Type=Integer,Description="Allele count in genotypes">',
    '##INFO=<ID=AN,Number=1,Type=Integer,Description="Total number of alleles">',
    '##INFO=<ID=BaseQRankSum,Number=1,Type=Float,Description="Base quality rank sum">',
    '##INFO=<ID=DB,Number=0,Type=Flag,Description="dbSNP membership">',
    '##INFO=<ID=RAW_MQ,Number=1,Type=Float,Description="Raw mapping quality">',
    '##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations from Ensembl VEP. Format: '
    + "|".join(CSQ_FIELDS)
    + '">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Allelic depths">',
    '##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Read depth">',
    '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="Phred-scaled likelihoods">',
    '##FORMAT=<ID=MIN_DP,Number=1,Type=Integer,Description="Minimum depth in block">',
    '##FORMAT=<ID=PID,Number=1,Type=String,Description="Physical phasing id">',
    '##FORMAT=<ID=PGT,Number=1,Type=String,Description="Physical phasing genotype">',
    "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *SAMPLES]),
]

VCF_HEADER_LINES = tuple(_HEADER_LINES)
VCF_HEADER: VcfHeader = parse_header(VCF_HEADER_LINES)


def _csq_entry(j: str) -> str:
    """Spark SQL text of annotation entry ``j`` (a lambda variable) of an
    order."""
    parts = [
        "substr(o_orderpriority, 1, 1)",
        f"case when (o_custkey + {j}) % 2 = 0 then 'missense_variant&splice_region_variant' else 'synonymous_variant' end",
        f"case when (o_custkey + {j}) % 2 = 0 then 'MODERATE' else 'LOW' end",
        f"concat('GENE', cast((o_custkey + {j}) % 40 as string))",
        f"concat('rs', cast(o_orderkey as string), '&COSV', cast(o_custkey + {j} as string))",
        f"case (o_orderkey + {j}) % 4 when 0 then '.' when 1 then '' when 2 then "
        f"concat('0.0', lpad(cast(o_custkey % 100 as string), 2, '0')) else '1.2e-05' end",
        f"concat('0.0', lpad(cast((o_custkey + o_orderkey + {j}) % 100 as string), 2, '0'))",
        "cast(o_custkey % 7 as string)",
        "cast(o_orderkey + 1 as string)",
        "concat('-0.', cast(o_custkey % 10 as string))",
        f"cast({j} as string)",
        "o_orderstatus",
        "substr(o_orderpriority, 1, 1)",
    ]
    return "concat_ws('|', " + ", ".join(parts) + ")"


def _sample(i: str) -> str:
    """Spark SQL text of the field string of sample ``i`` (a lambda
    variable)."""
    gt = (
        f"case (o_orderkey + {i}) % 4 when 0 then '0/0' when 1 then '0/1' "
        f"when 2 then '1|1' else './.' end"
    )
    ad = (
        f"case when (o_orderkey + {i}) % 6 = 0 then '.' else concat(cast((o_orderkey + {i}) % 5 as string), ',', "
        f"cast((o_orderkey + 2 * {i}) % 3 as string)) end"
    )
    dp = f"cast((o_orderkey + {i}) % 5 as string)"
    pl = f"concat('0,', cast((o_orderkey + {i}) % 7 as string), ',', cast((o_orderkey + {i}) % 11 as string))"
    min_dp = f"case when {i} % 3 = 0 then '.' else cast((o_orderkey + 2 * {i}) % 4 as string) end"
    pid = (
        f"case when (o_orderkey + {i}) % 7 = 0 then '' when {i} % 2 = 0 "
        f"then concat('p', cast({i} as string)) else '.' end"
    )
    pgt = f"case when (o_orderkey + {i}) % 2 = 0 then '0|1' else '.' end"
    # the last sample drops trailing fields (only GT) on every fifth site;
    # pending orders carry the short FORMAT
    return (
        f"case when {i} = {N_SAMPLES - 1} and o_orderkey % 5 = 0 then {gt} "
        f"when o_orderstatus = 'P' then concat_ws(':', {gt}, {ad}, {dp}, {pl}) "
        f"else concat_ws(':', {gt}, {ad}, {dp}, {pl}, {min_dp}, {pid}, {pgt}) end"
    )


def _line() -> Column:
    """The VCF data line of an order, of the columns of ``orders`` and of
    ``sample_fields``."""
    csq = (
        "case when o_orderkey % 3 = 0 then null else array_join(transform("
        f"sequence(0, cast(o_orderkey % 3 as int) - 1), j -> {_csq_entry('j')}), ',') end"
    )
    info = (
        "concat_ws(';', "
        "concat('AC=', cast(o_custkey % 5 as string), "
        "case when o_orderstatus = 'O' then concat(',', cast(o_custkey % 3 as string)) else '' end), "
        "'AN=10', "
        "concat('BaseQRankSum=', cast(o_totalprice / 1000.0 as string)), "
        "case when o_orderstatus = 'F' then 'DB' end, "
        "concat('RAW_MQ=', cast(o_custkey as string)), "
        f"concat('CSQ=', {csq}))"
    )
    fmt = "case when o_orderstatus = 'P' then 'GT:AD:DP:PL' else 'GT:AD:DP:PL:MIN_DP:PID:PGT' end"
    cols = [
        chrom_of("o_orderkey"),
        "cast(o_orderkey + 1 as string)",
        "case o_orderstatus when 'P' then '.' when 'F' then concat('rs', cast(o_orderkey as string), ';COSV', cast(o_custkey as string)) else concat('rs', cast(o_orderkey as string)) end",
        "o_orderstatus",
        "case when o_orderstatus = 'O' then concat(substr(o_orderpriority, 1, 1), ',T') else substr(o_orderpriority, 1, 1) end",
        "case when o_orderstatus = 'P' then '.' else cast(o_totalprice as string) end",
        "case o_orderstatus when 'F' then 'PASS' when 'O' then 'LowQual;q10' else '.' end",
        info,
        fmt,
        "sample_fields",
    ]
    return F.expr("concat_ws('\\t', " + ", ".join(cols) + ")")


#: What ``_sample`` makes of an order key that is not negative comes again after
#: so many keys: it takes remainders by 2, 3, 4, 5, 6, 7 and 11 only.
SAMPLE_PERIOD = 4620


def with_sample_fields(o: DataFrame) -> DataFrame:
    """Orders with ``sample_fields``, the text of all samples.  It is built once
    per remainder and kind of FORMAT, in a small table that every task gets; of
    a key that is negative or null, for the row itself."""
    text = f"array_join(transform(sequence(0, {N_SAMPLES - 1}), i -> {_sample('i')}), '\\t')"
    kinds = o.sparkSession.range(2 * SAMPLE_PERIOD).selectExpr(f"id % {SAMPLE_PERIOD} AS o_orderkey", f"if(id < {SAMPLE_PERIOD}, 'P', '') AS o_orderstatus")
    made = kinds.selectExpr("o_orderkey AS _rest", "o_orderstatus = 'P' AS _short", f"{text} AS _fields")
    keyed = o.withColumns({"_rest": F.expr(f"o_orderkey % {SAMPLE_PERIOD}"), "_short": F.expr("o_orderstatus <=> 'P'")})
    joined = keyed.join(F.broadcast(made), ["_rest", "_short"], "left")
    return joined.withColumn("sample_fields", F.expr(f"coalesce(_fields, {text})")).drop("_rest", "_short", "_fields")


def vcf_lines(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """One VCF data line per order (of those that ``where`` selects), in a
    ``value`` column."""
    return with_sample_fields(load(spark, sf_dir, "orders").where(where)).select(_line().alias("value"))


# Positions per rendered file: files are bounded by contig and position
# block, so no task writes more than one block of one contig.
FILE_BLOCK = 1_000_000


def write_vcf_files(spark: SparkSession, sf_dir: str, path: str, compression: str | None = None, where: str = "true") -> str:
    """Write the stand-in as VCF files, one per (contig, position block):
    header lines, then data lines by position, as cohort VCFs are split.

    Each file is one sequential stream written by one task; its size is
    bounded by the block of positions it covers.
    """
    o = load(spark, sf_dir, "orders").where(where)
    place = [F.expr(chrom_of("o_orderkey")).alias("part"), F.floor((F.col("o_orderkey") + 1) / F.lit(FILE_BLOCK)).alias("block")]
    # orders travel to their files; lines are made there, by all tasks.  What has
    # no key goes where the first fields of its line say.
    fields = F.split(_line(), "\t", 3)
    keyed = F.col("o_orderkey").isNotNull()
    n = F.when(keyed, F.col("o_orderkey") + 1).otherwise(fields.getItem(1).cast("long"))
    data = o.withColumn("sample_fields", F.lit(None).cast("string")).select(
        F.when(keyed, place[0]).otherwise(fields.getItem(0)).alias("part"),
        F.floor(n / F.lit(FILE_BLOCK)).alias("block"),
        F.lit(1).alias("kind"),
        n.alias("n"),
        *o.columns,
    )
    # every (contig, block) present gets the header lines, generated per row
    lines = F.array(*[F.struct(F.lit(i).cast("long").alias("n"), F.lit(v).alias("value")) for i, v in enumerate(VCF_HEADER_LINES)])
    headers = (
        o.select(*place)
        .distinct()
        .select("part", "block", F.lit(0).alias("kind"), F.inline(lines))
    )
    rows = with_sample_fields(data.unionByName(headers, allowMissingColumns=True).repartition("part", "block"))
    value = F.when(F.col("kind") == 0, F.col("value")).otherwise(_line())
    w = (
        rows.sortWithinPartitions("part", "block", "kind", "n")
        .select("part", "block", value.alias("value"))
        .write.mode("overwrite")
        .partitionBy("part", "block")
    )
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path


def write_bgzf_files(spark: SparkSession, sf_dir: str, path: str, block: int = 60_000) -> str:
    """The stand-in as block-gzip files of many members, one per file of
    ``write_vcf_files``; each task streams its file's lines."""
    texts = write_vcf_files(spark, sf_dir, f"{path}/text")
    files = sorted(spark.read.text(texts).inputFiles())

    def member(data: bytes) -> bytes:
        """A gzip member whose extra field states the block's size."""
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(data) + c.flush()
        head = struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25)
        return head + body + struct.pack("<II", zlib.crc32(data), len(data))

    def write(batches):
        for batch in batches:
            for row in batch.itertuples():
                fs, source = pa.fs.FileSystem.from_uri(row.file)
                _, target = pa.fs.FileSystem.from_uri(row.target)
                fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
                with fs.open_input_stream(source) as i, fs.open_output_stream(target, compression=None) as o:
                    while data := i.read(block):
                        o.write(member(data))
                    o.write(member(b""))
                yield pd.DataFrame({"file": [row.target]})

    rows = spark.createDataFrame([(f, f"{path}/bgzf/{i}.vcf.gz") for i, f in enumerate(files)], "file string, target string")
    rows.repartition(len(files), "file").mapInPandas(write, "file string").write.mode("overwrite").parquet(f"{path}/written")
    return f"{path}/bgzf"
