"""Ingest: VCF files -> site, INFO, annotation and genotype tables.

The text is read once: each line is split into its site fields and its
sample fields and staged as Parquet in the shared scratch folder, together
with the header lines; the tables are built from that copy, each reading
only the column it needs.  Only header lines reach the driver.

Each input owns its rows: they are written as a batch of their own
(``sources.batches``) and count from the moment the batch is marked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import SLIM_CSQ_FIELDS
from ..operators.filters import AF_NUMBERS, as_number
from ..operators.joins import KEY, ROWS_PER_TASK, hot_sites
from ..operators.project import csq_project, info_project, main_project
from ..plans.query import TABLE_KEYS, TABLE_NAMES
from ..session import scratch_path
from ..sources.batches import Batch, checkpoint_log, mark, merged_schema, new_batch, read_batches
from ..sources.tables import BATCH_COL, PARTITION_COL, table_path, write_table
from ..sources.vcf import VcfHeader, VcfSource, open_vcf, pos_one_based


class DuplicateSiteError(ValueError):
    """Two data lines share one (chrom, pos)."""


@dataclass(frozen=True)
class IngestResult:
    root: str
    tables: dict[str, str]
    header: VcfHeader


def build_tables(src: VcfSource, profile: str = "full", samples: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The four table frames of one VCF source (lazy, nothing runs).

    Site and INFO tables come from the nested site rows (the parse is
    pruned to the fields each uses); the annotation and genotype tables
    are read straight from the exploded CSQ entries and sample fields.
    The genotype table holds one row per (site, sample) with the typed
    FORMAT fields as columns; ``samples`` keeps the named ones only.
    Allele frequencies are stored as text and, beside it, as numbers."""
    if profile not in TABLE_NAMES:
        raise ValueError(f"unknown profile {profile!r}; use 'full' or 'slim'")
    s = pos_one_based(src.sites())
    tables = {"main": main_project(s), "info": info_project(s)}
    if src.header.csq_fields:
        ann = pos_one_based(src.annotations())
        fields = src.header.csq_fields if profile == "full" else SLIM_CSQ_FIELDS
        csq = csq_project(ann, fields, keep_index=True)
        tables["csq"] = csq.withColumns({n: as_number(F.col(c)) for c, n in AF_NUMBERS.items() if c in csq.columns})
    if src.header.formats:
        # raw typed fields (zeros and all) are stored; the three maps of
        # the reference, with falsy values left out, are a read-time view
        # (``genotype_maps_view``), so the stored table stays columnar
        genotypes = src.genotypes()
        tables["genotypes"] = genotypes if samples is None else genotypes.where(F.col("sampleId").isin(list(samples)))
    return tables


def file_states(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """Path, length and modification time of each file, from the file
    listing (no file is opened)."""
    rows = spark.read.format("binaryFile").load(list(files)).select("path", "length", F.col("modificationTime").cast("double").alias("time")).collect()
    return sorted(f"{r['path']} {r['length']} {r['time']}" for r in rows)


def _digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:32]


def duplicate_sites(main: DataFrame) -> DataFrame:
    """(chrom, pos, n) for keys on more than one site row."""
    return main.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def merge_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key; of rows that differ, the largest by their text-like
    columns (any fixed choice: within one batch no row is newer)."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_r")).select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in df.columns])


def write_variations(spark: SparkSession, root: str, profile: str, source: str, identity: str, batch: str, schema: T.StructType) -> Batch:
    """(variation, chrom, pos) of a written annotation batch, sorted by
    variation so that Parquet min/max finds one.  A row hash spreads a very
    common variation over several files."""
    names = TABLE_NAMES[profile]
    kind = schema["existing_variation"].dataType.simpleString()
    csq = spark.read.schema(f"pos int, existing_variation {kind}, {PARTITION_COL} string, {BATCH_COL} string").parquet(table_path(root, names["csq"]))
    rows = csq.where(F.col(BATCH_COL) == batch).select(F.explode("existing_variation").alias("variation"), *KEY).where("variation is not null").distinct()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "variation", F.xxhash64(*KEY)).sortWithinPartitions("variation", *KEY)
    dealt.withColumn(BATCH_COL, F.lit(batch)).write.mode("append").partitionBy(BATCH_COL).parquet(table_path(root, names["variations"]))
    return Batch(names["variations"], source, identity, batch, rows.schema, 0, (), {})


def write_batch(
    spark: SparkSession,
    root: str,
    profile: str,
    t: str,
    frames: Iterable[DataFrame],
    source: str,
    identity: str,
    batch: str,
    samples: tuple[str, ...] = (),
    replaces: tuple[str, ...] = (),
) -> None:
    """Write the rows of table ``t``, in one or more frames, as a batch and mark
    it, with the tables that are derived from annotations."""
    names = TABLE_NAMES[profile]
    for df in frames:
        bloom = ("symbol",) if t == "csq" and "symbol" in df.columns else ()
        write_table(df.withColumn(BATCH_COL, F.lit(batch)), root, names[t], partition_by=(PARTITION_COL, BATCH_COL), bloom_columns=bloom)
    written = spark.read.schema(f"pos int, {PARTITION_COL} string, {BATCH_COL} string").parquet(table_path(root, names[t])).where(F.col(BATCH_COL) == batch)

    def measure() -> dict[str, tuple[int, int, int]]:
        """Per contig: first and last position, rows.  One job; sites that are hot
        are looked up only where a contig has any."""
        extent = F.min("pos").alias("low"), F.max("pos").alias("high")
        if t != "csq":
            found = written.groupBy(PARTITION_COL).agg(*extent, F.count(F.lit(1)).alias("n")).collect()
        else:
            sites = written.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
            found = sites.groupBy(PARTITION_COL).agg(*extent, F.sum("n").alias("n"), F.count_if(F.col("n") > ROWS_PER_TASK).alias("hot")).collect()
            hot, n_hot = hot_sites(written), sum(r["hot"] for r in found)
            if n_hot:
                write_table(hot.withColumn(BATCH_COL, F.lit(batch)), root, names["hot"], partition_by=(PARTITION_COL, BATCH_COL))
            mark(spark, root, Batch(names["hot"], source, identity, batch, hot.schema, n_hot, (), {}, replaces))
        return {r[PARTITION_COL]: (r["low"], r["high"], r["n"]) for r in found}

    if t == "csq" and "existing_variation" in df.columns:
        with ThreadPoolExecutor(max_workers=1) as pool:  # the two jobs read the written table side by side
            measuring = pool.submit(measure)
            mark(spark, root, replace(write_variations(spark, root, profile, source, identity, batch, df.schema), replaces=replaces))
            covered = measuring.result()
    else:
        covered = measure()
    contigs = {c: (low, high) for c, (low, high, _) in covered.items()}
    mark(spark, root, Batch(names[t], source, identity, batch, df.schema, sum(n for _, _, n in covered.values()), samples, contigs, replaces))


def store_tables(
    spark: SparkSession,
    frames: dict[str, DataFrame],
    root: str,
    profile: str,
    source: str,
    identity: str,
    samples: Sequence[str],
    *,
    on_duplicate: str = "error",
    parallel: bool = True,
) -> dict[str, str]:
    """Write the frames as one batch of the input ``source`` in the state
    ``identity``; tables that are stored in that state already are skipped.
    Batch and stream ingest both come through here."""
    names = TABLE_NAMES[profile]
    stored = read_batches(spark, root)
    done = {b.table for b in read_batches(spark, root, replaced=True) if b.input == source and b.identity == identity}
    order = [t for t in ("genotypes", "csq", "info", "main") if t in frames]
    pending = [t for t in order if names[t] not in done]
    for t in pending:  # a type that changed fails before anything is written
        own = Batch(names[t], source, identity, "", frames[t].schema, 0, (), {})
        merged_schema([*(b for b in stored if b.table == names[t] and b.input != source), own])
    if on_duplicate == "error" and "main" in pending:
        dup = duplicate_sites(frames["main"].select(*KEY)).limit(5).collect()
        if dup:
            raise DuplicateSiteError(
                f"sites on more than one line, e.g. {[tuple(r) for r in dup]}; "
                "pass on_duplicate='keep' to store them, or 'merge' to store one of each"
            )
    batch = new_batch()

    def write(t: str) -> None:
        df = merge_rows(frames[t], TABLE_KEYS[t]) if on_duplicate == "merge" else frames[t]
        write_batch(spark, root, profile, t, [df], source, identity, batch, tuple(samples) if t == "genotypes" else ())

    if parallel and len(pending) > 1:
        # independent jobs submitted together keep every core busy while
        # another job's last tasks finish
        with ThreadPoolExecutor(max_workers=len(pending)) as pool:
            list(pool.map(write, pending))
    else:
        for t in pending:
            write(t)
    if pending:
        checkpoint_log(spark, root)
    return {t: table_path(root, names[t]) for t in order}


def ingest(
    spark: SparkSession,
    path: str | list[str],
    root: str,
    *,
    profile: str = "full",
    samples: Sequence[str] | None = None,
    on_duplicate: str = "error",
    min_partitions: int | None = None,
    parallel: bool = True,
    same_header: bool = False,
    stage: bool = True,
    on_bad_line: str = "fail",
) -> IngestResult:
    """Read VCF ``path`` and store its tables under ``root``.

    The input is the set of files: ingesting it again in the same state
    (paths, lengths, modification times) stores nothing, after a failure it
    completes the missing tables, and in a changed state it replaces its
    earlier rows (after ``plans.compact`` has merged them with others', its new
    rows are merged over them).  Sites that several inputs have are merged by
    key when they are read: the newest decides.
    ``samples``: store the genotypes of these samples only (default all).
    ``on_duplicate``: 'error' fails when a (chrom, pos) appears on more
    than one line of this input (a split site would multiply annotation
    join rows), before anything is written; 'merge' stores one row per
    key; 'keep' stores the rows as they are; they stay where no other batch
    covers their position.  ``parallel`` submits the four table writes as
    concurrent jobs.  ``same_header``: see ``open_vcf``.  ``stage=False``
    builds each table from the text itself, which reads it once per table.
    ``on_bad_line``: 'fail' ends the ingest at a line with too few fields or no
    position; 'drop' stores such lines with their file and the reason under
    ``<root>/bad_lines`` instead; 'keep' parses them as they are.
    """
    if on_duplicate not in ("error", "keep", "merge"):
        raise ValueError("on_duplicate must be 'error', 'keep' or 'merge'")
    if profile not in TABLE_NAMES:
        raise ValueError(f"unknown profile {profile!r}; use 'full' or 'slim'")
    src = open_vcf(spark, path, min_partitions=min_partitions, same_header=same_header, on_bad_line=on_bad_line)
    state = file_states(spark, src.files)
    kept = [profile, *(f"sample {s}" for s in samples or ())]
    source = _digest([*kept, *(x.rsplit(" ", 2)[0] for x in state)])
    identity = _digest([*kept, *state])
    names = TABLE_NAMES[profile]
    done = {b.table for b in read_batches(spark, root, replaced=True) if b.input == source and b.identity == identity}
    tables = ["genotypes"] * bool(src.header.formats) + ["csq"] * bool(src.header.csq_fields) + ["info", "main"]
    if all(names[t] in done for t in tables):
        return IngestResult(root, {t: table_path(root, names[t]) for t in tables}, src.header)
    if src.bad_lines is not None:
        # a rerun in the same state overwrites its own
        src.bad_lines.write.mode("overwrite").parquet(f"{root.rstrip('/')}/bad_lines/identity={identity}")
    if stage:
        src = src.stage(scratch_path(spark, "vcf-stage"))
    own = [s for s in src.sample_ids if samples is None or s in set(samples)]
    written = store_tables(
        spark, build_tables(src, profile, samples), root, profile, source, identity, own, on_duplicate=on_duplicate, parallel=parallel
    )
    return IngestResult(root, written, src.header)
