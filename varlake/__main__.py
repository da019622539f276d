"""Command line: ``python -m varlake ingest|query ...`` (or via spark-submit).

    python -m varlake ingest cohort.vcf.gz /data/store [--profile slim]
    python -m varlake query /data/store C --chrom chr7 --pos-start 100 --pos-end 2000
    python -m varlake query /data/store F --symbol BRCA1 --consequence missense_variant --samples all

``query`` shows the first rows of the answer (20 by default), as a
DataFrame ``show``; ``--out`` writes the whole answer as Parquet instead.
The session comes from ``SparkSession.builder.getOrCreate()``, so master
and resources are whatever spark-submit or the environment configure.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .operators.filters import QUERY_KINDS
from .plans.ingest import ingest
from .plans.query import query_variants

# Parameter name -> type, for the query kinds' arguments.
_PARAM_TYPES = {
    "chrom": str,
    "pos": int,
    "pos_start": int,
    "pos_end": int,
    "existing_variation": str,
    "gnomad_exomes_af": float,
    "gnomad_genomes_af": float,
    "symbol": str,
    "consequence": str,
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m varlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("ingest", help="VCF files -> site, INFO, annotation, genotype tables")
    i.add_argument("path", nargs="+")
    i.add_argument("root")
    i.add_argument("--profile", choices=["full", "slim"], default="full")
    i.add_argument("--keep-duplicates", action="store_true")
    i.add_argument("--same-header", action="store_true")
    i.add_argument("--min-partitions", type=int, help="spread the text over at least so many tasks")
    i.add_argument("--store-samples", help="comma-separated sample ids whose genotypes are stored; default all")
    q = sub.add_parser("query", help="variant query A..F over stored tables")
    q.add_argument("root")
    q.add_argument("kind", choices=sorted(QUERY_KINDS))
    for name, typ in _PARAM_TYPES.items():
        q.add_argument("--" + name.replace("_", "-"), dest=name, type=typ)
    q.add_argument("--profile", choices=["full", "slim"], default="full")
    q.add_argument("--samples", help="comma-separated sample ids, or 'all'")
    q.add_argument("--rows", type=int, default=20)
    q.add_argument("--out", help="write the whole answer here as Parquet")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("varlake").getOrCreate()
    if args.cmd == "ingest":
        paths = args.path[0] if len(args.path) == 1 else args.path
        res = ingest(
            spark, paths, args.root, profile=args.profile,
            on_duplicate="keep" if args.keep_duplicates else "error", same_header=args.same_header,
            min_partitions=args.min_partitions, samples=args.store_samples.split(",") if args.store_samples else None,
        )
        for table, path in res.tables.items():
            print(f"{table}\t{path}")
        return 0
    params = {k: getattr(args, k) for k in _PARAM_TYPES if getattr(args, k) is not None}
    samples = None
    if args.samples:
        samples = "all" if args.samples == "all" else args.samples.split(",")
    df = query_variants(spark, args.root, args.kind, profile=args.profile, samples=samples, **params)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.rows, truncate=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
