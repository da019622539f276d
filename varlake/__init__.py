"""varlake: annotated genomic variants on Spark DataFrames.

VEP-annotated multi-sample VCF text is parsed with column expressions
into site, INFO, annotation and genotype tables (Parquet, partitioned by
chromosome), which the variant queries A..F filter and join on
(chrom, pos).
"""

__version__ = "0.1.0"
