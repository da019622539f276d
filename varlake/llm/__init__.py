"""Training-data operators: tokens, packing, search, near-duplicates,
web text and quality.  Nothing outside this folder imports it, apart from
the guarded hook in ``__spark_entry__`` and ``corpus_pipeline``."""
