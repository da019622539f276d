"""Compaction: batches that cover the same positions become one.

Reads merge overlapping batches by key each time; a compaction does so once
and stores the result as a batch that replaces them.  Batches that overlap no
other are left as they are.  The replaced files stay; their markers still say
which inputs are stored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

from ..sources.batches import checkpoint_log, merged_pieces, new_batch, read_batches, shared_ranges, sharing
from .ingest import write_batch
from .query import TABLE_KEYS, TABLE_NAMES


def compact(spark: SparkSession, root: str, profile: str = "full") -> dict[str, int]:
    """Write the overlapping batches of each table of the store anew; returns
    how many of each were replaced.

    A table counts from its marker on: a run that dies leaves the tables it
    has not marked as they were, and a rerun goes on with them.  Nothing
    overlaps afterwards, so a second run does nothing.  Rows are the same
    before and after.  One writer per store at a time, as for ``ingest``."""
    if profile not in TABLE_NAMES:
        raise ValueError(f"unknown profile {profile!r}")
    batches = read_batches(spark, root)
    replaced = {}
    for t in ("genotypes", "csq", "info", "main"):
        own = [b for b in batches if b.table == TABLE_NAMES[profile][t]]
        old = sharing(own, shared_ranges(own))
        if not old:
            continue
        names = tuple(b.batch for b in old)
        samples = tuple(dict.fromkeys(s for b in old for s in b.samples))
        source = "compact " + hashlib.sha256("\n".join(names).encode()).hexdigest()[:32]
        write_batch(spark, root, profile, t, merged_pieces(spark, root, old, TABLE_KEYS[t]), source, source, new_batch(), samples, names)
        replaced[t] = len(old)
    if replaced:
        checkpoint_log(spark, root)
    return replaced
