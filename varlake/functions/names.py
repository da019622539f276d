"""Naming rules for stored columns.

Sample names become column-safe identifiers, and VEP annotation field
names from the CSQ header become lower-case table column names.  Both
rules are plain functions so they can be applied to a header of any
width instead of a hand-written list of fields.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six annotation fields kept by the slim (demo) profile,
# in the order the slim csq table lists them after chrom and pos.
SLIM_CSQ_FIELDS = (
    "Allele",
    "Consequence",
    "Existing_variation",
    "gnomAD_exomes_AF",
    "gnomAD_genomes_AF",
    "SYMBOL",
)

# Annotation fields that hold '&'-separated lists and are
# therefore stored as arrays; every other annotation field stays text.
CSQ_LIST_FIELDS = ("Consequence", "Existing_variation")

# Stored names of the site (main) and INFO tables.
MAIN_COLUMNS = ("chrom", "pos", "id", "ref", "alt", "qual", "filter")
INFO_COLUMNS = ("chrom", "pos", "ac", "an", "baseqranksum", "db", "raw_mq")


class NameCollisionError(ValueError):
    """Two different source names map to one stored name."""


def sample_column_name(sample: str) -> str:
    """``NA-12878`` -> ``sna_12878``: '-' to '_', lower case, prefix 's'."""
    return "s" + sample.replace("-", "_").lower()


def sample_column_expr(sample: Column) -> Column:
    """Column form of :func:`sample_column_name`, evaluated on executors."""
    # of ASCII alone, as nearly all ids are, one pass does both
    ascii_only = F.octet_length(sample) == F.char_length(sample)
    plain = F.translate(sample, ascii_uppercase + "-", ascii_lowercase + "_")
    return F.concat(F.lit("s"), F.when(ascii_only, plain).otherwise(F.lower(F.regexp_replace(sample, "-", "_"))))


def normalize_samples(samples: Sequence[str]) -> list[str]:
    """Normalise an ordered sample list; raise when two names collide."""
    out: list[str] = []
    seen: dict[str, str] = {}
    for s in samples:
        n = sample_column_name(s)
        if n in seen:
            raise NameCollisionError(
                f"samples {seen[n]!r} and {s!r} both normalise to {n!r}"
            )
        seen[n] = s
        out.append(n)
    return out


_DIGIT_START = re.compile(r"^[0-9]")


def csq_column_name(field: str, reserved: Iterable[str] = ()) -> str:
    """Stored column name of one VEP annotation field.

    lower case; '++' -> 'plusplus'; '-' and '(' -> '_'; ')' dropped;
    a name starting with a digit, or one that would clash with a column
    of the site or INFO tables (``reserved``), gets the prefix ``csq_``.
    """
    name = field.lower().replace("++", "plusplus").replace("-", "_")
    name = name.replace("(", "_").replace(")", "")
    if _DIGIT_START.match(name) or name in set(reserved):
        name = "csq_" + name
    return name


def csq_column_names(
    fields: Sequence[str], reserved: Iterable[str] = ()
) -> list[str]:
    """Apply :func:`csq_column_name` to a header's field list, checking
    that no two fields end up with one name."""
    reserved = set(reserved)
    out: list[str] = []
    seen: dict[str, str] = {}
    for f in fields:
        n = csq_column_name(f, reserved)
        if n in seen:
            raise NameCollisionError(
                f"CSQ fields {seen[n]!r} and {f!r} both map to {n!r}"
            )
        seen[n] = f
        out.append(n)
    return out


def csq_reserved_names() -> set[str]:
    """Names a csq column may not take: the join key is kept, the other
    site and INFO columns would clash after the annotation join."""
    return (set(MAIN_COLUMNS) | set(INFO_COLUMNS)) - {"chrom", "pos"}
