"""Per-sample genotype maps, in long and wide form.

For each sample of a site three maps are built:

* ``int``  : ``min_dp`` and ``depth``
* ``text`` : ``pid`` and ``pgt``
* ``list`` : ``allele_depth``, ``calls`` and ``plh``

Falsy values (null, 0, '' and empty lists) are left out; a sample with
nothing left has three empty maps, not null.  The maps are column
expressions over the nested ``genotypes`` array, so they are computed on
executors in the scan stage.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import normalize_samples, sample_column_expr
from ..sources.vcf import exploded

# Map key -> genotype struct field, per map kind.
INT_KEYS = {"min_dp": "MIN_DP", "depth": "depth"}
TEXT_KEYS = {"pid": "PID", "pgt": "PGT"}
LIST_KEYS = {"allele_depth": "alleleDepths", "calls": "calls", "plh": "phredLikelihoods"}

_KINDS = (
    ("int", INT_KEYS, T.IntegerType()),
    ("text", TEXT_KEYS, T.StringType()),
    ("list_int", LIST_KEYS, T.ArrayType(T.IntegerType())),
)


def _struct_fields(genotypes_type: T.DataType) -> set[str]:
    if isinstance(genotypes_type, T.ArrayType) and isinstance(genotypes_type.elementType, T.StructType):
        return set(genotypes_type.elementType.fieldNames())
    raise TypeError(f"genotypes must be array<struct>, got {genotypes_type}")


def _truthy(v: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        return v.isNotNull() & (F.size(v) > 0)
    if isinstance(dtype, T.StringType):
        return v.isNotNull() & (v != "")
    return v.isNotNull() & (v != 0)


def _kind_map(g: Column, keys: dict[str, str], dtype: T.DataType, present: set[str]) -> Column:
    """One map kind: a concat of single-entry maps, each present only when
    its value is truthy (plain expressions, so it stays in generated
    code; a map_filter lambda would be interpreted per entry)."""
    mtype = T.MapType(T.StringType(), dtype)
    empty = F.create_map().cast(mtype)
    parts: list[Column] = []
    for key, fld in keys.items():
        if fld in present:
            v = g.getField(fld).cast(dtype)
            parts.append(F.when(_truthy(v, dtype), F.create_map(F.lit(key), v)).otherwise(empty))
    if not parts:
        return empty
    return (parts[0] if len(parts) == 1 else F.map_concat(*parts)).cast(mtype)


def genotype_maps(g: Column, present: set[str]) -> list[Column]:
    """The three maps of one genotype struct ``g`` (``present`` = the
    struct's field names), unaliased, in the order int, text, list."""
    return [_kind_map(g, keys, dtype, present) for _, keys, dtype in _KINDS]


def sample_slice(df: DataFrame, start: int, end: int, col: str = "genotypes") -> DataFrame:
    """Keep samples ``[start:end)`` of each site's genotype array."""
    if start < 0 or end < start:
        raise ValueError(f"bad sample slice [{start}:{end})")
    return df.withColumn(col, F.slice(col, start + 1, end - start))


def genotypes_long(scanned: DataFrame, key: Sequence[str] = ("contigName", "start"), names: Sequence[str] = ("chrom", "pos")) -> DataFrame:
    """One row per (site, sample): chrom, pos, sample_index, sample, and
    the maps ``int``, ``text``, ``list_int``."""
    present = _struct_fields(scanned.schema["genotypes"].dataType)
    # positions are int in every stored table
    site = [(F.col(k).cast("int") if n == "pos" else F.col(k)).alias(n) for k, n in zip(key, names)]
    ex = exploded(scanned, site, F.col("genotypes"), "sample_index", "_g")
    g = F.col("_g")
    maps = genotype_maps(g, present)
    sample = sample_column_expr(g.getField("sampleId")) if "sampleId" in present else F.lit(None).cast("string")
    return ex.select(
        *names,
        "sample_index",
        sample.alias("sample"),
        *[m.alias(kind) for m, (kind, _, _) in zip(maps, _KINDS)],
    )


def genotypes_long_flat(fields: DataFrame, keep: Sequence[str] = ("chrom", "pos", "sample_index")) -> DataFrame:
    """Long maps from one row per (site, sample) with the genotype fields
    as columns (see ``parse_genotypes_long``): ``keep`` columns, sample,
    and the maps ``int``, ``text``, ``list_int``."""
    present = {c for c in fields.columns if c not in keep}
    g = F.struct(*[F.col(c) for c in sorted(present)])
    maps = genotype_maps(g, present)
    sample = sample_column_expr(F.col("sampleId")) if "sampleId" in present else F.lit(None).cast("string")
    return fields.select(
        *keep,
        sample.alias("sample"),
        *[m.alias(kind) for m, (kind, _, _) in zip(maps, _KINDS)],
    )


def genotype_maps_view(stored: DataFrame) -> DataFrame:
    """The three maps per (site, sample) over a stored genotype table
    (typed FORMAT fields as columns, as ``ingest`` writes it)."""
    return genotypes_long_flat(stored, keep=("chrom", "pos", "sample_index"))


def stored_wide(stored: DataFrame, samples: Sequence[str], key: Sequence[str] = ("chrom", "pos")) -> DataFrame:
    """Wide map columns ``s<name>_int``, ``s<name>_text``,
    ``s<name>_list_int`` for named samples, from a stored genotype table.

    The rows of those samples become one array per site in the order of
    ``samples``, and each column reads its place in it, so a plan for
    thousands of samples has two aggregates, not one per column.  A site
    without a row for a sample gets empty maps, as a sample with no data
    does; of several rows for one sample the smallest counts."""
    samples = list(samples)
    names = [n.replace("`", "``") for n in normalize_samples(samples)]
    spark = stored.sparkSession
    # an Arrow table stays a local relation, whose size the planner knows
    slots = spark.createDataFrame(pa.table({"sampleId": pa.array(samples, pa.string()), "_slot": pa.array(range(len(samples)), pa.int32())}))
    fields = [c for c in stored.columns if c not in (*key, "sample_index")]
    g = F.struct(*[F.col(c) for c in fields])
    # named, they reach the scan below any join that cuts the sites, so no other sample's rows are shuffled for it
    rows = stored.where(F.col("sampleId").isin(samples)).join(slots, "sampleId").select(*key, "_slot", g.alias("_g"))
    # both groupings use the one exchange by site
    rows = rows.repartition(*key).groupBy(*key, "_slot").agg(F.min("_g").alias("_g"))
    empty = F.lit(None).cast(rows.schema["_g"].dataType)
    sites = rows.groupBy(*key).agg(F.collect_list(F.struct("_slot", "_g")).alias("_have"))
    missing = F.array_except(F.sequence(F.lit(0), F.lit(len(samples) - 1)), F.transform("_have", lambda x: x["_slot"]))
    sites = sites.select(*key, F.array_sort(F.concat("_have", F.transform(missing, lambda i: F.struct(i.alias("_slot"), empty.alias("_g"))))).alias("_all"))

    def maps(x: Column) -> Column:
        kinds = zip(genotype_maps(x["_g"], set(fields)), _KINDS)
        return F.struct(*[F.coalesce(m, F.create_map().cast(_map_type(kind))).alias(kind) for m, (kind, _, _) in kinds])

    sites = sites.select(*key, F.transform("_all", maps).alias("_site"))
    return sites.selectExpr(*key, *[f"_site[{i}].`{kind}` AS `{n}_{kind}`" for i, n in enumerate(names) for kind, _, _ in _KINDS])


def genotypes_wide(
    scanned: DataFrame,
    samples: Sequence[str],
    order: Sequence[str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Wide columns ``s<name>_int``, ``s<name>_text``, ``s<name>_list_int``
    for the named samples; ``order`` is the header's sample order, giving
    each sample's index in the genotype array (no search per row).
    """
    normalize_samples(order)  # raise on colliding names before building columns
    present = _struct_fields(scanned.schema["genotypes"].dataType)
    index = {s: i for i, s in enumerate(order)}
    cols: list[Column] = [F.col(k) for k in keep]
    for s in samples:
        if s not in index:
            raise KeyError(f"sample {s!r} not in the header")
        g = F.get(F.col("genotypes"), index[s])
        base = normalize_samples([s])[0]
        for m, (kind, _, _) in zip(genotype_maps(g, present), _KINDS):
            # a site whose array lacks this sample gets empty maps, as a
            # sample with no data does
            cols.append(F.coalesce(m, F.create_map().cast(_map_type(kind))).alias(f"{base}_{kind}"))
    return scanned.select(*cols)


def _map_type(kind: str) -> T.MapType:
    for k, _, dtype in _KINDS:
        if k == kind:
            return T.MapType(T.StringType(), dtype)
    raise KeyError(kind)


def map_text(c: Column) -> Column:
    """Map -> 'k=v;k=v' with keys sorted and list values joined by ','
    (for comparing maps across engines)."""
    entries = F.sort_array(F.map_entries(c))

    def render(e: Column) -> Column:
        v = e["value"]
        return F.concat(e["key"], F.lit("="), v.cast("string"))

    # named twice, the map is built by generated code in a projection of its own
    return F.when(F.size(c) == 0, F.lit("")).otherwise(F.array_join(F.transform(entries, render), ";"))


def list_map_text(c: Column) -> Column:
    entries = F.sort_array(F.map_entries(c))
    text = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"].cast("array<string>"), ",")))
    return F.when(F.size(c) == 0, F.lit("")).otherwise(F.array_join(text, ";"))
