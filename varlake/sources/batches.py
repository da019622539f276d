"""Batches: what each ingest stored, and how reads bring batches together.

Every ingest of an input writes its rows of a table under a ``batch`` folder of
its own and then a marker (``<root>/_ingested``) with what a reader needs: the
schema, the positions covered per contig, row counts and sample ids.  A batch
without a marker is never read, so a run that dies half-way leaves nothing
behind; a newer batch of the same input takes the place of the older one.

Where batches of different inputs cover the same positions, rows with one key
are merged as a key-upserting store would have them: the newest batch decides
the columns that it has, and older ones the rest.  A sweep over the intervals
that the batches cover finds those positions; only they are merged, and all other
rows are plain scans, whatever contig or batch they are in.
``plans.compact`` writes merged batches anew, as one that replaces them.

Markers are folded into a checkpoint of the log from time to time: a Parquet
table of all markers so far and one of their distinct schemas.  Markers after it
go to a folder of their own, so a reader opens the newest checkpoint and the few
markers that follow, however many batches there are.  A checkpoint counts from
the note that is written last; nothing is deleted.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.store import SchemaConflictError
from .tables import BATCH_COL, PARTITION_COL, table_path

# Folder under the store root with one marker per (input, table, batch); after
# the n-th checkpoint of the log, ``_ingested-n``.
INGEST_LOG = "_ingested"
CHECKPOINTS = "_ingested_checkpoints"

_MARKER = (
    "table string, input string, identity string, batch string, schema string, rows long, "
    "samples array<string>, contigs array<struct<chrom: string, low: long, high: long>>, replaces array<string>"
)

#: Markers after which the log gets a checkpoint.
CHECKPOINT_EVERY = 300

#: Markers in one file of a checkpoint.
MARKERS_PER_FILE = 100_000

#: Batches that a plan names, at most; beyond that rows are joined to them.
MAX_NAMED = 64

#: Batches whose names are broadcast, at most (under 100 bytes each).
MAX_BROADCAST = 200_000

# Columns that identify rows; their types never change.
_KEYS = {PARTITION_COL, "pos", "csq_no", "sampleId", "variation"}

#: Position ranges that a plan names, at most; closer ones are joined beyond that.
MAX_RANGES = 64


@dataclass(frozen=True)
class Batch:
    table: str
    input: str  # which files (and profile) it came from
    identity: str  # those files' state
    batch: str  # its folder; sorts by time
    schema: T.StructType
    rows: int
    samples: tuple[str, ...]
    contigs: dict[str, tuple[int, int]]  # positions covered
    replaces: tuple[str, ...] = ()  # batches whose rows this one has


def new_batch() -> str:
    """A folder name that sorts after all earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _read(reader: Callable[[], DataFrame]) -> DataFrame | None:
    """What the reader gives, or None where there is no such path."""
    try:
        return reader()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _epoch(spark: SparkSession, root: str) -> int:
    """The number of the newest checkpoint that counts; 0 without one."""
    notes = _read(lambda: spark.read.schema("epoch long").json(f"{root.rstrip('/')}/{CHECKPOINTS}/*/valid"))
    return notes.agg(F.max("epoch")).first()[0] if notes is not None else 0


def _log_folder(root: str, epoch: int) -> str:
    return f"{root.rstrip('/')}/{INGEST_LOG}" + (f"-{epoch}" if epoch else "")


def _fresh(spark: SparkSession, root: str, epoch: int) -> DataFrame | None:
    """The markers since a checkpoint."""
    return _read(lambda: spark.read.schema(_MARKER).json(f"{_log_folder(root, epoch)}/*"))


def _folded(spark: SparkSession, root: str, epoch: int) -> tuple[DataFrame, DataFrame]:
    """A checkpoint: markers with a schema's digest, and schemas by digest."""
    at = f"{root.rstrip('/')}/{CHECKPOINTS}/{epoch:08d}"
    return spark.read.parquet(f"{at}/markers"), spark.read.parquet(f"{at}/schemas")


def _split(fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Markers in the form that a checkpoint holds."""
    digest = F.md5(F.col("schema").cast("binary")).alias("schema_id")
    return fresh.select("*", digest).drop("schema"), fresh.select(digest, "schema")


def checkpoint_log(spark: SparkSession, root: str, at_least: int | None = None) -> bool:
    """Fold the log into a new checkpoint if ``at_least`` markers
    (``CHECKPOINT_EVERY``) came since the last; says whether it did.  A run that
    dies half-way changes nothing, and the next writes the same checkpoint
    anew.  One writer per store at a time, as for ``ingest``."""
    epoch = _epoch(spark, root)
    fresh = _fresh(spark, root, epoch)
    if fresh is None or len(fresh.inputFiles()) < (CHECKPOINT_EVERY if at_least is None else at_least):
        return False
    markers, schemas = _split(fresh)
    if epoch:
        before = _folded(spark, root, epoch)
        markers, schemas = before[0].unionByName(markers), before[1].unionByName(schemas)
    at = f"{root.rstrip('/')}/{CHECKPOINTS}/{epoch + 1:08d}"
    schemas.dropDuplicates(["schema_id"]).write.mode("overwrite").parquet(f"{at}/schemas")
    markers.coalesce(1 + markers.count() // MARKERS_PER_FILE).write.mode("overwrite").parquet(f"{at}/markers")
    spark.range(0, 1, 1, 1).select(F.lit(json.dumps({"epoch": epoch + 1})).alias("value")).write.mode("overwrite").text(f"{at}/valid")
    return True


def read_batches(spark: SparkSession, root: str, *, replaced: bool = False) -> list[Batch]:
    """The batches that count, oldest first: of each table and input the
    newest, without those that a compaction has replaced (``replaced``: with
    them).  The newest checkpoint of the log and the markers after it are read;
    each distinct schema reaches the driver once from a checkpoint."""
    epoch = _epoch(spark, root)
    rows, types = [], {}
    if epoch:
        markers, schemas = _folded(spark, root, epoch)
        rows += markers.collect()
        types |= {r["schema_id"]: r["schema"] for r in schemas.collect()}
    fresh = _fresh(spark, root, epoch)
    if fresh is not None:  # few, so each brings its schema
        for r in fresh.withColumn("schema_id", F.md5(F.col("schema").cast("binary"))).collect():
            rows.append(r)
            types[r["schema_id"]] = r["schema"]
    parsed = {i: T.StructType.fromJson(json.loads(text)) for i, text in types.items()}
    newest: dict[tuple[str, str], Batch] = {}
    gone: set[tuple[str, str]] = set()
    for r in sorted(rows, key=lambda r: r["batch"]):
        contigs = {c["chrom"]: (c["low"], c["high"]) for c in r["contigs"]}
        newest[r["table"], r["input"]] = Batch(
            r["table"], r["input"], r["identity"], r["batch"], parsed[r["schema_id"]], r["rows"], tuple(r["samples"] or ()), contigs, tuple(r["replaces"] or ())
        )
        gone.update((r["table"], b) for b in r["replaces"] or ())
    return sorted((b for b in newest.values() if replaced or (b.table, b.batch) not in gone), key=lambda b: b.batch)


def mark(spark: SparkSession, root: str, b: Batch) -> None:
    """Make a written batch count."""
    row = {
        "table": b.table, "input": b.input, "identity": b.identity, "batch": b.batch, "schema": b.schema.json(), "rows": b.rows, "samples": list(b.samples),
        "contigs": [{"chrom": c, "low": low, "high": high} for c, (low, high) in b.contigs.items()], "replaces": list(b.replaces),
    }
    path = f"{_log_folder(root, _epoch(spark, root))}/{b.batch}-{b.table}"
    # a literal, not local rows: no Python worker is involved
    spark.range(0, 1, 1, 1).select(F.lit(json.dumps(row)).alias("value")).write.mode("overwrite").text(path)


def in_batches(df: DataFrame, batches: Sequence[Batch], kinds: Mapping[str, int] | None = None) -> DataFrame:
    """The rows of the batches.  Few are named in the plan; more are joined, so
    that the plan does not grow with them.  ``kinds`` (by batch): added to
    the rows as ``_kind``."""
    if len(batches) <= MAX_NAMED:
        df = df.where(F.col(BATCH_COL).isin([b.batch for b in batches]))
        if kinds is None:
            return df
        kind = F.lit(None).cast("int")
        for k in sorted(set(kinds.values())):
            kind = F.when(F.col(BATCH_COL).isin([b.batch for b in batches if kinds[b.batch] == k]), k).otherwise(kind)
        return df.withColumn("_kind", kind)
    first = min(b.batch for b in batches)
    members = df.sparkSession.createDataFrame([(b.batch, kinds[b.batch] if kinds else 0) for b in batches], f"{BATCH_COL} string, _kind int")
    # the comparison marks the side as a filter, so that folders of other batches are pruned
    members = members.where(F.col(BATCH_COL) >= first)
    if len(batches) <= MAX_BROADCAST:
        members = F.broadcast(members)
    df = df.join(members, BATCH_COL)
    return df if kinds else df.drop("_kind")


# Numbers that another type holds without loss.
_HOLDS = {("int", "bigint"): "bigint", ("int", "double"): "double", ("float", "double"): "double"}


def widest(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds all values of both without loss, None if neither
    can: integers go to longs or doubles, a single value to a list."""
    if a.simpleString() == b.simpleString():
        return a
    if isinstance(a, T.ArrayType) or isinstance(b, T.ArrayType):
        inner = widest(*(t.elementType if isinstance(t, T.ArrayType) else t for t in (a, b)))
        return inner and T.ArrayType(inner)
    names = a.simpleString(), b.simpleString()
    wide = _HOLDS.get(names) or _HOLDS.get(names[::-1])
    return T.DataType.fromDDL(wide) if wide else None


def widened(name: str, have: T.DataType, want: T.DataType) -> Column:
    """The column in a type that ``widest`` gave; null stays null."""
    c = F.col(name)
    if have.simpleString() == want.simpleString():
        return c
    if isinstance(want, T.ArrayType) and not isinstance(have, T.ArrayType):
        return F.when(c.isNotNull(), F.array(c.cast(want.elementType))).alias(name)
    return c.cast(want).alias(name)


def merged_schema(batches: Sequence[Batch]) -> T.StructType:
    """All columns of the batches.  One name with two types takes the one that
    holds both without loss, whichever came first; where neither does, and for
    key columns, it is an error."""
    fields: dict[str, T.StructField] = {}
    for schema, table in {id(b.schema): (b.schema, b.table) for b in batches}.values():
        for f in schema.fields:
            have = fields.setdefault(f.name, T.StructField(f.name, f.dataType))
            wide = widest(have.dataType, f.dataType)
            if wide is None or (f.name in _KEYS and wide is not have.dataType):
                raise SchemaConflictError(
                    f"table {table}: column {f.name!r} is {have.dataType.simpleString()} in the store and {f.dataType.simpleString()} in a batch"
                )
            fields[f.name] = T.StructField(f.name, wide)
    return T.StructType(list(fields.values()))


def shared_ranges(batches: Sequence[Batch]) -> dict[str, list[tuple[int, int]]]:
    """Per contig the position ranges that more than one batch covers, by a sweep
    over the ends of the batches' intervals."""
    ends: dict[str, list[tuple[int, int]]] = {}
    for b in batches:
        for chrom, (low, high) in b.contigs.items():
            if low is not None:
                ends.setdefault(chrom, []).extend([(low, 1), (high + 1, -1)])
    found: dict[str, list[tuple[int, int]]] = {}
    for chrom, own in ends.items():
        depth, start = 0, 0
        for pos, step in sorted(own):  # an interval that ends here goes before one that begins
            if depth == 2 and step < 0:
                if pos > start:
                    found.setdefault(chrom, []).append((start, pos - 1))
            elif depth == 1 and step > 0:
                start = pos
            depth += step
    for chrom, ranges in found.items():
        joined = [ranges[0]]
        for low, high in ranges[1:]:
            if low == joined[-1][1] + 1:
                joined[-1] = (joined[-1][0], high)
            else:
                joined.append((low, high))
        found[chrom] = joined
    return found


def _fewer(ranges: dict[str, list[tuple[int, int]]]) -> dict[str, list[tuple[int, int]]]:
    """The ranges, the closest of a contig joined until they are few: one row
    of one batch comes out of a merge as it went in."""
    gaps = sorted(b[0] - a[1] for own in ranges.values() for a, b in zip(own, own[1:]))
    keep = max(0, MAX_RANGES - len(ranges))
    if len(gaps) <= keep:
        return ranges
    joins = gaps[len(gaps) - keep - 1]  # the widest gap that is closed
    out: dict[str, list[tuple[int, int]]] = {}
    for chrom, own in ranges.items():
        joined = out.setdefault(chrom, [own[0]])
        for low, high in own[1:]:
            if low - joined[-1][1] > joins:
                joined.append((low, high))
            else:
                joined[-1] = (joined[-1][0], high)
    return out


def sharing(batches: Sequence[Batch], ranges: dict[str, list[tuple[int, int]]]) -> list[Batch]:
    """The batches that cover any of the ranges."""
    return [b for b in batches if any(b.contigs[c][0] is not None and b.contigs[c][0] <= high and low <= b.contigs[c][1] for c in b.contigs for low, high in ranges.get(c, ()))]


def _rows(spark: SparkSession, root: str, batches: Sequence[Batch], schema: T.StructType, kinds: Mapping[str, int]) -> DataFrame:
    """The rows of one table's batches in one schema, with ``batch`` and
    ``_kind``.  Batches that have the same types are read together, each
    in its own types, and widened."""
    groups: dict[tuple, list[Batch]] = {}
    differing: dict[int, tuple] = {}
    for b in batches:
        if id(b.schema) not in differing:
            differing[id(b.schema)] = tuple(
                (f.name, f.dataType.simpleString()) for f in sorted(b.schema.fields, key=lambda f: f.name) if f.dataType.simpleString() != schema[f.name].dataType.simpleString()
            )
        groups.setdefault(differing[id(b.schema)], []).append(b)
    columns = [f for f in schema.fields if f.name != PARTITION_COL]
    out = []
    for types, own in groups.items():
        stored = {name: T.DataType.fromDDL(t) for name, t in types}
        fields = [T.StructField(f.name, stored.get(f.name, f.dataType)) for f in columns]
        full = T.StructType([*fields, T.StructField(PARTITION_COL, T.StringType()), T.StructField(BATCH_COL, T.StringType())])
        df = in_batches(spark.read.schema(full).parquet(table_path(root, own[0].table)), own, kinds)
        out.append(df.select(PARTITION_COL, *[widened(f.name, stored.get(f.name, f.dataType), f.dataType) for f in columns], BATCH_COL, "_kind"))
    return reduce(DataFrame.unionByName, out)


def _within(places: Sequence[tuple[str, int, int]]) -> Column:
    """Whether a row is at one of the places (contig, first and last position)."""
    at = [(F.col(PARTITION_COL) == c) & F.col("pos").between(low, high) for c, low, high in places]
    return F.coalesce(reduce(Column.__or__, at), F.lit(False))


def _parted(
    spark: SparkSession, root: str, batches: Sequence[Batch], key: Sequence[str]
) -> tuple[DataFrame, DataFrame, list[tuple[str, int, int]], Callable[[DataFrame], DataFrame]]:
    """The rows of one table's batches that are taken as they are, all rows of
    the batches that share places, those places, and what merges rows of them by
    ``key``."""
    schema = merged_schema(batches)
    columns = [f.name for f in schema.fields if f.name != PARTITION_COL]
    sets = {id(b.schema): frozenset(b.schema.names) for b in batches}
    numbers = {names: i for i, names in enumerate(dict.fromkeys(sets.values()))}
    kinds = {b.batch: numbers[sets[id(b.schema)]] for b in batches}  # batches of one kind have the same columns
    df = _rows(spark, root, batches, schema, kinds)
    # columns that batches of the same kinds have are decided together
    groups: dict[tuple[int, ...], list[str]] = {}
    for c in columns:
        if c not in key:
            groups.setdefault(tuple(i for names, i in numbers.items() if c in names), []).append(c)
    newest = [F.max_by(F.struct(*names), F.when(F.col("_kind").isin(list(owners)), F.col(BATCH_COL))).alias(f"_g{i}") for i, (owners, names) in enumerate(groups.items())]
    place = {c: f"_g{i}.{c}" for i, names in enumerate(groups.values()) for c in names}

    def merge(rows: DataFrame) -> DataFrame:
        # positions first, as they tell most rows apart
        merged = rows.groupBy(*sorted(key, key=lambda c: c != "pos")).agg(*newest)
        return merged.select(PARTITION_COL, *[F.col(place.get(c, c)).alias(c) for c in columns])

    ranges = _fewer(shared_ranges(batches))
    places = [(c, low, high) for c, own in sorted(ranges.items()) for low, high in own]
    if not places:
        return df.select(PARTITION_COL, *columns), df, places, merge
    return df.where(~_within(places)).select(PARTITION_COL, *columns), _rows(spark, root, sharing(batches, ranges), schema, kinds), places, merge


def scan_batches(spark: SparkSession, root: str, batches: Sequence[Batch], key: Sequence[str]) -> DataFrame:
    """The rows of one table's batches, merged by ``key`` where several batches
    cover a position."""
    alone, rows, places, merge = _parted(spark, root, batches, key)
    if not places:
        return alone
    # dealt before they are merged: rows of a batch differ in key, so nothing is gained
    # by sorting what a reading task has.  No place is null: said here too, since a join on
    # the place says so, and a query that reads the table twice would else deal it twice
    shared = rows.where(F.col(PARTITION_COL).isNotNull() & F.col("pos").isNotNull() & _within(places))
    return alone.unionByName(merge(shared.repartition(*key)))


#: Rows that a task merges without a shuffle, about; fewer if tasks would be idle.
PIECE_ROWS = 1_000_000
LEAST_PIECE_ROWS = 50_000

#: Pieces of a contig, at most.
MAX_CUTS = 10_000


def _pieces(rows: DataFrame, places: Sequence[tuple[str, int, int]], most: int, sizes: Mapping[str, int]) -> list[tuple[list[tuple[str, int, int]], bool]]:
    """The places in pieces with about ``most`` rows at most: a stretch of a
    contig, or several small contigs.  A position with more rows is a piece
    of its own, which is marked.  ``sizes``: rows of each contig."""
    parts = {c: min(MAX_CUTS, -(-n // most)) for c, n in sizes.items() if n > most}
    ends: dict[str, list[int]] = {}
    if parts:  # positions that cut each contig into so many equal parts, of which it takes some
        m = max(parts.values())
        at = F.expr(f"percentile_approx(pos, array({', '.join(f'{i / m!r}D' for i in range(1, m))}), {max(10_000, 10 * m)})")
        found = rows.where(F.col(PARTITION_COL).isin(list(parts))).groupBy(PARTITION_COL).agg(at.alias("at")).collect()
        ends = {c: [r["at"][i * m // parts[c] - 1] for i in range(1, parts[c])] for r in found for c in [r[PARTITION_COL]]}
    out: list[tuple[list[tuple[str, int, int]], bool]] = []
    small: list[tuple[str, int, int]] = []
    held = 0
    for c, n in sorted(sizes.items()):
        own = [(low, high) for place, low, high in places if place == c]
        if c not in ends:
            if small and held + n > most:
                out.append((small, False))
                small, held = [], 0
            small = [*small, *((c, low, high) for low, high in own)]
            held += n
            continue
        start, last = own[0][0], own[-1][1]
        for end in sorted({*ends[c], last}):
            hot = ends[c].count(end) > (end != last)
            for first, until, marked in ((start, end - 1, False), (end, end, True)) if hot else ((start, end, False),):
                if cut := [(c, max(first, low), min(until, high)) for low, high in own if low <= until and first <= high]:
                    out.append((cut, marked))
            start = end + 1
    return [*out, (small, False)] if small else out


def merged_pieces(spark: SparkSession, root: str, batches: Sequence[Batch], key: Sequence[str]) -> Iterator[DataFrame]:
    """What ``scan_batches`` gives, in frames to be written one after the other.
    Rows to be merged are read piece by piece, each by the task that merges it
    (files are sorted by position, so it reads little else).  Nothing is shuffled
    but a position with very many rows, which is dealt by key."""
    alone, rows, places, merge = _parted(spark, root, batches, key)
    if not places:
        yield alone
        return
    extent = rows.groupBy(PARTITION_COL).agg(F.count(F.lit(1)).alias("n"), F.count("pos").alias("known"), F.min("pos").alias("low"), F.max("pos").alias("high")).collect()
    inside = [r["n"] == r["known"] and any(c == r[PARTITION_COL] and low <= r["low"] and r["high"] <= high for c, low, high in places) for r in extent]
    if not all(inside) or len(sharing(batches, shared_ranges(batches))) < len(batches):
        yield alone
    tasks = 2 * spark.sparkContext.defaultParallelism
    most = max(LEAST_PIECE_ROWS, min(PIECE_ROWS, -(-sum(r["n"] for r in extent) // tasks)))
    contigs = {c for c, _, _ in places}
    pieces = _pieces(rows, places, most, {r[PARTITION_COL]: r["known"] for r in extent if r[PARTITION_COL] in contigs})
    # a union of single partitions only would be one partition; beside a scan without files they stay apart
    nothing = rows.where(F.col(BATCH_COL) == "").select(alone.columns)
    for i in range(0, len(pieces), MAX_RANGES):  # a plan names so many at most
        # contigs and outer positions are named apart, in a form that folders and row groups are chosen by
        own = [
            (rows.where(F.col(PARTITION_COL).isin(sorted({c for c, _, _ in cut})) & F.col("pos").between(min(p for _, p, _ in cut), max(p for _, _, p in cut)) & _within(cut)), hot)
            for cut, hot in pieces[i : i + MAX_RANGES]
        ]
        yield reduce(DataFrame.unionByName, [nothing, *(merge(df.repartition(*key) if hot else df.coalesce(1)) for df, hot in own)])
