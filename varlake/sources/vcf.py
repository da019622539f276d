"""VCF text -> one row per site with typed INFO columns and nested genotypes.

The reader is split in two:

* :func:`parse_vcf_lines` turns a DataFrame of text lines into site rows
  using only built-in column expressions (``split``, ``str_to_map``,
  ``transform``), so parsing runs on executors inside the scan stage and
  needs no shuffle.
* :func:`read_vcf` is the file front end: it reads the header of each
  file (a bounded ``limit`` per file; only header lines reach the driver)
  and hands the data lines to the parser.

Output columns follow the row shape of the common Spark VCF source:
``contigName``, ``start`` (0-based), ``names``, ``referenceAllele``,
``alternateAlleles``, ``qual``, ``filters``, one ``INFO_<id>`` column per
header INFO field (``INFO_CSQ`` as an array of structs named by the CSQ
header), and ``genotypes`` (array of struct with ``sampleId``).

Note on lambdas: Catalyst inlines outer columns into higher-order
function bodies, where they are then evaluated once per array element.
Everything a per-sample or per-annotation lambda needs is therefore
zipped into the array it walks, so no lambda touches the whole line.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import CSQ_LIST_FIELDS, sample_column_expr
from ..session import scratch_path
from .bgzf import can_open, gzip_lines, gzip_ranges

# FORMAT keys renamed in the genotype struct, as the
# reference's queries read them (GT -> calls, AD -> alleleDepths,
# DP -> depth, PL -> phredLikelihoods); other keys keep their id.
FORMAT_RENAMES = {
    "GT": "calls",
    "AD": "alleleDepths",
    "DP": "depth",
    "PL": "phredLikelihoods",
}

# VCF header Type -> Spark type.
_VCF_TYPES = {
    "Integer": T.IntegerType(),
    "Float": T.DoubleType(),
    "String": T.StringType(),
    "Character": T.StringType(),
    "Flag": T.BooleanType(),
}

CSQ_ID = "CSQ"

class VcfFormatError(ValueError):
    """Input that is not a usable VCF (bad header, .bgz name, ...)."""


@dataclass(frozen=True)
class FieldDef:
    id: str
    number: str
    type: str
    description: str = ""

    @property
    def spark_type(self) -> T.DataType:
        base = _VCF_TYPES.get(self.type, T.StringType())
        if self.type == "Flag" or self.number in ("0", "1"):
            return base
        return T.ArrayType(base)


@dataclass(frozen=True)
class VcfHeader:
    info: tuple[FieldDef, ...] = ()
    formats: tuple[FieldDef, ...] = ()
    samples: tuple[str, ...] = ()
    csq_fields: tuple[str, ...] = ()
    lines: tuple[str, ...] = field(default=(), compare=False)

    def same_schema(self, other: "VcfHeader") -> bool:
        return (
            self.info == other.info
            and self.formats == other.formats
            and self.csq_fields == other.csq_fields
        )


_META_RE = re.compile(r"^##(INFO|FORMAT)=<(.*)>\s*$")
_KV_RE = re.compile(r'\s*([A-Za-z_][A-Za-z0-9_.]*)=("(?:[^"\\]|\\.)*"|[^,]*)\s*(?:,|$)')
_CSQ_FORMAT_RE = re.compile(r"Format:\s*(\S+)")


def _parse_meta(body: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for key, value in _KV_RE.findall(body):
        if value.startswith('"'):
            value = value[1:-1].replace('\\"', '"')
        out[key] = value
    return out


def parse_header(lines: list[str] | tuple[str, ...]) -> VcfHeader:
    """Parse ``##INFO``, ``##FORMAT`` and ``#CHROM`` header lines."""
    info: list[FieldDef] = []
    formats: list[FieldDef] = []
    samples: tuple[str, ...] = ()
    csq: tuple[str, ...] = ()
    seen_chrom = False
    for raw in lines:
        line = raw.rstrip("\r\n")
        m = _META_RE.match(line)
        if m:
            meta = _parse_meta(m.group(2))
            if "ID" not in meta:
                raise VcfFormatError(f"header line without ID: {line!r}")
            fd = FieldDef(
                meta["ID"],
                meta.get("Number", "."),
                meta.get("Type", "String"),
                meta.get("Description", ""),
            )
            (info if m.group(1) == "INFO" else formats).append(fd)
            if m.group(1) == "INFO" and fd.id == CSQ_ID:
                cm = _CSQ_FORMAT_RE.search(fd.description)
                if cm:
                    csq = tuple(cm.group(1).split("|"))
        elif line.startswith("#CHROM"):
            cols = line.split("\t")
            samples = tuple(cols[9:])
            seen_chrom = True
    if not seen_chrom:
        raise VcfFormatError("header has no #CHROM line")
    return VcfHeader(tuple(info), tuple(formats), samples, csq, tuple(lines))


# ---------------------------------------------------------------- helpers


def _missing(c: Column) -> Column:
    return c.isNull() | (c == ".") | (c == "")


def _text_list(c: Column, sep: str) -> Column:
    """'.' or empty -> empty array, else split on ``sep`` (a regex)."""
    return F.when(_missing(c), F.array().cast("array<string>")).otherwise(
        F.split(c, sep, -1)
    )


def _typed_scalar(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.when(_missing(c), F.lit(None).cast("string")).otherwise(c)
    # a missing value is told apart first: a cast that fails costs an exception
    return F.when(~_missing(c), c.try_cast(dtype))


def _typed_value(c: Column, fd: FieldDef) -> Column:
    """Typed value of one INFO or FORMAT field from its text (null text ->
    null).  Lists are split and cast as a whole (``try_cast`` on the
    array), which stays in generated code; '.' elements become null."""
    dtype = fd.spark_type
    if isinstance(dtype, T.ArrayType):
        parts = F.split(c, ",", -1)
        if not isinstance(dtype.elementType, T.StringType):
            parts = parts.try_cast(dtype)
        return F.when(_missing(c), F.lit(None).cast(dtype)).otherwise(parts)
    return _typed_scalar(c, dtype)


def _gt_calls(c: Column) -> Column:
    """GT text -> allele indices, '.' -> -1 (``0/1`` -> [0, 1])."""
    # '|' -> '/' and '.' -> '-1' without regexes, then one split on '/'
    calls = F.split(F.replace(F.translate(c, "|", "/"), F.lit("."), F.lit("-1")), "/", -1).try_cast("array<int>")
    return F.when(c.isNull() | (c == ""), F.lit(None).cast("array<int>")).otherwise(calls)


def csq_struct_type(csq_fields: tuple[str, ...]) -> T.StructType:
    return T.StructType(
        [
            T.StructField(
                f,
                T.ArrayType(T.StringType()) if f in CSQ_LIST_FIELDS else T.StringType(),
            )
            for f in csq_fields
        ]
    )


def _csq_column(text: Column, csq_fields: tuple[str, ...]) -> Column:
    """'a|b|c,d|e|f' -> array of struct named by the CSQ header.

    Each entry is split once; the struct is then built from the parts, so
    the work per entry is linear in the number of fields.
    """
    parts = F.transform(F.split(text, ",", -1), lambda e: F.split(e, r"\|", -1))

    def to_struct(p: Column) -> Column:
        cols = []
        for i, name in enumerate(csq_fields):
            v = F.get(p, i)
            v = F.when(v == "", F.lit(None).cast("string")).otherwise(v)
            if name in CSQ_LIST_FIELDS:
                v = F.when(v.isNull(), F.lit(None).cast("array<string>")).otherwise(
                    F.split(v, "&", -1)
                )
            cols.append(v.alias(name))
        return F.struct(*cols)

    return F.when(_missing(text), F.lit(None).cast(T.ArrayType(csq_struct_type(csq_fields)))).otherwise(
        F.transform(parts, to_struct)
    )


def _genotype_field(fd: FieldDef, v: Column) -> list[Column]:
    name = FORMAT_RENAMES.get(fd.id, fd.id)
    if fd.id == "GT":
        return [
            _gt_calls(v).alias("calls"),
            F.coalesce(v.contains("|"), F.lit(False)).alias("phased"),
        ]
    return [_typed_value(v, fd).alias(name)]


# ------------------------------------------------------------------ parse


def exploded(df: DataFrame, keep: Sequence[str | Column], items: Column, place: str, item: str) -> DataFrame:
    """``keep`` and a row per item of the array, with its place.  Arrays that are
    null or empty give no row; they are dropped after the explode: in front of
    it, Spark builds each array a second time to look at its size."""
    return df.select(*keep, F.posexplode_outer(items).alias(place, item)).where(F.col(place).isNotNull())


def parse_vcf_lines(
    lines: DataFrame,
    header: VcfHeader,
    *,
    value_col: str = "value",
    sample_names: Column | None = None,
    include_sample_ids: bool = True,
    flatten_info: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Parse VCF data lines (header lines are skipped) into site rows.

    ``sample_names``: array<string> column of sample ids per line; by
    default the ``#CHROM`` samples of ``header`` as a literal.
    ``keep``: extra input columns carried through (e.g. a file path).
    """
    v = F.col(value_col)
    data = lines.where(~v.startswith("#") & (F.length(v) > 0))
    fields = F.split(v, "\t", -1)
    if sample_names is None:
        sample_names = F.array(*[F.lit(s) for s in header.samples]).cast("array<string>")

    fmt = F.split(F.get(F.col("_f"), 8), ":", -1)
    # one index per header FORMAT field, computed once per line
    fmt_idx = F.array(
        *[(F.array_position(F.col("_fmt"), fd.id) - 1).cast("int") for fd in header.formats]
    ) if header.formats else F.array().cast("array<int>")

    staged = data.select(
        *[F.col(k) for k in keep],
        fields.alias("_f"),
        sample_names.alias("_names"),
    ).select(
        *[F.col(k) for k in keep],
        F.col("_f"),
        F.when(
            (F.size("_f") > 7) & ~_missing(F.get(F.col("_f"), 7)),
            F.str_to_map(F.get(F.col("_f"), 7), F.lit(";"), F.lit("=")),
        ).alias("_info"),
        fmt.alias("_fmt"),
        F.col("_names"),
    )

    out: list[Column] = [F.col(k) for k in keep]
    f = F.col("_f")
    out += [
        F.get(f, 0).alias("contigName"),
        (F.get(f, 1).try_cast("long") - 1).alias("start"),
        _text_list(F.get(f, 2), ";").alias("names"),
        F.get(f, 3).alias("referenceAllele"),
        _text_list(F.get(f, 4), ",").alias("alternateAlleles"),
        F.when(_missing(F.get(f, 5)), F.lit(None).cast("double"))
        .otherwise(F.get(f, 5).try_cast("double"))
        .alias("qual"),
        _text_list(F.get(f, 6), ";").alias("filters"),
    ]

    info = F.col("_info")
    if flatten_info:
        for fd in header.info:
            raw = F.try_element_at(info, F.lit(fd.id))
            if fd.type == "Flag":
                c = F.coalesce(F.map_contains_key(info, F.lit(fd.id)), F.lit(False))
            elif fd.id == CSQ_ID and header.csq_fields:
                c = _csq_column(raw, header.csq_fields)
            else:
                c = _typed_value(raw, fd)
            out.append(c.alias(f"INFO_{fd.id}"))
    else:
        out.append(info.alias("attributes"))

    if header.formats:
        n = F.greatest(F.size(f) - 9, F.lit(0))
        sample_parts = F.transform(F.slice(f, 10, n), lambda s: F.split(s, ":", -1))
        zipped = F.arrays_zip(
            sample_parts.alias("p"),
            F.array_repeat(fmt_idx, n).alias("ix"),
            F.col("_names").alias("nm") if include_sample_ids else F.array_repeat(F.lit(None).cast("string"), n).alias("nm"),
        )

        def sample_struct(e: Column) -> Column:
            p, ix = e["p"], e["ix"]
            cols: list[Column] = []
            if include_sample_ids:
                cols.append(e["nm"].alias("sampleId"))
            for j, fd in enumerate(header.formats):
                cols += _genotype_field(fd, F.get(p, F.get(ix, j)))
            return F.struct(*cols)

        out.append(F.transform(zipped, sample_struct).alias("genotypes"))

    return staged.select(*out)


def parse_genotypes_long(
    lines: DataFrame,
    header: VcfHeader,
    *,
    value_col: str = "value",
    sample_names: Column | None = None,
    samples: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per (site, sample) straight from the text: chrom, pos
    (1-based), sample_index, sampleId and the typed FORMAT fields as
    columns (renamed as in the nested form).

    The sample fields are exploded first, so every field is then read
    with plain expressions in generated code, with no per-element lambda.
    ``samples``: optional ``[start, end)`` slice of the sample list.
    """
    v = F.col(value_col)
    data = lines.where(~v.startswith("#") & (F.length(v) > 0))
    literal_names = sample_names is None
    if literal_names:
        sample_names = F.array(*[F.lit(s) for s in header.samples]).cast("array<string>")
    f = F.col("_f")
    first, count = 10, F.greatest(F.size(f) - 9, F.lit(0))
    offset = 0
    if samples is not None:
        offset = samples[0]
        first = 10 + offset
        count = F.greatest(F.least(count - offset, F.lit(samples[1] - offset)), F.lit(0))
    fmt = F.split(F.get(f, 8), ":", -1)
    # everything per line is computed before the explode, so the explode
    # carries only small columns (never the whole line) into each sample row
    per_line = data.select(F.split(v, "\t", -1).alias("_f"), *([] if literal_names else [sample_names.alias("_names")])).select(
        F.get(f, 0).alias("chrom"),
        F.get(f, 1).try_cast("int").alias("pos"),
        *([] if literal_names else ["_names"]),
        F.array(*[(F.array_position(fmt, fd.id) - 1).cast("int") for fd in header.formats]).alias("_ix"),
        F.slice(f, first, count).alias("_samples"),
    )
    ex = exploded(per_line, ["chrom", "pos", *([] if literal_names else ["_names"]), "_ix"], F.col("_samples"), "_slot", "_s")
    idx = F.col("_slot") + F.lit(offset)
    names = sample_names if literal_names else F.col("_names")
    parts = ex.select(
        "chrom", "pos", idx.alias("sample_index"),
        F.get(names, idx).alias("sampleId"),
        "_ix", F.split("_s", ":", -1).alias("_p"),
    )
    # the lambda keeps this projection out of the stage's one generated method, which
    # all these fields make longer than the JVM compiles (8,000 bytes): a third of the time
    sample = F.get(F.transform(F.array("sampleId"), lambda x: x), 0).alias("sampleId")
    out = [F.col("chrom"), F.col("pos"), F.col("sample_index"), sample]
    for j, fd in enumerate(header.formats):
        out += _genotype_field(fd, F.get(F.col("_p"), F.get(F.col("_ix"), j)))
    return parts.select(*out)


def parse_csq_long(lines: DataFrame, header: VcfHeader, *, value_col: str = "value") -> DataFrame:
    """One row per annotation straight from the text: contigName, start
    (0-based), csq_no and ``_csq``, a struct named by the CSQ header.

    The CSQ entries are exploded first and each is split once, so every
    field is read with plain expressions in generated code (the nested
    ``INFO_CSQ`` column needs a per-entry lambda).  Sites without CSQ give
    no row.
    """
    if not header.csq_fields:
        raise VcfFormatError("header has no CSQ INFO line with a 'Format:' list")
    v = F.col(value_col)
    f = F.col("_f")
    data = lines.where(~v.startswith("#") & (F.length(v) > 0))
    info_text = F.get(f, 7)
    per_line = data.select(F.split(v, "\t", -1).alias("_f")).select(
        F.get(f, 0).alias("contigName"),
        (F.get(f, 1).try_cast("long") - 1).alias("start"),
        F.try_element_at(
            F.when(~_missing(info_text), F.str_to_map(info_text, F.lit(";"), F.lit("="))),
            F.lit(CSQ_ID),
        ).alias("_csq_text"),
    )
    t = F.col("_csq_text")
    ex = exploded(per_line, ["contigName", "start"], F.when(~_missing(t), F.split(t, ",", -1)), "csq_no", "_e")
    parts = ex.select("contigName", "start", "csq_no", F.split("_e", r"\|", -1).alias("_p"))
    p = F.col("_p")
    cols = []
    for i, name in enumerate(header.csq_fields):
        x = F.get(p, i)
        x = F.when(x == "", F.lit(None).cast("string")).otherwise(x)
        if name in CSQ_LIST_FIELDS:
            x = F.split(x, "&", -1)
        cols.append(x.alias(name))
    return parts.select("contigName", "start", "csq_no", F.struct(*cols).alias("_csq"))


# ------------------------------------------------------------- broken lines

BAD_LINE_MODES = ("fail", "drop", "keep")


def line_fault(value: Column) -> Column:
    """What is wrong with a VCF line; null for a sound one, a header line and
    an empty one.  A data line has at least eight fields, a contig and a
    position of digits."""
    f = F.split(value, "\t", 9)
    fault = (
        F.when(value.startswith("#") | (F.length(value) == 0), F.lit(None).cast("string"))
        .when(F.size(f) < 8, F.concat(F.size(f).cast("string"), F.lit(" fields instead of 8 or more")))
        .when(F.get(f, 0) == "", F.lit("no contig"))
        .when(~F.get(f, 1).rlike("^[0-9]+$"), F.concat(F.lit("position "), F.get(f, 1)))
    )
    return fault


def sound_lines(lines: DataFrame, mode: str = "fail") -> tuple[DataFrame, DataFrame | None]:
    """``lines`` (``value``, ``file_path``) without broken ones, and the broken
    ones (file_path, line, reason).

    ``fail``: the job that comes to one fails and names it; ``drop``: the text is
    written once to the scratch folder with the reasons, and both are read
    from there; ``keep``: all lines as they are."""
    if mode not in BAD_LINE_MODES:
        raise ValueError(f"on_bad_line must be one of {', '.join(BAD_LINE_MODES)}")
    if mode == "keep":
        return lines, None
    fault = line_fault(F.col("value"))
    if mode == "fail":
        told = F.concat(F.lit("broken VCF line in "), F.col("file_path"), F.lit(": "), fault, F.lit(": "), F.substring("value", 1, 200))
        return lines.where(F.when(fault.isNotNull(), F.raise_error(told).cast("boolean")).otherwise(F.lit(True))), None
    path = scratch_path(lines.sparkSession, "vcf-lines")
    lines.withColumn("reason", fault).write.parquet(path)
    back = lines.sparkSession.read.parquet(path)
    return back.where("reason is null").drop("reason"), back.where("reason is not null").select("file_path", F.col("value").alias("line"), "reason")


# ------------------------------------------------------------------ files


def _check_path(spark: SparkSession, path: str) -> None:
    if path.endswith(".bgz"):
        codecs = spark.sparkContext._jsc.hadoopConfiguration().get("io.compression.codecs") or ""
        if "bgz" not in codecs.lower():
            raise VcfFormatError(
                f"{path}: only Spark can open this path, and without a block-gzip codec in io.compression.codecs it reads '.bgz' as plain text; "
                "name such a codec, or the files '*.vcf.gz' (gzip readers accept the multi-member stream)"
            )


def read_header_lines(spark: SparkSession, file: str, first: int = 512) -> list[str]:
    """Header lines of one file, read with a growing ``limit`` so only the
    start of the file is scanned (the header precedes all data lines)."""
    n = first
    while True:
        rows = [r[0] for r in spark.read.text(file).limit(n).collect()]
        for k, line in enumerate(rows):
            if not line.startswith("#"):
                return rows[:k]
        if len(rows) < n:
            return rows
        n *= 8


def _plain_path(c: Column) -> Column:
    """Listing and _metadata spell local paths differently ('file:///x' /
    'file:/x'): compare both without the scheme."""
    return F.regexp_replace(c, "^file:/+", "/")


def _source_path() -> Column:
    """The file of a text row, spelled like those of a listing."""
    return _plain_path(F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")))


def headers_of_lines(lines: DataFrame) -> dict[str, VcfHeader]:
    """Header per file of lines (``value``, ``file_path``), in one job:
    each distinct header text reaches the driver once, and of each file its
    path and the hash of its header."""
    found = lines.where(F.col("value").startswith("#")).select("file_path", F.struct(F.monotonically_increasing_id().alias("n"), "value").alias("line"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["value"]), "\n")
    per_file = found.groupBy("file_path").agg(text.alias("text")).select("file_path", "text", F.xxhash64("text").alias("h"))
    path = scratch_path(lines.sparkSession, "vcf-headers")
    per_file.write.parquet(path)
    per_file = lines.sparkSession.read.parquet(path)
    parsed = {r["text"]: parse_header(r["text"].split("\n")) for r in per_file.select("text").distinct().collect()}
    by_hash = {r["h"]: r["text"] for r in per_file.select("h", "text").distinct().collect()}
    return {r["file_path"]: parsed[by_hash[r["h"]]] for r in per_file.select("file_path", "h").collect()}


def read_headers(spark: SparkSession, files: list[str]) -> dict[str, VcfHeader]:
    """Headers of many files, by path without a file scheme."""
    if not files:
        return {}
    if len(files) == 1:
        return {re.sub(r"^file:/+", "/", files[0]): parse_header(read_header_lines(spark, files[0]))}
    return headers_of_lines(spark.read.text(files).select("value", _source_path().alias("file_path")))


@dataclass(frozen=True)
class VcfSource:
    """Lines of one or more VCF files, ready for either parser.

    ``parts``: (lines, header, sample_names) triples; ``sample_names`` is
    None when the header's literal list applies.
    ``sample_parts``: set by :meth:`stage`; then ``parts`` hold only the
    site fields and ``sample_parts`` only CHROM, POS, FORMAT and samples.
    ``sample_ids``: of all headers, in order; ``files``: the inputs."""

    header: VcfHeader
    parts: tuple[tuple[DataFrame, VcfHeader, Column | None], ...]
    sample_parts: tuple[tuple[DataFrame, VcfHeader, Column | None], ...] | None = None
    sample_ids: tuple[str, ...] = ()
    files: tuple[str, ...] = ()
    bad_lines: DataFrame | None = None  #: (file_path, line, reason) of dropped lines

    def sites(self, *, include_sample_ids: bool = True, flatten_info: bool = True) -> DataFrame:
        """Nested site rows (:func:`parse_vcf_lines`); a staged source has
        no ``genotypes`` column here (use :meth:`genotypes`)."""
        staged = self.sample_parts is not None
        return _union(
            parse_vcf_lines(
                lines, replace(h, formats=()) if staged else h, sample_names=names,
                include_sample_ids=include_sample_ids, flatten_info=flatten_info,
            )
            for lines, h, names in self.parts
        )

    def sample_list(self) -> DataFrame:
        """Ordered samples (sample_index, sample_id, sample), from the
        headers alone: no data line is read."""
        spark = self.parts[0][0].sparkSession
        rows = spark.createDataFrame(list(enumerate(self.sample_ids)), "sample_index int, sample_id string")
        return rows.withColumn("sample", sample_column_expr(F.col("sample_id")))

    def annotations(self) -> DataFrame:
        """One row per CSQ entry (:func:`parse_csq_long`)."""
        return _union(parse_csq_long(lines, h) for lines, h, _ in self.parts)

    def genotypes(self, samples: tuple[int, int] | None = None) -> DataFrame:
        """One row per (site, sample) (:func:`parse_genotypes_long`)."""
        parts = self.sample_parts if self.sample_parts is not None else self.parts
        return _union(
            parse_genotypes_long(lines, h, sample_names=names, samples=samples)
            for lines, h, names in parts
        )

    def stage(self, path: str) -> "VcfSource":
        """Split each data line once and write it as two Parquet columns
        under ``path`` (a shared folder): the site fields (CHROM to INFO)
        and CHROM, POS, FORMAT with the sample fields.  Each table built
        from the staged source then reads one column, so compressed text
        is decompressed and split once instead of once per table."""
        if self.sample_parts is not None:
            return self
        site_parts, sample_parts = [], []
        for k, (lines, h, names) in enumerate(self.parts):
            v = F.col("value")
            f = F.split(v, "\t", 10)  # the 10th element keeps all sample fields
            data = lines.where(~v.startswith("#") & (F.length(v) > 0))
            cols = [
                F.concat_ws("\t", *[F.get(f, i) for i in range(8)]).alias("site_line"),
                F.concat_ws(
                    "\t", F.get(f, 0), F.get(f, 1), *[F.lit(".")] * 6, F.get(f, 8), F.get(f, 9)
                ).alias("sample_line"),
            ]
            if names is not None:
                cols.append(names.alias("sample_names"))
            out = f"{path.rstrip('/')}/part-{k}"
            data.select(*cols).write.mode("overwrite").option("compression", "zstd").parquet(out)
            back = lines.sparkSession.read.parquet(out)
            keep = ["sample_names"] if names is not None else []
            nm = F.col("sample_names") if names is not None else None
            site_parts.append((back.select(F.col("site_line").alias("value")), h, None))
            per_line = F.size("sample_names") if names is not None else F.lit(len(h.samples))
            fields = back.agg(F.sum(per_line)).first()[0]
            sample_parts.append((_in_ranges(back.select(F.col("sample_line").alias("value"), *keep), fields or 0), h, nm))
        return replace(self, parts=tuple(site_parts), sample_parts=tuple(sample_parts))


#: Sample fields in a task that sorts them, about.
FIELDS_PER_TASK = 1_000_000


def _in_ranges(lines: DataFrame, fields: int) -> DataFrame:
    """Lines with that many sample fields in all, in ranges of (contig, position)
    if the tasks that read them would have too many: staged lines are small, and a
    row per field many times as large, so a task would sort more than it can hold."""
    n = -(-fields // FIELDS_PER_TASK)
    if n <= max(1, lines.rdd.getNumPartitions()):
        return lines
    f = F.split("value", "\t", 3)
    return lines.repartitionByRange(n, F.get(f, 0), F.get(f, 1).try_cast("long"))


def _union(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), list(frames))


def open_vcf(
    spark: SparkSession,
    path: str | list[str],
    *,
    min_partitions: int | None = None,
    same_header: bool = False,
    range_bytes: int | None = None,
    on_bad_line: str = "fail",
) -> VcfSource:
    """List the files, read their headers and return their lines.

    When files carry different sample lists, each line gets its file's
    samples through a join on the file path with a table of one row per
    file.  INFO, FORMAT and CSQ definitions must agree.
    ``min_partitions`` spreads the text over at least so many tasks with a
    round-robin repartition; compressed text of fewer tasks is spread over the
    session's default parallelism.  Block-gzip files are read in ranges of
    ``range_bytes`` compressed bytes (``sources.bgzf``).
    ``same_header``: read only the first file's header and use it for all
    files (thousands of per-contig files of one cohort).
    ``on_bad_line``: see ``sound_lines``; dropped lines are in ``bad_lines``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    text = spark.read.text(paths)
    files = sorted(unquote(f) for f in text.inputFiles())
    if not files:
        raise VcfFormatError(f"no input files at {paths}")
    packed = [f for f in files if f.endswith((".gz", ".bgz")) and can_open(f)]
    plain = [f for f in files if f not in set(packed)]
    for p in plain:
        _check_path(spark, p)
    ranges = gzip_ranges(spark, packed, range_bytes) if packed else None
    # the caller may vouch that every file has the first file's header (e.g.
    # one cohort split by contig): one header read, not one per file
    asked = files[:1] if same_header else files
    headers = read_headers(spark, [f for f in asked if f not in set(packed)])
    if any(f in set(packed) for f in asked):
        own = ranges.where(_plain_path(F.col("file")) == _plain_path(F.lit(asked[0]))) if same_header else ranges
        headers |= headers_of_lines(gzip_lines(own, header_only=True).withColumn("file_path", _plain_path(F.col("file_path"))))
    if len(headers) < len(asked):
        raise VcfFormatError(f"{len(asked) - len(headers)} of {len(asked)} files have no header line")
    if min_partitions is None and any(f.endswith((".gz", ".bgz", ".zst", ".deflate")) for f in files):
        min_partitions = spark.sparkContext.defaultParallelism

    def spread(t: DataFrame) -> DataFrame:
        if min_partitions and t.rdd.getNumPartitions() < min_partitions:
            return t.repartition(min_partitions)
        return t

    parts = [gzip_lines(ranges)] if packed else []
    if plain:
        parts.append((spark.read.text(plain) if packed else text).select("value", _source_path().alias("file_path")))
    lines = spread(_union(parts).select("value", _plain_path(F.col("file_path")).alias("file_path")))
    lines, bad = sound_lines(lines, on_bad_line)
    return replace(_source(lines, headers), files=tuple(files), bad_lines=bad)


def _source(lines: DataFrame, headers: dict[str, VcfHeader]) -> VcfSource:
    """The source of lines (``value``, ``file_path``) with a header per file."""
    origin, first = min(headers.items())
    for f, h in headers.items():
        if not first.same_schema(h):
            raise VcfFormatError(f"{f}: INFO/FORMAT/CSQ header differs from {origin}")
    lists = dict.fromkeys(h.samples for _, h in sorted(headers.items()))
    ids = tuple(dict.fromkeys(s for names in lists for s in names))
    if len(lists) == 1:
        return VcfSource(first, ((lines.select("value"), first, None),), sample_ids=ids)
    number = {names: i for i, names in enumerate(lists)}
    spark = lines.sparkSession
    per_file = spark.createDataFrame([(f, number[h.samples]) for f, h in headers.items()], "file_path string, list_id int")
    names = spark.createDataFrame([(i, list(x)) for x, i in number.items()], "list_id int, sample_names array<string>")
    joined = lines.join(per_file.join(names, "list_id").drop("list_id"), "file_path", "left")
    return VcfSource(first, ((joined, first, F.col("sample_names")),), sample_ids=ids)


def source_of_lines(lines: DataFrame) -> VcfSource | None:
    """The source of whole files' lines (``value``, ``file_path``), such as
    a micro-batch; None without header lines."""
    headers = headers_of_lines(lines)
    return _source(lines, headers) if headers else None


def read_vcf(
    spark: SparkSession,
    path: str | list[str],
    *,
    include_sample_ids: bool = True,
    flatten_info: bool = True,
    min_partitions: int | None = None,
    same_header: bool = False,
    range_bytes: int | None = None,
    on_bad_line: str = "fail",
) -> tuple[DataFrame, VcfHeader]:
    """Read VCF files (plain, ``.vcf.gz`` or ``.vcf.bgz``) into nested site
    rows; returns the DataFrame and the (first file's) header."""
    src = open_vcf(spark, path, min_partitions=min_partitions, same_header=same_header, range_bytes=range_bytes, on_bad_line=on_bad_line)
    return src.sites(include_sample_ids=include_sample_ids, flatten_info=flatten_info), src.header


def pos_one_based(df: DataFrame, col: str = "start") -> DataFrame:
    """``start + 1`` replaces ``start`` (0-based -> 1-based position)."""
    return df.withColumn(col, F.col(col) + F.lit(1))


__all__ = [
    "FieldDef",
    "VcfHeader",
    "VcfFormatError",
    "parse_header",
    "parse_vcf_lines",
    "read_header_lines",
    "read_vcf",
    "open_vcf",
    "VcfSource",
    "parse_genotypes_long",
    "parse_csq_long",
    "pos_one_based",
    "csq_struct_type",
    "FORMAT_RENAMES",
]
