"""What travels or stays on disk while a store is written, compacted and asked."""

import re

import pytest
from pyspark.sql import functions as F
from vcf_fixture import HEADER, line

from varlake.operators.filters import make_filter
from varlake.plans import ingest as ingest_module
from varlake.plans import registry
from varlake.plans.compact import compact
from varlake.plans.ingest import ingest
from varlake.plans.query import TABLE_KEYS, load_table, load_tables, query_variants, run_query
from varlake.session import scratch_path
from varlake.sources import batches as module
from varlake.sources.batches import merged_pieces, read_batches, scan_batches

TABLES = ("main", "info", "csq", "genotypes")


def site(chrom, pos, name, entries=1):
    csq = ",".join([f"G|m|GENE{pos % 7}|{name}|0.1|0.2"] * entries)
    return line(chrom, pos, name, "A", "G", 1.0, "PASS", f"AC=1;AN=2;CSQ={csq}", "GT:MIN_DP", "0/1:4", "0/0:5")


def store(spark, tmp_path, *inputs, **options):
    root = str(tmp_path / "store")
    for i, lines in enumerate(inputs):
        f = tmp_path / f"{i}.vcf"
        f.write_text("\n".join([*HEADER, *lines]) + "\n")
        ingest(spark, str(f), root, **options)
    return root


@pytest.fixture
def overlapping(spark, tmp_path):
    first = [site("chr1", p, f"a{p}") for p in range(1, 400, 2)] + [site("chr2", 5, "hot", 60), site("chr2", 6, "x"), site("chr3", 1, "y")]
    second = [site("chr1", p, f"b{p}") for p in range(20, 500, 3)] + [site("chr2", p, f"c{p}", 1 + 40 * (p == 5)) for p in range(1, 9)] + [site("chr4", 7, "z")]
    return store(spark, tmp_path, first, second)


def own_of(spark, root, t):
    return [b for b in read_batches(spark, root) if b.table == t]


@pytest.mark.parametrize("most", [7, 40, 10_000])
@pytest.mark.parametrize("t", TABLES)
def test_pieces_have_the_rows_of_a_scan(spark, overlapping, monkeypatch, t, most):
    monkeypatch.setattr(module, "LEAST_PIECE_ROWS", most)
    monkeypatch.setattr(module, "PIECE_ROWS", most)
    own = own_of(spark, overlapping, t)
    frames = list(merged_pieces(spark, overlapping, own, TABLE_KEYS[t]))
    want = scan_batches(spark, overlapping, own, TABLE_KEYS[t])
    assert sorted(str(r) for f in frames for r in f.collect()) == sorted(map(str, want.collect()))
    assert all(f.schema == want.schema for f in frames)
    assert sum(f.rdd.getNumPartitions() for f in frames[1:]) >= 2 if most < 10_000 else len(frames) <= 2


def test_pieces_are_bounded(spark):
    rows = spark.createDataFrame([("a", p) for p in range(1000)] + [("b", 5)] * 300 + [("b", p) for p in range(20)] + [("c", 1), ("d", 1), ("e", 1)], "chrom string, pos int")
    places = [("a", 0, 399), ("a", 500, 2000), ("b", 0, 5), ("b", 7, 30), ("c", 1, 1), ("d", 1, 1), ("e", 1, 1)]
    sizes = {r[0]: r[1] for r in rows.groupBy("chrom").count().collect()}
    pieces = module._pieces(rows, places, 100, sizes)
    n = [rows.where(module._within(cut)).count() for cut, _ in pieces]
    assert sum(n) == rows.where(module._within(places)).count()
    assert all(x <= 120 for x, (_, hot) in zip(n, pieces) if not hot)
    assert [cut for cut, hot in pieces if hot] == [[("b", 5, 5)]]
    assert pieces[-1] == ([("c", 1, 1), ("d", 1, 1), ("e", 1, 1)], False)


def test_last_position_may_be_hot(spark):
    rows = spark.createDataFrame([("a", p) for p in range(50)] + [("a", 50)] * 500, "chrom string, pos int")
    pieces = module._pieces(rows, [("a", 0, 50)], 100, {"a": 550})
    assert pieces[-1] == ([("a", 50, 50)], True) and pieces[-2][0][0][2] == 49


def test_compaction_shuffles_no_row(spark, overlapping, monkeypatch):
    plans = []
    real = ingest_module.write_table

    def seen(df, root, name, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, root, name, **options)

    monkeypatch.setattr(ingest_module, "write_table", seen)
    before = {t: sorted(map(str, load_table(spark, overlapping, t).collect())) for t in TABLES}
    assert compact(spark, overlapping) == dict.fromkeys(TABLES, 2)
    assert plans and not any("Exchange" in p for p in plans)
    assert {t: sorted(map(str, load_table(spark, overlapping, t).collect())) for t in TABLES} == before


def test_pieces_choose_folders_and_row_groups(spark, overlapping, monkeypatch):
    monkeypatch.setattr(module, "LEAST_PIECE_ROWS", 40)
    monkeypatch.setattr(module, "PIECE_ROWS", 40)
    kept = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plans = [f._jdf.queryExecution().executedPlan().toString() for f in merged_pieces(spark, overlapping, own_of(spark, overlapping, "main"), TABLE_KEYS["main"])]
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", kept)
    scans = [x for p in plans[1:] for x in p.split("\n") if "FileScan" in x and "GreaterThanOrEqual(pos" in x]
    assert len(scans) >= 4 and all(re.search(r"PartitionFilters: \[[^\]]*chrom#\d+ (IN|=)", x) for x in scans)


def test_rows_without_position_are_kept(spark, tmp_path):
    """A batch may have rows that no place covers, though all others are shared."""
    inputs = [[site("chr1", 1, "a"), site("chr1", 9, "b")], [site("chr1", 1, "c"), site("chr1", 9, "d"), site("chr1", 9, "e").replace("chr1\t9", "chr1\t.")]]
    root = store(spark, tmp_path, *inputs, on_bad_line="keep")
    before = {t: sorted(map(str, load_table(spark, root, t).collect())) for t in TABLES}
    assert load_table(spark, root, "main").where(F.col("pos").isNull()).count() == 1
    compact(spark, root)
    assert {t: sorted(map(str, load_table(spark, root, t).collect())) for t in TABLES} == before


def test_rows_of_other_samples_stay_at_the_scan(spark, overlapping):
    out = query_variants(spark, overlapping, "F", symbol="GENE1", consequence="m", samples=["NA-1"])
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = [i for i, x in enumerate(lines) if re.search(r"Filter .*sampleId#\d+ = NA-1", x)]
    assert at and all(re.search(r"Relation \[.*sampleId#", lines[i + 1]) for i in at)
    assert sum(bool(re.search(r"\bRelation \[.*sampleId", x)) for x in lines) == len(at)
    every = query_variants(spark, overlapping, "F", symbol="GENE1", consequence="m", samples="all")
    assert sorted(map(str, out.collect())) == sorted(map(str, every.select(out.columns).collect())) != []


def test_merged_table_is_dealt_once(spark, overlapping):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = run_query(make_filter("F", symbol="GENE1", consequence="m"), *load_tables(spark, overlapping))
        assert out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    dealt = [x for x in plan.split("\n") if re.search(r"Exchange hashpartitioning\(chrom#\d+, pos#\d+, csq_no#\d+", x)]
    assert len(dealt) == 2 and sum("Reused" in x for x in dealt) == 1


@pytest.mark.parametrize("made", [registry._ingested, registry._two_batches])
def test_rendered_files_are_packed(spark, sf, monkeypatch, made):
    packed = []
    real = registry.standin.write_vcf_files

    def seen(*args, **options):
        packed.append((real(*args, **options), options.get("where", "true")))
        return packed[-1][0]

    monkeypatch.setattr(registry.standin, "write_vcf_files", seen)
    made(spark, sf)
    assert len(packed) == 1 + (made is registry._two_batches)
    for path, where in packed:
        plain = real(spark, sf, scratch_path(spark, "vcf"), where=where)
        assert sorted(r[0] for r in spark.read.text(path).select("value").collect()) == sorted(r[0] for r in spark.read.text(plain).select("value").collect())
        size = lambda p: spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(p).agg(F.sum("length")).first()[0]
        assert size(path) * 2 < size(plain)
