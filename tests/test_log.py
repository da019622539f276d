"""The batch log: checkpoints, many batches, and types that widen."""

import json

import pytest
from pyspark.sql import types as T
from vcf_fixture import HEADER, line

from varlake.operators.store import SchemaConflictError
from varlake.plans import query as query_module
from varlake.plans.compact import compact
from varlake.plans.ingest import ingest
from varlake.plans.query import load_table, query_variants, stored_rows
from varlake.sources import batches as module
from varlake.sources.batches import checkpoint_log, read_batches, widest

TABLES = ("main", "info", "csq", "genotypes")


def site(chrom, pos, name, an="2"):
    return line(chrom, pos, name, "A", "G", 1.0, "PASS", f"AC=1;AN={an};CSQ=G|m|GENE{pos % 7}|{name}|0.1|0.2", "GT:MIN_DP", "0/1:4", "0/0:5")


def put(spark, tmp_path, name, lines, header=HEADER, root="store", **options):
    (tmp_path / f"{name}.vcf").write_text("\n".join([*header, *lines]) + "\n")
    ingest(spark, str(tmp_path / f"{name}.vcf"), str(tmp_path / root), **options)


def rows(spark, root):
    return {t: sorted(map(str, load_table(spark, root, t).collect())) for t in TABLES}


INPUTS = {"a": [site("chr1", p, f"a{p}") for p in range(1, 20, 2)], "b": [site("chr1", p, f"b{p}") for p in range(10, 30, 3)], "c": [site("chr2", 5, "c5")]}


def test_a_store_reads_alike_with_and_without_checkpoints(spark, tmp_path, monkeypatch):
    plain, folded = str(tmp_path / "plain"), str(tmp_path / "folded")
    for every, root in ((1_000, "plain"), (1, "folded")):
        monkeypatch.setattr(module, "CHECKPOINT_EVERY", every)
        for name, lines in INPUTS.items():
            put(spark, tmp_path, name, lines, root=root)
    assert module._epoch(spark, plain) == 0 and module._epoch(spark, folded) == 3
    digest = lambda root: sorted((b.table, b.input, b.schema.json(), b.rows, b.samples, sorted(b.contigs.items())) for b in read_batches(spark, root))  # noqa: E731  (files were written twice: other states)
    assert digest(plain) == digest(folded)
    want = rows(spark, plain)
    assert rows(spark, folded) == want
    before = read_batches(spark, folded)
    for name in INPUTS:  # stored already, as the checkpoint says
        ingest(spark, str(tmp_path / f"{name}.vcf"), folded)
    assert read_batches(spark, folded) == before and module._epoch(spark, folded) == 3
    assert compact(spark, folded) == dict.fromkeys(TABLES, 2)
    assert module._epoch(spark, folded) == 4 and rows(spark, folded) == want
    # a changed input takes the place of its rows in a checkpoint
    put(spark, tmp_path, "c", [site("chr2", 6, "c6")], root="folded")
    assert [r["id"] for r in load_table(spark, folded, "main").where("chrom = 'chr2'").collect()] == [["c6"]]


def test_a_checkpoint_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    assert not checkpoint_log(spark, root, 0)  # no store yet
    put(spark, tmp_path, "a", INPUTS["a"])
    put(spark, tmp_path, "b", INPUTS["b"])
    before, want = read_batches(spark, root), rows(spark, root)
    real = json.dumps

    def dying(value, *args, **options):
        if set(value) == {"epoch"}:
            raise RuntimeError("lost")
        return real(value, *args, **options)

    with monkeypatch.context() as m:
        m.setattr(module.json, "dumps", dying)
        with pytest.raises(RuntimeError):
            checkpoint_log(spark, root, 1)
    assert module._epoch(spark, root) == 0 and read_batches(spark, root) == before
    assert checkpoint_log(spark, root, 1)
    assert module._epoch(spark, root) == 1 and read_batches(spark, root) == before and rows(spark, root) == want
    assert not checkpoint_log(spark, root, 1)  # nothing new
    put(spark, tmp_path, "c", INPUTS["c"])
    assert checkpoint_log(spark, root, 1) and len(read_batches(spark, root)) == len(before) + 6
    assert stored_rows(spark, root, "main") == len(rows(spark, root)["main"])


def test_many_batches_are_joined_with_equal_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    more = [h.replace("gnomAD_genomes_AF", "gnomAD_genomes_AF|NEW") if "ID=CSQ" in h else h for h in HEADER]
    for name, lines in INPUTS.items():
        put(spark, tmp_path, name, lines, more if name == "b" else HEADER, on_duplicate="keep")
    ask = lambda: [sorted(map(str, query_variants(spark, root, k, samples="all", **p).collect())) for k, p in (("A", {"chrom": "chr1"}), ("D", {"existing_variation": "b13"}))]
    want, answers = rows(spark, root), ask()
    monkeypatch.setattr(module, "MAX_NAMED", 1)
    names = {b.batch for b in read_batches(spark, root)}
    for most in (module.MAX_BROADCAST, 0):  # broadcast, and not
        monkeypatch.setattr(module, "MAX_BROADCAST", most)
        assert rows(spark, root) == want and ask() == answers
    text = load_table(spark, root, "csq")._jdf.queryExecution().optimizedPlan().toString()
    assert len(names) == 3 and sum(n in text for n in names) <= 1  # the first, as a lower bound


def test_ten_thousand_batches(spark, tmp_path):
    """The log opens by its checkpoint, and a plan is as large for all of them as
    for a thousand."""
    size = {}
    schema = T.StructType.fromDDL("chrom string, pos int, id array<string>, ref string")
    for n in (1_000, 10_000):
        root = str(tmp_path / str(n))
        markers = [
            json.dumps({"table": "main", "input": f"i{i}", "identity": "x", "batch": f"{i:020d}-b", "schema": schema.json(), "rows": 1, "samples": [], "contigs": [{"chrom": f"chr{i % 20}", "low": i, "high": i}], "replaces": []})
            for i in range(n)
        ]
        folder = tmp_path / str(n) / module.INGEST_LOG / "m"
        folder.mkdir(parents=True)
        (folder / "part").write_text("\n".join(markers))
        stored = spark.createDataFrame([(f"chr{i % 20}", i, ["r"], "A", f"{i:020d}-b") for i in (0, 7, n - 1, n)], schema.add("batch", "string") if n == 1_000 else schema)
        stored.write.partitionBy("chrom", "batch").parquet(f"{root}/main")
        assert checkpoint_log(spark, root, 1)
        assert len(read_batches(spark, root)) == n and module._fresh(spark, root, 1) is None
        main = load_table(spark, root, "main")
        assert sorted(r["pos"] for r in main.collect()) == [0, 7, n - 1]  # the batch without a marker is not read
        size[n] = len(main._jdf.queryExecution().optimizedPlan().toString())
    assert size[10_000] <= size[1_000] + 100


def test_other_batches_are_pruned_by_the_join(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    for name, lines in INPUTS.items():
        put(spark, tmp_path, name, lines)
    monkeypatch.setattr(module, "MAX_NAMED", 0)
    text = load_table(spark, root, "main").where("chrom = 'chr2'")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text


def test_widest():
    ddl = T.DataType.fromDDL
    for a, b, want in (
        ("int", "int", "int"), ("int", "bigint", "bigint"), ("int", "double", "double"), ("float", "double", "double"), ("int", "array<int>", "array<int>"),
        ("array<int>", "array<double>", "array<double>"), ("double", "array<int>", "array<double>"), ("string", "array<string>", "array<string>"),
        ("bigint", "double", None), ("int", "string", None), ("array<string>", "int", None), ("boolean", "int", None), ("int", "float", None),
    ):
        for x, y in ((a, b), (b, a)):
            found = widest(ddl(x), ddl(y))
            assert (found and found.simpleString()) == want, (x, y)


def test_types_of_headers_widen(spark, tmp_path):
    """Integer, then Float, then a list: older rows read in the wider type."""
    floats = [h.replace("ID=AN,Number=1,Type=Integer", "ID=AN,Number=1,Type=Float").replace("ID=MIN_DP,Number=1", "ID=MIN_DP,Number=R") for h in HEADER]
    lists = [h.replace("ID=AN,Number=1,Type=Integer", "ID=AN,Number=.,Type=Integer") for h in HEADER]
    root = str(tmp_path / "store")
    put(spark, tmp_path, "a", [site("chr1", 1, "a1"), site("chr1", 2, "a2", "."), site("chr1", 3, "a3", "7")])
    put(spark, tmp_path, "b", [site("chr1", 3, "b3", "2.5"), site("chr1", 4, "b4", "3.5")], floats)
    an = lambda: {r["pos"]: r["an"] for r in query_variants(spark, root, "A", chrom="chr1").collect()}
    assert an() == {1: 2.0, 2: None, 3: 2.5, 4: 3.5}
    g = {(r["pos"], r["sampleId"]): r["MIN_DP"] for r in load_table(spark, root, "genotypes").collect()}
    assert g[1, "NA-1"] == [4] and g[3, "NA-2"] == [5]
    put(spark, tmp_path, "c", [site("chr1", 4, "c4", "5,6"), site("chr1", 9, "c9", "8")], lists)
    want = {1: [2.0], 2: None, 3: [2.5], 4: [5.0, 6.0], 9: [8.0]}
    assert an() == want
    before = rows(spark, root)
    compact(spark, root)
    assert an() == want and rows(spark, root) == before
    text = [h.replace("ID=AN,Number=1,Type=Integer", "ID=AN,Number=1,Type=String") for h in HEADER]
    with pytest.raises(SchemaConflictError):
        put(spark, tmp_path, "d", [site("chr1", 99, "d99", "x")], text)
    assert an() == want
    assert query_module.stored_extents(spark, root) == {"chr1": (1, 9)}
