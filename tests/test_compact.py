"""Overlapping batches: the sweep, merges on read, compaction."""

import itertools

import numpy as np
import pytest
from vcf_fixture import HEADER, line

from varlake.plans import ingest as ingest_module
from varlake.plans.compact import compact
from varlake.plans.ingest import ingest
from varlake.plans.query import load_table, query_variants, stored_extents, stored_rows, stored_samples
from varlake.sources import batches as module
from varlake.sources.batches import Batch, read_batches, shared_ranges

TABLES = ("main", "info", "csq", "genotypes")


def site(chrom, pos, name, qual=1.0):
    return line(chrom, pos, name, "A", "G", qual, "PASS", f"AC=1;AN=2;CSQ=G|m|GENE{pos % 7}|{name}|0.1|0.2", "GT:MIN_DP", "0/1:4", "0/0:5")


def store(spark, tmp_path, *inputs, **options):
    root = str(tmp_path / "store")
    for i, lines in enumerate(inputs):
        f = tmp_path / f"{i}.vcf"
        f.write_text("\n".join([*HEADER, *lines]) + "\n")
        ingest(spark, str(f), root, **options)
    return root


def rows(spark, root):
    return {t: sorted(map(str, load_table(spark, root, t).collect())) for t in TABLES}


def batch(**contigs):
    return Batch("main", "", "", "", None, 0, (), contigs)


def test_sweep_equals_counting_positions():
    random = np.random.default_rng(5)
    for _ in range(300):
        own = []
        for _ in range(random.integers(0, 6)):
            ends = np.sort(random.integers(0, 30, 2)).tolist()
            own.append(batch(a=tuple(ends)) if random.random() < 0.8 else batch(b=tuple(ends)))
        found = {c: [p for low, high in r for p in range(low, high + 1)] for c, r in shared_ranges(own).items()}
        for c in "ab":
            covered = [sum(x.contigs[c][0] <= p <= x.contigs[c][1] for x in own if c in x.contigs) for p in range(31)]
            assert found.get(c, []) == [p for p, n in enumerate(covered) if n > 1]
    assert shared_ranges([batch(a=(None, None)), batch(a=(1, 2))]) == {}


def test_ranges_are_joined_until_few(monkeypatch):
    own = {"a": [(1, 2), (5, 6), (100, 101), (103, 104)], "b": [(1, 1)]}
    for most, want in ((64, own), (3, {"a": [(1, 6), (100, 104)], "b": [(1, 1)]}), (1, {"a": [(1, 104)], "b": [(1, 1)]})):
        monkeypatch.setattr(module, "MAX_RANGES", most)
        assert module._fewer(own) == want


def test_only_shared_positions_are_grouped(spark, tmp_path):
    """Duplicates that 'keep' stored stay where no other batch is; one contig is merged, the other scanned."""
    first = [site("chr1", 10, "rs1"), site("chr1", 10, "rs2"), site("chr1", 50, "rs3"), site("chr1", 90, "rs4"), site("chr2", 5, "rs5")]
    root = store(spark, tmp_path, first, [site("chr1", 50, "rs3b", 9.0), site("chr1", 70, "rs6")], on_duplicate="keep")
    main = load_table(spark, root, "main")
    assert sorted((r["chrom"], r["pos"], r["id"][0]) for r in main.collect()) == [
        ("chr1", 10, "rs1"), ("chr1", 10, "rs2"), ("chr1", 50, "rs3b"), ("chr1", 70, "rs6"), ("chr1", 90, "rs4"), ("chr2", 5, "rs5"),
    ]
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan(main) and "Aggregate" not in plan(main.where("chrom = 'chr2'"))
    assert stored_extents(spark, root) == {"chr1": (10, 90), "chr2": (5, 5)}
    assert stored_rows(spark, root, "main") == 6


def test_rows_are_equal_before_and_after(spark, tmp_path):
    inputs = [[site("chr1", p, f"a{p}") for p in range(1, 40, 2)], [site("chr1", p, f"b{p}", 2.0) for p in range(20, 60, 3)], [site("chr2", p, f"c{p}") for p in range(1, 9)]]
    root = store(spark, tmp_path, *inputs)
    before = rows(spark, root)
    asked = [sorted(map(str, query_variants(spark, root, *q, **p).collect())) for q, p in ((("D",), {"existing_variation": "b20"}), (("A",), {"chrom": "chr1"}))]
    assert compact(spark, root) == dict.fromkeys(TABLES, 2)
    assert rows(spark, root) == before
    assert [sorted(map(str, query_variants(spark, root, *q, **p).collect())) for q, p in ((("D",), {"existing_variation": "b20"}), (("A",), {"chrom": "chr1"}))] == asked
    assert "Aggregate" not in load_table(spark, root, "csq")._jdf.queryExecution().optimizedPlan().toString()
    assert {t: stored_rows(spark, root, t) for t in TABLES} == {t: len(r) for t, r in before.items()}
    assert stored_samples(spark, root) == ["NA-1", "NA-2"]
    assert compact(spark, root) == {}
    # the inputs count as stored, and a new one is merged over the compacted rows
    for i in range(len(inputs)):
        ingest(spark, str(tmp_path / f"{i}.vcf"), root)
    assert rows(spark, root) == before
    (tmp_path / "new.vcf").write_text("\n".join([*HEADER, site("chr1", 20, "d20"), site("chr2", 100, "d100")]) + "\n")
    ingest(spark, str(tmp_path / "new.vcf"), root)
    ids = {(r["chrom"], r["pos"]): r["id"][0] for r in load_table(spark, root, "main").collect()}
    assert ids["chr1", 20] == "d20" and ids["chr2", 100] == "d100" and ids["chr1", 23] == "b23"
    assert compact(spark, root) == dict.fromkeys(TABLES, 2)  # chr1 of the compacted and the new; nothing else has position 100 of chr2
    assert {(r["chrom"], r["pos"]): r["id"][0] for r in load_table(spark, root, "main").collect()} == ids


def test_compaction_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    root = store(spark, tmp_path, [site("chr1", 1, "a"), site("chr1", 9, "b")], [site("chr1", 9, "c")])
    before = rows(spark, root)
    real = ingest_module.mark

    def dying(spark, root, b):
        if b.table == "info":
            raise RuntimeError("lost")
        real(spark, root, b)

    monkeypatch.setattr(ingest_module, "mark", dying)
    with pytest.raises(RuntimeError):
        compact(spark, root)
    assert rows(spark, root) == before
    monkeypatch.setattr(ingest_module, "mark", real)
    assert compact(spark, root).keys() == {"info", "main"}
    assert rows(spark, root) == before


def test_unmarked_batches_are_never_read(spark, tmp_path, monkeypatch):
    """A first ingest that dies before its first mark leaves empty tables; one
    that dies later leaves those that it has not marked empty."""
    real = ingest_module.mark
    for n, dies_at in enumerate(("genotypes", "main")):
        def dying(spark, root, b, dies_at=dies_at):
            if b.table == dies_at:
                raise RuntimeError("lost")
            real(spark, root, b)

        folder = tmp_path / str(n)
        folder.mkdir()
        monkeypatch.setattr(ingest_module, "mark", dying)
        with pytest.raises(RuntimeError):
            store(spark, folder, [site("chr1", 1, "a")], parallel=False)
        df = load_table(spark, str(folder / "store"), dies_at)
        assert df.count() == 0 and "batch" not in df.columns
        assert read_batches(spark, str(folder / "store")) == [] or dies_at == "main"
        monkeypatch.setattr(ingest_module, "mark", real)
        store(spark, folder, [site("chr1", 1, "a")])
        assert load_table(spark, str(folder / "store"), dies_at).count() > 0


def test_unknown_profile(spark, tmp_path):
    with pytest.raises(ValueError, match="profile"):
        compact(spark, str(tmp_path), "other")
    assert list(itertools.chain(*shared_ranges([]).values())) == []
