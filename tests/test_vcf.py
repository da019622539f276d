import gzip

import pytest
from pyspark.sql import functions as F

from varlake.functions.names import NameCollisionError, csq_column_name, normalize_samples
from varlake.operators.genotypes import genotypes_long, genotypes_long_flat, genotypes_wide
from varlake.operators.project import csq_table, info_project, main_project
from varlake.plans.ingest import DuplicateSiteError, ingest
from varlake.sources.vcf import (
    VcfFormatError,
    open_vcf,
    parse_genotypes_long,
    parse_header,
    parse_vcf_lines,
    pos_one_based,
    read_vcf,
)

from vcf_fixture import AF_TEXT, FULL, HEADER, LINES, MISSING, NO_CSQ, line


@pytest.fixture(scope="module")
def header():
    return parse_header(HEADER)


def lines_df(spark, lines, with_header=False):
    rows = (HEADER if with_header else []) + lines
    return spark.createDataFrame([(r,) for r in rows], "value string")


@pytest.fixture(scope="module")
def scanned(spark, header):
    return parse_vcf_lines(lines_df(spark, LINES, with_header=True), header)


def by_pos(rows):
    return {r["start"] if "start" in r else r["pos"]: r for r in rows}


def test_header(header):
    assert [f.id for f in header.info] == ["AC", "AN", "BaseQRankSum", "DB", "RAW_MQ", "CSQ"]
    assert header.samples == ("NA-1", "NA-2")
    assert header.csq_fields[:3] == ("Allele", "Consequence", "SYMBOL")
    bq = [f for f in header.info if f.id == "BaseQRankSum"][0]
    assert bq.description == "Rank sum, with, commas"


def test_header_without_chrom_line():
    with pytest.raises(VcfFormatError):
        parse_header(HEADER[:-1])


def test_full_row(scanned):
    r = by_pos(scanned.collect())[99]
    assert r["contigName"] == "chr1" and r["start"] == 99
    assert r["names"] == ["rs1"] and r["alternateAlleles"] == ["G", "T"]
    assert r["qual"] == 50.5 and r["filters"] == ["PASS"]
    assert r["INFO_AC"] == [1, 2] and r["INFO_AN"] == 4 and r["INFO_DB"] is True
    assert r["INFO_BaseQRankSum"] == -0.5 and r["INFO_RAW_MQ"] == 60.0
    csq = r["INFO_CSQ"]
    assert len(csq) == 2
    assert csq[0]["Consequence"] == ["missense_variant", "splice_region_variant"]
    assert csq[0]["Existing_variation"] == ["rs1", "COSV1"]
    assert csq[1]["gnomAD_genomes_AF"] is None  # empty field
    g1, g2 = r["genotypes"]
    assert g1["sampleId"] == "NA-1" and g1["calls"] == [0, 1] and g1["alleleDepths"] == [3, 4]
    assert g1["depth"] == 7 and g1["phredLikelihoods"] == [0, 10, 100]
    assert g1["MIN_DP"] == 5 and g1["PID"] == "p1" and g1["PGT"] == "0|1"
    assert g2["calls"] == [-1, -1] and g2["phredLikelihoods"] is None and g2["PID"] is None


def test_missing_fields(scanned):
    r = by_pos(scanned.collect())[199]
    assert r["names"] == [] and r["alternateAlleles"] == [] and r["filters"] == []
    assert r["qual"] is None and r["INFO_AC"] is None and r["INFO_DB"] is False
    assert r["INFO_CSQ"] is None
    short = r["genotypes"][1]
    assert short["calls"] == [-1, -1] and short["depth"] is None and short["alleleDepths"] is None


def test_pos_one_based_and_projections(scanned, header):
    s = pos_one_based(scanned)
    main = by_pos(main_project(s).collect())
    assert set(main) == {100, 200, 300, 400}
    assert main[300]["filter"] == ["q10", "LowQual"]
    info = by_pos(info_project(s).collect())
    assert info[100]["ac"] == [1, 2] and info[300]["db"] is False
    csq = csq_table(s, header.csq_fields, "slim").collect()
    # sites without CSQ (200, 300) have no annotation rows
    assert sorted({r["pos"] for r in csq}) == [100, 400]
    assert len([r for r in csq if r["pos"] == 100]) == 2
    assert csq_table(s, header.csq_fields, "slim").columns == [
        "chrom", "pos", "csq_no", "allele", "consequence", "existing_variation",
        "gnomad_exomes_af", "gnomad_genomes_af", "symbol",
    ]


def test_genotype_maps_falsy_left_out(scanned):
    g = {(r["pos"], r["sample"]): r for r in genotypes_long(pos_one_based(scanned)).collect()}
    full1 = g[(100, "sna_1")]
    assert full1["int"] == {"min_dp": 5, "depth": 7}
    assert full1["text"] == {"pid": "p1", "pgt": "0|1"}
    assert full1["list_int"] == {"allele_depth": [3, 4], "calls": [0, 1], "plh": [0, 10, 100]}
    full2 = g[(100, "sna_2")]
    # zeros, '' and '.' are left out; [0, 0] is a non-empty list and stays
    assert full2["int"] == {} and full2["text"] == {}
    assert full2["list_int"] == {"allele_depth": [0, 0], "calls": [-1, -1]}
    short = g[(200, "sna_2")]
    assert short["int"] == {} and short["list_int"] == {"calls": [-1, -1]}


def test_no_fields_gives_empty_maps_not_null(spark, header):
    df = parse_vcf_lines(lines_df(spark, [line("chr9", 5, ".", "A", "C", 1, ".", ".", "DP", "0", ".")]), header)
    rows = genotypes_long(pos_one_based(df)).collect()
    assert all(r["int"] == {} and r["text"] == {} and r["list_int"] == {} for r in rows)


def test_long_paths_agree(spark, scanned, header):
    nested = genotypes_long(pos_one_based(scanned))
    direct = genotypes_long_flat(parse_genotypes_long(lines_df(spark, LINES, True), header))
    cols = ["chrom", "pos", "sample_index", "sample", "int", "text", "list_int"]
    key = lambda r: (r["pos"], r["sample_index"])
    assert sorted(map(lambda r: tuple(r[c] for c in cols), nested.collect()), key=str) == sorted(
        map(lambda r: tuple(r[c] for c in cols), direct.collect()), key=str
    )
    assert key  # keep the helper used


def test_long_and_wide_agree(scanned):
    s = pos_one_based(scanned)
    long = {(r["pos"], r["sample"]): r for r in genotypes_long(s).collect()}
    wide = genotypes_wide(s.withColumn("pos", F.col("start")), ["NA-1", "NA-2"], ["NA-1", "NA-2"], keep=("pos",))
    for r in wide.collect():
        for name in ("sna_1", "sna_2"):
            assert r[f"{name}_int"] == long[(r["pos"], name)]["int"]
            assert r[f"{name}_list_int"] == long[(r["pos"], name)]["list_int"]


def test_twelve_samples_keep_own_values(spark):
    """D1: later samples get their own data, not the first chunk's."""
    names = [f"S-{i}" for i in range(12)]
    hdr = parse_header(HEADER[:-1] + ["\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names])])
    df = parse_vcf_lines(lines_df(spark, [line("chr1", 1, ".", "A", "C", 1, ".", ".", "DP", *[i + 1 for i in range(12)])]), hdr)
    w = genotypes_wide(df, names[10:12], names).collect()[0]
    assert w["ss_10_int"] == {"depth": 11} and w["ss_11_int"] == {"depth": 12}
    sliced = parse_genotypes_long(lines_df(spark, [line("chr1", 1, ".", "A", "C", 1, ".", ".", "DP", *[i + 1 for i in range(12)])]), hdr, samples=(10, 12)).collect()
    assert [(r["sample_index"], r["sampleId"], r["depth"]) for r in sliced] == [(10, "S-10", 11), (11, "S-11", 12)]


def test_sample_name_collision():
    """D8: names that normalise alike are refused."""
    with pytest.raises(NameCollisionError):
        normalize_samples(["A-1", "A_1"])
    assert normalize_samples(["NA-12878"]) == ["sna_12878"]


def test_csq_name_rule():
    assert csq_column_name("GERP++_NR") == "gerpplusplus_nr"
    assert csq_column_name("hg18_pos(1-based)") == "hg18_pos_1_based"
    assert csq_column_name("Eigen-PC-raw_coding") == "eigen_pc_raw_coding"
    assert csq_column_name("1000Gp3_AC") == "csq_1000gp3_ac"
    assert csq_column_name("T-RExDB_X_GTF_TH_M") == "t_rexdb_x_gtf_th_m"
    assert csq_column_name("ref", {"ref", "alt"}) == "csq_ref"


def test_repeated_info_key_fails(spark, header):
    df = parse_vcf_lines(lines_df(spark, [line("chr1", 1, ".", "A", "C", 1, ".", "AC=1;AC=2", "GT", "0/1", "0/1")]), header)
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY|Duplicate map key"):
        df.select("INFO_AC").collect()


def _write_vcf(path, lines, gz=False):
    text = "\n".join(HEADER + lines) + "\n"
    if gz:
        # two gzip members, as block-gzip writes them
        half = len(text) // 2
        with open(path, "wb") as f:
            f.write(gzip.compress(text[:half].encode()))
            f.write(gzip.compress(text[half:].encode()))
    else:
        with open(path, "w") as f:
            f.write(text)


def test_files_plain_gzip_and_bgz(spark, tmp_path):
    plain = tmp_path / "a.vcf"
    _write_vcf(plain, LINES)
    gz = tmp_path / "b.vcf.gz"
    _write_vcf(gz, LINES, gz=True)
    a, _ = read_vcf(spark, str(plain))
    b, _ = read_vcf(spark, str(gz))
    cols = ["contigName", "start", "qual", "INFO_AC"]
    assert sorted(map(tuple, a.select(cols).collect()), key=str) == sorted(map(tuple, b.select(cols).collect()), key=str)
    assert a.count() == len(LINES)
    bgz = tmp_path / "c.vcf.bgz"
    _write_vcf(bgz, LINES, gz=True)
    c, _ = read_vcf(spark, str(bgz))
    assert sorted(map(tuple, c.select(cols).collect()), key=str) == sorted(map(tuple, a.select(cols).collect()), key=str)


def test_files_with_different_samples(spark, tmp_path):
    d = tmp_path / "multi"
    d.mkdir()
    _write_vcf(d / "a.vcf", [FULL])
    other = HEADER[:-1] + ["#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tX-9\tY-8"]
    (d / "b.vcf").write_text("\n".join(other + [NO_CSQ]) + "\n")
    src = open_vcf(spark, str(d))
    ids = {r["contigName"]: r["ids"] for r in src.sites().select("contigName", F.col("genotypes.sampleId").alias("ids")).collect()}
    assert ids == {"chr1": ["NA-1", "NA-2"], "chr2": ["X-9", "Y-8"]}
    long_ids = {(r["chrom"], r["sampleId"]) for r in src.genotypes().collect()}
    assert ("chr2", "Y-8") in long_ids and ("chr1", "NA-2") in long_ids
    staged = src.stage(str(tmp_path / "staged"))
    assert {(r["chrom"], r["sampleId"]) for r in staged.genotypes().collect()} == long_ids
    assert "genotypes" not in staged.sites().columns


def test_split_site_fails_unless_kept(spark, tmp_path):
    f = tmp_path / "dup.vcf"
    _write_vcf(f, [NO_CSQ, NO_CSQ.replace("rs3", "rs3b")])
    with pytest.raises(DuplicateSiteError):
        ingest(spark, str(f), str(tmp_path / "store1"))
    res = ingest(spark, str(f), str(tmp_path / "store2"), on_duplicate="keep")
    assert set(res.tables) == {"main", "info", "csq", "genotypes"}
    assert spark.read.parquet(res.tables["main"]).count() == 2


def test_af_text_compared_as_numbers(spark, header, tmp_path):
    """D6: '1.2e-05' passes < 0.01; '.', '' and '0.1&0.2' never do."""
    from varlake.plans.query import query_variants

    f = tmp_path / "af.vcf"
    _write_vcf(f, [AF_TEXT])
    root = str(tmp_path / "store")
    ingest(spark, str(f), root, profile="slim")
    out = query_variants(spark, root, "E", profile="slim", gnomad_exomes_af=0.01, gnomad_genomes_af=0.01).collect()
    assert [r["symbol"] for r in out] == ["G1"]


def test_stored_genotypes_give_the_same_maps(spark, tmp_path):
    from varlake.operators.genotypes import genotype_maps_view
    from varlake.plans.query import load_table

    f = tmp_path / "g.vcf"
    _write_vcf(f, [FULL, MISSING, NO_CSQ])
    root = str(tmp_path / "store")
    ingest(spark, str(f), root)
    stored = load_table(spark, root, "genotypes")
    assert {"depth", "calls", "MIN_DP", "sampleId"} <= set(stored.columns)
    view = {(r["pos"], r["sample"]): r for r in genotype_maps_view(stored).collect()}
    nested = read_vcf(spark, str(f))[0]
    for r in genotypes_long(pos_one_based(nested)).collect():
        v = view[(r["pos"], r["sample"])]
        assert (v["int"], v["text"], v["list_int"]) == (r["int"], r["text"], r["list_int"])


def test_query_with_sample_columns(spark, tmp_path):
    """The answer can carry the per-sample map columns of the site table."""
    from varlake.plans.query import query_variants

    f = tmp_path / "s.vcf"
    _write_vcf(f, [FULL, MISSING, NO_CSQ, AF_TEXT])
    root = str(tmp_path / "store")
    ingest(spark, str(f), root)
    nested = pos_one_based(read_vcf(spark, str(f))[0])
    wide = {r["start"]: r for r in genotypes_wide(nested, ["NA-1", "NA-2"], ["NA-1", "NA-2"], keep=("start",)).collect()}
    for kind, params, samples in (
        ("A", {"chrom": "chr1"}, ["NA-1", "NA-2"]),
        ("D", {"existing_variation": "rs1"}, ["NA-1", "NA-2"]),
        ("C", {"chrom": "chr1", "pos_start": 1, "pos_end": 500}, "all"),
    ):
        rows = query_variants(spark, root, kind, samples=samples, **params).collect()
        assert rows
        for r in rows:
            for col in ("sna_1_int", "sna_1_text", "sna_1_list_int", "sna_2_int", "sna_2_list_int"):
                assert r[col] == wide[r["pos"]][col]


def test_same_header_reads_one_header(spark, tmp_path):
    d = tmp_path / "split"
    d.mkdir()
    _write_vcf(d / "a.vcf", [FULL])
    _write_vcf(d / "b.vcf", [NO_CSQ])
    a, _ = read_vcf(spark, str(d))
    b, _ = read_vcf(spark, str(d), same_header=True)
    cols = ["contigName", "start", "INFO_AC"]
    assert sorted(map(tuple, a.select(cols).collect()), key=str) == sorted(map(tuple, b.select(cols).collect()), key=str)


def test_wide_csq_header(spark, tmp_path):
    """A CSQ header as wide as production VEP output (406 fields) parses,
    ingests and queries (past the 100-field whole-stage codegen limit)."""
    from varlake.plans.query import query_variants

    fields = ["Allele", "Consequence", "SYMBOL", "Existing_variation", "gnomAD_exomes_AF", "gnomAD_genomes_AF"]
    fields += [f"extra-field({i})" for i in range(406 - len(fields))]
    hdr = [h for h in HEADER if "ID=CSQ" not in h]
    hdr.insert(6, '##INFO=<ID=CSQ,Number=.,Type=String,Description="VEP. Format: ' + "|".join(fields) + '">')
    entry = "|".join(["G", "missense_variant", "GENE1", "rs9", "0.001", "0.002"] + [str(i) for i in range(400)])
    text = "\n".join(hdr + [line("chr1", 10, "rs9", "A", "G", 5, "PASS", f"AC=1;AN=2;CSQ={entry},{entry}", "GT", "0/1", "1/1")]) + "\n"
    f = tmp_path / "wide.vcf"
    f.write_text(text)
    root = str(tmp_path / "store")
    ingest(spark, str(f), root)
    out = query_variants(spark, root, "F", symbol="GENE1", consequence="missense_variant").collect()
    assert len(out) == 2
    assert out[0]["extra_field_399"] == "399" and out[0]["existing_variation"] == ["rs9"]
    nested, _ = read_vcf(spark, str(f))
    row = nested.select("INFO_CSQ").collect()[0][0]
    assert len(row) == 2 and row[0]["extra-field(0)"] == "0"


def test_staged_ingest_same_tables(spark, tmp_path):
    from varlake.plans.query import load_table

    f = tmp_path / "st.vcf.gz"
    _write_vcf(f, LINES, gz=True)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    ingest(spark, str(f), a, stage=True)
    ingest(spark, str(f), b, stage=False)
    for t in ("main", "info", "csq", "genotypes"):
        x, y = load_table(spark, a, t), load_table(spark, b, t)
        assert x.columns == y.columns
        assert sorted(map(str, x.collect())) == sorted(map(str, y.collect())), t


def test_command_line(spark, tmp_path, capsys):
    from varlake.__main__ import main

    f = tmp_path / "cli.vcf"
    _write_vcf(f, LINES)
    root = str(tmp_path / "store")
    assert main(["ingest", str(f), root]) == 0
    out = str(tmp_path / "answer")
    assert main(["query", root, "B", "--chrom", "chr1", "--pos", "100", "--samples", "NA-1", "--out", out]) == 0
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 2 and rows[0]["sna_1_int"] == {"min_dp": 5, "depth": 7}


def test_reader_options(spark, header):
    df = parse_vcf_lines(lines_df(spark, [FULL, MISSING]), header, flatten_info=False, include_sample_ids=False)
    assert "attributes" in df.columns and not any(c.startswith("INFO_") for c in df.columns)
    rows = by_pos(df.collect())
    assert rows[99]["attributes"]["AN"] == "4" and "DB" in rows[99]["attributes"]
    assert rows[199]["attributes"] is None
    assert "sampleId" not in df.schema["genotypes"].dataType.elementType.fieldNames()


TABLES = ("main", "info", "csq", "genotypes")


def _counts(spark, root):
    from varlake.plans.query import load_table

    return {t: load_table(spark, root, t).count() for t in TABLES}


def _with_samples(path, lines, samples):
    head = HEADER[:-1] + ["\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples])]
    path.write_text("\n".join(head + lines) + "\n")


def test_repeated_ingest_appends_nothing(spark, tmp_path):
    f = tmp_path / "twice.vcf"
    _write_vcf(f, LINES)
    root = str(tmp_path / "store")
    ingest(spark, str(f), root)
    counts = _counts(spark, root)
    ingest(spark, str(f), root)  # same input again, e.g. a retried run
    assert _counts(spark, root) == counts
    g = tmp_path / "other.vcf"
    _write_vcf(g, [NO_CSQ.replace("chr2\t300", "chr5\t301")])
    ingest(spark, str(g), root)  # a new input still adds
    assert _counts(spark, root)["main"] == counts["main"] + 1


def test_changed_file_replaces_its_rows(spark, tmp_path):
    f, root = tmp_path / "f.vcf", str(tmp_path / "store")
    _write_vcf(f, [FULL, MISSING])
    ingest(spark, str(f), root)
    _write_vcf(f, [FULL.replace("rs1\t", "rs1b\t"), NO_CSQ, AF_TEXT])
    ingest(spark, str(f), root)
    from varlake.plans.query import load_table

    assert {r["pos"]: r["id"] for r in load_table(spark, root, "main").collect()} == {100: ["rs1b"], 300: ["rs3"], 400: ["rs4"]}


def test_second_batch_on_known_sites_merges_by_key(spark, tmp_path):
    from varlake.plans.query import query_variants, stored_samples

    root = str(tmp_path / "store")
    _write_vcf(tmp_path / "a.vcf", [FULL, NO_CSQ])
    _with_samples(tmp_path / "b.vcf", [FULL.replace("50.5", "60.5"), MISSING], ["X-9", "Y-8"])
    ingest(spark, str(tmp_path / "a.vcf"), root)
    ingest(spark, str(tmp_path / "b.vcf"), root)
    rows = query_variants(spark, root, "B", chrom="chr1", pos=100, samples="all").collect()
    assert len(rows) == 2 and {r["qual"] for r in rows} == {60.5}
    assert stored_samples(spark, root) == ["NA-1", "NA-2", "X-9", "Y-8"]
    assert all(r["sna_1_int"] == r["sx_9_int"] == {"depth": 7, "min_dp": 5} for r in rows)
    counts = _counts(spark, root)
    assert counts["main"] == 3
    # an input list that overlaps what is stored
    ingest(spark, [str(tmp_path / "a.vcf"), str(tmp_path / "b.vcf")], root, on_duplicate="merge")
    assert _counts(spark, root) == counts
    assert len(query_variants(spark, root, "B", chrom="chr1", pos=100).collect()) == 2


def test_inputs_that_do_not_overlap_are_plain_scans(spark, tmp_path):
    from varlake.plans.query import load_table

    root = str(tmp_path / "store")
    for name, lines in (("a", [FULL, MISSING]), ("b", [NO_CSQ])):
        _write_vcf(tmp_path / f"{name}.vcf", lines)
        ingest(spark, str(tmp_path / f"{name}.vcf"), root)
    df = load_table(spark, root, "main")
    assert df.count() == 3 and "Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_new_annotation_and_format_fields_show_in_answers(spark, tmp_path):
    from varlake.operators.store import SchemaConflictError
    from varlake.plans.query import load_table, query_variants

    root = str(tmp_path / "store")
    _write_vcf(tmp_path / "a.vcf", [FULL])
    ingest(spark, str(tmp_path / "a.vcf"), root)
    more = [h.replace("gnomAD_genomes_AF", "gnomAD_genomes_AF|NEW") if "ID=CSQ" in h else h for h in HEADER]
    more.insert(-1, '##FORMAT=<ID=XX,Number=1,Type=Integer,Description="New">')
    new = line("chr1", 500, "rs7", "A", "G", 1, "PASS", "AC=1;AN=2;CSQ=G|m|BRCA1|rs7|0.1|0.2|fresh", "GT:XX", "0/1:4", "0/0:5")
    again = line("chr1", 100, "rs1", "A", "G", 1, "PASS", "AC=1;AN=2;CSQ=G|m|BRCA1|rs1|0.1|0.2|newer", "GT:XX", "0/1:4", "0/0:5")
    (tmp_path / "b.vcf").write_text("\n".join([*more, new, again]) + "\n")
    ingest(spark, str(tmp_path / "b.vcf"), root)
    rows = query_variants(spark, root, "A", chrom="chr1").collect()
    assert {(r["pos"], r["csq_no"]): r["new"] for r in rows} == {(500, 0): "fresh", (100, 0): "newer", (100, 1): None}
    g = {(r["pos"], r["sampleId"]): (r["XX"], r["MIN_DP"]) for r in load_table(spark, root, "genotypes").collect()}
    # the newer batch decides the columns that it has, MIN_DP among them
    assert g[100, "NA-1"] == (4, None) and g[500, "NA-2"] == (5, None)
    wrong = [h.replace("ID=AN,Number=1,Type=Integer", "ID=AN,Number=1,Type=String") for h in HEADER]
    (tmp_path / "c.vcf").write_text("\n".join([*wrong, NO_CSQ]) + "\n")
    with pytest.raises(SchemaConflictError):
        ingest(spark, str(tmp_path / "c.vcf"), root)


def test_death_between_write_and_mark(spark, tmp_path, monkeypatch):
    """Rows whose marker is missing don't count; a rerun writes what is
    not marked, and only that."""
    from varlake.plans import ingest as module

    f, root = tmp_path / "crash.vcf", str(tmp_path / "store")
    _write_vcf(f, LINES)
    real, marked = module.mark, []

    def dying(spark, root, b):
        if b.table in ("info", "csq"):
            raise RuntimeError("lost")
        marked.append((b.table, b.batch))
        real(spark, root, b)

    monkeypatch.setattr(module, "mark", dying)
    with pytest.raises(RuntimeError):
        ingest(spark, str(f), root, parallel=False)
    monkeypatch.setattr(module, "mark", real)
    ingest(spark, str(f), root)
    assert _counts(spark, root) == {"main": 4, "info": 4, "csq": 6, "genotypes": 8}
    from varlake.sources.batches import read_batches

    assert {(b.table, b.batch) for b in read_batches(spark, root)} >= {m for m in marked if m[0] == "genotypes"}


def test_stored_samples_can_be_chosen(spark, tmp_path):
    f, root = tmp_path / "f.vcf", str(tmp_path / "store")
    _write_vcf(f, LINES)
    ingest(spark, str(f), root, profile="slim", samples=["NA-2"])
    from varlake.plans.query import load_table, stored_samples

    assert {r["sampleId"] for r in load_table(spark, root, "genotypes", "slim").collect()} == {"NA-2"}
    assert stored_samples(spark, root, "slim") == ["NA-2"]


def test_compressed_text_is_spread(spark, tmp_path):
    f = tmp_path / "one.vcf.gz"
    _write_vcf(f, LINES, gz=True)
    assert open_vcf(spark, str(f)).parts[0][0].rdd.getNumPartitions() > 1


def test_variation_sites_cut_the_annotation_scan(spark, tmp_path):
    from varlake.plans.query import load_tables, query_variants, run_query
    from varlake.operators.filters import make_filter

    root = str(tmp_path / "store")
    for name, lines in (("a", [FULL, MISSING, AF_TEXT]), ("b", [FULL.replace("rs1&COSV1", "rs9"), NO_CSQ])):
        _write_vcf(tmp_path / f"{name}.vcf", lines)
        ingest(spark, str(tmp_path / f"{name}.vcf"), root)
    for variation, n in (("rs9", 1), ("COSV1", 0), ("rs2", 1), ("rs6", 1), ("none", 0)):
        got = query_variants(spark, root, "D", existing_variation=variation)
        plain = run_query(make_filter("D", existing_variation=variation), *load_tables(spark, root))
        assert got.count() == n and sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
