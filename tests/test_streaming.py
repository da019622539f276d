from pyspark.sql import functions as F

from varlake.plans.query import query_variants
from varlake.streaming.ingest_stream import start_ingest_stream, stream_tables, write_batch

from vcf_fixture import AF_TEXT, FULL, HEADER, MISSING, NO_CSQ


def _write(path, lines):
    path.write_text("\n".join(HEADER + lines) + "\n")


def test_stream_ingests_new_files(spark, tmp_path):
    inp = tmp_path / "in"
    inp.mkdir()
    root, ckpt = str(tmp_path / "store"), str(tmp_path / "ckpt")
    _write(inp / "a.vcf", [FULL, MISSING])
    q = start_ingest_stream(spark, str(inp), root, ckpt, trigger={"availableNow": True})
    q.awaitTermination(300)
    _write(inp / "b.vcf", [NO_CSQ, AF_TEXT])
    q = start_ingest_stream(spark, str(inp), root, ckpt, trigger={"availableNow": True})
    q.awaitTermination(300)
    t = stream_tables(spark, root)
    assert sorted(r["pos"] for r in t["main"].collect()) == [100, 200, 300, 400]
    assert t["csq"].count() == 6  # 2 annotations at 100, 4 at 400
    assert t["genotypes"].count() == 8


def test_retried_batch_replaces_its_output(spark, tmp_path):
    lines = spark.createDataFrame([(v, "file:/x/a.vcf") for v in HEADER + [FULL, NO_CSQ]], "value string, file_path string")
    root = str(tmp_path / "store")
    write_batch(lines, 7, root)
    write_batch(lines, 7, root)  # same batch again, as after a failure
    t = stream_tables(spark, root)
    assert t["main"].count() == 2
    assert t["main"].where(F.col("pos") == 100).count() == 1


def test_same_lines_in_two_batches_count_once(spark, tmp_path):
    root = str(tmp_path / "store")
    for i, name in enumerate("ab"):
        write_batch(spark.createDataFrame([(v, f"file:/x/{name}.vcf") for v in HEADER + [FULL, FULL, NO_CSQ]], "value string, file_path string"), i, root)
    t = stream_tables(spark, root)
    assert [t[n].count() for n in ("main", "info", "csq", "genotypes")] == [2, 2, 2, 4]
    rows = query_variants(spark, root, "B", chrom="chr1", pos=100, samples="all").collect()
    assert len(rows) == 2 and all(r["sna_1_int"] == {"depth": 7, "min_dp": 5} for r in rows)
