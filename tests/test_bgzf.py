"""Block-gzip in ranges, and broken lines."""

import gzip
import struct
import zlib

import numpy as np
import pytest
from vcf_fixture import HEADER, line

from varlake.plans.ingest import ingest
from varlake.plans.query import load_table
from varlake.sources import bgzf
from varlake.sources.bgzf import gzip_lines, gzip_ranges, range_lines
from varlake.sources.vcf import line_fault, open_vcf, read_vcf


def member(data):
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def packed(data, sizes):
    out, at = [], 0
    while at < len(data):
        n = next(sizes)
        out.append(member(data[at : at + n]))
        at += n
    return b"".join(out) + member(b"")


class Opened:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at : at + n]


def all_ranges(data, step):
    f = Opened(data)
    return [x for a in range(0, max(1, len(data)), step) for x in range_lines(f, len(data), a, a + step)]


@pytest.mark.parametrize("seed", range(6))
def test_ranges_give_each_line_once(seed):
    random = np.random.default_rng(seed)
    lines = [bytes(random.integers(32, 126, random.choice([0, 5, 40, 3000]), dtype=np.uint8)) for _ in range(300)]
    text = b"\n".join(lines) + (b"\n" if seed % 2 else b"")
    want = text.split(b"\n")[: len(lines)] if lines[-1] or seed % 2 else lines[:-1]
    sizes = iter(lambda: int(random.choice([1, 7, 100, 2000, 60_000])), None)
    data = packed(text, sizes)
    for step in (1, 50, 700, 5_000, len(data) // 2 + 1, len(data) + 9):
        if step > 1 or seed == 0:
            assert all_ranges(data, step) == want
    # blocks that end with their lines
    data = b"".join(member(x + b"\n") for x in lines) + member(b"")
    assert all_ranges(data, 333) == lines


def test_bytes_like_a_member_inside_one_don_t_count():
    fake = bgzf.MEMBER + b"\0" * 6 + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, 40)
    noise = np.random.default_rng(1).integers(0, 256, 30_000, dtype=np.uint8).tobytes().replace(b"\n", b"x")
    stored = zlib.compressobj(0, zlib.DEFLATED, -15)  # content as it is
    body = stored.compress(noise + fake * 20 + b"\nnext\n") + stored.flush()
    raw = noise + fake * 20 + b"\nnext\n"
    block = struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(raw), len(raw))
    data = member(b"first\n") + block + member(b"last\n") + member(b"")
    for step in (100, 30_100, 1 << 20):
        assert all_ranges(data, step) == [b"first", *raw.split(b"\n")[:2], b"last"]


def test_other_gzip_files_and_damage():
    text = b"a\nb\n" * 50_000
    for data in (gzip.compress(text), gzip.compress(text[:7]) + gzip.compress(text[7:])):
        assert all_ranges(data, 1000) == text.split(b"\n")[:-1]
        with pytest.raises(ValueError, match="ends inside"):
            all_ranges(data[:-20], 1 << 30)
    assert all_ranges(b"", 10) == []
    data = packed(text, iter(lambda: 30_000, None))
    with pytest.raises(ValueError):
        all_ranges(data[:-40], 1 << 30)
    broken = bytearray(data)
    broken[100] ^= 255
    with pytest.raises((ValueError, zlib.error)):
        all_ranges(bytes(broken), 1 << 30)


def test_one_file_gives_several_tasks(spark, tmp_path):
    lines = [line("chr1", p, f"rs{p}", "A", "G", 1.0, "PASS", "AC=1;AN=2", "GT", "0/1", "0/0") for p in range(1, 3000)]
    text = "\n".join([*HEADER, *lines]) + "\n"
    (tmp_path / "a.vcf").write_text(text)
    for name in ("a.vcf.gz", "b c.vcf.bgz"):
        (tmp_path / name).write_bytes(packed(text.encode(), iter(lambda: 4_000, None)))
    want = sorted(map(str, read_vcf(spark, str(tmp_path / "a.vcf"))[0].collect()))
    for name in ("a.vcf.gz", "b c.vcf.bgz"):
        src = open_vcf(spark, str(tmp_path / name), range_bytes=2_000)
        assert src.parts[0][0].rdd.getNumPartitions() > 3
        assert sorted(map(str, src.sites().collect())) == want
    both, _ = read_vcf(spark, [str(tmp_path / "a.vcf"), str(tmp_path / "a.vcf.gz")], range_bytes=3_000)
    assert both.count() == 2 * len(lines)
    head = gzip_lines(gzip_ranges(spark, [str(tmp_path / "a.vcf.gz")], 500), header_only=True)
    assert [r["value"] for r in head.collect()] == HEADER
    assert not bgzf.can_open("nothing://a/b")


SOUND = line("chr1", 100, "rs1", "A", "G", 1.0, "PASS", "AC=1;AN=2", "GT", "0/1", "0/0")
BROKEN = {"chr1\t200\trs2\tA": "4 fields instead of 8 or more", SOUND.replace("\t100\t", "\tabc\t"): "position abc", "no tabs at all": "1 fields instead of 8 or more", SOUND[4:]: "no contig"}


def test_faults(spark):
    df = spark.createDataFrame([(x,) for x in [*BROKEN, SOUND, "#c", ""]], "value string")
    got = {r["value"]: r["f"] for r in df.select("value", line_fault(df.value).alias("f")).collect()}
    assert got == {**BROKEN, SOUND: None, "#c": None, "": None}


def test_broken_lines(spark, tmp_path):
    """They end the ingest by default, before anything counts; or go to a table
    of their own; or are kept as they are."""
    f = tmp_path / "broken.vcf"
    f.write_text("\n".join([*HEADER, SOUND, *BROKEN]) + "\n")
    root = str(tmp_path / "store")
    with pytest.raises(Exception, match="broken VCF line"):
        ingest(spark, str(f), root)
    with pytest.raises(Exception, match="broken VCF line"):
        read_vcf(spark, str(f))[0].collect()
    for _ in range(2):
        ingest(spark, str(f), root, on_bad_line="drop")
        assert [r["pos"] for r in load_table(spark, root, "main").collect()] == [100]
        bad = spark.read.parquet(f"{root}/bad_lines").collect()
        assert {r["line"]: r["reason"] for r in bad} == BROKEN and len(bad) == len(BROKEN)
        assert {r["file_path"].rsplit("/", 1)[1] for r in bad} == {"broken.vcf"}
    assert read_vcf(spark, str(f), on_bad_line="keep")[0].count() == 1 + len(BROKEN)
    with pytest.raises(ValueError, match="on_bad_line"):
        read_vcf(spark, str(f), on_bad_line="other")
