"""Wide genotype columns of a stored table."""

import time

from varlake.operators.genotypes import genotype_maps_view, stored_wide

SCHEMA = "chrom string, pos int, sample_index int, sampleId string, depth int, MIN_DP int, PID string, alleleDepths array<int>"
KINDS = ("int", "text", "list_int")


def brute(spark, df, samples):
    """Maps per (site, sample) from the long view, put side by side."""
    long = {}
    for r in genotype_maps_view(df).collect():
        long.setdefault((r["chrom"], r["pos"]), {})[r["sample"]] = tuple(r[k] for k in KINDS)
    names = {s: "s" + s.lower().replace("-", "_") for s in samples}
    wanted = {r["sampleId"] for r in df.collect()}
    asked = {(r["chrom"], r["pos"]) for r in df.where(df.sampleId.isin(list(samples))).collect()}
    assert wanted
    return {site: [long[site].get(names[s], ({}, {}, {})) for s in samples] for site in asked}


def wide(df, samples):
    out = {}
    for r in stored_wide(df, samples).collect():
        names = ["s" + s.lower().replace("-", "_") for s in samples]
        out[r["chrom"], r["pos"]] = [tuple(r[f"{n}_{k}"] for k in KINDS) for n in names]
    return out


def test_wide_equals_long(spark):
    rows = [("1", p, i, f"NA-{i}", p * i % 5, i, f"p{i}" if i % 2 else "", [p, i] if i != 3 else None) for p in range(1, 40) for i in range(6) if (p + i) % 4 or p == 8]
    df = spark.createDataFrame(rows + [("2", 1, 0, "other", 1, 1, "", [])], SCHEMA).repartition(5)
    for samples in (["NA-0"], ["NA-5", "NA-1", "absent", "NA-3"], [f"NA-{i}" for i in range(6)]):
        assert wide(df, samples) == brute(spark, df, samples)
    assert wide(df.limit(0), ["NA-0"]) == {}


def test_repeated_rows_count_once(spark):
    rows = [("1", 1, 0, "a", d, 0, "", [d]) for d in (7, 3, 9)] + [("1", 1, 1, "b", 2, 0, "", None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert wide(df, ["a", "b"]) == {("1", 1): [({"depth": 3}, {}, {"allele_depth": [3]}), ({"depth": 2}, {}, {})]}


def test_thousands_of_samples(spark):
    """The plan has two aggregates whatever the number of samples."""
    n = 2_000
    df = spark.range(3 * n).selectExpr(
        "'1' AS chrom", f"cast(id DIV {n} AS int) AS pos", f"cast(id % {n} AS int) AS sample_index", f"concat('N', id % {n}) AS sampleId", "cast(id AS int) AS depth", "0 AS MIN_DP", "'' AS PID", "array(1, 2) AS alleleDepths"
    )
    start = time.perf_counter()
    got = stored_wide(df, [f"N{i}" for i in range(n)])
    assert len(got.columns) == 2 + 3 * n
    assert [(r["pos"], r["sn7_int"], r["sn1999_int"]["depth"]) for r in got.select("pos", "sn7_int", "sn1999_int").orderBy("pos").collect()] == [(p, {"depth": p * n + 7}, p * n + 1999) for p in range(3)]
    assert time.perf_counter() - start < 60
