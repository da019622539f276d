"""Steps that a large input runs through: rendering, explodes, ranges of staged lines."""

from pyspark.sql import functions as F

from varlake.functions.names import sample_column_expr, sample_column_name
from varlake.plans import standin
from varlake.sources import vcf
from varlake.sources.vcf import exploded


def test_sample_fields_of_any_key(spark):
    keys = [0, 1, 4619, 4620, 4621, 9240 * 7 + 5, 4620 * 3 + 11, -1, -4621, None]
    o = spark.createDataFrame([(k, s) for k in keys for s in ("P", "F", "O", None)], "o_orderkey long, o_orderstatus string")
    text = f"array_join(transform(sequence(0, {standin.N_SAMPLES - 1}), i -> {standin._sample('i')}), '\\t')"
    got = standin.with_sample_fields(o).withColumn("want", F.expr(text)).collect()
    assert len(got) == 4 * len(keys)
    assert all(r["sample_fields"] == r["want"] for r in got)


def test_explode_builds_arrays_once(spark):
    df = spark.createDataFrame([(1, "a,b"), (2, None), (3, "")], "k int, t string")
    items = F.when(F.col("t") != "", F.split("t", ","))
    out = exploded(df, ["k"], items, "n", "x")
    assert sorted(map(tuple, out.collect())) == [(1, 0, "a"), (1, 1, "b")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and "size(" not in plan


def test_staged_lines_are_dealt_in_ranges(spark, monkeypatch):
    lines = spark.range(3000).selectExpr("concat('chr', id % 3, '\\t', id, '\\tx') AS value").coalesce(1)
    assert vcf._in_ranges(lines, 36_000) is lines
    monkeypatch.setattr(vcf, "FIELDS_PER_TASK", 3000)
    dealt = vcf._in_ranges(lines, 36_000)
    assert sorted(r[0] for r in dealt.collect()) == sorted(r[0] for r in lines.collect())
    part = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.countDistinct(F.split("value", "\t", 2)[0]).alias("c")).collect()
    assert len(part) >= 10 and max(r["n"] for r in part) < 600 and max(r["c"] for r in part) <= 2


def test_sample_names(spark):
    names = ["NA-00", "Ünï-X", "a_B", "", "İ-1"]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    assert [r[0] for r in df.select(sample_column_expr(F.col("s"))).collect()] == [sample_column_name(n) for n in names]
