import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from varlake.operators.filters import make_filter
from varlake.operators.joins import annotate_join, hot_sites, positional_join, with_row_index
from varlake.operators.store import SchemaConflictError, schema_evolve, upsert_merge
from varlake.plans import standin
from varlake.plans.oracle import oracle_sql
from varlake.plans.query import query_variants, run_query
from varlake.plans.registry import PARAMS, flat, registry
from varlake.sources.tables import scan_table, write_table

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, rows):
    return sorted((tuple(_norm(r[c]) for c in sorted(cols)) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


# Spark type -> DuckDB type of the same column
_DUCK = {"StringType": "VARCHAR", "IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "BooleanType": "BOOLEAN"}

QUERIES = registry()
ORACLE = oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    rel = duck.sql(ORACLE[name])
    exp = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for f in df.schema.fields:
        assert _DUCK.get(type(f.dataType).__name__) == duck_types[f.name], (f.name, f.dataType, duck_types[f.name])
    assert _rows(df.columns, got) == _rows(df.columns, exp)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0
    assert "chrom" in df.columns and df.columns.count("pos") == 1


def _tables(spark, sf):
    return standin.v_main(spark, sf), standin.v_info(spark, sf), standin.v_csq(spark, sf)


@pytest.mark.parametrize("kind", list("ABCDEF"))
def test_semi_join_reduction_same_rows(spark, sf, kind):
    m, i, c = _tables(spark, sf)
    f = make_filter(kind, **PARAMS[kind])
    on = flat(run_query(f, m, i, c, reduce_sites=True)).collect()
    off = flat(run_query(f, m, i, c, reduce_sites=False)).collect()
    assert sorted(map(tuple, on), key=str) == sorted(map(tuple, off), key=str)


def test_unknown_kind_raises():
    """D11: an unknown command is an error, not the previous query."""
    with pytest.raises(ValueError):
        make_filter("G", chrom="chr1")
    with pytest.raises(ValueError):
        make_filter("B", chrom="chr1")  # pos missing


def test_f_tests_consequence_not_variation(spark, sf):
    """D3: F filters on consequence."""
    m, i, c = _tables(spark, sf)
    rows = run_query(make_filter("F", symbol="Brand#4", consequence="ring"), m, i, c).collect()
    assert rows and all("ring" in r["consequence"] and r["symbol"] == "Brand#4" for r in rows)


def test_single_key_columns_from_csq(spark, sf):
    """D4, D7: one chrom and one pos, taken from the annotation side, so
    annotations of sites missing from main keep their key."""
    m, i, c = _tables(spark, sf)
    out = annotate_join(c, m, i)
    assert out.columns.count("chrom") == 1 and out.columns.count("pos") == 1
    unmatched = out.where(F.col("id").isNull())
    assert unmatched.count() > 0
    assert unmatched.where(F.col("chrom").isNull() | F.col("pos").isNull()).count() == 0


def test_clashing_csq_columns_prefixed(spark, sf):
    """D5: csq ref/alt do not collide with the site table's."""
    m, i, c = _tables(spark, sf)
    out = annotate_join(c.withColumn("ref", F.lit("x")).withColumn("alt", F.lit("y")), m, i)
    assert {"csq_ref", "csq_alt", "ref", "alt"} <= set(out.columns)
    assert len(out.columns) == len(set(out.columns))


def test_upsert_twice_changes_nothing(spark, sf):
    m = standin.v_main(spark, sf)
    old = m.where(F.col("ref").isin("F", "O")).select("chrom", "pos", "id", "ref", "qual")
    new = m.where(F.col("ref").isin("O", "P")).select("chrom", "pos", F.lower("ref").alias("ref"), "alt")
    once = flat(upsert_merge(old, new))
    twice = flat(upsert_merge(upsert_merge(old, new), new))
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_schema_evolve_conflict(spark, sf):
    m = standin.v_main(spark, sf)
    with pytest.raises(SchemaConflictError):
        schema_evolve(m, {"qual": "string"})
    assert "s_new_int" in schema_evolve(m, {"s_new_int": "map<string,int>"}).columns


@pytest.mark.parametrize("parts", [4, 8, 16, 32])
def test_row_index_matches_row_number(spark, sf, parts):
    """All columns collected, so that no pruned copy of the plan hides a
    difference; more rows than a range sample holds."""
    o = standin.load(spark, sf.replace("sf0.001", "sf0.01"), "orders")
    want = [k for k, _ in sorted(((r["o_orderkey"], r["o_totalprice"]) for r in o.collect()), key=lambda r: (r[1], r[0]))]
    for _ in range(3):
        rows = with_row_index(o, ["o_totalprice", "o_orderkey"], num_partitions=parts).collect()
        assert [r["o_orderkey"] for r in sorted(rows, key=lambda r: r["row_index"])] == want
        assert sorted(r["row_index"] for r in rows) == list(range(1, len(want) + 1))


@pytest.mark.parametrize("name", ["positional_join", "main_info_join", "query_c", "ingest_two_batches"])
def test_query_matches_oracle_on_more_rows(spark, sf, name):
    big = sf.replace("sf0.001", "sf0.01")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{big}/{t}.parquet')")
    df = QUERIES[name](spark, big)
    rel = con.sql(ORACLE[name])
    exp = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert _rows(df.columns, df.collect()) == _rows(df.columns, exp)


def test_positional_join_refuses_constant_order(spark, sf):
    o = standin.load(spark, sf, "orders").select("o_orderkey")
    c = standin.load(spark, sf, "customer").select("c_custkey")
    with pytest.raises(ValueError):
        positional_join(o, c, [], ["c_custkey"])


def test_store_roundtrip_and_pruning(spark, sf, tmp_path):
    root = str(tmp_path / "store")
    m, i, c = _tables(spark, sf)
    for name, df in (("main", m), ("info", i), ("csq", c)):
        write_table(df, root, name, cluster=True)
    out = query_variants(spark, root, "C", chrom="chr7", pos_start=100, pos_end=2000)
    exp = run_query(make_filter("C", **PARAMS["C"]), m, i, c)
    assert sorted(map(tuple, flat(out).collect()), key=str) == sorted(map(tuple, flat(exp).collect()), key=str)
    plan = scan_table(spark, root, "csq").where(F.col("chrom") == "chr7").where(F.col("pos") == 28)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chrom" in plan and "PushedFilters: [IsNotNull(pos), EqualTo(pos,28)]" in plan


@pytest.mark.parametrize("kind", list("ADEF"))
def test_each_annotation_row_once(spark, sf, kind):
    """With (chrom, pos) unique in main and info, every filtered csq row
    appears exactly once in the answer, matched or not."""
    m, i, c = _tables(spark, sf)
    f = make_filter(kind, **PARAMS[kind])
    out = flat(run_query(f, m, i, c)).drop(*[x for x in m.columns + i.columns if x not in ("chrom", "pos")])
    expected = flat(c.where(f.predicate))
    assert out.count() == expected.count()
    assert sorted(map(tuple, out.select(*expected.columns).collect()), key=str) == sorted(
        map(tuple, expected.collect()), key=str
    )


def test_numeric_contigs_stay_text(spark, tmp_path):
    root = str(tmp_path / "store")
    df = spark.createDataFrame([("01", 5, "x"), ("2", 6, "y")], "chrom string, pos int, v string")
    write_table(df, root, "t")
    got = {(r["chrom"], r["pos"]) for r in scan_table(spark, root, "t").collect()}
    assert got == {("01", 5), ("2", 6)}
    assert scan_table(spark, root, "t").columns[0] == "chrom"


def test_hot_site_is_salted_with_same_rows(spark, sf):
    """A third of the annotation rows on one site: the salted join splits
    that site over tasks and returns the rows of the plain join."""
    m, i, c = _tables(spark, sf)
    h = F.xxhash64("pos", "allele", "symbol", "existing_variation") % 3 == 0
    hot = c.withColumn("chrom", F.when(h, F.lit("chr1")).otherwise(F.col("chrom"))).withColumn(
        "pos", F.when(h, F.lit(0)).otherwise(F.col("pos"))
    )
    sites = hot_sites(hot, rows=100)
    assert sites.count() == 1
    salted = flat(annotate_join(hot, m, i, hot=sites, rows_per_task=100)).collect()
    plain = flat(annotate_join(hot, m, i)).collect()
    assert len(salted) == hot.count()
    assert sorted(map(tuple, salted), key=str) == sorted(map(tuple, plain), key=str)


def test_queries_read_the_annotations_once(spark, sf):
    m, i, c = _tables(spark, sf)
    plan = run_query(make_filter("A", **PARAMS["A"]), m, i, c)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") > 0 and plan.count("Join Inner, (l_partkey") == 1
