"""DuckDB SQL for each registered query (the correctness oracle).

The stand-in views are CTEs over the driver tables, with the same meaning
as :mod:`varlake.plans.standin`.  VCF-derived queries are checked against
the values the rendered lines encode, computed from ``orders`` directly.
Arrays come out as ','-joined text and maps as 'k=v;k=v' with sorted
keys, as ``registry.flat`` renders them.
"""

from __future__ import annotations

CHROM = "'chr' || CAST({k} % 22 + 1 AS VARCHAR)"

V_MAIN = f"""v_main AS (
  SELECT {CHROM.format(k='o_orderkey')} AS chrom,
         CAST(o_orderkey AS INTEGER) AS pos,
         ['rs' || CAST(o_orderkey AS VARCHAR)] AS id,
         o_orderstatus AS ref,
         [substr(o_orderpriority, 1, 1)] AS alt,
         o_totalprice AS qual,
         [CASE WHEN o_orderstatus = 'F' THEN 'PASS' ELSE 'LowQual' END] AS "filter"
  FROM orders)"""

V_INFO = f"""v_info AS (
  SELECT {CHROM.format(k='o_orderkey')} AS chrom,
         CAST(o_orderkey AS INTEGER) AS pos,
         [CAST(o_custkey % 5 AS INTEGER)] AS ac,
         CAST(10 AS INTEGER) AS an,
         o_totalprice / CAST(1000.0 AS DOUBLE) AS baseqranksum,
         o_orderstatus = 'F' AS db,
         CAST(o_custkey AS DOUBLE) AS raw_mq
  FROM orders WHERE o_orderstatus <> 'P')"""

V_CSQ = f"""v_csq AS (
  SELECT {CHROM.format(k='l_orderkey')} AS chrom,
         CAST(l_orderkey AS INTEGER) AS pos,
         l_returnflag AS allele,
         string_split(p_name, ' ') AS consequence,
         ['rs' || CAST(l_partkey AS VARCHAR), 'COSV' || CAST(l_suppkey AS VARCHAR)] AS existing_variation,
         CASE WHEN l_quantity < 5 THEN NULL ELSE l_discount END AS gnomad_exomes_af,
         l_tax AS gnomad_genomes_af,
         p_brand AS symbol
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _with(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


def _t(c: str) -> str:
    return f"array_to_string({c}, ',')"


MAIN_TEXT = f"""m.chrom, m.pos, {_t('m.id')} AS id, m.ref, {_t('m.alt')} AS alt, m.qual, {_t('m."filter"')} AS "filter\""""
INFO_TEXT = f"""{_t('i.ac')} AS ac, i.an, i.baseqranksum, i.db, i.raw_mq"""
CSQ_TEXT = (
    f"c.chrom, c.pos, c.allele, {_t('c.consequence')} AS consequence, "
    f"{_t('c.existing_variation')} AS existing_variation, c.gnomad_exomes_af, c.gnomad_genomes_af, c.symbol"
)


def _annotate(where: str = "", region: str = "") -> str:
    """csq LEFT JOIN (main JOIN info); ``region`` restricts all three
    tables, ``where`` the csq side only."""
    mw = f"WHERE {region.replace('X.', 'm.')}" if region else ""
    cw = []
    if region:
        cw.append(region.replace("X.", "c."))
    if where:
        cw.append(where)
    cws = ("WHERE " + " AND ".join(cw)) if cw else ""
    return (
        _with(V_MAIN, V_INFO, V_CSQ)
        + f"""SELECT {CSQ_TEXT},
       mi.id, mi.ref, mi.alt, mi.qual, mi."filter", mi.ac, mi.an, mi.baseqranksum, mi.db, mi.raw_mq
FROM v_csq c
LEFT JOIN (SELECT {MAIN_TEXT}, {INFO_TEXT}
           FROM v_main m JOIN v_info i ON m.chrom = i.chrom AND m.pos = i.pos {mw}) mi
  ON c.chrom = mi.chrom AND c.pos = mi.pos
{cws}"""
    )


# ------------------------------------------------- values encoded in the VCF

K = "o_orderkey"
C = "o_custkey"
ST = "o_orderstatus"

SCAN_COLS = f"""{CHROM.format(k=K)} AS contigName,
  {K} AS start,
  CASE {ST} WHEN 'P' THEN '' WHEN 'F' THEN 'rs' || CAST({K} AS VARCHAR) || ',COSV' || CAST({C} AS VARCHAR)
       ELSE 'rs' || CAST({K} AS VARCHAR) END AS names,
  {ST} AS referenceAllele,
  CASE WHEN {ST} = 'O' THEN substr(o_orderpriority, 1, 1) || ',T' ELSE substr(o_orderpriority, 1, 1) END AS alternateAlleles,
  CASE WHEN {ST} = 'P' THEN NULL ELSE o_totalprice END AS qual,
  CASE {ST} WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'LowQual,q10' ELSE '' END AS filters"""

INFO_COLS = f"""CAST({C} % 5 AS VARCHAR) || CASE WHEN {ST} = 'O' THEN ',' || CAST({C} % 3 AS VARCHAR) ELSE '' END AS INFO_AC,
  CAST(10 AS INTEGER) AS INFO_AN,
  o_totalprice / CAST(1000.0 AS DOUBLE) AS INFO_BaseQRankSum,
  {ST} = 'F' AS INFO_DB,
  CAST({C} AS DOUBLE) AS INFO_RAW_MQ"""

# one row per annotation entry j of an order: (k % 3) entries, generated per order
CSQ_ROWS = f"""(SELECT *, CAST(jj AS INTEGER) AS j FROM (SELECT o.*, unnest(range({K} % 3)) AS jj FROM orders o))"""


def _csq_field_sql() -> dict[str, str]:
    return {
        "Allele": "substr(o_orderpriority, 1, 1)",
        "Consequence": f"CASE WHEN ({C} + j) % 2 = 0 THEN 'missense_variant,splice_region_variant' ELSE 'synonymous_variant' END",
        "IMPACT": f"CASE WHEN ({C} + j) % 2 = 0 THEN 'MODERATE' ELSE 'LOW' END",
        "SYMBOL": f"'GENE' || CAST(({C} + j) % 40 AS VARCHAR)",
        "Existing_variation": f"'rs' || CAST({K} AS VARCHAR) || ',COSV' || CAST({C} + j AS VARCHAR)",
        "gnomAD_exomes_AF": f"CASE ({K} + j) % 4 WHEN 0 THEN '.' WHEN 1 THEN NULL WHEN 2 THEN '0.0' || lpad(CAST({C} % 100 AS VARCHAR), 2, '0') ELSE '1.2e-05' END",
        "gnomAD_genomes_AF": f"'0.0' || lpad(CAST(({C} + {K} + j) % 100 AS VARCHAR), 2, '0')",
        "GERP++_NR": f"CAST({C} % 7 AS VARCHAR)",
        "hg18_pos(1-based)": f"CAST({K} + 1 AS VARCHAR)",
        "Eigen-PC-raw_coding": f"'-0.' || CAST({C} % 10 AS VARCHAR)",
        "1000Gp3_AC": "CAST(j AS VARCHAR)",
        "ref": ST,
        "alt": "substr(o_orderpriority, 1, 1)",
    }


CSQ_STORED = {
    "Allele": "allele",
    "Consequence": "consequence",
    "IMPACT": "impact",
    "SYMBOL": "symbol",
    "Existing_variation": "existing_variation",
    "gnomAD_exomes_AF": "gnomad_exomes_af",
    "gnomAD_genomes_AF": "gnomad_genomes_af",
    "GERP++_NR": "gerpplusplus_nr",
    "hg18_pos(1-based)": "hg18_pos_1_based",
    "Eigen-PC-raw_coding": "eigen_pc_raw_coding",
    "1000Gp3_AC": "csq_1000gp3_ac",
    "ref": "csq_ref",
    "alt": "csq_alt",
}

SLIM = ("Allele", "Consequence", "Existing_variation", "gnomAD_exomes_AF", "gnomAD_genomes_AF", "SYMBOL")


def _csq_full_select() -> str:
    f = _csq_field_sql()
    return ", ".join(f'{f[src]} AS "{dst}"' for src, dst in CSQ_STORED.items())


# per (site, sample i) genotype values, twelve samples generated per order;
# "short" = only GT given
G_ROWS = f"""(SELECT *, CAST(ii AS INTEGER) AS i, (ii = 11 AND {K} % 5 = 0) AS short
 FROM (SELECT o.*, unnest(range(12)) AS ii FROM orders o))"""


def _geno(i: str = "i", short: str = "short") -> dict[str, str]:
    """Expected map texts of sample ``i`` (an SQL expression)."""
    dp = f"CASE WHEN {short} THEN NULL ELSE ({K} + {i}) % 5 END"
    min_dp = f"CASE WHEN {short} OR {ST} = 'P' OR {i} % 3 = 0 THEN NULL ELSE ({K} + 2 * {i}) % 4 END"
    pid = (
        f"CASE WHEN {short} OR {ST} = 'P' OR ({K} + {i}) % 7 = 0 THEN NULL "
        f"WHEN {i} % 2 = 0 THEN 'p' || CAST({i} AS VARCHAR) ELSE NULL END"
    )
    pgt = f"CASE WHEN {short} OR {ST} = 'P' THEN NULL WHEN ({K} + {i}) % 2 = 0 THEN '0|1' ELSE NULL END"
    ad = (
        f"CASE WHEN {short} OR ({K} + {i}) % 6 = 0 THEN NULL ELSE CAST(({K} + {i}) % 5 AS VARCHAR) "
        f"|| ',' || CAST(({K} + 2 * {i}) % 3 AS VARCHAR) END"
    )
    calls = f"CASE ({K} + {i}) % 4 WHEN 0 THEN '0,0' WHEN 1 THEN '0,1' WHEN 2 THEN '1,1' ELSE '-1,-1' END"
    plh = (
        f"CASE WHEN {short} THEN NULL ELSE '0,' || CAST(({K} + {i}) % 7 AS VARCHAR) || ',' "
        f"|| CAST(({K} + {i}) % 11 AS VARCHAR) END"
    )
    return {
        "int": f"concat_ws(';', CASE WHEN ({dp}) <> 0 THEN 'depth=' || CAST({dp} AS VARCHAR) END, "
        f"CASE WHEN ({min_dp}) <> 0 THEN 'min_dp=' || CAST({min_dp} AS VARCHAR) END)",
        "text": f"concat_ws(';', 'pgt=' || ({pgt}), 'pid=' || ({pid}))",
        "list_int": f"concat_ws(';', 'allele_depth=' || ({ad}), 'calls=' || ({calls}), 'plh=' || ({plh}))",
        "depth": dp,
    }


def _sample_name(i: str = "i") -> str:
    return f"'NA-' || lpad(CAST({i} AS VARCHAR), 2, '0')"


def _sample_col(i: str = "i") -> str:
    return f"'sna_' || lpad(CAST({i} AS VARCHAR), 2, '0')"


def _wide_cols(samples) -> str:
    cols = []
    for i in samples:
        g = _geno(str(i), f"({i} = 11 AND {K} % 5 = 0)")
        cols += [f"{g[kind]} AS sna_{i:02d}_{kind}" for kind in ("int", "text", "list_int")]
    return ",\n  ".join(cols)


def _genotypes_wide() -> str:
    head = f"{CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos"
    return f"SELECT {head},\n  {_wide_cols((0, 5, 11))}\nFROM orders"


def oracle_sql() -> dict[str, str]:
    g = _geno()
    fsql = _csq_field_sql()
    sql = {
        "vcf_scan": f"SELECT {SCAN_COLS} FROM orders",
        "vcf_flatten_info": f"SELECT {CHROM.format(k=K)} AS contigName, {K} AS start, {INFO_COLS} FROM orders",
        "vcf_sample_ids": f"SELECT {CHROM.format(k=K)} AS contigName, {K} AS start, i AS sample_index, {_sample_name()} AS sampleId FROM {G_ROWS}",
        "vcf_csq_struct": f"SELECT {CHROM.format(k=K)} AS contigName, {K} AS start, j AS csq_no, "
        + ", ".join(f'{fsql[s]} AS "{s}"' for s in SLIM)
        + f" FROM {CSQ_ROWS}",
        "vcf_bgzf": f"SELECT {SCAN_COLS} FROM orders",
        "table_scan": _with(V_CSQ) + f"SELECT {CSQ_TEXT} FROM v_csq c",
        "table_append": _with(V_MAIN) + f"SELECT {MAIN_TEXT} FROM v_main m",
        "upsert_merge": _with(V_MAIN)
        + """SELECT COALESCE(n.chrom, o.chrom) AS chrom, COALESCE(n.pos, o.pos) AS pos,
       o.id AS id,
       CASE WHEN n.chrom IS NOT NULL THEN n.ref ELSE o.ref END AS ref,
       o.qual AS qual, n.alt AS alt, n."filter" AS "filter"
FROM (SELECT chrom, pos, array_to_string(id, ',') AS id, ref, qual FROM v_main WHERE ref IN ('F', 'O')) o
FULL OUTER JOIN (SELECT chrom, pos, lower(ref) AS ref, array_to_string(alt, ',') AS alt,
                        array_to_string("filter", ',') AS "filter" FROM v_main WHERE ref IN ('O', 'P')) n
  ON o.chrom = n.chrom AND o.pos = n.pos""",
        "schema_evolve": _with(V_MAIN)
        + """SELECT chrom, pos, array_to_string(id, ',') AS id, CAST(NULL AS DOUBLE) AS qual FROM v_main WHERE ref = 'F'
UNION ALL
SELECT chrom, pos, array_to_string(id, ',') AS id, qual FROM v_main WHERE ref <> 'F'""",
        "preview": "SELECT * FROM ("
        + _annotate()
        + ") ORDER BY chrom, pos, allele, consequence, symbol, existing_variation, "
        "gnomad_exomes_af NULLS FIRST, gnomad_genomes_af NULLS FIRST LIMIT 20",
        "pos_one_based": f"SELECT {CHROM.format(k=K)} AS contigName, {K} + 1 AS start FROM orders",
        "main_project": f"""SELECT {CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos,
  CASE {ST} WHEN 'P' THEN '' WHEN 'F' THEN 'rs' || CAST({K} AS VARCHAR) || ',COSV' || CAST({C} AS VARCHAR)
       ELSE 'rs' || CAST({K} AS VARCHAR) END AS id,
  {ST} AS ref,
  CASE WHEN {ST} = 'O' THEN substr(o_orderpriority, 1, 1) || ',T' ELSE substr(o_orderpriority, 1, 1) END AS alt,
  CASE WHEN {ST} = 'P' THEN NULL ELSE o_totalprice END AS qual,
  CASE {ST} WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'LowQual,q10' ELSE '' END AS "filter"
FROM orders""",
        "info_project": f"""SELECT {CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos,
  CAST({C} % 5 AS VARCHAR) || CASE WHEN {ST} = 'O' THEN ',' || CAST({C} % 3 AS VARCHAR) ELSE '' END AS ac,
  CAST(10 AS INTEGER) AS an, o_totalprice / CAST(1000.0 AS DOUBLE) AS baseqranksum,
  {ST} = 'F' AS db, CAST({C} AS DOUBLE) AS raw_mq
FROM orders""",
        "csq_explode": f"SELECT {CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos, j AS csq_no, "
        f"substr(o_orderpriority, 1, 1) AS allele FROM {CSQ_ROWS}",
        "csq_project_slim": f"SELECT {CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos, "
        + ", ".join(f'{fsql[s]} AS "{CSQ_STORED[s]}"' for s in SLIM)
        + f" FROM {CSQ_ROWS}",
        "csq_project_full": f"SELECT {CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos, j AS csq_no, "
        + _csq_full_select()
        + f" FROM {CSQ_ROWS}",
        "sample_list": f"SELECT CAST(i AS INTEGER) AS sample_index, {_sample_name()} AS sample_id, "
        f"{_sample_col()} AS sample FROM (SELECT DISTINCT i FROM {G_ROWS})",
        "sample_normalize": f"SELECT {CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos, i AS sample_index, "
        f"{_sample_col()} AS sample FROM {G_ROWS}",
        "sample_slice": f"SELECT {CHROM.format(k=K)} AS contigName, {K} AS start, i - 10 AS slot, "
        f"{_sample_name()} AS sampleId, CAST({g['depth']} AS INTEGER) AS depth FROM {G_ROWS} WHERE i >= 10",
        "genotype_maps": f"SELECT {CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos, i AS sample_index, "
        f"{_sample_col()} AS sample, {g['int']} AS int, {g['text']} AS text, {g['list_int']} AS list_int FROM {G_ROWS}",
        "genotypes_long": f"""SELECT chrom, pos, sample, kind, entries FROM (
  SELECT {CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos, {_sample_col()} AS sample,
         {g['int']} AS e_int, {g['text']} AS e_text, {g['list_int']} AS e_list
  FROM {G_ROWS}) s,
  LATERAL (VALUES ('int', s.e_int), ('text', s.e_text), ('list_int', s.e_list)) v(kind, entries)""",
        "genotypes_wide": _genotypes_wide(),
        "positional_join": """WITH l AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS row_index, o_orderkey, o_totalprice FROM orders),
r AS (SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS row_index, o_orderkey AS p_orderkey, o_totalprice AS p_totalprice FROM orders)
SELECT l.row_index, l.o_orderkey, l.o_totalprice, p_orderkey, p_totalprice FROM l JOIN r ON l.row_index = r.row_index""",
        "main_info_join": _with(V_MAIN, V_INFO)
        + f"SELECT {MAIN_TEXT}, {INFO_TEXT} FROM v_main m JOIN v_info i ON m.chrom = i.chrom AND m.pos = i.pos",
        "annotate_join": _annotate(),
        "query_a": _annotate(region="X.chrom = 'chr7'"),
        "query_b": _annotate(region="X.chrom = 'chr7' AND X.pos = 28"),
        "query_c": _annotate(region="X.chrom = 'chr7' AND X.pos >= 100 AND X.pos <= 2000"),
        "query_d": _annotate(where="list_contains(c.existing_variation, 'rs77')"),
        "query_e": _annotate(where="c.gnomad_exomes_af < 0.02 AND c.gnomad_genomes_af < 0.02"),
        "query_f": _annotate(where="c.symbol = 'Brand#4' AND list_contains(c.consequence, 'ring')"),
        "row_count": "SELECT COUNT(*) AS row_count FROM orders",
        "ingest": f"SELECT {CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos, j AS csq_no, "
        + _csq_full_select()
        + f" FROM {CSQ_ROWS}",
    }
    key = f"{CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos"
    sql["ingest_main"] = sql["main_project"]
    sql["ingest_info"] = sql["info_project"]
    sql["ingest_genotypes"] = sql["ingest_slim_genotypes"] = sql["genotype_maps"]
    sql["ingest_slim"] = f"SELECT {key}, j AS csq_no, " + ", ".join(f'{fsql[x]} AS "{CSQ_STORED[x]}"' for x in SLIM) + f" FROM {CSQ_ROWS}"
    exomes, genomes = fsql["gnomAD_exomes_AF"], fsql["gnomAD_genomes_AF"]
    sql["query_e_text"] = f"""SELECT * FROM (SELECT {key}, j AS csq_no, {exomes} AS gnomad_exomes_af, {genomes} AS gnomad_genomes_af,
  CASE {ST} WHEN 'P' THEN '' WHEN 'F' THEN 'rs' || CAST({K} AS VARCHAR) || ',COSV' || CAST({C} AS VARCHAR)
       ELSE 'rs' || CAST({K} AS VARCHAR) END AS id, CAST(10 AS INTEGER) AS an
FROM {CSQ_ROWS}) WHERE TRY_CAST(gnomad_exomes_af AS DOUBLE) < 0.02 AND TRY_CAST(gnomad_genomes_af AS DOUBLE) < 0.05"""
    # query_variants: kind F over the ingested tables (symbol GENE4,
    # consequence missense_variant), joined to the site and INFO values
    sql["query_variants"] = f"""SELECT {CHROM.format(k=K)} AS chrom, CAST({K} + 1 AS INTEGER) AS pos, j AS csq_no, {_csq_full_select()},
  CASE {ST} WHEN 'P' THEN '' WHEN 'F' THEN 'rs' || CAST({K} AS VARCHAR) || ',COSV' || CAST({C} AS VARCHAR)
       ELSE 'rs' || CAST({K} AS VARCHAR) END AS id,
  {ST} AS ref,
  CASE WHEN {ST} = 'O' THEN substr(o_orderpriority, 1, 1) || ',T' ELSE substr(o_orderpriority, 1, 1) END AS alt,
  CASE WHEN {ST} = 'P' THEN NULL ELSE o_totalprice END AS qual,
  CASE {ST} WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'LowQual,q10' ELSE '' END AS "filter",
  {INFO_COLS.replace('AS INFO_AC', 'AS ac').replace('AS INFO_AN', 'AS an').replace('AS INFO_BaseQRankSum', 'AS baseqranksum').replace('AS INFO_DB', 'AS db').replace('AS INFO_RAW_MQ', 'AS raw_mq')},
  {_wide_cols((0, 5))}
FROM {CSQ_ROWS}
WHERE {fsql['SYMBOL']} = 'GENE4' AND ({C} + j) % 2 = 0"""
    # two inputs that share sites hold the rows of one input with all sites
    own = {"main": "ingest_main", "info": "ingest_info", "csq": "ingest", "genotypes": "ingest_genotypes"}
    sql |= {f"merged_{t}": sql[own[t]] for t in ("info", "csq")} | {f"compacted_{t}": sql[own[t]] for t in ("main", "csq", "genotypes")}
    sql["ingest_two_batches"] = sql["query_variants"].replace(",\n  " + _wide_cols((0, 5)), "")
    return sql
