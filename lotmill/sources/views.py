"""Listing-shaped views over the given tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CODES = "KAUPWBTGTZTNDLGAMHZZ"
_CIN = "'U18101' || substring('" + CODES + "', CAST(2 * (c_nationkey % 10) + 1 AS INT), 2) || '2002PLC' || lpad(CAST(c_custkey AS STRING), 6, '0')"

VIEWS = {
    "v_listings": f"""
SELECT o.o_orderkey AS input_seq,
  CAST(date_trunc('month', o.o_orderdate) AS DATE) AS batch_date,
  c.c_name AS corporate_debtor,
  'IP ' || CAST(o.o_custkey % 97 AS STRING) AS ip_name,
  o.o_orderpriority AS notice_type,
  p.p_type || ' ' || p.p_name
    || CASE o.o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN ' non-agricultural land' WHEN 2 THEN ' agricultural land'
         WHEN 3 THEN ' Industrial shed' WHEN 4 THEN ' residential flat' ELSE ' commercial unit' END
    || CASE o.o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN ' of ' || CAST(p.p_size AS STRING) || ' acres'
         WHEN 2 THEN ' of ' || CAST(p.p_size AS STRING) || ',000 sq. ft.'
         WHEN 3 THEN ' of ' || CAST(p.p_size AS STRING) || ' acres and ' || CAST(p.p_size + 1 AS STRING) || ' hectares'
         ELSE ' of 31.82 Guntas, again 31.82 guntas' END
    || CASE WHEN o.o_orderkey % 23 = 0 THEN '; Vehicle' WHEN o.o_orderkey % 29 = 0 THEN ' Swift VXI MH02EK5147'
         WHEN o.o_orderkey % 31 = 0 THEN ' carpet stock' ELSE '' END AS nature_of_assets,
  CASE WHEN o.o_orderkey % 17 = 0 THEN NULL WHEN o.o_orderkey % 13 = 0 THEN 0
       ELSE CAST(floor(o.o_totalprice) AS BIGINT) END AS reserve_price,
  CAST(o.o_orderdate AS DATE) AS notice_date,
  CAST(o.o_orderdate AS DATE) + CAST(14 + o.o_orderkey % 30 AS INT) AS auction_date,
  CAST(o.o_orderdate AS DATE) + CAST(7 + o.o_orderkey % 20 AS INT) AS emd_due_date,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
       ELSE n.n_name || ', ' || r.r_name || CASE WHEN o.o_orderkey % 19 = 0 THEN '; office in EUROPE' ELSE '' END END AS location,
  CASE WHEN o.o_orderstatus = 'F' THEN 'Sold with Physical Possession.' WHEN o.o_orderstatus = 'O' THEN 'symbolic possession only'
       WHEN o.o_orderkey % 2 = 0 THEN 'physical possession of lot 1, symbolic possession of lot 2' ELSE 'as is where is' END AS notice_text,
  CASE WHEN o.o_orderkey % 7 = 0 THEN NULL
       WHEN o.o_orderkey % 9 = 0 THEN ' ' || lower({_CIN}) ELSE {_CIN} END AS cin
FROM {{orders}} o JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
JOIN {{part}} p ON p.p_partkey = o.o_orderkey % 200""",
    "v_snapshots": """
SELECT event_id AS input_seq, CAST(ts AS DATE) AS run_date,
  CASE WHEN user_id % 40 = 1 THEN 'D|' || CAST(user_id - user_id % 2 AS STRING) || CASE WHEN event_id % 2 = 0 THEN '|X' ELSE '' END
       ELSE 'Debtor ' || CAST(user_id AS STRING) END AS corporate_debtor,
  CASE WHEN user_id % 40 = 1 THEN CASE WHEN event_id % 2 = 0 THEN 'Y' ELSE 'X|Y' END ELSE 'IP ' || CAST(user_id % 7 AS STRING) END AS ip_name,
  CASE WHEN event_id % 3 = 0 THEN upper(event_type) || ' ' ELSE event_type END AS notice_type,
  'Asset class ' || CAST(user_id % 5 AS STRING) AS nature_of_assets,
  CASE CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST(5000000 AS BIGINT) WHEN 2 THEN CAST(4500000 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS reserve_price,
  DATE '2024-02-01' + CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 2 AS INT) AS auction_date,
  DATE '2024-01-01' AS notice_date, DATE '2024-01-25' AS emd_due_date,
  value > 5 AS details_parsed
FROM {events}""",
    "v_registry": f"""
SELECT file_pos, cin, company_name, company_status, paidup_capital FROM (
SELECT c_custkey AS file_pos, {_CIN} AS cin, upper(c_name) AS company_name,
  CASE WHEN c_custkey % 4 = 0 THEN ' n.a. ' WHEN c_custkey % 4 = 1 THEN '-' ELSE c_mktsegment END AS company_status,
  CAST(floor(c_acctbal) AS BIGINT) AS paidup_capital FROM {{customer}} WHERE c_custkey % 3 <> 2
UNION ALL
SELECT 10000000 + c_custkey, {_CIN}, upper(c_name) || ' (DUP)', 'Active', CAST(0 AS BIGINT) FROM {{customer}} WHERE c_custkey % 50 = 0) t""",
    "v_paged_rows": """
SELECT page, row_idx, details_url, debtor, price_raw FROM (
SELECT CAST(floor(s_suppkey / 20) AS INT) + 1 AS page, CAST(s_suppkey % 20 AS INT) AS row_idx, CASE WHEN s_suppkey % 10 = 3 THEN '' ELSE '/d/' || CAST(s_suppkey AS STRING) || '.pdf' END AS details_url, s_name AS debtor, CAST(s_acctbal AS STRING) AS price_raw FROM {supplier}
UNION ALL
SELECT CAST(floor(s_suppkey / 20) AS INT) + 2, CAST(s_suppkey % 20 AS INT) - 20, CASE WHEN s_suppkey % 10 = 3 THEN '' ELSE '/d/' || CAST(s_suppkey AS STRING) || '.pdf' END, s_name, CAST(s_acctbal AS STRING) FROM {supplier} WHERE s_suppkey % 20 >= 18) t""",
    "v_tiers": """
SELECT item_id, 1 AS tier, text || CASE WHEN item_id % 3 = 0 THEN '' ELSE ' auction' END AS phrase FROM {benchmark}
UNION ALL SELECT item_id, 2, text || CASE WHEN item_id % 3 = 1 THEN '' ELSE ' NCLT' END FROM {benchmark}
UNION ALL SELECT item_id, 3, text FROM {benchmark}
UNION ALL SELECT item_id, 4, CASE WHEN item_id % 5 = 0 THEN text || ' #' ELSE substring(text, 1, 10) END FROM {benchmark}""",
}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``VIEWS`` over the tables in ``sf_dir``."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in VIEWS[name]}
    return spark.sql(VIEWS[name], **used)


def duckdb_view(name: str) -> str:
    """The same view as a common table expression."""
    return f"{name} AS ({VIEWS[name].format(**{t: t for t in TABLES})}\n)"
