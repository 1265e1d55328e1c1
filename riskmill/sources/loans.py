"""A loan table derived row by row from ``lineitem``, in SQL that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_LOANS_SQL = """
WITH base AS (
  SELECT
    CASE WHEN l_suppkey % 50 = 0 THEN l_orderkey
         ELSE l_orderkey * 1000000 + l_partkey * 10 + l_linenumber END AS id,
    l_partkey AS member_id,
    l_extendedprice AS loan_amnt,
    l_extendedprice AS funded_amnt,
    CASE WHEN l_suppkey % 29 = 0 THEN 'n/a'
         WHEN l_linenumber % 2 = 0 THEN ' 36 months' ELSE ' 60 months' END AS term,
    5e0 + l_discount * 100 + l_linenumber AS int_rate,
    l_extendedprice / 36e0 AS installment,
    CASE WHEN l_partkey % 97 = 0 THEN 'n/a'
         WHEN l_partkey % 89 = 0 THEN '0'
         ELSE CAST(20000 + l_partkey * 10 AS STRING) END AS annual_inc,
    l_quantity * 6e-1 AS dti,
    CAST(l_orderkey % 4 AS STRING) AS delinq_2yrs,
    CASE WHEN l_orderkey % 101 = 0 THEN 'text' ELSE CAST(l_orderkey % 6 AS STRING) END AS inq_last_6mths,
    CASE WHEN l_suppkey % 23 = 0 THEN NULL
         ELSE concat(CAST(CAST(round(l_tax * 1000) AS INT) AS STRING), '%') END AS revol_util,
    CAST(5 + l_partkey % 20 AS INT) AS open_acc,
    CAST(l_partkey % 3 AS INT) AS pub_rec,
    CAST(l_quantity * 300 AS DOUBLE) AS revol_bal,
    CAST(8 + l_partkey % 40 AS INT) AS total_acc,
    CAST(l_suppkey % 2 AS INT) AS collections_12_mths_ex_med,
    CAST(l_suppkey % 3 AS INT) AS acc_now_delinq,
    CAST(l_partkey % 700 AS DOUBLE) AS tot_coll_amt,
    CAST(l_partkey * 50 AS DOUBLE) AS tot_cur_bal,
    CASE WHEN l_partkey % 83 = 0 THEN 0e0 ELSE CAST(1000 + l_partkey * 7 AS DOUBLE) END AS total_rev_hi_lim,
    substring('ABCDEFG', l_linenumber, 1) AS grade,
    concat(substring('ABCDEFG', l_linenumber, 1), CAST(1 + l_partkey % 5 AS STRING)) AS sub_grade,
    CASE l_returnflag WHEN 'A' THEN 'RENT' WHEN 'N' THEN 'OWN' ELSE 'MORTGAGE' END AS home_ownership,
    concat('purpose_', CAST(l_partkey % 7 AS STRING)) AS purpose,
    CASE l_suppkey % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END AS verification_status,
    CASE WHEN l_partkey % 19 = 0 THEN NULL WHEN l_partkey % 17 = 0 THEN ''
         ELSE concat(CAST(l_partkey % 11 AS STRING), ' years') END AS emp_length,
    CASE WHEN l_linestatus = 'F' THEN 'INDIVIDUAL' ELSE 'JOINT' END AS application_type,
    concat('S', CAST(l_suppkey % 50 AS STRING)) AS addr_state,
    CASE WHEN l_partkey % 3 = 0 THEN l_returnflag ELSE NULL END AS sparse_col,
    CASE WHEN l_partkey % 5 = 0 THEN 'said "ok", then left' ELSE 'plain' END AS description,
    l_extendedprice * (1 - l_discount) AS total_pymnt,
    CAST(1 AS INT) AS policy_code,
    CASE WHEN l_partkey % 211 = 0 THEN NULL
         WHEN (l_orderkey * 7 + l_partkey * 13 + l_suppkey) % 100 < 2 + l_linenumber THEN 1
         ELSE 0 END AS default_ind,
    CAST((l_orderkey * 31 + l_partkey * 17 + l_suppkey * 3 + l_linenumber * 40) % 1000 AS DOUBLE) / 1000 AS score
  FROM lineitem
)
SELECT * FROM base
UNION ALL
SELECT * FROM base WHERE member_id % 500 = 0
"""


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw loan table over one folder of the supplied tables."""
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").createOrReplaceTempView("lineitem")
    return spark.sql(RAW_LOANS_SQL)
