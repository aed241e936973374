"""Role map: how the test tables stand in for the customer system's inputs.

Each adapter exists twice, once as Spark code and once as a SQL fragment for
the DuckDB twin, written side by side so they stay identical.

orders    -> accounts   (o_orderkey -> account no., o_custkey -> customer,
                         o_orderstatus -> open indicator / primary flag,
                         o_totalprice -> balance, o_orderpriority -> product)
customer  -> customer master; nation / region -> code tables
lineitem  -> customer-to-customer relationship edges
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsmith.catalog.registry import table

# ---------------------------------------------------------------- accounts
# 11-digit account number whose two-digit prefix runs 01..09.
ACCT_SQL = "lpad(CAST((o_orderkey % 9 + 1) * 1000000000 + o_orderkey AS VARCHAR), 11, '0')"


def acct_no(c="o_orderkey"):
    k = F.col(c)
    return F.lpad(((k % 9 + 1) * F.lit(1000000000) + k).cast("string"), 11, "0")


def account_rel(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(acct_no().alias("ACCTNOC"),
                    o.o_custkey.cast("string").alias("CUSTNO"),
                    F.substring("o_orderpriority", 1, 3).alias("RLENCODE"),
                    F.when(F.col("o_orderstatus") == "F", F.lit("901"))
                    .otherwise(F.lit("000")).alias("PRISEC"))


ACCOUNT_REL_SQL = f"""
SELECT {ACCT_SQL} AS ACCTNOC, CAST(o_custkey AS VARCHAR) AS CUSTNO,
       substr(o_orderpriority, 1, 3) AS RLENCODE,
       CASE WHEN o_orderstatus = 'F' THEN '901' ELSE '000' END AS PRISEC
FROM orders"""


# ------------------------------------------------- relationship edge list
# Edges that one task takes the distinct ones of.
EDGES = 500_000


def cust_rel(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    # Dealt out in parts of bounded size: hardly any edge repeats.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-li.count() // EDGES))
    return li.select(li.l_suppkey.cast("string").alias("CUST1"),
                     F.col("l_returnflag").alias("CODE1"),
                     li.l_partkey.cast("string").alias("CUST2"),
                     F.col("l_linestatus").alias("CODE2")).repartition(parts, "CUST1", "CODE1", "CUST2", "CODE2").distinct()


CUST_REL_SQL = """
SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS CUST1, l_returnflag AS CODE1,
       CAST(l_partkey AS VARCHAR) AS CUST2, l_linestatus AS CODE2
FROM lineitem"""
