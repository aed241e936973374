"""Rule tables as data and keyed lookups over the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from recsmith.catalog import roles, spec
from recsmith.catalog.columns import PROD_SQL, ZIP_SQL, _fcy_sql, _range_case_sql, _zip, _zip_state_sql
from recsmith.catalog.registry import query, table
from recsmith.functions import rules as R
from recsmith.operators.keyed import lookup_rows, write_keyed
from recsmith.operators.rule_tables import RULE_COLUMNS, compile_rules
from recsmith.session import scratch_path
from recsmith.sinks import writers as W
from recsmith.sources import readers as RD


def rule_file(spark):
    """The customer system's rules as a delimited file, with rules that no longer hold or do not hold yet."""
    rows = []
    for name, ranges, closed in (("DEPOSIT", R.DEPOSIT_RANGES, "N"), ("LOAN", R.LOAN_RANGES, "N"), ("ZIP", R.ZIP_STATE_RANGES, "Y")):
        rows += [(name, str(lo), str(hi), closed, value, "0", "", "") for lo, hi, value in ranges]
        rows += [(name, "0", "99999999999", "Y", "OLD", "9", "", "1980-12-31"), (name, "0", "99999999999", "Y", "NEW", "9", "2199-01-01", "")]
    for value, codes in (("FCYFD", R.FCY_FD_PRODUCTS), ("FCYCA", R.FCY_CA_PRODUCTS)):
        rows += [("PRODUCT", c, c, "Y", value, "0", "1970-01-01", "") for c in codes]
    path = scratch_path(spark, f"rules-{uuid.uuid4().hex}")
    W.write_csv(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in RULE_COLUMNS)), path, sep=";", header=False, quote_all=True)
    return RD.read_delimited(spark, path, RULE_COLUMNS)


@query("rules_accounts", "CLS-02 CLS-03 SRC-09", sql=f"""
SELECT o_orderkey, {_fcy_sql(_range_case_sql('a', spec.DEPOSITS))} AS APPL_CODE, {_range_case_sql('a', spec.LOANS)} AS LN_APPL
FROM (SELECT o_orderkey, o_custkey, {roles.ACCT_SQL} AS a FROM orders) WHERE {PROD_SQL} IS NOT NULL""")
def rules_accounts(spark, sf):
    """Account ranges overridden by product sets, both from the rule file."""
    rules = rule_file(spark)
    day = RD.control_date(table(spark, sf, "orders").agg(F.max("o_orderdate").alias("d")).select(
        F.year("d").alias("YY"), F.month("d").alias("MM"), F.dayofmonth("d").alias("DD")))
    deposit, loan, product = (compile_rules(rules, t, day) for t in ("DEPOSIT", "LOAN", "PRODUCT"))
    acct = roles.acct_no().try_cast("long")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.coalesce(product.value(F.col("o_custkey") % 500), deposit.value(acct, "")).alias("APPL_CODE"),
        loan.value(acct, "").alias("LN_APPL"))


@query("rules_zip", "CLS-04 SRC-09", sql=f"""
SELECT o_orderkey, z AS zip, {_zip_state_sql('z')} AS STATEX FROM (SELECT o_orderkey, {ZIP_SQL} AS z FROM orders)""")
def rules_zip(spark, sf):
    states = compile_rules(rule_file(spark), "ZIP", "1998-01-01")
    o = table(spark, sf, "orders").select("o_orderkey", _zip().alias("zip"))
    return o.select("o_orderkey", "zip", states.value(F.trim("zip").try_cast("int"), "").alias("STATEX"))


@query("keyed_lookup", "SNK-11 SRC-15", sql="""
SELECT CAST(o_custkey AS VARCHAR) AS CUSTNO, o_orderpriority AS IDTYPE, o_orderkey AS ID FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > (SELECT max(c_acctbal) - 20 FROM customer))""")
def keyed_lookup(spark, sf):
    """Ids of the customers of a short list, from a table laid out by customer."""
    name = "recsmith_keyed_" + uuid.uuid4().hex[:8]
    o = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("CUSTNO"), F.col("o_orderpriority").alias("IDTYPE"),
                                          F.col("o_orderkey").alias("ID"))
    write_keyed(o, name, "CUSTNO", 16, ["IDTYPE", "ID"], ["ID"], path=scratch_path(spark, name))
    c = table(spark, sf, "customer")
    top = c.agg((F.max("c_acctbal") - 20).alias("least"))
    wanted = c.join(F.broadcast(top), F.col("c_acctbal") > F.col("least")).select(F.col("c_custkey").cast("string").alias("CUSTNO"))
    return lookup_rows(spark, name, "CUSTNO", wanted)
