"""Inputs of the registered queries, derived from the given tables.

The given tables have no nulls, orphans or bad text, so views over them plant faults by key.
The same text runs on Spark and in the SQL check: table names stand in braces.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vouch.functions.checks import at_least, custom, in_set, not_null, references, unique
from vouch.plans.context import RunContext
from vouch.plans.reports import Report
from vouch.plans.rules import Rule

AS_OF = datetime(2026, 1, 1)
CONTEXT = RunContext(AS_OF)

DIRTY_VIEWS = {
    "patients": """
SELECT 'PT' || lpad(cast(CASE WHEN c_custkey % 199 = 7 THEN c_custkey - 1 ELSE c_custkey END AS string), 6, '0') AS patient_id,
 CASE WHEN c_custkey % 33 = 1 THEN NULL WHEN c_custkey % 97 = 5 THEN '2027-06-01' WHEN c_custkey % 101 = 3 THEN 'not-a-date'
      ELSE cast(DATE '1940-01-01' + cast(c_custkey * 17 % 23000 AS int) AS string) END AS date_of_birth,
 CASE WHEN c_custkey % 25 = 2 THEN NULL WHEN c_custkey % 50 = 4 THEN 'UNKNOWN' WHEN c_custkey % 31 = 0 THEN 'Other' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
 CASE WHEN c_custkey % 20 = 3 THEN NULL ELSE n_name END AS state,
 CASE WHEN c_custkey % 50 = 9 THEN '0000' WHEN c_custkey % 211 = 10 THEN '12A45' WHEN c_custkey % 223 = 11 THEN NULL ELSE lpad(cast(c_custkey * 37 % 100000 AS string), 5, '0') END AS zip_code,
 CASE WHEN c_custkey % 10 = 6 THEN NULL ELSE 'patient' || cast(c_custkey AS string) || '@email.com' END AS email,
 c_mktsegment AS insurance_type
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
""",
    "encounters": """
SELECT 'ENC' || lpad(cast(CASE WHEN o_orderkey % 1009 = 8 THEN o_orderkey - 1 ELSE o_orderkey END AS string), 7, '0') AS encounter_id,
 CASE WHEN o_orderkey % 307 = 1 THEN 'PT999999' WHEN o_orderkey % 401 = 2 THEN NULL ELSE 'PT' || lpad(cast(o_custkey AS string), 6, '0') END AS patient_id,
 CASE WHEN o_orderkey % 100 = 3 THEN NULL ELSE cast(cast(o_orderdate AS date) AS string) END AS admission_date,
 CASE WHEN o_orderkey % 33 = 4 THEN NULL WHEN o_orderkey % 601 = 5 THEN '2027-01-01'
      WHEN o_orderkey % 251 = 6 THEN cast(cast(o_orderdate AS date) - 3 AS string)
      ELSE cast(cast(o_orderdate AS date) + cast(o_orderkey % 15 AS int) AS string) END AS discharge_date,
 CASE WHEN o_orderkey % 33 = 7 THEN NULL ELSE o_orderpriority END AS primary_diagnosis,
 cast(o_orderkey % 15 AS int) AS length_of_stay,
 CASE WHEN o_orderkey % 50 = 11 THEN -999.0 WHEN o_orderkey % 50 = 12 THEN 0.0 ELSE o_totalprice END AS total_charges_usd
FROM {orders}
""",
    "lab_results": """
SELECT CASE WHEN l_orderkey % 2003 = 1 THEN NULL ELSE 'LAB' || lpad(cast(l_orderkey AS string), 7, '0') || cast(l_linenumber AS string) END AS lab_id,
 CASE WHEN l_orderkey % 1201 = 2 THEN 'PT999999' ELSE 'PT' || lpad(cast(o_custkey AS string), 6, '0') END AS patient_id,
 CASE WHEN l_partkey % 33 = 3 THEN NULL WHEN l_partkey % 50 = 4 THEN -99999.0 WHEN l_partkey % 50 = 5 THEN -999.0 ELSE l_quantity END AS result_value,
 CASE WHEN l_partkey % 100 = 6 THEN NULL ELSE 'mg/dL' END AS unit,
 l_quantity > 40 AS is_abnormal,
 cast(cast(l_shipdate AS date) AS string) AS collection_date,
 cast(cast(l_shipdate AS date) + cast(CASE WHEN l_partkey % 503 = 7 THEN -2 ELSE l_partkey % 4 END AS int) AS string) AS result_date,
 CASE WHEN l_partkey % 307 = 8 THEN NULL WHEN l_partkey % 211 = 9 THEN 'Pending' WHEN l_returnflag = 'A' THEN 'Final' WHEN l_returnflag = 'N' THEN 'Preliminary' ELSE 'Corrected' END AS status
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
""",
    "medications": """
SELECT 'MED' || lpad(cast(event_id AS string), 7, '0') AS med_id,
 'PT' || lpad(cast(user_id AS string), 6, '0') AS patient_id,
 CASE WHEN event_id % 33 = 1 THEN NULL ELSE cast(cast(event_id % 5 + 1 AS int) * 100 AS string) || 'mg' END AS dose,
 CASE WHEN event_id % 401 = 2 THEN 'Hourly' WHEN event_id % 409 = 3 THEN NULL WHEN event_type = 'click' THEN 'Daily' WHEN event_type = 'view' THEN 'BID' WHEN event_type = 'purchase' THEN 'TID' WHEN event_type = 'signup' THEN 'QID' ELSE 'PRN' END AS frequency,
 CASE WHEN event_id % 50 = 4 THEN NULL ELSE cast(cast(ts AS date) AS string) END AS start_date,
 CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 269 = 6 THEN '2021-01-01' ELSE cast(cast(ts AS date) + cast(30 + event_id % 335 AS int) AS string) END AS end_date,
 event_id % 5 = 0 AS is_active
FROM {events}
""",
}

#: Views that join two tables: their rules are checked in one pass over the join.
JOINED_VIEWS = ("patients", "lab_results")

RAW_TABLES = ("supplier", "part", "orders", "customer")

RAW_RULES = [
    Rule("SUP-001", "supplier", "Completeness", "Critical", "s_suppkey must not be null",
         not_null("s_suppkey")),
    Rule("SUP-002", "supplier", "Uniqueness", "Critical", "s_suppkey must be unique",
         unique("s_suppkey")),
    Rule("SUP-003", "supplier", "Referential", "Critical", "s_nationkey must exist in nation",
         references("s_nationkey", "nation", "n_nationkey")),
    Rule("SUP-004", "supplier", "Validity", "Low", "s_acctbal must not be negative",
         at_least("s_acctbal", 0)),
    Rule("PRT-001", "part", "Completeness", "Critical", "p_partkey must not be null",
         not_null("p_partkey")),
    Rule("PRT-002", "part", "Uniqueness", "Critical", "p_partkey must be unique",
         unique("p_partkey")),
    Rule("PRT-003", "part", "Validity", "High", "p_size must be at least 1", at_least("p_size", 1)),
    Rule("PRT-004", "part", "Uniqueness", "Medium", "p_name must be unique", unique("p_name")),
    Rule("ORD-001", "orders", "Completeness", "Critical", "o_orderkey must not be null",
         not_null("o_orderkey")),
    Rule("ORD-002", "orders", "Referential", "Critical", "o_custkey must exist in customer",
         references("o_custkey", "customer", "c_custkey")),
    Rule("ORD-003", "orders", "Validity", "High", "o_orderstatus must be O or F",
         in_set("o_orderstatus", "O", "F")),
    Rule("CUS-001", "customer", "Completeness", "Critical", "c_custkey must not be null",
         not_null("c_custkey")),
    Rule("CUS-002", "customer", "Validity", "High", "c_acctbal must not be negative",
         at_least("c_acctbal", 0)),
    Rule("CUS-003", "customer", "Referential", "Medium", "c_nationkey must exist in nation",
         references("c_nationkey", "nation", "n_nationkey")),
]

ORDER_RULES = [
    RAW_RULES[8],
    Rule("ORD-004", "orders", "Timeliness", "Medium", "o_orderdate must be before 1998",
         custom(lambda df: F.col("o_orderdate").cast("date") >= F.lit("1998-01-01").cast("date"))),
    Rule("ORD-005", "orders", "Consistency", "Low", "o_totalprice must be at least 50000", at_least("o_totalprice", 50000)),
]

# Rules that cannot be checked, beside one that can: columns that are not there, a check that gives
# no truth, a reference from no column (which holds), and text that is no number.
FAULTY_RULES = [
    RAW_RULES[10],
    Rule("BAD-001", "orders", "Completeness", "High", "no_such must not be null", not_null("no_such")),
    Rule("BAD-002", "orders", "Uniqueness", "High", "no_such must be unique", unique("no_such")),
    Rule("BAD-003", "orders", "Validity", "High", "a number is no check", custom(lambda df: F.col("o_custkey") + 1)),
    Rule("BAD-004", "orders", "Referential", "High", "no_such must exist in customer", references("no_such", "customer", "c_custkey")),
    Rule("BAD-005", "orders", "Validity", "High", "status as a number", custom(lambda df: F.col("o_orderstatus").cast("int") > 5)),
    Rule("BAD-006", "customer", "Validity", "Low", "share of nothing", custom(lambda df: F.col("c_acctbal") / (F.col("c_custkey") - F.col("c_custkey")) > 1)),
    RAW_RULES[12],
]

# What two stored runs check: the second has a rule that orders do not break.
STORED_RULES = [r for r in RAW_RULES if r.rule_id in ("ORD-003", "CUS-002")]
MENDED_RULES = [replace(r, check=not_null("o_orderkey")) if r.rule_id == "ORD-003" else r for r in STORED_RULES]

RAW_REPORTS = [
    Report("Supplier Directory", ("supplier",), "Purchasing", "Monthly", "High"),
    Report("Parts Catalogue", ("part", "supplier"), "Purchasing", "Weekly", "Medium"),
    Report("Order Book", ("part", "orders", "customer"), "Sales", "Daily", "Critical"),
    Report("Customer Balances", ("customer", "supplier"), "Finance", "Daily", "High"),
]


def raw(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}


SOURCES = ("customer", "nation", "orders", "lineitem", "events")


def from_sql(spark: SparkSession, sf_dir: str, *texts: str) -> list[DataFrame]:
    """Queries over given tables whose names stand in braces."""
    read = raw(spark, sf_dir, *[t for t in SOURCES if any("{" + t + "}" in text for text in texts)])
    return [
        spark.sql(text, **{t: df for t, df in read.items() if "{" + t + "}" in text}) for text in texts
    ]


def dirty(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The dirty views of these names, by default all four."""
    names = names or tuple(DIRTY_VIEWS)
    return dict(zip(names, from_sql(spark, sf_dir, *[DIRTY_VIEWS[n] for n in names])))


def plain(text: str) -> str:
    """The text of a view with bare table names, for the SQL check."""
    return text.format(**{name: name for name in SOURCES}).strip()


# CSV contents as text: null tokens in a text and a number column, near misses that must stay
TOKEN_CSV = """
SELECT cast(c_custkey AS string) AS patient_id,
 CASE c_custkey % 40 WHEN 0 THEN 'NA' WHEN 1 THEN 'null' WHEN 2 THEN 'None' WHEN 3 THEN 'N/A' WHEN 4 THEN 'nan'
   WHEN 5 THEN '' WHEN 6 THEN '#N/A' WHEN 7 THEN '<NA>' WHEN 8 THEN '-1.#IND' WHEN 9 THEN 'NULL'
   WHEN 10 THEN 'Null' WHEN 11 THEN 'none' WHEN 12 THEN 'NA, "quoted"' ELSE n_name END AS state,
 CASE c_custkey % 30 WHEN 1 THEN 'NaN' WHEN 2 THEN 'n/a' WHEN 3 THEN 'unknown' ELSE cast(c_acctbal AS string) END AS balance
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

# CSV contents as text: digit text, whole numbers written as decimals, bad numbers, booleans
TYPED_CSV = """
SELECT cast(o_orderkey AS string) AS encounter_id,
 lpad(cast(o_orderkey * 37 % 100000 AS string), 5, '0') AS zip_code,
 CASE WHEN o_orderkey % 7 = 1 THEN cast(o_orderkey % 15 AS string) || '.0' WHEN o_orderkey % 11 = 2 THEN 'three'
   WHEN o_orderkey % 13 = 3 THEN '2.5' ELSE cast(o_orderkey % 15 AS string) END AS length_of_stay,
 CASE WHEN o_orderkey % 17 = 4 THEN '12 USD' ELSE cast(o_totalprice AS string) END AS total_charges_usd,
 CASE WHEN o_orderkey % 5 = 0 THEN 'True' WHEN o_orderkey % 5 = 1 THEN 'no idea' ELSE 'False' END AS is_active
FROM {orders}
"""

# CSV lines, good ones and faulty ones: a field too many, an open quote, a quoted line break (which leaves
# two lines), a field too few, and commas and quotes inside a field
MALFORMED_CSV = """
SELECT CASE c_custkey % 10 WHEN 1 THEN cast(c_custkey AS string) || ',' || c_name || ',' || cast(c_nationkey AS string) || ',extra'
   WHEN 2 THEN cast(c_custkey AS string) || ',"' || c_name || ',' || cast(c_nationkey AS string)
   WHEN 3 THEN cast(c_custkey AS string) || ',"broken'
   WHEN 4 THEN cast(c_custkey AS string) || ',' || c_name
   WHEN 5 THEN cast(c_custkey AS string) || ',"a, ""b""' || '",' || cast(c_nationkey AS string)
   ELSE cast(c_custkey AS string) || ',' || c_name || ',' || cast(c_nationkey AS string) END AS line
FROM {customer}
UNION ALL SELECT 'name",' || cast(c_nationkey AS string) FROM {customer} WHERE c_custkey % 10 = 3
"""
