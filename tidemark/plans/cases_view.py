"""A messy case table derived from order data, whole tables in, one case per order and more.

Every order becomes a case; defects follow from the order key, so the same rows come out on every run
and every engine. Each fiftieth order appears twice, the second time with a padded name and its own
id, as a resubmitted case would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_CATEGORY = """
CASE WHEN k % 17 = 0 THEN ''
     WHEN k % 23 = 0 THEN concat('novel_cat_', CAST(k % 5 AS STRING))
     WHEN seg = 'AUTOMOBILE' THEN CASE k % 4 WHEN 0 THEN 'TECH SUPPORT' WHEN 1 THEN 'tech_support' ELSE 'Technical Support' END
     WHEN seg = 'BUILDING' THEN CASE k % 4 WHEN 0 THEN 'billng' WHEN 1 THEN 'BILLING-DEPT' ELSE 'Billing' END
     WHEN seg = 'FURNITURE' THEN CASE k % 4 WHEN 0 THEN 'hardware_maint' WHEN 1 THEN 'Hardware ' ELSE 'Hardware' END
     WHEN seg = 'HOUSEHOLD' THEN CASE k % 4 WHEN 0 THEN 'gen.inquiry' WHEN 1 THEN 'GENERAL  INQUIRY' ELSE 'General Inquiry' END
     ELSE CASE k % 4 WHEN 0 THEN 'sec alert' WHEN 1 THEN 'security-alert' ELSE 'Security Alert' END END
"""
_PRIORITY = """
CASE WHEN k % 43 = 0 THEN 'TBD'
     WHEN prio = '1-URGENT' THEN CASE k % 3 WHEN 0 THEN 'URGENT_OVERRIDE' WHEN 1 THEN 'p1' ELSE 'Critical' END
     WHEN prio = '2-HIGH' THEN CASE k % 3 WHEN 0 THEN 'HIGH' ELSE 'High' END
     WHEN prio = '3-MEDIUM' THEN CASE k % 3 WHEN 0 THEN 'med' ELSE 'Medium' END
     WHEN prio = '5-LOW' THEN CASE k % 3 WHEN 0 THEN ' low ' ELSE 'Low' END
     ELSE 'Medium' END
"""
_INTAKE = """
CASE WHEN k % 199 = 0 THEN '2099-01-01'
     WHEN k % 223 = 0 THEN ''
     WHEN k % 227 = 0 THEN 'not-a-date'
     WHEN k % 10 = 0 THEN date_format(day, 'MM/dd/yyyy')
     WHEN k % 10 = 1 THEN date_format(day, 'yyyy.MM.dd')
     WHEN k % 10 = 2 AND day(day) > 12 THEN date_format(day, 'dd/MM/yyyy')
     WHEN k % 10 = 3 THEN concat(date_format(day, 'yyyy-MM-dd'), ' 08:30:00')
     ELSE date_format(day, 'yyyy-MM-dd') END
"""
_CLOSURE = """
CASE WHEN k % 211 = 0 THEN '2024-13-45'
     WHEN last_ship IS NULL THEN ''
     WHEN k % 4 = 1 THEN date_format(last_ship, 'MM/dd/yyyy')
     ELSE date_format(last_ship, 'yyyy-MM-dd') END
"""
_TRIAGE = """
CASE WHEN k % 5 < 2 THEN ''
     WHEN k % 241 = 0 THEN 'bad'
     ELSE date_format(date_add(day, CAST(k % 9 - 1 AS INT)), 'yyyy-MM-dd') END
"""
_CONTACTS = """
CASE WHEN k % 53 = 0 THEN '-5'
     WHEN k % 59 = 0 THEN '999999'
     WHEN k % 61 = 0 THEN 'abc'
     WHEN k % 67 = 0 THEN ''
     WHEN k % 71 = 0 THEN '150'
     WHEN k % 37 = 0 THEN ' 3.0 '
     ELSE CAST(coalesce(n_lines, 0) AS STRING) END
"""
_STATUS = """
CASE WHEN k % 83 = 0 THEN 'UNKNOWN_STATUS'
     WHEN st = 'F' THEN CASE k % 3 WHEN 0 THEN 'RESOLVED' ELSE 'Closed' END
     WHEN st = 'P' THEN 'closed'
     ELSE CASE k % 3 WHEN 0 THEN 'in_progress' WHEN 1 THEN 'on hold' ELSE 'Open' END END
"""
_CLIENT = """
CASE WHEN copy = 1 THEN concat(name, '  ')
     WHEN k % 7 = 0 THEN upper(name)
     WHEN k % 11 = 0 THEN concat('  ', name, ' ')
     WHEN k % 13 = 0 THEN replace(name, '#', '  #')
     ELSE name END
"""
_CASE_ID = """
CASE WHEN k % 101 = 0 THEN ''
     WHEN k % 97 = 0 THEN concat('C-', CAST(k - k % 970 AS STRING))
     WHEN copy = 1 THEN concat(CAST(k AS STRING), '-R')
     ELSE CAST(k AS STRING) END
"""
_TRIAGED = "element_at(array('Yes', 'No', 'Y', '1', '0', 'TRUE', '', 'maybe'), CAST(k % 8 + 1 AS INT))"


def cases(spark: SparkSession, folder: str) -> DataFrame:
    """The raw case table, all strings, with ``row_index``."""
    lines = (
        table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("last_ship"), F.count("*").alias("n_lines"))
    )
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    spine = joined.selectExpr(
        "o_orderkey AS k",
        "o_orderstatus AS st",
        "o_orderpriority AS prio",
        "CAST(o_orderdate AS DATE) AS day",
        "CAST(last_ship AS DATE) AS last_ship",
        "n_lines",
        "c_name AS name",
        "c_mktsegment AS seg",
        "c_nationkey AS nation",
        "explode(CASE WHEN o_orderkey % 50 = 0 THEN array(0, 1) ELSE array(0) END) AS copy",
    )
    # Rows are dealt anew: a table of one or two files would leave most cores idle in the projections that follow.
    spine = spine.repartition("k")
    return spine.selectExpr(
        "k * 2 + copy AS row_index",
        f"{_CASE_ID} AS case_id",
        f"{_CLIENT} AS client_name",
        f"{_CATEGORY} AS category",
        f"{_PRIORITY} AS priority",
        f"{_INTAKE} AS intake_date",
        f"{_CLOSURE} AS closure_date",
        f"{_TRIAGE} AS triage_date",
        f"{_TRIAGED} AS triaged",
        f"{_CONTACTS} AS contact_count",
        "concat('Agent_', CAST(nation AS STRING)) AS assigned_agent",
        f"{_STATUS} AS status",
        "concat('Order ', CAST(k AS STRING), ' for ', lower(seg)) AS resolution_notes",
    )
