"""A person register derived from the customer and supplier tables.

The expressions hold in Spark SQL and ANSI engines alike; they give noisy headers and values with exact,
partial and possible duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PEOPLE_SQL = """
with b as (
  select 'customer' src, c_custkey k, c_mktsegment dep, c_custkey id from customer
  union all
  select 'supplier', s_suppkey * 7, 'HOUSEHOLD', 1000000000 + s_suppkey from supplier),
s as (select *, case when k % 5 = 4 then k - 4 else k end p from b),
t as (select *, translate(substr(md5(cast(p as string)), 1, 12), '0123456789', 'ghijklmnop') nm from s)
select id, src, k, p, dep,
  case k % 4 when 0 then '  Mr. ' || upper(nm) || ' ' when 1 then 'Dr ' || nm when 2 then nm || '.'
    else case when k % 15 = 14 then substr(nm, 1, 11) else nm end end raw_name,
  case when k % 15 = 14 then null when k % 10 = 9 then 'U' || cast(k as string) || '@Example.com'
    else ' u' || cast(p as string) || '@Example.com ' end raw_email,
  case when k % 15 = 14 then 'N/A' when k % 3 = 0 then '+91-98' || lpad(cast(p as string), 8, '0')
    else '098' || lpad(cast(p as string), 8, '0') end raw_phone,
  case when k % 2 = 0 then cast(k as string) || '.0' else lpad(cast(k as string), 8, '0') end raw_code
from t
"""


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """The rows over all cores.  A table of few bytes is read by a task or two, however much work its rows are."""
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, key)


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    for table, key in (("customer", "c_custkey"), ("supplier", "s_suppkey")):
        dealt(spark.read.parquet(f"{sf_dir}/{table}.parquet"), key).createOrReplaceTempView(table)
    return spark.sql(PEOPLE_SQL)
