"""The driver's tables in the roles of the ranking: observations, families, aliases, edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import table


def observations(spark: SparkSession, d: str) -> DataFrame:
    """events as observations: source (event_type), family (user_id), value, day, week (its Monday)."""
    day = F.to_date("ts")
    return table(spark, d, "events").select(F.col("event_type").alias("source"), F.col("user_id").alias("family"), "value", day.alias("day"), F.date_sub(day, F.weekday(day)).alias("week"))


def terms(spark: SparkSession, d: str) -> DataFrame:
    """One value by source and family, rounded so that ties are ties in any engine."""
    return observations(spark, d).groupBy("source", "family").agg(F.round(F.sum("value"), 2).alias("x"))


def counts(spark: SparkSession, d: str) -> DataFrame:
    """The ruler's counts: open urgent orders by customer, who is the family; families without one are off the ruler."""
    o = table(spark, d, "orders").where((F.col("o_orderstatus") == "O") & F.startswith("o_orderpriority", F.lit("1")))
    return o.groupBy(F.col("o_custkey").alias("family")).agg(F.count(F.lit(1)).alias("n"))


def parts(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as counts of packages (parts) that belong to families (brands)."""
    n = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("package")).agg(F.sum("l_quantity").alias("n"))
    return n.join(table(spark, d, "part").select(F.col("p_partkey").alias("package"), F.col("p_brand").alias("family")), "package")


def monthly(spark: SparkSession, d: str) -> DataFrame:
    """orders by priority (source) and month number."""
    o = table(spark, d, "orders")
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).alias("month")
    return o.groupBy(F.col("o_orderpriority").alias("source"), month).agg(F.sum("o_totalprice").alias("x"), F.count(F.lit(1)).alias("n"))


#: The same views as DuckDB SQL.
SQL = {
    "obs": "select event_type source, user_id family, value, ts::date as day, date_trunc('week', ts)::date as week from events",
    "terms": "select event_type source, user_id family, round(sum(value), 2) x from events group by all",
    "counts": "select o_custkey family, count(*) n from orders where o_orderstatus = 'O' and o_orderpriority like '1%' group by all",
    "parts": "select l_partkey package, p_brand family, sum(l_quantity) n from lineitem join part on l_partkey = p_partkey group by all",
    "monthly": "select o_orderpriority source, year(o_orderdate) * 12 + month(o_orderdate) - 1 as month, sum(o_totalprice) x, count(*) n from orders group by all",
}


def sql(body: str, *names: str) -> str:
    """SQL over the named views; body starts with its own further CTEs (', x as (...) select') or with select."""
    return "with " + ", ".join(f"{n} as ({SQL[n]})" for n in names) + " " + body
