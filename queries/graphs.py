"""Graphs and text lines derived from whole test tables.

Every graph is given twice, as Spark DataFrame and as SQL text. The line expressions are valid in
both SQL dialects and are shared.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Line items that one task of a join sorts.
ROWS_PER_TASK = 2_000_000

# Each line item as a line of an edge list, in the seven shapes an edge list may contain.
EDGE_LINE = """CASE l_linenumber
    WHEN 1 THEN concat('P', l_partkey, chr(9), 'S', l_suppkey)
    WHEN 2 THEN concat('  P', l_partkey, '   S', l_suppkey, ' ')
    WHEN 3 THEN concat('# P', l_partkey, chr(9), 'S', l_suppkey)
    WHEN 4 THEN concat('P', l_partkey, chr(9), 'S', l_suppkey, chr(9), 'L', l_orderkey)
    WHEN 5 THEN concat('P', l_partkey)
    WHEN 6 THEN concat(chr(9), ' ')
    ELSE concat('P', l_partkey, chr(9), chr(9), 'S', l_suppkey) END"""

# Each line item as a line of a record file, well formed or not.
RECORD_LINE = """CASE l_linenumber
    WHEN 1 THEN concat('P', l_partkey, chr(9), 'S', l_suppkey, ',S', l_suppkey + 1)
    WHEN 2 THEN concat(' P', l_partkey, chr(9))
    WHEN 3 THEN concat('P', l_partkey, chr(9), l_discount, chr(9), 'S', l_suppkey, ',, S', l_orderkey, ',')
    WHEN 4 THEN concat('P', l_partkey, chr(9), 'none', chr(9), 'S', l_suppkey)
    WHEN 5 THEN concat(' ', chr(9), 'S', l_suppkey)
    WHEN 6 THEN concat('P', l_partkey)
    ELSE concat('P', l_partkey, chr(9), '1e-3', chr(9)) END"""

# Each line item as a well-formed edge line.
PLAIN_EDGE_LINE = "concat('P', l_partkey, chr(9), 'S', l_suppkey)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def join_tasks(rows: DataFrame) -> int:
    """Tasks for a join of a table as large as this, so that what one of them sorts doesn't grow with the table; 0 for a table that one task can hold."""
    wanted = ceil(rows.count() / ROWS_PER_TASK)
    return max(wanted, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))) if wanted > 1 else 0


def item_lines(spark: SparkSession, folder: str, expression: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(F.expr(expression).alias("value"))


def part_supp(spark: SparkSession, folder: str) -> DataFrame:
    """Part to supplier, once per line item; every supplier is dangling."""
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("src"),
        F.concat(F.lit("S"), "l_suppkey").alias("dst"),
    )


def part_supp_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """The same with bare numbers, so that parts and suppliers share ids."""
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("src"),
        F.col("l_suppkey").cast("string").alias("dst"),
    )


def trade(spark: SparkSession, folder: str) -> DataFrame:
    """Customer to part to supplier to nation, and nation back to its customers and to its region."""
    lineitem = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    tasks = join_tasks(lineitem)
    if tasks:
        lineitem, orders = lineitem.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    bought = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    supplier = table(spark, folder, "supplier")
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")

    def link(df: DataFrame, kind: str, source: str, other: str, target: str) -> DataFrame:
        return df.select(
            F.concat(F.lit(kind), source).alias("src"), F.concat(F.lit(other), target).alias("dst")
        )

    return (
        link(bought, "C", "o_custkey", "P", "l_partkey")
        .union(part_supp(spark, folder))
        .union(link(supplier, "S", "s_suppkey", "N", "s_nationkey"))
        .union(link(customer, "N", "c_nationkey", "C", "c_custkey"))
        .union(link(nation, "N", "n_nationkey", "R", "n_regionkey"))
    )


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    """Page to every address it links to."""
    targets = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return table(spark, folder, "pages").select(
        F.col("url").alias("src"), F.explode(targets).alias("dst")
    )


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    """Adjacency records of the pages only; most link targets have no record."""
    targets = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return table(spark, folder, "pages").select(
        F.col("url").alias("id"), targets.alias("neighbors")
    )


def nation_trade(spark: SparkSession, folder: str) -> DataFrame:
    """Nation of the customer to nation of the supplier, once per line item."""
    lineitem = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, folder, "nation")
    buyer = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("src"))
    seller = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("dst"))
    return (
        lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(buyer, "c_nationkey")
        .join(seller, "s_nationkey")
        .select("src", "dst")
    )


SQL = {
    "part_supp": "SELECT concat('P', l_partkey) AS src, concat('S', l_suppkey) AS dst FROM lineitem",
    "part_supp_numbers": (
        "SELECT CAST(l_partkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem"
    ),
    "trade": """
        SELECT concat('C', o_custkey) AS src, concat('P', l_partkey) AS dst
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION ALL SELECT concat('P', l_partkey), concat('S', l_suppkey) FROM lineitem
        UNION ALL SELECT concat('S', s_suppkey), concat('N', s_nationkey) FROM supplier
        UNION ALL SELECT concat('N', c_nationkey), concat('C', c_custkey) FROM customer
        UNION ALL SELECT concat('N', n_nationkey), concat('R', n_regionkey) FROM nation""",
    "page_links": """
        SELECT url AS src, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst FROM pages""",
    "nation_trade": """
        SELECT b.n_name AS src, s.n_name AS dst
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation b ON b.n_nationkey = c_nationkey
        JOIN nation s ON s.n_nationkey = s_nationkey""",
}
