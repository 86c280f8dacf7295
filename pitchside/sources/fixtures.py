"""Driver test tables → raw sources in the reference's own shape.

``matches_raw`` is lineitem ⋈ orders ⋈ customer ⋈ nation(home) ⋈ supplier ⋈
nation(away); ``readings_raw`` is orders ⋈ customer ⋈ nation restricted to
finished orders outside region 4 (gaps on purpose, so exact, fallback and
unmatched rows all occur).  Each raw row carries ``src_pos``: the file order
of the source (a total order), used wherever the reference keeps "the first"
row.  ``dirty=True`` swaps in deterministic bad cells for the cleaning rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

MATCH_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
               "l_extendedprice")


# fact-sized tables: their scans must run on every core
LARGE = ("lineitem", "orders")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from pitchside.schemas import SOURCE_TABLES
    reader = spark.read
    if name in SOURCE_TABLES:
        reader = reader.schema(SOURCE_TABLES[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def large_table(spark: SparkSession, sf_dir: str, name: str, columns, key: str | None = None) -> DataFrame:
    """Pruned scan of a fact-sized table, spread over the cores if it is one split.

    With the ``key`` of its next join, many rows are dealt by it into tasks of a bounded number of rows."""
    from pitchside.sources.io import bound_task_rows, ensure_parallelism
    rows = table(spark, sf_dir, name).select(*columns)
    return bound_task_rows(rows, key) if key else ensure_parallelism(rows)


def matches_raw(spark: SparkSession, sf_dir: str, *, dirty: bool = False) -> DataFrame:
    li = large_table(spark, sf_dir, "lineitem", [*MATCH_ORDER, "l_returnflag"], key="l_orderkey")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    hn = n.select(F.col("n_nationkey").alias("h_key"), F.col("n_name").alias("h_name"))
    an = n.select(F.col("n_nationkey").alias("a_key"), F.col("n_name").alias("a_name"))

    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, o.o_custkey == c.c_custkey)
         .join(hn, F.col("c_nationkey") == F.col("h_key"))
         .join(s, li.l_suppkey == s.s_suppkey)
         .join(an, F.col("s_nationkey") == F.col("a_key")))

    day = F.to_date("o_orderdate")
    iso = F.date_format(day, "yyyy-MM-dd")
    home_goals = F.col("l_linenumber").cast("string")
    home_team = F.col("h_name")
    if dirty:
        key = F.col("l_orderkey")
        iso = F.when(key % 97 == 0, F.lit("bad")).otherwise(iso)
        home_goals = (F.when(key % 89 == 0, F.lit("x"))
                      .when(key % 83 == 0, F.lit(None).cast("string"))
                      .otherwise(home_goals))
        home_team = F.when(key % 10 == 0, F.concat(F.lit("  "), home_team, F.lit("  "))) \
                     .otherwise(home_team)
    return j.select(
        F.year(day).alias("Year"),
        iso.alias("Date"),
        F.lit(None).cast("string").alias("Time"),
        F.col("l_returnflag").alias("Round"),
        F.col("o_orderpriority").alias("Stadium"),
        F.col("c_mktsegment").alias("City"),
        F.col("h_name").alias("Country"),
        home_team.alias("HomeTeam"),
        home_goals.alias("HomeGoals"),
        (F.col("l_quantity").cast("int") % 8).cast("string").alias("AwayGoals"),
        F.col("a_name").alias("AwayTeam"),
        F.lit(None).cast("string").alias("Observation"),
        F.struct(*MATCH_ORDER).alias("src_pos"),
    )


def readings_raw(spark: SparkSession, sf_dir: str, *, dirty: bool = False) -> DataFrame:
    o = large_table(spark, sf_dir, "orders",
                    ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = (o.where(F.col("o_orderstatus") == "F")
         .join(c, o.o_custkey == c.c_custkey)
         .join(n.where(F.col("n_regionkey") != 4), F.col("c_nationkey") == F.col("n_nationkey")))
    temp = F.col("o_totalprice") / F.lit(10000)
    if dirty:
        key = F.col("o_orderkey")
        temp = (F.when(key % 53 == 0, F.lit(-99.0))
                .when(key % 59 == 0, F.lit(float("nan")))
                .otherwise(temp))
    return j.select(
        F.col("n_name").alias("Entity"),
        F.col("n_nationkey").cast("string").alias("Code"),
        F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd").alias("Month"),
        temp.alias("Monthly average"),
        F.struct("o_orderkey").alias("src_pos"),
    )
