"""A star over the order tables, with the untidiness of real delivery files.

``raw_lines`` turns the typed order tables into all-text rows with blanks, leading
zeros, bad numbers, odd dates and missing codes, so that every step has work to do.
"""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.lookup import BROADCAST_BYTES, Side
from starloom.specs import Column, Dimension, Source, Star

LINES = Source(
    columns=(
        Column("period", comment="Shipping year"),
        Column("supp_cd", comment="Supplier code"),
        Column("supp_name", comment="Supplier name"),
        Column("supp_tax_id", comment="Supplier tax id, leading zeros kept"),
        Column("supp_class", comment="Supplier class, changes over the years"),
        Column("region", comment="Customer region"),
        Column("city_cd", comment="Customer city code, sometimes missing"),
        Column("city_name", comment="Customer city name"),
        Column("band", comment="Part size band"),
        Column("band_group", comment="Group of part size bands"),
        Column("qty_active", "int", "Quantity ordered"),
        Column("qty_joined", "int", "Line number"),
        Column("qty_left", "int", "1 when returned"),
        Column("load_dt", "date", "Shipping date"),
    ),
    partition_by=("region", "period"),
    shards="shard=*/*.csv",
    raw_table="raw_lines",
    clean_table="clean_lines",
)

SUPPLIER = Dimension("dim_supplier", "supplier_sk", "supp_cd", ("supp_name", "supp_tax_id", "supp_class"), comments=LINES.comments, comment="Suppliers")
CITY = Dimension("dim_city", "city_sk", "city_cd", ("city_name", "region"), comments=LINES.comments, comment="Customer cities")
BAND = Dimension("dim_band", "band_sk", "band", ("band_group",), comments=LINES.comments, comment="Part size bands")

ORDER_LINES = Star(
    source=LINES,
    dimensions=(SUPPLIER, CITY, BAND),
    fact_table="fact_lines",
    measures=("qty_active", "qty_joined", "qty_left"),
    period="period",
    view="star_lines",
)

# A second dimension whose members come and go and change between two loads.
CUSTOMER = Dimension("dim_customer", "customer_sk", "cust_cd", ("cust_name", "segment", "city_cd"))


# The columns read from each order table. Declaring them spares a schema-inference job per table.
TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_size int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def padded(col: SparkColumn, width: int) -> SparkColumn:
    """Leading zeros up to ``width`` digits; longer numbers stay whole (``lpad`` would cut them)."""
    text = col.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def _small(frame: DataFrame) -> DataFrame:
    """The frame, marked for broadcast if its measured size allows; what file sizes say of a wide table is of no use."""
    return F.broadcast(frame) if Side(frame).fits(BROADCAST_BYTES) else frame


def raw_lines(spark: SparkSession, sf_dir: str, gather: bool = False) -> DataFrame:
    """One all-text row per order line.

    Lines, the largest table, are shuffled by order key and, where parts are too many to broadcast,
    by part key. Only numbers and codes take part in that; texts join and are rendered afterwards.
    ``gather`` brings the rows of a customer nation and year together while they are still narrow, so
    they arrive the way deliveries do: a task holds few regions and periods. Equal rows either way.
    """
    nation = table(spark, sf_dir, "nation")
    customers = _small(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    parts = _small(table(spark, sf_dir, "part"))
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .drop("l_partkey", "p_partkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .drop("o_orderkey")
    )
    supplier_nation = nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("supp_nation"))
    suppliers = table(spark, sf_dir, "supplier").join(_small(supplier_nation), F.col("s_nationkey") == F.col("sn_key"))
    suppliers = suppliers.select("s_suppkey", "s_name", "supp_nation")
    few, own = Side(suppliers).fits(BROADCAST_BYTES), F.col("l_suppkey") == F.col("s_suppkey")
    if not few:
        lines = lines.join(suppliers, own)  # this shuffles, so it comes before rows are gathered
    if gather:
        lines = lines.withColumn("_year", F.year("l_shipdate")).hint("rebalance", "c_nationkey", "_year")
    if few:
        lines = lines.join(F.broadcast(suppliers), own)
    cities = nation.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cities = cities.select(F.col("n_nationkey").alias("city_key"), F.col("n_name").alias("city"), "r_name")
    lines = lines.join(_small(cities), F.col("c_nationkey") == F.col("city_key"))
    year, order = F.year("l_shipdate"), F.col("l_orderkey")

    def size_group(width: int) -> SparkColumn:
        return F.floor((F.col("p_size") - 1) / width).cast("int")

    return lines.select(
        year.cast("string").alias("period"),
        padded(F.col("l_suppkey"), 6).alias("supp_cd"),
        F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("supp_name"),
        padded(F.col("s_suppkey") * 7919, 14).alias("supp_tax_id"),
        F.concat("supp_nation", F.when(year < 1998, "_OLD").otherwise("")).alias("supp_class"),
        F.col("r_name").alias("region"),
        F.when(order % 97 != 0, padded(F.col("city_key"), 4)).alias("city_cd"),
        F.concat(F.lit(" "), "city").alias("city_name"),
        padded(size_group(5), 2).alias("band"),
        size_group(10).cast("string").alias("band_group"),
        F.when(order % 101 == 0, "n/a")
        .otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string")))
        .alias("qty_active"),
        F.col("l_linenumber").cast("string").alias("qty_joined"),
        F.when(F.col("l_returnflag") == "R", "1").otherwise("0").alias("qty_left"),
        F.when(order % 103 == 0, "31/12/1999")
        .otherwise(F.col("l_shipdate").cast("date").cast("string"))
        .alias("load_dt"),
    )


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each order says about its customer, by year.

    Every tenth customer changes segment each year, every seventh has no city before 1998,
    every eleventh goes by a new code from 1998 on, and some orders lack the code.
    """
    year, key = F.year("o_orderdate"), F.col("c_custkey")
    renewed = F.when((key % 11 == 0) & (year >= 1998), "B").otherwise("")
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    return orders.select(
        year.cast("string").alias("period"),
        F.when(F.col("o_orderkey") % 97 != 0, F.concat(padded(key, 9), renewed)).alias("cust_cd"),
        F.col("c_name").alias("cust_name"),
        F.when(key % 10 == 0, F.concat("c_mktsegment", F.lit("_"), year.cast("string")))
        .otherwise(F.col("c_mktsegment"))
        .alias("segment"),
        F.when((key % 7 != 0) | (year >= 1998), padded(F.col("c_nationkey"), 4)).alias("city_cd"),
    )
