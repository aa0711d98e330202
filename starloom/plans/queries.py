"""One query per capability, each over the whole given tables.

A query takes (spark, folder of tables) and returns a DataFrame. Those that check loading
write tables of their own. Those that check what a load has produced read one load of the
order-lines star, done once per session and folder and kept as tables, the way analyses
read a warehouse that was loaded before.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import UNKNOWN_KEY, legacy_int, surrogate_key
from starloom.models.order_lines import (
    CITY,
    CUSTOMER,
    LINES,
    ORDER_LINES,
    SUPPLIER,
    customer_history,
    padded,
    raw_lines,
    table,
)
from starloom.operators.clean import clean
from starloom.operators.clustering import fact_files
from starloom.operators.dimensions import dimension_rows, latest_members
from starloom.operators.fact import fact_rows
from starloom.operators.numbering import numbered
from starloom.operators.star import Mart, ranking, star_view
from starloom.plans.catalog import publish_catalog
from starloom.plans.cobuckets import open_cobuckets, store_cobuckets
from starloom.plans.intake import ingest_new, ingest_screened, read_quarantine
from starloom.plans.loads import (
    Layout,
    build_fact,
    clean_step,
    full_load,
    ingest,
    land,
    open_mart,
    publish_views,
    report_frame,
    transform,
)
from starloom.plans.profiles import (
    DISTINCT_ERROR,
    RANK_ERROR,
    TOP_ERROR,
    as_number,
    profile,
    profiled_fields,
    refresh_profile,
)
from starloom.sources.catalog import table_columns
from starloom.sources.commits import DimensionStore
from starloom.sources.delimited import read_shards, write_mixed_shards, write_shards
from starloom.sources.screening import FAULT, FILE, LINE
from starloom.sources.tables import SchemaMismatch, even_tasks, read_table, spare_sort
from starloom.sources.workspace import new_folder
from starloom.specs import Dimension, Rollup, Source

Query = Callable[[SparkSession, str], DataFrame]

TEXTS = LINES.file_schema.names
FAULTY_LINES = replace(LINES, shards="shard=*/*.txt")
DROPPED_LINES = replace(LINES, shards="drop=*/shard=*/*.csv")
NEW_CODE_YEAR = "1998"
FIRST_RUN, SECOND_RUN = "2024-01-01 00:00:00", "2024-02-01 00:00:00"

_once: dict[tuple[str, str, str], str] = {}


def _kept(spark: SparkSession, sf_dir: str, label: str, fill: Callable[[str], None]) -> str:
    """A folder filled once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _once:
        folder = new_folder(spark, label)
        fill(folder)
        _once[key] = folder
    return _once[key]


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines as they are delivered: joined, gathered and rendered once per session, then read.

    Files hold few regions and periods each, so they land and become shards without another shuffle.
    """

    def fill(folder: str) -> None:
        even_tasks(spark)
        raw_lines(spark, sf_dir, gather=True).write.mode("overwrite").parquet(folder)

    return read_table(spark, _kept(spark, sf_dir, "delivered", fill), LINES.file_schema)


def shard_folder(spark: SparkSession, sf_dir: str) -> str:
    """The order lines laid out as text shards."""
    return _kept(spark, sf_dir, "shards", lambda folder: write_shards(delivered(spark, sf_dir), LINES, folder, gather=False))


def loaded(spark: SparkSession, sf_dir: str) -> Layout:
    """The order-lines star, loaded."""

    def load(folder: str) -> None:
        layout = Layout(folder, ORDER_LINES)
        land(delivered(spark, sf_dir), layout, gather=False)
        transform(spark, layout)

    return Layout(_kept(spark, sf_dir, "mart", load), ORDER_LINES)


def fresh(spark: SparkSession, label: str) -> Layout:
    return Layout(new_folder(spark, label), ORDER_LINES)


def _with_source(layout: Layout, source: Source) -> Layout:
    return replace(layout, star=replace(layout.star, source=source))


def at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp")


# --- sources, sinks, tables


def ingest_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards read back through the raw table: every column of every row."""
    layout = fresh(spark, "ingest")
    ingest(spark, layout, shard_folder(spark, sf_dir))
    return layout.read_raw(spark).select(*TEXTS)


def shard_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per shard folder, by the file each row was read from."""
    rows = read_shards(spark, LINES, shard_folder(spark, sf_dir))
    folder = F.regexp_extract(F.url_decode("_metadata.file_path"), "shard=([^/]+)/", 1)
    return rows.groupBy(folder.alias("shard")).agg(F.count(F.lit(1)).alias("n_rows"))


def partition_overwrite_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing the same rows twice leaves them there once."""
    layout = fresh(spark, "rerun")
    for _ in range(2):
        land(raw_lines(spark, sf_dir), layout)
    return layout.read_raw(spark).groupBy("region", "period").agg(F.count(F.lit(1)).alias("n_rows"))


def partition_overwrite_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch with doubled numbers replaces the partitions it holds and no others."""
    layout = fresh(spark, "replace")
    rows = raw_lines(spark, sf_dir)
    land(rows, layout)
    later = rows.where((F.col("region") == "ASIA") & (F.col("period") >= NEW_CODE_YEAR))
    land(later.withColumn("qty_joined", (F.col("qty_joined").cast("int") * 2).cast("string")), layout)
    joined = F.col("qty_joined").cast("int")
    return layout.read_raw(spark).groupBy("region", "period").agg(F.sum(joined).alias("joined"))


def schema_lock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes with a changed type and with an extra column are refused; the rows stay."""
    layout = fresh(spark, "lock")
    rows = raw_lines(spark, sf_dir)
    land(rows, layout)
    refused = 0
    for changed in (
        rows.withColumn("qty_joined", F.col("qty_joined").cast("int")),
        rows.withColumn("extra", F.lit("x")),
    ):
        try:
            land(changed, layout)
        except SchemaMismatch:
            refused += 1
    counts = layout.read_raw(spark).groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("refused", F.lit(refused))


def table_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns of the clean table in the catalog, with the values each one holds."""
    publish_catalog(spark, loaded(spark, sf_dir), prefix="lines_")
    name = f"lines_silver.{LINES.clean_table}"
    filled = spark.table(name).agg(*[F.count(c).alias(c) for c in LINES.clean_schema.names])
    per_column = filled.unpivot([], LINES.clean_schema.names, "column_name", "n_values")
    declared = table_columns(spark, name).select(
        "column_name", "data_type", "comment", F.col("is_partition").cast("int").alias("is_partition")
    )
    return declared.join(per_column, "column_name")


def catalog_star_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the star view in the catalog."""
    publish_catalog(spark, loaded(spark, sf_dir), prefix="lines_")
    return spark.sql(
        f"""SELECT region, supp_class, band_group, SUM(qty_active) AS active, SUM(qty_left) AS gone
            FROM lines_gold.{ORDER_LINES.view} GROUP BY region, supp_class, band_group"""
    )


def named_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over temp views of the loaded tables."""
    publish_views(spark, loaded(spark, sf_dir), prefix="v_")
    return spark.sql(
        f"""SELECT period, city_name, COUNT(*) AS n_rows, SUM(qty_active) AS active
            FROM v_{ORDER_LINES.view} GROUP BY period, city_name"""
    )


# --- cleaning and keys


def clean_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_lines(spark, sf_dir), LINES).drop(LINES.loaded_at)


def clean_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many numbers and dates could not be read, per region."""
    rows = clean(raw_lines(spark, sf_dir), LINES)
    return rows.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("qty_active").isNull()).alias("bad_numbers"),
        F.count_if(F.col("load_dt").isNull()).alias("bad_dates"),
    )


def legacy_int_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven ways of writing an order key, one per line number, read as integers."""
    number, key = F.col("l_linenumber"), F.col("l_orderkey").cast("string")
    text = (
        F.when(number == 1, F.concat(F.lit("\t "), key, F.lit(" \n")))
        .when(number == 2, F.concat(key, F.lit(".75")))
        .when(number == 3, F.concat(F.lit("-"), key, F.lit(".")))
        .when(number == 4, F.concat(F.lit("."), key))
        .when(number == 5, F.concat(F.lit("+"), key))
        .when(number == 6, F.concat(key, F.lit("e2")))
        .otherwise(F.concat(F.lit("9999999999"), key))
    )
    rows = table(spark, sf_dir, "lineitem").select(number.alias("form"), legacy_int(text).alias("value"))
    return rows.groupBy("form").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_read"), F.sum("value").alias("total")
    )


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct business keys and their surrogate keys: as many, none negative."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    codes = (
        lines.select(F.lit("order").alias("kind"), padded(F.col("l_orderkey"), 12).alias("bk"))
        .union(lines.select(F.lit("part"), padded(F.col("l_partkey"), 8)))
        .union(lines.select(F.lit("supplier"), padded(F.col("l_suppkey"), 6)))
        .union(orders.select(F.lit("customer"), padded(F.col("o_custkey"), 9)))
        .distinct()
    )
    keyed = codes.select("kind", surrogate_key(F.col("bk")).alias("sk"))
    per_key = keyed.groupBy("kind", "sk").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("kind").agg(
        F.sum("n").alias("n_keys"),
        F.count(F.lit(1)).alias("n_surrogates"),
        F.count_if(F.col("sk") < 0).alias("n_negative"),
    )


# --- dimensions


def _members(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        dim = ORDER_LINES.dimension(name)
        return loaded(spark, sf_dir).dimensions(spark).read(dim).select(dim.bk, *dim.attributes)

    return query


def _customer_batches(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, Column]]:
    """Customers as the orders before 1998 show them, then as those from 1998 on do."""
    history = customer_history(spark, sf_dir)
    batches = []
    for rows, moment in (
        (history.where(F.col("period") < NEW_CODE_YEAR), FIRST_RUN),
        (history.where(F.col("period") >= NEW_CODE_YEAR), SECOND_RUN),
    ):
        members = latest_members(rows, CUSTOMER, "period")
        batches.append((dimension_rows(members, CUSTOMER, at(moment)), at(moment)))
    return batches


def _merged_customers(spark: SparkSession, sf_dir: str, null_safe: bool = True) -> tuple[DimensionStore, DataFrame]:
    store = DimensionStore(spark, new_folder(spark, "customers"))
    for source, moment in _customer_batches(spark, sf_dir):
        store.upsert(CUSTOMER, source, moment, null_safe)
    return store, store.read(CUSTOMER)


def scd1_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge of all customers into a dimension that does not exist yet."""
    store = DimensionStore(spark, new_folder(spark, "customers"))
    members = latest_members(customer_history(spark, sf_dir), CUSTOMER, "period")
    store.upsert(CUSTOMER, dimension_rows(members, CUSTOMER, at(FIRST_RUN)), at(FIRST_RUN))
    return store.read(CUSTOMER).select(CUSTOMER.bk, *CUSTOMER.attributes)


def scd1_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members after a second merge, with what it did to each."""
    _, customers = _merged_customers(spark, sf_dir)
    created, updated = F.col(CUSTOMER.created_at), F.col(CUSTOMER.updated_at)
    return customers.select(
        CUSTOMER.bk,
        *CUSTOMER.attributes,
        (created == at(SECOND_RUN)).cast("int").alias("is_new"),
        (updated > created).cast("int").alias("was_updated"),
    )


def _both_modes(query: Callable[[SparkSession, str, bool], DataFrame]) -> Query:
    def both(spark: SparkSession, sf_dir: str) -> DataFrame:
        plain, safe = (query(spark, sf_dir, null_safe) for null_safe in (False, True))
        return plain.withColumn("mode", F.lit("plain")).union(safe.withColumn("mode", F.lit("null_safe")))

    return both


@_both_modes
def scd1_null_attr(spark: SparkSession, sf_dir: str, null_safe: bool) -> DataFrame:
    """A city that turns from NULL into a value counts as a change only when null-safe."""
    _, customers = _merged_customers(spark, sf_dir, null_safe)
    return customers.where(F.col(CUSTOMER.bk).isNotNull()).select(CUSTOMER.bk, *CUSTOMER.attributes)


@_both_modes
def scd1_null_key(spark: SparkSession, sf_dir: str, null_safe: bool) -> DataFrame:
    """The NULL key is inserted by each run unless comparison is null-safe."""
    _, customers = _merged_customers(spark, sf_dir, null_safe)
    return customers.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(CUSTOMER.bk).isNull()).alias("null_keys")
    )


def scd1_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merging the same members again inserts and updates nothing."""
    store = DimensionStore(spark, new_folder(spark, "suppliers"))
    members = latest_members(loaded(spark, sf_dir).read_clean(spark), SUPPLIER, "period")
    for moment in (FIRST_RUN, SECOND_RUN):
        store.upsert(SUPPLIER, dimension_rows(members, SUPPLIER, at(moment)), at(moment))
    return store.log(SUPPLIER).select("version", "rows_source", "rows_inserted", "rows_updated", "rows_total")


def merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commit log after two merges."""
    store, _ = _merged_customers(spark, sf_dir)
    return store.log(CUSTOMER).select(
        "table_name", "version", "operation", "rows_source", "rows_inserted", "rows_updated", "rows_total"
    )


MANY_BUCKETS = 4096  # bytes a bucket, where that makes no more than SEEN_BUCKETS of them
SEEN_BUCKETS = 64  # enough at any scale to see which are left alone; every one is a folder


def _bucketed_customers(spark: SparkSession, sf_dir: str) -> DimensionStore:
    """Both batches merged into a dimension of many buckets, the second one once more, then one renamed customer."""
    store = DimensionStore(spark, new_folder(spark, "buckets"))
    (old, first), (new, second) = _customer_batches(spark, sf_dir)
    size = store.upsert(CUSTOMER, old, first)["bytes_total"]
    store = replace(store, bucket_bytes=max(MANY_BUCKETS, size // SEEN_BUCKETS))
    for _ in range(2):
        store.upsert(CUSTOMER, new, second)
    least = store.read(CUSTOMER).agg(F.min(CUSTOMER.bk)).first()[0]
    one = store.read(CUSTOMER).where(F.col(CUSTOMER.bk) == least).withColumn("cust_name", F.lit("renamed"))
    store.upsert(CUSTOMER, one, second)
    return store


def scd1_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members after merges that rewrote only the buckets they changed."""
    return _bucketed_customers(spark, sf_dir).read(CUSTOMER).select(CUSTOMER.bk, *CUSTOMER.attributes)


def merge_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commit log of those merges: none of a merge that changes nothing is rewritten, one bucket for one member."""
    log = _bucketed_customers(spark, sf_dir).log(CUSTOMER)
    few = F.when(F.col("version") > 2, F.col("buckets_rewritten"))
    return log.select(
        "version", "rows_source", "rows_inserted", "rows_updated", "rows_rekeyed", "rows_total",
        few.alias("few_rewritten"), (F.size("buckets") > 1).cast("int").alias("in_buckets"),
    )


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two merges inserted and changed: operation and version, attributes before and after."""
    store, _ = _merged_customers(spark, sf_dir)
    shown = [F.col(f"{image}.{a}").alias(f"{a}_{image}") for image in ("before", "after") for a in CUSTOMER.attributes]
    return store.changes(CUSTOMER).select("version", "operation", F.col(f"after.{CUSTOMER.bk}").alias(CUSTOMER.bk), *shown)


def replayed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each version of the customers, from the change feed alone."""
    store, _ = _merged_customers(spark, sf_dir)
    versions = [store.replayed(CUSTOMER, v).withColumn("version", F.lit(v)) for v in (1, 2)]
    return versions[0].union(versions[1]).select("version", CUSTOMER.bk, *CUSTOMER.attributes)


# --- keys that hashes share


def _narrow_loads(spark: SparkSession, sf_dir: str) -> list[Layout]:
    """The star with surrogate keys so narrow that many hashes are shared, loaded late and early periods first.

    Suppliers have other codes from 1998 on if theirs ends in 7, so each batch brings members the other lacks.
    """
    commits = loaded(spark, sf_dir).dimensions(spark).last_commits(ORDER_LINES.dimensions)
    dims = [replace(d, key_bits=(3 * commits[d.name]["rows_total"]).bit_length()) for d in ORDER_LINES.dimensions]
    star, late = replace(ORDER_LINES, dimensions=tuple(dims)), F.col("period") >= NEW_CODE_YEAR
    recoded = F.when(late & F.col("supp_cd").endswith("7"), F.concat(F.lit("0"), "supp_cd")).otherwise(F.col("supp_cd"))
    layouts = []
    for order in ((late, ~late), (~late, late)):
        layout = Layout(new_folder(spark, "narrow"), star)
        for batch in order:
            rows = delivered(spark, sf_dir).withColumn("supp_cd", recoded).where(batch)
            land(rows, layout, gather=False)
            # as many values as the raw table has period folders of this batch
            years = [r[0] for r in layout.read_raw(spark).where(batch).select("period").distinct().collect()]
            transform(spark, layout, periods=years)
        layouts.append(layout)
    return layouts


def shared_hash_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with narrow keys: a key for each, the same whichever periods came first, and their totals right."""
    one, other = _narrow_loads(spark, sf_dir)
    dim = one.star.dimension(SUPPLIER.name)
    keys = one.dimensions(spark).read(dim).select(dim.bk, dim.sk)
    others = other.dimensions(spark).read(dim).select(dim.bk, F.col(dim.sk).alias("_sk"))
    shared = keys.groupBy(dim.sk).agg(F.count(F.lit(1)).alias("n_with_key"))
    same = keys.join(others, dim.bk).join(shared, dim.sk)
    same = same.select(dim.bk, (F.col(dim.sk) == F.col("_sk")).cast("int").alias("same_key"), "n_with_key")
    for name, layout in (("total_active", one), ("total_again", other)):
        totals = ranking(open_mart(spark, layout), [dim.bk], "qty_active", name)
        same = same.join(totals, dim.bk, "left")
    return same


def shared_hash_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by members of all three dimensions, joined on narrow keys, after periods came in two batches."""
    one, _ = _narrow_loads(spark, sf_dir)
    return ranking(open_mart(spark, one), ["supp_cd", "city_cd", "band"], "qty_joined", "total")


# --- rollups


ROLLED = replace(
    ORDER_LINES,
    rollups=(Rollup("supplier", ("dim_supplier",)), Rollup("city_and_band", ("dim_city", "dim_band"), ("region",))),
)


def _rolled(spark: SparkSession, sf_dir: str) -> tuple[Layout, DataFrame]:
    """A star with rollups, loaded whole, then 1995 delivered again with doubled numbers; the rollup files before that."""
    layout, rows = Layout(new_folder(spark, "rolled"), ROLLED), delivered(spark, sf_dir)
    land(rows, layout, gather=False)
    transform(spark, layout)
    path = F.col("_metadata.file_path").alias("path")
    before = spark.read.parquet(layout.rollup(ROLLED.rollups[0])).select("period", path).distinct()
    folder = new_folder(spark, "rollup-files")
    before.write.parquet(folder)
    again = rows.where(F.col("period") == "1995")
    land(again.withColumn("qty_joined", (F.col("qty_joined").cast("int") * 2).cast("string")), layout, gather=False)
    transform(spark, layout, periods=["1995"])
    return layout, spark.read.parquet(folder)


def rollup_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and region bands ranked from the rollups after one period was loaded again."""
    layout, _ = _rolled(spark, sf_dir)
    # a fact without rows: the totals can only come from rollups
    mart = open_mart(spark, layout)
    mart = replace(mart, fact=mart.fact.where("false"))
    suppliers = ranking(mart, ["supp_cd", "supp_class"], "qty_joined").select(F.lit("supplier").alias("by"), F.col("supp_cd").alias("who"), "total")
    bands = ranking(mart, ["region", "band"], "qty_joined")
    return suppliers.union(bands.select(F.lit("band"), F.concat_ws("/", "region", "band"), "total"))


def rollup_renewal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per period: fact rows the rollup counts, and whether its files are new after 1995 was loaded again."""
    layout, before = _rolled(spark, sf_dir)
    now = spark.read.parquet(layout.rollup(ROLLED.rollups[0])).withColumn("path", F.col("_metadata.file_path"))
    old = before.select(F.col("path").alias("old_path"))
    marked = now.join(old, F.col("path") == F.col("old_path"), "left")
    return marked.groupBy(F.col("period").cast("string").alias("period")).agg(
        F.sum("n_rows").alias("n_rows"), F.max(F.col("old_path").isNull().cast("int")).alias("is_new")
    )


def numbered_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier and city pairs by active quantity, with place, rank, dense rank and share."""
    totals = ranking(_mart(spark, sf_dir), ["supp_cd", "city_cd"], "qty_active", "total_active")

    def stored(rows: DataFrame, label: str) -> DataFrame:
        folder = new_folder(spark, label)
        rows.write.parquet(folder)
        return spark.read.schema(rows.schema).parquet(folder)

    return numbered(totals, "total_active", ["supp_cd", "city_cd"], stored)


# --- fact and star


def _fact_with_flags(fact: DataFrame) -> DataFrame:
    flags = [(F.col(d.sk) == UNKNOWN_KEY).cast("int").alias(f"no_{d.bk}") for d in ORDER_LINES.dimensions]
    return fact.select(*ORDER_LINES.partition_by, *ORDER_LINES.measures, *flags)


def fact_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fact row: partition keys, measures, which keys are unknown."""
    return _fact_with_flags(loaded(spark, sf_dir).read_fact(spark))


def fact_lines_large_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with every dimension treated as too large to broadcast."""
    layout = loaded(spark, sf_dir)
    members = open_mart(spark, layout).members
    return _fact_with_flags(fact_rows(layout.read_clean(spark), ORDER_LINES, members, limit=0))


def fact_unknown_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = _fact_with_flags(loaded(spark, sf_dir).read_fact(spark))
    names = [f"no_{d.bk}" for d in ORDER_LINES.dimensions]
    return flagged.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(n).alias(n) for n in names])


def fact_late_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts whose codes came up only after the dimensions were loaded: unknown, though not NULL."""
    layout, period = fresh(spark, "late"), F.col("period")
    late = {c: F.when((period >= NEW_CODE_YEAR) & F.col(c).endswith("3"), F.concat(c, F.lit("N"))).otherwise(F.col(c))
            for c in ("supp_cd", "city_cd", "band")}
    rows = delivered(spark, sf_dir).withColumns(late)
    land(rows.where(period < NEW_CODE_YEAR), layout, gather=False)
    transform(spark, layout)
    land(rows.where(period >= NEW_CODE_YEAR), layout, gather=False)
    clean_step(spark, layout)
    build_fact(spark, layout)
    names = [f"no_{d.bk}" for d in ORDER_LINES.dimensions]
    flagged = _fact_with_flags(layout.read_fact(spark))
    return flagged.groupBy("region").agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(n).alias(n) for n in names])


def star_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole star view."""
    return star_view(open_mart(spark, loaded(spark, sf_dir))).drop(LINES.loaded_at)


def star_rows_large_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole star view with every dimension treated as too large to broadcast."""
    return star_view(open_mart(spark, loaded(spark, sf_dir), limit=0)).drop(LINES.loaded_at)


def _cobucketed(spark: SparkSession, sf_dir: str) -> Mart:
    """The loaded star with lines and suppliers stored in equal buckets."""
    layout = loaded(spark, sf_dir)
    _kept(spark, sf_dir, "cobuckets", lambda _: store_cobuckets(spark, layout, SUPPLIER.name, buckets=8))
    return open_cobuckets(spark, layout, SUPPLIER.name, limit=0)


def star_rows_cobucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole star view, suppliers joined bucket by bucket and no dimension broadcast."""
    return star_view(_cobucketed(spark, sf_dir)).drop(LINES.loaded_at)


def top_suppliers_cobucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five greatest suppliers, summed and joined inside the buckets."""
    mart = _cobucketed(spark, sf_dir)
    return ranking(mart, ["supp_cd", "supp_name", "supp_class"], "qty_active", "total_active", limit=5)


def cobuckets_renewal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything bucketed, then one year delivered again with doubled numbers and bucketed again alone."""
    layout, rows = fresh(spark, "cobuckets"), delivered(spark, sf_dir)
    land(rows, layout, gather=False)
    transform(spark, layout)
    store_cobuckets(spark, layout, SUPPLIER.name, buckets=4)
    again = rows.where(F.col("period") == "1995")
    land(again.withColumn("qty_joined", (F.col("qty_joined").cast("int") * 2).cast("string")), layout, gather=False)
    transform(spark, layout, periods=["1995"])
    store_cobuckets(spark, layout, SUPPLIER.name, periods=["1995"])
    mart = open_cobuckets(spark, layout, SUPPLIER.name)
    return ranking(mart, ["period", "supp_cd", "supp_class"], "qty_joined", "total_joined")


# --- rankings


def _mart(spark: SparkSession, sf_dir: str) -> Mart:
    return open_mart(spark, loaded(spark, sf_dir))


def top_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five suppliers with the greatest active quantity."""
    return ranking(
        _mart(spark, sf_dir), ["supp_cd", "supp_name", "supp_class"], "qty_active", "total_active", limit=5
    )


def top_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size band with the greatest active quantity."""
    return ranking(_mart(spark, sf_dir), ["band"], "qty_active", "total_active", limit=1)


def city_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cities by active quantity, greatest first."""
    return ranking(_mart(spark, sf_dir), ["city_cd", "city_name", "region"], "qty_active", "total_active")


def top_suppliers_large_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same five with every dimension treated as too large to broadcast."""
    mart = open_mart(spark, loaded(spark, sf_dir), limit=0)
    return ranking(mart, ["supp_cd", "supp_name", "supp_class"], "qty_active", "total_active", limit=5)


def city_ranking_large_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranking with every dimension treated as too large to broadcast."""
    mart = open_mart(spark, loaded(spark, sf_dir), limit=0)
    return ranking(mart, ["city_cd", "city_name", "region"], "qty_active", "total_active")


def questions_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three rankings as SQL over the star view in the catalog."""
    publish_catalog(spark, loaded(spark, sf_dir), prefix="lines_")
    view = f"lines_gold.{ORDER_LINES.view}"
    return spark.sql(
        f"""SELECT * FROM (
              (SELECT 'suppliers' AS question, supp_cd AS who, SUM(qty_active) AS total FROM {view}
                 GROUP BY supp_cd, supp_name, supp_class ORDER BY total DESC NULLS LAST, supp_cd NULLS LAST LIMIT 5)
              UNION ALL
              (SELECT 'band', band, SUM(qty_active) AS total FROM {view}
                 GROUP BY band ORDER BY total DESC NULLS LAST, band NULLS LAST LIMIT 1)
              UNION ALL
              SELECT 'cities', city_cd, SUM(qty_active) FROM {view} GROUP BY city_cd, city_name, region)"""
    )


# --- runs


def ingest_mixed_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards that each hold rows of all partitions, gathered while they are ingested."""
    folder, layout = new_folder(spark, "mixed-shards"), fresh(spark, "mixed")
    write_mixed_shards(raw_lines(spark, sf_dir), LINES, folder, 16)
    ingest(spark, layout, folder, gather=True)
    return layout.read_raw(spark).groupBy("region", "period").agg(F.count(F.lit(1)).alias("n_rows"))


def _faulty_shards(spark: SparkSession, sf_dir: str) -> str:
    """The order lines as text lines of their own making, some cut short, some too long, one region's columns turned round."""
    cells = [F.concat(F.lit('"'), F.coalesce(F.col(c), F.lit("")), F.lit('"')) for c in TEXTS]

    def fill(folder: str) -> None:
        rows = delivered(spark, sf_dir).withColumn("shard", F.concat_ws("-", "region", "period"))
        short, long = F.col("qty_joined") == "6", F.col("qty_joined") == "7"
        line = F.when(short, F.concat_ws(";", *cells[:-2])).when(long, F.concat_ws(";", *cells, F.lit('"extra;x"'))).otherwise(F.concat_ws(";", *cells))
        turned, is_turned = F.concat_ws(";", *reversed(cells)), F.col("region").eqNullSafe("EUROPE")
        spare_sort(spark)
        # rows arrive clustered; a column named like the header, whose texts are lines, gives every file its first line
        for lines, names, wanted in ((line, TEXTS, ~is_turned), (turned, [*reversed(TEXTS)], is_turned)):
            texts = rows.where(wanted).select(lines.alias(";".join(names)), "shard")
            bare = {"sep": "\x01", "quote": "", "extension": "txt", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            texts.write.format("csv").options(header=True, **bare).partitionBy("shard").mode("append").save(folder)

    return _kept(spark, sf_dir, "faulty-shards", fill)


def screened_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows of shards with planted faults, each as it was delivered."""
    layout = _with_source(fresh(spark, "screened"), FAULTY_LINES)
    ingest_screened(spark, layout, _faulty_shards(spark, sf_dir))
    return layout.read_raw(spark).select(*TEXTS)


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines per file and fault, with a digest over their texts."""
    layout = _with_source(fresh(spark, "quarantine"), FAULTY_LINES)
    ingest_screened(spark, layout, _faulty_shards(spark, sf_dir))
    shard = F.regexp_extract(F.url_decode(FILE), "shard=([^/]+)/", 1)
    return read_quarantine(spark, layout).groupBy(shard.alias("shard"), FAULT).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length(LINE)).alias("n_chars")
    )


def incremental_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of shards taken in by a stream, then a run that finds nothing new: rows, and in which run they came."""
    folder, layout = new_folder(spark, "drops"), _with_source(fresh(spark, "intake"), DROPPED_LINES)
    rows, totals = delivered(spark, sf_dir), []
    for run, drop in enumerate((F.col("period") < NEW_CODE_YEAR, F.col("period") >= NEW_CODE_YEAR, F.lit(False))):
        if run < 2:
            write_shards(rows.where(drop), LINES, f"{folder}/drop={run}")
        reports = ingest_new(spark, layout, folder, run_ts=at(f"2024-01-0{run + 1} 00:00:00"))
        totals.append((sum(r.files_loaded for r in reports), sum(r.rows_written for r in reports)))
    n_rows = [n for _, n in totals]
    return layout.read_raw(spark).groupBy("region", "period").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.dayofmonth(LINES.loaded_at)).alias("run"),
        F.sum(F.col("qty_joined").cast("int")).alias("joined"),
    ).withColumns({"rows_first": F.lit(n_rows[0]), "rows_second": F.lit(n_rows[1]), "rows_third": F.lit(n_rows[2]), "files_third": F.lit(totals[2][0])})


def clustered_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and sums per supplier and per city of a clustered fact, and whether their files became fewer.

    Compared with as many files whose rows are dealt out by a digest. A quarter fewer is asked for.
    """
    base = replace(ORDER_LINES, cluster_by=(SUPPLIER.name, CITY.name))
    rows = delivered(spark, sf_dir)
    layout = fresh(spark, "clustered")
    land(rows, layout, gather=False)
    transform(spark, layout)
    partitions = layout.read_fact(spark).select("region", "period").distinct().count()
    plain = layout.read_fact(spark)
    whole = fact_files(plain.count(), ORDER_LINES.fact_schema, LINES.partition_by, 1)  # bytes
    dense = replace(layout, root=new_folder(spark, "curve"), star=replace(base, file_bytes=max(1, whole // (16 * partitions))))
    land(rows, dense, gather=False)
    transform(spark, dense)
    spread = new_folder(spark, "spread")
    digest = F.xxhash64(*plain.columns)
    plain.repartitionByRange(16 * partitions, "region", "period", digest).write.partitionBy(*LINES.partition_by).mode("overwrite").parquet(spread)
    out = None
    for dim in (SUPPLIER, CITY):
        curve, other = (_files_per_key(spark, path, dim) for path in (dense.fact, spread))
        fewer = 4 * curve <= 3 * other
        sums = dense.read_fact(spark).groupBy(dim.sk).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("qty_joined").alias("joined"))
        named = sums.join(dense.dimensions(spark).read(dim).select(dim.sk, F.col(dim.bk).alias("code")), dim.sk, "left")
        part = named.select(F.lit(dim.name).alias("dimension"), "code", "n_rows", "joined", F.lit(int(fewer)).alias("fewer_files"))
        out = part if out is None else out.union(part)
    return out


def _files_per_key(spark: SparkSession, path: str, dim: Dimension) -> int:
    """Files that hold rows of a key, summed over the keys."""
    rows = spark.read.schema(ORDER_LINES.fact_schema).parquet(path)
    return rows.select(dim.sk, "_metadata.file_path").distinct().count()


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles merged over periods, one of them delivered again, and whether they keep to their stated errors."""
    layout, rows = fresh(spark, "profile"), delivered(spark, sf_dir)
    land(rows, layout, gather=False)
    clean_step(spark, layout)
    refresh_profile(spark, layout)
    again = rows.where(F.col("period") == "1995")
    land(again.withColumn("qty_joined", (F.col("qty_joined").cast("int") * 2).cast("string")), layout, gather=False)
    clean_step(spark, layout, periods=["1995"])
    refresh_profile(spark, layout, ["1995"])
    found = profile(spark, layout, top=3, shares=[0.5])
    each = [F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).cast("string").alias("v"), as_number(f).alias("n")) for f in profiled_fields(layout)]
    values = layout.read_clean(spark).select(F.explode(F.array(*each)).alias("one")).select("one.*").where("v is not null")
    counted = values.groupBy("column_name", "v", "n").agg(F.count(F.lit(1)).alias("m"))
    met = counted.join(F.broadcast(found.withColumn("middle", F.get("quantiles", F.lit(0)))), "column_name")  # a row per column
    listed = F.get(F.filter("top", lambda one: one["item"] == F.col("v")), F.lit(0))["count"]
    exact = met.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_exact"),
        F.sum(F.when(F.col("n") < F.col("middle"), F.col("m")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("n") <= F.col("middle"), F.col("m")).otherwise(0)).alias("upto"),
        F.max(F.abs(listed - F.col("m"))).alias("astray"),
        F.max("m").alias("most"),
        F.max(F.when(listed.isNotNull(), F.col("m"))).alias("most_listed"),
    )
    slack, none = F.col("n_values") * TOP_ERROR, F.lit(0)
    return found.join(exact, "column_name").select(
        "column_name", "n_rows", "n_values", "least", "greatest", F.col("n_exact").alias("n_distinct"),
        (F.abs(F.col("n_distinct") - F.col("n_exact")) <= F.greatest(F.lit(1.0), F.col("n_exact") * DISTINCT_ERROR)).cast("int").alias("distinct_ok"),
        F.col("n_values").between(F.col("below") / (0.5 + RANK_ERROR), F.col("upto") / (0.5 - RANK_ERROR)).cast("int").alias("median_ok"),
        ((F.coalesce("astray", none) <= slack) & (F.coalesce("most_listed", none) >= F.col("most") - slack)).cast("int").alias("top_ok"),
    )


def reload_old_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All periods loaded, then an old one delivered again with other names: later periods still win."""
    layout = fresh(spark, "reload")
    rows = delivered(spark, sf_dir)
    land(rows, layout, gather=False)
    transform(spark, layout)
    again = rows.where(F.col("period") == "1995")
    land(again.withColumn("supp_name", F.concat(F.rtrim("supp_name"), F.lit(" II "))), layout, gather=False)
    transform(spark, layout, periods=["1995"])
    renamed = layout.read_clean(spark).where(F.col("supp_name").endswith(" II"))
    counts = renamed.groupBy("supp_cd").agg(F.count(F.lit(1)).alias("n"))
    members = layout.dimensions(spark).read(SUPPLIER).select("supp_cd", "supp_name", "supp_class")
    return members.join(counts, "supp_cd", "left").select(
        "supp_cd", "supp_name", "supp_class", F.coalesce("n", F.lit(0)).alias("n_renamed")
    )


def empty_input_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps on empty tables report no data; on loaded ones they report success."""
    empty = fresh(spark, "empty")
    empty.create_tables(spark)
    full = fresh(spark, "guard")
    land(delivered(spark, sf_dir), full, gather=False)
    before = [clean_step(spark, empty), build_fact(spark, empty)]
    after = [r for r in transform(spark, full) if r.step in (LINES.clean_table, ORDER_LINES.fact_table)]
    cases = report_frame(spark, before).withColumn("input", F.lit("empty")).union(
        report_frame(spark, after).withColumn("input", F.lit("full"))
    )
    return cases.select("input", "step", "status", "rows_read", "rows_written")


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of a full load read, wrote, inserted and updated."""
    reports = full_load(spark, fresh(spark, "report"), shard_folder(spark, sf_dir))
    return report_frame(spark, reports).select(
        "step", "status", "rows_read", "rows_written", "rows_inserted", "rows_updated", "partition_by"
    )


def _region_totals(mart: Mart) -> DataFrame:
    return (
        star_view(mart, ["region", *ORDER_LINES.measures])
        .groupBy("region")
        .agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(m).alias(m) for m in ORDER_LINES.measures])
    )


def full_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the star after loading the same shards twice."""
    layout = fresh(spark, "full")
    for _ in range(2):
        full_load(spark, layout, shard_folder(spark, sf_dir))
    return _region_totals(open_mart(spark, layout))


def load_by_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest once, then transform the later periods before the earlier ones."""
    layout = fresh(spark, "periods")
    ingest(spark, layout, shard_folder(spark, sf_dir))
    # As many values as the raw table has period folders.
    years = [r[0] for r in layout.read_raw(spark).select("period").distinct().collect()]
    for part in ([y for y in years if y >= NEW_CODE_YEAR], [y for y in years if y < NEW_CODE_YEAR]):
        transform(spark, layout, periods=part)
    return ranking(open_mart(spark, layout), ["region", "supp_class"], "qty_active", "total_active")


QUERIES: dict[str, Query] = {
    "ingest_delimited": ingest_delimited,
    "shard_rows": shard_rows,
    "partition_overwrite_rerun": partition_overwrite_rerun,
    "partition_overwrite_replace": partition_overwrite_replace,
    "schema_lock": schema_lock,
    "table_catalog": table_catalog,
    "catalog_star_view": catalog_star_view,
    "named_views": named_views,
    "clean_typed": clean_typed,
    "clean_bad_values": clean_bad_values,
    "legacy_int_parse": legacy_int_parse,
    "surrogate_key": surrogate_keys,
    "dim_supplier": _members("dim_supplier"),
    "dim_city": _members("dim_city"),
    "dim_band": _members("dim_band"),
    "scd1_initial": scd1_initial,
    "scd1_update": scd1_update,
    "scd1_null_attr": scd1_null_attr,
    "scd1_null_key": scd1_null_key,
    "scd1_idempotent": scd1_idempotent,
    "merge_metrics": merge_metrics,
    "scd1_buckets": scd1_buckets,
    "merge_buckets": merge_buckets,
    "change_feed": change_feed,
    "replayed_versions": replayed_versions,
    "shared_hash_keys": shared_hash_keys,
    "shared_hash_facts": shared_hash_facts,
    "rollup_ranking": rollup_ranking,
    "rollup_renewal": rollup_renewal,
    "numbered_ranking": numbered_ranking,
    "fact_rows": fact_lines,
    "fact_rows_large_dims": fact_lines_large_dims,
    "fact_unknown_members": fact_unknown_members,
    "fact_late_members": fact_late_members,
    "star_view": star_rows,
    "star_view_large_dims": star_rows_large_dims,
    "star_view_cobucketed": star_rows_cobucketed,
    "top_suppliers_cobucketed": top_suppliers_cobucketed,
    "cobuckets_renewal": cobuckets_renewal,
    "top_suppliers": top_suppliers,
    "top_band": top_band,
    "city_ranking": city_ranking,
    "top_suppliers_large_dims": top_suppliers_large_dims,
    "city_ranking_large_dims": city_ranking_large_dims,
    "questions_in_sql": questions_in_sql,
    "empty_input_guard": empty_input_guard,
    "run_report": run_report,
    "full_load_twice": full_load_twice,
    "ingest_mixed_shards": ingest_mixed_shards,
    "screened_rows": screened_rows,
    "quarantined_rows": quarantined_rows,
    "incremental_intake": incremental_intake,
    "clustered_layout": clustered_layout,
    "column_profile": column_profile,
    "reload_old_period": reload_old_period,
    "load_by_periods": load_by_periods,
}
