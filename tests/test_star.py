import pytest
from pyspark.sql import functions as F

from starloom.models.order_lines import BAND, CITY, ORDER_LINES, SUPPLIER
from starloom.operators.fact import fact_rows
from starloom.operators.lookup import (
    HOT_FRACTION,
    Side,
    hot_keys,
    join_spread,
    left_lookup,
    measured_bytes,
    salts_per_key,
)
from starloom.operators.star import Mart, ranking, star_view

CLEAN = (
    "region string, period string, supp_cd string, city_cd string, band string, "
    "qty_active int, qty_joined int, qty_left int"
)


def dim_frame(spark, dim, rows):
    text = ", ".join(f"{c} string" for c in (dim.bk, *dim.attributes))
    return Side(spark.createDataFrame(rows, f"{dim.sk} long, {text}"))


@pytest.fixture(scope="module")
def members(spark):
    return {
        SUPPLIER.name: dim_frame(spark, SUPPLIER, [(1, "s1", "n1", "t", "c"), (2, "s2", "n2", "t", "c")]),
        CITY.name: dim_frame(spark, CITY, [(10, "c1", "one", "R1"), (42, None, "none", "R9")]),
        BAND.name: dim_frame(spark, BAND, [(5, "b1", "g1")]),
    }


@pytest.fixture(scope="module")
def clean_rows(spark):
    rows = [
        ("R1", "1", "s1", "c1", "b1", 5, 1, 0),
        ("R1", "1", "s2", None, "b1", 7, 1, 0),
        ("R2", "1", "gone", "c1", "b1", None, 1, 1),
        ("R2", "2", "s2", "c1", "zz", 7, 2, 1),
    ]
    return spark.createDataFrame(rows, CLEAN)


@pytest.mark.parametrize("limit", [0, 10**9])
def test_unknown_keys_become_minus_one(members, clean_rows, limit):
    fact = fact_rows(clean_rows, ORDER_LINES, members, limit=limit)
    assert fact.columns == ORDER_LINES.fact_schema.names
    keys = sorted((r["supplier_sk"], r["city_sk"], r["band_sk"]) for r in fact.collect())
    # A NULL code is unknown even though the dimension has a row for it.
    assert keys == [(-1, 10, 5), (1, 10, 5), (2, -1, 5), (2, 10, -1)]


@pytest.fixture(scope="module")
def mart(spark, members, clean_rows):
    fact = fact_rows(clean_rows, ORDER_LINES, members)
    return Mart(ORDER_LINES, spark.createDataFrame(fact.collect(), fact.schema), members)


def test_star_view_takes_shared_names_from_the_fact(mart):
    assert "region" in CITY.attributes
    rows = star_view(mart).collect()
    assert len(rows) == 4
    by_city = [(r["region"], r["city_cd"], r["city_name"]) for r in rows]
    assert sorted(by_city, key=str) == sorted(
        [("R1", "c1", "one"), ("R1", None, None), ("R2", "c1", "one"), ("R2", "c1", "one")], key=str
    )
    assert star_view(mart).columns == ORDER_LINES.view_columns


def test_star_view_joins_only_what_is_asked_for(mart):
    narrow = star_view(mart, ["region", "band", "qty_active"])
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "supp_name" not in plan and "city_name" not in plan
    assert narrow.count() == 4


def test_ranking_keeps_unknown_groups_and_breaks_ties(mart):
    rows = [tuple(r) for r in ranking(mart, ["supp_cd"], "qty_active").collect()]
    assert rows == [("s2", 14), ("s1", 5), (None, None)]
    bands = [tuple(r) for r in ranking(mart, ["region"], "qty_joined").collect()]
    assert bands == [("R2", 3), ("R1", 2)]
    assert ranking(mart, ["supp_cd", "region"], "qty_active", limit=1).collect() == [("s2", "R1", 7)]


def test_ranking_equals_summing_the_view_even_when_keys_repeat(spark, members, clean_rows):
    """Two members under one surrogate key multiply view rows; totals must follow."""
    twice = dict(members)
    twice[SUPPLIER.name] = dim_frame(spark, SUPPLIER, [(1, "s1", "n1", "t", "c"), (1, "s1x", "n", "t", "c")])
    fact = fact_rows(clean_rows, ORDER_LINES, members)
    mart = Mart(ORDER_LINES, fact, twice)
    assert star_view(mart).count() == 5
    by = ["supp_class", "region"]
    want = star_view(mart).groupBy(*by).agg(F.sum("qty_joined").alias("total"))
    assert sorted(map(tuple, ranking(mart, by, "qty_joined").collect()), key=str) == sorted(
        map(tuple, want.collect()), key=str
    )


def test_ranking_sums_before_it_joins(mart):
    plan = ranking(mart, ["supp_cd"], "qty_active")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Aggregate") > plan.index("Join")


def test_unknown_column_is_refused(mart):
    with pytest.raises(KeyError):
        star_view(mart, ["nope"])


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 60,000 rows share one key, a third have none, the rest are spread."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 3 == 1, None).otherwise(F.concat(F.lit("k"), (n % 5000).cast("string")))
    return spark.range(0, 60_000, 1, 16).select("id", key.alias("k"))


@pytest.fixture(scope="module")
def side(spark):
    known = spark.range(0, 5000, 2).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    more = spark.createDataFrame([("hot", -5), ("k2", 77), (None, 1)], "k string, v long")
    return known.union(more)


def test_hot_keys_are_found(skewed):
    assert hot_keys(skewed, "k") == {"hot": 1 / 3}
    assert hot_keys(skewed.where("id < 0"), "k") == {}


def test_parts_follow_the_share_and_the_cluster():
    shares = {"third": 1 / 3, "tenth": 1 / 10, "least": 1 / HOT_FRACTION}
    assert salts_per_key(shares, 8) == {16: ["third"], 4: ["tenth"], 2: ["least"]}
    many = salts_per_key(shares, 20_000)
    assert many == {32768: ["third"], 8192: ["tenth"], 128: ["least"]}
    even = {k: 1 / HOT_FRACTION for k in range(HOT_FRACTION)}
    for partitions in (8, 200, 20_000):
        copies = sum(parts * len(keys) for parts, keys in salts_per_key(even, partitions).items())
        assert copies <= 8 * partitions + 2 * HOT_FRACTION


def test_spread_join_equals_plain_join(skewed, side):
    plain = skewed.join(side, "k", "left")
    spread = left_lookup(skewed, Side(side), "k", limit=0)
    assert spread.columns == plain.columns
    assert spread.count() == plain.count() > skewed.count()
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


def test_spread_join_leaves_no_task_with_the_hot_key(skewed, side, spark):
    """Rows per (key, salt) are what one reducer must take at least: the hot key is cut to task-sized parts."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        joined = join_spread(skewed, side, "k", {"hot": 1 / 3}).withColumn("task", F.spark_partition_id())
        largest = joined.groupBy("task").count().agg(F.max("count")).first()[0]
        plain = skewed.join(side.hint("merge"), "k", "left").withColumn("task", F.spark_partition_id())
        worst = plain.groupBy("task").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert worst >= 20_000
    assert largest < 10_000


def test_small_side_is_broadcast_and_large_is_not(skewed, side):
    small = left_lookup(skewed, Side(side), "k")
    large = left_lookup(skewed, Side(side, size=10**12), "k")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_measured_bytes_counts_text(spark):
    rows = spark.createDataFrame([("abcd", 1), (None, 2)], "t string, n long")
    assert measured_bytes(rows) == 4 + 2 * 2 * 16
    assert measured_bytes(rows.where("n > 9")) == 0
