"""The space-filling layout of a fact: fewer files per key, no hot file, same rows."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starloom.models.order_lines import BAND, CITY, ORDER_LINES, SUPPLIER
from starloom.operators.clustering import clustered, fact_files, space_filling
from starloom.operators.star import ranking
from starloom.plans import Layout, open_mart, transform
from starloom.plans.loads import land
from starloom.specs import Dimension

SMALL = Dimension("small", "s_sk", "s", (), key_bits=8), Dimension("other", "o_sk", "o", (), key_bits=8)


def place(keys, widths):
    """The Z curve again, bit by bit."""
    each = 32 // len(keys)
    bits = [min(each, w) for w in widths]
    out = 0
    for turn, (key, width, n) in enumerate(zip(keys, widths, bits)):
        lead = max(key, 0) >> (width - n)
        for bit in range(n):
            out |= (lead >> (n - 1 - bit) & 1) << (31 - (bit * len(keys) + turn))
    return out


@pytest.mark.parametrize("dims, widths", [((SUPPLIER,), (63,)), ((SUPPLIER, CITY), (63, 63)), ((SUPPLIER, CITY, BAND), (63,) * 3), (SMALL, (8, 8))])
def test_curve(spark, dims, widths):
    keys = [-1, 0, 1, 255, 2**20, 2**31 - 1, 2**62 + 12345, 2**63 - 1, -(2**63)]
    keys = [k for k in keys if k < 2 ** widths[0]]
    rows = [tuple(keys[(i * (n + 1) + n) % len(keys)] for n in range(len(dims))) for i in range(len(keys))]
    frame = spark.createDataFrame(rows, ", ".join(f"{d.sk} long" for d in dims))
    got = [r[0] for r in frame.select(space_filling(dims)).collect()]
    assert got == [place(row, widths) for row in rows]


def test_equal_rows_and_hot_keys_are_cut(spark):
    """One key set holds all rows, a third of them equal."""
    rows = spark.range(30_000, numPartitions=12).select(
        F.lit("p").alias("period"), F.lit(5).cast("long").alias(SUPPLIER.sk), F.lit(7).cast("long").alias(CITY.sk),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("n"),
    )
    dealt = clustered(rows, ["period"], [SUPPLIER, CITY], 10)
    assert dealt.columns == rows.columns
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30_000 and len(sizes) == 10 and max(sizes) < 8_000
    assert sorted(dealt.collect()) == sorted(rows.collect())


def test_empty(spark):
    assert clustered(spark.createDataFrame([], "p string, supplier_sk long"), ["p"], [SUPPLIER], 4).count() == 0


def test_file_count():
    width = 3 * 8 + 3 * 4 + 8  # three keys, three integers, a time
    assert fact_files(1000, ORDER_LINES.fact_schema, ORDER_LINES.partition_by, width * 100) == 10
    assert fact_files(0, ORDER_LINES.fact_schema, ORDER_LINES.partition_by, 1) == 1


def test_load_by_period_keeps_rows(spark, tmp_path):
    texts = ORDER_LINES.source.file_schema.names
    def rows(period, n):
        base = dict.fromkeys(texts, "x") | {"region": "R", "period": period, "qty_active": "1", "qty_joined": "1", "qty_left": "0"}
        return [tuple((base | {"supp_cd": f"s{i % 50}", "city_cd": f"c{i // 50}"})[c] for c in texts) for i in range(n)]
    star = replace(ORDER_LINES, cluster_by=(SUPPLIER.name, CITY.name), file_bytes=44 * 100)
    plain, curve = Layout(str(tmp_path / "a"), ORDER_LINES), Layout(str(tmp_path / "b"), star)
    for layout in (plain, curve):
        for period, n in (("1", 2500), ("2", 500), ("1", 2000)):
            land(spark.createDataFrame(rows(period, n), ", ".join(f"{c} string" for c in texts)), layout)
            transform(spark, layout, periods=[period])
    by = ["period", "supp_cd", "city_cd"]
    assert ranking(open_mart(spark, curve), by, "qty_active").collect() == ranking(open_mart(spark, plain), by, "qty_active").collect()
    files = curve.read_fact(spark).where("period = '1'").groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n"))
    assert 15 <= files.count() <= 25 and files.agg(F.max("n")).first()[0] <= 300
    held = curve.read_fact(spark).where("period = '1'").groupBy(SUPPLIER.sk).agg(F.countDistinct("_metadata.file_path").alias("n"))
    assert held.agg(F.avg("n")).first()[0] <= 10
