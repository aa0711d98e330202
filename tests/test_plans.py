"""The physical plans that large tables depend on."""

import re

import pytest
from pyspark.sql import functions as F

from starloom.models.order_lines import LINES, ORDER_LINES, raw_lines
from starloom.operators.clean import clean
from starloom.operators.dimensions import latest_members
from starloom.operators.fact import fact_rows
from starloom.operators.star import ranking, star_view
from starloom.plans import open_mart
from starloom.plans.queries import loaded
from starloom.sources.tables import only_periods


@pytest.fixture(scope="module")
def layout(spark, tables):
    return loaded(spark, tables)


@pytest.fixture(scope="module")
def mart(spark, layout):
    return open_mart(spark, layout)


@pytest.fixture
def plan(capsys):
    def text(frame):
        capsys.readouterr()
        frame.explain("formatted")
        return capsys.readouterr().out

    return text


def shuffles(plan_text):
    tree = plan_text.split("\n\n")[0]
    return len(re.findall(r"[-+] Exchange ", tree))


def columns_read(plan_text, table):
    """Columns each scan of a table's folder reads, partition values aside."""
    scans = re.findall(r"Location: [^\n]*?/" + table + r"[\]/].*?ReadSchema: struct<([^>]*)>", plan_text, re.S)
    assert scans, f"no scan of {table}"
    return [sorted(c.split(":")[0] for c in s.split(",") if c) for s in scans]


def test_cleaning_is_map_only(spark, layout, plan):
    text = plan(clean(layout.read_raw(spark), LINES))
    assert shuffles(text) == 0 and "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_fact_build_is_map_only_and_reads_what_it_needs(spark, layout, mart, plan):
    text = plan(fact_rows(layout.read_clean(spark), ORDER_LINES, mart.members))
    assert shuffles(text) == 0 and text.count("BroadcastHashJoin LeftOuter") >= 3
    needed = sorted(["supp_cd", "city_cd", "band", *ORDER_LINES.measures])
    assert columns_read(text, "clean_lines") == [needed]


def test_star_view_is_map_only(mart, plan):
    assert shuffles(plan(star_view(mart))) == 0


def test_a_period_is_read_from_its_folders_alone(spark, layout, plan):
    text = plan(only_periods(layout.read_clean(spark), "period", ["1998"]))
    assert re.search(r"PartitionFilters: \[[^\]]*period[^\]]*1998", text)


def test_counting_a_table_reads_no_column(spark, layout, plan):
    text = plan(layout.read_raw(spark).agg(F.count(F.lit(1))))
    assert columns_read(text, "raw_lines") == [[]]


def test_members_read_their_columns_only(spark, layout, plan):
    dim = ORDER_LINES.dimension("dim_band")
    text = plan(latest_members(layout.read_clean(spark), dim, "period"))
    assert columns_read(text, "clean_lines") == [["band", "band_group"]]


def test_ranking_reads_one_key_and_the_measure(mart, plan):
    text = plan(ranking(mart, ["supp_cd", "supp_name"], "qty_active", limit=5))
    assert columns_read(text, "fact_lines") == [["qty_active", "supplier_sk"]]
    assert "TakeOrderedAndProject" in text
    assert shuffles(text) == 2  # per-key sums, then sums per member


def test_lines_are_shuffled_by_order_alone(spark, plan):
    """While suppliers and parts are small enough to broadcast, lines meet one shuffle."""
    text = plan(raw_lines(spark, "/root/testdata/sf0.1"))
    keys = re.findall(r"Arguments: hashpartitioning\((\w+)#", text)
    assert set(keys) == {"l_orderkey", "o_orderkey"}
