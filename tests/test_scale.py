"""Plans and sizes that must hold at any scale: bounded files, pruned scans, no jobs while a plan is built."""

import re
from itertools import takewhile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.models.order_lines import LINES, ORDER_LINES, SUPPLIER, padded, raw_lines
from starloom.operators.dimensions import distinct_members
from starloom.operators.star import ranking, star_view
from starloom.plans import Layout, full_load, open_mart, queries, transform
from starloom.plans.loads import land
from starloom.plans.queries import delivered
from starloom.sources.delimited import write_mixed_shards
from starloom.sources.tables import even_tasks, only_periods


@pytest.fixture(scope="module")
def layout(spark, tables, tmp_path_factory):
    out = Layout(str(tmp_path_factory.mktemp("scale") / "wh"), ORDER_LINES)
    land(raw_lines(spark, tables), out)
    transform(spark, out)
    return out


def jobs(spark, action):
    """How many jobs an action starts."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_long_numbers_are_not_cut(spark):
    rows = spark.createDataFrame([(7,), (1_000_000,), (1_000_001,), (1_234_567_890,)], "n bigint")
    got = {r[0] for r in rows.select(padded(F.col("n"), 6)).collect()}
    assert got == {"000007", "1000000", "1000001", "1234567890"}


def test_building_a_plan_over_large_dimensions_starts_no_job(spark, layout):
    mart = open_mart(spark, layout, limit=0)
    assert jobs(spark, lambda: star_view(mart)) == 0
    assert jobs(spark, lambda: ranking(mart, ["supp_cd", "city_name"], "qty_active")) == 0


def test_hot_keys_ride_with_the_fact(spark, layout):
    side = open_mart(spark, layout).members["dim_city"]
    assert side.hot["city_cd"].keys() and len(side.hot["city_cd"]) == len(side.hot["city_sk"])
    assert all(0 < share <= 1 for share in side.hot["city_sk"].values())


def test_a_period_renews_its_members_only(spark, layout):
    rows = distinct_members(only_periods(layout.read_clean(spark), "period", ["1995"]), SUPPLIER, "period")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*period", plan)
    seen = Path(layout.members(SUPPLIER))
    before = {p: p.stat().st_mtime_ns for p in seen.rglob("*.parquet")}
    transform(spark, layout, periods=["1995"])
    after = {p: p.stat().st_mtime_ns for p in seen.rglob("*.parquet")}
    kept = before.items() & after.items()
    assert all("period=1995" in str(p) for p in before.keys() ^ after.keys())
    assert kept and not any("period=1995" in str(p) for p, _ in kept)


def test_mixed_shards_leave_few_files(spark, tables, tmp_path):
    shards, out = str(tmp_path / "shards"), Layout(str(tmp_path / "wh"), ORDER_LINES)
    write_mixed_shards(raw_lines(spark, tables), LINES, shards, 16)
    full_load(spark, out, shards, gather=True)
    partitions = out.read_raw(spark).select("region", "period").distinct().count()
    for path in (out.raw, out.clean, out.fact):
        assert len(list(Path(path).rglob("*.parquet"))) <= 2 * partitions


def below(plan, name):
    """The lines of a printed plan below the first node of that name."""
    lines = plan.splitlines()
    at = next(i for i, row in enumerate(lines) if name in row)
    depth = re.match(r"[\s:|+\-]*", lines[at]).end()
    return list(takewhile(lambda row: re.match(r"[\s:|+\-]*", row).end() > depth, lines[at + 1 :]))


def test_order_lines_are_gathered_while_they_are_narrow(spark, tables):
    """Texts of suppliers and cities join after the rows were shuffled, and the rows are those of the plain plan."""
    gathered, plain = raw_lines(spark, tables, gather=True), raw_lines(spark, tables)
    inside = below(gathered._jdf.queryExecution().optimizedPlan().toString(), "RebalancePartitions")
    assert inside and not any("s_name" in row or "n_name" in row or "r_name" in row for row in inside)
    assert gathered.exceptAll(plain).isEmpty() and plain.exceptAll(gathered).isEmpty()


def test_delivered_lines_are_joined_once_a_session(spark, tables):
    first, again = delivered(spark, tables), delivered(spark, tables)
    assert first.inputFiles() == again.inputFiles()
    plan = again._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Rebalance" not in plan
    assert again.exceptAll(raw_lines(spark, tables)).isEmpty() and again.count() == raw_lines(spark, tables).count()


def test_buckets_of_merged_customers_do_not_grow_with_them(spark, tables, monkeypatch):
    monkeypatch.setattr(queries, "MANY_BUCKETS", 16)  # far below a row: as if there were very many customers
    store = queries._bucketed_customers(spark, tables)
    last = store.last_commit(queries.CUSTOMER)
    assert 1 < len(last["buckets"]) <= 4 * queries.SEEN_BUCKETS
    assert store.read(queries.CUSTOMER).count() == last["rows_total"]


def test_the_widest_dimension_is_joined_last(spark, layout):
    """What a shuffled join carries is the texts of the dimensions joined before it."""
    plan = star_view(open_mart(spark, layout, limit=0))._jdf.queryExecution().optimizedPlan().toString()
    joins = [row for row in plan.splitlines() if "Join LeftOuter" in row]
    assert len(joins) == 3 and "supplier_sk" in joins[0]


def test_scans_have_several_tasks_a_core(spark, layout):
    """A task per core leaves most cores waiting for the longest; a session's own settings stay."""
    assert layout.read_raw(spark).rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    name = "spark.sql.files.minPartitionNum"
    own = spark.newSession()
    own.conf.set(name, "1")
    even_tasks(own)
    assert own.conf.get(name) == "1" and layout.read_raw(own).rdd.getNumPartitions() < layout.read_raw(spark).rdd.getNumPartitions()
