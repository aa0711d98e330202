"""A fact and a dimension in equal buckets: plans without a shuffle of the fact, and whole results."""

import re

import pytest
from pyspark.sql import functions as F

from starloom.models.order_lines import ORDER_LINES, SUPPLIER
from starloom.operators.star import ranking, star_view
from starloom.plans import Layout, open_mart, transform
from starloom.plans.cobuckets import open_cobuckets, store_cobuckets
from starloom.plans.loads import land

TEXTS = ORDER_LINES.source.file_schema.names


def line(period, supplier, quantity, city="c1", klass="k"):
    row = dict.fromkeys(TEXTS, "x") | {"period": period, "supp_cd": supplier, "city_cd": city, "supp_class": klass}
    return tuple((row | {"region": "R", "qty_active": str(quantity), "qty_joined": "1", "qty_left": "0", "load_dt": None})[c] for c in TEXTS)


def load(spark, layout, rows, periods=None):
    land(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in TEXTS)), layout)
    transform(spark, layout, periods=periods)


def view_rows(mart):
    return sorted(map(str, star_view(mart).drop("loaded_at").collect()))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def above(plan, scan):
    """Operators on the way from a scan up to the root of a printed plan."""
    lines = [(len(re.match(r"[\s:|+\-]*", row).group()), row) for row in plan.splitlines()]
    at = next(i for i, (_, row) in enumerate(lines) if scan in row and "Scan" in row)
    depth, path = lines[at][0], []
    for indent, row in reversed(lines[:at]):
        if indent < depth:
            depth = indent
            path.append(row)
    return path


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("cobuckets")), ORDER_LINES)
    rows = [line("1", "hot", n) for n in range(120)] + [line("1", f"s{n}", n) for n in range(200)]
    rows += [line("2", f"s{n}", 1) for n in range(50)] + [line("2", None, 3), line("2", None, 3)]
    load(spark, layout, rows)
    store_cobuckets(spark, layout, SUPPLIER.name, buckets=16)
    return layout


@pytest.mark.parametrize("limit", [0, 10**9])
def test_rows_equal_the_plain_view(spark, layout, limit):
    assert view_rows(open_cobuckets(spark, layout, SUPPLIER.name, limit)) == view_rows(open_mart(spark, layout))


def test_hot_and_unknown_keys_lie_apart(spark, layout):
    co = open_cobuckets(spark, layout, SUPPLIER.name).cobucketed
    hot = {r["supp_cd"]: r["n"] for r in co.hot_rows.join(co.members, SUPPLIER.sk, "left").groupBy("supp_cd").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert hot["hot"] == 120 and hot[None] == 2 and co.rows.count() + sum(hot.values()) == 372
    assert co.rows.where(F.col(SUPPLIER.sk) == -1).count() == 0


def test_fact_is_not_shuffled(spark, layout):
    co = open_cobuckets(spark, layout, SUPPLIER.name).cobucketed
    joined = co.rows.join(co.members.select(SUPPLIER.sk, "supp_cd").hint("merge"), SUPPLIER.sk, "left")
    assert "SortMergeJoin" in plan_of(joined) and "Exchange" not in plan_of(joined)
    summed = co.rows.groupBy(SUPPLIER.sk, "city_sk").agg(F.sum("qty_active"))
    assert "Exchange" not in plan_of(summed)


def test_view_has_no_shuffle_above_the_fact(spark, layout):
    plan = plan_of(star_view(open_cobuckets(spark, layout, SUPPLIER.name), ["supp_cd", "qty_active"]))
    path = above(plan, "Bucketed: true")
    assert any("SortMergeJoin" in step for step in path) and not any("Exchange" in step for step in path)


def test_ranking_shuffles_sums_only(spark, layout):
    co, plain = (ranking(m, ["supp_cd", "supp_class"], "qty_active") for m in (open_cobuckets(spark, layout, SUPPLIER.name), open_mart(spark, layout)))
    assert co.collect() == plain.collect()
    path = above(plan_of(co), "Bucketed: true")
    join = next(i for i, step in enumerate(path) if "SortMergeJoin" in step)
    assert not any("Exchange" in step for step in path[:join])


def test_renewal(spark, tmp_path):
    """A renewed period loses its hot rows, keeps no old ones, and takes the dimension's new version."""
    layout = Layout(str(tmp_path), ORDER_LINES)
    load(spark, layout, [line("1", "hot", 1)] * 90 + [line("1", f"s{n}", 1) for n in range(30)] + [line("2", "s1", 1), line(None, "s2", 5)])
    assert store_cobuckets(spark, layout, SUPPLIER.name, buckets=8) == 8
    load(spark, layout, [line("1", f"s{n}", 7, klass="new") for n in range(40)], periods=["1"])
    before = open_cobuckets(spark, layout, SUPPLIER.name)
    assert star_view(before).count() == 122  # the last stored build is still whole
    assert store_cobuckets(spark, layout, SUPPLIER.name, periods=["1"]) == 8
    after = open_cobuckets(spark, layout, SUPPLIER.name)
    assert view_rows(after) == view_rows(open_mart(spark, layout)) and star_view(after).count() == 42
    assert store_cobuckets(spark, layout, SUPPLIER.name, buckets=4, periods=["1"]) == 4  # a new count stores all periods
    assert view_rows(open_cobuckets(spark, layout, SUPPLIER.name)) == view_rows(open_mart(spark, layout))


def test_nothing_stored_and_empty_fact(spark, tmp_path):
    layout = Layout(str(tmp_path), ORDER_LINES)
    load(spark, layout, [line("1", "s1", 1)])
    with pytest.raises(FileNotFoundError):
        open_cobuckets(spark, layout, SUPPLIER.name)


def test_a_large_fact_gets_more_buckets_than_asked_for(spark, tmp_path):
    """A bucket is one task's work: the count asked for is the least, and the rows stay whole."""
    layout = Layout(str(tmp_path / "wh"), ORDER_LINES)
    load(spark, layout, [line("2001", f"s{i % 40}", i) for i in range(400)])
    assert store_cobuckets(spark, layout, SUPPLIER.name, buckets=2, namespace="grown", bucket_bytes=8192) >= 8
    stored, plain = open_cobuckets(spark, layout, SUPPLIER.name, limit=0, namespace="grown"), open_mart(spark, layout)
    assert view_rows(stored) == view_rows(plain)
