"""Column profiles kept per period and merged."""

from collections import Counter

import pytest

from starloom.plans import Layout
from starloom.plans.loads import clean_step, land
from starloom.plans.profiles import TOP_ERROR, profile, refresh_profile, stored_profile
from starloom.specs import Column, Source, Star

SOURCE = Source(
    columns=(Column("p"), Column("word"), Column("n", "int"), Column("day", "date"), Column("none")),
    partition_by=("p",), shards="*.csv", raw_table="raw", clean_table="clean",
)
STAR = Star(source=SOURCE, dimensions=(), fact_table="fact", measures=("n",), period="p")


def load(spark, layout, rows, periods=None):
    land(spark.createDataFrame(rows, "p string, word string, n string, day string, none string"), layout)
    clean_step(spark, layout, periods=periods)
    return refresh_profile(spark, layout, periods)


def rows_of(period, numbers, word=lambda n: f"w{n % 40}"):
    return [(period, word(n), str(n), f"2020-01-{n % 28 + 1:02d}", None) for n in numbers]


def by_column(frame):
    return {r["column_name"]: r for r in frame.collect()}


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("profiles")), STAR)
    assert load(spark, layout, rows_of("1", range(3000)) + rows_of("2", range(2000, 9000)) + rows_of("3", [5])) == 15
    return layout


def test_merged_over_periods(spark, layout):
    got = by_column(profile(spark, layout, top=2))
    assert [got["n"][c] for c in ("n_rows", "n_values", "least", "greatest")] == [10001, 10001, 0, 8999]
    assert abs(got["n"]["n_distinct"] - 9000) <= 9000 * 0.025
    exact = sorted([*range(3000), *range(2000, 9000), 5])
    for share, value in zip((0.25, 0.5, 0.75), got["n"]["quantiles"], strict=True):
        assert abs(sum(x <= value for x in exact) / len(exact) - share) <= 0.02
    counts = Counter(f"w{n % 40}" for n in exact)
    assert all(abs(t["count"] - counts[t["item"]]) <= len(exact) * TOP_ERROR for t in got["word"]["top"])
    assert got["word"]["n_distinct"] == 40 and got["word"]["quantiles"][1:] == [3, 3]
    assert (got["day"]["least"], got["day"]["greatest"]) == (18262, 18289)


def test_some_periods_only(spark, layout):
    got = by_column(profile(spark, layout, periods=["3"]))
    assert got["n"]["quantiles"] == [5, 5, 5] and got["word"]["top"][0]["item"] == "w5"
    assert profile(spark, layout, periods=["9"]).count() == 0


def test_column_without_values(spark, layout):
    got = by_column(profile(spark, layout))["none"]
    assert (got["n_rows"], got["n_values"], got["n_distinct"], got["quantiles"], got["top"]) == (10001, 0, 0, None, [])


def test_merged_equals_one_pass(spark, layout, tmp_path):
    """The same rows as one period: counts agree exactly, estimates within their error."""
    whole = Layout(str(tmp_path), STAR)
    numbers = [*range(3000), *range(2000, 9000), 5]
    load(spark, whole, rows_of("1", numbers))
    one, merged = by_column(profile(spark, whole)), by_column(profile(spark, layout))
    for name in ("word", "day", "none"):
        assert one[name][:6] == merged[name][:6]
        assert {t["item"]: t["count"] for t in one[name]["top"]}.keys() <= {f"w{i}" for i in range(40)} | {f"2020-01-{i:02d}" for i in range(1, 29)}
    # a merged sketch has lost the order its estimate of one pass draws on; both keep to the error
    assert all(abs(got["n"]["n_distinct"] - 9000) <= 9000 * 0.025 for got in (one, merged))


def test_delivered_again(spark, tmp_path):
    layout = Layout(str(tmp_path), STAR)
    load(spark, layout, rows_of("1", range(50)) + rows_of("2", range(10)))
    kept = stored_profile(spark, layout).where("p = '2'").selectExpr("column_name", "base64(distinct_sketch)").collect()
    load(spark, layout, rows_of("1", [7, 7, 7], word=lambda n: "x" * 1_000_000), periods=["1"])
    got = by_column(profile(spark, layout))
    assert got["n"]["n_values"] == 13 and got["word"]["greatest"] == 1_000_000 and got["n"]["top"][0]["item"] == "7"
    assert sorted(stored_profile(spark, layout).where("p = '2'").selectExpr("column_name", "base64(distinct_sketch)").collect()) == sorted(kept)
