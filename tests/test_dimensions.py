from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.operators.dimensions import (
    INSERTED,
    UPDATED,
    dimension_rows,
    latest_members,
    merge_statement,
    merge_type1,
    require_unique,
)
from starloom.sources.commits import DimensionStore
from starloom.specs import Dimension

DIM = Dimension("dim_thing", "thing_sk", "bk", ("attr",))
PAIR = Dimension("dim_pair", "pair_sk", "bk", ("a", "b"))
FIRST, SECOND = datetime(2024, 1, 1), datetime(2024, 2, 1)


def members(spark, rows, moment):
    frame = spark.createDataFrame(rows, "bk string, attr string")
    return dimension_rows(frame, DIM, F.lit(moment))


OLD = [("a", "x"), ("b", None), ("c", "z"), (None, "n")]
NEW = [("a", "y"), ("b", "q"), ("d", "w"), (None, "n2")]


def merged(spark, null_safe):
    target, source = members(spark, OLD, FIRST), members(spark, NEW, SECOND)
    return merge_type1(target, source, DIM, F.lit(SECOND), null_safe).collect()


def test_plain_merge_ignores_nulls(spark):
    rows = merged(spark, null_safe=False)
    assert sorted(((r["bk"], r["attr"]) for r in rows), key=str) == sorted(
        [("a", "y"), ("b", None), ("c", "z"), ("d", "w"), (None, "n"), (None, "n2")], key=str
    )
    assert sum(r[INSERTED] for r in rows) == 2 and sum(r[UPDATED] for r in rows) == 1


def test_null_safe_merge_has_one_null_key(spark):
    rows = merged(spark, null_safe=True)
    assert {r["bk"]: r["attr"] for r in rows} == {"a": "y", "b": "q", "c": "z", "d": "w", None: "n2"}
    assert len(rows) == 5
    assert sum(r[INSERTED] for r in rows) == 1 and sum(r[UPDATED] for r in rows) == 3


def test_what_a_merge_leaves_and_renews(spark):
    rows = {r["bk"]: r for r in merged(spark, null_safe=True)}
    before = {r["bk"]: r for r in members(spark, OLD, FIRST).collect()}
    assert all(rows[k]["thing_sk"] == before[k]["thing_sk"] for k in before)
    assert (rows["a"]["created_at"], rows["a"]["updated_at"]) == (FIRST, SECOND)
    assert (rows["c"]["created_at"], rows["c"]["updated_at"]) == (FIRST, FIRST)
    assert (rows["d"]["created_at"], rows["d"]["updated_at"]) == (SECOND, SECOND)


def test_merge_keeps_a_key_that_was_issued_before(spark):
    """Surrogate keys of matched rows come from the target even if the source disagrees."""
    target = members(spark, [("a", "x")], FIRST).withColumn("thing_sk", F.lit(7).cast("long"))
    rows = merge_type1(target, members(spark, [("a", "y")], SECOND), DIM, F.lit(SECOND)).collect()
    assert [(r["thing_sk"], r["attr"]) for r in rows] == [(7, "y")]


def test_a_row_of_nulls_is_still_a_row(spark):
    source = members(spark, [(None, None)], SECOND)
    empty = spark.createDataFrame([], DIM.schema)
    rows = merge_type1(empty, source, DIM, F.lit(SECOND)).collect()
    assert len(rows) == 1 and rows[0][INSERTED]
    rows = merge_type1(source, source, DIM, F.lit(SECOND)).collect()
    assert len(rows) == 1 and not rows[0][INSERTED] and not rows[0][UPDATED]


def test_latest_period_then_greatest_attributes_win(spark):
    rows = spark.createDataFrame(
        [
            ("k", "1", "z", "z"),
            ("k", "2", "a", None),
            ("k", "2", "a", "b"),
            ("k", "2", None, "z"),
            (None, "1", "n", "n"),
            (None, "3", None, None),
            ("only", None, "x", "y"),
        ],
        "bk string, p string, a string, b string",
    )
    got = {r["bk"]: (r["a"], r["b"]) for r in latest_members(rows, PAIR, "p").collect()}
    assert got == {"k": ("a", "b"), None: (None, None), "only": ("x", "y")}


def test_members_are_reduced_by_hash_before_any_sort(spark):
    rows = spark.createDataFrame([("k", "1", "a", "b")], "bk string, p string, a string, b string")
    plan = latest_members(rows, PAIR, "p")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.rindex("Sort ") < plan.index("HashAggregate")


def test_repeated_source_keys_fail(spark):
    once = members(spark, [("a", "x"), (None, "y")], FIRST)
    assert sorted(require_unique(once, DIM).collect(), key=str) == sorted(once.collect(), key=str)
    for rows in ([("a", "x"), ("a", "x")], [(None, "x"), (None, "y")]):
        with pytest.raises(Exception, match="repeats in the merge source"):
            require_unique(members(spark, rows, FIRST), DIM).collect()


def test_store_keeps_versions_and_counts(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path))
    first = store.upsert(DIM, members(spark, OLD, FIRST), F.lit(FIRST))
    assert (first["version"], first["rows_inserted"], first["rows_updated"]) == (1, 4, 0)
    second = store.upsert(DIM, members(spark, NEW, SECOND), F.lit(SECOND))
    assert (second["version"], second["rows_inserted"], second["rows_updated"]) == (2, 1, 3)
    again = store.upsert(DIM, members(spark, NEW, SECOND), F.lit(SECOND))
    assert (again["rows_source"], again["rows_inserted"], again["rows_updated"]) == (4, 0, 0)
    log = store.log(DIM).orderBy("version").collect()
    assert [r["rows_total"] for r in log] == [4, 5, 5]
    assert all(r["bytes_total"] > 0 for r in log)
    assert {r["bk"] for r in store.read(DIM).collect()} == {"a", "b", "c", "d", None}


def test_a_version_without_a_commit_is_never_read(spark, tmp_path):
    """A run that dies after writing but before committing changes nothing; the next one succeeds."""
    store = DimensionStore(spark, str(tmp_path))
    store.upsert(DIM, members(spark, OLD, FIRST), F.lit(FIRST))
    members(spark, [("junk", "junk")], SECOND).write.parquet(f"{tmp_path}/{DIM.name}/version=2")
    assert {r["bk"] for r in store.read(DIM).collect()} == {"a", "b", "c", None}
    store.upsert(DIM, members(spark, NEW, SECOND), F.lit(SECOND))
    assert {r["bk"] for r in store.read(DIM).collect()} == {"a", "b", "c", "d", None}


def test_repeated_merge_source_is_refused_by_the_store(spark, tmp_path):
    store = DimensionStore(spark, str(tmp_path))
    twice = members(spark, [("a", "x"), ("a", "y")], FIRST)
    with pytest.raises(Exception, match="repeats in the merge source"):
        store.upsert(DIM, twice, F.lit(FIRST))
    assert store.last_commit(DIM) is None


def test_merge_text():
    text = merge_statement(DIM, "t_name", "s_name", null_safe=False)
    assert "ON t.`bk` = s.`bk`" in text and "t.`attr` <> s.`attr`" in text
    assert "UPDATE SET t.`attr` = s.`attr`, t.`updated_at` = s.`updated_at`" in text
    assert "<=>" in merge_statement(DIM, "t_name", "s_name")


def test_merge_text_is_understood_by_spark(spark, tmp_path):
    """Parquet tables take no MERGE: Spark must get as far as saying so."""
    spark.createDataFrame([], DIM.schema).createOrReplaceTempView("merge_words")
    spark.sql(f"CREATE TABLE merge_target USING parquet LOCATION '{tmp_path}/m' AS SELECT * FROM merge_words")
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        spark.sql(merge_statement(DIM, "merge_target", "merge_words"))
    spark.sql("DROP TABLE merge_target")
