import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.catalog import create_namespace, refresh_table, reset_table, table_columns, table_ddl
from starloom.sources.delimited import list_shards, read_shards, write_shards
from starloom.sources.tables import (
    SchemaMismatch,
    create_if_absent,
    lock_schema,
    only_periods,
    overwrite_partitions,
    read_table,
)
from starloom.sources.workspace import new_folder
from starloom.specs import Column, Source

LETTERS = Source(
    columns=(Column("a"), Column("b"), Column("c")),
    partition_by=("a",),
    shards="part-*.csv",
    raw_table="raw_letters",
    clean_table="clean_letters",
)
SCHEMA = T.StructType(
    [T.StructField("uf", T.StringType()), T.StructField("m", T.StringType()), T.StructField("n", T.IntegerType())]
)


def read_lines(spark, tmp_path, *lines, name="part-1.csv"):
    (tmp_path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return [tuple(r) for r in read_shards(spark, LETTERS, str(tmp_path)).collect()]


def test_missing_shards_fail_before_any_job(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_shards(spark, LETTERS, str(tmp_path))


def test_columns_are_taken_by_position(spark, tmp_path):
    assert read_lines(spark, tmp_path, "x;y;z", "1;2;3") == [("1", "2", "3")]


def test_short_and_long_rows(spark, tmp_path):
    got = read_lines(spark, tmp_path, "a;b;c", "1;2", "1;2;3;4")
    assert got == [("1", "2", None), ("1", "2", "3")]


def test_empty_quoted_and_blank_fields(spark, tmp_path):
    got = read_lines(spark, tmp_path, "a;b;c", '"";;" x "', ' p ;"q;r";São')
    assert got == [(None, None, " x "), (" p ", "q;r", "São")]


def test_quotes_inside_quotes(spark, tmp_path):
    got = read_lines(spark, tmp_path, "a;b;c", r'"say \"hi\"";2;3', '"a ""b"" c";2;3')
    assert got[0] == ('say "hi"', "2", "3")
    assert got[1] == ('"a ""b"" c"', "2", "3")


def test_many_shards_make_one_frame(spark, tmp_path):
    read_lines(spark, tmp_path, "a;b;c", "1;2;3")
    got = read_lines(spark, tmp_path, "a;b;c", "4;5;6", name="part-2.csv")
    assert sorted(got) == [("1", "2", "3"), ("4", "5", "6")]
    assert list_shards(spark, LETTERS, str(tmp_path)).where("bytes > 0").count() == 2


def test_shards_keep_blanks_and_nulls(spark, tmp_path):
    source = Source(LETTERS.columns, ("a",), "shard=*/*.csv", "raw", "clean")
    rows = [(" 007", "x ", None), ("b;c", 'q"t', "é"), (None, "n", "n")]
    frame = spark.createDataFrame(rows, source.file_schema)
    write_shards(frame, source, str(tmp_path / "out"))
    got = [tuple(r) for r in read_shards(spark, source, str(tmp_path / "out")).collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def contents(spark, path):
    return sorted((tuple(r) for r in read_table(spark, path, SCHEMA).collect()), key=str)


@pytest.mark.parametrize("gather", [False, True])
def test_only_incoming_partitions_are_replaced(spark, tmp_path, gather):
    path = str(tmp_path / "t")
    first = rows_of(spark, ("SP", "202508", 1), ("SP", "202507", 2), ("RJ", "202508", 3))
    assert overwrite_partitions(first, path, SCHEMA, ["uf", "m"], gather=gather) == 3
    second = rows_of(spark, ("SP", "202508", 9), ("SP", "202508", 8))
    assert overwrite_partitions(second, path, SCHEMA, ["uf", "m"], gather=gather) == 2
    assert contents(spark, path) == [
        ("RJ", "202508", 3), ("SP", "202507", 2), ("SP", "202508", 8), ("SP", "202508", 9)
    ]


def test_partition_values_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_partitions(rows_of(spark, ("01", "007", 1), (None, "", 2)), path, SCHEMA, ["uf", "m"])
    assert contents(spark, path) == [("01", "007", 1), (None, None, 2)]


def test_null_partition_is_replaced_too(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2):
        overwrite_partitions(rows_of(spark, (None, "1", n)), path, SCHEMA, ["uf", "m"])
    assert contents(spark, path) == [(None, "1", 2)]


def test_empty_overwrite_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_partitions(rows_of(spark, ("SP", "1", 1)), path, SCHEMA, ["uf", "m"])
    assert overwrite_partitions(rows_of(spark).where("n > 5"), path, SCHEMA, ["uf", "m"]) == 0
    assert contents(spark, path) == [("SP", "1", 1)]


def test_a_hot_partition_is_split_over_tasks(spark, tmp_path):
    """With REBALANCE, AQE does not leave one partition's rows to one task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "65536")
    try:
        rows = spark.range(0, 200_000, 1, 8).select(
            F.lit("SP").alias("uf"),
            F.lit("1").alias("m"),
            F.pmod(F.hash("id"), F.lit(10**9)).cast("int").alias("n"),
        )
        path = str(tmp_path / "t")
        assert overwrite_partitions(rows, path, SCHEMA, ["uf", "m"], gather=True) == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(read_table(spark, path, SCHEMA).inputFiles()) > 1


def test_schema_is_locked(spark):
    good = rows_of(spark, ("a", "b", 1))
    assert lock_schema(good.select("n", "uf", "m"), SCHEMA).columns == ["uf", "m", "n"]
    for bad in (
        good.withColumn("n", F.col("n").cast("long")),
        good.drop("m"),
        good.withColumn("x", F.lit(1)),
        good.select("uf", "m", "n", F.col("n").alias("n")),
    ):
        with pytest.raises(SchemaMismatch):
            lock_schema(bad, SCHEMA)


def test_periods_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_partitions(rows_of(spark, ("SP", "1", 1), ("SP", "2", 2)), path, SCHEMA, ["uf", "m"])
    table = read_table(spark, path, SCHEMA)
    assert only_periods(table, "m", None).count() == 2
    assert [r["n"] for r in only_periods(table, "m", ["2"]).collect()] == [2]
    assert only_periods(table, "m", []).count() == 0


def test_create_if_absent_leaves_an_existing_table(spark, tmp_path):
    path = str(tmp_path / "t")
    create_if_absent(spark, path, SCHEMA)
    assert contents(spark, path) == []
    rows_of(spark, ("a", "b", 1)).write.mode("append").parquet(path)
    create_if_absent(spark, path, SCHEMA)
    assert contents(spark, path) == [("a", "b", 1)]


def test_ddl_carries_comments():
    schema = T.StructType([T.StructField("a", T.LongType(), True, {"comment": "it's"})])
    ddl = table_ddl("ns.t", schema, "/x", ["a"], "all")
    assert "`a` bigint COMMENT 'it\\'s'" in ddl and "PARTITIONED BY (`a`)" in ddl and "COMMENT 'all'" in ddl


def test_catalog_tables_follow_their_files(spark, tmp_path):
    create_namespace(spark, "cat_ns", str(tmp_path / "ns"), "A namespace", {"layer": "silver"})
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE SCHEMA EXTENDED cat_ns").collect()}
    assert described["Comment"] == "A namespace" and "(layer,silver)" in described["Properties"]
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    reset_table(spark, "cat_ns.t", SCHEMA, first, ["uf", "m"])
    overwrite_partitions(rows_of(spark, ("SP", "007", 1)), first, SCHEMA, ["uf", "m"])
    refresh_table(spark, "cat_ns.t", partitioned=True)
    assert [tuple(r) for r in spark.table("cat_ns.t").select("uf", "m", "n").collect()] == [("SP", "007", 1)]
    assert {r["column_name"]: r["is_partition"] for r in table_columns(spark, "cat_ns.t").collect()} == {
        "n": False, "uf": True, "m": True
    }
    reset_table(spark, "cat_ns.t", SCHEMA, second, ["uf", "m"])
    assert spark.table("cat_ns.t").count() == 0
    assert contents(spark, first) == [("SP", "007", 1)]


def test_work_folders_are_fresh_and_shared(spark):
    one, two = new_folder(spark, "x"), new_folder(spark, "x")
    assert one != two
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or one.startswith(shared)


def test_partitions_are_written_without_a_sort(spark, tmp_path):
    """A task that holds many partitions keeps a file open for each; beyond ``OPEN_FILES`` of them rows come as right."""
    spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    schema = T.StructType([T.StructField("v", T.LongType()), T.StructField("p", T.StringType())])
    rows = spark.range(1000).select(F.col("id").alias("v"), (F.col("id") % 150).cast("string").alias("p")).coalesce(1)
    assert overwrite_partitions(rows, f"{tmp_path}/t", schema, ["p"]) == 1000
    assert sorted(map(tuple, read_table(spark, f"{tmp_path}/t", schema).collect())) == sorted(map(tuple, rows.collect()))
    spark.sql(f"CREATE TABLE open_files (v BIGINT, p STRING) USING parquet PARTITIONED BY (p) LOCATION '{tmp_path}/u'")
    rows.createOrReplaceTempView("open_files_rows")
    plan = spark.sql("EXPLAIN INSERT INTO open_files SELECT * FROM open_files_rows").first()[0]
    spark.sql("DROP TABLE open_files")
    assert "Insert" in plan and "Sort [" not in plan
