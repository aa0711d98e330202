import pytest
from pyspark.sql import functions as F

from starloom.functions import legacy_int, plain_int, surrogate_key
from starloom.functions.keys import without_sign
from starloom.operators.clean import clean
from starloom.specs import Column, Source

NUMBER_TEXTS = [
    "12", "12.5", " 12 ", "\t7\n", "", ".5", "-.5", "12.", "+", "-", ".", "+.", "+3", "-3.9", "1e2",
    "2147483647", "2147483648", "-2147483648", "-2147483649.9", "1,234", "0x1", "007", "1_0", "12.a",
    "- 3", "1.2.3", "0000000000000012", "-000000000000002147483648.0", "99999999999", "99999999999.5",
    "1 2", "12\n", "\n12.5", "12\n.5", "١٢", "12\u00a0", "--1", "+-1", "1-", "12..", "\x0012\x01", "\x7f8\x7f", " 9", "n/a", None,
]


def test_legacy_int_agrees_with_the_non_ansi_cast(spark):
    texts = spark.createDataFrame([(t,) for t in NUMBER_TEXTS], "t string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = [tuple(r) for r in texts.select("t", F.col("t").cast("int")).collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    got = [tuple(r) for r in texts.select("t", legacy_int(F.col("t"))).collect()]
    assert got == want


def test_plain_int_agrees_with_try_cast(spark):
    texts = spark.createDataFrame([(t,) for t in NUMBER_TEXTS], "t string")
    rows = texts.select("t", plain_int(F.col("t")).alias("got"), F.col("t").try_cast("int").alias("want"))
    assert rows.where(~F.col("got").eqNullSafe(F.col("want"))).collect() == []


def test_surrogate_key_values(spark):
    # 64-bit xxHash, seed 42, of the business keys, sign removed.
    known = {
        "301949": 5687388469587005407,
        "006246": 293348318068916719,
        "40 a 44 anos": 8271606593110763612,
        None: 42,
    }
    rows = spark.createDataFrame([(k,) for k in known], "bk string").select("bk", surrogate_key(F.col("bk")))
    got = {r[0]: r[1] for r in rows.collect()}
    assert {k: abs(v) for k, v in got.items()} == {k: abs(v) for k, v in known.items()}
    assert all(v >= 0 for v in got.values())


def test_smallest_long_keeps_its_sign(spark):
    numbers = spark.createDataFrame([(-(2**63),), (-5,), (5,)], "n long")
    assert [r[0] for r in numbers.select(without_sign(F.col("n"))).collect()] == [-(2**63), 5, 5]


def test_clean_trims_casts_and_keeps_every_row(spark):
    source = Source(
        columns=(Column("p"), Column("s"), Column("n", "int"), Column("m", "legacy_int"), Column("d", "date")),
        partition_by=("p",),
        shards="*.csv",
        raw_table="raw",
        clean_table="clean",
    )
    raw = spark.createDataFrame(
        [
            (" a ", " \tx ", " 7 ", "7.9", "2025-08-27"),
            ("a", None, "7.9", " 8 ", "2025-08"),
            ("a", "", "abc", "abc", "27/08/2025"),
            ("a", "é ", None, None, "2025-08-27 10:00:00"),
        ],
        "p string, s string, n string, m string, d string",
    )
    rows = [tuple(r)[:-1] for r in clean(raw, source).withColumn("d", F.col("d").cast("string")).collect()]
    assert rows == [
        ("a", "\tx", 7, 7, "2025-08-27"),
        ("a", None, None, 8, "2025-08-01"),
        ("a", "", None, None, None),
        ("a", "é", None, None, "2025-08-27"),
    ]
    assert clean(raw, source).schema.simpleString() == source.clean_schema.simpleString()


def test_unknown_column_kind_is_refused():
    with pytest.raises(ValueError):
        Column("x", "decimal")
