"""Keys that hashes share, bucketed merges, the change feed, rollups and global numbering against brute force."""

import random
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.functions import surrogate_key
from starloom.models.order_lines import ORDER_LINES, raw_lines
from starloom.operators.dimensions import dimension_rows, merge_type1
from starloom.operators.numbering import numbered
from starloom.operators.probing import KeySpaceTooSmall, moved_keys
from starloom.operators.star import ranking, star_view
from starloom.plans.catalog import publish_catalog
from starloom.plans.loads import Layout, land, known_hot_keys, open_mart, stale_periods, transform
from starloom.sources.commits import DimensionStore
from starloom.specs import Dimension, Rollup

DIM = Dimension("dim", "sk", "bk", ("attr",), key_bits=9)
T1, T2, T3 = (f"2024-0{m}-01 00:00:00" for m in (1, 2, 3))


@pytest.fixture
def stored(spark, tmp_path):
    def write(rows, label):
        path = f"{tmp_path}/{label}-{random.getrandbits(60)}"
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    return write


def hashes(spark, keys, bits, probe):
    rows = spark.createDataFrame([(k,) for k in keys], "bk string")
    return dict(rows.select("bk", surrogate_key(F.col("bk"), bits, probe)).collect())


def brute_keys(spark, keys, bits):
    """Key by key in rounds, straight from the rule."""
    plain = hashes(spark, keys, bits, 0)
    rank = lambda k: (k is not None, k or "")
    taken, out = set(plain.values()), {}
    waiting = []
    for k in sorted(keys, key=rank):
        if plain[k] in {out[x] for x in out}:
            waiting.append(k)
        else:
            out[k] = plain[k]
    probe = 0
    while waiting:
        probe += 1
        tried, won = hashes(spark, waiting, bits, probe), {}
        for k in sorted(waiting, key=rank):
            if tried[k] not in taken and tried[k] not in won.values():
                won[k] = tried[k]
        out |= won
        taken |= set(won.values())
        waiting = [k for k in waiting if k not in won]
    return out


def at(moment):
    return F.lit(moment).cast("timestamp")


def dim_rows(spark, pairs, moment, dim=DIM):
    return dimension_rows(spark.createDataFrame(pairs, "bk string, attr string"), dim, at(moment))


def test_probed_keys_equal_brute_force(spark, stored):
    keys = [None, *[f"k{i}" for i in range(220)]]
    rows = stored(spark.createDataFrame([(k, 0) for k in keys], "bk string, sk bigint"), "keys")
    moved = {r.bk: r.sk for r in moved_keys(rows, "bk", "sk", stored, bits=9).collect()}
    want = brute_keys(spark, keys, 9)
    plain = hashes(spark, keys, 9, 0)
    assert len(set(want.values())) == len(keys) and None not in moved
    assert moved == {k: v for k, v in want.items() if v != plain[k]} and len(moved) > 20
    assert moved_keys(rows, "bk", "sk", stored).isEmpty()
    with pytest.raises(KeySpaceTooSmall):
        moved_keys(rows, "bk", "sk", stored, bits=8)


@pytest.mark.parametrize("bucket_bytes", [1 << 30, 500])
def test_keys_do_not_depend_on_the_order_of_merges(spark, tmp_path, bucket_bytes):
    draw = random.Random(4)
    keys = [f"k{i}" for i in range(200)] + [None]
    draw.shuffle(keys)
    want = brute_keys(spark, keys, 9)
    orders = (keys, sorted(keys, key=str, reverse=True)) if bucket_bytes < 1000 else (keys[::-1],)
    for n, order in enumerate(orders):
        store = DimensionStore(spark, f"{tmp_path}/{n}", bucket_bytes=bucket_bytes)
        for moment, part in zip((T1, T2, T3), (order[:70], order[40:150], order[100:]), strict=True):
            commit = store.upsert(DIM, dim_rows(spark, [(k, "x") for k in part], moment), at(moment))
        assert {r.bk: r.sk for r in store.read(DIM).collect()} == want
        assert {r.bk: r.sk for r in store.exceptions(DIM).collect()} == {k: v for k, v in want.items() if v != hashes(spark, [k], 9, 0)[k]}
        assert commit["rows_total"] == len(keys) == store.read(DIM).count()
        assert store.log(DIM).agg(F.sum("rows_rekeyed")).first()[0] > 0
        for version in (1, 3):
            assert sorted(store.replayed(DIM, version).collect(), key=str) == sorted(store.read(DIM, version).collect(), key=str)


def test_a_rekeyed_row_may_change_as_well(spark, tmp_path):
    """A merge that gives a row a new attribute and, by bringing a smaller key of its hash, a new key."""
    names = [f"k{i}" for i in range(400)]
    plain, shared = hashes(spark, names, 9, 0), {}
    for k in sorted(names):
        shared.setdefault(plain[k], []).append(k)
    small, large = next(v[:2] for v in shared.values() if len(v) > 1)
    store = DimensionStore(spark, str(tmp_path))
    store.upsert(DIM, dim_rows(spark, [(large, "old"), ("zz", "stays")], T1), at(T1))
    commit = store.upsert(DIM, dim_rows(spark, [(large, "new"), (small, "first")], T2), at(T2))
    assert (commit["rows_inserted"], commit["rows_updated"], commit["rows_rekeyed"]) == (1, 1, 1)
    rows = {r.bk: r for r in store.read(DIM).collect()}
    assert rows[small].sk == plain[small] and rows[large].sk != plain[large] and rows[large].attr == "new" and len(rows) == 3
    assert sorted(store.replayed(DIM, 2).collect(), key=str) == sorted(rows.values(), key=str)
    feed = [(r.operation, r.after.bk) for r in store.changes(DIM).where("version = 2").collect()]
    assert sorted(feed) == sorted([("insert", small), ("update", large), ("rekey", large)])


@pytest.mark.parametrize("null_safe", [True, False])
def test_bucketed_merges_equal_whole_merges(spark, tmp_path, null_safe):
    dim, draw = replace(DIM, key_bits=64), random.Random(8)
    store = DimensionStore(spark, str(tmp_path), bucket_bytes=2000)
    whole, buckets = None, []
    for n, moment in enumerate((T1, T2, T3, T1, T2)):
        keys = draw.sample(range(n * 40, n * 40 + 300), 150) if n < 3 else range(120, 122) if n == 3 else []
        pairs = [(f"k{k}", "c" if n == 3 else draw.choice(["a", "b", None])) for k in keys] + ([(None, draw.choice("ab"))] if n < 2 else [])
        source = dim_rows(spark, pairs, moment, dim)
        commit = store.upsert(dim, source, at(moment), null_safe)
        target = spark.createDataFrame(whole or [], dim.schema)
        merged = merge_type1(target, source, dim, at(moment), null_safe) if whole else source
        whole = [tuple(r) for r in merged.select(*dim.columns).collect()]
        assert sorted(map(str, whole)) == sorted(str(tuple(r)) for r in store.read(dim).collect())
        assert commit["rows_total"] == len(whole)
        buckets.append((len(commit["buckets"]), commit["buckets_rewritten"]))
    assert buckets[0] == (1, 1) and buckets[2][0] > 4 and 0 < buckets[3][1] <= 2 < buckets[3][0] and buckets[4][1] == 0
    sizes = store.log(dim).orderBy("version").select("bytes_total").collect()
    from starloom.operators.lookup import measured_bytes

    assert sizes[-1][0] == measured_bytes(store.read(dim))


def test_facts_follow_a_key_that_moves(spark, tables, tmp_path):
    """Suppliers arrive greatest code first, so earlier ones lose their hash and their facts are built again."""
    dims = tuple(replace(d, key_bits=7 if d.name == "dim_supplier" else 64) for d in ORDER_LINES.dimensions)
    layout = Layout(str(tmp_path), replace(ORDER_LINES, dimensions=dims, rollups=(Rollup("s", ("dim_supplier",)),)))
    code = (F.col("l") % 60).cast("string")
    rows = raw_lines(spark, tables).withColumn("l", F.xxhash64("supp_tax_id", "band", "qty_active", "city_cd"))
    rows = rows.withColumn("supp_cd", F.concat(F.lit("s"), F.abs(code.cast("int")).cast("string"))).drop("l")
    low = F.col("supp_cd") < "s3"
    first = rows.where((F.col("period") == "1995") & ~low)
    land(first, layout)
    transform(spark, layout, periods=["1995"])
    built = {p: p.stat().st_mtime_ns for p in Path(layout.fact).rglob("*.parquet")}
    land(rows.where(F.col("period") == "1996"), layout)
    transform(spark, layout, periods=["1996"])
    supplier = layout.star.dimension("dim_supplier")
    assert layout.dimensions(spark).log(supplier).agg(F.sum("rows_rekeyed")).first()[0] > 0
    assert not built.items() & {p: p.stat().st_mtime_ns for p in Path(layout.fact).rglob("*.parquet")}.items()
    assert stale_periods(spark, layout) == []
    both = first.union(rows.where(F.col("period") == "1996"))
    want = {r[0]: r[1] for r in both.groupBy("supp_cd").agg(F.sum(F.col("qty_joined").cast("int"))).collect()}
    mart = open_mart(spark, layout)
    assert {r.supp_cd: r.total for r in ranking(mart, ["supp_cd"], "qty_joined").collect()} == want
    view = star_view(mart).groupBy("supp_cd").agg(F.sum("qty_joined").alias("total"))
    assert {r.supp_cd: r.total for r in view.collect()} == want


def test_a_period_keeps_the_hot_keys_of_others(spark, tables, tmp_path):
    layout = Layout(str(tmp_path), ORDER_LINES)
    rows = raw_lines(spark, tables)
    hot = F.when(F.col("period").isin("1995", "1997"), F.concat(F.lit("HOT"), "period")).otherwise(F.col("city_cd"))
    land(rows.withColumn("city_cd", hot), layout)
    transform(spark, layout)
    before = known_hot_keys(spark, layout)
    transform(spark, layout, periods=["1995"])
    assert known_hot_keys(spark, layout) == before
    total = rows.count()
    for year in ("1995", "1997"):
        share = rows.where(F.col("period") == year).count() / total
        assert before["dim_city"]["city_cd"][f"HOT{year}"] == pytest.approx(share)


def test_rollups_answer_only_what_they_cover(spark, tables, tmp_path):
    star = replace(ORDER_LINES, rollups=(Rollup("supplier", ("dim_supplier",)), Rollup("wide", ("dim_supplier", "dim_band"), ("region",))))
    layout = Layout(str(tmp_path), star)
    land(raw_lines(spark, tables), layout)
    transform(spark, layout)
    mart = open_mart(spark, layout)
    empty = replace(mart, fact=mart.fact.where("false"))
    for by, covered in ((["supp_cd"], True), (["period", "supp_name"], True), (["region", "band"], True), (["city_cd"], False)):
        rows = {tuple(r) for r in ranking(replace(mart, rollups={}), by, "qty_active").collect()}
        assert {tuple(r) for r in ranking(mart, by, "qty_active").collect()} == rows
        assert ({tuple(r) for r in ranking(empty, by, "qty_active").collect()} == rows) is covered


def test_numbers_with_ties_across_ranges(spark, stored):
    draw = random.Random(2)
    for ranges, values in ((1, [1]), (7, [5] * 40), (9, [5] * 40 + [4, 4, 3, None, None]), (13, [draw.choice([1, 2, 2, 3, None]) for _ in range(200)])):
        data = [(f"r{i:03}", v) for i, v in enumerate(values)]
        got = numbered(spark.createDataFrame(data, "name string, total bigint"), "total", ["name"], stored, ranges).collect()
        order = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
        levels = list(dict.fromkeys(v for _, v in order))
        tops = [v for _, v in order]
        whole = sum(v or 0 for v in values)
        want = {(n, v, i + 1, tops.index(v) + 1, levels.index(v) + 1, None if v is None else v / whole) for i, (n, v) in enumerate(order)}
        assert {tuple(r) for r in got} == want
    assert numbered(spark.createDataFrame([], "name string, total bigint"), "total", ["name"], stored).count() == 0


def test_a_bucketed_dimension_in_the_catalog(spark, tables, tmp_path):
    layout = Layout(str(tmp_path), ORDER_LINES, bucket_bytes=300)
    rows = raw_lines(spark, tables)
    land(rows.where("period < '1996'"), layout)
    transform(spark, layout)
    land(rows.where("period >= '1996'"), layout)
    transform(spark, layout)
    supplier = ORDER_LINES.dimension("dim_supplier")
    assert len(layout.dimensions(spark).locations(supplier)) > 1
    publish_catalog(spark, layout, prefix="bk_")
    named = spark.table("bk_gold.dim_supplier").drop("key_bucket")
    assert sorted(named.collect(), key=str) == sorted(layout.dimensions(spark).read(supplier).collect(), key=str)
    view = spark.sql(f"SELECT supp_cd, sum(qty_active) AS total FROM bk_gold.{ORDER_LINES.view} GROUP BY supp_cd")
    assert {tuple(r) for r in view.collect()} == {tuple(r) for r in ranking(open_mart(spark, layout), ["supp_cd"], "qty_active").collect()}
