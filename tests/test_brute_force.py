"""Random rows with NULLs and one key holding a third of them, against plain Python."""

import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.models.order_lines import ORDER_LINES, SUPPLIER
from starloom.operators.dimensions import INSERTED, UPDATED, dimension_rows, latest_members, merge_type1
from starloom.operators.fact import fact_rows
from starloom.operators.lookup import Side
from starloom.operators.star import Mart, ranking, star_view

ATTRIBUTES = list(SUPPLIER.attributes)
FIRST, SECOND = datetime(2024, 1, 1), datetime(2024, 2, 1)


def pick(rng, values, null=0.1):
    return None if rng.random() < null else rng.choice(values)


def random_rows(seed, count=3000):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        key = "hot" if rng.random() < 1 / 3 else pick(rng, [f"k{i}" for i in range(60)])
        rows.append((key, pick(rng, ["1", "2", "3"]), *[pick(rng, ["a", "b", "c"]) for _ in ATTRIBUTES]))
    return rows


def low(values):
    """Sort key in which NULL is smallest."""
    return tuple((v is not None, v or "") for v in values)


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_members(spark, seed):
    rows = random_rows(seed)
    best = {}
    for key, period, *values in rows:
        if key not in best or low([period, *values]) > low(best[key]):
            best[key] = [period, *values]
    frame = spark.createDataFrame(rows, ["supp_cd", "period", *ATTRIBUTES])
    got = {r["supp_cd"]: [r[a] for a in ATTRIBUTES] for r in latest_members(frame, SUPPLIER, "period").collect()}
    assert got == {key: values for key, (_, *values) in best.items()}


def merge_in_python(target, source, null_safe):
    """Rows after the merge with what happened to each; keys unique but for NULL."""
    old, out = dict(target), []
    for key, new in source.items():
        matched = key in old and (key is not None or null_safe)
        if not matched:
            out.append((key, new, "inserted"))
            continue
        if null_safe:
            changed = old[key] != new
        else:
            changed = any(a is not None and b is not None and a != b for a, b in zip(old[key], new))
        out.append((key, new if changed else old[key], "updated" if changed else "kept"))
    rest = [k for k in old if k not in source or (k is None and not null_safe)]
    return out + [(k, old[k], "kept") for k in rest]


@pytest.mark.parametrize("null_safe", [True, False])
def test_merge(spark, null_safe):
    rng = random.Random(7)
    keys = [None, *[f"k{i}" for i in range(400)]]

    def members():
        chosen = [k for k in keys if k is None or rng.random() < 0.6]
        return {k: tuple(pick(rng, ["a", "b"], 0.3) for _ in ATTRIBUTES) for k in chosen}

    def frame(rows, moment):
        flat = spark.createDataFrame([(k, *v) for k, v in rows.items()], SUPPLIER.schema.names[1:-2])
        return dimension_rows(flat, SUPPLIER, F.lit(moment))

    target, source = members(), members()
    merged = merge_type1(frame(target, FIRST), frame(source, SECOND), SUPPLIER, F.lit(SECOND), null_safe)
    got = []
    for r in merged.collect():
        what = "inserted" if r[INSERTED] else "updated" if r[UPDATED] else "kept"
        got.append((r["supp_cd"], tuple(r[a] for a in ATTRIBUTES), what))
        assert r["created_at"] == (SECOND if what == "inserted" else FIRST)
        assert r["updated_at"] == (FIRST if what == "kept" else SECOND)
    assert sorted(got, key=repr) == sorted(merge_in_python(target, source, null_safe), key=repr)


@pytest.mark.parametrize("limit", [0, 10**9])
def test_fact_star_and_ranking(spark, limit):
    rng = random.Random(11)
    names = {
        "supp_cd": [f"s{i}" for i in range(40)],
        "city_cd": [f"c{i}" for i in range(10)],
        "band": [f"b{i}" for i in range(5)],
    }
    rows = []
    for _ in range(2000):
        supplier = "s0" if rng.random() < 1 / 3 else pick(rng, names["supp_cd"])
        codes = (supplier, pick(rng, names["city_cd"], 0.3), pick(rng, names["band"]))
        rows.append((pick(rng, ["R1", "R2"], 0), "1", *codes, pick(rng, range(50)), 1, 0))
    schema = (
        "region string, period string, supp_cd string, city_cd string, band string, "
        "qty_active int, qty_joined int, qty_left int"
    )
    clean = spark.createDataFrame(rows, schema)
    known, members = {}, {}
    for dim in ORDER_LINES.dimensions:
        known[dim.bk] = {c for c in names[dim.bk] if rng.random() < 0.8}
        flat = spark.createDataFrame(
            [(c, *[f"{c}-{a}" for a in dim.attributes]) for c in known[dim.bk]], [dim.bk, *dim.attributes]
        )
        members[dim.name] = Side(dimension_rows(flat, dim, F.lit(FIRST)))
    mart = Mart(ORDER_LINES, fact_rows(clean, ORDER_LINES, members, limit=limit), members, limit)

    def seen(column, value):
        return value if value in known[column] else None

    want = [(r[0], seen("supp_cd", r[2]), seen("city_cd", r[3]), seen("band", r[4]), r[5]) for r in rows]
    view = star_view(mart, ["region", "supp_cd", "city_cd", "band", "qty_active"])
    assert sorted(map(tuple, view.collect()), key=repr) == sorted(want, key=repr)

    totals = defaultdict(lambda: None)
    for region, supplier, _, _, quantity in want:
        key = (supplier, region)
        totals[key] = totals[key] if quantity is None else (totals[key] or 0) + quantity
    got = [tuple(r) for r in ranking(mart, ["supp_cd", "region"], "qty_active").collect()]
    assert {(s, r): t for s, r, t in got} == dict(totals)
    order = [(t is None, -(t or 0), s is None, s or "", r) for s, r, t in got]
    assert order == sorted(order)
