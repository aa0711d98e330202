import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from starloom.llm import common
from starloom.llm.common import Words, components, with_group


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_no_edges_have_no_components(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_groups_reach_hot_cold_and_null_keys(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") < 3000, 1).when(F.col("id") > 4990, None).otherwise(F.col("id")).cast("long").alias("k"))
    groups = rows.where("k is not null and k % 2 = 1").groupBy("k").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("least"))
    got = {tuple(r) for r in with_group(rows, groups, "k", "m").collect()}
    want = {tuple(r) for r in rows.join(groups, "k", "left").select("id", "k", "m", "least").collect()}
    assert got == want


def test_words_and_their_hashes():
    texts = ["a bb  a", None, "", "bb\ta", "x" * 3_000_000 + " a"]
    words = Words(texts)
    assert words.count.tolist() == [3, 0, 0, 2, 2]
    h = words.hashes
    assert h[0] == h[2] == h[4] == h[6] and h[1] == h[3] and len(set(h.tolist())) == 3
    assert len(Words([]).hashes) == 0 and len(Words(["", None]).shingles(5)[0]) == 0
    a, owner = Words(["a b c d e f", "x a b c d e"]).shingles(5)
    assert owner.tolist() == [0, 0, 1, 1] and a[0] == a[3] and len(np.unique(a)) == 3


def test_hashing_holds_little_and_does_not_depend_on_how_text_is_dealt(monkeypatch):
    text = " ".join(f"w{i * i % 70001}é" for i in range(250_000))
    words = Words([text, "", "one two", None, text[:1000]])
    common._powers(1)
    tracemalloc.start()
    whole = words.hashes
    peak = tracemalloc.get_traced_memory()[1] - whole.nbytes
    tracemalloc.stop()
    assert peak < 16e6
    monkeypatch.setattr(common, "HASHED_CHARS", 1000)
    assert (Words(words.texts).hashes == whole).all()
