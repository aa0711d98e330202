import math
import re
from collections import Counter

import pytest

from starloom.llm.decontaminate import B, K1, THRESHOLD, drop_leaks, leaks, retrieved
from starloom.llm.common import table


def words(text):
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower()) if w]


def brute(docs, items):
    """Every window against every unit of an item, exhaustively scored."""
    units = [(i, words(t)[k : k + 64]) for i, t in items for k in range(0, len(words(t)), 64)]
    units = list({(i, tuple(u)): None for i, u in units})
    df = Counter(w for _, u in units for w in set(u))
    avg = sum(len(u) for _, u in units) / max(len(units), 1)
    weights = []
    for _, u in units:
        tf = Counter(u)
        raw = {
            w: math.log1p((len(units) - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * len(u) / avg))
            for w, n in tf.items()
        }
        weights.append({w: x / sum(raw.values()) for w, x in raw.items()})
    found = {}
    for d, t in docs:
        own = words(t)
        for s in range(0, len(own), 64):
            window = set(own[s : s + 128])
            for (i, _), weight in zip(units, weights, strict=True):
                score = sum(x for w, x in weight.items() if w in window)
                if score >= THRESHOLD:
                    found[d, i] = True
    return set(found)


@pytest.mark.parametrize("shard_units", [7, 20_000])
def test_retrieval_equals_exhaustive_scoring(spark, tables, shard_units):
    docs, items = table(spark, tables, "documents"), table(spark, tables, "benchmark")
    got = {(r.doc_id, r.item_id) for r in retrieved(docs, items, shard_units=shard_units).collect()}
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and got


def test_question_and_answer_must_both_be_there(spark):
    question = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    answer = "red orange yellow green blue indigo violet"
    filler = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame(
        [(1, f"{filler} {question.upper()}. {answer} {filler}"), (2, f"{filler} {question}. {filler}"),
         (3, filler), (4, f"{question}, {answer}!"), (4, f"{question}, {answer}!")],
        "doc_id bigint, text string",
    )
    items = spark.createDataFrame([(7, f"{question}. {answer}."), (8, None), (9, ""), (10, "...")], "item_id bigint, text string")
    assert sorted((r.doc_id, r.item_id) for r in leaks(docs, items).collect()) == [(1, 7), (4, 7), (4, 7)]


def test_odd_rows(spark, odd, none, tables, tmp_path):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog. And runs on and on."), (2, "one")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(odd, items).collect()}
    assert got == {(1, 1), (2, 1), (6, 2), (7, 2)}
    assert leaks(none, items).count() == 0 and leaks(odd, items.where("false")).count() == 0
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    left = drop_leaks(spark, odd, str(tmp_path))
    assert left.columns == odd.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["3", "4", "5", "None", "8", "9"])
