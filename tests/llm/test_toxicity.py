import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.llm.common import table
from starloom.llm.toxicity import FEATURES, entries, entry_counts, features, learned, lexicon, op12_toxicity, toxicity

SCHEMA = "doc_id bigint, text string"


def planted(n=1200, seed=5):
    """Texts of made-up words; a tenth are toxic by words whose beginning is common to them, or by insults."""
    draw = random.Random(seed)
    plain = ["".join(draw.choices("aeiounrstl", k=draw.randint(3, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = draw.choices(plain, k=draw.randint(5, 120))
        toxic = draw.random() < 0.15
        if toxic:
            for _ in range(draw.randint(2, 4)):
                bad = "qwirz" + draw.choice("abcdefg") * 2 if draw.random() < 0.5 else draw.choice(["moron", "scum"])
                words.insert(draw.randint(0, len(words)), bad)
        docs.append((i, " ".join(words)))
        if draw.random() < 0.8:
            labels.append((i, int(toxic)))
    return docs, labels


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = planted()
    frames = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    return docs, dict(labels), {r.doc_id: r for r in toxicity(*frames).collect()}


def test_held_out_accuracy(judged):
    docs, labels, got = judged
    assert set(got) == {i for i, _ in docs} and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == held_out(r.doc_id) and r.predicted == int(r.score >= 0.5) for r in got.values())
    test = [(got[i].predicted, y) for i, y in labels.items() if held_out(i)]
    toxic = [p for p, y in test if y]
    clean = [p for p, y in test if not y]
    assert len(toxic) > 15 and sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.02 * len(clean)


def test_held_out_labels_are_not_read(spark, judged):
    docs, labels, got = judged
    turned = [(i, 1 - y if held_out(i) else y) for i, y in labels.items()]
    again = toxicity(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(turned, "doc_id bigint, toxic int"))
    assert {r.doc_id: r.score for r in again.collect()} == {i: r.score for i, r in got.items()}


def test_given_table(spark):
    folder = "/root/testdata/sf0.01"
    got = op12_toxicity(spark, folder)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = got.join(table(spark, folder, "labels"), "doc_id").where("held_out").collect()
    assert got.count() == table(spark, folder, "documents").count()
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    auc = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.9


def test_entry_counts_equal_brute_force(spark):
    docs, labels = planted(150)
    by_id = dict(docs)
    want = {True: Counter(), False: Counter()}
    for i, y in labels:
        want[y > 0].update({e for w in re.findall(r"\w+", by_id[i]) for e in entries(w)})
    rows = spark.createDataFrame([(by_id[i], y) for i, y in labels], "text string, toxic int").repartition(5)
    got = {r.entry: (r.toxic, r.clean) for r in entry_counts(rows).collect()}
    assert got == {e: (want[True][e], want[False][e]) for e in want[True] | want[False]}
    learned_words = lexicon(rows)
    assert learned_words["qwirz"] > 2 and len(lexicon(rows, 3)) == 3


def test_features_of_plain_texts(spark):
    texts = ["You absolute MORON!!", "m0ron 1d1ot fine", "s t u p i d sooo", "quiet words only", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r.doc_id: dict(zip(FEATURES, r.features, strict=True)) for r in features(docs, {"abso": 1.5}).collect()}
    assert got[0]["insults"] == 1 and got[0]["near_second_person"] == 2 / 3 and got[0]["capital_words"] == 1 / 3
    assert got[0]["shouts_per_word"] == 1 / 3 and got[0]["most_weight"] == 1.5 and got[0]["telling"] == 1
    assert got[1]["masked_insults"] == 2 and got[1]["insults"] == 0 and got[1]["mixed_per_word"] > 0
    assert got[2]["spelled_per_word"] > 0 and got[2]["drawn_per_word"] > 0
    assert not any(v for k, v in got[3].items() if k != "words") and not any(got[4].values()) and not any(got[5].values())


def test_bounded_sample_of_labels(spark):
    docs, labels = planted(600)
    frames = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model, measured = learned(*frames, learn_rows=200)
    assert measured.count() == 600 and model.trees is not None
    assert model.scored(measured).where("score is null").isEmpty()


def test_without_labels_or_with_one_class(spark, odd):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity(odd, none).collect()} == {0.5}
    clean = spark.createDataFrame([(i, 0) for i in range(8)] + [(8, None), (None, 1)], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity(odd, clean).collect()} == {0.0}


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] + [(1, 0), (2, 1)], "doc_id bigint, toxic int")
    rows = toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(r.score is not None and 0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert len({r.score for r in rows if r.doc_id == 2}) == 1
    assert toxicity(none, labels).count() == 0
    assert toxicity(odd.withColumn("toxic", F.lit(9)).withColumn("features", F.lit("x")), labels).count() == odd.count()
