"""The filtering stages keep and drop rows, not doc_ids: ids may be null or stand for several texts."""

import random
from urllib.parse import unquote, urlparse

import pyarrow.parquet as pq

from starloom.llm.common import table, with_row_ids, written
from starloom.llm.decontaminate import drop_leaks
from starloom.llm.jaccard import one_of_each
from starloom.llm.quality import judged, keep_good

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in pairs], SCHEMA).repartition(3)


def prose(seed, n=60):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("aeiorstln", k=draw.randint(2, 8))) for _ in range(n)) + "."


def left(frame):
    return sorted((str(r.doc_id), r.text) for r in frame.collect())


def test_leaks_go_row_by_row(spark, tables):
    item = table(spark, tables, "benchmark").first()["text"]
    leak = f"{prose(1)} {item} {prose(2)}"
    pairs = [(None, leak), (None, prose(3)), (None, prose(4)), (7, leak), (7, prose(5)), (7, prose(6)), (8, prose(7))]
    kept = drop_leaks(spark, rows_of(spark, pairs), tables)
    assert left(kept) == sorted((str(i), t) for i, t in pairs if t != leak) and kept.columns == SCHEMA.replace(",", "").split()[::2]


def test_one_row_of_each_class_stays(spark, tables):
    same, near = prose(1, 200), prose(1, 200).replace(".", " more.")
    pairs = [(1, same), (1, same), (None, same), (None, same), (2, near), (2, prose(9)), (None, prose(10)), (3, ""), (3, ""), (None, " ")]
    want = [(1, same), (2, prose(9)), (None, prose(10)), (3, ""), (3, ""), (None, " ")]
    assert left(one_of_each(spark, rows_of(spark, pairs), tables)) == sorted((str(i), t) for i, t in want)
    nameless = one_of_each(spark, rows_of(spark, [(None, same)] * 5 + [(None, near)]), tables).collect()
    assert len(nameless) == 1


def test_good_rows_stay_whatever_shares_their_id(spark, tables):
    docs = table(spark, tables, "documents").where("text is not null").limit(120)
    verdicts = {r.doc_id: r.kept for r in judged(docs).collect()}
    shared = docs.selectExpr("if(doc_id % 2 = 0, null, 5L) as doc_id", "text", "lang", "source", "n_chars")
    kept = keep_good(spark, shared, tables)
    assert sorted(r.text for r in kept.collect()) == sorted(r.text for r in docs.collect() if verdicts[r.doc_id])
    assert kept.where("doc_id is null").count() > 0 and kept.columns == docs.columns


def stored_bytes(frame):
    """Bytes of a table's files, and how their texts are compressed."""
    files = [pq.ParquetFile(unquote(urlparse(f).path)).metadata for f in frame.inputFiles()]
    groups = [f.row_group(i) for f in files for i in range(f.num_row_groups)]
    columns = [g.column(i) for g in groups for i in range(g.num_columns)]
    return sum(c.total_compressed_size for c in columns), {c.compression for c in columns if c.path_in_schema == "text"}


def test_stored_rows_are_compressed_well(spark):
    """Every filtering stage keeps a copy of all texts: three of them must leave room in four times the input."""
    rows = rows_of(spark, [(i, prose(i, 300)) for i in range(400)])
    size, how = stored_bytes(with_row_ids(rows, "__row"))
    assert how == {"ZSTD"} and size < 0.8 * stored_bytes(written(rows, "plain"))[0]
    assert left(with_row_ids(rows, "__row")) == left(rows)
