"""Shards with faults, and shards that arrive in several drops."""

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.plans import Layout, queries
from starloom.plans.intake import ingest_new, ingest_screened, read_quarantine
from starloom.sources.delimited import read_shards
from starloom.sources.screening import FAULT, FILE, LINE, screened
from starloom.specs import Column, Source, Star

LETTERS = Source(
    columns=(Column("a"), Column("b"), Column("c")),
    partition_by=("a",),
    shards="part-*.csv",
    raw_table="raw_letters",
    clean_table="clean_letters",
)
STAR = Star(source=LETTERS, dimensions=(), fact_table="fact", measures=(), period="a")


def put(folder, name, *lines, encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes("".join(f"{line}\n" for line in lines).encode(encoding))


def faults(spark, folder, source=LETTERS):
    return sorted(((r[LINE], r[FAULT]) for r in screened(spark, source, str(folder)).collect()), key=str)


def raw(spark, layout):
    return sorted((tuple(r) for r in layout.read_raw(spark).drop("loaded_at").collect()), key=str)


def test_short_long_and_blank_lines(spark, tmp_path):
    put(tmp_path, "part-1.csv", "a;b;c", "1;2", "1;2;3", "", "  ", "1;2;3;4", "1;;", '1;"x;y";3', "a;b;c")
    assert faults(spark, tmp_path) == [('1;"x;y";3', None), ("1;2", "short"), ("1;2;3", None), ("1;2;3;4", "long"), ("1;;", None)]


@pytest.mark.parametrize("head", ["a;b;c", '"A"; b ;"c"', "﻿a;b;c"])
def test_headers_that_fit(spark, tmp_path, head):
    put(tmp_path, "part-1.csv", head, "1;2;3")
    assert faults(spark, tmp_path) == [("1;2;3", None)]


@pytest.mark.parametrize("head", ["b;a;c", "a;b", "a;b;c;d", "1;2;3"])
def test_headers_that_do_not_fit(spark, tmp_path, head):
    put(tmp_path, "part-1.csv", head, "4;5;6", "7")
    put(tmp_path, "part-2.csv", "a;b;c", "4;5;6")
    assert faults(spark, tmp_path) == [("4;5;6", "header"), ("4;5;6", None), ("7", "header")]


def test_good_rows_are_the_plain_readers(spark, tmp_path):
    put(tmp_path, "part-1.csv", "a;b;c", '"";;" x "', ' p ;"q;r";São', r'"say \"hi\"";2;3', '"a ""b"" c";2;3')
    plain = [tuple(r) for r in read_shards(spark, LETTERS, str(tmp_path)).collect()]
    assert [tuple(r)[:3] for r in screened(spark, LETTERS, str(tmp_path)).where(F.col(FAULT).isNull()).collect()] == plain


def test_other_encoding(spark, tmp_path):
    put(tmp_path, "part-1.csv", "a;b;c", "1;São;ñ", encoding="latin-1")
    rows = screened(spark, replace(LETTERS, encoding="ISO-8859-1"), str(tmp_path)).collect()
    assert [tuple(r)[:3] for r in rows] == [("1", "São", "ñ")]


def test_long_lines_and_files_without_rows(spark, tmp_path):
    put(tmp_path, "part-1.csv", "a;b;c", "1;2;" + "x" * 2_000_000, "1;" + '"' * 1_000_001)
    put(tmp_path, "part-2.csv", "a;b;c")
    put(tmp_path, "part-3.csv")
    kinds = {FAULT: [r[FAULT] for r in screened(spark, LETTERS, str(tmp_path)).orderBy(F.length(LINE).desc()).collect()]}
    assert kinds[FAULT][0] is None and kinds[FAULT][1] == "short"


def test_no_shard(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        screened(spark, LETTERS, str(tmp_path))


@pytest.mark.parametrize("gather", [False, True])
def test_quarantine_follows_the_last_delivery(spark, tmp_path, gather):
    layout, drop = Layout(str(tmp_path / "w"), STAR), tmp_path / "in"
    put(drop, "part-1.csv", "a;b;c", "1;2;3", "1;2", "1;2")
    put(drop, "part-2.csv", "c;b;a", "9;9;9")
    report, found = ingest_screened(spark, layout, str(drop), gather=gather)
    assert (report.rows_read, report.rows_written, found) == (4, 1, {"header": 1, "short": 2, "long": 0})
    put(drop, "part-2.csv", "a;b;c", "8;8;8")  # mended: its rejects go, those of the other file are found again
    report, found = ingest_screened(spark, layout, str(drop), gather=gather)
    assert found == {"header": 0, "short": 2, "long": 0}
    kept = read_quarantine(spark, layout).select(F.element_at(F.split(FILE, "/"), -1).alias("f"), LINE, FAULT).collect()
    assert [tuple(r) for r in kept] == [("part-1.csv", "1;2", "short")] * 2
    assert raw(spark, layout) == [("1", "2", "3"), ("8", "8", "8")]


def test_clean_delivery_leaves_an_empty_quarantine(spark, tmp_path):
    layout = Layout(str(tmp_path / "w"), STAR)
    put(tmp_path / "in", "part-1.csv", "a;b;c", "1;2;3")
    assert ingest_screened(spark, layout, str(tmp_path / "in"))[1] == {"header": 0, "short": 0, "long": 0}
    assert read_quarantine(spark, layout).count() == 0


def test_new_shards_only(spark, tmp_path):
    layout, drop = Layout(str(tmp_path / "w"), STAR), tmp_path / "in"
    put(drop, "part-1.csv", "a;b;c", "1;2;3", "2;2;3")
    assert [(r.files_loaded, r.rows_written) for r in ingest_new(spark, layout, str(drop))] == [(1, 2)]
    put(drop, "part-2.csv", "a;b;c", "3;2;3")
    put(drop, "part-3.csv", "a;b;c", "2;9;9")
    assert [(r.files_loaded, r.rows_written) for r in ingest_new(spark, layout, str(drop))] == [(2, 2)]
    assert ingest_new(spark, layout, str(drop)) == []
    # a partition that a later run brings again is replaced, as a plain ingest would
    assert raw(spark, layout) == [("1", "2", "3"), ("2", "9", "9"), ("3", "2", "3")]


def test_lost_checkpoint_changes_nothing(spark, tmp_path):
    layout, drop = Layout(str(tmp_path / "w"), STAR), tmp_path / "in"
    put(drop, "part-1.csv", "a;b;c", "1;2;3", "1;2;3")
    for n in range(2):
        ingest_new(spark, layout, str(drop), checkpoint=str(tmp_path / f"c{n}"))
    assert raw(spark, layout) == [("1", "2", "3")] * 2


def test_faulty_shards_stay_in_their_tasks(spark, tables, monkeypatch):
    """A region and year that comes from several tasks is written by them, a header in each file, and not gathered in one."""
    delivered = queries.delivered(spark, tables).where("period in ('1995', '1996')").repartition(3).cache()
    monkeypatch.setattr(queries, "delivered", lambda *_: delivered)
    monkeypatch.setattr(queries, "_once", {})
    folder = queries._faulty_shards(spark, tables)
    names = queries.TEXTS
    shards = list(Path(folder).glob("shard=*"))
    for shard in shards:
        files = list(shard.glob("*.txt"))
        heads = {file.read_text().split("\n", 1)[0] for file in files}
        assert len(files) == 3 and heads == {";".join(reversed(names) if "EUROPE" in shard.name else names)}
    assert len(shards) == 10
    rows = screened(spark, queries.FAULTY_LINES, folder)
    fits = delivered.where("region <> 'EUROPE' and qty_joined not in ('6', '7')")
    good = rows.where(F.col(FAULT).isNull())
    blanks = {c: F.coalesce(F.col(c), F.lit("")) for c in names}
    assert rows.count() == delivered.count()
    assert sorted(good.select(*names).withColumns(blanks).collect()) == sorted(fits.withColumns(blanks).collect())
