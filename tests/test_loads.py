from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starloom.__main__ import main
from starloom.models import HEALTH_PLANS, ORDER_LINES
from starloom.models.order_lines import LINES, raw_lines
from starloom.operators.star import ranking, star_view
from starloom.plans import Layout, clean_step, full_load, ingest, open_mart, publish_views, report_frame, transform
from starloom.plans.catalog import LAYERS, publish_catalog
from starloom.sources.delimited import write_shards

HEADER = ";".join(c.name for c in HEALTH_PLANS.source.columns)
FILLER = "P;INDIVIDUAL;AMB;NAC;MED"


def line(period, operator, name, state, city, city_name, band, active, modality="COOP", day="2025-08-27"):
    return (
        f"{period};{operator};{name};00012345000199;{modality};{state};{city};{city_name};M;{band};{band} R;"
        f"P1;{FILLER};TITULAR;{active};1;0;{day}"
    )


def put(folder, state, period, *lines):
    folder.mkdir(exist_ok=True)
    (folder / f"pda-024-icb-{state}-{period}.csv").write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")


@pytest.fixture
def shards(tmp_path):
    folder = tmp_path / "shards"
    put(
        folder,
        "SP",
        "202508",
        line("202508", "006246", " SEGURADORA ", "SP", "355030", "São Paulo", "40 a 44 anos", "10"),
        line("202508", "301949", "OUTRA", "SP", "355030", "São Paulo", "40 a 44 anos", "7.9"),
        line("202508", "301949", "OUTRA", "SP", "", "", "00 a 18 anos", "abc", day="27/08/2025"),
    )
    put(folder, "RJ", "202508", line("202508", "006246", "SEGURADORA", "RJ", "330455", "Rio", "40 a 44 anos", "5"))
    return folder


def test_health_plans_from_shards_to_answers(spark, tmp_path, shards):
    layout = Layout(str(tmp_path / "wh"), HEALTH_PLANS)
    reports = {r.step: r for r in full_load(spark, layout, str(shards))}
    assert reports["raw_pda_beneficiario"].files_loaded == 2
    assert reports["raw_pda_beneficiario"].rows_written == reports["fato_beneficiario"].rows_written == 4
    assert reports["dim_municipio"].rows_inserted == 3
    assert all(r.status == "success" for r in reports.values())
    mart = open_mart(spark, layout)
    operators = ranking(
        mart, ["CD_OPERADORA", "NM_RAZAO_SOCIAL", "MODALIDADE_OPERADORA"], "QT_BENEFICIARIO_ATIVO", limit=5
    )
    assert [tuple(r) for r in operators.collect()] == [
        ("006246", "SEGURADORA", "COOP", 15), ("301949", "OUTRA", "COOP", 7)
    ]
    bands = ranking(mart, ["DE_FAIXA_ETARIA"], "QT_BENEFICIARIO_ATIVO", limit=1)
    assert [tuple(r) for r in bands.collect()] == [("40 a 44 anos", 22)]
    cities = ranking(mart, ["CD_MUNICIPIO", "NM_MUNICIPIO", "SG_UF"], "QT_BENEFICIARIO_ATIVO")
    assert [tuple(r) for r in cities.collect()] == [
        ("355030", "São Paulo", "SP", 17), ("330455", "Rio", "RJ", 5), (None, None, "SP", None)
    ]
    dates = {str(r["DT_CARGA"]) for r in layout.read_clean(spark).collect()}
    assert dates == {"2025-08-27", "None"}


def test_reruns_change_nothing_and_new_periods_update_dimensions(spark, tmp_path, shards):
    layout = Layout(str(tmp_path / "wh"), HEALTH_PLANS)
    for _ in range(2):
        reports = {r.step: r for r in full_load(spark, layout, str(shards))}
    assert (reports["dim_operadora"].rows_inserted, reports["dim_operadora"].rows_updated) == (0, 0)
    assert layout.read_fact(spark).count() == 4
    put(
        shards,
        "SP",
        "202509",
        line("202509", "006246", "NOVO NOME", "SP", "355030", "São Paulo", "40 a 44 anos", "1"),
        line("202509", "999999", "ESTREANTE", "SP", "355030", "São Paulo", "40 a 44 anos", "2"),
    )
    reports = {r.step: r for r in full_load(spark, layout, str(shards))}
    assert (reports["dim_operadora"].rows_inserted, reports["dim_operadora"].rows_updated) == (1, 1)
    mart = open_mart(spark, layout)
    names = {r["NM_RAZAO_SOCIAL"] for r in star_view(mart).where("CD_OPERADORA = '006246'").collect()}
    assert names == {"NOVO NOME"}
    assert layout.read_fact(spark).count() == 6


def test_plain_mode_adds_a_null_key_per_run(spark, tmp_path, shards):
    layout = Layout(str(tmp_path / "wh"), HEALTH_PLANS)
    for _ in range(2):
        full_load(spark, layout, str(shards), null_safe=False)
    dim = HEALTH_PLANS.dimension("dim_municipio")
    assert layout.dimensions(spark).read(dim).where("CD_MUNICIPIO IS NULL").count() == 2
    assert layout.read_fact(spark).where("SK_MUNICIPIO = -1").count() == 1


def test_a_period_with_blanks_around_it_is_loaded_whole(spark, tmp_path):
    shards, layout = tmp_path / "shards", Layout(str(tmp_path / "wh"), HEALTH_PLANS)
    put(
        shards,
        "SP",
        "202508",
        line("202508", "1", "A", "SP", "10", "X", "b", "1"),
        line(" 202508 ", "1", "A", " SP", "10", "X", "b", "2"),
        line("202509", "1", "A", "SP", "10", "X", "b", "4"),
    )
    ingest(spark, layout, str(shards))
    for periods in (None, ["202508"]):
        transform(spark, layout, periods=periods)
        rows = layout.read_fact(spark).collect()
        assert sorted((r["ID_CMPT_MOVEL"], r["SG_UF"], r["QT_BENEFICIARIO_ATIVO"]) for r in rows) == [
            ("202508", "SP", 1), ("202508", "SP", 2), ("202509", "SP", 4)
        ]


def test_missing_shards_stop_the_load(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ingest(spark, Layout(str(tmp_path / "wh"), HEALTH_PLANS), str(tmp_path))


def test_empty_tables_report_no_data(spark, tmp_path):
    layout = Layout(str(tmp_path / "wh"), HEALTH_PLANS)
    layout.create_tables(spark)
    reports = transform(spark, layout)
    assert [(r.step, r.status, r.rows_read, r.rows_written) for r in reports] == [
        ("stg_pda_beneficiario", "no data", 0, 0)
    ]
    assert clean_step(spark, layout).status == "no data"


def test_run_times_can_be_fixed(spark, tmp_path, shards):
    layout = Layout(str(tmp_path / "wh"), HEALTH_PLANS)
    moment = F.lit("2024-05-06 07:08:09").cast("timestamp")
    full_load(spark, layout, str(shards), moment)
    for frame in (layout.read_raw(spark), layout.read_clean(spark), layout.read_fact(spark)):
        assert {str(r[0]) for r in frame.select("CRIADO_EM").distinct().collect()} == {"2024-05-06 07:08:09"}


def test_views_and_catalog_answer_the_same_sql(spark, tmp_path, shards):
    layout = Layout(str(tmp_path / "wh"), HEALTH_PLANS)
    full_load(spark, layout, str(shards))
    publish_views(spark, layout, prefix="t_")
    publish_catalog(spark, layout, prefix="t_")
    text = """SELECT CD_OPERADORA, SUM(QT_BENEFICIARIO_ATIVO) AS TOTAL FROM {} GROUP BY CD_OPERADORA
              ORDER BY TOTAL DESC LIMIT 5"""
    answers = [
        [tuple(r) for r in spark.sql(text.format(name)).collect()]
        for name in ("t_star_beneficiario", "t_gold.star_beneficiario")
    ]
    assert answers == [[("006246", 15), ("301949", 7)]] * 2
    assert spark.table("t_gold.star_beneficiario").columns == HEALTH_PLANS.view_columns
    assert spark.table("t_silver.stg_pda_beneficiario").count() == 4
    for name, layer in LAYERS.items():
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE SCHEMA EXTENDED t_{name}").collect()}
        assert all(f"({k},{v})" in described["Properties"] for k, v in layer.properties.items())
    put(shards, "AC", "202508", line("202508", "777777", "NORTE", "AC", "120040", "Rio Branco", "b", "99"))
    full_load(spark, layout, str(shards))
    publish_catalog(spark, layout, prefix="t_")
    assert spark.sql(text.format("t_gold.star_beneficiario")).first()["TOTAL"] == 99


def test_reports_become_a_frame(spark, tmp_path, shards):
    reports = full_load(spark, Layout(str(tmp_path / "wh"), HEALTH_PLANS), str(shards))
    frame = report_frame(spark, [*reports, replace(reports[0], rows_read=None)])
    assert frame.count() == 7 and frame.where("rows_read IS NULL").count() == 2  # the raw step reads no counted table


def test_invariants_over_the_order_tables(spark, tmp_path, tables):
    shards, layout = str(tmp_path / "shards"), Layout(str(tmp_path / "wh"), ORDER_LINES)
    rows = raw_lines(spark, tables).cache()
    write_shards(rows, LINES, shards)
    full_load(spark, layout, shards)
    mart = open_mart(spark, layout)
    clean, fact, view = layout.read_clean(spark), mart.fact, star_view(mart)
    assert rows.count() == clean.count() == fact.count() == view.count()
    sums = [F.sum(m) for m in ORDER_LINES.measures]
    assert clean.agg(*sums).first() == fact.agg(*sums).first() == view.agg(*sums).first()
    for dim in ORDER_LINES.dimensions:
        frame = mart.members[dim.name].frame
        assert frame.where(F.col(dim.sk) < 0).isEmpty()
        assert frame.count() == frame.select(dim.sk).distinct().count() == frame.select(dim.bk).distinct().count()
        known = fact.where(F.col(dim.sk) != -1)
        assert known.join(frame, dim.sk, "left_anti").isEmpty()
    rows.unpersist()


def test_command_line(spark, tmp_path, shards, capsys):
    root = str(tmp_path / "wh")
    main(["ingest", str(shards), root])
    main(["transform", root, "--periods", "202508"])
    main(["rank", root, "--by", "CD_OPERADORA", "--measure", "QT_BENEFICIARIO_ATIVO", "--limit", "1"])
    shown = capsys.readouterr().out
    assert "fato_beneficiario" in shown and "|006246      |15   |" in shown
