"""The public monthly file of health-plan beneficiaries, one text shard per state."""

from __future__ import annotations

from starloom.specs import Column, Dimension, Layer, Rollup, Source, Star

# The public file's column names and order, the shard name pattern, and the
# table and column names that existing queries over the star use.
BENEFICIARIES = Source(
    columns=(
        Column("ID_CMPT_MOVEL", comment="Reference period"),
        Column("CD_OPERADORA", comment="Operator code"),
        Column("NM_RAZAO_SOCIAL", comment="Operator name"),
        Column("NR_CNPJ", comment="Operator tax id, leading zeros kept"),
        Column("MODALIDADE_OPERADORA", comment="Operator modality"),
        Column("SG_UF", comment="State"),
        Column("CD_MUNICIPIO", comment="Municipality code"),
        Column("NM_MUNICIPIO", comment="Municipality name"),
        Column("TP_SEXO", comment="Sex"),
        Column("DE_FAIXA_ETARIA", comment="Age band"),
        Column("DE_FAIXA_ETARIA_REAJ", comment="Age band for price adjustment"),
        Column("CD_PLANO", comment="Plan code"),
        Column("TP_VIGENCIA_PLANO", comment="Plan validity"),
        Column("DE_CONTRATACAO_PLANO", comment="Contract type"),
        Column("DE_SEGMENTACAO_PLANO", comment="Care segment"),
        Column("DE_ABRG_GEOGRAFICA_PLANO", comment="Geographic coverage"),
        Column("COBERTURA_ASSIST_PLAN", comment="Care coverage"),
        Column("TIPO_VINCULO", comment="Holder or dependant"),
        Column("QT_BENEFICIARIO_ATIVO", "legacy_int", "Active beneficiaries"),
        Column("QT_BENEFICIARIO_ADERIDO", "legacy_int", "Beneficiaries who joined"),
        Column("QT_BENEFICIARIO_CANCELADO", "legacy_int", "Beneficiaries who left"),
        Column("DT_CARGA", "date", "Date of the file"),
    ),
    partition_by=("SG_UF", "ID_CMPT_MOVEL"),
    shards="pda-024-icb-*.csv",
    raw_table="raw_pda_beneficiario",
    clean_table="stg_pda_beneficiario",
    loaded_at="CRIADO_EM",
)

AUDIT = {"created_at": "CRIADO_EM", "updated_at": "ATUALIZADO_EM", "comments": BENEFICIARIES.comments}

OPERATOR = Dimension(
    "dim_operadora",
    "SK_OPERADORA",
    "CD_OPERADORA",
    ("NM_RAZAO_SOCIAL", "NR_CNPJ", "MODALIDADE_OPERADORA"),
    comment="Operators",
    **AUDIT,
)
MUNICIPALITY = Dimension("dim_municipio", "SK_MUNICIPIO", "CD_MUNICIPIO", ("NM_MUNICIPIO", "SG_UF"), comment="Municipalities", **AUDIT)
AGE_BAND = Dimension(
    "dim_faixa_etaria", "SK_FAIXA_ETARIA", "DE_FAIXA_ETARIA", ("DE_FAIXA_ETARIA_REAJ",), comment="Age bands", **AUDIT
)

HEALTH_PLANS = Star(
    source=BENEFICIARIES,
    dimensions=(OPERATOR, MUNICIPALITY, AGE_BAND),
    fact_table="fato_beneficiario",
    measures=("QT_BENEFICIARIO_ATIVO", "QT_BENEFICIARIO_ADERIDO", "QT_BENEFICIARIO_CANCELADO"),
    period="ID_CMPT_MOVEL",
    view="star_beneficiario",
    rollups=(
        Rollup("operator", ("dim_operadora",)),
        Rollup("band", ("dim_faixa_etaria",)),
        Rollup("city", ("dim_municipio",), ("SG_UF",)),
    ),
)

# The properties under which this star's three layers are registered.
HEALTH_LAYERS = {
    "bronze": Layer(
        "Raw rows as delivered, all text",
        {
            "layer": "bronze",
            "data_quality": "raw",
            "created_date": "2026-03-26",
            "sla": "near_realtime",
            "retention_days": "30",
            "pii_data": "yes",
        },
    ),
    "silver": Layer(
        "Clean typed rows",
        {
            "layer": "silver",
            "data_quality": "cleaned_and_validated",
            "created_date": "2026-03-26",
            "sla": "daily",
            "retention_days": "365",
            "pii_data": "masked",
        },
    ),
    "gold": Layer(
        "Dimensions, fact and star view",
        {
            "layer": "gold",
            "data_quality": "curated",
            "created_date": "2026-03-26",
            "sla": "daily",
            "retention_days": "2555",
            "pii_data": "no",
        },
    ),
}
