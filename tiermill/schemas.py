"""Fixed schemas of every layer and the age-band domain."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values: column names of the raw beneficiary file and its layers ---
RAW_COLUMNS = [
    "CD_OPERADORA",
    "NM_RAZAO_SOCIAL",
    "NR_CNPJ",
    "MODALIDADE_OPERADORA",
    "SG_UF",
    "CD_MUNICIPIO",
    "NM_MUNICIPIO",
    "TP_SEXO",
    "DE_FAIXA_ETARIA",
    "DE_SEGMENTACAO_PLANO",
    "DE_ABRG_GEOGRAFICA_PLANO",
    "DE_CONTRATACAO_PLANO",
    "COBERTURA_ASSIST_PLAN",
    "TIPO_VINCULO",
    "QT_BENEFICIARIO_ATIVO",
    "QT_BENEFICIARIO_ADERIDO",
    "QT_BENEFICIARIO_CANCELADO",
    "DT_CARGA",
    "ID_CMPT_MOVEL",
]

# Audit columns appended by the bronze load.
INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"

# Silver partition key (reference month) and the measure every gold sums.
MONTH = "id_cmpt_movel"
ACTIVE = "qt_beneficiario_ativo"
GOLD_MEASURE = "qt_beneficiarios_ativos"

# Quantity columns checked by the typing checks: (silver name, bronze name).
QUANTITY_PAIRS = [
    ("qt_beneficiario_ativo", "QT_BENEFICIARIO_ATIVO"),
    ("qt_beneficiario_aderido", "QT_BENEFICIARIO_ADERIDO"),
    ("qt_beneficiario_cancelado", "QT_BENEFICIARIO_CANCELADO"),
]

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])

BRONZE_SCHEMA = StructType(
    RAW_SCHEMA.fields
    + [
        StructField(INGESTED_AT, TimestampType(), True),
        StructField(SOURCE_FILE, StringType(), True),
    ]
)

_SILVER_TEXT = [
    "cd_operadora",
    "nm_razao_social",
    "nr_cnpj_masc",
    "modalidade_operadora",
    "sg_uf",
    "cd_municipio",
    "nm_municipio",
    "tp_sexo",
    "de_faixa_etaria",
    "de_segmentacao_plano",
    "de_abrg_geografica_plano",
    "de_contratacao_plano",
    "cobertura_assist_plan",
    "tipo_vinculo",
]

SILVER_SCHEMA = StructType(
    [StructField(c, StringType(), True) for c in _SILVER_TEXT]
    + [
        StructField("qt_beneficiario_ativo", IntegerType(), True),
        StructField("qt_beneficiario_aderido", IntegerType(), True),
        StructField("qt_beneficiario_cancelado", IntegerType(), True),
        StructField("dt_carga", DateType(), True),
        StructField(MONTH, StringType(), True),
    ]
)

# Gold tables: name -> grouping keys. Every gold is SUM(active) by its keys.
GOLD_KEYS = {
    "beneficiarios_por_operadora": ["cd_operadora", "nm_razao_social"],
    "beneficiarios_por_faixa_etaria": ["de_faixa_etaria"],
    "beneficiarios_por_municipio": ["cd_municipio", "nm_municipio"],
}


def gold_schema(table: str) -> StructType:
    return StructType(
        [StructField(k, StringType(), True) for k in GOLD_KEYS[table]]
        + [StructField(GOLD_MEASURE, LongType(), True)]
    )


#: Gold sums by month: every gold's keys, the number that tells the golds apart, the sum, the month.
PARTIALS_SCHEMA = StructType(
    [StructField(k, StringType(), True) for k in dict.fromkeys(k for keys in GOLD_KEYS.values() for k in keys)]
    + [StructField("_tm_gid", LongType(), True), StructField(GOLD_MEASURE, LongType(), True), StructField(MONTH, StringType(), True)]
)

CHECK_SCHEMA = StructType(
    [
        StructField("check", StringType(), False),
        StructField("passed", BooleanType(), True),
        StructField("detail", StringType(), True),
    ]
)


def age_band_domain() -> list[str]:
    """The 17 age bands in age order: five-year steps from 0, then 80 and over."""
    bands = [f"{lo} a {lo + 4} anos" for lo in range(0, 80, 5)]
    return bands + ["80 anos ou mais"]
