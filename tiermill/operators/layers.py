"""Layer transforms as pure ``DataFrame -> DataFrame`` functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.functions.text import lenient_date, lenient_int, mask_id
from tiermill.schemas import ACTIVE, GOLD_KEYS, GOLD_MEASURE, INGESTED_AT, MONTH, SOURCE_FILE


def to_bronze(raw: DataFrame, source: str | None = None) -> DataFrame:
    """Raw rows unchanged plus audit columns (load time, source).

    ``source=None`` records each row's own input file (``_metadata``), which
    is exact for multi-file and directory inputs; a string records that path.
    """
    src: Column = F.lit(source) if source is not None else F.col("_metadata.file_path")
    return raw.select("*", F.current_timestamp().alias(INGESTED_AT), src.alias(SOURCE_FILE))


def to_silver(bronze: DataFrame) -> DataFrame:
    """Typed, trimmed and masked projection of bronze (19 columns).

    Names are resolved case-insensitively, so the raw upper-case header names
    map to lower snake_case. TRIM strips spaces only (tabs are kept).
    """
    text = lambda c: F.col(c).cast("string")
    trim = lambda c: F.trim(F.col(c))
    return bronze.select(
        text("CD_OPERADORA").alias("cd_operadora"),
        trim("NM_RAZAO_SOCIAL").alias("nm_razao_social"),
        mask_id("NR_CNPJ").alias("nr_cnpj_masc"),
        trim("MODALIDADE_OPERADORA").alias("modalidade_operadora"),
        text("SG_UF").alias("sg_uf"),
        text("CD_MUNICIPIO").alias("cd_municipio"),
        trim("NM_MUNICIPIO").alias("nm_municipio"),
        text("TP_SEXO").alias("tp_sexo"),
        trim("DE_FAIXA_ETARIA").alias("de_faixa_etaria"),
        trim("DE_SEGMENTACAO_PLANO").alias("de_segmentacao_plano"),
        trim("DE_ABRG_GEOGRAFICA_PLANO").alias("de_abrg_geografica_plano"),
        trim("DE_CONTRATACAO_PLANO").alias("de_contratacao_plano"),
        trim("COBERTURA_ASSIST_PLAN").alias("cobertura_assist_plan"),
        trim("TIPO_VINCULO").alias("tipo_vinculo"),
        lenient_int("QT_BENEFICIARIO_ATIVO").alias("qt_beneficiario_ativo"),
        lenient_int("QT_BENEFICIARIO_ADERIDO").alias("qt_beneficiario_aderido"),
        lenient_int("QT_BENEFICIARIO_CANCELADO").alias("qt_beneficiario_cancelado"),
        lenient_date("DT_CARGA").alias("dt_carga"),
        text("ID_CMPT_MOVEL").alias(MONTH),
    )


def gold_by(silver: DataFrame, keys: list[str], measure: str = ACTIVE) -> DataFrame:
    """SUM of the active quantity per key combination (BIGINT result).

    Planned as partial aggregation before the shuffle, so a key holding a
    third of all rows is pre-summed inside every task and never reaches one
    reducer as raw rows.
    """
    return silver.groupBy(*keys).agg(F.sum(measure).alias(GOLD_MEASURE))


@dataclass(frozen=True)
class Golds:
    """The three gold tables."""

    operadora: DataFrame
    faixa: DataFrame
    municipio: DataFrame

    def by_table(self) -> dict[str, DataFrame]:
        return {
            "beneficiarios_por_operadora": self.operadora,
            "beneficiarios_por_faixa_etaria": self.faixa,
            "beneficiarios_por_municipio": self.municipio,
        }


GID = "_tm_gid"


def grouping_id_of(dims: list[str], keys: list[str]) -> int:
    """``grouping_id()`` of the grouping set ``keys`` among ``dims``: bit i is
    set when dims[i] is not grouped (the first dimension is the most
    significant bit)."""
    return sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in keys)


def golds_one_pass(silver: DataFrame, measure: str = ACTIVE) -> DataFrame:
    """All three gold aggregates from a single scan of silver (GROUPING SETS).

    Each row carries ``_tm_gid`` telling which gold it belongs to, so a real
    NULL key stays distinct from the NULLs of the other grouping sets. The
    scan reads the five key columns and the measure once; rows are expanded
    per grouping set inside the map stage and pre-aggregated before the one
    shuffle. The result is gold-sized; split it with :func:`split_golds`.
    """
    dims = list(dict.fromkeys(k for keys in GOLD_KEYS.values() for k in keys))
    return silver.groupingSets(list(GOLD_KEYS.values()), *dims).agg(
        F.sum(measure).alias(GOLD_MEASURE), F.grouping_id().alias(GID)
    )


def split_golds(combined: DataFrame) -> Golds:
    """The three gold tables out of :func:`golds_one_pass`'s result."""
    dims = [c for c in combined.columns if c not in (GOLD_MEASURE, GID)]
    g = {
        table: combined.filter(F.col(GID) == grouping_id_of(dims, keys)).select(*keys, GOLD_MEASURE)
        for table, keys in GOLD_KEYS.items()
    }
    return Golds(
        g["beneficiarios_por_operadora"],
        g["beneficiarios_por_faixa_etaria"],
        g["beneficiarios_por_municipio"],
    )


def to_golds(silver: DataFrame) -> Golds:
    """All three gold aggregates of a silver frame (lazy, one scan each)."""
    g = {name: gold_by(silver, keys) for name, keys in GOLD_KEYS.items()}
    return Golds(
        g["beneficiarios_por_operadora"],
        g["beneficiarios_por_faixa_etaria"],
        g["beneficiarios_por_municipio"],
    )
