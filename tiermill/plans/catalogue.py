"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the lake built from the test tables of ``sf_dir`` (see
:mod:`tiermill.plans.workspace`) through the library's own operators, so
its work grows with the input. Queries that must change a lake (refresh,
month replacement, upsert, stream) work on a fresh copy of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.operators import quality as Q
from tiermill.operators import ranking as R
from tiermill.operators import rejects
from tiermill.operators.layers import Golds, to_bronze, to_silver
from tiermill.plans.medallion import (
    BRONZE,
    SILVER,
    load_bronze,
    load_golds,
    load_month,
    load_rankings,
    load_silver,
    register_layers,
    run,
    run_month,
    upsert,
)
from tiermill.plans.results import result
from tiermill.plans.workspace import Workspace, reference_row, workspace, workspace_frame
from tiermill.schemas import (
    GOLD_KEYS,
    GOLD_MEASURE,
    INGESTED_AT,
    MONTH,
    SILVER_SCHEMA,
    SOURCE_FILE,
    age_band_domain,
    gold_schema,
)
from tiermill.session import new_scratch_path
from tiermill.sources.raw_csv import read_raw
from tiermill.sources.fixture import write_raw_csv
from tiermill.sources.layers import layer_path, list_tables, read_layer, read_table, storage_options, write_layer
from tiermill.sources.results import export_result, read_result, read_result_positions
from tiermill.sources.ledger import load_new
from tiermill.streaming.ingest import stream_ingest
from tiermill.streaming.months import stream_months

Query = Callable[[SparkSession, str], DataFrame]

OP = GOLD_KEYS["beneficiarios_por_operadora"]
FX = GOLD_KEYS["beneficiarios_por_faixa_etaria"]
MU = GOLD_KEYS["beneficiarios_por_municipio"]
QT = GOLD_MEASURE

# Parameters of the parameterised views (fixed for the registered queries).
PAGE_NUMBER, PAGE_SIZE = 2, 10
SEARCH_TERM = "nation_1"
# Upsert batch: the latest month's rows of one sex code.
BATCH_SEX = "R"
UPSERT_KEYS = ["id_cmpt_movel", "cd_operadora", "cd_municipio", "de_faixa_etaria"]


def _ws(spark: SparkSession, sf_dir: str) -> Workspace:
    return workspace(spark, sf_dir)


def _golds(spark: SparkSession, sf_dir: str) -> Golds:
    ws = _ws(spark, sf_dir)
    return workspace_frame(spark, ws, "golds", lambda: load_golds(spark, ws.root))


def _ranked(spark: SparkSession, sf_dir: str) -> Golds:
    ws = _ws(spark, sf_dir)
    return workspace_frame(spark, ws, "rankings", lambda: load_rankings(spark, ws.root))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, sf_dir)
    return workspace_frame(spark, ws, "silver", lambda: load_silver(spark, ws.root))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, sf_dir)
    return workspace_frame(spark, ws, "bronze", lambda: load_bronze(spark, ws.root))


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _ws(spark, sf_dir)
    return workspace_frame(spark, ws, "raw", lambda: read_raw(spark, ws.raw_path))


def _reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_row(spark, _ws(spark, sf_dir))


def _by_month(silver: DataFrame) -> DataFrame:
    return silver.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("n_linhas"), F.sum("qt_beneficiario_ativo").cast("long").alias(QT)
    )


# ------------------------------------------------------------------ layers --

def bronze_ingest(spark, sf_dir):
    return _bronze(spark, sf_dir).drop(INGESTED_AT, SOURCE_FILE)


def silver_refine(spark, sf_dir):
    return _silver(spark, sf_dir)


def silver_by_month(spark, sf_dir):
    return _by_month(_silver(spark, sf_dir))


def gold_operadora(spark, sf_dir):
    return _golds(spark, sf_dir).operadora


def gold_faixa_etaria(spark, sf_dir):
    return _golds(spark, sf_dir).faixa


def gold_municipio(spark, sf_dir):
    return _golds(spark, sf_dir).municipio


# ----------------------------------------------------------- named results --

def _named(name: str) -> Query:
    def q(spark, sf_dir):
        return result(_golds(spark, sf_dir), name)

    q.__name__ = name
    return q


def c_beneficiarios_por_municipio(spark, sf_dir):
    """The published file, re-read with the gold schema, in the order it was written in."""
    ws = _ws(spark, sf_dir)
    name, schema = "c_beneficiarios_por_municipio", gold_schema("beneficiarios_por_municipio")
    return read_result_positions(spark, ws.out_dir, name, schema, R.POSITION).orderBy(R.POSITION)


# Published result -> (gold table, its code column).
RESULT_FILES = {
    "a_top5_operadoras": ("beneficiarios_por_operadora", "cd_operadora"),
    "b_faixa_etaria_top": ("beneficiarios_por_faixa_etaria", "de_faixa_etaria"),
    "c_beneficiarios_por_municipio": ("beneficiarios_por_municipio", "cd_municipio"),
}


def results_content(spark, sf_dir):
    """What the three published files hold: position, code, quantity."""
    ws = _ws(spark, sf_dir)
    parts = [
        read_result_positions(spark, ws.out_dir, name, gold_schema(table), R.POSITION).select(
            F.lit(name).alias("resultado"), R.POSITION, F.col(key).alias("chave"), F.col(QT).alias("quantidade"))
        for name, (table, key) in RESULT_FILES.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def export_round_trip(spark, sf_dir):
    """Names with padding, tabs, quotes, backslashes, empty and missing text, exported and read again."""
    name, code = F.col("s_name"), F.col("s_suppkey")
    text = (
        F.when(code % 7 == 0, F.concat(F.lit(" "), name, F.lit(" ")))
        .when(code % 7 == 1, F.concat(F.lit("\t"), name))
        .when(code % 7 == 2, F.lit(""))
        .when(code % 7 == 3, F.lit(None).cast("string"))
        .when(code % 7 == 4, F.concat(F.lit('"'), name, F.lit('" said')))
        .when(code % 7 == 5, F.concat(F.lit("00"), code.cast("string")))
        .otherwise(F.concat(name, F.lit(", \\x")))
    )
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/supplier.parquet").select(code.cast("long").alias("n"), text.alias("t"))
    out = new_scratch_path(spark, "export")
    export_result(rows, out, "nomes")
    return read_result(spark, out, "nomes", rows.schema)


# ---------------------------------------------------------------- analytics --

def top_n_operadoras(spark, sf_dir):
    return R.top_n(_golds(spark, sf_dir).operadora, QT, OP, 10)


def top_n_municipios(spark, sf_dir):
    return R.top_n(_golds(spark, sf_dir).municipio, QT, MU, 15)


def faixa_por_idade(spark, sf_dir):
    fx = _golds(spark, sf_dir).faixa
    return R.order_by_domain(R.flag_leader(fx, QT, FX), "de_faixa_etaria", age_band_domain())


def ranking_operadoras(spark, sf_dir):
    """Stored ranked gold (written once by the results step with rank_with_share)."""
    return _ranked(spark, sf_dir).operadora


def ranking_municipios(spark, sf_dir):
    return _ranked(spark, sf_dir).municipio


def concentracao_municipios(spark, sf_dir):
    return R.concentration(_ranked(spark, sf_dir).municipio, QT, "nm_municipio")


def concentracao_operadoras(spark, sf_dir):
    return R.concentration(_ranked(spark, sf_dir).operadora, QT, "nm_razao_social")


def lider_faixa(spark, sf_dir):
    return R.leader_summary(_golds(spark, sf_dir).faixa, QT, FX)


def kpis(spark, sf_dir):
    g = _golds(spark, sf_dir)
    return R.kpis(g.operadora, g.faixa, g.municipio)


def municipios_pagina(spark, sf_dir):
    return R.page_stored(_ranked(spark, sf_dir).municipio, PAGE_NUMBER, PAGE_SIZE)


def municipios_busca(spark, sf_dir):
    return R.search(_golds(spark, sf_dir).municipio, "nm_municipio", SEARCH_TERM)


def municipios_formatado(spark, sf_dir):
    return R.display_municipios(_ranked(spark, sf_dir).municipio)


def operadoras_cards(spark, sf_dir):
    """Top-5 operator cards (formatted count, share with one decimal, bar fill)."""
    return R.display_cards(_ranked(spark, sf_dir).operadora, "nm_razao_social", 5, 1)


def municipios_destaques(spark, sf_dir):
    """Municipality highlights: leader, its share, count, top-5 / top-10 shares."""
    return R.display_highlights(R.concentration(_ranked(spark, sf_dir).municipio, QT, "nm_municipio"), 1)


# ------------------------------------------------------------------ checks --

def _layers(spark, sf_dir):
    return _ws(spark, sf_dir), _raw(spark, sf_dir), _bronze(spark, sf_dir), _silver(spark, sf_dir), _golds(spark, sf_dir)


def dq_volume(spark, sf_dir):
    _, raw, bronze, silver, _ = _layers(spark, sf_dir)
    return Q.check_volume(raw, bronze, silver)


def dq_typing(spark, sf_dir):
    _, _, bronze, silver, _ = _layers(spark, sf_dir)
    return Q.check_typing(bronze, silver)


def dq_masking(spark, sf_dir):
    return Q.check_masking(_silver(spark, sf_dir))


def dq_sanity(spark, sf_dir):
    return Q.check_sanity(_silver(spark, sf_dir))


def dq_totals(spark, sf_dir):
    return Q.check_totals(_silver(spark, sf_dir), _golds(spark, sf_dir))


def dq_single_pass(spark, sf_dir):
    return Q.silver_metrics(_silver(spark, sf_dir))


def _reconcile(table: str) -> Query:
    label, key = Q.RECONCILE[table]

    def q(spark, sf_dir):
        silver, gold = _silver(spark, sf_dir), _golds(spark, sf_dir).by_table()[table]
        recalc = Q.recompute(silver, key)
        n_div = Q.divergences(recalc, gold, key).agg(F.count(F.lit(1))).scalar()
        n_gold = gold.agg(F.count(F.lit(1))).scalar()
        return recalc.agg(
            F.lit(table).alias("tabela"),
            n_div.alias("divergencias"),
            F.count(F.lit(1)).alias("n_recalculo"),
            n_gold.alias("n_gold"),
        )

    q.__name__ = f"dq_reconcile_{label}"
    return q


def damage_gold(gold: DataFrame, key: str) -> DataFrame:
    """A deliberately wrong gold: smallest key renamed, largest key's sum +1."""
    lo, hi = gold.agg(F.min(key)).scalar(), gold.agg(F.max(key)).scalar()
    return gold.select(
        F.when(F.col(key) == lo, F.concat(F.col(key), F.lit("X"))).otherwise(F.col(key)).alias(key),
        *[c for c in gold.columns if c not in (key, QT)],
        F.when(F.col(key) == hi, F.col(QT) + 1).otherwise(F.col(QT)).alias(QT),
    )


def dq_divergent_rows(spark, sf_dir):
    silver, g = _silver(spark, sf_dir), _golds(spark, sf_dir)
    key = "cd_operadora"
    return Q.divergences(Q.recompute(silver, key), damage_gold(g.operadora, key), key)


def dq_outputs(spark, sf_dir):
    ws = _ws(spark, sf_dir)
    return Q.check_outputs(spark, _golds(spark, sf_dir), ws.out_dir, _ranked(spark, sf_dir))


def dq_outputs_damaged(spark, sf_dir):
    """The output checks over files of which one has a wrong quantity and lacks its last row."""
    ws, golds = _ws(spark, sf_dir), _golds(spark, sf_dir)
    out = new_scratch_path(spark, "damaged")
    for name, (table, _) in RESULT_FILES.items():
        rows = read_result_positions(spark, ws.out_dir, name, gold_schema(table), R.POSITION)
        if name == "c_beneficiarios_por_municipio":
            last = rows.agg(F.max(R.POSITION)).scalar()
            rows = rows.filter(F.col(R.POSITION) < last).withColumn(QT, F.col(QT) + (F.col(R.POSITION) == 2).cast("long"))
        export_result(rows.orderBy(R.POSITION).drop(R.POSITION), out, name)
    return Q.check_outputs(spark, golds, out, _ranked(spark, sf_dir))


def dq_reference(spark, sf_dir):
    return Q.check_reference(_golds(spark, sf_dir), _reference(spark, sf_dir))


def full_report(spark, sf_dir) -> DataFrame:
    ws, raw, bronze, silver, golds = _layers(spark, sf_dir)
    return Q.checks(raw, bronze, silver, golds, ws.out_dir, _reference(spark, sf_dir), ranked=_ranked(spark, sf_dir))


def dq_report(spark, sf_dir):
    return full_report(spark, sf_dir)


def dq_summary(spark, sf_dir):
    return Q.summary(full_report(spark, sf_dir))


# -------------------------------------------------------------- dirty rows --

def _dirty(spark, sf_dir):
    ws = workspace(spark, sf_dir, dirty=True)
    return read_raw(spark, ws.raw_path), load_bronze(spark, ws.root), load_silver(spark, ws.root), load_golds(spark, ws.root)


def silver_refine_dirty(spark, sf_dir):
    return _dirty(spark, sf_dir)[2]


def dq_report_dirty(spark, sf_dir):
    """The suite over rows with faults: V2, V3 and V4 do not pass."""
    return Q.checks(*_dirty(spark, sf_dir))


def dq_summary_dirty(spark, sf_dir):
    return Q.summary(dq_report_dirty(spark, sf_dir))


def faixa_por_idade_dirty(spark, sf_dir):
    fx = _dirty(spark, sf_dir)[3].faixa
    return R.order_by_domain(R.flag_leader(fx, QT, FX), "de_faixa_etaria", age_band_domain())


def gate_layers(spark, sf_dir):
    """Whether each gate lets the next layer be written, for a clean and a dirty delivery."""
    _, raw, bronze, silver, _ = _layers(spark, sf_dir)
    d_raw, d_bronze, d_silver, _ = _dirty(spark, sf_dir)
    parts = [
        Q.summary(checks).select(F.lit(load).alias("entrega"), F.lit(gate).alias("portao"), F.col("all_passed").alias("promovido"))
        for load, gate, checks in (
            ("clean", "ingest", Q.check_ingest(raw, bronze)), ("clean", "silver", Q.check_silver(bronze, silver)),
            ("dirty", "ingest", Q.check_ingest(d_raw, d_bronze)), ("dirty", "silver", Q.check_silver(d_bronze, d_silver)),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _gold_rows(spark, root: str) -> DataFrame:
    parts = [
        g.select(F.lit(t).alias("tabela"), F.col(GOLD_KEYS[t][0]).alias("chave"), F.col(QT).alias("quantidade"))
        for t, g in load_golds(spark, root).by_table().items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def audit_keeps_old(spark, sf_dir):
    """A lake after a dirty delivery that the gate stops: silver and golds are those of the clean one."""
    ws, dirty = _ws(spark, sf_dir), workspace(spark, sf_dir, dirty=True)
    root = new_scratch_path(spark, "audit")
    run(spark, ws.raw_path, root, steps=["bronze", "silver", "gold"], gate=True)
    try:
        run(spark, dirty.raw_path, root, steps=["bronze", "silver", "gold"], gate=True)
    except Q.ChecksFailed:
        pass
    silver = load_silver(spark, root).agg(
        F.lit("silver").alias("tabela"), F.lit(None).cast("string").alias("chave"), F.sum("qt_beneficiario_ativo").cast("long").alias("quantidade"))
    return silver.unionByName(_gold_rows(spark, root))


def rejected_rows(spark, sf_dir):
    """Every fault of the dirty delivery: row, column, reason and value as delivered."""
    raw = rejects.read_with_lines(spark, workspace(spark, sf_dir, dirty=True).raw_path)
    return rejects.split(raw)[1].select("CD_OPERADORA", "CD_MUNICIPIO", MONTH.upper(), "coluna", "motivo", "valor")


def accepted_rows(spark, sf_dir):
    """The dirty delivery without its rejected rows, refined."""
    raw = rejects.read_with_lines(spark, workspace(spark, sf_dir, dirty=True).raw_path)
    return to_silver(rejects.split(raw)[0])


def busca_sem_acento(spark, sf_dir):
    """Municipalities found as users type them, without accents."""
    return R.search(_dirty(spark, sf_dir)[3].municipio, "nm_municipio", "sao nation_1", accents=False)


def deliveries_once(spark, sf_dir):
    """The delivery, the same rows in files of other names, and the first files again: bronze has each row once."""
    raw, base = _raw(spark, sf_dir), new_scratch_path(spark, "once")
    root = f"{base}/lake"
    # both times the same tasks read the same files, so both deliveries have as many files, of the same rows each; a task that
    # writes rows in turn to two files takes longer than two tasks
    for name in ("first", "again"):
        write_raw_csv(raw, f"{base}/raw/entrega={name}")
    for k, name in enumerate(("first", "again", "first")):
        load_new(spark, f"{base}/raw/entrega={name}", root, lambda rows, k=k: to_bronze(rows, source=str(k)).write.mode("append").options(
            **storage_options("parquet")).parquet(layer_path(root, *BRONZE)))
    return load_bronze(spark, root).select(*raw.columns)


# ----------------------------------------------------------------- catalog --

def catalog_tables(spark, sf_dir):
    """Every layer table registered, listed and counted through the catalog.

    The registration holds for the session, so it is made again for each
    folder of test tables.
    """
    ws = _ws(spark, sf_dir)
    register_layers(spark, ws.root)
    parts = [
        read_table(spark, layer, table).agg(
            F.lit(layer).alias("camada"), F.lit(table).alias("tabela"), F.count(F.lit(1)).alias("n_linhas"))
        for layer in ("bronze", "silver", "gold") for table in list_tables(spark, layer) if not table.startswith("ranking_")
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def bronze_audit(spark, sf_dir):
    """Rows of bronze, and those with a load time and a source file."""
    return _bronze(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_linhas"), F.count(INGESTED_AT).alias("com_carga"), F.count(SOURCE_FILE).alias("com_arquivo"))


# ------------------------------------------------- refresh / incremental --

def idempotent_refresh(spark, sf_dir):
    """Run bronze -> gold twice into one fresh root; the golds are unchanged."""
    ws = _ws(spark, sf_dir)
    root = new_scratch_path(spark, "refresh")
    for _ in range(2):
        run(spark, ws.raw_path, root, steps=["bronze", "silver", "gold"])
    golds = load_golds(spark, root).by_table()
    parts = [
        g.agg(F.lit(t).alias("tabela"), F.count(F.lit(1)).alias("n_linhas"), F.sum(QT).cast("long").alias("total"))
        for t, g in golds.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _silver_copy(spark, sf_dir, rows: DataFrame | None = None) -> tuple[DataFrame, str]:
    """The built lake's silver (or some rows of it), and a fresh lake root that holds a copy."""
    silver, root = _silver(spark, sf_dir), new_scratch_path(spark, "incremental")
    write_layer(silver if rows is None else rows, root, *SILVER, partition_by=[MONTH], layout="sorted")
    return silver, root


def _latest(spark, silver: DataFrame) -> str:
    """The latest month, from the partition folders' names."""
    return silver.agg(F.max(MONTH)).first()[0]


def incremental_month(spark, sf_dir):
    """Replace the whole latest month by a corrected delivery (X1): every quantity one more."""
    silver, root = _silver_copy(spark, sf_dir)
    month = _latest(spark, silver)
    corrected = silver.filter(F.col(MONTH) == month).withColumn("qt_beneficiario_ativo", F.col("qt_beneficiario_ativo") + 1)
    load_month(corrected, root, month)
    return _by_month(load_silver(spark, root))


def upsert_month(spark, sf_dir):
    """Upsert a batch into silver by key (X2); the batch doubles one sex code's active count in the latest month.

    The test tables have several rows of a key, so a key stands for all its rows.
    """
    silver, root = _silver_copy(spark, sf_dir)
    month = _latest(spark, silver)
    batch = silver.filter((F.col(MONTH) == month) & (F.col("tp_sexo") == BATCH_SEX)).withColumn(
        "qt_beneficiario_ativo", F.col("qt_beneficiario_ativo") * 2
    )
    upsert(spark, batch, root, *SILVER, UPSERT_KEYS, schema=SILVER_SCHEMA, partition_by=[MONTH], unique=False)
    return _by_month(load_silver(spark, root))


def upsert_null_partition(spark, sf_dir):
    """Upsert into a NULL month: the month's other keys stay."""
    silver = _silver(spark, sf_dir)
    old = silver.withColumn(MONTH, F.when(F.col("tp_sexo") != "N", F.col(MONTH)))
    _, root = _silver_copy(spark, sf_dir, old)
    batch = old.filter(F.col(MONTH).isNull() & (F.col("cd_municipio") == "1")).withColumn(
        "qt_beneficiario_ativo", F.col("qt_beneficiario_ativo") * 2
    )
    upsert(spark, batch, root, *SILVER, UPSERT_KEYS, schema=SILVER_SCHEMA, partition_by=[MONTH], unique=False)
    return _by_month(load_silver(spark, root))


def monthly_loads(spark, sf_dir):
    """A lake of all months but the last two, then these one by one from delivery to results."""
    raw, base = _raw(spark, sf_dir), new_scratch_path(spark, "monthly")
    month = MONTH.upper()
    last = [r[0] for r in _silver(spark, sf_dir).select(MONTH).distinct().orderBy(F.desc(MONTH)).limit(2).collect()][::-1]
    write_raw_csv(raw.filter(~F.col(month).isin(last)), f"{base}/raw/before")
    run(spark, f"{base}/raw/before", f"{base}/lake", steps=["bronze", "silver"])
    for m in last:
        write_raw_csv(raw.filter(F.col(month) == m), f"{base}/raw/{m}")
        run_month(spark, f"{base}/raw/{m}", f"{base}/lake", f"{base}/out", m)
    return _gold_rows(spark, f"{base}/lake")


def stream_months_replaced(spark, sf_dir):
    """All months by stream, then a corrected latest month by the same stream: it replaces the earlier one in silver and gold."""
    raw, base = _raw(spark, sf_dir), new_scratch_path(spark, "stream-months")
    month = MONTH.upper()
    latest = _latest(spark, _silver(spark, sf_dir))
    corrected = raw.filter(F.col(month) == latest).withColumn(
        "QT_BENEFICIARIO_ATIVO", (F.col("QT_BENEFICIARIO_ATIVO").cast("int") + 1).cast("string"))
    for k, rows in enumerate((raw, corrected)):
        write_raw_csv(rows, f"{base}/in/delivery={k}")
        stream_months(spark, f"{base}/in/*", f"{base}/lake", f"{base}/checkpoint")
    return _gold_rows(spark, f"{base}/lake")


def stream_ingest_query(spark, sf_dir):
    """Stream the delivered raw files into a fresh bronze table.

    Run twice: the second run finds no new file, so the rows are ingested
    exactly once.
    """
    ws = _ws(spark, sf_dir)
    base = new_scratch_path(spark, "stream")
    for _ in range(2):
        stream_ingest(spark, ws.raw_path, f"{base}/bronze", f"{base}/checkpoint")
    return read_layer(spark, base, "bronze", "", recursive=True).drop(INGESTED_AT, SOURCE_FILE)


def stream_after_batch(spark, sf_dir):
    """A bronze table of a batch load and two streamed deliveries, one after the other."""
    raw, base = _raw(spark, sf_dir), new_scratch_path(spark, "stream")
    third = F.pmod(F.xxhash64(*raw.columns), F.lit(3))
    write_layer(to_bronze(raw.filter(third == 0), source="batch"), base, *BRONZE)
    for k in (1, 2):
        write_raw_csv(raw.filter(third == k), f"{base}/in/delivery={k}")
        stream_ingest(spark, f"{base}/in/*", f"{base}/{'/'.join(BRONZE)}", f"{base}/checkpoint")
    return load_bronze(spark, base).select(*raw.columns)


QUERIES: dict[str, Query] = {
    "bronze_ingest": bronze_ingest,
    "silver_refine": silver_refine,
    "silver_by_month": silver_by_month,
    "gold_operadora": gold_operadora,
    "gold_faixa_etaria": gold_faixa_etaria,
    "gold_municipio": gold_municipio,
    "a_top5_operadoras": _named("a_top5_operadoras"),
    "b_faixa_etaria_top": _named("b_faixa_etaria_top"),
    "c_beneficiarios_por_municipio": c_beneficiarios_por_municipio,
    "insight_operadoras": _named("insight_operadoras"),
    "insight_faixa_etaria": _named("insight_faixa_etaria"),
    "top_n_operadoras": top_n_operadoras,
    "top_n_municipios": top_n_municipios,
    "faixa_por_idade": faixa_por_idade,
    "ranking_operadoras": ranking_operadoras,
    "ranking_municipios": ranking_municipios,
    "concentracao_municipios": concentracao_municipios,
    "concentracao_operadoras": concentracao_operadoras,
    "lider_faixa": lider_faixa,
    "kpis": kpis,
    "municipios_pagina": municipios_pagina,
    "municipios_busca": municipios_busca,
    "municipios_formatado": municipios_formatado,
    "operadoras_cards": operadoras_cards,
    "municipios_destaques": municipios_destaques,
    "dq_volume": dq_volume,
    "dq_typing": dq_typing,
    "dq_masking": dq_masking,
    "dq_sanity": dq_sanity,
    "dq_totals": dq_totals,
    "dq_single_pass": dq_single_pass,
    "dq_reconcile_operadora": _reconcile("beneficiarios_por_operadora"),
    "dq_reconcile_faixa": _reconcile("beneficiarios_por_faixa_etaria"),
    "dq_reconcile_municipio": _reconcile("beneficiarios_por_municipio"),
    "dq_divergent_rows": dq_divergent_rows,
    "dq_outputs": dq_outputs,
    "dq_reference": dq_reference,
    "dq_report": dq_report,
    "dq_summary": dq_summary,
    "dq_outputs_damaged": dq_outputs_damaged,
    "results_content": results_content,
    "export_round_trip": export_round_trip,
    "silver_refine_dirty": silver_refine_dirty,
    "dq_report_dirty": dq_report_dirty,
    "dq_summary_dirty": dq_summary_dirty,
    "faixa_por_idade_dirty": faixa_por_idade_dirty,
    "gate_layers": gate_layers,
    "audit_keeps_old": audit_keeps_old,
    "rejected_rows": rejected_rows,
    "accepted_rows": accepted_rows,
    "busca_sem_acento": busca_sem_acento,
    "deliveries_once": deliveries_once,
    "catalog_tables": catalog_tables,
    "bronze_audit": bronze_audit,
    "idempotent_refresh": idempotent_refresh,
    "incremental_month": incremental_month,
    "upsert_month": upsert_month,
    "upsert_null_partition": upsert_null_partition,
    "monthly_loads": monthly_loads,
    "stream_months_replaced": stream_months_replaced,
    "stream_ingest": stream_ingest_query,
    "stream_after_batch": stream_after_batch,
}
