"""DuckDB SQL equivalent of every registered query (the correctness oracle).

All statements start from the raw rows derived from the test tables
(``raw``), then ``silver`` and the three golds, written as CTEs. Spark runs
the same questions through the real operators (CSV write and re-read,
layer writes); these strings only state the expected answer.
"""

from __future__ import annotations

# Written on its own: nothing here comes from the package.
QUANTITY_PAIRS = [
    ("qt_beneficiario_ativo", "QT_BENEFICIARIO_ATIVO"),
    ("qt_beneficiario_aderido", "QT_BENEFICIARIO_ADERIDO"),
    ("qt_beneficiario_cancelado", "QT_BENEFICIARIO_CANCELADO"),
]
RECONCILE = {
    "beneficiarios_por_operadora": ("operadora", "cd_operadora"),
    "beneficiarios_por_faixa_etaria": ("faixa_etaria", "de_faixa_etaria"),
    "beneficiarios_por_municipio": ("municipio", "cd_municipio"),
}

_RAW = """
raw AS (
  SELECT lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS CD_OPERADORA,
         concat(' ', s_name, ' ') AS NM_RAZAO_SOCIAL,
         concat(lpad(CAST(l_suppkey AS VARCHAR), 8, '0'), '000199') AS NR_CNPJ,
         p_type AS MODALIDADE_OPERADORA,
         r_name AS SG_UF,
         CAST(n_nationkey AS VARCHAR) AS CD_MUNICIPIO,
         n_name AS NM_MUNICIPIO,
         l_returnflag AS TP_SEXO,
         CASE WHEN p_size*2-2 >= 80 THEN '80 anos ou mais'
              ELSE concat(CAST(p_size*2-2-(p_size*2-2)%5 AS VARCHAR), ' a ',
                          CAST(p_size*2-2-(p_size*2-2)%5+4 AS VARCHAR), ' anos') END AS DE_FAIXA_ETARIA,
         c_mktsegment AS DE_SEGMENTACAO_PLANO,
         o_orderpriority AS DE_ABRG_GEOGRAFICA_PLANO,
         o_orderstatus AS DE_CONTRATACAO_PLANO,
         p_brand AS COBERTURA_ASSIST_PLAN,
         l_linestatus AS TIPO_VINCULO,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS QT_BENEFICIARIO_ATIVO,
         CAST(l_linenumber AS VARCHAR) AS QT_BENEFICIARIO_ADERIDO,
         CAST(p_size AS VARCHAR) AS QT_BENEFICIARIO_CANCELADO,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS DT_CARGA,
         substring(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 1, 7) AS ID_CMPT_MOVEL
  FROM lineitem
  JOIN orders   ON l_orderkey  = o_orderkey
  JOIN customer ON o_custkey   = c_custkey
  JOIN nation   ON c_nationkey = n_nationkey
  JOIN region   ON n_regionkey = r_regionkey
  JOIN part     ON l_partkey   = p_partkey
  JOIN supplier ON l_suppkey   = s_suppkey
)"""

_SILVER = r"""
silver AS (
  SELECT CAST(CD_OPERADORA AS VARCHAR) AS cd_operadora,
         trim(NM_RAZAO_SOCIAL) AS nm_razao_social,
         substring(NR_CNPJ, 1, 8) || '******' AS nr_cnpj_masc,
         trim(MODALIDADE_OPERADORA) AS modalidade_operadora,
         CAST(SG_UF AS VARCHAR) AS sg_uf,
         CAST(CD_MUNICIPIO AS VARCHAR) AS cd_municipio,
         trim(NM_MUNICIPIO) AS nm_municipio,
         CAST(TP_SEXO AS VARCHAR) AS tp_sexo,
         trim(DE_FAIXA_ETARIA) AS de_faixa_etaria,
         trim(DE_SEGMENTACAO_PLANO) AS de_segmentacao_plano,
         trim(DE_ABRG_GEOGRAFICA_PLANO) AS de_abrg_geografica_plano,
         trim(DE_CONTRATACAO_PLANO) AS de_contratacao_plano,
         trim(COBERTURA_ASSIST_PLAN) AS cobertura_assist_plan,
         trim(TIPO_VINCULO) AS tipo_vinculo,
         CASE WHEN regexp_matches(QT_BENEFICIARIO_ATIVO, '^\s*[+-]?[0-9]+\s*$')
              THEN try_cast(QT_BENEFICIARIO_ATIVO AS INTEGER) END AS qt_beneficiario_ativo,
         CASE WHEN regexp_matches(QT_BENEFICIARIO_ADERIDO, '^\s*[+-]?[0-9]+\s*$')
              THEN try_cast(QT_BENEFICIARIO_ADERIDO AS INTEGER) END AS qt_beneficiario_aderido,
         CASE WHEN regexp_matches(QT_BENEFICIARIO_CANCELADO, '^\s*[+-]?[0-9]+\s*$')
              THEN try_cast(QT_BENEFICIARIO_CANCELADO AS INTEGER) END AS qt_beneficiario_cancelado,
         try_cast(DT_CARGA AS DATE) AS dt_carga,
         CAST(ID_CMPT_MOVEL AS VARCHAR) AS id_cmpt_movel
  FROM raw
)"""

_GOLDS = """
g_operadora AS (
  SELECT cd_operadora, nm_razao_social, CAST(SUM(qt_beneficiario_ativo) AS BIGINT) AS qt_beneficiarios_ativos
  FROM silver GROUP BY cd_operadora, nm_razao_social
),
g_faixa AS (
  SELECT de_faixa_etaria, CAST(SUM(qt_beneficiario_ativo) AS BIGINT) AS qt_beneficiarios_ativos
  FROM silver GROUP BY de_faixa_etaria
),
g_municipio AS (
  SELECT cd_municipio, nm_municipio, CAST(SUM(qt_beneficiario_ativo) AS BIGINT) AS qt_beneficiarios_ativos
  FROM silver GROUP BY cd_municipio, nm_municipio
)"""

QT = "qt_beneficiarios_ativos"
OP_ORDER = f"{QT} DESC NULLS LAST, cd_operadora ASC NULLS LAST, nm_razao_social ASC NULLS LAST"
FX_ORDER = f"{QT} DESC NULLS LAST, de_faixa_etaria ASC NULLS LAST"
MU_ORDER = f"{QT} DESC NULLS LAST, cd_municipio ASC NULLS LAST, nm_municipio ASC NULLS LAST"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join([_RAW, _SILVER, _GOLDS, *ctes])


def _with_dirty(*ctes: str) -> str:
    """As :func:`_with`, over the raw rows spoiled by a rule on order and line number."""
    clean = _RAW.replace("raw AS (", "clean AS (").replace("  SELECT lpad", "  SELECT (l_orderkey + l_linenumber) % 23 AS m, lpad", 1)
    return "WITH " + ",".join([clean, _DIRTY, _SILVER, _GOLDS, *ctes])


_DIRTY = """
raw AS (
  SELECT * EXCLUDE (m) REPLACE (
    CASE m WHEN 0 THEN 'abc' WHEN 1 THEN '99999999999' WHEN 2 THEN NULL WHEN 3 THEN '  ' WHEN 4 THEN '-5'
           ELSE QT_BENEFICIARIO_ATIVO END AS QT_BENEFICIARIO_ATIVO,
    CASE m WHEN 5 THEN '31/12/2024' WHEN 6 THEN NULL ELSE DT_CARGA END AS DT_CARGA,
    CASE m WHEN 7 THEN NULL ELSE NR_CNPJ END AS NR_CNPJ,
    CASE m WHEN 8 THEN 'São ' || NM_MUNICIPIO ELSE NM_MUNICIPIO END AS NM_MUNICIPIO,
    CASE m WHEN 9 THEN 'Ignorado' WHEN 10 THEN NULL ELSE DE_FAIXA_ETARIA END AS DE_FAIXA_ETARIA,
    CASE m WHEN 11 THEN '12.7' ELSE QT_BENEFICIARIO_ADERIDO END AS QT_BENEFICIARIO_ADERIDO)
  FROM clean
)"""


def _pct(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} IS NULL OR {whole} = 0 THEN CAST(0 AS DOUBLE) "
        f"ELSE CAST({part} AS DOUBLE) * CAST(100 AS DOUBLE) / CAST({whole} AS DOUBLE) END"
    )


def _ranked(gold: str, order: str, keys: str) -> str:
    return f"""
SELECT CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS posicao, {keys}, {QT},
       {_pct(QT, 't.total')} AS participacao,
       {_pct(QT, 't.mx')} AS proporcao_lider
FROM {gold}, (SELECT SUM({QT}) AS total, MAX({QT}) AS mx FROM {gold}) t"""


def _concentration_ctes(gold: str, order: str, name: str) -> tuple[str, str]:
    """CTEs ``r`` (rows with positions) and ``c`` (the concentration row)."""
    r = f"r AS (SELECT *, row_number() OVER (ORDER BY {order}) AS pos FROM {gold})"
    c = f"""c AS (
SELECT CAST(COUNT(*) AS BIGINT) AS n_itens, CAST(SUM({QT}) AS BIGINT) AS total,
       arg_min({name}, pos) AS lider,
       CAST(SUM(CASE WHEN pos <= 1 THEN {QT} END) AS BIGINT) AS qt_lider,
       {_pct(f"SUM(CASE WHEN pos <= 1 THEN {QT} END)", f"SUM({QT})")} AS share_top1,
       {_pct(f"SUM(CASE WHEN pos <= 5 THEN {QT} END)", f"SUM({QT})")} AS share_top5,
       {_pct(f"SUM(CASE WHEN pos <= 10 THEN {QT} END)", f"SUM({QT})")} AS share_top10
FROM r)"""
    return r, c


def _concentration(gold: str, order: str, name: str) -> str:
    return _with(*_concentration_ctes(gold, order, name)) + "\nSELECT * FROM c"


def _fmt_int(x: str) -> str:
    return f"replace(format('{{:,}}', {x}), ',', '.')"


def _fmt_pct(x: str, places: int) -> str:
    return f"replace(format('{{:.{places}f}}%', {x}), '.', ',')"


def _domain_cte() -> str:
    """The known bands, in the order of their first age."""
    return """dom AS (
  SELECT band AS de_faixa_etaria, row_number() OVER (ORDER BY CAST(regexp_extract(band, '^[0-9]+') AS INTEGER)) AS ordem
  FROM (SELECT concat(CAST(i AS VARCHAR), ' a ', CAST(i + 4 AS VARCHAR), ' anos') AS band FROM range(0, 80, 5) t(i)
        UNION ALL SELECT '80 anos ou mais'))"""


def _check(name: str, passed: str, detail: str) -> str:
    return f"SELECT '{name}' AS \"check\", coalesce({passed}, false) AS passed, {detail} AS detail"


def _s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


# Check-row SELECTs; each expects the metric CTEs of _CHECK_CTES.
_CHECK_CTES = [
    "sm AS (SELECT COUNT(*) AS n_silver, "
    + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_{c}" for c, _ in QUANTITY_PAIRS)
    + ", CAST(count_if(dt_carga IS NOT NULL) AS BIGINT) AS nonnull_dt_carga"
    + r", CAST(count_if(regexp_matches(nr_cnpj_masc, '\*{6}$')) AS BIGINT) AS masked"
    + ", CAST(MAX(length(regexp_replace(nr_cnpj_masc, '[^0-9]', '', 'g'))) AS INTEGER) AS max_visible_digits"
    + ", CAST(count_if(qt_beneficiario_ativo < 0) AS BIGINT) AS negative_active"
    + ", CAST(SUM(qt_beneficiario_ativo) AS BIGINT) AS total_active FROM silver)",
    "bm AS (SELECT COUNT(*) AS n_bronze, "
    + ", ".join(f"count_if({r} IS NULL OR trim({r}) = '') AS blank_{r}" for _, r in QUANTITY_PAIRS)
    + " FROM raw)",
    f"gt AS (SELECT (SELECT SUM({QT}) FROM g_operadora) AS t_o, (SELECT SUM({QT}) FROM g_faixa) AS t_f, "
    f"(SELECT SUM({QT}) FROM g_municipio) AS t_m)",
    # reference values straight from the test tables (independent path)
    f"""lq AS (SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER) AS q FROM lineitem),
ref_op AS (SELECT trim(s_name) AS name, CAST(SUM(q) AS BIGINT) AS qt FROM lq JOIN supplier ON l_suppkey = s_suppkey
           GROUP BY l_suppkey, s_name ORDER BY qt DESC, l_suppkey LIMIT 1),
ref_fx AS (SELECT band AS name, CAST(SUM(q) AS BIGINT) AS qt FROM (
             SELECT q, CASE WHEN p_size*2-2 >= 80 THEN '80 anos ou mais'
                       ELSE concat(CAST(p_size*2-2-(p_size*2-2)%5 AS VARCHAR), ' a ',
                                   CAST(p_size*2-2-(p_size*2-2)%5+4 AS VARCHAR), ' anos') END AS band
             FROM lq JOIN part ON l_partkey = p_partkey) GROUP BY band ORDER BY qt DESC, band LIMIT 1),
ref_nat_all AS (SELECT c_nationkey, n_name, CAST(SUM(q) AS BIGINT) AS qt FROM lq
             JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey GROUP BY c_nationkey, n_name),
ref_mu AS (SELECT n_name AS name, qt FROM ref_nat_all ORDER BY qt DESC, CAST(c_nationkey AS VARCHAR) LIMIT 1),
lead_op AS (SELECT nm_razao_social AS name, {QT} AS qt FROM g_operadora ORDER BY {OP_ORDER} LIMIT 1),
lead_fx AS (SELECT de_faixa_etaria AS name, {QT} AS qt FROM g_faixa ORDER BY {FX_ORDER} LIMIT 1),
lead_mu AS (SELECT nm_municipio AS name, {QT} AS qt FROM g_municipio ORDER BY {MU_ORDER} LIMIT 1)""",
]


def _div_count(gold: str, key: str) -> str:
    return f"""(SELECT COUNT(*) FROM (SELECT {key}, SUM(qt_beneficiario_ativo) AS qt FROM silver GROUP BY {key}) r
  FULL OUTER JOIN (SELECT {key}, {QT} AS qg FROM {gold}) g USING ({key})
  WHERE r.qt <> g.qg OR r.qt IS NULL OR g.qg IS NULL)"""


_GOLD_CTE = {
    "beneficiarios_por_operadora": "g_operadora",
    "beneficiarios_por_faixa_etaria": "g_faixa",
    "beneficiarios_por_municipio": "g_municipio",
}


def _checks_volume() -> list[str]:
    return [
        _check("V1a bronze rows = raw rows", "(SELECT COUNT(*) FROM lineitem) = bm.n_bronze",
               "'raw=' || " + _s("(SELECT COUNT(*) FROM lineitem)") + " || ' bronze=' || " + _s("bm.n_bronze")) + " FROM bm",
        _check("V1b silver rows = bronze rows", "sm.n_silver = bm.n_bronze",
               "'bronze=' || " + _s("bm.n_bronze") + " || ' silver=' || " + _s("sm.n_silver")) + " FROM sm, bm",
    ]


def _checks_typing() -> list[str]:
    out = [
        _check(f"V2 no extra NULL in {c}", f"sm.null_{c} <= bm.blank_{r}",
               f"'silver_nulls=' || {_s(f'sm.null_{c}')} || ' source_blanks=' || {_s(f'bm.blank_{r}')}")
        + " FROM sm, bm"
        for c, r in QUANTITY_PAIRS
    ]
    out.append(_check("V2d dt_carga has values", "sm.nonnull_dt_carga > 0",
                      "'non_null=' || " + _s("sm.nonnull_dt_carga")) + " FROM sm")
    return out


def _checks_masking() -> list[str]:
    d = "coalesce(sm.max_visible_digits, 0)"
    return [
        _check("V3a every id ends in the mask", "sm.masked = sm.n_silver",
               "'masked=' || " + _s("sm.masked") + " || '/' || " + _s("sm.n_silver")) + " FROM sm",
        _check("V3b at most 8 visible digits", f"{d} <= 8", "'max_visible_digits=' || " + _s(d)) + " FROM sm",
    ]


def _checks_sanity() -> list[str]:
    return [_check("V4 no negative active quantity", "sm.negative_active = 0",
                   "'negative=' || " + _s("sm.negative_active")) + " FROM sm"]


def _checks_reconcile() -> list[str]:
    out = []
    for table, (label, key) in RECONCILE.items():
        n = _div_count(_GOLD_CTE[table], key)
        out.append(_check(f"V5 gold {label} = recompute", f"{n} = 0", f"'divergences=' || {_s(n)}"))
    return out


# What the result files should hold (``f_*``, recomputed from silver) and gold by position (``p_*``).
_OUTPUT_CTES = [
    f"""f_a AS (SELECT cd_operadora, SUM(qt_beneficiario_ativo) AS q, row_number() OVER (
       ORDER BY SUM(qt_beneficiario_ativo) DESC NULLS LAST, cd_operadora NULLS LAST, nm_razao_social NULLS LAST) AS pos
       FROM silver GROUP BY cd_operadora, nm_razao_social)""",
    """f_b AS (SELECT de_faixa_etaria, SUM(qt_beneficiario_ativo) AS q, row_number() OVER (
       ORDER BY SUM(qt_beneficiario_ativo) DESC NULLS LAST, de_faixa_etaria NULLS LAST) AS pos
       FROM silver GROUP BY de_faixa_etaria)""",
    """f_c AS (SELECT cd_municipio, SUM(qt_beneficiario_ativo) AS q, row_number() OVER (
       ORDER BY SUM(qt_beneficiario_ativo) DESC NULLS LAST, cd_municipio NULLS LAST, nm_municipio NULLS LAST) AS pos
       FROM silver GROUP BY cd_municipio, nm_municipio)""",
    f"p_a AS (SELECT *, row_number() OVER (ORDER BY {OP_ORDER}) AS pos FROM g_operadora)",
    f"p_b AS (SELECT *, row_number() OVER (ORDER BY {FX_ORDER}) AS pos FROM g_faixa)",
    f"p_c AS (SELECT *, row_number() OVER (ORDER BY {MU_ORDER}) AS pos FROM g_municipio)",
]


def _mismatches(file: str, gold: str, most: str, more: str = "") -> str:
    return (f"(SELECT COUNT(*) FROM (SELECT * FROM {file} WHERE {most}) f FULL JOIN (SELECT * FROM {gold} WHERE {most}) p "
            f"ON f.pos = p.pos WHERE f.q IS DISTINCT FROM p.{QT}{more})")


def _checks_outputs(c_file: str = "f_c") -> list[str]:
    a, c = _mismatches("f_a", "p_a", "pos <= 5"), _mismatches(c_file, "p_c", "TRUE")
    b = _mismatches("f_b", "p_b", "pos <= 1", " OR f.de_faixa_etaria IS DISTINCT FROM p.de_faixa_etaria")
    n_file, n_gold = f"(SELECT COUNT(*) FROM {c_file})", "(SELECT COUNT(*) FROM g_municipio)"
    return [
        _check("V6a top-5 operators file = gold", f"{a} = 0", f"'mismatches=' || {_s(a)}"),
        _check("V6b leading age band file = gold", f"{b} = 0", f"'mismatches=' || {_s(b)}"),
        _check("V6c municipality file row count = gold", f"{n_file} = {n_gold}",
               f"'file=' || {_s(n_file)} || ' gold=' || {_s(n_gold)}"),
        _check("V6d municipality file = gold in order", f"{c} = 0", f"'mismatches=' || {_s(c)}"),
    ]


def _checks_totals() -> list[str]:
    p = "sm.total_active = gt.t_o AND gt.t_o = gt.t_f AND gt.t_f = gt.t_m"
    d = ("'silver=' || " + _s("sm.total_active") + " || ' operadora=' || " + _s("gt.t_o")
         + " || ' faixa=' || " + _s("gt.t_f") + " || ' municipio=' || " + _s("gt.t_m"))
    return [_check("V7 totals equal in silver and golds", p, d) + " FROM sm, gt"]


def _checks_reference() -> list[str]:
    def shown(t: str) -> str:
        return f"{t}.name || ' = ' || {_s(f'{t}.qt')}"

    return [
        _check("V8a top operator = reference",
               "strip_accents(lead_op.name) = strip_accents(ref_op.name) AND lead_op.qt = ref_op.qt",
               shown("lead_op")) + " FROM lead_op, ref_op",
        _check("V8b leading age band = reference", "lead_fx.name = ref_fx.name AND lead_fx.qt = ref_fx.qt",
               shown("lead_fx")) + " FROM lead_fx, ref_fx",
        _check("V8c top municipality = reference",
               "strip_accents(lead_mu.name) = strip_accents(ref_mu.name) AND lead_mu.qt = ref_mu.qt",
               shown("lead_mu")) + " FROM lead_mu, ref_mu",
        _check("V8d municipality count = reference", "n = (SELECT COUNT(*) FROM ref_nat_all)",
               "'municipios=' || " + _s("n")) + " FROM (SELECT COUNT(*) AS n FROM g_municipio)",
    ]


def _checks(*groups: list[str]) -> str:
    body = "\nUNION ALL\n".join(s for g in groups for s in g)
    return _with(*_CHECK_CTES, *_OUTPUT_CTES) + "\n" + body


_ACCEPTED = " AND ".join(
    [f"({c} IS NULL OR try_cast(CASE WHEN regexp_matches({c}, '^[0-9+-]+$') THEN {c} END AS INTEGER) IS NOT NULL)" for _, c in QUANTITY_PAIRS]
    + ["(DT_CARGA IS NULL OR try_cast(DT_CARGA AS DATE) IS NOT NULL)"])


def _gold_rows_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS tabela, {k} AS chave, {QT} AS quantidade FROM {g}"
        for t, g, k in (("beneficiarios_por_operadora", "g_operadora", "cd_operadora"),
                        ("beneficiarios_por_faixa_etaria", "g_faixa", "de_faixa_etaria"),
                        ("beneficiarios_por_municipio", "g_municipio", "cd_municipio")))


def _checks_dirty(*groups: list[str]) -> str:
    body = "\nUNION ALL\n".join(s for g in groups for s in g)
    return _with_dirty(*_CHECK_CTES) + "\n" + body


def _everything() -> str:
    return _checks(
        _checks_volume(), _checks_typing(), _checks_masking(), _checks_sanity(),
        _checks_reconcile(), _checks_outputs(), _checks_totals(), _checks_reference(),
    )


def _suite_dirty() -> str:
    return _checks_dirty(_checks_volume(), _checks_typing(), _checks_masking(), _checks_sanity(),
                         _checks_reconcile(), _checks_totals())


def _summary(checks: str) -> str:
    return ("SELECT CAST(count_if(passed) AS BIGINT) AS n_passed, COUNT(*) AS n_checks, COUNT(*) > 0 AND count_if(NOT passed) = 0 AS all_passed "
            f"FROM ({checks})")


def _by_month(src: str) -> str:
    return (f"SELECT id_cmpt_movel, COUNT(*) AS n_linhas, CAST(SUM(qt_beneficiario_ativo) AS BIGINT) AS {QT} "
            f"FROM {src} GROUP BY id_cmpt_movel")


_LATEST = "latest AS (SELECT * FROM silver WHERE id_cmpt_movel = (SELECT MAX(id_cmpt_movel) FROM silver))"
_BATCH = "batch AS (SELECT * FROM latest WHERE tp_sexo = 'R')"


def _reconcile_sql(table: str) -> str:
    label, key = RECONCILE[table]
    gold = _GOLD_CTE[table]
    return _with() + f"""
SELECT '{table}' AS tabela, {_div_count(gold, key)} AS divergencias,
       (SELECT COUNT(DISTINCT {key}) + MAX(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END) FROM silver) AS n_recalculo,
       (SELECT COUNT(*) FROM {gold}) AS n_gold"""


ORACLE_SQL: dict[str, str] = {
    "bronze_ingest": _with() + "\nSELECT * FROM raw",
    "silver_refine": _with() + "\nSELECT * FROM silver",
    "silver_by_month": _with() + "\n" + _by_month("silver"),
    "gold_operadora": _with() + "\nSELECT * FROM g_operadora",
    "gold_faixa_etaria": _with() + "\nSELECT * FROM g_faixa",
    "gold_municipio": _with() + "\nSELECT * FROM g_municipio",
    "a_top5_operadoras": _with() + f"\nSELECT * FROM g_operadora ORDER BY {OP_ORDER} LIMIT 5",
    "b_faixa_etaria_top": _with() + f"\nSELECT * FROM g_faixa ORDER BY {FX_ORDER} LIMIT 1",
    "c_beneficiarios_por_municipio": _with() + f"""
SELECT *, CAST(row_number() OVER (ORDER BY {MU_ORDER}) AS BIGINT) AS posicao FROM g_municipio""",
    "results_content": _with(*_OUTPUT_CTES) + """
SELECT 'a_top5_operadoras' AS resultado, CAST(pos AS BIGINT) AS posicao, cd_operadora AS chave, CAST(q AS BIGINT) AS quantidade
FROM f_a WHERE pos <= 5
UNION ALL SELECT 'b_faixa_etaria_top', pos, de_faixa_etaria, CAST(q AS BIGINT) FROM f_b WHERE pos <= 1
UNION ALL SELECT 'c_beneficiarios_por_municipio', pos, cd_municipio, CAST(q AS BIGINT) FROM f_c""",
    "dq_outputs_damaged": _with(*_OUTPUT_CTES, """d_c AS (
  SELECT pos, q + CASE WHEN pos = 2 THEN 1 ELSE 0 END AS q FROM f_c WHERE pos < (SELECT MAX(pos) FROM f_c))""")
    + "\n" + "\nUNION ALL\n".join(_checks_outputs("d_c")),
    "export_round_trip": """
SELECT CAST(s_suppkey AS BIGINT) AS n,
       CASE s_suppkey % 7 WHEN 0 THEN concat(' ', s_name, ' ') WHEN 1 THEN concat(chr(9), s_name) WHEN 2 THEN ''
            WHEN 3 THEN NULL WHEN 4 THEN concat('"', s_name, '" said') WHEN 5 THEN concat('00', CAST(s_suppkey AS VARCHAR))
            ELSE concat(s_name, ', ', chr(92), 'x') END AS t
FROM supplier""",
    "insight_operadoras": _with() + f"\nSELECT * FROM g_operadora ORDER BY {OP_ORDER}",
    "insight_faixa_etaria": _with() + f"\nSELECT * FROM g_faixa ORDER BY {FX_ORDER}",
    "top_n_operadoras": _with() + f"\nSELECT * FROM g_operadora ORDER BY {OP_ORDER} LIMIT 10",
    "top_n_municipios": _with() + f"\nSELECT * FROM g_municipio ORDER BY {MU_ORDER} LIMIT 15",
    "faixa_por_idade": _with(_domain_cte()) + f"""
SELECT g.de_faixa_etaria, g.{QT},
       coalesce(g.de_faixa_etaria = (SELECT de_faixa_etaria FROM g_faixa ORDER BY {FX_ORDER} LIMIT 1), false) AS lider,
       CAST(d.ordem AS INTEGER) AS ordem
FROM g_faixa g JOIN dom d ON g.de_faixa_etaria = d.de_faixa_etaria""",
    "ranking_operadoras": _with() + _ranked("g_operadora", OP_ORDER, "cd_operadora, nm_razao_social"),
    "ranking_municipios": _with() + _ranked("g_municipio", MU_ORDER, "cd_municipio, nm_municipio"),
    "concentracao_municipios": _concentration("g_municipio", MU_ORDER, "nm_municipio"),
    "concentracao_operadoras": _concentration("g_operadora", OP_ORDER, "nm_razao_social"),
    "lider_faixa": _with() + f"""
SELECT de_faixa_etaria, {QT}, {_pct(QT, f'(SELECT SUM({QT}) FROM g_faixa)')} AS participacao
FROM g_faixa ORDER BY {FX_ORDER} LIMIT 1""",
    "kpis": _with() + f"""
SELECT CAST((SELECT SUM({QT}) FROM g_municipio) AS BIGINT) AS total_beneficiarios,
       (SELECT COUNT(DISTINCT cd_operadora) FROM g_operadora) AS n_operadoras,
       (SELECT COUNT(DISTINCT cd_municipio) FROM g_municipio) AS n_municipios,
       de_faixa_etaria AS faixa_lider, {QT} AS qt_faixa_lider
FROM g_faixa ORDER BY {FX_ORDER} LIMIT 1""",
    "municipios_pagina": _with(
        "r AS (" + _ranked("g_municipio", MU_ORDER, "cd_municipio, nm_municipio") + ")",
        "p AS (SELECT CAST(greatest(1, ceil((SELECT COUNT(*) FROM g_municipio) / 10.0)) AS BIGINT) AS n_paginas)",
        "c AS (SELECT CAST(least(greatest(2, 1), n_paginas) AS BIGINT) AS pagina, n_paginas FROM p)",
    ) + """
SELECT r.*, c.pagina, c.n_paginas FROM r, c
WHERE r.posicao BETWEEN (c.pagina - 1) * 10 + 1 AND c.pagina * 10""",
    "municipios_busca": _with() + "\nSELECT * FROM g_municipio WHERE strpos(lower(nm_municipio), 'nation_1') > 0",
    "municipios_formatado": _with(
        "r AS (" + _ranked("g_municipio", MU_ORDER, "cd_municipio, nm_municipio") + ")",
    ) + f"""
SELECT posicao AS "Posição", cd_municipio AS "Cód. IBGE", nm_municipio AS "Município",
       replace(format('{{:,}}', {QT}), ',', '.') AS "Beneficiários ativos",
       {_fmt_pct('participacao', 2)} AS "Participação"
FROM r""",
    "operadoras_cards": _with(
        "r AS (" + _ranked("g_operadora", OP_ORDER, "cd_operadora, nm_razao_social") + ")"
    ) + f"""
SELECT posicao, nm_razao_social AS rotulo, {_fmt_int(QT)} AS quantidade,
       {_fmt_pct('participacao', 1)} AS participacao, proporcao_lider AS preenchimento
FROM r WHERE posicao <= 5""",
    "municipios_destaques": _with(*_concentration_ctes("g_municipio", MU_ORDER, "nm_municipio")) + f"""
SELECT lider, {_fmt_int('qt_lider')} AS quantidade_lider, {_fmt_pct('share_top1', 1)} AS participacao_lider,
       {_fmt_int('n_itens')} AS n_itens, {_fmt_pct('share_top5', 1)} AS concentracao_top5,
       {_fmt_pct('share_top10', 1)} AS concentracao_top10
FROM c""",
    "dq_volume": _checks(_checks_volume()),
    "dq_typing": _checks(_checks_typing()),
    "dq_masking": _checks(_checks_masking()),
    "dq_sanity": _checks(_checks_sanity()),
    "dq_totals": _checks(_checks_totals()),
    "dq_single_pass": _with(*_CHECK_CTES) + "\nSELECT * FROM sm",
    "dq_reconcile_operadora": _reconcile_sql("beneficiarios_por_operadora"),
    "dq_reconcile_faixa": _reconcile_sql("beneficiarios_por_faixa_etaria"),
    "dq_reconcile_municipio": _reconcile_sql("beneficiarios_por_municipio"),
    "dq_divergent_rows": _with(
        f"""dmg AS (SELECT CASE WHEN cd_operadora = (SELECT MIN(cd_operadora) FROM g_operadora)
                        THEN cd_operadora || 'X' ELSE cd_operadora END AS cd_operadora,
                   CASE WHEN cd_operadora = (SELECT MAX(cd_operadora) FROM g_operadora)
                        THEN {QT} + 1 ELSE {QT} END AS qg
            FROM g_operadora)""",
        "rc AS (SELECT cd_operadora, CAST(SUM(qt_beneficiario_ativo) AS BIGINT) AS qt FROM silver GROUP BY cd_operadora)",
    ) + """
SELECT cd_operadora, rc.qt, dmg.qg FROM rc FULL OUTER JOIN dmg USING (cd_operadora)
WHERE rc.qt <> dmg.qg OR rc.qt IS NULL OR dmg.qg IS NULL""",
    "dq_outputs": _checks(_checks_outputs()),
    "dq_reference": _checks(_checks_reference()),
    "dq_report": _everything(),
    "dq_summary": _summary(_everything()),
    "silver_refine_dirty": _with_dirty() + "\nSELECT * FROM silver",
    "dq_report_dirty": _suite_dirty(),
    "dq_summary_dirty": _summary(_suite_dirty()),
    "faixa_por_idade_dirty": _with_dirty(_domain_cte()) + f"""
SELECT g.de_faixa_etaria, g.{QT},
       coalesce(g.de_faixa_etaria = (SELECT de_faixa_etaria FROM g_faixa ORDER BY {FX_ORDER} LIMIT 1), false) AS lider,
       CAST(d.ordem AS INTEGER) AS ordem
FROM g_faixa g JOIN dom d ON g.de_faixa_etaria = d.de_faixa_etaria""",
    "gate_layers": "\nUNION ALL\n".join(
        f"SELECT '{load}' AS entrega, '{gate}' AS portao, all_passed AS promovido FROM ({_summary(sql)})"
        for load, gate, sql in (
            ("clean", "ingest", _checks(_checks_volume()[:1])),
            ("clean", "silver", _checks(_checks_typing(), _checks_masking(), _checks_sanity())),
            ("dirty", "ingest", _checks_dirty(_checks_volume()[:1])),
            ("dirty", "silver", _checks_dirty(_checks_typing(), _checks_masking(), _checks_sanity())),
        )
    ),
    "audit_keeps_old": _with() + """
SELECT 'silver' AS tabela, CAST(NULL AS VARCHAR) AS chave, CAST(SUM(qt_beneficiario_ativo) AS BIGINT) AS quantidade FROM silver
UNION ALL
""" + _gold_rows_sql(),
    "rejected_rows": _with_dirty() + "\n" + "\nUNION ALL\n".join(
        f"SELECT CD_OPERADORA, CD_MUNICIPIO, ID_CMPT_MOVEL, '{c}' AS coluna, "
        f"CASE WHEN trim({c}) = '' THEN 'em branco' ELSE '{why}' END AS motivo, {c} AS valor FROM raw WHERE {c} IS NOT NULL AND {bad}"
        for c, why, bad in [(c, "nao inteiro", f"try_cast(CASE WHEN regexp_matches({c}, '^[0-9+-]+$') THEN {c} END AS INTEGER) IS NULL")
                            for _, c in QUANTITY_PAIRS] + [("DT_CARGA", "nao e data", "try_cast(DT_CARGA AS DATE) IS NULL")]
    ),
    "accepted_rows": _with_dirty().replace("FROM raw\n)", "FROM raw\n  WHERE " + _ACCEPTED + "\n)", 1) + "\nSELECT * FROM silver",
    "busca_sem_acento": _with_dirty() + "\nSELECT * FROM g_municipio WHERE strpos(strip_accents(lower(nm_municipio)), 'sao nation_1') > 0",
    "deliveries_once": _with() + "\nSELECT * FROM raw",
    "stream_months_replaced": _with(
        _LATEST, "changed AS (SELECT * FROM silver WHERE id_cmpt_movel <> (SELECT MAX(id_cmpt_movel) FROM silver) "
        "UNION ALL SELECT * REPLACE (qt_beneficiario_ativo + 1 AS qt_beneficiario_ativo) FROM latest)"
    ) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS tabela, {k[0]} AS chave, CAST(SUM(qt_beneficiario_ativo) AS BIGINT) AS quantidade FROM changed GROUP BY {', '.join(k)}"
        for t, k in (("beneficiarios_por_operadora", ("cd_operadora", "nm_razao_social")), ("beneficiarios_por_faixa_etaria", ("de_faixa_etaria",)),
                     ("beneficiarios_por_municipio", ("cd_municipio", "nm_municipio")))
    ),
    "idempotent_refresh": _with() + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS tabela, COUNT(*) AS n_linhas, CAST(SUM({QT}) AS BIGINT) AS total FROM {g}"
        for t, g in _GOLD_CTE.items()
    ),
    "incremental_month": _with(_LATEST) + "\n" + _by_month(
        "(SELECT * FROM silver WHERE id_cmpt_movel <> (SELECT MAX(id_cmpt_movel) FROM silver) "
        "UNION ALL SELECT * REPLACE (qt_beneficiario_ativo + 1 AS qt_beneficiario_ativo) FROM latest)"
    ),
    "monthly_loads": _with() + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS tabela, {k} AS chave, {QT} AS quantidade FROM {g}"
        for t, g, k in (("beneficiarios_por_operadora", "g_operadora", "cd_operadora"),
                        ("beneficiarios_por_faixa_etaria", "g_faixa", "de_faixa_etaria"),
                        ("beneficiarios_por_municipio", "g_municipio", "cd_municipio"))
    ),
    "upsert_null_partition": _with(
        "old AS (SELECT * REPLACE (CASE WHEN tp_sexo = 'N' THEN NULL ELSE id_cmpt_movel END AS id_cmpt_movel) FROM silver)",
        "nb AS (SELECT * REPLACE (qt_beneficiario_ativo * 2 AS qt_beneficiario_ativo) FROM old "
        "WHERE id_cmpt_movel IS NULL AND cd_municipio = '1')",
        """kept AS (SELECT * FROM old s WHERE NOT EXISTS (
             SELECT 1 FROM nb WHERE nb.id_cmpt_movel IS NOT DISTINCT FROM s.id_cmpt_movel
               AND nb.cd_operadora IS NOT DISTINCT FROM s.cd_operadora
               AND nb.cd_municipio IS NOT DISTINCT FROM s.cd_municipio
               AND nb.de_faixa_etaria IS NOT DISTINCT FROM s.de_faixa_etaria))""",
    ) + "\n" + _by_month("(SELECT * FROM kept UNION ALL SELECT * FROM nb)"),
    "upsert_month": _with(
        _LATEST,
        _BATCH,
        "nb AS (SELECT * REPLACE (qt_beneficiario_ativo * 2 AS qt_beneficiario_ativo) FROM batch)",
        """kept AS (SELECT * FROM silver s WHERE NOT EXISTS (
             SELECT 1 FROM nb WHERE nb.id_cmpt_movel IS NOT DISTINCT FROM s.id_cmpt_movel
               AND nb.cd_operadora IS NOT DISTINCT FROM s.cd_operadora
               AND nb.cd_municipio IS NOT DISTINCT FROM s.cd_municipio
               AND nb.de_faixa_etaria IS NOT DISTINCT FROM s.de_faixa_etaria))""",
    ) + "\n" + _by_month("(SELECT * FROM kept UNION ALL SELECT * FROM nb)"),
    "stream_ingest": _with() + "\nSELECT * FROM raw",
    "stream_after_batch": _with() + "\nSELECT * FROM raw",
    "catalog_tables": _with() + """
SELECT * FROM (VALUES ('bronze', 'beneficiarios', (SELECT COUNT(*) FROM raw)),
                      ('silver', 'beneficiarios', (SELECT COUNT(*) FROM silver)),
                      ('gold', 'beneficiarios_por_operadora', (SELECT COUNT(*) FROM g_operadora)),
                      ('gold', 'beneficiarios_por_faixa_etaria', (SELECT COUNT(*) FROM g_faixa)),
                      ('gold', 'beneficiarios_por_municipio', (SELECT COUNT(*) FROM g_municipio))) t(camada, tabela, n_linhas)""",
    "bronze_audit": _with() + "\nSELECT COUNT(*) AS n_linhas, COUNT(*) AS com_carga, COUNT(*) AS com_arquivo FROM raw",
}
