"""Analytic views over gold: positions, shares, concentration, paging, display.

No operator here uses a window without a partition key over the data:
positions come from a global range sort plus per-partition offsets, and
totals / maxima enter as scalar subqueries (one partial aggregate each).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.functions.display import format_percent, format_thousands
from tiermill.schemas import GOLD_MEASURE
from tiermill.session import cut_lineage

POSITION = "posicao"
SHARE = "participacao"
OF_LEADER = "proporcao_lider"

_PART = "_tm_part"
_MID = "_tm_mid"
_OFF = "_tm_off"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def order_desc(qt: str, keys: list[str]) -> list[Column]:
    """Largest first; ties broken by the keys, NULLs last everywhere."""
    return [F.col(qt).desc_nulls_last()] + [F.col(k).asc_nulls_last() for k in keys]


def with_position(df: DataFrame, order: list[Column], name: str = POSITION) -> DataFrame:
    """Add a 1-based position following ``order`` (a total order), distributed.

    1. ``orderBy`` range-partitions and sorts (balanced by sampling).
    2. Each row records its partition and its row number inside it; the
       tagged frame is written to the shared scratch folder (a lineage cut),
       so both uses below read exactly the same rows and ids.
    3. Per-partition counts (one row per partition, bounded by the shuffle
       width, not by the data) are turned into starting offsets and
       broadcast back.
    """
    tagged = df.orderBy(*order).select(
        "*",
        F.spark_partition_id().alias(_PART),
        F.monotonically_increasing_id().alias(_MID),
    )
    tagged = cut_lineage(tagged)
    counts = tagged.groupBy(_PART).agg(F.count(F.lit(1)).alias("_tm_n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PART, F.coalesce(F.sum("_tm_n").over(before), F.lit(0)).alias(_OFF))
    local = F.col(_MID).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        tagged.join(F.broadcast(offsets), _PART)
        .withColumn(name, (F.col(_OFF) + local + F.lit(1)).cast("long"))
        .drop(_PART, _MID, _OFF)
    )


def _total(df: DataFrame, qt: str) -> Column:
    return df.agg(F.sum(qt)).scalar()


def _percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as DOUBLE; 0 when the whole is 0 or NULL."""
    pct = part.cast("double") * F.lit(100.0) / whole.cast("double")
    return F.when(whole.isNull() | (whole == 0), F.lit(0.0)).otherwise(pct)


def rank_with_share(df: DataFrame, qt: str, keys: list[str]) -> DataFrame:
    """Position (largest first), share of total and proportion of the leader."""
    ranked = with_position(df, order_desc(qt, keys))
    # Both figures come from one partial aggregate over the input itself.
    stats = df.agg(F.struct(F.sum(qt).alias("t"), F.max(qt).alias("m"))).scalar()
    with_stats = ranked.select("*", stats.alias("_tm_stats"))
    return with_stats.select(
        POSITION,
        *keys,
        qt,
        _percent(F.col(qt), F.col("_tm_stats.t")).alias(SHARE),
        _percent(F.col(qt), F.col("_tm_stats.m")).alias(OF_LEADER),
    )


def top_n(df: DataFrame, qt: str, keys: list[str], n: int) -> DataFrame:
    """The ``n`` largest rows (top-k; distributed partial top-k then merge)."""
    return df.orderBy(*order_desc(qt, keys)).limit(n)


def leader(df: DataFrame, qt: str, keys: list[str]) -> DataFrame:
    """The single largest row, ties broken by the keys."""
    return top_n(df, qt, keys, 1)


def flag_leader(df: DataFrame, qt: str, keys: list[str], name: str = "lider") -> DataFrame:
    """Mark the leader row with a boolean column (for emphasis)."""
    lead_key = leader(df, qt, keys).select(F.struct(*keys).alias("k")).scalar()
    return df.withColumn(name, F.struct(*keys).eqNullSafe(lead_key))


def leader_summary(df: DataFrame, qt: str, keys: list[str]) -> DataFrame:
    """Leader row with its quantity and its share of the total."""
    total = _total(df, qt)
    return leader(df, qt, keys).select(*keys, qt, _percent(F.col(qt), total).alias(SHARE))


def concentration(
    ranked: DataFrame, qt: str, name: str, ks: tuple[int, ...] = (1, 5, 10)
) -> DataFrame:
    """Leader and share of the total held by the top ``k`` rows (one row).

    ``ranked`` must carry ``posicao`` (from :func:`with_position`); the whole
    summary is one partial aggregate over it.
    """
    aggs = [
        F.count(F.lit(1)).alias("n_itens"),
        F.sum(qt).cast("long").alias("total"),
        F.min_by(F.col(name), F.col(POSITION)).alias("lider"),
    ]
    for k in ks:
        aggs.append(F.sum(F.when(F.col(POSITION) <= k, F.col(qt))).cast("long").alias(f"qt_top{k}"))
    summary = ranked.agg(*aggs)
    return summary.select(
        "n_itens",
        "total",
        "lider",
        F.col(f"qt_top{ks[0]}").alias("qt_lider") if ks[0] == 1 else F.lit(None).cast("long").alias("qt_lider"),
        *[_percent(F.col(f"qt_top{k}"), F.col("total")).alias(f"share_top{k}") for k in ks],
    )


def order_by_domain(
    df: DataFrame, col: str, domain: list[str], order_name: str = "ordem"
) -> DataFrame:
    """Keep values of a known domain and order them by the domain's order.

    Values outside the domain (and NULL) are dropped, as an inner join does.
    """
    entries = [F.struct(F.lit(v).alias(col), F.lit(i + 1).alias(order_name)) for i, v in enumerate(domain)]
    dom = df.sparkSession.range(1).select(F.inline(F.array(*entries)))
    return df.join(dom, col).orderBy(order_name)


def page(
    ranked: DataFrame, number: int, size: int, *, position: str = POSITION
) -> DataFrame:
    """One page of a positioned frame; the page number is clamped to the range.

    ``n_paginas = max(1, ceil(n / size))`` and the page shown is
    ``min(max(number, 1), n_paginas)``, both computed inside the plan.
    """
    if size <= 0:
        raise ValueError("page size must be positive")
    n = ranked.agg(F.count(F.lit(1))).scalar()
    n_pages = F.greatest(F.lit(1), F.ceil(n / F.lit(size))).cast("long")
    current = F.least(F.greatest(F.lit(number), F.lit(1)), n_pages).cast("long")
    lo = (current - 1) * size + 1
    hi = current * size
    return (
        ranked.filter(F.col(position).between(lo, hi))
        .withColumn("pagina", current)
        .withColumn("n_paginas", n_pages)
        .orderBy(position)
    )


def search(df: DataFrame, col: str, term: str, *, accents: bool = True) -> DataFrame:
    """Rows whose ``col`` contains ``term``, ignoring case (literal match).

    With ``accents=False`` accents do not count either, on both sides: ``sao``
    finds ``São`` (a case and accent insensitive collation of the column).
    """
    if accents:
        return df.filter(F.lower(F.col(col)).contains(term.lower()))
    return df.filter(F.contains(F.collate(F.col(col), "UNICODE_CI_AI"), F.collate(F.lit(term), "UNICODE_CI_AI")))


def page_stored(
    ranked: DataFrame, number: int, size: int, *, position: str = POSITION
) -> DataFrame:
    """One page of a stored ranking table, as :func:`page`, for tables written in order of position.

    The number of rows is read first (from the files' footers, one number to
    the driver), so the bounds are literals: the scan skips every file and row
    group outside the page.
    """
    if size <= 0:
        raise ValueError("page size must be positive")
    n_pages = max(1, -(-ranked.count() // size))
    current = min(max(number, 1), n_pages)
    rows = ranked.filter((F.col(position) > (current - 1) * size) & (F.col(position) <= current * size))
    return rows.withColumn("pagina", F.lit(current).cast("long")).withColumn("n_paginas", F.lit(n_pages).cast("long")).orderBy(position)


# --- fixed values: display headings of the municipality table ---
DISPLAY_HEADINGS = {
    POSITION: "Posição",
    "cd_municipio": "Cód. IBGE",
    "nm_municipio": "Município",
    GOLD_MEASURE: "Beneficiários ativos",
    SHARE: "Participação",
}


def display_municipios(ranked: DataFrame) -> DataFrame:
    """Formatted municipality table: position, code, name, count, share."""
    return ranked.select(
        F.col(POSITION).alias(DISPLAY_HEADINGS[POSITION]),
        F.col("cd_municipio").alias(DISPLAY_HEADINGS["cd_municipio"]),
        F.col("nm_municipio").alias(DISPLAY_HEADINGS["nm_municipio"]),
        format_thousands(GOLD_MEASURE).alias(DISPLAY_HEADINGS[GOLD_MEASURE]),
        format_percent(F.col(SHARE), 2).alias(DISPLAY_HEADINGS[SHARE]),
    ).orderBy(DISPLAY_HEADINGS[POSITION])


def kpis(operadora: DataFrame, faixa: DataFrame, municipio: DataFrame, qt: str = GOLD_MEASURE) -> DataFrame:
    """KPI row: total active, operators, municipalities, leading band.

    Always one row (an aggregate), with the other figures as scalar
    subqueries, so every figure is one partial aggregate and nothing is
    cross-joined. With no data the counts are 0 and the rest NULL.
    """
    n_ops = operadora.agg(F.count_distinct("cd_operadora")).scalar()
    n_mun = municipio.agg(F.count_distinct("cd_municipio")).scalar()
    lead = leader(faixa, qt, ["de_faixa_etaria"]).select(F.struct("de_faixa_etaria", qt).alias("s")).scalar()
    return municipio.agg(F.sum(qt).cast("long").alias("total_beneficiarios")).select(
        "total_beneficiarios",
        n_ops.cast("long").alias("n_operadoras"),
        n_mun.cast("long").alias("n_municipios"),
        lead.alias("_tm_lead"),
    ).select(
        "total_beneficiarios",
        "n_operadoras",
        "n_municipios",
        F.col("_tm_lead.de_faixa_etaria").alias("faixa_lider"),
        F.col(f"_tm_lead.{qt}").alias("qt_faixa_lider"),
    )


def display_cards(ranked: DataFrame, label: str, n: int = 5, places: int = 1) -> DataFrame:
    """Leaderboard cards: the first ``n`` positions with formatted figures.

    Position, label, count with ``.`` thousands, share of the total with a
    decimal comma (``places`` decimals) and the bar fill (percent of the
    leader). ``ranked`` is a ranking table (see :func:`rank_with_share`).
    """
    return ranked.filter(F.col(POSITION) <= n).orderBy(POSITION).select(
        POSITION,
        F.col(label).alias("rotulo"),
        format_thousands(GOLD_MEASURE).alias("quantidade"),
        format_percent(F.col(SHARE), places).alias("participacao"),
        F.col(OF_LEADER).alias("preenchimento"),
    )


def display_highlights(summary: DataFrame, places: int = 1) -> DataFrame:
    """Formatted highlights from :func:`concentration`'s row: the leader, its
    count and share, the number of items, and the top-5 / top-10 shares."""
    return summary.select(
        F.col("lider"),
        format_thousands("qt_lider").alias("quantidade_lider"),
        format_percent(F.col("share_top1"), places).alias("participacao_lider"),
        format_thousands("n_itens").alias("n_itens"),
        format_percent(F.col("share_top5"), places).alias("concentracao_top5"),
        format_percent(F.col("share_top10"), places).alias("concentracao_top10"),
    )
