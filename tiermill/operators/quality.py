"""Reconciliation and data-quality checks, as DataFrames of check rows.

Every check group returns ``DataFrame[check STRING, passed BOOLEAN,
detail STRING]``. The numbers behind the checks are one-row aggregates
(partial aggregation, no driver round trip). A group declares the scalars
it needs; they are attached once as columns of one base row (silver's
metrics row when silver figures are used) and the row is spread into check
rows with ``inline``. :func:`checks` builds the whole suite on a single base
row: silver is read by one metrics aggregate and one grouping-sets
recompute (shared by the three reconciliations), bronze by one aggregate,
the raw file by one count. Only :func:`assert_all` brings anything to the driver: the failed
check rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.functions.text import MASK_KEEP, MASK_PATTERN, accent_insensitive_equal, blank, visible_digits
from tiermill.operators.layers import Golds, grouping_id_of
from tiermill.operators.ranking import POSITION, leader, order_desc, with_position
from tiermill.schemas import ACTIVE, GOLD_KEYS, GOLD_MEASURE, QUANTITY_PAIRS, gold_schema
from tiermill.sources.results import read_result_positions


class ChecksFailed(AssertionError):
    """Raised by :func:`assert_all` when any check row did not pass."""


Spec = tuple[str, Column, Column]


@dataclass
class _Group:
    """Check rows of one group and the scalars their expressions read."""

    specs: list[Spec]
    scalars: dict[str, Column] = field(default_factory=dict)
    uses_silver_metrics: bool = False


def _s(c: Column) -> Column:
    return c.cast("string")


def _count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def _row_scalar(df: DataFrame) -> Column:
    """A one-row frame as one struct-valued scalar subquery."""
    return df.select(F.struct(*df.columns).alias("s")).scalar()


def _run(spark: SparkSession, silver: DataFrame | None, groups: list[_Group]) -> DataFrame:
    """Attach every needed scalar once to one base row, then spread the rows."""
    if any(g.uses_silver_metrics for g in groups):
        base = silver_metrics(silver)
    else:
        base = spark.range(1).select()
    scalars: dict[str, Column] = {}
    for g in groups:
        scalars.update(g.scalars)
    row = base.select("*", *[c.alias(name) for name, c in scalars.items()])
    structs = [
        F.struct(
            F.lit(name).alias("check"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
            detail.alias("detail"),
        )
        for g in groups
        for name, passed, detail in g.specs
    ]
    return row.select(F.inline(F.array(*structs)))


# ---------------------------------------------------------------- metrics --

def silver_metrics(silver: DataFrame) -> DataFrame:
    """Every silver figure the checks need, from one scan (one row)."""
    aggs = [F.count(F.lit(1)).alias("n_silver")]
    for col, _ in QUANTITY_PAIRS:
        aggs.append(F.count_if(F.col(col).isNull()).alias(f"null_{col}"))
    aggs += [
        F.count_if(F.col("dt_carga").isNotNull()).alias("nonnull_dt_carga"),
        F.count_if(F.col("nr_cnpj_masc").rlike(MASK_PATTERN)).alias("masked"),
        F.max(visible_digits("nr_cnpj_masc")).alias("max_visible_digits"),
        F.count_if(F.col(ACTIVE) < 0).alias("negative_active"),
        F.sum(ACTIVE).alias("total_active"),
    ]
    return silver.agg(*aggs)


def bronze_metrics(bronze: DataFrame) -> DataFrame:
    """Row count and NULL-or-blank counts of the raw quantity columns (one row)."""
    aggs = [F.count(F.lit(1)).alias("n_bronze")]
    for _, raw_col in QUANTITY_PAIRS:
        aggs.append(F.count_if(blank(raw_col)).alias(f"blank_{raw_col}"))
    return bronze.agg(*aggs)


# ------------------------------------------------------------ check groups --

def _ingest(raw: DataFrame, bronze: DataFrame) -> _Group:
    n_raw, n_bronze = F.col("n_raw"), F.col("bm.n_bronze")
    return _Group(
        [("V1a bronze rows = raw rows", n_bronze == n_raw,
          F.concat(F.lit("raw="), _s(n_raw), F.lit(" bronze="), _s(n_bronze)))],
        {"n_raw": _count(raw), "bm": _row_scalar(bronze_metrics(bronze))},
    )


def _volume(raw: DataFrame, bronze: DataFrame) -> _Group:
    n_bronze, n_silver = F.col("bm.n_bronze"), F.col("n_silver")
    ingest = _ingest(raw, bronze)
    return _Group(
        ingest.specs
        + [("V1b silver rows = bronze rows", n_silver == n_bronze,
            F.concat(F.lit("bronze="), _s(n_bronze), F.lit(" silver="), _s(n_silver)))],
        ingest.scalars,
        uses_silver_metrics=True,
    )


def _typing(bronze: DataFrame) -> _Group:
    specs = []
    for col, raw_col in QUANTITY_PAIRS:
        ns, nb = F.col(f"null_{col}"), F.col(f"bm.blank_{raw_col}")
        specs.append(
            (f"V2 no extra NULL in {col}", ns <= nb,
             F.concat(F.lit("silver_nulls="), _s(ns), F.lit(" source_blanks="), _s(nb)))
        )
    nn = F.col("nonnull_dt_carga")
    specs.append(("V2d dt_carga has values", nn > 0, F.concat(F.lit("non_null="), _s(nn))))
    return _Group(specs, {"bm": _row_scalar(bronze_metrics(bronze))}, uses_silver_metrics=True)


def _masking() -> _Group:
    masked, n = F.col("masked"), F.col("n_silver")
    digits = F.coalesce(F.col("max_visible_digits"), F.lit(0))
    return _Group(
        [
            ("V3a every id ends in the mask", masked == n,
             F.concat(F.lit("masked="), _s(masked), F.lit("/"), _s(n))),
            (f"V3b at most {MASK_KEEP} visible digits", digits <= MASK_KEEP,
             F.concat(F.lit("max_visible_digits="), _s(digits))),
        ],
        uses_silver_metrics=True,
    )


def _sanity() -> _Group:
    neg = F.col("negative_active")
    return _Group(
        [("V4 no negative active quantity", neg == 0, F.concat(F.lit("negative="), _s(neg)))],
        uses_silver_metrics=True,
    )


def check_ingest(raw: DataFrame, bronze: DataFrame) -> DataFrame:
    """V1a alone: bronze keeps every raw row (usable before silver exists)."""
    return _run(bronze.sparkSession, None, [_ingest(raw, bronze)])


def check_volume(raw: DataFrame, bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """V1: bronze keeps every raw row; silver keeps every bronze row."""
    return _run(silver.sparkSession, silver, [_volume(raw, bronze)])


def check_typing(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """V2: the lenient casts produced no NULL the source did not have."""
    return _run(silver.sparkSession, silver, [_typing(bronze)])


def check_masking(silver: DataFrame) -> DataFrame:
    """V3: every identifier ends in the mask; at most 8 digits stay visible."""
    return _run(silver.sparkSession, silver, [_masking()])


def check_sanity(silver: DataFrame) -> DataFrame:
    """V4: no negative active quantity."""
    return _run(silver.sparkSession, silver, [_sanity()])


# ----------------------------------------------------------- reconcile (V5) --

def recompute(silver: DataFrame, keys: str | list[str], measure: str = ACTIVE) -> DataFrame:
    """Independent re-aggregation of silver by ``keys`` (column ``qt``)."""
    keys = [keys] if isinstance(keys, str) else keys
    return silver.groupBy(*keys).agg(F.sum(measure).alias("qt"))


def recompute_all(silver: DataFrame, key_sets: list[list[str]], measure: str = ACTIVE) -> DataFrame:
    """Several re-aggregations of silver from one scan (GROUPING SETS).

    Rows carry ``_tm_gid``; :func:`recomputed` picks one key set out.
    """
    dims = list(dict.fromkeys(k for keys in key_sets for k in keys))
    return silver.groupingSets(key_sets, *dims).agg(
        F.sum(measure).alias("qt"), F.grouping_id().alias("_tm_gid")
    )


def recomputed(all_sets: DataFrame, keys: list[str]) -> DataFrame:
    """The re-aggregation by ``keys`` out of :func:`recompute_all`."""
    dims = [c for c in all_sets.columns if c not in ("qt", "_tm_gid")]
    return all_sets.filter(F.col("_tm_gid") == grouping_id_of(dims, keys)).select(*keys, "qt")


def divergences(
    recalc: DataFrame, gold: DataFrame, keys: str | list[str], mode: str = "strict"
) -> DataFrame:
    """Keys whose sums differ or that exist on one side only.

    ``strict`` joins with plain equality, so a NULL key never matches and a
    NULL sum always counts (the reference behaviour). ``null_safe`` matches
    NULL keys and NULL sums with null-safe equality. Both sides are already
    aggregated, so the full outer join only sees one row per key.
    """
    keys = [keys] if isinstance(keys, str) else keys
    g = gold.select(*keys, F.col(GOLD_MEASURE).alias("qg"))
    if mode == "strict":
        joined = recalc.join(g, keys, "full_outer")
        bad = (F.col("qt") != F.col("qg")) | F.col("qt").isNull() | F.col("qg").isNull()
        return joined.filter(bad).select(*keys, "qt", "qg")
    if mode == "null_safe":
        r, gg = recalc.alias("r"), g.alias("g")
        cond = None
        for k in keys:
            c = F.col(f"r.{k}").eqNullSafe(F.col(f"g.{k}"))
            cond = c if cond is None else cond & c
        joined = r.join(gg, cond, "full_outer")
        bad = ~F.col("r.qt").eqNullSafe(F.col("g.qg"))
        return joined.filter(bad).select(
            *[F.coalesce(F.col(f"r.{k}"), F.col(f"g.{k}")).alias(k) for k in keys],
            F.col("r.qt").alias("qt"), F.col("g.qg").alias("qg"),
        )
    raise ValueError(f"unknown mode: {mode}")


# gold table -> (label, single key the reference recomputes by)
RECONCILE = {
    "beneficiarios_por_operadora": ("operadora", "cd_operadora"),
    "beneficiarios_por_faixa_etaria": ("faixa_etaria", "de_faixa_etaria"),
    "beneficiarios_por_municipio": ("municipio", "cd_municipio"),
}


def _reconcile(silver: DataFrame, golds: Golds, mode: str) -> _Group:
    """V5 for all three golds with one recompute and one join.

    Silver is re-aggregated by the three key sets in one grouping-sets scan;
    each row gets its gold's label and its key (the single code in
    ``strict`` mode, the struct of gold's keys in ``null_safe`` mode). The
    three golds are unioned with the same (label, key) shape, one full outer
    join on (label, key) pairs them, and one aggregate counts the divergent
    keys per label. ``strict`` keeps plain equality (a NULL key never
    matches), as :func:`divergences` does.
    """
    if mode not in ("strict", "null_safe"):
        raise ValueError(f"unknown mode: {mode}")
    tables = list(golds.by_table())
    key_sets = {t: ([RECONCILE[t][1]] if mode == "strict" else GOLD_KEYS[t]) for t in tables}
    dims = list(dict.fromkeys(k for keys in key_sets.values() for k in keys))
    rec = recompute_all(silver, list(key_sets.values()))
    gid = F.col("_tm_gid")
    label = None
    key = None
    for t in tables:
        hit = gid == grouping_id_of(dims, key_sets[t])
        label = (F.when(hit, F.lit(RECONCILE[t][0])) if label is None else label.when(hit, F.lit(RECONCILE[t][0])))
        if mode == "strict":
            col = F.col(key_sets[t][0])
            key = F.when(hit, col) if key is None else key.when(hit, col)
    if mode == "null_safe":
        key = F.struct(*dims)
    left = rec.select(label.alias("label"), key.alias("k"), "qt")

    right = None
    for t, gold in golds.by_table().items():
        if mode == "strict":
            k = F.col(key_sets[t][0])
        else:
            k = F.struct(*[(F.col(d) if d in key_sets[t] else F.lit(None).cast("string")).alias(d) for d in dims])
        part = gold.select(F.lit(RECONCILE[t][0]).alias("label"), k.alias("k"), F.col(GOLD_MEASURE).alias("qg"))
        right = part if right is None else right.unionByName(part)

    if mode == "strict":
        joined = left.join(right, ["label", "k"], "full_outer")
        bad = (F.col("qt") != F.col("qg")) | F.col("qt").isNull() | F.col("qg").isNull()
        labelled = joined.filter(bad).select("label")
    else:
        l, r = left.alias("l"), right.alias("r")
        cond = (F.col("l.label") == F.col("r.label")) & F.col("l.k").eqNullSafe(F.col("r.k"))
        joined = l.join(r, cond, "full_outer")
        labelled = joined.filter(~F.col("l.qt").eqNullSafe(F.col("r.qg"))).select(
            F.coalesce(F.col("l.label"), F.col("r.label")).alias("label")
        )
    labels = [RECONCILE[t][0] for t in tables]
    counts = labelled.agg(*[F.count_if(F.col("label") == lb).alias(lb) for lb in labels])
    specs = []
    for lb in labels:
        n = F.col(f"div.{lb}")
        specs.append((f"V5 gold {lb} = recompute", n == 0, F.concat(F.lit("divergences="), _s(n))))
    return _Group(specs, {"div": _row_scalar(counts)})


def check_reconcile(silver: DataFrame, golds: Golds, mode: str = "strict") -> DataFrame:
    """V5: each gold equals an independent recompute from silver."""
    return _run(silver.sparkSession, silver, [_reconcile(silver, golds, mode)])


# ---------------------------------------------------------- totals (V7) --

def _totals(golds: Golds) -> _Group:
    t_s = F.col("total_active")
    t_o, t_f, t_m = F.col("tot.o"), F.col("tot.f"), F.col("tot.m")
    tot = golds.operadora.agg(F.sum(GOLD_MEASURE).alias("o")).select(
        "o",
        golds.faixa.agg(F.sum(GOLD_MEASURE)).scalar().alias("f"),
        golds.municipio.agg(F.sum(GOLD_MEASURE)).scalar().alias("m"),
    )
    passed = (t_s == t_o) & (t_o == t_f) & (t_f == t_m)
    detail = F.concat(
        F.lit("silver="), _s(t_s), F.lit(" operadora="), _s(t_o),
        F.lit(" faixa="), _s(t_f), F.lit(" municipio="), _s(t_m),
    )
    return _Group([("V7 totals equal in silver and golds", passed, detail)], {"tot": _row_scalar(tot)},
                  uses_silver_metrics=True)


def check_totals(silver: DataFrame, golds: Golds) -> DataFrame:
    """V7: the active total is identical in silver and the three golds."""
    return _run(silver.sparkSession, silver, [_totals(golds)])


# --------------------------------------------------------- outputs (V6) --

def _ordered_mismatches(file_rows: DataFrame, gold_rows: DataFrame, cols: list[str]) -> Column:
    """Count of positions where the file and gold disagree on ``cols``."""
    f = file_rows.select(POSITION, *[F.col(c).alias(f"f_{c}") for c in cols])
    g = gold_rows.select(POSITION, *[F.col(c).alias(f"g_{c}") for c in cols])
    bad = None
    for c in cols:
        cnd = ~F.col(f"f_{c}").eqNullSafe(F.col(f"g_{c}"))
        bad = cnd if bad is None else bad | cnd
    return _count(f.join(g, POSITION, "full_outer").filter(bad))


def _file_in_order(spark: SparkSession, out_dir: str, name: str, table: str) -> DataFrame:
    return read_result_positions(spark, out_dir, name, gold_schema(table), POSITION)


def _outputs(spark: SparkSession, golds: Golds, out_dir: str, ranked: Golds | None) -> _Group:
    fx_keys = GOLD_KEYS["beneficiarios_por_faixa_etaria"]
    if ranked is None:
        ranked = Golds(*(
            with_position(g, order_desc(GOLD_MEASURE, GOLD_KEYS[t])) for t, g in golds.by_table().items()
        ))
    f_a = _file_in_order(spark, out_dir, "a_top5_operadoras", "beneficiarios_por_operadora")
    f_b = _file_in_order(spark, out_dir, "b_faixa_etaria_top", "beneficiarios_por_faixa_etaria")
    f_c = _file_in_order(spark, out_dir, "c_beneficiarios_por_municipio", "beneficiarios_por_municipio")
    scalars = {
        "mis_a": _ordered_mismatches(f_a, ranked.operadora.filter(F.col(POSITION) <= 5), [GOLD_MEASURE]),
        "mis_b": _ordered_mismatches(f_b, ranked.faixa.filter(F.col(POSITION) <= 1), fx_keys + [GOLD_MEASURE]),
        "n_file": _count(f_c),
        "n_gold": _count(golds.municipio),
        "mis_d": _ordered_mismatches(f_c, ranked.municipio, [GOLD_MEASURE]),
    }
    mis_a, mis_b, n_file, n_gold, mis_d = (F.col(c) for c in scalars)
    return _Group(
        [
            ("V6a top-5 operators file = gold", mis_a == 0, F.concat(F.lit("mismatches="), _s(mis_a))),
            ("V6b leading age band file = gold", mis_b == 0, F.concat(F.lit("mismatches="), _s(mis_b))),
            ("V6c municipality file row count = gold", n_file == n_gold,
             F.concat(F.lit("file="), _s(n_file), F.lit(" gold="), _s(n_gold))),
            ("V6d municipality file = gold in order", mis_d == 0, F.concat(F.lit("mismatches="), _s(mis_d))),
        ],
        scalars,
    )


def check_outputs(
    spark: SparkSession, golds: Golds, out_dir: str, ranked: Golds | None = None
) -> DataFrame:
    """V6: the exported result files equal gold, value by value, in order.

    ``ranked`` are the golds with positions (the stored ranking tables);
    they are computed here when not given.
    """
    return _run(spark, None, [_outputs(spark, golds, out_dir, ranked)])


# ------------------------------------------------------- reference (V8) --

REFERENCE_COLUMNS = [
    "top_operadora_nome", "top_operadora_qt", "top_faixa", "top_faixa_qt",
    "top_muni", "top_muni_qt", "qt_municipios",
]


def _reference(golds: Golds, reference: DataFrame) -> _Group:
    def lead(df: DataFrame, keys: list[str], name: str) -> Column:
        row = leader(df, GOLD_MEASURE, keys).select(F.col(name).alias("name"), F.col(GOLD_MEASURE).alias("qt"))
        return _row_scalar(row)

    scalars = {
        "ref": _row_scalar(reference.select(*REFERENCE_COLUMNS)),
        "lead_o": lead(golds.operadora, GOLD_KEYS["beneficiarios_por_operadora"], "nm_razao_social"),
        "lead_f": lead(golds.faixa, GOLD_KEYS["beneficiarios_por_faixa_etaria"], "de_faixa_etaria"),
        "lead_m": lead(golds.municipio, GOLD_KEYS["beneficiarios_por_municipio"], "nm_municipio"),
        "n_mun": _count(golds.municipio),
    }
    o, f, m, n_mun = F.col("lead_o"), F.col("lead_f"), F.col("lead_m"), F.col("n_mun")
    ref = lambda c: F.col(f"ref.{c}")

    def shown(s: Column) -> Column:
        return F.concat(s.getField("name"), F.lit(" = "), _s(s.getField("qt")))

    return _Group(
        [
            ("V8a top operator = reference",
             accent_insensitive_equal(o.getField("name"), ref("top_operadora_nome"))
             & (o.getField("qt") == ref("top_operadora_qt")), shown(o)),
            ("V8b leading age band = reference",
             (f.getField("name") == ref("top_faixa")) & (f.getField("qt") == ref("top_faixa_qt")), shown(f)),
            ("V8c top municipality = reference",
             accent_insensitive_equal(m.getField("name"), ref("top_muni"))
             & (m.getField("qt") == ref("top_muni_qt")), shown(m)),
            ("V8d municipality count = reference", n_mun == ref("qt_municipios"),
             F.concat(F.lit("municipios="), _s(n_mun))),
        ],
        scalars,
    )


def check_reference(golds: Golds, reference: DataFrame) -> DataFrame:
    """V8: leaders and municipality count equal the expected reference values.

    ``reference`` is one row with :data:`REFERENCE_COLUMNS`. Names are
    compared ignoring accents (case still matters).
    """
    return _run(reference.sparkSession, None, [_reference(golds, reference)])


# ------------------------------------------------------------------ report --

def checks(
    raw: DataFrame,
    bronze: DataFrame,
    silver: DataFrame,
    golds: Golds,
    out_dir: str | None = None,
    reference: DataFrame | None = None,
    mode: str = "strict",
    ranked: Golds | None = None,
) -> DataFrame:
    """The whole validation suite (V1-V8) as one DataFrame of check rows.

    Built on a single base row: silver's metrics aggregate plus every
    scalar attached once, so each source is scanned once. V6 needs the
    published results folder and V8 the expected reference row; each group
    is left out when its input is not given.
    """
    groups = [_volume(raw, bronze), _typing(bronze), _masking(), _sanity(), _reconcile(silver, golds, mode)]
    if out_dir is not None:
        groups.append(_outputs(silver.sparkSession, golds, out_dir, ranked))
    groups.append(_totals(golds))
    if reference is not None:
        groups.append(_reference(golds, reference))
    return _run(silver.sparkSession, silver, groups)


def check_silver(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """V2-V4 on one base row (the gate before gold is built)."""
    return _run(silver.sparkSession, silver, [_typing(bronze), _masking(), _sanity()])


def check_gold(silver: DataFrame, golds: Golds, mode: str = "strict") -> DataFrame:
    """V5 and V7 on one base row (the gate before results are published)."""
    return _run(silver.sparkSession, silver, [_reconcile(silver, golds, mode), _totals(golds)])


def report(*groups: DataFrame) -> DataFrame:
    """All check rows of the given groups (V9)."""
    out = groups[0]
    for g in groups[1:]:
        out = out.unionByName(g)
    return out


def _not_passed() -> Column:
    """A NULL outcome is not a pass."""
    return ~F.coalesce(F.col("passed"), F.lit(False))


def summary(checks: DataFrame) -> DataFrame:
    """One row: checks passed, checks run, and whether all passed (false without checks)."""
    return checks.agg(
        F.count_if(F.col("passed")).alias("n_passed"),
        F.count(F.lit(1)).alias("n_checks"),
        ((F.count(F.lit(1)) > 0) & (F.count_if(_not_passed()) == 0)).alias("all_passed"),
    )


def assert_all(checks: DataFrame) -> None:
    """Raise :class:`ChecksFailed` listing every check that did not pass, or if there is none at all.

    The suite's rows, about twenty, are read in one run.
    """
    rows = checks.select("check", "detail", _not_passed().alias("failed"))
    rows = rows.filter("failed").unionByName(
        checks.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
            F.lit("any check").alias("check"), F.lit("no check was run").alias("detail"), F.lit(True).alias("failed"))
    )
    failed = rows.collect()
    if failed:
        lines = "; ".join(f"{r['check']} ({r['detail']})" for r in failed)
        raise ChecksFailed(f"{len(failed)} check(s) failed: {lines}")
