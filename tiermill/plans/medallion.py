"""Layer runner: raw file -> bronze -> silver -> gold -> published results.

Each step reads the previous step's stored output, so any step can be run
alone from stored inputs, and every write cuts the lineage (an executor
lost later never forces a recompute from the raw file).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType

from tiermill.operators import quality
from tiermill.operators.layers import GID, Golds, golds_one_pass, split_golds, to_bronze, to_golds, to_silver
from tiermill.operators.ranking import rank_with_share
from tiermill.plans.results import RESULTS, result
from tiermill.schemas import GOLD_KEYS, GOLD_MEASURE, MONTH, PARTIALS_SCHEMA, SILVER_SCHEMA, gold_schema
from tiermill.sources.layers import layer_path, read_layer, register_table, small_tasks, storage_options, unsorted_writes, write_layer
from tiermill.session import cut_lineage, new_scratch_path, remove_path
from tiermill.sources.raw_csv import read_raw
from tiermill.sources.results import export_result
from tiermill.sources.staging import promote, staged

BRONZE = ("bronze", "beneficiarios")
SILVER = ("silver", "beneficiarios")
PARTIALS = ("gold", "_parciais_por_mes")
STEPS = ("bronze", "silver", "gold", "results")
MAX_CONCURRENT_WRITES = 4


def _concurrently(jobs: dict[str, Callable[[], str]], at_once: int = MAX_CONCURRENT_WRITES) -> dict[str, str]:
    """Run independent write jobs from a few driver threads.

    Spark schedules jobs submitted from different threads side by side, so
    small independent writes (the gold splits, result exports, rankings)
    share the executors instead of queueing one after the other. The first
    failure is re-raised.
    """
    if len(jobs) <= 1:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(at_once, len(jobs))) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def load_bronze(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    return read_layer(spark, root, *BRONZE, fmt=fmt, recursive=True)


def load_silver(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    return read_layer(spark, root, *SILVER, schema=SILVER_SCHEMA, fmt=fmt)


def load_golds(spark: SparkSession, root: str, fmt: str = "parquet") -> Golds:
    g = {t: read_layer(spark, root, "gold", t, schema=gold_schema(t), fmt=fmt) for t in GOLD_KEYS}
    return Golds(g["beneficiarios_por_operadora"], g["beneficiarios_por_faixa_etaria"], g["beneficiarios_por_municipio"])


# Ranked serving tables written next to the golds: gold table -> ranking table.
RANKINGS = {
    "beneficiarios_por_operadora": "ranking_operadora",
    "beneficiarios_por_faixa_etaria": "ranking_faixa_etaria",
    "beneficiarios_por_municipio": "ranking_municipio",
}


def load_rankings(spark: SparkSession, root: str, fmt: str = "parquet") -> Golds:
    """The ranked golds (position, keys, quantity, share, proportion of leader)."""
    r = {t: read_layer(spark, root, "gold", name, fmt=fmt) for t, name in RANKINGS.items()}
    return Golds(r["beneficiarios_por_operadora"], r["beneficiarios_por_faixa_etaria"], r["beneficiarios_por_municipio"])


def publish(spark: SparkSession, root: str, out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Export every named result of the registry (L5) and write the ranked golds.

    Positions and shares are computed once here, so paging, concentration,
    display and the output checks read a stored table instead of re-ranking.
    """
    golds = load_golds(spark, root, fmt)
    jobs: dict[str, Callable[[], str]] = {
        name: (lambda name=name: export_result(result(golds, name), out_dir, name)) for name in RESULTS
    }
    for table, gold in golds.by_table().items():
        jobs[RANKINGS[table]] = lambda table=table, gold=gold: write_layer(
            rank_with_share(gold, GOLD_MEASURE, GOLD_KEYS[table]), root, "gold", RANKINGS[table], fmt=fmt
        )
    return _concurrently(jobs)


def run(
    spark: SparkSession,
    raw_path: str,
    root: str,
    out_dir: str | None = None,
    steps: list[str] | None = None,
    *,
    fmt: str = "parquet",
    silver_layout: str = "sorted",
    gold_one_pass: bool = True,
    register: bool = False,
    gate: bool = False,
    raw_schema=None,
    source_per_file: bool = False,
) -> dict[str, str]:
    """Run the selected steps in order (all by default).

    Unknown step names raise before anything runs. With ``gate=True`` every
    layer is written aside, checked there, and only then put in the place of
    the former one (write, audit, publish): bronze if its volume agrees with
    the raw files', silver if it passes the typing, masking and sanity checks,
    gold if it reconciles with silver. A layer that fails leaves the former
    one as it is and raises. Steps left out are checked as they are stored.

    ``gold_one_pass`` computes the three golds from one scan of silver
    (grouping sets), materialised once in the shared scratch folder and then
    split; otherwise each gold scans silver on its own. ``raw_schema``
    (e.g. :data:`tiermill.schemas.RAW_SCHEMA`) fixes the raw columns instead
    of taking their names from the header line. ``source_per_file``
    records each row's own input file in ``_source_file`` (useful when the
    raw path is a folder or glob of deliveries) instead of the path given.
    """
    chosen = [s.lower() for s in (steps or STEPS)]
    unknown = [s for s in chosen if s not in STEPS]
    if unknown:
        raise ValueError(f"unknown step(s): {unknown}; known: {list(STEPS)}")
    if "results" in chosen and out_dir is None:
        raise ValueError("the results step needs out_dir")
    paths: dict[str, str] = {}
    for step in STEPS:
        if step not in chosen:
            continue
        if step == "bronze":
            raw = read_raw(spark, raw_path, raw_schema)
            source = None if source_per_file else raw_path
            with small_tasks(spark):
                paths["bronze"] = _published(
                    spark, root, [BRONZE], gate,
                    lambda to: write_layer(to_bronze(raw, source=source), to, *BRONZE, fmt=fmt),
                    lambda to: quality.check_ingest(raw, load_bronze(spark, to, fmt)))
            if register:
                register_table(spark, root, *BRONZE, fmt=fmt, recursive=True)
        elif step == "silver":
            bronze = load_bronze(spark, root, fmt)
            if gate and "bronze" not in chosen:
                quality.assert_all(quality.check_ingest(read_raw(spark, raw_path, raw_schema), bronze))
            with small_tasks(spark):
                paths["silver"] = _published(
                    spark, root, [SILVER], gate,
                    lambda to: write_layer(to_silver(bronze), to, *SILVER, partition_by=[MONTH], fmt=fmt, layout=silver_layout),
                    lambda to: quality.check_silver(bronze, load_silver(spark, to, fmt)))
            _forget_partials(spark, root, fmt)
            if register:
                register_table(spark, root, *SILVER, fmt=fmt, partitioned=True)
        elif step == "gold":
            if gate and "silver" not in chosen:
                quality.assert_all(quality.check_silver(load_bronze(spark, root, fmt), load_silver(spark, root, fmt)))
            _published(
                spark, root, [("gold", t) for t in GOLD_KEYS], gate,
                lambda to: refresh_gold(spark, root, fmt, gold_one_pass, to=to),
                lambda to: quality.check_gold(load_silver(spark, root, fmt), load_golds(spark, to, fmt)))
            paths.update({t: layer_path(root, "gold", t) for t in GOLD_KEYS})
            if register:
                for table in GOLD_KEYS:
                    register_table(spark, root, "gold", table, fmt=fmt)
        elif step == "results":
            if gate and "gold" not in chosen:
                quality.assert_all(quality.check_gold(load_silver(spark, root, fmt), load_golds(spark, root, fmt)))
            paths.update(publish(spark, root, out_dir, fmt))
    return paths


def _published(
    spark: SparkSession, root: str, tables: list[tuple[str, str]], gate: bool, write: Callable[[str], object],
    checks: Callable[[str], DataFrame],
) -> str:
    """Write tables in place or, with ``gate``, aside; there they are checked, and promoted if all checks pass."""
    if not gate:
        write(root)
    else:
        with staged(spark, root) as aside:
            write(aside)
            quality.assert_all(checks(aside))
            for layer, table in tables:
                promote(spark, layer_path(aside, layer, table), layer_path(root, layer, table))
    return layer_path(root, *tables[0])


def _write_golds(golds: Golds, root: str, fmt: str) -> dict[str, str]:
    return _concurrently(
        {t: (lambda t=t, g=g: write_layer(g, root, "gold", t, fmt=fmt)) for t, g in golds.by_table().items()}
    )


def refresh_gold(spark: SparkSession, root: str, fmt: str = "parquet", one_pass: bool = True, *, to: str | None = None) -> dict[str, str]:
    """Rebuild the three golds from the stored silver (into the lake ``to`` if it is given)."""
    silver = load_silver(spark, root, fmt)
    golds = split_golds(cut_lineage(golds_one_pass(silver))) if one_pass else to_golds(silver)
    return _write_golds(golds, to or root, fmt)


# Golds by month: sums of every month on their own, so that a load scans its own months only.


def load_partials(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame | None:
    """The stored sums by month and gold key; None for a lake without any."""
    try:
        return read_layer(spark, root, *PARTIALS, schema=PARTIALS_SCHEMA, fmt=fmt)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err) and "Path does not exist" not in str(err):
            raise
        return None


def _forget_partials(spark: SparkSession, root: str, fmt: str = "parquet") -> None:
    """Silver was written anew: no month's sums hold any more."""
    if load_partials(spark, root, fmt) is not None:
        empty = spark.createDataFrame([], PARTIALS_SCHEMA)
        write_layer(empty, root, *PARTIALS, partition_by=[MONTH], fmt=fmt, layout="sorted")


def _month_in(months: list[str | None]):
    """Literal month values, NULL among them, so that only their folders are listed and scanned."""
    known = [m for m in months if m is not None]
    hit = F.col(MONTH).isin(known) if known else F.lit(False)
    return hit | F.col(MONTH).isNull() if None in months else hit


def month_sums(silver: DataFrame) -> DataFrame:
    """The gold sums of every month, from one scan: month, gold keys, grouping id and sum."""
    keys = list(dict.fromkeys(k for ks in GOLD_KEYS.values() for k in ks))
    sets = [[*ks, MONTH] for ks in GOLD_KEYS.values()]
    sums = silver.groupingSets(sets, *keys, MONTH).agg(F.sum("qt_beneficiario_ativo").alias(GOLD_MEASURE), F.grouping_id().alias("_id"))
    # without the month, which every set holds, the id is that of the golds
    return sums.select(*keys, F.shiftright("_id", 1).cast("long").alias(GID), GOLD_MEASURE, MONTH)


def refresh_partials(spark: SparkSession, root: str, months: list[str | None], fmt: str = "parquet") -> list[str | None]:
    """Store the sums of the given months and of all whose sums are missing; returns the months scanned.

    Which months are there comes from the folders' names of both tables.
    Months that silver no longer has lose their sums.
    """
    silver, partials = load_silver(spark, root, fmt), load_partials(spark, root, fmt)
    have = {r[0] for r in silver.select(MONTH).distinct().collect()}
    stored = set() if partials is None else {r[0] for r in partials.select(MONTH).distinct().collect()}
    if stored - have:
        kept = cut_lineage(partials.filter(_month_in(list(stored & have))))
        write_layer(kept, root, *PARTIALS, partition_by=[MONTH], fmt=fmt, layout="sorted")
    todo = sorted((have & set(months)) | (have - stored), key=lambda m: (m is None, m or ""))
    if todo:
        scan = silver if set(todo) == have else silver.filter(_month_in(todo))
        _overwrite_partitions(month_sums(scan), layer_path(root, *PARTIALS), [MONTH], fmt)
    return todo


def golds_from_partials(partials: DataFrame) -> Golds:
    """The golds as sums of the months' sums (gold-sized rows a month, no scan of silver)."""
    keys = [c for c in partials.columns if c not in (GOLD_MEASURE, MONTH)]
    return split_golds(partials.groupBy(*keys).agg(F.sum(GOLD_MEASURE).alias(GOLD_MEASURE)))


def refresh_gold_months(
    spark: SparkSession, root: str, months: list[str | None], fmt: str = "parquet", *, to: str | None = None
) -> dict[str, str]:
    """The golds after a change of some months of silver: only these months are scanned."""
    refresh_partials(spark, root, months, fmt)
    golds = golds_from_partials(load_partials(spark, root, fmt))
    return _write_golds(golds, to or root, fmt)


def register_layers(spark: SparkSession, root: str, fmt: str = "parquet") -> list[str]:
    """Expose every written layer table in the session catalog."""
    out = [
        register_table(spark, root, *BRONZE, fmt=fmt, recursive=True),
        register_table(spark, root, *SILVER, fmt=fmt, partitioned=True),
    ]
    return out + [register_table(spark, root, "gold", table, fmt=fmt) for table in GOLD_KEYS]


def run_month(
    spark: SparkSession, raw_path: str, root: str, out_dir: str, month: str, *, fmt: str = "parquet", gate: bool = False,
    raw_schema=None,
) -> dict[str, str]:
    """One month's delivery from end to end: bronze, silver's month, golds, rankings and results.

    The delivery gets a folder of its own in bronze and replaces its month in
    silver, so loading it again leaves the same state. The golds are merged
    from stored sums by month: only the loaded month of silver is scanned
    (all of it once, when a lake has no such sums yet). With ``gate`` each
    layer is checked aside and only then put in place.
    """
    raw = read_raw(spark, raw_path, raw_schema)
    name = (BRONZE[0], f"{BRONZE[1]}/month-{month}")

    def load(to: str) -> DataFrame:
        return spark.read.format(fmt).load(layer_path(to, *name))

    with small_tasks(spark):
        paths = {"bronze": _published(
            spark, root, [name], gate,
            lambda to: to_bronze(raw, source=raw_path).write.mode("overwrite").format(fmt).options(**storage_options(fmt)).save(
                layer_path(to, *name)),
            lambda to: quality.check_ingest(raw, load(to)))}
    rows = to_silver(load(root))
    if gate:
        quality.assert_all(quality.check_silver(load(root), rows))
    paths["silver"] = load_month(rows, root, month, fmt)
    _published(
        spark, root, [("gold", t) for t in GOLD_KEYS], gate,
        lambda to: refresh_gold_months(spark, root, [month], fmt, to=to),
        lambda to: quality.check_gold(load_silver(spark, root, fmt), load_golds(spark, to, fmt)))
    paths.update({t: layer_path(root, "gold", t) for t in GOLD_KEYS})
    paths.update(publish(spark, root, out_dir, fmt))
    return paths


class WrongMonth(ValueError):
    """The rows given for a month hold rows of another one."""


def load_month(
    month_rows: DataFrame, root: str, month: str | None, fmt: str = "parquet", *, layout: str = "sorted",
    only: bool = False,
) -> str:
    """Replace one reference month of silver by ``month_rows``.

    Rows of another month raise :class:`WrongMonth` before anything is
    written; with ``only=True`` they are left out instead. Other months are
    kept, and loading the same month twice leaves the same state. A month
    without rows stays as it is (there is nothing to replace it by).
    """
    if layout not in ("rebalance", "sorted", "local"):
        raise ValueError(f"unknown layout: {layout}")
    out = month_rows.select(*[f.name for f in SILVER_SCHEMA.fields])
    mine = F.col(MONTH).eqNullSafe(F.lit(month).cast("string"))
    if only:
        out = out.filter(mine)
    else:
        other = out.filter(~mine).select(MONTH).limit(1).collect()
        if other:
            raise WrongMonth(f"rows of month {other[0][0]!r} among those of {month!r}")
    path = _overwrite_partitions(out, layer_path(root, *SILVER), [MONTH], fmt, layout)
    _silver_changed(out.sparkSession, root, [month], fmt)
    return path


def _silver_changed(spark: SparkSession, root: str, months: list[str | None], fmt: str) -> None:
    """Stored sums, if there are any, follow the months that were written."""
    if load_partials(spark, root, fmt) is not None:
        refresh_partials(spark, root, months, fmt)


def _overwrite_partitions(rows: DataFrame, path: str, partition_by: list[str], fmt: str, layout: str = "sorted") -> str:
    """Replace the partitions that ``rows`` hold, and no others."""
    if layout == "rebalance":
        rows = rows.hint("rebalance", *partition_by)
    if layout != "local":
        rows = rows.sortWithinPartitions(*partition_by)
    with unsorted_writes(rows.sparkSession) if layout == "local" else nullcontext():
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .format(fmt)
            .partitionBy(*partition_by)
            .save(path)
        )
    return path


class DuplicateKeys(ValueError):
    """The batch of an upsert holds several rows of one key."""


#: Most partitions that an upsert names in its read of the old table; a batch touching more is joined instead.
NAMED_PARTITIONS = 1000


def _touched(old: DataFrame, batch: DataFrame, partition_by: list[str]) -> DataFrame:
    """The old rows in the partitions that the batch touches, NULL partitions included.

    The batch's partition values are named as literals, so the read lists and
    scans those folders only. Beyond :data:`NAMED_PARTITIONS` a null-safe
    semi join selects them.
    """
    values = batch.select(*partition_by).distinct()
    named = values.limit(NAMED_PARTITIONS + 1).collect()
    if len(named) > NAMED_PARTITIONS:
        cond = [F.col(f"o.{c}").eqNullSafe(F.col(f"t.{c}")) for c in partition_by]
        return old.alias("o").join(values.alias("t"), cond, "left_semi")
    hit = F.lit(False)
    first = partition_by[0]
    rest = partition_by[1:]
    if not rest:
        known = [r[0] for r in named if r[0] is not None]
        hit = F.col(first).isin(known) if known else hit
        if any(r[0] is None for r in named):
            hit = hit | F.col(first).isNull()
        return old.filter(hit)
    for r in named:
        one = F.lit(True)
        for c in partition_by:
            one = one & (F.col(c).isNull() if r[c] is None else F.col(c) == F.lit(r[c]))
        hit = hit | one
    return old.filter(hit)


def _may_match(batch: DataFrame, keys: list[str]) -> Column:
    """Whether a row can have a key of the batch, column by column; true of every row that has one.

    Key columns of which the batch holds few values are compared with these,
    null-safely, so that a batch of one municipality leaves all others' rows
    out of the join.
    """
    may = F.lit(True)
    kinds = {f.name: f.dataType for f in batch.schema.fields}
    for k in keys:
        if kinds[k] not in (StringType(), IntegerType(), LongType(), DateType()):
            continue
        values = [r[0] for r in batch.select(k).distinct().limit(NAMED_PARTITIONS + 1).collect()]
        if len(values) <= NAMED_PARTITIONS:
            known = F.coalesce(F.col(k).isin([v for v in values if v is not None]), F.lit(False))
            may = may & (known | F.col(k).isNull() if None in values else known)
    return may


def upsert(
    spark: SparkSession,
    new_rows: DataFrame,
    root: str,
    layer: str,
    table: str,
    keys: list[str],
    *,
    schema=None,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    unique: bool = True,
) -> str:
    """Replace the rows whose key appears in ``new_rows`` and add the new ones.

    The batch is staged once in the shared scratch folder and read from
    there. Several batch rows of one key (compared null-safely) raise
    :class:`DuplicateKeys` before anything is written, unless ``unique`` is
    false, when a key stands for all its rows. Old rows whose key is in the
    batch are removed by a null-safe left anti join on its distinct keys;
    rows that differ from all batch rows in one key column do not enter it.

    When the table is partitioned by columns of the key, only the partitions
    the batch touches can change: only those are read (their values are named
    in the read, so others are pruned) and written back; NULL partitions
    count like any other. The merged rows are staged in the scratch folder as
    well, since a plan cannot overwrite its own input; both staged tables are
    removed in the end.
    """
    path = f"{root.rstrip('/')}/{layer}/{table}"
    old = read_layer(spark, root, layer, table, schema=schema, fmt=fmt)
    staged, merged_at = new_scratch_path(spark, "upsert-batch"), new_scratch_path(spark, "upsert-merged")
    try:
        new_rows.select(*old.columns).write.parquet(staged)
        batch = spark.read.schema(old.schema).parquet(staged)
        batch_keys = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tm_n"))
        if unique:
            twice = batch_keys.filter("_tm_n > 1").limit(1).collect()
            if twice:
                raise DuplicateKeys(f"several rows of the key {twice[0].asDict()}")
        scoped = bool(partition_by) and set(partition_by) <= set(keys)
        if scoped:
            old = _touched(old, batch, partition_by)
        cond = [F.col(f"o.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
        may = _may_match(batch, keys)
        kept = old.filter(may).alias("o").join(batch_keys.alias("b"), cond, "left_anti")
        old.filter(~may).unionByName(kept).unionByName(batch).write.parquet(merged_at)
        merged = spark.read.schema(old.schema).parquet(merged_at)
        if scoped:
            _overwrite_partitions(merged, path, partition_by, fmt)
        else:
            write_layer(merged, root, layer, table, partition_by=partition_by, fmt=fmt, layout="sorted")
        if (layer, table) == SILVER:
            if scoped and partition_by == [MONTH]:
                _silver_changed(spark, root, [r[0] for r in batch.select(MONTH).distinct().collect()], fmt)
            else:
                _forget_partials(spark, root, fmt)
        return path
    finally:
        remove_path(spark, staged)
        remove_path(spark, merged_at)
