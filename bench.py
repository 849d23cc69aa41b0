"""Benchmark: build the lake from the test tables and run the headline queries.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), optional BENCH_EVENT_LOG_DIR (an existing folder for Spark's
event log). Prints one JSON line. ``value`` is the wall-clock of the layer
steps (bronze, silver, gold, results) plus the headline queries; deriving
the raw file from the test tables (the stand-in for the delivered file) is
reported separately as ``fixture_raw_csv`` and not counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tiermill.plans.catalogue import QUERIES  # noqa: E402
from tiermill.plans.medallion import run  # noqa: E402
from tiermill.plans.workspace import Workspace, adopt_workspace  # noqa: E402
from tiermill.session import get_session, new_scratch_path  # noqa: E402
from tiermill.sources.fixture import raw_from_tpch, write_raw_csv  # noqa: E402

HEADLINE = [
    "a_top5_operadoras",
    "b_faixa_etaria_top",
    "c_beneficiarios_por_municipio",
    "insight_operadoras",
    "silver_by_month",
    "ranking_municipios",
    "concentracao_operadoras",
    "faixa_por_idade",
    "kpis",
    "municipios_pagina",
    "municipios_formatado",
    "dq_single_pass",
    "dq_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    extra = {}
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # existing folder; stage/task timings
    if event_dir:
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir}
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=partitions, driver_memory="16g", extra=extra)
    timings: dict[str, float] = {}

    ws = Workspace(sf_dir, new_scratch_path(spark, "bench"))
    t = time.perf_counter()
    write_raw_csv(raw_from_tpch(spark, sf_dir), ws.raw_path)
    timings["fixture_raw_csv"] = time.perf_counter() - t

    for step in ("bronze", "silver", "gold", "results"):
        t = time.perf_counter()
        run(spark, ws.raw_path, ws.root, ws.out_dir, steps=[step])
        timings[f"step_{step}"] = time.perf_counter() - t
    adopt_workspace(spark, ws)

    for name in HEADLINE:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).collect()
        timings[name] = time.perf_counter() - t

    counted = {k: v for k, v in timings.items() if k != "fixture_raw_csv"}
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "layers_plus_headline_queries_wall_clock",
                "value": round(sum(counted.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in timings.items()},
                "sf": float(m.group(1)) if m else sf_dir,
                "config": {
                    "master": f"local[{cpus}]",
                    "shuffle_partitions": partitions,
                    "driver_memory": "16g",
                    "aqe": True,
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
