"""tiermill: a Spark-native medallion (bronze / silver / gold) analytics library.

Everything is expressed with the DataFrame API so Catalyst and adaptive
execution plan the work; actions only happen in writes, exports and checks.
"""

from tiermill.operators.quality import assert_all, checks, summary
from tiermill.plans.medallion import load_bronze, load_golds, load_month, load_rankings, load_silver, publish, run, upsert
from tiermill.plans.results import RESULTS, register_result, result
from tiermill.session import get_session, scratch_root
from tiermill.sources.raw_csv import read_raw
from tiermill.streaming.ingest import stream_ingest

__all__ = [
    "RESULTS",
    "assert_all",
    "checks",
    "get_session",
    "load_bronze",
    "load_golds",
    "load_month",
    "load_rankings",
    "load_silver",
    "publish",
    "read_raw",
    "register_result",
    "result",
    "run",
    "scratch_root",
    "stream_ingest",
    "summary",
    "upsert",
]
