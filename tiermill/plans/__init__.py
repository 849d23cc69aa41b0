"""Plans: the named-result registry and the layer runner."""

from tiermill.plans.medallion import STEPS, load_golds, load_silver, load_month, publish, run, upsert
from tiermill.plans.results import RESULTS, NamedResult, register_result, result, result_names, unregister_result

__all__ = [
    "RESULTS",
    "STEPS",
    "NamedResult",
    "load_golds",
    "load_month",
    "load_silver",
    "publish",
    "result",
    "register_result",
    "result_names",
    "run",
    "unregister_result",
    "upsert",
]
